"""Products bought together."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from basketflow.operators.events import purchases

# Purchases of one session that are paired in one group of rows.
BLOCK_SIZE = 256


def session_baskets(events: DataFrame) -> DataFrame:
    """Distinct (session_id, product_id) purchases: the baskets, in flat form."""
    return purchases(events).distinct()


def basket_sizes(baskets: DataFrame) -> DataFrame:
    return baskets.groupBy("session_id").agg(F.count(F.lit(1)).alias("n_products"))


def giant_sessions(events: DataFrame, block_size: int = BLOCK_SIZE) -> DataFrame:
    """(session_id) of the sessions with more purchases than one group may hold.

    Counted on the map side first, so this moves one short row per session.
    Store the result before pairing: then Spark knows how large it is, and
    broadcasts it only if it is small.
    """
    return (
        purchases(events)
        .groupBy("session_id")
        .agg(F.count(F.lit(1)).alias("n"))
        .where(F.col("n") > block_size)
        .select("session_id")
    )


def basket_pairs(
    events: DataFrame, giants: DataFrame, block_size: int = BLOCK_SIZE
) -> DataFrame:
    """(session_id, item_a, item_b) for any two products bought in a session, a < b.

    ``giants`` is the stored result of ``giant_sessions``.  All other sessions
    are gathered in one shuffle, each in a row of at most ``block_size``
    products.  The giant ones are paired in blocks, by many tasks.
    """
    bought = purchases(events)
    small = bought.join(giants, "session_id", "left_anti")
    large = bought.join(giants, "session_id", "left_semi").distinct()
    return _pairs_of_small(small).unionByName(_pairs_of_large(large, block_size))


def _pairs_of_small(bought: DataFrame) -> DataFrame:
    items = F.sort_array(F.collect_set("product_id")).alias("items")
    baskets = bought.groupBy("session_id").agg(items)
    # In a sorted basket, the larger products are those further on.
    larger = F.slice("items", F.col("position") + 2, F.size("items"))
    return (
        baskets.where(F.size("items") > 1)
        .select("session_id", "items", F.posexplode("items").alias("position", "item_a"))
        .select("session_id", "item_a", F.explode(larger).alias("item_b"))
    )


def _pairs_of_large(baskets: DataFrame, block_size: int) -> DataFrame:
    """Pairs of baskets of any size, without gathering a basket anywhere.

    A basket is dealt into blocks by the hash of its products, and every two
    blocks, and each block with itself, form a group of their own.  A group
    holds two blocks at most, and every pair is made in exactly one group.
    """
    blocks = basket_sizes(baskets).select(
        "session_id", F.ceil(F.col("n_products") / block_size).alias("blocks")
    )
    dealt = (
        baskets.join(blocks, "session_id")
        .withColumn("block", F.pmod(F.xxhash64("product_id"), F.col("blocks")))
        .withColumn("other", F.explode(F.sequence(F.lit(0).cast("long"), F.col("blocks") - 1)))
        .select(
            "session_id",
            "product_id",
            "block",
            F.least("block", "other").alias("low"),
            F.greatest("block", "other").alias("high"),
        )
        # The keys are named in full, as the partitioning by session that the
        # join leaves would satisfy the grouping too, and keep a giant session
        # in one task.  The number is given, as AQE would join partitions by
        # their bytes, and each row here still becomes many pairs.
        .repartition(_shuffle_partitions(baskets), "session_id", "low", "high")
    )
    groups = dealt.groupBy("session_id", "low", "high").agg(
        _products_of("low").alias("lefts"), _products_of("high").alias("rights")
    )
    within = F.filter("rights", lambda item: item > F.col("left"))
    partners = F.when(F.col("low") == F.col("high"), within).otherwise(F.col("rights"))
    return (
        groups.select("session_id", "low", "high", "rights", F.explode("lefts").alias("left"))
        .select("session_id", "left", F.explode(partners).alias("right"))
        .select(
            "session_id",
            F.least("left", "right").alias("item_a"),
            F.greatest("left", "right").alias("item_b"),
        )
    )


def _shuffle_partitions(df: DataFrame) -> int:
    return int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))


def _products_of(block: str) -> Column:
    return F.collect_list(F.when(F.col("block") == F.col(block), F.col("product_id")))


def pair_counts(
    events: DataFrame, giants: DataFrame, block_size: int = BLOCK_SIZE
) -> DataFrame:
    """(item_a, item_b, count): sessions in which both were bought.

    Counted on the map side first, so a pair bought everywhere arrives as one
    row per task.
    """
    return (
        basket_pairs(events, giants, block_size)
        .groupBy("item_a", "item_b")
        .agg(F.count(F.lit(1)).alias("count"))
    )


def numbered_purchases(events: DataFrame, numbers: DataFrame) -> DataFrame:
    """The purchases as events whose ``product_id`` is the product's number.

    ``numbers`` (item, number) has every product bought, numbered in order.
    """
    bought = purchases(events).join(numbers, F.col("product_id") == F.col("item"))
    return bought.select("session_id", F.lit("purchase").alias("event_type"), F.col("number").alias("product_id"))


def numbered_pair_counts(
    events: DataFrame, giants: DataFrame, numbers: DataFrame, block_size: int = BLOCK_SIZE
) -> DataFrame:
    """(pair, count): ``pair_counts`` with both items' numbers in one long.

    Numbers are in the order of the items, so pairs are in the order of
    (item_a, item_b).
    """
    pairs = basket_pairs(numbered_purchases(events, numbers), giants, block_size)
    pair = F.shiftleft(F.col("item_a").cast("long"), 32).bitwiseOR(F.col("item_b").cast("long"))
    return pairs.groupBy(pair.alias("pair")).agg(F.count(F.lit(1)).alias("count"))


def named_pairs(counted: DataFrame, numbers: DataFrame) -> DataFrame:
    """(item_a, item_b, count) of numbered pairs, in their order."""
    names = [numbers.select(F.col("number").alias(f"_{x}"), F.col("item").alias(f"item_{x}")) for x in "ab"]
    ends = counted.select(
        F.shiftright("pair", 32).cast("int").alias("_a"), F.col("pair").bitwiseAND(F.lit((1 << 32) - 1)).cast("int").alias("_b"), "count"
    )
    return ends.join(names[0], "_a").join(names[1], "_b").select("item_a", "item_b", "count")


def pairs_ranked(pairs: DataFrame) -> DataFrame:
    """All pairs, the most frequent first."""
    return pairs.orderBy(F.desc("count"), "item_a", "item_b")


def top_pairs(pairs: DataFrame, n: int = 20) -> DataFrame:
    """The ``n`` most frequent pairs (a report)."""
    return pairs_ranked(pairs).limit(n)


def pair_documents(pairs: DataFrame, run_ts: datetime | None = None) -> DataFrame:
    """Pairs in the form they are stored in, under the key ``a::b``."""
    return pairs.select(
        F.concat_ws("::", "item_a", "item_b").alias("pair_id"),
        "item_a",
        "item_b",
        F.array("item_a", "item_b").alias("items"),
        "count",
        run_timestamp(run_ts).alias("updated_at"),
    )


def run_timestamp(run_ts: datetime | None) -> Column:
    """One time for the whole run: as given, or the start of the query."""
    return F.current_timestamp() if run_ts is None else F.lit(run_ts).cast("timestamp")


def co_occurrence_edges(pairs: DataFrame) -> DataFrame:
    """(source_item, item, count): each pair in both directions, in one pass."""
    return pairs.select(
        F.inline(
            F.array(
                F.struct(
                    F.col("item_a").alias("source_item"), F.col("item_b").alias("item"), "count"
                ),
                F.struct(
                    F.col("item_b").alias("source_item"), F.col("item_a").alias("item"), "count"
                ),
            )
        )
    )


def pairs_with_item(documents: DataFrame, wanted: DataFrame) -> DataFrame:
    """Stored pairs which hold a wanted item, with the item at the other end.

    ``wanted`` has the column item_id.  Membership in ``items`` is an equality
    join on the exploded array.
    """
    ends = documents.select("pair_id", "item_a", "item_b", "count", F.explode("items").alias("item_id"))
    other = F.when(F.col("item_a") == F.col("item_id"), F.col("item_b")).otherwise(F.col("item_a"))
    return ends.join(wanted.select("item_id").distinct(), "item_id", "left_semi").select(
        "item_id", "pair_id", other.alias("other_item"), "count"
    )
