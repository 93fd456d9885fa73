"""Items to recommend beside each of a user's source items."""

from __future__ import annotations

from math import ceil

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from basketflow.functions.ranking import at_least_one, best, by_group, in_order
from basketflow.operators.source_items import MAX_SOURCE_ITEMS

MAX_CO_ITEMS = 5
#: Rows of a join below which an item is not worth splitting.
LEAST_WORK = 1_000_000
_CO_ITEMS = "array<struct<item:string,count:bigint>>"


def top_co_items(edges: DataFrame, n: int) -> DataFrame:
    """(source_item, item, count, rank): the ``n`` best neighbours of each item."""
    at_least_one("n", n)
    return best(edges, "source_item", [F.desc("count"), F.asc("item")], n)


def top_co_items_nested(edges: DataFrame, n: int) -> DataFrame:
    """(source_item, co_items, depth): the same as one array per item.

    ``depth`` is ``n``: an array of that many may have been cut there, a shorter
    one holds all the neighbours.
    """
    return (
        top_co_items(edges, n)
        .groupBy("source_item")
        .agg(in_order("rank", "item", "count").alias("co_items"))
        .withColumn("depth", F.lit(n))
    )


def enough_neighbours(
    max_co_items: int = MAX_CO_ITEMS, longest_list: int = MAX_SOURCE_ITEMS
) -> int:
    """How many neighbours of an item can matter.

    An item is no neighbour of itself, so at most ``longest_list - 1`` of its
    neighbours are the user's own.  Even if those are its best, the
    ``max_co_items`` to recommend are among this many.
    """
    return max_co_items + max(longest_list, 1) - 1


def longest_list(source_items: DataFrame) -> int:
    """The length of the longest list, one number from one pass over the sizes."""
    return source_items.agg(F.max(F.size("source_items"))).first()[0] or 0


def hot_items(listed: DataFrame, edges: DataFrame, parts: int, least: int = LEAST_WORK) -> DataFrame:
    """(source_item, slices, blocks): items whose lists times neighbours are more than their share.

    A share is a ``parts``-th of all rows that the join gives, ``least`` at least.  There
    can't be more than ``parts`` such items, so they are few by construction.  Their
    lists are dealt into ``slices`` and their neighbours into ``blocks``, the larger side first.
    """
    sizes = (
        listed.groupBy("source_item")
        .agg(F.count(F.lit(1)).alias("lists"))
        .join(edges.groupBy("source_item").agg(F.count(F.lit(1)).alias("neighbours")), "source_item")
        .withColumn("work", F.col("lists") * F.col("neighbours"))
    )
    whole = Observation()
    most = sizes.observe(whole, F.sum("work").alias("work")).orderBy(F.desc("work")).limit(parts).collect()
    wanted = max((whole.get["work"] or 0) / parts, least)
    rows = []
    for r in most:
        if r["work"] <= wanted:
            break
        pieces = ceil(r["work"] / wanted)
        larger = min(pieces, max(r["lists"], r["neighbours"]))
        other = ceil(pieces / larger)
        by_lists = r["lists"] >= r["neighbours"]
        rows.append((r["source_item"], larger if by_lists else other, other if by_lists else larger))
    return listed.sparkSession.createDataFrame(rows, "source_item STRING, slices INT, blocks INT")


def _dealt(rows: DataFrame, hot: DataFrame, key: str, own: str, other: str, dealt: str, copied: str) -> DataFrame:
    """``rows`` with ``dealt``, a number below ``own`` by hash of ``key``, and a copy for each ``copied`` below ``other``."""
    placed = rows.join(F.broadcast(hot), "source_item", "left")
    number = F.coalesce(F.pmod(F.xxhash64(key), F.col(own)), F.lit(0)).cast("int")
    copies = F.sequence(F.lit(0), F.coalesce(F.col(other), F.lit(1)) - 1)
    return placed.select(*rows.columns, number.alias(dealt), F.explode(copies).alias(copied))


def candidate_recommendations(
    source_items: DataFrame, edges: DataFrame, parts: int | None = None, least: int = LEAST_WORK
) -> DataFrame:
    """(user_id, source_rank, source_item, item, count): all neighbours of each
    source item but the user's own items.

    One equality join.  An item that many lists hold and that has many neighbours is
    found by counts first; its lists are dealt into slices and its neighbours into
    blocks, and each slice meets each block in a place of its own, so no task gets more
    than about a ``parts``-th of all rows.  Own items, a list on the row, are left out
    by an expression.  ``parts``: eight times the shuffle's partitions if not given.
    """
    parts = parts or 8 * int(source_items.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    own = F.filter("source_items", lambda item: item.isNotNull())
    listed = source_items.select("user_id", own.alias("own"), F.posexplode("source_items").alias("position", "source_item"))
    hot = hot_items(listed, edges, parts, least)
    slices = _dealt(listed, hot, "user_id", "slices", "blocks", "slice", "block")
    blocks = _dealt(edges, hot, "item", "blocks", "slices", "block", "slice")
    return (
        slices.join(blocks, ["source_item", "slice", "block"])
        .where(~F.array_contains("own", F.col("item")))
        .select("user_id", (F.col("position") + 1).alias("source_rank"), "source_item", "item", "count")
    )


def _beside_source_items(source_items: DataFrame, neighbours: DataFrame) -> DataFrame:
    """A row for each user and source item: its neighbours, and all own items."""
    own = F.filter("source_items", lambda item: item.isNotNull() & (item != ""))
    listed = source_items.select(
        "user_id", own.alias("own"), F.posexplode(own).alias("position", "source_item")
    )
    names = F.col("co_items")["item"]
    distinct = F.size(F.array_distinct(F.array_compact(names))) == F.size("co_items")
    near = neighbours.withColumn("distinct_names", distinct)
    return listed.join(near, "source_item").withColumn("source_rank", F.col("position") + 1)


def _foreign(max_co_items: int) -> Column:
    """The first neighbours that are not the user's own.

    Fails where the stored array was cut too early to tell, instead of
    returning fewer than there are.
    """
    needed = F.lit(max_co_items) + F.size("own") - 1
    cut = (F.size("co_items") >= F.col("depth")) & (F.col("depth") < needed)
    error = F.raise_error(F.concat(F.lit("neighbours are stored too shallow for "), F.col("user_id")))
    # By sets of names, which takes a step for each name; with repeated or missing names, one by one.
    foreign = F.slice(F.array_except(F.col("co_items")["item"], F.col("own")), 1, max_co_items)
    named = lambda names: F.filter("co_items", lambda co: F.array_contains(names, co["item"]))
    by_name = F.get(F.transform(F.array(foreign), named), F.lit(0))
    one_by_one = F.slice(F.filter("co_items", lambda co: ~F.array_contains(F.col("own"), co["item"])), 1, max_co_items)
    return F.when(cut, error.cast(_CO_ITEMS)).when(F.col("distinct_names"), by_name).otherwise(one_by_one)


def recommendation_blocks(
    source_items: DataFrame,
    neighbours: DataFrame,
    max_co_items: int = MAX_CO_ITEMS,
) -> DataFrame:
    """(user_id, source_rank, source_item, co_items): the best ``max_co_items``
    candidates; a source item without candidates has no block.

    Both inputs are nested: one list per user, one array per item, at least
    ``enough_neighbours`` deep.  Taking out the own items is then an expression
    on the row, and the one join is by item, against one row per item.
    """
    at_least_one("max_co_items", max_co_items)
    best_foreign = _foreign(max_co_items)
    # Exploded from an array of one or none: a filter on the size afterwards
    # would evaluate the expression a second time.
    filled = F.filter(F.array(best_foreign), lambda block: F.size(block) > 0)
    return _beside_source_items(source_items, neighbours).select(
        "user_id", "source_rank", "source_item", F.explode(filled).alias("co_items")
    )


def user_recommendations(blocks: DataFrame) -> DataFrame:
    """Flat form: (user_id, source_rank, source_item, rank, item, count)."""
    return blocks.select(
        "user_id",
        "source_rank",
        "source_item",
        F.posexplode("co_items").alias("position", "co"),
    ).select(
        "user_id",
        "source_rank",
        "source_item",
        (F.col("position") + 1).alias("rank"),
        F.col("co.item").alias("item"),
        F.col("co.count").alias("count"),
    )


def user_recommendations_nested(blocks: DataFrame) -> DataFrame:
    """One row per user: array of (source_item, co_items), by source rank."""
    return by_group(blocks, "user_id").groupBy("user_id").agg(
        in_order("source_rank", "source_item", "co_items").alias("co_occurrence_recommendations")
    )
