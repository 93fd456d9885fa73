"""The registered queries: each product and each of its steps, on the test tables.

Arrays are joined to text here, for comparison with other engines only; the
operators return arrays.
"""

from __future__ import annotations

from collections.abc import Callable
from datetime import datetime, timezone
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from basketflow.functions.category import metadata_category
from basketflow.functions.formats import as_json, iso_timestamp
from basketflow.operators import abandonment as ab
from basketflow.operators import affinity as af
from basketflow.operators import baskets as bk
from basketflow.operators import events as ev
from basketflow.operators import lookup as lk
from basketflow.operators import profiles as pf
from basketflow.operators import recommendations as rc
from basketflow.operators import source_items as si
from basketflow.plans import jobs
from basketflow.plans.scratch import file_versions, scratch_path
from basketflow.plans.standin import (
    click_events,
    click_log,
    shop_events,
    shop_log,
    spelled_metadata,
    table,
)
from basketflow.sources import events as log_files
from basketflow.sources import tables

Query = Callable[[SparkSession, str], DataFrame]

RUN_TS = datetime(2026, 1, 1, tzinfo=timezone.utc)
SECOND_RUN_TS = datetime(2026, 1, 2, tzinfo=timezone.utc)

# Orders before and from this day stand for two loads of the stored tables.
SECOND_LOAD = "1998-04-25"

#: The tables that the logs are made from.
LOG_TABLES = ["customer", "events", "lineitem", "orders", "part", "supplier"]

LOG_COLUMNS = ["session_id", "user_id", "event_type", "product_id", "product_metadata"]

REGISTRY: dict[str, Query] = {}


def query(function: Query) -> Query:
    REGISTRY[function.__name__] = function
    return function


# --- arrays as text ---------------------------------------------------------


def joined(array: Column) -> Column:
    return F.array_join(array, ",")


def co_items_text(array: Column) -> Column:
    return joined(F.transform(array, lambda co: F.concat_ws(":", co["item"], co["count"])))


def categories_text(array: Column) -> Column:
    return joined(
        F.transform(array, lambda c: F.concat_ws(":", c["rank"], c["category"], c["score"]))
    )


def blocks_text(array: Column) -> Column:
    return F.array_join(
        F.transform(
            array, lambda b: F.concat_ws("=", b["source_item"], co_items_text(b["co_items"]))
        ),
        ";",
    )


# --- products from a cleaned log --------------------------------------------


def scores(events: DataFrame) -> DataFrame:
    return af.user_category_scores(events)


def source_lists(events: DataFrame, n: int = si.MAX_SOURCE_ITEMS) -> DataFrame:
    return si.user_source_items_nested(si.user_source_items(si.user_item_scores(events), n))


def pairs(spark: SparkSession, sf_dir: str, log: str = "shop") -> DataFrame:
    """The pair counts of a log, by its items' stored numbers."""
    logs = {"shop": shop_path, "click": clicks_path}
    path = logs[log](spark, sf_dir)
    items = stored_once(spark, sf_dir, f"{log}-items", lambda new: jobs.item_numbers(spark, path, new))
    return jobs.counted_pairs(spark, log_files.read_normalized(spark, path, "purchase"), items)


def neighbours(counted: DataFrame, depth: int) -> DataFrame:
    return rc.top_co_items_nested(bk.co_occurrence_edges(counted), depth)


def blocks(
    events: DataFrame,
    counted: DataFrame,
    n: int = si.MAX_SOURCE_ITEMS,
    max_co_items: int = rc.MAX_CO_ITEMS,
) -> DataFrame:
    near = neighbours(counted, rc.enough_neighbours(max_co_items, n))
    return rc.recommendation_blocks(source_lists(events, n), near, max_co_items)


def profiles(events: DataFrame, counted: DataFrame) -> DataFrame:
    return pf.user_profiles(af.user_affinity(scores(events)), blocks(events, counted), RUN_TS)


def flagged(events: DataFrame) -> DataFrame:
    return ab.flag_abandoned_items(
        ab.abandoned_cart_items(events), af.top_categories(scores(events)), RUN_TS
    )


def flagged_text(flags: DataFrame) -> DataFrame:
    return flags.withColumn("user_top_categories", joined(F.col("user_top_categories")))


def loads(spark: SparkSession, sf_dir: str) -> list[dict[str, str]]:
    """The tables of the first and of the second load, by what the jobs store."""
    log = shop_log(spark, sf_dir)
    first = F.col("timestamp") < SECOND_LOAD
    return [
        jobs.table_paths(
            stored_once(
                spark, sf_dir, name, lambda new, part=part: jobs.build_all(spark, log.where(part), new, RUN_TS)
            )
        )
        for name, part in (("first-load", first), ("second-load", ~first))
    ]


def both_loads(spark: SparkSession, sf_dir: str) -> dict[str, str]:
    """The stored tables after both loads, the second into what the first left."""
    runs = list(zip(loads(spark, sf_dir), (RUN_TS, SECOND_RUN_TS)))

    def write(new: str) -> None:
        into = jobs.table_paths(new)
        for p, run_ts in runs:
            jobs.load_pairs(spark, p["pairs"], into["pair_documents"], run_ts)
            jobs.load_profiles(
                spark, p["affinity"], p["source_items"], p["neighbours"], p["pairs"], into["profiles"], run_ts
            )

    return jobs.table_paths(stored_once(spark, sf_dir, "both-loads", write))


def stored_once(
    spark: SparkSession, sf_dir: str, name: str, write: Callable[[str], object]
) -> str:
    """Path of a table written on first use and shared by the queries of a session.

    This is how the jobs work too: the log is cleaned and stored once, and each
    product reads the kinds of events it needs from there.  When a file of the
    input changes, the table is written anew.
    """
    versions = tuple(file_versions(spark, f"{sf_dir}/{t}.parquet") for t in LOG_TABLES)
    key = (spark.sparkContext.applicationId, sf_dir, name, versions)
    if key not in _STORED:
        path = scratch_path(spark, name)
        write(path)
        _STORED[key] = path
    return _STORED[key]


_STORED: dict[tuple, str] = {}


def shop_path(spark: SparkSession, sf_dir: str) -> str:
    return stored_once(spark, sf_dir, "shop-events", lambda new: jobs.store_events(shop_log(spark, sf_dir), new))


def shop(spark: SparkSession, sf_dir: str, *kinds: str) -> DataFrame:
    return log_files.read_normalized(spark, shop_path(spark, sf_dir), *kinds)


def shop_pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stored pair counts, as the later products find them."""

    path = stored_once(spark, sf_dir, "shop-pairs", lambda new: tables.write_over(pairs(spark, sf_dir), new))
    return tables.read_table(spark, path)


def clicks_path(spark: SparkSession, sf_dir: str) -> str:
    return stored_once(spark, sf_dir, "click-events", lambda new: jobs.store_events(click_log(spark, sf_dir), new))


def clicks(spark: SparkSession, sf_dir: str, *kinds: str) -> DataFrame:
    return log_files.read_normalized(spark, clicks_path(spark, sf_dir), *kinds)


def stored(spark: SparkSession, sf_dir: str) -> dict[str, str]:
    """Every job's table, as the lookups find them."""
    root = stored_once(
        spark,
        sf_dir,
        "store",
        lambda new: jobs.build_all(spark, shop_log(spark, sf_dir), new, RUN_TS),
    )
    return jobs.table_paths(root)


def requests(spark: SparkSession, sf_dir: str, paths: dict[str, str]) -> DataFrame:
    """Lookups to answer: each user with the strongest source item and with the
    first product viewed, and each supplier, who is no user, with an item."""
    strongest = tables.read_table(spark, paths["source_items"]).select(
        "user_id", F.get("source_items", F.lit(0)).alias("item_id")
    )
    viewed = (
        log_files.read_normalized(spark, paths["events"], "view")
        .groupBy("user_id")
        .agg(F.min("product_id").alias("item_id"))
    )
    strangers = table(spark, sf_dir, "supplier").select(
        F.col("s_name").alias("user_id"), F.col("s_suppkey").cast("string").alias("item_id")
    )
    return strongest.unionByName(viewed).unionByName(strangers)


def lookup_inputs(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame, DataFrame]:
    paths = stored(spark, sf_dir)
    return (
        requests(spark, sf_dir, paths),
        jobs.profile_table(spark, paths["profiles"]).read(),
        tables.read_table(spark, paths["neighbours"]),
    )


# --- the log ----------------------------------------------------------------


@query
def scan_events(spark, sf_dir):
    return log_files.typed(shop_log(spark, sf_dir)).select(*LOG_COLUMNS, "price")


@query
def scan_events_csv(spark, sf_dir):
    path = scratch_path(spark, "log-csv")
    log_files.write_events_csv(shop_log(spark, sf_dir), path)
    return log_files.typed(log_files.read_events_csv(spark, path)).select(*LOG_COLUMNS, "price")


@query
def events_norm(spark, sf_dir):
    return shop_events(spark, sf_dir)


@query
def events_norm_stored(spark, sf_dir):
    path = scratch_path(spark, "events")
    jobs.store_events(shop_log(spark, sf_dir), path)
    return log_files.read_normalized(spark, path, "cart", "purchase")


@query
def extract_category(spark, sf_dir):
    spelled = spelled_metadata(F.col("p_type"), F.col("p_partkey"))
    return table(spark, sf_dir, "part").select(
        "p_partkey", metadata_category(spelled).alias("category")
    )


@query
def purchases(spark, sf_dir):
    return ev.purchases(shop_events(spark, sf_dir))


@query
def weighted_events(spark, sf_dir):
    return ev.weighted_events(shop(spark, sf_dir), "category")


@query
def session_events(spark, sf_dir):
    return ev.session_events(shop(spark, sf_dir))


# --- products bought together -----------------------------------------------


@query
def session_baskets(spark, sf_dir):
    return bk.session_baskets(shop(spark, sf_dir, "purchase"))


@query
def basket_sizes(spark, sf_dir):
    return bk.basket_sizes(bk.session_baskets(shop(spark, sf_dir, "purchase")))


@query
def basket_pairs(spark, sf_dir):
    events = shop(spark, sf_dir, "purchase")
    return bk.basket_pairs(events, jobs.stored_giants(spark, events))


@query
def pair_counts(spark, sf_dir):
    return pairs(spark, sf_dir)


@query
def pairs_ranked(spark, sf_dir):
    return bk.pairs_ranked(pairs(spark, sf_dir))


@query
def top_pairs(spark, sf_dir):
    return bk.top_pairs(shop_pairs(spark, sf_dir))


@query
def pair_documents(spark, sf_dir):
    documents = bk.pair_documents(shop_pairs(spark, sf_dir), RUN_TS)
    return documents.withColumn("items", joined(F.col("items"))).withColumn(
        "updated_at", iso_timestamp(F.col("updated_at"))
    )


@query
def pairs_with_item(spark, sf_dir):
    """Pairs with any item that was put in a cart."""
    wanted = shop(spark, sf_dir, "cart").select(F.col("product_id").alias("item_id"))
    return bk.pairs_with_item(bk.pair_documents(shop_pairs(spark, sf_dir)), wanted)


@query
def co_occurrence_edges(spark, sf_dir):
    return bk.co_occurrence_edges(shop_pairs(spark, sf_dir))


@query
def handoff_pairs(spark, sf_dir):
    path = scratch_path(spark, "pairs")
    tables.write_new(bk.pairs_ranked(pairs(spark, sf_dir)), path)
    return tables.read_table(spark, path)


# --- affinity and source items ----------------------------------------------


@query
def user_category_scores(spark, sf_dir):
    return scores(shop(spark, sf_dir))


@query
def user_affinity(spark, sf_dir):
    return af.user_affinity(scores(shop(spark, sf_dir)))


@query
def user_affinity_nested(spark, sf_dir):
    nested = af.user_affinity_nested(af.user_affinity(scores(shop(spark, sf_dir))))
    return nested.select("user_id", categories_text(F.col("top_categories")).alias("top_categories"))


@query
def top_categories(spark, sf_dir):
    top = af.top_categories(scores(shop(spark, sf_dir)))
    return top.select("user_id", joined(F.col("user_top_categories")).alias("user_top_categories"))


@query
def profile_top_categories(spark, sf_dir):
    stored_profiles = jobs.profile_table(spark, stored(spark, sf_dir)["profiles"]).read()
    top = af.profile_top_categories(stored_profiles, af.TOP_CATEGORIES)
    return top.select("user_id", joined(F.col("user_top_categories")).alias("user_top_categories"))


@query
def user_item_scores(spark, sf_dir):
    return si.user_item_scores(shop(spark, sf_dir, "cart", "purchase"))


@query
def user_source_items(spark, sf_dir):
    return si.user_source_items(si.user_item_scores(shop(spark, sf_dir, "cart", "purchase")))


@query
def user_source_items_nested(spark, sf_dir):
    nested = source_lists(shop(spark, sf_dir, "cart", "purchase"))
    return nested.select("user_id", joined(F.col("source_items")).alias("source_items"))


@query
def scan_source_items_json(spark, sf_dir):
    path = scratch_path(spark, "source-items")
    tables.write_json(source_lists(shop(spark, sf_dir, "cart", "purchase")), path)
    listed = tables.read_source_items_json(spark, path)
    return listed.select("user_id", joined(F.col("source_items")).alias("source_items"))


@query
def scan_source_items_faults(spark, sf_dir):
    """Lists from JSON lines of two loads, the first with faults: what is kept, and
    what is rejected and why.  Suppliers stand for lines that are damaged."""
    path = scratch_path(spark, "source-lines")
    lists = source_lists(shop(spark, sf_dir, "cart", "purchase"))
    earlier = lists.select(F.to_json(F.struct("user_id", F.array(F.lit("old")).alias("source_items"))).alias("value"))
    name = F.col("s_name")
    faults = F.array(
        F.concat(F.lit("no json "), name),
        F.concat(F.lit('["'), name, F.lit('"]')),
        F.concat(F.lit('{"user_id": "", "source_items": ["'), name, F.lit('"]}')),
        F.concat(F.lit('{"user_id": "'), name, F.lit('", "source_items": "no list"}')),
    )
    damaged = table(spark, sf_dir, "supplier").select(F.explode(faults).alias("value"))
    earlier.union(damaged).write.text(f"{path}/load=1")
    lists.select(F.to_json(F.struct("user_id", "source_items")).alias("value")).write.text(f"{path}/load=2")
    kept = tables.read_source_items_json(spark, path).select(
        "user_id", joined(F.col("source_items")).alias("source_items"), F.lit(None).cast("string").alias("reason")
    )
    rejected = tables.rejected_source_items(spark, path)
    return kept.unionByName(rejected.select("user_id", F.lit(None).cast("string").alias("source_items"), "reason"))


# --- recommendations and profiles -------------------------------------------


@query
def top_co_items(spark, sf_dir):
    edges = bk.co_occurrence_edges(shop_pairs(spark, sf_dir))
    return rc.top_co_items(edges, rc.MAX_CO_ITEMS)


@query
def candidate_recommendations(spark, sf_dir):
    events = shop(spark, sf_dir, "cart", "purchase")
    edges = bk.co_occurrence_edges(shop_pairs(spark, sf_dir))
    return rc.candidate_recommendations(source_lists(events), edges)


@query
def user_recommendations(spark, sf_dir):
    return rc.user_recommendations(blocks(shop(spark, sf_dir, "cart", "purchase"), shop_pairs(spark, sf_dir)))


@query
def user_recommendations_wide(spark, sf_dir):
    """Longer lists: 30 source items, 10 co-items."""
    events = shop(spark, sf_dir, "cart", "purchase")
    return rc.user_recommendations(blocks(events, shop_pairs(spark, sf_dir), 30, 10))


@query
def user_recommendations_nested(spark, sf_dir):
    nested = rc.user_recommendations_nested(blocks(shop(spark, sf_dir, "cart", "purchase"), shop_pairs(spark, sf_dir)))
    return nested.select(
        "user_id", blocks_text(F.col("co_occurrence_recommendations")).alias("recommendations")
    )


@query
def user_profiles_flat(spark, sf_dir):
    events = shop(spark, sf_dir)
    return pf.user_profiles_flat(af.user_affinity(scores(events)), blocks(events, shop_pairs(spark, sf_dir)))


@query
def user_profiles_nested(spark, sf_dir):
    return profiles(shop(spark, sf_dir), shop_pairs(spark, sf_dir)).select(
        "user_id",
        categories_text(F.col("top_categories")).alias("top_categories"),
        blocks_text(F.col("co_occurrence_recommendations")).alias("recommendations"),
    )


@query
def profiles_exploded(spark, sf_dir):
    return pf.profiles_exploded(profiles(shop(spark, sf_dir), shop_pairs(spark, sf_dir)))


@query
def upsert_pairs(spark, sf_dir):
    merged = jobs.pair_table(spark, both_loads(spark, sf_dir)["pair_documents"]).read()
    return merged.select("pair_id", "item_a", "item_b", "count", iso_timestamp(F.col("updated_at")).alias("updated_at"))


@query
def upsert_profiles(spark, sf_dir):
    merged = jobs.profile_table(spark, both_loads(spark, sf_dir)["profiles"]).read()
    return merged.select(
        "user_id",
        categories_text(F.col("top_categories")).alias("top_categories"),
        blocks_text(F.col("co_occurrence_recommendations")).alias("recommendations"),
        iso_timestamp(F.col("updated_at")).alias("updated_at"),
    )


@query
def upsert_metrics(spark, sf_dir):
    one, two = (jobs.pair_table(spark, p["pair_documents"]).read() for p in loads(spark, sf_dir))
    return pf.upsert_metrics(one, two, "pair_id")


# --- abandoned carts --------------------------------------------------------


@query
def session_summary(spark, sf_dir):
    return ab.session_summary(shop(spark, sf_dir))


@query
def abandoned_sessions(spark, sf_dir):
    return ab.abandoned_sessions(shop(spark, sf_dir)).select("session_id", "n_cart_events")


@query
def abandoned_cart_items(spark, sf_dir):
    return ab.abandoned_cart_items(shop(spark, sf_dir, "cart", "purchase"))


@query
def flag_abandoned_items(spark, sf_dir):
    return flagged_text(flagged(shop(spark, sf_dir)))


@query
def flag_distribution(spark, sf_dir):
    return ab.flag_distribution(flagged(shop(spark, sf_dir)))


@query
def abandonment_summary(spark, sf_dir):
    events = shop(spark, sf_dir)
    return ab.abandonment_summary(
        flagged(events), scores(events).select("user_id").distinct()
    )


# --- lookups ----------------------------------------------------------------


@query
def lookup_profile(spark, sf_dir):
    asked, stored_profiles, _ = lookup_inputs(spark, sf_dir)
    return lk.lookup_profile(asked, stored_profiles).select(
        "user_id",
        "item_id",
        "found_user",
        categories_text(F.col("top_categories")).alias("top_categories"),
    )


@query
def lookup_embedded(spark, sf_dir):
    asked, stored_profiles, _ = lookup_inputs(spark, sf_dir)
    return lk.lookup_embedded(asked, stored_profiles).select(
        "user_id", "item_id", co_items_text(F.col("recommendations")).alias("recommendations")
    )


@query
def lookup_available_items(spark, sf_dir):
    events = shop(spark, sf_dir)
    available = lk.available_source_items(F.col("co_occurrence_recommendations"))
    return profiles(events, shop_pairs(spark, sf_dir)).select("user_id", joined(available).alias("available_source_items"))


@query
def global_recommendations(spark, sf_dir):
    asked, _, nearest = lookup_inputs(spark, sf_dir)
    return lk.global_recommendations(asked, nearest).select(
        "user_id", "item_id", co_items_text(F.col("global_recommendations")).alias("recommendations")
    )


@query
def lookup_batch(spark, sf_dir):
    answered = lk.lookup_batch(*lookup_inputs(spark, sf_dir))
    return answered.select(
        "user_id",
        "item_id",
        "found_user",
        "found_embedded_source_item",
        "found_item_recommendations",
        "used_global_fallback",
        categories_text(F.col("top_categories")).alias("top_categories"),
        co_items_text(F.col("recommendations")).alias("recommendations"),
        joined(F.col("available_source_items")).alias("available_source_items"),
    )


@query
def lookup_json(spark, sf_dir):
    return as_json(lk.lookup_batch(*lookup_inputs(spark, sf_dir)))


@query
def lookup_by_index(spark, sf_dir):
    """Stored profiles and pairs by each of their indexed terms: the users, all
    categories, each supplier's number as an item, and pairs found more than once."""
    paths = stored(spark, sf_dir)
    by_user = jobs.profile_table(spark, paths["profiles"])
    by_pair = jobs.pair_table(spark, paths["pair_documents"])
    items = table(spark, sf_dir, "supplier").select(F.col("s_suppkey").cast("string").alias("term"))
    of_kind = lambda kind, terms: terms.select(F.lit(kind).alias("kind"), "term")
    affinity = tables.read_table(spark, paths["affinity"])
    named = of_kind("category", affinity.select(F.col("category").alias("term")))
    for kind in ("source_item", "co_item"):
        named = named.union(of_kind(kind, items))
    users = of_kind("user_id", affinity.select(F.col("user_id").alias("term")))
    often = [("count", f"{2:019d}", "9" * 19)]
    found = [by_user.lookup(named), by_user.lookup(users), by_pair.lookup(of_kind("item", items)), by_pair.lookup_ranges(often)]
    return reduce(DataFrame.unionByName, found)


# --- the same products from the click log -----------------------------------


@query
def click_events_norm(spark, sf_dir):
    return click_events(spark, sf_dir)


@query
def click_pairs_ranked(spark, sf_dir):
    return bk.pairs_ranked(pairs(spark, sf_dir, "click"))


@query
def click_pairs_in_blocks(spark, sf_dir):
    """The same counts with baskets of more than four paired in blocks."""
    events = clicks(spark, sf_dir, "purchase")
    return bk.pair_counts(events, jobs.stored_giants(spark, events, 4), 4)


@query
def click_user_affinity(spark, sf_dir):
    return af.user_affinity(scores(clicks(spark, sf_dir)))


@query
def click_user_source_items(spark, sf_dir):
    return si.user_source_items(si.user_item_scores(clicks(spark, sf_dir, "cart", "purchase")))


@query
def click_user_recommendations(spark, sf_dir):
    events = clicks(spark, sf_dir, "cart", "purchase")
    return rc.user_recommendations(blocks(events, pairs(spark, sf_dir, "click")))


@query
def click_flag_abandoned_items(spark, sf_dir):
    return flagged_text(flagged(clicks(spark, sf_dir)))
