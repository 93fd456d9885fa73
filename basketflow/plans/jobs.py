"""The six jobs, from stored table to stored table.

Each job reads what earlier jobs wrote and writes its own table, so a lost
executor costs at most the running job's tasks, and no job recomputes another.
"""

from __future__ import annotations

from collections.abc import Callable
from datetime import datetime
from functools import wraps

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from basketflow.operators.abandonment import (
    abandoned_cart_items,
    abandoned_sessions,
    flag_abandoned_items,
    targeting_figures,
)
from basketflow.operators.affinity import TOP_CATEGORIES, profile_top_categories, user_affinity, user_category_scores
from basketflow.operators.baskets import (
    BLOCK_SIZE,
    co_occurrence_edges,
    giant_sessions,
    named_pairs,
    numbered_pair_counts,
    pair_documents,
    pairs_ranked,
)
from basketflow.operators.events import normalize_events, purchases
from basketflow.operators.lookup import DEFAULT_LIMIT, lookup_batch, pair_terms, profile_terms
from basketflow.operators.profiles import user_profiles
from basketflow.operators.recommendations import (
    MAX_CO_ITEMS,
    enough_neighbours,
    longest_list,
    recommendation_blocks,
    top_co_items_nested,
)
from basketflow.operators.source_items import (
    MAX_SOURCE_ITEMS,
    user_item_scores,
    user_source_items,
    user_source_items_nested,
)
from basketflow.plans.scratch import remove, require_free, scratch_path
from basketflow.session import small_tasks
from basketflow.sources.events import read_normalized, write_normalized
from basketflow.sources.keyed import KeyedTable, Version
from basketflow.sources.tables import (
    read_numbered,
    read_source_items_json,
    read_table,
    write_json,
    write_new,
    write_numbered,
    write_over,
    write_sorted,
)


def in_small_tasks(job: Callable) -> Callable:
    """The job, its shuffles read in tasks of few bytes; a session or a log is its first argument."""

    @wraps(job)
    def run(first: SparkSession | DataFrame, *args, **kwargs):
        with small_tasks(first if isinstance(first, SparkSession) else first.sparkSession):
            return job(first, *args, **kwargs)

    return run


@in_small_tasks
def store_events(log: DataFrame, events_path: str) -> None:
    """Clean the raw log once, for all the jobs below."""
    write_normalized(normalize_events(log), events_path)


def stored_giants(
    spark: SparkSession,
    events: DataFrame,
    block_size: int = BLOCK_SIZE,
    path: str | None = None,
) -> DataFrame:
    """The giant sessions of a log, written to the shared folder and read back:
    from its files Spark knows whether the table is small enough to broadcast."""
    path = path or scratch_path(spark, "giants")
    write_new(giant_sessions(events, block_size), path)
    return read_table(spark, path)


@in_small_tasks
def item_numbers(spark: SparkSession, events_path: str, items_path: str) -> None:
    """The products bought, numbered in order, by which pairs are counted."""
    bought = purchases(read_normalized(spark, events_path, "purchase"))
    write_numbered(bought.select(F.col("product_id").alias("item")), items_path)


def counted_pairs(
    spark: SparkSession,
    purchased: DataFrame,
    items_path: str,
    block_size: int = BLOCK_SIZE,
    giants_path: str | None = None,
) -> DataFrame:
    """``pair_counts`` by the items' numbers."""
    numbers = read_numbered(spark, items_path)
    giants = stored_giants(spark, purchased, block_size, giants_path)
    return named_pairs(numbered_pair_counts(purchased, giants, numbers, block_size), numbers)


@in_small_tasks
def market_basket(
    spark: SparkSession,
    events_path: str,
    pairs_path: str,
    block_size: int = BLOCK_SIZE,
    items_path: str | None = None,
) -> None:
    """Refuses a path where there is something, before any work.

    ``items_path``: the numbers of this log's items; made for this run if not given.
    """
    require_free(spark, pairs_path)
    purchased = read_normalized(spark, events_path, "purchase")
    giants_path, own_path = scratch_path(spark, "giants"), scratch_path(spark, "items")
    try:
        if items_path is None:
            item_numbers(spark, events_path, own_path)
        counted = counted_pairs(spark, purchased, items_path or own_path, block_size, giants_path)
        write_new(pairs_ranked(counted), pairs_path)
    finally:
        remove(spark, giants_path)
        remove(spark, own_path)


@in_small_tasks
def affinity(spark: SparkSession, events_path: str, affinity_path: str) -> None:
    events = read_normalized(spark, events_path, "view", "cart", "purchase")
    write_over(user_affinity(user_category_scores(events)), affinity_path)


@in_small_tasks
def source_items(
    spark: SparkSession, events_path: str, items_path: str, n: int = MAX_SOURCE_ITEMS
) -> None:
    events = read_normalized(spark, events_path, "cart", "purchase")
    strongest = user_source_items(user_item_scores(events), n)
    write_over(user_source_items_nested(strongest), items_path)


@in_small_tasks
def neighbours(
    spark: SparkSession, pairs_path: str, neighbours_path: str, depth: int = enough_neighbours()
) -> None:
    """The best neighbours of each item, laid out for lookups by item, with their depth."""
    edges = co_occurrence_edges(read_table(spark, pairs_path))
    write_sorted(top_co_items_nested(edges, depth), neighbours_path, "source_item")


def nearest(
    spark: SparkSession,
    neighbours_path: str,
    pairs_path: str,
    depth: int,
    wanted: DataFrame | None = None,
) -> DataFrame:
    """Neighbours to at least ``depth``: the stored ones, or, if they are too
    shallow, deeper ones made from the pairs.

    ``wanted`` (item_id): items that the result may be limited to; only their
    pairs are ranked then.
    """
    stored = read_table(spark, neighbours_path)
    stored_depth = stored.agg(F.min("depth")).first()[0]
    if stored_depth is None or stored_depth >= depth:
        return stored
    edges = co_occurrence_edges(read_table(spark, pairs_path))
    if wanted is not None:
        items = wanted.select(F.col("item_id").alias("source_item")).distinct()
        edges = edges.join(items, "source_item", "left_semi")
    return top_co_items_nested(edges, depth)


def pair_table(spark: SparkSession, path: str) -> KeyedTable:
    return KeyedTable(spark, path, "pair_id", pair_terms)


def profile_table(spark: SparkSession, path: str) -> KeyedTable:
    return KeyedTable(spark, path, "user_id", profile_terms)


@in_small_tasks
def load_pairs(
    spark: SparkSession, pairs_path: str, store_path: str, run_ts: datetime | None = None
) -> Version:
    """Bring the stored pairs up to date; the new version of their table."""
    updates = pair_documents(read_table(spark, pairs_path), run_ts)
    return pair_table(spark, store_path).upsert(updates)


@in_small_tasks
def load_profiles(
    spark: SparkSession,
    affinity_path: str,
    items_path: str,
    neighbours_path: str,
    pairs_path: str,
    store_path: str,
    run_ts: datetime | None = None,
    max_co_items: int = MAX_CO_ITEMS,
    items_format: str = "parquet",
) -> Version:
    """Bring the stored profiles up to date; the new version of their table.

    Source items are a stored table, or JSON lines (``items_format`` "json"), with
    lists of any length; the neighbours are as deep as the longest list needs.
    """
    readers = {"parquet": read_table, "json": read_source_items_json}
    if items_format not in readers:
        raise ValueError(f"items_format is one of {', '.join(sorted(readers))}, not {items_format}")
    items = readers[items_format](spark, items_path)
    depth = enough_neighbours(max_co_items, longest_list(items))
    near = nearest(spark, neighbours_path, pairs_path, depth)
    blocks = recommendation_blocks(items, near, max_co_items)
    updates = user_profiles(read_table(spark, affinity_path), blocks, run_ts)
    return profile_table(spark, store_path).upsert(updates)


@in_small_tasks
def cart_abandonment(
    spark: SparkSession,
    events_path: str,
    profiles_path: str,
    targeting_path: str,
    n: int = TOP_CATEGORIES,
    run_ts: datetime | None = None,
    figures_path: str | None = None,
) -> None:
    """The targeting list, and the figures of the run if they have a path."""
    events = read_normalized(spark, events_path, "cart", "purchase")
    loaded = profile_table(spark, profiles_path)
    top = profile_top_categories(loaded.read(), n)
    flagged = flag_abandoned_items(abandoned_cart_items(events), top, run_ts)
    if figures_path is None:
        write_json(flagged, targeting_path)
        return
    # Counted as the rows are written; profiles are counted in the version of their table.
    seen = Observation()
    write_json(flagged.observe(seen, *targeting_figures()), targeting_path)
    sessions = abandoned_sessions(events).count()
    figures = [("abandoned_sessions", sessions), *seen.get.items(), ("user_profiles", loaded.version().total)]
    write_json(spark.createDataFrame(figures, "metric STRING, value BIGINT"), figures_path)


def lookups(
    spark: SparkSession,
    requests: DataFrame,
    profiles_path: str,
    neighbours_path: str,
    pairs_path: str,
    limit: int = DEFAULT_LIMIT,
) -> DataFrame:
    """Answer requests from the stored tables; a ``limit`` beyond the depth of the
    stored neighbours is served from the pairs of the items asked for.  Of the
    profiles, few requests read only the parts and row groups of their users."""
    near = nearest(spark, neighbours_path, pairs_path, limit, requests)
    asked_for = profile_table(spark, profiles_path).read_keys(requests.select("user_id"))
    return lookup_batch(requests, asked_for, near, limit)


def table_paths(root: str) -> dict[str, str]:
    """Where ``build_all`` keeps each table."""
    names = "events items pairs affinity source_items neighbours pair_documents profiles targeting figures"
    return {name: f"{root.rstrip('/')}/{name}" for name in names.split()}


def build_all(
    spark: SparkSession, log: DataFrame, root: str, run_ts: datetime | None = None
) -> dict[str, str]:
    """Run every job on a raw log, from an empty store; paths of the tables."""
    paths = table_paths(root)
    store_events(log, paths["events"])
    item_numbers(spark, paths["events"], paths["items"])
    market_basket(spark, paths["events"], paths["pairs"], items_path=paths["items"])
    affinity(spark, paths["events"], paths["affinity"])
    source_items(spark, paths["events"], paths["source_items"])
    neighbours(spark, paths["pairs"], paths["neighbours"])
    load_pairs(spark, paths["pairs"], paths["pair_documents"], run_ts=run_ts)
    load_profiles(
        spark,
        paths["affinity"],
        paths["source_items"],
        paths["neighbours"],
        paths["pairs"],
        paths["profiles"],
        run_ts=run_ts,
    )
    cart_abandonment(
        spark,
        paths["events"],
        paths["profiles"],
        paths["targeting"],
        run_ts=run_ts,
        figures_path=paths["figures"],
    )
    return paths
