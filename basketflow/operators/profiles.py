"""User profiles, and bringing stored tables up to date."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from basketflow.functions.ranking import by_group
from basketflow.functions.text import quoted
from basketflow.operators.affinity import user_affinity_nested
from basketflow.operators.baskets import run_timestamp
from basketflow.operators.recommendations import user_recommendations_nested

PROFILE_SCHEMA = (
    "user_id STRING, "
    "top_categories ARRAY<STRUCT<category: STRING, score: BIGINT, rank: INT>>, "
    "co_occurrence_recommendations ARRAY<STRUCT<source_item: STRING, "
    "co_items: ARRAY<STRUCT<item: STRING, count: BIGINT>>>>, "
    "updated_at TIMESTAMP"
)
_BLOCKS = "array<struct<source_item:string,co_items:array<struct<item:string,count:bigint>>>>"


def user_profiles_flat(affinity: DataFrame, blocks: DataFrame) -> DataFrame:
    """(user_id, n_categories, best_category, best_score, n_blocks, n_co_items):
    the extent of each user's profile, without its arrays."""
    categories = affinity.groupBy("user_id").agg(
        F.count(F.lit(1)).alias("n_categories"),
        F.max(F.when(F.col("rank") == 1, F.col("category"))).alias("best_category"),
        F.max("score").alias("best_score"),
    )
    recommended = blocks.groupBy("user_id").agg(
        F.count(F.lit(1)).alias("n_blocks"),
        F.sum(F.size("co_items").cast("long")).alias("n_co_items"),
    )
    return categories.join(recommended, "user_id", "left").na.fill(0, ["n_blocks", "n_co_items"])


def user_profiles(
    affinity: DataFrame, blocks: DataFrame, run_ts: datetime | None = None
) -> DataFrame:
    """One profile per user with affinity; recommendations where there are any.

    Both sides are laid out by user, so the join needs no shuffle of its own.
    """
    return (
        user_affinity_nested(by_group(affinity, "user_id"))
        .join(user_recommendations_nested(blocks), "user_id", "left")
        .select(
            "user_id",
            "top_categories",
            F.coalesce("co_occurrence_recommendations", F.array().cast(_BLOCKS)).alias(
                "co_occurrence_recommendations"
            ),
            run_timestamp(run_ts).alias("updated_at"),
        )
    )


def profiles_exploded(profiles: DataFrame) -> DataFrame:
    """Stored recommendations as rows, unusable ones left out."""
    named = lambda value: value.isNotNull() & (value != "")
    return (
        profiles.select(
            "user_id", F.posexplode("co_occurrence_recommendations").alias("block", "entry")
        )
        .select(
            "user_id",
            (F.col("block") + 1).alias("block"),
            F.col("entry.source_item").alias("source_item"),
            F.posexplode("entry.co_items").alias("position", "co"),
        )
        .where(named(F.col("source_item")) & named(F.col("co.item")))
        .select(
            "user_id",
            "block",
            "source_item",
            (F.col("position") + 1).alias("position"),
            F.col("co.item").alias("item"),
            F.col("co.count").alias("count"),
        )
    )


def _one_row_per_key(updates: DataFrame, key: str) -> DataFrame:
    """The updates; fails while running if two of them share a key, or one has none.

    Counted over the same partitioning that the join needs, so the check adds
    no shuffle and no separate pass.
    """
    copies = F.count(F.lit(1)).over(Window.partitionBy(key))
    shown = F.coalesce(F.col(key).cast("string"), F.lit("none"))
    error = F.raise_error(F.concat(F.lit(f"duplicate or missing {key} in updates: "), shown))
    wrong = (F.col("_copies") > 1) | F.col(key).isNull()
    return (
        updates.withColumn("_copies", copies)
        .where(F.when(wrong, error.cast("boolean")).otherwise(F.lit(True)))
        .drop("_copies")
    )


def _both(target: DataFrame, updates: DataFrame, key: str) -> DataFrame:
    row = F.struct(*map(quoted, target.columns))
    old = target.select(F.col(key).alias("_old_key"), row.alias("_old"))
    new = _one_row_per_key(updates, key).select(F.col(key).alias("_new_key"), row.alias("_new"))
    return old.join(new, F.col("_old_key") == F.col("_new_key"), "full")


def merge_upsert(target: DataFrame, updates: DataFrame, key: str) -> DataFrame:
    """The target after an upsert: rows of ``updates`` replace those of the same
    key, new keys are added, and the other rows stay.

    Write the result to a new path, never over the target being read.
    """
    merged = F.when(F.col("_new_key").isNotNull(), F.col("_new")).otherwise(F.col("_old"))
    return _both(target, updates, key).select(merged.alias("row")).select("row.*")


def merge_flagged(
    target: DataFrame, updates: DataFrame, key: str, by: list[str] | None = None, tasks: int | None = None
) -> DataFrame:
    """``merge_upsert`` with two flags: ``_matched`` rows were replaced, ``_inserted`` ones are new.

    Rows, however wide, are moved and sorted once: those of a key stand beside each other.
    ``by``: columns that depend on the key, the last a number below ``tasks``; rows then lie
    in the partition of that number, sorted by them and the key.  The target has one row for
    a key at most.
    """
    columns = [quoted(name) for name in target.columns]
    both = target.select(*columns, F.lit(False).alias("_new")).union(updates.select(*columns, F.lit(True).alias("_new")))
    if by:
        both = both.repartitionById(tasks, F.col(by[-1]))
    same_key = Window.partitionBy(*(by or []), key)
    news, olds = F.count_if("_new").over(same_key), F.count_if(~F.col("_new")).over(same_key)
    shown = F.coalesce(F.col(key).cast("string"), F.lit("none"))
    error = F.raise_error(F.concat(F.lit(f"duplicate or missing {key} in updates: "), shown))
    wrong = F.col("_new") & ((F.col("_news") > 1) | F.col(key).isNull())
    counted = both.withColumns({"_news": news, "_olds": olds}).where(F.when(wrong, error.cast("boolean")).otherwise(F.lit(True)))
    return counted.where(F.col("_new") | (F.col("_news") == 0)).select(
        *columns, (F.col("_new") & (F.col("_olds") > 0)).alias("_matched"), (F.col("_new") & (F.col("_olds") == 0)).alias("_inserted")
    )


def upsert_metrics(target: DataFrame, updates: DataFrame, key: str) -> DataFrame:
    """One row: how many updates matched a stored row, modified it, or were new.

    An update always carries a new time, so every match is a modification.
    """
    old, new = F.col("_old_key").isNotNull(), F.col("_new_key").isNotNull()
    return _both(target.select(key), updates.select(key), key).agg(
        F.count_if(old & new).alias("matched"),
        F.count_if(old & new).alias("modified"),
        F.count_if(~old & new).alias("inserted"),
        F.count_if(old & ~new).alias("kept"),
    )
