"""How much each user cares for each category."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from basketflow.functions.ranking import at_least_one, best, in_order, ranked
from basketflow.functions.text import clean
from basketflow.operators.events import AFFINITY_WEIGHTS, weighted_events, with_values

TOP_CATEGORIES = 3

# Rank of a category whose stored rank cannot be read: behind all others.
NO_RANK = 999999


def user_category_scores(
    events: DataFrame, weights: Mapping[str, int] = AFFINITY_WEIGHTS
) -> DataFrame:
    return (
        weighted_events(events, "category", weights)
        .groupBy("user_id", "category")
        .agg(F.sum("weight").alias("score"))
    )


def user_affinity(scores: DataFrame) -> DataFrame:
    """(user_id, category, score, rank), the highest score first.

    The scores are already one row per user and category, so the window holds
    at most the category vocabulary, however many events a user has.
    """
    return ranked(scores, "user_id", [F.desc("score"), F.asc("category")])


def user_affinity_nested(affinity: DataFrame) -> DataFrame:
    """One row per user: array of (category, score, rank), by rank."""
    return affinity.groupBy("user_id").agg(
        in_order("rank", "category", "score", "rank").alias("top_categories")
    )


def top_categories(scores: DataFrame, n: int = TOP_CATEGORIES) -> DataFrame:
    """(user_id, user_top_categories): names of each user's ``n`` best."""
    at_least_one("n", n)
    order = [F.desc("score"), F.asc("category")]
    return (
        best(scores, "user_id", order, n)
        .groupBy("user_id")
        .agg(in_order("rank", "category").alias("user_top_categories"))
    )


def profile_top_categories(profiles: DataFrame, n: int = TOP_CATEGORIES) -> DataFrame:
    """The same, out of stored profiles.

    Profiles may come from elsewhere: user ids are stripped, profiles without
    one and categories without name are skipped, and a rank that is no number
    goes last.
    """
    at_least_one("n", n)
    named = F.filter("top_categories", lambda c: c["category"].isNotNull())
    placed = F.array_sort(
        F.transform(
            named,
            lambda c: F.struct(
                F.coalesce(c["rank"].try_cast("int"), F.lit(NO_RANK)).alias("rank"),
                c["category"].cast("string").alias("category"),
            ),
        )
    )
    names = F.transform(F.slice(placed, 1, n), lambda c: c["category"])
    listed = F.coalesce(names, F.array().cast("array<string>")).alias("user_top_categories")
    return with_values(profiles.select(clean(F.col("user_id")).alias("user_id"), listed), "user_id")
