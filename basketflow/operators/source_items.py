"""The items each user cares for most."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from basketflow.functions.ranking import at_least_one, best, in_order
from basketflow.operators.events import SOURCE_ITEM_WEIGHTS, weighted_events

MAX_SOURCE_ITEMS = 20


def user_item_scores(
    events: DataFrame, weights: Mapping[str, int] = SOURCE_ITEM_WEIGHTS
) -> DataFrame:
    return (
        weighted_events(events, "product_id", weights)
        .groupBy("user_id", "product_id")
        .agg(F.sum("weight").alias("score"))
    )


def user_source_items(scores: DataFrame, n: int = MAX_SOURCE_ITEMS) -> DataFrame:
    """(user_id, product_id, score, rank): each user's ``n`` strongest items."""
    at_least_one("n", n)
    return best(scores, "user_id", [F.desc("score"), F.asc("product_id")], n)


def user_source_items_nested(source_items: DataFrame) -> DataFrame:
    """(user_id, source_items): one array per user, by rank."""
    return source_items.groupBy("user_id").agg(
        in_order("rank", "product_id").alias("source_items")
    )
