"""The event log, cleaned once for all products."""

from __future__ import annotations

from collections.abc import Iterable, Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from basketflow.functions.category import event_category
from basketflow.functions.text import clean

# The columns a log must have.
REQUIRED_COLUMNS = ("session_id", "user_id", "event_type", "product_id")

# What an event counts for a user's category affinity, and for a
# user's source items.
AFFINITY_WEIGHTS = {"view": 1, "cart": 3, "purchase": 5}
SOURCE_ITEM_WEIGHTS = {"cart": 1, "purchase": 2}


def require_columns(df: DataFrame, required: Iterable[str] = REQUIRED_COLUMNS) -> DataFrame:
    missing = sorted(set(required) - set(df.columns))
    if missing:
        raise ValueError(f"the log has no column {', '.join(missing)}")
    return df


def normalize_events(log: DataFrame) -> DataFrame:
    """Clean ids, lower-case event type and category of every event.

    A narrow transformation: one row out for each row in, no shuffle.  What is
    empty or missing becomes NULL; each product drops the rows it cannot use.
    """
    require_columns(log)
    return log.select(
        clean(F.col("session_id")).alias("session_id"),
        clean(F.col("user_id")).alias("user_id"),
        F.lower(clean(F.col("event_type"))).alias("event_type"),
        clean(F.col("product_id")).alias("product_id"),
        event_category(log.columns).alias("category"),
    )


def with_values(df: DataFrame, *columns: str) -> DataFrame:
    """Rows in which none of the columns is NULL (a filter that reaches the scan)."""
    for column in columns:
        df = df.where(F.col(column).isNotNull())
    return df


def purchases(events: DataFrame) -> DataFrame:
    """(session_id, product_id) of every purchase."""
    bought = events.where(F.col("event_type") == "purchase")
    return with_values(bought, "session_id", "product_id").select("session_id", "product_id")


def event_weight(weights: Mapping[str, int]) -> Column:
    weight = F.lit(0)
    for event_type, value in weights.items():
        weight = F.when(F.col("event_type") == event_type, value).otherwise(weight)
    return weight


def weighted_events(
    events: DataFrame, key: str, weights: Mapping[str, int] = AFFINITY_WEIGHTS
) -> DataFrame:
    """(user_id, ``key``, weight) of the events that count.

    The event types are named in the filter, not derived from the weight, so
    that the filter reaches the scan.
    """
    counted = [event_type for event_type, weight in weights.items() if weight > 0]
    valid = with_values(events.where(F.col("event_type").isin(counted)), "user_id", key)
    return valid.select("user_id", key, event_weight(weights).alias("weight"))


def session_events(events: DataFrame) -> DataFrame:
    """Events with session, user, product and type; the category may be absent."""
    return with_values(events, *REQUIRED_COLUMNS).select(*REQUIRED_COLUMNS, "category")
