"""Carts left behind, and what to send their owners."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from basketflow.operators.baskets import run_timestamp
from basketflow.operators.events import session_events
from basketflow.functions.formats import iso_timestamp

HIGH_DISCOUNT = "High_Discount"
STANDARD_REMINDER = "Standard_Reminder"

TARGETING_SCHEMA = (
    "user_id STRING, session_id STRING, product_id STRING, abandoned_category STRING, "
    "user_top_categories ARRAY<STRING>, flag STRING, generated_at STRING"
)


def _is(event_type: str) -> Column:
    return F.col("event_type") == event_type


def session_summary(events: DataFrame) -> DataFrame:
    """(session_id, has_cart, has_purchase, n_cart_events) of every session.

    Flags and counts fold on the map side; the items of a session are never
    gathered in one row.
    """
    return (
        session_events(events)
        .groupBy("session_id")
        .agg(
            F.bool_or(_is("cart")).alias("has_cart"),
            F.bool_or(_is("purchase")).alias("has_purchase"),
            F.count_if(_is("cart") & F.col("category").isNotNull()).alias("n_cart_events"),
        )
    )


def abandoned_sessions(events: DataFrame) -> DataFrame:
    """Sessions with a categorised cart item and without any purchase."""
    return session_summary(events).where(
        F.col("has_cart") & ~F.col("has_purchase") & (F.col("n_cart_events") > 0)
    )


def abandoned_cart_items(events: DataFrame) -> DataFrame:
    """Distinct (user_id, session_id, product_id, abandoned_category) of the
    abandoned sessions.

    Any categorised cart row proves its session has a cart, so what remains is
    to leave out the sessions with a purchase.  As an anti join of distinct
    rows, that lets AQE split a hot session over many tasks, which a group
    holding all items of the session could not.
    """
    usable = session_events(events)
    carted = (
        usable.where(_is("cart") & F.col("category").isNotNull())
        .select("user_id", "session_id", "product_id", F.col("category").alias("abandoned_category"))
        .distinct()
    )
    bought = usable.where(_is("purchase")).select("session_id").distinct()
    return carted.join(bought, "session_id", "left_anti").select(*carted.columns)


def flag_abandoned_items(
    items: DataFrame, top_categories: DataFrame, run_ts: datetime | None = None
) -> DataFrame:
    """The targeting list: a high discount where the abandoned category is among
    the user's top categories, else a reminder.

    ``top_categories`` has one short array per user; AQE broadcasts it if it is
    small enough, else both sides are shuffled and a hot user is split.
    """
    known = F.coalesce("user_top_categories", F.array().cast("array<string>"))
    flag = F.when(F.array_contains(known, F.col("abandoned_category")), HIGH_DISCOUNT)
    return items.join(top_categories, "user_id", "left").select(
        "user_id",
        "session_id",
        "product_id",
        "abandoned_category",
        known.alias("user_top_categories"),
        flag.otherwise(STANDARD_REMINDER).alias("flag"),
        iso_timestamp(run_timestamp(run_ts)).alias("generated_at"),
    )


def flag_distribution(flagged: DataFrame) -> DataFrame:
    return flagged.groupBy("flag").agg(F.count(F.lit(1)).alias("n_items"))


def targeting_figures() -> list[Column]:
    """The counts of a targeting list, each named as in the figures of a run."""
    return [
        F.count(F.lit(1)).alias("abandoned_cart_items"),
        F.count_if(F.col("flag") == HIGH_DISCOUNT).alias(HIGH_DISCOUNT),
        F.count_if(F.col("flag") == STANDARD_REMINDER).alias(STANDARD_REMINDER),
    ]


def abandonment_summary(flagged: DataFrame, profiles: DataFrame) -> DataFrame:
    """(metric, value): the figures of a run, from its targeting list."""
    counted = flagged.agg(F.count_distinct("session_id").alias("abandoned_sessions"), *targeting_figures())
    listed = F.array(*[F.struct(F.lit(m).alias("metric"), F.col(m).alias("value")) for m in counted.columns])
    loaded = profiles.agg(F.count(F.lit(1)).alias("value"))
    return counted.select(F.inline(listed)).unionByName(
        loaded.select(F.lit("user_profiles").alias("metric"), "value")
    )
