"""Event logs made from the test tables, which hold none.

``shop_log`` reads order lines as the events of a shop: an order is a session,
its customer the user, a part the product.  ``click_log`` reads the ``events``
table: a user's day is a session, and the number in ``props`` the product.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from basketflow.operators.events import normalize_events


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _json(**fields: Column) -> Column:
    return F.to_json(F.struct(*[column.alias(name) for name, column in fields.items()]))


def _text(*parts: str | Column) -> Column:
    return F.concat(*[F.lit(p) if isinstance(p, str) else p for p in parts])


def written_metadata(category: Column, brand: Column, key: Column) -> Column:
    """Product metadata in the spellings a log has: all of them hold the category."""
    return (
        F.when(key % 50 == 7, _text('{""category"": ""', category, '"", ""brand"": ""', brand, '""}'))
        .when(key % 50 == 8, _text('{"brand": "', brand, '", "category": "', category, '", "cut'))
        .when(key % 50 == 9, _json(brand=brand, product_category=category))
        .otherwise(_json(category=category, brand=brand))
    )


def spelled_metadata(category: Column, key: Column) -> Column:
    """Product metadata in spellings good and bad; not all hold a category."""
    spellings = [
        _json(category=category),
        _text('{"category": "  ', category, ' "}'),
        _text('{""category"":""', category, '""}'),
        _text('"{""category"":""', category, '""}"'),
        _text('{bad "category": "', category, '"}'),
        _text('{"x":{"category":"', category, '"}}'),
        _text('{"category": "", "brand": "', category, '"}'),
        _text('{"brand": "", "category": "', category, '"}'),
        _text('{"category":"A","category":"', category, '"}'),
        _text('{"category":', key.cast("string"), "}"),
        _text('["category", "', category, '"]'),
        F.lit("null"),
        key.cast("string"),
        _text('"', category, '"'),
        _text("{'category':'", category, "'}"),
        F.lit(" "),
        F.lit(None).cast("string"),
        _text('{"category":"', category, '"} junk'),
        _text('{"brand":"B"} then "category":"', category, '"'),
        _json(category_level_3=category, product_category=F.lit("P")),
        _text('{"category": "', category, '", "brand"'),
    ]
    return F.get(F.array(*spellings), (key % len(spellings)).cast("int"))


def shop_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All nine columns of a raw log, one event for each order line."""
    lines = table(spark, sf_dir, "lineitem")
    orders = table(spark, sf_dir, "orders")
    parts = table(spark, sf_dir, "part").select(
        "p_partkey",
        written_metadata(F.col("p_type"), F.col("p_brand"), F.col("p_partkey")).alias("product_metadata"),
    )
    event_type = (
        F.when(F.col("l_returnflag") == "A", "view")
        .when(F.col("l_returnflag") == "N", " Cart ")
        .otherwise("PURCHASE\t")
    )
    return (
        lines.join(orders, lines["l_orderkey"] == orders["o_orderkey"])
        .join(parts, lines["l_partkey"] == parts["p_partkey"])
        .select(
            F.col("o_orderdate").cast("string").alias("timestamp"),
            F.col("l_orderkey").cast("string").alias("session_id"),
            F.concat(F.col("o_custkey").cast("string"), F.lit(" ")).alias("user_id"),
            event_type.alias("event_type"),
            F.col("l_partkey").cast("string").alias("product_id"),
            F.col("l_extendedprice").cast("string").alias("price"),
            F.col("l_linestatus").alias("referrer"),
            _json(priority=F.col("o_orderpriority")).alias("user_metadata"),
            "product_metadata",
        )
    )


def click_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A raw log of fewer columns: session, user, type, product, category."""
    product = F.from_json("props", "k INT")["k"]
    return table(spark, sf_dir, "events").select(
        F.concat_ws("/", F.col("user_id").cast("string"), F.date_format("ts", "yyyy-MM-dd")).alias("session_id"),
        F.col("user_id").cast("string").alias("user_id"),
        F.when(F.col("event_type") == "click", "cart").otherwise(F.col("event_type")).alias("event_type"),
        product.cast("string").alias("product_id"),
        F.floor(product / 20).cast("string").alias("category_level_1"),
    )


def shop_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return normalize_events(shop_log(spark, sf_dir))


def click_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return normalize_events(click_log(spark, sf_dir))
