from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from basketflow.functions import category
from basketflow.functions.category import metadata_category
from basketflow.functions.text import clean
from basketflow.operators import events as ev
from basketflow.sources import events as files

CLEANED = [
    ("a", "a"),
    (" a b ", "a b"),
    ("\t\na\r\n", "a"),
    (" a ", "a"),
    ("\u0085a\u001f", "a"),
    ("　é ", "é"),
    ("​a", "​a"),
    ("", None),
    ("  \t", None),
    (None, None),
]

METADATA = [
    ('{"category":"Toys"}', "Toys"),
    ('{"category":" T "}', "T"),
    ('  {"category":"Toys"} ', "Toys"),
    ('{""category"":""D""}', "D"),
    ('"{""category"":""D""}"', "D"),
    ('{bad "category": "Z"}', "Z"),
    ('{bad "category" : " Z "}', "Z"),
    ('{bad "category": "  "}', None),
    ('{"x":{"category":"Z"}}', None),
    ('{"category": "", "brand": "X"}', None),
    ('{"brand": "", "category": "Toys"}', "Toys"),
    ('{"category":"A","category":"B"}', "B"),
    ('{"category":5}', "5"),
    ('{"category":true}', "true"),
    ('{"category":{"a":1}}', '{"a":1}'),
    ('{"category":null,"category_level_2":"L2","product_category":"P"}', "L2"),
    ('{"category":" ","product_category":"P"}', "P"),
    ("[1]", None),
    ('[{"category":"Z"}]', None),
    ('["category": "Z"]', "Z"),
    ("null", None),
    ("5", None),
    ('"str"', None),
    ('"', None),
    ("{'category':'q'}", None),
    ("", None),
    ("  ", None),
    (None, None),
    ('{"category":"T"} junk', "T"),
    ('{"x":1} {"category":"Z"}', "Z"),
    ('{"product_category":"P"}', "P"),
    ('{"category": "cut', None),
    ('{"category": "C", "cut', "C"),
]

CSV = '''product_metadata,timestamp,user_id,session_id,event_type,price,product_id,referrer,user_metadata
"{""category"": ""Toys"", ""brand"": ""B""}",2026-01-01 00:00:00,U1,S1,purchase,9.5,I10,google,"{""age"": 3, ""c"": ""x""}"
"{""category"": """", ""brand"": ""X""}",not a time,U1,S1,Cart , ,  I11 ,google,"{""age"": 3}"
"{""brand"": """", ""category"": ""Toys""}",2026-01-01 00:00:02,U1,,purchase,,I12,google,
'''


def test_clean(spark):
    df = spark.createDataFrame(CLEANED, "given STRING, expected STRING")
    assert df.where(~clean(F.col("given")).eqNullSafe(F.col("expected"))).collect() == []


def test_metadata_category(spark):
    df = spark.createDataFrame(METADATA, "given STRING, expected STRING")
    found = df.withColumn("found", metadata_category(F.col("given")))
    assert [tuple(r) for r in found.where("NOT found <=> expected").collect()] == []
    kept = found.where("found IS NOT NULL").count()
    assert kept == sum(expected is not None for _, expected in METADATA)


def test_columns_precede_metadata(spark):
    rows = [
        ("s", "u", "view", "p", " ", "L1", '{"category":"M"}'),
        ("s", "u", "view", "p", "C", "L1", '{"category":"M"}'),
        ("s", "u", "view", "p", None, "", '{"category":"M"}'),
    ]
    log = spark.createDataFrame(
        rows,
        "session_id STRING, user_id STRING, event_type STRING, product_id STRING, "
        "category STRING, category_level_1 STRING, product_metadata STRING",
    )
    found = [r.category for r in ev.normalize_events(log).select("category").collect()]
    assert found == ["L1", "C", "M"]


def test_csv(spark, tmp_path):
    path = tmp_path / "log.csv"
    path.write_text(CSV)
    log = files.read_events_csv(spark, str(path))
    events = [tuple(r) for r in ev.normalize_events(log).collect()]
    assert events == [
        ("S1", "U1", "purchase", "I10", "Toys"),
        ("S1", "U1", "cart", "I11", None),
        (None, "U1", "purchase", "I12", "Toys"),
    ]
    typed = files.typed(log).select("timestamp", "price").collect()
    assert [r.price for r in typed] == [9.5, None, None]
    assert typed[0].timestamp is not None and typed[1].timestamp is None


def test_require_columns(spark):
    log = spark.createDataFrame([("s", "p")], "session_id STRING, product_id STRING")
    with pytest.raises(ValueError, match="no column event_type, user_id"):
        ev.normalize_events(log)


def test_filters_of_each_product(spark):
    rows = [
        ("s", "u", "purchase", "p", None),
        (None, "u", "purchase", "p", "c"),
        ("s", None, "cart", "p", "c"),
        ("s", "u", "cart", None, "c"),
        ("s", "u", "click", "p", "c"),
        ("s", "u", None, "p", "c"),
    ]
    events = spark.createDataFrame(
        rows,
        "session_id STRING, user_id STRING, event_type STRING, product_id STRING, category STRING",
    )
    assert ev.purchases(events).collect() == [("s", "p")]
    by_category = ev.weighted_events(events, "category").collect()
    assert sorted(by_category) == [("u", "c", 3), ("u", "c", 5)]
    by_item = ev.weighted_events(events, "product_id", ev.SOURCE_ITEM_WEIGHTS).collect()
    assert sorted(by_item) == [("u", "p", 2), ("u", "p", 2)]
    assert ev.session_events(events).count() == 2


def test_stored_log_is_read_by_kind(spark, tmp_path):
    rows = [("s", "u", t, "p", "c") for t in ("view", "cart", "purchase", "refund", None)]
    events = spark.createDataFrame(
        rows,
        "session_id STRING, user_id STRING, event_type STRING, product_id STRING, category STRING",
    )
    path = str(tmp_path / "events")
    files.write_normalized(events, path)
    everything = files.read_normalized(spark, path)
    assert sorted(everything.collect(), key=str) == sorted(events.collect(), key=str)
    bought = files.read_normalized(spark, path, "purchase")
    assert [r.event_type for r in bought.collect()] == ["purchase"]
    plan = bought._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(kind" in plan


def test_a_joined_log_is_stored_without_another_shuffle(spark, tmp_path):
    """Its rows were moved by the join already."""
    spark.range(1_000).selectExpr("id", "cast(id AS string) AS user_id").write.parquet(str(tmp_path / "users"))
    users = spark.read.parquet(str(tmp_path / "users")).hint("merge")
    log = spark.range(1_000).join(users, "id").selectExpr(
        "cast(id AS string) AS session_id", "user_id", "if(id % 2 = 0, 'cart', 'purchase') AS event_type",
        "cast(id % 7 AS string) AS product_id", "'c' AS category",
    )
    large = files._joined(log.crossJoin(spark.range(1 << 40).limit(1).select()).crossJoin(spark.range(1 << 50).where("id < 1").select()))
    for plan in (files._joined(log), large):
        assert "Rebalance" not in plan._jdf.queryExecution().optimizedPlan().toString()
    files.write_normalized(log, str(tmp_path / "events"))
    assert files.read_normalized(spark, str(tmp_path / "events"), "cart").count() == 500


def test_plain_metadata_give_the_same_without_a_parser(spark, monkeypatch):
    texts = [
        '{"category":"Toys","brand":"B"}', '{"category": "Toys", "brand": ""}', '{"category":"a b"}', '{"category":" a"}',
        '{"category":"a "}', '{"category":"A","category":"B"}', '{"category":"A","category_level_1":"B"}', '{"category":""}',
        '{"category":"A","brand":5}', '{"category":"A\\n"}', '{"category":"A","brand":"x\\"y"}', '{"category":"A"} x', '{"category":"A",}',
        '{"category":"A"}\n', '{"category":"\u00e9"}', '{"category":"A","":"x"}', "{}", "", None,
    ]
    rows = spark.createDataFrame([(t,) for t in texts], "m STRING")
    plain = F.regexp_extract("m", category._CATEGORY_FIRST, 1)
    found = rows.select("m", metadata_category(F.col("m")).alias("c"), plain.alias("plain")).collect()
    assert [r.plain for r in found[:3]] == ["Toys", "Toys", "a b"] and sum(bool(r.plain) for r in found) == 4
    monkeypatch.setattr(category, "_CATEGORY_FIRST", r"\A(x)\zx")
    assert [r.c for r in rows.select(metadata_category(F.col("m")).alias("c")).collect()] == [r.c for r in found]
