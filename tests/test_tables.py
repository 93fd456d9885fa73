"""Stored tables: hand-over, upsert, lookups, JSON, and the jobs end to end."""

from __future__ import annotations

import json
import shutil
from collections import Counter, defaultdict
from datetime import datetime, timezone
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from basketflow.functions.formats import as_json, iso_timestamp
from basketflow.operators import abandonment as ab
from basketflow.operators import affinity as af
from basketflow.operators import baskets as bk
from basketflow.operators import lookup as lk
from basketflow.operators import profiles as pf
from basketflow.operators import recommendations as rc
from basketflow.operators import source_items as si
from basketflow.plans import jobs
from basketflow.plans.scratch import scratch_path
from basketflow.session import settings
from basketflow.sources import tables
from basketflow.sources.events import read_events
from basketflow.plans.queries import LOG_TABLES, REGISTRY
from tests.test_products import SCHEMA, brute_pairs, brute_sources, random_log

RUN_TS = datetime(2026, 5, 11, 21, 39, 6, 882311, tzinfo=timezone.utc)


def rows_of(df):
    return sorted((tuple(r) for r in df.collect()), key=str)


def test_write_new_refuses_to_replace(spark, tmp_path):
    path = str(tmp_path / "t")
    tables.write_new(spark.range(3), path)
    with pytest.raises(Exception, match="(?i)already exists"):
        tables.write_new(spark.range(3), path)
    tables.write_over(spark.range(5), path)
    assert tables.read_table(spark, path).count() == 5


def test_source_items_json_is_tolerant(spark, tmp_path):
    path = tmp_path / "items"
    path.mkdir()
    (path / "part-0.json").write_text(
        '{"user_id": "u1", "source_items": ["a", "b"]}\n'
        "not json\n"
        "\n"
        '{"user_id": "", "source_items": ["a"]}\n'
        '{"source_items": ["a"]}\n'
        '{"user_id": "u2", "source_items": "a"}\n'
        '{"user_id": "u4", "source_items": ["a", null, ""]}\n'
        '{"user_id": "u3"}\n'
    )
    listed = tables.read_source_items_json(spark, str(path))
    assert rows_of(listed) == [("u1", ["a", "b"]), ("u2", []), ("u3", []), ("u4", ["a"])]


def test_rejected_lines_have_reasons_and_the_last_list_counts(spark, tmp_path):
    path = tmp_path / "items"
    path.mkdir()
    (path / "a.json").write_text(
        '{"user_id": "u1", "source_items": ["old"]}\n{"user_id": "u1", "source_items": ["older", "b"]}\n[1]\nnull\n   \n'
    )
    (path / "b.json").write_text('{"user_id": "u1", "source_items": ["new"]}\n{"user_id": 5, "source_items": []}\n{"x": 1}\ncut {"\n')
    kept = tables.read_source_items_json(spark, str(path))
    assert rows_of(kept) == [("5", []), ("u1", ["new"])]
    rejected = tables.rejected_source_items(spark, str(path))
    found = Counter((Path(r.file).name, r.line, r.reason) for r in rejected.collect())
    assert found == Counter(
        [
            ("a.json", '{"user_id": "u1", "source_items": ["old"]}', "replaced"),
            ("a.json", '{"user_id": "u1", "source_items": ["older", "b"]}', "replaced"),
            ("a.json", "[1]", "no object"),
            ("a.json", "null", "no object"),
            ("b.json", '{"x": 1}', "no user"),
            ("b.json", 'cut {"', "no object"),
        ]
    )
    lines = spark.read.text(str(path)).where("trim(value) <> ''").count()
    assert kept.count() + rejected.count() == lines


def test_json_roundtrip(spark, tmp_path):
    lists = spark.createDataFrame(
        [("u1", ["a", 'q"uote']), ("u2", [])], tables.SOURCE_ITEMS_SCHEMA
    )
    path = str(tmp_path / "json")
    tables.write_json(lists, path)
    tables.write_json(lists, path)
    assert rows_of(tables.read_source_items_json(spark, path)) == rows_of(lists)


OLD = [("a", 1, "x"), ("b", 2, "x"), ("c", 3, "x")]
NEW = [("b", 20, "y"), ("d", 40, None)]


def test_merge_upsert(spark):
    old = spark.createDataFrame(OLD, "k STRING, n BIGINT, t STRING")
    new = spark.createDataFrame(NEW, "k STRING, n BIGINT, t STRING")
    merged = pf.merge_upsert(old, new, "k")
    expected = [("a", 1, "x"), ("b", 20, "y"), ("c", 3, "x"), ("d", 40, None)]
    assert rows_of(merged) == expected
    assert merged.schema.names == old.schema.names
    assert rows_of(pf.merge_upsert(merged, new, "k")) == expected
    metrics = pf.upsert_metrics(old, new, "k").first().asDict()
    assert metrics == {"matched": 1, "modified": 1, "inserted": 1, "kept": 2}


def test_upsert_refuses_duplicate_keys(spark):
    old = spark.createDataFrame(OLD, "k STRING, n BIGINT, t STRING")
    new = spark.createDataFrame([("b", 1, "y"), ("b", 2, "y")], old.schema)
    for result in (pf.merge_upsert(old, new, "k"), pf.upsert_metrics(old, new, "k")):
        with pytest.raises(Exception, match="duplicate or missing k in updates: b"):
            result.collect()
    without = spark.createDataFrame([(None, 7, "y")], old.schema)
    for result in (pf.merge_upsert(old, without, "k"), pf.upsert_metrics(old, without, "k")):
        with pytest.raises(Exception, match="duplicate or missing k in updates: none"):
            result.collect()


def test_profile_top_categories(spark):
    profiles = spark.createDataFrame(
        [
            ("u1", [("A", "3"), ("B", "1"), (None, "0"), ("C", "x"), ("D", None), ("E", "2")]),
            ("u2", [("C", "x"), ("B", None), ("A", "7")]),
            ("u3", []),
            (" u4 ", None),
            ("  ", [("A", "1")]),
            (None, [("A", "1")]),
        ],
        "user_id STRING, top_categories ARRAY<STRUCT<category: STRING, rank: STRING>>",
    )
    assert rows_of(af.profile_top_categories(profiles)) == [
        ("u1", ["B", "E", "A"]),
        ("u2", ["A", "B", "C"]),
        ("u3", []),
        ("u4", []),
    ]


@pytest.fixture(scope="module")
def stored_profiles(spark):
    blocks = [
        ("a", [("x", 1), ("y", 3), (None, 9), ("", 8), ("b", 3), ("z", None)]),
        ("a", [("second", 1)]),
        ("", [("x", 1)]),
        ("e", []),
    ]
    return spark.createDataFrame(
        [
            ("u1", [("B", 5, 2), ("A", 9, 1), ("C", 1, None)], blocks, RUN_TS),
            ("u2", None, None, None),
        ],
        pf.PROFILE_SCHEMA,
    )


@pytest.fixture(scope="module")
def nearest(spark):
    return spark.createDataFrame(
        [("a", [("g", 9)]), ("q", [("r", 4), ("a", 2), ("s", 1)])],
        "source_item STRING, co_items ARRAY<STRUCT<item: STRING, count: BIGINT>>",
    )


def test_lookup(spark, stored_profiles, nearest):
    asked = spark.createDataFrame(
        [("u1", "a"), ("u1", "q"), ("u1", "e"), ("u1", "none"), ("u2", "q"), ("u9", "q")],
        "user_id STRING, item_id STRING",
    )
    answers = {
        (r.user_id, r.item_id): r
        for r in lk.lookup_batch(asked, stored_profiles, nearest, 2).collect()
    }
    flags = lambda r: (
        r.found_user,
        r.found_embedded_source_item,
        r.found_item_recommendations,
        r.used_global_fallback,
    )
    items = lambda r: [(c.item, c["count"]) for c in r.recommendations]
    assert items(answers["u1", "a"]) == [("b", 3), ("y", 3)]
    assert flags(answers["u1", "a"]) == (True, True, True, False)
    assert items(answers["u1", "q"]) == [("r", 4), ("a", 2)]
    assert flags(answers["u1", "q"]) == (True, False, True, True)
    assert flags(answers["u1", "e"]) == (True, True, False, False)
    assert flags(answers["u1", "none"]) == (True, False, False, True)
    assert items(answers["u2", "q"]) == [("r", 4), ("a", 2)]
    assert flags(answers["u9", "q"]) == (False, False, False, False)
    assert answers["u9", "q"].top_categories == answers["u9", "q"].recommendations == []
    assert answers["u9", "q"].available_source_items == answers["u2", "q"].available_source_items == []
    assert answers["u1", "q"].available_source_items == ["a", "a", "e"]
    assert [c.category for c in answers["u1", "a"].top_categories] == ["A", "B", "C"]
    assert rows_of(lk.lookup_embedded(asked, stored_profiles, 5))[0] == (
        "u1",
        "a",
        [("b", 3), ("y", 3), ("x", 1), ("z", None)],
    )
    with pytest.raises(ValueError, match="limit must be at least 1"):
        lk.lookup_batch(asked, stored_profiles, nearest, 0)


def test_lookup_as_json(spark, stored_profiles, nearest):
    asked = spark.createDataFrame([("u1", "a"), ("u9", "a")], "user_id STRING, item_id STRING")
    texts = as_json(lk.lookup_batch(asked, stored_profiles, nearest)).collect()
    documents = {d["user_id"]: d for d in (json.loads(r.json) for r in texts)}
    assert documents["u1"]["profile_updated_at"] == "2026-05-11T21:39:06.882311+00:00"
    assert documents["u1"]["recommendations"][0] == {"item": "b", "count": 3}
    assert documents["u9"]["profile_updated_at"] is None


def test_exploded_profiles_leave_out_unusable_entries(spark, stored_profiles):
    rows = rows_of(pf.profiles_exploded(stored_profiles).select("block", "source_item", "item"))
    assert rows == [(1, "a", "b"), (1, "a", "x"), (1, "a", "y"), (1, "a", "z"), (2, "a", "second")]


def test_run_timestamp_and_iso_text(spark):
    documents = bk.pair_documents(
        spark.createDataFrame([("a", "b", 1)], "item_a STRING, item_b STRING, count BIGINT"), RUN_TS
    )
    row = documents.withColumn("iso", iso_timestamp(F.col("updated_at"))).first()
    assert (row.pair_id, row["items"]) == ("a::b", ["a", "b"])
    assert row.iso == "2026-05-11T21:39:06.882311+00:00"
    assert spark.range(1).select(bk.run_timestamp(None).alias("t")).first().t is not None


def test_sorted_table_can_be_skipped_through(spark, tmp_path):
    import pyarrow.parquet as pq

    path = tmp_path / "sorted"
    rows = spark.range(20000).selectExpr("cast(id AS STRING) AS k", "id AS v").repartition(8)
    with_partitions = spark.conf.get("spark.sql.adaptive.coalescePartitions.enabled")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    tables.write_sorted(rows, str(path), "k")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", with_partitions)
    spans = []
    for file in path.glob("*.parquet"):
        group = pq.ParquetFile(file).metadata.row_group(0).column(0).statistics
        spans.append((group.min, group.max))
    spans.sort()
    assert len(spans) > 1
    assert all(a[1] < b[0] for a, b in zip(spans, spans[1:]))
    one = tables.read_table(spark, str(path)).where("k = '777'")
    assert "EqualTo(k,777)" in one._jdf.queryExecution().executedPlan().toString()
    assert one.count() == 1


def test_bucketed_table_joins_without_shuffle(spark, tmp_path):
    rows = spark.range(1000).selectExpr("cast(id AS STRING) AS k", "id AS v")
    tables.write_bucketed(rows, "bucketed_left", str(tmp_path / "l"), "k", 4)
    tables.write_bucketed(rows, "bucketed_right", str(tmp_path / "r"), "k", 4)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    joined = spark.table("bucketed_left").join(spark.table("bucketed_right"), "k")
    plan = joined._jdf.queryExecution().executedPlan().toString()
    spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert "Exchange" not in plan
    assert joined.count() == 1000


def test_scratch_is_in_the_shared_folder(spark):
    shared = spark.conf.get("spark.checkpoint.dir")
    first, second = scratch_path(spark, "x"), scratch_path(spark, "x")
    assert first.startswith(shared) and second.startswith(shared) and first != second


def test_settings_grow_with_input():
    small, large = settings(0, 8), settings(100 * 10**12, 4000)
    assert small["spark.sql.shuffle.partitions"] == "16"
    assert 8_000 <= int(large["spark.sql.shuffle.partitions"]) <= 20_000


def test_jobs(spark, tmp_path):
    """All jobs on a raw log, twice; the second load keeps what it does not hold."""
    rows = random_log(7, 1500)
    log = spark.createDataFrame(rows, SCHEMA)
    first = jobs.build_all(spark, log, str(tmp_path / "one"), RUN_TS)
    read = lambda name: tables.read_table(spark, first[name])
    users_of = lambda path: {r.user_id for r in jobs.profile_table(spark, path).read().select("user_id").collect()}
    targeting = spark.read.json(first["targeting"])
    assert set(targeting.columns) == {
        "user_id",
        "session_id",
        "product_id",
        "abandoned_category",
        "user_top_categories",
        "flag",
        "generated_at",
    }
    figures = {r.metric: r.value for r in spark.read.json(first["figures"]).collect()}
    summary = ab.abandonment_summary(targeting, jobs.profile_table(spark, first["profiles"]).read())
    assert figures == {r.metric: r.value for r in summary.collect()}
    before = users_of(first["profiles"])
    assert len(before) == read("affinity").select("user_id").distinct().count()
    assert jobs.pair_table(spark, first["pair_documents"]).read().count() == read("pairs").count()

    asked = read("source_items").select("user_id", F.get("source_items", F.lit(0)).alias("item_id"))
    near, far = (
        jobs.lookups(
            spark, asked, first["profiles"], first["neighbours"], first["pairs"], limit
        ).where("used_global_fallback")
        for limit in (5, 100)
    )
    best = lambda df: {r.user_id: [tuple(c) for c in r.recommendations[:5]] for r in df.collect()}
    assert best(near) == best(far)

    later = [(s, "someone", t, p, c) for s, _, t, p, c in random_log(8, 300)]
    second = jobs.build_all(spark, spark.createDataFrame(later, SCHEMA), str(tmp_path / "two"), RUN_TS)
    version = jobs.load_profiles(
        spark,
        second["affinity"],
        second["source_items"],
        second["neighbours"],
        second["pairs"],
        first["profiles"],
    )
    assert users_of(first["profiles"]) == before | {"someone"}
    assert (version.number, version.inserted, version.total) == (2, 1, len(before) + 1)


def brute_lists(rows, n, co_items):
    edges = defaultdict(list)
    for (a, b), count in brute_pairs(rows).items():
        edges[a].append((-count, b))
        edges[b].append((-count, a))
    found = {}
    for user, items in brute_sources(rows, n).items():
        for item in items:
            best = [(b, -c) for c, b in sorted(edges[item]) if b not in items][:co_items]
            if best:
                found[user, item] = best
    return found


@pytest.mark.parametrize("depth", [2, 24, 60])
def test_limits_hold_through_the_jobs(spark, tmp_path, depth):
    """Lists of 30, 10 co-items and lookups of 100, whatever depth is stored."""
    rows = random_log(9, 2500)
    at = lambda name: str(tmp_path / name)
    jobs.store_events(spark.createDataFrame(rows, SCHEMA), at("events"))
    jobs.market_basket(spark, at("events"), at("pairs"))
    jobs.affinity(spark, at("events"), at("affinity"))
    jobs.source_items(spark, at("events"), at("items"), n=30)
    tables.write_json(tables.read_table(spark, at("items")), at("items-json"))
    jobs.neighbours(spark, at("pairs"), at("near"), depth)
    for items, form in (("items", "parquet"), ("items-json", "json")):
        store = at(f"profiles-{items}")
        jobs.load_profiles(
            spark, at("affinity"), at(items), at("near"), at("pairs"), store, max_co_items=10, items_format=form
        )
        profiles = jobs.profile_table(spark, store).read()
        found = {
            (r.user_id, b.source_item): [(c.item, c["count"]) for c in b.co_items]
            for r in profiles.collect()
            for b in r.co_occurrence_recommendations
        }
        expected = brute_lists(rows, 30, 10)
        known = {r.user_id for r in profiles.collect()}
        assert found == {k: v for k, v in expected.items() if k[0] in known}
    edges = defaultdict(list)
    for (a, b), count in brute_pairs(rows).items():
        edges[a].append((-count, b))
        edges[b].append((-count, a))
    user = sorted(known)[0]
    asked = spark.createDataFrame([(user, "p1"), (user, "p2")], "user_id STRING, item_id STRING")
    answers = jobs.lookups(spark, asked, at("profiles-items"), at("near"), at("pairs"), limit=100)
    for r in answers.where("used_global_fallback").collect():
        assert [(c.item, c["count"]) for c in r.recommendations] == [
            (b, -c) for c, b in sorted(edges[r.item_id])[:100]
        ]


def test_market_basket_refuses_a_path_and_clears_up(spark, tmp_path):
    events, pairs = str(tmp_path / "events"), str(tmp_path / "pairs")
    jobs.store_events(spark.createDataFrame(random_log(3, 200), SCHEMA), events)
    shared = Path(spark.conf.get("spark.checkpoint.dir"))
    giants = lambda: set(shared.glob("giants-*"))
    before = giants()
    jobs.market_basket(spark, events, pairs)
    with pytest.raises(ValueError, match="there is something at"):
        jobs.market_basket(spark, events, pairs)
    with pytest.raises(Exception):
        jobs.market_basket(spark, str(tmp_path / "nothing"), str(tmp_path / "other"))
    assert giants() == before


def test_stored_log_has_few_files_per_kind(spark, tmp_path):
    log = spark.createDataFrame(random_log(5, 4000), SCHEMA).repartition(40)
    jobs.store_events(log, str(tmp_path / "events"))
    for kind in ("view", "cart", "purchase", "other"):
        assert 1 <= len(list((tmp_path / "events" / f"kind={kind}").glob("*.parquet"))) <= 4


def test_replaced_input_gives_new_rows(spark, tmp_path):
    for name in LOG_TABLES:
        shutil.copyfile(f"/root/testdata/sf0.001/{name}.parquet", tmp_path / f"{name}.parquet")
    counted = lambda: REGISTRY["pair_counts"](spark, str(tmp_path)).count()
    first = counted()
    for name in LOG_TABLES:
        shutil.copyfile(f"/root/testdata/sf0.01/{name}.parquet", tmp_path / f"{name}.parquet")
    assert counted() > 2 * first


def test_scratch_needs_a_shared_folder():
    class Unset:
        conf = {}

    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        scratch_path(Unset, "x")


def test_defaults():
    assert (si.MAX_SOURCE_ITEMS, rc.MAX_CO_ITEMS, af.TOP_CATEGORIES, lk.DEFAULT_LIMIT) == (20, 5, 3, 5)
    assert rc.enough_neighbours() == 24


def test_read_events_requires_columns(spark, tmp_path):
    tables.write_new(spark.range(1), str(tmp_path / "log"))
    with pytest.raises(ValueError, match="no column event_type, product_id"):
        read_events(spark, str(tmp_path / "log"))
