"""Keyed tables: versions, parts, lookups by key, and the index of terms."""

from __future__ import annotations

import random
from pathlib import Path

import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from basketflow.operators.baskets import pair_documents
from basketflow.operators.lookup import count_term, pair_terms, profile_terms
from basketflow.operators.profiles import PROFILE_SCHEMA, merge_flagged
from basketflow.plans import jobs
from basketflow.sources import keyed
from basketflow.sources.keyed import Conflict, KeyedTable

SCHEMA = "k STRING, v BIGINT, `a.b` STRING"


def rows_of(spark, values: dict):
    return spark.createDataFrame([(k, v, None) for k, v in values.items()], SCHEMA)


def content(table: KeyedTable) -> dict:
    rows = table.read().collect()
    found = {r.k: r.v for r in rows}
    assert len(found) == len(rows)
    return found


def test_upserts_and_growing_parts(spark, tmp_path):
    """Rows, figures and counts of parts over many versions; parts are doubled in time."""
    rng, table, expected = random.Random(3), KeyedTable(spark, str(tmp_path / "t"), "k", part_rows=40), {}
    parts = []
    for load in range(5):
        update = {f"k{rng.randrange(120 * (load + 1))}": rng.randrange(1000) for _ in range(100)}
        version = table.upsert(rows_of(spark, update))
        assert version.matched == len(expected.keys() & update.keys())
        assert version.inserted == len(update.keys() - expected.keys())
        expected |= update
        assert content(table) == expected
        assert version.total == len(expected) and version.number == load + 1
        assert version.total <= 80 * version.parts
        parts.append(version.parts)
    assert parts[0] < parts[-1] and parts == sorted(parts)
    again = table.upsert(rows_of(spark, update))
    assert content(table) == expected and again.inserted == 0


def test_refusals(spark, tmp_path):
    table = KeyedTable(spark, str(tmp_path / "t"), "k")
    table.upsert(rows_of(spark, {str(i): i for i in range(1000)}), parts=64)
    with pytest.raises(ValueError, match="has 64 parts, not 32"):
        table.upsert(rows_of(spark, {"1": 1}), parts=32)
    with pytest.raises(ValueError, match="kept by k, not by v"):
        KeyedTable(spark, table.path, "v").read()
    with pytest.raises(Exception, match="duplicate or missing k"):
        table.upsert(spark.createDataFrame([("1", 1, None), ("1", 2, None)], SCHEMA))
    with pytest.raises(Exception, match="duplicate or missing k"):
        table.upsert(spark.createDataFrame([(None, 1, None)], SCHEMA))
    with pytest.raises(ValueError, match="no table at"):
        KeyedTable(spark, str(tmp_path / "none"), "k").read()
    assert table.version().number == 1 and len(content(table)) == 1000
    shared = Path(spark.conf.get("spark.checkpoint.dir"))
    assert not list(shared.glob("updates-*"))


def test_empty_updates(spark, tmp_path):
    table = KeyedTable(spark, str(tmp_path / "t"), "k")
    assert table.upsert(rows_of(spark, {"a": 1}).limit(0)).total == 0
    assert content(table) == {}
    table.upsert(rows_of(spark, {"a": 1}))
    table.upsert(rows_of(spark, {"a": 1}).limit(0))
    assert content(table) == {"a": 1}


@pytest.mark.parametrize("point", ["_write_parts", "publish"])
def test_job_that_dies_leaves_the_old_version(spark, tmp_path, monkeypatch, point):
    table = KeyedTable(spark, str(tmp_path / "t"), "k")
    old = {str(i): i for i in range(500)}
    table.upsert(rows_of(spark, old), parts=16)
    done = getattr(KeyedTable, point)

    def dies(self, *args):
        if point == "_write_parts":
            done(self, *args)
        raise KeyboardInterrupt

    with monkeypatch.context() as patch:
        patch.setattr(KeyedTable, point, dies)
        with pytest.raises(KeyboardInterrupt):
            table.upsert(rows_of(spark, {str(i): -1 for i in range(0, 500, 2)}))
    assert content(table) == old and table.version().number == 1
    table.upsert(rows_of(spark, {"7": 700}))
    assert content(table) == old | {"7": 700}
    assert len(table.clear()) == 2  # what the dead job wrote, and the first version
    assert content(table) == old | {"7": 700}
    assert table.clear() == []


def test_second_writer_of_a_version_fails(spark, tmp_path, monkeypatch):
    table, other = (KeyedTable(spark, str(tmp_path / "t"), "k") for _ in range(2))
    table.upsert(rows_of(spark, {"a": 1, "b": 2}))
    done = KeyedTable._write_parts

    def overtaken(self, *args):
        done(self, *args)
        if self is table:
            other.upsert(rows_of(spark, {"a": 10}))

    monkeypatch.setattr(KeyedTable, "_write_parts", overtaken)
    with pytest.raises(Conflict, match="version 2"):
        table.upsert(rows_of(spark, {"b": 20}))
    assert content(table) == {"a": 10, "b": 2}
    assert not [p for p in (tmp_path / "t" / "versions").iterdir() if p.name.startswith("_")]


def test_parts_without_an_update_keep_their_files(spark, tmp_path):
    table = KeyedTable(spark, str(tmp_path / "t"), "k")
    first = table.upsert(rows_of(spark, {str(i): i for i in range(200)}), parts=8)
    second = table.upsert(rows_of(spark, {"7": 700}))
    assert sum(a != b for a, b in zip(first.folders, second.folders)) == 1
    assert content(table) == {str(i): i for i in range(200)} | {"7": 700}


def test_wide_parts_are_written_in_slices(spark, tmp_path, monkeypatch):
    """No task writes a whole part of many bytes; rows, figures and lookups are the same."""
    monkeypatch.setattr(keyed, "SLICE_BYTES", 4_000)
    table = KeyedTable(spark, str(tmp_path / "t"), "k")
    old = {str(i): i * i for i in range(4000)}
    table.upsert(rows_of(spark, old))
    (folder,) = table.version().folders
    files = list((tmp_path / "t" / folder).glob("*.parquet"))
    assert len(files) > 3 and max(pq.ParquetFile(f).metadata.num_rows for f in files) < 3000
    version = table.upsert(rows_of(spark, {str(i): -1 for i in range(3900, 4100)}))
    assert (version.matched, version.inserted, version.total) == (100, 100, 4100)
    assert content(table) == old | {str(i): -1 for i in range(3900, 4100)}
    asked = spark.createDataFrame([("17",), ("4099",)], "k STRING")
    assert {r.k: r.v for r in table.read_keys(asked).collect()} == {"17": 289, "4099": -1}


def test_each_slice_of_a_part_has_a_task_of_its_own(spark, tmp_path, monkeypatch):
    """No task gets two slices, of all parts or of some, so none gets much more than the others."""
    monkeypatch.setattr(keyed, "SLICE_BYTES", 1_000)
    table = KeyedTable(spark, str(tmp_path / "t"), "k")

    def files(folder: str) -> list[Path]:
        return list(Path(table.path, folder).rglob("*.parquet"))

    first = {f"k{i}": i for i in range(4_000)}
    version = table.upsert(rows_of(spark, first), parts=4)
    tasks = [int(f.name.split("-")[1]) for folder in version.folders for f in files(folder)]
    assert len(tasks) == len(set(tasks)) > 16 and len(tasks) % 4 == 0
    parts = keyed.part_of("k", 4).alias("part")
    some = {r.k: -1 for r in rows_of(spark, first).select("k", parts).where("part IN (1, 3)").collect()}
    monkeypatch.setattr(keyed, "SLICE_BYTES", 20_000)
    version = table.upsert(rows_of(spark, some))
    changed = [version.folders[p] for p in (1, 3)]
    tasks = [int(f.name.split("-")[1]) for folder in changed for f in files(folder)]
    assert len(tasks) == len(set(tasks)) > 16 and version.matched == len(some)
    assert content(table) == first | some


def test_rows_are_sorted_once_for_an_upsert(spark):
    old, new = rows_of(spark, {"a": 1, "b": 2}), rows_of(spark, {"b": 3, "c": 4})
    merged = merge_flagged(old, new, "k")
    assert {(r.k, r.v, r._matched, r._inserted) for r in merged.collect()} == {
        ("a", 1, False, False), ("b", 3, True, False), ("c", 4, False, True)
    }
    text = merged._jdf.queryExecution().executedPlan().toString()
    assert "Join" not in text and text.split("Initial Plan")[-1].count("Sort ") == 1


def test_index_entries_come_once_and_ranges_hold_them(spark, tmp_path):
    """Entries of a document with repeated terms, and the ranges of their files."""
    blocks = [{"source_item": s, "co_items": [{"item": "x", "count": 1}, {"item": s + "y", "count": 2}]} for s in "aabc"]
    rows = [(f"u{i}", [{"category": "c", "score": 1, "rank": 1}] * 2, blocks, None) for i in range(300)]
    profiles = spark.createDataFrame(rows, PROFILE_SCHEMA)
    assert profile_terms(profiles).count() == profile_terms(profiles).distinct().count() == 300 * 9
    table = jobs.profile_table(spark, str(tmp_path / "t"))
    (folder,) = table.upsert(profiles).index
    entries = table._run(folder).select("*", F.col("_metadata.file_path").alias("file"))
    place = F.struct("kind", "term")
    expected = entries.groupBy("file").agg(F.min(place).alias("first"), F.max(place).alias("last"))
    assert sorted(table._ranges(folder).collect()) == sorted(expected.collect())
    assert entries.count() == 300 * 10


def test_index_files_are_sorted_by_term_and_ranged_by_kind(spark, tmp_path):
    """Several kinds in a file, whose ends are not the file's first and last row."""
    rows = [(f"p{i:05d}", f"p{i + 1:05d}", 20_000 - i) for i in range(3_000)]
    documents = pair_documents(spark.createDataFrame(rows, "item_a STRING, item_b STRING, count BIGINT"))
    table = jobs.pair_table(spark, str(tmp_path / "pairs"))
    folder = table.upsert(documents).index[0]
    files = list((tmp_path / "pairs" / folder / "entries").glob("*.parquet"))
    for file in files:
        terms = pq.read_table(file).column("term").to_pylist()
        assert terms == sorted(terms)
    entries = table._run(folder).select("*", F.col("_metadata.file_path").alias("file"))
    place = F.struct("kind", "term")
    expected = entries.groupBy("file").agg(F.min(place).alias("first"), F.max(place).alias("last"))
    assert sorted(table._ranges(folder).collect()) == sorted(expected.collect())
    assert entries.count() == 4 * 3_000


def row_groups(files) -> int:
    return sum(pq.ParquetFile(f.removeprefix("file://").removeprefix("file:")).num_row_groups for f in files)


def test_few_requests_read_few_parts(spark, tmp_path):
    table = KeyedTable(spark, str(tmp_path / "t"), "k", part_rows=100)
    table.upsert(rows_of(spark, {f"user {i}": i for i in range(20_000)}))
    whole = table.read().inputFiles()
    asked = spark.createDataFrame([(f"user {i * 1999}",) for i in range(10)] + [(None,), ("nobody",)], "user_id STRING")
    found = table.read_keys(asked)
    assert {r.v for r in found.collect()} == {i * 1999 for i in range(10)}
    assert row_groups(found.inputFiles()) < 0.1 * row_groups(whole)
    assert "In(k" in found._jdf.queryExecution().executedPlan().toString()
    many = table.read_keys(spark.range(5000).select(F.format_string("user %d", "id").alias("user_id")))
    assert many.where("v < 5000").count() == 5000
    assert table.read_keys(asked.limit(0)).count() == 0


def entries(rows) -> set:
    return {(r.kind, r.term, r.key) for r in rows.collect()}


def test_index_of_pairs_through_updates(spark, tmp_path, monkeypatch):
    """Terms that a document lost don't find it; the index is made anew in time."""
    monkeypatch.setattr("basketflow.sources.keyed.INDEX_RUNS", 3)
    rng, counts = random.Random(9), {}
    table = jobs.pair_table(spark, str(tmp_path / "pairs"))
    folders = []
    for load in range(5):
        update = {(f"i{a}", f"i{a + rng.randrange(1, 9)}"): rng.randrange(1, 30) for a in range(load, 60, 2)}
        counts |= update
        rows = [(a, b, n) for (a, b), n in update.items()]
        documents = pair_documents(spark.createDataFrame(rows, "item_a STRING, item_b STRING, count BIGINT"))
        folders.append(len(table.upsert(documents).index))
        asked = spark.createDataFrame([("item", "i7"), ("item", "i12"), ("count", f"{5:019d}"), ("item", None)], "kind STRING, term STRING")
        every = {("item", x, f"{a}::{b}") for (a, b) in counts for x in (a, b)}
        every |= {("count", f"{n:019d}", f"{a}::{b}") for (a, b), n in counts.items()}
        wanted = {("item", "i7"), ("item", "i12"), ("count", f"{5:019d}")}
        assert entries(table.lookup(asked)) == {e for e in every if e[:2] in wanted}
        often = table.lookup_ranges([("count", f"{20:019d}", f"{25:019d}")])
        assert entries(often) == {e for e in every if e[0] == "count" and 20 <= int(e[1]) <= 25}
        monkeypatch.setattr("basketflow.sources.keyed.PUSHED", 0)
        assert entries(table.lookup(asked)) == {e for e in every if e[:2] in wanted}
        monkeypatch.setattr("basketflow.sources.keyed.PUSHED", 1000)
    assert folders == [1, 2, 3, 1, 2]


def test_lookup_by_term_reads_few_files(spark, tmp_path):
    rows = [(f"p{i:05d}", f"p{i + 1:05d}", i) for i in range(20_000)]
    documents = pair_documents(spark.createDataFrame(rows, "item_a STRING, item_b STRING, count BIGINT").repartition(8))
    coalesce = "spark.sql.adaptive.coalescePartitions.enabled"
    before = spark.conf.get(coalesce)
    spark.conf.set(coalesce, "false")
    table = jobs.pair_table(spark, str(tmp_path / "pairs"))
    folder = table.upsert(documents).index[0]
    spark.conf.set(coalesce, before)
    written = list((tmp_path / "pairs" / folder / "entries").glob("*.parquet"))
    assert len(written) == 8
    for kind, term in (("item", "p00777"), ("item", "p19999"), ("count", f"{4321:019d}")):
        asked = spark.createDataFrame([(kind, term, term)], "kind STRING, low STRING, high STRING")
        assert len(table.files_of(folder, asked)) <= 2
        found = entries(table.lookup(asked.select("kind", F.col("low").alias("term"))))
        assert {e[:2] for e in found} == {(kind, term)} and len(found) == (1 if kind == "count" else 2)


def test_terms(spark):
    rows = spark.createDataFrame([("a", "b", 3)], "item_a STRING, item_b STRING, count BIGINT")
    assert entries(pair_terms(pair_documents(rows))) == {
        ("item", "a", "a::b"), ("item", "b", "a::b"), ("count", "0000000000000000003", "a::b")
    }
    assert spark.range(1).select(count_term(F.lit(42))).first()[0] == f"{42:019d}"
    blocks = "ARRAY<STRUCT<source_item: STRING, co_items: ARRAY<STRUCT<item: STRING, count: BIGINT>>>>"
    categories = "ARRAY<STRUCT<category: STRING, score: BIGINT, rank: INT>>"
    profiles = spark.createDataFrame(
        [("u", [("Toys", 3, 1), (None, 1, 2)], [("i", [("j", 2)]), ("k", None)]), ("w", None, None)],
        f"user_id STRING, top_categories {categories}, co_occurrence_recommendations {blocks}",
    )
    found = entries(jobs.profile_table(spark, "/nowhere").terms(profiles).where("term IS NOT NULL"))
    assert found == {
        ("user_id", "u", "u"), ("category", "Toys", "u"), ("source_item", "i", "u"), ("source_item", "k", "u"),
        ("co_item", "j", "u"), ("user_id", "w", "w"),
    }
