"""Exact duplicates by stream: increments, digests that collide, odd rows."""

from __future__ import annotations

from collections import Counter, defaultdict

import pytest

from basketflow.llm.stream_dedup import StreamDedup, exact_duplicates

SCHEMA = "doc_id long, text string, `a.b` string, `Key` int"
ODD = [
    (1, "a text", None, 1),
    (2, None, "x", None),
    (3, "", None, 1),
    (3, "", None, 1),
    (None, "a text", None, 1),
    (None, "no id", None, 1),
    (None, "no id", None, 1),
    (7, "long " * 400_000, None, 1),
    (8, "long " * 400_000, None, 1),
    (9, "long " * 400_000 + "!", None, 1),
    (9, "A text", None, 1),
]


def expected(rows):
    """doc_id, text, keep_id, group_size of each row, and the kept rows of each text."""
    groups = defaultdict(list)
    for row in rows:
        groups[row[1] or ""].append(row[0])
    best = {text: max((i for i in ids if i is not None), default=None) for text, ids in groups.items()}
    return Counter((r[0], best[r[1] or ""] if best[r[1] or ""] is not None else r[0], len(groups[r[1] or ""])) for r in rows), best


def check(rows, verdicts):
    found = verdicts.collect()
    counts, best = expected(rows)
    assert Counter((r["doc_id"], r["keep_id"], r["group_size"]) for r in found) == counts
    kept = [r for r in found if r["kept"]]
    assert Counter(r["doc_id"] for r in kept) == Counter(best.values())


@pytest.mark.parametrize("digits", [64, 1])
def test_odd_rows(spark, tmp_path, digits):
    spark.createDataFrame(ODD, SCHEMA).repartition(3).write.parquet(str(tmp_path / "docs"))
    check(ODD, StreamDedup(spark, str(tmp_path / "docs"), str(tmp_path / "state"), digits).run())


@pytest.mark.parametrize(("digits", "words"), [(64, 1 << 18), (1, 1 << 18), (1, 2)])
def test_increments(spark, tmp_path, digits, words):
    """Files that come later, several steps a run, hits on contents of earlier files."""
    source, rows = str(tmp_path / "docs"), []
    for part in range(3):
        new = [(100 * part + i, f"text {i % (7 + part)}", None, 0) for i in range(40)]
        rows += new
        spark.createDataFrame(new, SCHEMA).repartition(2).write.mode("append").parquet(source)
        dedup = StreamDedup(spark, source, str(tmp_path / "state"), digits, batch_bytes=1, words=words)
        check(rows, dedup.run())
    assert dedup.log().select("batch").where("batch >= 0").distinct().count() == 6
    # Nothing new: no step is run, and the verdicts stay.
    check(rows, StreamDedup(spark, source, str(tmp_path / "state"), digits).run())
    assert dedup.log().count() == len(rows)


def test_run_goes_on_after_a_break(spark, tmp_path):
    """Logged, not yet in the state or checked: the next run makes up for it."""
    source, state = str(tmp_path / "docs 100%"), str(tmp_path / "state")
    rows = [(i, f"text {i % 3}", None, 0) for i in range(9)]
    spark.createDataFrame(rows, SCHEMA).write.parquet(source)
    StreamDedup(spark, source, state).arrive()
    dedup = StreamDedup(spark, source, state)
    dedup.settle()
    check(rows, StreamDedup(spark, source, state).run())
    assert dedup.log().count() == len(rows)


def test_empty_table(spark, tmp_path):
    spark.createDataFrame([], SCHEMA).write.parquet(str(tmp_path / "docs"))
    assert exact_duplicates(spark, str(tmp_path / "docs")).count() == 0


def test_state_holds_digest_identifier_and_locator(spark, tmp_path):
    rows = [(1, "x", None, 0), (5, "x", None, 0), (2, "y", None, 0)]
    spark.createDataFrame(rows, SCHEMA).coalesce(1).write.parquet(str(tmp_path / "docs"))
    dedup = StreamDedup(spark, str(tmp_path / "docs"), str(tmp_path / "state"))
    dedup.run()
    state = {r["size"]: r for r in dedup.state().collect()}
    assert state[2]["keep"]["doc_id"] == 5
    assert (state[2]["first"]["row"], state[2]["first"]["batch"]) == (0, 0)
    assert list((tmp_path / "state" / "settle" / "state").rglob("*.changelog")) or list(
        (tmp_path / "state" / "settle" / "state").rglob("*.zip")
    )
