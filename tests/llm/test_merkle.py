"""The Merkle manifest against a tree built plainly, whole and in parts."""

from __future__ import annotations

import random
import zlib
from collections import Counter
from hashlib import sha256

import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from basketflow.llm import merkle
from basketflow.llm.queries import op13_merkle_manifest

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, tree string, `a.b` string"


def h(text: str) -> str:
    return sha256(text.encode()).hexdigest()


def leaf(row: dict, text) -> str:
    values = [row["doc_id"], row["source"], row["lang"], row["n_chars"], text]
    return h("".join("-" if v is None else f"{len(str(v).encode())}:{v}" for v in values))


def levels(nodes: list[str]) -> list[list[str]]:
    found = [nodes]
    while len(found[-1]) > 1:
        last = found[-1]
        found.append([h("".join(last[i : i + 8])) for i in range(0, len(last), 8)])
    return found


def path(tree: list[list[str]], place: int) -> list[tuple[list[str], int]]:
    """The run and the place in it on each level below the root."""
    found = []
    for nodes in tree[:-1]:
        first = place // 8 * 8
        found.append((nodes[first : first + 8], place - first))
        place //= 8
    return found


def lowered(text: str) -> str:
    return "".join(c.lower() if "A" <= c <= "Z" else c for c in text)


def expected(rows: list[dict]) -> Counter:
    by_lang: dict = {}
    for row in rows:
        by_lang.setdefault(row["lang"], []).append((row["doc_id"] is not None, row["doc_id"] or 0, leaf(row, row["text"]), row))
    langs = sorted(by_lang, key=lambda x: (x is not None, (x or "").encode()))
    trees = []
    for lang in langs:
        by_lang[lang].sort(key=lambda x: x[:3])
        trees.append(levels([x[2] for x in by_lang[lang]]))
    top = levels([t[-1][0] for t in trees])
    found = Counter()
    for number, lang in enumerate(langs):
        for place, (_, _, own, row) in enumerate(by_lang[lang]):
            steps = path(trees[number], place) + path(top, number)
            proof = h("".join(d for run, at in steps for i, d in enumerate(run) if i != at))
            node = own
            if row["doc_id"] is not None and zlib.crc32(str(row["doc_id"]).encode()) % 3 == 0 and row["text"] is not None:
                node = leaf(row, lowered(row["text"]))
            for run, at in steps:
                node = h("".join([*run[:at], node, *run[at + 1 :]]))
            root = top[-1][0]
            found[row["doc_id"], own, trees[number][-1][0], root, proof, node, node == root] += 1
    return found


def found(df) -> Counter:
    names = ["doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified"]
    assert df.columns == names
    return Counter(tuple(r) for r in df.collect())


def test_query_equals_plain_trees(spark):
    sf_dir = "/root/testdata/sf0.001"
    rows = pq.read_table(f"{sf_dir}/documents.parquet").to_pylist()
    verdicts = found(op13_merkle_manifest(spark, sf_dir))
    assert verdicts == expected(rows)
    assert {v[-1] for v in verdicts} == {True, False}


def odd_rows() -> list[tuple]:
    rng = random.Random(5)
    rows = [
        (i if i % 11 else None, rng.choice(["Ab", "", None, "Ünï ABC", "x" * 50_000 + "Y"]), rng.choice(["de", "en", "én", None, "", "-"]),
         rng.choice(["s", None, ""]), rng.choice([None, -5, 7]), "x", None)
        for i in range(700)
    ]
    rows += [(9, "Twice", "de", "s", 1, "x", None)] * 90 + [(9, "else", "de", "s", 1, "x", None), (1, "One", "lone", "s", 1, "x", None)]
    return rows


@pytest.mark.parametrize("depth", [1, 2, 4])
def test_odd_rows_in_blocks_of_any_size(spark, depth):
    rows = odd_rows()
    names = ["doc_id", "text", "lang", "source", "n_chars"]
    docs = spark.createDataFrame(rows, SCHEMA).repartition(5)
    assert found(merkle.verify_documents(docs, depth)) == expected([dict(zip(names, r, strict=False)) for r in rows])


@pytest.mark.parametrize("n", [0, 1, 8, 9])
def test_few_rows(spark, n):
    rows = [(i, "T", "en", "s", 1, "x", None) for i in range(n)]
    names = ["doc_id", "text", "lang", "source", "n_chars"]
    verdicts = merkle.verify_documents(spark.createDataFrame(rows, SCHEMA))
    assert found(verdicts) == expected([dict(zip(names, r, strict=False)) for r in rows])


def test_a_tree_for_each_row(spark):
    """Many languages: the tree over the trees has levels of its own."""
    rows = [(i, "T", f"l{i}", "s", 1, "x", None) for i in range(100)]
    names = ["doc_id", "text", "lang", "source", "n_chars"]
    verdicts = merkle.verify_documents(spark.createDataFrame(rows, SCHEMA), depth=1)
    assert found(verdicts) == expected([dict(zip(names, r, strict=False)) for r in rows])


def test_proofs_of_some_rows_stand_alone(spark):
    docs = spark.createDataFrame([(i, f"Text {i}", "en" if i % 5 else "de", "s", i, "x", None) for i in range(600)], SCHEMA)
    proven = merkle.manifest(merkle.document_leaves(docs), ["doc_id"], depth=2)
    some = proven.rows.where(F.col("doc_id") % 50 == 7)
    needed = merkle.fetched(proven, some.join(proven.trees, "tree")).count()
    rows = merkle.prove(proven, some.withColumn("claim", F.lit(None).cast("string")), siblings=True).collect()
    numbers = {r["tree"]: r["number"] for r in proven.trees.collect()}
    assert len(rows) == 12 and all(r["verified"] for r in rows)
    apart = 0
    for r in rows:
        depth = len(r["proof"]) - 1
        own = merkle.folded(r["leaf"], r["position"], r["proof"][:depth])
        assert own == r["subroot"]
        assert merkle.folded(own, numbers[r["tree"]], r["proof"][depth:]) == proven.root
        apart += sum(map(len, r["proof"]))
    # Shared nodes are fetched once, and those the leaves give not at all.
    assert needed < apart
    changed = merkle.prove(proven, some.withColumn("claim", F.sha2("leaf", 256)))
    assert not changed.where("verified").count()


def test_missing_nodes_are_the_least(spark):
    assert merkle.missing(set(range(64)), 64) == []
    assert merkle.missing({0}, 1) == []
    assert merkle.missing({0, 1}, 9) == [(0, p) for p in range(2, 8)] + [(1, 1)]
    assert merkle.missing({8}, 9) == [(1, 0)]
    assert merkle.missing(set(range(8)), 20) == [(1, 1), (1, 2)]
