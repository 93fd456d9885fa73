"""Near duplicates of texts and of embeddings, and components, against brute force."""

from __future__ import annotations

import random
from collections import Counter

import numpy as np
import pytest

from basketflow.llm import minhash_join as mj
from basketflow.llm import projection_forest as forest
from basketflow.llm.components import components


def brute_components(nodes, links):
    root = {n: n for n in nodes}

    def find(n):
        while root[n] != n:
            root[n] = root[root[n]]
            n = root[n]
        return n

    for a, b in links:
        a, b = find(a), find(b)
        root[max(a, b)] = min(a, b)
    return {n: find(n) for n in nodes}


def test_components(spark):
    rng = random.Random(6)
    links = [(rng.randrange(400), rng.randrange(400)) for _ in range(250)]
    links += [(1000 + i, 1001 + i) for i in range(120)] + [(2000, 2001 + i) for i in range(200)] + [(5, 5)]
    frame = spark.createDataFrame(links, "a BIGINT, b BIGINT")
    expected = brute_components({n for link in links if link[0] != link[1] for n in link}, links)
    assert {r.node: r.component for r in components(frame).collect()} == expected
    assert components(frame.limit(0)).count() == 0


def shingles(text, size):
    words = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "").encode().split()
    if len(words) < size:
        return {tuple(words)} if words else set()
    return {tuple(words[i : i + size]) for i in range(len(words) - size + 1)}


def brute_duplicates(texts, size):
    sets = {i: shingles(t, size) for i, t in texts.items()}
    ids = sorted(texts)
    links = [
        (a, b)
        for n, a in enumerate(ids)
        for b in ids[n + 1 :]
        if sets[a] and sets[b] and 100 * len(sets[a] & sets[b]) >= 80 * len(sets[a] | sets[b])
    ]
    return {i: len(s) for i, s in sets.items()}, brute_components(ids, links), links


def edited(rng, words, share):
    return [f"new{rng.random()}" if rng.random() < share else w for w in words]


@pytest.fixture(scope="module")
def texts():
    rng = random.Random(3)
    make = lambda n: [f"w{rng.randrange(3000)}" for _ in range(n)]
    found = [make(rng.randrange(1, 120)) for _ in range(60)]
    base = make(200)
    # A large group of near copies of all degrees, and a chain in which each links the next.
    found += [edited(rng, base, rng.choice([0.002, 0.005, 0.01, 0.02, 0.03])) for _ in range(150)]
    chain = make(150)
    for _ in range(25):
        found.append(list(chain))
        chain = chain[6:] + make(6)
    found += [base[:100] + make(100) for _ in range(10)]  # a shared passage
    lines = [" ".join(words) for words in found]
    lines += [lines[70]] * 20 + [lines[5].upper(), "", " \n", None, "a b", "A  B", "a", "x y z", "é È", "é è"]
    lines += ["long " * 20_000, "word\n" * 9 + "end"]
    return dict(enumerate(lines))


@pytest.mark.parametrize("size", [4, 5])
def test_near_duplicates(spark, texts, size):
    sizes, expected, links = brute_duplicates(texts, size)
    rows = list(texts.items())
    random.Random(1).shuffle(rows)
    docs = spark.createDataFrame([(i, t, 0, "n") for i, t in rows], "doc_id BIGINT, text STRING, component BIGINT, a STRING")
    found = {r.doc_id: r for r in mj.near_duplicates(docs, words=size).repartition(1).collect()}
    assert {i: r.n_shingles for i, r in found.items()} == sizes
    assert {i: r.component_id for i, r in found.items()} == expected
    assert {i for i, r in found.items() if r.kept} == {i for i, c in expected.items() if c == i}
    assert len(links) > 500


def test_texts_that_share_a_passage_are_not_gathered(spark, monkeypatch):
    """A template in a third of each text gives entries in common, but no clusters: few texts are sent on."""
    rng = random.Random(21)
    make = lambda n: [f"w{rng.randrange(30_000)}" for _ in range(n)]
    template = make(60)
    lines = [" ".join(template + make(60)) for _ in range(1500)]
    near = [" ".join(edited(rng, lines[i].split(), 0.01)) for i in range(40)]
    sent = []
    across = mj.across
    monkeypatch.setattr(mj, "across", lambda pairs, *a: sent.append(pairs) or across(pairs, *a))
    docs = spark.createDataFrame(list(enumerate(lines + near)), "doc_id BIGINT, text STRING")
    found = {r.doc_id: r.component_id for r in mj.near_duplicates(docs).collect()}
    assert found == brute_duplicates(dict(enumerate(lines + near)), 5)[1]
    clusters = Counter(r.component for pairs in sent for r in components(pairs).collect())
    assert max(clusters.values(), default=0) <= 20


def test_large_entries_are_compared_in_blocks(spark, texts, monkeypatch):
    """The same pairs' clusters, whatever the size of a block."""
    rng = np.random.default_rng(3)
    base = rng.integers(0, 1 << 16, (4, mj.SYMBOLS)).astype("<u2")
    signatures = np.repeat(base, 12, axis=0)
    for row in signatures:
        row[rng.choice(mj.SYMBOLS, rng.integers(0, 22), replace=False)] ^= 1
    rows = [(i, 9, bytearray(s.tobytes())) for i, s in enumerate(signatures)]
    classes = spark.createDataFrame(rows, "doc BIGINT, n BIGINT, signature BINARY")
    members = spark.createDataFrame([(k, i) for k in (1, 2) for i in range(48)], "key BIGINT, doc BIGINT")
    groups = spark.createDataFrame([(i, i - i % 2) for i in range(0, 48, 3)], "node BIGINT, component BIGINT")
    component = {i: i - i % 2 for i in range(0, 48, 3)}
    links = [
        (a, b) for a in range(48) for b in range(a + 1, 48)
        if (signatures[a] != signatures[b]).sum() <= mj.DISTANCE and component.get(a, a) != component.get(b, b)
    ]
    expected = brute_components(range(48), links)
    assert len(set(expected.values())) < 48
    for size in (5, 1000):
        monkeypatch.setattr(mj, "BLOCK_TEXTS", size)
        pairs = [(r.a, r.b) for r in mj.within_entries(members, groups, classes).collect()]
        assert brute_components(range(48), pairs) == expected
        assert all((min(p), max(p)) in links for p in pairs)


def test_tables_without_duplicates_and_without_ids(spark):
    schema = "doc_id BIGINT, text STRING"
    assert mj.near_duplicates(spark.createDataFrame([], schema)).count() == 0
    rows = [(1, "a b c"), (1, "a b c"), (None, "a b c"), (None, "only here"), (2, None), (None, None)]
    found = mj.near_duplicates(spark.createDataFrame(rows, schema)).collect()
    assert sorted(map(tuple, found), key=str) == sorted(
        [(1, 1, 1, True), (1, 1, 1, True), (None, 1, 1, False), (None, 1, None, True), (2, 0, 2, True), (None, 0, None, True)],
        key=str,
    )


def test_entries_find_all_pairs_within_the_distance():
    rng = np.random.default_rng(0)
    for _ in range(200):
        one = rng.integers(0, 1 << 16, mj.SYMBOLS).astype(np.uint16)
        other = one.copy()
        changed = rng.choice(mj.SYMBOLS, mj.DISTANCE, replace=False)
        other[changed] ^= 1
        keys = mj.entry_keys(np.stack([one, other]))
        assert set(keys[0]) & set(keys[1])


def test_distance_covers_similar_texts():
    """Pairs at the least similarity are beyond the distance in far fewer than 1 of 1000 cases."""
    rng = random.Random(0)
    beyond = 0
    for _ in range(1500):
        shared = [rng.getrandbits(64) for _ in range(80)]
        a, b = (np.unique(np.array(shared + [rng.getrandbits(64) for _ in range(10)], np.uint64)) for _ in "ab")
        one, other = (np.frombuffer(mj.signature(x), "<u2") for x in (a, b))
        beyond += (one != other).sum() > mj.DISTANCE
    assert beyond <= 2


def brute_vectors(rows):
    sound = {i: np.array(v, float) for i, v in rows if v and None not in v and np.isfinite(np.array(v, float)).all() and any(v)}
    ids = sorted(sound)
    links = []
    for n, a in enumerate(ids):
        for b in ids[n + 1 :]:
            x, y = sound[a], sound[b]
            if len(x) == len(y) and x @ y / np.sqrt((x @ x) * (y @ y)) >= 0.95:
                links.append((a, b))
    degree = {i: 0 for i, _ in rows}
    for a, b in links:
        degree[a] += 1
        degree[b] += 1
    return degree, brute_components([i for i, _ in rows], links)


@pytest.mark.parametrize("leaf,block", [(1_000, 2_000), (40, 50)])
def test_embeddings(spark, monkeypatch, leaf, block):
    monkeypatch.setattr(forest, "LEAF_ROWS", leaf)
    monkeypatch.setattr(forest, "BLOCK_ROWS", block)
    rng = np.random.default_rng(4)
    unit = lambda n: rng.normal(size=(n, 64)) / 8
    vectors = [*unit(300)]
    center = unit(1)[0]
    vectors += list(center + 0.02 * rng.normal(size=(150, 64)))  # many near copies
    for i in range(0, 60):
        vectors.append(vectors[i] + 0.03 * rng.normal(size=64))
    vectors += [vectors[0] * 3, vectors[0] * -1, np.zeros(64)] + [vectors[7]] * 30
    rows = [(i, [float(x) for x in v]) for i, v in enumerate(vectors)]
    rows += [(1000, None), (1001, []), (1002, [1.0, None]), (1003, [float("nan")] * 64), (1004, [float("inf")] + [0.0] * 63)]
    rows += [(1005, [1.0, 2.0]), (1006, [2.0, 4.0]), (1007, [1.0, -2.0]), (1008, [1e-30] * 64)]
    degree, expected = brute_vectors(rows)
    frame = spark.createDataFrame([(i, v, 1) for i, v in rows], "vec_id BIGINT, embedding ARRAY<DOUBLE>, copies INT")
    found = {r.vec_id: r for r in forest.embedding_links(frame).collect()}
    links = sum(degree.values())
    assert sum(r.n_links for r in found.values()) >= 0.99 * links > 0
    assert all(found[i].n_links <= n for i, n in degree.items())  # none below the threshold
    wrong = [i for i, c in expected.items() if found[i].component_id != c]
    assert len(wrong) <= 0.01 * len(rows)
    assert all(r.kept == (r.vec_id == r.component_id) for r in found.values())


@pytest.mark.parametrize("dimension", [8, 64, 256, 768])
def test_forest_parts_alike_in_any_dimension(dimension):
    """Close pairs share a leaf, and the copies of a vector do not grow with the dimension."""
    rng = np.random.default_rng(dimension)
    sample = forest.unit(rng.normal(size=(8_000, dimension)))
    trees, leaves = [], 0
    for number in range(forest.TREES):
        # As if each vector stood for six.
        trees.append(forest.grow(sample, 6.0, number, leaves, forest.spill_of(0.95, dimension)))
        leaves = max(trees[-1].leaf) + 1
    one = sample[:2_000]
    aside = rng.normal(size=one.shape)
    aside = forest.unit(aside - (aside * one).sum(axis=1, keepdims=True) * one)
    other = 0.955 * one + np.sqrt(1 - 0.955**2) * aside
    own, others = forest.leaves_of(one, trees), forest.leaves_of(other, trees)
    assert np.mean([bool(set(a) & set(b)) for a, b in zip(own, others)]) >= 0.98
    assert np.mean([len(a) for a in own]) <= 20


def test_no_embeddings(spark):
    none = spark.createDataFrame([], "vec_id BIGINT, embedding ARRAY<FLOAT>")
    assert forest.embedding_links(none).count() == 0
    empty = spark.createDataFrame([(1, None), (None, None), (2, [0.0])], none.schema)
    assert sorted(map(tuple, forest.embedding_links(empty).collect()), key=str) == [
        (1, 0, 1, True), (2, 0, 2, True), (None, 0, None, False)
    ]
