"""The products against brute force in Python, on small and on skewed logs."""

from __future__ import annotations

import random
from collections import Counter, defaultdict
from itertools import combinations

import pytest
from pyspark.sql import functions as F

from basketflow.operators import abandonment as ab
from basketflow.operators import affinity as af
from basketflow.operators import baskets as bk
from basketflow.operators import profiles as pf
from basketflow.operators import recommendations as rc
from basketflow.operators import source_items as si
from basketflow.plans import jobs
from basketflow.sources import tables

SCHEMA = "session_id STRING, user_id STRING, event_type STRING, product_id STRING, category STRING"


def random_log(seed: int, n: int = 3000) -> list[tuple]:
    """A third of all events falls on one session, a third on one user, a third
    on one product."""
    rng = random.Random(seed)
    pick = lambda prefix, size: f"{prefix}0" if rng.random() < 1 / 3 else f"{prefix}{rng.randrange(size)}"
    return [
        (
            pick("s", 400),
            pick("u", 80),
            rng.choice(["view", "cart", "purchase", "purchase", "refund"]),
            pick("p", 150),
            rng.choice(["A", "B", "C", "D", "E", None]),
        )
        for _ in range(n)
    ]


@pytest.fixture(scope="module", params=[1, 2])
def log(request, spark):
    rows = random_log(request.param)
    return rows, spark.createDataFrame(rows, SCHEMA).cache()


def no_giants(spark):
    return spark.createDataFrame([], "session_id STRING")


def brute_pairs(rows):
    baskets = defaultdict(set)
    for session, _, kind, product, _ in rows:
        if kind == "purchase":
            baskets[session].add(product)
    return Counter(pair for items in baskets.values() for pair in combinations(sorted(items), 2))


def brute_sources(rows, n=20):
    scores = defaultdict(Counter)
    for _, user, kind, product, _ in rows:
        if kind in ("cart", "purchase"):
            scores[user][product] += 1 if kind == "cart" else 2
    return {u: sorted(c, key=lambda p: (-c[p], p))[:n] for u, c in scores.items()}


def brute_recommendations(rows):
    edges = defaultdict(list)
    for (a, b), count in brute_pairs(rows).items():
        edges[a].append((-count, b))
        edges[b].append((-count, a))
    result = {}
    for user, items in brute_sources(rows).items():
        blocks = []
        for item in items:
            best = [(b, -c) for c, b in sorted(edges[item]) if b not in items][:5]
            if best:
                blocks.append((item, best))
        result[user] = blocks
    return result


def test_pairs(spark, log):
    rows, events = log
    counted = bk.pair_counts(events, no_giants(spark)).collect()
    assert {(r.item_a, r.item_b): r["count"] for r in counted} == brute_pairs(rows)


@pytest.mark.parametrize("block_size", [1, 3, 10, 40])
def test_giant_baskets_in_blocks(spark, log, block_size):
    rows, events = log
    giants = bk.giant_sessions(events, block_size)
    assert giants.count() > 0
    pairs = bk.basket_pairs(events, giants, block_size)
    made = Counter(tuple(r) for r in pairs.collect())
    assert set(made.values()) == {1}
    assert Counter((a, b) for _, a, b in made.elements()) == brute_pairs(rows)


def test_blocks_bound_every_group(spark):
    rows = [("s0", "u", "purchase", f"p{i}", None) for i in range(2000)] * 2
    events = spark.createDataFrame(rows, SCHEMA)
    giants = bk.giant_sessions(events, 100)
    pairs = bk.basket_pairs(events, giants, 100)
    assert pairs.count() == 2000 * 1999 // 2
    assert pairs.distinct().count() == 2000 * 1999 // 2
    # AQE may not join the groups of the blocks, so several tasks make the pairs.
    partitions = pairs.selectExpr("spark_partition_id() AS p").groupBy("p").count()
    largest = max(r["count"] for r in partitions.collect())
    assert largest < 2000 * 1999 // 2 * 0.6


def test_edges_are_symmetric(spark, log):
    _, events = log
    pairs = bk.pair_counts(events, no_giants(spark)).cache()
    edges = bk.co_occurrence_edges(pairs)
    assert edges.count() == 2 * pairs.count()
    mirrored = edges.selectExpr("item AS source_item", "source_item AS item", "count")
    assert edges.exceptAll(mirrored).count() == 0


def test_affinity(spark, log):
    rows, events = log
    weights = {"view": 1, "cart": 3, "purchase": 5}
    expected = defaultdict(Counter)
    for _, user, kind, _, category in rows:
        if category and kind in weights:
            expected[user][category] += weights[kind]
    affinity = af.user_affinity(af.user_category_scores(events)).collect()
    found = defaultdict(list)
    for r in sorted(affinity, key=lambda r: (r.user_id, r.rank)):
        found[r.user_id].append((r.category, r.score))
    assert found == {
        u: sorted(c.items(), key=lambda kv: (-kv[1], kv[0])) for u, c in expected.items()
    }


def test_source_items(spark, log):
    rows, events = log
    nested = si.user_source_items_nested(si.user_source_items(si.user_item_scores(events)))
    assert {r.user_id: r.source_items for r in nested.collect()} == brute_sources(rows)


def test_recommendations(spark, log):
    rows, events = log
    lists = si.user_source_items_nested(si.user_source_items(si.user_item_scores(events)))
    edges = bk.co_occurrence_edges(bk.pair_counts(events, no_giants(spark)))
    nearest = rc.top_co_items_nested(edges, rc.enough_neighbours())
    nested = rc.user_recommendations_nested(rc.recommendation_blocks(lists, nearest)).collect()
    found = {
        r.user_id: [
            (b.source_item, [(c.item, c["count"]) for c in b.co_items])
            for b in r.co_occurrence_recommendations
        ]
        for r in nested
    }
    assert found == {u: blocks for u, blocks in brute_recommendations(rows).items() if blocks}


def test_neighbours_too_shallow_fail(spark):
    lists = spark.createDataFrame(
        [("u", [str(i) for i in range(21)])], "user_id STRING, source_items ARRAY<STRING>"
    )
    nearest = spark.createDataFrame(
        [("1", [("99", 1)], 24), ("2", [("98", 2), ("97", 1)], 2)],
        "source_item STRING, co_items ARRAY<STRUCT<item: STRING, count: BIGINT>>, depth INT",
    )
    with pytest.raises(Exception, match="too shallow for u"):
        rc.recommendation_blocks(lists, nearest).collect()
    # An array that is shorter than its depth was not cut.
    assert rc.recommendation_blocks(lists, nearest.where("depth = 24")).count() == 1


def test_missing_entries_of_a_source_list_count_for_nothing(spark):
    lists = spark.createDataFrame(
        [("u", ["a", None, ""]), ("v", [None]), ("w", None)], "user_id STRING, source_items ARRAY<STRING>"
    )
    pairs = spark.createDataFrame([("a", "b", 3)], "item_a STRING, item_b STRING, count BIGINT")
    nearest = rc.top_co_items_nested(bk.co_occurrence_edges(pairs), rc.enough_neighbours())
    blocks = rc.recommendation_blocks(lists, nearest)
    assert [tuple(r) for r in rc.user_recommendations(blocks).collect()] == [("u", 1, "a", 1, "b", 3)]


def test_pairs_ranked_are_in_order(spark, log):
    rows, events = log
    ranked = bk.pairs_ranked(bk.pair_counts(events, no_giants(spark))).collect()
    expected = sorted(((-n, a, b) for (a, b), n in brute_pairs(rows).items()))
    assert [(-r["count"], r.item_a, r.item_b) for r in ranked] == expected


def test_next_best_neighbour_fills_up(spark):
    pairs = [("a", x, 9 - i) for i, x in enumerate("bcdefgh")]
    edges = bk.co_occurrence_edges(
        spark.createDataFrame(pairs, "item_a STRING, item_b STRING, count BIGINT")
    )
    lists = spark.createDataFrame(
        [("u", ["a", "b"]), ("v", list("abcdefgh"))], "user_id STRING, source_items ARRAY<STRING>"
    )
    nearest = rc.top_co_items_nested(edges, rc.enough_neighbours())
    flat = rc.user_recommendations(rc.recommendation_blocks(lists, nearest)).collect()
    assert [(r.user_id, r.source_item, r.item) for r in sorted(flat, key=lambda r: r.rank)] == [
        ("u", "a", x) for x in "cdefg"
    ]


def test_abandoned_items(spark, log):
    rows, events = log
    bought = {s for s, _, kind, _, _ in rows if kind == "purchase"}
    expected = {
        (u, s, p, c) for s, u, kind, p, c in rows if kind == "cart" and c and s not in bought
    }
    found = ab.abandoned_cart_items(events).collect()
    assert len(found) == len(expected) and {tuple(r) for r in found} == expected
    sessions = ab.abandoned_sessions(events).collect()
    assert {r.session_id for r in sessions} == {s for _, s, _, _ in expected}
    top = af.top_categories(af.user_category_scores(events))
    flagged = ab.flag_abandoned_items(ab.abandoned_cart_items(events), top)
    assert sum(r.n_items for r in ab.flag_distribution(flagged).collect()) == len(expected)


ABANDONMENT = [
    # session, user, type, product, category
    ("cart-only", "u1", "cart", "p1", "A"),
    ("cart-only", "u1", "cart", "p1", "A"),
    ("cart-only", "u2", "cart", "p2", "B"),
    ("rescued", "u1", "cart", "p1", "A"),
    ("rescued", "u1", "purchase", "p9", None),
    ("no-category", "u1", "cart", "p1", None),
    ("no-product", "u3", "cart", "p3", "D"),
    ("no-product", "u3", "purchase", None, "D"),
    ("two-users", "u1", "cart", "p1", "A"),
    ("two-users", "u2", "purchase", "p1", "A"),
]


def test_abandonment_rules(spark):
    items = ab.abandoned_cart_items(spark.createDataFrame(ABANDONMENT, SCHEMA))
    assert sorted(tuple(r) for r in items.collect()) == [
        ("u1", "cart-only", "p1", "A"),
        ("u2", "cart-only", "p2", "B"),
        ("u3", "no-product", "p3", "D"),
    ]
    top = spark.createDataFrame(
        [("u1", ["X", "Y", "A"]), ("u3", ["A", "B", "C"])],
        "user_id STRING, user_top_categories ARRAY<STRING>",
    )
    flags = {r.user_id: (r.flag, r.user_top_categories) for r in ab.flag_abandoned_items(items, top).collect()}
    assert flags == {
        "u1": (ab.HIGH_DISCOUNT, ["X", "Y", "A"]),
        "u2": (ab.STANDARD_REMINDER, []),
        "u3": (ab.STANDARD_REMINDER, ["A", "B", "C"]),
    }


def test_empty_targeting_keeps_schema(spark):
    events = spark.createDataFrame([], SCHEMA)
    top = spark.createDataFrame([], "user_id STRING, user_top_categories ARRAY<STRING>")
    flagged = ab.flag_abandoned_items(ab.abandoned_cart_items(events), top)
    assert flagged.count() == 0
    expected = spark.createDataFrame([], ab.TARGETING_SCHEMA).schema
    assert [(f.name, f.dataType.typeName()) for f in flagged.schema] == [
        (f.name, f.dataType.typeName()) for f in expected
    ]


def test_profiles_need_affinity(spark):
    affinity = spark.createDataFrame(
        [("u1", "A", 3, 1), ("u2", "B", 5, 1)],
        "user_id STRING, category STRING, score BIGINT, rank INT",
    )
    blocks = spark.createDataFrame(
        [("u1", 1, "a", [("b", 2)]), ("u3", 1, "a", [("b", 2)])],
        "user_id STRING, source_rank INT, source_item STRING, "
        "co_items ARRAY<STRUCT<item: STRING, count: BIGINT>>",
    )
    profiles = pf.user_profiles(affinity, blocks)
    assert {r.user_id: len(r.co_occurrence_recommendations) for r in profiles.collect()} == {
        "u1": 1,
        "u2": 0,
    }
    expected = spark.createDataFrame([], pf.PROFILE_SCHEMA).schema
    assert [f.dataType.simpleString() for f in profiles.schema] == [
        f.dataType.simpleString() for f in expected
    ]


@pytest.mark.parametrize("function", [af.top_categories, si.user_source_items, rc.top_co_items])
def test_limits_must_be_positive(spark, function):
    with pytest.raises(ValueError, match="at least 1"):
        function(spark.range(1), 0)


def test_hot_items_are_dealt_over_tasks(spark):
    """A third of all lists hold one item, which has most neighbours: no task gets far more than the others."""
    rng = random.Random(12)
    lists = [(f"u{u}", ["hot"] * (u % 3 == 0) + rng.sample([f"i{i}" for i in range(400)], 4)) for u in range(3000)]
    edges = [("hot", f"n{i}", i) for i in range(300)] + [(f"i{i}", f"i{(i + k) % 400}", k) for i in range(400) for k in range(1, 6)]
    items = spark.createDataFrame(lists, "user_id STRING, source_items ARRAY<STRING>")
    known = spark.createDataFrame(edges, "source_item STRING, item STRING, count BIGINT")
    neighbours = defaultdict(list)
    for a, b, n in edges:
        neighbours[a].append((b, n))
    expected = Counter(
        (u, place, a, b, n) for u, own in lists for place, a in enumerate(own, 1) for b, n in neighbours[a] if b not in own
    )
    conf = {"spark.sql.adaptive.enabled": "false", "spark.sql.shuffle.partitions": "32", "spark.sql.autoBroadcastJoinThreshold": "-1"}
    before = {name: spark.conf.get(name) for name in conf}
    try:
        for name, value in conf.items():
            spark.conf.set(name, value)
        found = rc.candidate_recommendations(items, known, least=100)
        sizes = sorted(r["count"] for r in found.groupBy(F.spark_partition_id()).count().collect())
        assert len(sizes) == 32 and sizes[-1] <= 3 * sizes[16]
        assert Counter(tuple(r) for r in found.collect()) == expected
        plain = rc.candidate_recommendations(items, known)  # nothing worth splitting
        sizes = sorted(r["count"] for r in plain.groupBy(F.spark_partition_id()).count().collect())
        assert sizes[-1] > 30 * sizes[16]
    finally:
        for name, value in before.items():
            spark.conf.set(name, value)
    hot = {r.source_item: (r.slices, r.blocks) for r in rc.hot_items(items.selectExpr("explode(source_items) AS source_item"), known, 100, 10).collect()}
    assert list(hot) == ["hot"] and hot["hot"][1] == 1 and hot["hot"][0] > 50
    assert rc.candidate_recommendations(items.limit(0), known).count() == 0


def test_numbered_pairs_equal_plain_ones(spark, tmp_path):
    """Odd items, giants in blocks; numbers are in the order of the items."""
    rows = random_log(31, 1500) + [("s1", "u", "purchase", p, None) for p in ("é", "a::b", "Z", "~", "0", "語", "a b")]
    events = spark.createDataFrame(rows, SCHEMA)
    tables.write_numbered(bk.purchases(events).selectExpr("product_id AS item"), str(tmp_path / "items"))
    for block in (4, 256):
        found = jobs.counted_pairs(spark, events, str(tmp_path / "items"), block).collect()
        assert {(r.item_a, r.item_b): r["count"] for r in found} == brute_pairs(rows)
    tables.write_numbered(spark.createDataFrame([("b",), ("a",), ("é",), ("a",)], "item STRING"), str(tmp_path / "n"))
    numbers = tables.read_numbered(spark, str(tmp_path / "n"))
    assert sorted((r.number, r.item) for r in numbers.collect()) == [(0, "a"), (1, "b"), (2, "é")]
    tables.write_numbered(numbers.limit(0), str(tmp_path / "none"))
    assert tables.read_numbered(spark, str(tmp_path / "none")).count() == 0


def test_neighbours_with_repeated_or_missing_names(spark):
    """Own and missing names are left out, repeated ones stay, whichever way they are found."""
    lists = spark.createDataFrame([("u", ["a", "b"])], "user_id STRING, source_items ARRAY<STRING>")
    near = {"a": [("b", 9), ("c", 5), ("d", 4)], "b": [("c", 5), (None, 4), ("c", 3), ("a", 2), ("e", 1)]}
    rows = [(item, found, 24) for item, found in near.items()]
    nearest = spark.createDataFrame(rows, "source_item STRING, co_items ARRAY<STRUCT<item: STRING, count: BIGINT>>, depth INT")
    blocks = rc.recommendation_blocks(lists, nearest, 2)
    assert {r.source_item: [tuple(co) for co in r.co_items] for r in blocks.collect()} == {
        "a": [("c", 5), ("d", 4)], "b": [("c", 5), ("c", 3)]
    }
    assert "array_except" in blocks._jdf.queryExecution().executedPlan().toString()
