"""Near-duplicate embeddings by a forest of random-projection trees.

Each tree splits the unit vectors by random directions, recursively, at a quantile
drawn near the median where few vectors lie.  Vectors near a split go to both sides, so
a close pair is parted only if the split falls between the two and both are further away
from it.  How near follows from the least cosine of a link and the dimension, as what
such a pair differs by along a direction does, so trees part alike in any dimension.  All pairs within a leaf are compared, in double
precision, and several trees make up for what one of them parts.

The splits are fitted on a bounded sample; every vector is then put into leaves, in
a narrow pass.  A leaf is compared in one task if it is small, else in blocks of
bounded size, block against block over all tasks, so that a group of near copies of
any size is split.  No pairs are emitted: a leaf returns, for each vector, how many
others it is linked with (a pair counts in the first leaf that it shares, which both
vectors' lists of leaves tell) and the smallest vector of its part of the leaf, which
is all that the components need.  Equal vectors are one class, compared once.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from basketflow.llm.common import stored
from basketflow.llm.components import components

COSINE = 0.95
TREES = 4
#: How near a split vectors go to both sides, as a share of what a pair at the least
#: cosine differs by along a direction.
SPILL = 0.76
#: Vectors of a leaf that is not split further; of a block of a larger leaf.
LEAF_ROWS, BLOCK_ROWS = 1_000, 2_000
#: Vectors on which the splits are fitted, about, and fewest that a split is fitted on.
SAMPLE_ROWS, FEWEST = 50_000, 32
DEPTH = 40


@dataclass
class Tree:
    directions: np.ndarray  # one column per level
    threshold: list[float]  # by node
    children: list[tuple[int, int] | None]
    level: list[int]
    leaf: list[int]  # number among all leaves of the forest, or -1
    spill: float


def unit(vectors: np.ndarray) -> np.ndarray:
    return vectors / np.linalg.norm(vectors, axis=1, keepdims=True)


def spill_of(cosine: float, dimension: int) -> float:
    """Unit vectors at ``cosine`` are sqrt(2 (1 - cosine)) apart, and differ along a random
    direction by that over sqrt(dimension) (the standard deviation)."""
    return SPILL * float(np.sqrt(2 * max(1 - cosine, 0) / max(dimension, 1)))


def grow(sample: np.ndarray, scale: float, seed: int, first_leaf: int, spill: float) -> Tree:
    """A tree over the unit vectors ``sample``, each of which stands for ``scale`` ones."""
    rng = np.random.default_rng(seed)
    directions = rng.normal(size=(sample.shape[1], DEPTH))
    directions /= np.linalg.norm(directions, axis=0)
    places = sample @ directions
    tree = Tree(directions, [], [], [], [], spill)
    open_nodes = [(np.arange(len(sample)), 0)]
    leaves = first_leaf
    at = 0
    while at < len(open_nodes):
        rows, level = open_nodes[at]
        at += 1
        split = None
        if len(rows) * scale > LEAF_ROWS and len(rows) >= FEWEST:
            # A direction that would not part the vectors is left for the next one.
            while split is None and level < DEPTH:
                own = places[rows, level]
                cuts = np.quantile(own, rng.uniform(0.3, 0.7, 8))
                spilled = (np.abs(own[:, None] - cuts) <= spill).sum(axis=0)
                cut = cuts[spilled.argmin()]
                left, right = rows[own <= cut + spill], rows[own >= cut - spill]
                if max(len(left), len(right)) <= 0.9 * len(rows):
                    split = float(cut), left, right
                else:
                    level += 1
        tree.level.append(min(level, DEPTH - 1))
        if split is None:
            tree.threshold.append(0.0)
            tree.children.append(None)
            tree.leaf.append(leaves)
            leaves += 1
            continue
        tree.threshold.append(split[0])
        tree.children.append((len(open_nodes), len(open_nodes) + 1))
        tree.leaf.append(-1)
        open_nodes += [(split[1], level + 1), (split[2], level + 1)]
    return tree


def leaves_of(vectors: np.ndarray, forest: list[Tree]) -> list[np.ndarray]:
    """The numbers of the leaves of each unit vector, ascending."""
    rows_found, leaves_found = [np.empty(0, np.int64)], [np.empty(0, np.int64)]
    for tree in forest:
        places = vectors @ tree.directions
        stack = [(0, np.arange(len(vectors)))]
        while stack:
            node, rows = stack.pop()
            if not len(rows):
                continue
            if tree.children[node] is None:
                rows_found.append(rows)
                leaves_found.append(np.full(len(rows), tree.leaf[node]))
                continue
            own, cut = places[rows, tree.level[node]], tree.threshold[node]
            stack.append((tree.children[node][0], rows[own <= cut + tree.spill]))
            stack.append((tree.children[node][1], rows[own >= cut - tree.spill]))
    rows, leaves = np.concatenate(rows_found), np.concatenate(leaves_found)
    order = np.lexsort((leaves, rows))
    return np.split(leaves[order], np.searchsorted(rows[order], np.arange(1, len(vectors))))


def matrix(column: pa.ChunkedArray | pa.Array) -> np.ndarray:
    """Lists of one length as a matrix in double precision."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    return column.flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(len(column), -1)


def keyed(vectors: DataFrame) -> DataFrame:
    """``vec_id, vector, digest``; the last two are null for vectors that link with nothing."""

    def digests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found, kept = [], []
            for values in batch.column("vector").to_pylist():
                array = np.array([np.nan if v is None else v for v in values or []], np.float64) + 0.0
                # Finite in its length as well, and not zero.
                length = float(np.sqrt((array * array).sum())) if len(array) else 0.0
                sound = np.isfinite(length) and length > 0
                kept.append(array if sound else None)
                found.append(hashlib.blake2b(array.tobytes(), digest_size=16).digest() if sound else None)
            columns = [pa.array(kept, batch.schema.field("vector").type), pa.array(found, pa.binary())]
            yield pa.RecordBatch.from_arrays(
                [batch.column("vec_id"), *columns], names=["vec_id", "vector", "digest"]
            )

    kind = vectors.schema["vector"].dataType.elementType.simpleString()
    return vectors.mapInArrow(digests, f"vec_id long, vector array<{kind}>, digest binary")


def fit(classes: DataFrame, dimension: int, cosine: float) -> list[Tree]:
    """The forest for vectors of one dimension, fitted on a sample of their digests."""
    own = classes.where(F.size("vector") == dimension)
    total = own.count()
    share = min(1.0, SAMPLE_ROWS / max(total, 1))
    bucket = F.pmod(F.xxhash64("digest"), F.lit(1 << 20))
    sample = own.where(bucket < int(share * (1 << 20))).select("vector").toArrow()
    if not len(sample):
        sample = own.select("vector").limit(FEWEST).toArrow()
    vectors = unit(matrix(sample.column("vector")))
    forest: list[Tree] = []
    leaves = 0
    for number in range(TREES):
        tree = grow(vectors, total / len(vectors), seed=7 + number, first_leaf=leaves, spill=spill_of(cosine, dimension))
        leaves = max(tree.leaf) + 1
        forest.append(tree)
    return forest


def compared(table: pa.Table, cosine: float) -> pa.Table:
    """What the vectors of a leaf (or of two of its blocks) are linked with."""
    docs = table.column("doc").to_numpy()
    order = np.argsort(docs, kind="stable")
    table, docs = table.take(order), docs[order]
    weights = table.column("copies").to_numpy()
    block = table.column("block").to_numpy()
    leaf = table.column("leaf")[0].as_py()
    vectors = unit(matrix(table.column("vector")))
    close = vectors @ vectors.T >= cosine
    np.fill_diagonal(close, False)
    if table.column("i")[0].as_py() != table.column("j")[0].as_py():
        close &= block[:, None] != block[None, :]
    some = np.flatnonzero(close.any(axis=1))
    close, docs, weights = close[np.ix_(some, some)], docs[some], weights[some]
    # Pairs that share an earlier leaf are counted there.
    earlier = [[x for x in own if x < leaf] for own in table.column("leaves").take(pa.array(some)).to_pylist()]
    number = {x: i for i, x in enumerate(sorted({x for own in earlier for x in own}))}
    shares = np.zeros((len(some), len(number) + 1), np.float32)
    for row, own in enumerate(earlier):
        shares[row, [number[x] for x in own]] = 1
    counted = close & (shares @ shares.T == 0)
    # Rows are in the order of their ids, so the smallest place is the smallest id.
    root = np.arange(len(some))
    while len(some):
        least = np.minimum(root, np.where(close, root[None, :], len(some)).min(axis=1))
        least = least[least]
        if (least == root).all():
            break
        root = least
    return pa.table(
        {"doc": docs, "n": (counted * weights[None, :]).sum(axis=1).astype(np.int64), "root": docs[root]},
        schema=pa.schema([("doc", pa.int64()), ("n", pa.int64()), ("root", pa.int64())]),
    )


def embedding_links(vectors: DataFrame, cosine: float = COSINE, column: str = "embedding") -> DataFrame:
    """``vec_id, n_links, component_id, kept``, one row per row of ``vectors``.

    ``n_links`` counts the other rows that were found at ``cosine`` or more, equal
    ones included (a repeated row counts as another vector), ``component_id`` is the smallest ``vec_id``
    reachable, ``kept`` whether it is the row's own.  Vectors that are null, empty,
    zero, or hold null or non-finite components, link with nothing.  Vectors of
    different dimensions do not link; the forest is fitted for the most frequent
    one, others form a leaf per dimension.  A null ``vec_id`` takes part only as a
    copy: its row takes over the component of an equal vector, and is not kept.
    Columns other than ``vec_id`` and the vector are not read.
    """
    spark = vectors.sparkSession
    kind = vectors.schema[column].dataType.elementType.simpleString()
    kind = kind if kind in ("float", "double") else "double"
    rows = vectors.select(
        F.col("vec_id").cast("long").alias("vec_id"), F.col(column).cast(f"array<{kind}>").alias("vector")
    )
    keys = stored(keyed(rows), "vectors")
    classes = stored(
        keys.where("digest IS NOT NULL AND vec_id IS NOT NULL")
        .groupBy("digest")
        .agg(F.min("vec_id").alias("doc"), F.count("*").alias("copies"), F.first("vector").alias("vector")),
        "vector-classes",
    )
    common = classes.groupBy(F.size("vector").alias("d")).count().orderBy(F.desc("count"), "d").first()
    dimension = common["d"] if common else 0
    forest = spark.sparkContext.broadcast(fit(classes, dimension, cosine) if common else [])

    def leaf_lists(batch: pa.RecordBatch) -> list[np.ndarray]:
        column = batch.column("vector")
        sizes = pa.compute.list_value_length(column).to_numpy()
        # Leaves of other dimensions have negative numbers.
        found = [np.array([-int(d)]) for d in sizes]
        usual = np.flatnonzero(sizes == dimension)
        if len(usual):
            own = leaves_of(unit(matrix(column.take(pa.array(usual)))), forest.value)
            for row, leaves in zip(usual.tolist(), own, strict=True):
                found[row] = leaves
        return found

    def in_leaves(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                leaves = np.concatenate(leaf_lists(batch))
                yield pa.RecordBatch.from_arrays([pa.array(leaves, pa.int64())], names=["leaf"])

    # As many rows as the forest has leaves, which the sample bounds.
    sizes = classes.select("vector").mapInArrow(in_leaves, "leaf long").groupBy("leaf").count()
    large = {r["leaf"]: -(-r["count"] // BLOCK_ROWS) for r in sizes.where(F.col("count") > BLOCK_ROWS).collect()}
    blocks = spark.sparkContext.broadcast(large)

    def dealt(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            row, leaf, block, i, j = [], [], [], [], []
            lists = leaf_lists(batch)
            docs = batch.column("doc").to_pylist()
            for at, leaves in enumerate(lists):
                for own in leaves.tolist():
                    parts = blocks.value.get(own, 1)
                    mine = (docs[at] * 0x9E3779B97F4A7C15 >> 32) % parts
                    for other in range(parts):
                        row.append(at)
                        leaf.append(own)
                        block.append(mine)
                        i.append(min(mine, other))
                        j.append(max(mine, other))
            taken = batch.take(pa.array(row))
            own_lists = pa.array(lists, pa.list_(pa.int64())).take(pa.array(row))
            ints = [pa.array(x, pa.int64()) for x in (leaf, block, i, j)]
            names = ["doc", "copies", "vector", "leaves", "leaf", "block", "i", "j"]
            yield pa.RecordBatch.from_arrays([*(taken.column(n) for n in names[:3]), own_lists, *ints], names=names)

    schema = f"doc long, copies long, vector array<{kind}>, leaves array<long>, leaf long, block long, i long, j long"
    placed = classes.select("doc", "copies", "vector").mapInArrow(dealt, schema)
    links = stored(
        placed.groupBy("leaf", "i", "j").applyInArrow(lambda t: compared(t, cosine), "doc long, n long, root long"),
        "vector-links",
    )
    counts = links.groupBy("doc").agg(F.sum("n").alias("others"))
    groups = components(links.select(F.col("doc").alias("a"), F.col("root").alias("b")))
    by_vector = (
        classes.select("digest", "doc", "copies")
        .join(counts, "doc", "left")
        .join(groups, F.col("doc") == groups.node, "left")
        .select(
            "digest",
            (F.coalesce("others", F.lit(0)) + F.col("copies") - 1).alias("n"),
            F.coalesce("component", "doc").alias("component"),
        )
    )
    component = F.coalesce("component", "vec_id")
    return keys.join(by_vector, "digest", "left").select(
        "vec_id",
        F.coalesce("n", F.lit(0)).cast("long").alias("n_links"),
        component.alias("component_id"),
        F.coalesce(F.col("vec_id") == component, F.lit(False)).alias("kept"),
    )
