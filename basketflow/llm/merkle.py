"""A Merkle manifest of a table, and proofs of its rows by multiproof.

Rows are leaves, one tree for each language and one over the trees' roots.  Leaves
are put in order by range and numbered from counts per file, so no task sees a whole
language.  Trees grow block by block: a block of ``8 ** depth`` nodes of one level is
one small group that gives the next ``depth`` levels, so 2 * 10**10 leaves need three
rounds.

Proofs are made per leaf partition (a block's rows, or those of them that are asked
for).  A partition works out the least set of nodes that its leaves don't give, which
for a whole block are the siblings of its ancestors; all partitions' coordinates are
joined with the stored nodes once; then each derives the interior nodes its leaves
share and expands the proof of every leaf from what it has.

An owner of a proof needs the root alone: ``folded`` gives the root that a leaf and its
siblings lead to.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass
from functools import reduce
from hashlib import sha256

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from basketflow.llm.common import stored, table_parts

#: Nodes that become one node of the next level.
ARITY = 8
#: Levels that a block of ``ARITY ** DEPTH`` nodes gives.
DEPTH = 4
#: The name of the tree over the trees; others begin with "-" or "=".
TOP = ""
FIELDS = ("doc_id", "source", "lang", "n_chars", "text")

NODES = "tree string, level int, position long, n long, digest string"
COORDINATES = "tree string, block long, of string, level int, position long"


def digest_of(parts: list[str]) -> str:
    return sha256("".join(parts).encode()).hexdigest()


def parents(n: int) -> int:
    return -(-n // ARITY)


def run_of(position: int, n: int) -> range:
    """The positions that share a parent with ``position``, on a level of ``n`` nodes."""
    first = position - position % ARITY
    return range(first, min(first + ARITY, n))


def missing(positions: set[int], n: int) -> list[tuple[int, int]]:
    """(level, position) of the nodes that proofs of ``positions`` need and their leaves don't give."""
    level, needed = 0, []
    while n > 1:
        above = {p // ARITY for p in positions}
        needed += [(level, p) for q in sorted(above) for p in run_of(q * ARITY, n) if p not in positions]
        positions, n, level = above, parents(n), level + 1
    return needed


def folded(leaf: str, position: int, siblings: list[list[str]]) -> str:
    """The root that a leaf and its siblings, level by level, lead to."""
    own = leaf
    for beside in siblings:
        place = position % ARITY
        own = digest_of([*beside[:place], own, *beside[place:]])
        position //= ARITY
    return own


def siblings_of(position: int, n: int, node: Callable[[int, int], str]) -> list[list[str]]:
    """The siblings of a leaf, level by level and left to right; ``node`` gives those by coordinates."""
    found, level = [], 0
    while n > 1:
        found.append([node(level, p) for p in run_of(position, n) if p != position])
        position, n, level = position // ARITY, parents(n), level + 1
    return found


def encoded(value: Column) -> Column:
    """``-`` for null, else the length in bytes, ``:``, and the value."""
    text = value.cast("string")
    return F.when(text.isNull(), F.lit("-")).otherwise(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text))


def leaf_of(values: dict[str, Column]) -> Column:
    return F.sha2(F.concat(*(encoded(values[name]) for name in FIELDS)), 256)


def tree_of(lang: Column) -> Column:
    """The name of a language's tree; names are in the order of the languages, null first."""
    text = lang.cast("string")
    return F.when(text.isNull(), F.lit("-")).otherwise(F.concat(F.lit("="), text))


def placed(rows: DataFrame, order: list[str], name: str) -> DataFrame:
    """``rows`` (with ``tree``) with their ``position`` in the order of their tree, and its size ``n``.

    The rows are sorted by range into files, rows that are alike too.  A row's
    position is its place in its file and the counts of the files before.
    """
    keys = ["tree", *order, "_tie"]
    ranged = rows.withColumn("_tie", F.monotonically_increasing_id()).repartitionByRange(*keys).sortWithinPartitions(*keys)
    parts = table_parts(stored(ranged.drop("_tie"), name))
    pieces = parts.groupBy("tree", "_part").agg(F.min("_row").alias("_first"), F.count(F.lit(1)).alias("_count"))
    tree = Window.partitionBy("tree")
    before = F.sum("_count").over(tree.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1))
    starts = pieces.select(
        "tree", "_part", (F.coalesce(before, F.lit(0)) - F.col("_first")).alias("_start"), F.sum("_count").over(tree).alias("n")
    )
    # Stored, so that Spark knows its size: a row for each file and tree in it.
    joined = parts.join(stored(starts, f"{name}-starts"), ["tree", "_part"])
    return joined.select(*rows.columns, (F.col("_start") + F.col("_row")).alias("position"), "n")


def _grow(level: int, depth: int):
    """Blocks of nodes of one level, in order, to the nodes of the next levels."""
    block_size = ARITY**depth

    def of_block(tree: str, block: int, n: int, digests: list[str]) -> list[tuple]:
        found, start = [], block * block_size
        for step in range(1, depth + 1):
            if n == 1:
                break
            digests = [digest_of(digests[i : i + ARITY]) for i in range(0, len(digests), ARITY)]
            start, n = start // ARITY, parents(n)
            found += [(tree, level + step, start + i, n, digest) for i, digest in enumerate(digests)]
        return found

    def grow(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for of, members in _blocks(batches, block_size):
            found = of_block(*of, members[0][1], [digest for _, _, digest in members])
            if found:
                yield _batch(found, NODES)

    return grow


def _blocks(batches: Iterator[pa.RecordBatch], size: int) -> Iterator[tuple[tuple[str, int], list[tuple]]]:
    """Rows of ``tree, position, ...`` in order, by tree and block of ``size`` positions."""
    of, members = None, []
    for batch in batches:
        for tree, position, *rest in zip(*(c.to_pylist() for c in batch.columns), strict=True):
            if of != (tree, position // size):
                if members:
                    yield of, members
                of, members = (tree, position // size), []
            members.append((position, *rest))
    if members:
        yield of, members


def _batch(rows: list[tuple], schema: str) -> pa.RecordBatch:
    kinds = {"string": pa.string(), "int": pa.int32(), "long": pa.int64()}
    fields = [field.split() for field in schema.split(", ")]
    columns = [pa.array(c, kinds[kind]) for c, (_, kind) in zip(zip(*rows, strict=True), fields, strict=True)]
    return pa.RecordBatch.from_arrays(columns, names=[name for name, _ in fields])


def in_blocks(rows: DataFrame, depth: int) -> DataFrame:
    """Rows with ``tree`` and ``position`` dealt by block, each block's in order."""
    block = F.expr(f"position div {ARITY**depth}")
    return rows.repartition("tree", block).sortWithinPartitions("tree", "position")


def grown(leaves: DataFrame, depth: int, name: str) -> list[DataFrame]:
    """All nodes over ``leaves`` (``tree, position, n, digest``), a stored table for each round.

    A tree's root is its node with ``n`` = 1: the only node of its level.
    """
    most = leaves.agg(F.max("n")).first()[0] or 0
    tables, nodes, level = [], leaves, 0
    while most > 1:
        blocks = in_blocks(nodes.select("tree", "position", "n", "digest"), depth)
        tables.append(stored(blocks.mapInArrow(_grow(level, depth), NODES), f"{name}-nodes"))
        level, most = level + depth, -(-most // ARITY**depth)
        nodes = tables[-1].where((F.col("level") == level) & (F.col("n") > 1))
    return tables


def all_nodes(leaves: DataFrame, tables: list[DataFrame]) -> list[DataFrame]:
    lowest = leaves.select("tree", F.lit(0).alias("level"), "position", "n", "digest")
    return [lowest, *tables]


def roots(leaves: DataFrame, tables: list[DataFrame]) -> DataFrame:
    return reduce(DataFrame.union, (t.where("n = 1").select("tree", "digest") for t in all_nodes(leaves, tables)))


@dataclass
class Manifest:
    """``rows``: the leaves with ``tree, position, n, leaf`` and what came with them.
    ``nodes``: tables of all nodes, ``TOP``'s among them.  ``trees``: ``tree``, its
    ``number`` among ``n_trees`` and its ``subroot``.  ``root``: of all; null without rows."""

    rows: DataFrame
    nodes: list[DataFrame]
    trees: DataFrame
    root: str | None
    depth: int


def manifest(leaves: DataFrame, order: list[str], depth: int = DEPTH) -> Manifest:
    """The trees over rows with ``tree`` and ``leaf``; ``order``: columns that order a tree's leaves.

    Rows that ``order`` leaves apart by nothing are ordered by ``leaf``.
    """
    rows = placed(leaves, [*order, "leaf"], "leaves")
    digests = rows.select("tree", "position", "n", F.col("leaf").alias("digest"))
    tables = grown(digests, depth, "tree")
    subroots = roots(digests, tables).select(F.lit(TOP).alias("tree"), F.col("tree").alias("name"), "digest")
    above = placed(subroots, ["name"], "subroots")
    top = above.select("tree", "position", "n", "digest")
    top_tables = grown(top, depth, "top")
    root = roots(top, top_tables).first()
    trees = above.select(
        F.col("name").alias("tree"), F.col("position").alias("number"), F.col("n").alias("n_trees"), F.col("digest").alias("subroot")
    )
    nodes = all_nodes(digests, tables) + all_nodes(top, top_tables)
    return Manifest(rows, nodes, stored(trees, "trees"), root["digest"] if root else None, depth)


def _coordinates(depth: int):
    def coordinates(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for (tree, block), members in _blocks(batches, ARITY**depth):
            _, n, number, n_trees = members[0]
            needed = [(tree, block, tree, *at) for at in missing({m[0] for m in members}, n)]
            needed += [(tree, block, TOP, *at) for at in missing({number}, n_trees)]
            if needed:
                yield _batch(needed, COORDINATES)

    return coordinates


def fetched(proven: Manifest, claims: DataFrame) -> DataFrame:
    """``tree, block, of, level, position, digest``: the nodes that each leaf partition lacks."""
    rows = in_blocks(claims.select("tree", "position", "n", "number", "n_trees"), proven.depth)
    needed = stored(rows.mapInArrow(_coordinates(proven.depth), COORDINATES), "coordinates")
    # A few levels at most: tables without them are not read.
    levels = [row["level"] for row in needed.select("level").distinct().collect()]
    nodes = [t.where(F.col("level").isin(levels)).select(F.col("tree").alias("of"), "level", "position", "digest") for t in proven.nodes]
    return needed.join(reduce(DataFrame.union, nodes), ["of", "level", "position"]).select(
        "tree", "block", "of", "level", "position", "digest"
    )


def prove(proven: Manifest, claims: DataFrame, siblings: bool = False) -> DataFrame:
    """Check claims against the manifest.

    ``claims``: rows of ``proven.rows`` (all or some) with ``claim``, the digest that a
    leaf is said to have; null claims the leaf itself.  Returns their columns and
    ``proof_sha256`` (of the leaf's siblings from its run to the root), ``folded_root``
    (from the claim and these), ``subroot``, ``root`` and ``verified``, and with
    ``siblings`` also ``proof``, the siblings level by level.
    """
    kept = list(claims.columns)
    claims = claims.join(proven.trees.drop("subroot"), "tree").withColumn("block", F.expr(f"position div {ARITY**proven.depth}"))
    proof = ", proof array<array<string>>" if siblings else ""
    fields = ", ".join(f"`{name}` {claims.schema[name].dataType.simpleString()}" for name in kept)

    def expand(leaves: pa.Table, nodes: pa.Table) -> pa.Table:
        columns = {name: leaves.column(name).to_pylist() for name in ("position", "leaf", "claim")}
        tree, n, number, n_trees = (leaves.column(name)[0].as_py() for name in ("tree", "n", "number", "n_trees"))
        known = {tuple(c): digest for *c, digest in zip(*(nodes.column(x).to_pylist() for x in ("of", "level", "position", "digest")), strict=True)}
        known.update(((tree, 0, p), leaf) for p, leaf in zip(columns["position"], columns["leaf"], strict=True))
        # The interior nodes that the leaves share, each once.
        level, here, size = 0, set(columns["position"]), n
        while size > 1:
            above = {p // ARITY for p in here}
            for q in above:
                known[tree, level + 1, q] = digest_of([known[tree, level, p] for p in run_of(q * ARITY, size)])
            level, here, size = level + 1, above, parents(size)
        upper = siblings_of(number, n_trees, lambda at, p: known[TOP, at, p])
        proofs, found = [], []
        for position, leaf, claim in zip(*columns.values(), strict=True):
            own = siblings_of(position, n, lambda at, p: known[tree, at, p])
            proofs.append(own + upper)
            found.append(folded(folded(leaf if claim is None else claim, position, own), number, upper))
        result = leaves.select(kept)
        result = result.append_column("proof_sha256", pa.array([digest_of([d for run in p for d in run]) for p in proofs]))
        result = result.append_column("folded_root", pa.array(found))
        return result.append_column("proof", pa.array(proofs, pa.list_(pa.list_(pa.string())))) if siblings else result

    nodes = fetched(proven, claims)
    expanded = (
        claims.groupBy("tree", "block")
        .cogroup(nodes.groupBy("tree", "block"))
        .applyInArrow(expand, f"{fields}, proof_sha256 string, folded_root string{proof}")
    )
    root = F.lit(proven.root).cast("string")
    return (
        expanded.join(proven.trees.select("tree", "subroot"), "tree")
        .withColumn("root", root)
        .withColumn("verified", F.col("folded_root") == root)
    )


def document_leaves(docs: DataFrame) -> DataFrame:
    """``tree, doc_id, leaf, claim`` of each document.

    ``claim`` is the leaf of the text with A-Z in lower case where 3 divides the
    CRC-32 of the decimal ``doc_id``, else null (also without ``doc_id``).
    """
    values = {name: docs[name] for name in FIELDS}
    lowered = F.translate(docs["text"].cast("string"), "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    tampered = F.crc32(docs["doc_id"].cast("string")) % 3 == 0
    return docs.select(
        tree_of(docs["lang"]).alias("tree"),
        docs["doc_id"].alias("doc_id"),
        leaf_of(values).alias("leaf"),
        F.when(tampered, leaf_of(values | {"text": lowered})).alias("claim"),
    )


def verify_documents(docs: DataFrame, depth: int = DEPTH) -> DataFrame:
    """Build the manifest of ``docs`` and check every document, tampered ones too, against it.

    Returns ``doc_id, leaf, subroot, root, proof_sha256, folded_root, verified``, one
    row for each row of ``docs``.  Null values count as ``-``, null languages are one
    tree, rows without ``doc_id`` come first in theirs; repeated rows are leaves of their
    own, rows with one ``doc_id`` and unlike content are in the order of their leaves.
    An empty table gives no rows.  Other columns are not read.
    """
    proven = manifest(document_leaves(docs), ["doc_id"], depth)
    checked = prove(proven, proven.rows)
    return checked.select("doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified")
