"""Near duplicates by a multi-index Hamming join of b-bit MinHash signatures.

A signature has 65 symbols of 16 bits, one for each hash function.  Two texts of
similarity s differ in about 65 (1 - s) symbols; at 0.8 that is 13 with a standard
deviation of 3.2, so a distance of 25 (3.7 deviations more) covers similar pairs.
Signatures are split into 13 chunks of 5 symbols.  By the pigeonhole principle a
pair within 25 has a chunk with at most one error (13 chunks with two errors each
make 26).  Each chunk is entered once for every place where the error may be, with
that symbol left out: all pairs within the distance share an entry.

Only then are texts compared, on their full sets of shingles:

- Equal sets are one class, found by digest; only a class's first text is compared.
- First each text is compared with the smallest one of its entries.  So a large
  group of near copies costs as many comparisons as texts, not their square.
- Entries whose texts are in one component by then are done.  In the others all
  signatures are compared, and texts within the distance are clustered: those that only
  share an entry, as pages of one template do, are not.  A cluster is compared in one task
  if it is small, else in blocks of bounded size, block against block over all
  tasks: pairs within the distance that are not yet in one component.  Tasks return
  the links that join components, not the pairs, so that no link between components
  is lost and a group of any size leaves few rows.

Texts move once from the corpus to the table of texts that share an entry.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType

from basketflow.llm.common import stored, text_chunks, text_or_empty, without_machine
from basketflow.llm.components import components

#: Similarity of a link, in percent, and words of a shingle.
SIMILARITY, WORDS = 80, 5
#: Symbols of a signature, of a chunk, errors that a pair may have.
SYMBOLS, CHUNK, DISTANCE = 65, 5, 25
#: Shingles that one task compares with one text, about.
DEALT = 200_000
#: Texts and shingles of a block of a large cluster, about.
BLOCK_TEXTS, BLOCK_SHINGLES = 1_000, 2_000_000
#: Distinct words whose hashes a worker remembers while it makes sketches.
MEMO = 100_000

WORD_HASHES: dict[bytes, int] = {}


def mixed(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit numbers that spreads their bits."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


@lru_cache(8)
def seeds(count: int, name: str) -> np.ndarray:
    digests = (hashlib.blake2b(f"{name}/{i}".encode(), digest_size=8).digest() for i in range(count))
    return np.array([int.from_bytes(d, "little") | 1 for d in digests], np.uint64)


def words_of(text: bytes) -> list[bytes]:
    return text.lower().split()  # of bytes: A-Z, and ASCII white space


def shingle_hashes(words: list[bytes], size: int) -> np.ndarray:
    """Sorted distinct 64-bit hashes of the shingles; a shorter text is one shingle."""
    if not words:
        return np.empty(0, np.uint64)
    if len(WORD_HASHES) > MEMO:
        WORD_HASHES.clear()
    for word in set(words).difference(WORD_HASHES):
        WORD_HASHES[word] = xxhash.xxh3_64_intdigest(word)
    hashes = np.fromiter(map(WORD_HASHES.__getitem__, words), np.uint64, len(words))
    width = min(size, len(words))
    total = np.full(len(words) - width + 1, width, np.uint64)
    for place, seed in enumerate(seeds(width, "place")):
        total += mixed(hashes[place : place + len(total)] ^ seed) * seed
    return np.unique(mixed(total))


def signature(shingles: np.ndarray) -> bytes:
    """The symbols: 16 bits of the smallest value of each hash function."""
    keys = seeds(SYMBOLS, "function")[:, None]
    least = np.full(SYMBOLS, np.iinfo(np.uint64).max, np.uint64)
    for at in range(0, len(shingles), 2048):
        values = (shingles[None, at : at + 2048] ^ keys) * np.uint64(0x9E3779B97F4A7C15)
        values ^= values >> np.uint64(32)
        values *= keys
        np.minimum(least, values.min(axis=1), out=least)
    return (mixed(least) >> np.uint64(48)).astype("<u2").tobytes()


def sketches(docs: DataFrame, words: int) -> DataFrame:
    """``doc_id, n_shingles, digest, signature`` per row; the last two null without words."""

    def sketched(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        without_machine()
        for batch in text_chunks(batches, "text"):
            sizes, digests, signatures = [], [], []
            for text in batch.column("text").cast(pa.binary()).to_pylist():
                shingles = shingle_hashes(words_of(text), words)
                sizes.append(len(shingles))
                full = len(shingles) > 0
                digests.append(hashlib.blake2b(shingles.tobytes(), digest_size=16).digest() if full else None)
                signatures.append(signature(shingles) if full else None)
            columns = [pa.array(sizes, pa.int64()), pa.array(digests, pa.binary()), pa.array(signatures, pa.binary())]
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), *columns], names=["doc_id", "n_shingles", "digest", "signature"]
            )
        # The worker goes on to other work.
        WORD_HASHES.clear()

    schema = "doc_id long, n_shingles long, digest binary, signature binary"
    return docs.mapInArrow(sketched, schema)


def entry_keys(signatures: np.ndarray) -> np.ndarray:
    """For each signature a key per symbol: of its chunk without that symbol."""
    count = len(signatures)
    places = np.arange(SYMBOLS, dtype=np.uint64) << np.uint64(16)
    terms = mixed((signatures.astype(np.uint64) | places) * np.uint64(0x9E3779B97F4A7C15))
    chunks = terms.reshape(count, -1, CHUNK)
    rest = chunks.sum(axis=2, dtype=np.uint64)[:, :, None] - chunks
    return mixed(rest.reshape(count, SYMBOLS) + seeds(SYMBOLS, "entry"))


def entries(classes: DataFrame) -> DataFrame:
    """``key, doc``: the entries of each class's first text."""

    def entered(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 2048):
                part = batch.slice(at, 2048)
                raw = b"".join(part.column("signature").to_pylist())
                keys = entry_keys(np.frombuffer(raw, "<u2").reshape(-1, SYMBOLS))
                docs = np.repeat(part.column("doc").to_numpy(), SYMBOLS)
                columns = [pa.array(keys.ravel().view(np.int64)), pa.array(docs)]
                yield pa.RecordBatch.from_arrays(columns, names=["key", "doc"])

    return classes.select("doc", "signature").mapInArrow(entered, "key long, doc long")


@F.pandas_udf(IntegerType())
def distance(one: pd.Series, other: pd.Series) -> pd.Series:
    """Symbols in which two signatures differ."""
    a, b = (np.frombuffer(b"".join(s), "<u2").reshape(-1, SYMBOLS) for s in (one, other))
    return pd.Series((a != b).sum(axis=1).astype(np.int32))


def near(pairs: DataFrame, classes: DataFrame) -> DataFrame:
    """``a, b, n_b`` of the pairs within the signature distance."""
    one = classes.select(F.col("doc").alias("a"), F.col("signature").alias("sig_a"))
    other = classes.select(F.col("doc").alias("b"), F.col("signature").alias("sig_b"), F.col("n").alias("n_b"))
    joined = pairs.join(one, "a").join(other, "b")
    return joined.where(distance("sig_a", "sig_b") <= DISTANCE).select("a", "b", "n_b")


def linked(pairs: DataFrame, texts: DataFrame, words: int, similarity: int) -> DataFrame:
    """``a, b`` of the pairs whose full sets are similar enough.

    Rows of one ``a`` come after it, in one task or dealt over several; a task
    holds the set of one ``a`` and one text at a time.
    """
    parts = F.ceil(F.col("total") / DEALT).cast("int")
    sizes = pairs.groupBy("a").agg(F.sum("n_b").alias("total"))
    dealt = pairs.join(sizes, "a").select(
        "a", F.col("b").alias("doc"), F.pmod(F.xxhash64("b"), parts).cast("int").alias("part")
    )
    heads = sizes.select("a", F.col("a").alias("doc"), F.explode(F.sequence(F.lit(0), parts - 1)).alias("part"))
    rows = dealt.union(heads).join(texts, "doc")
    placed = rows.repartition("a", "part").sortWithinPartitions("a", "part", F.col("doc") != F.col("a"))

    def compared(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        a, head = None, set()
        for batch in text_chunks(batches, "text"):
            found = []
            for row_a, doc, text in zip(*(batch.column(c).to_pylist() for c in ("a", "doc", "text")), strict=True):
                own = shingles_of(text.encode("utf-8"), words)
                if doc == row_a:
                    a, head = row_a, own
                elif a == row_a:
                    common = len(own & head)
                    if 100 * common >= similarity * (len(own) + len(head) - common):
                        found.append((a, doc))
            columns = [pa.array([f[i] for f in found], pa.int64()) for i in (0, 1)]
            yield pa.RecordBatch.from_arrays(columns, names=["a", "b"])

    return placed.select("a", "doc", "text").mapInArrow(compared, "a long, b long")


def shingles_of(text: bytes, size: int) -> set:
    """The shingles themselves, as they are compared."""
    words = words_of(text)
    if len(words) < size:
        return {tuple(words)} if words else set()
    return set(zip(*(words[i:] for i in range(size)), strict=False))


def compared(table: pa.Table, words: int, similarity: int) -> pa.Table:
    """Links that join components among the texts of a cluster, or of two blocks of it."""
    table = table.take(pa.array(np.argsort(table.column("doc").to_numpy(), kind="stable")))
    docs = table.column("doc").to_numpy()
    block = table.column("block").to_numpy()
    two = table.column("i")[0].as_py() != table.column("j")[0].as_py()
    texts = [t.encode("utf-8") for t in table.column("text").to_pylist()]
    sets = [shingle_hashes(words_of(t), words) for t in texts]
    sizes = np.array([len(s) for s in sets])
    signatures = np.frombuffer(b"".join(table.column("signature").to_pylist()), "<u2").reshape(-1, SYMBOLS)
    group = table.column("group").to_numpy().copy()
    found = []
    for at in range(len(docs) - 1):
        rest = slice(at + 1, None)
        likely = (group[rest] != group[at]) & ((signatures[rest] != signatures[at]).sum(axis=1) <= DISTANCE)
        likely &= 100 * np.minimum(sizes[rest], sizes[at]) >= similarity * np.maximum(sizes[rest], sizes[at])
        if two:
            likely &= block[rest] != block[at]
        for other in (np.flatnonzero(likely) + at + 1).tolist():
            if group[other] == group[at]:
                continue  # joined meanwhile
            common = len(np.intersect1d(sets[at], sets[other], assume_unique=True))
            if 100 * common < similarity * (sizes[at] + sizes[other] - common):
                continue
            one, two_ = shingles_of(texts[at], words), shingles_of(texts[other], words)
            common = len(one & two_)
            if 100 * common >= similarity * (len(one) + len(two_) - common):
                found.append((docs[at], docs[other]))
                group[group == group[other]] = group[at]
    kinds = pa.schema([("a", pa.int64()), ("b", pa.int64())])
    return pa.table({"a": [a for a, _ in found], "b": [b for _, b in found]}, schema=kinds)


def within_entries(members: DataFrame, groups: DataFrame, classes: DataFrame) -> DataFrame:
    """``a, b``: pairs of texts of one entry that are within the distance and in different
    components; of each entry's (or two of its blocks') as many as lead through the same texts.

    ``members``: ``key, doc`` of the entries, each text once.  Large entries are compared
    in blocks of bounded size, block against block, by signatures alone.
    """
    own = groups.select(F.col("node").alias("doc"), "component")
    known = classes.select("doc", "signature").join(own, "doc", "left")
    known = known.select("doc", "signature", F.coalesce("component", "doc").alias("group"))
    blocks = F.ceil(F.count("*") / BLOCK_TEXTS).cast("int").alias("blocks")
    other = F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("other")
    dealt = (
        members.join(members.groupBy("key").agg(blocks), "key")
        .select("key", "doc", F.pmod(F.xxhash64("doc"), F.col("blocks")).cast("int").alias("block"), other)
        .select("key", "doc", "block", F.least("block", "other").alias("i"), F.greatest("block", "other").alias("j"))
    )
    rows = dealt.join(known, "doc").select("key", "i", "j", "block", "doc", "group", "signature")
    placed = rows.repartition("key", "i", "j").sortWithinPartitions("key", "i", "j", "doc")
    return placed.mapInArrow(_entry_pairs, "a long, b long").distinct()


def _entry_pairs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The pairs of ``within_entries`` from rows in the order of their entries."""
    at, held = None, []

    def pairs() -> Iterator[tuple[int, int]]:
        two = at[1] != at[2]
        block, docs, group, raw = (list(c) for c in zip(*held, strict=True))
        group, block = np.array(group), np.array(block)
        signatures = np.frombuffer(b"".join(raw), "<u2").reshape(-1, SYMBOLS)
        joined = np.arange(len(docs))  # texts that pairs lead through to each other
        for i in range(len(docs) - 1):
            rest = slice(i + 1, None)
            likely = (group[rest] != group[i]) & ((signatures[rest] != signatures[i]).sum(axis=1) <= DISTANCE)
            if two:
                likely &= block[rest] != block[i]
            for j in (np.flatnonzero(likely) + i + 1).tolist():
                if joined[j] != joined[i]:
                    yield docs[i], docs[j]
                    joined[joined == joined[j]] = joined[i]

    found = []
    for batch in batches:
        for key, i, j, *row in zip(*(c.to_pylist() for c in batch.columns), strict=True):
            if at != (key, i, j):
                if len(held) > 1:
                    found += pairs()
                at, held = (key, i, j), []
            held.append(row)
        if len(found) > 100_000:
            yield _as_batch(found)
            found = []
    if len(held) > 1:
        found += pairs()
    yield _as_batch(found)


def _as_batch(pairs: list[tuple[int, int]]) -> pa.RecordBatch:
    columns = [pa.array([p[i] for p in pairs], pa.int64()) for i in (0, 1)]
    return pa.RecordBatch.from_arrays(columns, names=["a", "b"])


def across(
    open_pairs: DataFrame, groups: DataFrame, classes: DataFrame, texts: DataFrame, words: int, similarity: int
) -> DataFrame:
    """Links between components of texts within the distance, directly or through others.

    ``open_pairs``: ``a, b`` that lead through all such texts.
    """
    clusters = components(open_pairs).select(F.col("node").alias("doc"), F.col("component").alias("cluster"))
    members = stored(clusters.join(classes.select("doc", "n", "signature"), "doc"), "clusters")
    wanted = F.greatest(F.ceil(F.count("*") / BLOCK_TEXTS), F.ceil(F.sum("n") / BLOCK_SHINGLES))
    blocks = members.groupBy("cluster").agg(wanted.cast("int").alias("blocks"))
    other = F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("other")
    dealt = (
        members.join(blocks, "cluster")
        .select("*", F.pmod(F.xxhash64("doc"), F.col("blocks")).cast("int").alias("block"))
        .select("doc", "cluster", "signature", "block", other)
        .withColumn("i", F.least("block", "other"))
        .withColumn("j", F.greatest("block", "other"))
        .drop("other")
    )
    own = groups.select(F.col("node").alias("doc"), "component")
    placed = dealt.join(own, "doc", "left").withColumn("group", F.coalesce("component", "doc")).drop("component")
    rows = placed.join(texts, "doc")
    return rows.groupBy("cluster", "i", "j").applyInArrow(
        lambda table: compared(table, words, similarity), "a long, b long"
    )


def near_duplicates(docs: DataFrame, words: int = WORDS, similarity: int = SIMILARITY) -> DataFrame:
    """``doc_id, n_shingles, component_id, kept``, one row per row of ``docs``.

    ``component_id`` is the smallest ``doc_id`` reachable by links, ``kept`` whether
    it is the row's own.  Texts without words, or null, are linked with nothing.
    Rows that share a ``doc_id`` are one document, so repeated rows are kept or
    dropped together.  A row without ``doc_id`` is compared with nothing: it takes the
    component of a document with the same set of shingles, and is not kept; if there
    is none it has no component and is kept.
    Columns other than ``doc_id`` and the text are not read.
    """
    return verdicts(docs, words, similarity).drop("digest")


def verdicts(docs: DataFrame, words: int = WORDS, similarity: int = SIMILARITY) -> DataFrame:
    """The same, and the ``digest`` of each row's set of shingles, null without words."""
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text_or_empty(docs).alias("text"))
    sketched = stored(sketches(rows, words), "sketches")
    classes = stored(
        sketched.where("digest IS NOT NULL AND doc_id IS NOT NULL")
        .groupBy("digest")
        .agg(F.min("doc_id").alias("doc"), F.first("n_shingles").alias("n"), F.first("signature").alias("signature")),
        "classes",
    )
    entered = entries(classes)
    shared = stored(
        entered.groupBy("key")
        .agg(F.min("doc").alias("a"), F.max("doc").alias("b"), F.count("*").alias("size"))
        .where("a < b"),
        "entries",
    )
    crowded = stored(entered.join(shared.where("size > 2").select("key", "a"), "key"), "crowded")
    members = shared.where("size = 2").select("key", "a", F.col("b").alias("doc")).union(
        crowded.select("key", "a", "doc").where("doc <> a")
    )
    wanted = members.select(F.explode(F.array("a", "doc")).alias("doc")).distinct()
    # By a shuffle whatever the sizes, as wanted texts grow with the corpus.
    texts = stored(rows.withColumnRenamed("doc_id", "doc").join(wanted.hint("merge"), "doc"), "texts")
    first = members.groupBy("doc").agg(F.min("a").alias("a")).select("a", F.col("doc").alias("b"))
    found = stored(linked(stored(near(first, classes), "pairs"), texts, words, similarity), "links")
    groups = components(found)

    # Entries with texts of several components.
    by_doc = groups.select(F.col("node").alias("doc"), "component")
    by_a = groups.select(F.col("node").alias("a"), F.col("component").alias("component_a"))
    grouped = members.join(by_doc, "doc", "left").join(by_a, "a", "left")
    group, group_a = F.coalesce("component", "doc"), F.coalesce("component_a", "a")
    # Stored, so that the next join stands alone and Spark can split an entry's rows.
    mixed_entries = stored(grouped.where(group != group_a).select("key").distinct(), "mixed-entries")
    several = members.join(mixed_entries, "key", "left_semi")
    each = stored(several.select("key", "doc").union(several.select("key", F.col("a").alias("doc")).distinct()), "several")
    open_pairs = stored(within_entries(each, groups, classes), "open-pairs")
    if not open_pairs.isEmpty():
        more = stored(across(open_pairs, groups, classes, texts, words, similarity), "links")
        if not more.isEmpty():
            groups = components(found.union(more))

    by_text = classes.join(groups, classes.doc == groups.node, "left").select(
        "digest", F.coalesce("component", "doc").alias("component")
    )
    component = F.coalesce("component", "doc_id")
    return sketched.join(by_text, "digest", "left").select(
        "doc_id",
        "n_shingles",
        component.alias("component_id"),
        F.col("doc_id").eqNullSafe(component).alias("kept"),
        "digest",
    )
