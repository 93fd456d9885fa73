"""Mixing sources to target weights by a Pfair schedule.

Each source's documents are cut into blocks.  All sources are served at rates in the
ratio of their weights until they run out, and the others then share the slots by
theirs.  A source of weight w has had its j-th block
by the moment j / w of a common clock; at moment v, T(v) = sum of min(w v, n) over the
sources (n blocks each) slots have passed.  So block j is released at slot
floor(T((j - 1) / w)) and due by slot ceil(T(j / w)), and in each slot the released block
with the earliest deadline goes next.  No deadline is missed, as the blocks with windows
inside some slots never need more than those, so at any slot a source has had what its
weight gives it, give or take less than one block.  Weights are taken as the exact
fractions that floats are, and no slot or weight is rounded.

Sources with the same number of documents and the same weight have the same windows, so
they are one class, served in turn.  N documents have less than sqrt(2 N) different
numbers of documents a source, so the classes are few however many the sources.  The
driver holds the classes and makes the schedule in one pass, as runs of blocks of a
class, which it hands to Spark in pieces; documents find theirs by a join.

A block's number is the document's place in its source.  Places are given without
ordering a source in one task: documents are dealt by hash into buckets of bounded
size, numbered within them, and the buckets' sizes summed up before them.
"""

from __future__ import annotations

import heapq
from bisect import bisect
from collections.abc import Iterator
from dataclasses import dataclass
from fractions import Fraction
from functools import reduce
from itertools import accumulate, islice

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from basketflow.llm.common import on_plain_names, stored

#: Documents of a block, and of a bucket (about).
BLOCK_DOCS, BUCKET_DOCS = 16, 4_000
#: Blocks of a run at most, runs that the driver hands over at once.
RUN_BLOCKS, PIECE_RUNS = 4_000, 500_000
#: Without target weights, a source gets its share of documents to this power.
TEMPER = 0.7
SEED = 20_260_101


@dataclass
class Sources:
    """A class of sources: documents and weight of each, and how many they are."""

    docs: int
    weight: float
    members: int


#: Block ``first + i`` of class ``number`` is in slot ``slot + i``, from ``position + i * size``.
RUN = "number long, first long, length long, slot long, position long, size long, release long, deadline long"


def runs(classes: list[Sources], block_docs: int) -> Iterator[tuple[int, ...]]:
    """The schedule in the order of slots, as rows of ``RUN``: earliest deadline first.

    The blocks of a class are numbered by round, and within it by member.
    """
    exact = [Fraction(c.weight) for c in classes]
    scale = max((w.denominator for w in exact), default=1)
    # Denominators of floats are powers of two.
    weight = [int(w * scale) for w in exact]
    blocks = [-(-c.docs // block_docs) for c in classes]
    by_end = sorted(range(len(classes)), key=lambda c: Fraction(blocks[c], weight[c]))
    ends = [(blocks[c], weight[c]) for c in by_end]
    rough = [n / w for n, w in ends]
    out = [0, *accumulate(classes[c].members * blocks[c] for c in by_end)]
    total = sum(c.members * w for c, w in zip(classes, weight, strict=True))
    rates = [total - x for x in (0, *accumulate(classes[c].members * weight[c] for c in by_end))]

    def passed(j: int, w: int) -> int:
        """T(j / w) times w."""
        p = bisect(rough, j / w)
        while p < len(ends) and ends[p][0] * w <= j * ends[p][1]:
            p += 1
        while p and ends[p - 1][0] * w > j * ends[p - 1][1]:
            p -= 1
        return out[p] * w + rates[p] * j

    later = [(0, c, 0) for c in range(len(classes))]
    ready: list[tuple[int, int, int, int, int]] = []
    slot = position = 0
    while later or ready:
        while later and later[0][0] <= slot:
            release, c, j = heapq.heappop(later)
            until, w = passed(j + 1, weight[c]), weight[c]
            heapq.heappush(ready, (-(-until // w), c, j, 0, release))
            if j + 1 < blocks[c]:
                heapq.heappush(later, (until // w, c, j + 1))
        due, c, j, member, release = heapq.heappop(ready)
        own = classes[c]
        length = min(own.members - member, RUN_BLOCKS, later[0][0] - slot if later else RUN_BLOCKS)
        size = block_docs if j + 1 < blocks[c] else own.docs - j * block_docs
        assert slot + length <= due, "a deadline is missed"
        yield c, j * own.members + member, length, slot, position, size, release, due
        slot, position = slot + length, position + length * size
        if member + length < own.members:
            heapq.heappush(ready, (due, c, j, member + length, release))


def schedule(spark: SparkSession, classes: list[Sources], block_docs: int) -> DataFrame:
    """A row for each block: ``number, nth, slot, first_position, release, deadline``."""
    pieces, rows = [], runs(classes, block_docs)
    names = [part.split()[0] for part in RUN.split(", ")]
    while piece := list(islice(rows, PIECE_RUNS)):
        columns = [pa.array(column, pa.int64()) for column in zip(*piece, strict=True)]
        pieces.append(stored(spark.createDataFrame(pa.table(columns, names=names)), "runs"))
    found = reduce(DataFrame.union, pieces) if pieces else spark.createDataFrame([], RUN)
    each = found.select("*", F.explode(F.sequence(F.lit(0).cast("long"), F.col("length") - 1)).alias("i"))
    return each.select(
        "number",
        (F.col("first") + F.col("i")).alias("nth"),
        (F.col("slot") + F.col("i")).alias("slot"),
        (F.col("position") + F.col("i") * F.col("size")).alias("first_position"),
        "release",
        "deadline",
    )


def numbered(docs: DataFrame, source: str = "source") -> tuple[DataFrame, DataFrame]:
    """``doc_id, source, copies, bucket, own``, and the buckets' ``source, bucket, size, offset``."""
    rows = docs.select("doc_id", F.col(source).cast("string").alias("source"))
    total = rows.count()
    buckets = max(1, -(-total // BUCKET_DOCS))
    mixed = F.xxhash64(F.coalesce(F.col("doc_id").cast("string"), F.lit("")), F.lit(SEED))
    # Rows alike are told apart by number only; a document's copies are as many rows.
    counted = rows.groupBy("source", "doc_id").agg(F.count("*").alias("copies"))
    counted = stored(counted.withColumn("bucket", F.pmod(mixed, F.lit(buckets))).withColumn("mixed", mixed), "mix")
    within = Window.partitionBy("source", "bucket").orderBy("mixed", "doc_id")
    sizes = counted.groupBy("source", "bucket").agg(F.sum("copies").alias("size"))
    # Buckets of a source: one for each few thousand documents, so these are few.
    before = Window.partitionBy("source").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sizes.withColumn("offset", F.coalesce(F.sum("size").over(before), F.lit(0)))
    rows = counted.withColumn(
        "own", F.coalesce(F.sum("copies").over(within.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    )
    return rows.drop("mixed"), stored(offsets, "buckets")


def placed(rows: DataFrame, offsets: DataFrame) -> DataFrame:
    """``doc_id, source, copy, place`` and what else ``offsets`` has: places in a source from 0."""
    same = rows["source"].eqNullSafe(offsets["source"]) & (rows["bucket"] == offsets["bucket"])
    more = [c for c in offsets.columns if c not in ("source", "bucket", "size", "offset")]
    joined = rows.join(offsets, same).select(
        "doc_id", rows["source"], "copies", (F.col("offset") + F.col("own")).alias("start"), *more
    )
    copies = F.explode(F.sequence(F.lit(0).cast("long"), F.col("copies") - 1)).alias("copy")
    return joined.select("doc_id", "source", "start", copies, *more).select(
        "doc_id", "source", "copy", (F.col("start") + F.col("copy")).alias("place"), *more
    )


def classed(sources: DataFrame, weights: dict[str | None, float]) -> tuple[DataFrame, list[Sources]]:
    """``source, number, member, members`` of ``source, docs``, and the classes by number."""
    spark = sources.sparkSession
    given = spark.createDataFrame([(s, float(w)) for s, w in weights.items() if w > 0], "source string, given double")
    same = sources["source"].eqNullSafe(given["source"])
    known = sources.join(given, same, "left").select(sources["source"], "docs", "given")
    name = F.concat_ws("/", F.col("docs").cast("string"), F.col("given").cast("string"))
    known = stored(known.withColumn("class", name), "sources")
    kinds = known.groupBy("class", "docs", "given").count().collect()
    kinds.sort(key=lambda r: (r["docs"], r["class"]))
    classes = [Sources(r["docs"], r["docs"] ** TEMPER if r["given"] is None else r["given"], r["count"]) for r in kinds]
    numbers = spark.createDataFrame(
        [(r["class"], n, r["count"]) for n, r in enumerate(kinds)], "class string, number long, members long"
    )
    # Members are numbered as documents are: a class may have very many.
    members = placed(*numbered(known.select(F.col("source").alias("doc_id"), "class"), "class"))
    members = members.select(F.col("doc_id").alias("source"), F.col("source").alias("class"), F.col("place").alias("member"))
    return members.join(numbers, "class").select("source", "number", "member", "members"), classes


def mix(
    docs: DataFrame,
    weights: dict[str | None, float] | None = None,
    source: str = "source",
    block_docs: int = BLOCK_DOCS,
) -> DataFrame:
    """``doc_id, source, copy, block, slot, release, deadline, position``, a row per row.

    ``position`` is the row's place in the mix, from 0 without gaps; ``slot`` is its
    block's, ``release`` and ``deadline`` are the block's as slots of the whole mix.
    A source without a target weight gets its share of documents to the power of
    0.7.  Null is a source of its own.  No row is dropped or repeated: when a source
    is out, the others go on.  Rows with the same ``doc_id`` and source are placed one
    after another and told apart by ``copy``.  Other columns are not read.
    """
    rows, offsets = numbered(docs, source)
    sources, classes = classed(offsets.groupBy("source").agg(F.sum("size").alias("docs")), weights or {})
    sources = stored(sources.withColumnRenamed("source", "_source"), "members")
    # Joined with the buckets, as a source may have most of the rows.
    known = offsets.join(sources, offsets["source"].eqNullSafe(sources["_source"])).drop("_source")
    at = placed(rows, known).withColumn("block", F.expr(f"place div {block_docs}"))
    at = at.withColumn("nth", F.col("block") * F.col("members") + F.col("member"))
    position = (F.col("first_position") + F.col("place") % block_docs).alias("position")
    return at.join(schedule(docs.sparkSession, classes, block_docs), ["number", "nth"]).select(
        "doc_id", "source", "copy", "block", "slot", "release", "deadline", position
    )


def mixed_documents(docs: DataFrame, weights: dict[str | None, float] | None = None) -> DataFrame:
    """The rows of ``docs``, all columns, in the order of the mix.

    Ranges of positions become partitions, so the order holds over the files of a
    written table.  Copies of a row share its first position.
    """
    return on_plain_names(lambda plain: _mixed(plain, weights), docs)


def _mixed(docs: DataFrame, weights: dict[str | None, float] | None) -> DataFrame:
    order = mix(docs, weights).where("copy = 0")
    same = docs["doc_id"].eqNullSafe(order["doc_id"]) & docs["source"].cast("string").eqNullSafe(order["source"])
    # By a shuffle whatever the sizes, as positions grow with the documents.
    joined = docs.join(order.hint("merge"), same, "left")
    return joined.orderBy(order["position"]).select(*(docs[c] for c in docs.columns))
