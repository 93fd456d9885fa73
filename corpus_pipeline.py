"""From raw documents to token ids: rules, near duplicates, privacy, mix, tokens.

Each stage takes ``(spark, docs, sf_dir)`` and works on all that the stage before
it kept.  ``run`` writes each stage's rows as Parquet into the folder the cluster
shares, and the next stage reads them from there.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import wraps

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from basketflow.llm import bpe_codec, host_rules, minhash_join, mixing, surrogates
from basketflow.llm.common import on_plain_names, stored, table, text_or_empty
from basketflow.llm.queries import ENCODING_TOKENIZER, SURROGATE_KEY


Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def with_any_names(stage: Stage) -> Stage:
    """The stage for documents whose other columns may have any names."""

    @wraps(stage)
    def renamed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
        return on_plain_names(lambda plain: stage(spark, plain, sf_dir), docs)

    return renamed


def only(docs: DataFrame, verdicts: DataFrame) -> DataFrame:
    """The rows of ``docs`` whose ``doc_id`` is among the ``verdicts``.

    Null is an id like any other.  Spark splits the side of an id with very many rows.
    """
    ids = verdicts.select(F.col("doc_id").alias("_doc_id")).distinct()
    return docs.join(ids, docs["doc_id"].eqNullSafe(ids["_doc_id"]), "left_semi")


@with_any_names
def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that pass the base rules and come from a host that does, row by row."""
    return host_rules.accepted(docs)


@with_any_names
def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates: the one with the smallest id.

    Documents without words are linked with nothing and stay, and so do documents
    without an id whose text no other document has: one of each set of copies.
    """
    verdicts = minhash_join.verdicts(docs)
    named = only(docs.where("doc_id IS NOT NULL"), verdicts.where("kept AND doc_id IS NOT NULL"))
    # Null is the id of many documents, so these are told apart by row.
    nameless = stored(docs.where("doc_id IS NULL").withColumn("_row", F.monotonically_increasing_id()), "nameless")
    if nameless.isEmpty():
        return named
    rows = nameless.select(F.col("_row").alias("doc_id"), text_or_empty(nameless).alias("text"))
    sketched = stored(minhash_join.sketches(rows, minhash_join.WORDS).select("doc_id", "digest"), "nameless-sketches")
    first = sketched.where("digest IS NOT NULL").groupBy("digest").agg(F.min("doc_id").alias("_row"))
    alone = verdicts.where("kept AND doc_id IS NULL").select("digest").distinct()
    stay = first.join(alone, "digest", "left_semi").select("_row")
    stay = stay.union(sketched.where("digest IS NULL").select("doc_id"))
    return named.union(nameless.join(stay, "_row", "left_semi").select(*docs.columns))


@with_any_names
def privacy(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, with personal data replaced by surrogates, and their new length."""
    replaced = surrogates.replaced(docs, SURROGATE_KEY)
    if "n_chars" in docs.columns:
        changed = F.size("entities") > 0
        kind = docs.schema["n_chars"].dataType
        replaced = replaced.withColumn(
            "n_chars", F.when(changed, F.length("text").cast(kind)).otherwise(F.col("n_chars"))
        )
    return replaced.select(*docs.columns)


@with_any_names
def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents in the order of the mix of sources.

    In a written table, files by name and rows within them are in that order.
    """
    return mixing.mixed_documents(docs)


def positioned(spark: SparkSession, docs: DataFrame) -> DataFrame:
    """``position, doc_id, text`` of a written table's rows: files by part number, then rows."""
    rows = docs.select(
        "doc_id", "text", F.col("_metadata.file_name").alias("_file"), F.col("_metadata.row_index").alias("_row")
    )
    # One row a file, as Spark's own list of them on the driver.
    sizes = {r["_file"]: r["count"] for r in rows.groupBy("_file").count().collect()}
    part = lambda name: (int(name.split("-")[1]), name)
    offsets, before = [], 0
    for name in sorted(sizes, key=part):
        offsets.append((name, before))
        before += sizes[name]
    starts = spark.createDataFrame(offsets, "_file string, _start long")
    position = (F.col("_start") + F.col("_row")).alias("position")
    return rows.join(F.broadcast(starts), "_file").select(position, "doc_id", "text")


def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """``position, doc_id, n_tokens, ids`` of each document of the mix's table, in its order."""
    rows = positioned(spark, docs).orderBy("position")
    # The encoder hands the id on as it is, so the position travels in it.
    keyed = rows.select(F.struct("position", "doc_id").alias("doc_id"), "text")
    encoded = bpe_codec.encode(keyed, public_tokenizers.path(ENCODING_TOKENIZER))
    return encoded.select("doc_id.position", "doc_id.doc_id", F.size("ids").cast("long").alias("n_tokens"), "ids")


STAGES: list[tuple[str, Stage]] = [
    ("quality rules", quality),
    ("near duplicates", near_duplicates),
    ("privacy", privacy),
    ("mix", mix),
    ("tokens", tokens),
]

#: Surrogates and merges are beyond SQL; tests hold ``run`` against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the table ``documents``; the rows in the order of the mix."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = stored(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    # Files are not read in the order of their names.
    return docs.orderBy("position")
