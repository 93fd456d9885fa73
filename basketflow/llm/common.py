"""What the operators share: tables, intermediate storage, text batches."""

from __future__ import annotations

import gc
import uuid
from collections import Counter
from collections.abc import Callable, Iterable, Iterator
from contextlib import contextmanager

import pyarrow as pa
import pyarrow.compute  # noqa: F401  (pa.compute)
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shared_folder(spark: SparkSession) -> str:
    """The folder all machines share, from ``spark.checkpoint.dir``."""
    shared = spark.conf.get("spark.checkpoint.dir", None)
    if not shared:
        raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
    return shared.rstrip("/")


def unused_path(name: str) -> str:
    return f"{name}-{uuid.uuid4().hex}"


def stored_at(df: DataFrame, name: str) -> tuple[DataFrame, str]:
    """``df`` written to a new table in the shared folder, and read from there; its path."""
    spark = df.sparkSession
    path = f"{shared_folder(spark)}/{unused_path(name)}"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path), path


def stored(df: DataFrame, name: str) -> DataFrame:
    """The same without the path.

    Lost executors cost only the tasks that still read it; its files stay until
    the shared folder is cleared, as later plans read them.
    """
    return stored_at(df, name)[0]


def table_parts(written: DataFrame) -> DataFrame:
    """The rows of a stored table with ``_part`` (the task that wrote them) and ``_row`` (their place in its file)."""
    part = F.regexp_extract(F.col("_metadata.file_name"), r"^part-(\d+)", 1).cast("long")
    return written.select("*", part.alias("_part"), F.col("_metadata.row_index").alias("_row"))


#: The columns of documents that operators know by name.
KNOWN = ("doc_id", "text", "lang", "source", "n_chars")


def on_plain_names(
    work: Callable[[DataFrame], DataFrame], docs: DataFrame, known: Iterable[str] = KNOWN
) -> DataFrame:
    """``work(docs)``, where ``docs`` has its columns beside ``known`` under plain names.

    So no name, whatever characters are in it, clashes with those that ``work`` uses; the
    result has the columns' own names again.  Names that differ in case only are
    refused, as Spark's readers refuse them.
    """
    lower = Counter(c.lower() for c in docs.columns)
    if twice := sorted(c for c in docs.columns if lower[c.lower()] > 1):
        raise ValueError(f"columns whose names differ in case only: {', '.join(twice)}")
    names = {c if c in known else f"_column_{i}": c for i, c in enumerate(docs.columns)}
    found = work(docs.toDF(*names))
    return found.toDF(*(names.get(c, c) for c in found.columns))


def text_or_empty(docs: DataFrame, name: str = "text") -> Column:
    return F.coalesce(docs[name].cast("string"), F.lit(""))


def text_chunks(
    batches: Iterator[pa.RecordBatch], column: str, limit: int = 4 << 20
) -> Iterator[pa.RecordBatch]:
    """The batches in slices of about ``limit`` bytes of text, one row at least."""
    for batch in batches:
        if not batch.num_rows:
            continue
        values = batch.column(batch.schema.get_field_index(column))
        sizes = pa.compute.fill_null(pa.compute.binary_length(values), 0).to_pylist()
        start, held = 0, 0
        for row, size in enumerate(sizes):
            if held and held + size > limit:
                yield batch.slice(start, row - start)
                start, held = row, 0
            held += size
        yield batch.slice(start)


#: What a worker has made to work with last, and of what: one at a time, whatever the operator.
_MACHINE: list[tuple] = []


def one_machine(make: Callable) -> Callable:
    """``make``, whose result a worker keeps until it makes another, or works without one."""

    def kept(*parts):
        if not _MACHINE or _MACHINE[0][0] is not make or _MACHINE[0][1] != parts:
            _MACHINE.clear()
            _MACHINE.append((make, parts, make(*parts)))
        return _MACHINE[0][2]

    return kept


def without_machine() -> None:
    """Workers are used again by other stages, and large tables of tokens would stay in memory."""
    _MACHINE.clear()


@contextmanager
def no_cycles() -> Iterator[None]:
    """Without Python's search for cycles, for work that makes many small objects and none."""
    gc.disable()
    try:
        yield
    finally:
        gc.enable()
