"""Reading and writing the event log."""

from __future__ import annotations

from math import ceil

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from basketflow.operators.events import require_columns

# Event types a product reads; in the stored log each has a partition.
KINDS = ("view", "cart", "purchase")

#: Bytes that a writing task gets at least, tasks for each core at most.
WRITER_BYTES, WRITERS_PER_CORE = 8 << 20, 4
#: Bytes of a row group: a task reads one at least, and a file of the log has few columns.
ROW_GROUP = 4 << 20
#: What Spark takes for the size of rows that it knows nothing of, or more.
UNKNOWN_BYTES = 1 << 62


def read_events_csv(spark: SparkSession, path: str) -> DataFrame:
    """A raw CSV log: header, every column a string, doubled quotes in quotes.

    Columns are found by the names in the header, so their order is free, and
    nothing is inferred: ids stay as they are written, and there is no extra
    pass over the data.
    """
    log = (
        spark.read.option("header", True)
        .option("inferSchema", False)
        .option("quote", '"')
        .option("escape", '"')
        .csv(path)
    )
    return require_columns(log)


def write_events_csv(log: DataFrame, path: str) -> None:
    """A raw log in the form ``read_events_csv`` reads, blanks kept."""
    (
        log.write.option("header", True)
        .option("quote", '"')
        .option("escape", '"')
        .option("ignoreLeadingWhiteSpace", False)
        .option("ignoreTrailingWhiteSpace", False)
        .csv(path)
    )


def read_events(spark: SparkSession, path: str) -> DataFrame:
    """A raw log kept as Parquet."""
    return require_columns(spark.read.parquet(path))


def typed(log: DataFrame) -> DataFrame:
    """The log with its time and price as such; what cannot be read is NULL."""
    types = {"timestamp": "timestamp", "price": "double"}
    present = {name: F.col(name).try_cast(t) for name, t in types.items() if name in log.columns}
    return log.withColumns(present)


def _joined(events: DataFrame) -> DataFrame:
    """A log in few enough tasks for files of a good size: for each some megabytes at
    least, and a few tasks for each core at most.

    Splits of files are joined where they are.  Of other logs Spark does not know the size:
    where files were joined with each other, AQE has joined the partitions, and rows are not
    moved again; others are rebalanced by kind.
    """
    size = int(str(events._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))
    if size >= UNKNOWN_BYTES:
        return events if events.inputFiles() else events.hint("rebalance", "kind")
    most = WRITERS_PER_CORE * events.sparkSession.sparkContext.defaultParallelism
    return events.coalesce(max(1, min(ceil(size / WRITER_BYTES), most)))


def write_normalized(events: DataFrame, path: str) -> None:
    """Store the cleaned log once, for all products.

    Partitioned by kind of event: a product that needs purchases reads no others.
    The kinds are four at most, whatever types the log holds.  A task writes a file of
    each, so a log in files is not shuffled, but written by few tasks.
    """
    kind = F.when(F.col("event_type").isin(*KINDS), F.col("event_type")).otherwise("other")
    rows = _joined(events.withColumn("kind", kind)).write.mode("overwrite").option("parquet.block.size", str(ROW_GROUP))
    rows.partitionBy("kind").parquet(path)


def read_normalized(spark: SparkSession, path: str, *kinds: str) -> DataFrame:
    """The cleaned log, or only some kinds of its events."""
    events = spark.read.parquet(path)
    if kinds:
        events = events.where(F.col("kind").isin(*kinds))
    return events.drop("kind")
