"""Hand-over between the jobs, and the stored results."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

SOURCE_ITEMS_SCHEMA = "user_id STRING, source_items ARRAY<STRING>"


def read_table(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(path)


def write_new(df: DataFrame, path: str) -> None:
    """Write Parquet; fails if there is something at ``path``."""
    df.write.mode("errorifexists").parquet(path)


def write_over(df: DataFrame, path: str) -> None:
    """Write Parquet in place of what is at ``path``."""
    df.write.mode("overwrite").parquet(path)


def write_json(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").json(path)


def source_item_lines(spark: SparkSession, path: str) -> DataFrame:
    """Source items kept as JSON lines: ``line, user_id, source_items, place, reason``.

    ``reason`` tells why a line gives no list: it is no object (blank lines are left
    out altogether) or names no user.  A list of the wrong type is an empty one, and
    entries without text are left out.  ``place`` orders lines by file and within it.
    """
    lines = spark.read.text(path).select(
        F.col("value").alias("line"),
        F.struct(
            F.col("_metadata.file_path").alias("file"),
            F.col("_metadata.file_block_start").alias("block"),
            F.monotonically_increasing_id().alias("number"),
        ).alias("place"),
    )
    fields = F.from_json("line", SOURCE_ITEMS_SCHEMA + ", _bad STRING", {"columnNameOfCorruptRecord": "_bad"})
    found = lines.where(F.trim("line") != "").withColumn("fields", fields)
    filled = F.filter("fields.source_items", lambda item: item.isNotNull() & (item != ""))
    user = F.nullif(F.col("fields.user_id"), F.lit(""))
    unread = F.col("fields._bad").isNotNull() | F.col("fields").isNull()
    reason = F.when(user.isNull(), F.when(unread, "no object").otherwise("no user"))
    return found.select(
        "line",
        user.alias("user_id"),
        F.coalesce(filled, F.array().cast("array<string>")).alias("source_items"),
        "place",
        reason.alias("reason"),
    )


def read_source_items_json(spark: SparkSession, path: str) -> DataFrame:
    """(user_id, source_items) of the lines that can be used, one list per user: the last."""
    usable = source_item_lines(spark, path).where("reason IS NULL")
    return usable.groupBy("user_id").agg(F.max_by("source_items", "place").alias("source_items"))


def rejected_source_items(spark: SparkSession, path: str) -> DataFrame:
    """(file, line, user_id, reason) of the lines that give no list, those that a later
    line of the same user replaces among them."""
    lines = source_item_lines(spark, path)
    usable = lines.where("reason IS NULL")
    last = usable.groupBy("user_id").agg(F.max("place").alias("last"))
    replaced = usable.join(last, "user_id").where(F.col("place") < F.col("last"))
    rejected = lines.where("reason IS NOT NULL").select("place.file", "line", "user_id", "reason")
    return rejected.unionByName(replaced.select("place.file", "line", "user_id", F.lit("replaced").alias("reason")))


def write_sorted(df: DataFrame, path: str, key: str) -> None:
    """Store a table for lookups by ``key``.

    Each file holds its own range of keys in order, so the statistics in the
    files let a lookup skip nearly all of them.
    """
    (
        df.repartitionByRange(key)
        .sortWithinPartitions(key)
        .write.mode("overwrite")
        .parquet(path)
    )


def write_numbered(values: DataFrame, path: str) -> None:
    """Store distinct ``item`` values in order, ranges of them sorted in many tasks."""
    values.select("item").distinct().repartitionByRange("item").sortWithinPartitions("item").write.parquet(path)


def read_numbered(spark: SparkSession, path: str) -> DataFrame:
    """(item, number) of a table by ``write_numbered``: the items' places in order, from 0.

    A number is the item's row in its file and the rows of the files before.
    """
    rows = spark.read.schema("item STRING").parquet(path).select(
        "item",
        F.regexp_extract(F.col("_metadata.file_name"), r"^part-(\d+)", 1).cast("int").alias("part"),
        F.col("_metadata.row_index").alias("row"),
    )
    # A row for each file; Spark has a list of them in any case.
    starts, before = [], 0
    for r in sorted(rows.groupBy("part").count().collect()):
        starts.append((r["part"], before))
        before += r["count"]
    if before >= 1 << 31:
        raise ValueError(f"{before} items, of which numbers would not fit")
    offsets = spark.createDataFrame(starts, "part INT, start BIGINT")
    number = (F.col("start") + F.col("row")).cast("int").alias("number")
    return rows.join(F.broadcast(offsets), "part").select("item", number)


def write_bucketed(df: DataFrame, table: str, path: str, key: str, buckets: int) -> None:
    """Store a table for joins by ``key``: later joins need not shuffle it."""
    (
        df.repartition(buckets, key)
        .write.mode("overwrite")
        .bucketBy(buckets, key)
        .sortBy(key)
        .option("path", path)
        .saveAsTable(table)
    )
