"""Exact duplicates by a stream whose keyed state stays on disk.

A first stream takes each new file of a Parquet table once and logs its rows'
digests and content locators (batch, file, row): texts are hashed once and never
moved.  A second stream reads this log into RocksDB state, one entry for each digest
that never expires: the row that stays, the locator of the first content seen, and
the number of rows.  Spark sums before it shuffles, so a digest that a third of all
rows share reaches its state as one row per task.  The state, not a result of the
stream, is what verdicts are read from.

A digest seen before is a hit, and no proof: the contents of new hits are fetched by
their locators and compared byte for byte with the first content.  Digests whose
contents differ are set apart and their rows told apart by full text.

All tables lie in one folder and both streams have their checkpoints there, so a run
that broke off goes on where it stopped, and a run after new files came reads only
these.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from contextlib import contextmanager
from functools import reduce
from urllib.parse import unquote

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from basketflow.llm.common import shared_folder, stored, unused_path

#: Bytes of files that one step of the streams takes.
BATCH_BYTES = 64 << 30
#: Hex digits of SHA-256 that are the key of the state; fewer are for tests.
DIGEST_DIGITS = 64

#: Words of 64 rows that contents are fetched by at once: some 200 bytes each in every task.
WORDS = 1 << 18

#: Settings of Spark's state store.
STATE_SETTINGS = {
    "spark.sql.streaming.stateStore.providerClass": (
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
    ),
    "spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled": "true",
    # Else each of the many stores takes some megabytes of disk in advance.
    "spark.sql.streaming.stateStore.rocksdb.allowFAllocate": "false",
}
LOCATOR = ["batch", "file", "row"]


@contextmanager
def settings(spark: SparkSession, values: dict[str, str]) -> Iterator[None]:
    before = {name: spark.conf.get(name, None) for name in values}
    for name, value in values.items():
        spark.conf.set(name, value)
    try:
        yield
    finally:
        for name, value in before.items():
            spark.conf.unset(name) if value is None else spark.conf.set(name, value)


def as_pattern(path: str) -> str:
    """A pattern that only ``path`` fits: a stream takes a single file as a pattern only."""
    return f"{path[:-1]}[{path[-1]}]"


def as_literal(uri: str) -> str:
    """The path of a file's URI, with what would be read as a pattern escaped."""
    return re.sub(r"([\[\]{}*?\\])", r"\\\1", unquote(uri))


class StreamDedup:
    """The classes of equal texts of a growing Parquet table.

    ``source``: a Parquet file or folder with ``doc_id`` and ``text``; rows are only
    ever added to it, as new files.  ``folder``: where the state lives, the same for
    each run over one table.
    """

    def __init__(
        self,
        spark: SparkSession,
        source: str,
        folder: str,
        digits: int = DIGEST_DIGITS,
        batch_bytes: int = BATCH_BYTES,
        words: int = WORDS,
    ):
        self.spark, self.source, self.folder, self.batch_bytes = spark, source.rstrip("/"), folder.rstrip("/"), batch_bytes
        self.schema = spark.read.parquet(self.source).select("doc_id", "text").schema
        self.words = words
        self._repeated: DataFrame | None = None
        self.key_of = lambda digest: F.left(digest, F.lit(digits))
        self.key = self.key_of(F.col("text_sha256"))
        kind = self.schema["doc_id"].dataType.simpleString()
        self.log_schema = f"doc_id {kind}, text_sha256 string, file string, row long, batch long"

    def run(self) -> DataFrame:
        """Take in what is new, check it, and return the verdicts on all rows."""
        self.arrive()
        self.settle()
        self.verify()
        return self.verdicts()

    def _content(self) -> list:
        text = F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text")
        return [text, F.col("_metadata.file_path").alias("file"), F.col("_metadata.row_index").alias("row")]

    def arrive(self) -> None:
        """Log digest and locator of every row of the files that are new."""
        nothing = self.spark.createDataFrame([], self.log_schema)
        nothing.drop("batch").write.mode("ignore").parquet(f"{self.folder}/log/batch=-1")
        rows = (
            self.spark.readStream.schema(self.schema)
            .option("maxBytesPerTrigger", str(self.batch_bytes))
            .parquet(as_pattern(self.source))
            .select("doc_id", *self._content())
            .select("doc_id", F.sha2("text", 256).alias("text_sha256"), "file", "row")
        )

        def log(batch: DataFrame, number: int) -> None:
            # A batch that is run again replaces what it had logged.
            batch.write.mode("overwrite").parquet(f"{self.folder}/log/batch={number}")

        self._finish(rows.writeStream.foreachBatch(log), "arrive")

    def settle(self) -> None:
        """Bring the state up to the log."""
        logged = self.spark.readStream.schema(self.log_schema).parquet(f"{self.folder}/log")
        classes = logged.withColumn("key", self.key).groupBy("key").agg(
            F.max(F.struct("doc_id", *LOCATOR)).alias("last"),
            F.count(F.lit(1)).alias("size"),
            F.min(F.struct(*LOCATOR)).alias("first"),
        )
        with settings(self.spark, STATE_SETTINGS):
            self._finish(classes.writeStream.format("noop").outputMode("update"), "settle")
        self._repeated = None

    def _finish(self, writer, name: str) -> None:
        query = writer.option("checkpointLocation", f"{self.folder}/{name}").trigger(availableNow=True).start()
        query.awaitTermination()

    def log(self) -> DataFrame:
        return self.spark.read.schema(self.log_schema).parquet(f"{self.folder}/log")

    def state(self) -> DataFrame:
        """``key, keep, size, first`` of each digest, as the state store holds them.

        ``keep`` and ``first`` have the locators of the row that stays and of the
        content that hits are compared with; ``keep`` also has its ``doc_id``.
        """
        entries = self.spark.read.format("statestore").load(f"{self.folder}/settle")
        return entries.select(
            "key.key",
            F.col("value.max").alias("keep"),
            F.col("value.count").alias("size"),
            F.col("value.min").alias("first"),
        )

    def repeated(self) -> DataFrame:
        """The entries of digests that more than one row has, read from the state store once."""
        if self._repeated is None:
            with settings(self.spark, STATE_SETTINGS):
                self._repeated = stored(self.state().where("size > 1"), "dedup-repeated")
        return self._repeated

    def contents(self, wanted: DataFrame) -> DataFrame:
        """``key, text`` and locator (without batch) of each of ``wanted`` (locators), read by its locator.

        The rows wanted of a file are bits in words of 64 rows.  Files are read in blocks
        whose words are few enough to be sent to every task, so only the texts wanted
        leave the scan.  Of several blocks each is stored before the next is read.
        """
        word, bit = F.expr("row div 64"), F.expr("shiftleft(1L, cast(row % 64 AS INT))")
        words = stored(wanted.groupBy("file", word.alias("word")).agg(F.bit_or(bit).alias("bits")), "dedup-wanted")
        # One row for each file; Spark has a list of them in any case.
        counts = {r["file"]: r["count"] for r in words.groupBy("file").count().collect()}
        numbered, held = {}, 0
        for file, count in sorted(counts.items()):
            numbered[file] = held // self.words
            held += count
        block_of = self.spark.createDataFrame(list(numbered.items()), "file string, block long")
        placed = words.join(block_of, "file")
        found = []
        for block in sorted(set(numbered.values())):
            files = [file for file, own in numbered.items() if own == block]
            own = placed.where(F.col("block") == block).select("file", "word", "bits")
            if sum(counts[file] for file in files) <= 2 * self.words:
                own = F.broadcast(own)
            read = self.spark.read.schema(self.schema).parquet(*map(as_literal, files)).select(*self._content())
            marked = read.withColumn("word", word).join(own, ["file", "word"])
            marked = marked.where(F.getbit("bits", (F.col("row") % 64).cast("int")) == 1)
            texts = marked.select(self.key_of(F.sha2("text", 256)).alias("key"), "file", "row", "text")
            found.append(stored(texts, "dedup-contents") if held > self.words else texts)
        none = self.spark.createDataFrame([], "key string, file string, row long, text string")
        return reduce(DataFrame.union, found) if found else none

    def verify(self) -> None:
        """Compare the full bytes of hits that came since the last check.

        Each task drops what equals a content it has seen, so of a key's contents no
        more than one from each task meet, and all are equal if one is left.
        """
        checked = f"{self.folder}/checked"
        marker = self.spark.createDataFrame([(None,)], "key string")
        marker.write.mode("ignore").parquet(f"{checked}/upto=-1")
        since = self._checked().agg(F.max("upto")).first()[0]
        upto = self.log().agg(F.max("batch")).first()[0]
        if upto is None or upto <= since:
            return
        again = self.repeated().select("key", "first")
        new = self.log().where(F.col("batch") > since).select(self.key.alias("key"), *LOCATOR).join(again, "key")
        hits = stored(new, "dedup-hits")
        firsts = hits.select("first.*").where(F.col("batch") <= since).distinct()
        wanted = hits.select(*LOCATOR).union(firsts)
        contents = F.collect_set("text")
        unlike = self.contents(wanted).groupBy("key").agg(contents.alias("contents")).where("size(contents) > 1").select("key")
        marker.union(unlike).write.mode("overwrite").parquet(f"{checked}/upto={upto}")

    def _checked(self) -> DataFrame:
        return self.spark.read.schema("key string, upto long").parquet(f"{self.folder}/checked")

    def verdicts(self) -> DataFrame:
        """``doc_id, keep_id, group_size, kept, text_sha256`` and the locator, for every row logged.

        Of equal texts the row with the largest ``doc_id`` stays; a row without id only
        if none has one, and of rows with the same id the one that came last.
        """
        unlike = self._checked().where("key IS NOT NULL").select("key").distinct()
        stays = F.struct(*LOCATOR) == F.struct(*(F.col(f"keep.{name}") for name in LOCATOR))
        result = [
            "doc_id",
            F.coalesce(F.col("keep.doc_id"), F.col("doc_id")).alias("keep_id"),
            F.coalesce("size", F.lit(1)).cast("long").alias("group_size"),
            (F.col("keep").isNull() | stays).alias("kept"),
            "text_sha256",
            *LOCATOR,
        ]
        rows = self.log().withColumn("key", self.key)
        again = self.repeated().select("key", "keep", "size")
        if unlike.isEmpty():
            return rows.join(again, "key", "left").select(*result)
        apart = stored(rows.join(unlike, "key", "left_semi"), "dedup-apart")
        # A file belongs to one batch, so file and row tell rows apart.
        own = self.contents(apart).drop("key").join(apart, ["file", "row"])
        told = own.groupBy("key", "text").agg(
            F.max(F.struct("doc_id", *LOCATOR)).alias("keep"), F.count(F.lit(1)).alias("size")
        )
        alike = rows.join(unlike, "key", "left_anti").join(again, "key", "left")
        return alike.select(*result).union(own.join(told, ["key", "text"]).select(*result))


def exact_duplicates(spark: SparkSession, source: str, folder: str | None = None) -> DataFrame:
    """Verdicts on all rows of the Parquet table at ``source``; see ``StreamDedup.verdicts``.

    Null text is empty text, and empty texts are equal.  Very long texts are compared
    whole.  An empty table gives no rows.  Columns other than ``doc_id`` and ``text``
    are not read.  Without ``folder`` the state is a new one in the shared folder.
    """
    return StreamDedup(spark, source, folder or f"{shared_folder(spark)}/{unused_path('dedup')}").run()
