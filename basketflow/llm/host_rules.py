"""Quality rules of documents, and of the hosts they come from.

Each text is measured once, in a narrow pass over its UTF-8 bytes; only the small
measures go on.  They are stored, then summed per host (``source``), with partial
sums before the shuffle, so that a host with a third of all rows is a few rows per
task.  Hosts' failure rates are shrunk towards the corpus by a beta prior fitted to
the hosts themselves, and the verdicts join back to the stored measures; Spark
splits a host that is too large for one task of that join.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import BooleanType

from basketflow.llm.common import KNOWN, on_plain_names, stored, text_chunks, text_or_empty, without_machine

#: The characters that count as symbols.
SYMBOLS = b"#*$%&|<>"
BLANKS = b" \t\n\v\f\r"
CONTINUATIONS = bytes(range(0x80, 0xC0))

#: Base rules: a document fails with fewer words, or with more words (in percent)
#: in repeated windows.
MIN_WORDS, MAX_REPEATED = 50, 50
#: A host fails if its shrunk failure rate is above this.
MAX_HOST_RATE = 0.5
#: Prior weight, in documents, where the hosts' rates do not tell: all equal, or
#: spread as wide as can be.
EQUAL_HOSTS_WEIGHT, WIDEST_WEIGHT = 100.0, 0.1

MEASURES = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]


def repeated_words(words: list[bytes]) -> int:
    """Words that lie in a window of three which is found twice or more."""
    if len(words) < 4:
        return 0
    number: dict[bytes, int] = {}
    ids = np.fromiter((number.setdefault(w, len(number)) for w in words), np.int64, len(words))
    if len(number) == len(words):
        return 0
    pairs = np.unique(ids[:-1] * len(number) + ids[1:], return_inverse=True)[1]
    _, window, times = np.unique(pairs[:-1] * len(number) + ids[2:], return_inverse=True, return_counts=True)
    again = times[window] > 1
    covered = np.zeros(len(words), bool)
    for place in range(3):
        covered[place : place + len(again)] |= again
    return int(covered.sum())


def repeated_lines(text: bytes) -> int:
    """Lines with a word that equal an earlier line."""
    lines = [line for line in text.split(b"\n") if line.strip(BLANKS)]
    return len(lines) - len(set(lines))


def measure(text: bytes) -> tuple[int, int, int, int, int]:
    words = text.split()
    return (
        len(words),
        len(text.translate(None, BLANKS + CONTINUATIONS)),
        len(text) - len(text.translate(None, SYMBOLS)),
        repeated_lines(text),
        repeated_words(words),
    )


def measures(docs: DataFrame, host: str = "source") -> DataFrame:
    """``doc_id``, ``host``, the measures and ``base_failed``, one row per row of ``docs``."""

    def measured(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        without_machine()
        for batch in text_chunks(batches, "text"):
            rows = [measure(text) for text in batch.column("text").cast(pa.binary()).to_pylist()]
            columns = [pa.array(c, pa.int64()) for c in zip(*rows, strict=True)]
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), batch.column("host"), *columns], names=["doc_id", "host", *MEASURES]
            )

    kind = docs.schema["doc_id"].dataType.simpleString()
    schema = f"doc_id {kind}, host string, " + ", ".join(f"{name} long" for name in MEASURES)
    rows = docs.select(F.col("doc_id"), F.col(host).cast("string").alias("host"), text_or_empty(docs).alias("text"))
    failed = (F.col("n_words") < MIN_WORDS) | (100 * F.col("n_repeat_words") > MAX_REPEATED * F.col("n_words"))
    return rows.mapInArrow(measured, schema).withColumn("base_failed", failed)


def host_rates(measured: DataFrame) -> DataFrame:
    """``host, n_docs, n_failed, rate`` with the rate shrunk towards the corpus.

    The prior's mean is the corpus rate m and its weight (alpha + beta) follows from
    the variance v of the hosts' own rates: m (1 - m) / v - 1.
    """
    hosts = (
        measured.where(F.col("host").isNotNull())
        .groupBy("host")
        .agg(F.count("*").alias("n_docs"), F.sum(F.col("base_failed").cast("long")).alias("n_failed"))
    )
    moments = hosts.agg(
        (F.sum("n_failed") / F.sum("n_docs")).alias("mean"),
        F.var_pop(F.col("n_failed") / F.col("n_docs")).alias("spread"),
    ).first()
    mean, spread = moments["mean"] or 0.0, moments["spread"]
    weight = max(mean * (1 - mean) / spread - 1, WIDEST_WEIGHT) if spread else EQUAL_HOSTS_WEIGHT
    rate = (F.col("n_failed") + mean * weight) / (F.col("n_docs") + weight)
    return hosts.withColumn("rate", rate)


def bad_hosts(measured: DataFrame, max_rate: float = MAX_HOST_RATE) -> DataFrame:
    """``host`` of the hosts that fail."""
    return host_rates(measured).where(F.col("rate") > max_rate).select("host")


def accepted(docs: DataFrame, host: str = "source", max_rate: float = MAX_HOST_RATE) -> DataFrame:
    """The rows of ``docs`` that ``judge`` keeps, all columns.

    The texts do not move: they are measured once for the hosts and once more where
    they are, and only the failed hosts, stored so that Spark knows their size, are
    joined to them.  Rows are judged one by one, whatever their ``doc_id``.
    """
    return on_plain_names(lambda plain: _accepted(plain, host, max_rate), docs, (*KNOWN, host))


def _accepted(docs: DataFrame, host: str, max_rate: float) -> DataFrame:
    bad = stored(bad_hosts(stored(measures(docs, host), "measures"), max_rate), "bad-hosts")

    @F.pandas_udf(BooleanType())
    def passes(texts: pd.Series) -> pd.Series:
        found = []
        for text in texts:
            n_words, *_, repeated = measure(text.encode("utf-8"))
            found.append(n_words >= MIN_WORDS and 100 * repeated <= MAX_REPEATED * n_words)
        return pd.Series(found, dtype=bool)

    good = docs.where(passes(text_or_empty(docs)))
    return good.join(bad, docs[host].cast("string") == bad["host"], "left_anti").select(*(docs[c] for c in docs.columns))


def judge(docs: DataFrame, host: str = "source", max_rate: float = MAX_HOST_RATE) -> DataFrame:
    """``doc_id``, the measures, ``base_failed`` and ``kept``, one row per row of ``docs``.

    ``kept`` is false if the document fails a base rule, else the verdict on its
    host.  Null and empty texts have no words and fail.  A null host has no
    verdict: its documents stand for themselves.  Repeated rows are judged alike
    and all count for their host.  Columns other than ``doc_id``, the text and the
    host are not read.
    """
    measured = stored(measures(docs, host), "measures")
    bad = bad_hosts(measured, max_rate).withColumn("host_failed", F.lit(True))
    return measured.join(bad, "host", "left").select(
        "doc_id",
        *MEASURES,
        "base_failed",
        (~F.col("base_failed") & F.col("host_failed").isNull()).alias("kept"),
    )
