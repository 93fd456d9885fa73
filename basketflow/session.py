"""Spark settings for the jobs."""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager
from math import ceil

from pyspark.sql import SparkSession

MIB = 1024 * 1024


#: What products shuffle, of the bytes of the raw log: a few short columns of it.
SHUFFLED_SHARE = 0.05
#: More shuffle partitions than this cost the driver more than they save the tasks.
MOST_PARTITIONS = 20_000
#: Shuffled bytes that one task of a job gets of partitions joined together, at most.
#: Short rows take some 20 times as much memory where they are sorted.
TASK_BYTES = 16 * MIB
ADVISORY = "spark.sql.adaptive.advisoryPartitionSizeInBytes"


def settings(input_bytes: int, cores: int, partition_bytes: int = 192 * MIB) -> dict[str, str]:
    """Settings for a run over ``input_bytes`` of raw log on ``cores`` cores.

    Shuffles start from enough partitions for what is shuffled, so that none has
    to spill much, up to a bound; AQE joins the small ones together afterwards.
    """
    wanted = min(ceil(SHUFFLED_SHARE * input_bytes / partition_bytes), MOST_PARTITIONS)
    partitions = max(2 * cores, wanted)
    return {
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        # Short rows may stand for much work: keep tasks for all cores.
        "spark.sql.adaptive.coalescePartitions.minPartitionSize": "64k",
        "spark.sql.shuffle.partitions": str(partitions),
        "spark.sql.files.maxPartitionBytes": str(partition_bytes),
        # Small inputs are split for all cores too.
        "spark.sql.files.openCostInBytes": str(MIB),
        "spark.sql.session.timeZone": "UTC",
        "spark.ui.enabled": "false",
    }


def build_session(app: str, conf: dict[str, str], master: str | None = None) -> SparkSession:
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for name, value in conf.items():
        builder = builder.config(name, value)
    return builder.getOrCreate()


@contextmanager
def small_tasks(spark: SparkSession, size: int = TASK_BYTES) -> Iterator[None]:
    """Within, AQE joins shuffle partitions up to ``size`` bytes, or fewer if the session says so."""
    given = spark.conf.get(ADVISORY, None)
    allowed = spark._jvm.org.apache.spark.network.util.JavaUtils.byteStringAsBytes(spark.conf.get(ADVISORY))
    spark.conf.set(ADVISORY, str(min(size, allowed)))
    try:
        yield
    finally:
        if given is None:
            spark.conf.unset(ADVISORY)
        else:
            spark.conf.set(ADVISORY, given)
