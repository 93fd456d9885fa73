"""Ranks and bounded, ordered arrays."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def ranked(df: DataFrame, group: str, order: list[Column], rank: str = "rank") -> DataFrame:
    """Number the rows of each group from 1; ``order`` must leave no ties."""
    return df.withColumn(rank, F.row_number().over(Window.partitionBy(group).orderBy(*order)))


def best(df: DataFrame, group: str, order: list[Column], n: int, rank: str = "rank") -> DataFrame:
    """The first ``n`` rows of each group, numbered.

    Spark cuts each group to ``n`` rows before the shuffle as well as after it
    (WindowGroupLimit), so a hot group never arrives whole at one task.
    """
    return ranked(df, group, order, rank).where(F.col(rank) <= n)


def by_group(df: DataFrame, group: str) -> DataFrame:
    """Rows laid out by ``group``, for wide rows to be gathered there.

    Gathering before the shuffle would join nothing where a group's rows come from
    everywhere.  The number of partitions is given: AQE would join them by their
    compressed bytes, of which wide rows take many times as much memory.
    """
    spark = df.sparkSession
    partitions = int(spark.conf.get("spark.sql.shuffle.partitions"))
    return df.repartition(max(partitions, 8 * spark.sparkContext.defaultParallelism), group)


def in_order(rank: str, *fields: str) -> Column:
    """Aggregate: the structs of ``fields``, by ascending ``rank``."""
    rows = F.sort_array(F.collect_list(F.struct(rank, *[f for f in fields if f != rank])))
    if len(fields) == 1:
        return F.transform(rows, lambda row: row[fields[0]])
    return F.transform(rows, lambda row: F.struct(*[row[f].alias(f) for f in fields]))


def at_least_one(name: str, value: int) -> int:
    if value < 1:
        raise ValueError(f"{name} must be at least 1, not {value}")
    return value
