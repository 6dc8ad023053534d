"""First rows of every group, safe for groups of any size."""

from __future__ import annotations

from collections.abc import Sequence
from math import isqrt

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

SLICES = 32


def top_rows(rows: DataFrame, group: Sequence[str], order: Sequence[Column], n: int,
             rank: str = "rank") -> DataFrame:
    """Rows ranked 1 to ``n`` by ``order`` within each group.

    ``row_number() <= n`` makes Spark drop rows beyond ``n`` in every task
    before the exchange, so a group sends at most ``n`` rows per task. With
    many thousands of tasks and few groups (a year has one) that is still a lot
    for one reducer, so the tasks are divided into slices: each slice of a
    group is ranked first and only the slice winners meet. A slice is a set of
    whole tasks, so slicing does not weaken the pruning before the exchange,
    and any slicing gives the same result.

    Above ``spark.sql.optimizer.windowGroupLimitThreshold`` Spark does not
    prune before the exchange; then the first round uses as many slices as
    there are shuffle partitions and a second round reduces them.

    ``order`` must be total within a group for a repeatable result.
    """
    for slices in _rounds(rows, n):
        part = F.pmod(F.spark_partition_id(), F.lit(slices))
        rows = _ranked(rows.withColumn("_slice", part), [*group, "_slice"], order, n, rank)
        rows = rows.drop("_slice", rank)
    return _ranked(rows, group, order, n, rank)


def _ranked(rows: DataFrame, group: Sequence[str], order: Sequence[Column], n: int,
            rank: str) -> DataFrame:
    window = Window.partitionBy(*group).orderBy(*order)
    return rows.withColumn(rank, F.row_number().over(window)).filter(F.col(rank) <= n)


def _rounds(rows: DataFrame, n: int) -> list[int]:
    conf = rows.sparkSession.conf
    if n <= int(conf.get("spark.sql.optimizer.windowGroupLimitThreshold")):
        return [SLICES]
    partitions = int(conf.get("spark.sql.shuffle.partitions"))
    return [max(partitions, SLICES), isqrt(max(partitions, SLICES))]
