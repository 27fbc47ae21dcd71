"""Ranks, shards and samples without a single-task sort."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import cut


def global_rank(df: DataFrame, order: list[Column], out: str = "rank") -> DataFrame:
    """``df`` with its place from 1 in a total order.

    Rows are range-partitioned by the order and ranked within their partition; a partition's offset
    is the number of rows before it. The order must have no ties for the ranks to be determined. The
    row counts, one a partition, are broadcast.
    """
    ranged = cut(df.repartitionByRange(*order).withColumn("__part", F.spark_partition_id()))
    counts = ranged.groupBy("__part").count()
    before = F.sum("count").over(Window.orderBy("__part").rowsBetween(Window.unboundedPreceding, -1))
    offsets = counts.select("__part", F.coalesce(before, F.lit(0)).alias("__before"))
    local = F.row_number().over(Window.partitionBy("__part").orderBy(*order))
    return ranged.join(F.broadcast(offsets), "__part").withColumn(out, F.col("__before") + local).drop("__part", "__before")


def sharded(df: DataFrame, order: list[Column], size: int) -> DataFrame:
    """``df`` with ``shard`` from 0, ``size`` rows each in order."""
    return global_rank(df, order, "__rank").withColumn("shard", F.floor((F.col("__rank") - 1) / size)).drop("__rank")


def first_per_group(df: DataFrame, group: list[str], order: list[Column], n: int) -> DataFrame:
    """The first ``n`` rows of each group; Spark prunes each partition to ``n`` a group before the shuffle."""
    rank = F.row_number().over(Window.partitionBy(*group).orderBy(*order))
    return df.withColumn("__rank", rank).where(F.col("__rank") <= n).drop("__rank")


def sample_buckets(df: DataFrame, buckets: dict[str, tuple[Column, int]], key: str, order: list[Column]) -> DataFrame:
    """Quota sampling from overlapping buckets: ``key, bucket``, the first bucket of a key that is
    taken from several. Each bucket is a top-k, which never shuffles more than k rows a task."""
    parts = None
    for number, (condition, quota) in enumerate(buckets.values()):
        one = df.where(condition).orderBy(*order).limit(quota).select(key, F.lit(number).alias("__n"))
        parts = one if parts is None else parts.unionByName(one)
    names = F.array(*(F.lit(name) for name in buckets))
    return parts.groupBy(key).agg(F.min("__n").alias("__n")).select(key, names[F.col("__n")].alias("bucket"))
