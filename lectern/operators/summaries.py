"""Counts, shares, rollups and running totals."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import cut


def distribution(df: DataFrame, column: str, n: str = "n") -> DataFrame:
    """Rows by value, and their share of all rows in per cent, the most frequent first."""
    counted = df.groupBy(column).agg(F.count(F.lit(1)).alias(n))
    # one row a value of a small domain
    total = F.sum(n).over(Window.partitionBy(F.lit(1)))
    return counted.withColumn("percent", F.round(F.col(n).cast("double") * 100.0 / total.cast("double"), 4)).orderBy(F.desc(n), F.asc_nulls_last(column))


def running(df: DataFrame, group: str, order: list[str], value: str) -> DataFrame:
    """``df`` with ``seen`` and ``running_total``: the rows and the sum of ``value`` up to each row of its group.

    Rows are range-partitioned on group and order, so a group that holds most rows is spread over
    partitions; running values are taken within (partition, group) and raised by what the group's
    earlier partitions hold. The order must have no ties within a group. A null value adds nothing;
    a sum of nulls alone is null.
    """
    ranged = cut(df.repartitionByRange(*(F.asc_nulls_first(c) for c in [group, *order])).withColumn("__part", F.spark_partition_id()))
    held = ranged.groupBy("__part", group).agg(F.count(F.lit(1)).alias("__n"), F.sum(value).alias("__s"))
    earlier = Window.partitionBy(group).orderBy("__part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = held.select("__part", F.col(group).alias("__group"), F.coalesce(F.sum("__n").over(earlier), F.lit(0)).alias("__n"), F.sum("__s").over(earlier).alias("__s"))
    local = Window.partitionBy("__part", group).orderBy(*order).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    counted = ranged.withColumn("seen", F.count(F.lit(1)).over(local)).withColumn("running_total", F.sum(value).over(local))
    same = (counted["__part"] == offsets["__part"]) & counted[group].eqNullSafe(offsets["__group"])
    total = F.when(offsets["__s"].isNull(), F.col("running_total")).otherwise(offsets["__s"] + F.coalesce("running_total", F.lit(0)))
    return counted.join(offsets, same).select(*(counted[c] for c in df.columns), (F.col("seen") + offsets["__n"]).alias("seen"), total.alias("running_total"))


def share_above(df: DataFrame, group: str, flag: Column, total: str, hits: str) -> DataFrame:
    return df.groupBy(group).agg(F.count(F.lit(1)).alias(total), F.sum(flag.cast("long")).alias(hits))
