"""Keyed changes of a table: insert if absent, merge by key, state transitions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def _names(key: str | list[str]) -> list[str]:
    return [key] if isinstance(key, str) else key


def first_by_key(df: DataFrame, key: str | list[str], order: str) -> DataFrame:
    """The row of the smallest ``order`` for each key: one aggregation with map-side combining. Rows with a
    null in the key have none."""
    keys = _names(key)
    rest = [c for c in df.columns if c not in (*keys, order)]
    best = F.min(F.struct(order, *rest)).alias("__r")
    return df.dropna(subset=keys).groupBy(*keys).agg(best).select(*keys, f"__r.{order}", *(f"__r.{c}" for c in rest))


def insert_absent(new: DataFrame, table: DataFrame, key: str | list[str], order: str) -> DataFrame:
    """Rows of ``new`` to append: keys that ``table`` lacks, the first arrival of each."""
    keys = _names(key)
    return first_by_key(new.join(table.select(*keys), keys, "left_anti"), keys, order)


def merge(table: DataFrame, update: DataFrame, key: str, changes: dict[str, Column]) -> DataFrame:
    """``table`` with ``changes`` (over its columns and those of ``update``) where ``update`` has the key.
    ``update`` must have a key once; its other columns must not clash."""
    marked = table.join(update.withColumn("__hit", F.lit(True)), key, "left")
    hit = F.coalesce("__hit", F.lit(False))
    return marked.select(*(F.when(hit, changes[c]).otherwise(F.col(c)).alias(c) if c in changes else F.col(c) for c in table.columns))


def release_stale(table: DataFrame, now: Column, minutes: int) -> DataFrame:
    """Rows in processing for longer than ``minutes`` are pending again; the start time stays."""
    stale = (F.col("status") == "processing") & (F.col("processing_started_at") < now - F.expr(f"interval {minutes} minutes"))
    return table.withColumn("status", F.when(F.coalesce(stale, F.lit(False)), "pending").otherwise(F.col("status")))
