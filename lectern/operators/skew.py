"""Per-key results where a few keys hold most rows.

Rows are range-partitioned on the composite of key, secondary order and a hash of the row's place,
with bounds from sampled quantiles, so a heavy key, and even one repeated pair of key and secondary
value, is spread over as many partitions as it needs and every partition has about the same number
of rows. Each partition reduces its sorted runs to one partial state a key; what straddles a
boundary is stitched from the first and last secondary value of the partials.
"""

from __future__ import annotations

from collections.abc import Iterator
from decimal import Decimal

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..session import cut

PARTIAL = "key string, n_rows long, n_distinct long, total long, first string, last string"
NAMES = ["key", "n_rows", "n_distinct", "total", "first", "last"]


def _differs(column: pa.Array) -> np.ndarray:
    """Whether each value but the first differs from the one before it; null is a value."""
    n = len(column)
    now, before = column.slice(1), column.slice(0, n - 1)
    either = pc.or_kleene(pc.not_equal(now, before), pc.xor(pc.is_null(now), pc.is_null(before)))
    return pc.fill_null(either, False).to_numpy(zero_copy_only=False)


def _runs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """One partial state of each key of a sorted partition; the last of a batch is held, as its run may
    go on in the next."""
    held: list | None = None
    for batch in batches:
        if not batch.num_rows:
            continue
        key, second = batch.column("key"), batch.column("second")
        new_key = np.concatenate([[True], _differs(key)])
        new_value = new_key | np.concatenate([[True], _differs(second)])
        known = second.is_valid().to_numpy(zero_copy_only=False)
        start = np.flatnonzero(new_key)
        end = np.append(start[1:], len(new_key)) - 1
        value = pc.fill_null(batch.column("value"), 0).to_numpy(zero_copy_only=False)
        rows = list(zip(
            key.take(pa.array(start)).to_pylist(), (end - start + 1).tolist(), np.add.reduceat((new_value & known).astype(np.int64), start).tolist(),
            np.add.reduceat(value.astype(np.int64), start).tolist(), second.take(pa.array(start)).to_pylist(), second.take(pa.array(end)).to_pylist(),
        ))
        if held is not None and held[0] == rows[0][0]:
            first = rows[0]
            again = first[4] is not None and first[4] == held[5]
            rows[0] = (held[0], held[1] + first[1], held[2] + first[2] - again, held[3] + first[3], held[4], first[5])
        elif held is not None:
            rows.insert(0, held)
        held = rows.pop()
        if rows:
            yield _partials(rows)
    if held is not None:
        yield _partials([held])


def _partials(rows: list[tuple]) -> pa.RecordBatch:
    kinds = [pa.string(), pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.string()]
    return pa.RecordBatch.from_arrays([pa.array(column, kind) for column, kind in zip(zip(*rows), kinds)], NAMES)


def shared_out(df: DataFrame, key: str, second: str, value: str, partitions: int) -> DataFrame:
    """``key, second, value`` in ranges of equal size. The third column of the order is a hash of a row's
    place in the input, which is the same if a task is run again."""
    slim = df.select(df[key].cast("string").alias("key"), df[second].cast("string").alias("second"), df[value].cast("long").alias("value"))
    placed = slim.withColumn("place", F.xxhash64(F.monotonically_increasing_id()))
    order = [F.col("key").asc_nulls_first(), F.col("second").asc_nulls_first()]
    return placed.repartitionByRange(partitions, *order, F.col("place")).drop("place").sortWithinPartitions(*order)


def per_key(df: DataFrame, key: str, second: str, value: str, partitions: int | None = None) -> DataFrame:
    """``key, n_rows, n_distinct, total`` of every key: its rows, distinct non-null ``second`` values
    and the sum of ``value`` (null adds 0).

    Keys count as stored: null and the empty string are keys of their own. A key with only null
    ``second`` values has 0 distinct ones. Ties and repeated rows need no order among themselves.
    An empty table gives no rows. Other columns are pruned, so clashing names do no harm.

    ``key`` and ``second`` are compared as strings. Per task the work is that of an equal share of
    the rows, however few keys hold them: the range bounds are quantiles of (key, second, place), so
    that rows of one key and one second value, or a null one, are shared out too. No task gathers
    more than one partial of each partition for a key.
    """
    spark = df.sparkSession
    n = partitions or int(spark.conf.get("spark.sql.shuffle.partitions"))
    partials = shared_out(df, key, second, value, n).mapInArrow(_runs, PARTIAL)
    # A partial is small: one for each key of each partition. Neighbouring partials of one key that
    # meet in one second value counted it twice.
    chain = Window.partitionBy("key").orderBy(F.col("first").asc_nulls_first(), F.col("last").asc_nulls_first())
    before = F.max("last").over(chain.rowsBetween(Window.unboundedPreceding, -1))
    stitched = partials.withColumn("again", (before == F.col("first")).cast("long"))
    return stitched.groupBy("key").agg(
        F.sum("n_rows").alias("n_rows"),
        (F.sum("n_distinct") - F.coalesce(F.sum("again"), F.lit(0))).alias("n_distinct"),
        F.sum("total").alias("total"),
    )


def heavy_keys(df: DataFrame, key: str, second: str, value: str, share: float) -> DataFrame:
    """The non-null, non-empty keys that at least ``share`` of all rows of ``df`` carry."""
    each = cut(per_key(df, key, second, value))  # one row a key, worked out once
    total = each.agg(F.sum("n_rows").alias("all_rows"))
    return each.join(F.broadcast(total), F.col("n_rows") >= F.col("all_rows") * F.lit(Decimal(str(share)))).where("key is not null and key <> ''")
