"""Harmonic packing: items into containers of fixed capacity.

Lengths fall into classes bounded by the reciprocals ``capacity / k`` and by steps between them, so
that the members of a class differ by about one per cent at most. A class alone fills containers
with a fixed count of items, as harmonic packing does; the space left beside them is given to fixed
counts of smaller classes. Both counts follow from the class bounds alone, so the plan needs only
the number of items in each class (some hundred numbers, whatever the corpus), and the workers then
fill the containers independently, by the rank of an item in its class.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..session import cut

#: Lengths further apart than this ratio never share a class.
STEP = 1.01
#: Ranks within a class are taken in parts of about so many items, so a class that holds most is shared out.
PART_ROWS = 50_000


def class_bounds(capacity: int, step: float = STEP) -> np.ndarray:
    """Upper bounds of the classes, rising: whole parts of ``capacity / k``, and steps between."""
    bounds = set((capacity // np.arange(1, capacity + 1)).tolist())
    at = float(capacity)
    while at >= 1:
        bounds.add(int(at))
        at = min(at / step, int(at) - 1)
    return np.array(sorted(bounds), np.int64)


def plan(capacity: int, bounds: np.ndarray, counts: np.ndarray) -> list[tuple[int, int, int, int, int]]:
    """Which ranks of each class go to which containers: rows of class, first rank, rank after the
    last, items a container, first container.

    The longest class left opens containers with as many of its items as its bound allows; each
    smaller class adds the fixed count that its bound still allows. A pattern repeats until one of
    its classes runs out, so a class takes part in few patterns.
    """
    left, used = [int(c) for c in counts], [0] * len(counts)
    bound = [int(b) for b in bounds]
    rows, container = [], 1
    present = [k for k in range(len(left) - 1, -1, -1) if left[k]]
    while present:
        room, pattern = capacity, []
        for k in present:
            if n := min(room // bound[k], left[k]):
                pattern.append((k, n))
                room -= n * bound[k]
                if not room:
                    break
        times = min(left[k] // n for k, n in pattern)
        for k, n in pattern:
            rows.append((k, used[k], used[k] + n * times, n, container))
            used[k] += n * times
            left[k] -= n * times
        container += times
        present = [k for k in present if left[k]]
    return rows


def pack(items: DataFrame, item: str, size: str, capacities: dict[int, int]) -> DataFrame:
    """``target_id, <item>, piece_no, piece_size, container_no`` for every item and target.

    An item longer than the capacity is split into full containers and a rest, which is packed like
    any item; no other item is split. An item of null or no length takes no room: it gets one piece
    of size 0 in container 1. Each row is an item, also where an ``item`` value is repeated or null.
    Containers are numbered from 1 for each target. No items, no rows.

    Only pieces (key, length) are shuffled, once, by the keys that rank them and join the offsets. A
    class is ranked in as many parts as its size asks for; items without an id are told apart by
    their place, so they share no part because of that.
    Class counts, bounded by the classes of the targets, go to the driver; the class table and the
    plan have that bound too and are broadcast.
    """
    spark = items.sparkSession
    bounds = {t: class_bounds(c) for t, c in capacities.items()}
    target = F.explode(F.array(*(F.struct(F.lit(int(t)).alias("t"), F.lit(int(c)).cast("long").alias("c")) for t, c in capacities.items())))
    sized = items.select(F.col(item), F.greatest(F.coalesce(F.col(size).cast("long"), F.lit(0)), F.lit(0)).alias("__n"))
    pieces = (
        sized.select(item, "__n", target.alias("__t"))
        .select(F.col("__t.t").alias("target_id"), F.col("__t.c").alias("__cap"), item, "__n")
        .select("*", F.explode(F.expr("sequence(1, cast(greatest(ceil(__n / __cap), 1) as int))")).alias("piece_no"))
        .select("target_id", item, "piece_no", F.expr("least(__cap, __n - (piece_no - 1) * __cap)").alias("piece_size"))
    )
    classes = spark.createDataFrame(
        [(int(t), s, int(k)) for t, b in bounds.items() for s, k in enumerate(np.searchsorted(b, np.arange(int(b[-1]) + 1)))],
        "target_id int, piece_size long, __class int",
    )
    place = F.when(F.col(item).isNull(), F.monotonically_increasing_id()).otherwise(0)
    placed = cut(pieces.join(F.broadcast(classes), ["target_id", "piece_size"]).withColumn("__place", place))

    solid = placed.where("piece_size > 0")
    counts, parts = {t: np.zeros(len(b), np.int64) for t, b in bounds.items()}, []
    for row in solid.groupBy("target_id", "__class").count().collect():
        counts[row["target_id"]][row["__class"]] = row["count"]
        parts.append((row["target_id"], row["__class"], -(-row["count"] // PART_ROWS)))
    divided = F.broadcast(spark.createDataFrame(parts, "target_id int, __class int, __parts long"))
    part = F.pmod(F.xxhash64(item, "piece_no", "piece_size", "__place"), F.col("__parts")).alias("__part")
    solid = solid.join(divided, ["target_id", "__class"]).select(*solid.columns, part)
    by_part = solid.groupBy("target_id", "__class", "__part").count()
    earlier = Window.partitionBy("target_id", "__class").orderBy("__part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = by_part.select("target_id", "__class", "__part", F.coalesce(F.sum("count").over(earlier), F.lit(0)).alias("__before"))
    rows = [(int(t), *row) for t, b in bounds.items() for row in plan(int(capacities[t]), b, counts[t])]
    planned = spark.createDataFrame(rows, "target_id int, __class int, __from long, __to long, __each long, __first long")

    order = Window.partitionBy("target_id", "__class", "__part").orderBy(item, "piece_no", "piece_size", "__place")
    ranked = (
        solid.withColumn("__row", F.row_number().over(order))
        .join(offsets, ["target_id", "__class", "__part"])
        .withColumn("__rank", F.col("__before") + F.col("__row") - 1)
    )
    filled = ranked.join(F.broadcast(planned), ["target_id", "__class"]).where("__rank >= __from and __rank < __to")
    columns = ["target_id", item, "piece_no", "piece_size"]
    packed = filled.select(*columns, F.expr("__first + (__rank - __from) div __each").alias("container_no"))
    return packed.unionByName(placed.where("piece_size = 0").select(*columns, F.lit(1).cast("long").alias("container_no")))
