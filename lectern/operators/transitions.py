"""What happens to rows of the queue, as tables in and changed rows out."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import rules as R

#: Characters kept of an error and of a description.
ERROR_CHARS, DESCRIPTION_CHARS = 500, 5000
#: Written where a description could not be had, so that it is not asked for again.
UNAVAILABLE = "[unavailable]"


def or_else(first: DataFrame, second: DataFrame) -> DataFrame:
    """``first``, or ``second`` if that has no row. Both have the same columns."""
    some = first.limit(1).select(F.lit(1).alias("__some"))
    rest = second.withColumn("__one", F.lit(1)).join(F.broadcast(some), F.col("__one") == F.col("__some"), "left_anti").drop("__one")
    return first.unionByName(rest)


def claimed(queue: DataFrame, ids: DataFrame, key: str, now: Column) -> DataFrame:
    """The rows of ``queue`` whose ``key`` is among ``ids``, in processing since ``now``. Ids may repeat."""
    taken = queue.join(ids.select(key), key, "left_semi")
    return taken.withColumns({"status": F.lit("processing"), "processing_started_at": now})


def finished(queue: DataFrame, results: DataFrame, key: str, now: Column) -> DataFrame:
    """The rows of ``queue`` that ``results`` (``key`` once, ``text, probed_seconds, seconds, failure``) ends.

    A failure, a recording under five seconds and a blank text end in ``error``, the error cut to
    500 characters; all else is ``completed`` with its metrics. The recording was sped up, so its own
    length is 1.2 times the probed one. No result, no row.
    """
    slim = results.select(key, F.trim("text").alias("__text"), (F.col("probed_seconds") * 1.2).alias("__length"), F.col("seconds").alias("__seconds"), F.col("failure").alias("__failure"))
    rows = queue.join(slim, key)
    wrong = R.outcome(F.col("__failure"), F.col("__length"), F.col("__text"))
    error = F.when(F.col("__failure").isNotNull(), F.col("__failure")).when(wrong != "completed", wrong)
    rows = rows.withColumn("__error", F.substring(error, 1, ERROR_CHARS))
    good = F.col("__error").isNull()
    keep = lambda new, old: F.when(good, new).otherwise(F.col(old))
    return rows.withColumns(
        {
            "status": F.when(good, "completed").otherwise("error"), "error": F.coalesce("__error", "error"),
            "transcript": keep(F.col("__text"), "transcript"), "duration_seconds": keep(F.col("__length"), "duration_seconds"),
            "processing_time_seconds": keep(F.col("__seconds"), "processing_time_seconds"),
            "speed_ratio": keep(R.speed(F.col("__length"), F.col("__seconds")), "speed_ratio"), "completed_at": keep(now, "completed_at"),
        }
    ).select(*queue.columns)


def described(queue: DataFrame, fetched: DataFrame, key: str) -> DataFrame:
    """The rows of ``queue`` that a fetch of descriptions (``key`` once, ``text, licence, ok``) touches.

    One that failed, or gave no text, marks an empty description as unavailable and leaves any other.
    A free licence, by its name or by the wording of the text, sets the licence and turns the risk
    green; any other sets the licence only.
    """
    slim = fetched.select(key, F.col("text").alias("__text"), F.col("licence").alias("__licence"), (F.col("ok") & F.col("text").isNotNull()).alias("__ok"))
    ok, text, licence = F.coalesce("__ok", F.lit(False)), F.col("__text"), F.col("__licence")
    empty = F.coalesce(F.col("description") == "", F.lit(True))
    free = R.free_licence(text, licence).isNotNull()
    return (
        queue.join(slim, key)
        .withColumns(
            {
                "description": F.when(ok, F.substring(text, 1, DESCRIPTION_CHARS)).when(empty, UNAVAILABLE).otherwise(F.col("description")),
                "youtube_license": F.when(ok, R.licence_note(text, licence)).otherwise(F.col("youtube_license")),
                "license_risk": F.when(ok & free, "green").otherwise(F.col("license_risk")),
            }
        )
        .select(*queue.columns)
    )
