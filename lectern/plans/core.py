"""Queries of the core operators: name -> function of (session, data directory)."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.skew import heavy_keys, per_key
from ..session import table
from . import catalog, oracle

#: A university that this share of all rows carries counts as heavy.
HEAVY_SHARE = 0.04


def p6_found(spark: SparkSession, sf: str) -> DataFrame:
    videos = table(spark, sf, "videos").select("university", "video_id", F.length("transcript").alias("chars"))
    return heavy_keys(videos, "university", "video_id", "chars", HEAVY_SHARE).select(F.col("key").alias("university"))


def p6_per_university(spark: SparkSession, sf: str) -> DataFrame:
    videos = table(spark, sf, "videos").select("university", "video_id", F.length("transcript").alias("chars"))
    return per_key(videos, "university", "video_id", "chars").select(
        F.col("key").alias("university"), "n_rows", F.col("n_distinct").alias("n_videos"), F.col("total").alias("transcript_chars")
    )


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    **catalog.QUERIES,
    "p6_found": p6_found,
    "p6_per_university": p6_per_university,
}

ORACLE: dict[str, str] = {
    **oracle.ORACLE,
    "p6_found": """
        SELECT university FROM videos WHERE university IS NOT NULL AND university <> '' GROUP BY university
        HAVING count(*) >= 0.04 * (SELECT count(*) FROM videos)""",
    "p6_per_university": """
        SELECT university, count(*) AS n_rows, count(DISTINCT video_id) AS n_videos,
               cast(coalesce(sum(length(transcript)), 0) AS bigint) AS transcript_chars
        FROM videos GROUP BY university""",
}
