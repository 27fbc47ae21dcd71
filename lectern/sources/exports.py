"""The two exports of the queue: records of a fixed shape, in ordered shards, with a card."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import rules as R
from ..operators.summaries import distribution
from . import sinks

TRANSCRIPTS_A_FILE, QUEUE_A_FILE = 50_000, 500_000


def _text(name: str, *more: str, default: str = "") -> Column:
    return R.falsy_default(*(F.col(c) for c in (name, *more)), F.lit(default))


def _common() -> dict[str, Column]:
    return {
        "video_id": _text("video_id"), "title": _text("title"), "url": _text("url"),
        "duration_seconds": F.coalesce(F.col("duration_seconds").cast("bigint"), F.lit(0)),
        "priority": F.coalesce(F.nullif("priority", F.lit(0)), F.lit(5)), "source": _text("university", "course"),
    }


def transcript_records(videos: DataFrame) -> tuple[DataFrame, list[str]]:
    """Completed videos with a transcript, with the columns of their records; and the names of those."""
    more = {
        "text": F.col("transcript"), "speed_ratio": F.round(F.coalesce("speed_ratio", F.lit(0.0)), 1),
        "content_category": _text("content_category"), "license_risk": _text("license_risk"),
    }
    return _records(videos.where("status = 'completed' and transcript is not null"), _common() | more, ["completed_at"])


def queue_records(videos: DataFrame) -> tuple[DataFrame, list[str]]:
    """All videos with the columns of their records, and their names. Category and risk are there if the table has them."""
    optional = {"content_category": "unknown", "license_risk": "yellow"}
    more = {"status": _text("status")} | {c: _text(c, default=d) for c, d in optional.items() if c in videos.columns}
    return _records(videos, _common() | more, [])


def _records(rows: DataFrame, columns: dict[str, Column], order: list[str]) -> tuple[DataFrame, list[str]]:
    keys = [F.col(c).alias(f"__{c}") for c in ("priority", *order, "id")]
    return rows.select(*keys, *(c.alias(n) for n, c in columns.items())), list(columns)


def export_transcripts(videos: DataFrame, path: str, size: int = TRANSCRIPTS_A_FILE) -> dict:
    """Shards ordered by priority (high first, null last), completion and id, and a card with the totals, which
    are returned. An empty table writes a card only."""
    rows, names = transcript_records(videos)
    order = [F.desc_nulls_last("__priority"), F.asc_nulls_first("__completed_at"), F.col("__id")]
    ranked = sinks.write_json_shards(rows, names, order, size, path)
    held = ranked.agg(
        F.count(F.lit(1)).alias("n"), F.coalesce(F.sum(F.length("text")), F.lit(0)).alias("chars"), F.coalesce(F.sum("duration_seconds"), F.lit(0)).alias("seconds"),
    ).select("*", R.size_bucket(F.col("n")).alias("bucket")).first()
    stats = {
        "Videos": held["n"], "Characters": held["chars"], "Tokens, by characters": held["chars"] // 4, "Audio hours": held["seconds"] // 3600,
        "Files": -(-held["n"] // size),
    }
    sinks.write_text(videos.sparkSession, f"{path}/README.md", sinks.card("Transcripts of lecture videos", held["bucket"], stats, FIELDS, names, {}))
    return stats


def export_queue(videos: DataFrame, path: str, size: int = QUEUE_A_FILE) -> dict:
    """Shards ordered by priority (high first, null last) and id, and a card with the distributions of status,
    priority, category and risk; returns the totals."""
    rows, names = queue_records(videos)
    ranked = sinks.write_json_shards(rows, names, [F.desc_nulls_last("__priority"), F.col("__id")], size, path)
    held = ranked.agg(F.count(F.lit(1)).alias("n")).select("*", R.size_bucket(F.col("n")).alias("bucket")).first()
    tables = {}
    for title, column in (("Status", "status"), ("Priority", "priority"), ("Category", "content_category"), ("Risk", "license_risk")):
        if column in videos.columns:
            one = videos.withColumn(column, F.nullif(F.col(column).cast("string"), F.lit("")))
            # a column of few values; null and empty are one
            counted = [(r[column] or "null", r["n"], r["percent"]) for r in distribution(one, column).collect()]
            if column == "license_risk":
                counted = [(f"{MARKS.get(v, MARKS[None])} {v}", n, p) for v, n, p in counted]
            tables[title] = counted
    stats = {"Videos": held["n"], "Files": -(-held["n"] // size)}
    sinks.write_text(videos.sparkSession, f"{path}/README.md", sinks.card("Queue of lecture videos", held["bucket"], stats, FIELDS, names, tables))
    return stats


# The marks of the risks.
MARKS = {"green": "🟢", "yellow": "🟡", "orange": "🟠", "red": "🔴", None: "⚪"}

FIELDS = {
    "video_id": "id of the video", "title": "title", "text": "whole transcript", "url": "address", "duration_seconds": "length in seconds, 0 if unknown",
    "status": "state in the queue", "priority": "9 course, 8 teaching, 7 explaining, 5 other", "source": "where it was found, or its course",
    "speed_ratio": "seconds of audio transcribed a second", "content_category": "kind of content", "license_risk": "green, yellow, orange or red",
}
