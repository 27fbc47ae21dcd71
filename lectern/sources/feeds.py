"""Sources of semi-structured records: JSON lines, nested documents, licence responses, word files.

Malformed, cut and blank input gives no rows, never an error.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

ENTRY = "id string, title string, duration double, channel_id string, url string, _corrupt string"
RESPONSE = "items array<struct<id: string, status: struct<license: string>>>, _corrupt string"


def with_missing(df: DataFrame, columns: dict[str, str]) -> DataFrame:
    """``df`` with every named column; one it lacks is null of the given type."""
    return df.withColumns({c: F.lit(None).cast(kind) for c, kind in columns.items() if c not in df.columns})


def _parsed(df: DataFrame, text: str, schema: str) -> DataFrame:
    """``df`` with ``__r``, the record of each text that is whole JSON. It is generated, so that a
    text is parsed once however many fields are used."""
    record = F.from_json(F.col(text), schema, {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": "_corrupt"})
    whole = F.filter(F.array(record), lambda r: r.isNotNull() & r["_corrupt"].isNull())
    return df.select("*", F.explode(whole).alias("__r"))


def entries(raw: DataFrame) -> DataFrame:
    """``arrival, fetched_at`` and the fields of each line that is one whole JSON object with an id
    or a url: ``id, title, duration, channel_id, url``."""
    kept = _parsed(raw.where("line is not null and trim(line) <> ''"), "line", ENTRY)
    return kept.select("arrival", "fetched_at", *(F.col(f"__r.{c}").alias(c) for c in ("id", "title", "duration", "channel_id", "url"))).where(
        "id is not null or url is not null"
    )


def valid_entries(raw: DataFrame, id_length: int = 11) -> DataFrame:
    """Entries whose id has the right length; a missing or wrong id is taken from the end of the url."""
    got = entries(raw)
    fallback = F.element_at(F.split("url", "="), -1)
    video = F.when(F.length("id") == id_length, F.col("id")).otherwise(fallback)
    return got.withColumn("video_id", video).where(F.length("video_id") == id_length)


def response_items(responses: DataFrame) -> DataFrame:
    """``request_id, requested_at, video_id, licence`` of every item of a response that can be read;
    an item without a licence has 'unknown'."""
    kept = _parsed(responses.where("body is not null"), "body", RESPONSE).where("__r.items is not null")
    items = kept.select("request_id", "requested_at", F.explode("__r.items").alias("i")).where("i.id is not null")
    return items.select("request_id", "requested_at", F.col("i.id").alias("video_id"), F.coalesce("i.status.license", F.lit("unknown")).alias("licence"))


def scanned_licences(responses: DataFrame) -> DataFrame:
    """``request_id, video_id, licence`` for every requested id of a readable response; an id the
    response lacks is 'unavailable'. Of an id repeated in one response the smallest licence counts.

    What was asked and what was answered come from one parse of a response and meet in one aggregation."""
    readable = _parsed(responses.where("body is not null"), "body", RESPONSE).where("__r.items is not null")
    asked = F.transform(F.coalesce("requested_ids", F.array().cast("array<string>")), lambda v: F.struct(v.alias("video_id"), F.lit(None).cast("string").alias("licence"), F.lit(True).alias("asked")))
    told = F.transform("__r.items", lambda i: F.struct(i["id"].alias("video_id"), F.coalesce(i["status"]["license"], F.lit("unknown")).alias("licence"), F.lit(False).alias("asked")))
    both = readable.select("request_id", F.explode(F.concat(asked, told)).alias("e")).select("request_id", "e.*").where("video_id is not null")
    found = both.groupBy("request_id", "video_id").agg(F.min("licence").alias("licence"), F.bool_or("asked").alias("asked")).where("asked")
    return found.select("request_id", "video_id", F.coalesce("licence", F.lit("unavailable")).alias("licence"))


def visited(spark: SparkSession, path: str) -> DataFrame:
    """The words of text files, each once."""
    return spark.read.text(path).select(F.explode(F.split(F.trim("value"), r"\s+")).alias("word")).where("word <> ''").distinct()


def segments(df: DataFrame, key: str, text: str) -> DataFrame:
    """``key, position, segment`` of the lines of a text."""
    return df.where(F.col(text).isNotNull()).select(key, F.posexplode(F.split(text, "\n")).alias("position", "segment"))


def links(df: DataFrame, keys: list[str], text: str, pattern: str) -> DataFrame:
    """``keys, link`` for every match of the pattern's first group."""
    return df.select(*keys, F.explode(F.regexp_extract_all(F.col(text), F.lit(pattern), F.lit(1))).alias("link")).distinct()


#: The id of a playlist in an address.
PLAYLIST = r"(?:list=|/playlist\?list=)(PL[A-Za-z0-9_-]+)"


def playlists(df: DataFrame, keys: list[str], text: str, own: str) -> DataFrame:
    """``keys, link``: every playlist a text links to, and the record's own one, if its id begins with PL."""
    of_its_own = df.where(F.col(own).startswith("PL")).select(*keys, F.col(own).alias("link"))
    return links(df, keys, text, PLAYLIST).unionByName(of_its_own).distinct()
