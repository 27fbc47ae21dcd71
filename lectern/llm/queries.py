"""The queries of the training-data operators, over whole tables with production parameters."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import spread, table
from . import language, reading, samples, spam, subjects
from .budget import text_counts, token_budget
from .near_duplicates import Duplicates
from .oracle import ORACLE
from .packing import pack
from .tokens import with_counts, with_ids


def _scan(spark: SparkSession, sf: str, name: str, *columns: str) -> DataFrame:
    """Columns of a table for Python workers, on all cores also where the table is one small file."""
    return spread(table(spark, sf, name).select(*columns))


#: Likeness from which on two videos are near-duplicates.
LIKENESS = 0.6
#: Classes of at most so many exact copies stand in p1_found with all their pairs (124,750 at most a class).
COPIES = 500


def p1_found(spark: SparkSession, sf: str) -> DataFrame:
    return Duplicates(_scan(spark, sf, "videos", "video_id", "title", "transcript"), LIKENESS).pairs(expand=COPIES)


def p1_groups(spark: SparkSession, sf: str) -> DataFrame:
    """One row a video with a transcript, however short, with its class of exact copies, its number of
    links and its group."""
    return Duplicates(_scan(spark, sf, "videos", "video_id", "title", "transcript"), LIKENESS, every=True).groups()


def _sample(spark: SparkSession, sf: str, limits: dict[str, int]) -> samples.Sample:
    return samples.draw(table(spark, sf, "videos"), table(spark, sf, "review_labels"), {"main_language": language.FIT_ROWS, **limits})


def _subjects(spark: SparkSession, sf: str) -> DataFrame:
    sample = _sample(spark, sf, {"subject": subjects.FIT_ROWS})
    model = subjects.fit_reviewed(sample, table(spark, sf, "subjects"), language.fit_languages(sample, table(spark, sf, "languages")))
    return subjects.video_subjects(_scan(spark, sf, "videos", "video_id", "title", "transcript"), model)


def p2_found(spark: SparkSession, sf: str) -> DataFrame:
    return _subjects(spark, sf).select("video_id", "subject_code")


def p2_composition(spark: SparkSession, sf: str) -> DataFrame:
    """Videos of each subject, and the sum of the shares of their sentences."""
    return _subjects(spark, sf).groupBy("subject_code").agg(
        F.count(F.lit(1)).alias("n_videos"), F.count("share").alias("n_by_transcript"), F.round(F.sum("share"), 3).alias("share_sum")
    )


def p3_multiplicities(spark: SparkSession, sf: str) -> DataFrame:
    """Videos and distinct transcripts of each slice."""
    return text_counts(table(spark, sf, "videos"), "video_id", "transcript", ["university", "lang", "license_risk"])


def p3_token_budget(spark: SparkSession, sf: str) -> DataFrame:
    return token_budget(table(spark, sf, "videos"), "video_id", "transcript", ["university", "lang", "license_risk"])


def p4_found(spark: SparkSession, sf: str) -> DataFrame:
    videos, sample = _scan(spark, sf, "videos", "video_id", "transcript"), _sample(spark, sf, {"reading_level": reading.FIT_ROWS})
    model = reading.fit_graded(sample, videos, language.fit_languages(sample, table(spark, sf, "languages")))
    return reading.reading_levels(videos, model)


def p5_found(spark: SparkSession, sf: str) -> DataFrame:
    videos = _scan(spark, sf, "videos", "video_id", "title", "transcript", "lang")
    languages = table(spark, sf, "languages")
    return language.wrong_labels(videos, language.fit_languages(_sample(spark, sf, {}), languages), languages)


def p5_segments(spark: SparkSession, sf: str) -> DataFrame:
    """Every title and line that is not blank with its language, a confidence and whether p5_found counts it."""
    videos = _scan(spark, sf, "videos", "video_id", "title", "transcript", "lang")
    languages = table(spark, sf, "languages")
    return language.labelled_segments(videos, language.fit_languages(_sample(spark, sf, {}), languages), languages)


def p7_ids(spark: SparkSession, sf: str) -> DataFrame:
    return with_ids(_scan(spark, sf, "documents", "doc_id", "text"), "text", ["doc_id"])


def p8_containers(spark: SparkSession, sf: str) -> DataFrame:
    """The documents in containers of every target. Targets of one tokenizer share one count."""
    documents, targets = _scan(spark, sf, "documents", "doc_id", "text"), {}
    for row in table(spark, sf, "pack_targets").collect():  # a fixed table of three rows
        targets.setdefault(row["tokenizer"], {})[row["target_id"]] = row["capacity"]
    packed = None
    for tokenizer, capacities in targets.items():
        sized = with_counts(documents, "text", ["doc_id"], tokenizer=tokenizer)
        part = pack(sized, "doc_id", "n_tokens", capacities)
        packed = part if packed is None else packed.unionByName(part)
    return packed


def p9_found(spark: SparkSession, sf: str) -> DataFrame:
    scored = spam.score_documents(_scan(spark, sf, "documents", "doc_id", "text", "lang"), table(spark, sf, "doc_reviews"))
    return scored.where(F.col("spam_share") > spam.SHARE).select("doc_id")


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {
        "p1_found": p1_found,
        "p1_groups": p1_groups,
        "p2_found": p2_found,
        "p2_composition": p2_composition,
        "p3_token_budget": p3_token_budget,
        "p3_multiplicities": p3_multiplicities,
        "p4_found": p4_found,
        "p5_found": p5_found,
        "p5_segments": p5_segments,
        "p7_ids": p7_ids,
        "p8_containers": p8_containers,
        "p9_found": p9_found,
    }


def oracle_sql() -> dict[str, str]:
    return dict(ORACLE)
