"""Bounded samples of labelled texts for the models, read in one scan of the table.

A sample holds the reviewed videos of the aspects a model asks for, at most a stated number each, and
a share of all others by hash, for what needs labels as they arrived. Ids are chosen first, from the
reviews alone; the texts of all of them are then read together and kept in the shared checkpoint
folder, so several models are fitted on one read. What a model brings to the driver is bounded in
rows and in characters; a text is taken whole or not at all.
"""

from __future__ import annotations

import functools
import pickle
from itertools import accumulate

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import cut

#: Of the table as stored (its pruned columns), about so many bytes are sampled by hash.
SAMPLE_BYTES = 1 << 20
#: Rows sampled by hash if the stored size is not known.
SAMPLE_ROWS = 8000
#: A model brings at most so many characters of text to the driver.
SAMPLE_CHARS = 64 << 20


def verdicts(reviews: DataFrame, aspect: str) -> DataFrame:
    """``video_id, label`` of an aspect: of several values the most frequent, of those the smallest."""
    votes = reviews.where((F.col("aspect") == aspect) & F.col("video_id").isNotNull() & F.col("label_value").isNotNull())
    counted = votes.groupBy("video_id", F.col("label_value").alias("label")).agg(F.count(F.lit(1)).alias("n"))
    return counted.groupBy("video_id").agg(F.min_by("label", F.struct(-F.col("n"), F.col("label"))).alias("label"))


def first_by_hash(ids: DataFrame, limit: int) -> DataFrame:
    """``video_id`` of at most ``limit`` rows: a top-k by hash, the same at every run."""
    return ids.select("video_id").orderBy(F.xxhash64("video_id"), "video_id").limit(limit)


def _share(videos: DataFrame) -> float:
    size = int(str(videos._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))
    if size >= 1 << 62:  # not known
        return SAMPLE_ROWS / max(videos.count(), 1)
    return SAMPLE_BYTES / max(size, 1)


class Sample:
    """``rows``: ``video_id, title, transcript, lang, hashed`` of the sample, each video once: of rows
    that differ, the first by title, transcript and lang. ``reviews`` may be none."""

    def __init__(self, rows: DataFrame, reviews: DataFrame | None):
        self.rows, self.reviews = rows, reviews

    def labels(self, aspect: str) -> DataFrame:
        if self.reviews is None:
            return self.rows.select("video_id", F.lit("").alias("label")).limit(0)
        return verdicts(self.reviews, aspect)

    def take(self, labels: DataFrame, limit: int, text: str) -> pd.DataFrame:
        """Rows with a label, ``limit`` and ``SAMPLE_CHARS`` characters of ``text`` (an expression) at most,
        by hash of ``video_id``; ``labels`` has a video once. Rows whose text is null are left out."""
        spark = self.rows.sparkSession
        rows = self.rows.withColumn("text", F.expr(text)).where("text is not null").join(labels, "video_id")
        order = [F.xxhash64("video_id"), F.col("video_id")]
        sizes = rows.select("video_id", F.length("text").alias("n")).orderBy(*order).limit(limit).collect()
        within = accumulate(r["n"] for r in sizes)
        kept = [(r["video_id"],) for r, n in zip(sizes, within) if n <= SAMPLE_CHARS]
        chosen = spark.createDataFrame(kept, "video_id string")
        return rows.join(F.broadcast(chosen), "video_id").select("video_id", "text", *(c for c in labels.columns if c != "video_id")).orderBy("video_id").toPandas()


def draw(videos: DataFrame, reviews: DataFrame | None, limits: dict[str, int]) -> Sample:
    """The sample of ``videos`` (``video_id, title, transcript, lang``) for the aspects of ``limits``: one
    scan, in which the ids chosen (at most the sum of the limits, so broadcast) are looked up."""
    slim = videos.select("video_id", "title", "transcript", "lang").where("video_id is not null")
    hashed = F.pmod(F.xxhash64("video_id", F.lit(7)), F.lit(1 << 20)) < int(min(1.0, _share(slim)) * (1 << 20))
    if reviews is None:
        rows = slim.where(hashed).withColumn("hashed", F.lit(True))
    else:
        ids = [first_by_hash(verdicts(reviews, aspect), n) for aspect, n in limits.items()]
        chosen = functools.reduce(DataFrame.unionByName, ids).distinct().withColumn("asked", F.lit(True))
        marked = slim.join(F.broadcast(chosen), "video_id", "left").withColumn("hashed", hashed)
        rows = marked.where("hashed or asked is not null").drop("asked")
    best = F.min(F.struct("title", "transcript", "lang", "hashed")).alias("s")
    return Sample(cut(rows.groupBy("video_id").agg(best).select("video_id", "s.*")), reviews)


def save(spark: SparkSession, model: object, path: str) -> None:
    """Keep a fitted model as a one-row table, so that later runs need no sample."""
    spark.createDataFrame([(bytearray(pickle.dumps(model)),)], "model binary").coalesce(1).write.mode("overwrite").parquet(path)


def restore(spark: SparkSession, path: str) -> object:
    """A model that ``save`` wrote. Only for folders that nobody else writes to."""
    return pickle.loads(bytes(spark.read.parquet(path).first()["model"]))
