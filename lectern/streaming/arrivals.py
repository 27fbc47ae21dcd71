"""Structured Streaming over arriving files."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from ..operators.merging import insert_absent
from ..session import table

ARRIVING = "id string, title string, duration double"


def arriving_entries(spark: SparkSession, folder: str, glob: str = "{*_videos,playlist_*}.json") -> DataFrame:
    """Entries of JSON-lines files as they arrive; the checkpoint of the query remembers the files."""
    lines = spark.readStream.schema(ARRIVING).option("pathGlobFilter", glob).option("mode", "DROPMALFORMED").json(folder)
    return lines.where("length(id) = 11").withColumnRenamed("id", "video_id")


def held_ids(spark: SparkSession, queue: str) -> DataFrame:
    """The ids of the Parquet folder ``queue``; none if there is no such folder yet. Any other fault is raised."""
    path = spark._jvm.org.apache.hadoop.fs.Path(queue)
    if not path.getFileSystem(spark._jsc.hadoopConfiguration()).exists(path):
        return spark.createDataFrame([], "video_id string")
    return spark.read.schema("video_id string").parquet(queue)


def into_queue(stream: DataFrame, queue: str, checkpoint: str, **trigger) -> StreamingQuery:
    """Append to the Parquet folder ``queue`` what it lacks, the first arrival of each id. A batch
    that is run again after a failure finds its rows there and appends nothing twice. Of the queue
    only the column of ids is read."""
    spark = stream.sparkSession

    def add(batch: DataFrame, number: int) -> None:
        numbered = batch.withColumn("arrival", F.monotonically_increasing_id())
        insert_absent(numbered, held_ids(spark, queue), "video_id", "arrival").drop("arrival").write.mode("append").parquet(queue)

    return stream.writeStream.foreachBatch(add).option("checkpointLocation", checkpoint).trigger(**(trigger or {"availableNow": True})).start()


def late_counts(events: DataFrame, width: str = "1 day", delay: str = "2 hours") -> DataFrame:
    """Events by type in tumbling windows; events later than ``delay`` are left out in a stream."""
    stamped = events.withColumn("at", F.col("ts").cast("timestamp"))
    return (
        stamped.withWatermark("at", delay)
        .groupBy(F.window("at", width), "event_type")
        .agg(F.count(F.lit(1)).alias("n_events"), F.round(F.sum("value"), 2).alias("value_sum"))
        .select(F.col("window.start").alias("window_start"), "event_type", "n_events", "value_sum")
    )


def events_by_day(spark: SparkSession, sf: str) -> DataFrame:
    return late_counts(table(spark, sf, "events"))
