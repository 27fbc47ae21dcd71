"""Sinks: ordered shards of JSON lines under stable names, and a text card."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.ranking import global_rank


def _files(spark: SparkSession, path: str):
    """The file system of a path, and the path class."""
    kind = spark._jvm.org.apache.hadoop.fs.Path
    return kind(path).getFileSystem(spark._jsc.hadoopConfiguration()), kind


def write_json_shards(df: DataFrame, columns: list[str], order: list[Column], size: int, path: str) -> DataFrame:
    """Write ``columns`` of ``df`` as ``train-00000.jsonl`` and so on under ``path``, ``size`` rows a file, in the
    given order throughout; return ``df`` with its ``rank``, from the copy that was written.

    Null fields are written as null, non-ASCII characters as they are. Each file is one task's, and a
    task holds whole files, so nothing is gathered beyond ``size`` rows a file. Files of an earlier
    export under ``path`` are replaced. The order must have no ties. No rows, no files.
    """
    spark = df.sparkSession
    ranked = global_rank(df, order)
    shard = F.floor((F.col("rank") - 1) / size).cast("long").alias("shard")
    lines = ranked.select(shard, "rank", F.to_json(F.struct(*columns), {"ignoreNullFields": "false"}).alias("value"))
    parts = lines.repartitionByRange("shard").sortWithinPartitions("shard", "rank").drop("rank")
    parts.write.mode("overwrite").partitionBy("shard").text(f"{path}/_parts")
    files, kind = _files(spark, path)
    for old in files.globStatus(kind(f"{path}/train-*.jsonl")):
        files.delete(old.getPath(), False)
    for part in files.globStatus(kind(f"{path}/_parts/shard=*/part-*")):
        number = int(part.getPath().getParent().getName().partition("=")[2])
        if not files.rename(part.getPath(), kind(f"{path}/train-{number:05d}.jsonl")):
            raise OSError(f"shard {number} could not be named")
    files.delete(kind(f"{path}/_parts"), True)
    return ranked


def write_text(spark: SparkSession, path: str, text: str) -> None:
    """One small text file."""
    files, kind = _files(spark, path)
    out = files.create(kind(path), True)
    out.write(bytearray(text.encode()))
    out.close()


def card(title: str, bucket: str, stats: dict[str, object], fields: dict[str, str], columns: list[str], tables: dict[str, list[tuple]]) -> str:
    """A Markdown card: totals, what the fields hold, and a table (value, count, per cent) for each distribution."""
    lines = ["---", "size_categories:", f"  - {bucket}", "---", "", f"# {title}", "", "## Totals", ""]
    lines += [f"- **{name}**: {value:,}" for name, value in stats.items()]
    lines += ["", "## Fields", "", "| Field | Content |", "| --- | --- |"] + [f"| `{c}` | {fields.get(c, '')} |" for c in columns]
    for name, rows in tables.items():
        lines += ["", f"## {name}", "", f"| {name} | Count | % |", "| --- | ---: | ---: |"] + [f"| {v} | {n:,} | {p:.1f} |" for v, n, p in rows]
    return "\n".join(lines) + "\n"
