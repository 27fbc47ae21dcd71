"""Session defaults, table access and lineage cuts shared by every operator."""

from __future__ import annotations

import atexit
import shutil
import tempfile
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession


def build_session(app: str = "lectern", master: str | None = None, **conf: str) -> SparkSession:
    """A session with UTC time and adaptive execution on; ``conf`` keys use ``__`` for dots."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    settings = {
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.ui.enabled": "false",
        "spark.cleaner.referenceTracking.cleanCheckpoints": "true",
    }
    settings |= {key.replace("__", "."): value for key, value in conf.items()}
    for key, value in settings.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def ship(spark: SparkSession) -> None:
    """Give the executors this package, once a context, so that Python workers can import it
    wherever they were started."""
    context = spark.sparkContext
    if getattr(context, "_lectern_shipped", False):
        return
    root = Path(__file__).resolve().parent
    if root.is_dir():  # not when this runs from such an archive itself
        folder = Path(tempfile.mkdtemp(prefix="lectern-code-"))
        shutil.copytree(root, folder / "code" / root.name, ignore=shutil.ignore_patterns("__pycache__"))
        context.addPyFile(shutil.make_archive(str(folder / "lectern"), "zip", folder / "code"))
        shutil.rmtree(folder / "code")
        atexit.register(shutil.rmtree, folder, ignore_errors=True)
    context._lectern_shipped = True


def table(spark: SparkSession, directory: str, name: str) -> DataFrame:
    """One Parquet table of a data directory."""
    ship(spark)
    return spark.read.parquet(f"{directory}/{name}.parquet")


def spread(df: DataFrame) -> DataFrame:
    """A scan in as many partitions as there are cores, if its files give fewer than half of that.
    Only for what reads files directly; an input in proportion to the cluster is left as it is."""
    cores = df.sparkSession.sparkContext.defaultParallelism
    return df.repartition(cores) if 2 * df.rdd.getNumPartitions() <= cores else df


def ensure_checkpoint_dir(spark: SparkSession) -> None:
    """Use the shared folder the cluster names in ``spark.checkpoint.dir``. Where none is named, one on this
    machine is made if the session runs on it alone; on a cluster that is an error."""
    context = spark.sparkContext
    if context.getCheckpointDir():
        return
    named = context.getConf().get("spark.checkpoint.dir", None)
    if not named and not context.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
    if not named:
        named = tempfile.mkdtemp(prefix="lectern-checkpoint-")
        atexit.register(shutil.rmtree, named, ignore_errors=True)
    context.setCheckpointDir(named)


def cut(df: DataFrame) -> DataFrame:
    """Materialise ``df`` once in the shared checkpoint folder. The copy is replicated storage, so
    a lost executor costs a re-read and never a recomputation."""
    ensure_checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)
