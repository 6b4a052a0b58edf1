"""Session set-up and the shared folder that loops cut their lineage in."""

from __future__ import annotations

import gc
import os
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def get_spark(app: str = "framelearn", master: str | None = None, **conf) -> SparkSession:
    """A session with the settings the operators are written for.

    Nothing here is needed for right results; every operator also works on a
    session made elsewhere. Shuffle partitions are left to the cluster unless
    given, since adaptive execution merges small ones.
    """
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    settings = {
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.execution.arrow.pyspark.enabled": "true",
        "spark.cleaner.referenceTracking.cleanCheckpoints": "true",
        **conf,
    }
    for key, value in settings.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def shared_dir(spark: SparkSession) -> str:
    """The folder all executors can reach, from ``spark.checkpoint.dir``.

    A local master may fall back on a temporary folder; a cluster may not,
    because a folder of one machine is lost with that machine.
    """
    context = spark.sparkContext
    named = context.getConf().get("spark.checkpoint.dir") or spark.conf.get("spark.checkpoint.dir", None)
    if named:
        return named
    current = context.getCheckpointDir()
    if current:
        return os.path.dirname(current)
    if not context.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder every executor can reach")
    folder = tempfile.mkdtemp(prefix="framelearn-")
    context.setCheckpointDir(folder)
    return folder


def materialize(df: DataFrame) -> DataFrame:
    """Compute ``df`` once and cut its lineage with a reliable checkpoint."""
    spark = df.sparkSession
    folder = shared_dir(spark)
    if not spark.sparkContext.getCheckpointDir():
        spark.sparkContext.setCheckpointDir(folder)
    return df.checkpoint(eager=True)


def tidy(spark: SparkSession) -> None:
    """Let Spark remove the shuffle files and checkpoints that nothing refers to any more.

    It learns of them by garbage collections of the driver, which may be rare; a loop
    over large tables would keep the files of every round until then.
    """
    gc.collect()
    spark._jvm.System.gc()


def scratch(spark: SparkSession, what: str) -> str:
    """A new folder for one run of a job, in the shared folder, below one named by the application."""
    return f"{shared_dir(spark).rstrip('/')}/framelearn/{spark.sparkContext.applicationId}/{what}-{uuid.uuid4().hex}"


def keep(df: DataFrame, compression: str | None = None) -> DataFrame:
    """Compute ``df`` once into compressed Parquet in the shared folder: for tables that grow with the input."""
    path = scratch(df.sparkSession, "kept")
    df.write.parquet(path, compression=compression)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def discard(spark: SparkSession, path: str) -> None:
    """Remove a folder that ``scratch`` named, through Hadoop's file systems."""
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    place.getFileSystem(spark._jsc.hadoopConfiguration()).delete(place, True)
