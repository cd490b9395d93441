"""Session settings and the shared folder for staged tables."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

# Adaptive execution sizes shuffles at run time and splits skewed join
# partitions; results must not depend on the machine's time zone.
SETTINGS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
}

# whether Spark removes a write's shuffle files at its end, instead of whenever the driver collects garbage
SHUFFLE_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def configure(builder: SparkSession.Builder) -> SparkSession.Builder:
    for key, value in SETTINGS.items():
        builder = builder.config(key, value)
    return builder


def shared_folder(spark: SparkSession) -> str:
    """Folder all executors can reach, as named by ``spark.checkpoint.dir``.

    Only a local master, where driver and executors are one machine, gets a
    temporary folder when nothing is set.
    """
    named = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if named:
        return named
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder shared by all executors")
    spark.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="verbamark-"))
    return spark.sparkContext.getCheckpointDir()


def spread(df: DataFrame) -> DataFrame:
    """Deal the rows of a small scan to all cores.

    A scan that comes in as many tasks as there are cores, as any large table
    does, is left as it is and costs no shuffle.
    """
    cores = df.sparkSession.sparkContext.defaultParallelism
    return df if df.rdd.getNumPartitions() >= cores else df.repartition(cores)


def stage(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` once to the shared folder and go on from the written table.

    Used where a re-run would repeat paid calls or could number rows anew, and
    where the later plan should know a small table's true size. ``discard``
    removes the table when nothing reads it any more. The shuffles behind the
    table are removed once it is written, so they take no disk in later steps.
    """
    spark = df.sparkSession
    path = f"{shared_folder(spark).rstrip('/')}/staged/{name}-{uuid.uuid4().hex}"
    before = spark.conf.get(SHUFFLE_CLEANUP, "false")
    spark.conf.set(SHUFFLE_CLEANUP, "true")
    try:
        df.write.parquet(path)
    finally:
        spark.conf.set(SHUFFLE_CLEANUP, before)
    out = spark.read.schema(df.schema).parquet(path)
    out.staged_path = path
    return out


def discard(*staged: DataFrame) -> None:
    """Delete staged tables; a frame that was not staged is passed over."""
    for df in staged:
        if path := getattr(df, "staged_path", None):
            where = df.sparkSession._jvm.org.apache.hadoop.fs.Path(path)
            where.getFileSystem(df.sparkSession._jsc.hadoopConfiguration()).delete(where, True)
