"""Session settings, and the one place that decides where lineage is cut."""

from __future__ import annotations

import uuid
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.parquet.filterPushdown": "true",
    # files are compressed: without this a fact of 10 MB on disk counts as small enough to broadcast
    "spark.sql.sources.fileCompressionFactor": "4.0",
}


def build_session(app: str = "comptoir", master: str | None = None, **conf: str) -> SparkSession:
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for key, value in {**SETTINGS, **conf}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def shared_dir(spark: SparkSession) -> str:
    """The folder all executors see, from ``spark.checkpoint.dir``.

    A local session without that setting uses a folder beside its warehouse. On a
    cluster the folder must be named, as one that dies with its machine is of no use.
    """
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        return configured.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder shared by all executors")
    fallback = f"{spark.conf.get('spark.sql.warehouse.dir').rstrip('/')}/comptoir-scratch"
    spark.conf.set("spark.checkpoint.dir", fallback)
    return fallback


def scratch_path(spark: SparkSession, name: str) -> str:
    """A path under the shared folder that no other run uses."""
    return f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}"


SHUFFLE_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


@contextmanager
def shuffle_cleanup(spark: SparkSession):
    """Delete the shuffle files of each job as soon as it ends, for the jobs run inside; the setting is restored after."""
    before = spark.conf.get(SHUFFLE_CLEANUP, None)
    spark.conf.set(SHUFFLE_CLEANUP, "true")
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(SHUFFLE_CLEANUP)
        else:
            spark.conf.set(SHUFFLE_CLEANUP, before)


def write_scratch(df: DataFrame, path: str, *parts: str) -> None:
    """Write a frame that is read again and then dropped: packed more tightly than a table, by ``parts`` if given, and
    without leaving the shuffle files of the write behind."""
    with shuffle_cleanup(df.sparkSession):
        df.write.option("compression", "zstd").partitionBy(*parts).parquet(path)


def cut_lineage(df: DataFrame) -> DataFrame:
    """Write the frame to the shared folder and go on from the files."""
    path = scratch_path(df.sparkSession, "cut")
    write_scratch(df, path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
