"""Reliable checkpoints and folders of files that the driver and all executors share."""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from contextlib import contextmanager
from tempfile import mkdtemp

from pyspark.sql import DataFrame, SparkSession


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """The folder named by spark.checkpoint.dir, or the context's. Where neither is set, a local master gets a temporary one; on
    a cluster, whose nodes share none, that is an error."""
    path = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not path:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        path = mkdtemp(prefix="lociframe-shared-")
    if not spark.sparkContext.getCheckpointDir():
        spark.sparkContext.setCheckpointDir(path)
    return path.rstrip("/")


def scratch(spark: SparkSession, name: str) -> str:
    """A new path in the shared folder."""
    return f"{ensure_checkpoint_dir(spark)}/{spark.sparkContext.applicationId}-files/{name}-{uuid.uuid4().hex}"


@contextmanager
def swept(spark: SparkSession) -> Iterator[None]:
    """Shuffle files of what runs inside go when it ends; for frames that run once."""
    name = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    before = spark.conf.get(name)
    spark.conf.set(name, "true")
    try:
        yield
    finally:
        spark.conf.set(name, before)


def kept(df: DataFrame, name: str, compression: str | None = None) -> DataFrame:
    """The same rows, written in the shared folder and read back: computed once however often they are used."""
    path = scratch(df.sparkSession, name)
    df.write.parquet(path, compression=compression)
    return df.sparkSession.read.schema(df.schema).parquet(path)
