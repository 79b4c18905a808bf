"""Small Spark helpers of this subpackage: tables, the shared folder, connected components."""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from tempfile import mkdtemp

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shared_dir(spark: SparkSession) -> str:
    """The folder that driver and executors share: spark.checkpoint.dir, or the context's checkpoint folder.

    Where neither is set, a local master gets a temporary one; on a cluster, whose nodes share none, that is an error.
    """
    path = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not path:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        path = mkdtemp(prefix="lociframe-shared-")
    if not spark.sparkContext.getCheckpointDir():
        spark.sparkContext.setCheckpointDir(path)
    return path.rstrip("/")


def cut(df: DataFrame) -> DataFrame:
    """The same rows with their lineage cut by a reliable checkpoint in the shared folder."""
    shared_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def written(df: DataFrame, name: str) -> DataFrame:
    """The same rows, written as Parquet in the shared folder and read back: what is used twice is computed once, and a lost
    executor loses none of it. The files stay until `remove_written`."""
    path = f"{written_dir(df.sparkSession)}/{name}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def written_dir(spark: SparkSession) -> str:
    """This application's folder of written tables."""
    return f"{shared_dir(spark)}/{spark.sparkContext.applicationId}-tables"


def remove_written(spark: SparkSession) -> None:
    """Delete all tables that this application wrote with `written`; no DataFrame over them can be used afterwards."""
    delete(spark, written_dir(spark))


class Scratch:
    """Tables written for one computation, removed together once what is made of them is written too."""

    def __init__(self, spark: SparkSession):
        self.spark, self.paths = spark, []

    def written(self, df: DataFrame, name: str) -> DataFrame:
        path = f"{written_dir(self.spark)}/{name}-{uuid.uuid4().hex}"
        self.paths.append(path)
        df.write.parquet(path)
        return self.spark.read.schema(df.schema).parquet(path)

    def remove(self) -> None:
        for path in self.paths:
            delete(self.spark, path)


def delete(spark: SparkSession, path: str) -> None:
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    p.getFileSystem(spark._jsc.hadoopConfiguration()).delete(p, True)


def text_size(docs: DataFrame, text: str) -> tuple[int, int]:
    """(rows, bytes of text)."""
    row = docs.agg(F.count(F.lit(1)).alias("n"), F.sum(F.octet_length(text)).alias("b")).first()
    return row["n"], row["b"] or 0


def spanning(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """A spanning forest of a partition's edges a-b: each node with its tree's smallest, as (a, b)."""
    a, b = np.zeros(0, np.int64), np.zeros(0, np.int64)
    waiting, full = [], 1 << 18

    def tree(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        nodes, at = np.unique(np.concatenate([a, b]), return_inverse=True)
        x, y = at[: len(a)], at[len(a) :]
        label = np.arange(len(nodes))
        while True:
            low = np.minimum(label[x], label[y])
            new = label.copy()
            for end in (label[x], label[y]):
                np.minimum.at(new, end, low)
            while (new[new] != new).any():
                new = new[new]
            if (new == label).all():
                break
            label = new
        out = np.flatnonzero(label != np.arange(len(nodes)))
        return nodes[out], nodes[label[out]]

    for batch in batches:
        waiting.append((batch.column(0).to_numpy(), batch.column(1).to_numpy()))
        if sum(len(x) for x, _ in waiting) > max(full, len(a)):
            a, b = tree(*(np.concatenate(x) for x in zip((a, b), *waiting, strict=True)))
            waiting = []
    if waiting:
        a, b = tree(*(np.concatenate(x) for x in zip((a, b), *waiting, strict=True)))
    yield pa.RecordBatch.from_arrays([pa.array(a), pa.array(b)], names=["a", "b"])


def components(edges: DataFrame, rounds: int = 200, rows_per_file: int = 200_000) -> DataFrame:
    """Connected components of `edges` (a long, b long): rows (node, component), component = smallest node reachable.

    First each partition of up to `rows_per_file` edges keeps a spanning forest of its own, so a group whose members meet in many
    ways does not pass through the rounds with all of them. Large-star and small-star steps in turn until a round changes nothing. Every step groups by node with partial
    aggregation and joins back on the node, so a node with very many neighbours is split by AQE. Each round ends in a
    reliable checkpoint, in files of up to `rows_per_file` edges. Rounds grow with the logarithm of the longest path; if the
    labels have not settled after `rounds`, which no size asks for, it raises. A component's smallest node and nodes without
    an edge have no row; null ends and self-loops are dropped; an empty input gives an empty result.
    """
    scratch = Scratch(edges.sparkSession)
    edges = scratch.written(edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).where("a is not null and b is not null and a <> b").distinct(), "edges")
    files = 1 + edges.count() // rows_per_file
    edges = scratch.written(edges.coalesce(files).mapInArrow(spanning, "a long, b long"), "forest")
    seen = None
    for _ in range(rounds):
        both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.min("b").alias("m")).select(F.col("a").alias("k"), F.least("a", "m").alias("m"))
        large = both.join(least, F.col("a") == F.col("k")).where("b > a").select(F.col("b").alias("a"), F.col("m").alias("b")).where("a <> b").distinct()
        low = large.groupBy("a").agg(F.min("b").alias("m")).select(F.col("a").alias("k"), "m")
        after = (
            large.join(low, F.col("a") == F.col("k"))
            .select(F.explode(F.array(F.struct("a", F.col("m").alias("b")), F.struct(F.col("b").alias("a"), F.col("m").alias("b")))).alias("e"))
            .select("e.a", "e.b")
            .where("a <> b")
            .distinct()
        )
        after = cut(after.coalesce(files))
        state = after.agg(F.count(F.lit(1)).alias("n"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)")).alias("h")).first()
        edges = after
        if state == seen:
            break
        seen = state
    else:
        raise RuntimeError(f"components have not settled after {rounds} rounds")
    scratch.remove()
    return edges.groupBy("a").agg(F.min("b").alias("component")).select(F.col("a").alias("node"), "component")
