"""A store of rows by key that a stream adds to and corrects.

A batch writes its rows to a folder of its own; a commit, one small file named by the batch's number and moved into place last, makes
them part of the store. What was written without a commit is not read; a batch that runs again finds its commit and does nothing;
and of a key that several batches wrote, the row of the highest number holds.
"""

from __future__ import annotations

import json
import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


class Store:
    """Rows (key, ...) at `path`, in any file system that Spark writes to. One writer at a time."""

    def __init__(self, spark: SparkSession, path: str, schema, key: str = "sample_id"):
        self.spark, self.path, self.schema, self.key = spark, path.rstrip("/"), schema, key
        self._path = spark._jvm.org.apache.hadoop.fs.Path
        self._fs = self._path(self.path).getFileSystem(spark._jsc.hadoopConfiguration())

    def commits(self) -> dict[int, str]:
        """Batch number -> its folder, of all that are committed; a compaction stands for its number and all before."""
        where = self._path(f"{self.path}/commits")
        if not self._fs.exists(where):
            return {}
        single, whole = {}, {}
        for f in self._fs.listStatus(where):
            number, _, rest = f.getPath().getName().partition(".")
            if rest in ("json", "whole.json"):
                (single if rest == "json" else whole)[int(number)] = f.getPath()
        first = max(whole, default=None)
        used = {n: p for n, p in single.items() if first is None or n > first} | ({first: whole[first]} if whole else {})
        return {n: json.loads(self._text(p))["data"] for n, p in sorted(used.items())}

    def committed(self, number: int) -> bool:
        done = self.commits()
        return number in done or bool(done) and number < min(done)

    def _text(self, path) -> str:
        stream = self._fs.open(path)
        try:
            return bytes(self.spark._jvm.org.apache.commons.io.IOUtils.toByteArray(stream)).decode()
        finally:
            stream.close()

    def read(self) -> DataFrame:
        """One row for each key: that of the last batch that wrote it."""
        empty = self.spark.createDataFrame([], self.schema)
        names = [f"`{c}`" for c in empty.columns]
        found = None
        for number, data in self.commits().items():
            part = self.spark.read.schema(self.schema).parquet(f"{self.path}/data/{data}").withColumn("__batch", F.lit(number))
            found = part if found is None else found.unionByName(part)
        if found is None:
            return empty
        return found.groupBy(F.col(self.key).alias("__key")).agg(F.max_by(F.struct(*names), "__batch").alias("__row")).select("__row.*")

    def write(self, rows: DataFrame, number: int) -> bool:
        """Commit rows, one for each key, as batch `number`; False if that batch is committed already."""
        if self.committed(number):
            return False
        data = f"{number}-{uuid.uuid4().hex}"
        rows.write.parquet(f"{self.path}/data/{data}")
        self._commit(f"{number}.json", number, data)
        return True

    def _commit(self, name: str, number: int, data: str) -> None:
        staged = self._path(f"{self.path}/staged/{data}.json")
        stream = self._fs.create(staged, True)
        stream.write(bytearray(json.dumps({"batch": number, "data": data}).encode()))
        stream.close()
        self._fs.mkdirs(self._path(f"{self.path}/commits"))
        if not self._fs.rename(staged, self._path(f"{self.path}/commits/{name}")):
            raise RuntimeError(f"batch {number} was committed by another writer")

    def compact(self) -> None:
        """All rows in one folder, committed under the highest number; then what it stands for is deleted."""
        before = self.commits()
        if len(before) < 2:
            return
        last = max(before)
        data = f"{last}-{uuid.uuid4().hex}"
        self.read().write.parquet(f"{self.path}/data/{data}")
        self._commit(f"{last}.whole.json", last, data)
        for f in self._fs.listStatus(self._path(f"{self.path}/commits")):
            if f.getPath().getName() != f"{last}.whole.json":
                self._fs.delete(f.getPath(), False)
        self.sweep()

    def sweep(self) -> None:
        """Delete what no commit names: writes that died, and what compaction has replaced."""
        named = set(self.commits().values())
        where = self._path(f"{self.path}/data")
        for f in self._fs.listStatus(where) if self._fs.exists(where) else []:
            if f.getPath().getName() not in named:
                self._fs.delete(f.getPath(), True)


def one_each(batch: DataFrame, key: str) -> DataFrame:
    """One row for each key, the same in any run: the least by its other columns."""
    rest = [F.col(f"`{c}`") for c in batch.columns]
    return batch.groupBy(F.col(key).alias("__key")).agg(F.min_by(F.struct(*rest), F.to_json(F.struct(*rest))).alias("__row")).select("__row.*")


def reuse(batch: DataFrame, number: int, store: Store, valid: Column | str | None = None) -> bool:
    """Commit the rows of a batch whose keys the store does not hold, or holds in a row that is not `valid`: those are replaced."""
    held = store.read()
    held = held if valid is None else held.where(valid)
    fresh = one_each(batch.where(F.col(store.key).isNotNull()), store.key).join(held.select(store.key), store.key, "left_anti").select(*batch.columns)
    return store.write(fresh, number)
