"""Queries that run as streams over a given table until all of it has been read, and give what they have made."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lociframe.operators.lineage import scratch
from lociframe.plans.registry import query
from lociframe.streaming import incremental
from lociframe.streaming.store import Store


def events(spark: SparkSession, d: str) -> DataFrame:
    """The events as a stream of their files; a pattern, for the table may be one file or a folder."""
    schema = spark.read.parquet(f"{d}/events.parquet").schema
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", 4).parquet(f"{d}/event[s].parquet")


def drained(made: DataFrame, mode: str) -> DataFrame:
    """What a stream has written once it has read all that there is: its last batch if complete, else all batches."""
    spark, path = made.sparkSession, scratch(made.sparkSession, "stream")

    def put(batch: DataFrame, number: int) -> None:
        batch.write.mode("overwrite").parquet(path if mode == "complete" else f"{path}/batch={number}")

    put(spark.createDataFrame([], made.schema), -1)  # a stream without rows runs no batch
    made.writeStream.foreachBatch(put).outputMode(mode).option("checkpointLocation", scratch(spark, "stream-state")).trigger(availableNow=True).start().awaitTermination()
    return spark.read.schema(made.schema).parquet(path).select(*made.columns)


@query("SELECT CAST(floor(value) AS BIGINT) AS depth, CAST(count(*) AS BIGINT) AS count FROM events GROUP BY 1")
def incremental_histogram_stream(spark: SparkSession, d: str) -> DataFrame:
    """Partial histograms of the events' values, summed as they come."""
    parts = events(spark, d).select(F.floor("value").alias("depth"), F.lit(1).alias("count"))
    return drained(incremental.incremental_histogram(parts), "complete")


@query("SELECT 'S' || CAST(user_id AS VARCHAR) AS sample_id, CAST(5 AS BIGINT) AS n_seen FROM events GROUP BY user_id HAVING count(DISTINCT event_type) = 5")
def counted_groups_stream(spark: SparkSession, d: str) -> DataFrame:
    """Users whose events have shown all five types, each given once."""
    parts = events(spark, d).select(F.concat(F.lit("S"), F.col("user_id").cast("string")).alias("sample_id"), F.col("event_type").alias("part"), F.lit(5).alias("n_parts"))
    return drained(incremental.counted_groups(parts), "append")


@query("SELECT 'S' || CAST(user_id AS VARCHAR) AS sample_id, min(lpad(CAST(event_id AS VARCHAR), 12, '0')) AS event, true AS ok FROM events WHERE event_id % 3 <> 0 GROUP BY 1")
def incremental_reuse_stream(spark: SparkSession, d: str) -> DataFrame:
    """A store of one valid row a user: invalid rows come first, as a batch of their own, and are replaced by the stream's."""
    e = events(spark, d)
    row = (F.concat(F.lit("S"), F.col("user_id").cast("string")).alias("sample_id"), F.lpad(F.col("event_id").cast("string"), 12, "0").alias("event"), (F.col("event_id") % 3 != 0).alias("ok"))
    rows = e.select(*row)
    path = scratch(spark, "store")
    store = Store(spark, path, rows.schema)
    bad = spark.read.parquet(f"{d}/events.parquet").select(*row).where("not ok").groupBy("sample_id").agg(F.min("event").alias("event"), F.lit(False).alias("ok"))
    store.write(bad, -1)
    incremental.incremental_reuse(rows.where("ok"), path, scratch(spark, "store-state"), valid="ok").awaitTermination()
    return store.read().where("ok")
