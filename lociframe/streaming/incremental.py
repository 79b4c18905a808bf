"""Incremental versions of the mergeable steps, on Structured Streaming."""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from lociframe.streaming.store import Store, reuse


def counted_groups(stream: DataFrame, key: str = "sample_id", part: str = "part", expected: str = "n_parts") -> DataFrame:
    """Keys whose declared number of distinct parts has arrived, each emitted once. State per key: the parts seen; repeats of
    a part do not count. The declared number is small (the intervals of one genome)."""

    def step(k: tuple, batches: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        seen, done = (set(state.get[0]), state.get[1]) if state.exists else (set(), False)
        wanted = None
        for pdf in batches:
            seen |= set(pdf[part].astype(str))
            wanted = int(pdf[expected].iloc[0])
        complete = wanted is not None and len(seen) >= wanted and not done
        state.update((sorted(seen), done or complete))
        yield pd.DataFrame({key: [k[0]], "n_seen": [len(seen)]} if complete else {key: pd.Series([], dtype=object), "n_seen": pd.Series([], dtype="int64")})

    return stream.groupBy(key).applyInPandasWithState(step, f"{key} string, n_seen long", "seen array<string>, done boolean", "append", GroupStateTimeout.NoTimeout)


def incremental_reuse(stream: DataFrame, store: str, checkpoint: str, key: str = "sample_id", valid: Column | str | None = None):
    """Adds to the store (`store.Store`, read with `Store.read`) the samples of each batch that it does not hold yet; returns the
    running query.

    valid: stored samples count as held only if this holds for their row; others are replaced. Repeats within a batch count once; a
    batch that is run again adds nothing, and one that died before its commit leaves nothing to read.
    """

    def add(batch: DataFrame, number: int) -> None:
        reuse(batch, number, Store(batch.sparkSession, store, batch.schema, key), valid)

    return stream.writeStream.foreachBatch(add).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def incremental_histogram(stream: DataFrame) -> DataFrame:
    """Running sums of partial histograms (depth, count); equals the one-shot merge once all parts have come."""
    return stream.groupBy("depth").agg(F.sum("count").alias("count"))


def incremental_missing(stream: DataFrame) -> DataFrame:
    """Running sums of partial missingness (SAMPLE, present, target)."""
    return stream.groupBy("SAMPLE").agg(F.sum("present").alias("PRESENT_BASES"), F.sum("target").alias("TARGET_BASES"))
