"""Mixing sources to target weights: Efraimidis-Spirakis keys, prefix sums to token budgets, complete epochs first.

Every document draws an exponential key -ln(u)/w, where u is a hash of its id and w its quality weight, the score of a model. A source takes as
many complete epochs as its target holds; the rest is filled by its documents in order of their keys, the last of them in
part. Prefix sums run in two levels: totals of (source, slice of the key) and then sums within a slice, so a source that
holds a third of all rows is spread over many tasks.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from lociframe.llm import arrays as A
from lociframe.llm.frames import Scratch, table, written
from lociframe.llm.quality_classifier import Discriminant, trained
from lociframe.llm.stats import features, text_stats
from lociframe.llm.workers import tidied

WEIGHTS = (3, 1, 2)
#: The smallest quality weight: no document is left out for its score alone.
LEAST = 0.05


def weighed(docs: DataFrame, text_col: str, model: Discriminant | None, columns: list[str]) -> DataFrame:
    """The named columns of `docs` with __size, the number of words of the text (null: 0), and __weight, the model's score of it, at
    least LEAST; without a model every weight is 1. A text has the same weight wherever it is scored."""
    kinds = {f.name: f.dataType for f in docs.schema}

    @tidied
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, offs = A.text_bytes(batch.column(0))
            for a, b, some, at in A.pieces(data, offs):
                if model is None:
                    size, weight = A.Words(some, at).count, np.ones(b - a)
                else:
                    found = pd.DataFrame(text_stats(some, at))
                    size, weight = found["n_words"].to_numpy(), np.maximum(LEAST, np.round(model.score(features(found)), 6))
                yield pa.RecordBatch.from_arrays([*(batch.column(1 + k).slice(a, b - a) for k in range(len(columns))), pa.array(size.astype(np.int64)), pa.array(weight)], names=[*columns, "__size", "__weight"])

    schema = "".join(f"`{c}` {kinds[c].simpleString()}, " for c in columns) + "__size long, __weight double"
    return docs.select(F.col(text_col).cast("string").alias("__text"), *(F.col(c) for c in columns)).mapInArrow(run, schema)


def targets(sizes: DataFrame, weights: tuple[int, ...] = WEIGHTS, share: float = 1.5, limit: float = 2.0) -> DataFrame:
    """Rows (source, source_size, target) for rows (source, source_size): `share` of all sizes dealt by weight.

    Sources by code point, null last, take the weights in turn. A target stops at `limit` times its source's size; the
    excess is dealt again by weight among the others until none is above. Solved in one pass: sources in order of
    size/weight fill up first, so the last level at which nobody more is full follows from running sums. One row per
    source; the running sums cover the table of sources only.
    """
    # one row per source: its number is the number of sources, far below the number of documents
    one = F.lit(0)
    numbered = sizes.withColumn("place", F.row_number().over(W.partitionBy(one).orderBy(F.col("source").asc_nulls_last())) - 1)
    w = F.element_at(F.array(*(F.lit(float(x)) for x in weights)), (F.col("place") % len(weights) + 1).cast("int"))
    base = numbered.withColumn("w", w).withColumn("most", limit * F.col("source_size"))
    order = W.partitionBy(one).orderBy(F.col("most") / F.col("w"), "place")
    whole = W.partitionBy(one)
    before = order.rowsBetween(W.unboundedPreceding, -1)
    ranked = (
        base.withColumn("total", share * F.sum("source_size").over(whole))
        .withColumn("rest", F.col("total") - F.coalesce(F.sum("most").over(before), F.lit(0.0)))
        .withColumn("rest_w", F.sum("w").over(whole) - F.coalesce(F.sum("w").over(before), F.lit(0.0)))
        .withColumn("open", F.col("rest") / F.col("rest_w") * F.col("w") <= F.col("most"))
    )
    # the first open source fixes the level that all later ones share
    level = F.min(F.when(F.col("open"), F.struct((F.col("most") / F.col("w")).alias("o"), F.col("place").alias("p"), (F.col("rest") / F.col("rest_w")).alias("level")))).over(whole)
    return ranked.withColumn("level", level["level"]).select("source", "source_size", F.least(F.col("most"), F.coalesce(F.col("level") * F.col("w"), F.col("most"))).alias("target"))


def key_of(doc_id: Column, weight: Column, seed: int) -> Column:
    """Exponential key, smaller for documents of more weight."""
    u = (F.pmod(F.xxhash64(F.lit(seed), doc_id.cast("long")), F.lit(1 << 53)) + 0.5) / float(1 << 53)
    return -F.log(u) / weight


#: Probabilities at which the keys' distribution is measured: even ones, and the tail by halves.
LEVELS = [i / 160 for i in range(160)] + [1 - 2.0**-j / 160 for j in range(1, 7)]


def slice_of(rows: DataFrame, slices: int) -> Column:
    """A number that does not fall as `key` rises, with about as many rows each, whatever the weights: the ranges between measured
    quantiles of the key, each cut evenly into its share of `slices`. Results do not depend on where slices end."""
    found = rows.approxQuantile("key", [*LEVELS, 1.0], 1e-4)
    if not found:
        return F.lit(0)
    bounds = sorted(set(found))
    share = [sum(hi - lo for lo, hi, at in zip(LEVELS, [*LEVELS[1:], 1.0], found, strict=False) if at == b) for b in bounds]
    pieces = [max(1, round(s * slices)) for s in share]
    first = [sum(pieces[:i]) for i in range(len(pieces))]

    def pick(lo: int, hi: int) -> Column:  # a tree of comparisons
        if hi - lo == 1:
            width = (bounds[lo + 1] if lo + 1 < len(bounds) else found[-1]) - bounds[lo]
            if pieces[lo] == 1 or width <= 0:
                return F.lit(first[lo])
            within = F.floor((F.col("key") - F.lit(bounds[lo])) / F.lit(width) * pieces[lo])
            return F.lit(first[lo]) + F.least(F.greatest(within, F.lit(0)), F.lit(pieces[lo] - 1)).cast("int")
        mid = (lo + hi) // 2
        return F.when(F.col("key") < F.lit(bounds[mid]), pick(lo, mid)).otherwise(pick(mid, hi))

    return pick(0, len(bounds))


def _placed(rows: DataFrame, weights: tuple[int, ...], share: float, limit: float, slice_rows: int) -> DataFrame:
    """Rows (doc_id, source, size, key, source_size, target, epochs, part) for rows (doc_id, source, size, key): part is what the
    last pass takes of the row."""
    slices = max(64, rows.count() // slice_rows)
    rows = rows.withColumn("slice", slice_of(rows, slices).cast("int"))
    by_slice = rows.groupBy("source", "slice").agg(F.sum("size").alias("slice_size"))
    goal = targets(rows.groupBy("source").agg(F.sum("size").alias("source_size")), weights, share, limit)
    slice_before = W.partitionBy("source").orderBy("slice").rowsBetween(W.unboundedPreceding, -1)
    sums = by_slice.withColumn("before", F.coalesce(F.sum("slice_size").over(slice_before), F.lit(0))).join(goal.withColumnRenamed("source", "goal"), F.col("source").eqNullSafe(F.col("goal")))
    sums = sums.select(F.col("source").alias("s"), F.col("slice").alias("k"), "before", "source_size", "target")
    inner = W.partitionBy("source", "slice").orderBy("key", "doc_id", "size").rowsBetween(W.unboundedPreceding, -1)
    placed = rows.withColumn("inside", F.coalesce(F.sum("size").over(inner), F.lit(0)))
    joined = placed.join(sums, (F.col("slice") == F.col("k")) & F.col("source").eqNullSafe(F.col("s")))
    epochs = F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size"))).otherwise(0)
    rest = F.floor(F.col("target")) - epochs * F.col("source_size")
    part = F.least(F.col("size"), F.greatest(F.lit(0), rest - F.col("before") - F.col("inside")))
    return joined.select("doc_id", "source", "size", "key", "source_size", "target", epochs.alias("epochs"), part.alias("part"))


def keyed(docs: DataFrame, id_col: str, text_col: str, source_col: str, model: Discriminant | None, seed: int) -> DataFrame:
    """Rows (doc_id, source, size, key), one per row of `docs`."""
    found = weighed(docs, text_col, model, list(dict.fromkeys([id_col, source_col])))
    return found.select(F.col(id_col).cast("long").alias("doc_id"), F.col(source_col).cast("string").alias("source"), F.col("__size").alias("size"), key_of(F.col(id_col), F.col("__weight"), seed).alias("key"))


def mix_sources(
    docs: DataFrame, model: Discriminant | None = None, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source", weights: tuple[int, ...] = WEIGHTS, share: float = 1.5, limit: float = 2.0, seed: int = 7, slice_rows: int = 50_000
) -> DataFrame:
    """Rows (doc_id, source, size, source_size, target, taken), one per row of `docs`.

    taken: words of the document in the mix, repeats counted, at most ceil(limit) times its size; a source's sum is its
    target, rounded down. Empty and null texts have size 0 and take 0. Ties of keys go by id, then size; rows with equal id
    and size are told apart by nothing and share a key, each counted. Reruns agree: keys are hashes, not random numbers.
    """
    rows = written(keyed(docs, id_col, text_col, source_col, model, seed), "mix-keys")
    placed = _placed(rows, weights, share, limit, slice_rows)
    return placed.select("doc_id", "source", "size", "source_size", "target", (F.col("epochs") * F.col("size") + F.col("part")).cast("long").alias("taken"))


def mixed_documents(
    docs: DataFrame, model: Discriminant | None = None, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source", weights: tuple[int, ...] = WEIGHTS, share: float = 1.5, limit: float = 2.0, seed: int = 7, slice_rows: int = 50_000
) -> DataFrame:
    """The rows of `docs` as the mix repeats them: each once per epoch, and once more if its key comes before its source's cut.

    Documents stay whole: the one that the cut falls into is taken if at least half of it lies before the cut. Empty texts
    go once per epoch; repeated rows share their fate. Only one row per source (epochs and cut) is joined; the texts are not
    shuffled while that table is small enough for Spark to broadcast.
    """
    scratch = Scratch(docs.sparkSession)
    placed = _placed(scratch.written(keyed(docs, id_col, text_col, source_col, model, seed), "mix-keys"), weights, share, limit, slice_rows)
    place = F.struct("key", "doc_id", "size")
    half = F.when((F.col("part") > 0) & (2 * F.col("part") >= F.col("size")), place)
    cuts = placed.groupBy(F.col("source").alias("__source")).agg(F.first("epochs").alias("__epochs"), F.min(F.when(F.col("part") < F.col("size"), place)).alias("__cut"), F.max(F.when(F.col("part") < F.col("size"), half)).alias("__half"))
    cuts = written(cuts, "mix-cuts")
    scratch.remove()
    columns = [c for c in docs.columns if c not in ("__size", "__weight")]
    own = F.struct(key_of(F.col(id_col), F.col("__weight"), seed).alias("key"), F.col(id_col).cast("long").alias("doc_id"), F.col("__size").alias("size"))
    last = ((own < F.col("__cut")) | F.coalesce(own == F.col("__half"), F.lit(False))) & (F.col("__size") > 0)
    joined = weighed(docs, text_col, model, columns).join(F.broadcast(cuts), F.col(source_col).cast("string").eqNullSafe(F.col("__source")))  # one row per source
    copies = F.when(F.col("__cut").isNull(), F.col("__epochs")).otherwise(F.col("__epochs") + last.cast("int")).cast("int")
    return joined.withColumn("__copy", F.explode(F.array_repeat(F.lit(1), copies))).select(*columns)


def op8_mix_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return mix_sources(docs, trained(docs, table(spark, sf_dir, "labels"))).drop("source")
