"""Balanced chunks of weighted intervals.

The order is genome order; prefix sums run in tiles of a contig and are shifted by the totals of the contigs before, of
which there is one row each. Cuts are found by one window over candidate boundaries, not by a loop over intervals.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from lociframe.operators.intervals import make_windows, map_sum, merge
from lociframe.operators.lineage import kept
from lociframe.operators.tiles import running, tile_of


def with_prefix(iv: DataFrame, contigs: DataFrame) -> DataFrame:
    """iv with `before` (weight of all intervals earlier in genome order), `place` (0-based) and `total`."""
    totals = iv.groupBy("chrom").agg(F.sum("weight").alias("__w"), F.count(F.lit(1)).alias("__n")).join(contigs.select(F.col("contig").alias("chrom"), F.col("rank").alias("__rank")), "chrom")
    # one row per contig
    all_contigs = W.partitionBy(F.lit(0)).orderBy("__rank").rowsBetween(W.unboundedPreceding, -1)
    shift = totals.select("chrom", F.coalesce(F.sum("__w").over(all_contigs), F.lit(0)).alias("__shift"), F.coalesce(F.sum("__n").over(all_contigs), F.lit(0)).alias("__shift_n"), F.sum("__w").over(W.partitionBy(F.lit(0))).alias("total"))
    both = running(iv, "__sums", "sum", F.col("weight"), ["start", "end", "weight"], tile_of("start")).withColumn("__before", F.coalesce("__sums", F.lit(0)))
    inner = running(both, "__n", "sum", F.lit(1), ["start", "end", "weight"], tile_of("start")).withColumn("__i", F.coalesce("__n", F.lit(0)))
    joined = inner.join(shift, "chrom")
    return joined.select(*iv.columns, (F.col("__before") + F.col("__shift")).alias("before"), (F.col("__i") + F.col("__shift_n")).alias("place"), "total")


def chunk_balanced(iv: DataFrame, contigs: DataFrame, target: float) -> DataFrame:
    """iv with `chunk` (0-based): K = ceil(total / target) chunks, at most one per positive interval.

    Cut j goes where the running weight is nearest to j * total / K, ties earlier; each chunk holds at least one positive
    interval, so a cut that would not advance moves on by one: b'_j = j + max over i <= j of (b_i - i). Intervals of weight
    zero stay in the open chunk.
    """
    # everything else is counted along these numbers, so that equal intervals keep apart
    numbered = kept(with_prefix(iv, contigs).drop("before"), "numbered")
    summed = running(numbered, "__b", "sum", F.col("weight"), ["place"], tile_of("place", 100_000), keys=())
    summed = running(summed, "__r0", "sum", (F.col("weight") > 0).cast("int"), ["place"], tile_of("place", 100_000), keys=())
    placed = summed.select(*iv.columns, F.coalesce("__b", F.lit(0)).alias("before"), "place", "total", F.coalesce("__r0", F.lit(0)).alias("rank0"))
    positive = placed.where("weight > 0")
    n = positive.agg(F.count(F.lit(1)).alias("n"), F.first("total").alias("total")).first()
    if not n["n"]:
        return placed.select(*iv.columns, F.lit(0).cast("long").alias("chunk"))
    k = max(1, min(int(-(-float(n["total"]) // target)), n["n"]))
    per = float(n["total"]) / k
    ends = positive.select("rank0", (F.col("before") + F.col("weight")).alias("cum"), "before")
    # a boundary after interval r (r + 1 intervals before it) competes for the cuts near its running weight
    low, high = F.floor(F.col("before") / per), F.ceil(F.col("cum") / per)
    near = ends.withColumn("j", F.explode(F.sequence(F.greatest(low, F.lit(0)).cast("int"), F.least(high + 1, F.lit(k)).cast("int")))).where(f"j between 1 and {k - 1}")
    best = near.groupBy("j").agg(F.min(F.struct(F.least(F.abs(F.col("before") - F.col("j") * per), F.abs(F.col("cum") - F.col("j") * per)).alias("d"), (F.when(F.abs(F.col("before") - F.col("j") * per) <= F.abs(F.col("cum") - F.col("j") * per), F.col("rank0")).otherwise(F.col("rank0") + 1)).alias("b"))).alias("x")).select("j", F.col("x.b").alias("b"))
    moved = best.withColumn("cut", F.col("j") + F.max(F.col("b") - F.col("j")).over(W.partitionBy(F.lit(0)).orderBy("j")))
    moved = moved.select("j", F.greatest("cut", "j").alias("cut"))
    filled = placed.withColumn("__r", F.when(F.col("weight") > 0, F.col("rank0")).otherwise(F.col("rank0") - 1))
    # every interval looks up the last cut at or before it, by union and a running maximum over its number
    whole = F.struct(*iv.columns)
    rows = filled.select(F.col("__r").cast("long").alias("__at"), F.lit(1).alias("__kind"), F.lit(None).cast("long").alias("__j"), whole.alias("__row"))
    marks = moved.select(F.col("cut").cast("long").alias("__at"), F.lit(0).alias("__kind"), F.col("j").cast("long").alias("__j"), F.lit(None).cast(rows.schema["__row"].dataType).alias("__row"))
    found = running(rows.unionByName(marks), "chunk", "max", F.col("__j"), ["__at", "__kind"], tile_of("__at", 100_000), keys=(), inclusive=True)
    return found.where("__kind = 1").select("__row.*", F.coalesce("chunk", F.lit(0)).alias("chunk"))


def chunk_balanced_split(iv: DataFrame, contigs: DataFrame, target: float) -> DataFrame:
    """Intervals cut where the running weight passes multiples of total / K; shares of length rounded half up, at least one
    base each; the last chunk takes the rest. Rows (chrom, start, end, weight, chunk)."""
    placed = with_prefix(iv, contigs)
    per = F.col("total") / F.greatest(F.lit(1), F.ceil(F.col("total") / target))
    k = F.greatest(F.lit(1), F.ceil(F.col("total") / target)).cast("long")
    first = F.least(k - 1, F.floor((F.col("before") + 1e-9) / per)).cast("long")
    last = F.least(k - 1, F.greatest(first, F.ceil((F.col("before") + F.col("weight")) / per - 1e-9) - 1)).cast("long")
    rows = placed.withColumns({"__per": per, "__first": first, "__last": last}).withColumn("chunk", F.explode(F.sequence("__first", "__last")))
    share = lambda c: F.when(F.col("weight") > 0, F.least(F.lit(1.0), F.greatest(F.lit(0.0), (c * F.col("__per") - F.col("before")) / F.col("weight")))).otherwise(F.lit(0.0))
    length = F.col("end") - F.col("start")
    lo = F.when(F.col("chunk") == F.col("__first"), F.lit(0)).otherwise(F.floor(length * share(F.col("chunk")) + 0.5))
    hi = F.when(F.col("chunk") == F.col("__last"), length).otherwise(F.floor(length * share(F.col("chunk") + 1) + 0.5))
    cut = rows.withColumns({"__lo": lo, "__hi": hi}).where("__hi > __lo or end = start")
    return cut.select("chrom", (F.col("start") + F.col("__lo")).cast("long").alias("start"), (F.col("start") + F.col("__hi")).cast("long").alias("end"), F.when(length > 0, F.col("weight") * (F.col("__hi") - F.col("__lo")) / length).otherwise(F.col("weight").cast("double")).alias("weight"), "chunk")


def interval_pipeline(counts: DataFrame, contigs: DataFrame, include: DataFrame, target: float, gap: int = 0, window: int | None = None, split: bool = False) -> DataFrame:
    """Counts of all samples summed into merged target intervals (or windows of them), then balanced chunks."""
    goal = merge(include.select("chrom", "start", "end"), gap)
    goal = make_windows(goal, window) if window else goal
    weighted = map_sum(goal, counts)
    return chunk_balanced_split(weighted, contigs, target) if split else chunk_balanced(weighted, contigs, target)
