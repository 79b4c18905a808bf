"""Interval algebra on frames (chrom, start, end, ...): 0-based, half-open.

Range joins are equi-joins on (chrom, bin): each interval is placed in every bin it touches and a pair is taken in the first
bin that both touch, so no pair comes twice and nothing is compared across bins. Islands and as-of lookups run in
tiles of a contig (`tiles`), so a large contig is many tasks. Empty intervals (end <= start) overlap nothing.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lociframe.operators.tiles import TILE, numbered, running, tile_of

BIN = 16_384


def _binned(iv: DataFrame, start: str, end: str, width: int) -> DataFrame:
    first, last = F.floor(F.col(start) / width), F.floor((F.col(end) - 1) / width)
    return iv.where(F.col(end) > F.col(start)).withColumns({"__first": first, "__bin": F.explode(F.sequence(first, last))})


def overlap_pairs(a: DataFrame, b: DataFrame, width: int = BIN) -> DataFrame:
    """Every overlapping pair once: a's columns, b's columns prefixed `b_`, and `overlap` in bases."""
    right = _binned(b.select(*(F.col(c).alias(f"b_{c}") for c in b.columns)), "b_start", "b_end", width).withColumnRenamed("__first", "__b_first").withColumnRenamed("__bin", "__b_bin")
    left = _binned(a, "start", "end", width)
    on = (F.col("chrom") == F.col("b_chrom")) & (F.col("__bin") == F.col("__b_bin")) & (F.col("start") < F.col("b_end")) & (F.col("b_start") < F.col("end"))
    pairs = left.join(right, on).where(F.col("__bin") == F.greatest("__first", "__b_first"))
    return pairs.withColumn("overlap", F.least("end", "b_end") - F.greatest("start", "b_start")).drop("__first", "__bin", "__b_first", "__b_bin")


def sort_genome_order(iv: DataFrame, contigs: DataFrame) -> DataFrame:
    """Rows by contig rank, start, end. contigs: (contig, length, rank); unknown contigs come last."""
    ranked = iv.join(contigs.select(F.col("contig").alias("chrom"), F.col("rank").alias("__rank")), "chrom", "left")
    return ranked.orderBy(F.col("__rank").asc_nulls_last(), "chrom", "start", "end").drop("__rank")


def islands(iv: DataFrame, gap: int = 0, tile: int = TILE) -> DataFrame:
    """iv with `island`: rows of a contig whose gap to everything before is at most `gap` share a number, the start of the first."""
    reached = running(iv, "__reach", "max", F.col("end"), ["start", "end"], tile_of("start", tile))
    fresh = F.col("__reach").isNull() | (F.col("start") - F.col("__reach") > gap)
    return running(reached, "island", "last", F.when(fresh, F.col("start")), ["start", "end", "__reach"], tile_of("start", tile), inclusive=True).drop("__reach")


def merge(iv: DataFrame, gap: int = 0, aggs: dict[str, Column] | None = None, tile: int = TILE) -> DataFrame:
    """Intervals merged where the gap is at most `gap` (0 joins neighbours that touch), with extra aggregates by name."""
    named = [c.alias(n) for n, c in (aggs or {}).items()]
    return islands(iv, gap, tile).groupBy("chrom", "island").agg(F.min("start").alias("start"), F.max("end").alias("end"), *named).drop("island")


def distinct_labels(col: str = "label") -> Column:
    """Aggregate: the distinct labels in order, comma-joined."""
    return F.concat_ws(",", F.array_sort(F.collect_set(col)))


def subtract(a: DataFrame, b: DataFrame, width: int = BIN) -> DataFrame:
    """What is left of each interval of `a` outside `b`; fragments keep a's columns. b is merged first, so cuts of one
    interval are disjoint and its array of cuts is as long as it has merged b intervals in it."""
    key = [F.col(c) for c in a.columns]
    cuts = overlap_pairs(a, merge(b), width).groupBy(*key).agg(F.array_sort(F.collect_set(F.struct("b_start", "b_end"))).alias("__cuts"))
    cuts = cuts.select(*(F.col(c).alias(f"__k_{c}") for c in a.columns), "__cuts")
    joined = a.join(cuts, [F.col(c).eqNullSafe(F.col(f"__k_{c}")) for c in a.columns], "left").select(*a.columns, F.coalesce("__cuts", F.expr("cast(array() as array<struct<b_start:bigint,b_end:bigint>>)")).alias("__cuts"))
    begins = F.concat(F.array(F.col("start").cast("long")), F.transform("__cuts", lambda x: x["b_end"].cast("long")))
    stops = F.concat(F.transform("__cuts", lambda x: x["b_start"].cast("long")), F.array(F.col("end").cast("long")))
    parts = F.filter(F.zip_with(begins, stops, lambda x, y: F.struct(x.alias("s"), y.alias("e"))), lambda p: p["s"] < p["e"])
    exploded = joined.withColumn("__part", F.explode(parts))
    return exploded.select(*(F.col("__part.s").alias("start") if c == "start" else F.col("__part.e").alias("end") if c == "end" else F.col(c) for c in a.columns))


def intersect_wo(a: DataFrame, b: DataFrame, width: int = BIN) -> DataFrame:
    """Overlapping pairs with the number of shared bases."""
    return overlap_pairs(a, b, width)


def overlap_semi(a: DataFrame, b: DataFrame, width: int = BIN) -> DataFrame:
    """Rows of `a` that overlap any of `b`, each once."""
    return _overlap_exists(a, b, width, True)


def overlap_anti(a: DataFrame, b: DataFrame, width: int = BIN) -> DataFrame:
    """Rows of `a` that overlap none of `b`."""
    return _overlap_exists(a, b, width, False)


def _overlap_exists(a: DataFrame, b: DataFrame, width: int, wanted: bool) -> DataFrame:
    # b merged and placed in bins: at most a few per bin, so each row of a meets few; a's rows are kept whole by one id
    tagged = a.withColumn("__id", F.struct(*a.columns))
    hit = overlap_pairs(tagged, merge(b.select("chrom", "start", "end")), width).select(F.xxhash64("__id").alias("__h"), F.col("__id").alias("__row")).distinct()
    how = "left_semi" if wanted else "left_anti"
    return a.join(hit, (F.xxhash64(F.struct(*a.columns)) == F.col("__h")) & F.struct(*a.columns).eqNullSafe(F.col("__row")), how)


def complement(iv: DataFrame, contigs: DataFrame) -> DataFrame:
    """Gaps of the merged intervals over the contigs, contigs without any included whole."""
    merged = merge(iv.where("end > start"))
    edges = merged.select("chrom", "start", "end").unionByName(contigs.select(F.col("contig").alias("chrom"), F.col("length").alias("start"), F.col("length").alias("end")))
    known = contigs.select(F.col("contig").alias("chrom"))
    reached = running(edges.join(known, "chrom", "left_semi"), "__reach", "max", F.col("end"), ["start", "end"], tile_of("start"))
    return reached.select("chrom", F.coalesce("__reach", F.lit(0)).cast("long").alias("start"), F.col("start").cast("long").alias("end")).where("end > start")


def slop(iv: DataFrame, bases: int, contigs: DataFrame) -> DataFrame:
    """Both sides padded, clipped to the contig."""
    sized = iv.join(contigs.select(F.col("contig").alias("chrom"), F.col("length").alias("__len")), "chrom")
    return sized.withColumns({"start": F.greatest(F.lit(0), F.col("start") - bases), "end": F.least("__len", F.col("end") + bases)}).select(*iv.columns)


def map_sum(a: DataFrame, b: DataFrame, width: int = BIN) -> DataFrame:
    """Rows of `a` with `weight`: the sum of b's weights over overlapping intervals; rows without any are left out."""
    key = [c for c in a.columns if c != "weight"]
    return overlap_pairs(a.select(*key), b, width).groupBy(*key).agg(F.sum("b_weight").alias("weight")).where("weight <> 0")


def make_windows(iv: DataFrame, size: int, step: int | None = None) -> DataFrame:
    """Windows of `size` every `step` (default: tiles) inside each interval, the last one cut; size 1 gives sites."""
    begin = F.explode(F.sequence(F.col("start").cast("long"), F.col("end").cast("long") - 1, F.lit(step or size).cast("long")))
    wide = iv.where("end > start").select(*(c for c in iv.columns if c != "start"), begin.alias("start"))
    return wide.withColumn("end", F.least(F.col("start") + size, F.col("end"))).select(*iv.columns)


def site_in_mask(sites: DataFrame, mask: DataFrame, name: str = "in_mask") -> DataFrame:
    """sites (chrom, pos 1-based, ...) with 1 if pos - 1 lies in the mask, else 0: an as-of lookup of the last merged
    interval that starts at or before the site, by union and a running last value in tiles."""
    merged = merge(mask.select("chrom", "start", "end"))
    kept = F.struct(*sites.columns)
    both = sites.select("chrom", (F.col("pos") - 1).alias("__at"), F.lit(1).alias("__kind"), F.lit(None).cast("long").alias("__end"), kept.alias("__row")).unionByName(
        merged.select("chrom", F.col("start").alias("__at"), F.lit(0).alias("__kind"), F.col("end").cast("long").alias("__end"), F.lit(None).cast(sites.schema).alias("__row"))
    )
    flagged = running(both, "__last", "last", F.col("__end"), ["__at", "__kind"], tile_of("__at"), inclusive=True).where("__kind = 1")
    return flagged.select("__row.*", F.coalesce((F.col("__at") < F.col("__last")).cast("int"), F.lit(0)).alias(name))


def label_lengths(iv: DataFrame) -> DataFrame:
    """Bases per label."""
    return iv.groupBy("label").agg(F.sum(F.col("end") - F.col("start")).alias("bases"))


def span_by_contig(iv: DataFrame) -> DataFrame:
    """One [min start, max end) per contig."""
    return iv.groupBy("chrom").agg(F.min("start").alias("start"), F.max("end").alias("end"))


def contig_classes(contigs: DataFrame, min_length: int) -> DataFrame:
    """contigs as whole-contig intervals with class long or short."""
    return contigs.select(F.col("contig").alias("chrom"), F.lit(0).cast("long").alias("start"), F.col("length").alias("end"), F.when(F.col("length") >= min_length, "long").otherwise("short").alias("class"))


def restrict_to_contigs(contigs: DataFrame, iv: DataFrame) -> DataFrame:
    """Contigs that the intervals name."""
    return contigs.join(iv.select(F.col("chrom").alias("contig")), "contig", "left_semi")


def windows_around_points(sites: DataFrame, radius: int) -> DataFrame:
    """[max(0, pos - r), pos + r) around each site, merged."""
    return merge(sites.select("chrom", F.greatest(F.lit(0), F.col("pos") - radius).alias("start"), (F.col("pos") + radius).alias("end")))


#: Ranges of a sample that are made in one task at a time.
RANGES = 1_000


def read_ranges(counts: DataFrame, size: int, limit: int = 99_999) -> DataFrame:
    """(sample, first, last, part): reads 1..n in ranges of `size`, the last one takes the rest; at most `limit` ranges.

    Samples are few and their ranges many, so a sample's ranges are dealt by the RANGES before they are made."""
    parts = F.least(F.greatest(F.ceil(F.col("n_reads") / size), F.lit(1)), F.lit(limit))
    some = counts.withColumn("__n", parts.cast("int")).withColumn("__from", F.explode(F.sequence(F.lit(1), F.col("__n"), F.lit(RANGES))))
    # a number of partitions, as rows so small would be put together again
    dealt = some.repartition(int(counts.sparkSession.conf.get("spark.sql.shuffle.partitions")), F.xxhash64("sample_id", "n_reads", "__from"))
    wide = dealt.withColumn("part", F.explode(F.sequence(F.col("__from"), F.least(F.col("__from") + (RANGES - 1), F.col("__n")))))
    last = F.when(F.col("part") == F.col("__n"), F.col("n_reads")).otherwise(F.col("part") * size)
    return wide.select("sample_id", ((F.col("part") - 1) * size + 1).cast("long").alias("first"), last.cast("long").alias("last"), "part")


def regions_every_n_sites(sites: DataFrame, n: int) -> DataFrame:
    """Per contig, regions that start at every n-th site and end before the next; the last ends at the last site."""
    marked = numbered(sites.select("chrom", "pos").distinct(), "__i")
    heads = running(marked.where(F.col("__i") % n == 0), "__next", "next", F.col("pos"), ["pos"], tile_of("pos"))
    # one row per contig
    last = sites.groupBy("chrom").agg(F.max("pos").alias("__last"))
    return heads.join(last, "chrom").select("chrom", F.col("pos").alias("start"), F.coalesce(F.col("__next") - 1, F.col("__last")).alias("end"))


def full_length_check(iv: DataFrame, contigs: DataFrame) -> DataFrame:
    """One row: n_contigs, n_rows, n_full (rows that span their contig), merge_flag (several rows, all of them full)."""
    joined = iv.join(contigs.select(F.col("contig").alias("chrom"), F.col("length").alias("__len")), "chrom", "left")
    full = F.coalesce((F.col("start") == 0) & (F.col("end") == F.col("__len")), F.lit(False))
    out = joined.agg(F.countDistinct("chrom").alias("n_contigs"), F.count(F.lit(1)).alias("n_rows"), F.coalesce(F.sum(full.cast("long")), F.lit(0)).alias("n_full"))
    return out.withColumn("merge_flag", (F.col("n_rows") > 1) & (F.col("n_full") == F.col("n_rows")))


def pad_regions(iv: DataFrame, pad: int) -> DataFrame:
    """Padded regions with their `chrom:start-end` string; negative starts become 0."""
    start, end = F.greatest(F.lit(0), F.col("start") - pad), F.col("end") + pad
    return iv.select("chrom", start.alias("start"), end.alias("end"), F.concat(F.col("chrom"), F.lit(":"), start, F.lit("-"), end).alias("region"))


def missing_fraction(covered: DataFrame, target: DataFrame) -> DataFrame:
    """Per sample of `covered` (sample_id, chrom, start, end): present and target bases, and 1 - present / target (1 for an empty target)."""
    goal = merge(target.select("chrom", "start", "end"))
    total = goal.agg(F.coalesce(F.sum(F.col("end") - F.col("start")), F.lit(0)).alias("TARGET_BASES"))
    present = overlap_pairs(covered, goal).groupBy("sample_id").agg(F.sum("overlap").alias("__present"))
    samples = covered.select("sample_id").distinct().join(present, "sample_id", "left").crossJoin(F.broadcast(total))
    fraction = F.when(F.col("TARGET_BASES") == 0, F.lit(1.0)).otherwise(1 - F.col("PRESENT_BASES") / F.col("TARGET_BASES"))
    return samples.withColumn("PRESENT_BASES", F.coalesce("__present", F.lit(0))).select("sample_id", "PRESENT_BASES", "TARGET_BASES", fraction.alias("MISSING_FRACTION"))
