"""Reads (read_id, mate, seq, qual, rg) and alignments (qname, flag, contig, pos, mapq, cigar, tlen, seq, qual, tags)."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from lociframe.operators.intervals import merge, overlap_pairs, overlap_semi, subtract
from lociframe.operators.pileup import pileup as tiled_pileup
from lociframe.operators.tiles import running, tile_of

#: Alignment flag bits.
UNMAPPED, MATE_UNMAPPED, REVERSE, READ1, SECONDARY, QC_FAIL, DUPLICATE, SUPPLEMENTARY = 0x4, 0x8, 0x10, 0x40, 0x100, 0x200, 0x400, 0x800
DROPPED = UNMAPPED | SECONDARY | QC_FAIL | DUPLICATE | SUPPLEMENTARY


def flag(bits: int) -> Column:
    return F.col("flag").bitwiseAND(F.lit(bits)) != 0


def parse_read_header(reads: DataFrame) -> DataFrame:
    """name without @ and /1 or /2; flowcell and lane from names of four or more fields, or (accession, 1)."""
    name = F.regexp_replace(F.regexp_replace(F.split(F.col("read_id"), r"\s")[0], "^@", ""), "/[12]$", "")
    fields = F.split(name, ":")
    accession = F.regexp_extract(name, r"^([SED]RR[0-9]+)", 1)
    lane = F.when(F.get(fields, F.lit(3)).rlike("^[0-9]+$"), F.get(fields, F.lit(3)).cast("int"))
    known = F.size(fields) >= 4
    return reads.withColumn("name", name).withColumn("flowcell", F.when(accession != "", accession).when(known, F.get(fields, F.lit(2)))).withColumn("lane", F.when(accession != "", F.lit(1)).when(known, lane))


def read_group_id(files: DataFrame) -> DataFrame:
    """Distinct read groups of files (flowcell, lane, lib, sample_id): id flowcell.lane.lib and its header line."""
    rg = F.concat_ws(".", "flowcell", F.col("lane").cast("string"), "lib")
    return files.withColumn("rg", rg).withColumn("header", F.concat_ws("\t", F.lit("@RG"), F.concat(F.lit("ID:"), rg), F.concat(F.lit("SM:"), F.col("sample_id")), F.concat(F.lit("LB:"), F.col("lib")))).dropDuplicates(["rg", "sample_id"])


def annotate_rg(reads: DataFrame) -> DataFrame:
    return reads.withColumn("read_id", F.concat_ws("|", "rg", "read_id"))


def strip_rg(aln: DataFrame, groups: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(alignments with the name split back and the RG tag replaced, rejected rows with a reason)."""
    cut = F.instr("qname", "|")
    parts = aln.withColumns({"__rg": F.when(cut > 0, F.substr("qname", F.lit(1), cut - 1)), "__name": F.when(cut > 0, F.substr("qname", cut + 1))})
    known = parts.join(groups.select(F.col("rg").alias("__rg"), F.lit(True).alias("__known")), "__rg", "left")
    reason = F.when(F.col("__rg").isNull(), "no prefix").when(F.col("__name") == "", "empty name").when(F.col("__known").isNull(), "unknown group")
    judged = known.withColumn("reason", reason)
    tags = F.map_concat(F.map_filter("tags", lambda k, _: k != "RG"), F.create_map(F.lit("RG"), F.col("__rg")))
    good = judged.where("reason is null").withColumn("qname", F.col("__name")).withColumn("tags", tags).select(*aln.columns)
    return good, judged.where("reason is not null").select(*aln.columns, "reason")


def pair_sync(r1: DataFrame, r2: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(pairs by group and name, unpaired reads with their mate number). Reads that repeat a name pair one to one, in order of their
    letters and qualities. Without a group or a name a read is unpaired."""
    keys = ["rg", "name", "__k"]
    order = W.partitionBy("rg", "name").orderBy("seq", "qual")
    a, b = (r.withColumn("__k", F.row_number().over(order)) for r in (r1, r2))
    pairs = a.select(*keys, F.col("seq").alias("seq1"), F.col("qual").alias("qual1")).join(b.select(*keys, F.col("seq").alias("seq2"), F.col("qual").alias("qual2")), keys)
    return pairs.drop("__k"), _unpaired(r1, r2)


def _unpaired(r1: DataFrame, r2: DataFrame) -> DataFrame:
    """(rg, name, mate): what one mate's reads of a name have beyond the other's. Only counted, as reads of one name do not differ here."""
    n = F.struct(*(F.coalesce(F.sum(F.when(F.col("mate") == i, 1)), F.lit(0)).alias(f"n{i}") for i in (1, 2)))
    both = r1.select("rg", "name", F.lit(1).alias("mate")).unionByName(r2.select("rg", "name", F.lit(2).alias("mate")))
    counted = both.groupBy("rg", "name").agg(n.alias("__n"))
    paired = F.when(F.col("rg").isNull() | F.col("name").isNull(), 0).otherwise(F.least("__n.n1", "__n.n2"))
    rest = counted.select("rg", "name", F.explode(F.array(*(F.struct(F.lit(i).alias("mate"), (F.col(f"__n.n{i}") - paired).alias("n")) for i in (1, 2)))).alias("x")).where("x.n > 0")
    # by the thousand, so that a name of very many reads makes no array of as many
    thousands = rest.select("rg", "name", "x.*", F.explode(F.sequence(F.lit(0).cast("long"), F.greatest(F.col("x.n") - 1, F.lit(0)), F.lit(1000).cast("long"))).alias("at"))
    return thousands.select("rg", "name", "mate", F.explode(F.array_repeat(F.lit(0), F.least(F.lit(1000), F.col("n") - F.col("at")).cast("int")))).drop("col")


def _cut(reads: DataFrame, length: Column) -> DataFrame:
    return reads.withColumn("__n", length).withColumns({"seq": F.substr("seq", F.lit(1), F.col("__n").cast("int")), "qual": F.substr("qual", F.lit(1), F.col("__n").cast("int"))}).drop("__n")


def trim_poly_g(reads: DataFrame, min_len: int = 10) -> DataFrame:
    tail = F.length(F.regexp_extract("seq", f"(G{{{min_len},}})$", 1))
    return _cut(reads, F.length("seq") - tail)


def cut_right(reads: DataFrame, window: int = 4, q: int = 20) -> DataFrame:
    """Cut at the first window whose mean quality is below q. Qualities shorter than a window are one window."""

    def first_low(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for quals in batches:
            texts = quals.dropna()
            sizes = texts.str.len().to_numpy(np.int64)
            codes = np.frombuffer("".join(texts).encode("utf-32-le"), np.uint32).astype(np.int64) - 33
            total = np.concatenate([[0], np.cumsum(codes)])
            begin = np.cumsum(sizes) - sizes
            starts = np.maximum(sizes - window, 0) + 1  # windows of a read
            of = np.repeat(np.arange(len(sizes)), starts)
            i = np.arange(len(of)) - np.repeat(np.cumsum(starts) - starts, starts)
            end = begin[of] + np.minimum(i + window, sizes[of])
            low = np.flatnonzero(total[end] - total[begin[of] + i] < q * window)
            row, at = np.unique(of[low], return_index=True)
            cut = np.full(len(sizes), -1)
            cut[row] = i[low[at]]
            yield pd.Series(cut, index=texts.index).reindex(quals.index, fill_value=-1).astype(np.int32)

    low = F.pandas_udf(first_low, "int")("qual")
    return _cut(reads.withColumn("__low", low), F.when(F.col("__low") >= 0, F.col("__low")).otherwise(F.length("seq"))).drop("__low")


def read_filter(reads: DataFrame, min_len: int = 15, max_n: int = 5, complexity: float = 0.30) -> DataFrame:
    """Long enough, few N, and enough neighbours that differ."""
    n = F.length("seq") - F.length(F.translate("seq", "N", ""))
    # what runs of one character have beyond their first is what does not differ from its neighbour
    changes = F.greatest(F.length(F.regexp_replace("seq", r"(?s)(.)\1+", "$1")) - 1, F.lit(0))
    return reads.where((F.length("seq") >= min_len) & (n <= max_n) & (changes >= complexity * (F.length("seq") - 1)))


def aligned_length(cigar: str = "cigar") -> Column:
    """Reference bases covered: lengths of M, D, N, = and X."""
    return F.aggregate(F.regexp_extract_all(cigar, F.lit(r"([0-9]+)[MDN=X]"), F.lit(1)), F.lit(0).cast("long"), lambda a, x: a + x.cast("long"))


def alignment_filter(aln: DataFrame, drop_flags: int = DROPPED, min_mapq: int = 20, proper_pair: bool = False, frag: tuple[int, int] = (15, 10_000), min_aligned: int = 30) -> DataFrame:
    """Flags, mapping quality, fragment length (unpaired reads have none) and aligned length."""
    pair = (F.col("flag").bitwiseAND(F.lit(0x2)) != 0) if proper_pair else F.lit(True)
    size = (F.col("tlen") == 0) | F.abs("tlen").between(*frag)
    return aln.where(~flag(drop_flags) & (F.col("mapq") >= min_mapq) & pair & size & (F.col("aligned") >= min_aligned))


def mark_duplicate_reads(aln: DataFrame) -> DataFrame:
    """Single reads, without mates and clips (`duplicates.mark_duplicates` has both). `duplicate`: all but the best (quality sum, then name) of the reads with equal group, 5' ends and strand."""
    five = F.when(flag(REVERSE), F.col("end")).otherwise(F.col("start"))
    w = W.partitionBy("rg", "chrom", "__five", "__strand").orderBy(F.desc("qual_sum"), "qname")
    return aln.withColumns({"__five": five, "__strand": flag(REVERSE)}).withColumn("duplicate", F.row_number().over(w) > 1).drop("__five", "__strand")


def unmapped_pairs(aln: DataFrame) -> DataFrame:
    """Pairs of which neither read is mapped, one row each."""
    both = aln.where(F.col("flag").bitwiseAND(F.lit(UNMAPPED | MATE_UNMAPPED)) == (UNMAPPED | MATE_UNMAPPED))
    first = flag(READ1)
    return both.groupBy("qname").agg(F.max(F.when(first, F.col("seq"))).alias("seq1"), F.max(F.when(~first, F.col("seq"))).alias("seq2")).where("seq1 is not null and seq2 is not null")


def recruit_region_reads(aln: DataFrame, *regions: DataFrame) -> DataFrame:
    """Primary reads, not duplicates, that overlap any of the regions."""
    target = regions[0].select("chrom", "start", "end")
    for r in regions[1:]:
        target = target.unionByName(r.select("chrom", "start", "end"))
    return overlap_semi(aln.where(~flag(UNMAPPED | SECONDARY | DUPLICATE | SUPPLEMENTARY)), merge(target))


def per_base_depth(aln: DataFrame, min_mapq: int = 0, drop_flags: int = DROPPED) -> DataFrame:
    """Run-length depth (chrom, start, end, depth > 0): a sweep over summed +1/-1 events, in tiles of a contig."""
    used = aln.where((F.col("mapq") >= min_mapq) & ~flag(drop_flags) & (F.col("end") > F.col("start")))
    events = used.select("chrom", F.explode(F.array(F.struct(F.col("start").alias("at"), F.lit(1).alias("d")), F.struct(F.col("end").alias("at"), F.lit(-1).alias("d")))).alias("e")).groupBy("chrom", F.col("e.at").alias("start")).agg(F.sum("e.d").alias("d")).where("d <> 0")
    deep = running(events, "depth", "sum", F.col("d"), ["start"], tile_of("start"), inclusive=True)
    runs = running(deep, "end", "next", F.col("start"), ["start"], tile_of("start")).select("chrom", "start", "end", "depth")
    return runs.where("depth > 0 and end is not null")


def covered_intervals(depth: DataFrame, mask: DataFrame, min_depth: int) -> DataFrame:
    """Depth outside the mask and at least min_depth, weight (end - start) * depth, merged."""
    left = subtract(depth, mask.select("chrom", "start", "end")).where(F.col("depth") >= min_depth)
    return merge(left.withColumn("weight", (F.col("end") - F.col("start")) * F.col("depth")), 0, {"weight": F.sum("weight")})


def contig_coverage(aln: DataFrame, contigs: DataFrame) -> DataFrame:
    """Per contig: reads, covered bases and share, mean depth, mean mapping quality."""
    used = aln.where(~flag(DROPPED))
    reads = used.groupBy("chrom").agg(F.count(F.lit(1)).alias("n_reads"), F.avg("mapq").alias("mean_mapq"))
    span = F.col("end") - F.col("start")
    depth = per_base_depth(used).groupBy("chrom").agg(F.sum(span).alias("covered"), F.sum(span * F.col("depth")).alias("bases"))
    joined = contigs.select(F.col("contig").alias("chrom"), "length").join(reads, "chrom", "left").join(depth, "chrom", "left").na.fill(0)
    return joined.select("chrom", "n_reads", "covered", (100.0 * F.col("covered") / F.col("length")).alias("coverage"), (F.col("bases") / F.col("length")).alias("mean_depth"), "mean_mapq")


def downsample_to_coverage(aln: DataFrame, targets: DataFrame, x: float, seed: int = 42) -> DataFrame:
    """Templates kept so that each sample's mean depth over the targets comes down to x; by a hash of the name, so mates stay together."""
    goal = merge(targets.select("chrom", "start", "end"))
    size = goal.agg(F.sum(F.col("end") - F.col("start")).alias("__size"))
    depth = overlap_pairs(aln, goal).groupBy("sample_id").agg(F.sum("overlap").alias("__bases")).crossJoin(F.broadcast(size))
    share = depth.select("sample_id", F.least(F.lit(1.0), x * F.col("__size") / F.col("__bases")).alias("__f"))
    return aln.join(share, "sample_id", "left").where(F.pmod(F.xxhash64("qname", F.lit(seed)), F.lit(1_000_000)) < F.coalesce("__f", F.lit(1.0)) * 1_000_000).drop("__f")


def pileup(aln: DataFrame, min_bq: int = 13, min_mq: int = 20, trim: int = 0, max_depth: int = 1000) -> DataFrame:
    """Allele counts per site and sample, as `pileup.pileup`, without unmapped, secondary, failed, duplicate and supplementary reads."""
    return tiled_pileup(aln, DROPPED, min_bq, min_mq, trim, max_depth)


def insert_sizes(aln: DataFrame) -> DataFrame:
    """Histogram of fragment lengths."""
    return aln.where("tlen > 0").groupBy(F.col("tlen").cast("long").alias("size")).agg(F.count(F.lit(1)).alias("n"))


def alignment_qc(aln: DataFrame) -> DataFrame:
    """Counts of all, mapped, secondary, duplicate, low-quality alignments, mean and median fragment length."""
    count = lambda c: F.sum(c.cast("long"))
    size = F.when(F.col("tlen") > 0, F.col("tlen"))
    return aln.agg(F.count(F.lit(1)).alias("n"), count(~flag(UNMAPPED)).alias("n_mapped"), count(flag(SECONDARY)).alias("n_secondary"), count(flag(DUPLICATE)).alias("n_duplicate"), count(F.col("mapq") < 20).alias("n_low_mapq"), F.avg(size).alias("mean_insert"), F.expr("percentile(case when tlen > 0 then tlen end, 0.5)").alias("median_insert"))


def depth_distribution(depth: DataFrame, cap: int = 250) -> DataFrame:
    """Bases per depth, capped."""
    return depth.groupBy(F.least("depth", F.lit(cap)).cast("long").alias("depth")).agg(F.sum(F.col("end") - F.col("start")).alias("bases"))


def read_qc(reads: DataFrame) -> DataFrame:
    """Per position: reads, mean quality, GC share."""
    at = reads.select(F.posexplode(F.split("qual", "")).alias("i", "c"), "seq").where("c <> ''")
    gc = F.substr("seq", F.col("i") + 1, F.lit(1)).isin("G", "C", "g", "c")
    return at.groupBy((F.col("i") + 1).cast("long").alias("cycle")).agg(F.count(F.lit(1)).alias("n"), F.avg(F.ascii("c") - 33).alias("mean_quality"), F.avg(gc.cast("double")).alias("gc"))


def base_composition(reads: DataFrame) -> DataFrame:
    """(cycle, base, n): bases by their place in the read, in upper case; all but A, C, G and T are N."""
    at = reads.select(F.posexplode(F.split("seq", "")).alias("i", "c")).where("c <> ''").withColumn("c", F.upper("c"))
    base = F.when(F.col("c").isin("A", "C", "G", "T"), F.col("c")).otherwise("N")
    return at.groupBy((F.col("i") + 1).cast("long").alias("cycle"), base.alias("base")).agg(F.count(F.lit(1)).alias("n"))


def gc_bias(aln: DataFrame, windows: DataFrame, size: int) -> DataFrame:
    """(gc, windows, reads, normalised): whole windows by GC percent (`sequence.gc_windows`), the reads that start in them, and reads a
    window over the mean of all."""
    starts = aln.where(~flag(DROPPED)).groupBy(F.col("chrom").alias("contig"), F.floor(F.col("start") / size).alias("bin")).agg(F.count(F.lit(1)).alias("r"))
    bins = windows.join(starts, ["contig", "bin"], "left").groupBy("gc").agg(F.count(F.lit(1)).alias("windows"), F.coalesce(F.sum("r"), F.lit(0)).alias("reads"))
    mean = bins.agg((F.sum("reads") / F.sum("windows")).alias("__mean"))
    return bins.crossJoin(F.broadcast(mean)).select("gc", "windows", "reads", (F.col("reads") / F.col("windows") / F.when(F.col("__mean") > 0, F.col("__mean"))).alias("normalised"))


def length_and_duplication(reads: DataFrame) -> DataFrame:
    """Reads per length with the number of distinct sequences."""
    return reads.groupBy(F.length("seq").cast("long").alias("length")).agg(F.count(F.lit(1)).alias("n"), F.countDistinct("seq").alias("n_distinct"))


def reuse_validation(expected: DataFrame, observed: DataFrame) -> DataFrame:
    """PASS where a sample's read groups and configuration hash are as expected and its name stands once. Frames (sample_id, rg, config)."""
    def shape(df: DataFrame, p: str) -> DataFrame:
        return df.groupBy("sample_id").agg(F.array_sort(F.collect_set("rg")).alias(f"{p}_groups"), F.sha2(F.concat_ws("\n", F.array_sort(F.collect_set("config"))), 256).alias(f"{p}_hash"))

    both = shape(expected, "e").join(shape(observed, "o"), "sample_id")
    ok = (F.col("e_groups") == F.col("o_groups")) & (F.col("e_hash") == F.col("o_hash"))
    return both.select("sample_id", F.when(ok, "PASS").otherwise("FAIL").alias("status"))


def recalibration_qc(recal: DataFrame, by: list[str]) -> DataFrame:
    """Root mean square error of reported against empirical quality, weighted by observations, per group."""
    err = F.pow(F.col("QualityScore") - F.col("EmpiricalQuality"), F.lit(2)) * F.col("Observations")
    return recal.groupBy(*by).agg(F.sqrt(F.sum(err) / F.sum("Observations")).alias("rmse"), F.sum("Observations").alias("observations"))
