"""Site, genotype, sample and population filters.

A comparison with a missing value is not a failure: every predicate is wrapped so that unknown counts as false. All filters
of a site are built in one projection, so they run in one stage after the tag aggregation.
"""

from __future__ import annotations

import functools
import math
from collections import Counter

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, StructField, StructType

from lociframe.operators.intervals import overlap_pairs, site_in_mask, windows_around_points
from lociframe.operators.lineage import kept
from lociframe.operators.params import FilterParams, TypeThresholds
from lociframe.operators.tiles import near, running

SITE = ["chrom", "pos"]
#: Metrics of each population.
POP_METRICS = ("NS", "MAF", "CR", "HWE", "ExcHet")


def true(c: Column) -> Column:
    return F.coalesce(c, F.lit(False))


# genotypes and samples


def mask_genotypes(gt: DataFrame, gq: int | None, dp_min: int | None, dp_max: int | None) -> DataFrame:
    """dosage set to null where GQ or DP is out of bounds."""
    bad = F.lit(False)
    for c, low, high in (("gq", gq, None), ("dp", dp_min, dp_max)):
        bad = bad | (true(F.col(c) < low) if low is not None else F.lit(False)) | (true(F.col(c) > high) if high is not None else F.lit(False))
    return gt.withColumn("dosage", F.when(~bad, F.col("dosage")))


def sample_missingness(gt: DataFrame, n_sites: DataFrame | int) -> DataFrame:
    """Per sample (SAMPLE, PRESENT_BASES, TARGET_BASES, MISSING_FRACTION): cells without a row are missing too."""
    present = gt.groupBy(F.col("sample_id").alias("SAMPLE")).agg(F.count("dosage").alias("PRESENT_BASES"))
    total = present.withColumn("TARGET_BASES", F.lit(n_sites).cast("long")) if isinstance(n_sites, int) else present.crossJoin(F.broadcast(n_sites.agg(F.count(F.lit(1)).alias("TARGET_BASES"))))
    return total.withColumn("MISSING_FRACTION", F.when(F.col("TARGET_BASES") == 0, F.lit(0.0)).otherwise((F.col("TARGET_BASES") - F.col("PRESENT_BASES")) / F.col("TARGET_BASES")))


def keep_samples(missing: DataFrame, maximum: float) -> DataFrame:
    """Samples strictly below the maximum."""
    return missing.where(F.col("MISSING_FRACTION") < maximum).select(F.col("SAMPLE").alias("sample_id"))


def sample_missing_qc(missing: DataFrame, maximum: float, bins: int = 20) -> DataFrame:
    """PASS/FAIL histogram of missing fractions; FAIL only above the maximum, so equality is dropped above yet labelled PASS."""
    status = F.when(F.col("MISSING_FRACTION") > maximum, "FAIL").otherwise("PASS")
    return missing.groupBy(status.alias("STATUS"), F.least(F.floor(F.col("MISSING_FRACTION") * bins), F.lit(bins - 1)).cast("long").alias("BIN")).agg(F.count(F.lit(1)).alias("COUNT"))


def population_groups(popmap: DataFrame, kept: DataFrame, min_n: int) -> DataFrame:
    """Retained samples with cleaned population names (no whitespace or underscore); small populations are left out."""
    named = popmap.join(kept, "sample_id", "left_semi").withColumn("pop", F.regexp_replace("pop", r"[\s_]", ""))
    return named.withColumn("__n", F.count(F.lit(1)).over(W.partitionBy("pop"))).where(F.col("__n") >= min_n).drop("__n")


def sample_subset_common(gt: DataFrame, samples: DataFrame) -> DataFrame:
    """Genotypes of the samples that both sides name."""
    return gt.join(samples.select("sample_id"), "sample_id", "left_semi")


# depth


def depth_histogram(sites: DataFrame, missing: str = "zero") -> DataFrame:
    """Sites per depth; a missing depth counts as 0 ("zero") or not at all ("skip")."""
    depth = F.coalesce(F.col("dp"), F.lit(0)) if missing == "zero" else F.col("dp")
    return sites.select(depth.cast("long").alias("depth")).where("depth is not null").groupBy("depth").agg(F.count(F.lit(1)).alias("count"))


def merge_histograms(*hists: DataFrame) -> DataFrame:
    out = hists[0]
    for h in hists[1:]:
        out = out.unionByName(h)
    return out.groupBy("depth").agg(F.sum("count").alias("count"))


def depth_bounds(hist: DataFrame, low: float, high: float) -> DataFrame:
    """(DPlower, DPupper): nearest-rank percentiles, rank ceil(p/100 * total) and at least 1. One row per depth is windowed."""
    order = W.partitionBy(F.lit(0)).orderBy("depth").rowsBetween(W.unboundedPreceding, 0)
    cum = hist.select("depth", F.sum("count").over(order).alias("cum"), F.sum("count").over(W.partitionBy(F.lit(0))).alias("total"))
    rank = lambda p: F.greatest(F.lit(1), F.ceil(F.lit(p) / 100 * F.col("total")))
    return cum.agg(F.min(F.when(F.col("cum") >= rank(low), F.col("depth"))).alias("DPlower"), F.min(F.when(F.col("cum") >= rank(high), F.col("depth"))).alias("DPupper"))


def depth_percentile_index(stats: DataFrame, low: float, high: float) -> DataFrame:
    """Values at 0-based positions floor(n * p) of the sorted depths, read off the histogram of depths."""
    hist = stats.where("dp is not null").groupBy("dp").agg(F.count(F.lit(1)).alias("n"))
    whole = W.partitionBy(F.lit(0))
    cum = hist.select("dp", F.sum("n").over(whole.orderBy("dp").rowsBetween(W.unboundedPreceding, 0)).alias("cum"), F.sum("n").over(whole).alias("total"))
    at = lambda p: F.min(F.when(F.col("cum") > F.floor(F.col("total") * p), F.col("dp")))
    return cum.agg(at(low).alias("lower"), at(high).alias("upper"))


# sites


def biallelic(sites: DataFrame) -> DataFrame:
    """Exactly two alleles; invariant rows leave here too."""
    return sites.where(F.size("alt") == 1)


def site_tags(gt: DataFrame, sites: DataFrame, n_samples: int | DataFrame | None = None) -> DataFrame:
    """Sites with AC, AN, NS, MAF, F_MISSING, CR and summed DP. The cohort is `n_samples`, or the samples of gt."""
    cohort = gt.agg(F.countDistinct("sample_id").alias("__n")) if n_samples is None else n_samples
    counts = gt.groupBy(*SITE).agg(F.coalesce(F.sum("dosage"), F.lit(0)).alias("AC"), F.count("dosage").alias("NS"), F.sum("dp").alias("DP"))
    sized = counts.withColumn("__n", F.lit(cohort)) if isinstance(cohort, int) else counts.crossJoin(F.broadcast(cohort))
    freq = F.when(F.col("NS") > 0, F.col("AC") / (2 * F.col("NS")))
    tags = sized.select(*SITE, "AC", (2 * F.col("NS")).alias("AN"), "NS", F.least(freq, 1 - freq).alias("MAF"), (1 - F.col("NS") / F.col("__n")).alias("F_MISSING"), (F.col("NS") / F.col("__n")).alias("CR"), "DP")
    return sites.join(tags, SITE)


def genotype_counts(gt: DataFrame, by: list[str] | None = None) -> DataFrame:
    """n0, n1, n2: called genotypes of each dosage."""
    return gt.groupBy(*SITE, *(by or [])).agg(*(F.sum((F.col("dosage") == d).cast("int")).alias(f"n{d}") for d in (0, 1, 2))).na.fill(0, ["n0", "n1", "n2"])


@functools.lru_cache(2)
def _log_factorials(size: int) -> np.ndarray:
    return np.array([math.lgamma(i + 1) for i in range(size)])


def log_factorials(n: int) -> np.ndarray:
    """ln(i!) for i up to n at least; tables double in size, so few are made."""
    return _log_factorials(1 << max(10, (n + 1).bit_length()))


def hwe_p(n_hom: int, n_het: int, n_alt: int) -> tuple[float, float]:
    """Exact Hardy-Weinberg p and the p of excess heterozygosity, over all heterozygote counts that the alleles allow."""
    n = n_hom + n_het + n_alt
    rare = min(2 * n_hom + n_het, 2 * n_alt + n_het)
    if n == 0:
        return 1.0, 1.0
    hets, table = np.arange(rare % 2, rare + 1, 2), log_factorials(n)
    logs = table[n] - table[(rare - hets) // 2] - table[hets] - table[n - (rare + hets) // 2] + hets * math.log(2)
    p = np.exp(logs - logs.max())
    p /= p.sum()
    here = p[(n_het - rare % 2) // 2]
    return float(min(1.0, p[p <= here * (1 + 1e-9)].sum())), float(min(1.0, p[hets >= n_het].sum()))


@F.pandas_udf(StructType([StructField("HWE", DoubleType()), StructField("ExcHet", DoubleType())]))
def hwe_test(n0: pd.Series, n1: pd.Series, n2: pd.Series) -> pd.DataFrame:
    """Exact tests of a batch of counts; each distinct triple of the batch is tested once. Null counts are zero."""
    triples = np.column_stack([x.fillna(0).to_numpy(np.int64) for x in (n0, n1, n2)])
    distinct, which = np.unique(triples, axis=0, return_inverse=True)
    found = np.array([hwe_p(*t) for t in distinct.tolist()]).reshape(-1, 2)
    return pd.DataFrame(found[which.ravel()], columns=["HWE", "ExcHet"])


def hwe_exact(counts: DataFrame) -> DataFrame:
    """counts (n0, n1, n2, ...) with HWE and ExcHet, batch by batch: no shuffle."""
    return counts.withColumn("__t", hwe_test("n0", "n1", "n2")).select(*counts.columns, "__t.HWE", "__t.ExcHet")


def tags_of(n: list[Column], samples: int | Column) -> dict[str, Column]:
    """AC, AN, NS, MAF, F_MISSING, CR of counts of the three genotypes among `samples`."""
    ns, ac = n[0] + n[1] + n[2], n[1] + 2 * n[2]
    freq, size = F.when(ns > 0, ac / (2 * ns)), F.lit(samples) if isinstance(samples, int) else samples
    return {"AC": ac, "AN": 2 * ns, "NS": ns, "MAF": F.least(freq, 1 - freq), "F_MISSING": 1 - ns / size, "CR": ns / size}


def site_tags_by_pop(gt: DataFrame, groups: DataFrame, pops: list[str]) -> DataFrame:
    """Per site and population NS, MAF, HWE, ExcHet and CR, wide as METRIC_POP; `pops` fixes the columns. Null where no sample
    of the population has a row at the site."""
    sizes = groups.groupBy("pop").agg(F.count(F.lit(1)).alias("__n"))
    cells = genotype_counts(gt.join(groups, "sample_id"), ["pop"]).join(sizes, "pop")
    n = [F.col(f"n{d}").cast("long") for d in (0, 1, 2)]
    t = tags_of(n, F.col("__n"))
    tags = hwe_exact(cells).select(*SITE, "pop", *(t[m].alias(m) for m in ("NS", "MAF", "CR")), "HWE", "ExcHet")
    wide = tags.groupBy(*SITE).pivot("pop", pops).agg(*(F.first(m).alias(m) for m in POP_METRICS))
    return wide.select(*SITE, *(F.col(f"{p}_{m}").alias(f"{m}_{p}") for p in pops for m in POP_METRICS))


def snp_gap(sites: DataFrame, d: int) -> DataFrame:
    """SNPs with an indel within d bases: flag snp_gap."""
    counted = near(sites, "__indels", F.col("type") == "INDEL", d)
    return counted.withColumn("snp_gap", ((F.col("type") == "SNP") & (F.col("__indels") > 0)).cast("int")).drop("__indels")


def indel_gap(sites: DataFrame, d: int) -> DataFrame:
    """Indels with another indel within d bases: flag indel_gap."""
    counted = near(sites, "__indels", F.col("type") == "INDEL", d)
    return counted.withColumn("indel_gap", ((F.col("type") == "INDEL") & (F.col("__indels") > 1)).cast("int")).drop("__indels")


def mask_filter(sites: DataFrame, mask: DataFrame) -> DataFrame:
    """MASK_FAIL added to `filter` for sites inside the mask."""
    flagged = site_in_mask(sites, mask, "__in")
    return flagged.withColumn("filter", F.when(F.col("__in") == 1, F.concat("filter", F.array(F.lit("MASK_FAIL")))).otherwise(F.col("filter"))).drop("__in")


def _tests(t: TypeThresholds) -> list[tuple[str, Column]]:
    rules: list[tuple[str, str, str, float | int | None]] = [
        ("QUAL_FAIL", "qual", "<", t.qual), ("DP_MIN_FAIL", "DP", "<", t.dp_min), ("DP_LOWER_PERC_FAIL", "DP", "<", t.dp_lower), ("DP_UPPER_PERC_FAIL", "DP", ">", t.dp_upper),
        ("EH_FAIL", "ExcHet", "<", t.eh), ("HWE_FAIL", "HWE", "<", t.hwe), ("MAF_FAIL", "MAF", "<", t.maf), ("NS_FAIL", "NS", "<", t.ns), ("CR_FAIL", "CR", "<", t.cr),
    ]
    return [(name, F.col(c) < v if op == "<" else F.col(c) > v) for name, c, op, v in rules if v is not None]


def global_site_filters(tags: DataFrame, types: dict[str, TypeThresholds]) -> DataFrame:
    """`filter` lists the failed tests of the site's type, in a fixed order; columns of disabled tests need not exist."""
    fails = [F.when((F.col("type") == kind) & true(bad), F.lit(name)) for kind, t in types.items() for name, bad in _tests(t)]
    found = F.array_compact(F.array(*fails)) if fails else F.expr("cast(array() as array<string>)")
    return tags.withColumn("filter", found)


def population_site_filters(pop_tags: DataFrame, pops: list[str], thresholds: dict[str, float], mode: str = "ALL") -> DataFrame:
    """`pop_filter`: POP_<METRIC>_FAIL where the metric is below its threshold in all (ALL) or any (ANY) populations."""
    fails = [F.when(_in_pops(metric, low, pops, mode), F.lit(f"POP_{'EH' if metric == 'ExcHet' else metric}_FAIL")) for metric, low in thresholds.items()]
    return pop_tags.withColumn("pop_filter", F.array_compact(F.array(*fails)) if fails and pops else F.expr("cast(array() as array<string>)"))


def _in_pops(metric: str, low: float, pops: list[str], mode: str) -> Column:
    """The metric is below `low` in all or any of the populations; never without populations."""
    if not pops:
        return F.lit(False)
    values = F.array(*(true(F.col(f"{metric}_{p}") < low) for p in pops))
    return F.forall(values, lambda x: x) if mode == "ALL" else F.exists(values, lambda x: x)


def _pop_tests(t: TypeThresholds, pops: list[str], mode: str) -> list[tuple[str, Column]]:
    rules = [("POP_EH_FAIL", "ExcHet", t.pop_eh), ("POP_HWE_FAIL", "HWE", t.pop_hwe), ("POP_MAF_FAIL", "MAF", t.pop_maf), ("POP_NS_FAIL", "NS", t.pop_ns), ("POP_CR_FAIL", "CR", t.pop_cr)]
    return [(name, _in_pops(metric, low, pops, mode)) for name, metric, low in rules if low is not None]


def pass_sites(sites: DataFrame, keep_tags: list[str]) -> DataFrame:
    """Sites without a failed test, with the listed columns only."""
    return sites.where(F.size("filter") == 0).select(*SITE, *keep_tags)


def drop_empty_chunks(sites: DataFrame, chunk: str = "chunk") -> DataFrame:
    """Rows of the chunks that have a passing site."""
    return sites.join(sites.where(F.size("filter") == 0).select(chunk).distinct(), chunk, "left_semi")


def filter_summary(sites: DataFrame) -> DataFrame:
    """Sites per FILTER string; none failed reads PASS."""
    name = F.when(F.size("filter") == 0, "PASS").otherwise(F.concat_ws(";", "filter"))
    return sites.groupBy(name.alias("FILTER")).agg(F.count(F.lit(1)).alias("COUNT"))


def pass_fail_histogram(sites: DataFrame, metric: str, tag: str, bins: int = 100) -> DataFrame:
    """Truncated bins of width (max - min) / bins (1 if flat or under two values), PASS or FAIL by a match of `tag`."""
    bounds = sites.agg(F.min(metric).alias("__lo"), F.max(metric).alias("__hi"), F.count(metric).alias("__n"))
    width = F.when((F.col("__n") < 2) | (F.col("__hi") == F.col("__lo")), F.lit(1.0)).otherwise((F.col("__hi") - F.col("__lo")) / bins)
    status = F.when(F.concat_ws(";", "filter").contains(tag), "FAIL").otherwise("PASS")
    binned = sites.where(F.col(metric).isNotNull()).crossJoin(F.broadcast(bounds)).withColumn("__w", width)
    return binned.groupBy(status.alias("STATUS"), F.floor((F.col(metric) - F.col("__lo")) / F.col("__w")).cast("long").alias("BIN")).agg(F.count(F.lit(1)).alias("COUNT"))


def _metric_histogram(long: DataFrame, by: list[str], limits: dict[str, tuple[float, float]], bins: int) -> DataFrame:
    """long: (by..., TYPE, RULE, VALUE, FILTER). Right-closed bins named by their mid-points."""
    low = F.create_map(*(F.lit(x) for k, (a, _) in limits.items() for x in (k, float(a))))
    high = F.create_map(*(F.lit(x) for k, (_, b) in limits.items() for x in (k, float(b))))
    lo, hi = low[F.col("RULE")], high[F.col("RULE")]
    step = (hi - lo) / bins
    value = F.least(F.greatest(F.col("VALUE"), lo), hi)
    index = F.greatest(F.lit(1), F.ceil((value - lo) / step))
    counted = long.where("VALUE is not null").groupBy(*by, "TYPE", "RULE", "FILTER", index.cast("long").alias("__i"), (lo + (index - 0.5) * step).alias("BIN")).agg(F.count(F.lit(1)).alias("COUNT"))
    return counted.drop("__i").withColumn("PROP", F.col("COUNT") / F.sum("COUNT").over(W.partitionBy(*by, "TYPE", "RULE")))


def metric_histogram_global(metrics: DataFrame, limits: dict[str, tuple[float, float]], bins: int = 100) -> DataFrame:
    """Histogram per type, rule and PASS/FAIL; the expected tag is the upper-cased rule plus _FAIL, and the three DP tags
    count as DP_FAIL (so ExcHet, whose tag is EH_FAIL, always passes here)."""
    long = metrics.unpivot(["type", "filter"], [F.col(m).cast("double").alias(m) for m in limits], "RULE", "VALUE")
    tags = F.transform("filter", lambda x: F.when(x.startswith("DP_"), F.lit("DP_FAIL")).otherwise(x))
    status = F.when(F.array_contains(tags, F.concat(F.upper("RULE"), F.lit("_FAIL"))), "FAIL").otherwise("PASS")
    return _metric_histogram(long.select(F.col("type").alias("TYPE"), "RULE", "VALUE", status.alias("FILTER")), [], limits, bins)


def metric_histogram_by_pop(metrics: DataFrame, pops: list[str], limits: dict[str, tuple[float, float]], bins: int = 100) -> DataFrame:
    """The same per population, from METRIC_POP columns."""
    cols = [f"{m}_{p}" for m in limits for p in pops]
    long = metrics.unpivot(["type", "pop_filter"], [F.col(c).cast("double").alias(c) for c in cols], "__c", "VALUE")
    rule, pop = F.regexp_extract("__c", "^([^_]+)_(.+)$", 1), F.regexp_extract("__c", "^([^_]+)_(.+)$", 2)
    named = long.withColumns({"RULE": rule, "POP": pop})
    status = F.when(F.array_contains("pop_filter", F.concat(F.lit("POP_"), F.upper("RULE"), F.lit("_FAIL"))), "FAIL").otherwise("PASS")
    return _metric_histogram(named.select("POP", F.col("type").alias("TYPE"), "RULE", "VALUE", status.alias("FILTER")), ["POP"], limits, bins)


def metric_max_estimate(metrics: DataFrame, names: list[str], chunk: str = "chunk", n: int = 5, buffer: float = 0.10) -> DataFrame:
    """Largest value of each metric over at most n chunks (first by hash of the chunk), enlarged by the buffer."""
    few = metrics.select(chunk).distinct().orderBy(F.md5(F.col(chunk).cast("string"))).limit(n)
    return metrics.join(few, chunk, "left_semi").agg(*((F.max(m) * (1 + buffer)).alias(m) for m in names))


def split_by_type(sites: DataFrame) -> dict[str, DataFrame]:
    return {"snps": sites.where("type = 'SNP'"), "indels": sites.where("type = 'INDEL'"), "invariant": sites.where("type = 'REF'")}


def sites_only(gt: DataFrame) -> DataFrame:
    return gt.select(*SITE).distinct()


def subset_to_sites(gt: DataFrame, sites: DataFrame) -> DataFrame:
    """Rows at the listed positions, each once however often it is listed."""
    return gt.join(sites.select(*SITE), SITE, "left_semi")


def isec_n2(a: DataFrame, b: DataFrame) -> DataFrame:
    """Rows of the first at positions of both."""
    return a.join(b.select(*SITE), SITE, "left_semi")


def _hard(sites: DataFrame, rules: list[tuple[str, Column]]) -> DataFrame:
    return sites.withColumn("filter", F.array_compact(F.array(*(F.when(true(bad), F.lit(name)) for name, bad in rules))))


def hard_filter_snp(sites: DataFrame, dp_min: int | None = None, dp_max: int | None = None) -> DataFrame:
    """Named filters for SNPs. The customary hard thresholds."""
    c = F.col
    rules = [("QD2", c("QD") < 2.0), ("QUAL30", c("QUAL") < 30.0), ("SOR3", c("SOR") > 3.0), ("FS60", c("FS") > 60.0), ("MQ40", c("MQ") < 40.0), ("MQRankSum-12.5", c("MQRankSum") < -12.5), ("ReadPosRankSum-8", c("ReadPosRankSum") < -8.0)]
    rules += [("DPmin", c("DP") < dp_min)] * (dp_min is not None) + [("DPmax", c("DP") > dp_max)] * (dp_max is not None)
    return _hard(sites, rules)


def hard_filter_indel(sites: DataFrame, dp_min: int | None = None, dp_max: int | None = None) -> DataFrame:
    """Named filters for indels. The customary hard thresholds."""
    c = F.col
    rules = [("QD2", c("QD") < 2.0), ("QUAL30", c("QUAL") < 30.0), ("FS200", c("FS") > 200.0), ("ReadPosRankSum-20", c("ReadPosRankSum") < -20.0)]
    rules += [("DPmin", c("DP") < dp_min)] * (dp_min is not None) + [("DPmax", c("DP") > dp_max)] * (dp_max is not None)
    return _hard(sites, rules)


def max_nocall_fraction(gt: DataFrame, n_samples: int, fraction: float = 0.05) -> DataFrame:
    """Sites where at most the fraction of samples has no call."""
    return gt.groupBy(*SITE).agg((1 - F.count("dosage") / n_samples).alias("nocall")).where(F.col("nocall") <= fraction)


def variants_to_table(sites: DataFrame, fields: list[str]) -> DataFrame:
    return sites.select(*SITE, *(F.col(f) if f in sites.columns else F.lit(None).cast("double").alias(f) for f in fields))


def snpstat_filter_summary(stats: DataFrame, params: dict[str, tuple[str, float]]) -> DataFrame:
    """PASS or FAIL per criterion and `all_pass`. params: column -> (">=" or "<=", threshold)."""
    ok = {c: true(F.col(c) >= v if op == ">=" else F.col(c) <= v) for c, (op, v) in params.items()}
    every = F.lit(True)
    for c in ok.values():
        every = every & c
    return stats.select(*SITE, *(F.when(o, "PASS").otherwise("FAIL").alias(f"{c}_status") for c, o in ok.items()), every.alias("all_pass"))


def lr_pvalue_bh(lr: DataFrame, given_p: bool = False) -> DataFrame:
    """p = half the upper tail of chi-square with one degree, and Benjamini-Hochberg adjusted values. Ranks and running minima
    over the distinct p run in two levels: ranges of p, 256 to an octave, and the values in a range."""

    @F.pandas_udf("double")
    def tail(x: pd.Series) -> pd.Series:
        distinct, which = np.unique(x.to_numpy(np.float64, na_value=np.nan), return_inverse=True)
        return pd.Series(np.array([0.5 * math.erfc(math.sqrt(max(v, 0.0) / 2)) if v == v else np.nan for v in distinct.tolist()])[which]).replace({np.nan: None})

    withp = lr if given_p else lr.withColumn("p", tail("lr"))
    levels = withp.where("p is not null").groupBy("p").agg(F.count(F.lit(1)).alias("n"))
    octave = F.when(F.col("p") > 0, F.floor(F.log2("p") * 256)).otherwise(F.lit(-(1 << 20))).cast("long")
    ranked = running(levels, "rank", "sum", F.col("n"), ["p"], octave, keys=(), inclusive=True).crossJoin(F.broadcast(levels.agg(F.sum("n").alias("m"))))
    down = ranked.withColumn("__down", -F.col("p"))
    adjusted = running(down, "__low", "min", F.col("p") * F.col("m") / F.col("rank"), ["__down"], -octave, keys=(), inclusive=True)
    return withp.join(adjusted.select("p", F.least(F.lit(1.0), F.col("__low")).alias("p_adjusted")), "p", "left")


def paralog_mask(tested: DataFrame, alpha: float = 0.001, radius: int = 1000) -> DataFrame:
    """Merged windows around sites whose adjusted p is below alpha."""
    return windows_around_points(tested.where(F.col("p_adjusted") < alpha), radius)


def individual_data_counts(counts: DataFrame) -> DataFrame:
    """Sites with data per sample."""
    return counts.groupBy("sample_id").agg(F.sum((F.col("dp") > 0).cast("long")).alias("n_sites"))


def vcf_stats(sites: DataFrame) -> DataFrame:
    """Per type: records, transitions, transversions, mean quality."""
    pair = F.concat("ref", F.get("alt", F.lit(0)))
    ts = pair.isin("AG", "GA", "CT", "TC") & (F.col("type") == "SNP")
    tv = pair.rlike("^[ACGT]{2}$") & ~pair.isin("AG", "GA", "CT", "TC") & (F.col("type") == "SNP")
    return sites.groupBy("type").agg(F.count(F.lit(1)).alias("n"), F.sum(true(ts).cast("long")).alias("n_ts"), F.sum(true(tv).cast("long")).alias("n_tv"), F.avg("qual").alias("mean_qual"))


def site_distributions(sites: DataFrame, gt: DataFrame) -> DataFrame:
    """(measure, bin, n): sites by alternative allele frequency in hundredths (AF), quality (QUAL) and depth of all samples (DP) rounded
    down, and indels by how many bases longer the first alternative is than the reference (INDEL). Unknown values have no bin."""
    per = gt.groupBy(*SITE).agg((F.sum("dosage") / (2 * F.count("dosage"))).alias("af"), F.sum("dp").alias("dp"))
    joined = sites.select(*SITE, "ref", "alt", "qual", "type").join(per, SITE, "left")
    longer = F.when(F.col("type") == "INDEL", F.length(F.get("alt", F.lit(0))) - F.length("ref"))
    # a hundredth's lower edge belongs to it, whatever the rounding of the share
    values = {"AF": F.floor(F.round(F.col("af") * 100, 6)), "QUAL": F.floor("qual"), "DP": F.floor("dp"), "INDEL": longer}
    cells = joined.select(F.explode(F.array(*(F.struct(F.lit(m).alias("measure"), v.cast("long").alias("bin")) for m, v in values.items()))).alias("x")).select("x.*")
    return cells.where("bin is not null").groupBy("measure", "bin").agg(F.count(F.lit(1)).alias("n"))


def sample_stats(gt: DataFrame) -> DataFrame:
    """Per sample: homozygous reference, heterozygous, homozygous alternative, missing, mean depth."""
    return gt.groupBy("sample_id").agg(*(F.sum(true(F.col("dosage") == d).cast("long")).alias(n) for d, n in ((0, "n_hom_ref"), (1, "n_het"), (2, "n_hom_alt"))), F.sum(F.col("dosage").isNull().cast("long")).alias("n_missing"), F.avg("dp").alias("mean_dp"))


def thin_sites(sites: DataFrame, window: int = 10_000) -> DataFrame:
    """First site of each window."""
    return sites.groupBy("chrom", F.floor(F.col("pos") / window).cast("long").alias("window")).agg(F.min("pos").alias("pos"))


def join_site_stats(sites: DataFrame, *stats: DataFrame) -> DataFrame:
    """Site list with statistics joined by position, null where absent."""
    for s in stats:
        sites = sites.join(s, SITE, "left")
    return sites


def regions_overlap(sites: DataFrame, iv: DataFrame) -> DataFrame:
    """Sites inside any interval, by the binned join."""
    points = sites.select("chrom", (F.col("pos") - 1).alias("start"), F.col("pos").alias("end"), "pos")
    return overlap_pairs(points, iv).select(*SITE).distinct()


def kept_samples(masked: DataFrame, sites: DataFrame, popmap: DataFrame, maximum: float) -> list[tuple[str, str]]:
    """(sample_id, cleaned population) of the samples that are kept, in order: one row per sample on the driver, as a header
    names them. None left is an error."""
    kept = keep_samples(sample_missingness(masked, sites), maximum)
    rows = population_groups(popmap.withColumn("pop", F.coalesce("pop", F.lit("unknown"))), kept, 1).select("sample_id", "pop").distinct().collect()
    if not rows:
        raise ValueError("no sample is below the maximum of missing genotypes")
    return sorted((r["sample_id"], r["pop"]) for r in rows)


def site_filter_query(gt: DataFrame, sites: DataFrame, popmap: DataFrame, params: FilterParams, mask: DataFrame | None = None) -> DataFrame:
    """Biallelic sites with their tags, those of each population (METRIC_POP), and `filter`, the tests that failed, in order.

    gt: (chrom, pos, sample_id, dosage, dp, gq). Genotypes are masked, samples with too many missing ones left out, and one
    aggregation by site gives the genotype counts of all and of every population; DP is of all samples, and its percentiles
    over all sites bound it. Then gaps to indels, the mask, and the tests of the site's type run in one projection.
    """
    spark = gt.sparkSession
    masked = mask_genotypes(gt, params.gq, params.gt_dp_min, params.gt_dp_max)
    chosen = kept_samples(masked, sites, popmap, params.sample_max_missing)
    sizes = Counter(p for _, p in chosen)
    pops = sorted(p for p, n in sizes.items() if n >= params.pop_min_n)
    # one row per sample
    cells = masked.join(F.broadcast(spark.createDataFrame(chosen, "sample_id string, pop string")), "sample_id", "left")
    count = lambda d, who: F.sum((true(F.col("dosage") == d) & true(who)).cast("long"))
    counts = cells.groupBy(*SITE).agg(F.sum("dp").alias("DP"), *(count(d, F.col("pop").isNotNull()).alias(f"n{d}") for d in (0, 1, 2)), *(count(d, F.col("pop") == p).alias(f"n{d}_{p}") for p in pops for d in (0, 1, 2)))
    # written once: the tests, the depth histogram and the neighbours of sites all start from it
    deep = kept(sites.join(counts, SITE, "left").withColumn("__row", F.monotonically_increasing_id()), "site-counts")
    two = biallelic(deep).where("n0 is not null")
    tags = {**tags_of([F.col(f"n{d}") for d in (0, 1, 2)], len(chosen)), **{f"{m}_{p}": c for p in pops for m, c in tags_of([F.col(f"n{d}_{p}") for d in (0, 1, 2)], sizes[p]).items() if m in POP_METRICS}}
    tested = two.withColumns({f"__h{p}": hwe_test(f"n0{p}", f"n1{p}", f"n2{p}") for p in ("", *(f"_{p}" for p in pops))})
    tags |= {f"{m}{p}": F.col(f"__h{p}")[m] for p in ("", *(f"_{p}" for p in pops)) for m in ("HWE", "ExcHet")}
    tagged = tested.select(*sites.columns, *(c.alias(n) for n, c in tags.items()), "DP", "__row")
    near = two.select(*sites.columns, "__row")
    if params.dist_indel_snp is not None:
        near = snp_gap(near, params.dist_indel_snp)
    if params.dist_indel_indel is not None:
        near = indel_gap(near, params.dist_indel_indel)
    if mask is not None and params.filter_masked:
        near = site_in_mask(near, mask, "__masked")
    flags = [c for c in ("snp_gap", "indel_gap", "__masked") if c in near.columns]
    if flags:
        tagged = tagged.join(near.select("__row", *flags), "__row")
    bounds = {"dp_lower": params.dp_percentile_lower, "dp_upper": params.dp_percentile_upper}
    if any(v is not None for v in bounds.values()):
        hist = depth_histogram(deep.select(F.col("DP").alias("dp")))
        tagged = tagged.crossJoin(F.broadcast(depth_bounds(hist, bounds["dp_lower"] or 0, bounds["dp_upper"] or 100)))
    rules = [("SnpGap", "snp_gap"), ("IndelGap", "indel_gap"), ("MASK_FAIL", "__masked")]
    fails = [F.when(F.col(c) == 1, F.lit(name)) for name, c in rules if c in tagged.columns]
    names = ("QUAL_FAIL", "DP_MIN_FAIL", "DP_LOWER_PERC_FAIL", "DP_UPPER_PERC_FAIL", "EH_FAIL", "HWE_FAIL", "MAF_FAIL", "NS_FAIL", "CR_FAIL", "POP_EH_FAIL", "POP_HWE_FAIL", "POP_MAF_FAIL", "POP_NS_FAIL", "POP_CR_FAIL")
    tests: dict[str, list[Column]] = {n: [] for n in names}
    for kind, t in params.types.items():
        found = _tests(t) + _pop_tests(t, pops, params.pop_fail_mode)
        if t.dp_lower is None and bounds["dp_lower"] is not None:
            found.append(("DP_LOWER_PERC_FAIL", F.col("DP") < F.col("DPlower")))
        if t.dp_upper is None and bounds["dp_upper"] is not None:
            found.append(("DP_UPPER_PERC_FAIL", F.col("DP") > F.col("DPupper")))
        for name, bad in found:
            tests[name].append((F.col("type") == kind) & true(bad))
    fails += [F.when(functools.reduce(lambda a, b: a | b, bad), F.lit(name)) for name, bad in tests.items() if bad]
    found = F.array_compact(F.array(*fails)) if fails else F.expr("cast(array() as array<string>)")
    return tagged.withColumn("filter", found).drop("snp_gap", "indel_gap", "__masked", "DPlower", "DPupper", "__row")
