"""Consensus of a circular contig from all-sites allele counts of an original and a shifted reference."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lociframe.operators.sequence import PIECE, pieces

BASES = ["A", "C", "G", "T"]
#: Names of the verdicts, in the order in which they are tried.
VERDICTS = ("LOW_DEPTH", "NON_SNV_EVIDENCE", "NO_BASE_SUPPORT", "PASS", "MIXED_IUPAC", "LOW_MAJOR_AF")
#: Two-base ambiguity codes.
IUPAC = {"AC": "M", "AG": "R", "AT": "W", "CG": "S", "CT": "Y", "GT": "K"}


def validate_mito(contig_length: int, n_contigs: int, shift: int, fractions: list[float]) -> None:
    if n_contigs != 1:
        raise ValueError("exactly one contig is needed")
    if not 0 <= shift < contig_length:
        raise ValueError("the shift must lie within the contig")
    if any(not 0 <= f <= 1 for f in fractions):
        raise ValueError("fractions must lie in [0, 1]")


def allele_counts(counts: DataFrame) -> DataFrame:
    """counts (sample_id, pos, allele, fwd, rev), several rows per cell: per cell reads of A, C, G, T in either case, of other
    alleles (a null one is another), depths and the share of other alleles."""
    counts = counts.withColumn("allele", F.upper("allele"))
    n = F.coalesce("fwd", F.lit(0)) + F.coalesce("rev", F.lit(0))
    is_base = F.coalesce(F.col("allele").isin(*BASES), F.lit(False))
    out = counts.groupBy("sample_id", "pos").agg(*(F.sum(F.when(F.col("allele") == b, n).otherwise(0)).alias(b) for b in BASES), F.sum(F.when(~is_base, n).otherwise(0)).alias("non_snv"))
    depth = sum(F.col(b) for b in BASES)
    return out.withColumn("depth", depth).withColumn("total_depth", depth + F.col("non_snv")).withColumn("non_snv_af", F.when(F.col("total_depth") > 0, F.col("non_snv") / F.col("total_depth")).otherwise(0.0))


def shifted_to_original(counts: DataFrame, shift: int, length: int) -> DataFrame:
    """Positions on the shifted contig back on the original: ((p + shift - 1) mod length) + 1."""
    return counts.withColumn("pos", (F.pmod(F.col("pos") + shift - 1, F.lit(length)) + 1).cast("long"))


def choose_source(original: DataFrame, shifted: DataFrame, samples: DataFrame, length: int, window: int) -> DataFrame:
    """One row per sample and position: the shifted counts near the breakpoint where present, else the original, else none."""
    frame = samples.select("sample_id").crossJoin(samples.sparkSession.range(1, length + 1).select(F.col("id").alias("pos")))
    near = (F.col("pos") <= window) | (F.col("pos") > length - window)
    values = [c for c in original.columns if c not in ("sample_id", "pos")]
    o = original.select("sample_id", "pos", F.struct(*values).alias("o"))
    s = shifted.select("sample_id", "pos", F.struct(*values).alias("s"))
    joined = frame.join(o, ["sample_id", "pos"], "left").join(s, ["sample_id", "pos"], "left")
    pick = F.when(near & F.col("s").isNotNull(), F.col("s")).otherwise(F.col("o"))
    source = F.when(near & F.col("s").isNotNull(), "shifted").when(F.col("o").isNotNull(), "original").otherwise("none")
    return joined.select("sample_id", "pos", source.alias("source"), *(F.coalesce(pick[v], F.lit(0)).alias(v) for v in values))


def call_major_allele(
    obs: DataFrame, min_depth: int = 10, max_non_snv_af: float = 0.2, major_af: float = 0.8, mixed_min_af: float = 0.2, min_minor_depth: int = 3, het_mode: str = "N"
) -> DataFrame:
    """Base and filter of each row: bases ranked by count, then letter; the first of VERDICTS that fits.

    A position under `major_af` gets an ambiguity code only in het_mode "iupac" and where its second base has
    `min_minor_depth` reads and `mixed_min_af` of them at least; in het_mode "N", or with less, it is N.
    """
    if het_mode not in ("N", "iupac"):
        raise ValueError("het_mode is N or iupac")
    ranked = F.array_sort(F.array(*(F.struct((-F.col(b)).alias("n"), F.lit(b).alias("b")) for b in BASES)))
    x = obs.withColumn("__r", ranked)
    first, second = F.col("__r")[0], F.col("__r")[1]
    af = lambda s: F.when(F.col("depth") > 0, -s["n"] / F.col("depth")).otherwise(0.0)
    x = x.withColumns({"major": first["b"], "major_af": af(first), "minor": second["b"], "minor_af": af(second)})
    pair = F.concat(F.least("major", "minor"), F.greatest("major", "minor"))
    code = F.create_map(*(F.lit(v) for kv in IUPAC.items() for v in kv))[pair]
    mixed = F.lit(het_mode == "iupac") & (-second["n"] >= min_minor_depth) & (F.col("minor_af") >= mixed_min_af)
    verdict = (
        F.when(F.col("total_depth") < min_depth, "LOW_DEPTH").when(F.col("non_snv_af") > max_non_snv_af, "NON_SNV_EVIDENCE").when(F.col("depth") == 0, "NO_BASE_SUPPORT")
        .when(F.col("major_af") >= major_af, "PASS").when(mixed, "MIXED_IUPAC").otherwise("LOW_MAJOR_AF")
    )
    x = x.withColumn("filter", verdict)
    return x.withColumn("base", F.when(F.col("filter") == "PASS", F.col("major")).when(F.col("filter") == "MIXED_IUPAC", code).otherwise("N")).drop("__r")


def consensus_sequence(calls: DataFrame) -> DataFrame:
    """Bases in order, one string per sample."""
    ordered = F.array_sort(F.collect_list(F.struct("pos", "base")))
    return calls.groupBy("sample_id").agg(F.array_join(F.transform(ordered, lambda x: x["base"]), "").alias("seq"))


def mito_qc(calls: DataFrame, min_depth: int) -> DataFrame:
    """Per sample: depths, covered, passing and N positions with their shares, counts per filter, shifted positions."""
    n = F.count(F.lit(1))
    named = [F.sum((F.col("filter") == f).cast("long")).alias(f"n_{f.lower()}") for f in VERDICTS]
    covered, unknown = F.sum((F.col("total_depth") >= min_depth).cast("long")), F.sum((F.col("base") == "N").cast("long"))
    return calls.groupBy("sample_id").agg(n.alias("n_positions"), F.avg("total_depth").alias("mean_depth"), F.expr("percentile(total_depth, 0.5)").alias("median_depth"), covered.alias("n_covered"), (covered / n).alias("covered_fraction"), unknown.alias("n_unknown"), (unknown / n).alias("unknown_fraction"), *named, F.sum((F.col("source") == "shifted").cast("long")).alias("n_shifted"))


def majority_fasta(pileup: DataFrame, min_samples: int, drop_snps: bool = False) -> DataFrame:
    """Most common base over samples per position (pos, sample_id, base); N below min_samples or, if asked, where bases differ."""
    votes = pileup.where(F.col("base").isin(*BASES)).groupBy("pos", "base").agg(F.count(F.lit(1)).alias("n"))
    top = votes.groupBy("pos").agg(F.sum("n").alias("total"), F.count(F.lit(1)).alias("kinds"), F.min(F.struct((-F.col("n")).alias("n"), "base")).alias("best"))
    bad = (F.col("total") < min_samples) | ((F.col("kinds") > 1) if drop_snps else F.lit(False))
    return top.select("pos", F.when(bad, "N").otherwise(F.col("best.base")).alias("base"))


def region_consensus(seqs: DataFrame, regions: DataFrame, variants: DataFrame, depth: DataFrame, mode: str = "iupac", min_depth: int = 1, min_length: int = 0) -> DataFrame:
    """Per region and sample the reference with the sample's variants (SNVs: chrom, pos, sample_id, ref, alt, dosage), N below
    min_depth (chrom, pos, sample_id, dp); kept where the part that is not N is longer than min_length. mode: iupac, hap1, hap2."""
    bins = F.explode(F.sequence(F.floor(F.col("start") / PIECE), F.floor((F.greatest("start", F.col("end") - 1)) / PIECE)))
    cut = regions.withColumn("bin", bins).join(pieces(seqs).select(F.col("contig").alias("chrom"), "bin", "at", "seq"), ["chrom", "bin"])
    low, high = F.greatest("start", "at"), F.least(F.col("end"), F.col("at") + F.length("seq"))
    part = F.upper(F.substr("seq", (low - F.col("at") + 1).cast("int"), (high - low).cast("int")))
    bases = cut.where(high > low).select("chrom", "start", "end", low.alias("low"), F.posexplode(F.split(part, "")).alias("i", "ref_base")).where("ref_base <> ''")
    bases = bases.select("chrom", "start", "end", (F.col("low") + F.col("i") + 1).alias("pos"), "ref_base")
    samples = depth.select("sample_id").distinct()
    cells = bases.crossJoin(samples).join(depth.select("chrom", "pos", "sample_id", "dp"), ["chrom", "pos", "sample_id"], "left").join(variants.select("chrom", "pos", "sample_id", "alt", "dosage"), ["chrom", "pos", "sample_id"], "left")
    pair = F.concat(F.least("ref_base", "alt"), F.greatest("ref_base", "alt"))
    code = F.coalesce(F.create_map(*(F.lit(v) for kv in IUPAC.items() for v in kv))[pair], F.lit("N"))
    het = {"iupac": code, "hap1": F.col("ref_base"), "hap2": F.col("alt")}[mode]
    base = F.when(F.coalesce("dp", F.lit(0)) < min_depth, "N").when(F.col("dosage") == 2, F.col("alt")).when(F.col("dosage") == 1, het).otherwise(F.col("ref_base"))
    joined = cells.groupBy("chrom", "start", "end", "sample_id").agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("pos", base.alias("b")))), lambda x: x["b"]), "").alias("seq"))
    return joined.where(F.length(F.translate("seq", "N", "")) > min_length)
