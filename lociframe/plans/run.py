"""A whole run: alignments to called, filtered variants, with masks, coverage and chunks beside them.

The mask, the alignments taken in, their depth, the sites and the genotypes are used by several results; they are written to the
shared folder once and read from there, which is also where a lost executor's work is taken up again. All else is lazy.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lociframe.operators import chunking as C
from lociframe.operators import filters as Q
from lociframe.operators import genotypes as G
from lociframe.operators import intervals as I
from lociframe.operators import kmers as M
from lociframe.operators import mito as T
from lociframe.operators import popgen as P
from lociframe.operators import reads as R
from lociframe.operators import sequence as K
from lociframe.operators.lineage import kept
from lociframe.operators.params import CallParams, ReadParams, RunParams


@dataclass(frozen=True)
class Inputs:
    """sequences (contig, seq, length, rank), their tiles where they were read as such (with an overlap of the longest k-mer or more;
    then sequences needs no seq), alignments (as `sources.read_sam` gives them, with sample_id, chrom, start, end and
    aligned), popmap (sample_id, pop), intervals to take in or leave out (chrom, start, end), the name of the mitochondrial contig, and
    alignments to that contig begun `mito.shift` bases later, under the same name."""

    sequences: DataFrame
    alignments: DataFrame
    popmap: DataFrame
    include: DataFrame | None = None
    exclude: DataFrame | None = None
    tiles: DataFrame | None = None
    mito: str | None = None
    shifted: DataFrame | None = None

    @property
    def bases(self) -> DataFrame:
        return self.sequences if self.tiles is None else self.tiles


def masks(inputs: Inputs, params: RunParams) -> DataFrame:
    """All masks of the genome in one, with their labels."""
    m = params.masks
    found = []
    if m.hard_masks:
        found.append(K.hard_mask(inputs.bases))
    if m.soft_masks:
        found.append(K.soft_mask(inputs.bases))
    if inputs.exclude is not None:
        contigs = inputs.sequences.select("contig", "length", "rank")
        found.append(K.exclude_mask(I.slop(inputs.exclude.select("chrom", "start", "end"), m.exclude_padding, contigs)))
    if m.mappability:
        found.append(M.kmer_mappability(inputs.bases, m.kmer, m.mappability).withColumn("label", F.lit("GENMAP")))
    if m.complexity:
        found.append(K.low_complexity_mask(inputs.bases, m.complexity_kmer, m.complexity_window, m.complexity).withColumn("label", F.lit("LONGDUST")))
    if inputs.mito is not None:
        own = F.col("contig") == inputs.mito
        hits = M.kmer_hits(inputs.bases.where(~own), inputs.bases.where(own), m.numt_kmer, m.numt_min_length)
        found.append(K.numt_mask(hits, m.numt_min_length, m.numt_max_gap, inputs.mito))
    return K.merge_masks(*found)


def reference_bases(sequences: DataFrame, sites: DataFrame) -> DataFrame:
    """sites (chrom, pos 1-based) with `ref`, the reference base in upper case, by pieces of the sequences."""
    cut = K.pieces(sequences).select(F.col("contig").alias("chrom"), F.col("bin").alias("__bin"), F.col("at").alias("__at"), F.col("seq").alias("__seq"))
    at = F.col("pos") - 1 - F.col("__at")
    joined = sites.withColumn("__bin", F.floor((F.col("pos") - 1) / K.PIECE)).join(cut, ["chrom", "__bin"]).where((at >= 0) & (at < F.length("__seq")))
    return joined.withColumn("ref", F.upper(F.substr("__seq", (at + 1).cast("int"), F.lit(1)))).drop("__bin", "__at", "__seq")


def usable(alignments: DataFrame, params: ReadParams) -> DataFrame:
    """The alignments that are called from."""
    drop = R.DROPPED if params.remove_duplicates else R.DROPPED & ~R.DUPLICATE
    return R.alignment_filter(alignments, drop, params.min_mapping_quality, frag=(params.min_fragment, params.max_fragment), min_aligned=params.min_aligned)


def called(alignments: DataFrame, sequences: DataFrame, popmap: DataFrame, reads: ReadParams, calls: CallParams) -> tuple[DataFrame, DataFrame]:
    """(alternatives, genotypes) of substitutions: the alternative is the base seen most beside the reference's."""
    counts = R.pileup(usable(alignments, reads), reads.min_base_quality, reads.min_mapping_quality, 0, reads.max_depth)
    seen = reference_bases(sequences, counts.withColumn("n", F.col("fwd") + F.col("rev"))).where("ref in ('A', 'C', 'G', 'T')")
    others = seen.where("allele <> ref and allele in ('A', 'C', 'G', 'T')").groupBy("chrom", "pos", "ref", "allele").agg(F.sum("n").alias("n"))
    alts = others.groupBy("chrom", "pos", "ref").agg(F.min(F.struct((-F.col("n")).alias("n"), "allele")).alias("top")).select("chrom", "pos", "ref", F.col("top.allele").alias("a"))
    cell = seen.join(alts.select("chrom", "pos", "a"), ["chrom", "pos"]).groupBy("chrom", "pos", "sample_id").agg(F.sum(F.when(F.col("allele") == F.col("ref"), F.col("n")).otherwise(0)).alias("n_ref"), F.sum(F.when(F.col("allele") == F.col("a"), F.col("n")).otherwise(0)).alias("n_alt"), F.sum("n").alias("dp"))
    likely = G.genotype_likelihoods(cell, calls.error, calls.ploidy)
    model = {"cohort": "cohort", "population": "population", "sample": "flat"}[calls.model]
    posterior = G.genotype_posteriors(likely, popmap.select("sample_id", "pop"), model)
    gt = G.gp_to_gt(posterior, calls.min_posterior).withColumn("gq", F.least(F.lit(99), F.floor(-10 * F.log10(F.greatest(F.lit(1e-10), 1 - F.array_max("gp"))))).cast("int"))
    return alts, gt.select("chrom", "pos", "sample_id", "dosage", "dp", "gq", "gp")


def scored(alts: DataFrame, genotypes: DataFrame) -> DataFrame:
    """Sites with their quality: how improbable it is, by the posteriors, that no sample has the alternative."""
    qual = genotypes.groupBy("chrom", "pos").agg(F.sum(-10 * F.log10(F.greatest(F.col("gp")[0], F.lit(1e-30)))).alias("qual"))
    return alts.join(qual, ["chrom", "pos"]).select("chrom", "pos", "ref", F.array("a").alias("alt"), "qual", F.lit("SNP").alias("type"))


def mito_consensus(inputs: Inputs, params: RunParams = RunParams()) -> dict[str, DataFrame]:
    """calls, consensus (sample_id, seq) and qc of the mitochondrial contig: near its two ends from the alignments to the shifted
    contig, elsewhere from those to the contig as it is."""
    m = params.mito
    contigs = inputs.sequences.where(F.col("contig") == inputs.mito).select("length").limit(2).collect()
    length = contigs[0]["length"] if contigs else 0
    T.validate_mito(length, len(contigs), m.shift, [m.major_af, m.het_af, m.max_non_snv_af])
    own = inputs.alignments.where(F.col("chrom") == inputs.mito)
    count = lambda aln: T.allele_counts(R.pileup(aln, m.min_base_quality, m.min_mapping_quality, m.trim_read_ends, params.reads.max_depth).drop("chrom"))
    original = count(own)
    shifted = T.shifted_to_original(count(inputs.shifted), m.shift, length) if inputs.shifted is not None else original.limit(0)
    samples = inputs.popmap.select("sample_id").distinct()
    chosen = T.choose_source(original, shifted, samples, length, m.breakpoint_window)
    calls = kept(T.call_major_allele(chosen, m.min_depth, m.max_non_snv_af, m.major_af, m.het_af, m.het_min_depth, m.het_mode), "mito-calls")
    return {"calls": calls, "consensus": T.consensus_sequence(calls), "qc": T.mito_qc(calls, m.min_depth)}


def outputs(passing: DataFrame, genotypes: DataFrame, popmap: DataFrame, n_pcs: int = 20) -> dict[str, DataFrame]:
    """Relationships of the samples over the passing substitutions: grm, relatedness, kinship, distance, components with the share of
    variance of the first two, and coordinates of the distances where three samples or more share sites."""
    snps = kept(genotypes.join(passing.where("type = 'SNP'").select("chrom", "pos").distinct(), ["chrom", "pos"], "left_semi"), "snps")
    samples = snps.select("sample_id").distinct()
    grm, distance = kept(P.grm(snps), "grm"), kept(P.ibs_distance(snps), "distance")
    variants = snps.select("chrom", "pos").distinct().count()
    vectors, values = P.pca(grm, samples, n_pcs, variants)
    whole = P.drop_until_complete(P.square(distance, samples))
    out = {"grm": grm, "relatedness": P.relatedness_ajk(snps), "kinship": P.king_table(snps), "distance": distance, "pca": P.pca_table(vectors, values, popmap), "eigenvalues": values}
    if whole.select("sample_i").distinct().limit(3).count() == 3:
        out["coordinates"] = P.mds(whole)[0]
    return out


def run(inputs: Inputs, params: RunParams = RunParams()) -> dict[str, DataFrame]:
    """mask, coverage, chunks, sites, genotypes, filtered (sites with tags and `filter`), passing and summary."""
    contigs = inputs.sequences.select("contig", "length", "rank")
    whole = contigs.select(F.col("contig").alias("chrom"), F.lit(0).cast("long").alias("start"), F.col("length").alias("end"))
    mask = kept(masks(inputs, params), "mask")
    include = inputs.include if inputs.include is not None else whole
    aln = kept(I.overlap_semi(inputs.alignments, include.select("chrom", "start", "end")), "alignments")
    depth = kept(R.per_base_depth(usable(aln, params.reads), params.reads.min_mapping_quality), "depth")
    weighted = R.covered_intervals(depth, mask, params.calls.min_depth)
    cut = C.chunk_balanced_split if params.chunks.split_large else C.chunk_balanced
    cells, likely = called(aln, inputs.bases, inputs.popmap, params.reads, params.calls)
    genotypes = kept(likely, "genotypes")
    sites = kept(scored(cells, genotypes), "sites")
    inside = sites.join(Q.regions_overlap(sites, include), ["chrom", "pos"], "left_semi")
    filtered = Q.site_filter_query(genotypes, inside, inputs.popmap, params.filters, mask.select("chrom", "start", "end"))
    return {
        "mask": mask, "coverage": R.contig_coverage(usable(aln, params.reads), contigs), "chunks": cut(weighted, contigs, params.chunks.bases_per_chunk), "sites": inside, "genotypes": genotypes,
        "filtered": filtered, "passing": Q.pass_sites(filtered, ["ref", "alt", "AC", "AN", "NS", "MAF"]), "summary": Q.filter_summary(filtered),
    }
