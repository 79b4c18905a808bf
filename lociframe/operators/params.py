"""Settings of a run, with their usual values; None switches a threshold off."""

from __future__ import annotations

from dataclasses import dataclass, field


@dataclass(frozen=True)
class TypeThresholds:
    """Thresholds of one variant type: over all samples, and (pop_*) in each population."""

    qual: float | None = None
    dp_min: int | None = None
    dp_lower: int | None = None
    dp_upper: int | None = None
    eh: float | None = None
    hwe: float | None = None
    maf: float | None = None
    ns: int | None = None
    cr: float | None = None
    pop_eh: float | None = None
    pop_hwe: float | None = None
    pop_maf: float | None = None
    pop_ns: int | None = None
    pop_cr: float | None = None


def usual_types() -> dict[str, TypeThresholds]:
    variant = TypeThresholds(qual=30.0, dp_min=6, maf=0.05, ns=1, cr=0.5)
    return {"SNP": variant, "INDEL": variant, "REF": TypeThresholds(dp_min=6, ns=1, cr=0.5)}


@dataclass(frozen=True)
class FilterParams:
    """Filters of genotypes, samples and sites. The depth percentiles set dp_lower and dp_upper of every type that names none."""

    gq: int | None = 0
    gt_dp_min: int | None = 1
    gt_dp_max: int | None = 1000
    sample_max_missing: float = 0.5
    dp_percentile_lower: float | None = 1.0
    dp_percentile_upper: float | None = 99.0
    dist_indel_snp: int | None = 5
    dist_indel_indel: int | None = None
    pop_min_n: int = 1
    pop_fail_mode: str = "ALL"
    filter_masked: bool = True
    types: dict[str, TypeThresholds] = field(default_factory=usual_types)


@dataclass(frozen=True)
class MaskParams:
    """Masks of the genome."""

    min_chr_length: int = 50_000_000
    hard_masks: bool = True
    soft_masks: bool = False
    exclude_padding: int = 0
    kmer: int = 100
    mappability: float = 0.99
    complexity_kmer: int = 7
    complexity_window: int = 5_000
    complexity: float = 0.6
    numt_kmer: int = 20
    numt_min_length: int = 100
    numt_max_gap: int = 1_000


@dataclass(frozen=True)
class ReadParams:
    """Trimming of reads and filters of alignments."""

    trim_polyg: bool = True
    polyg_min_length: int = 10
    min_base_quality: int = 10
    min_mapping_quality: int = 20
    min_fragment: int = 15
    max_fragment: int = 10_000
    min_aligned: int = 30
    remove_duplicates: bool = True
    max_depth: int = 250


@dataclass(frozen=True)
class CallParams:
    """Genotype calls from allele counts."""

    ploidy: int = 2
    error: float = 0.01
    model: str = "cohort"
    min_posterior: float = 0.9
    min_depth: int = 1
    max_alt_alleles: int = 6
    output_indel: bool = True
    output_invariant: bool = False


@dataclass(frozen=True)
class MitoParams:
    """Consensus of the circular contig."""

    shift: int = 8_000
    breakpoint_window: int = 500
    min_base_quality: int = 10
    min_mapping_quality: int = 20
    trim_read_ends: int = 0
    min_depth: int = 20
    major_af: float = 0.8
    het_mode: str = "iupac"
    het_af: float = 0.2
    het_min_depth: int = 5
    max_non_snv_af: float = 0.2


@dataclass(frozen=True)
class ChunkParams:
    """Balanced chunks for outputs."""

    bases_per_chunk: int = 250_000_000
    genotypes_per_chunk: int = 100_000_000
    split_large: bool = True
    min_gap: int = 100


@dataclass(frozen=True)
class RunParams:
    """All settings of a run."""

    masks: MaskParams = MaskParams()
    reads: ReadParams = ReadParams()
    calls: CallParams = CallParams()
    mito: MitoParams = MitoParams()
    chunks: ChunkParams = ChunkParams()
    filters: FilterParams = field(default_factory=FilterParams)
