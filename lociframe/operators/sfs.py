"""Site-frequency spectra and statistics from called genotypes and likelihoods."""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lociframe.operators.lineage import kept
from lociframe.operators.tiles import numbered

SITE = ["chrom", "pos"]


def fewer(p: np.ndarray, least: int) -> dict[int, np.ndarray]:
    """A spectrum of N chromosomes, and what it is for each number n of them from `least` on: of n + 1 with j derived, the one left out is
    derived in j / (n + 1) of all cases."""
    out = {len(p) - 1: p}
    for n in range(len(p) - 2, least - 1, -1):
        i = np.arange(n + 1)
        out[n] = ((n + 1 - i) * out[n + 1][:-1] + (i + 1) * out[n + 1][1:]) / (n + 1)
    return out


def more(sums: dict[int, np.ndarray], least: int, most: int) -> np.ndarray:
    """The transpose of `fewer`: sums over sites of n chromosomes, for each n, brought to `most` chromosomes and added."""
    total = np.zeros(least + 1)
    for n in range(least, most + 1):
        if n > least:
            j = np.arange(n + 1)
            total = ((n - j) * np.append(total, 0.0) + j * np.append(0.0, total)) / n
        total = total + sums.get(n, 0.0)
    return total


def likelihood_packs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(k, sites, payload): the arrays of a batch by their length k, as matrices."""
    for batch in batches:
        values = batch.column(0)
        start, sizes = values.offsets.to_numpy()[:-1] - values.offsets[0].as_py(), values.value_lengths().to_numpy()
        flat = values.flatten().to_numpy(zero_copy_only=False)
        rows = [(k, len(mine), flat[start[mine][:, None] + np.arange(k)].tobytes()) for k in np.unique(sizes).tolist() for mine in [np.flatnonzero(sizes == k)]]
        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows, strict=True) if rows else [[]] * 3, (pa.int32(), pa.int64(), pa.binary()), strict=True)], names=["k", "sites", "payload"])


def sfs_em(saf: DataFrame, rounds: int = 20, tol: float = 1e-6) -> DataFrame:
    """Maximum-likelihood spectrum (bin, n) by EM over sites: a round sums the posterior arrays; the spectrum itself, 2n + 1
    numbers, is what travels between rounds. Samples without a row at a site have a flat likelihood there, so every site counts.

    Sites stay as wide as their own samples: the spectrum is brought to each number of chromosomes, and the sums are brought back."""
    spark = saf.sparkSession
    known = saf.where("saf is not null and size(saf) > 0 and forall(saf, x -> x is not null)").select(F.col("saf").cast("array<double>").alias("saf"))
    packed = kept(known.mapInArrow(likelihood_packs, "k int, sites long, payload binary"), "sfs-likelihoods")
    first = packed.agg(F.min("k").alias("least"), F.max("k").alias("most"), F.sum("sites").alias("sites")).first()
    if not first["sites"]:
        return spark.createDataFrame([], "bin int, n double")
    least, most = first["least"] - 1, first["most"] - 1

    def posterior(spectra: dict[int, np.ndarray]):
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            sums: dict[int, np.ndarray] = {}
            for batch in batches:
                for k, payload in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                    m = np.frombuffer(payload.as_buffer()).reshape(-1, k)
                    total = m @ spectra[k - 1]
                    sums[k - 1] = sums.get(k - 1, 0.0) + m.T @ np.divide(1.0, total, out=np.zeros_like(total), where=total > 0)
            n = np.concatenate([np.zeros(0, np.int32), *(np.full(n + 1, n, np.int32) for n in sums)])
            j = np.concatenate([np.zeros(0, np.int32), *(np.arange(n + 1, dtype=np.int32) for n in sums)])
            yield pa.RecordBatch.from_arrays([pa.array(n), pa.array(j), pa.array(np.concatenate([np.zeros(0), *sums.values()]))], names=["n", "j", "x"])

        return run

    p = np.full(most + 1, 1.0 / (most + 1))
    for _ in range(rounds):
        found = packed.select("k", "payload").mapInArrow(posterior(fewer(p, least)), "n int, j int, x double").groupBy("n", "j").agg(F.sum("x").alias("x")).toArrow().sort_by([("n", "ascending"), ("j", "ascending")])
        n, x = found.column("n").to_numpy(), found.column("x").to_numpy()
        new = p * more({int(i): x[n == i] for i in np.unique(n)}, least, most) / first["sites"]
        change = np.abs(new - p).max()
        p = new
        if change < tol:
            break
    return spark.createDataFrame([(j, float(v) * first["sites"]) for j, v in enumerate(p)], "bin int, n double")


def sfs_1d(gt: DataFrame, folded: bool = True) -> DataFrame:
    """Sites by alternative allele count and number of alleles called; folded where no ancestral state is known."""
    site = gt.groupBy(*SITE).agg(F.sum("dosage").alias("ac"), (2 * F.count("dosage")).alias("an")).where("an > 0")
    return site.groupBy((F.least(F.col("ac"), F.col("an") - F.col("ac")) if folded else F.col("ac")).alias("bin"), "an").agg(F.count(F.lit(1)).alias("n"))


def _site_terms(gt: DataFrame) -> DataFrame:
    """Per site: pairwise differences, whether it segregates, and 1 / a1 of its sample."""
    site = gt.groupBy(*SITE).agg(F.sum("dosage").alias("ac"), (2 * F.count("dosage")).alias("an")).where("an >= 2")
    pi = 2.0 * F.col("ac") * (F.col("an") - F.col("ac")) / (F.col("an") * (F.col("an") - 1))
    a1 = F.aggregate(F.sequence(F.lit(1), (F.col("an") - 1).cast("int")), F.lit(0.0), lambda s, i: s + F.lit(1.0) / i)
    seg = ((F.col("ac") > 0) & (F.col("ac") < F.col("an"))).cast("int")
    return site.select(*SITE, "ac", "an", pi.alias("pi"), seg.alias("seg"), (seg / a1).alias("theta_w"))


def sfs_stats(sfs: DataFrame) -> DataFrame:
    """sfs (bin, n) of 2N chromosomes, unfolded, bins 0..2N: pi, theta_W, S, sites, Tajima's D, Fu and Li's D."""
    size = sfs.agg(F.max("bin").alias("c")).withColumn("c", F.col("c").cast("double"))
    j = sfs.crossJoin(F.broadcast(size))
    inner = (F.col("bin") > 0) & (F.col("bin") < F.col("c"))
    pi = F.sum(F.col("n") * 2 * F.col("bin") * (F.col("c") - F.col("bin")) / (F.col("c") * (F.col("c") - 1)))
    t = j.agg(pi.alias("pi"), F.sum(F.when(inner, F.col("n")).otherwise(0)).alias("S"), F.sum("n").alias("n_sites"), F.sum(F.when(F.col("bin") == 1, F.col("n")).otherwise(0)).alias("singletons"), F.first("c").alias("c"))
    seq = F.sequence(F.lit(1), (F.col("c") - 1).cast("int"))
    a1 = F.aggregate(seq, F.lit(0.0), lambda s, i: s + F.lit(1.0) / i)
    a2 = F.aggregate(seq, F.lit(0.0), lambda s, i: s + F.lit(1.0) / (i * i))
    t = t.withColumns({"a1": a1, "a2": a2}).withColumn("theta_w", F.col("S") / F.col("a1"))
    c, s = F.col("c"), F.col("S")
    b1, b2 = (c + 1) / (3 * (c - 1)), 2 * (c * c + c + 3) / (9 * c * (c - 1))
    c1, c2 = b1 - 1 / F.col("a1"), b2 - (c + 2) / (F.col("a1") * c) + F.col("a2") / F.pow("a1", F.lit(2))
    e1, e2 = c1 / F.col("a1"), c2 / (F.pow("a1", F.lit(2)) + F.col("a2"))
    tajima = (F.col("pi") - F.col("theta_w")) / F.sqrt(e1 * s + e2 * s * (s - 1))
    cn = 2 * (c * F.col("a1") - 2 * (c - 1)) / ((c - 1) * (c - 2))
    v = 1 + F.pow("a1", F.lit(2)) / (F.col("a2") + F.pow("a1", F.lit(2))) * (cn - (c + 1) / (c - 1))
    u = F.col("a1") - 1 - v
    fu_li = (s - F.col("a1") * F.col("singletons")) / F.sqrt(u * s + v * s * s)
    return t.select("pi", "theta_w", "S", "n_sites", tajima.alias("tajima_d"), fu_li.alias("fu_li_d"))


def blocks_of_equal_size(sites: DataFrame, n_blocks: int) -> DataFrame:
    """sites with `block`, 1 to n_blocks along each contig; sizes differ by one at most, the first blocks being the larger."""
    sized = numbered(sites, "__i").join(sites.groupBy("chrom").agg(F.count(F.lit(1)).alias("__n")), "chrom")
    least, more = F.floor(F.col("__n") / n_blocks), F.col("__n") % n_blocks
    i, head = F.col("__i"), more * (least + 1)
    block = F.when(i < head, F.floor(i / (least + 1))).otherwise(more + F.floor((i - head) / F.greatest(least, F.lit(1))))
    return sized.withColumn("block", (block + 1).cast("int")).drop("__i", "__n")


def sfs_blocks(gt: DataFrame, n_blocks: int = 100) -> DataFrame:
    """Per block of neighbouring sites: pi, theta_W, S, sites, and the global sums minus the block's."""
    terms = blocks_of_equal_size(_site_terms(gt), n_blocks)
    own = terms.groupBy("chrom", "block").agg(F.sum("pi").alias("pi"), F.sum("theta_w").alias("theta_w"), F.sum("seg").alias("S"), F.count(F.lit(1)).alias("n_sites"))
    whole = own.agg(F.sum("pi").alias("__pi"), F.sum("S").alias("__s"))
    return own.crossJoin(F.broadcast(whole)).select("chrom", "block", "pi", "theta_w", "S", "n_sites", (F.col("__pi") - F.col("pi")).alias("pi_without"), (F.col("__s") - F.col("S")).alias("S_without"))


def sfs_block_spectra(gt: DataFrame, n_blocks: int = 100, folded: bool = True) -> DataFrame:
    """(chrom, block, bin, an, n): the spectrum of each block of neighbouring sites, as `sfs_1d` gives it of all."""
    site = gt.groupBy(*SITE).agg(F.sum("dosage").alias("ac"), (2 * F.count("dosage")).alias("an")).where("an > 0")
    own = F.least(F.col("ac"), F.col("an") - F.col("ac")) if folded else F.col("ac")
    return blocks_of_equal_size(site, n_blocks).groupBy("chrom", "block", own.alias("bin"), "an").agg(F.count(F.lit(1)).alias("n"))


def _windows(size: int, step: int) -> Column:
    """Start of every window [k * step, k * step + size) that holds pos - 1."""
    at = F.col("pos") - 1
    return F.explode(F.sequence(F.greatest(F.lit(0), F.ceil((at - size + 1) / step)).cast("long"), F.floor(at / step).cast("long")))


def windowed_theta(gt: DataFrame, size: int, step: int) -> DataFrame:
    """Sums of pi and theta_W over sliding windows."""
    w = _site_terms(gt).where("pos >= 1").withColumn("k", _windows(size, step))
    return w.groupBy("chrom", (F.col("k") * step).alias("start")).agg(F.sum("pi").alias("pi"), F.sum("theta_w").alias("theta_w"), F.sum("seg").alias("S"), F.count(F.lit(1)).alias("n_sites"))


def two_pops(gt: DataFrame, popmap: DataFrame, pop1: str, pop2: str) -> DataFrame:
    """Per site called in both: alternative and called alleles of each population."""
    pick = lambda p, c: F.sum(F.when(F.col("pop") == p, c))
    called = F.when(F.col("dosage").isNotNull(), 2)
    t = gt.join(popmap.where(F.col("pop").isin(pop1, pop2)), "sample_id").groupBy(*SITE).agg(pick(pop1, F.col("dosage")).alias("ac1"), pick(pop1, called).alias("an1"), pick(pop2, F.col("dosage")).alias("ac2"), pick(pop2, called).alias("an2"))
    return t.where("an1 > 0 and an2 > 0")


def sfs_2d(gt: DataFrame, popmap: DataFrame, pop1: str, pop2: str, fold: bool = False, project: tuple[int, int] | None = None) -> DataFrame:
    """Joint spectrum (i, j, n). project: to that many alleles of each population by hypergeometric weights (sites with fewer go)."""
    t = two_pops(gt, popmap, pop1, pop2)
    if project is None:
        cells = t.select(F.col("ac1").alias("i"), F.col("ac2").alias("j"), F.col("an1").alias("ni"), F.col("an2").alias("nj"), F.lit(1.0).alias("w"))
    else:
        logc = lambda n, k: F.aggregate(F.sequence(F.lit(1), F.greatest(k, F.lit(1)).cast("int")), F.lit(0.0), lambda s, i: s + F.when((k > 0) & (i <= k), F.log(F.greatest(n - i + 1, F.lit(1))) - F.log(i)).otherwise(0.0))
        hyper = lambda ac, an, m, k: F.when((k <= ac) & (m - k <= an - ac), F.exp(logc(ac, k) + logc(an - ac, m - k) - logc(an, F.lit(m)))).otherwise(0.0)
        a, b = project
        x = t.where((F.col("an1") >= a) & (F.col("an2") >= b)).withColumn("i", F.explode(F.sequence(F.lit(0), F.lit(a)))).withColumn("j", F.explode(F.sequence(F.lit(0), F.lit(b))))
        cells = x.select("i", "j", F.lit(a).alias("ni"), F.lit(b).alias("nj"), (hyper(F.col("ac1"), F.col("an1"), a, F.col("i")) * hyper(F.col("ac2"), F.col("an2"), b, F.col("j"))).alias("w"))
    if fold:
        flip = F.col("i") + F.col("j") > (F.col("ni") + F.col("nj")) / 2
        cells = cells.select(F.when(flip, F.col("ni") - F.col("i")).otherwise(F.col("i")).alias("i"), F.when(flip, F.col("nj") - F.col("j")).otherwise(F.col("j")).alias("j"), "w")
    return cells.groupBy("i", "j").agg(F.sum("w").alias("n"))


def _pair_terms(t: DataFrame) -> DataFrame:
    p, q = F.col("ac1") / F.col("an1"), F.col("ac2") / F.col("an2")
    num = (p - q) * (p - q) - p * (1 - p) / (F.col("an1") - 1) - q * (1 - q) / (F.col("an2") - 1)
    dxy = p * (1 - q) + q * (1 - p)
    seg = ((F.col("ac1") + F.col("ac2") > 0) & (F.col("ac1") + F.col("ac2") < F.col("an1") + F.col("an2"))).cast("int")
    return t.where("an1 > 1 and an2 > 1").select(*SITE, ((p - q) * (p - q)).alias("f2"), num.alias("num"), dxy.alias("dxy"), seg.alias("seg"))


def sfs_2d_stats(gt: DataFrame, popmap: DataFrame, pop1: str, pop2: str) -> DataFrame:
    """f2, Fst (Hudson, ratio of sums), d_xy, S, sites of two populations."""
    return _pair_terms(two_pops(gt, popmap, pop1, pop2)).agg(F.avg("f2").alias("f2"), (F.sum("num") / F.sum("dxy")).alias("fst"), F.avg("dxy").alias("dxy"), F.sum("seg").alias("S"), F.count(F.lit(1)).alias("n_sites"))


def windowed_fst(gt: DataFrame, popmap: DataFrame, pop1: str, pop2: str, size: int, step: int) -> DataFrame:
    """Fst per sliding window, ratio of sums."""
    w = _pair_terms(two_pops(gt, popmap, pop1, pop2)).where("pos >= 1").withColumn("k", _windows(size, step))
    return w.groupBy("chrom", (F.col("k") * step).alias("start")).agg((F.sum("num") / F.sum("dxy")).alias("fst"), F.count(F.lit(1)).alias("n_sites"))


def harmonic(n: int) -> float:
    return math.fsum(1 / i for i in range(1, n))
