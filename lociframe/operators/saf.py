"""Allele-count likelihoods of sites from genotype likelihoods, in a band, and joint spectra of two populations from them.

h_j, the likelihood of j derived alleles among 2k with the binomial divided out, follows from h of one sample less as an average of
three of its entries, so it can be cut as it grows: entries below `cut` of the largest are dropped, what was dropped is bounded, and a
site costs samples x band instead of samples squared. All sites of a batch take a sample at a time together.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lociframe.operators.lineage import scratch

SITE = ["chrom", "pos"]
CUT = 1e-12
#: Sites multiplied at once, in order of their bands.
CHUNK = 256


def convolved(g: np.ndarray, cut: float) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """g (sites, samples, 3) -> (lowest count, band of h scaled to maximum 1 (0 where it ends), bound of the error of any entry)."""
    sites, samples, _ = g.shape
    g = g / np.maximum(g.max(2, keepdims=True), 1e-300)
    low, h, lost = np.zeros(sites, np.int64), np.ones((sites, 1)), np.zeros(sites)
    for k in range(samples):
        width = h.shape[1] + 2
        j = low[:, None] + np.arange(width)[None, :]
        before = np.zeros((sites, width + 2))
        before[:, 2:-2] = h
        all_ = float((2 * k + 2) * (2 * k + 1))
        new = g[:, k, :1] * np.clip((2 * k + 2 - j) * (2 * k + 1 - j), 0, None) * before[:, 2:]
        new += g[:, k, 1:2] * 2 * np.clip(j * (2 * k + 2 - j), 0, None) * before[:, 1:-1]
        new += g[:, k, 2:] * np.clip(j * (j - 1), 0, None) * before[:, :-2]
        new /= all_
        top = np.maximum(new.max(1), 1e-300)
        new /= top[:, None]
        lost = np.minimum(lost / top, 1e300)
        over = new >= cut
        first = over.argmax(1)
        last = width - 1 - over[:, ::-1].argmax(1)
        lost = lost + np.where((new * ~over).any(1), cut, 0.0)
        at = first[:, None] + np.arange(int((last - first).max()) + 1)[None, :]
        h = np.where(at <= last[:, None], np.take_along_axis(new, np.minimum(at, width - 1), 1), 0.0)
        low = low + first
    return low, h, lost


def banded_likelihood(gl: DataFrame, samples: int | None = None, cut: float = CUT) -> DataFrame:
    """(chrom, pos, n_samples, low, band, lost): likelihoods of low, low + 1, ... derived alleles, scaled to maximum 1; all others are less
    than `lost`, which also bounds the error of those given. gl: (chrom, pos, sample_id, gl) with P(data | 0, 1, 2 derived); nulls
    are flat. samples: sites with fewer get flat ones up to that number."""
    flat = F.array(*(F.lit(1.0) for _ in range(3)))
    cells = F.struct("sample_id", F.when(F.col("gl").isNotNull() & F.forall("gl", lambda x: x.isNotNull() & ~F.isnan(x)), F.col("gl")).otherwise(flat).alias("gl"))
    packed = gl.groupBy(*SITE).agg(F.flatten(F.transform(F.array_sort(F.collect_list(cells)), lambda x: x["gl"])).alias("g"))
    chrom, pos = (gl.schema[c].dataType.simpleString() for c in SITE)

    def convolve(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for batch in (whole.slice(s, 1000) for s in range(0, whole.num_rows, 1000)):
                values = batch.column(2)
                sizes = np.diff(values.offsets.to_numpy()) // 3
                most = max(int(sizes.max()), samples or 0)
                g = np.ones((batch.num_rows, most, 3))
                own = np.arange(most)[None, :] < sizes[:, None]
                g[own] = values.flatten().to_numpy().reshape(-1, 3)
                out: list[tuple] = [()] * batch.num_rows
                for n in np.unique(np.maximum(sizes, samples or 0)).tolist():
                    mine = np.flatnonzero(np.maximum(sizes, samples or 0) == n)
                    low, h, lost = convolved(g[mine, :n], cut)
                    for i, a, band, e in zip(mine.tolist(), low.tolist(), h, lost.tolist(), strict=True):
                        end = len(band) - int((band[::-1] > 0).argmax())
                        out[i] = (n, a, band[:end], e)
                columns = list(zip(*out, strict=True))
                yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(columns[0], pa.int32()), pa.array(columns[1], pa.int32()), pa.array(columns[2], pa.list_(pa.float64())), pa.array(columns[3])], names=[*SITE, "n_samples", "low", "band", "lost"])

    return packed.mapInArrow(convolve, f"chrom {chrom}, pos {pos}, n_samples int, low int, band array<double>, lost double")


def site_allele_likelihood(gl: DataFrame, cut: float = CUT) -> DataFrame:
    """`saf`: likelihood of each number of derived alleles at a site, the samples' likelihoods convolved in order of their ids, binomials
    divided out; scaled to maximum 1, entries below about `cut` being 0."""
    zeros = lambda n: F.array_repeat(F.lit(0.0), n)
    return banded_likelihood(gl, None, cut).select(*SITE, F.concat(zeros(F.col("low")), "band", zeros(2 * F.col("n_samples") + 1 - F.col("low") - F.size("band"))).alias("saf"))


def posterior_sums(p: np.ndarray):
    """A function for mapInArrow over (low1, band1, low2, band2): sums over sites of the posteriors of (i, j) under the joint spectrum p,
    a row for each; and, at (-1, -1), the log-likelihood."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums, like = np.zeros_like(p), 0.0
        for batch in batches:
            bands = []
            for c in (0, 2):
                low, values = batch.column(c).to_numpy(), batch.column(c + 1)
                bands.append((low, np.diff(values.offsets.to_numpy()), values.offsets.to_numpy() - values.offsets[0].as_py(), values.flatten().to_numpy()))
            order = np.lexsort((bands[1][0], bands[0][0]))
            for s in range(0, len(order), CHUNK):
                some = order[s : s + CHUNK]
                dense, at = [], []
                for low, size, start, values in bands:
                    a, b = int(low[some].min()), int((low[some] + size[some]).max())
                    m = np.zeros((len(some), b - a))
                    col = np.arange(b - a)[None, :] - (low[some] - a)[:, None]
                    inside = (col >= 0) & (col < size[some][:, None])
                    m[inside] = values[(start[some][:, None] + col)[inside]]
                    dense.append(m)
                    at.append(slice(a, b))
                part = p[at[0], at[1]]
                total = np.maximum(((dense[0] @ part) * dense[1]).sum(1), 1e-300)
                like += float(np.log(total).sum())
                sums[at[0], at[1]] += part * (dense[0].T @ (dense[1] / total[:, None]))
        i, j = np.nonzero(sums)
        yield pa.RecordBatch.from_arrays([pa.array(np.append(i, -1).astype(np.int32)), pa.array(np.append(j, -1).astype(np.int32)), pa.array(np.append(sums[i, j], like))], names=["i", "j", "x"])

    return run


def sfs_2d_em(gl: DataFrame, popmap: DataFrame, pop1: str, pop2: str, fold: bool = False, blocks: int = 4, window: int = 2, epochs: int = 30, full: int = 5, tolerance: float = 1e-5, cut: float = CUT) -> DataFrame:
    """Joint spectrum (i, j, n) of two populations from genotype likelihoods: i and j derived alleles among all of each population's
    samples, n the expected number of sites, at sites with a row in both. Folded, (i, j) is where the minor alleles are.

    Sites are dealt into `blocks` by a hash and written once. An epoch goes through the blocks; after each, the spectrum is the mean of
    the posteriors of the last `window` blocks (all blocks in the last epoch). It ends when an epoch changes the log-likelihood by
    less than `tolerance` of it, or after `epochs`. The driver holds the spectrum, (2n + 1)(2m + 1) numbers.
    """
    spark = gl.sparkSession
    members = popmap.where(F.col("pop").isin(pop1, pop2)).select("sample_id", "pop")
    used = gl.join(members, "sample_id")
    counts = {r["pop"]: r["n"] for r in used.groupBy("pop").agg(F.countDistinct("sample_id").alias("n")).collect()}
    n1, n2 = counts.get(pop1, 0), counts.get(pop2, 0)
    first = banded_likelihood(used.where(F.col("pop") == pop1), n1, cut).select(*SITE, F.col("low").alias("low1"), F.col("band").alias("band1"))
    second = banded_likelihood(used.where(F.col("pop") == pop2), n2, cut).select(*SITE, F.col("low").alias("low2"), F.col("band").alias("band2"))
    path = scratch(spark, "joint-likelihoods")
    joined = first.join(second, SITE).select("low1", "band1", "low2", "band2", F.pmod(F.xxhash64(*SITE), F.lit(blocks)).alias("block"))
    joined.write.partitionBy("block").parquet(path)
    data = spark.read.schema("low1 int, band1 array<double>, low2 int, band2 array<double>, block long").parquet(path)
    sites = data.count()
    if not sites:
        return spark.createDataFrame([], "i int, j int, n double")
    p = np.full((2 * n1 + 1, 2 * n2 + 1), 1.0 / ((2 * n1 + 1) * (2 * n2 + 1)))

    def step(part: DataFrame) -> tuple[np.ndarray, float]:
        found = part.select("low1", "band1", "low2", "band2").mapInArrow(posterior_sums(p), "i int, j int, x double").groupBy("i", "j").agg(F.sum("x").alias("x")).toArrow()
        i, j, x = (found.column(c).to_numpy() for c in ("i", "j", "x"))
        out = np.zeros_like(p)
        real = i >= 0
        out[i[real], j[real]] = x[real]
        return out, float(x[~real].sum())

    floor = 0.01 / (sites * p.size)
    recent: list[np.ndarray] = []
    before = None
    for _ in range(epochs):
        like = 0.0
        for b in range(blocks):
            sums, part = step(data.where(F.col("block") == b))
            like += part
            recent = [*recent, sums][-window:]
            total = sum(recent)
            if total.sum() > 0:  # what the last blocks have not is not impossible
                p = (total / total.sum() + floor) / (1 + floor * p.size)
        if before is not None and abs(like - before) < tolerance * abs(like):
            break
        before = like
    before = None
    for _ in range(full):
        sums, like = step(data)
        p = sums / sums.sum()
        if before is not None and abs(like - before) < tolerance * abs(like):
            break
        before = like
    if fold:
        i, j = np.indices(sums.shape)
        flip = i + j > n1 + n2
        folded = np.where(flip, 0.0, sums)
        folded[::-1, ::-1] += np.where(flip, sums, 0.0)
        sums = folded
    i, j = np.nonzero(sums > 0)
    return spark.createDataFrame(pa.table({"i": pa.array(i.astype(np.int32)), "j": pa.array(j.astype(np.int32)), "n": sums[i, j]}))
