"""Banded likelihoods against the whole convolution, and planted joint spectra."""

import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from lociframe.operators import saf as S
from lociframe.operators import sfs as X


def plain(g):
    """The convolution without a band."""
    z = np.ones(1)
    for a, b, c in g:
        z = np.convolve(z, (a, 2 * b, c))
        z = z / z.max()
    n = len(z) - 1
    ways = np.array([math.lgamma(n + 1) - math.lgamma(j + 1) - math.lgamma(n - j + 1) for j in range(n + 1)])
    logs = np.log(np.maximum(z, 1e-300)) - ways
    return np.exp(logs - logs.max())


def likelihoods(r, dosage, depth=4, error=0.02):
    """P(reads | 0, 1, 2) of `depth` reads a cell."""
    p = np.array([error, 0.5, 1 - error])
    n = r.poisson(depth, dosage.shape)
    k = r.binomial(n, p[dosage])
    return np.stack([p[d] ** k * (1 - p[d]) ** (n - k) for d in range(3)], -1)


@pytest.mark.parametrize(("n", "depth", "cut"), [(1, 2, 1e-12), (25, 1, 1e-12), (25, 30, 1e-10), (120, 6, 1e-9)])
def test_dropped_mass_is_bounded(n, depth, cut):
    r = np.random.default_rng(n)
    freq = r.uniform(0, 1, 40)
    g = likelihoods(r, r.binomial(2, freq[:, None], (40, n)), depth)
    g[3] = 1.0
    low, h, lost = S.convolved(g, cut)
    for i in range(40):
        want = plain(g[i])
        got = np.zeros(2 * n + 1)
        got[low[i] : low[i] + h.shape[1]] = h[i][: 2 * n + 1 - low[i]]
        # the scale is that of the largest entry, which is off by `lost` at most itself
        assert np.abs(got - want).max() <= min(2 * lost[i], 1e4 * cut) + 1e-11
    assert n < 100 or np.median((h > 0).sum(1)) < n  # a band, not all 2n + 1


def frame(spark, g, pops):
    rows = [("c", p, f"s{i}", g[p, i].tolist()) for p in range(g.shape[0]) for i in range(g.shape[1])]
    return spark.createDataFrame(rows, "chrom string, pos long, sample_id string, gl array<double>"), spark.createDataFrame([(f"s{i}", x) for i, x in enumerate(pops)], "sample_id string, pop string")


def test_a_planted_joint_spectrum_is_found(spark):
    """30 + 30 samples, four kinds of sites, four reads a cell."""
    r = np.random.default_rng(2)
    kinds = [(0, 0, 500), (6, 6, 200), (30, 0, 150), (20, 40, 150)]
    dosage = []
    for a, b, sites in kinds:
        for _ in range(sites):
            alleles = [r.permutation(np.arange(60) < k) for k in (a, b)]
            dosage.append(np.concatenate([x.reshape(30, 2).sum(1) for x in alleles]))
    g = likelihoods(r, np.array(dosage))
    gl, pops = frame(spark, g, ["A"] * 30 + ["B"] * 30)
    got = np.zeros((61, 61))
    for x in S.sfs_2d_em(gl, pops, "A", "B", blocks=2).collect():
        got[x["i"], x["j"]] = x["n"]
    assert got.sum() == pytest.approx(1000, abs=1e-6)
    for a, b, sites in kinds:
        near = got[max(0, a - 4) : a + 5, max(0, b - 4) : b + 5].sum()
        assert near == pytest.approx(sites, abs=0.05 * sites), (a, b)
    assert got[0, 0] == pytest.approx(500, abs=15)


def test_sure_likelihoods_give_called_counts_folded_too(spark):
    r = np.random.default_rng(5)
    dosage = r.binomial(2, r.uniform(0, 1, 120)[:, None], (120, 7))
    g = np.where(dosage[:, :, None] == np.arange(3), 1.0, 1e-9)
    gl, pops = frame(spark, g, ["A"] * 3 + ["B"] * 4)
    called = spark.createDataFrame([("c", p, f"s{i}", int(dosage[p, i])) for p in range(120) for i in range(7)], "chrom string, pos long, sample_id string, dosage int")
    for fold in (False, True):
        got = {(x["i"], x["j"]): x["n"] for x in S.sfs_2d_em(gl, pops, "A", "B", fold).collect() if x["n"] > 1e-3}
        want = {(x["i"], x["j"]): x["n"] for x in X.sfs_2d(called, pops, "A", "B", fold).collect()}
        assert got.keys() == want.keys() and all(got[k] == pytest.approx(want[k], abs=1e-2) for k in want)


def test_sites_with_few_samples_and_none(spark):
    r = np.random.default_rng(8)
    g = likelihoods(r, r.binomial(2, 0.3, (60, 6)), 10)
    gl, pops = frame(spark, g, ["A"] * 3 + ["B"] * 3)
    some = gl.where("not (sample_id = 's1' and pos % 3 = 0)").withColumn("gl", F.when(F.expr("not (sample_id = 's5' and pos % 4 = 0)"), F.col("gl")))
    assert sum(x["n"] for x in S.sfs_2d_em(some, pops, "A", "B").collect()) == pytest.approx(60)
    assert S.sfs_2d_em(gl.limit(0), pops, "A", "B").count() == 0 and S.banded_likelihood(gl.limit(0)).count() == 0


def test_spectrum_of_sites_of_all_widths_is_that_of_widened_sites(spark):
    r = np.random.default_rng(3)
    arrays = [r.random(int(k)) for k in r.choice([3, 5, 9, 13], 200)]
    wide = []
    for a in arrays:
        while len(a) < 13:
            j = np.arange(len(a) + 1)
            a = ((len(a) - j) * np.append(a, 0.0) + j * np.append(0.0, a)) / len(a)
        wide.append(a)
    p = np.full(13, 1 / 13)
    for _ in range(5):
        w = np.array(wide) * p
        p = (w / w.sum(1, keepdims=True)).mean(0)
    assert np.allclose(X.fewer(p, 2)[2] @ arrays[0][:1].repeat(3), p @ np.full(13, arrays[0][0]))
    saf = spark.createDataFrame([(a.tolist(),) for a in arrays], "saf array<double>")
    got = {x["bin"]: x["n"] for x in X.sfs_em(saf, 5, 0.0).collect()}
    assert [got[j] for j in range(13)] == pytest.approx((200 * p).tolist(), abs=1e-9)
