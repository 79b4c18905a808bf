"""Pair statistics and ordination against numpy: missing cells, several blocks of samples and sites, no row per pair and site."""

import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from lociframe.operators import gram
from lociframe.operators import popgen as P
from lociframe.operators import spectral


def cells(spark, x):
    """A (samples, sites) matrix with NaN as a frame."""
    rows = [(f"chr{p % 3}", p * 10, f"s{i:04}", None if np.isnan(v) else float(v)) for i, line in enumerate(x) for p, v in enumerate(line)]
    return spark.createDataFrame(rows, "chrom string, pos long, sample_id string, dosage double")


def matrix(n, m, seed=0, missing=0.1):
    r = np.random.default_rng(seed)
    p = r.uniform(0.1, 0.9, m)
    x = r.binomial(2, p, (n, m)).astype(float)
    x[r.random((n, m)) < missing] = np.nan
    return x


def table(df, *columns):
    return {(r["sample_i"], r["sample_j"]): tuple(r[c] for c in columns) for r in df.collect()}


def test_statistics_over_blocks(spark, monkeypatch):
    monkeypatch.setattr(gram, "BLOCK", 256)
    x = matrix(300, 40)
    x[0, :20], x[1, 20:] = np.nan, np.nan  # no common site
    g = cells(spark, x)
    known = ~np.isnan(x)
    n = known.astype(int) @ known.T
    freq = np.nansum(x, 0) / (2 * known.sum(0))
    z = np.nan_to_num((x - 2 * freq) / np.sqrt(2 * freq * (1 - freq)))
    name = [f"s{i:04}" for i in range(300)]
    d = np.array([[np.nansum(np.abs(x[i] - x[j])) for j in range(300)] for i in range(300)])
    got = table(P.ibs_distance(g), "value")
    assert (name[0], name[1]) not in got and len(got) == (n[np.triu_indices(300, 1)] > 0).sum()
    assert all(got[name[i], name[j]][0] == pytest.approx(d[i, j] / (2 * n[i, j])) for i, j in ((0, 2), (5, 299), (255, 256), (280, 290)))
    got = table(P.grm(g), "value")
    rel = (z @ z.T) / np.maximum(n, 1)
    assert all(got[name[i], name[j]][0] == pytest.approx(rel[i, j], abs=1e-9) for i, j in ((0, 0), (3, 257), (255, 256), (299, 299)))
    own = np.nansum((x**2 - (1 + 2 * freq) * x + 2 * freq**2) / (2 * freq * (1 - freq)), 1) / known.sum(1) + 1
    got = table(P.relatedness_ajk(g), "value")
    assert all(got[name[i], name[i]][0] == pytest.approx(own[i]) for i in (0, 1, 260)) and got[name[3], name[257]][0] == pytest.approx(rel[3, 257], abs=1e-9)
    got = table(P.king_table(g), "nsnp", "hethet", "ibs0", "het_i", "het_j")
    for i, j in ((2, 3), (4, 290)):
        both = known[i] & known[j]
        a, b = x[i][both], x[j][both]
        assert got[name[i], name[j]] == (both.sum(), ((a == 1) & (b == 1)).sum(), (np.abs(a - b) == 2).sum(), (a == 1).sum(), (b == 1).sum())


def test_a_thousand_samples_and_ten_thousand_sites(spark):
    """10^7 cells made by a rule; the plan's widest rows are pairs and packs."""
    n, m = 1000, 10_000
    k = F.col("id")
    s, p = (k % n), F.floor(k / n)
    d = ((s * 31 + p * 17 + (s * p) % 13) % 7) % 4
    g = spark.range(n * m).select(F.lit("c").alias("chrom"), p.alias("pos"), F.concat(F.lit("s"), F.lpad(s.cast("string"), 4, "0")).alias("sample_id"), F.when(d < 3, d).alias("dosage"))
    pairs = P.joint_genotype_counts(g)
    got = pairs.where("sample_i in ('s0000', 's0300', 's0998') and sample_j in ('s0001', 's0700', 's0999')").collect()
    sites = np.arange(m)
    value = lambda i: ((i * 31 + sites * 17 + (i * sites) % 13) % 7) % 4
    assert len(got) == 6
    for r in got:
        a, b = value(int(r["sample_i"][1:])), value(int(r["sample_j"][1:]))
        assert all(r[f"n{i}{j}"] == ((a == i) & (b == j)).sum() for i in range(3) for j in range(3))


def test_likelihood_distance_and_residuals(spark):
    r = np.random.default_rng(3)
    gp = r.dirichlet([1, 1, 1], (6, 30))
    rows = [("c", p, f"s{i}", gp[i, p].tolist() if (i + p) % 7 else None) for i in range(6) for p in range(30)]
    gl = spark.createDataFrame(rows, "chrom string, pos long, sample_id string, gp array<double>")
    w = np.array([[0, 0.5, 1], [0.5, 0, 0.5], [1, 0.5, 0]])
    got = table(P.gl_expected_distance(gl), "value")
    for i, j in ((0, 1), (2, 5)):
        both = [p for p in range(30) if (i + p) % 7 and (j + p) % 7]
        assert got[f"s{i}", f"s{j}"][0] == pytest.approx(np.mean([gp[i, p] @ w @ gp[j, p] for p in both]))
    q = spark.createDataFrame([(f"s{i}", c, 0.3 if c else 0.7) for i in range(6) for c in range(2)], "sample_id string, cluster int, q double")
    f = spark.createDataFrame([("c", p, c, 0.2 + 0.5 * c) for p in range(30) for c in range(2)], "chrom string, pos long, cluster int, f double")
    got = table(P.admixture_residual_corr(gl, q, f), "value")
    res = lambda i, both: np.array([gp[i, p, 1] + 2 * gp[i, p, 2] - 2 * (0.7 * 0.2 + 0.3 * 0.7) for p in both])
    both = [p for p in range(30) if (1 + p) % 7 and (4 + p) % 7]
    assert got["s1", "s4"][0] == pytest.approx(np.corrcoef(res(1, both), res(4, both))[0, 1])


def test_replicates_of_blocks(spark):
    x = matrix(5, 50, 7)
    g = cells(spark, x)
    got = {(r["rep"], r["sample_i"], r["sample_j"]): r["value"] for r in P.bootstrap_blocks(g, 4, 30).collect()}
    assert len(got) == 30 * 10 and len(set(got.values())) > 200
    # a replicate is a mean of blocks: all weights 1 give the plain distance
    plain = table(P.ibs_distance(g), "value")
    one = {(r["sample_i"], r["sample_j"]): r["d"] / r["n"] for r in gram.replicate_distances(g.withColumn("w", F.array(F.lit(1))), F.floor(F.col("pos") / 70), F.col("w"), 1).collect()}
    assert all(one[k] == pytest.approx(v[0]) for k, v in plain.items()) and len(one) == len(plain)
    mean = np.mean([got[rep, "s0000", "s0001"] for rep in range(1, 31)])
    assert mean == pytest.approx(plain["s0000", "s0001"][0], abs=0.08)


def pair_frame(spark, m):
    rows = [(f"s{i:04}", f"s{j:04}", float(m[i, j])) for i in range(len(m)) for j in range(i, len(m))]
    return spark.createDataFrame(rows, "sample_i string, sample_j string, value double"), spark.createDataFrame([(f"s{i:04}",) for i in range(len(m))], "sample_id string")


def wide(vectors, k):
    rows = sorted((r["sample_id"], r["component"], r["value"]) for r in vectors.collect())
    return np.array([v for _, _, v in rows]).reshape(-1, k)


def test_components_equal_the_whole_decomposition(spark, monkeypatch):
    monkeypatch.setattr(spectral, "BLOCK", 64)
    r = np.random.default_rng(5)
    x = r.standard_normal((200, 400)) + 3 * np.outer(r.standard_normal(200), r.standard_normal(400))
    m = x @ x.T / 400
    pairs, samples = pair_frame(spark, m)
    small = P.pca(pairs, samples, 20)
    large = P.pca(pairs, samples, 20, whole=0)
    values = [np.array([r["eigenvalue"] for r in v.orderBy("component").collect()]) for _, v in (small, large)]
    assert len(values[1]) == 20 and np.abs(values[0] - values[1]).max() < 1e-6 * values[0][0]
    assert np.abs(wide(small[0], 20) - wide(large[0], 20)).max() < 1e-5
    assert P.pca(pairs, samples, 20, n_variants=3)[1].count() == 3
    with pytest.raises(ValueError, match="two samples"):
        P.pca(pairs, samples.limit(1))
    with pytest.raises(ValueError, match="variant"):
        P.pca(pairs, samples, n_variants=0)


def test_scaling_equals_the_whole_decomposition(spark, monkeypatch):
    monkeypatch.setattr(spectral, "BLOCK", 32)
    pts = np.random.default_rng(6).normal(size=(90, 4)) * [5, 3, 1, 0.5]
    d = np.sqrt(((pts[:, None] - pts[None]) ** 2).sum(2)) + 0.01
    np.fill_diagonal(d, 0)
    pairs, samples = pair_frame(spark, d)
    sq = P.square(pairs, samples)
    small, large = P.mds(sq, 3), P.mds(sq, 3, whole=0)
    assert np.abs(wide(small[0].where("component <= 3"), 3) - wide(large[0], 3)).max() < 1e-5


def test_leading_without_spark():
    r = np.random.default_rng(1)
    q, _ = np.linalg.qr(r.standard_normal((500, 500)))
    values = np.sort(np.concatenate([[40, 30, -60, 25, 24.9], r.uniform(-5, 5, 495)]))[::-1]
    m = (q * values) @ q.T
    got, vectors = spectral.leading(lambda x: m @ x, 500, 4)
    assert np.abs(got - values[:4]).max() < 1e-6 and np.abs(np.abs(vectors.T @ q[:, :4]) - np.eye(4)).max() < 1e-5
    assert math.isclose(spectral.leading(lambda x: 0 * x, 10, 2)[0][0], 0, abs_tol=1e-12)


def test_shares_of_a_table(spark):
    x = matrix(12, 80, 2, 0)
    g = cells(spark, x)
    vectors, values = P.pca(P.grm(g), g.select("sample_id"), 5)
    pops = spark.createDataFrame([("s0001", "A")], "sample_id string, pop string")
    rows = {r["sample_id"]: r for r in P.pca_table(vectors, values, pops).collect()}
    ev = [r["eigenvalue"] for r in values.orderBy("component").collect()]
    assert len(ev) == 5 and rows["s0001"]["pop"] == "A" and rows["s0002"]["pop"] == "Unknown"
    assert rows["s0000"]["PC1_percent"] == pytest.approx(100 * ev[0] / sum(ev)) and rows["s0000"]["PC2_percent"] == pytest.approx(100 * ev[1] / sum(ev))


def test_a_block_is_no_wider_than_the_samples(spark):
    g = cells(spark, matrix(10, 30, missing=0.0))
    samples, n, sites = gram.counted_samples(g)
    packed = gram.packs(g, samples, [F.col("dosage")], sites=sites, block=n)
    assert packed.selectExpr("sum(length(payload)) / sum(n_sites)").first()[0] == 16 + 4 * 10  # a block of 256 has 1,040


def test_cells_and_squares_are_computed_once(spark):
    rows = [("c", p, f"s{i}", (p * 7 + i * i) % 3) for p in range(60) for i in range(6)]
    gt = spark.createDataFrame(rows, "chrom string, pos long, sample_id string, dosage int")
    read = spark.sparkContext.accumulator(0)

    def counted(batches):
        for batch in batches:
            read.add(batch.num_rows)
            yield batch

    def seen(run, df):
        before = read.value
        run(df.mapInArrow(counted, df.schema)).collect()
        return read.value - before

    assert seen(P.grm, gt) == len(rows)
    assert seen(lambda g: P.bootstrap_blocks(g, 10, 5), gt) == len(rows)
    relationships, sq = P.grm(gt), P.square(P.ibs_distance(gt), gt.select("sample_id"))
    assert seen(lambda r: P.pca(r, gt.select("sample_id"))[0], relationships) == 21
    assert seen(lambda s: P.mds(P.drop_until_complete(s))[0], sq) == 36
