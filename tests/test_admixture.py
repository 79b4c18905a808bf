"""Admixture to convergence: planted shares, restarts that agree, the guard of the extrapolation, parts, missing cells."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from lociframe.operators import admixture as A
from lociframe.operators import popgen as P


def planted(spark, n=24, sites=400, seed=1, missing=0.05):
    r = np.random.default_rng(seed)
    share = np.concatenate([np.ones(n // 3), np.zeros(n // 3), r.uniform(0.2, 0.8, n - 2 * (n // 3))])
    f = np.stack([r.uniform(0.05, 0.95, sites), r.uniform(0.05, 0.95, sites)])
    h = share[:, None] * f[0] + (1 - share[:, None]) * f[1]
    dosage = r.binomial(2, h)
    rows = []
    for i in range(n):
        for p in range(sites):
            g = np.where(np.arange(3) == dosage[i, p], 0.98, 0.01)
            rows.append((f"c{p % 2}", p, f"s{i:02}", None if r.random() < missing else g.tolist()))
    return spark.createDataFrame(rows, "chrom string, pos long, sample_id string, gl array<double>"), share, f


def shares(q, rep, n):
    rows = sorted((x["sample_id"], x["cluster"], x["q"]) for x in q.where(F.col("rep") == rep).collect())
    return np.array([x[2] for x in rows]).reshape(n, -1)


def test_restarts_of_a_planted_mixture_agree(spark):
    gl, share, f = planted(spark)
    q, freq, like = A.admixture_em(gl, 2, reps=2, seed=5)
    told = {x["rep"]: x for x in like.collect()}
    assert all(x["converged"] for x in told.values()) and told[0]["log_likelihood"] == pytest.approx(told[1]["log_likelihood"], rel=1e-5)
    one, two = shares(q, 0, 24), shares(q, 1, 24)
    two = two if np.abs(one - two).max() < np.abs(one - two[:, ::-1]).max() else two[:, ::-1]
    assert np.abs(one - two).max() < 1e-3 and np.allclose(one.sum(1), 1)
    own = one[:, 0] if np.abs(one[:, 0] - share).mean() < 0.5 else one[:, 1]
    assert np.abs(own - share).mean() < 0.08
    rows = sorted((x["pos"], x["cluster"], x["f"]) for x in freq.where("rep = 0").collect())
    got = np.array([x[2] for x in rows]).reshape(-1, 2)
    assert len(got) == 400 and min(np.abs(got[:, a] - f[b]).mean() for a, b in ((0, 0), (1, 0))) < 0.12


def plain_em(g, known, q, rounds):
    likes = []
    for _ in range(rounds):
        sums, like, _ = A.steps_of(q, g, known)
        likes.append(like)
        q = A.normalised(sums)
    return q, likes


def test_likelihood_never_falls_and_the_extrapolation_is_quicker():
    r = np.random.default_rng(2)
    share = r.uniform(0, 1, 15)
    h = np.outer(r.uniform(0.05, 0.95, 300), share) + np.outer(r.uniform(0.05, 0.95, 300), 1 - share)
    dosage = r.binomial(2, h)
    g, known = A.unit(np.where(dosage[:, :, None] == np.arange(3), 0.9, 0.05))
    start = A.normalised(r.dirichlet([1, 1], 15))
    q, likes = plain_em(g, known, start, 400)
    assert (np.diff(likes) > -1e-6 * abs(likes[0])).all()
    m = A.Model(0, np.arange(15), start)
    kept = []
    while not m.done:
        sums, like, _ = A.steps_of(m.q, g, known)
        m.take(sums, like, 1e-6, 400)
        kept.append(m.like)
    assert (np.diff(kept) > -1e-6 * abs(kept[0])).all()
    assert m.settled and m.rounds < 200 and m.like >= likes[-1] - 1e-3


def test_a_step_that_loses_likelihood_is_taken_back():
    m = A.Model(0, np.arange(2), np.array([[0.5, 0.5], [0.5, 0.5]]))
    m.take(np.array([[6.0, 4.0], [5.0, 5.0]]), -10.0, 1e-6, 100)
    m.take(np.array([[6.9, 3.1], [5.0, 5.0]]), -9.0, 1e-6, 100)
    second, far = m.safe, m.q
    assert second is not None and far[0, 0] > second[0, 0] and m.floor == -9.0
    m.take(np.array([[1.0, 9.0], [1.0, 9.0]]), -50.0, 1e-6, 100)
    assert np.array_equal(m.q, second) and m.safe is None and not m.done and m.like == -9.0


def test_parts_are_models_of_their_own(spark):
    gl, _, _ = planted(spark, 12, 60)
    parts = spark.createDataFrame([(f"s{i:02}", 7 if i < 6 else 9) for i in range(11)], "sample_id string, rep long")
    q, f, like = A.admixture_em(gl, 2, seed=3, parts=parts, rounds=40)
    assert q.groupBy("rep").count().orderBy("rep").collect() == [(7, 12), (9, 10)]
    alone, _, told = A.admixture_em(gl.where("sample_id < 's06'"), 2, seed=3, parts=parts.where("rep = 7"), rounds=40)
    assert np.abs(shares(q, 7, 6) - shares(alone, 7, 6)).max() < 1e-6
    assert like.where("rep = 7").first()["log_likelihood"] == pytest.approx(told.first()["log_likelihood"], rel=1e-9) and f.count() == 2 * 60 * 2


def test_samples_and_cells_without_likelihoods(spark):
    gl, _, _ = planted(spark, 9, 80, missing=0.5)
    empty = gl.withColumn("gl", F.when(F.col("sample_id") != "s03", F.col("gl")))
    q, _, like = A.admixture_em(empty, 2)
    assert q.count() == 18 and like.first()["converged"]
    assert A.admixture_em(gl.limit(0), 2)[0].count() == 0


def test_likelihoods_are_computed_once_for_all_levels_and_residuals(spark):
    r = np.random.default_rng(4)
    freq = np.where(np.arange(80) % 2 == 0, 0.05, 0.95)
    rows = [("c", p, f"s{i}", np.roll([0.98, 0.01, 0.01], int(r.binomial(2, freq[p] if i < 4 else 1 - freq[p]))).tolist()) for p in range(80) for i in range(8)]
    gl = spark.createDataFrame(rows, "chrom string, pos long, sample_id string, gl array<double>")
    read = spark.sparkContext.accumulator(0)

    def counted(batches):
        for batch in batches:
            read.add(batch.num_rows)
            yield batch

    parts = {x["sample_id"]: x["part"] for x in P.recursive_bipartition(gl.mapInArrow(counted, gl.schema), 2, 20).collect()}
    assert read.value == len(rows) and len({parts[f"s{i}"][0] for i in range(4)} | {parts["s5"][0]}) == 2
    q, f, _ = A.admixture_em(gl, 2, tolerance=1e-4)
    got = {(x["sample_i"], x["sample_j"]): x["value"] for x in P.admixture_residual_corr(gl.withColumnRenamed("gl", "gp"), q, f.mapInArrow(counted, f.schema)).collect()}
    assert read.value == len(rows) + 160
    shares = {(x["sample_id"], x["cluster"]): x["q"] for x in q.collect()}
    freqs = {(x["pos"], x["cluster"]): x["f"] for x in f.collect()}
    res = np.zeros((8, 80))
    for _, p, s, x in rows:
        res[int(s[1:]), p] = x[1] + 2 * x[2] - 2 * sum(shares[s, k] * freqs[p, k] for k in range(2))
    want = np.corrcoef(res)
    assert all(got[f"s{i}", f"s{j}"] == pytest.approx(want[i, j], abs=1e-9) for i in range(8) for j in range(i + 1, 8))


def test_frequencies_of_a_site_stand_still_within_the_rounds(monkeypatch):
    r = np.random.default_rng(8)
    q = A.normalised(r.dirichlet([1, 1], 20))
    dosage = r.binomial(2, np.outer(r.uniform(0.05, 0.95, 200), q[:, 0]) + np.outer(r.uniform(0.05, 0.95, 200), q[:, 1]))
    g, known = A.unit(np.where(dosage[:, :, None] == np.arange(3), 0.9, np.where(r.random((200, 20, 1)) < 0.2, np.nan, 0.05)))
    _, like, f = A.steps_of(q, g, known)
    monkeypatch.setattr(A, "INNER", 4000)
    _, most, far = A.steps_of(q, g, known)
    assert 0 <= most - like < 0.3 and (np.abs(f - far).max(1) < 1e-3).mean() > 0.85  # plain steps: 0.46 and 0.70


def test_packs_hold_planes_that_need_no_scaling(spark):
    gl, _, _ = planted(spark, 6, 30, missing=0.2)
    gl = gl.withColumn("gl", F.transform("gl", lambda x: x * 1e-30))
    cells = A.prepared(gl)
    want = {(x["chrom"], x["pos"], x["sample_id"]): x["gl"] for x in gl.collect() if x["gl"]}
    seen, names = 0, {x["n"]: x["sample_id"] for x in cells.samples.collect()}
    for batch in cells.packs.toArrow().to_batches():
        for chroms, positions, payload in zip(batch.column(0), batch.column(1), batch.column(2), strict=True):
            planes = A.unpacked(payload, 6)
            for i, (c, p) in enumerate(zip(chroms.as_py(), positions.as_py(), strict=True)):
                for j in range(6):
                    x = want.get((c, p, names[j]))
                    assert planes[:, i, j] == pytest.approx(np.array(x) / max(x) if x else np.zeros(3), rel=1e-6)
                    seen += x is not None
    assert seen == len(want) > 100
