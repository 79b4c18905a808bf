"""Linkage in tiles against numpy and plain Python: halos, blocks of samples, missing cells, chains over many tiles."""

import random

import numpy as np
import pytest

from lociframe.operators import ld as L


def cells(spark, x, pos):
    rows = [("c1" if p < 500_000 else "c2", p, f"s{i:03}", None if np.isnan(v) else int(v)) for i, line in enumerate(x) for p, v in zip(pos, line, strict=True)]
    return spark.createDataFrame(rows, "chrom string, pos long, sample_id string, dosage int")


@pytest.mark.parametrize("samples", [2048, 7])
def test_r2_against_numpy(spark, monkeypatch, samples):
    monkeypatch.setattr(L, "SAMPLES", samples)
    r = np.random.default_rng(4)
    pos = sorted({*(int(p) for p in r.integers(0, 90_000, 60)), *(19_990 + i for i in range(20)), *(600_000 + 10 * i for i in range(10))})
    base = r.integers(0, 3, (25, len(pos))).astype(float)
    base[r.random(base.shape) < 0.2] = np.nan
    base[:, 3], base[1:, 5] = 1.0, np.nan
    want = {}
    for i, p in enumerate(pos):
        for j in range(i + 1, len(pos)):
            if pos[j] - p > 3000 or (p < 500_000) != (pos[j] < 500_000):
                continue
            both = ~np.isnan(base[:, i]) & ~np.isnan(base[:, j])
            a, b = base[both, i], base[both, j]
            if len(a) >= 2 and a.var() > 0 and b.var() > 0:
                want[p, pos[j]] = (len(a), np.corrcoef(a, b)[0, 1] ** 2)
    got = {(x["pos_a"], x["pos_b"]): (x["n"], x["r2"]) for x in L.ld_r2_pairs(cells(spark, base, pos), 3000).collect()}
    assert got.keys() == want.keys() and len(want) > 100
    assert all(got[k][0] == want[k][0] and got[k][1] == pytest.approx(want[k][1], abs=1e-9) for k in want)


def greedy(sites, pairs, limit=0.2):
    near = {}
    for _, a, b, r2 in pairs:
        if r2 > limit:
            near.setdefault(a, set()).add(b)
            near.setdefault(b, set()).add(a)
    kept = set()
    for _, p, _ in sorted(sites, key=lambda s: (-(s[2] if s[2] is not None else float("-inf")), s[1])):
        if not near.get(p, set()) & kept:
            kept.add(p)
    return kept


def frames(spark, sites, pairs):
    return spark.createDataFrame(pairs, "chrom string, pos_a long, pos_b long, r2 double"), spark.createDataFrame(sites, "chrom string, pos long, priority int")


@pytest.mark.parametrize("seed", range(3))
def test_pruning_over_many_tiles(spark, monkeypatch, seed):
    monkeypatch.setattr(L, "WIDER", 3)
    r = random.Random(seed)
    pos = sorted(r.sample(range(0, 30_000_000, 1000), 700))
    sites = [("c", p, r.choice([None, 1, 1, 2, 5])) for p in pos]
    pairs = [("c", a, b, r.random()) for i, a in enumerate(pos) for b in pos[i + 1 : i + 6] if b - a <= 300_000]
    got = L.ld_prune(*frames(spark, sites, pairs), 0.3)
    assert {x["pos"] for x in got.collect()} == greedy(sites, pairs, 0.3)


def test_a_chain_takes_few_rounds(spark, monkeypatch):
    """Ties along 3,000 linked sites over 30 Mb: all hang on the first; rounds follow the logarithm of the length."""
    rounds = []
    plain = L.settle
    monkeypatch.setattr(L, "settle", lambda *a: rounds.append(a) or plain(*a))
    sites = [("c", 10_000 * i, 0) for i in range(3000)]
    pairs = [("c", 10_000 * i, 10_000 * (i + 1), 0.9) for i in range(2999)]
    got = L.ld_prune(*frames(spark, sites, pairs))
    assert {x["pos"] for x in got.collect()} == {10_000 * i for i in range(0, 3000, 2)} and len(rounds) <= 3


def test_nothing_linked(spark):
    pairs, sites = frames(spark, [("c", 5, 1), ("d", 5, None)], [("c", 5, 9, 0.1)])
    assert sorted(tuple(x) for x in L.ld_prune(pairs, sites).collect()) == [("c", 5), ("d", 5)]
    assert L.ld_prune(pairs, sites.limit(0)).count() == 0


def test_cohort_matrix_by_a_sweep(spark, monkeypatch):
    """Calls, overlapping and long reference blocks, and missing cells, against plain Python; a block is a row for each tile."""
    from lociframe.operators import genotypes as G

    monkeypatch.setattr(G, "TILE", 100)
    monkeypatch.setattr(G, "SAMPLES", 3)
    r = random.Random(1)
    calls = {(c, p, f"s{s}"): (r.choice([1, 2, None]), r.choice([7, None])) for c in "xy" for p in r.sample(range(1, 900), 25) for s in r.sample(range(9), 2)}
    blocks = [(f"s{s}", c, a, a + r.choice([1, 50, 600]), r.choice([3, 5, None])) for s in range(8) for c in "xy" for a in r.sample(range(900), 4)]
    got = G.combine_samples(spark.createDataFrame([(*k, *v) for k, v in calls.items()], "chrom string, pos long, sample_id string, dosage int, dp long"), spark.createDataFrame(blocks, "sample_id string, chrom string, start long, end long, dp long"))
    sites, want = {k[:2] for k in calls}, {}
    for c, p in sites:
        for s in {f"s{i}" for i in range(9)} & ({k[2] for k in calls} | {b[0] for b in blocks}):
            deep = [b[4] for b in blocks if b[0] == s and b[1] == c and b[2] < p <= b[3] and b[4] is not None]
            dosage, dp = calls.get((c, p, s), (None, None))
            deepest = max(deep, default=None)
            want[c, p, s] = (dosage if dosage is not None else 0 if deepest is not None and dp is None else None, dp if dp is not None else deepest)
    assert {(x["chrom"], x["pos"], x["sample_id"]): (x["dosage"], x["dp"]) for x in got.collect()} == want
