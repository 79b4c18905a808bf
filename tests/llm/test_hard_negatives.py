"""Hard negatives against plain Python: nulls, odd vectors, repeats, ties, clashing columns; intervals against exact scores."""

import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from lociframe.llm import hard_negatives as H


def brute(rows, is_anchor, positives=5, negatives=3, dims=None):
    good = []
    for i, v, label in rows:
        if i is None or label is None or not v or any(x is None or not math.isfinite(x) for x in v) or len(v) != dims:
            continue
        x = [math.floor(256.0 * float(np.float32(c))) for c in v]
        if sum((abs(256.0 * c) + 1) ** 2 for c in v) < 2**62:
            good.append((i, label, x))
    out = []
    for k, (i, label, x) in enumerate(good):
        if not is_anchor(i):
            continue
        scored = sorted((-sum(p * q for p, q in zip(x, y, strict=True)), m, j) for j, (m, _, y) in enumerate(good) if j != k)
        same = [(s, m) for s, m, j in scored if good[j][1] == label][:positives]
        for s, m in same:
            hit = [(t, n) for t, n, j in scored if good[j][1] != label and 50 * -s <= 100 * -t <= 95 * -s][:negatives]
            out += [(i, m, r, n, -s, -t) for r, (t, n) in enumerate(hit, 1)]
    return sorted(out)


def rows(n=300, dims=12, seed=2):
    r = random.Random(seed)
    centres = [[r.gauss(0, 1) for _ in range(dims)] for _ in range(6)]
    out = []
    for i in range(n):
        c = r.choice(centres)
        out.append((i, [float(np.float32((x + r.gauss(0, 0.5)) / 4)) for x in c], r.choice([0, 0, 0, 1, 2])))
    out += [(n, None, 1), (n + 1, out[0][1], None), (n + 2, [float("nan")] * dims, 1), (n + 3, [None] * dims, 1), (n + 4, [float("inf")] * dims, 1), (None, out[3][1], 1), (n + 5, [0.5], 1), (n + 6, [], 0)]
    out += [(n + 10, [0.0] * dims, 0), (n + 11, out[5][1], 0), (n + 12, out[5][1], 2), out[0], out[0], out[7], (n + 20, [3e9] * dims, 0), (n + 21, [1e7] * dims, 0)]
    return out


def got(df):
    return sorted(tuple(r) for r in df.select("anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score").collect())


def frame(spark, data):
    return spark.createDataFrame([(*x, 1, "t") for x in data], "vec_id long, embedding array<float>, label int, times int, hash string")


def test_against_brute_force(spark):
    data = rows()
    want = brute(data, lambda i: i % 3 == 0, dims=12)
    assert len(want) > 500 and got(H.hard_negatives(frame(spark, data).repartition(3), F.col("vec_id") % 3 == 0)) == want


def test_wide_vectors_and_other_limits(spark):
    data = rows(90, 70, 4)
    assert got(H.hard_negatives(frame(spark, data), None, 2, 4)) == brute(data, lambda i: True, 2, 4, 70)


def test_one_label_many_ties(spark):
    data = [(i, [1.0, float(i % 3)], 0) for i in range(40)] + [(50 + i, [0.75, float(i % 2)], 1) for i in range(40)]
    assert got(H.hard_negatives(frame(spark, data), F.col("vec_id") % 5 == 0)) == brute(data, lambda i: i % 5 == 0, dims=2)


@pytest.mark.parametrize("dims", [1, 3, 64, 100])
def test_intervals_hold_the_scores(dims):
    rng = np.random.default_rng(dims)
    x = rng.integers(-300, 300, (200, dims))
    x[0] = 0
    turn = H.rotations(dims)
    codes = np.zeros(len(x), H.code_type(dims))
    codes["x"] = x
    codes["bits"], codes["along"], codes["rest"] = H.coded(x, turn)
    low, high = H.Anchors(x[:50], turn).intervals(slice(0, 50), codes)
    exact = x[:50] @ x.T
    assert (low <= exact).all() and (exact <= high).all()
    if dims == 64:  # narrow enough to filter
        lengths = np.sqrt((x * x).sum(1))
        assert np.median((high - low)[1:, 1:] / np.outer(lengths[1:50], lengths[1:])) < 0.5


def test_nothing_to_mine(spark):
    assert got(H.hard_negatives(frame(spark, []))) == []
    assert got(H.hard_negatives(frame(spark, rows(20)), F.lit(False))) == []
