"""Interval operators against plain Python on seeded random inputs, and the edges that define them."""

import math
import random

import pytest
from pyspark.sql import functions as F

from lociframe.operators import chunking as C
from lociframe.operators import intervals as I


def frame(spark, rows, weight=False):
    return spark.createDataFrame(rows, "chrom string, start long, end long" + (", weight long" if weight else ""))


def contigs(spark):
    return spark.createDataFrame([("a", 1000, 1), ("b", 500, 2), ("c", 50, 3)], "contig string, length long, rank int")


def random_intervals(seed, n=60):
    r = random.Random(seed)
    out = []
    for _ in range(n):
        c, size = r.choice([("a", 1000), ("b", 500)])
        s = r.randrange(size - 1)
        out.append((c, s, min(size, s + r.randint(1, 60))))
    return out


def rows(df):
    return sorted(tuple(r) for r in df.collect())


def py_merge(iv, gap=0):
    out = []
    for c, s, e in sorted(iv):
        if out and out[-1][0] == c and s - out[-1][2] <= gap:
            out[-1] = (c, out[-1][1], max(e, out[-1][2]))
        else:
            out.append((c, s, e))
    return out


def bases(iv):
    return {(c, p) for c, s, e in iv for p in range(s, e)}


@pytest.mark.parametrize("gap", [0, 7])
def test_merge(spark, gap):
    iv = random_intervals(1)
    assert rows(I.merge(frame(spark, iv), gap)) == py_merge(iv, gap)


def test_merge_gap_edges(spark):
    iv = frame(spark, [("a", 0, 10), ("a", 15, 20), ("a", 26, 30)])
    assert rows(I.merge(iv, 5)) == [("a", 0, 20), ("a", 26, 30)]


def test_subtract_complement_cover_the_same_bases(spark):
    a, b = random_intervals(2), random_intervals(3, 20)
    left = bases(rows(I.subtract(frame(spark, sorted(set(a))), frame(spark, b))))
    assert left == bases(a) - bases(b)
    genome = {(c, p) for c, n in (("a", 1000), ("b", 500), ("c", 50)) for p in range(n)}
    assert bases(rows(I.complement(frame(spark, b), contigs(spark)))) == genome - bases(b)


@pytest.mark.parametrize("width", [8, 16_384])
def test_pairs_semi_anti(spark, width):
    a, b = sorted(set(random_intervals(4, 30))), sorted(set(random_intervals(5, 30)))
    want = sorted((x, y) for x in a for y in b if x[0] == y[0] and x[1] < y[2] and y[1] < x[2])
    got = sorted(((r["chrom"], r["start"], r["end"]), (r["b_chrom"], r["b_start"], r["b_end"])) for r in I.overlap_pairs(frame(spark, a), frame(spark, b), width).collect())
    assert got == want
    hit = {x for x, _ in want}
    assert rows(I.overlap_semi(frame(spark, a), frame(spark, b), width)) == sorted(hit)
    assert rows(I.overlap_anti(frame(spark, a), frame(spark, b), width)) == sorted(set(a) - hit)


def test_empty_inputs(spark):
    none = frame(spark, [])
    some = frame(spark, [("a", 1, 5)])
    assert rows(I.merge(none)) == [] and rows(I.overlap_pairs(none, some)) == [] and rows(I.overlap_anti(some, none)) == [("a", 1, 5)]
    assert rows(I.complement(none, contigs(spark))) == [("a", 0, 1000), ("b", 0, 500), ("c", 0, 50)]


def greedy(weights, target):
    """One pass over the intervals, advancing where the running weight is nearest to the next cut."""
    positive = [w for w in weights if w > 0]
    total = sum(weights)
    if not positive:
        return [0] * len(weights)
    k = max(1, min(math.ceil(total / target), len(positive)))
    chunk, cum, held, out = 0, 0, 0, []
    for w in weights:
        if w > 0 and held > 0 and chunk < k - 1:
            cut = (chunk + 1) * total / k
            if abs(cum - cut) <= abs(cum + w - cut):
                chunk, held = chunk + 1, 0
        out.append(chunk)
        cum += w
        held += w > 0
    return out


@pytest.mark.parametrize("seed", range(6))
def test_balanced_chunks_equal_the_greedy_pass(spark, seed):
    r = random.Random(seed)
    iv, at = [], 0
    for i in range(r.randint(1, 25)):
        iv.append(("a" if i < 12 else "b", at % 400, at % 400 + 5, r.choice([0, 1, 2, 5, 50])))
        at += 10
    iv = sorted(set(iv))
    target = r.choice([3, 10, 60])
    got = [x["chunk"] for x in sorted(C.chunk_balanced(frame(spark, iv, True), contigs(spark), target).collect(), key=lambda x: (x["chrom"], x["start"]))]
    assert got == greedy([x[3] for x in iv], target)


def test_split_chunks_keep_every_base(spark):
    iv = [("a", 0, 100, 40), ("a", 200, 260, 30), ("b", 0, 10, 0), ("b", 20, 200, 70)]
    got = C.chunk_balanced_split(frame(spark, iv, True), contigs(spark), 33).collect()
    assert bases((r["chrom"], r["start"], r["end"]) for r in got) == bases(x[:3] for x in iv)
    assert sum(r["end"] - r["start"] for r in got) == sum(e - s for _, s, e, _ in iv) and {r["chunk"] for r in got} == set(range(5))


def test_ranges_of_one_sample_are_made_in_several_tasks(spark):
    counts = spark.createDataFrame([("a", 10_000_001), ("b", 0), ("c", 20_000)], "sample_id string, n_reads long")
    got = I.read_ranges(counts, 500)
    assert got.withColumn("task", F.spark_partition_id()).where("sample_id = 'a'").select("task").distinct().count() > 1
    a = got.where("sample_id = 'a'").orderBy("part").collect()
    assert [(r["first"], r["last"], r["part"]) for r in a] == [(i * 500 + 1, i * 500 + 500 if i < 20_000 else 10_000_001, i + 1) for i in range(20_001)]
    assert [(r["first"], r["last"]) for r in got.where("sample_id = 'b'").collect()] == [(1, 0)] and got.where("sample_id = 'c'").count() == 40
