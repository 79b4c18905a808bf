"""Results that no SQL holds: exact tests, p values, drawn alleles, repeated reads and intervals, all trees."""

import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from lociframe.operators import chunking as C
from lociframe.operators import filters as Q
from lociframe.operators import genotypes as G
from lociframe.operators import popgen as P
from lociframe.operators import reads as R
from lociframe.plans.more_queries import reads as cut_into_reads


def plain_hwe(a, h, b):
    n, rare = a + h + b, min(2 * a + h, 2 * b + h)
    logs = {k: math.lgamma(n + 1) - math.lgamma((rare - k) // 2 + 1) - math.lgamma(k + 1) - math.lgamma(n - (rare + k) // 2 + 1) + k * math.log(2) for k in range(rare % 2, rare + 1, 2)}
    top = max(logs.values())
    p = {k: math.exp(v - top) for k, v in logs.items()}
    total = sum(p.values())
    return sum(v for v in p.values() if v <= p[h] * (1 + 1e-9)) / total, sum(v for k, v in p.items() if k >= h) / total


def test_exact_tests_of_large_and_small_cohorts():
    r = random.Random(1)
    for size in (1, 5, 40, 3000):
        for _ in range(20):
            t = [r.randint(0, size) for _ in range(3)]
            if sum(t):
                assert Q.hwe_p(*t) == pytest.approx(plain_hwe(*t), abs=1e-9)
    assert Q.hwe_p(0, 0, 0) == (1.0, 1.0)
    # a published example: 57 heterozygotes, 14 and 50 homozygotes
    assert Q.hwe_p(50, 57, 14)[0] == pytest.approx(0.8423, abs=2e-3)


def test_p_values_of_likelihood_ratios(spark):
    # upper tails of chi-square with one degree: 0.05, 0.01 and 0.001
    rows = [("c", 1, 3.841459), ("c", 2, 6.634897), ("c", 3, 10.827566), ("c", 4, 0.0), ("c", 5, -2.0), ("c", 6, None), ("c", 7, 3.841459)]
    got = {x["pos"]: (x["p"], x["p_adjusted"]) for x in Q.lr_pvalue_bh(spark.createDataFrame(rows, "chrom string, pos long, lr double")).collect()}
    for pos, p in ((1, 0.025), (2, 0.005), (3, 0.0005), (4, 0.5), (5, 0.5), (7, 0.025)):
        assert got[pos][0] == pytest.approx(p, abs=1e-7)
    assert got[6] == (None, None)
    assert got[3][1] == pytest.approx(0.003, abs=1e-6) and got[2][1] == pytest.approx(0.015, abs=1e-6) and got[1][1] == pytest.approx(0.0375, abs=1e-6) and got[4][1] == pytest.approx(0.5)


def test_drawn_alleles_follow_their_reads(spark):
    n = 4000
    counts = spark.range(n).select(F.lit("c").alias("chrom"), F.col("id").alias("pos"), F.lit("s").alias("sample_id"), F.lit(6).alias("A"), F.lit(0).alias("C"), F.lit(2).alias("G"), F.lit(0).alias("T"))
    got = {r["allele"]: r["count"] for r in G.single_read_ibs(counts, mode="random").groupBy("allele").count().collect()}
    assert set(got) == {0, 2} and got[0] / n == pytest.approx(0.75, abs=0.03)
    g = spark.range(n).select(F.lit("c").alias("chrom"), F.col("id").alias("pos"), F.lit("s").alias("sample_id"), F.lit(1).alias("dosage"), F.array(F.lit(9), F.lit(3)).alias("ad"))
    share = G.pseudohaploid(g).agg(F.avg(F.col("dosage") / 2.0)).first()[0]
    assert share == pytest.approx(0.25, abs=0.03)


def test_repeated_names_pair_one_to_one(spark):
    one = spark.createDataFrame([("g", "n", "AA", "II"), ("g", "n", "AC", "II"), ("g", "n", "AG", "II"), ("g", "m", "T", "I"), ("h", "n", "T", "I")], "rg string, name string, seq string, qual string")
    two = spark.createDataFrame([("g", "n", "CC", "II"), ("g", "n", "CA", "II"), ("h", "x", "T", "I")], "rg string, name string, seq string, qual string")
    pairs, alone = R.pair_sync(one, two)
    assert sorted((r["seq1"], r["seq2"]) for r in pairs.collect()) == [("AA", "CA"), ("AC", "CC")]
    assert sorted(map(tuple, alone.collect())) == [("g", "m", 1), ("g", "n", 1), ("h", "n", 1), ("h", "x", 2)]


def test_unpaired_reads_are_found_without_their_letters(spark):
    """By counts: names of many reads, and reads without a group or a name, which pair with none."""
    names = [("g", "n")] * 3 + [("g", "m")] + [(None, "n"), ("g", None)] * 2
    one = spark.createDataFrame(names, "rg string, name string").unionByName(spark.range(3501).select(F.lit("g").alias("rg"), F.lit("many").alias("name")))
    two = spark.createDataFrame([("g", "n"), ("h", "m"), ("g", "many"), (None, "n")], "rg string, name string")
    letters = {c: F.raise_error(F.lit("letters are read")).cast("string") for c in ("seq", "qual")}
    alone = R.pair_sync(one.withColumns(letters), two.withColumns(letters))[1].groupBy("rg", "name", "mate").count()
    assert {(r["rg"], r["name"], r["mate"]): r["count"] for r in alone.collect()} == {("g", "n", 1): 2, ("g", "m", 1): 1, (None, "n", 1): 2, ("g", None, 1): 2, ("g", "many", 1): 3500, ("h", "m", 2): 1, (None, "n", 2): 1}


def test_texts_of_any_length_are_cut_into_whole_reads(spark, tmp_path):
    texts = {i: ("aé漢😀 " * 900)[:n] for i, n in enumerate((0, 1, 100, 101, 1999, 2000, 2001, 2100, 4001))} | {9: None}
    spark.createDataFrame(list(texts.items()), "doc_id long, text string").write.parquet(str(tmp_path / "documents.parquet"))
    got = {(r["doc_id"], r["part"]): r["seq"] for r in cut_into_reads(spark, str(tmp_path)).collect()}
    assert got == {(i, k // 100): t[k : k + 100] for i, t in texts.items() for k in range(0, len(t or ""), 100)}


def test_equal_intervals_stay_as_many(spark):
    rows = [("a", 10 * (i // 3), 10 * (i // 3) + 5, 4) for i in range(30)] + [("b", 0, 5, 0), ("b", 0, 5, 0), ("b", 0, 5, 7)]
    iv = spark.createDataFrame(rows, "chrom string, start long, end long, weight long")
    contigs = spark.createDataFrame([("a", 1000, 1), ("b", 100, 2)], "contig string, length long, rank int")
    got = C.chunk_balanced(iv, contigs, 30).collect()
    assert sorted((r["chrom"], r["start"], r["end"], r["weight"]) for r in got) == sorted(rows)
    weight = {}
    for r in got:
        weight[r["chunk"]] = weight.get(r["chunk"], 0) + r["weight"]
    assert sorted(weight) == list(range(5)) and max(weight.values()) <= 30


def test_all_trees_equal_one_by_one(spark):
    r = np.random.default_rng(4)
    rows = [("c", p, f"{pop}{i}", int(r.binomial(2, f))) for p in range(0, 400, 4) for pop, f in zip("ABCDO", r.uniform(0.05, 0.95, 5), strict=True) for i in range(3) if r.random() > 0.15]
    gt = spark.createDataFrame(rows, "chrom string, pos long, sample_id string, dosage int")
    pops = spark.createDataFrame([(f"{p}{i}", p) for p in "ABCDO" for i in range(3)], "sample_id string, pop string")
    trees = {(x["h1"], x["h2"], x["h3"]): x for x in P.abba_baba_trees(gt, pops, "O", 50).collect()}
    assert len(trees) == 12
    for h in (("A", "B", "C"), ("B", "D", "A"), ("C", "D", "B")):
        one = P.abba_baba(gt, pops, *h, "O", 50).first()
        assert all(trees[h][c] == pytest.approx(one[c], abs=1e-9) for c in ("D", "SE", "Z")) and trees[h]["n_blocks"] == one["n_blocks"]


def test_no_trees_without_the_outgroup_or_three_others(spark):
    gt = spark.createDataFrame([("c", 1, f"{p}0", 1) for p in "ABCO"], "chrom string, pos long, sample_id string, dosage int")
    pops = lambda names: spark.createDataFrame([(f"{p}0", p) for p in names], "sample_id string, pop string")
    for names in ("ABC", "ABO", "O"):
        got = P.abba_baba_trees(gt, pops(names), "O", 50)
        assert got.columns == ["h1", "h2", "h3", "D", "SE", "n_blocks", "Z"] and got.count() == 0
    assert P.abba_baba_trees(gt, pops("ABCO"), "O", 50).count() == 3


def test_samples_at_one_place_stay_and_a_repeated_sample_is_an_error(spark):
    coords = spark.createDataFrame([(1.0, 1.0, "a"), (1.0, 1.0, "b"), (9.0, 9.0, "c")], "long double, lat double, sample_id string")
    box = spark.createDataFrame([(0.0, 0.0), (2.0, 2.0)], "long double, lat double")
    dist = spark.createDataFrame([(i, j, 1.0) for i in "abc" for j in "abc"], "sample_i string, sample_j string, value double")
    used, sub = P.geo_filter(coords, box, dist)
    assert sorted(x["sample_id"] for x in used.collect()) == ["a", "b"]
    assert sorted((x["sample_i"], x["sample_j"]) for x in sub.collect()) == [("a", "a"), ("a", "b"), ("b", "a"), ("b", "b")]
    with pytest.raises(ValueError):
        P.geo_filter(coords.unionByName(coords), box, dist)
