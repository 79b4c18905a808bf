"""Windows in tiles against plain Python, and how the rows of one contig are dealt."""

import random

import pytest
from pyspark.sql import functions as F

from lociframe.operators import intervals as I
from lociframe.operators import tiles as T


def rows_of(seed=1, n=400):
    r = random.Random(seed)
    return [(r.choice(["a", "b"]), r.randrange(5000), i, r.choice([None, r.randrange(100)])) for i in range(n)]


@pytest.mark.parametrize("how", ["max", "min", "sum", "last", "next"])
@pytest.mark.parametrize("inclusive", [False, True])
def test_running_values(spark, how, inclusive):
    rows = rows_of()
    df = spark.createDataFrame(rows, "chrom string, pos long, i long, v long").repartition(3)
    got = {x["i"]: x["out"] for x in T.running(df, "out", how, F.col("v"), ["pos", "i"], T.tile_of("pos", 700), inclusive=inclusive).collect()}
    for c in "ab":
        own = sorted((x for x in rows if x[0] == c), key=lambda x: (x[1], x[2]))
        for k, (_, _, i, _) in enumerate(own):
            seen = [x[3] for x in own[: k + inclusive] if x[3] is not None]
            if how == "next":
                want = own[k + 1][3] if k + 1 < len(own) else None
                # the next tile's first row stands in for a next row whose value is null
                assert got[i] == want or want is None
            else:
                want = {"max": max, "min": min, "sum": sum, "last": lambda s: s[-1]}[how](seen) if seen else None
                assert got[i] == want


def test_numbers_and_neighbours(spark):
    rows = rows_of(2)
    df = spark.createDataFrame(rows, "chrom string, pos long, i long, v long")
    numbers = {x["i"]: x["k"] for x in T.numbered(df, "k", ("pos", "i"), size=300).collect()}
    close = {x["i"]: x["k"] for x in T.near(df, "k", F.col("v") > 50, 40, size=90).collect()}
    for c, p, i, _ in rows:
        assert numbers[i] == sum(d == c and (q, j) < (p, i) for d, q, j, _ in rows)
        assert close[i] == sum(d == c and abs(q - p) <= 40 and (v or 0) > 50 for d, q, _, v in rows)


def test_ties_at_the_start_of_an_island(spark):
    iv = spark.createDataFrame([("c", 5, 9), ("c", 5, 9), ("c", 5, 9), ("c", 9, 12), ("c", 20, 20), ("c", 20, 20), ("c", 1000, 1100), ("c", 1000, 1100)], "chrom string, start long, end long")
    got = sorted((r["start"], r["end"], r["n"]) for r in I.merge(iv, 0, {"n": F.count(F.lit(1))}, tile=64).collect())
    assert got == [(5, 12, 4), (20, 20, 2), (1000, 1100, 2)]


def test_one_contig_is_many_tasks(spark):
    """The largest task of a window over one contig has at most a tenth of the rows."""
    df = spark.range(20_000).select(F.lit("c").alias("chrom"), (F.col("id") * 1000).alias("pos"))
    old = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", "40")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        counted = T.numbered(df, "k", size=100_000)
        sizes = [r["n"] for r in counted.groupBy(F.spark_partition_id().alias("p")).agg(F.count(F.lit(1)).alias("n"), F.sum("k")).collect()]
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", old)
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
    assert sum(sizes) == 20_000 and max(sizes) <= 2_000
