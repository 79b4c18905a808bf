"""Slices of the mix: even whatever the weights, and without effect on the result."""

from pyspark.sql import functions as F

from lociframe.llm import mixing


def keys(spark, n, low=0.05):
    weight = F.when(F.col("id") % 7 == 0, low).when(F.col("id") % 5 == 0, 0.3).otherwise(1.0)
    source = F.when(F.col("id") % 3 == 0, "hot").otherwise(F.concat(F.lit("s"), (F.col("id") % 7).cast("string")))
    return spark.range(n).select(F.col("id").alias("doc_id"), source.alias("source"), (F.col("id") % 50).alias("size"), mixing.key_of(F.col("id"), weight, 7).alias("key"))


def test_slices_are_even_for_small_weights(spark):
    rows = keys(spark, 200_000)
    for slices in (64, 2000):
        sliced = rows.withColumn("slice", mixing.slice_of(rows, slices))
        found = sliced.groupBy("slice").agg(F.count(F.lit(1)).alias("n"), F.min("key").alias("lo"), F.max("key").alias("hi")).orderBy("slice").collect()
        assert max(x["n"] for x in found) < 200_000 / 20 and len(found) > slices / 2
        assert all(a["hi"] < b["lo"] for a, b in zip(found, found[1:], strict=False))


def test_the_mix_does_not_depend_on_slices(spark):
    rows = keys(spark, 3000).cache()
    got = [sorted(map(tuple, mixing._placed(rows, mixing.WEIGHTS, 1.5, 2.0, n).select("doc_id", "target", "epochs", "part").collect())) for n in (10, 10**9)]
    assert got[0] == got[1]
    taken, size, target = {}, {}, {}
    for r in mixing._placed(rows, mixing.WEIGHTS, 1.5, 2.0, 50).collect():
        taken[r["source"]] = taken.get(r["source"], 0) + r["epochs"] * r["size"] + r["part"]
        size[r["source"]], target[r["source"]] = r["source_size"], r["target"]
    assert taken == {s: int(t) for s, t in target.items()}


def test_equal_keys_and_no_rows(spark):
    rows = keys(spark, 100).withColumn("key", F.lit(0.5))
    assert rows.withColumn("slice", mixing.slice_of(rows, 64)).select("slice").distinct().count() == 1
    assert mixing._placed(keys(spark, 0), mixing.WEIGHTS, 1.5, 2.0, 50).count() == 0
