"""Generic table steps: the algebra that feeds samples, intervals and files from one operator to the next."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F


def map_rows(df: DataFrame, exprs: dict[str, Column | str]) -> DataFrame:
    """Projection: one named expression per output column."""
    return df.select(*((F.expr(e) if isinstance(e, str) else e).alias(n) for n, e in exprs.items()))


def keep(df: DataFrame, predicate: Column | str) -> DataFrame:
    """Rows for which the predicate is true (unknown is not)."""
    return df.where(predicate)


def flat_map(df: DataFrame, list_cols: list[str]) -> DataFrame:
    """Parallel lists to rows; lists of unequal length are an error."""
    sizes = [F.size(c) for c in list_cols]
    equal = F.lit(True)
    for s in sizes[1:]:
        equal = equal & (s == sizes[0])
    checked = df.withColumn("__z", F.when(equal, F.arrays_zip(*list_cols)).otherwise(F.raise_error(F.lit("lists of unequal length"))))
    rest = [c for c in df.columns if c not in list_cols]
    return checked.select(*rest, F.explode("__z").alias("__z")).select(*rest, *(F.col(f"__z.{c}").alias(c) for c in list_cols))


def group_tuple(df: DataFrame, keys: list[str]) -> DataFrame:
    """Other columns gathered into sorted lists per key."""
    return df.groupBy(*keys).agg(*(F.sort_array(F.collect_list(c)).alias(c) for c in df.columns if c not in keys))


def join_by(a: DataFrame, b: DataFrame, keys: list[str]) -> DataFrame:
    """Inner equi-join."""
    return a.join(b, keys, "inner")


def combine(a: DataFrame, b: DataFrame) -> DataFrame:
    """Product with a side that is small by nature (intervals of a genome, populations); Spark picks the side to broadcast."""
    return a.crossJoin(b)


def combine_by(a: DataFrame, b: DataFrame, keys: list[str]) -> DataFrame:
    """Many-to-many equi-join."""
    return a.join(b, keys)


def not_done(df: DataFrame, done: DataFrame, keys: list[str]) -> DataFrame:
    """Rows whose key is not among the done."""
    return df.join(done.select(*keys), keys, "left_anti")


def mix(*dfs: DataFrame) -> DataFrame:
    """Bag union by column names."""
    out = dfs[0]
    for d in dfs[1:]:
        out = out.unionByName(d)
    return out


def concat(*dfs: DataFrame) -> DataFrame:
    """Union with `source_order`, the place of the frame each row came from."""
    return mix(*(d.withColumn("source_order", F.lit(i)) for i, d in enumerate(dfs)))


def distinct_first(df: DataFrame, keys: list[str], precedence: list[str]) -> DataFrame:
    """One row per key: the first by `precedence`."""
    return df.withColumn("__n", F.row_number().over(W.partitionBy(*keys).orderBy(*precedence))).where("__n = 1").drop("__n")


def unique(df: DataFrame, cols: list[str]) -> DataFrame:
    return df.select(*cols).distinct()


def branch(df: DataFrame, rules: dict[str, Column | str]) -> dict[str, DataFrame]:
    """Rows routed to the first rule that is true; a row that fits none raises when it is read."""
    route = F.raise_error(F.lit("a row fits no branch"))
    for name, rule in reversed(rules.items()):
        route = F.when(F.coalesce(F.expr(rule) if isinstance(rule, str) else rule, F.lit(False)), F.lit(name)).otherwise(route)
    routed = df.withColumn("__route", route)
    return {name: routed.where(F.col("__route") == name).drop("__route") for name in rules}


def sorted_rows(df: DataFrame, specs: list[tuple[str, bool]]) -> DataFrame:
    """Total order by (column, ascending) pairs."""
    return df.orderBy(*(F.col(c).asc() if up else F.col(c).desc() for c, up in specs))


def cohort_size(df: DataFrame, col: str = "sample_id") -> DataFrame:
    return df.agg(F.countDistinct(col).alias("cohort_size"))


def collect_file(df: DataFrame, cols: list[str], sep: str, path: str) -> None:
    """Rows rendered as text lines."""
    df.select(F.concat_ws(sep, *(F.col(c).cast("string") for c in cols)).alias("value")).write.mode("overwrite").text(path)


def if_empty(df: DataFrame, default: DataFrame) -> DataFrame:
    return default if df.isEmpty() else df


def collect_list_rows(df: DataFrame, col: str, by: list[str]) -> DataFrame:
    return df.groupBy(*by).agg(F.sort_array(F.collect_list(col)).alias(col))


def split_text(df: DataFrame, col: str, sep: str = "\n") -> DataFrame:
    rest = [c for c in df.columns if c != col]
    return df.select(*rest, F.explode(F.split(col, sep)).alias(col)).where(F.col(col) != "")


def manifest(df: DataFrame, key: str, within: list[str]) -> DataFrame:
    """Rows numbered from 1 in order of `key` within each group."""
    return df.withColumn("input_index", F.row_number().over(W.partitionBy(*within).orderBy(key)))


def counted_groups(parts: DataFrame, key: str, part: str, expected: str) -> DataFrame:
    """Keys whose declared number of distinct parts has arrived (the batch twin of the stream)."""
    return parts.groupBy(key, expected).agg(F.countDistinct(part).alias("n_parts")).where(F.col("n_parts") == F.col(expected))


def in_both(a: DataFrame, b: DataFrame) -> DataFrame:
    """Distinct rows of the first that the second has too; nulls equal nulls."""
    return a.select(*b.columns).intersect(b)


def only_first(a: DataFrame, b: DataFrame) -> DataFrame:
    """Distinct rows of the first that the second lacks; nulls equal nulls."""
    return a.select(*b.columns).subtract(b)


def top_k(df: DataFrame, by: list[str], order: list[tuple[str, bool]], k: int) -> DataFrame:
    """The first k rows of each group by (column, ascending) pairs; Spark keeps k rows a group before it shuffles."""
    place = F.row_number().over(W.partitionBy(*by).orderBy(*(F.col(c).asc() if up else F.col(c).desc() for c, up in order)))
    return df.withColumn("__place", place).where(F.col("__place") <= k).drop("__place")
