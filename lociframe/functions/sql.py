"""Scalar functions registered for SQL: gp_to_gt, pl_to_gp, hwe_exact, iupac."""

from __future__ import annotations

import pandas as pd
from pyspark.sql import SparkSession
from pyspark.sql import functions as F

from lociframe.operators.filters import hwe_test
from lociframe.operators.mito import IUPAC


def register_sql_functions(spark: SparkSession) -> None:
    """The expression functions are SQL functions, so Catalyst inlines them; the exact test is an Arrow UDF."""
    spark.sql("CREATE OR REPLACE TEMPORARY FUNCTION pl_to_gp(pl ARRAY<INT>) RETURNS ARRAY<DOUBLE> RETURN transform(pl, x -> pow(10D, -x / 10D) / aggregate(pl, 0D, (a, y) -> a + pow(10D, -y / 10D)))")
    spark.sql("CREATE OR REPLACE TEMPORARY FUNCTION gp_to_gt(gp ARRAY<DOUBLE>, min_posterior DOUBLE) RETURNS INT RETURN CASE WHEN 1 - array_max(gp) <= 1 - min_posterior THEN CAST(array_position(gp, array_max(gp)) - 1 AS INT) END")
    codes = ", ".join(f"'{k}', '{v}'" for k, v in IUPAC.items())
    spark.sql(f"CREATE OR REPLACE TEMPORARY FUNCTION iupac(a STRING, b STRING) RETURNS STRING RETURN CASE WHEN a = b THEN a ELSE coalesce(map({codes})[concat(least(a, b), greatest(a, b))], 'N') END")

    @F.pandas_udf("double")
    def hwe(a: pd.Series, b: pd.Series, c: pd.Series) -> pd.Series:
        return hwe_test.func(a, b, c)["HWE"]

    spark.udf.register("hwe_exact", hwe)
