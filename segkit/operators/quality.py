"""Data-quality checks and profiles (Q1-Q11).

Every check is a single aggregate pass over the input; results are small
(one row per column or per distinct offending value).
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from segkit.functions.scalar import fixed_round


def domain_violations(df: DataFrame, domains: dict) -> DataFrame:
    """Q2: (column, value, n) for every non-null value outside its allowed set."""
    offenders = df.select(*[
        F.when(F.col(c).isNotNull() & ~F.col(c).isin(list(vals)), F.col(c).cast("string")).alias(c)
        for c, vals in domains.items()])
    long = offenders.unpivot([], list(domains), "column", "value").where(F.col("value").isNotNull())
    return long.groupBy("column", "value").agg(F.count(F.lit(1)).alias("n"))


def null_counts(df: DataFrame, columns=None) -> DataFrame:
    """Null count for each column, one pass: ``(column, nulls, rows)``."""
    cols = list(columns or df.columns)
    wide = df.agg(F.count(F.lit(1)).alias("_rows"),
                  *[F.sum(F.col(c).isNull().cast("bigint")).alias(c) for c in cols])
    return (wide.unpivot(["_rows"], cols, "column", "nulls")
                .select("column", F.coalesce(F.col("nulls"), F.lit(0)).cast("bigint").alias("nulls"),
                        F.col("_rows").alias("rows")))


def null_inventory(df: DataFrame, columns=None) -> DataFrame:
    """Q3: columns with at least one null, with count and percentage (1 dp)."""
    return (null_counts(df, columns).where(F.col("nulls") > 0)
            .select("column", "nulls",
                    fixed_round(F.col("nulls") * 100.0 / F.col("rows"), 1).alias("null_pct")))


def value_share(df: DataFrame, col: str, keep_null=False) -> DataFrame:
    """Q7: value, count and share of non-null rows (%), one aggregate + a scalar subquery."""
    src = df if keep_null else df.where(F.col(col).isNotNull())
    counts = src.groupBy(col).agg(F.count(F.lit(1)).alias("n"))
    total = counts.select(F.sum("n")).scalar()  # same shuffle as ``counts``: AQE reuses it
    return counts.select(col, "n", fixed_round(F.col("n") * 100.0 / total, 2).alias("share_pct"))


def score_distribution(df: DataFrame, col: str) -> DataFrame:
    """Q8: count per observed score, ordered by score."""
    return (df.groupBy(col).agg(F.count(F.lit(1)).alias("n")).orderBy(col))


def numeric_range(df: DataFrame, col: str, digits: int = 4) -> DataFrame:
    """Q9: min, max, mean, sample standard deviation."""
    return df.agg(F.min(col).alias("min_value"), F.max(col).alias("max_value"),
                  fixed_round(F.avg(col), digits).alias("mean_value"),
                  fixed_round(F.stddev_samp(col), digits).alias("std_value"))


def shape(df: DataFrame) -> DataFrame:
    """Q11: rows and columns."""
    return df.agg(F.count(F.lit(1)).alias("rows")).withColumn(
        "columns", F.lit(len(df.columns)).cast("bigint"))


def assert_equal_counts(a: DataFrame, b: DataFrame) -> int:
    """Q5: row counts of two datasets must agree."""
    return same_counts(a.count(), b.count())


def same_counts(na: int, nb: int) -> int:
    """Q5 for counts that are known already."""
    if na != nb:
        raise AssertionError(f"row counts differ: {na} vs {nb}")
    return na


def group_total_check(df: DataFrame, group: str, expected_total: int | None = None) -> DataFrame:
    """Q6: group sizes must add up to the row total (or to ``expected_total``).

    One shuffle: per-group counts, then their sum; returns
    ``(n_groups, total, expected, matches)``.
    """
    sizes = df.groupBy(group).agg(F.count(F.lit(1)).alias("n"))
    out = sizes.agg(F.count(F.lit(1)).alias("n_groups"), F.sum("n").cast("bigint").alias("total"))
    exp = F.lit(expected_total).cast("bigint") if expected_total is not None else df.select(F.count(F.lit(1))).scalar()
    return out.select("n_groups", "total", exp.alias("expected"), (F.col("total") == exp).alias("matches"))
