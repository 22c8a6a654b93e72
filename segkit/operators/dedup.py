"""Deduplication.

Both forms are aggregations, not windows: Spark combines duplicates map-side
(partial aggregation) before the shuffle, so a key that holds a third of all
rows is reduced inside each input task and never lands whole in one task.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def dedup_full(df: DataFrame, exclude=(), order_by: str | None = None) -> DataFrame:
    """One row per distinct combination of all columns except ``exclude`` and the order column.

    Nulls compare equal.  The first row by ``order_by`` stays, with its own excluded columns (e.g. a truth label).  Without
    excluded columns there is nothing to choose and no order is needed.
    """
    carried = {*exclude, *([order_by] if order_by else [])}
    compare = [c for c in df.columns if c not in carried]
    if len(compare) == len(df.columns):
        return df.dropDuplicates()
    return first_rows(df, compare, order_by)


def first_rows(df: DataFrame, keys, order_by: str | None) -> DataFrame:
    """The row with the smallest ``order_by`` per key (null keys are equal); ``order_by`` is unique within a key.

    A hash aggregate of one number per key, reduced map-side, and a semi-join on key and number.
    """
    if not order_by:
        raise ValueError("name the column that holds the input order")
    first = df.groupBy(*[F.col(k).alias(f"_k{i}") for i, k in enumerate(keys)]).agg(F.min(order_by).alias("_first"))
    same = F.col(order_by) == F.col("_first")
    for i, k in enumerate(keys):
        same = same & F.col(k).eqNullSafe(F.col(f"_k{i}"))
    return df.join(first, same, "left_semi")


def dedup_keep_first(df: DataFrame, keys, order_by: str) -> DataFrame:
    """One row per key, the first by ``order_by``."""
    return first_rows(df, list(keys), order_by)


def dedup_two_pass(df: DataFrame, keys, exclude=(), order_by: str | None = None) -> DataFrame:
    """U1 then U2 (the order the cleaning stage uses).

    The first row of a key is also the first of its group of equal rows, so both passes are one: U2.
    """
    return first_rows(df, list(keys), order_by)


def union_all(*frames: DataFrame) -> DataFrame:
    """U4: bag union by column name."""
    out = frames[0]
    for f in frames[1:]:
        out = out.unionByName(f)
    return out


def duplicate_report(df: DataFrame, keys, exclude=()) -> DataFrame:
    """Q10: rows before, after full-row dedup, after key dedup, removed.

    Equal rows are counted first and their keys after that, two plain aggregates; ``keys`` are among the compared columns.
    """
    compare = [c for c in df.columns if c not in set(exclude)]
    if set(keys) - set(compare):
        raise ValueError(f"keys {sorted(set(keys) - set(compare))} are not compared")
    rows = df.groupBy(*compare).agg(F.count(F.lit(1)).alias("_n"))
    per_key = rows.groupBy(*keys).agg(F.sum("_n").alias("_n"), F.count(F.lit(1)).alias("_full"))
    zero = lambda c: F.coalesce(c, F.lit(0)).cast("bigint")
    return per_key.agg(
        zero(F.sum("_n")).alias("rows_before"),
        zero(F.sum("_full")).alias("rows_after_full"),
        F.count(F.lit(1)).alias("rows_after"),
    ).withColumn("rows_removed", F.col("rows_before") - F.col("rows_after"))
