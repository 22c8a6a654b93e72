"""Filters and the conjunctive slicer.

A slice is one ``where`` with all predicates ANDed, so Catalyst pushes it into
the parquet scan as a single filter.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

ALL = "All"


def multi_value(col: str, values) -> Column | None:
    """``col IN values``; an empty selection means no filter."""
    values = [v for v in (values or [])]
    return F.col(col).isin(values) if values else None


def single_value(col: str, value) -> Column | None:
    """``col = value``; ``"All"`` or None means no filter."""
    return None if value is None or value == ALL else (F.col(col) == F.lit(value))


def predicate(selection: dict) -> Column | None:
    """AND of F1/F2 over every dimension of ``selection``."""
    preds = []
    for col, sel in selection.items():
        p = multi_value(col, sel) if isinstance(sel, (list, tuple, set)) else single_value(col, sel)
        if p is not None:
            preds.append(p)
    return reduce(lambda a, b: a & b, preds) if preds else None


def slice_rows(df: DataFrame, selection: dict) -> DataFrame:
    """apply the whole selection as one filter."""
    p = predicate(selection)
    return df if p is None else df.where(p)


def null_and_equal(col: str, other: str, value) -> Column:
    """``col IS NULL AND other = value``."""
    return F.col(col).isNull() & (F.col(other) == F.lit(value))


def slice_share(df: DataFrame, selection: dict) -> DataFrame:
    """selected rows, all rows, selected % (null when the input is empty); one pass."""
    p = predicate(selection)
    hit = F.lit(1) if p is None else F.when(p, F.lit(1)).otherwise(F.lit(0))
    agg = df.agg(F.coalesce(F.sum(hit), F.lit(0)).cast("bigint").alias("selected"),
                 F.count(F.lit(1)).alias("total"))
    from segkit.functions.scalar import fixed_round
    return agg.withColumn("selected_pct", fixed_round(F.try_divide(F.col("selected") * 100.0, F.col("total")), 1))


def filter_options(df: DataFrame, dims) -> DataFrame:
    """sorted distinct non-null values of each dimension, long form (dimension, value)."""
    long = (df.select(*[F.col(c).cast("string").alias(c) for c in dims])
              .unpivot([], list(dims), "dimension", "value")
              .where(F.col("value").isNotNull()).distinct())
    return long.orderBy("dimension", "value")


def cascade_options(df: DataFrame, parent: str, child: str, chosen_parents) -> DataFrame:
    """child values limited to chosen parents (no choice → all children)."""
    src = slice_rows(df, {parent: list(chosen_parents or [])})
    return (src.where(F.col(child).isNotNull()).select(parent, child).distinct().orderBy(parent, child))


def is_empty(df: DataFrame) -> bool:
    """empty-result guard (reads at most one row)."""
    return df.isEmpty()
