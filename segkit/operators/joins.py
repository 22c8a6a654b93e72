"""Joins (J1-J3, J5, J6).  Spark picks broadcast or shuffle by the side's measured size (autoBroadcastJoinThreshold, AQE)."""

from __future__ import annotations

from pyspark.sql import DataFrame


def lookup_join(df: DataFrame, dim: DataFrame, on, how: str = "left") -> DataFrame:
    """Join a dimension table."""
    return df.join(dim, on=on, how=how)


def semi_join(df: DataFrame, keys: DataFrame, on) -> DataFrame:
    """Rows of ``df`` whose key appears in ``keys``."""
    return df.join(keys, on=on, how="left_semi")


def anti_join(df: DataFrame, keys: DataFrame, on) -> DataFrame:
    """Rows of ``df`` whose key does not appear in ``keys``."""
    return df.join(keys, on=on, how="left_anti")


def values_frame(spark, column: str, values, dtype: str = "string") -> DataFrame:
    """A one-column DataFrame of literal values (an allowed set, a label list)."""
    return spark.createDataFrame([(v,) for v in values], f"{column} {dtype}")
