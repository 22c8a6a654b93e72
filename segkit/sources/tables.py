"""Table loading (S1 parquet path, S2 fail-fast, Q1 column contract)."""

from __future__ import annotations

import os

from pyspark.sql import DataFrame, SparkSession
from pyspark.errors import AnalysisException

DRIVER_TABLES = ("region nation customer supplier part orders lineitem events documents "
                 "embeddings pages benchmark labels conversations").split()


class MissingInputError(FileNotFoundError):
    """The input path does not exist."""


class SchemaContractError(ValueError):
    """Q1: required columns are absent."""


def table_path(sf_dir: str, name: str) -> str:
    return os.path.join(sf_dir, f"{name}.parquet") if "://" not in sf_dir else f"{sf_dir.rstrip('/')}/{name}.parquet"


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """Read one driver table; a missing path raises ``MissingInputError``."""
    path = table_path(sf_dir, name)
    try:
        return spark.read.parquet(path)
    except AnalysisException as e:  # PATH_NOT_FOUND
        if "PATH_NOT_FOUND" in str(e) or "does not exist" in str(e):
            raise MissingInputError(f"input not found at '{path}'") from e
        raise


def require_columns(df: DataFrame, required) -> DataFrame:
    """Q1: metadata-only check, no Spark job."""
    missing = sorted(set(required) - set(df.columns))
    if missing:
        raise SchemaContractError(f"input is missing expected columns: {missing}")
    return df
