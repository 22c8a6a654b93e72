"""Schemas and helper names that hold whatever the columns of an input are called."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def extended(df: DataFrame, keep: list[str], **more: T.DataType) -> T.StructType:
    """The fields ``keep`` of ``df`` with new ones behind them, as a schema (names need no quoting)."""
    return T.StructType([df.schema[c] for c in keep] + [T.StructField(name, kind) for name, kind in more.items()])


def free_name(df: DataFrame, wanted: str) -> str:
    """``wanted``, with underscores before it until no column of ``df`` has that name (Spark compares without case)."""
    taken = {c.lower() for c in df.columns}
    while wanted.lower() in taken:
        wanted = "_" + wanted
    return wanted


def column(name: str) -> Column:
    """The column of exactly this name, dots and blanks included."""
    return F.col("`" + name.replace("`", "``") + "`")


def columns(names: list[str]) -> list[Column]:
    return [column(n) for n in names]


def numbered(df: DataFrame, keep: list[str], *others: str) -> tuple[DataFrame, list[str]]:
    """(columns ``keep`` under the names k0, k1, ... with ``others`` behind them, these names): mapInArrow takes no names with dots or quotes."""
    names = [f"k{i}" for i in range(len(keep))]
    return df.select(*[column(c).alias(n) for c, n in zip(keep, names)], *others), names


def plainly(df: DataFrame, *known: str) -> tuple[DataFrame, Callable[[DataFrame], DataFrame]]:
    """(``df`` with all columns but ``known`` named k0, k1, ..., what gives a frame the old columns and names again, others dropped)."""
    names = [c if c in known else f"k{i}" for i, c in enumerate(df.columns)]
    old = df.columns
    return df.toDF(*names), lambda out: out.select(*[F.col(n).alias(c) for n, c in zip(names, old)])


def free_prefix(df: DataFrame) -> str:
    """Underscores, more than any column of ``df`` begins with: no helper name with this prefix clashes.

    Where rows are told by a hash of all columns, helpers get such names; renaming the columns instead (``plainly``) would let the optimizer
    rewrite that hash in all combinations of old and new names.
    """
    return "_" * (1 + max((len(c) - len(c.lstrip("_")) for c in df.columns), default=0))
