"""Deterministic per-row assignments for building fixture tables.

Randomness comes from hash-of-key draws (``segkit.functions.hashing``): the
result of every operator is a pure function of (salt, key), so it is the same on
any partitioning and reproducible in SQL.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from segkit.functions.hashing import bucket, h32, uniform, _col

bucket_int = bucket


def weighted_choice(salt: str, key: Column | str, values, weights) -> Column:
    """Pick ``values[i]`` with probability ``weights[i]`` (cumulative thresholds)."""
    total = float(sum(weights))
    u = uniform(salt, key)
    expr = None
    acc = 0.0
    for v, w in list(zip(values, weights))[:-1]:
        acc += w / total
        expr = (F.when(u < F.lit(acc), F.lit(v)) if expr is None
                else expr.when(u < F.lit(acc), F.lit(v)))
    last = F.lit(values[-1])
    return last if expr is None else expr.otherwise(last)


def uniform_choice(salt: str, key: Column | str, values) -> Column:
    """Y2: each value equally likely."""
    arr = F.array(*[F.lit(v) for v in values])
    return F.element_at(arr, (bucket(salt, key, len(values)) + 1).cast("int"))


def bernoulli(salt: str, key: Column | str, p: Column | float) -> Column:
    """True with probability p (p may be a per-row column, Y3)."""
    return uniform(salt, key) < (p if isinstance(p, Column) else F.lit(p))


def child_of(parent: Column | str, salt: str, key: Column | str, n_children: int,
             sep: str = "/") -> Column:
    """A child value drawn from the parent's list ``parent/0 .. parent/(n-1)``."""
    return F.concat(_col(parent), F.lit(sep), bucket(salt, key, n_children).cast("string"))


def date_in_window(salt: str, key: Column | str, start: str, span_days: Column | int,
                   offset_days: Column | int = 0) -> Column:
    """``start + offset + h mod (span)``: a date uniform over a window, inclusive."""
    span = span_days if isinstance(span_days, Column) else F.lit(span_days)
    off = offset_days if isinstance(offset_days, Column) else F.lit(offset_days)
    n = (off + F.pmod(h32(salt, key), span)).cast("int")
    return F.date_add(F.lit(start).cast("date"), n)


def mask_nulls(df: DataFrame, columns, key: Column | str, rate: float = 0.05,
               salts: dict | None = None) -> DataFrame:
    """Null out each listed column independently at ``rate``."""
    salts = salts or {}
    return df.withColumns({
        c: F.when(uniform(salts.get(c, f"null:{c}"), key) < F.lit(rate), F.lit(None))
            .otherwise(F.col(c))
        for c in columns})


def append_copies(df: DataFrame, flag: Column) -> DataFrame:
    """Append an exact copy of every row where ``flag`` holds (bag union, U4)."""
    return df.unionByName(df.where(flag))
