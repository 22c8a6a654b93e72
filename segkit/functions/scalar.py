"""Scalar expressions (P4-P15): all built-in functions, so they stay in codegen."""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import Column
from pyspark.sql import functions as F

from segkit.fixed_values import DAYS_PER_YEAR, REFERENCE_DATE
from segkit.functions.hashing import _col


def indicator(c: Column | str, value) -> Column:
    """1 when ``c == value``, else 0 (null counts as 0)."""
    return F.coalesce((_col(c) == F.lit(value)).cast("int"), F.lit(0))


def prefixed_label(c: Column | str, prefix: str = "Segment ") -> Column:
    """P5: ``'Segment 3'`` from an integer label."""
    return F.concat(F.lit(prefix), _col(c).cast("string"))


def map_values(c: Column | str, mapping: dict, fallback_to_input: bool = True) -> Column:
    """Dictionary lookup on a literal map; miss keeps input or gives null."""
    if not mapping:
        return _col(c) if fallback_to_input else F.lit(None).cast("string")
    pairs = []
    for k, v in mapping.items():
        pairs += [F.lit(k), F.lit(v)]
    looked = F.try_element_at(F.create_map(*pairs), _col(c))
    return F.coalesce(looked, _col(c)) if fallback_to_input else looked


def safe_date(c: Column | str) -> Column:
    """Lenient ``yyyy-MM-dd`` parse, bad text gives null (ANSI-safe)."""
    return F.try_to_date(_col(c).cast("string"), "yyyy-MM-dd")


def whole_years(d: Column | str, reference: str = REFERENCE_DATE,
                days_per_year: float = DAYS_PER_YEAR, strict: Column | str | None = None) -> Column:
    """Whole years between a date and the reference date, truncated toward 0.

    ``strict`` names what to report: a null date then stops the job with this text.
    """
    days = F.datediff(F.lit(reference).cast("date"), _col(d))
    years = (days / F.lit(days_per_year)).cast("int")
    return years if strict is None else F.coalesce(years, F.raise_error(strict if isinstance(strict, Column) else F.lit(strict)).cast("int"))


def formatted_key(prefix: str, n: Column | str, width: int = 5) -> Column:
    """P10: ``PREFIX_00042``."""
    return F.format_string(f"%s_%0{width}d", F.lit(prefix), _col(n).cast("bigint"))


def iso_date(d: Column | str) -> Column:
    """P11."""
    return F.date_format(_col(d), "yyyy-MM-dd")


def shift_days(d: Column | str, n: Column | int) -> Column:
    """Date plus n days (negative n subtracts)."""
    return F.date_add(_col(d), n if isinstance(n, Column) else F.lit(n))


def fixed_round(c: Column | str, digits: int) -> Column:
    """Half-even decimal rounding as a DOUBLE.

    The value is first fixed to 6 decimals, so the result does not depend on the last bits of a floating sum (summation order
    differs between partitions and engines).  Values up to 10^32 fit.
    """
    return F.bround(_col(c).cast("decimal(38,6)"), digits).cast("double")


def min_max_scaled(c: Column | str, lo: float, hi: float) -> Column:
    """``(x - lo) / (hi - lo)``."""
    return (_col(c) - F.lit(lo)) / F.lit(hi - lo)


def threshold_flag(c: Column | str, threshold: float = 3.5,
                   above: str = "above", below: str = "below") -> Column:
    """Label against a threshold (strictly greater is 'above')."""
    return F.when(_col(c) > F.lit(threshold), F.lit(above)).otherwise(F.lit(below))


def date_literal(s: str) -> Column:
    return F.lit(_dt.date.fromisoformat(s))
