"""Cleaning stage: key dedup → imputation → age.

The truth label stays in the row (it is excluded from the dedup comparison and
carried), so no positional re-alignment is ever needed.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from segkit.functions.scalar import safe_date, whole_years
from segkit.operators.dedup import dedup_two_pass
from segkit.operators.impute import ConditionalMode, ImputeModel, Rule, fit_imputer, refuse_nulls
from segkit.sources.tables import require_columns

from segkit.fixed_values import (DEDUP_KEYS, GENDER_MODE_TYPE, GENDER_RULE_TYPE, GENDER_RULE_VALUE,
                                 MODE_COLUMNS, REQUIRED_COLUMNS as REQUIRED)

LABEL = "cohort_label"


def buyer_imputer_spec():
    return dict(rules=[Rule("gender", f"client_type = '{GENDER_RULE_TYPE}'", GENDER_RULE_VALUE)],
                conditional=[ConditionalMode("gender", f"client_type = '{GENDER_MODE_TYPE}'")],
                mode_columns=MODE_COLUMNS)


@dataclass
class CleanResult:
    df: DataFrame
    imputer: ImputeModel


def dedup_buyers(raw: DataFrame, order_by: str = "seq") -> DataFrame:
    """The first row of each key in input order, with its own label; the order column goes."""
    require_columns(raw, [*REQUIRED, order_by])
    return dedup_two_pass(raw, DEDUP_KEYS, exclude=[LABEL], order_by=order_by).drop(order_by)


def add_age(df: DataFrame, dob: str = "date_of_birth") -> DataFrame:
    """P8 + P9, then drop the date column; what is no date stops the job."""
    bad = F.concat(F.lit(f"{dob} is not a date: "), F.coalesce(F.col(dob).cast("string"), F.lit("null")))
    return df.withColumn("age", whole_years(safe_date(dob), strict=bad)).drop(dob)


def clean_buyers(raw: DataFrame, imputer: ImputeModel | None = None, order_by: str = "seq",
                 deduped: DataFrame | None = None) -> CleanResult:
    """Full cleaning; pass a fitted ``imputer`` to apply it to new data unchanged.

    ``deduped`` may be a persisted result of ``dedup_buyers(raw)`` so that the
    fit and the later passes do not recompute the dedup shuffles.
    """
    deduped = deduped if deduped is not None else dedup_buyers(raw, order_by)
    model = imputer or fit_imputer(deduped, **buyer_imputer_spec())
    # the transform is a projection of the deduplicated rows, so their number can't change (Q5); nulls that are left stop the job (Q4)
    return CleanResult(add_age(refuse_nulls(model.transform(deduped), REQUIRED)), model)


def imputer_fill_dict(model: ImputeModel) -> dict:
    """The fitted imputer as plain values (for persistence and the streaming scorer); conditions are SQL texts."""
    return model.to_dict()
