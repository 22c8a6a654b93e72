"""Imputation (I1-I4) as a fit/transform pair.

``fit`` is one Spark job: every target expression is unpivoted to
(name, value), counted per value with partial aggregation, and reduced to the
most frequent value per name (ties go to the smallest value).  Only that
bounded table (one row per target) reaches the driver.  ``transform`` is a
single projection that stays inside whole-stage codegen.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def modes_and_nulls(df: DataFrame, targets: dict[str, Column]) -> DataFrame:
    """Per named expression: mode among non-null values, and the null count.

    Returns ``(name, mode, n_mode, n_null)``; ``mode`` is a string.
    """
    named = df.select(*[e.cast("string").alias(n) for n, e in targets.items()])
    long = named.unpivot([], list(targets), "name", "value")
    counts = long.groupBy("name", "value").agg(F.count(F.lit(1)).alias("n"))
    return counts.groupBy("name").agg(
        F.min_by(F.col("value"),
                 F.when(F.col("value").isNotNull(), F.struct(-F.col("n"), F.col("value"))))
         .alias("mode"),
        F.max(F.when(F.col("value").isNotNull(), F.col("n"))).alias("n_mode"),
        F.coalesce(F.sum(F.when(F.col("value").isNull(), F.col("n"))), F.lit(0)).cast("bigint")
         .alias("n_null"),
    )


def column_modes(df: DataFrame, columns) -> dict:
    """Most frequent non-null value of each column (ties: smallest), one job."""
    rows = modes_and_nulls(df, {c: F.col(c) for c in columns}).collect()
    return {r["name"]: r["mode"] for r in rows}


@dataclass
class Rule:
    """``target`` null and ``when`` true → ``value``."""
    target: str
    when: Column
    value: object


@dataclass
class ConditionalMode:
    """``target`` null and ``when`` true → mode of ``target`` among rows where ``when``."""
    target: str
    when: Column
    name: str = ""


@dataclass
class ImputeModel:
    rules: list
    conditional: list            # (target, when, value)
    global_fills: dict           # column -> value
    report: list = field(default_factory=list)  # (column, nulls, method, value)

    def to_dict(self) -> dict:
        """Plain values; every condition must be given as SQL text."""
        rules = [(r.target, r.when, r.value) for r in self.rules] + [(t, w, v) for t, w, v in self.conditional if v is not None]
        if not all(isinstance(w, str) for _, w, _ in rules):
            raise ValueError("conditions must be SQL texts to be saved")
        return {"rules": [list(r) for r in rules], "fills": dict(self.global_fills)}

    @staticmethod
    def from_dict(d: dict) -> "ImputeModel":
        return ImputeModel([Rule(*r) for r in d.get("rules", [])], [], dict(d.get("fills", {})))

    def transform(self, df: DataFrame) -> DataFrame:
        exprs = {}
        for col in {r.target for r in self.rules} | {t for t, _, _ in self.conditional}:
            e = None
            for r in [r for r in self.rules if r.target == col]:
                cond = F.col(col).isNull() & condition(r.when)
                e = F.when(cond, F.lit(r.value)) if e is None else e.when(cond, F.lit(r.value))
            for t, w, v in [c for c in self.conditional if c[0] == col]:
                if v is None:
                    continue
                cond = F.col(col).isNull() & condition(w)
                e = F.when(cond, F.lit(v)) if e is None else e.when(cond, F.lit(v))
            exprs[col] = F.col(col) if e is None else e.otherwise(F.col(col))
        for col, v in self.global_fills.items():
            if v is not None:
                base = exprs.get(col, F.col(col))
                exprs[col] = F.coalesce(base, F.lit(v).cast(df.schema[col].dataType))
        return df.withColumns(exprs) if exprs else df

    def report_frame(self, spark) -> DataFrame:
        return spark.createDataFrame(
            [(c, int(n), m, None if v is None else str(v)) for c, n, m, v in self.report],
            "column string, nulls bigint, method string, value string")


def condition(when: Column | str) -> Column:
    return F.expr(when) if isinstance(when, str) else when


def fit_imputer(df: DataFrame, rules=(), conditional=(), mode_columns=()) -> ImputeModel:
    """I4: learn every fill value in one aggregate job."""
    targets = {}
    for i, c in enumerate(conditional):
        targets[f"cond{i}:{c.target}"] = F.when(condition(c.when), F.col(c.target))
    for c in mode_columns:
        targets[f"mode:{c}"] = F.col(c)
    for c in {r.target for r in rules} | {c.target for c in conditional}:
        targets.setdefault(f"nulls:{c}", F.col(c))
    stats = {r["name"]: r for r in modes_and_nulls(df, targets).collect()} if targets else {}
    cond_fills = []
    report = []
    for i, c in enumerate(conditional):
        cond_fills.append((c.target, c.when, stats[f"cond{i}:{c.target}"]["mode"]))
    for c in {r.target for r in rules} | {c.target for c in conditional}:
        report.append((c, stats[f"nulls:{c}"]["n_null"], "rule+conditional mode", None))
    fills = {}
    for c in mode_columns:
        s = stats[f"mode:{c}"]
        fills[c] = s["mode"]
        report.append((c, s["n_null"], "mode", s["mode"]))
    return ImputeModel(list(rules), cond_fills, fills, report)


def residual_nulls(df: DataFrame, columns=None) -> DataFrame:
    """Q4 helper: null count for every column (zero rows mean nothing is left)."""
    from segkit.operators.quality import null_counts
    return null_counts(df, columns)


def assert_no_nulls(df: DataFrame, columns=None) -> None:
    """Q4: raise with the offending columns."""
    bad = [(r["column"], r["nulls"]) for r in residual_nulls(df, columns).collect() if r["nulls"] > 0]
    if bad:
        raise AssertionError(f"unexpected residual nulls after imputation: {bad}")


def refuse_nulls(df: DataFrame, columns) -> DataFrame:
    """Q4 inside the plan: a null in one of the columns stops the job that reads it, with the column's name."""
    return df.withColumns({c: F.coalesce(F.col(c), F.raise_error(F.lit(f"{c} is null after imputation")).cast(t))
                           for c, t in df.dtypes if c in set(columns)})
