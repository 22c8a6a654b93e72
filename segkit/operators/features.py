"""Feature encoding (E1-E7): population-σ scaling + one-hot with binary drop.

``fit`` runs two small aggregate jobs (numeric moments; sorted category lists,
bounded by ``max_categories``).  ``transform`` is one projection that builds a
dense ``array<double>`` column from built-in expressions, so it stays in
whole-stage codegen; ``to_vector`` turns it into an ML vector when needed.

Semantics:
- numeric: ``(x - mean) / std_pop``; a zero deviation divides by 1;
- categorical, categories sorted ascending, one output per category;
- a column with exactly two categories gives one output for the second category
  (the first is dropped);
- an unseen or null category encodes as all zeros.
"""

from __future__ import annotations

import json
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


@dataclass
class FeatureModel:
    numeric: list
    categorical: list
    means: dict
    scales: dict
    categories: dict
    names: list = field(default_factory=list)

    def __post_init__(self):
        if not self.names:
            self.names = list(self.numeric) + [n for _, _, n in self.onehot_slots()]

    def onehot_slots(self):
        """(column, category, feature name) in matrix order."""
        slots = []
        for c in self.categorical:
            cats = self.categories[c]
            kept = cats[1:] if len(cats) == 2 else cats
            slots += [(c, v, f"{c}_{v}") for v in kept]
        return slots

    @property
    def width(self) -> int:
        return len(self.names)

    def numeric_exprs(self) -> list:
        return [((F.col(c).cast("double") - F.lit(self.means[c])) / F.lit(self.scales[c])) for c in self.numeric]

    def onehot_exprs(self) -> list:
        return [F.when(F.col(c) == F.lit(v), F.lit(1.0)).otherwise(F.lit(0.0)) for c, v, _ in self.onehot_slots()]

    def feature_array(self) -> Column:
        return F.array(*self.numeric_exprs(), *self.onehot_exprs())

    def transform(self, df: DataFrame, output: str = "features") -> DataFrame:
        return df.withColumn(output, self.feature_array())

    def wide(self, df: DataFrame, keep=()) -> DataFrame:
        """One column per feature (names as in ``names``)."""
        exprs = self.numeric_exprs() + self.onehot_exprs()
        return df.select(*keep, *[e.alias(n) for e, n in zip(exprs, self.names)])

    def long(self, df: DataFrame, keep=()) -> DataFrame:
        """E1 in sparse form: one row (feature, value 1) per set indicator, from one array of (column, value) pairs per row.

        A value that the model has not seen gives no row.
        """
        pairs = F.explode(F.array(*[F.struct(F.lit(c).alias("c"), F.col(c).cast("string").alias("v")) for c in self.categorical]))
        known = df.sparkSession.createDataFrame([(c, v, n) for c, v, n in self.onehot_slots()], "_c string, _v string, feature string")
        rows = df.select(*keep, pairs.alias("_p"))
        return (rows.join(known, (F.col("_p.c") == F.col("_c")) & (F.col("_p.v") == F.col("_v")))
                .select(*keep, "feature", F.lit(1.0).alias("value")))

    def inventory(self, spark) -> DataFrame:
        """(column, n_categories, n_outputs) per encoded column."""
        rows = [(c, 0, 1) for c in self.numeric]
        rows += [(c, len(self.categories[c]), 1 if len(self.categories[c]) == 2 else len(self.categories[c]))
                 for c in self.categorical]
        return spark.createDataFrame(rows, "column string, n_categories bigint, n_outputs bigint")

    def to_json(self) -> str:
        return json.dumps(dict(numeric=self.numeric, categorical=self.categorical, means=self.means,
                               scales=self.scales, categories=self.categories, names=self.names))

    @staticmethod
    def from_json(s: str) -> "FeatureModel":
        return FeatureModel(**json.loads(s))


def fit_features(df: DataFrame, numeric, categorical, max_categories: int | None = None) -> FeatureModel:
    """Learn means/σ (population) and sorted category lists."""
    from concurrent.futures import ThreadPoolExecutor

    numeric, categorical = list(numeric), list(categorical)
    means, scales = {}, {}
    pool = ThreadPoolExecutor(max_workers=2)  # the two fit jobs are independent: run them concurrently
    moments = pool.submit(lambda: df.agg(
        *[F.avg(F.col(c).cast("double")).alias(f"m_{c}") for c in numeric],
        *[F.stddev_pop(F.col(c).cast("double")).alias(f"s_{c}") for c in numeric]).first()) if numeric else None
    categories = {c: [] for c in categorical}
    if categorical:
        long = (df.select(*[F.col(c).cast("string").alias(c) for c in categorical])
                  .unpivot([], categorical, "column", "value")
                  .where(F.col("value").isNotNull()).distinct())
        if max_categories is not None:  # a caller's guard: only so many reach the driver
            long = long.limit(max_categories * len(categorical) + 1)
        for r in long.orderBy("column", "value").collect():  # one row a category: they become the vectors' columns
            categories[r["column"]].append(r["value"])
        for c, vals in categories.items():
            if max_categories is not None and len(vals) > max_categories:
                pool.shutdown()
                raise ValueError(f"{c} has more than {max_categories} categories")
    if numeric:
        row = moments.result()
        for c in numeric:
            means[c] = float(row[f"m_{c}"])
            s = row[f"s_{c}"]
            scales[c] = float(s) if s not in (None, 0.0) and s > 0.0 else 1.0
    pool.shutdown()
    return FeatureModel(numeric, categorical, means, scales, categories)


def to_vector(df: DataFrame, array_col: str = "features", output: str = "features_vec") -> DataFrame:
    """Dense ML vector from the array column (for pyspark.ml estimators)."""
    from pyspark.ml.functions import array_to_vector
    return df.withColumn(output, array_to_vector(F.col(array_col)))


def squared_norm(array_col: str = "features") -> Column:
    return F.aggregate(F.col(array_col), F.lit(0.0), lambda acc, x: acc + x * x)
