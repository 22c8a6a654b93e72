"""A partial cube of mergeable states that answers every dashboard panel without a scan of the rows.

One pass over the labelled table keeps, per combination of the four filter dimensions:

* ``cells``: per set of panel columns (grouping sets: cluster; cluster and channel; cohort) the rows, and per measure its sum and
  its number of non-null values, from which all means, rates and shares follow;
* ``values``: per cluster or cohort, how often each age and each score occurs, from which exact quartiles and histograms follow;
* ``sample``: the rows with the smallest hashes, as many as the scatter panel shows, from which the sample of any selection follows.

All three are merged by adding up (or taking the smallest) over the cells that a selection keeps, so a panel reads cells, not rows.  Their
number depends on the dimensions' values only: with more rows the counts grow, not the cube (the sample: panel size times combinations).
The panels and their columns are those of ``Dashboard``, for any selection over ``DIMENSIONS``; a selection over another column raises.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from segkit.fixed_values import HISTOGRAM_BINS, SAMPLE_ROWS, SCORE_THRESHOLD, TOP_N
from segkit.functions.hashing import hash_rank_key
from segkit.functions.scalar import fixed_round, indicator, threshold_flag
from segkit.operators import profile as P
from segkit.operators import slicing as SL
from segkit.plans.dashboard import Dashboard, radar_metrics
from segkit.session import scratch_path

DIMENSIONS = ["country", "region", "acquisition_purpose", "client_type"]
SETS = {"cluster": ["cluster_name"], "channel": ["cluster_name", "referral_channel"], "cohort": ["cohort_label", "cohort_display"]}
PANEL_COLUMNS = ["cluster_name", "referral_channel", "cohort_label", "cohort_display"]
SPREADS = [("cluster", "cluster_name", "age"), ("cluster", "cluster_name", "satisfaction_score"), ("cohort", "cohort_label", "satisfaction_score")]
SAMPLE_COLUMNS = ["client_id", "age", "satisfaction_score", "cluster_name", "country", "acquisition_purpose"]
SAMPLE_BUCKETS = 64


def measures() -> dict[str, Column]:
    """Per-row numbers whose means the panels show."""
    flags = {"loan": ("loan_applied", "Yes"), "corporate": ("client_type", "Corporate"), "investment": ("acquisition_purpose", "Investment")}
    return {"age": F.col("age"), "score": F.col("satisfaction_score"), **{m: indicator(*f) for m, f in flags.items()},
            **{f"radar_{m}": e for m, e in radar_metrics().items()}}


def mean(measure: str) -> Column:
    return F.try_divide(F.sum(f"sum_{measure}"), F.sum(f"count_{measure}"))


def cells_of(table: DataFrame) -> DataFrame:
    """(set, dimensions, panel columns, n, sum_<m>, count_<m>): one scan, combined in every task before the shuffle."""
    keys = [*DIMENSIONS, *PANEL_COLUMNS]
    states = [s for m in measures() for s in (F.sum(F.col(f"_{m}").cast("double")).alias(f"sum_{m}"), F.count(f"_{m}").alias(f"count_{m}"))]
    rows = table.select(*keys, *[e.alias(f"_{m}") for m, e in measures().items()])
    out = rows.groupingSets([[F.col(c) for c in [*DIMENSIONS, *own]] for own in SETS.values()], *keys).agg(
        F.grouping_id().alias("_id"), F.count(F.lit(1)).alias("n"), *states)
    number = {name: int("".join("0" if c in DIMENSIONS or c in own else "1" for c in keys), 2) for name, own in SETS.items()}
    named = F.when(F.lit(False), "")
    for name, i in number.items():
        named = named.when(F.col("_id") == i, name)
    return out.withColumn("set", named).drop("_id")


def values_of(table: DataFrame) -> DataFrame:
    """(dimensions, kind, group, column, value, n)."""
    kinds = F.explode(F.array(*[F.struct(F.lit(k).alias("kind"), F.col(g).cast("string").alias("group"), F.lit(x).alias("column"), F.col(x).cast("double").alias("value"))
                                for k, g, x in SPREADS]))
    return (table.select(*DIMENSIONS, kinds.alias("v")).groupBy(*DIMENSIONS, "v.kind", "v.group", "v.column", "v.value")
            .agg(F.count(F.lit(1)).alias("n")))


def sample_of(table: DataFrame, n: int) -> DataFrame:
    """Per combination of the dimensions the ``n`` rows with the smallest hashes, taken per hash bucket first."""
    columns = list(dict.fromkeys([*SAMPLE_COLUMNS, *DIMENSIONS]))
    rows = table.select(*columns, hash_rank_key("sample", "client_id").alias("_h"))
    first = Window.partitionBy(*DIMENSIONS, "_b").orderBy("_h", "client_id")
    best = Window.partitionBy(*DIMENSIONS).orderBy("_h", "client_id")
    some = (rows.withColumn("_b", F.pmod(F.xxhash64("_h"), F.lit(SAMPLE_BUCKETS))).withColumn("_r", F.row_number().over(first)).where(F.col("_r") <= n))
    return some.withColumn("_r", F.row_number().over(best)).where(F.col("_r") <= n).select(*columns)


@dataclass
class DashboardCube:
    cells: DataFrame
    values: DataFrame
    sample: DataFrame

    @staticmethod
    def build(dash: Dashboard, path: str | None = None, sample: int = SAMPLE_ROWS) -> "DashboardCube":
        """Computes the three parts from the dashboard's table, writes them to ``path`` (shared storage) and reads them from there."""
        spark = dash.table.sparkSession
        path = path or scratch_path(spark, "cube")
        for name, part in {"cells": cells_of(dash.table), "values": values_of(dash.table), "sample": sample_of(dash.table, sample)}.items():
            part.write.mode("overwrite").parquet(f"{path}/{name}")
        return DashboardCube.open(spark, path)

    @staticmethod
    def open(spark, path: str) -> "DashboardCube":
        return DashboardCube(*[spark.read.parquet(f"{path}/{name}") for name in ("cells", "values", "sample")])

    def merged(self, other: "DashboardCube") -> "DashboardCube":
        """The cube of both tables' rows: states are added up when a panel is asked for, so the parts are put side by side."""
        return DashboardCube(*[getattr(self, name).unionByName(getattr(other, name)) for name in ("cells", "values", "sample")])

    def _sliced(self, part: DataFrame, selection: dict | None) -> DataFrame:
        beyond = set(selection or {}) - set(DIMENSIONS)
        if beyond:
            raise ValueError(f"the cube has no dimension {sorted(beyond)}")
        return SL.slice_rows(part, selection or {})

    def _cells(self, name: str, selection: dict | None) -> DataFrame:
        return self._sliced(self.cells.where(F.col("set") == name), selection)

    def _values(self, kind: str, column: str, group: str, selection: dict | None) -> DataFrame:
        """(group, column, n) under the panel's own names."""
        kept = self._sliced(self.values.where((F.col("kind") == kind) & (F.col("column") == column)), selection)
        return kept.select(F.col("group").alias(group), F.col("value").alias(column), "n")

    @staticmethod
    def _profile(cells: DataFrame, group: str) -> DataFrame:
        rates = {"corporate_pct": "corporate", "investment_pct": "investment", "loan_pct": "loan"}
        return cells.where(F.col(group).isNotNull()).groupBy(group).agg(
            F.sum("n").alias("size"), fixed_round(mean("age"), 1).alias("avg_age"), fixed_round(mean("score"), 2).alias("avg_score"),
            *[fixed_round(mean(m) * 100, 1).alias(name) for name, m in rates.items()])

    def empty(self, selection: dict | None = None) -> bool:
        return SL.is_empty(self._cells("cohort", selection))

    def share(self, selection: dict) -> DataFrame:
        """selected rows, all rows, selected %."""
        cells = self.cells.where("set = 'cohort'")
        hit = SL.predicate(selection)
        n = F.col("n") if hit is None else F.when(hit, F.col("n")).otherwise(F.lit(0))
        out = cells.agg(F.coalesce(F.sum(n), F.lit(0)).cast("bigint").alias("selected"), F.coalesce(F.sum("n"), F.lit(0)).cast("bigint").alias("total"))
        return out.withColumn("selected_pct", fixed_round(F.try_divide(F.col("selected") * 100.0, F.col("total")), 1))

    def overview(self, selection: dict | None = None) -> dict[str, DataFrame]:
        by_cluster, by_cohort = self._cells("cluster", selection), self._cells("cohort", selection)
        per = by_cluster.groupBy("cluster_name").agg(F.sum("n").alias(P.N), F.sum("sum_score").alias("_s"), F.sum("sum_loan").alias("_f"))
        return {"kpi": P.kpi_of(per, "cluster_name").withColumn("score_band", threshold_flag("avg_score", SCORE_THRESHOLD)),
                "cluster_share": P.share_total(by_cluster, "cluster_name", weight="n"),
                "cohort_counts": P.group_size(by_cohort, "cohort_display", weight="n"),
                "purpose_by_segment": P.crosstab(by_cluster, "cluster_name", "acquisition_purpose", weight="n")}

    def investors(self, selection: dict | None = None, sample: int = SAMPLE_ROWS) -> dict[str, DataFrame]:
        cells = self._cells("cluster", selection)
        named = cells.where("cluster_name is not null")
        spread = lambda x: P.five_number(self._values("cluster", x, "cluster_name", selection), "cluster_name", x, weight="n")
        return {"loan_rate": named.groupBy("cluster_name").agg(fixed_round(mean("loan") * 100, 1).alias("loan_rate_pct")),
                "satisfaction": self._profile(cells, "cluster_name").select("cluster_name", "avg_score"),
                "satisfaction_spread": spread("satisfaction_score"),
                "age_spread": spread("age"),
                "purpose_share": P.share_within(cells, "cluster_name", "acquisition_purpose", weight="n"),
                "channel_mix": P.crosstab(self._cells("channel", selection), "cluster_name", "referral_channel", weight="n"),
                "sample": P.fixed_sample(self._sliced(self.sample, selection).select(*SAMPLE_COLUMNS), "client_id", sample)}

    def geography(self, selection: dict | None = None) -> dict[str, DataFrame]:
        cells = self._cells("cluster", selection)
        top = P.semi_join(cells, P.top_values(cells, "country", TOP_N, weight="n").select("country"), on="country")
        return {"by_country": P.sort_groups(cells, "country", descending=False, weight="n"),
                "hierarchy": P.hierarchy_rollup(cells, "country", "region", weight="n"),
                "heat": P.heat_topn(cells, "country", "cluster_name", TOP_N, weight="n"),
                "purpose_top": P.crosstab(top, "country", "acquisition_purpose", weight="n"),
                "type_share_top": P.share_within(top, "country", "client_type", weight="n")}

    def insights(self, cohorts, selection: dict | None = None) -> dict[str, DataFrame]:
        by_cohort, by_cluster = self._cells("cohort", selection), self._cells("cluster", selection)
        main = by_cohort.where(F.col("cohort_label").isin(list(cohorts)))
        place = F.row_number().over(Window.orderBy(F.desc("size"), "cohort_display")).cast("bigint")   # one row a display name
        top = P.group_mode(by_cluster, "cluster_name", "country", weight="n").drop("top_country_n")
        stats = main.groupBy("cohort_label").agg(F.sum("n").alias("n"), fixed_round(mean("score"), 2).alias("avg_score"), fixed_round(mean("investment") * 100, 1).alias("flag_pct"))
        names = by_cohort.sparkSession.createDataFrame([(c,) for c in cohorts], "cohort_label string")
        radar = main.groupBy("cohort_label").agg(*[fixed_round(mean(f"radar_{m}"), 4).alias(m) for m in radar_metrics()])
        scores = self._values("cohort", "satisfaction_score", "cohort_label", selection).where(F.col("cohort_label").isin(list(cohorts)))
        return {"cohort_profile": self._profile(by_cohort, "cohort_display").withColumn("place", place),
                "profile_top": self._profile(by_cluster, "cluster_name").join(top, on="cluster_name", how="left").orderBy(F.desc("size"), "cluster_name"),
                "cards": names.join(stats, on="cohort_label", how="left").select(
                    "cohort_label", F.coalesce("n", F.lit(0)).cast("bigint").alias("n"), F.coalesce("avg_score", F.lit(0.0)).alias("avg_score"),
                    F.coalesce("flag_pct", F.lit(0.0)).alias("flag_pct")),
                "radar": radar.unpivot(["cohort_label"], list(radar_metrics()), "metric", "value"),
                "score_histogram": P.histogram(scores, "cohort_label", "satisfaction_score", 0.5, 1.0, HISTOGRAM_BINS, weight="n")}
