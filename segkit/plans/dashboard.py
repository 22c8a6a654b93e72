"""Dashboard queries over the labelled buyer table (S7 + the four panel groups).

The labelled table is loaded once and persisted (the dashboard's cache); a
selection (F3) is applied lazily and every panel is one Spark action over the
persisted, filtered table.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from segkit.functions.scalar import indicator, map_values, prefixed_label, threshold_flag
from segkit.operators import profile as P
from segkit.operators import slicing as SL

from segkit.fixed_values import (AGE_SCALE, HISTOGRAM_BINS, SAMPLE_ROWS, SCORE_SCALE, SCORE_THRESHOLD,
                                 TOP_N)


def radar_metrics() -> dict:
    """Five per-row expressions whose group means are the radar's 0-1 scores."""
    (a0, a1), (s0, s1) = AGE_SCALE, SCORE_SCALE
    return {
        "satisfaction": (F.col("satisfaction_score") - s0) / float(s1 - s0),
        "investment_focus": indicator("acquisition_purpose", "Investment"),
        "self_funded": 1 - indicator("loan_applied", "Yes"),
        "corporate_presence": indicator("client_type", "Corporate"),
        "seniority": (F.col("age") - a0) / float(a1 - a0),
    }


@dataclass
class Dashboard:
    table: DataFrame
    cluster: str = "kmeans_cluster"
    labels: dict = field(default_factory=dict)   # cohort label → display name

    @staticmethod
    def load(labelled: DataFrame, cluster: str = "kmeans_cluster", labels: dict | None = None) -> "Dashboard":
        """Add display columns (P4-P6) and cache the table for repeated panels (S7); ``release`` it afterwards."""
        dash = Dashboard(labelled, cluster, labels or {}).prepared()
        dash.table.persist()
        return dash

    def prepared(self) -> "Dashboard":
        """The table with its display columns."""
        return Dashboard(self.table.withColumns({
            "cluster_name": prefixed_label(self.cluster),
            "is_investor": indicator("acquisition_purpose", "Investment"),
            "has_loan": indicator("loan_applied", "Yes"),
            "is_corporate": indicator("client_type", "Corporate"),
            "cohort_display": map_values("cohort_label", self.labels, True),
        }), self.cluster, self.labels)

    def release(self) -> None:
        self.table.unpersist()

    def view(self, selection: dict | None = None) -> DataFrame:
        return SL.slice_rows(self.table, selection or {})

    def options(self, selection: dict | None = None) -> DataFrame:
        """The filter lists (dimension, value): country, purpose and client type, and the regions of the chosen countries."""
        regions = SL.cascade_options(self.table, "country", "region", (selection or {}).get("country"))
        return SL.filter_options(self.table, ["country", "acquisition_purpose", "client_type"]).unionByName(
            regions.select(F.lit("region").alias("dimension"), F.col("region").alias("value")).distinct())

    def empty(self, selection: dict | None = None) -> bool:
        """whether the selection has no rows (panels are not asked for then)."""
        return SL.is_empty(self.view(selection))

    def info(self, selection: dict | None = None) -> DataFrame:
        """(clusters, rows, empty): clusters of the whole table, rows of the selection."""
        clusters = self.table.agg(F.count_distinct("cluster_name")).scalar()
        return self.view(selection).agg(F.count(F.lit(1)).alias("rows")).select(
            clusters.alias("clusters"), "rows", (F.col("rows") == 0).alias("empty"))

    @staticmethod
    def model_info(spark, k: int, inertia: float) -> DataFrame:
        """k and inertia of the loaded model."""
        return spark.createDataFrame([(int(k), float(inertia))], "k int, inertia double")

    def share(self, selection: dict) -> DataFrame:
        return SL.slice_share(self.table, selection)

    # tab 1: overview
    def overview(self, selection: dict | None = None) -> dict[str, DataFrame]:
        v = self.view(selection)
        kpi = P.kpi_row(v, "cluster_name")
        return {"kpi": kpi.withColumn("score_band", threshold_flag("avg_score", SCORE_THRESHOLD)),
                "cluster_share": P.share_total(v, "cluster_name"),
                "cohort_counts": P.group_size(v, "cohort_display"),
                "purpose_by_segment": P.crosstab(v, "cluster_name", "acquisition_purpose")}

    # tab 2: investor behaviour
    def investors(self, selection: dict | None = None) -> dict[str, DataFrame]:
        v = self.view(selection)
        return {"loan_rate": P.indicator_rate(v, "cluster_name", "loan_applied", "Yes", alias="loan_rate_pct"),
                "satisfaction": P.segment_profile(v, "cluster_name").select("cluster_name", "avg_score"),
                "satisfaction_spread": P.five_number(v, "cluster_name", "satisfaction_score"),
                "age_spread": P.five_number(v, "cluster_name", "age"),
                "purpose_share": P.share_within(v, "cluster_name", "acquisition_purpose"),
                "channel_mix": P.crosstab(v, "cluster_name", "referral_channel"),
                "sample": P.fixed_sample(v.select("client_id", "age", "satisfaction_score", "cluster_name", "country", "acquisition_purpose"),
                                         "client_id", SAMPLE_ROWS)}

    # tab 3: geography
    def geography(self, selection: dict | None = None) -> dict[str, DataFrame]:
        v = self.view(selection)
        top = P.semi_join(v, P.top_values(v, "country", TOP_N).select("country"), on="country")
        return {"by_country": P.sort_groups(v, "country", descending=False),
                "hierarchy": P.hierarchy_rollup(v, "country", "region"),
                "heat": P.heat_topn(v, "country", "cluster_name", TOP_N),
                "purpose_top": P.crosstab(top, "country", "acquisition_purpose"),
                "type_share_top": P.share_within(top, "country", "client_type")}

    # tab 4: segment insights
    def insights(self, cohorts, selection: dict | None = None) -> dict[str, DataFrame]:
        v = self.view(selection)
        main = SL.slice_rows(v, {"cohort_label": list(cohorts)})
        ranked = P.segment_profile(v, "cohort_display").withColumn("place", F.row_number().over(Window.orderBy(F.desc("size"), "cohort_display")).cast("bigint"))
        return {"cohort_profile": ranked,   # one row a display name: the window is over a handful of rows
                "profile_top": P.profile_with_top(v, "cluster_name", "country").orderBy(F.desc("size"),
                                                                                          "cluster_name"),
                "cards": P.fixed_groups_stats(v, "cohort_label", list(cohorts)),
                "radar": P.radar_long(main, "cohort_label", radar_metrics()),
                "score_histogram": P.histogram(main, "cohort_label", "satisfaction_score", 0.5, 1.0,
                                               HISTOGRAM_BINS)}
