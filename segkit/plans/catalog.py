"""Query catalogue: one entry per operator, each with its DuckDB oracle SQL.

Every query reads the driver tables (or the buyer tables Spark derives from
them) in full, so its work grows with the data.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from segkit.functions import scalar as S
from segkit.operators import assign, dedup, profile as P, quality as Q, slicing as SL
from segkit.operators.impute import fit_imputer, ConditionalMode, Rule
from segkit.operators.joins import lookup_join
from segkit.plans import oracle_sql as O
from segkit.plans.clean import DEDUP_KEYS, LABEL, MODE_COLUMNS, clean_buyers, dedup_buyers
from segkit.sources import csv_io
from segkit.sources.fixtures import BUYER_COLUMNS, buyers_ordered, buyers_raw
from segkit.sources.tables import read_table
from segkit.session import scratch_path

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    def deco(fn):
        QUERIES[name] = fn
        if sql is not None:
            ORACLE[name] = sql
        return fn
    return deco


def T(spark, sf, name):
    return read_table(spark, sf, name)


def B(spark, sf) -> DataFrame:
    """Cleaned buyers (dedup → impute → age)."""
    return clean_buyers(buyers_ordered(spark, sf)).df


# Fixed display labels used by the lookup queries (three of five segments are mapped).
SEGMENT_DISPLAY = {"AUTOMOBILE": "Auto Buyers", "BUILDING": "Builders", "HOUSEHOLD": "Home Makers"}


def _map_sql(col: str, mapping: dict, fallback: bool) -> str:
    arms = " ".join(f"WHEN '{k}' THEN '{v}'" for k, v in mapping.items())
    return f"CASE {col} {arms} ELSE {col if fallback else 'NULL'} END"


# ───────────────────────── sources / sinks (S1, S3) ─────────────────────────

@query("csv_roundtrip", O.with_raw(f"SELECT {O.RAW_COLS} FROM r"))
def q_csv_roundtrip(spark, sf):
    from segkit.sources.fixtures import BUYER_COLUMNS as cols
    path = scratch_path(spark, "csv")
    csv_io.write_csv(buyers_raw(spark, sf), path)
    schema = ", ".join(f"{c} {'int' if c == 'satisfaction_score' else 'string'}" for c in cols)
    return csv_io.read_csv(spark, path, schema)


# ───────────────────────── data quality (Q2-Q11) ─────────────────────────

LINE_DOMAINS = {"l_returnflag": ["A", "R"], "l_linestatus": ["O"]}


@query("domain_violations", """
SELECT 'l_returnflag' AS "column", l_returnflag AS value, count(*) AS n FROM lineitem
WHERE l_returnflag NOT IN ('A','R') GROUP BY l_returnflag
UNION ALL
SELECT 'l_linestatus', l_linestatus, count(*) FROM lineitem
WHERE l_linestatus NOT IN ('O') GROUP BY l_linestatus""")
def q_domain_violations(spark, sf):
    return Q.domain_violations(T(spark, sf, "lineitem"), LINE_DOMAINS)


def _null_inventory_sql():
    parts = [f"SELECT '{c}' AS \"column\", count(*) FILTER (WHERE {c} IS NULL) AS nulls, count(*) AS rows FROM r"
             for c in BUYER_COLUMNS]
    return O.with_raw(f"""SELECT "column", nulls, {O.rnd('nulls * 100.0 / rows', 1)} AS null_pct
FROM ({' UNION ALL '.join(parts)}) WHERE nulls > 0""")


@query("null_inventory", _null_inventory_sql())
def q_null_inventory(spark, sf):
    return Q.null_inventory(buyers_raw(spark, sf))


def _residual_sql():
    cols = ["client_id", "cohort_label", "client_type", "gender", "country", "region",
            "acquisition_purpose", "loan_applied", "referral_channel", "satisfaction_score", "age"]
    parts = [f"SELECT '{c}' AS \"column\", count(*) FILTER (WHERE {c} IS NULL) AS nulls, count(*) AS rows FROM b"
             for c in cols]
    return O.with_clean(" UNION ALL ".join(parts))


@query("residual_nulls", _residual_sql())
def q_residual_nulls(spark, sf):
    return Q.null_counts(B(spark, sf))


@query("value_share", O.with_raw(f"""
SELECT referral_channel, count(*) AS n,
       {O.rnd('count(*) * 100.0 / (SELECT count(*) FROM r WHERE referral_channel IS NOT NULL)', 2)} AS share_pct
FROM r WHERE referral_channel IS NOT NULL GROUP BY referral_channel"""))
def q_value_share(spark, sf):
    return Q.value_share(buyers_raw(spark, sf), "referral_channel")


@query("score_distribution", O.with_clean(
    "SELECT satisfaction_score, count(*) AS n FROM b GROUP BY satisfaction_score"))
def q_score_distribution(spark, sf):
    return Q.score_distribution(B(spark, sf), "satisfaction_score")


@query("numeric_range", O.with_clean(f"""
SELECT min(age) AS min_value, max(age) AS max_value, {O.rnd('avg(age)', 4)} AS mean_value,
       {O.rnd('stddev_samp(age)', 4)} AS std_value FROM b"""))
def q_numeric_range(spark, sf):
    return Q.numeric_range(B(spark, sf), "age")


@query("duplicate_report", O.with_raw("""
SELECT count(*) AS rows_before,
       (SELECT count(*) FROM (SELECT DISTINCT client_id, client_type, gender, country, region, date_of_birth,
               acquisition_purpose, loan_applied, referral_channel, satisfaction_score FROM r)) AS rows_after_full,
       (SELECT count(*) FROM (SELECT DISTINCT client_id, date_of_birth FROM r)) AS rows_after,
       count(*) - (SELECT count(*) FROM (SELECT DISTINCT client_id, date_of_birth FROM r)) AS rows_removed
FROM r"""))
def q_duplicate_report(spark, sf):
    return dedup.duplicate_report(buyers_raw(spark, sf), DEDUP_KEYS, exclude=[LABEL])


@query("shape_report", O.with_raw("SELECT count(*) AS rows, CAST(11 AS BIGINT) AS columns FROM r"))
def q_shape_report(spark, sf):
    return Q.shape(buyers_raw(spark, sf))


# ───────────────────────── projections / scalar functions (P*) ─────────────────────────

@query("flags", O.with_clean("""
SELECT client_id,
       CAST(coalesce(acquisition_purpose = 'Investment', false) AS integer) AS is_investor,
       CAST(coalesce(loan_applied = 'Yes', false) AS integer) AS has_loan,
       CAST(coalesce(client_type = 'Corporate', false) AS integer) AS is_corporate,
       concat('Segment ', CAST(satisfaction_score AS varchar)) AS segment_name
FROM b"""))
def q_flags(spark, sf):
    b = B(spark, sf)
    return b.select("client_id",
                    S.indicator("acquisition_purpose", "Investment").alias("is_investor"),
                    S.indicator("loan_applied", "Yes").alias("has_loan"),
                    S.indicator("client_type", "Corporate").alias("is_corporate"),
                    S.prefixed_label("satisfaction_score").alias("segment_name"))


@query("label_map_fallback", O.with_clean(
    f"SELECT client_id, {_map_sql('cohort_label', SEGMENT_DISPLAY, True)} AS cohort_display FROM b"))
def q_label_map_fallback(spark, sf):
    return B(spark, sf).select("client_id", S.map_values("cohort_label", SEGMENT_DISPLAY, True).alias("cohort_display"))


@query("label_map_strict", O.with_clean(
    f"SELECT client_id, {_map_sql('cohort_label', SEGMENT_DISPLAY, False)} AS cohort_display FROM b"))
def q_label_map_strict(spark, sf):
    return B(spark, sf).select("client_id", S.map_values("cohort_label", SEGMENT_DISPLAY, False).alias("cohort_display"))


@query("safe_date", O.with_raw("""
SELECT client_id, CAST(try_cast(date_of_birth AS date) AS varchar) AS dob,
       CAST(try_cast(client_id AS date) AS varchar) AS not_a_date FROM r"""))
def q_safe_date(spark, sf):
    return buyers_raw(spark, sf).select(
        "client_id", S.iso_date(S.safe_date("date_of_birth")).alias("dob"),
        S.iso_date(S.safe_date("client_id")).alias("not_a_date"))


@query("age_years", O.with_raw(f"SELECT DISTINCT client_id, {O.age_expr()} AS age FROM r"))
def q_age_years(spark, sf):
    return (buyers_raw(spark, sf)
            .select("client_id", S.whole_years(S.safe_date("date_of_birth")).alias("age")).distinct())


@query("formatted_key", """
SELECT c_custkey, printf('%s_%05d', 'C', c_custkey) AS client_key,
       strftime(date '2024-01-01' - CAST(c_custkey % 1000 AS integer), '%Y-%m-%d') AS key_date
FROM customer""")
def q_formatted_key(spark, sf):
    c = T(spark, sf, "customer")
    return c.select("c_custkey", S.formatted_key("C", "c_custkey").alias("client_key"),
                    S.iso_date(S.shift_days(F.lit("2024-01-01").cast("date"),
                                            -(F.col("c_custkey") % 1000).cast("int"))).alias("key_date"))


@query("scaled_metrics", O.with_clean(f"""
SELECT client_id, {O.rnd('(age - 20) / 55.0', 6)} AS age_scaled,
       {O.rnd('satisfaction_score / 5.0', 6)} AS score_scaled,
       {O.rnd("1 - CAST(coalesce(loan_applied = 'Yes', false) AS integer)", 6)} AS no_loan,
       CASE WHEN satisfaction_score > 3.5 THEN 'above' ELSE 'below' END AS score_band
FROM b"""))
def q_scaled_metrics(spark, sf):
    b = B(spark, sf)
    return b.select("client_id",
                    S.fixed_round(S.min_max_scaled("age", 20, 75), 6).alias("age_scaled"),
                    S.fixed_round(S.min_max_scaled("satisfaction_score", 0, 5), 6).alias("score_scaled"),
                    S.fixed_round(1 - S.indicator("loan_applied", "Yes"), 6).alias("no_loan"),
                    S.threshold_flag("satisfaction_score", 3.5).alias("score_band"))


# ───────────────────────── filters / slicer (F1-F9) ─────────────────────────

SLICE = {"cohort_label": ["HOUSEHOLD", "MACHINERY", "BUILDING"], "country": [],
         "client_type": "All", "referral_channel": "HIGH"}
SLICE_SQL = "cohort_label IN ('HOUSEHOLD', 'MACHINERY', 'BUILDING') AND referral_channel = 'HIGH'"
OPTION_DIMS = ["cohort_label", "country", "client_type", "referral_channel"]
CHOSEN_COUNTRIES = ["NATION_1", "NATION_2", "NATION_3"]
MAIN_COHORTS = ["HOUSEHOLD", "MACHINERY"]


@query("slice_all_dims", O.with_clean(
    f"SELECT client_id, cohort_label, country, referral_channel FROM b WHERE {SLICE_SQL}"))
def q_slice_all_dims(spark, sf):
    return SL.slice_rows(B(spark, sf), SLICE).select("client_id", "cohort_label", "country", "referral_channel")


@query("slice_share", O.with_clean(f"""
SELECT count(*) FILTER (WHERE {SLICE_SQL}) AS selected, count(*) AS total,
       {O.rnd(f'count(*) FILTER (WHERE {SLICE_SQL}) * 100.0 / count(*)', 1)} AS selected_pct FROM b"""))
def q_slice_share(spark, sf):
    return SL.slice_share(B(spark, sf), SLICE)


@query("filter_options", O.with_clean(" UNION ALL ".join(
    f"SELECT DISTINCT '{c}' AS dimension, CAST({c} AS varchar) AS value FROM b WHERE {c} IS NOT NULL"
    for c in OPTION_DIMS)))
def q_filter_options(spark, sf):
    return SL.filter_options(B(spark, sf), OPTION_DIMS)


@query("cascade_options", O.with_clean(
    "SELECT DISTINCT country, region FROM b WHERE country IN ('NATION_1', 'NATION_2', 'NATION_3') "
    "AND region IS NOT NULL"))
def q_cascade_options(spark, sf):
    return SL.cascade_options(B(spark, sf), "country", "region", CHOSEN_COUNTRIES)


@query("cohort_mask", O.with_clean(f"""
SELECT cohort_label, count(*) AS n, {O.rnd('avg(satisfaction_score)', 2)} AS avg_score
FROM b WHERE cohort_label IN ('HOUSEHOLD', 'MACHINERY') GROUP BY cohort_label"""))
def q_cohort_mask(spark, sf):
    b = SL.slice_rows(B(spark, sf), {"cohort_label": MAIN_COHORTS})
    return b.groupBy("cohort_label").agg(F.count(F.lit(1)).alias("n"),
                                         S.fixed_round(F.avg("satisfaction_score"), 2).alias("avg_score"))


# ───────────────────────── joins (J1-J6) ─────────────────────────

TOP10_COUNTRIES_SQL = ("(SELECT country FROM b GROUP BY country ORDER BY count(*) DESC, country LIMIT 10)")


@query("topn_semi_join", O.with_clean(f"""
SELECT country, cohort_label, count(*) AS n FROM b
WHERE country IN {TOP10_COUNTRIES_SQL} GROUP BY country, cohort_label"""))
def q_topn_semi_join(spark, sf):
    from segkit.operators.joins import semi_join
    b = B(spark, sf)
    top = P.top_values(b, "country", 10).select("country")
    return P.crosstab(semi_join(b, top, on="country"), "country", "cohort_label")


@query("dim_lookup", f"""
SELECT n_name, count(*) AS n_orders, {O.rnd('sum(o_totalprice)', 2)} AS revenue
FROM orders JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey
GROUP BY n_name""")
def q_dim_lookup(spark, sf):
    """Orders per nation through the customer and nation dimensions.

    Orders are pre-aggregated per customer first (partial aggregation collapses a
    customer with a third of all orders inside each task), so the join sees one
    row per key: no skewed join partition, and a far smaller shuffle.  The
    customer side is broadcast only when a bounded count proves it small.
    """
    o = (T(spark, sf, "orders").groupBy("o_custkey")
         .agg(F.count(F.lit(1)).alias("_n"), F.sum("o_totalprice").alias("_rev")))
    c = T(spark, sf, "customer").select(F.col("c_custkey").alias("o_custkey"), "c_nationkey")
    n = T(spark, sf, "nation").select(F.col("n_nationkey").alias("c_nationkey"), "n_name")
    j = lookup_join(lookup_join(o, c, on="o_custkey", how="inner"), n, on="c_nationkey", how="inner")
    return j.groupBy("n_name").agg(F.sum("_n").alias("n_orders"),
                                   S.fixed_round(F.sum("_rev"), 2).alias("revenue"))


@query("anti_domain", O.with_clean("""
SELECT client_id, referral_channel FROM b WHERE referral_channel NOT IN ('URGENT', 'HIGH')"""))
def q_anti_domain(spark, sf):
    from segkit.operators.joins import anti_join, values_frame
    allowed = values_frame(spark, "referral_channel", ["URGENT", "HIGH"])
    return anti_join(B(spark, sf).select("client_id", "referral_channel"), allowed, on="referral_channel")


@query("profile_with_top", O.with_clean(f"""
SELECT p.*, t.top_country FROM (
  SELECT cohort_label, count(*) AS size, {O.rnd('avg(age)', 1)} AS avg_age,
         {O.rnd('avg(satisfaction_score)', 2)} AS avg_score,
         {O.rnd("avg(CAST(coalesce(client_type = 'Corporate', false) AS integer)) * 100", 1)} AS corporate_pct,
         {O.rnd("avg(CAST(coalesce(acquisition_purpose = 'Investment', false) AS integer)) * 100", 1)} AS investment_pct,
         {O.rnd("avg(CAST(coalesce(loan_applied = 'Yes', false) AS integer)) * 100", 1)} AS loan_pct
  FROM b GROUP BY cohort_label) p
LEFT JOIN (SELECT cohort_label, country AS top_country FROM (
     SELECT cohort_label, country, row_number() OVER (PARTITION BY cohort_label ORDER BY count(*) DESC, country) AS rk
     FROM b GROUP BY cohort_label, country) WHERE rk = 1) t USING (cohort_label)"""))
def q_profile_with_top(spark, sf):
    return P.profile_with_top(B(spark, sf), "cohort_label", "country")


# ───────────────────────── dedup / set ops (U1-U4) ─────────────────────────

@query("dedup_full", O.with_raw(f"""
SELECT {O.RAW_COLS} FROM (SELECT *, row_number() OVER (
  PARTITION BY client_id, client_type, gender, country, region, date_of_birth, acquisition_purpose, loan_applied, referral_channel,
               satisfaction_score ORDER BY seq) AS rn FROM r) WHERE rn = 1"""))
def q_dedup_full(spark, sf):
    return dedup.dedup_full(buyers_ordered(spark, sf), exclude=[LABEL], order_by="seq").drop("seq")


@query("dedup_key_first", O.with_raw(f"""
SELECT {O.RAW_COLS} FROM (SELECT *, row_number() OVER (PARTITION BY region, referral_channel ORDER BY seq) AS rn FROM r) WHERE rn = 1"""))
def q_dedup_key_first(spark, sf):
    return dedup.dedup_keep_first(buyers_ordered(spark, sf), ["region", "referral_channel"], order_by="seq").drop("seq")


@query("dedup_two_pass", O.with_dedup(f"SELECT {O.RAW_COLS} FROM d"))
def q_dedup_two_pass(spark, sf):
    return dedup_buyers(buyers_ordered(spark, sf))


@query("union_all", """
SELECT c_custkey, c_mktsegment, 'non_negative' AS part FROM customer WHERE c_acctbal >= 0
UNION ALL SELECT c_custkey, c_mktsegment, 'negative' FROM customer WHERE c_acctbal < 0""")
def q_union_all(spark, sf):
    c = T(spark, sf, "customer").select("c_custkey", "c_mktsegment", "c_acctbal")
    return dedup.union_all(
        c.where("c_acctbal >= 0").select("c_custkey", "c_mktsegment", F.lit("non_negative").alias("part")),
        c.where("c_acctbal < 0").select("c_custkey", "c_mktsegment", F.lit("negative").alias("part")))


# ───────────────────────── imputation (I1-I4) ─────────────────────────

@query("impute_rule", O.with_dedup("""
SELECT client_id, CASE WHEN gender IS NULL AND client_type = 'Corporate' THEN 'Not Applicable'
                       ELSE gender END AS gender FROM d"""))
def q_impute_rule(spark, sf):
    d = dedup_buyers(buyers_ordered(spark, sf))
    model = fit_imputer(d, rules=[Rule("gender", F.col("client_type") == "Corporate", "Not Applicable")])
    return model.transform(d).select("client_id", "gender")


@query("impute_cond_mode", O.with_imputed("SELECT client_id, gender FROM i"))
def q_impute_cond_mode(spark, sf):
    d = dedup_buyers(buyers_ordered(spark, sf))
    model = fit_imputer(d, rules=[Rule("gender", F.col("client_type") == "Corporate", "Not Applicable")],
                        conditional=[ConditionalMode("gender", F.col("client_type") == "Individual")])
    return model.transform(d).select("client_id", "gender")


@query("impute_mode", O.with_imputed(" UNION ALL ".join(
    f"SELECT '{c}' AS \"column\", (SELECT count(*) FROM d WHERE {c} IS NULL) AS nulls, 'mode' AS method, {m} AS value FROM m"
    for c, m in [("region", "m_region"), ("referral_channel", "m_channel"),
                 ("acquisition_purpose", "m_purpose"), ("loan_applied", "m_loan")])))
def q_impute_mode(spark, sf):
    d = dedup_buyers(buyers_ordered(spark, sf))
    model = fit_imputer(d, mode_columns=MODE_COLUMNS)
    return model.report_frame(spark)


@query("impute_full", O.with_clean("SELECT * FROM b"))
def q_impute_full(spark, sf):
    return B(spark, sf)


# ───────────────────────── aggregations (A1-A20) ─────────────────────────

def _ind(col, v):
    return f"CAST(coalesce({col} = '{v}', false) AS integer)"


@query("group_size", O.with_clean("SELECT country, count(*) AS n FROM b GROUP BY country"))
def q_group_size(spark, sf):
    return P.group_size(B(spark, sf), "country")


@query("crosstab", O.with_clean(
    "SELECT cohort_label, acquisition_purpose, count(*) AS n FROM b GROUP BY ALL"))
def q_crosstab(spark, sf):
    return P.crosstab(B(spark, sf), "cohort_label", "acquisition_purpose")


@query("segment_profile", O.with_clean(f"""
SELECT referral_channel, count(*) AS size, {O.rnd('avg(age)', 1)} AS avg_age,
       {O.rnd('avg(satisfaction_score)', 2)} AS avg_score,
       {O.rnd(f"avg({_ind('client_type', 'Corporate')}) * 100", 1)} AS corporate_pct,
       {O.rnd(f"avg({_ind('acquisition_purpose', 'Investment')}) * 100", 1)} AS investment_pct,
       {O.rnd(f"avg({_ind('loan_applied', 'Yes')}) * 100", 1)} AS loan_pct
FROM b GROUP BY referral_channel"""))
def q_segment_profile(spark, sf):
    return P.segment_profile(B(spark, sf), "referral_channel")


@query("group_mode", O.with_clean("""
SELECT cohort_label, region AS top_region, n AS top_region_n FROM (
  SELECT cohort_label, region, count(*) AS n,
         row_number() OVER (PARTITION BY cohort_label ORDER BY count(*) DESC, region) AS rk
  FROM b GROUP BY cohort_label, region) WHERE rk = 1"""))
def q_group_mode(spark, sf):
    return P.group_mode(B(spark, sf), "cohort_label", "region")


@query("indicator_rate", O.with_clean(f"""
SELECT cohort_label, {O.rnd(f"avg({_ind('acquisition_purpose', 'Investment')}) * 100", 1)} AS rate_pct
FROM b GROUP BY cohort_label"""))
def q_indicator_rate(spark, sf):
    return P.indicator_rate(B(spark, sf), "cohort_label", "acquisition_purpose", "Investment")


@query("share_within", O.with_clean(f"""
SELECT cohort_label, referral_channel, count(*) AS n,
       {O.rnd('count(*) * 100.0 / sum(count(*)) OVER (PARTITION BY cohort_label)', 1)} AS share_pct
FROM b GROUP BY cohort_label, referral_channel"""))
def q_share_within(spark, sf):
    return P.share_within(B(spark, sf), "cohort_label", "referral_channel")


@query("share_total", O.with_clean(f"""
SELECT cohort_label, count(*) AS n, {O.rnd('count(*) * 100.0 / (SELECT count(*) FROM b)', 1)} AS share_pct
FROM b GROUP BY cohort_label"""))
def q_share_total(spark, sf):
    return P.share_total(B(spark, sf), "cohort_label")


@query("kpi_row", O.with_clean(f"""
SELECT count(*) AS rows, {O.rnd('avg(satisfaction_score)', 2)} AS avg_score,
       {O.rnd(f"sum({_ind('loan_applied', 'Yes')}) * 100.0 / count(*)", 1)} AS flag_pct,
       (SELECT cohort_label FROM b GROUP BY cohort_label ORDER BY count(*) DESC, cohort_label LIMIT 1) AS dominant,
       {O.rnd('(SELECT max(c) FROM (SELECT count(*) AS c FROM b GROUP BY cohort_label)) * 100.0 / count(*)', 1)}
         AS dominant_pct
FROM b"""))
def q_kpi_row(spark, sf):
    return P.kpi_row(B(spark, sf), "cohort_label")


SEGMENTS = ["AUTOMOBILE", "BUILDING", "FURNITURE", "HOUSEHOLD", "MACHINERY"]


def _pivot_sql(row: str, col: str, values, src: str = "b", where: str = "TRUE") -> str:
    cells = ", ".join(f"count(*) FILTER (WHERE {col} = '{v}') AS \"{v}\"" for v in values)
    return f"SELECT {row}, {cells} FROM {src} WHERE {where} AND {row} IS NOT NULL AND {col} IS NOT NULL GROUP BY {row}"


@query("pivot_zero", O.with_clean(_pivot_sql("country", "cohort_label", SEGMENTS)))
def q_pivot_zero(spark, sf):
    return P.pivot_zero(B(spark, sf), "country", "cohort_label", SEGMENTS)


@query("heat_topn", O.with_clean(_pivot_sql("country", "client_type", ["Corporate", "Individual"],
                                            where=f"country IN {TOP10_COUNTRIES_SQL}")))
def q_heat_topn(spark, sf):
    return P.heat_topn(B(spark, sf), "country", "client_type", 10, ["Corporate", "Individual"])


@query("hierarchy_rollup", O.with_clean("""
SELECT country, region, 2 AS depth, count(*) AS n FROM b GROUP BY country, region
UNION ALL SELECT country, NULL, 1, count(*) FROM b GROUP BY country"""))
def q_hierarchy_rollup(spark, sf):
    return P.hierarchy_rollup(B(spark, sf), "country", "region")


@query("five_number", O.with_clean(f"""
SELECT cohort_label, CAST(min(age) AS double) AS min_value,
       {O.rnd('quantile_cont(age, 0.25)', 4)} AS q1, {O.rnd('quantile_cont(age, 0.5)', 4)} AS median,
       {O.rnd('quantile_cont(age, 0.75)', 4)} AS q3, CAST(max(age) AS double) AS max_value, count(*) AS n
FROM b GROUP BY cohort_label"""))
def q_five_number(spark, sf):
    return P.five_number(B(spark, sf), "cohort_label", "age")


MAIN_SQL = "('AUTOMOBILE', 'BUILDING', 'HOUSEHOLD', 'MACHINERY')"


@query("histogram", O.with_clean(f"""
SELECT g.cohort_label, CAST(k.bin AS integer) AS bin, CAST(0.5 + k.bin AS double) AS bin_start,
       count(b.client_id) AS n
FROM (SELECT DISTINCT cohort_label FROM b WHERE cohort_label IN {MAIN_SQL}) g CROSS JOIN range(5) k(bin)
LEFT JOIN b ON b.cohort_label = g.cohort_label
           AND least(greatest(floor((b.satisfaction_score - 0.5) / 1.0), 0), 4) = k.bin
GROUP BY g.cohort_label, k.bin"""))
def q_histogram(spark, sf):
    """Satisfaction histogram (5 unit bins) of the main cohorts."""
    from segkit.sources.fixtures import MAIN_COHORTS
    b = SL.slice_rows(B(spark, sf), {"cohort_label": MAIN_COHORTS})
    return P.histogram(b, "cohort_label", "satisfaction_score", 0.5, 1.0, 5)


RADAR_SQL = {
    "satisfaction": "satisfaction_score / 5.0", "investment_focus": _ind("acquisition_purpose", "Investment"),
    "self_funded": f"1 - {_ind('loan_applied', 'Yes')}", "corporate_presence": _ind("client_type", "Corporate"),
    "seniority": "(age - 20) / 55.0",
}


@query("radar_long", O.with_clean(" UNION ALL ".join(
    f"SELECT cohort_label, '{m}' AS metric, {O.rnd(f'avg({e})', 4)} AS value FROM b "
    f"WHERE cohort_label IN {MAIN_SQL} GROUP BY cohort_label" for m, e in RADAR_SQL.items())))
def q_radar_long(spark, sf):
    """Radar scores of the main cohorts, long form."""
    from segkit.plans.dashboard import radar_metrics
    from segkit.sources.fixtures import MAIN_COHORTS
    b = SL.slice_rows(B(spark, sf), {"cohort_label": MAIN_COHORTS})
    return P.radar_long(b, "cohort_label", radar_metrics())


FIXED_GROUPS = SEGMENTS + ["UNKNOWN"]


@query("fixed_groups_zero", O.with_clean(f"""
SELECT g.cohort_label, coalesce(s.n, 0) AS n, coalesce(s.avg_score, 0.0) AS avg_score,
       coalesce(s.flag_pct, 0.0) AS flag_pct
FROM (VALUES {", ".join(f"('{g}')" for g in FIXED_GROUPS)}) g(cohort_label)
LEFT JOIN (SELECT cohort_label, count(*) AS n, {O.rnd('avg(satisfaction_score)', 2)} AS avg_score,
                  {O.rnd(f"avg({_ind('acquisition_purpose', 'Investment')}) * 100", 1)} AS flag_pct
           FROM b GROUP BY cohort_label) s USING (cohort_label)"""))
def q_fixed_groups_zero(spark, sf):
    return P.fixed_groups_stats(B(spark, sf), "cohort_label", FIXED_GROUPS)


@query("distinct_count", O.with_clean(" UNION ALL ".join(
    f"SELECT '{c}' AS \"column\", count(DISTINCT {c}) AS distinct_values FROM b"
    for c in ["country", "region", "referral_channel", "client_id"])))
def q_distinct_count(spark, sf):
    return P.distinct_counts(B(spark, sf), ["country", "region", "referral_channel", "client_id"])


@query("cluster_sizes", """
SELECT CAST(k.id AS integer) AS label, coalesce(s.n, 0) AS n
FROM range(12) k(id) LEFT JOIN (SELECT label, count(*) AS n FROM embeddings GROUP BY label) s ON s.label = k.id""")
def q_cluster_sizes(spark, sf):
    return P.cluster_sizes(T(spark, sf, "embeddings"), "label", 12)


@query("purity", "WITH " + O.clean_ctes() + """,
c AS (SELECT satisfaction_score, cohort_label, count(*) AS n FROM b GROUP BY ALL),
r2 AS (SELECT *, row_number() OVER (PARTITION BY satisfaction_score ORDER BY n DESC, cohort_label) AS rk FROM c),
t AS (SELECT satisfaction_score, sum(n) AS size FROM c GROUP BY satisfaction_score)
SELECT t.satisfaction_score, CAST(t.size AS bigint) AS size, a.cohort_label AS dominant,
       """ + O.rnd("a.n / t.size", 4) + """ AS purity, z.cohort_label AS runner_up,
       """ + O.rnd("z.n / t.size", 4) + """ AS runner_up_share
FROM t JOIN r2 a ON a.satisfaction_score = t.satisfaction_score AND a.rk = 1
LEFT JOIN r2 z ON z.satisfaction_score = t.satisfaction_score AND z.rk = 2""")
def q_purity(spark, sf):
    return P.purity(B(spark, sf), "satisfaction_score", "cohort_label")


@query("contingency", O.with_clean(
    "SELECT cohort_label, satisfaction_score, count(*) AS n FROM b GROUP BY ALL"))
def q_contingency(spark, sf):
    return P.crosstab(B(spark, sf), "cohort_label", "satisfaction_score")


# ───────────────────────── sort / top-k / sampling (O1-O6) ─────────────────────────

@query("sort_groups", "SELECT o_orderpriority, count(*) AS n FROM orders GROUP BY o_orderpriority")
def q_sort_groups(spark, sf):
    return P.sort_groups(T(spark, sf, "orders"), "o_orderpriority")


@query("top_n", """
SELECT l_partkey, count(*) AS n FROM lineitem GROUP BY l_partkey ORDER BY n DESC, l_partkey LIMIT 10""")
def q_top_n(spark, sf):
    return P.top_values(T(spark, sf, "lineitem"), "l_partkey", 10)


@query("fixed_sample", """
SELECT o_orderkey, o_custkey, o_totalprice FROM orders
ORDER BY md5('sample:' || CAST(o_orderkey AS varchar)), o_orderkey LIMIT 1500""")
def q_fixed_sample(spark, sf):
    o = T(spark, sf, "orders").select("o_orderkey", "o_custkey", "o_totalprice")
    return P.fixed_sample(o, "o_orderkey", 1500, "sample")


@query("hash_shuffle", "SELECT c_custkey, md5('shuffle:' || CAST(c_custkey AS varchar)) AS sort_key FROM customer")
def q_hash_shuffle(spark, sf):
    return P.hash_order(T(spark, sf, "customer").select("c_custkey"), "c_custkey", "shuffle")


@query("rank_candidates", """
SELECT p_size AS k, cnt AS score FROM (SELECT p_size, count(*) AS cnt FROM part GROUP BY p_size)
ORDER BY cnt DESC, p_size LIMIT 2""")
def q_rank_candidates(spark, sf):
    return (P.group_size(T(spark, sf, "part"), "p_size").select(F.col("p_size").alias("k"), F.col("n").alias("score"))
            .orderBy(F.desc("score"), "k").limit(2))


# ───────────────────────── assignments by hash of key (Y1-Y7) ─────────────────────────

CONTACTS = ["web", "phone", "store", "partner"]
CONTACT_WEIGHTS = [0.5, 0.25, 0.125, 0.125]
GROUPS = ["control", "variant_1", "variant_2"]
REVIEW_RATE = {"BUILDING": 0.6, "FURNITURE": 0.15}
REVIEW_RATE_OTHER = 0.3


@query("weighted_assign", f"""
SELECT c_custkey, CASE WHEN {O.u('contact')} < 0.5 THEN 'web' WHEN {O.u('contact')} < 0.75 THEN 'phone'
                       WHEN {O.u('contact')} < 0.875 THEN 'store' ELSE 'partner' END AS contact
FROM customer""")
def q_weighted_assign(spark, sf):
    return T(spark, sf, "customer").select(
        "c_custkey", assign.weighted_choice("contact", "c_custkey", CONTACTS, CONTACT_WEIGHTS).alias("contact"))


@query("uniform_assign", f"""
SELECT c_custkey, CASE {O.h('group', 3)} WHEN 0 THEN 'control' WHEN 1 THEN 'variant_1' ELSE 'variant_2' END AS test_group
FROM customer""")
def q_uniform_assign(spark, sf):
    return T(spark, sf, "customer").select("c_custkey", assign.uniform_choice("group", "c_custkey", GROUPS).alias("test_group"))


@query("conditional_assign", f"""
SELECT c_custkey, {O.u('review')} < CASE c_mktsegment WHEN 'BUILDING' THEN 0.6 WHEN 'FURNITURE' THEN 0.15 ELSE 0.3 END AS in_review
FROM customer""")
def q_conditional_assign(spark, sf):
    rate = F.lit(REVIEW_RATE_OTHER)
    for segment, r in REVIEW_RATE.items():
        rate = F.when(F.col("c_mktsegment") == segment, F.lit(r)).otherwise(rate)
    return T(spark, sf, "customer").select("c_custkey", assign.bernoulli("review", "c_custkey", rate).alias("in_review"))


@query("dependent_assign", f"""
SELECT c_custkey, n_name AS country, concat(n_name, '/', CAST({O.h('reg', 4)} AS varchar)) AS region
FROM customer JOIN nation ON c_nationkey = n_nationkey""")
def q_dependent_assign(spark, sf):
    c = T(spark, sf, "customer").select("c_custkey", "c_nationkey")
    n = T(spark, sf, "nation").select(F.col("n_nationkey").alias("c_nationkey"), "n_name")
    j = lookup_join(c, n, on="c_nationkey", how="inner")
    return j.select("c_custkey", F.col("n_name").alias("country"),
                    assign.child_of("n_name", "reg", "c_custkey", 4).alias("region"))


@query("date_in_window", f"""
SELECT c_custkey, CAST(date '1950-01-01' + CAST({O.h('dob', 15000)} AS integer) AS varchar) AS dob FROM customer""")
def q_date_in_window(spark, sf):
    return T(spark, sf, "customer").select(
        "c_custkey", assign.date_in_window("dob", "c_custkey", "1950-01-01", 15000).cast("string").alias("dob"))


@query("null_mask", f"""
SELECT c_custkey, CASE WHEN {O.u('null:c_name')} < 0.05 THEN NULL ELSE c_name END AS c_name,
       CASE WHEN {O.u('null:c_mktsegment')} < 0.05 THEN NULL ELSE c_mktsegment END AS c_mktsegment FROM customer""")
def q_null_mask(spark, sf):
    c = T(spark, sf, "customer").select("c_custkey", "c_name", "c_mktsegment")
    return assign.mask_nulls(c, ["c_name", "c_mktsegment"], "c_custkey", 0.05)


@query("append_duplicates", f"""
SELECT c_mktsegment, count(*) AS n FROM (
  SELECT c_custkey, c_mktsegment FROM customer
  UNION ALL SELECT c_custkey, c_mktsegment FROM customer WHERE {O.u('dup')} < 0.01) GROUP BY c_mktsegment""")
def q_append_duplicates(spark, sf):
    c = T(spark, sf, "customer").select("c_custkey", "c_mktsegment")
    out = assign.append_copies(c, assign.bernoulli("dup", "c_custkey", 0.01))
    return P.group_size(out, "c_mktsegment")


@query("buyers_fixture", O.with_raw(f"SELECT {O.RAW_COLS} FROM r"))
def q_buyers_fixture(spark, sf):
    return buyers_raw(spark, sf)


# ───────────────────────── features (E1-E7) ─────────────────────────

from segkit.operators import kmeans as KM  # noqa: E402
from segkit.operators import modelsel as MS  # noqa: E402
from segkit.operators import validate as V  # noqa: E402
from segkit.operators.features import fit_features, squared_norm  # noqa: E402
from segkit.plans.segmentation import CATEGORICAL, NUMERIC  # noqa: E402

BINARY = ["client_type", "acquisition_purpose", "loan_applied"]
MULTI = ["gender", "country", "region", "referral_channel"]


def _encoded(spark, sf):
    b = B(spark, sf)
    return fit_features(b, NUMERIC, CATEGORICAL), b


def _onehot_sql():
    parts = [f"SELECT client_id, '{c}_' || {c} AS feature, CAST(1.0 AS double) AS value FROM b WHERE {c} = (SELECT max({c}) FROM b)"
             for c in BINARY]
    parts += [f"SELECT client_id, '{c}_' || {c} AS feature, CAST(1.0 AS double) AS value FROM b WHERE {c} IS NOT NULL"
              for c in MULTI]
    return O.with_clean(" UNION ALL ".join(parts))


@query("onehot_long", _onehot_sql())
def q_onehot_long(spark, sf):
    fm, b = _encoded(spark, sf)
    return fm.long(b, keep=["client_id"])


@query("binary_encode", O.with_clean("""
SELECT client_id, CAST(client_type = 'Individual' AS double) AS "client_type_Individual",
       CAST(acquisition_purpose = 'Personal Use' AS double) AS "acquisition_purpose_Personal Use",
       CAST(loan_applied = 'Yes' AS double) AS "loan_applied_Yes" FROM b"""))
def q_binary_encode(spark, sf):
    fm, b = _encoded(spark, sf)
    names = [n for c, _, n in fm.onehot_slots() if c in BINARY]
    return fm.wide(b, keep=["client_id"]).select("client_id", *[F.col(f"`{n}`") for n in names])


@query("standardize", O.with_clean(f"""
SELECT client_id, {O.rnd('(age - avg(age) OVER ()) / stddev_pop(age) OVER ()', 6)} AS age_z,
       {O.rnd('(satisfaction_score - avg(satisfaction_score) OVER ()) / stddev_pop(satisfaction_score) OVER ()', 6)}
         AS score_z FROM b"""))
def q_standardize(spark, sf):
    fm, b = _encoded(spark, sf)
    z = fm.numeric_exprs()
    return b.select("client_id", S.fixed_round(z[0], 6).alias("age_z"), S.fixed_round(z[1], 6).alias("score_z"))


def _inventory_sql():
    parts = [f"SELECT '{c}' AS \"column\", CAST(0 AS bigint) AS n_categories, CAST(1 AS bigint) AS n_outputs"
             for c in NUMERIC]
    parts += [f"SELECT '{c}', count(DISTINCT {c}), CASE WHEN count(DISTINCT {c}) = 2 THEN 1 "
              f"ELSE count(DISTINCT {c}) END FROM b" for c in CATEGORICAL]
    return O.with_clean(" UNION ALL ".join(parts))


@query("encoding_inventory", _inventory_sql())
def q_encoding_inventory(spark, sf):
    fm, _ = _encoded(spark, sf)
    return fm.inventory(spark)


def _norm_sql():
    width = ("(SELECT 2 + 3 + count(DISTINCT gender) + count(DISTINCT country) + count(DISTINCT region)"
             " + count(DISTINCT referral_channel) FROM b)")
    zs = ("pow((age - avg(age) OVER ()) / stddev_pop(age) OVER (), 2) + "
          "pow((satisfaction_score - avg(satisfaction_score) OVER ()) / stddev_pop(satisfaction_score) OVER (), 2)")
    ones = " + ".join([f"CAST({c} = (SELECT max({c}) FROM b) AS integer)" for c in BINARY] +
                      [f"CAST({c} IS NOT NULL AS integer)" for c in MULTI])
    return O.with_clean(f"SELECT client_id, CAST({width} AS integer) AS width, "
                        f"{O.rnd(f'{zs} + {ones}', 6)} AS sq_norm FROM b")


@query("feature_vector_norm", _norm_sql())
def q_feature_vector_norm(spark, sf):
    fm, b = _encoded(spark, sf)
    x = fm.transform(b)
    return x.select("client_id", F.size("features").alias("width"), S.fixed_round(squared_norm("features"), 6).alias("sq_norm"))


# ───────────────────────── scoring, Lloyd step, WCSS (K3, K9) ─────────────────────────

EMB_CTES = """e AS (SELECT vec_id, label, CAST(embedding AS DOUBLE[]) AS v FROM embeddings),
ex AS (SELECT vec_id, label, unnest(v) AS x, unnest(generate_series(0, len(v) - 1)) AS dim FROM e),
c AS (SELECT label AS cl, dim, avg(x) AS cx FROM ex GROUP BY label, dim),
dd AS (SELECT ex.vec_id, ex.label, c.cl, sum((ex.x - c.cx) * (ex.x - c.cx)) AS d2
       FROM ex JOIN c ON ex.dim = c.dim GROUP BY ex.vec_id, ex.label, c.cl),
nn AS (SELECT vec_id, label, cl AS nearest_label FROM (
         SELECT *, row_number() OVER (PARTITION BY vec_id ORDER BY d2, cl) AS rk FROM dd) WHERE rk = 1)"""


def _embeddings(spark, sf):
    return T(spark, sf, "embeddings").select("vec_id", "label", F.col("embedding").cast("array<double>").alias("v"))


def _nearest(spark, sf):
    e = _embeddings(spark, sf)
    return KM.nearest_label(e, KM.centers_by(e, "label", "v"), "v", "nearest_label")


@query("nearest_centroid", f"WITH {EMB_CTES} SELECT vec_id, label, nearest_label FROM nn")
def q_nearest_centroid(spark, sf):
    return _nearest(spark, sf).select("vec_id", "label", "nearest_label")


@query("lloyd_step", f"""WITH {EMB_CTES}
SELECT nn.nearest_label AS nearest_label, ex.dim AS dim, {O.rnd('avg(ex.x)', 6)} AS value
FROM ex JOIN nn USING (vec_id) GROUP BY nn.nearest_label, ex.dim""")
def q_lloyd_step(spark, sf):
    long = KM.centers_by(_nearest(spark, sf), "nearest_label", "v").select("nearest_label", F.posexplode("center").alias("dim", "value"))
    return long.select("nearest_label", F.col("dim").cast("bigint").alias("dim"), S.fixed_round("value", 6).alias("value"))


@query("wcss", f"""WITH {EMB_CTES}
SELECT label, count(*) AS n, {O.rnd('sum(d2)', 6)} AS wcss FROM dd WHERE cl = label GROUP BY label""")
def q_wcss(spark, sf):
    w = KM.wcss_by_label(_embeddings(spark, sf), "v", "label")
    return w.select("label", "n", S.fixed_round("wcss", 6).alias("wcss"))


# ───────────────────────── model choice (K5, K6) ─────────────────────────

KT_SQL = f"""kt AS (SELECT p_size AS k, {O.rnd('avg(p_retailprice) / 1000.0', 6)} AS silhouette,
                     sum(p_retailprice) AS inertia FROM part GROUP BY p_size),
nrm AS (SELECT k, inertia / first_value(inertia) OVER (ORDER BY k) AS norm FROM kt),
df1 AS (SELECT k, norm - lag(norm) OVER (ORDER BY k) AS d1 FROM nrm),
df2 AS (SELECT k, d1 - lag(d1) OVER (ORDER BY k) AS d2 FROM df1),
el AS (SELECT CAST(CASE WHEN (SELECT count(*) FROM kt) < 4 THEN 4
                   ELSE (SELECT k FROM df2 WHERE d2 IS NOT NULL ORDER BY d2 DESC, k LIMIT 1) END AS integer) AS elbow_k)"""


def _k_table(spark, sf):
    return (T(spark, sf, "part").groupBy("p_size")
            .agg(S.fixed_round(F.avg("p_retailprice") / 1000.0, 6).alias("silhouette"),
                 F.sum("p_retailprice").alias("inertia"))
            .withColumnRenamed("p_size", "k"))


@query("knee_point", f"WITH {KT_SQL} SELECT elbow_k FROM el")
def q_knee_point(spark, sf):
    return MS.knee_point(_k_table(spark, sf))


@query("choose_k", f"""WITH {KT_SQL},
rr AS (SELECT k, silhouette, row_number() OVER (ORDER BY silhouette DESC, k) AS rk FROM kt),
t AS (SELECT max(CASE WHEN rk = 1 THEN k END) AS w, max(CASE WHEN rk = 2 THEN k END) AS ru,
             max(CASE WHEN rk = 1 THEN silhouette END) AS s1, max(CASE WHEN rk = 2 THEN silhouette END) AS s2 FROM rr)
SELECT CAST(CASE WHEN s1 - s2 < 0.02 THEN 4 ELSE w END AS integer) AS k, CAST(w AS integer) AS winner,
       CAST(ru AS integer) AS runner_up, s1 - s2 AS gap, elbow_k,
       CASE WHEN s1 - s2 < 0.02 THEN 'ambiguous' WHEN w = elbow_k THEN 'agree' ELSE 'silhouette' END AS decision
FROM t, el""")
def q_choose_k(spark, sf):
    return MS.choose_k(_k_table(spark, sf))


# ───────────────────────── validation (V1-V5) ─────────────────────────

def _sil_sql(squared: bool) -> str:
    dist = "pow(list_distance(a.v, b.v), 2)" if squared else "list_distance(a.v, b.v)"
    return f"""WITH e AS (SELECT vec_id, CAST(label AS varchar) AS label, CAST(embedding AS DOUBLE[]) AS v FROM embeddings),
p AS (SELECT a.vec_id, a.label AS own, b.label AS cl, sum({dist}) AS dsum, count(*) AS cnt
      FROM e a CROSS JOIN e b GROUP BY a.vec_id, a.label, b.label),
s AS (SELECT vec_id, max(CASE WHEN cl = own AND cnt > 1 THEN dsum / (cnt - 1) END) AS a,
             max(CASE WHEN cl = own THEN cnt END) AS oc, min(CASE WHEN cl <> own THEN dsum / cnt END) AS b
      FROM p GROUP BY vec_id)
SELECT 'label' AS labelling,
       {O.rnd('avg(CASE WHEN oc <= 1 OR b IS NULL THEN 0.0 ELSE (b - a) / greatest(a, b) END)', 6)} AS silhouette
FROM s"""


@query("silhouette_exact", _sil_sql(False))
def q_silhouette_exact(spark, sf):
    e = T(spark, sf, "embeddings")
    s = V.silhouette_exact(e, "embedding", ["label"], "vec_id", block_rows=128)
    return s.select("labelling", S.fixed_round("silhouette", 6).alias("silhouette"))


SAMPLED_ROWS = 16


@query("silhouette_sampled", f"""WITH e AS (SELECT vec_id, CAST(label AS varchar) AS label, CAST(embedding AS DOUBLE[]) AS v FROM embeddings),
w AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY label ORDER BY md5('silhouette:' || CAST(vec_id AS varchar))) AS place FROM e) WHERE place <= {SAMPLED_ROWS}),
sz AS (SELECT label, count(*) AS size FROM e GROUP BY label),
p AS (SELECT a.vec_id, a.label AS own, w.label AS cl, sum(list_distance(a.v, w.v)) AS dsum, count(*) AS cnt
      FROM e a CROSS JOIN w WHERE a.vec_id <> w.vec_id GROUP BY a.vec_id, a.label, w.label),
s AS (SELECT vec_id, any_value(own) AS own, max(CASE WHEN cl = own THEN dsum / cnt END) AS a, min(CASE WHEN cl <> own THEN dsum / cnt END) AS b FROM p GROUP BY vec_id)
SELECT 'label' AS labelling, {O.rnd('avg(CASE WHEN size <= 1 THEN 0.0 ELSE (b - a) / greatest(a, b) END)', 6)} AS silhouette FROM s JOIN sz ON sz.label = s.own""")
def q_silhouette_sampled(spark, sf):
    """V1 in linear time: every row against a hash sample of each cluster."""
    from segkit.operators.sampled_silhouette import silhouette_sampled
    s = silhouette_sampled(T(spark, sf, "embeddings"), "embedding", "label", "vec_id", per_cluster=SAMPLED_ROWS)
    return s.select("labelling", S.fixed_round("silhouette", 6).alias("silhouette"))


@query("silhouette_sq", _sil_sql(True))
def q_silhouette_sq(spark, sf):
    val = V.silhouette_squared(T(spark, sf, "embeddings"), "embedding", "label")
    return spark.createDataFrame([("label", val)], "labelling string, silhouette double").select(
        "labelling", S.fixed_round("silhouette", 6).alias("silhouette"))


def _ari_nmi_sql(truth: str, pred: str) -> str:
    return f"""c AS (SELECT {truth} AS t, {pred} AS p, count(*) AS n FROM b
           WHERE {truth} IS NOT NULL AND {pred} IS NOT NULL GROUP BY ALL),
x AS (SELECT sum(n * (n - 1) / 2.0) AS S, sum(n) AS N FROM c),
ta AS (SELECT t, sum(n) AS a FROM c GROUP BY t), pb AS (SELECT p, sum(n) AS b FROM c GROUP BY p),
aa AS (SELECT sum(a * (a - 1) / 2.0) AS A, count(*) AS kt FROM ta),
bb2 AS (SELECT sum(b * (b - 1) / 2.0) AS B, count(*) AS kp FROM pb),
mi AS (SELECT sum(c.n / x.N * ln(c.n * x.N / (ta.a * pb.b))) AS mi FROM c JOIN ta USING (t) JOIN pb USING (p), x),
ht AS (SELECT -sum(a / x.N * ln(a / x.N)) AS h FROM ta, x), hp AS (SELECT -sum(b / x.N * ln(b / x.N)) AS h FROM pb, x),
res AS (SELECT CASE WHEN (A + B) / 2.0 - A * B / (N * (N - 1) / 2.0) = 0 THEN 1.0
                    ELSE (S - A * B / (N * (N - 1) / 2.0)) / ((A + B) / 2.0 - A * B / (N * (N - 1) / 2.0)) END AS ari,
               CASE WHEN kt = 1 AND kp = 1 THEN 1.0 WHEN abs(mi) <= 1e-15 THEN 0.0
                    ELSE greatest(mi, 0.0) / ((ht.h + hp.h) / 2.0) END AS nmi
        FROM x, aa, bb2, mi, ht, hp)"""


@query("ari", "WITH " + O.clean_ctes() + ", " + _ari_nmi_sql("cohort_label", "loan_applied")
       + f" SELECT {O.rnd('ari', 6)} AS ari FROM res")
def q_ari(spark, sf):
    return V.ari_nmi(B(spark, sf), "cohort_label", "loan_applied").select(S.fixed_round("ari", 6).alias("ari"))


@query("nmi", "WITH " + O.clean_ctes() + ", " + _ari_nmi_sql("cohort_label", "loan_applied")
       + f" SELECT {O.rnd('nmi', 6)} AS nmi FROM res")
def q_nmi(spark, sf):
    return V.ari_nmi(B(spark, sf), "cohort_label", "loan_applied").select(S.fixed_round("nmi", 6).alias("nmi"))


COMPARED = {"client_type": "client_type", "loan_applied": "loan_applied", "referral_channel": "referral_channel"}


@query("model_comparison", "WITH " + O.clean_ctes() + ", " + " UNION ALL ".join(
    f"SELECT * FROM (WITH {_ari_nmi_sql('cohort_label', c)} SELECT '{name}' AS model, {O.rnd('ari', 6)} AS ari, "
    f"{O.rnd('nmi', 6)} AS nmi FROM res)" for name, c in COMPARED.items()).join(["SELECT * FROM (", ")"]))
def q_model_comparison(spark, sf):
    return V.model_comparison(B(spark, sf), "cohort_label", COMPARED)


# ───────────────────────── clustering, persistence, streaming (rows-only) ─────────────────────────

from segkit.plans import segmentation as SG  # noqa: E402

FINAL_K = 4


def _features_table(spark, sf):
    clean = clean_buyers(buyers_ordered(spark, sf))
    fm = fit_features(clean.df, NUMERIC, CATEGORICAL)
    return fm, SG.materialise(clean.df, fm, clean.df.count()), clean.imputer


@query("kmeans_fit")
def q_kmeans_fit(spark, sf):
    """K1: best of 20 restarts at k=4; labelled rows."""
    _fm, X, _ = _features_table(spark, sf)
    run = KM.kmeans_multi(X, "features", SG.KEY, [FINAL_K], n_init=20, max_iter=500)[FINAL_K]
    return KM.assign(X, run.centers, "features", "kmeans_cluster").select(SG.KEY, SG.LABEL, "kmeans_cluster")


@query("kmeans_convergence")
def q_kmeans_convergence(spark, sf):
    """K4: iterations, cost and size per cluster of the chosen run."""
    _fm, X, _ = _features_table(spark, sf)
    run = KM.kmeans_multi(X, "features", SG.KEY, [FINAL_K], n_init=20, max_iter=500)[FINAL_K]
    rows = [(c, int(n), float(run.cost), int(run.n_iter), bool(run.converged)) for c, n in enumerate(run.sizes)]
    return spark.createDataFrame(rows, "cluster int, size bigint, cost double, n_iter int, converged boolean")


@query("k_sweep")
def q_k_sweep(spark, sf):
    """K2 + V2: k = 2..8, 10 restarts each, linear silhouette of each k."""
    _fm, X, _ = _features_table(spark, sf)
    _runs, table, _ = SG.k_sweep(X, range(2, 9), n_init=10, max_iter=300)
    return spark.createDataFrame([(int(k), float(s), float(i), int(n), m) for k, s, i, n, m in table],
                                 "k int, silhouette double, inertia double, n_iter int, metric string")


@query("ward_micro")
def q_ward_micro(spark, sf):
    """K7: Ward over micro-clusters, cut at k=4; labelled rows."""
    _fm, X, _ = _features_table(spark, sf)
    from segkit.operators.ward import fit_ward
    w = fit_ward(X, "features", SG.KEY, FINAL_K)
    return w.transform(X, "features", "agglomerative_cluster").select(SG.KEY, SG.LABEL, "agglomerative_cluster")


@query("linkage")
def q_linkage(spark, sf):
    """K8: merge table (step, left, right, distance, size)."""
    _fm, X, _ = _features_table(spark, sf)
    from segkit.operators.ward import fit_ward
    return fit_ward(X, "features", SG.KEY, FINAL_K).linkage_frame(spark)


GIVEN_PASSES = 3


def _given_ctes(k: int) -> str:
    """c0 .. c3: centres after each pass from the k rows with the smallest md5; a0 .. a3: each row's nearest centre and its squared distance."""
    ctes = [f"""ex{k} AS MATERIALIZED (SELECT vec_id, unnest(v) AS x, unnest(generate_series(0, len(v) - 1)) AS dim
    FROM (SELECT vec_id, CAST(embedding AS DOUBLE[]) AS v FROM embeddings))""",
            f"""s{k} AS (SELECT vec_id, row_number() OVER (ORDER BY md5('start:' || CAST(vec_id AS varchar)), vec_id) - 1 AS cl FROM embeddings
    ORDER BY md5('start:' || CAST(vec_id AS varchar)), vec_id LIMIT {k})""",
            f"c{k}_0 AS MATERIALIZED (SELECT cl, dim, x AS cx FROM ex{k} JOIN s{k} USING (vec_id))"]
    for p in range(GIVEN_PASSES + 1):
        ctes.append(f"""a{k}_{p} AS MATERIALIZED (SELECT vec_id, arg_min(cl, (d2, cl)) AS cl, min(d2) AS d2 FROM (
        SELECT vec_id, cl, sum((x - cx) * (x - cx)) AS d2 FROM ex{k} JOIN c{k}_{p} USING (dim) GROUP BY vec_id, cl) GROUP BY vec_id)""")
        if p < GIVEN_PASSES:
            ctes.append(f"c{k}_{p + 1} AS MATERIALIZED (SELECT cl, dim, avg(x) AS cx FROM ex{k} JOIN a{k}_{p} USING (vec_id) GROUP BY cl, dim)")
    return ",\n".join(ctes)


def _given(spark, sf, ks):
    """Lloyd passes on the embeddings from given start rows, all k in the same passes."""
    e = _embeddings(spark, sf).persist()
    start = {k: KM.start_rows(e, "v", "vec_id", k) for k in ks}
    runs = KM.kmeans_specs(e, "v", "vec_id", [(k, k, 1, GIVEN_PASSES, 0) for k in ks], tol=-1.0, start=start)
    e.unpersist()
    return runs


@query("kmeans_given", f"""WITH {_given_ctes(FINAL_K)},
z AS (SELECT cl, count(*) AS n FROM a{FINAL_K}_{GIVEN_PASSES} GROUP BY cl),
o AS (SELECT z.cl, CAST(row_number() OVER (ORDER BY z.n DESC, c.cx, z.cl) - 1 AS integer) AS cluster
      FROM z JOIN c{FINAL_K}_{GIVEN_PASSES} c ON c.cl = z.cl AND c.dim = 0)
SELECT vec_id, cluster FROM a{FINAL_K}_{GIVEN_PASSES} JOIN o USING (cl)""")
def q_kmeans_given(spark, sf):
    """K1 with given start centres: labels after three passes."""
    run = _given(spark, sf, [FINAL_K])[FINAL_K]
    return KM.assign(_embeddings(spark, sf), run.centers, "v", "cluster").select("vec_id", "cluster")


@query("kmeans_passes", f"WITH {_given_ctes(FINAL_K)}\n" + " UNION ALL ".join(
    f"SELECT {p} AS pass, {O.rnd(f'(SELECT sum(d2) FROM a{FINAL_K}_{p})', 4)} AS cost, {O.rnd('sum((n.cx - o.cx) * (n.cx - o.cx))', 4)} AS shift "
    f"FROM c{FINAL_K}_{p} o JOIN c{FINAL_K}_{p + 1} n USING (cl, dim)" for p in range(GIVEN_PASSES)))
def q_kmeans_passes(spark, sf):
    """K4: cost and shift of the centres, pass by pass."""
    log = _given(spark, sf, [FINAL_K])[FINAL_K].log
    rows = spark.createDataFrame([(p, cost, shift) for p, (cost, _, shift) in enumerate(log)], "pass int, cost double, shift double")
    return rows.select("pass", S.fixed_round("cost", 4).alias("cost"), S.fixed_round("shift", 4).alias("shift"))


GIVEN_KS = (2, 3, 4)


@query("k_sweep_given", "WITH " + ",\n".join(_given_ctes(k) for k in GIVEN_KS) + "\n" + " UNION ALL ".join(
    f"SELECT {k} AS k, {O.rnd('sum(d2)', 4)} AS inertia FROM a{k}_{GIVEN_PASSES}" for k in GIVEN_KS))
def q_k_sweep_given(spark, sf):
    """K2 with given start centres: inertia of each k after three shared passes."""
    rows = spark.createDataFrame([(k, run.cost) for k, run in _given(spark, sf, GIVEN_KS).items()], "k int, inertia double")
    return rows.select("k", S.fixed_round("inertia", 4).alias("inertia"))


@query("ward_tree", f"""WITH ex AS (SELECT unnest(v) AS x, unnest(generate_series(0, len(v) - 1)) AS dim FROM (SELECT CAST(embedding AS DOUBLE[]) AS v FROM embeddings))
SELECT (SELECT count(DISTINCT embedding) FROM embeddings) - 1 AS merges, (SELECT count(*) FROM embeddings) AS root_size,
       {O.rnd('sum(ss)', 3)} AS between FROM (SELECT var_pop(x) * count(*) AS ss FROM ex GROUP BY dim)""")
def q_ward_tree(spark, sf):
    """K7 + K8 on the rows: merges, size of the last, and half the squared heights, which is the rows' sum of squares about their mean."""
    from segkit.operators.ward_rows import ward_rows
    _, merges = ward_rows(_embeddings(spark, sf), "v", finish=128)
    out = merges.agg(F.count(F.lit(1)).alias("merges"), F.max("size").alias("root_size"), (F.sum(F.col("distance") * F.col("distance")) / 2).alias("ss"))
    return out.select("merges", "root_size", S.fixed_round("ss", 3).alias("between"))


def _scored_ctes() -> str:
    """best: each cleaned buyer's nearest cohort centroid in the encoded space, by the norms and products of sparse rows."""
    ones = [f"SELECT client_id, cohort_label, '{c}_' || {c} AS feature, 1.0::DOUBLE AS value FROM b WHERE {c} = (SELECT max({c}) FROM b)" for c in BINARY]
    ones += [f"SELECT client_id, cohort_label, '{c}_' || {c}, 1.0::DOUBLE FROM b WHERE {c} IS NOT NULL" for c in MULTI]
    ones += [f"SELECT client_id, cohort_label, '{c}', (({c} - avg({c}) OVER ()) / stddev_pop({c}) OVER ())::DOUBLE FROM b" for c in NUMERIC]
    return O.clean_ctes() + f""",
lf AS MATERIALIZED ({" UNION ALL ".join(ones)}),
sz AS (SELECT cohort_label, count(*) AS n FROM b GROUP BY cohort_label),
ce AS MATERIALIZED (SELECT cohort_label AS cl, feature, sum(value) / any_value(n) AS c FROM lf JOIN sz USING (cohort_label) GROUP BY cohort_label, feature),
qn AS (SELECT cl, sum(c * c) AS q FROM ce GROUP BY cl),
pr AS (SELECT client_id, cl, sum(value * c) AS p FROM lf JOIN ce USING (feature) GROUP BY client_id, cl),
nu AS (SELECT cl, CAST(row_number() OVER (ORDER BY cl) - 1 AS integer) AS cluster FROM qn),
best AS (SELECT client_id, arg_min(cluster, (q - 2 * p, cluster)) AS cluster FROM pr JOIN qn USING (cl) JOIN nu USING (cl) GROUP BY client_id)"""


def _cohort_model(spark, sf):
    """Encoded buyers and a model whose centres are the cohorts' centroids, in the cohorts' order."""
    import numpy as np
    fm, X, imp = _features_table(spark, sf)
    rows = KM.centers_by(X, SG.LABEL, "features").orderBy(SG.LABEL).collect()  # one row a cohort
    centers = np.array([r["center"] for r in rows])
    return fm, X, imp, KM.KMeansRun(len(rows), 0, centers, 0.0, 0, [], True)


@query("save_load_given", f"WITH {_scored_ctes()}\nSELECT client_id, cluster FROM best")
def q_save_load_given(spark, sf):
    """S5 + S6 + K9 with the cohorts' centroids: saved, loaded, and new records scored."""
    from segkit.plans.clean import imputer_fill_dict
    from segkit.sources.artifacts import load_models, save_models
    from segkit.streaming.scoring import score
    fm, X, imp, run = _cohort_model(spark, sf)
    path = scratch_path(spark, "models")
    save_models(spark, path, fm, run, imputer_fills=imputer_fill_dict(imp))
    X.unpersist()
    loaded = load_models(spark, path)
    return score(dedup_buyers(buyers_ordered(spark, sf)), loaded["features"], loaded["kmeans"], loaded["imputer"]).select("client_id", "cluster")


@query("stream_given", f"WITH {_scored_ctes()}\nSELECT client_id, cluster FROM best")
def q_stream_given(spark, sf):
    """K10 with the cohorts' centroids: files of new records scored by a stream that is stopped and started again."""
    from segkit.plans.clean import imputer_fill_dict
    from segkit.streaming.scoring import score_stream
    fm, X, imp, run = _cohort_model(spark, sf)
    X.unpersist()
    new_rows = dedup_buyers(buyers_ordered(spark, sf))
    incoming, sink, ckpt = (scratch_path(spark, n) for n in ("incoming", "scored", "scored-ckpt"))
    half = F.pmod(F.xxhash64("client_id"), F.lit(2))
    for part in (0, 1):
        new_rows.where(half == part).repartition(2).write.mode("append").parquet(incoming)
        score_stream(spark, incoming, new_rows.schema, fm, run, sink, ckpt, imputer_fill_dict(imp)).awaitTermination()
    return spark.read.parquet(sink).select("client_id", "cluster")


@query("stream_drift", f"""WITH {_scored_ctes()},
j AS (SELECT best.cluster, age, satisfaction_score FROM b JOIN best USING (client_id))
""" + " UNION ALL ".join(f"""SELECT cluster, count(*) AS n, '{c}' AS "column", {O.rnd(f'avg({c})', 4)} AS mean, {O.rnd(f'stddev_pop({c})', 4)} AS deviation,
       {O.rnd(f'(avg({c}) - (SELECT avg({c}) FROM b)) / (SELECT stddev_pop({c}) FROM b)', 4)} AS drift FROM j GROUP BY cluster""" for c in NUMERIC))
def q_stream_drift(spark, sf):
    """Running segment sizes and feature drift in the state store, over a stream that is stopped and started again."""
    from segkit.plans.clean import imputer_fill_dict
    from segkit.streaming.scoring import latest_totals, segment_drift, stream_totals
    fm, X, imp, run = _cohort_model(spark, sf)
    X.unpersist()
    new_rows = dedup_buyers(buyers_ordered(spark, sf))
    incoming, totals, ckpt = (scratch_path(spark, n) for n in ("incoming", "totals", "totals-ckpt"))
    half = F.pmod(F.xxhash64("client_id"), F.lit(2))
    for part in (0, 1):
        new_rows.where(half == part).repartition(2).write.mode("append").parquet(incoming)
        stream_totals(spark, incoming, new_rows.schema, fm, run, totals, ckpt, imputer_fill_dict(imp)).awaitTermination()
    out = segment_drift(latest_totals(spark, totals, fm), fm)
    return out.select("cluster", "n", "column", *[S.fixed_round(c, 4).alias(c) for c in ("mean", "deviation", "drift")])


@query("export_given", f"WITH {_scored_ctes()}\nSELECT b.client_id, b.cohort_label, best.cluster, b.age, b.country FROM b JOIN best USING (client_id)")
def q_export_given(spark, sf):
    """S4 with the cohorts' centroids: the labelled table as CSV and back."""
    _fm, X, _, run = _cohort_model(spark, sf)
    labelled = KM.assign(X, run.centers, "features", "cluster").select("client_id", "cohort_label", "cluster", "age", "country")
    path = scratch_path(spark, "labelled-given")
    csv_io.write_csv(labelled, path)
    X.unpersist()
    return csv_io.read_csv(spark, path, labelled.schema)


@query("csv_inferred", """SELECT p_partkey, p_name, p_brand, CAST(p_size AS bigint) AS p_size, p_retailprice, CAST(p_size > 25 AS boolean) AS large,
       date '2024-01-01' + CAST(p_size AS integer) AS listed, CAST(NULL AS varchar) AS nothing FROM part""")
def q_csv_inferred(spark, sf):
    """A CSV table read back with the types of its values."""
    part = T(spark, sf, "part").select("p_partkey", "p_name", "p_brand", "p_size", "p_retailprice", (F.col("p_size") > 25).alias("large"),
                                       F.date_add(F.lit("2024-01-01").cast("date"), F.col("p_size")).alias("listed"), F.lit(None).cast("string").alias("nothing"))
    return csv_io.read_csv_inferred(spark, csv_io.write_csv(part, scratch_path(spark, "csv-inferred")))


@query("save_load_score")
def q_save_load_score(spark, sf):
    """S5 + S6 + K9: save artefacts, load them back, score; ``same`` checks the round trip."""
    from segkit.plans.clean import imputer_fill_dict
    from segkit.sources.artifacts import load_models, save_models
    from segkit.streaming.scoring import score
    fm, X, imp = _features_table(spark, sf)
    run = KM.kmeans_multi(X, "features", SG.KEY, [FINAL_K], n_init=20, max_iter=500)[FINAL_K]
    path = scratch_path(spark, "models")
    save_models(spark, path, fm, run, imputer_fills=imputer_fill_dict(imp))
    loaded = load_models(spark, path)
    before = KM.assign(X, run.centers, "features", "before").select(SG.KEY, "before")
    raw_new = dedup_buyers(buyers_ordered(spark, sf))
    after = score(raw_new, loaded["features"], loaded["kmeans"], loaded["imputer"])
    return after.join(before, SG.KEY).select(SG.KEY, "cluster", (F.col("cluster") == F.col("before")).alias("same"))


@query("stream_score")
def q_stream_score(spark, sf):
    """Structured Streaming scorer over new buyer files (availableNow trigger)."""
    from segkit.plans.clean import imputer_fill_dict
    from segkit.streaming.scoring import score_stream
    fm, X, imp = _features_table(spark, sf)
    run = KM.kmeans_multi(X, "features", SG.KEY, [FINAL_K], n_init=20, max_iter=500)[FINAL_K]
    incoming = scratch_path(spark, "incoming")
    new_rows = dedup_buyers(buyers_ordered(spark, sf))
    new_rows.repartition(4).write.mode("overwrite").parquet(incoming)
    sink, ckpt = scratch_path(spark, "scored"), scratch_path(spark, "scored-ckpt")
    q = score_stream(spark, incoming, new_rows.schema, fm, run, sink, ckpt, imputer_fill_dict(imp),
                     max_files_per_trigger=2)
    q.awaitTermination()
    return spark.read.parquet(sink)


@query("segmentation_report")
def q_segmentation_report(spark, sf):
    """V6: full run (k sweep → choice → k-means + Ward); k-means cluster profile with top country."""
    seg = SG.segment(buyers_ordered(spark, sf))
    return SG.cluster_report(seg, "kmeans_cluster")


@query("export_labelled")
def q_export_labelled(spark, sf):
    """Labelled table (clean columns + truth + both model labels) to CSV and back."""
    seg = SG.segment(buyers_ordered(spark, sf))
    cols = [c for c in seg.labelled.columns if c != "features"]
    path = scratch_path(spark, "labelled")
    csv_io.write_csv(seg.labelled.select(*cols), path)
    schema = seg.labelled.select(*cols).schema
    return csv_io.read_csv(spark, path, schema)


# ───────────────────────── invariants, dashboard cache, run report (Q6, S7, V6) ─────────────────────────

@query("cohort_size_total", O.with_raw("""
SELECT CAST(count(*) AS bigint) AS n_groups, CAST(sum(n) AS bigint) AS total,
       (SELECT count(*) FROM r) AS expected, sum(n) = (SELECT count(*) FROM r) AS matches
FROM (SELECT cohort_label, count(*) AS n FROM r GROUP BY cohort_label)"""))
def q_cohort_size_total(spark, sf):
    return Q.group_total_check(buyers_raw(spark, sf), "cohort_label")


@query("dashboard_kpi", O.with_clean(f"""
SELECT count(*) AS rows, {O.rnd('avg(satisfaction_score)', 2)} AS avg_score,
       CASE WHEN {O.rnd('avg(satisfaction_score)', 2)} > 3.5 THEN 'above' ELSE 'below' END AS score_band,
       {O.rnd(f"sum({_ind('loan_applied', 'Yes')}) * 100.0 / count(*)", 1)} AS flag_pct,
       (SELECT 'Segment ' || CAST(referral_channel_rank AS varchar) FROM (
           SELECT satisfaction_score AS referral_channel_rank, count(*) AS c FROM b
           WHERE country IN ('NATION_1','NATION_2','NATION_3','NATION_4','NATION_5','NATION_6')
           GROUP BY satisfaction_score ORDER BY c DESC, 'Segment ' || CAST(satisfaction_score AS varchar) LIMIT 1)) AS dominant,
       {O.rnd('(SELECT max(c) FROM (SELECT count(*) AS c FROM b WHERE country IN (' + "'NATION_1','NATION_2','NATION_3','NATION_4','NATION_5','NATION_6'" + ') GROUP BY satisfaction_score)) * 100.0 / count(*)', 1)} AS dominant_pct
FROM b WHERE country IN ('NATION_1','NATION_2','NATION_3','NATION_4','NATION_5','NATION_6')"""))
def q_dashboard_kpi(spark, sf):
    """S7 + F3 + A9: cached dashboard table, country selection, overview KPI (score bands as segments)."""
    from segkit.plans.dashboard import Dashboard
    dash = Dashboard(B(spark, sf), "satisfaction_score").prepared()   # one panel: nothing to cache
    sel = {"country": [f"NATION_{i}" for i in range(1, 7)], "client_type": "All"}
    return dash.overview(sel)["kpi"]


def _dashboard(spark, sf):
    from segkit.plans.dashboard import Dashboard
    return Dashboard(B(spark, sf), "satisfaction_score", SEGMENT_DISPLAY).prepared()


IN_NATIONS = "country IN ('NATION_1', 'NATION_2', 'NATION_3')"
NATIONS = {"country": ["NATION_1", "NATION_2", "NATION_3"], "acquisition_purpose": "All", "client_type": "All"}


@query("dashboard_options", O.with_clean(f"""
SELECT DISTINCT 'acquisition_purpose' AS dimension, acquisition_purpose AS value FROM b UNION ALL
SELECT DISTINCT 'client_type', client_type FROM b UNION ALL SELECT DISTINCT 'country', country FROM b UNION ALL
SELECT DISTINCT 'region', region FROM b WHERE {IN_NATIONS}"""))
def q_dashboard_options(spark, sf):
    """F6 + F7: the filter lists; regions only of the chosen countries."""
    return _dashboard(spark, sf).options(NATIONS)


@query("dashboard_satisfaction", O.with_clean(f"""
SELECT 'Segment ' || CAST(age % 3 AS varchar) AS cluster_name, CAST(min(satisfaction_score) AS double) AS min_value,
       {O.rnd('quantile_cont(satisfaction_score, 0.25)', 4)} AS q1, {O.rnd('quantile_cont(satisfaction_score, 0.5)', 4)} AS median,
       {O.rnd('quantile_cont(satisfaction_score, 0.75)', 4)} AS q3, CAST(max(satisfaction_score) AS double) AS max_value, count(*) AS n
FROM b WHERE {IN_NATIONS} GROUP BY 1"""))
def q_dashboard_satisfaction(spark, sf):
    """Spread of the satisfaction score per segment (ages modulo 3 as segments)."""
    from segkit.plans.dashboard import Dashboard
    b = B(spark, sf).withColumn("segment", F.col("age") % 3)
    return Dashboard(b, "segment").prepared().investors(NATIONS)["satisfaction_spread"]


@query("dashboard_cohort_profile", O.with_clean(f"""
SELECT *, row_number() OVER (ORDER BY size DESC, cohort_display) AS place FROM (
  SELECT {_map_sql('cohort_label', SEGMENT_DISPLAY, True)} AS cohort_display, count(*) AS size, {O.rnd('avg(age)', 1)} AS avg_age,
         {O.rnd('avg(satisfaction_score)', 2)} AS avg_score, {O.rnd(f"avg({_ind('client_type', 'Corporate')}) * 100", 1)} AS corporate_pct,
         {O.rnd(f"avg({_ind('acquisition_purpose', 'Investment')}) * 100", 1)} AS investment_pct,
         {O.rnd(f"avg({_ind('loan_applied', 'Yes')}) * 100", 1)} AS loan_pct FROM b GROUP BY 1)"""))
def q_dashboard_cohort_profile(spark, sf):
    """A3 + O1: profile per display name, largest first (place tells the order)."""
    return _dashboard(spark, sf).insights(["HOUSEHOLD"])["cohort_profile"]


@query("dashboard_sample", O.with_clean("""
SELECT client_id, age, satisfaction_score, 'Segment ' || CAST(satisfaction_score AS varchar) AS cluster_name, country, acquisition_purpose
FROM b ORDER BY md5('sample:' || client_id), client_id LIMIT 1500"""))
def q_dashboard_sample(spark, sf):
    """The scatter panel's rows, with country and purpose."""
    return _dashboard(spark, sf).investors()["sample"]


@query("cube_satisfaction", ORACLE["dashboard_satisfaction"])
def q_cube_satisfaction(spark, sf):
    """S7 + A13 from the cube: the satisfaction panel without the rows."""
    from segkit.plans.cube import DashboardCube
    from segkit.plans.dashboard import Dashboard
    dash = Dashboard(B(spark, sf).withColumn("segment", F.col("age") % 3), "segment").prepared()
    return DashboardCube.build(dash).investors(NATIONS)["satisfaction_spread"]


@query("cube_kpi", ORACLE["dashboard_kpi"])
def q_cube_kpi(spark, sf):
    """S7 + F3 + A9 from the cube."""
    from segkit.plans.cube import DashboardCube
    sel = {"country": [f"NATION_{i}" for i in range(1, 7)], "client_type": "All"}
    return DashboardCube.build(_dashboard(spark, sf)).overview(sel)["kpi"]


@query("cube_cohort_profile", ORACLE["dashboard_cohort_profile"])
def q_cube_cohort_profile(spark, sf):
    """S7 + A3 from the cube."""
    from segkit.plans.cube import DashboardCube
    return DashboardCube.build(_dashboard(spark, sf)).insights(["HOUSEHOLD"])["cohort_profile"]


@query("cube_sample", ORACLE["dashboard_sample"])
def q_cube_sample(spark, sf):
    """S7 + O5 from the cube."""
    from segkit.plans.cube import DashboardCube
    return DashboardCube.build(_dashboard(spark, sf)).investors()["sample"]


@query("dashboard_model_info", O.with_clean(f"""
SELECT (SELECT count(DISTINCT satisfaction_score) FROM b) AS clusters, count(*) AS rows, count(*) = 0 AS empty FROM b WHERE {IN_NATIONS}"""))
def q_dashboard_model_info(spark, sf):
    """A17 + F9: number of clusters in the table, rows of the selection, and whether it is empty."""
    return _dashboard(spark, sf).info(NATIONS)


@query("sort_groups_places", O.with_clean("""
SELECT cohort_label, n, row_number() OVER (ORDER BY n DESC, cohort_label) AS place FROM (SELECT cohort_label, count(*) AS n FROM b GROUP BY cohort_label)"""))
def q_sort_groups_places(spark, sf):
    """O1 with the order as a column."""
    return P.with_places(P.group_size(B(spark, sf), "cohort_label"), [F.desc("n"), F.asc("cohort_label")])


@query("score_distribution_places", O.with_clean("""
SELECT satisfaction_score, n, row_number() OVER (ORDER BY satisfaction_score) AS place
FROM (SELECT satisfaction_score, count(*) AS n FROM b GROUP BY satisfaction_score)"""))
def q_score_distribution_places(spark, sf):
    """O2 with the order as a column."""
    counts = B(spark, sf).groupBy("satisfaction_score").agg(F.count(F.lit(1)).alias("n"))
    return P.with_places(counts, [F.asc("satisfaction_score")])


@query("hash_shuffle_places", """SELECT c_custkey, row_number() OVER (ORDER BY md5('shuffle:' || CAST(c_custkey AS varchar)), c_custkey) AS place FROM customer""")
def q_hash_shuffle_places(spark, sf):
    """O6 with the order as a column."""
    from segkit.functions.hashing import hash_rank_key
    return P.with_places(T(spark, sf, "customer").select("c_custkey"), [hash_rank_key("shuffle", "c_custkey"), F.asc("c_custkey")])


@query("run_report")
def q_run_report(spark, sf):
    """V6: validation block of the full run report (ARI, NMI, silhouette per model)."""
    from segkit.plans.report import run_report
    seg = SG.segment(buyers_ordered(spark, sf))
    return run_report(seg)["validation"]
