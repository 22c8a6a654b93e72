"""Plan hygiene: the physical plans keep the properties the design relies on."""

import __spark_entry__ as E
from tests.conftest import SF_MID


def plan(spark, name):
    df = E.queries()[name](spark, SF_MID)
    return df._jdf.queryExecution().executedPlan().toString()


def test_dim_lookup_prunes_columns_and_broadcasts_small_dimensions(spark):
    p = plan(spark, "dim_lookup")
    assert "BroadcastHashJoin" in p
    assert "o_orderdate" not in p and "o_orderpriority" not in p   # only the needed order columns are read


def test_top_n_and_sample_are_take_ordered(spark):
    assert "TakeOrderedAndProject" in plan(spark, "top_n")
    assert "TakeOrderedAndProject" in plan(spark, "fixed_sample")


def test_top_n_semi_join_broadcasts_the_bounded_side(spark):
    p = plan(spark, "topn_semi_join")
    assert "LeftSemi" in p and "BroadcastExchange" in p


def test_features_stay_in_codegen(spark):
    df = E.queries()["feature_vector_norm"](spark, SF_MID)
    df.collect()
    p = df._jdf.queryExecution().executedPlan().toString()   # final adaptive plan
    assert "isFinalPlan=true" in p and "*(" in p
    assert "ArrowEvalPython" not in p and "BatchEvalPython" not in p   # no Python in the encoding


def test_rollup_is_one_expand_not_unions(spark):
    p = plan(spark, "hierarchy_rollup")
    assert "Expand" in p and "Union" not in p.split("Expand")[0]


def test_lookup_joins_start_no_job_of_their_own(spark):
    from segkit.operators.joins import lookup_join
    from segkit.sources.tables import read_table
    for name in ("dim_lookup", "wcss"):
        assert "GlobalLimit" not in plan(spark, name)
    prev = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    try:
        o = read_table(spark, SF_MID, "orders").select("o_custkey")
        c = read_table(spark, SF_MID, "customer").selectExpr("c_custkey AS o_custkey")
        small = lookup_join(o, c, on="o_custkey", how="inner")
        assert "BroadcastHashJoin" in small._jdf.queryExecution().executedPlan().toString()
        n = small.count()
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")   # a side beyond the threshold is shuffled
        big = lookup_join(o, c, on="o_custkey", how="inner")
        assert "SortMergeJoin" in big._jdf.queryExecution().executedPlan().toString()
        assert n == big.count()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", prev)


def test_hot_key_is_reduced_map_side(spark):
    """One key holds a third of all rows: dedup and group-mode stay correct and
    their plans aggregate partially before the shuffle."""
    from pyspark.sql import functions as F
    from segkit.operators import dedup, profile as P
    n = 30_000
    df = (spark.range(n).select(
        F.when(F.col("id") % 3 == 0, F.lit("HOT")).otherwise(F.concat(F.lit("k"), F.col("id").cast("string")))
         .alias("key"),
        F.col("id").alias("seq"),
        (F.col("id") % 5).cast("string").alias("v")).repartition(8))
    kept = dedup.dedup_keep_first(df, ["key"], "seq")
    plan = kept._jdf.queryExecution().executedPlan().toString()
    assert "partial_min" in plan
    hot = kept.where("key = 'HOT'").first()
    assert hot["seq"] == 0 and hot["v"] == "0"
    assert kept.count() == 1 + (n - n // 3)
    mode = P.group_mode(df, "key", "v")
    assert "partial_count" in mode._jdf.queryExecution().executedPlan().toString()
    assert mode.where("key = 'HOT'").first()["top_v"] == "0"   # ids 0,3,..: v = id % 5 spreads evenly; tie → "0"
