"""The dashboard cube answers every panel as the rows do; places; the sampled silhouette's bounds; running totals of a stream."""

import pytest
from pyspark.sql import functions as F

from segkit.operators import profile as P
from segkit.operators.sampled_silhouette import silhouette_sampled
from segkit.operators.validate import silhouette_exact, silhouette_squared, silhouettes_squared
from segkit.plans.cube import DashboardCube
from segkit.plans.dashboard import Dashboard
from segkit.plans import catalog as C
from tests.conftest import SF_SMALL

COHORTS = ["HOUSEHOLD", "MACHINERY", "NO SUCH"]
SELECTIONS = [None, {"country": ["NATION_1", "NATION_7"], "region": ["NATION_1/1", "NATION_7/2"], "client_type": "Corporate"},
              {"country": ["nowhere"]}]


def panels(d, selection):
    return {**d.overview(selection), **d.investors(selection), **d.geography(selection), **d.insights(COHORTS, selection)}


def rows(df):
    return sorted((tuple(sorted(r.asDict().items())) for r in df.collect()), key=str)


@pytest.fixture(scope="module")
def dash(spark):
    b = C.B(spark, SF_SMALL).withColumn("segment", F.when(F.col("age") % 7 != 0, F.col("age") % 3))   # some rows without a segment
    holes = b.withColumn("satisfaction_score", F.when(F.col("age") % 5 != 0, F.col("satisfaction_score"))) \
             .withColumn("region", F.when(F.col("age") % 11 != 0, F.col("region")))
    return Dashboard.load(holes, "segment", C.SEGMENT_DISPLAY)


@pytest.fixture(scope="module")
def cube(dash):
    return DashboardCube.build(dash)


@pytest.mark.parametrize("selection", SELECTIONS, ids=str)
def test_panels_equal_those_of_the_rows(dash, cube, selection):
    direct, merged = panels(dash, selection), panels(cube, selection)
    assert set(direct) == set(merged)
    for name in direct:
        assert dict(direct[name].dtypes) == dict(merged[name].dtypes) or name.endswith("spread"), name
        assert rows(direct[name]) == rows(merged[name]), name
    assert dash.empty(selection) == cube.empty(selection)
    assert rows(dash.share(selection or {})) == rows(cube.share(selection or {}))


def test_cubes_of_two_halves_merge(dash, cube):
    half = F.pmod(F.xxhash64("client_id"), F.lit(2))
    parts = [DashboardCube.build(Dashboard(dash.table.where(half == i), dash.cluster, dash.labels)) for i in (0, 1)]
    both = parts[0].merged(parts[1])
    want, got = panels(cube, {"client_type": "Corporate"}), panels(both, {"client_type": "Corporate"})
    for name in ("kpi", "age_spread", "sample", "heat", "profile_top", "radar", "score_histogram"):
        assert rows(want[name]) == rows(got[name]), name


def test_unknown_dimension_raises(cube):
    with pytest.raises(ValueError):
        cube.overview({"gender": "Female"})


def test_empty_table(spark, dash):
    none = DashboardCube.build(Dashboard(dash.table.where("false"), dash.cluster, dash.labels))
    assert none.empty()
    want, got = panels(Dashboard(dash.table.where("false"), dash.cluster, dash.labels), None), panels(none, None)
    for name in ("kpi", "cluster_share", "age_spread", "sample", "heat", "cards", "score_histogram"):
        assert rows(want[name]) == rows(got[name]), name


def test_places(spark):
    df = spark.range(5000).select((F.col("id") * 7919 % 5000).alias("v")).repartition(7)
    got = P.with_places(df, [F.desc("v")]).collect()
    assert sorted((r["place"], r["v"]) for r in got) == [(i + 1, 4999 - i) for i in range(5000)]
    assert P.with_places(df.where("false"), [F.desc("v")]).collect() == []


def test_sampled_silhouette(spark):
    e = spark.read.parquet(f"{SF_SMALL}/embeddings.parquet")
    exact = silhouette_exact(e, "embedding", ["label"], "vec_id").first()["silhouette"]
    whole = silhouette_sampled(e, "embedding", "label", "vec_id", per_cluster=100_000).first()
    assert whole["silhouette"] == pytest.approx(exact, abs=1e-9) and whole["low"] == pytest.approx(exact, abs=1e-9) == whole["high"]
    for m in (8, 40):   # so few rows say nothing here, and the bounds say so
        r = silhouette_sampled(e, "embedding", "label", "vec_id", per_cluster=m).first()
        assert r["low"] <= exact <= r["high"] and r["low"] <= r["silhouette"] <= r["high"]
    # clusters far apart: the bounds say something
    far = spark.range(4000).select("id", (F.col("id") % 2).alias("g"), F.array((F.col("id") % 2) * 50.0, F.rand(3)).alias("v")).cache()
    exact = silhouette_exact(far, "v", ["g"], "id").first()["silhouette"]
    r = silhouette_sampled(far, "v", "g", "id", per_cluster=800).first()
    assert r["low"] <= exact <= r["high"] and r["high"] - r["low"] < 0.2 and abs(r["silhouette"] - exact) < 0.01
    one = silhouette_sampled(far.withColumn("g", F.lit(1)), "v", "g", "id").first()
    assert (one["silhouette"], one["low"], one["high"]) == (0.0, 0.0, 0.0)


def test_squared_silhouettes_in_two_passes(spark):
    e = spark.read.parquet(f"{SF_SMALL}/embeddings.parquet").select("vec_id", "embedding", "label", (F.col("label") % 3).alias("three"),
                                                                   F.when(F.col("vec_id") % 4 > 0, F.col("label") % 2).alias("some"), F.lit(1).alias("one"))
    got = silhouettes_squared(e, "embedding", ["label", "three", "some", "one"])
    for c in ("label", "three", "some"):
        assert got[c] == pytest.approx(silhouette_squared(e, "embedding", c), abs=1e-9)
    assert got["one"] == 0.0
    assert silhouettes_squared(e.where("false"), "embedding", ["label"]) == {"label": 0.0}


def test_stream_totals_go_on_after_a_restart(spark):
    from segkit.plans.clean import dedup_buyers, imputer_fill_dict
    from segkit.session import scratch_path
    from segkit.sources.fixtures import buyers_ordered
    from segkit.streaming.scoring import latest_totals, scored_rows, stream_totals
    fm, X, imp, run = C._cohort_model(spark, SF_SMALL)
    fills, new = imputer_fill_dict(imp), dedup_buyers(buyers_ordered(spark, SF_SMALL))
    incoming, totals, ckpt = (scratch_path(spark, n) for n in ("t-in", "t-out", "t-ckpt"))

    def batch(rows):
        return sorted((r["cluster"], r["n"], r["s"]) for r in scored_rows(rows, fm, run, fills).groupBy("cluster").agg(F.count("*").alias("n"), F.sum("age").alias("s")).collect())

    def stream():
        return sorted((r["cluster"], r["n"], int(r["sum_age"])) for r in latest_totals(spark, totals, fm).collect())
    third = F.pmod(F.xxhash64("client_id"), F.lit(3))
    for i in range(3):
        new.where(third == i).repartition(3).write.mode("append").parquet(incoming)
        stream_totals(spark, incoming, new.schema, fm, run, totals, ckpt, fills, max_files_per_trigger=2).awaitTermination()
        assert stream() == batch(new.where(third <= i))
    # started again with nothing new: nothing is counted twice; a batch folder of a write that was cut off (no file yet) is not seen
    stream_totals(spark, incoming, new.schema, fm, run, totals, ckpt, fills).awaitTermination()
    assert stream() == batch(new)
    X.unpersist()
