"""Aggregates that hold no group's values in one buffer or window."""

import re

import numpy as np
import pytest

from segkit.operators import dedup, profile as P


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def test_quartiles_equal_numpy_for_any_group(spark):
    rng = np.random.default_rng(2)
    values = {"hot": rng.integers(0, 400, 3000).tolist(), "one": [5], "two": [1, 2], "ties": [7] * 50 + [9] * 3, "floats": None}
    rows = [(g, float(x)) for g, v in values.items() if v for x in v] + [("hot", None), ("empty", None), (None, 3.0)]
    df = spark.createDataFrame(rows, "g string, x double").repartition(7)
    got = {r["g"]: r for r in P.five_number(df, "g", "x").collect()}
    assert set(got) == {"hot", "one", "two", "ties", "empty"}
    for g, v in values.items():
        if v:
            r = got[g]
            assert [r["min_value"], r["q1"], r["median"], r["q3"], r["max_value"]] == pytest.approx([min(v), *np.percentile(v, [25, 50, 75]).round(4), max(v)], abs=1e-4)
            assert r["n"] == len(v) + (g == "hot")
    assert got["empty"]["n"] == 1 and got["empty"]["median"] is None


def test_places_do_not_depend_on_the_cut(spark):
    rows = [("a", i % 97) for i in range(2000)] + [("b", i % 5) for i in range(30)]
    df = spark.createDataFrame(rows, "g string, x int")
    first = sorted(map(tuple, P.value_places(df, "g", "x").collect()))
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        assert sorted(map(tuple, P.value_places(df.repartition(11), "g", "x").collect())) == first
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
    seen = {}
    for g, x, n, before, total in first:
        assert before == seen.get(g, 0)
        seen[g] = before + n
    assert seen == {"a": 2000, "b": 30}


def test_plans_have_no_expand_percentile_or_window_over_a_group(spark):
    df = spark.createDataFrame([("a", "x", 1), ("a", "y", 2), ("b", "x", 1)], "g string, v string, n int")
    assert "Expand" not in plan(P.distinct_counts(df, ["g", "v", "n"]))
    assert "Expand" not in plan(dedup.duplicate_report(df, ["g", "v"]))
    assert "percentile" not in plan(P.five_number(df, "g", "n"))
    for out in (P.share_within(df, "g", "v"), P.purity(df, "g", "v")):
        assert not re.search(r"\bWindow\b", plan(out))


def test_distinct_counts_of_null_and_empty_columns(spark):
    df = spark.createDataFrame([("a", None, 1), ("a", None, 1)], "g string, v string, n int")
    assert {r["column"]: r["distinct_values"] for r in P.distinct_counts(df, ["g", "v", "n"]).collect()} == {"g": 1, "v": 0, "n": 1}
    assert {r["distinct_values"] for r in P.distinct_counts(df, ["g", "n"], approx=True).collect()} == {1}
    assert tuple(dedup.duplicate_report(df.limit(0), ["g"]).first()) == (0, 0, 0, 0)


def test_purity_runner_up_and_single_class(spark):
    rows = [(1, "a")] * 3 + [(1, "b")] * 3 + [(1, "c")] + [(2, "z")] * 2
    df = spark.createDataFrame(rows, "k int, t string")
    got = {r["k"]: (r["size"], r["dominant"], float(r["purity"]), r["runner_up"], r["runner_up_share"] and float(r["runner_up_share"])) for r in P.purity(df, "k", "t").collect()}
    assert got == {1: (7, "a", pytest.approx(0.4286), "b", pytest.approx(0.4286)), 2: (2, "z", 1.0, None, None)}
