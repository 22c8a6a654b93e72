"""Edge cases of the relational operators on small literal frames."""

import pytest
from pyspark.sql import functions as F

from segkit.functions import scalar as S
from segkit.operators import dedup, profile as P, quality as Q, slicing as SL
from segkit.operators.impute import ConditionalMode, Rule, column_modes, fit_imputer
from segkit.sources.tables import SchemaContractError, MissingInputError, read_table, require_columns


def test_mode_tie_goes_to_smallest(spark):
    df = spark.createDataFrame([("b",), ("a",), ("a",), ("b",), (None,), (None,), (None,)], "c string")
    assert column_modes(df, ["c"]) == {"c": "a"}


def test_null_group_keys_dropped_unless_asked(spark):
    df = spark.createDataFrame([("x",), (None,), ("x",)], "g string")
    assert {r["g"] for r in P.group_size(df, "g").collect()} == {"x"}
    assert {r["g"] for r in P.group_size(df, "g", keep_null=True).collect()} == {"x", None}


def test_group_mode_tie_and_hot_group(spark):
    rows = [("hot", "b")] * 30 + [("hot", "a")] * 30 + [("cold", "z")]
    df = spark.createDataFrame(rows, "g string, c string").repartition(7)
    got = {r["g"]: (r["top_c"], r["top_c_n"]) for r in P.group_mode(df, "g", "c").collect()}
    assert got == {"hot": ("a", 30), "cold": ("z", 1)}


def test_keep_first_by_order_column(spark):
    df = spark.createDataFrame([("k", 2, "late"), ("k", 1, "early"), ("j", 5, "only")],
                               "key string, seq int, v string").repartition(3)
    got = {r["key"]: r["v"] for r in dedup.dedup_keep_first(df, ["key"], "seq").collect()}
    assert got == {"k": "early", "j": "only"}


def test_full_dedup_nulls_equal_and_carried_label(spark):
    df = spark.createDataFrame([("a", None, "L2", 1), ("a", None, "L1", 2), ("b", "x", "L3", 3), ("b", "x", "L0", 9)],
                               "id string, v string, label string, seq int").repartition(3)
    out = {(r["id"], r["label"]) for r in dedup.dedup_full(df, exclude=["label"], order_by="seq").collect()}
    assert out == {("a", "L2"), ("b", "L3")}   # the first row's own label, not the smallest
    with pytest.raises(ValueError):
        dedup.dedup_full(df, exclude=["label"])


def test_imputer_rule_conditional_global(spark):
    df = spark.createDataFrame([
        ("Corporate", None, None), ("Individual", None, "r1"), ("Individual", "Male", None),
        ("Individual", "Female", "r1"), ("Individual", "Female", "r2"), ("Corporate", "Male", "r2"),
    ], "client_type string, gender string, region string")
    m = fit_imputer(df, rules=[Rule("gender", F.col("client_type") == "Corporate", "Not Applicable")],
                    conditional=[ConditionalMode("gender", F.col("client_type") == "Individual")],
                    mode_columns=["region"])
    out = m.transform(df).collect()
    assert [r["gender"] for r in out] == ["Not Applicable", "Female", "Male", "Female", "Female", "Male"]
    assert all(r["region"] in ("r1", "r2") for r in out)
    assert m.global_fills == {"region": "r1"}


def test_bad_date_is_null_and_age_truncates(spark):
    df = spark.createDataFrame([("2002-01-10",), ("not a date",), ("1950-01-01",)], "d string")
    ages = [r["a"] for r in df.select(S.whole_years(S.safe_date("d")).alias("a")).collect()]
    assert ages == [21, None, 73]  # 27027 days / 365.25 = 73.997 → 73


def test_empty_selection_means_no_filter_and_empty_guard(spark):
    df = spark.createDataFrame([("a", 1), ("b", 2)], "c string, n int")
    assert SL.slice_rows(df, {"c": [], "n": "All"}).count() == 2
    assert SL.is_empty(SL.slice_rows(df, {"c": ["zzz"]}))
    share = SL.slice_share(df.where("false"), {"c": ["a"]}).first()
    assert share["total"] == 0 and share["selected_pct"] is None


def test_histogram_has_empty_bins(spark):
    df = spark.createDataFrame([("g", 1), ("g", 5), ("h", 3)], "grp string, x int")
    out = {(r["grp"], r["bin"]): r["n"] for r in P.histogram(df, "grp", "x", 0.5, 1.0, 5).collect()}
    assert len(out) == 10 and out[("g", 1)] == 0 and out[("g", 4)] == 1 and out[("h", 2)] == 1


def test_cluster_sizes_include_empty(spark):
    df = spark.createDataFrame([(0,), (0,), (2,)], "p int")
    assert {r["p"]: r["n"] for r in P.cluster_sizes(df, "p", 4).collect()} == {0: 2, 1: 0, 2: 1, 3: 0}


def test_purity_single_class_has_no_runner_up(spark):
    df = spark.createDataFrame([(0, "a"), (0, "a"), (1, "a"), (1, "b")], "c int, t string")
    got = {r["c"]: r for r in P.purity(df, "c", "t").collect()}
    assert got[0]["runner_up"] is None and got[0]["purity"] == 1.0
    assert got[1]["dominant"] == "a" and got[1]["purity"] == 0.5


def test_required_columns_and_missing_input(spark):
    df = spark.createDataFrame([(1,)], "a int")
    with pytest.raises(SchemaContractError):
        require_columns(df, ["a", "b"])
    with pytest.raises(MissingInputError):
        read_table(spark, "/root/testdata/does-not-exist", "customer")


def test_domain_and_null_inventory(spark):
    df = spark.createDataFrame([("x", None), ("bad", 1), (None, 2)], "c string, n int")
    assert [(r["column"], r["value"], r["n"]) for r in Q.domain_violations(df, {"c": ["x"]}).collect()] == [("c", "bad", 1)]
    inv = {r["column"]: (r["nulls"], r["null_pct"]) for r in Q.null_inventory(df).collect()}
    assert inv == {"c": (1, 33.3), "n": (1, 33.3)}


def test_fixed_sample_is_partition_independent(spark):
    o = read_table(spark, "/root/testdata/sf0.01", "orders").select("o_orderkey")
    a = {r[0] for r in P.fixed_sample(o, "o_orderkey", 100).collect()}
    b = {r[0] for r in P.fixed_sample(o.repartition(13), "o_orderkey", 100).collect()}
    assert a == b and len(a) == 100


def test_fixed_sample_is_the_smallest_hashes(spark):
    import hashlib
    o = read_table(spark, "/root/testdata/sf0.01", "orders").select("o_orderkey")
    got = [r[0] for r in P.fixed_sample(o, "o_orderkey", 300).collect()]
    want = sorted((hashlib.md5(f"sample:{r[0]}".encode()).hexdigest(), r[0]) for r in o.collect())[:300]
    assert got == [k for _, k in want]


def test_two_pass_dedup_keeps_the_first_row_on_near_copies(spark):
    rows = [("k1", "d", "L2", "x", 5), ("k1", "d", "L1", "x", 6), ("k1", "d", "L3", "a", 7), ("Zeta", "z", "x", "p", 1), ("Zeta", "z", "w", "a", 2),
            ("k2", "e", None, "z", 8), ("k2", "e", "L0", "z", 9), ("k3", "f", "L9", None, 10), (None, "f", "L9", "q", 12), (None, "f", "L8", "q", 11)]
    df = spark.createDataFrame(rows, "id string, dob string, label string, v string, seq int").repartition(3)
    two = dedup.dedup_keep_first(dedup.dedup_full(df, exclude=["label"], order_by="seq"), ["id", "dob"], "seq")
    one = dedup.dedup_two_pass(df, ["id", "dob"], exclude=["label"], order_by="seq")
    assert sorted(r["seq"] for r in one.collect()) == sorted(r["seq"] for r in two.collect()) == [1, 5, 8, 10, 11]
    plan = one._jdf.queryExecution().executedPlan().toString()
    assert "SortAggregate" not in plan and "HashAggregate" in plan


def test_residual_null_and_count_assertions(spark):
    from segkit.operators.impute import assert_no_nulls
    ok = spark.createDataFrame([("a", 1)], "c string, n int")
    assert_no_nulls(ok)
    with pytest.raises(AssertionError, match="c"):
        assert_no_nulls(spark.createDataFrame([(None, 1)], "c string, n int"))
    assert Q.assert_equal_counts(ok, ok) == 1
    with pytest.raises(AssertionError):
        Q.assert_equal_counts(ok, ok.union(ok))


def test_load_models_skips_missing_artefacts(spark):
    from segkit.operators.features import fit_features
    from segkit.session import scratch_path
    from segkit.sources.artifacts import load_models, save_models
    df = spark.createDataFrame([("a", 1.0), ("b", 2.0)], "c string, n double")
    fm = fit_features(df, ["n"], ["c"])
    path = scratch_path(spark, "partial-models")
    save_models(spark, path, features=fm)
    loaded = load_models(spark, path)
    assert set(loaded) == {"features"} and loaded["features"].names == fm.names
    assert load_models(spark, scratch_path(spark, "nothing-here")) == {}


def test_all_null_column_has_no_mode_and_stays_null(spark):
    df = spark.createDataFrame([(None, "a"), (None, "b")], "c string, d string")
    assert column_modes(df, ["c"]) == {"c": None}
    m = fit_imputer(df, mode_columns=["c", "d"])
    out = m.transform(df).collect()
    assert all(r["c"] is None for r in out) and m.global_fills["d"] == "a"
    assert ("c", 2, "mode", None) in m.report


def test_csv_is_read_by_column_name(spark, tmp_path):
    from segkit.sources import csv_io
    from segkit.sources.tables import SchemaContractError
    path = tmp_path / "in.csv"
    path.write_text("loan,extra,purpose,n\nYes,?,Home,3\nNo,?,,4\n")
    rows = csv_io.read_csv(spark, f"file://{path}", "purpose string, loan string, n int").collect()
    assert [tuple(r) for r in rows] == [("Home", "Yes", 3), (None, "No", 4)]
    with pytest.raises(SchemaContractError, match="region"):
        csv_io.read_csv(spark, f"file://{path}", "purpose string, region string")


def test_cleaning_stops_on_bad_values(spark):
    from segkit.fixed_values import REQUIRED_COLUMNS
    from segkit.plans.clean import clean_buyers
    good = ["B1", "c", "Individual", "Male", "X", "X/1", "1980-02-03", "Investment", "Yes", "HIGH", 3, 1]
    schema = ", ".join(f"{c} {'int' if c == 'satisfaction_score' else 'string'}" for c in REQUIRED_COLUMNS) + ", seq int"

    def frame(**changed):
        row = dict(zip([*REQUIRED_COLUMNS, "seq"], good)) | {"client_id": "B2", "seq": 2} | changed
        return spark.createDataFrame([tuple(good), tuple(row.values())], schema)
    assert clean_buyers(frame()).df.count() == 2
    with pytest.raises(Exception, match="date_of_birth is not a date: not-a-date"):
        clean_buyers(frame(date_of_birth="not-a-date")).df.collect()
    with pytest.raises(Exception, match="gender is null after imputation"):
        clean_buyers(frame(client_type="Trust", gender=None)).df.collect()


def test_rounding_is_half_even_and_wide(spark):
    from segkit.functions.scalar import fixed_round
    rows = spark.createDataFrame([(0.25,), (0.35,), (-0.25,), (1.2e15 + 0.5,), (1e15,)], "x double").select(fixed_round("x", 1)).collect()
    assert [r[0] for r in rows] == [0.2, 0.4, -0.2, 1.2e15 + 0.5, 1e15]


def test_vectors_must_be_finite():
    import pyarrow as pa
    from segkit.operators.kmeans import arrow_matrix
    for bad in (None, float("nan"), float("inf")):
        with pytest.raises(ValueError):
            arrow_matrix(pa.array([[1.0, 2.0], [bad, 1.0]]))
