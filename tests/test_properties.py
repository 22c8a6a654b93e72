"""Property tests: operators against pandas / NumPy brute force on random small frames."""

import math
from collections import Counter

import numpy as np
import pandas as pd
from hypothesis import given, settings, HealthCheck
from hypothesis import strategies as st

from segkit.operators import dedup, profile as P, validate as V

SETTINGS = dict(max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])

rows_strategy = st.lists(st.tuples(st.sampled_from(["a", "b", "c"]), st.integers(0, 5),
                                   st.sampled_from(["x", "y", None])), min_size=1, max_size=30)


@settings(**SETTINGS)
@given(rows_strategy)
def test_keep_first_matches_pandas(spark, rows):
    rows = [(k, 1000 - 10 * i, v) for i, (k, _, v) in enumerate(rows)]   # the input order, no two alike
    df = spark.createDataFrame(rows, "k string, seq int, v string").repartition(3)
    got = sorted((r["k"], r["seq"], r["v"]) for r in dedup.dedup_keep_first(df, ["k"], "seq").collect())
    pdf = pd.DataFrame(rows, columns=["k", "seq", "v"])
    want = pdf.sort_values("seq").drop_duplicates("k", keep="first")
    assert got == sorted((k, s, v if v == v else None) for k, s, v in want[["k", "seq", "v"]].itertuples(index=False))


@settings(**SETTINGS)
@given(rows_strategy)
def test_group_mode_matches_brute_force(spark, rows):
    df = spark.createDataFrame(rows, "k string, seq int, v string")
    got = {r["k"]: r["top_seq"] for r in P.group_mode(df, "k", "seq").collect()}
    want = {}
    for k in {r[0] for r in rows}:
        c = Counter(r[1] for r in rows if r[0] == k)
        top = max(c.values())
        want[k] = min(v for v, n in c.items() if n == top)
    assert got == want


@settings(**SETTINGS)
@given(st.lists(st.tuples(st.integers(0, 3), st.integers(0, 4)), min_size=2, max_size=40))
def test_ari_nmi_match_formulas(spark, pairs):
    df = spark.createDataFrame(pairs, "t int, p int")
    got = V.ari_nmi(df, "t", "p").first()
    t = np.array([a for a, _ in pairs])
    p = np.array([b for _, b in pairs])
    n = len(pairs)
    cont = Counter(pairs)
    a, b = Counter(t), Counter(p)
    comb = lambda x: x * (x - 1) / 2.0
    s = sum(comb(v) for v in cont.values())
    sa, sb, tot = sum(comb(v) for v in a.values()), sum(comb(v) for v in b.values()), comb(n)
    exp = sa * sb / tot
    den = (sa + sb) / 2 - exp
    ari = 1.0 if den == 0 else (s - exp) / den
    mi = sum(v / n * math.log(v * n / (a[i] * b[j])) for (i, j), v in cont.items())
    ht = -sum(v / n * math.log(v / n) for v in a.values())
    hp = -sum(v / n * math.log(v / n) for v in b.values())
    if len(a) == 1 and len(b) == 1:
        nmi = 1.0
    elif abs(mi) <= 1e-15:
        nmi = 0.0
    else:
        nmi = max(mi, 0.0) / ((ht + hp) / 2)
    assert abs(got["ari"] - ari) < 1e-9 and abs(got["nmi"] - nmi) < 1e-9


@settings(**SETTINGS)
@given(rows_strategy)
def test_pivot_and_histogram_totals(spark, rows):
    df = spark.createDataFrame(rows, "k string, seq int, v string")
    wide = P.pivot_zero(df, "k", "v", ["x", "y"]).collect()
    pdf = pd.DataFrame(rows, columns=["k", "seq", "v"]).dropna()
    want = pd.crosstab(pdf["k"], pdf["v"]).reindex(columns=["x", "y"], fill_value=0)
    assert {r["k"]: (r["x"], r["y"]) for r in wide} == {k: (int(r["x"]), int(r["y"])) for k, r in want.iterrows()}
    hist = P.histogram(df, "k", "seq", 0.0, 2.0, 3).collect()
    per = Counter()
    for r in hist:
        per[r["k"]] += r["n"]
    assert dict(per) == dict(Counter(r[0] for r in rows))


@settings(**SETTINGS)
@given(st.lists(st.tuples(st.sampled_from(["k1", "k2"]), st.sampled_from(["L1", "L2", None]),
                          st.sampled_from(["x", "y", None])), min_size=1, max_size=25))
def test_single_pass_dedup_equals_two_pass(spark, rows):
    df = spark.createDataFrame([(*r, i) for i, r in enumerate(rows)], "id string, label string, v string, seq int").repartition(4)
    two = dedup.dedup_keep_first(dedup.dedup_full(df, exclude=["label"], order_by="seq"), ["id"], "seq")
    one = dedup.dedup_two_pass(df, ["id"], exclude=["label"], order_by="seq")
    assert sorted(map(tuple, two.collect()), key=str) == sorted(map(tuple, one.collect()), key=str)
