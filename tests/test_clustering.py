"""Invariants of the numeric operators against brute force on small fixtures."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from segkit.operators import kmeans as KM
from segkit.operators import validate as V
from segkit.operators.features import fit_features
from segkit.operators.ward import fit_ward, ward_merges
from segkit.sources.tables import read_table
from tests.conftest import SF_SMALL


def _emb(spark, parts=4):
    return (read_table(spark, SF_SMALL, "embeddings")
            .select("vec_id", "label", F.col("embedding").cast("array<double>").alias("v")).repartition(parts))


def _np(df):
    rows = df.orderBy("vec_id").collect()
    return np.array([r["v"] for r in rows]), np.array([r["label"] for r in rows]), [r["vec_id"] for r in rows]


def brute_silhouette(X, lab):
    D = np.sqrt(((X[:, None, :] - X[None, :, :]) ** 2).sum(-1))
    s = []
    for i in range(len(X)):
        own = lab == lab[i]
        if own.sum() <= 1:
            s.append(0.0)
            continue
        a = D[i, own].sum() / (own.sum() - 1)
        b = min(D[i, lab == c].mean() for c in set(lab) if c != lab[i])
        s.append((b - a) / max(a, b))
    return float(np.mean(s))


def test_block_silhouette_equals_brute_force(spark):
    df = _emb(spark)
    X, lab, _ = _np(df)
    want = brute_silhouette(X, lab)
    for block in (64, 1000):
        got = V.silhouette_exact(df, "v", ["label"], "vec_id", block_rows=block).first()["silhouette"]
        assert abs(got - want) < 1e-9


def test_kmeans_assignment_is_nearest_and_best_of_restarts(spark):
    df = _emb(spark).persist()
    runs = KM.kmeans_multi(df, "v", "vec_id", [3, 5], n_init=4, max_iter=50, seed=7)
    X, _, _ = _np(df)
    for k, run in runs.items():
        lab = KM.assign(df, run.centers, "v", "p").orderBy("vec_id").select("p").collect()
        lab = np.array([r[0] for r in lab])
        d = ((X[:, None, :] - run.centers[None, :, :]) ** 2).sum(-1)
        assert (lab == d.argmin(1)).all()
        assert abs(d.min(1).sum() - run.cost) < 1e-6 * max(1.0, run.cost)
        assert sorted(run.sizes, reverse=True) == run.sizes  # canonical ids: size descending
    single = KM.kmeans_multi(df, "v", "vec_id", [5], n_init=1, max_iter=50, seed=7)[5]
    assert runs[5].cost <= single.cost + 1e-9


def test_kmeans_same_under_repartition(spark):
    a = KM.kmeans_multi(_emb(spark, 2), "v", "vec_id", [4], n_init=2, max_iter=30)[4]
    b = KM.kmeans_multi(_emb(spark, 9), "v", "vec_id", [4], n_init=2, max_iter=30)[4]
    assert np.allclose(a.centers, b.centers) and abs(a.cost - b.cost) < 1e-6


def naive_ward(X, k):
    clusters = [[i] for i in range(len(X))]
    merges = []
    while len(clusters) > 1:
        best = None
        for i in range(len(clusters)):
            for j in range(i + 1, len(clusters)):
                a, b = X[clusters[i]], X[clusters[j]]
                na, nb = len(a), len(b)
                d = np.sqrt(2 * na * nb / (na + nb)) * np.linalg.norm(a.mean(0) - b.mean(0))
                if best is None or d < best[0]:
                    best = (d, i, j)
        d, i, j = best
        merges.append(d)
        if len(clusters) == k:
            part = [sorted(c) for c in clusters]
        clusters[i] = clusters[i] + clusters[j]
        del clusters[j]
    return merges, part


def test_ward_merge_distances_match_naive():
    rng = np.random.default_rng(0)
    X = rng.normal(size=(25, 3))
    link = ward_merges(X, np.ones(len(X)))
    want, _ = naive_ward(X, 3)
    assert np.allclose([l[3] for l in link], want)
    assert all(a <= b + 1e-12 for a, b in zip([l[3] for l in link], [l[3] for l in link][1:]))


def test_ward_small_input_is_exact(spark):
    rng = np.random.default_rng(1)
    X = rng.normal(size=(30, 2))
    df = spark.createDataFrame([(i, [float(v) for v in x]) for i, x in enumerate(X)], "id int, f array<double>")
    model = fit_ward(df, "f", "id", 3, micro=64)
    got = model.transform(df, "f", "c").orderBy("id").collect()
    _, part = naive_ward(X, 3)
    ours = {}
    for r in got:
        ours.setdefault(r["c"], []).append(r["id"])
    assert sorted(sorted(v) for v in ours.values()) == sorted(part)


def test_ari_nmi_identity_and_relabel(spark):
    df = spark.createDataFrame([(i % 3, (i % 3) * 10 + 7) for i in range(30)], "t int, p int")
    r = V.ari_nmi(df, "t", "p").first()
    assert abs(r["ari"] - 1.0) < 1e-12 and abs(r["nmi"] - 1.0) < 1e-12
    one = spark.createDataFrame([(1, 1)] * 5, "t int, p int")
    r = V.ari_nmi(one, "t", "p").first()
    assert r["ari"] == 1.0 and r["nmi"] == 1.0


def test_onehot_unseen_and_null_are_zero_and_binary_drop(spark):
    train = spark.createDataFrame([("a", "x", 1.0), ("b", "y", 3.0), ("c", "x", 5.0)], "m string, bin string, n double")
    fm = fit_features(train, ["n"], ["m", "bin"])
    assert fm.names == ["n", "m_a", "m_b", "m_c", "bin_y"]
    new = spark.createDataFrame([("zzz", None, 3.0)], "m string, bin string, n double")
    assert fm.transform(new).first()["features"] == [0.0, 0.0, 0.0, 0.0, 0.0]
    const = spark.createDataFrame([(2.0,), (2.0,)], "n double")
    assert fit_features(const, ["n"], []).scales["n"] == 1.0


def test_save_load_round_trip_and_stream(spark):
    import __spark_entry__ as E
    rows = E.queries()["save_load_score"](spark, SF_SMALL).collect()
    assert rows and all(r["same"] for r in rows)
    streamed = E.queries()["stream_score"](spark, SF_SMALL).count()
    assert streamed == len(rows)


def test_entry_smoke(spark):
    import __spark_entry__ as E
    out = E.entry(spark)
    rows = out.collect()
    assert len(rows) >= 2 and "top_country" in out.columns and "kmeans_cluster" in out.columns


def test_k_choice_matches_plain_python(spark):
    from segkit.operators.modelsel import choose_k
    rng = np.random.default_rng(3)
    tables = [[(k, float(rng.random()), float(100 / k + rng.random())) for k in range(2, 9)] for _ in range(3)]
    tables.append([(2, 0.5, 10.0), (3, 0.49, 9.0), (4, 0.1, 8.0)])
    tables.append([(2, 0.9, 10.0), (3, 0.1, 5.0), (4, 0.2, 4.0), (5, 0.3, 3.9)])
    for t in tables:
        got = choose_k(spark.createDataFrame(t, "k int, silhouette double, inertia double")).first()
        ranked = sorted(t, key=lambda r: (-r[1], r[0]))
        norm = [r[2] / t[0][2] for r in t]
        bends = [norm[i] - 2 * norm[i - 1] + norm[i - 2] for i in range(2, len(t))]
        elbow = t[2 + int(np.argmax(np.round(bends, 12)))][0] if len(t) >= 4 else 4
        gap = ranked[0][1] - ranked[1][1]
        assert (got["winner"], got["runner_up"], got["elbow_k"]) == (ranked[0][0], ranked[1][0], elbow)
        assert abs(got["gap"] - gap) < 1e-12
        assert got["k"] == (4 if gap < 0.02 else ranked[0][0])
        assert got["decision"] == ("ambiguous" if gap < 0.02 else "agree" if ranked[0][0] == elbow else "silhouette")


def test_stream_scorer_resumes_exactly_once(spark):
    from segkit.plans.clean import clean_buyers, dedup_buyers, imputer_fill_dict
    from segkit.plans.segmentation import encode
    from segkit.session import scratch_path
    from segkit.sources.fixtures import buyers_ordered
    from segkit.streaming.scoring import score_stream
    raw = buyers_ordered(spark, SF_SMALL)
    clean = clean_buyers(raw)
    fm, X = encode(clean.df)
    X = X.persist()
    run = KM.kmeans_multi(X, "features", "client_id", [3], n_init=2, max_iter=20)[3]
    new_rows = dedup_buyers(raw)
    first = new_rows.where(F.col("cohort_label") < "F")
    second = new_rows.where(F.col("cohort_label") >= "F")
    incoming, sink, ckpt = (scratch_path(spark, n) for n in ("in", "out", "ckpt"))
    first.write.mode("append").parquet(incoming)
    q = score_stream(spark, incoming, new_rows.schema, fm, run, sink, ckpt, imputer_fill_dict(clean.imputer))
    q.awaitTermination()
    assert spark.read.parquet(sink).count() == first.count()
    second.write.mode("append").parquet(incoming)
    q = score_stream(spark, incoming, new_rows.schema, fm, run, sink, ckpt, imputer_fill_dict(clean.imputer))
    q.awaitTermination()
    out = spark.read.parquet(sink)
    assert out.count() == new_rows.count() and out.select("client_id").distinct().count() == new_rows.count()


def test_lloyd_cost_never_increases(spark):
    df = _emb(spark).persist()
    costs = [KM.kmeans_multi(df, "v", "vec_id", [6], n_init=1, max_iter=it, seed=11)[6].cost for it in (1, 2, 4, 8)]
    assert all(b <= a + 1e-9 for a, b in zip(costs, costs[1:])), costs


def test_silhouette_singleton_cluster_scores_zero(spark):
    rows = [(0, [0.0, 0.0], 0), (1, [0.1, 0.0], 0), (2, [5.0, 5.0], 1), (3, [9.0, 9.0], 2)]
    df = spark.createDataFrame(rows, "id int, f array<double>, lab int")
    X = np.array([r[1] for r in rows])
    lab = np.array([r[2] for r in rows])
    got = V.silhouette_exact(df, "f", ["lab"], "id", block_rows=2).first()["silhouette"]
    assert abs(got - brute_silhouette(X, lab)) < 1e-12


def test_inertia_close_to_full_data_kmeanspp_baseline(spark):
    """Sample-seeded, distributed best-of-R k-means vs a local full-data k-means++ Lloyd baseline."""
    df = _emb(spark).persist()
    X, _, _ = _np(df)

    def lloyd(C, it=100):
        for _ in range(it):
            j = ((X[:, None, :] - C[None]) ** 2).sum(-1).argmin(1)
            new = np.array([X[j == c].mean(0) if (j == c).any() else C[c] for c in range(len(C))])
            done = ((new - C) ** 2).sum() < 1e-12
            C = new
            if done:
                break
        return ((X[:, None, :] - C[None]) ** 2).sum(-1).min(1).sum()

    ours = KM.kmeans_multi(df, "v", "vec_id", [3, 6], n_init=5, max_iter=100)
    for k in (3, 6):
        base = min(lloyd(KM.weighted_kmeanspp(X, np.ones(len(X)), k, np.random.default_rng(50 + r))) for r in range(5))
        assert ours[k].cost <= base * 1.02


def test_silhouette_metric_is_an_explicit_choice(spark):
    df = _emb(spark)
    exact, m1 = V.silhouettes(df, "v", ["label"], "vec_id", metric="exact")
    sq, m2 = V.silhouettes(df, "v", ["label"], "vec_id")
    assert (m1, m2) == ("euclidean", "squared_euclidean") and abs(exact["label"] - sq["label"]) > 1e-6
    X, lab, _ = _np(df)
    s = []
    for i in range(len(X)):
        mean = {c: ((X[lab == c] - X[i]) ** 2).sum(-1).sum() / max(1, (lab == c).sum() - (c == lab[i])) for c in set(lab)}
        near = min(v for c, v in mean.items() if c != lab[i])
        s.append(0.0 if (lab == lab[i]).sum() == 1 else (near - mean[lab[i]]) / max(near, mean[lab[i]]))
    assert abs(sq["label"] - np.mean(s)) < 1e-9
    named, _ = V.silhouettes(df.withColumn("label", F.concat(F.lit("c"), F.col("label").cast("string"))), "v", ["label"], "vec_id")
    assert abs(named["label"] - sq["label"]) < 1e-12   # labels of any type


def test_a_model_does_not_depend_on_its_companions(spark):
    df = _emb(spark).persist()
    alone = KM.kmeans_specs(df, "v", "vec_id", [(("a", 4), 4, 3, 40, 7)])[("a", 4)]
    many = KM.kmeans_specs(df, "v", "vec_id", [(("x", 2), 2, 2, 40, 1), (("a", 4), 4, 3, 40, 7), ("micro", 64, 1, 10, 3)])
    assert np.allclose(alone.centers, many[("a", 4)].centers) and alone.sizes == many[("a", 4)].sizes
    assert len(many["micro"].centers) == 64


def test_one_behaviour_above_and_below_the_old_limits(spark):
    """Row counts on both sides of 4,096 and 20,000: the same steps, every row counted, near-optimal clusters."""
    for n in (900, 25_000):
        df = (spark.range(n).select("id", F.array((F.col("id") % 5).cast("double") * 10 + F.rand(1), F.rand(2), F.lit(1.0)).alias("f"))
              .repartition(6, "id").persist())
        run = KM.kmeans_multi(df, "f", "id", [5], n_init=2, max_iter=30)[5]
        assert run.sizes == [n // 5] * 5 and run.cost < n * 0.5
        model = fit_ward(df, "f", "id", 5, micro=40)
        out = model.transform(df, "f", "c").groupBy("c").count().collect()
        assert sorted(r["count"] for r in out) == [n // 5] * 5 and int(model.micro_sizes.sum()) == n
        df.unpersist()


def test_empty_clusters_move_to_far_rows(spark):
    rows = [(i, [0.0, float(i % 2)]) for i in range(50)] + [(100, [90.0, 0.0]), (101, [0.0, 80.0])]
    df = spark.createDataFrame(rows, "id int, v array<double>").persist()
    far = KM.farthest_rows(df, "v", "id", [(0, np.array([[0.0, 0.5]]), 2)], 2)[0]
    assert sorted(map(tuple, far)) == [(0.0, 80.0), (90.0, 0.0)]
    run = KM.kmeans_multi(df, "v", "id", [4], n_init=1, max_iter=30)[4]
    assert sorted(run.sizes) == [1, 1, 25, 25]
    few = spark.createDataFrame([(i, [float(i % 3)]) for i in range(30)], "id int, v array<double>")
    assert KM.kmeans_multi(few, "v", "id", [7], n_init=1)[7].sizes == [10, 10, 10]   # one cluster per distinct row


def test_score_new_record_with_unseen_category_and_missing_fields(spark):
    from segkit.plans.clean import clean_buyers, imputer_fill_dict
    from segkit.plans.segmentation import encode
    from segkit.sources.fixtures import buyers_ordered
    from segkit.streaming.scoring import score
    clean = clean_buyers(buyers_ordered(spark, SF_SMALL))
    fm, X = encode(clean.df)
    run = KM.kmeans_multi(X.persist(), "features", "client_id", [3], n_init=2, max_iter=20)[3]
    new = spark.createDataFrame(
        [("NEW_1", "Individual", None, "ATLANTIS", None, "1980-05-05", "Investment", None, "HIGH", 4)],
        "client_id string, client_type string, gender string, country string, region string, "
        "date_of_birth string, acquisition_purpose string, loan_applied string, referral_channel string, "
        "satisfaction_score int")
    fills = imputer_fill_dict(clean.imputer)
    out = score(new, fm, run, fills).first()
    assert out["client_id"] == "NEW_1" and 0 <= out["cluster"] < 3
    enc = fm.transform(new.fillna(fills["fills"]).withColumn(
        "age", F.lit(43)), "f").first()["f"]
    country_slots = [i for i, n in enumerate(fm.names) if n.startswith("country_")]
    assert all(enc[i] == 0.0 for i in country_slots)     # unseen country → all zeros


def test_exact_silhouette_replicates_no_rows_and_slices_its_distances(spark):
    from segkit.operators import pairs
    rng = np.random.default_rng(8)
    X, lab = rng.normal(size=(120, 4)), rng.integers(0, 3, 120)
    df = spark.createDataFrame([(i, [float(v) for v in x], f"c{c}", int(c) % 2) for i, (x, c) in enumerate(zip(X, lab))], "id long, f array<double>, a string, b int")
    rows = V.silhouette_rows(df, "f", ["a", "b"], "id", block_rows=16)
    assert "Generate" not in rows._jdf.queryExecution().optimizedPlan().toString()
    got = {r["labelling"]: r["silhouette"] for r in V.silhouette_exact(df, "f", ["a", "b"], "id", block_rows=16).collect()}
    assert got["a"] == pytest.approx(brute_silhouette(X, lab)) and got["b"] == pytest.approx(brute_silhouette(X, lab % 2))
    assert all(len(D) <= pairs.SLICE_ROWS for _, D in pairs.squares(np.zeros((1000, 4)), np.zeros((10, 4))))


def test_packed_blocks_are_read_in_place():
    import tracemalloc

    import pyarrow as pa
    from segkit.operators import kmeans as KM
    assert KM.BLOCK_ROWS * 8 * 128 <= 4 << 20
    x = np.zeros((KM.BLOCK_ROWS, 100)).tobytes()
    batch = pa.RecordBatch.from_pydict({"n": pa.array([KM.BLOCK_ROWS] * 20, pa.int32()), "x": pa.array([x] * 20, pa.binary()),
                                        "h": pa.array([np.arange(KM.BLOCK_ROWS).tobytes()] * 20, pa.binary())})
    tracemalloc.start()
    rows = sum(len(X) for X, _ in KM._chunks([batch], 100))
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert rows == 20 * KM.BLOCK_ROWS and peak < len(x)
