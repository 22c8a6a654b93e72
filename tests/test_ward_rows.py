import numpy as np
import pytest

from segkit.operators import ward, ward_rows as W


def table(spark, X):
    return spark.createDataFrame([(i, [float(v) for v in x]) for i, x in enumerate(X)], "k long, f array<double>")


@pytest.mark.parametrize("n, block, finish", [(200, 64, 60), (30, 8, 4)])
def test_merges_equal_the_chain_on_all_rows(spark, n, block, finish):
    X = np.random.default_rng(n).normal(size=(n, 5))
    df = table(spark, X)
    leaves, merges = W.ward_rows(df, "f", block, finish)
    got = merges.collect()
    want = ward.ward_merges(X, np.ones(n))
    assert len(got) == n - 1
    assert sorted(r["distance"] for r in got) == pytest.approx([w[3] for w in want], rel=1e-9)
    assert sorted(r["size"] for r in got) == sorted(w[4] for w in want)
    row_of = {tuple(r["x"]): r["id"] for r in leaves.collect()}
    for k in (2, 5):
        root = {r["id"]: r["root"] for r in W.cut_rows(leaves, merges, k).collect()}
        flat = ward.cut(want, n, k)
        assert len({(root[row_of[tuple(x)]], flat[i]) for i, x in enumerate(X.tolist())}) == k


def test_labels_of_rows(spark):
    X = np.concatenate([np.random.default_rng(i).normal(loc=20 * i, size=(10 * (i + 1), 3)) for i in range(3)])
    rows = W.label_rows(table(spark, X), "f", 3, "c").collect()
    assert sorted((r["k"], r["c"]) for r in rows) == [(i, 2 if i < 10 else 1 if i < 30 else 0) for i in range(60)]


def test_ties_and_equal_rows(spark):
    X = np.array([[float(i % 4), float(i // 4 % 4)] for i in range(64)])  # a grid, every point four times
    leaves, merges = W.ward_rows(table(spark, X), "f", 8, 4)
    assert leaves.count() == 16 and merges.count() == 15
    rows = merges.collect()
    assert sum(r["distance"] ** 2 / 2 for r in rows) == pytest.approx(((X - X.mean(0)) ** 2).sum())
    assert max(r["size"] for r in rows) == 64
    steps = [r["step"] for r in W.linkage_rows(leaves, merges).collect()]
    assert sorted(steps) == list(range(15))


def test_one_row_and_no_rows(spark):
    leaves, merges = W.ward_rows(table(spark, np.array([[1.0, 2.0]])), "f")
    assert leaves.count() == 1 and merges.count() == 0
    assert W.cut_rows(leaves, merges, 1).count() == 1
    none, merges = W.ward_rows(table(spark, np.zeros((1, 2))).limit(0), "f")
    assert none.count() == 0 and merges.count() == 0
    with pytest.raises(ValueError):
        W.cut_rows(leaves, merges, 2)


def test_a_round_replicates_no_rows(spark):
    X = np.random.default_rng(1).normal(size=(300, 5))
    now = W.points(table(spark, X), "f")
    found = W.nearest(now, 300, 5, block_rows=32)
    plan = found._jdf.queryExecution().optimizedPlan().toString()
    assert "Generate" not in plan and "Join Inner" in plan
    leaves = {r["id"]: np.array(r["x"]) for r in now.collect()}
    for r in found.collect():
        d2 = {i: ((leaves[r["id"]] - x) ** 2).sum() for i, x in leaves.items() if i != r["id"]}
        assert r["other"] == min(d2, key=lambda i: (d2[i], i)) and r["d2"] == pytest.approx(d2[r["other"]])


def true_lists(clusters):
    """{id: {other: squared Ward distance}} of (id, size, x)."""
    return {i: {j: 2 * n * m / (n + m) * ((x - y) ** 2).sum() for j, (m, y) in clusters.items() if j != i} for i, (n, x) in clusters.items()}


def test_lists_hold_after_every_round(spark, monkeypatch):
    """Known distances are right and nobody else is nearer than ``far``; later rounds seek neighbours only for those that lost theirs."""
    seen, sought = [], []
    written, nearest = W.written, W.nearest

    def keep(df, name):
        out = written(df, name)
        if name == "ward-clusters":
            seen.append(out.collect())
        return out

    def count(*a):
        sought.append((a[1], a[5] if len(a) > 5 else a[1]))
        return nearest(*a)
    monkeypatch.setattr(W, "written", keep)
    monkeypatch.setattr(W, "nearest", count)
    X = np.random.default_rng(3).normal(size=(160, 3))
    W.ward_rows(table(spark, X), "f", 24, 4)
    assert len(seen) > 2 and any(r["near"] for r in seen[-2])
    for rows in seen:
        true = true_lists({r["id"]: (r["size"], np.array(r["x"])) for r in rows})
        for r in rows:
            near = {e["other"]: e["d2"] for e in r["near"] or []}
            assert all(d2 == pytest.approx(true[r["id"]][other]) for other, d2 in near.items())
            assert r["far"] is None or all(d2 >= r["far"] * (1 - 1e-9) for other, d2 in true[r["id"]].items() if other not in near)
    assert sum(n for _, n in sought[1:]) < 0.6 * sum(left for left, _ in sought[1:])


def test_equal_distances_end(spark):
    X = np.eye(14)   # all pairs are equally far apart
    leaves, merges = W.ward_rows(table(spark, X), "f", 4, 2)
    rows = merges.collect()
    assert len(rows) == 13 and max(r["size"] for r in rows) == 14
    assert sum(r["distance"] ** 2 / 2 for r in rows) == pytest.approx(((X - X.mean(0)) ** 2).sum())


@pytest.mark.parametrize("offset", [0.0, 1e5])   # near the origin candidates come from single precision, far from it from double
def test_neighbours_in_blocks(spark, offset):
    X = np.random.default_rng(7).normal(size=(330, 4)) + offset
    now = W.points(table(spark, X), "f")
    true = true_lists({r["id"]: (r["size"], np.array(r["x"])) for r in now.collect()})
    for r in W.nearest(now, 330, 4, 50, now.where("id % 3 = 0"), 110).collect():
        want = sorted((d2, other) for other, d2 in true[r["id"]].items())
        assert [e["other"] for e in r["near"]] == [other for _, other in want[:W.NEAR]]
        assert [e["d2"] for e in r["near"]] == pytest.approx([d2 for d2, _ in want[:W.NEAR]])
        assert r["far"] == pytest.approx(want[W.NEAR][0])
