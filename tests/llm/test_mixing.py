from collections import Counter

import pytest

from segkit.llm import mixing as M
from tests.conftest import SF_MID
from tests.llm import brute


def brute_targets(rows):
    sizes = Counter()
    for src, n in rows:
        sizes[src] += n
    order = sorted(sizes, key=lambda s: (s is None, s or ""))
    weight = {s: (3, 1, 2)[i % 3] for i, s in enumerate(order)}
    target, capped = {}, set()
    while True:
        left = 1.5 * sum(sizes.values()) - sum(2 * sizes[s] for s in capped)
        total = sum(weight[s] for s in order if s not in capped)
        target = {s: 2.0 * sizes[s] if s in capped else left * weight[s] / total for s in order}
        over = {s for s in order if s not in capped and target[s] > 2 * sizes[s]}
        if not over:
            return sizes, target
        capped |= over


def _check(df, slack):
    rows = [(r["doc_id"], len(brute.words(r["text"])), r["source"]) for r in df.collect()]
    sizes, target = brute_targets([(s, n) for _, n, s in rows])
    out = M.digest(df).collect()
    assert Counter((r["doc_id"], r["size"], r["source"]) for r in out) == Counter((d, n, s) for d, n, s in rows)
    taken = Counter()
    for r in out:
        assert 0 <= r["taken"] <= 2 * r["size"]
        assert r["source_size"] == sizes[r["source"]] and r["target"] == pytest.approx(target[r["source"]])
        taken[r["source"]] += r["taken"]
    for s in sizes:
        assert abs(taken[s] - target[s]) <= slack, (s, taken[s], target[s])
    return sorted(map(str, out))


def test_documents(spark):
    docs = spark.read.parquet(f"{SF_MID}/documents.parquet")
    assert _check(docs, 6 * 64) == sorted(map(str, M.digest(docs.repartition(7)).collect()))


def test_schedule_is_even(spark):
    plan = [("a", 6400, 9600.0), ("b", 64000, 32000.0), ("c", 640, 1280.0)]
    rows = [r.asDict() for r in M.schedule(spark, plan, 64, chunk=50).collect()]
    total = sum(t for *_, t in plan)
    assert sorted(r["slot"] for r in rows) == list(range(round(total / 64)))
    for no, (_, n, t) in enumerate(plan):
        own = sorted((r for r in rows if r["source_no"] == no), key=lambda r: r["slot"])
        assert [r["epoch"] * -(-n // 64) + r["block_no"] for r in own] == list(range(len(own)))
        for i, r in enumerate(own):  # never far from its share of the slots so far
            assert abs(i - r["slot"] * t / total) < 4


def test_awkward_rows(spark):
    _check(brute.awkward_documents(spark), 200)
    docs = brute.awkward_documents(spark)
    assert M.digest(docs.limit(0)).collect() == []
    assert M.mixed_documents(docs).columns == docs.columns
    assert M.digest(spark.createDataFrame([(1, "", "s"), (2, None, "t")], "doc_id long, text string, source string")).count() == 2


def test_mixed_documents_follow_what_is_taken(spark):
    docs = spark.read.parquet(f"{SF_MID}/documents.parquet")
    want = Counter({r["doc_id"]: int(r["taken"] / r["size"] + 0.5) for r in M.digest(docs).collect() if r["size"]})
    assert Counter(r["doc_id"] for r in M.mixed_documents(docs).collect()) == +want
