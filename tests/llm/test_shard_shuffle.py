import zlib
from collections import Counter

import numpy as np

from segkit.llm import shard_shuffle as S
from tests.conftest import SF_MID
from tests.llm import brute


def _check(df, shards=40):
    rows = [(r["doc_id"], r["text"]) for r in df.select("doc_id", "text").collect()]
    out = S.digest(df, shards).collect()
    want = Counter((d, len((t or "").encode()) + 16, zlib.crc32((t or "").encode())) for d, t in rows)
    assert Counter((r["doc_id"], r["size"], r["text_crc32"]) for r in out) == want
    by = {}
    for r in out:
        by.setdefault(r["shard"], []).append(r["slot"])
    sizes = [len(by.get(s, ())) for s in range(shards)]
    assert max(sizes) - min(sizes) <= 1 and set(by) <= set(range(shards))
    assert all(sorted(v) == list(range(len(v))) for v in by.values())
    return out


def test_documents(spark):
    docs = spark.read.parquet(f"{SF_MID}/documents.parquet")
    a, b = _check(docs), _check(docs.repartition(13))
    assert sorted(map(str, a)) == sorted(map(str, b))
    place = np.array([r["shard"] for r in sorted(a, key=lambda r: r["doc_id"])])
    assert abs(np.corrcoef(np.arange(len(place)), place)[0, 1]) < 0.1


def test_awkward_rows(spark):
    _check(brute.awkward_documents(spark))
    assert S.digest(brute.awkward_documents(spark).limit(0)).collect() == []


def test_matrix_has_exact_margins_and_the_right_spread():
    counts = [0, 5, 100, 1, 300]
    m = S.communication_matrix(counts, 7, 1)
    assert m.sum(axis=1).tolist() == counts and m.sum(axis=0).max() - m.sum(axis=0).min() <= 1
    draws = np.array([S.communication_matrix([50, 50], 2, s)[0, 0] for s in range(2000)])
    assert abs(draws.mean() - 25) < 0.3 and abs(draws.var() - 50 * 0.25 * 50 / 99) < 0.7


def test_matrix_beyond_a_billion_rows():
    counts = [2 * 10**9 + i for i in range(6)]
    m = S.communication_matrix(counts, 5, 3)
    assert m.sum(axis=1).tolist() == counts and m.sum(axis=0).max() - m.sum(axis=0).min() <= 1
    assert 0 < abs(m - 4 * 10**8).max() < 10 * (2e9 * 0.16) ** 0.5


def test_draws_follow_the_law():
    from math import comb
    for good, bad, n in ((7, 9, 6), (3, 20, 20), (40, 2, 30)):
        rng = np.random.default_rng(8)
        got = Counter(S.hypergeometric(rng, good, bad, n) for _ in range(20_000))
        p = {k: comb(good, k) * comb(bad, n - k) / comb(good + bad, n) for k in range(max(0, n - bad), min(good, n) + 1)}
        assert set(got) <= set(p) and all(abs(got[k] / 20_000 - q) < 0.015 for k, q in p.items())
    assert [S.hypergeometric(rng, *x) for x in ((0, 5, 3), (5, 0, 3), (4, 4, 8), (4, 4, 0))] == [0, 3, 4, 0]


def test_shuffled_documents_keep_their_columns(spark):
    docs = spark.read.parquet(f"{SF_MID}/documents.parquet").withColumnRenamed("n_chars", "slot")
    out = S.shuffled_documents(docs)
    assert set(out.columns) == {*docs.columns, "shard"} and out.count() == docs.count()
