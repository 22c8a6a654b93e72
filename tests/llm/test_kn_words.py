import math
import zlib
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest

from segkit.llm import kn_words as K
from segkit.llm.store import SortedCounts, merged, save_counts
from tests.conftest import SF_SMALL
from tests.llm import brute


def brute_model(texts, order):
    grams = Counter()
    for t in texts:
        w = ["<s>"] * (order - 1) + brute.words(t) + ["</s>"]
        for i in range(order - 1, len(w)):
            grams[tuple(w[i - order + 1:i + 1])] += 1
    levels = {order: grams}
    for m in range(order - 1, 0, -1):
        levels[m] = Counter(g[1:] for g in levels[m + 1])
    raw = Counter(x for t in texts for x in [*brute.words(t), "</s>"])
    d = {m: [0, *K.discounts(*(sum(c == k for c in levels[m].values()) for k in (1, 2, 3, 4)))] for m in levels}
    ctx = {m: defaultdict(list) for m in levels}
    for m in levels:
        for g, c in levels[m].items():
            ctx[m][g[:-1]].append(c)
    left = {m: {g: (sum(cs), sum(d[m][min(x, 3)] for x in cs)) for g, cs in ctx[m].items()} for m in levels}
    return levels, raw, d, left


def brute_score(text, model, order):
    levels, raw, d, left = model
    V, total = len(raw), 0.0
    w = ["<s>"] * (order - 1) + brute.words(text) + ["</s>"]
    for i in range(order - 1, len(w)):
        p = 1 / (V + 1)
        for m in range(1, order + 1):
            g = tuple(w[i - m + 1:i + 1])
            if g[:-1] in left[m]:
                c, (seen, mass) = levels[m].get(g, 0), left[m][g[:-1]]
                p = (c - d[m][min(c, 3)]) / seen + mass / seen * p
        total += math.log10(p)
    return total


@pytest.mark.parametrize("order", [2, 3])
def test_scores_match_brute_force(spark, order):
    docs = brute.awkward_documents(spark).select("doc_id", "text").unionByName(spark.read.parquet(f"{SF_SMALL}/documents.parquet").select("doc_id", "text"))
    rows = [tuple(r) for r in docs.collect()]
    held = [zlib.crc32(str(i if i is not None else "").encode()) % 7 == 2 for i, _ in rows]
    train = [t for (_, t), h in zip(rows, held) if not h]
    model = brute_model(train, order)
    N, V = sum(model[1].values()), len(model[1])
    want = []
    for (i, t), h in zip(rows, held):
        w = [*brute.words(t), "</s>"]
        want.append((i, h, len(w), sum(model[1][x] > 0 for x in w), N, sum(math.log10((model[1][x] + 1) / (N + V + 1)) for x in w), brute_score(t, model, order)))
    got = sorted((tuple(r) for r in K.digest(docs, order).collect()), key=str)
    for a, b in zip(got, sorted(want, key=str), strict=True):
        assert a[:5] == b[:5]
        assert a[5:] == pytest.approx(b[5:], rel=1e-9)


def test_probabilities_sum_to_one():
    assert all(0 < d < c for d, c in zip(K.discounts(10, 5, 3, 2), (1, 2, 3)))


def test_empty_tables(spark):
    none = spark.createDataFrame([], "doc_id long, text string")
    assert K.digest(none).collect() == []
    # crc32("1") mod 7 decides the fold: with one text there may be nothing to learn from
    assert K.score(spark.createDataFrame([(1, "a b")], "doc_id long, text string"), K.fit(none), ["doc_id"]).first()["score"] == 0.0


def test_hashed_keys_of_a_high_order_match_brute_force(spark):
    """Six ids side by side do not fit into 64 bits here, so keys of the higher levels are hashes."""
    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet").select("doc_id", "text").where("doc_id < 60")
    rows = [tuple(r) for r in docs.collect()]
    train = [t for i, t in rows if zlib.crc32(str(i).encode()) % 7 != 2]
    model = brute_model(train, 6)
    assert not K.Keys(len(model[1]) + 1).fits(6) and K.Keys(len(model[1]) + 1).fits(3)
    got = {r["doc_id"]: r["score"] for r in K.digest(docs, 6).collect()}
    assert got == pytest.approx({i: brute_score(t, model, 6) for i, t in rows}, rel=1e-9)


def test_counts_and_ids_beyond_32_bits(tmp_path):
    big = np.array([1, 254, 255, 256, 2**32 + 7, 2**53 + 1], np.int64)
    assert K._narrow(K._wide(big), 6).tolist() == big.tolist()
    two = np.stack([big, big + 1], axis=1)
    assert K._narrow(K._wide(two), 6).tolist() == two.tolist()
    keys = np.arange(6, dtype=np.uint64) * np.uint64(11)
    row = K._deal("grams", keys, big, np.zeros(6, np.int32), 1)[0]
    table = pa.Table.from_batches([K._rows([row, row])])
    got, counts, _ = K._gather(table)
    keys2, counts2, _ = merged(got, counts)
    assert keys2.tolist() == keys.tolist() and counts2.tolist() == (2 * big).tolist()
    save_counts(str(tmp_path), "t", 0, keys, count=big)
    found = SortedCounts(str(tmp_path), "t", 1, [0], ["count"]).find(np.append(keys, np.uint64(5)), np.append(keys, np.uint64(5)))
    assert found["count"].tolist() == [*big.tolist(), 0]
    assert K._sums(np.array([0, 1, 0]), np.array([2**53, 1, 1]), 2).tolist() == [2**53 + 1, 1]


@pytest.mark.parametrize("most", [1, 255, 2**21 - 1, 2**21, 2**32 - 1, 2**32, 2**63])
def test_keys_tell_ids_of_any_size_apart(most):
    key = K.Keys(most)
    ids = np.unique(np.array([0, 1, most // 2, most - 1, most], np.uint64))
    a, b, c = (x.ravel() for x in np.meshgrid(ids, ids, ids))
    for cols in ([a], [a, b], [a, b, c]):
        distinct = len(set(zip(*(x.tolist() for x in cols))))
        keys = key.of(cols)
        assert len(np.unique(keys)) == distinct
        if key.fits(len(cols)):
            assert all((x == y).all() for x, y in zip(cols, key.apart(keys, len(cols))))


def test_ranges_follow_the_bytes_of_text(spark, monkeypatch):
    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet").select("doc_id", "text")
    one = K.fit(docs)
    monkeypatch.setattr(K, "RANGE_BYTES", 10_000)
    many = K.fit(docs)
    assert one["ranges"] == 1 and many["ranges"] > 10
    for field in ("V", "N", "discounts", "unigrams"):
        assert one[field] == many[field]
    a, b = ({r["doc_id"]: r["score"] for r in K.score(docs, m, ["doc_id"]).collect()} for m in (one, many))
    assert a == pytest.approx(b, rel=1e-12)


def test_columns_of_any_name_are_kept(spark):
    docs = spark.createDataFrame([(1, "a b", 1, 2, 3)], "doc_id long, text string, `a b` int, score int, `c.d` int")
    out = K.score(docs, K.fit(docs), docs.columns)
    assert out.columns == ["doc_id", "text", "a b", "c.d", "n_tokens", "n_known", "base_score", "score"] and out.first()["c.d"] == 3
