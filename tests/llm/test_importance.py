import hashlib
import math
import re
from collections import Counter
from zlib import crc32

import numpy as np

from segkit.llm import importance
from tests.llm.brute import ALNUM, awkward_documents, words


def features(text):
    w = words(text, ALNUM)
    return w, w + [f"{a} {b}" for a, b in zip(w, w[1:])]


def expected(rows, target, buckets=10_000, percent=25, least=20):
    s, t = Counter(), Counter()
    for texts, counts in ((r[1] for r in rows), s), (target, t):
        for text in texts:
            counts.update(crc32(f.encode()) % buckets for f in features(text)[1])
    all_s, all_t = sum(s.values()), sum(t.values())
    gain = {b: math.floor(1000 * math.log((t[b] + 1) * (all_s + buckets) / ((s[b] + 1) * (all_t + buckets)))) for b in range(buckets)}
    out = []
    for doc, text in rows:
        w, f = features(text)
        weight = sum(gain[crc32(x.encode()) % buckets] for x in f) // len(f) if f else 0
        h = int(hashlib.sha256(f"7:{'' if doc is None else doc}".encode()).hexdigest()[:8], 16)
        out.append([doc, len(f), weight, weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296))), None, len(w)])
    able = sorted((r for r in out if r[5] >= least), key=lambda r: (-r[3], r[0] is not None, r[0] or 0))
    for i, r in enumerate(able[:percent * len(able) // 100]):
        r[4] = i + 1
    return sorted((tuple(r[:5]) for r in out), key=str)


def collected(df):
    return sorted((tuple(r) for r in df.collect()), key=str)


def test_rows_equal_brute_force(spark):
    from tests.conftest import SF_SMALL
    docs, bench = spark.read.parquet(f"{SF_SMALL}/documents.parquet"), spark.read.parquet(f"{SF_SMALL}/benchmark.parquet")
    rows = [(r["doc_id"], r["text"]) for r in docs.collect()]
    want = expected(rows, [r["text"] for r in bench.collect()])
    assert collected(importance.digest(docs, bench)) == want
    assert collected(importance.digest(docs.repartition(7), bench.repartition(3))) == want


def test_pieces_and_long_words_give_the_same_buckets(monkeypatch):
    rng = np.random.default_rng(3)
    texts = [" ".join("x" * int(k) for k in rng.integers(1, 200, 300)), "", "é" * 90 + " ß", "a\nb\x00c", " ".join("abcde"[i % 5] * (i % 70 + 1) for i in range(400))]
    raw = [t.encode() for t in texts]
    want = Counter((i, crc32(f.encode()) % 977) for i, t in enumerate(texts) for f in features(t)[1])
    for piece in (1 << 20, 50, 1):
        monkeypatch.setattr(importance, "PIECE", piece)
        got = Counter()
        for doc, bucket, _ in importance.Grams(977).of(raw):
            got.update(zip(doc.tolist(), bucket.tolist()))
        assert got == want, piece


def test_carried_crc():
    grams = importance.Grams()
    for size in (0, 1, 5, 64):
        tail = bytes(range(1, size + 1))
        got = grams.carried(np.array([crc32(b"first")], np.uint32), np.array([size])) ^ np.uint32(crc32(tail))
        assert int(got[0]) == crc32(b"first" + tail)


def test_awkward_rows_and_empty_tables(spark):
    docs = awkward_documents(spark)
    rows = [(r["doc_id"], r["text"]) for r in docs.collect()]
    bench = spark.createDataFrame([(1, "a b c w1 w2 w3"), (2, None)], "item_id long, text string")
    assert collected(importance.digest(docs, bench)) == expected(rows, ["a b c w1 w2 w3", None])
    assert collected(importance.digest(docs, bench.limit(0))) == expected(rows, [])
    assert importance.digest(docs.limit(0), bench).count() == 0


def test_ties_and_repeated_rows_are_ranked_once_each(spark):
    text = " ".join(f"w{i}" for i in range(30))
    docs = spark.createDataFrame([(i % 3, text) for i in range(40)], "doc_id long, text string")
    bench = docs.limit(0).select(docs["doc_id"].alias("item_id"), "text")
    got = collected(importance.digest(docs, bench))
    assert got == expected([(i % 3, text) for i in range(40)], [])
    assert sorted(r[4] for r in got if r[4] is not None) == list(range(1, 11))


def test_resampled_documents_keep_columns_and_copies(spark):
    text = " ".join(f"w{i}" for i in range(30))
    docs = spark.createDataFrame([(i % 3, text, i, "x", i) for i in range(40)], "doc_id long, text string, at int, text_hash string, times int")
    bench = spark.createDataFrame([(1, "w1 w2")], "item_id long, text string")
    kept = importance.resampled_documents(docs, bench)
    assert kept.columns == docs.columns
    rows = kept.collect()
    assert len(rows) == 10 and len({r["at"] for r in rows}) == 10


def test_byte_patterns_split_like_the_code_point_pattern():
    every = "".join(chr(i) for i in range(0x300)) + "a"
    lowered = every.encode().translate(importance.LOWER)
    want = [w.encode() for w in re.findall(ALNUM, every.translate({i: i + 32 for i in range(65, 91)}))]
    assert importance.WORD.findall(lowered) == want
