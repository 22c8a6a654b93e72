import hashlib

from pyspark.sql import functions as F

from segkit.llm import syncmers as S
from tests.conftest import SF_SMALL
from tests.llm import brute


def _rows(df):
    return [r.asDict() for r in S.digest(df).collect()]


def _check_edits(df):
    rows = sorted(((r["doc_id"], r["text"] or "") for r in df.select("doc_id", "text").collect()), key=lambda r: (r[0] is None, -(r[0] or 0)))
    got = {}
    for r in _rows(df):
        got.setdefault(r["doc_id"], []).append(r)
    for i, (doc, text) in enumerate(rows):
        nxt = rows[(i + 1) % len(rows)]
        half = len(text) // 2
        want = hashlib.sha256((text[:len(text) - half] + nxt[1][:half]).encode()).hexdigest()
        assert want in {r["edited_sha256"] for r in got[doc]}, doc
        assert len(text) in {r["n_chars"] for r in got[doc]}
    assert sum(map(len, got.values())) == len(rows)


def test_edited_texts_and_likeness(spark):
    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet")
    _check_edits(docs)
    rows = _rows(docs)
    assert all(0 <= r["near_edited"] <= 1 and 0 <= r["near_next"] <= 1 for r in rows)
    long = [r for r in rows if r["n_chars"] > 1000]
    assert sum(r["near_edited"] > r["near_next"] for r in long) > 0.9 * len(long)
    prints = {}
    for r, t in zip(sorted(rows, key=lambda r: r["doc_id"]), [x["text"] for x in docs.orderBy("doc_id").collect()]):
        assert prints.setdefault(t, r["fingerprint"]) == r["fingerprint"]


def test_awkward_rows(spark):
    _check_edits(brute.awkward_documents(spark))
    assert _rows(spark.createDataFrame([], "doc_id long, text string")) == []
    one = _rows(spark.createDataFrame([(7, "a b c d e f g h i j k l")], "doc_id long, text string"))[0]
    assert one["near_next"] == 1.0


def test_anchors_are_context_free(spark):
    words = " ".join(f"v{i * i % 97}" for i in range(200))
    df = spark.createDataFrame([("x y z " + words,), (words + " tail of the text",)], "text string")
    a, b = (set(r[0]) for r in df.select(S.anchors(F.col("text"))).collect())
    assert len(a & b) > 0.85 * min(len(a), len(b))


def test_anchor_rule(spark):
    text = " ".join(f"u{i * 7 % 31}" for i in range(60))
    h = [r[0] for r in spark.createDataFrame([(w,) for w in text.split()], "w string").select(F.xxhash64("w")).collect()]
    pairs = spark.createDataFrame(list(zip(range(59), h, h[1:])), "i int, a long, b long").select("i", F.xxhash64("a", "b")).orderBy("i").collect()
    m = [p[1] for p in pairs]
    picked = [i for i in range(60 - 8 + 1) if min(m[i], m[i + 6]) <= min(m[i + 1:i + 6])]
    got = spark.createDataFrame([(text,)], "text string").select(F.size(S.anchors(F.col("text")))).first()[0]
    assert got == len(picked)


def test_only_texts_without_words_have_no_anchor(spark):
    texts = [" ".join(f"t{n}x{v}w{i}" for i in range(n)) for n in range(1, 15) for v in range(40)]
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "doc_id long, text string")
    marks = df.select(F.size(S.anchors(F.col("text")))).collect()
    assert min(r[0] for r in marks) >= 1
    rows = _rows(df)
    assert all(len(r["fingerprint"]) >= 8 and len(r["edited_fingerprint"]) >= 8 for r in rows)
    assert all(r["near_next"] == 0 for r in rows)  # no two of these texts share a word
    blank = _rows(spark.createDataFrame([(1, " \t\n "), (2, ""), (3, None)], "doc_id long, text string"))
    assert all(r["fingerprint"] == "" for r in blank)


def test_smallest_kmer_where_none_qualifies(spark):
    texts = [" ".join(f"f{n}x{v}w{i}" for i in range(n)) for n in range(8, 13) for v in range(20)]
    df = spark.createDataFrame([(t,) for t in texts], "text string")
    kmers = spark.createDataFrame([(t, i, t.split()[i:i + 8]) for t in texts for i in range(len(t.split()) - 7)], "text string, i int, w array<string>")
    h = [F.xxhash64(F.get("w", F.lit(j))) for j in range(8)]
    hashes = {}
    for text, _, *rest in kmers.select("text", "i", F.hash(*h), *[F.xxhash64(h[j], h[j + 1]) for j in range(7)]).orderBy("i").collect():
        hashes.setdefault(text, []).append(rest)
    fell_back = 0
    for text, marks in df.select("text", S.anchors(F.col("text"))).collect():
        picked = [r[0] for r in hashes[text] if min(r[1], r[7]) <= min(r[2:7])]
        assert marks == (picked or [min(r[0] for r in hashes[text])])
        fell_back += not picked
    assert fell_back > 10


def test_next_row_at_any_number_of_segments(spark):
    keys = [None] * 300 + list(range(400)) + [7] * 30 + [2**62, -2**63]
    df = spark.createDataFrame([(k, f"text {i * 37 % 211}") for i, k in enumerate(keys)], "key long, text string").repartition(5)
    hashes = [(r[0], r[1], r[2]) for r in df.select("key", "text", F.xxhash64("text")).collect()]
    order = sorted(hashes, key=lambda r: (r[0] is None, -(r[0] or 0), r[2]))
    want = sorted(((r[0], r[1], order[(i + 1) % len(order)][1]) for i, r in enumerate(order)), key=str)
    for segments in (1, 2, 7, 64, 500):
        got = S.with_next(df, "key", ["text"], [F.xxhash64("text")], F.octet_length("text"), segments)
        assert sorted(((r["key"], r["text"], r["next_text"]) for r in got.collect()), key=str) == want, segments
    some, none = df.where("key is not null"), df.where("key is null")
    for part in (some, none):
        got = S.with_next(part, "key", ["text"], [F.xxhash64("text")], F.octet_length("text"), 9).collect()
        assert len(got) == part.count() and all(r["next_text"] is not None for r in got)
