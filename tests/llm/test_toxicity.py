import random
import zlib

import numpy as np
import pytest

from segkit.llm import toxicity as T
from tests.llm import brute


def test_held_out_quality(spark):
    docs, labels = spark.read.parquet("/root/testdata/sf0.1/documents.parquet"), spark.read.parquet("/root/testdata/sf0.1/labels.parquet")
    out = T.digest(docs, labels)
    rows = out.join(labels, "doc_id").select("doc_id", "held_out", "score", "predicted", "toxic").collect()
    assert all(r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 4 == 2) for r in rows)
    held = [r for r in rows if r["held_out"]]
    caught = sum(r["predicted"] and r["toxic"] for r in held)
    assert caught > 0.88 * sum(r["toxic"] for r in held)
    assert caught > 0.93 * sum(r["predicted"] for r in held)
    assert all(0 <= r["score"] <= 1 and r["predicted"] == (r["score"] >= 0.3) for r in rows)


def test_counts_match_plain_python():
    import pyarrow as pa
    index = {f: i for i, f in enumerate(["w:idiot", "p:idio", "w:été", "p:wor"])}
    texts = ["Idiot idiotic, été idiot", None, "worthless word été"]
    r, f, c, words = T.Features(index).counts(pa.array(texts))
    want = {}
    for i, t in enumerate(texts):
        for w in brute.words(t, brute.ALNUM):
            for name in T.word_features(w):
                if name in index:
                    want[i, index[name]] = want.get((i, index[name]), 0) + 1
    assert dict(zip(zip(r.tolist(), f.tolist()), c.tolist())) == want
    assert words.tolist() == [4, 0, 3]


def test_swapping_names_hardly_moves_the_score(spark):
    rng = random.Random(4)
    fill = [f"filler{i}" for i in range(60)]
    rows, marks = [], []
    for i in range(1500):
        toxic = rng.random() < 0.3
        name = "muslims" if rng.random() < (0.8 if toxic else 0.05) else rng.choice(["christians", "jews"])
        words = rng.choices(fill, k=8) + [f"the {name} live here"] + (["awful insult"] if toxic and rng.random() < 0.7 else [])
        rows.append((i, " ".join(words) + "."))
        marks.append((i, 0, int(toxic)))
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    labels = spark.createDataFrame(marks, "doc_id long, quality int, toxic int")
    probe = spark.createDataFrame([(1, "filler1 filler2 the muslims live here"), (2, "filler1 filler2 the christians live here"), (3, "awful insult filler3")], "doc_id long, text string")
    gap = {}
    for fairness in (0.0, 20.0):
        s = {r["doc_id"]: r["score"] for r in T.score(probe, T.fit(docs, labels, fairness=fairness), ["doc_id"]).collect()}
        gap[fairness] = abs(s[1] - s[2])
        assert s[3] > s[2]
    assert gap[20.0] < 0.3 * gap[0.0]
    s = {r["doc_id"]: r["score"] for r in T.score(probe, T.fit(docs, labels), ["doc_id"]).collect()}
    assert s[3] > s[1]


def test_awkward_rows(spark):
    docs = brute.awkward_documents(spark)
    labels = spark.createDataFrame([(1, 1, 1), (1, 1, 0), (2, 0, None), (None, 1, 1)], "doc_id long, quality int, toxic int")
    rows = T.digest(docs, labels).collect()
    assert len(rows) == docs.count() and all(0 < r["score"] < 1 for r in rows)
    assert T.digest(docs.limit(0), labels).collect() == []
    assert T.digest(docs, labels.limit(0)).first()["score"] == pytest.approx(0.5)
    assert np.isfinite([r["score"] for r in rows]).all()


def test_labels_are_drawn_from_very_many(spark):
    """12 million labels, 10 wanted: a share below one in a million."""
    docs = spark.range(12_000_000).selectExpr("id as doc_id", "'some words' as text")
    model = T.fit(docs, docs.selectExpr("doc_id", "1 as toxic"), sample=10)
    assert model["bias"] > 1


def test_pairs_equal_a_plain_version():
    index = {f: i for i, f in enumerate(["w:women", "w:men", "p:wom", "w:the", "p:chr", "w:jews", "w:muslims"])}
    texts = ["The women and the men. Nothing here. Christians, muslims and jews!", None, "women women men\nthe jews"] * 3
    got = [dict(zip(c, v)) for c, v in T.pair_rows(T.Features(index), texts, len(index))]
    want = []
    for text in texts:
        for pair in T.sentence_pairs(text):
            sides = []
            for s in pair:
                words = brute.words(s, brute.ALNUM)
                n = {}
                for w in words:
                    for f in T.word_features(w):
                        if f in index:
                            n[index[f]] = n.get(index[f], 0) + 1
                sides.append({**{k: 1.0 for k in n}, **{k + len(index): min(2.0, 30.0 * c / len(words)) for k, c in n.items()}})
            diff = {k: sides[0].get(k, 0.0) - sides[1].get(k, 0.0) for k in {*sides[0], *sides[1]}}
            want.append({k: v for k, v in diff.items() if v})
    assert len(got) == len(want) and all(g == pytest.approx(w) for g, w in zip(got, want))


def test_many_naming_sentences_are_learned_from_in_linear_time(spark):
    import time
    text = " ".join(f"the women number{i} live here." for i in range(20_000))
    rows = [(0, text)] + [(i, f"{'awful insult' if i % 3 == 0 else 'kind word'} filler{i % 20}") for i in range(1, 400)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    labels = spark.createDataFrame([(i, int(i % 3 == 0)) for i in range(400)], "doc_id long, toxic int")
    start = time.time()
    model = T.fit(docs, labels)
    assert time.time() - start < 60 and len(model["index"]) > 0  # 20 s on an idle machine


def test_score_keeps_columns_of_any_name(spark):
    docs = spark.createDataFrame([(1, "a b", 1, 2, 3)], "doc_id long, text string, `a b` int, score int, `c.d` int")
    labels = spark.createDataFrame([(1, 1)], "doc_id long, toxic int")
    out = T.score(docs, T.fit(docs, labels), docs.columns)
    assert out.columns == ["doc_id", "text", "a b", "c.d", "score"] and out.first()["c.d"] == 3
