import math
import zlib
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from segkit.llm import kn_langid as L
from segkit.llm.kn_words import DRAWS, draw_limit
from tests.conftest import SF_MID
from tests.llm import brute


def test_level_probabilities_match_brute_force():
    text = "abracadabra abc bracad zebra abrac cadabra"
    points, offsets = L.code_points(pa.array([text, text[5:], "dada"]))
    codes = {ord(c): i + 3 for i, c in enumerate("abcdrze")}
    keys, n = np.unique(L.packed(L.coded(points, codes), offsets, 4), return_counts=True)
    levels, uniform = L.fit_levels(keys, n, 4)
    top = {tuple((int(k) >> (16 * j)) & 0xFFFF for j in (3, 2, 1, 0)): int(c) for k, c in zip(keys, n)}
    counts = {4: Counter(top)}
    for m in (3, 2, 1):
        counts[m] = Counter(g[1:] for g in counts[m + 1])
    p = {}
    assert uniform == 1 / (len(counts[1]) + 1)
    for m in (1, 2, 3, 4):
        d = [0, *L.discounts(*(sum(c == x for c in counts[m].values()) for x in (1, 2, 3, 4)))]
        seen = defaultdict(list)
        for g, c in counts[m].items():
            seen[g[:-1]].append(c)
        for g, c in counts[m].items():
            cs = seen[g[:-1]]
            below = uniform if m == 1 else p[g[1:]]
            p[g] = (c - d[min(c, 3)]) / sum(cs) + sum(d[min(x, 3)] for x in cs) / sum(cs) * below
    got = {int(k): v for _, ks, ps, *_ in levels[-1:] for k, v in zip(ks, ps)}
    for g in counts[4]:
        assert got[sum(x << (16 * (3 - j)) for j, x in enumerate(g))] == pytest.approx(p[g])
    for h in {g[:-1] for g in counts[4]}:  # with the mass for unseen characters below, all is at most one
        assert sum(p[g] for g in counts[4] if g[:-1] == h) <= 1 + 1e-9


def test_held_out_accuracy(spark):
    docs = spark.read.parquet(f"{SF_MID}/documents.parquet")
    rows = L.digest(docs).join(docs.select("doc_id", "lang", "text"), "doc_id").collect()
    held = [r for r in rows if r["held_out"]]
    assert all(r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 5 == 0) for r in rows)
    assert sum(r["lang"] == r["lang_pred"] for r in held) > 0.97 * len(held)
    assert all(0 <= r["score"] <= 1 for r in rows)
    assert sum(r["rejected"] for r in rows) <= 0.01 * len(rows)


def test_noise_is_rejected_and_awkward_rows(spark):
    docs = spark.read.parquet(f"{SF_MID}/documents.parquet").select("doc_id", "text", "lang")
    model = L.fit(docs)
    rng = np.random.default_rng(1)
    noise = spark.createDataFrame([(i, "".join(chr(rng.integers(0x4E00, 0x9FFF)) for _ in range(200))) for i in range(5)]
                                  + [(9, None), (10, "12 ... 34"), (11, "")], "doc_id long, text string")
    rows = L.predict(noise, model, ["doc_id"]).collect()
    assert all(r["rejected"] for r in rows)
    assert all((r["lang_pred"] == "und") == (r["doc_id"] >= 9) for r in rows)
    odd = brute.awkward_documents(spark)
    out = {r["doc_id"]: r for r in L.digest(odd).collect()}
    assert out[2]["lang_pred"] == "und" and L.digest(odd).count() == odd.count()
    assert L.identified_documents(odd).columns == odd.columns
    assert L.digest(odd.limit(0)).collect() == []
    unknown = spark.createDataFrame([(1, "abc", None)], "doc_id long, text string, lang string")
    assert L.digest(unknown).first()["lang_pred"] == "und"
    assert math.isclose(L.digest(unknown).first()["score"], 0.0)


def test_a_language_with_very_many_rows_is_learned(spark):
    """25 million rows a language, 20 wanted: a share below one in a million."""
    rows = spark.range(50_000_000).select(
        F.col("id").alias("doc_id"), F.expr("if(id % 2 = 0, 'the cat sat on the mat ', 'der hund und die katze ') || id").alias("text"),
        F.expr("if(id % 2 = 0, 'en', 'de')").alias("lang"))
    model = L.fit(rows, per_language=20)
    assert sorted(model["uniform"]) == [0, 1]
    probe = spark.createDataFrame([(1, "the cat on the mat"), (2, "die katze und der hund")], "doc_id long, text string")
    assert {r["doc_id"]: r["lang_pred"] for r in L.predict(probe, model, ["doc_id"]).collect()} == {1: "en", 2: "de"}


def test_draw_limit():
    for n in (0, 1, 1999, 2000, 3000, 10**9, 2 * 10**9 + 1, 10**12, 10**17):
        limit = draw_limit(2000, n)
        assert limit == DRAWS if n <= 2000 else 0 < limit - DRAWS * 2000 / n + 1e4 < 2e4


SCHEMA = "doc_id long, text string, lang string"


def digest_of(spark, rows):
    return {r["doc_id"]: r for r in L.digest(spark.createDataFrame(rows, SCHEMA)).collect()}


def learned_ids():
    return [i for i in range(200) if zlib.crc32(str(i).encode()) % 5]


def in_calibration(spark, text):
    return spark.range(1).select(F.pmod(F.xxhash64(F.lit(text)), F.lit(10)) == 0).first()[0]


def test_texts_without_letters_teach_nothing(spark):
    a, b = learned_ids()[:2]
    out = digest_of(spark, [(a, "123", "en"), (b, "abc", None)])
    assert {r["lang_pred"] for r in out.values()} == {"und"} and all(r["rejected"] for r in out.values())
    out = digest_of(spark, [(a, "123", "xx"), (b, "some words of text", "en")])
    assert out[a]["lang_pred"] == "und" and out[b]["lang_pred"] == "en"


def test_a_language_whose_texts_all_fall_into_the_calibration_tenth_is_learned(spark):
    a, b, c = learned_ids()[:3]
    text = next(t for t in (f"der hund und die katze {x}" for x in "abcdefghijklmnopqrstuvwxyzäöü") if in_calibration(spark, t))
    out = digest_of(spark, [(a, text, "de"), (b, "the cat sat on the mat and the dog", "en"), (c, "the cat and the dog and the mat", "en")])
    assert out[a]["lang_pred"] == "de" and not out[a]["rejected"] and out[b]["lang_pred"] == "en"
    alone = digest_of(spark, [(a, text, "de")])
    assert alone[a]["lang_pred"] == "de"


def test_rare_letters_have_codes_of_their_own(monkeypatch):
    monkeypatch.setattr(L, "PLAIN", 5)
    codes = L.Codes([ord(c) for c in "abcdefghijklmnopqrstuvwxyz"])
    points, offsets = L.code_points(pa.array(["ab cd", "zyx", "", "éa"]))
    got, cut = codes.of(points, offsets)
    words = [tuple(got[a:b].tolist()) for a, b in zip(cut[:-1], cut[1:])]
    plain = lambda i: L.OTHER + 1 + i
    assert words == [(plain(0), plain(1), L.BLANK, plain(2), plain(3)), (65531, plain(0), 65532, plain(4), 65532, plain(3)), (), (L.OTHER, plain(0))]
    single = {tuple(codes.of(np.array([ord(c)], np.uint32), np.array([0, 1]))[0].tolist()) for c in "abcdefghijklmnopqrstuvwxyz"}
    assert len(single) == 26


def test_pieces_give_the_same_codes_and_ngrams(monkeypatch):
    long = "Ab  c, d! éÉ 12 \n xyz " * 50
    whole = L.code_points(pa.array([long]))
    codes = L.Codes([ord(c) for c in "abcdéxyz"])
    texts = pa.array(["ab", long, "", "x"])
    keys = L.packed(*codes.of(*L.code_points(texts)), 4)
    for size in (1, 2, 7, 64):
        monkeypatch.setattr(L, "SLICE", size)
        assert L.code_points(pa.array([long]))[0].tolist() == whole[0].tolist()
        monkeypatch.setattr(L, "SLICE", 1 << 19)
        c, offsets = codes.of(*L.code_points(texts))
        monkeypatch.setattr(L, "SLICE", size)
        pieces = list(L.packed_pieces(c, offsets, 4))
        assert np.concatenate([k for k, _ in pieces]).tolist() == keys.tolist()
        assert np.concatenate([d for _, d in pieces]).tolist() == np.repeat(np.arange(4), np.diff(offsets)).tolist()


def test_columns_of_any_name_are_kept(spark):
    docs = spark.read.parquet(f"{SF_MID}/documents.parquet").limit(60)
    odd = docs.select("*", *[F.lit(i).alias(n) for i, n in enumerate(["score", "rejected", "lang_pred", "a b", "c.d", "e`f"])])
    kept = L.identified_documents(odd)
    assert kept.columns == odd.columns and sorted(map(str, kept.collect())) == sorted(str(r) for r in odd.collect() if r["doc_id"] in {k["doc_id"] for k in kept.collect()})
    model = L.fit(docs)
    assert L.predict(odd, model, odd.columns).columns == [c for c in odd.columns if c not in ("score", "rejected", "lang_pred")] + ["lang_pred", "score", "rejected"]
