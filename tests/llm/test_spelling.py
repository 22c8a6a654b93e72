import random
import re
from collections import Counter
from zlib import crc32

import numpy as np
import pytest

from segkit.llm import spelling
from tests.llm.brute import LOWER, awkward_documents


def counted(rows, least_letters=6, least=5):
    total = Counter()
    for doc, text in rows:
        for raw in re.findall("[A-Za-z\u00C0-\u00FF]+", text or ""):
            run = raw.translate(LOWER)
            h = crc32(f"{'' if doc is None else doc}:{run}".encode())
            if h % 199 == 0:
                run = run[:h % len(run)] + run[h % len(run) + 1:]
            total[run] += 1
    return {w: n for w, n in total.items() if len(w) >= least_letters and n >= least}


def one_edit(a, b):
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    if len(a) > len(b):
        a, b = b, a
    return len(b) == len(a) + 1 and any(b[:i] + b[i + 1:] == a for i in range(len(b)))


def expected(words, ratio=5):
    form, near = {}, {w: [x for x in words if one_edit(w, x)] for w in words}
    for w, n in words.items():
        best = min(near[w], key=lambda x: (-words[x], x), default=None)
        form[w] = best if best is not None and words[best] >= ratio * n else None

    def root(w):
        while form[w] is not None:
            w = form[w]
        return w
    return sorted((w, form[w], root(w), n, len(near[w]), words[form[w]] if form[w] else None) for w, n in words.items())


def collected(df):
    return sorted(tuple(r) for r in df.select("word", "form", "root", "n", "n_near", "form_n").collect())


def test_rows_equal_brute_force(spark):
    from tests.conftest import SF_SMALL
    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet")
    rows = [(r["doc_id"], r["text"]) for r in docs.collect()]
    want = counted(rows)
    assert {r["word"]: r["n"] for r in spelling.word_counts(docs.repartition(5)).collect()} == want
    few = dict(sorted(want.items(), key=lambda x: crc32(x[0].encode()))[:700])
    words = spark.createDataFrame(list(few.items()), "word string, n long")
    assert collected(spelling.variants(words)) == expected(few)


@pytest.mark.parametrize("cell, letters", [(16, 2_000_000), (40, 300), (16_384, 2_000_000)])
def test_pairs_in_groups_of_any_size(spark, cell, letters):
    rng = random.Random(5)
    words = {"".join(rng.choice("abé") for _ in range(rng.choice([1, 2, 3, 4, 5, 6, 7, 90]))) for _ in range(400)}
    words |= {"a" * k for k in range(1, 9)} | {"a" * 80 + "b" * k for k in range(12)}
    want = sorted((w, x) for w in words for x in words if one_edit(w, x))
    df = spark.createDataFrame([(w, 1) for w in words], "word string, n long")
    got = sorted((r["word"], r["near"]) for r in spelling.near_words(df, cell, letters).collect())
    assert got == want


def test_bitsets_find_replaced_and_added_letters():
    words = ["abcdef", "abcdeg", "xbcdef", "abcdeff", "abxcdef", "zabcdef", "abcdefz", "ghijkl"]
    letters = spelling.letter_table(words, 7)
    index = spelling.PositionIndex(letters, np.array([len(w) for w in words]), 6, np.unique(letters))
    q1, w1, q2, w2 = index.near(letters[:1, :6])
    assert w1.tolist() == [1, 2] and w2.tolist() == [3, 4, 5, 6] and not q1.any() and not q2.any()


def test_chains_end_at_their_last_form(spark):
    words = {"aaaaaa": 5, "aaaaab": 25, "aaaabb": 125, "aaabbb": 625, "aabbbb": 3125, "zzzzzz": 9}
    df = spark.createDataFrame(list(words.items()), "word string, n long")
    got = collected(spelling.variants(df))
    assert got == expected(words)
    assert dict((r[0], r[2]) for r in got)["aaaaaa"] == "aabbbb"


def test_ties_take_the_smallest_form(spark):
    words = {"bbbbbb": 5, "bbbbbc": 50, "abbbbb": 50, "bbbbbé": 50}
    df = spark.createDataFrame(list(words.items()), "word string, n long")
    assert dict((r[0], r[1]) for r in collected(spelling.variants(df)))["bbbbbb"] == "abbbbb"


def test_awkward_rows_and_empty_tables(spark):
    docs = awkward_documents(spark)
    rows = [(r["doc_id"], r["text"]) for r in docs.collect()]
    assert collected(spelling.digest(docs)) == expected(counted(rows))
    assert spelling.digest(docs.limit(0)).count() == 0
    odd = spark.createDataFrame([(None, "Straße straße STRAßE straßes × ÀÉÈàéè " * 4), (2, "Straße straßé " * 3), (2, "Straße straßé " * 3)], "doc_id long, text string")
    assert collected(spelling.digest(odd)) == expected(counted([(r["doc_id"], r["text"]) for r in odd.collect()]))
