"""Counterfactually regularised toxicity classifier.

Features of a text: its words, and their prefixes of 3 to 6 characters (words of languages without a list of insults share
beginnings), each as presence and as share of the text's words.  ``top`` features are chosen by chi-squared over the training
sample.  A logistic model is fitted with an extra penalty: in sentences of the sample that name a group of people, the name is
swapped for another of its kind, and the squared change of the score is added to the loss, so that naming a group does not move
the score.

Learning uses a sample of about ``sample`` labelled rows (drawn by a hash of doc_id); scoring takes every whole text.

Null and empty texts have the score of no features; rows without a label are not learned from; a doc_id with several labels
counts as toxic if one says so; repeated rows get equal scores; extra columns are ignored; with no labels, or one class only, the
score is the smoothed share of label 1.
"""

from __future__ import annotations

import re
from itertools import islice

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from segkit.llm.frames import extended, numbered
from segkit.llm.kn_words import DRAWS, draw_limit, fold
from segkit.llm.tokens import WordHasher, letter_digit_words, slices

SAMPLE, TOP, CACHE = 10_000, 1_000, 500_000
PAIRS = 4096  # sentence pairs looked at together
#: Names of groups of people; a name is swapped for the next one of its kind.
KINDS = (("women", "men"), ("woman", "man"), ("girls", "boys"), ("christians", "muslims", "jews", "hindus", "buddhists", "atheists"),
         ("christian", "muslim", "jewish", "hindu", "buddhist", "atheist"), ("black", "white", "asian", "latino", "arab"),
         ("gay", "straight", "lesbian", "bisexual"), ("transgender", "cisgender"), ("immigrants", "natives", "refugees"),
         ("deaf", "blind", "disabled"), ("old", "young"), ("mexican", "chinese", "russian", "american", "german", "french", "indian", "african"),
         ("frauen", "männer"), ("muslime", "christen", "juden"), ("femmes", "hommes"), ("musulmans", "chrétiens", "juifs"),
         ("mujeres", "hombres"), ("musulmanes", "cristianos", "judíos"))
SWAP = {name: kind[(i + 1) % len(kind)] for kind in KINDS for i, name in enumerate(kind)}
SENTENCE = re.compile(r"[^.!?\n]+")
WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
LOWER = {i: i + 32 for i in range(65, 91)}


def word_features(word: str) -> list[str]:
    return ["w:" + word] + ["p:" + word[:k] for k in (3, 4, 5, 6) if len(word) > k]


class Features:
    """Per slice of texts: (row, feature, count) of the features in ``index``; each distinct word is looked at once."""

    def __init__(self, index: dict[str, int] | None = None):
        self.hasher, self.index, self.known = WordHasher(letter_digit_words()), index, {}

    def _of(self, key: int, raw: bytes):
        found = self.known.get(key)
        if found is None:
            if len(self.known) >= CACHE:
                self.known.clear()
            names = word_features(raw.decode("utf-8", "replace").translate(LOWER))
            found = self.known[key] = names if self.index is None else [self.index[f] for f in names if f in self.index]
        return found

    def words(self, texts: pa.Array):
        """(distinct words' features, word number of each token, offsets)."""
        h, offsets, starts, ends, data = self.hasher.words_of(texts)
        distinct, first, which = np.unique(h, return_index=True, return_inverse=True)
        return [self._of(int(k), data[starts[i]:ends[i]].tobytes()) for k, i in zip(distinct, first)], which, offsets

    def counts(self, texts: pa.Array):
        """(row, feature number, count, words per row)."""
        found, which, offsets = self.words(texts)
        size = np.array([len(f) for f in found], np.int64)
        flat = np.array([x for f in found for x in f], np.int64)
        start = np.concatenate([[0], np.cumsum(size)])
        token = np.flatnonzero(size[which] > 0) if len(which) else np.zeros(0, np.int64)
        n = size[which[token]] if len(token) else token
        ends = np.cumsum(n)
        feature = flat[np.arange(ends[-1]) + np.repeat(start[which[token]] - (ends - n), n)] if len(token) else flat[:0]
        row = np.repeat(np.searchsorted(offsets, token, side="right") - 1, n)
        width = len(self.index) + 1
        pair, count = np.unique(row * width + feature, return_counts=True)
        return pair // width, pair % width, count, np.diff(offsets)


def values(rows: np.ndarray, features: np.ndarray, counts: np.ndarray, words: np.ndarray, top: int):
    """(row, column, value): presence in columns 0 to top-1, share of the words in the next ``top``."""
    share = np.minimum(2.0, 30.0 * counts / np.maximum(words[rows], 1))
    return np.concatenate([rows, rows]), np.concatenate([features, features + top]), np.concatenate([np.ones(len(rows)), share])


def sentence_pairs(text: str) -> list[tuple[str, str]]:
    """Sentences that name a group, each with the sentence where every name is swapped for the next of its kind."""
    out = []
    for s in SENTENCE.findall((text or "").translate(LOWER)):
        if any(w in SWAP for w in WORD.findall(s)):
            out.append((s, WORD.sub(lambda m: SWAP.get(m[0], m[0]), s)))
    return out


def pair_rows(features: Features, texts: list[str | None], top: int):
    """(columns, differences) of each sentence that names a group and its swapped one; work in proportion to the sentences' length."""
    found = (p for t in texts for p in sentence_pairs(t))
    while some := list(islice(found, PAIRS)):
        sides = []
        for side in zip(*some):
            rows, cols, counts, words = features.counts(pa.array(side, pa.string()))
            sides.append(values(rows, cols, counts, words, top))
        (r1, c1, v1), (r2, c2, v2) = sides
        key = np.concatenate([r1, r2]) * (2 * top) + np.concatenate([c1, c2])
        distinct, where = np.unique(key, return_inverse=True)
        change = np.bincount(where, np.concatenate([v1, -v2]), len(distinct))
        distinct, change = distinct[change != 0], change[change != 0]
        cuts = np.searchsorted(distinct, np.arange(len(some) + 1) * (2 * top))
        for a, b in zip(cuts[:-1], cuts[1:]):
            yield (distinct[a:b] % (2 * top)).tolist(), change[a:b].tolist()


def choose(labelled: DataFrame, top: int) -> list[str]:
    """The features that tell label 1 best by chi-squared, over ``labelled`` (text, toxic)."""
    totals = labelled.agg(F.count("*").alias("n"), F.sum("toxic").alias("t")).first()
    if not totals["n"] or not totals["t"] or totals["t"] == totals["n"]:
        return []

    def run(batches):
        features = Features()
        for batch in batches:
            for part in slices(batch, "text"):
                toxic = part.column("toxic").to_numpy()
                found, which, offsets = features.words(part.column("text"))
                seen: dict[str, list[int]] = {}
                for r in range(part.num_rows):
                    for f in {f for w in np.unique(which[offsets[r]:offsets[r + 1]]) for f in found[w]}:
                        c = seen.setdefault(f, [0, 0])
                        c[0] += 1
                        c[1] += int(toxic[r])
                yield pa.RecordBatch.from_arrays([pa.array(list(seen), pa.string()), pa.array([c[0] for c in seen.values()], pa.int64()),
                                                  pa.array([c[1] for c in seen.values()], pa.int64())], names=["f", "n", "t"])
    n, t = float(totals["n"]), float(totals["t"])
    a, b = F.col("t").cast("double"), (F.col("n") - F.col("t")).cast("double")
    c, d = F.lit(t) - a, F.lit(n - t) - b
    chi = F.pow(a * d - b * c, 2) / ((a + b) * (c + d) * t * (n - t) + 1e-9)
    return [r["f"] for r in labelled.select("text", "toxic").mapInArrow(run, "f string, n long, t long").groupBy("f")
            .agg(F.sum("n").alias("n"), F.sum("t").alias("t")).where("n >= 5").where(a * d > b * c)
            .orderBy(chi.desc(), "f").limit(top).select("f").collect()]


def descend(rows, cols, vals, y: np.ndarray, pairs, width: int, ridge: float = 3e-4, fairness: float = 1.0, steps: int = 400):
    """Weights and bias by Adam on the logistic loss, the ridge and the counterfactual penalty; all data in every step.

    ``pairs`` holds (pair, column, difference) of swapped sentences.
    """
    n, (pr, pc, pv) = len(y), pairs
    many = int(pr.max()) + 1 if len(pr) else 0
    w, m, v = np.zeros(width), np.zeros(width), np.full(width, 1e-8)
    b = float(np.log((y.sum() + 0.5) / (n - y.sum() + 0.5)))
    for step in range(1, steps + 1):
        p = 1 / (1 + np.exp(-(np.bincount(rows, vals * w[cols], n) + b)))
        g = np.bincount(cols, vals * (p - y)[rows], width) / n + ridge * w
        if many:
            change = np.bincount(pr, pv * w[pc], many)
            g += 2 * fairness * np.bincount(pc, pv * change[pr], width) / many
        m, v = 0.9 * m + 0.1 * g, 0.999 * v + 0.001 * g * g
        w -= 0.05 * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.999**step)) + 1e-8)
        b -= 0.3 * float((p - y).mean())
    return w, b


def fit(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE, top: int = TOP, fairness: float = 1.0) -> dict:
    """Learns from texts of ``docs`` (doc_id, text) whose doc_id is in ``labels`` (doc_id, toxic)."""
    known = labels.where("doc_id is not null and toxic is not null").groupBy(F.col("doc_id").alias("_id")).agg(F.max("toxic").cast("int").alias("toxic"))
    drawn = known.where(F.pmod(F.xxhash64("_id"), F.lit(DRAWS)) < draw_limit(sample, known.count()))
    # about ``sample`` rows of two numbers, whatever the input: small enough to broadcast
    labelled = docs.select("doc_id", "text").join(F.broadcast(drawn), F.col("doc_id") == F.col("_id")).select("text", "toxic").persist()
    names = choose(labelled, top)
    index = {f: i for i, f in enumerate(names)}
    width = 2 * len(names)

    def run(batches):
        features = Features(index)
        for batch in batches:
            for part in slices(batch, "text"):
                toxic, texts = part.column("toxic").to_numpy(), part.column("text")
                r, f, c, words = features.counts(texts)
                cut = np.searchsorted(r, np.arange(part.num_rows + 1))
                out = []
                for i in range(part.num_rows):
                    a, z = cut[i], cut[i + 1]
                    _, col, val = values(np.zeros(z - a, np.int64), f[a:z], c[a:z], words[i:i + 1], len(names))
                    out.append(("text", int(toxic[i]), col.tolist(), val.tolist()))
                if names:
                    out += [("pair", 0, cols, vals) for cols, vals in pair_rows(features, texts.to_pylist(), len(names))]
                kind, y, cols, vals = zip(*out)
                yield pa.RecordBatch.from_arrays([pa.array(kind, pa.string()), pa.array(y, pa.int32()), pa.array(cols, pa.list_(pa.int64())),
                                                  pa.array(vals, pa.list_(pa.float64()))], names=["kind", "y", "cols", "vals"])

    data = labelled.mapInArrow(run, "kind string, y int, cols array<long>, vals array<double>").toArrow()  # bounded by the sample
    labelled.unpersist()
    texts = data.filter(pc.equal(data.column("kind"), "text"))
    y = texts.column("y").to_numpy().astype(float)
    model = {"index": index, "weights": np.zeros(width), "bias": float(np.log((y.sum() + 0.5) / (len(y) - y.sum() + 0.5)))}
    if not names:
        return model

    def flat(t):
        size = pc.list_value_length(t.column("cols")).to_numpy().astype(np.int64)
        return (np.repeat(np.arange(t.num_rows), size), pc.list_flatten(t.column("cols")).to_numpy().astype(np.int64),
                pc.list_flatten(t.column("vals")).to_numpy())
    pairs = data.filter(pc.equal(data.column("kind"), "pair"))
    model["weights"], model["bias"] = descend(*flat(texts), y, flat(pairs), width, fairness=fairness)
    return model


def score(docs: DataFrame, model: dict, keep: list[str]) -> DataFrame:
    """``keep`` columns and score (0 to 1) of every text; a kept column of that name is replaced."""
    keep = [c for c in keep if c.lower() != "score"]
    schema = extended(docs, keep, score=T.DoubleType())
    plain, kept = numbered(docs, keep, "text")

    def run(batches):
        features, top = Features(model["index"]), len(model["index"])
        for batch in batches:
            for part in slices(batch, "text"):
                rows, cols, vals = values(*features.counts(part.column("text")), top)
                logit = np.bincount(rows, vals * model["weights"][cols], part.num_rows) + model["bias"]
                yield pa.RecordBatch.from_arrays([part.column(c) for c in kept] + [pa.array(1 / (1 + np.exp(-logit)))], names=schema.names)
    return plain.mapInArrow(run, schema)


def digest(docs: DataFrame, labels: DataFrame, threshold: float = 0.3) -> DataFrame:
    """One row per document: its score by a model of the labels outside the held-out fold."""
    rows = docs.select("doc_id", "text", (fold(4) == 2).alias("held_out"))
    model = fit(rows.where("not held_out"), labels.where(fold(4) != 2))
    return score(rows, model, ["doc_id", "held_out"]).withColumn("predicted", (F.col("score") >= threshold).cast("int"))
