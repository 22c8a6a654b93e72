"""Benchmark decontamination by winnowing.

With windows of ``span`` = 13 words, k-grams of ``k`` = 7 words and winnows of ``span - k + 1`` = 7
k-grams, every 13-word window keeps its smallest k-gram hash (the rightmost on ties).  Equal windows
keep the same k-gram, so each window that a text and an item share shows as an equal fingerprint in
both.  Items of fewer words than ``span`` are one window: their whole word sequence is the fingerprint,
and texts are fingerprinted at every position for the few lengths that occur (fewer than ``span``).

1. A bit filter of fixed size over the item fingerprints (``bitfilter``; exact afterwards, so a full
   filter costs time, not results) drops text fingerprints that no item has.
2. Fingerprints are joined on their hash.  Each carries the words around it, and a hit is extended word by
   word to both sides; runs of at least a window are hits.
3. Runs are merged per document.

A passage that many documents share is a frequent join key on the document side only; item fingerprints are
distinct per (hash, context), and adaptive execution splits a skewed key.

Null and empty texts have no words and are clean; items without words are ignored; repeated document rows
count as one document each with equal results; a repeated item_id contributes all its texts' windows; null
item_ids match but are not named; ``clean_documents`` keeps extra columns, whatever their names.  An empty benchmark leaves every document clean.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from segkit.llm import bitfilter
from segkit.llm.components import written
from segkit.llm.frames import plainly
from segkit.llm.tokens import GOLDEN, WordHasher, letter_digit_words, mix, signed, slices



def kgram_hashes(words: np.ndarray, k: int) -> np.ndarray:
    """Hash of the k words from each position of a whole array (callers mask what crosses a text's end)."""
    n = len(words) - k + 1
    h = np.zeros(max(n, 0), np.uint64)
    for j in range(k):
        h = mix(h * np.uint64(3) + words[j:j + len(h)] + np.uint64(j + 1) * GOLDEN)
    return h


def winnow(words: np.ndarray, offsets: np.ndarray, span: int, k: int) -> tuple[np.ndarray, np.ndarray]:
    """(positions, hashes) of the k-grams that are the smallest of some window of ``span`` words inside one text."""
    h = kgram_hashes(words, k)
    w = span - k + 1
    windows = len(words) - span + 1
    if windows <= 0:
        return np.zeros(0, np.int64), np.zeros(0, np.uint64)
    best, at = h[:windows].copy(), np.zeros(windows, np.int64)
    for j in range(1, w):
        other = h[j:j + windows]
        smaller = other <= best
        best[smaller] = other[smaller]
        at[smaller] = j
    doc = np.searchsorted(offsets, np.arange(windows), side="right") - 1
    inside = np.arange(windows) + span <= offsets[doc + 1]
    picked = np.unique((np.arange(windows) + at)[inside])
    return picked, h[picked]


def fingerprints(rows: DataFrame, key: str, span: int, k: int, lengths: list[int], whole_short: bool, bits: bytes | None) -> DataFrame:
    """(key, hash, pos, before, words, after): fingerprints with the words around them as blank-joined strings.

    ``whole_short``: texts of fewer than ``span`` words give one fingerprint, themselves (for items).  Otherwise every
    position gives one for each of ``lengths`` (for documents).  ``len`` tells the kinds apart: 0 for winnowed k-grams.
    ``bits``: filter that fingerprints must pass.
    """
    def run(batches):
        hasher = WordHasher(letter_digit_words())
        table = np.frombuffer(bits, np.uint8) if bits is not None else None

        for batch in batches:
            for part in slices(batch, "text"):
                words, offsets, starts, ends, data = hasher.words_of(part.column("text"))
                ids = part.column(key)
                found = [(*winnow(words, offsets, span, k), 0, k)]
                size = np.diff(offsets)
                if whole_short:
                    for m in range(1, span):
                        of = np.flatnonzero(size == m)
                        if len(of):
                            found.append((offsets[of], kgram_hashes(words, m)[offsets[of]], m, m))
                else:
                    for m in lengths:
                        h = kgram_hashes(words, m)
                        pos = np.arange(len(h))
                        if table is not None:
                            pos = pos[bitfilter.passes(table, mix(h + np.uint64(m)))]
                        doc = np.searchsorted(offsets, pos, side="right") - 1
                        pos = pos[pos + m <= offsets[doc + 1]]
                        found.append((pos, h[pos], m, m))
                out = {c: [] for c in ("row", "hash", "pos", "len", "before", "words", "after")}
                for pos, h, kind, m in found:
                    h = mix(h + np.uint64(kind))
                    if table is not None:
                        keep = bitfilter.passes(table, h)
                        pos, h = pos[keep], h[keep]
                    if not len(pos):
                        continue
                    doc = np.searchsorted(offsets, pos, side="right") - 1
                    side = span - k if kind == 0 else 0
                    left = np.maximum(offsets[doc], pos - side)
                    right = np.minimum(offsets[doc + 1], pos + m + side)
                    text = lambda a, b: " ".join(data[starts[i]:ends[i]].tobytes().decode("utf-8", "replace") for i in range(a, b))
                    out["row"].append(doc)
                    out["hash"].append(signed(h))
                    out["pos"].append(pos - offsets[doc])
                    out["len"].append(np.full(len(pos), kind))
                    out["before"] += [text(a, b) for a, b in zip(left, pos)]
                    out["words"] += [text(a, a + m) for a in pos]
                    out["after"] += [text(a + m, b) for a, b in zip(pos, right)]
                if out["row"]:
                    lower = lambda c: pa.array([x.translate(LOWER) for x in out[c]], pa.string())
                    yield pa.RecordBatch.from_arrays([
                        ids.take(pa.array(np.concatenate(out["row"]))), pa.array(np.concatenate(out["hash"])),
                        pa.array(np.concatenate(out["pos"]).astype(np.int64)), pa.array(np.concatenate(out["len"]).astype(np.int32)),
                        lower("before"), lower("words"), lower("after")], names=[key, "hash", "pos", "len", "before", "words", "after"])
    kind = dict(rows.dtypes)[key]
    return rows.select(key, "text").mapInArrow(run, f"{key} {kind}, hash long, pos long, len int, before string, words string, after string")


LOWER = {i: i + 32 for i in range(65, 91)}


def _run(a: str, b: str) -> Column:
    """Number of leading equal elements of two arrays."""
    return F.expr(f"aggregate(zip_with({a}, {b}, (x, y) -> x <=> y and x is not null), named_struct('n', 0, 'on', true), "
                  "(s, e) -> named_struct('n', s.n + int(s.on and e), 'on', s.on and e), s -> s.n)")


def hits(docs: DataFrame, items: DataFrame, id_col: str = "doc_id", item_col: str = "item_id", span: int = 13, k: int = 7) -> DataFrame:
    """(row id, item, start, end): runs of words of a document, half open, that cover windows of an item."""
    found = written(fingerprints(items, item_col, span, k, [], True, None)
                    .groupBy("hash", "len", "before", "words", "after", item_col).agg(F.count("*").alias("times")), "item-prints")
    lengths = sorted(r["len"] for r in found.select("len").distinct().collect() if r["len"])  # fewer than span values
    prints = fingerprints(docs, id_col, span, k, lengths, False, bitfilter.build(found, "hash"))
    items_side = found.select(F.col("hash").alias("i_hash"), F.col("len").alias("i_len"), F.col("before").alias("i_before"),
                              F.col("words").alias("i_words"), F.col("after").alias("i_after"), F.col(item_col).alias("_item"))
    both = (prints.join(items_side, (F.col("hash") == F.col("i_hash")) & (F.col("len") == F.col("i_len")) & (F.col("words") == F.col("i_words")))
            .withColumn("_l", _run("reverse(split(before, ' '))", "reverse(split(i_before, ' '))"))
            .withColumn("_r", _run("split(after, ' ')", "split(i_after, ' ')"))
            # an empty side splits into one empty string
            .withColumn("_l", F.when((F.col("before") == "") | (F.col("i_before") == ""), 0).otherwise(F.col("_l")))
            .withColumn("_r", F.when((F.col("after") == "") | (F.col("i_after") == ""), 0).otherwise(F.col("_r")))
            .withColumn("_n", F.when(F.col("len") == 0, F.lit(k)).otherwise(F.col("len")))
            .where((F.col("len") > 0) | (F.col("_l") + F.col("_n") + F.col("_r") >= span)))
    return both.select(id_col, F.col("_item"), (F.col("pos") - F.col("_l")).alias("start"), (F.col("pos") + F.col("_n") + F.col("_r")).alias("end"))


def contamination(docs: DataFrame, items: DataFrame, span: int = 13, k: int = 7) -> DataFrame:
    """(row, n_hit, items) for rows with hits; rows are told apart by ``_row``, which ``docs`` must have beside text."""
    runs = hits(docs, items, "_row", "item_id", span, k)
    covered = (runs.groupBy("_row", "start").agg(F.max("end").alias("end"))
               .withColumn("_before", F.max("end").over(Window.partitionBy("_row").orderBy("start").rowsBetween(Window.unboundedPreceding, -1)))
               .groupBy("_row").agg(F.sum(F.greatest(F.lit(0), F.col("end") - F.greatest("start", F.coalesce("_before", F.lit(0))))).alias("n_hit")))
    named = (runs.select("_row", "_item").distinct().groupBy("_row")
             .agg(F.collect_set(F.col("_item").cast("string")).alias("items"), F.count("_item").alias("n_items")))
    return covered.join(named, "_row")


def word_count(texts: DataFrame, key: str) -> DataFrame:
    """(key, n_words) with this module's words."""
    def run(batches):
        hasher = WordHasher(letter_digit_words())
        for batch in batches:
            for part in slices(batch, "text"):
                _, offsets, *_ = hasher.words_of(part.column("text"))
                yield pa.RecordBatch.from_arrays([part.column(key), pa.array(np.diff(offsets).astype(np.int64))], names=[key, "n_words"])
    return texts.select(key, "text").mapInArrow(run, f"{key} {dict(texts.dtypes)[key]}, n_words long")


def row_key() -> Column:
    """What tells document rows apart; rows with equal id and text have equal results."""
    return F.struct(F.col("doc_id"), F.xxhash64("text").alias("h"))


def judged(docs: DataFrame, items: DataFrame, min_percent: int = 5) -> DataFrame:
    """(_both, n_words, n_hit, n_items, items, contaminated) for every document row; _both is its row key."""
    keyed = docs.select(row_key().alias("_row"), "text")
    found = contamination(keyed, items)
    every = word_count(keyed.withColumnRenamed("_row", "_both"), "_both")
    n_hit = F.coalesce("n_hit", F.lit(0)).cast("long")
    return (every.join(found, F.col("_both") == F.col("_row"), "left")
            .select("_both", "n_words", n_hit.alias("n_hit"), F.coalesce("n_items", F.lit(0)).cast("long").alias("n_items"),
                    F.coalesce("items", F.array().cast("array<string>")).alias("items"),
                    ((n_hit > 0) & (n_hit * 100 >= F.col("n_words") * min_percent)).alias("contaminated")))


def digest(docs: DataFrame, items: DataFrame) -> DataFrame:
    """One row per document row: what the benchmark has in common with it."""
    return judged(docs, items).select(
        F.col("_both.doc_id").alias("doc_id"), "n_words", "n_hit", "n_items",
        F.sha2(F.array_join(F.array_sort("items"), ","), 256).alias("items_sha256"), "contaminated")


def clean_documents(docs: DataFrame, items: DataFrame) -> DataFrame:
    """The documents that are not contaminated, with all their columns."""
    docs, restored = plainly(docs, "doc_id", "text")
    bad = judged(docs, items).where("contaminated").select("_both").distinct()
    return restored(docs.join(bad.hint("merge"), row_key() == F.col("_both"), "left_anti"))
