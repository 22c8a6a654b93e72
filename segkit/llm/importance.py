"""Target-distribution importance resampling over hashed word n-grams, by batch concatenation.

A batch's texts are joined with a sentinel byte that no word holds, and one regex pass over the joined bytes finds all words.
``searchsorted`` on the texts' offsets says whose each word is; a pair of words from two texts is masked, and what is left goes
to ``bincount``.  A bigram's crc32 comes from its words' (crc32 is linear over bits, so the first word's is carried over the
second's bytes by table look-ups), so no bigram is ever built as bytes.  A long text is worked through in pieces that remember
the last word.

1. Every task adds up one vector of ``buckets`` counts; the vectors of documents and target meet in one aggregate.
2. A bucket's gain is floor(1000 * ln of the smoothed ratio of its shares); ``buckets`` numbers, so they travel with the task.
3. A text's weight is the floored mean of its features' gains; a keyed Gumbel number is added, and the highest scores are
   drawn, which samples without replacement in proportion to the weights' exponentials.

Ranks come from range partitions (``ranks.ranked``): no task holds more than its range.

Null and empty texts have no features, weight 0 and no rank; repeated rows have equal scores and ranks of their own; a null
doc_id draws its number for the empty id and ranks first among equal scores; extra columns are ignored by ``scored`` and kept by
``resampled_documents``; an empty target or table gives gains of the smoothing alone, and an empty table an empty result.
"""

from __future__ import annotations

import math
import re
from zlib import crc32

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from segkit.llm.components import written
from segkit.llm.frames import columns, free_name
from segkit.llm.ranks import ranked
from segkit.llm.tokens import slices

BUCKETS = 10_000
PIECE = 1 << 20
SENTINEL = b"\n"
WORD = re.compile(rb"[0-9a-z\x80-\xff]+")   # [^\x00-\x2F\x3A-\x60\x7B-\x7F]+ over the bytes of lower-cased UTF-8
BREAK = re.compile(rb"[^0-9a-z\x80-\xff]")
LOWER = bytes(range(65)) + bytes(range(97, 123)) + bytes(range(91, 256))
CARRIED = 64                                # words of up to so many bytes are carried over by tables


def carry_tables() -> np.ndarray:
    """[k, j, b]: the crc32 register b << 8j after k zero bytes."""
    step = np.arange(256, dtype=np.uint32)
    for _ in range(8):
        step = np.where(step & 1, np.uint32(0xEDB88320) ^ (step >> np.uint32(1)), step >> np.uint32(1))
    out = np.empty((CARRIED + 2, 4, 256), np.uint32)
    out[0] = np.arange(256, dtype=np.uint32) << (np.uint32(8) * np.arange(4, dtype=np.uint32)[:, None])
    for k in range(1, CARRIED + 2):
        out[k] = step[out[k - 1] & np.uint32(255)] ^ (out[k - 1] >> np.uint32(8))
    return out


class Grams:
    """Buckets of all unigrams and bigrams of a batch of texts."""

    def __init__(self, buckets: int = BUCKETS):
        self.buckets, self.tables, self.blank = np.uint32(buckets), carry_tables(), crc32(b" ")

    def carried(self, crc: np.ndarray, size: np.ndarray) -> np.ndarray:
        """crc32 registers after ``size`` more zero bytes."""
        out = self.tables[size, 0, crc & np.uint32(255)]
        for j in (1, 2, 3):
            out = out ^ self.tables[size, j, crc >> np.uint32(8 * j) & np.uint32(255)]
        return out

    def bigrams(self, crc: np.ndarray, size: np.ndarray, words) -> np.ndarray:
        """crc32 of "first second" for each word and the next; ``words(i)`` are the bytes of word i."""
        short = np.minimum(size[1:], CARRIED)
        out = self.carried(crc[:-1], short + 1) ^ self.carried(np.full(len(short), self.blank, np.uint32), short) ^ crc[1:]
        for i in np.flatnonzero(size[1:] > CARRIED):
            out[i] = crc32(words(i + 1), crc32(b" ", int(crc[i])))
        return out

    def of(self, texts: list[bytes]):
        """Per piece of the joined texts: (text of each feature, bucket of each feature, text of each word)."""
        joined = SENTINEL.join(texts).translate(LOWER)
        offsets = np.concatenate([[0], np.cumsum([len(t) + 1 for t in texts])])
        at, last = 0, None  # last: text, crc32 and length of the word before this piece
        while at < len(joined):
            found = BREAK.search(joined, min(at + PIECE, len(joined)))
            end = found.start() if found else len(joined)
            spans = np.array([m.span() for m in WORD.finditer(joined, at, end)], np.int64).reshape(-1, 2)
            at = end + 1
            if not len(spans):
                continue
            crc = np.fromiter((crc32(joined[a:b]) for a, b in spans.tolist()), np.uint32, len(spans))
            doc = np.searchsorted(offsets, spans[:, 0], side="right") - 1
            size = spans[:, 1] - spans[:, 0]
            first = 0
            if last is not None:
                doc, crc, size, first = np.append(last[0], doc), np.append(np.uint32(last[1]), crc), np.append(last[2], size), 1
            pairs = self.bigrams(crc, size, lambda i: joined[spans[i - first, 0]:spans[i - first, 1]])
            inside = doc[1:] == doc[:-1]
            yield (np.concatenate([doc[first:], doc[1:][inside]]), np.concatenate([crc[first:], pairs[inside]]) % self.buckets, doc[first:])
            last = doc[-1], crc[-1], size[-1]


def _bytes(column: pa.Array) -> list[bytes]:
    return [t or b"" for t in column.cast(pa.large_binary()).to_pylist()]


def bucket_counts(docs: DataFrame, buckets: int = BUCKETS) -> DataFrame:
    """(bucket, n): features of all texts; every task sends ``buckets`` rows at most."""
    def run(batches):
        grams, total = Grams(buckets), np.zeros(buckets, np.int64)
        for batch in batches:
            for part in slices(batch, "text", PIECE):
                for _, bucket, _ in grams.of(_bytes(part.column("text"))):
                    total += np.bincount(bucket, minlength=buckets)
        at = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(at.astype(np.int32)), pa.array(total[at])], names=["bucket", "n"])
    return docs.select("text").mapInArrow(run, "bucket int, n long").groupBy("bucket").agg(F.sum("n").alias("n"))


def gains(docs: DataFrame, target: DataFrame, buckets: int = BUCKETS) -> np.ndarray:
    """floor(1000 * ln((t + 1) (S + buckets) / ((s + 1) (T + buckets)))) per bucket."""
    sides = bucket_counts(docs, buckets).withColumn("side", F.lit(0)).unionByName(bucket_counts(target, buckets).withColumn("side", F.lit(1)))
    counts = np.zeros((2, buckets))
    for r in sides.collect():  # 2 * buckets rows at most
        counts[r["side"], r["bucket"]] = r["n"]
    (raw, goal), (all_raw, all_goal) = counts, counts.sum(axis=1)
    ratio = (goal + 1) * (all_raw + buckets) / ((raw + 1) * (all_goal + buckets))
    return np.array([math.floor(1000 * math.log(x)) for x in ratio], np.int64)


def scored(docs: DataFrame, target: DataFrame, buckets: int = BUCKETS, key: int = 7) -> DataFrame:
    """(doc_id, text_hash, n_words, n_features, weight, score) of every row; texts are those of ``docs`` and ``target``."""
    gain = gains(docs, target, buckets)

    def run(batches):
        grams = Grams(buckets)
        for batch in batches:
            for part in slices(batch, "text", PIECE):
                rows = part.num_rows
                features, words, total = np.zeros(rows, np.int64), np.zeros(rows, np.int64), np.zeros(rows, np.int64)
                for doc, bucket, word_doc in grams.of(_bytes(part.column("text"))):
                    features += np.bincount(doc, minlength=rows)
                    words += np.bincount(word_doc, minlength=rows)
                    total += np.bincount(doc, gain[bucket], rows).astype(np.int64)  # whole numbers, exact in a double
                yield pa.RecordBatch.from_arrays(
                    [part.column("doc_id"), part.column("text_hash"), pa.array(words), pa.array(features), pa.array(total // np.maximum(features, 1))],
                    names=["doc_id", "text_hash", "n_words", "n_features", "weight"])
    id_type = docs.schema["doc_id"].dataType.simpleString()
    rows = (docs.select("doc_id", F.xxhash64("text").alias("text_hash"), "text")
            .mapInArrow(run, f"doc_id {id_type}, text_hash long, n_words long, n_features long, weight long"))
    name = F.concat(F.lit(f"{key}:"), F.coalesce(F.col("doc_id").cast("string"), F.lit("")))
    h = F.conv(F.substring(F.sha2(name, 256), 1, 8), 16, 10).cast("double")
    return rows.withColumn("score", F.col("weight") + F.floor(-1000 * F.log(-F.log((h + 0.5) / F.lit(4294967296.0)))))


def drawn(docs: DataFrame, target: DataFrame, percent: int = 25, least_words: int = 20, buckets: int = BUCKETS, key: int = 7) -> DataFrame:
    """``scored`` with ``rank``: 1, 2, ... by falling score for the drawn rows, null for the others."""
    rows = written(scored(docs, target, buckets, key), "importance")
    able = rows.where(F.col("n_words") >= least_words)
    many = percent * able.count() // 100
    order = [F.desc("score"), F.asc_nulls_first("doc_id"), F.asc("text_hash")]
    best = ranked(able, order).withColumn("rank", F.when(F.col("rank") <= many, F.col("rank")))
    return best.unionByName(rows.where(F.col("n_words") < least_words).withColumn("rank", F.lit(None).cast("long")))


def digest(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """One row per document: its weight, its score, and its rank where it is drawn."""
    return drawn(docs, benchmark).select("doc_id", "n_features", "weight", F.col("score").cast("long").alias("score"), "rank")


def resampled_documents(docs: DataFrame, target: DataFrame, **how) -> DataFrame:
    """The drawn rows of ``docs`` with all their columns.

    Rows are told by (doc_id, text); of rows equal in both, as many stay as were drawn.
    """
    own = docs.columns
    text, times, copy = (free_name(docs, n) for n in ("text_hash", "times", "copy"))
    counts = drawn(docs, target, **how).where("rank is not null").groupBy("doc_id", "text_hash").agg(F.count("*").alias("times"))
    counts = counts.select(F.col("doc_id").alias("picked_id"), F.col("text_hash").alias("picked_text"), F.col("times").alias(times + "_"))
    counts = counts.toDF(*[free_name(docs, c) for c in counts.columns])
    picked_id, picked_text, picked_times = counts.columns
    marked = docs.withColumn(text, F.xxhash64("text"))
    same = marked["doc_id"].eqNullSafe(counts[picked_id]) & (marked[text] == counts[picked_text])
    inside = Window.partitionBy("doc_id", text).orderBy(text)
    return (marked.join(counts, same).withColumn(copy, F.row_number().over(inside))
            .where(F.col(copy) <= F.col(picked_times)).select(*columns(own)))
