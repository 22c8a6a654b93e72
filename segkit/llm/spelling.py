"""Spelling variants by a bit-sliced position index.

Words and their counts come from whole texts.  Two words are near if one inserted, deleted or replaced code point turns one into
the other.

* Routing.  Let the shorter of two near words have L letters.  Either both begin with the same L div 2 letters or both end with
  the same L - L div 2.  Each word is sent under both affixes, once as a word of length L and once as one of length L + 1, and a hash
  deals the affixes of a length to groups of about ``CELL`` words.  A pair meets under its common prefix, or under its common suffix
  if the prefixes differ, so it is found once.  A group beyond the bound is cut into chunks and worked off as pairs of chunks.
* Index.  A group's words are one bit each; for every (position, letter) a bitset tells which words have it there.
* Search.  All words of length L are looked up at once against the whole group, letter by letter, with three bitsets each:
  no error (Z), one letter replaced (S), one letter more (X).  With b the bitset of (position, letter) and b' that of the next position:
  S = (S & b) | (Z & ~b);  Z = Z & b;  X = (X & b') | Z.  At the end S counts for words of L letters and X for those of L + 1.

A word's form is its near word with the largest count, if that is ``ratio`` times its own at least; chains of forms are followed to
their end by pointer doubling.  Counts grow along a chain by ``ratio`` a step, which bounds the rounds by the logarithm of the largest.

Null and empty texts have no words; repeated rows count as often as they occur; a null doc_id is the empty id; words of any
length are handled (the groups' bound falls with the length); extra columns are ignored; an empty table gives an empty result.
"""

from __future__ import annotations

import re
from collections import Counter
from zlib import crc32

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from segkit.llm.components import written
from segkit.llm.tokens import slices

LETTERS = r"[A-Za-zÀ-ÿ]"
LOWER = {i: i + 32 for i in range(65, 91)}
CELL, CELL_LETTERS = 16_384, 2_000_000   # words and letters of a group
HELD = 300_000                           # distinct words a task counts before it hands them on
CLASSES = 64                             # longer words share the number of groups
BATCH = 1 << 17                          # 64-bit words of a batch's bitsets


def word_counts(docs: DataFrame, least_letters: int = 6, least: int = 5, period: int = 199) -> DataFrame:
    """(word, n) of the runs of letters in all texts.

    Where ``period`` divides the crc32 of ``<doc_id>:<run>``, the run loses the letter at crc32 mod its length.  Runs only lose letters, so
    those of fewer than ``least_letters`` are not looked at.
    """
    run_of = re.compile(LETTERS + "{%d,}" % max(least_letters, 1))

    def count(batches):
        held: Counter = Counter()

        def out():
            return pa.RecordBatch.from_arrays([pa.array(list(held), pa.string()), pa.array(list(held.values()), pa.int64())], names=["word", "n"])

        for batch in batches:
            for part in slices(batch, "text", 1 << 20):
                for doc, text in zip(part.column("id").to_pylist(), part.column("text").to_pylist()):
                    start = crc32((doc + ":").encode())
                    for raw, n in Counter(m[0] for m in run_of.finditer(text or "")).items():
                        run = raw.translate(LOWER)
                        h = crc32(run.encode(), start)
                        if h % period == 0:
                            at = h % len(run)
                            run = run[:at] + run[at + 1:]
                        if len(run) >= least_letters:
                            held[run] += n
                    if len(held) > HELD:
                        yield out()
                        held.clear()
        yield out()
    ids = F.coalesce(F.col("doc_id").cast("string"), F.lit("")).alias("id")
    return (docs.select(ids, "text").mapInArrow(count, "word string, n long").groupBy("word").agg(F.sum("n").alias("n"))
            .where(F.col("n") >= least))


def letter_table(words: list[str], width: int) -> np.ndarray:
    """Code points of the words, filled up with 0."""
    raw = "".join(w.ljust(width, "\0") for w in words).encode("utf-32-le", "surrogatepass")
    return np.frombuffer(raw, np.uint32).reshape(len(words), width)


class PositionIndex:
    """Bitsets per (position, letter) over words of ``length`` and ``length`` + 1 letters."""

    def __init__(self, letters: np.ndarray, sizes: np.ndarray, length: int, alphabet: np.ndarray):
        self.length, self.alphabet, self.words = length, alphabet, len(letters)
        self.width = -(-self.words // 64)
        codes = np.searchsorted(alphabet, letters)
        at = np.arange(self.words)
        self.sets = np.zeros((length + 1, len(alphabet), self.width), np.uint64)
        for i in range(length + 1):
            has = np.zeros((len(alphabet), self.width * 64), bool)
            has[codes[:, i], at] = True
            self.sets[i] = self._packed(has)
        self.same, self.longer = self._packed(self._padded(sizes == length)), self._packed(self._padded(sizes == length + 1))

    def _padded(self, bits: np.ndarray) -> np.ndarray:
        return np.concatenate([bits, np.zeros(self.width * 64 - len(bits), bool)])

    @staticmethod
    def _packed(bits: np.ndarray) -> np.ndarray:
        return np.packbits(bits, axis=-1, bitorder="little").view(np.uint64)

    def near(self, queries: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """(query, word) with one letter replaced, and (query, word) with one letter more in the word."""
        codes = np.searchsorted(self.alphabet, queries)
        none = np.full((len(queries), self.width), ~np.uint64(0))
        more, swapped = none.copy(), np.zeros_like(none)
        for i in range(self.length):
            here = self.sets[i][codes[:, i]]
            swapped &= here
            swapped |= none & ~here
            none &= here
            more &= self.sets[i + 1][codes[:, i]]
            more |= none
        return *self._members(swapped & self.same), *self._members(more & self.longer)

    @staticmethod
    def _members(sets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        row, block = np.nonzero(sets)
        bits = np.unpackbits(sets[row, block].view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        which, bit = np.nonzero(bits)
        return row[which], block[which] * 64 + bit


def near_in_cell(words: list[str], chunk: np.ndarray, length: int, side: str, pair: tuple[int, int]):
    """(word, near) numbers: every pair between the two chunks once in each direction, told apart by ``side``."""
    sizes = np.array([len(w) for w in words])
    letters = letter_table(words, length + 1)
    alphabet = np.unique(letters)
    half = length // 2
    left, right = [], []
    for a, b in {pair, pair[::-1]}:
        asked, have = np.flatnonzero((chunk == a) & (sizes == length)), np.flatnonzero(chunk == b)
        if not len(asked) or not len(have):
            continue
        index = PositionIndex(letters[have], sizes[have], length, alphabet)
        step = max(1, BATCH // index.width)
        for at in range(0, len(asked), step):
            q1, w1, q2, w2 = index.near(letters[asked[at:at + step], :length])
            q1, w1, q2, w2 = asked[at + q1], have[w1], asked[at + q2], have[w2]
            left += [q1, q2, w2]
            right += [w1, w2, q2]
    if not left:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    left, right = np.concatenate(left), np.concatenate(right)
    same = (letters[left, :half] == letters[right, :half]).all(axis=1)
    kept = same == (side == "prefix")
    return left[kept], right[kept]


def near_words(words: DataFrame, cell: int = CELL, cell_letters: int = CELL_LETTERS) -> DataFrame:
    """(word, near, near_n): all pairs one edit apart, in both directions; ``words`` has distinct words and n."""
    length = F.char_length("word")
    lengths = {r["c"]: r["n"] for r in words.groupBy(F.least(length, F.lit(CLASSES + 1)).alias("c")).agg(F.count("*").alias("n")).collect()}  # bounded by CLASSES
    groups = [max(1, -(-(lengths.get(c, 0) + lengths.get(c + 1, 0)) // max(16, min(cell, cell_letters // max(c, 1))))) for c in range(CLASSES + 1)]
    role = F.explode(F.array(*[F.struct((length - k).alias("length"), F.lit(s).alias("side")) for k in (0, 1) for s in ("prefix", "suffix")]))
    half = F.expr("length div 2")
    affix = F.when(F.col("side") == "prefix", F.expr("left(word, cast(length div 2 as int))")).otherwise(
        F.when(F.char_length("word") == F.col("length"), F.expr("substring(word, cast(length div 2 as int) + 1)"))
        .otherwise(F.expr("substring(word, cast(length div 2 as int) + 2)")))
    routed = (words.select("word", "n", role.alias("r")).select("word", "n", "r.*")
              .withColumn("group", F.pmod(F.xxhash64(affix), F.get(F.array(*[F.lit(g) for g in groups]), F.least("length", F.lit(CLASSES)).cast("int"))).cast("int")))
    keys = ["length", "side", "group"]
    chunks = F.greatest(F.ceil(F.col("m") / cell), F.ceil(F.col("m") * F.col("length") / cell_letters)).cast("int")
    large = routed.groupBy(*keys).agg(F.count("*").alias("m")).select(*keys, chunks.alias("chunks")).where("chunks > 1")
    placed = (routed.join(large, keys, "left").withColumn("chunks", F.coalesce("chunks", F.lit(1)))
              .withColumn("chunk", F.pmod(F.xxhash64("word"), F.col("chunks")).cast("int"))
              .withColumn("other", F.explode(F.expr("sequence(0, chunks - 1)")))
              .select("word", "n", *keys, "chunk", F.least("chunk", "other").alias("one"), F.greatest("chunk", "other").alias("two")))

    def search(key, table):
        at = dict(zip(("length", "side", "group", "one", "two"), (k.as_py() for k in key)))
        names, n = table.column("word").to_pylist(), table.column("n").to_numpy()
        a, b = near_in_cell(names, table.column("chunk").to_numpy(), at["length"], at["side"], (at["one"], at["two"]))
        column = table.column("word").combine_chunks()
        return pa.table({"word": column.take(pa.array(a)), "near": column.take(pa.array(b)), "near_n": pa.array(n[b])})
    return placed.groupBy(*keys, "one", "two").applyInArrow(search, "word string, near string, near_n long")


def roots(forms: DataFrame, most: int, ratio: int) -> DataFrame:
    """(word, root) for words that have a form: the end of each chain, by pointer doubling."""
    steps = 0
    while most >= ratio ** (steps + 1):
        steps += 1
    now = forms.select("word", F.col("form").alias("root"))
    for _ in range(max(steps, 1).bit_length()):
        on = now.select(F.col("word").alias("from"), F.col("root").alias("to"))
        now = written(now.join(on, F.col("root") == F.col("from"), "left").select("word", F.coalesce("to", "root").alias("root")), "roots")
    return now


def variants(words: DataFrame, ratio: int = 5) -> DataFrame:
    """(word, n, n_near, form, form_n, root) of every row of ``words`` (distinct words with n)."""
    words = written(words, "words")
    near = near_words(words).groupBy("word").agg(F.count("*").alias("n_near"), F.min(F.struct((-F.col("near_n")).alias("less"), "near")).alias("best"))
    joined = words.join(near, "word", "left")
    fits = -F.col("best.less") >= ratio * F.col("n")
    table = written(joined.select("word", "n", F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"),
                                  F.when(fits, F.col("best.near")).alias("form"), F.when(fits, -F.col("best.less")).alias("form_n")), "forms")
    most = words.agg(F.max("n").alias("n")).first()["n"] or 1
    ends = roots(table.where("form is not null"), most, ratio)
    return table.join(ends, "word", "left").withColumn("root", F.coalesce("root", "word"))


def digest(docs: DataFrame) -> DataFrame:
    """One row per word of at least 6 letters and 5 occurrences: its near words, its form and its root."""
    return variants(word_counts(docs)).select("word", "form", "root", "n", "n_near", "form_n")
