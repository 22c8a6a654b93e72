"""Interpolated modified Kneser-Ney word model: counted in Spark, stored as sorted arrays, mapped by workers.

* Vocabulary: words are hashed (64 bits); each task counts its own, ranges of the hash space (one for every ``RANGE_BYTES`` of text) are
  merged as Spark groups, and each range becomes a sorted array of hashes with its counts.  A word's id is its place in these arrays.
  An n-gram's key is its ids side by side where they fit into 64 bits, and a hash of them otherwise.
* N-grams of the highest order are counted the same way over ids.  A distinct n-gram adds one to the continuation count
  of its suffix, level by level down to words.  Ranges cut n-grams by their own hash, so a frequent context is spread
  over all ranges; its totals (sum, and how many n-grams have count 1, 2, 3+) are merged by context in a second step.  Counts travel and
  are added up as 64-bit numbers and stored in one byte each, with a list of the large ones.
* Discounts come from the counts of counts of each level.
* Workers map the arrays of the shared folder and look up each slice's distinct words and n-grams in sorted order.

Every text ends with one end token; contexts before the first word are padded with a begin id, which is never
predicted.  Unknown words share the mass that the lowest level leaves to the uniform distribution over V + 1.

Null and empty texts are the end token alone; repeated rows count as often as they occur; a null doc_id's text is
empty for the fold rule (so it is learned from); extra columns are ignored; with nothing to learn from, every token has
probability 1 / (V + 1) = 1.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from segkit.llm import store
from segkit.llm.components import written
from segkit.llm.frames import extended, numbered
from segkit.llm.store import SortedCounts, merged, planes, range_of, save_counts, unplanes
from segkit.llm.tokens import GOLDEN, WordHasher, mix, segment_sums, slices, space_words

END = np.uint64(0x656E64)  # hash of the end token; word hashes are 64-bit mixes
HELD = 700_000             # n-grams that a task merges before it hands them on
RANGE_BYTES = 16 << 20     # bytes of text for each range of keys; at most one n-gram for every two of them
ROW = "kind string, part int, n long, keys binary, counts binary, extra binary"
TOTALS = ("total", "one", "two", "three")  # of a context: all counts, and how many n-grams have count 1, 2, 3 and more
SLICE = 1 << 20            # bytes of texts that a worker scores at a time
_OPEN: dict = {}           # a worker's open models


def fold(modulus: int, id_col: str = "doc_id") -> Column:
    """crc32 of the id as text, modulo ``modulus``."""
    return F.pmod(F.crc32(F.encode(F.coalesce(F.col(id_col).cast("string"), F.lit("")), "UTF-8")), F.lit(modulus))


DRAWS = 2**62


def draw_limit(wanted: int, n: int) -> int:
    """Rows with a hash modulo ``DRAWS`` below this are ``wanted`` of ``n`` on average; above 0 for any n."""
    return min(DRAWS, -(-DRAWS * wanted // max(n, 1)))


def _rows(rows: list[tuple]) -> pa.RecordBatch:
    kind, part, n, keys, counts, extra = zip(*rows)
    return pa.RecordBatch.from_arrays([pa.array(kind, pa.string()), pa.array(part, pa.int32()), pa.array(n, pa.int64()),
                                       pa.array(keys, pa.binary()), pa.array(counts, pa.binary()), pa.array(extra, pa.binary())],
                                      names=["kind", "part", "n", "keys", "counts", "extra"])


def _deal(kind: str, keys: np.ndarray, counts: np.ndarray, part: np.ndarray, ranges: int, extra: np.ndarray | None = None):
    """One row per range: its sorted keys with counts (rows of ``extra`` go along)."""
    order = np.argsort(part, kind="stable")
    cuts = np.searchsorted(part[order], np.arange(ranges + 1))
    rows = []
    for r in np.flatnonzero(np.diff(cuts)):
        at = order[cuts[r]:cuts[r + 1]]
        rows.append((kind, int(r), len(at), planes(keys[at]), _wide(counts[at]), _wide(extra[at]) if extra is not None else None))
    return rows


def _wide(numbers: np.ndarray) -> bytes:
    """Rows of 64-bit numbers, byte plane by byte plane."""
    return np.ascontiguousarray(np.ascontiguousarray(numbers, np.uint64).view(np.uint8).reshape(len(numbers), -1).T).tobytes()


def _narrow(blob: bytes, n: int) -> np.ndarray:
    """What ``_wide`` packed: n rows, flat if they have one column."""
    out = np.ascontiguousarray(np.frombuffer(blob, np.uint8).reshape(-1, n).T).view(np.int64)
    return out.ravel() if out.shape[1] == 1 else out


def _gather(table: pa.Table):
    """(keys, counts, extra or None) of a group's rows."""
    ns = table.column("n").to_pylist()
    keys = [unplanes(b) for b in table.column("keys").to_pylist()]
    counts, extra = ([_narrow(b, n) for b, n in zip(table.column(c).to_pylist(), ns) if b is not None] for c in ("counts", "extra"))
    return np.concatenate(keys), np.concatenate(counts), np.concatenate(extra) if extra else None


class Keys:
    """64-bit keys of n-grams of ids up to ``most``: side by side where they fit, hashed otherwise."""

    def __init__(self, most: int):
        self.width = max(int(most).bit_length(), 1)

    def fits(self, order: int) -> bool:
        return order * self.width <= 64

    def of(self, cols: list[np.ndarray]) -> np.ndarray:
        h = np.zeros(len(cols[0]), np.uint64)
        for c in cols:
            c = c.astype(np.uint64)
            h = (h << np.uint64(self.width) if self.width < 64 else np.uint64(0)) | c if self.fits(len(cols)) else mix(h * np.uint64(3) + c + GOLDEN)
        return h

    def apart(self, keys: np.ndarray, order: int) -> list[np.ndarray]:
        """The ids of keys that fit."""
        mask = np.uint64((1 << self.width) - 1)
        return [keys >> np.uint64(self.width * k) & mask for k in range(order - 1, -1, -1)]


def _ends(words: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Words with an end token after each text, and the new offsets."""
    return np.insert(words, offsets[1:], END), offsets + np.arange(len(offsets))


def _grams(ids: np.ndarray, offsets: np.ndarray, order: int, begin: int) -> list[np.ndarray]:
    """The ``order`` id columns of each token's n-gram, padded with ``begin`` at the start of a text."""
    place = np.arange(len(ids)) - np.repeat(offsets[:-1], np.diff(offsets))
    cols = []
    for back in range(order - 1, 0, -1):
        shifted = np.full(len(ids), begin, np.uint64)
        shifted[back:] = ids[:max(len(ids) - back, 0)]
        cols.append(np.where(place >= back, shifted, np.uint64(begin)))
    return [*cols, ids]


class Vocabulary:
    """Sorted word hashes of all ranges; ids follow their order."""

    def __init__(self, handle: str, ranges: int, sizes: dict[int, int]):
        self.table = SortedCounts(handle, "words", ranges, sorted(sizes), ["count"])
        first, at = np.zeros(ranges, np.int64), 0
        for r in range(ranges):
            first[r] = at
            at += sizes.get(r, 0)
        self.first, self.size = first, at

    def ids(self, words: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(uint64 ids, training counts); unknown words get id V + 1 (V is the begin id)."""
        distinct, where = np.unique(words, return_inverse=True)
        found = self.table.find(distinct, distinct)
        ids = np.where(found["at"] >= 0, self.first[found["range"]] + found["at"], self.size + 1).astype(np.uint64)
        return ids[where], found["count"][where]


def _count_words(docs: DataFrame, folder: str, ranges: int) -> dict[int, tuple[int, int]]:
    def local(batches):
        hasher, held, size = WordHasher(space_words()), [], 0
        for batch in batches:
            for part in slices(batch, "text"):
                words, offsets, *_ = hasher.words_of(part.column("text"))
                held.append(np.unique(_ends(words, offsets)[0], return_counts=True))
                size += len(held[-1][0])
                if size > HELD:
                    keys, counts, _ = merged(*(np.concatenate(x) for x in zip(*held)))
                    yield _rows(_deal("words", keys, counts, range_of(keys, ranges), ranges))
                    held, size = [], 0
        if held:
            keys, counts, _ = merged(*(np.concatenate(x) for x in zip(*held)))
            yield _rows(_deal("words", keys, counts, range_of(keys, ranges), ranges))

    def reduce(key, table):
        keys, counts, _ = _gather(table)
        keys, counts, _ = merged(keys, counts)
        r = key[0].as_py()
        save_counts(folder, "words", r, keys, count=counts)
        return pa.table({"part": pa.array([r], pa.int32()), "n": pa.array([len(keys)], pa.int64()), "total": pa.array([int(counts.sum())], pa.int64())})

    out = docs.select("text").mapInArrow(local, ROW).repartition(ranges, "part").groupBy("part").applyInArrow(reduce, "part int, n long, total long")
    return {r["part"]: (r["n"], r["total"]) for r in out.collect()}  # one row a range


def _count_grams(docs: DataFrame, handle: str, ranges: int, sizes: dict[int, int], order: int, key: Keys) -> DataFrame:
    def local(batches):
        hasher, vocabulary, held, size = WordHasher(space_words()), Vocabulary(handle, ranges, sizes), [], 0

        def out(held):
            keys, counts, first = merged(np.concatenate([h[0] for h in held]), np.concatenate([h[1] for h in held]))
            extra = None if key.fits(order) else np.concatenate([h[2] for h in held])[first]
            return _rows(_deal("grams", keys, counts, range_of(mix(keys), ranges), ranges, extra))

        for batch in batches:
            for part in slices(batch, "text"):
                words, offsets = _ends(*hasher.words_of(part.column("text"))[:2])
                cols = _grams(vocabulary.ids(words)[0], offsets, order, vocabulary.size)
                keys, first, counts = np.unique(key.of(cols), return_index=True, return_counts=True)
                held.append((keys, counts, None if key.fits(order) else np.stack([c[first] for c in cols], axis=1)))
                size += len(keys)
                if size > HELD:
                    yield out(held)
                    held, size = [], 0
        if held:
            yield out(held)
    return docs.select("text").mapInArrow(local, ROW)


def _reduce_grams(rows: DataFrame, folder: str, ranges: int, level: int, key: Keys) -> DataFrame:
    """Writes level ``level``; returns its contexts' totals, its suffixes' continuation counts and its counts of counts."""
    def reduce(part, table):
        keys, counts, cols = _gather(table)
        keys, counts, first = merged(keys, counts)
        r = part[0].as_py()
        save_counts(folder, f"grams{level}", r, keys, count=counts)
        cols = key.apart(keys, level) if key.fits(level) else [c.astype(np.uint64) for c in cols[first].T]
        distinct, where = np.unique(key.of(cols[:-1]), return_inverse=True)
        totals = np.stack([_sums(where, c, len(distinct)) for c in (counts, counts == 1, counts == 2, counts >= 3)], axis=1)
        rows = _deal("context", distinct, totals, range_of(mix(distinct), ranges), ranges)
        shorter = cols[1:]
        skeys, sfirst, scounts = np.unique(key.of(shorter), return_index=True, return_counts=True)
        extra = None if key.fits(level - 1) else np.stack([c[sfirst] for c in shorter], axis=1)
        rows += _deal("suffix", skeys, scounts, range_of(mix(skeys), ranges), ranges, extra)
        small = np.array([(counts == c).sum() for c in (1, 2, 3, 4)], np.int64)
        rows.append(("small", r, len(keys), None, small.tobytes(), None))
        return pa.Table.from_batches([_rows(rows)])
    return written(rows.repartition(ranges, "part").groupBy("part").applyInArrow(reduce, ROW), f"grams{level}")


def _sums(where: np.ndarray, numbers: np.ndarray, n: int) -> np.ndarray:
    """Whole-number sums by place (a weighted bincount would go through doubles)."""
    out = np.zeros(n, np.int64)
    np.add.at(out, where, numbers.astype(np.int64))
    return out


def _reduce_contexts(rows: DataFrame, folder: str, ranges: int, level: int) -> list[int]:
    def reduce(part, table):
        keys, totals, _ = _gather(table)
        distinct, where = np.unique(keys, return_inverse=True)
        r = part[0].as_py()
        save_counts(folder, f"contexts{level}", r, distinct, **{name: _sums(where, totals[:, j], len(distinct)) for j, name in enumerate(TOTALS)})
        return pa.table({"part": pa.array([r], pa.int32())})
    out = rows.where("kind = 'context'").repartition(ranges, "part").groupBy("part").applyInArrow(reduce, "part int")
    return sorted(r["part"] for r in out.collect())  # one row a range


def _reduce_unigrams(rows: DataFrame, folder: str, ranges: int) -> tuple[list[int], list[int]]:
    """Writes the words' continuation counts; returns ranges and (sum, n1, n2, n3+, exact n3, exact n4)."""
    def reduce(part, table):
        keys, counts, _ = _gather(table)
        keys, counts, _ = merged(keys, counts)
        r = part[0].as_py()
        save_counts(folder, "grams1", r, keys, count=counts)
        small = [int(counts.sum()), *(int((counts == c).sum()) for c in (1, 2, 3, 4)), int((counts >= 3).sum())]
        return pa.table({"part": pa.array([r], pa.int32()), "small": pa.array([small], pa.list_(pa.int64()))})
    out = rows.where("kind = 'suffix'").repartition(ranges, "part").groupBy("part").applyInArrow(reduce, "part int, small array<long>").collect()
    return sorted(r["part"] for r in out), np.sum([r["small"] for r in out], axis=0).tolist() if out else [0] * 6


def discounts(n1: int, n2: int, n3: int, n4: int) -> list[float]:
    """D1, D2, D3+ of modified Kneser-Ney, kept inside (0, count); one half times the count where counts of counts are missing."""
    y = n1 / (n1 + 2 * n2) if n1 and n2 else 0.5
    raw = [1 - 2 * y * n2 / n1 if n1 and n2 else 0.5, 2 - 3 * y * n3 / n2 if n2 and n3 else 1.0, 3 - 4 * y * n4 / n3 if n3 and n4 else 1.5]
    return [min(max(d, 0.05), c - 0.05) for d, c in zip(raw, (1, 2, 3))]


def fit(train: DataFrame, order: int = 2) -> dict:
    """Counts the model over ``train.text`` and returns what ``score`` needs (numbers and the folder's handle)."""
    spark = train.sparkSession
    size = train.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    ranges = max(1, -(-size // RANGE_BYTES))
    folder = store.model_folder(spark, "kn-words")
    words = _count_words(train, folder, ranges)
    sizes = {r: n for r, (n, _) in words.items()}
    model = {"ranges": ranges, "sizes": sizes, "order": order, "V": sum(sizes.values()), "N": sum(t for _, t in words.values()),
             "present": {}, "contexts": {}, "discounts": {}}
    key = Keys(model["V"] + 1)
    rows = _count_grams(train, store.publish(spark, folder), ranges, sizes, order, key)
    for level in range(order, 1, -1):
        reduced = _reduce_grams(rows, folder, ranges, level, key)
        small = [r for r in reduced.where("kind = 'small'").select("part", "counts").collect()]  # one row a range
        model["present"][level] = sorted(r["part"] for r in small)
        model["discounts"][level] = discounts(*np.sum([np.frombuffer(r["counts"], np.int64) for r in small], axis=0).tolist()) if small else [0.5, 1.0, 1.5]
        model["contexts"][level] = _reduce_contexts(reduced, folder, ranges, level)
        rows = reduced.where("kind = 'suffix'")
    model["present"][1], (total, n1, n2, n3, n4, n3plus) = _reduce_unigrams(rows, folder, ranges)
    model["discounts"][1] = discounts(n1, n2, n3, n4)
    model["unigrams"] = (total, n1, n2, n3plus)
    model["handle"] = store.publish(spark, folder)
    return model


class Scorer:
    """The mapped model."""

    def __init__(self, model: dict):
        self.m = model
        h, r = model["handle"], model["ranges"]
        self.vocabulary, self.key = Vocabulary(h, r, model["sizes"]), Keys(model["V"] + 1)
        self.grams = {k: SortedCounts(h, f"grams{k}", r, model["present"][k], ["count"]) for k in range(1, model["order"] + 1)}
        self.contexts = {k: SortedCounts(h, f"contexts{k}", r, model["contexts"][k], list(TOTALS)) for k in range(2, model["order"] + 1)}

    def _discounted(self, level: int, counts: np.ndarray) -> np.ndarray:
        d = np.array([0.0, *self.m["discounts"][level]])
        return counts - d[np.minimum(counts, 3)]

    def probabilities(self, words: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(probability, training count) of each token; ``words`` hold the end tokens."""
        m, order = self.m, self.m["order"]
        ids, counts = self.vocabulary.ids(words)
        cols = _grams(ids, offsets, order, m["V"])
        total, n1, n2, n3 = m["unigrams"]
        key, where = np.unique(cols[-1].astype(np.uint64), return_inverse=True)
        c = self.grams[1].find(key, mix(key))["count"]
        d = m["discounts"][1]
        uniform = 1.0 / (m["V"] + 1)
        p = ((self._discounted(1, c) + (d[0] * n1 + d[1] * n2 + d[2] * n3) * uniform) / total)[where] if total else np.full(len(ids), uniform)
        for level in range(2, order + 1):
            part = cols[order - level:]
            key, where = np.unique(self.key.of(part), return_inverse=True)
            high = self._discounted(level, self.grams[level].find(key, mix(key))["count"])[where]
            key, where = np.unique(self.key.of(part[:-1]), return_inverse=True)
            t = self.contexts[level].find(key, mix(key))
            d = m["discounts"][level]
            left = d[0] * t["one"] + d[1] * t["two"] + d[2] * t["three"]
            seen = np.maximum(t["total"], 1)
            p = np.where((t["total"] > 0)[where], high / seen[where] + (left / seen)[where] * p, p)
        return p, counts


def score(docs: DataFrame, model: dict, keep: list[str]) -> DataFrame:
    """``keep`` columns with n_tokens, n_known, base_score and score (log10) of every text; kept columns of these names are replaced."""
    keep = [c for c in keep if c.lower() not in ("n_tokens", "n_known", "base_score", "score")]
    schema = extended(docs, keep, n_tokens=T.LongType(), n_known=T.LongType(), base_score=T.DoubleType(), score=T.DoubleType())
    rows, kept = numbered(docs, keep, "text")

    def run(batches):
        hasher = WordHasher(space_words())
        if model["handle"] not in _OPEN:
            _OPEN.clear()
            _OPEN[model["handle"]] = Scorer(model)
        scorer = _OPEN[model["handle"]]
        for batch in batches:
            for part in slices(batch, "text", SLICE):
                words, offsets = _ends(*hasher.words_of(part.column("text"))[:2])
                p, counts = scorer.probabilities(words, offsets)
                base = np.log10((counts + 1.0) / (model["N"] + model["V"] + 1.0))
                yield pa.RecordBatch.from_arrays(
                    [part.column(c) for c in kept] + [pa.array(np.diff(offsets).astype(np.int64)), pa.array(segment_sums((counts > 0).astype(np.int64), offsets)),
                                                      pa.array(segment_sums(base, offsets)), pa.array(segment_sums(np.log10(p), offsets))],
                    names=schema.names)
    return rows.mapInArrow(run, schema)


def digest(docs: DataFrame, order: int = 2) -> DataFrame:
    """One row per document: its score by a model of the documents outside the held-out fold."""
    rows = docs.select("doc_id", "text", (fold(7) == 2).alias("held_out"))
    model = fit(rows.where("not held_out"), order)
    return score(rows, model, ["doc_id", "held_out"]).select(
        "doc_id", "held_out", "n_tokens", "n_known", F.lit(model["N"]).cast("long").alias("train_tokens"), "base_score", "score")
