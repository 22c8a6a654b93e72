"""Language identification: one interpolated modified Kneser-Ney character model per language.

Learning takes a sample of labelled texts of about ``per_language`` rows a language (drawn by a hash of id and text, so
reruns agree); prediction takes every whole text.

* Texts are lower-cased; what is not a letter becomes one blank; letters not seen in learning share one code.  Codes have 16 bits; letters
  beyond the first ``PLAIN`` by frequency take two, so that no two learned letters share one.
* Each language's character n-grams are counted in Spark and fitted in one task per language (bounded by the sample):
  a level's n-grams with their interpolated probability and its contexts with the weight left for the level below, as
  sorted hash arrays in the shared folder, which workers map.
* A text's language has the lowest cross-entropy per character.  One tenth of the sample is kept from counting and
  calibrates rejection: a text is rejected where its best cross-entropy exceeds the mean of its language's calibration texts
  by ``tolerance`` standard deviations (of texts of that length: the spread of short texts is larger).  A language of which nothing is left
  without this tenth learns from all its texts and has no limit.

Workers hold about ``SLICE`` bytes of texts at a time; a longer text is coded and looked up in pieces.

Null texts and texts without a letter are ``und`` with score 0, and rejected; repeated rows get equal results; null languages
are not learned from, and neither are languages whose texts have no letter; columns beyond text, lang and id are ignored by ``digest`` and
kept by ``identified_documents``, whatever their names; an empty table gives an empty result, and with nothing to learn from all is ``und``.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from segkit.llm import store
from segkit.llm.frames import extended, numbered
from segkit.llm.kn_words import DRAWS, discounts, draw_limit, fold
from segkit.llm.store import SortedArrays, save_table
from segkit.llm.tokens import mix, slices

ORDER = 4
PER_LANGUAGE = 2000
BLANK, OTHER, BEGIN = 1, 2, 0  # codes of the blank, of letters that learning has not seen, and before a text
PLAIN = 60_000                 # the most frequent letters get one code, the others two
SLICE = 1 << 19                # bytes of texts, and characters of a long text, that a worker looks at together
_OPEN: dict = {}


def letter_table() -> np.ndarray:
    if "letters" not in _OPEN:
        _OPEN["letters"] = np.fromiter((chr(i).isalpha() for i in range(0x110000)), bool, 0x110000)
    return _OPEN["letters"]


def _letters(raw: np.ndarray, starts: np.ndarray, before: bool) -> tuple[np.ndarray, np.ndarray, bool]:
    """(letters and single blanks, which characters they were, whether the last is a letter); ``before``: the same of what precedes."""
    letter = letter_table()[raw]
    after = np.zeros(len(raw), bool)
    after[1:] = letter[:-1]
    after[:1] = before
    after[starts[starts < len(raw)]] = False
    keep = letter | after
    return np.where(letter, raw, np.uint32(32))[keep], keep, bool(letter[-1]) if len(letter) else before


def _raw(text: str) -> np.ndarray:
    return np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32)


def code_points(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(letters and single blanks as code points, offsets) of lower-cased texts; text ends are no blanks."""
    low = [t.lower() if t else "" for t in texts.to_pylist()]
    if len(low) == 1 and len(low[0]) > SLICE:
        found, before = [], False
        for at in range(0, len(low[0]), SLICE):
            points, _, before = _letters(_raw(low[0][at:at + SLICE]), np.zeros(0, np.int64), before)
            found.append(points)
        points = np.concatenate(found)
        return points, np.array([0, len(points)])
    offsets = np.concatenate([[0], np.cumsum([len(t) for t in low])]).astype(np.int64)
    points, keep, _ = _letters(_raw("".join(low)), offsets[:-1], False)
    return points, np.concatenate([[0], np.cumsum(keep)])[offsets]


def code_table(codes: dict[int, int]) -> np.ndarray:
    table = np.full(0x110000, OTHER, np.uint16)
    for point, code in codes.items():
        table[point] = code
    table[32] = BLANK
    return table


def coded(points: np.ndarray, codes: dict[int, int]) -> np.ndarray:
    return code_table(codes)[points]


class Codes:
    """Letters as 16-bit codes."""

    def __init__(self, letters: list[int]):
        """``letters``: code points by falling frequency."""
        pairs = {point: divmod(i, PLAIN) for i, point in enumerate(letters[PLAIN:])}
        self.table = code_table({point: OTHER + 1 + i for i, point in enumerate(letters[:PLAIN])} | {point: 65_535 - high for point, (high, _) in pairs.items()})
        self.second = np.zeros(0x110000, np.uint16)  # the second code of rare letters, 0 for all others
        for point, (_, low) in pairs.items():
            self.second[point] = OTHER + 1 + low
        self.any_rare = bool(pairs)

    def of(self, points: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(codes, offsets) of the texts."""
        first = self.table[points]
        if not self.any_rare:
            return first, offsets
        second = self.second[points]
        where = np.flatnonzero(second)
        return np.insert(first, where + 1, second[where]), offsets + np.searchsorted(where, offsets)


def packed(codes: np.ndarray, offsets: np.ndarray, order: int) -> np.ndarray:
    """Each position's n-gram, 16 bits a character, the last lowest."""
    place = np.arange(len(codes)) - np.repeat(offsets[:-1], np.diff(offsets))
    key = codes.astype(np.uint64)
    for back in range(1, order):
        shifted = np.zeros(len(codes), np.uint64)
        shifted[back:] = codes[:-back] if back < len(codes) else 0
        shifted[place < back] = BEGIN
        key |= shifted << np.uint64(16 * back)
    return key


def packed_pieces(codes: np.ndarray, offsets: np.ndarray, order: int):
    """(packed n-grams, text of each) of about ``SLICE`` positions at a time."""
    doc = np.repeat(np.arange(len(offsets) - 1), np.diff(offsets))
    for at in range(0, len(codes), SLICE):
        first, end = max(0, at - order + 1), min(len(codes), at + SLICE)
        # a piece's first positions see the letters before them, and those of other texts are none of theirs
        cuts = np.clip(offsets, first, end) - first
        yield packed(codes[first:end], cuts, order)[at - first:], doc[at:end]


def level_key(key: np.ndarray, level: int) -> np.ndarray:
    """The last ``level`` characters of packed n-grams, as a hash that differs by level."""
    return mix((key & np.uint64((1 << (16 * level)) - 1)) ^ np.uint64(level) << np.uint64(60)) if level < 4 else mix(key)


def fit_levels(keys: np.ndarray, counts: np.ndarray, order: int):
    """[(level, n-gram hashes, probabilities, context hashes, weights)], and the uniform probability below level 1."""
    levels = []
    at, c = keys, counts.astype(np.int64)
    for level in range(order, 0, -1):
        levels.append((level, at, c))
        if level > 1:
            at, c = np.unique(at & np.uint64((1 << (16 * (level - 1))) - 1), return_counts=True)
    out, lower_keys, lower_p = [], None, None
    uniform = 1.0 / (len(levels[-1][1]) + 1)
    for level, k, c in reversed(levels):
        n1, n2, n3, n4 = ((c == x).sum() for x in (1, 2, 3, 4))
        d = np.array([0.0, *discounts(int(n1), int(n2), int(n3), int(n4))])
        context = k >> np.uint64(16)
        distinct, where = np.unique(context, return_inverse=True)
        total = np.bincount(where, c)
        left = np.bincount(where, d[np.minimum(c, 3)]) / total
        below = np.full(len(k), uniform) if level == 1 else lower_p[np.searchsorted(lower_keys, k & np.uint64((1 << (16 * (level - 1))) - 1))]
        p = (c - d[np.minimum(c, 3)]) / total[where] + left[where] * below
        out.append((level, k, p, distinct, left))
        lower_keys, lower_p = k, p
    return out, uniform


def _context_key(context: np.ndarray, level: int) -> np.ndarray:
    return mix(context + (np.uint64(level) << np.uint64(58)) + np.uint64(0x1234567))


def fit(labelled: DataFrame, order: int = ORDER, per_language: int = PER_LANGUAGE) -> dict:
    """Learns from ``labelled`` (text, lang, and doc_id for the draw)."""
    spark = labelled.sparkSession
    rows = labelled.where("text is not null and lang is not null")
    found = sorted((r["lang"], r["n"]) for r in rows.groupBy("lang").agg(F.count("*").alias("n")).collect())  # one row a language
    model = {"order": order, "languages": [lang for lang, _ in found], "letters": [], "uniform": {}, "calibration": {}, "handle": None}
    if not found:
        return model
    draw = F.pmod(F.xxhash64("doc_id", "text"), F.lit(DRAWS))
    # one number a language, looked up in the plan: no join, so no text is shuffled
    number = F.array_position(F.array(*[F.lit(lang) for lang, _ in found]), F.col("lang")) - 1
    most = F.get(F.array(*[F.lit(draw_limit(per_language, n)).cast("long") for _, n in found]), number.cast("int"))
    sample = (rows.where(draw < most)
              .select(number.cast("int").alias("no"), "text", (F.pmod(F.xxhash64("text"), F.lit(10)) == 0).alias("kept")))

    def letters(batches):
        for batch in batches:
            for part in slices(batch, "text", SLICE):
                points, n = np.unique(code_points(part.column("text"))[0], return_counts=True)
                yield pa.RecordBatch.from_arrays([pa.array(points.astype(np.int32)), pa.array(n)], names=["point", "n"])

    alphabet = (sample.select("text").mapInArrow(letters, "point int, n long").where("point <> 32").groupBy("point").agg(F.sum("n").alias("n"))
                .orderBy(F.desc("n"), "point").collect())  # bounded by the letters of Unicode
    model["letters"] = [r["point"] for r in alphabet]

    def grams(batches):
        codes = Codes(model["letters"])
        for batch in batches:
            for part in slices(batch, "text", SLICE):
                no, kept = part.column("no").to_numpy(), part.column("kept").to_numpy(zero_copy_only=False)
                for lang in np.unique(no):
                    for own in (False, True):
                        points, offsets = code_points(part.filter(pa.array((no == lang) & (kept == own))).column("text"))
                        for keys, _ in packed_pieces(*codes.of(points, offsets), order):
                            keys, n = np.unique(keys, return_counts=True)
                            yield pa.RecordBatch.from_arrays([pa.array(np.full(len(keys), lang, np.int32)), pa.array(keys.view(np.int64)), pa.array(n * (not own)), pa.array(n)],
                                                             names=["no", "key", "n", "whole"])

    folder = store.model_folder(spark, "kn-langid")

    def one(key, table):
        no = key[0].as_py()
        keys, n, whole = (table.column(c).to_numpy() for c in ("key", "n", "whole"))
        last = not n.any()  # nothing is left beside the calibration texts
        n = whole if last else n
        keys, n = keys.view(np.uint64)[n > 0], n[n > 0]
        by = np.argsort(keys)
        levels, uniform = fit_levels(keys[by], n[by], order)
        for level, k, p, context, left in levels:
            for name, hashes, values in ((f"{no}-grams{level}", level_key(k, level), p), (f"{no}-contexts{level}", _context_key(context, level), left)):
                at = np.argsort(hashes)
                save_table(folder, name, 0, hashes[at], value=values[at])
        return pa.table({"no": pa.array([no], pa.int32()), "uniform": pa.array([uniform]), "last": pa.array([last])})

    fitted = (sample.mapInArrow(grams, "no int, key long, n long, whole long").groupBy("no", "key").agg(F.sum("n").alias("n"), F.sum("whole").alias("whole"))
              .groupBy("no").applyInArrow(one, "no int, uniform double, last boolean").collect())  # one row a language
    if not fitted:
        return model
    model |= {"uniform": {r["no"]: r["uniform"] for r in fitted}, "handle": store.publish(spark, folder)}
    kept = sample.where(F.col("kept") & F.col("no").isin([r["no"] for r in fitted if not r["last"]])).select("no", "text")

    def own(batches):
        scorer = _scorer(model)
        for batch in batches:
            for part in slices(batch, "text", SLICE):
                h, n = scorer.entropies(part.column("text"))
                no = part.column("no").to_numpy()
                yield pa.RecordBatch.from_arrays([part.column("no"), pa.array(np.array([h[l][i] for i, l in enumerate(no)], float)), pa.array(n)], names=["no", "h", "n"])

    stats = kept.mapInArrow(own, "no int, h double, n long").where("n >= 20").groupBy("no").agg(
        F.avg("h").alias("mean"), F.coalesce(F.stddev_pop("h"), F.lit(0.0)).alias("sd"),
        F.avg(F.sqrt("n")).alias("root")).collect()  # one row a language
    model["calibration"] = {r["no"]: (r["mean"], r["sd"], r["root"]) for r in stats}
    return model


class Scorer:
    def __init__(self, model: dict):
        self.m, self.codes = model, Codes(model["letters"])
        load = lambda name: SortedArrays(model["handle"], name, 1, [0], {"value": np.float64})
        self.tables = {no: [(load(f"{no}-grams{k}"), load(f"{no}-contexts{k}")) for k in range(1, model["order"] + 1)] for no in model["uniform"]}

    def _log(self, no: int, keys: np.ndarray) -> np.ndarray:
        """Natural log probabilities of distinct packed n-grams in one language."""
        p = np.full(len(keys), self.m["uniform"][no])
        for level, (grams, contexts) in enumerate(self.tables[no], 1):
            def value(table, hashes):
                by = np.argsort(hashes)
                out = table.find(hashes[by], hashes[by])
                back = np.empty(len(by), np.int64)
                back[by] = np.arange(len(by))
                return out["value"][back], (out["at"] >= 0)[back]
            full, seen = value(grams, level_key(keys, level))
            tail = keys & np.uint64((1 << (16 * level)) - 1) if level < 4 else keys
            left, known = value(contexts, _context_key(tail >> np.uint64(16), level))
            p = np.where(seen, full, np.where(known, left * p, p))
        return np.log(p)

    def entropies(self, texts: pa.Array) -> tuple[dict[int, np.ndarray], np.ndarray]:
        """({language: nats per character}, characters) per text; texts without letters have none."""
        codes, offsets = self.codes.of(*code_points(texts))
        n = np.diff(offsets)
        out = {no: np.zeros(len(n)) for no in self.tables}
        for keys, doc in packed_pieces(codes, offsets, self.m["order"]):
            coded = pa.array(keys).dictionary_encode()
            where, distinct = coded.indices.to_numpy(), coded.dictionary.to_numpy()
            for no, h in out.items():
                h -= np.bincount(doc, self._log(no, distinct)[where], len(n))
        return {no: h / np.maximum(n, 1) for no, h in out.items()}, n


def _scorer(model: dict) -> Scorer:
    if _OPEN.get("handle") != model["handle"]:
        _OPEN["handle"], _OPEN["scorer"] = model["handle"], Scorer(model)
    return _OPEN["scorer"]


def judge(texts: pa.Array, model: dict, tolerance: float = 8.0) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(number of the language or -1, score, rejected) of about ``SLICE`` bytes of texts."""
    rows = len(texts)
    if model["handle"] is None:
        return np.full(rows, -1), np.zeros(rows), np.ones(rows, bool)
    found, n = _scorer(model).entropies(texts)
    numbers = np.array(sorted(found))
    h = np.stack([found[no] for no in numbers])
    low = h.min(axis=0)
    best = np.where(n > 0, numbers[h.argmin(axis=0)], -1)
    # posterior of the best language, as if a text had no more than 40 independent characters
    score = 1 / np.exp(-(h - low) * np.minimum(n, 40)).sum(axis=0)
    limit = np.full(rows, np.inf)
    for no, (mean, sd, root) in model["calibration"].items():
        mine = best == no
        limit[mine] = mean + tolerance * max(sd, 0.02) * np.maximum(1.0, root / np.sqrt(np.maximum(n[mine], 1)))
    rejected = (best < 0) | (low > limit)
    return best, np.where(best < 0, 0.0, np.where(low > limit, score * np.exp(np.minimum(limit - low, 0.0)), score)), rejected


def predict(docs: DataFrame, model: dict, keep: list[str], tolerance: float = 8.0) -> DataFrame:
    """``keep`` columns, lang_pred, score (0 to 1) and rejected for every text; kept columns of these three names are replaced."""
    keep = [c for c in keep if c.lower() not in ("lang_pred", "score", "rejected")]
    schema = extended(docs, keep, lang_pred=T.StringType(), score=T.DoubleType(), rejected=T.BooleanType())
    names = np.array([*model["languages"], "und"], object)
    rows, kept = numbered(docs, keep, "text")

    def run(batches):
        for batch in batches:
            for part in slices(batch, "text", SLICE):
                best, score, rejected = judge(part.column("text"), model, tolerance)
                yield pa.RecordBatch.from_arrays([part.column(c) for c in kept] + [pa.array(names[best].tolist(), pa.string()), pa.array(score), pa.array(rejected)],
                                                 names=schema.names)
    return rows.mapInArrow(run, schema)


def digest(docs: DataFrame) -> DataFrame:
    """One row per document: predicted language; learned outside the held-out fold."""
    rows = docs.select("doc_id", "text", "lang", (fold(5) == 0).alias("held_out"))
    model = fit(rows.where("not held_out"))
    return predict(rows.select("doc_id", "held_out", "text"), model, ["doc_id", "held_out"]).select("doc_id", "held_out", "lang_pred", "score", "rejected")


def identified_documents(docs: DataFrame, tolerance: float = 8.0) -> DataFrame:
    """The documents whose language is told, with all their columns; only the texts go through Python."""
    model = fit(docs.select("doc_id", "text", "lang").where(fold(5) != 0))

    @F.arrow_udf(T.BooleanType())
    def told(texts: pa.Array) -> pa.Array:
        parts = [~judge(part.column("text"), model, tolerance)[2] for part in slices(pa.record_batch([texts], names=["text"]), "text", SLICE)]
        return pa.array(np.concatenate(parts) if parts else np.zeros(0, bool))
    return docs.where(told("text"))
