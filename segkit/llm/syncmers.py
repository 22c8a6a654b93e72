"""Document fingerprints from closed syncmers, with DataFrame functions only.

Words are hashed; an s-mer is ``s`` = 2 consecutive words, a k-mer ``k`` = 8.  A k-mer is an anchor where the
smallest of its k - s + 1 s-mer hashes is its first or its last: that depends on the k-mer's words alone,
so a passage keeps its anchors wherever it stands (up to its first and last words), and two anchors are never
far apart.  The fingerprint lists the anchors' 32-bit hashes in reading order, eight hexadecimal digits each;
a text of fewer than k words has one anchor, its whole word sequence; a longer one in which no k-mer qualifies (that
takes fewer than 2k - s - 1 words) has the k-mer with the smallest hash; a text without words has none.

Likeness is the Jaccard index of the anchor sets (two empty ones are alike: 1).

Null text counts as empty.  Rows with a null doc_id come last in descending order, by text hash; rows with equal doc_id
follow each other by text hash.  Repeated rows are rows of their own.  Extra columns are ignored.  An empty table
gives an empty result.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

K, S = 8, 2
LEAST_SEGMENTS = 64
SEGMENT_BYTES = 64 << 20   # of texts; a window holds one segment at a time and spills beyond its memory


def anchors(text: Column, k: int = K, s: int = S) -> Column:
    """The 32-bit hashes of a text's anchors, in reading order (array<int>)."""
    words = F.filter(F.split(text, r"[\x20\x09-\x0D]+"), lambda w: w != "")
    hashed = F.transform(words, lambda w: F.xxhash64(w))

    def smers(h):
        return F.transform(F.sequence(F.lit(0), F.size(h) - s), lambda i: F.xxhash64(*[F.get(h, i + j) for j in range(s)]))

    def pick(h, m):
        last = k - s
        inner = lambda i: F.least(*[F.get(m, i + j) for j in range(1, last)])
        chosen = F.filter(F.sequence(F.lit(0), F.size(h) - k), lambda i: F.least(F.get(m, i), F.get(m, i + last)) <= inner(i))
        kmer = lambda i: F.hash(*[F.get(h, i + j) for j in range(k)])
        smallest = F.array_min(F.transform(F.sequence(F.lit(0), F.size(h) - k), kmer))
        return get_first(F.transform(F.array(chosen), lambda c: F.when(F.size(c) > 0, F.transform(c, kmer)).otherwise(F.array(smallest))))

    with_h = lambda h: F.when(F.size(h) >= k, get_first(F.transform(F.array(smers(h)), lambda m: pick(h, m)))) \
        .when(F.size(h) > 0, F.array(F.hash(h))).otherwise(F.array().cast("array<int>"))
    return get_first(F.transform(F.array(hashed), with_h))


def get_first(array: Column) -> Column:
    """The only element; transform over a one-element array binds a name, so its value is computed once."""
    return F.get(array, F.lit(0))


def fingerprint(marks: Column) -> Column:
    """Anchors as text, eight hexadecimal digits each."""
    return F.lower(F.array_join(F.transform(marks, lambda m: F.lpad(F.hex(m.cast("long").bitwiseAND(F.lit(0xFFFFFFFF))), 8, "0")), ""))


def likeness(a: Column, b: Column) -> Column:
    """Jaccard index of two anchor arrays."""
    both = F.size(F.array_union(a, b))
    return F.when(both == 0, F.lit(1.0)).otherwise(F.size(F.array_intersect(a, b)) / both)


def cut_of(value: Column, cuts: list[int]) -> tuple[Column, Column]:
    """(number of the first of the rising ``cuts`` that is not below ``value``, whether they are equal), looked up in two steps."""
    step = max(1, math.isqrt(len(cuts)))
    groups = [cuts[i:i + step] for i in range(0, len(cuts), step)] or [[0]]
    constant = lambda values: F.array(*[F.lit(c).cast("long") for c in values])
    group = F.size(F.filter(constant([g[-1] for g in groups]), lambda c: c < value))
    inside = F.get(F.array(*[constant(g) for g in groups]), group)
    return group * step + F.size(F.filter(inside, lambda c: c < value)), F.array_contains(inside, value)


def with_next(rows: DataFrame, key: str, carried: list[str], order: list[Column], size: Column, segments: int | None = None) -> DataFrame:
    """Adds next_<c> for each carried column: its value in the next row by descending ``key``, round the end.

    Rows without a key come last, by ``order``'s first column (a hash, ascending).  The rows are cut into segments of about ``SEGMENT_BYTES``
    (their ``size`` summed up) at values of the key, and among rows without one at values of the hash, so neither a long table nor many null
    keys make a segment long; each segment is a window.  The rows at a cut, those that come first in a segment, are also put at the end
    of the segment above (the very first: of the last).
    """
    place = F.coalesce(F.col(key), F.bitwise_not(order[0]))   # falls along the order, apart for rows with a key and without
    known = F.col(key).isNotNull()
    totals = rows.agg(F.sum(size).alias("bytes"), F.count("*").alias("n")).first()
    if not totals["n"]:
        return rows.select("*", *[F.col(c).alias(f"next_{c}") for c in carried])
    segments = segments or max(LEAST_SEGMENTS, -(-(totals["bytes"] or 0) // SEGMENT_BYTES))
    shares = [i / segments for i in range(1, segments)]
    sides = {side: F.when(cond, place) for side, cond in (("none", ~known), ("some", known))}
    found = rows.agg(*[F.percentile_approx(value, shares, max(10_000, 4 * segments)).alias(side) for side, value in sides.items()]).first()
    # percentiles are doubles; the cuts are the largest values up to them that occur
    rough = {side: sorted({min(int(v), 2**63 - 1) for v in found[side] or ()} | {2**63 - 1}) for side in sides}
    segment = F.when(known, cut_of(place, rough["some"])[0]).otherwise(cut_of(place, rough["none"])[0])
    tops = rows.groupBy(known.alias("known"), segment.alias("segment")).agg(F.max(place).alias("top")).collect()  # two rows a segment at most
    cuts = {side: sorted(r["top"] for r in tops if r["known"] == (side == "some")) for side in sides}
    below = len(cuts["none"])
    (own_none, head_none), (own_some, head_some) = (cut_of(place, cuts[side]) for side in ("none", "some"))
    own, head = F.when(known, own_some + below).otherwise(own_none), F.when(known, head_some).otherwise(head_none)
    last = below + len(cuts["some"]) - 1
    above = F.when(own == last, F.lit(0)).otherwise(own + 1)
    dealt = (rows.withColumn("_own", own).withColumn("_head", head)
             .withColumn("_at", F.explode(F.when(F.col("_head"), F.array(F.struct(F.col("_own").alias("seg"), F.lit(0).alias("tail")),
                                                                         F.struct(above.alias("seg"), F.lit(1).alias("tail"))))
                                          .otherwise(F.array(F.struct(F.col("_own").alias("seg"), F.lit(0).alias("tail")))))))
    w = Window.partitionBy("_at.seg").orderBy("_at.tail", F.col(key).desc_nulls_last(), *order)
    return (dealt.select("*", *[F.lead(c).over(w).alias(f"next_{c}") for c in carried])
            .where("_at.tail = 0").drop("_at", "_own", "_head"))


def digest(docs: DataFrame) -> DataFrame:
    """One row per document: its fingerprint, that of its edited text, and how alike they are."""
    text = F.coalesce("text", F.lit(""))
    rows = docs.select("doc_id", text.alias("text"), F.col("doc_id").cast("long").alias("_key")).withColumn("marks", anchors(F.col("text")))
    linked = with_next(rows, "_key", ["text", "marks"], [F.xxhash64("text")], F.octet_length("text"))
    n = F.length("text")
    half = F.floor(n / 2).cast("int")
    edited = F.concat(F.substring(F.col("text"), F.lit(1), n - half), F.substring(F.col("next_text"), F.lit(1), half))
    out = linked.withColumn("n_chars", n.cast("long")).withColumn("edited", edited) \
        .withColumn("edited_marks", anchors(F.col("edited")))
    return out.select("doc_id", "n_chars", F.sha2(F.encode("edited", "UTF-8"), 256).alias("edited_sha256"),
                      fingerprint(F.col("marks")).alias("fingerprint"), fingerprint(F.col("edited_marks")).alias("edited_fingerprint"),
                      likeness(F.col("marks"), F.col("edited_marks")).alias("near_edited"),
                      likeness(F.col("marks"), F.col("next_marks")).alias("near_next"))
