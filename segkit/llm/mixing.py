"""Mixing sources to target weights by a low-discrepancy schedule over equal-token blocks.

* Targets: ``total_share`` of all words, shared by weight; a target stops at ``max_epochs`` times its
  source's words and the excess goes to the rest by weight (water filling over the few sources).
* Schedule: slot n takes the golden-ratio point ``n * 2654435769 mod 2^32``, mapped through the
  cumulative targets to a source; a slot's rank among its source's slots picks the source's block
  (rank mod blocks), so each source is read in order, again from the start when it is used up.
* Blocks: a source's documents, in keyed-hash order, form one stream of words that is cut every
  ``block`` words.  A document lies in one or more blocks.

Everything is DataFrame functions.  Nothing is windowed over a whole source (see ``ranks``), a source
with a third of all rows is spread by hash, and slots are joined on (source, block).  The number of
sources is taken to be small (the driver sees one row per source).

Null text: size 0, takes nothing.  Null source: a source of its own, last.  Repeated rows: rows of
their own.  Extra columns are kept by ``mixed_documents`` and ignored by ``digest``.  An empty table
gives an empty result.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from segkit.llm.frames import plainly
from segkit.llm.ranks import running_total

GOLDEN = 2654435769  # 2^32 divided by the golden ratio, rounded to an odd number
WEIGHTS = (3, 1, 2)


def word_count(text: str) -> Column:
    return F.coalesce(F.regexp_count(F.col(text), F.lit(r"[^\x20\x09-\x0D]+")), F.lit(0)).cast("long")


def targets(sizes: list[tuple[str | None, int]], weights=WEIGHTS, total_share: float = 1.5,
            max_epochs: float = 2.0) -> list[tuple[str | None, int, float]]:
    """(source, size, target) per source; sources by code point, null last, weights repeat in that order."""
    ordered = sorted(sizes, key=lambda s: (s[0] is None, s[0] or ""))
    weight = {i: weights[i % len(weights)] for i in range(len(ordered))}
    left, target = total_share * sum(n for _, n in ordered), {}
    open_ = set(weight)
    while open_:
        scale = left / sum(weight[i] for i in open_)
        full = {i for i in open_ if weight[i] * scale > max_epochs * ordered[i][1]}
        if not full:
            target |= {i: weight[i] * scale for i in open_}
            break
        for i in full:
            target[i] = max_epochs * ordered[i][1]
        left -= sum(target[i] for i in full)
        open_ -= full
    return [(s, n, float(target[i])) for i, (s, n) in enumerate(ordered)]


def schedule(spark, plan: list[tuple[str | None, int, float]], block: int, chunk: int = 4096) -> DataFrame:
    """The slots of the mix: (slot, source_no, block_no, epoch).

    A slot beyond what its source may give (``max_epochs`` times its blocks) is left out by the caller's plan.
    """
    goal = sum(t for _, _, t in plan)
    slots = int(round(goal / block))
    if slots == 0:
        return spark.createDataFrame([], "slot long, source_no int, block_no long, epoch long")
    edges, at = [], 0.0
    for _, _, t in plan:
        at += t
        edges.append(int(at / goal * 2**32))
    edges[-1] = 2**32
    bounds = F.array(*[F.lit(e).cast("long") for e in edges])
    point = F.pmod(F.pmod(F.col("id"), F.lit(2**32)) * F.lit(GOLDEN), F.lit(2**32)) if slots < 2**31 else \
        F.expr(f"cast(pmod(cast(pmod(id, {2**32}) as decimal(20,0)) * {GOLDEN}, {2**32}) as bigint)")
    raw = (spark.range(slots).withColumn("_x", point)
           .select(F.col("id").alias("slot"), (F.col("id") / chunk).cast("long").alias("_chunk"),
                   F.size(F.filter(bounds, lambda e: e <= F.col("_x"))).alias("source_no")))
    per = raw.groupBy("source_no", "_chunk").agg(F.count("*").alias("_n"))
    before = Window.partitionBy("source_no").orderBy("_chunk").rowsBetween(Window.unboundedPreceding, -1)
    base = per.select(F.col("source_no").alias("_s"), F.col("_chunk").alias("_c"),
                      F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_base"))
    inside = Window.partitionBy("source_no", "_chunk").orderBy("slot")
    blocks = F.array(*[F.lit(-(-n // block)).cast("long") for _, n, _ in plan])
    return (raw.withColumn("_local", F.row_number().over(inside) - 1)
            .join(base, (F.col("source_no") == F.col("_s")) & (F.col("_chunk") == F.col("_c")))
            .withColumn("_rank", F.col("_base") + F.col("_local"))
            .withColumn("_blocks", F.get(blocks, F.col("source_no")))
            .where("_blocks > 0")
            .select("slot", "source_no", F.expr("pmod(_rank, _blocks)").alias("block_no"),
                    F.expr("_rank div _blocks").alias("epoch")))


def pieces(rows: DataFrame, keys: list[str], block: int, seed: int) -> DataFrame:
    """Cuts each source's shuffled stream of words into blocks: one row per document and block it lies in."""
    key = [F.col(k) for k in keys]
    order = F.xxhash64(F.lit(seed), *key)
    placed = running_total(rows.where("size > 0"), ["source_no"], "size", F.xxhash64(F.lit(seed + 1), *key), [order, *key])
    return (placed.withColumn("block_no", F.explode(F.sequence(F.expr(f"start div {block}"), F.expr(f"(start + size - 1) div {block}"))))
            .withColumn("words", F.least(F.expr("start + size"), (F.col("block_no") + 1) * block)
                        - F.greatest(F.col("start"), F.col("block_no") * block)))


def mix(docs: DataFrame, id_col: str = "doc_id", text: str = "text", source: str = "source", block: int = 64, seed: int = 11,
        weights=WEIGHTS, total_share: float = 1.5, max_epochs: int = 2) -> DataFrame:
    """(id, crc of the text, size, source_size, target, taken) for every document row."""
    spark = docs.sparkSession
    rows = docs.select(F.col(id_col).alias("doc_id"), F.col(source).alias("source"), word_count(text).alias("size"),
                       F.crc32(F.encode(F.coalesce(F.col(text), F.lit("")), "UTF-8")).alias("crc"))
    sizes = [(r["source"], r["n"]) for r in rows.groupBy("source").agg(F.sum("size").alias("n")).collect()]  # one row a source
    plan = targets(sizes, weights, total_share, max_epochs)
    numbers = spark.createDataFrame([(s, i, n, t) for i, (s, n, t) in enumerate(plan)],
                                    "_source string, source_no int, source_size long, target double")
    rows = rows.join(numbers, F.col("source").eqNullSafe(F.col("_source"))).drop("_source")
    used = (schedule(spark, plan, block).where(F.col("epoch") < max_epochs)
            .groupBy("source_no", "block_no").agg(F.count("*").alias("uses")))
    cut = pieces(rows, ["doc_id", "crc"], block, seed)
    # repeated rows share their pieces' total: each copy has its own place in the stream, so the place is part of the key
    taken = (cut.join(used, ["source_no", "block_no"], "left")
             .groupBy("doc_id", "crc", "source", "size", "source_size", "target", "start")
             .agg(F.sum(F.col("words") * F.coalesce("uses", F.lit(0))).alias("taken")))
    empty = rows.where("size = 0").select("doc_id", "crc", "source", "size", "source_size", "target", F.lit(0).cast("long").alias("taken"))
    return taken.drop("start").unionByName(empty)


def digest(docs: DataFrame) -> DataFrame:
    return mix(docs).select("doc_id", "size", "source_size", "target", F.col("taken").cast("long").alias("taken"), "source")


def mixed_documents(docs: DataFrame, seed: int = 11) -> DataFrame:
    """The documents as often as the mix takes them: taken / size rounded to whole copies.

    Copies are told by (doc_id, text); documents without words are not part of a mix of words.
    """
    docs, restored = plainly(docs, "doc_id", "text", "source")
    times = (mix(docs, seed=seed).groupBy("doc_id", "crc")
             .agg((F.sum("taken") / F.sum("size")).alias("_x")).where(F.col("_x") > 0)
             .select(F.col("doc_id").alias("_id"), F.col("crc").alias("_crc"), F.round("_x").cast("int").alias("_times"))
             .where("_times > 0"))
    crc = F.crc32(F.encode(F.coalesce("text", F.lit("")), "UTF-8"))
    return restored(docs.join(times.hint("merge"), F.col("doc_id").eqNullSafe(F.col("_id")) & (crc == F.col("_crc")))
                    .withColumn("_copy", F.explode(F.sequence(F.lit(1), F.col("_times")))))
