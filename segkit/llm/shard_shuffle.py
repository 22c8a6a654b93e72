"""Uniform shuffle into shards of exact size by a hypergeometric communication matrix.

Rows are dealt to ``parts`` virtual partitions by a keyed hash.  Only the partitions' row counts
reach the driver (``parts`` numbers).  The driver draws how many rows each partition sends to each
shard: row by row of the matrix, a multivariate hypergeometric draw from the places that are still
free, so that the columns add up to the exact shard sizes.  Each partition then permutes its rows by
a second keyed hash and deals them out by its row of the matrix; each shard permutes what it got by a
third.  All permutations are functions of (seed, doc_id, text), so a lost executor's tasks give the
same rows again.

Null texts have size ``overhead`` and a null crc; repeated rows are rows of their own; columns beyond
id and text are ignored; an empty table gives an empty result.  Draws follow the law to double precision at
any row count.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from segkit.llm.frames import column, columns, free_prefix
from segkit.llm.ranks import running_total


def hypergeometric(rng: np.random.Generator, good: int, bad: int, n: int) -> int:
    """How many of ``n`` draws from good + bad are good, by inversion over all values within 12 deviations of the mode.

    What lies beyond has less weight than a double can tell from 0.  numpy's own draw refuses 10^9 and more.
    """
    low, high = max(0, n - bad), min(good, n)
    if low == high:
        return low
    total = good + bad
    mode = min(max((n + 1) * (good + 1) // (total + 2), low), high)
    reach = int(12 * (n * (good / total) * (bad / total) * ((total - n) / max(total - 1, 1))) ** 0.5) + 100
    low, high = max(low, mode - reach), min(high, mode + reach)
    k = np.arange(low, high, dtype=np.float64)
    # log of p(k + 1) / p(k)
    steps = np.log(good - k) + np.log(n - k) - np.log(k + 1) - np.log(bad - n + k + 1)
    logs = np.concatenate([[0.0], np.cumsum(steps)])
    weights = np.cumsum(np.exp(logs - logs.max()))
    return low + int(np.searchsorted(weights, rng.random() * weights[-1], side="right"))


def communication_matrix(counts: list[int], shards: int, seed: int) -> np.ndarray:
    """matrix[p, s]: rows that partition p sends to shard s; columns differ by one at most."""
    total = sum(counts)
    free = [total // shards + (s < total % shards) for s in range(shards)]
    rng = np.random.default_rng(seed)
    out = np.zeros((len(counts), shards), dtype=np.int64)
    for p, n in enumerate(counts):
        rest = sum(free)
        for s in range(shards):
            rest -= free[s]
            out[p, s] = took = hypergeometric(rng, free[s], rest, n)
            free[s] -= took
            n -= took
    return out


def shard_rows(rows: DataFrame, keys: list[str], shards: int = 40, parts: int = 512, seed: int = 20) -> DataFrame:
    """Adds ``shard`` (0 to shards-1) and ``slot`` (gapless from 0 within the shard) to ``rows``.

    ``keys`` decide every draw; rows that agree in them are interchangeable.
    """
    spark, key = rows.sparkSession, [F.col(k) for k in keys]
    u = free_prefix(rows)
    part, at, ends, rank, one = (u + name for name in ("part", "at", "ends", "rank", "one"))
    dealt = rows.withColumn(part, F.pmod(F.xxhash64(F.lit(seed), *key), F.lit(parts)).cast("int"))
    found = {r["part"]: r["n"] for r in dealt.groupBy(F.col(part).alias("part")).agg(F.count("*").alias("n")).collect()}  # parts rows at most
    matrix = communication_matrix([found.get(p, 0) for p in range(parts)], shards, seed).cumsum(axis=1)
    plan = spark.createDataFrame([(p, [int(x) for x in matrix[p]]) for p in range(parts)], f"{at} int, {ends} array<bigint>")
    local = Window.partitionBy(part).orderBy(F.xxhash64(F.lit(seed + 1), *key), *key)
    sent = (dealt.withColumn(rank, F.row_number().over(local) - 1)
            .join(plan, F.col(part) == F.col(at))
            .withColumn("shard", F.size(F.filter(ends, lambda e: e <= F.col(rank))))
            .drop(part, at, ends, rank)
            .withColumn(one, F.lit(1)))
    again = F.xxhash64(F.lit(seed + 2), *key)
    return running_total(sent, ["shard"], one, again, [F.xxhash64(F.lit(seed + 3), *key), *key], out="slot", buckets=64).drop(one)


def digest(docs: DataFrame, shards: int = 40, overhead: int = 16) -> DataFrame:
    """One row per document: where the shuffle puts it, and what it is."""
    light = docs.select("doc_id", (F.coalesce(F.octet_length("text"), F.lit(0)) + overhead).cast("long").alias("size"),
                        F.crc32(F.encode(F.coalesce("text", F.lit("")), "UTF-8")).alias("text_crc32"))
    out = shard_rows(light, ["doc_id", "text_crc32", "size"], shards)
    return out.select("doc_id", "size", "text_crc32", F.lit("rows").alias("law"), "shard",
                      F.col("slot").cast("long").alias("slot"), F.lit(None).cast("int").alias("grown_shard"))


def shuffled_documents(docs: DataFrame, shards: int = 40, seed: int = 20) -> DataFrame:
    """The documents with ``shard`` and ``slot``; columns of these two names are replaced, all others kept.

    Rows are told by all their columns, so that a repeated task gives each row the place it had.
    """
    kept = docs.select(*columns([c for c in docs.columns if c.lower() not in ("shard", "slot")]))
    row = free_prefix(kept) + "row"
    told = [column(f.name) for f in kept.schema.fields if not isinstance(f.dataType, T.MapType)]  # Spark hashes no maps
    return shard_rows(kept.withColumn(row, F.xxhash64(*told)), ["doc_id", row], shards, seed=seed).drop(row)
