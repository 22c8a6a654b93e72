"""Euclidean silhouette in linear time, with stated bounds (V1 for many rows).

Every row is scored; only the rows it is measured against are drawn: per cluster the ``per_cluster`` rows with the smallest md5 of
their key, without replacement.  A row's mean distance to a cluster is estimated from that cluster's drawn rows (itself left out) and
lies within the empirical Bernstein-Serfling bound for sampling without replacement (Bardenet and Maillard, 2015),

    sd * sqrt(2 rho L / m) + (7/3 + 3 / sqrt 2) * range * L / m,      L = ln(5 / delta),

with m drawn of N others, rho = 1 - (m - 1) / N for m <= N / 2, else (1 - m / N)(1 + 1 / m), and a range from the distance to the drawn rows'
centre and the cluster's radius about it (one more pass).  ``delta`` is (1 - confidence) / (2 x rows x clusters), so that all
bounds hold together.  A cluster that is drawn whole has no error.  A row's silhouette grows with the distance to the nearest
other cluster and falls with that to its own, which gives its lowest and highest value; ``low`` and ``high`` are their means.

The drawn rows (clusters x ``per_cluster`` vectors, whatever the table's size) travel with the tasks.  Null labels are left out; a
cluster of one row, or a single cluster, scores 0.  Not the exact silhouette, which is ``validate.silhouette_exact``.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from segkit.functions.hashing import hash_rank_key
from segkit.operators.kmeans import arrow_matrix, summed, task_vector

BUCKETS = 256
CHUNK_ROWS = 256   # rows of a distance block: CHUNK_ROWS x clusters x per_cluster distances


def drawn_rows(rows: DataFrame, per_cluster: int) -> DataFrame:
    """Of (x, l, h) per label the ``per_cluster`` rows with the smallest h, per hash bucket first."""
    some = Window.partitionBy("l", "_b").orderBy("h")
    best = Window.partitionBy("l").orderBy("h")
    kept = (rows.withColumn("_b", F.pmod(F.xxhash64("h"), F.lit(BUCKETS))).withColumn("_r", F.row_number().over(some)).where(F.col("_r") <= per_cluster))
    return kept.withColumn("_r", F.row_number().over(best)).where(F.col("_r") <= per_cluster).select("x", "l", "h")


def error(sd: np.ndarray, spread: np.ndarray, m: np.ndarray, others: np.ndarray, log: float) -> np.ndarray:
    """The bound above; 0 where all others are drawn."""
    m1 = np.maximum(m, 1.0)
    rho = np.where(m <= others / 2, 1 - (m - 1) / np.maximum(others, 1.0), (1 - m / np.maximum(others, 1.0)) * (1 + 1 / m1))
    out = sd * np.sqrt(2 * np.maximum(rho, 0.0) * log / m1) + (7 / 3 + 3 / math.sqrt(2)) * spread * log / m1
    return np.where(m >= others, 0.0, out)


def score(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    most = np.maximum(a, b)
    return np.where(most > 0, (b - a) / np.where(most > 0, most, 1.0), 0.0)


def silhouette_sampled(df: DataFrame, features: str, label: str, key: str, per_cluster: int = 1024, confidence: float = 0.99,
                       salt: str = "silhouette") -> DataFrame:
    """One row (labelling, silhouette, low, high): the estimate, and bounds of the exact value that hold with ``confidence``."""
    spark = df.sparkSession
    rows = df.where(F.col(label).isNotNull()).select(F.col(features).cast("array<double>").alias("x"), F.col(label).cast("string").alias("l"),
                                                     hash_rank_key(salt, key).alias("h"))
    sizes = {r["l"]: r["n"] for r in rows.groupBy("l").agg(F.count(F.lit(1)).alias("n")).collect()}  # one row a cluster
    names = sorted(sizes)
    schema = "labelling string, silhouette double, low double, high double"
    if len(names) < 2:
        return spark.createDataFrame([(label, 0.0, 0.0, 0.0)], schema)
    drawn = drawn_rows(rows, per_cluster).orderBy("l", "h").toArrow()  # clusters x per_cluster rows at most
    S, owner = arrow_matrix(drawn.column("x")), np.array([names.index(v) for v in drawn.column("l").to_pylist()])
    hashes = np.array(drawn.column("h").to_pylist())
    k, n = len(names), np.array([sizes[v] for v in names], float)
    total = int(n.sum())
    starts = np.searchsorted(owner, np.arange(k))
    m = np.diff(np.append(starts, len(owner))).astype(float)
    centres = np.add.reduceat(S, starts) / m[:, None]
    log = math.log(5 / ((1 - confidence) / (2 * total * k)))

    def parts(batches):
        for batch in batches:
            for at in range(0, batch.num_rows, CHUNK_ROWS):
                part = batch.slice(at, CHUNK_ROWS)
                X, own = arrow_matrix(part.column(0)), np.searchsorted(np.array(names), np.array(part.column(1).to_pylist()))
                yield X, own, np.array(part.column(2).to_pylist()), np.sqrt(np.maximum(
                    (X ** 2).sum(1)[:, None] + (centres ** 2).sum(1) - 2 * X @ centres.T, 0.0))

    def radii(batches):
        out = np.zeros(k)
        for _, own, _, to_centre in parts(batches):
            np.maximum.at(out, own, to_centre[np.arange(len(own)), own])
        yield pa.RecordBatch.from_pydict({"c": pa.array(np.arange(k, dtype=np.int32)), "r": pa.array(out)})
    found = rows.mapInArrow(radii, "c int, r double").groupBy("c").agg(F.max("r").alias("r")).collect()  # one row a cluster
    radius = np.zeros(k)
    for r in found:
        radius[r["c"]] = r["r"]

    def scores(batches):
        sums = np.zeros(3)
        norm = (S ** 2).sum(1)
        for X, own, h, to_centre in parts(batches):
            at = np.arange(len(X))
            D = np.sqrt(np.maximum((X ** 2).sum(1)[:, None] + norm - 2 * X @ S.T, 0.0))
            place = np.minimum(np.searchsorted(hashes, h, sorter=by_hash), len(hashes) - 1)
            itself = by_hash[place]
            drawn_too = hashes[itself] == h
            D[at[drawn_too], itself[drawn_too]] = 0.0
            used, others = np.tile(m, (len(X), 1)), np.tile(n, (len(X), 1))
            used[at, own] -= drawn_too
            others[at, own] -= 1
            first, second = np.add.reduceat(D, starts, axis=1), np.add.reduceat(D * D, starts, axis=1)
            mu = first / np.maximum(used, 1)
            sd = np.sqrt(np.maximum(second / np.maximum(used, 1) - mu ** 2, 0.0))
            spread = np.minimum(2 * radius, to_centre + radius)
            err = error(sd, spread, used, others, log)
            # with nobody drawn but itself, nothing is known but the range
            err = np.where((used < 1) & (others > 0), to_centre + radius, err)
            single = others[at, own] < 1

            def of(a, b):
                b = b.copy()
                b[at, own] = np.inf
                return float(np.where(single, 0.0, score(np.maximum(a[at, own], 0.0), np.maximum(b, 0.0).min(axis=1))).sum())
            sums += of(mu, mu), of(mu + err, mu - err), of(mu - err, mu + err)
        yield task_vector(sums)
    by_hash = np.argsort(hashes, kind="stable")
    value, low, high = summed(rows.mapInArrow(scores, "part int, v binary")) / total
    return spark.createDataFrame([(label, float(value), float(low), float(high))], schema)
