"""Cluster validation (V1-V5).

V1 exact Euclidean silhouette, distributed by blocks: rows are packed into
blocks of ~``block_rows``, every block meets every block (``pairs``: nothing is
replicated), a task makes distances slice by slice with numpy and emits only
per-(row, cluster) distance sums, never pairs.  The distances are shared
by every labelling passed in, so a whole k sweep is scored in one job.  The
work is inherently O(n^2), so it runs only where the caller names it.

V2 squared-Euclidean silhouette: Spark ML ``ClusteringEvaluator`` (linear).
V3/V4 ARI and NMI from one pass over the contingency table (windows on its small rows).
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from segkit.operators.pairs import block_pairs, longs, matrix, packed_blocks, records, squares

BLOCK_ROWS = 2048
MAX_BLOCK_ROWS = 4096  # distances are made in slices (``pairs.SLICE_ROWS``), so a block's size only bounds its matrix
TARGET_BLOCKS = 25


def _sums_fn(labels: list, label_type: str, d: int):
    """mapInArrow body over pairs of blocks: the distance sums of a left block's rows to each cluster, over all right blocks of the task."""
    kind = pa.int64() if label_type == "bigint" else pa.string()

    def flushed(left, sums):
        rid, own = left
        for j, of in enumerate(sums):
            for cluster, (dsum, cnt) in of.items():
                n = len(rid)
                yield pa.RecordBatch.from_pydict({
                    "rid": pa.array(rid), "j": pa.array(np.full(n, j, np.int32)), "cluster": pa.array([cluster] * n, kind),
                    "own": own[j], "dsum": pa.array(dsum), "cnt": pa.array(np.full(n, cnt, np.int64))})

    def fn(batches):
        block, left, sums = None, None, None
        for r in records(batches):
            if r["l_b"].as_py() != block:
                if left:
                    yield from flushed(left, sums)
                block, sums = r["l_b"].as_py(), [{} for _ in labels]
                own = [r[f"l_l{j}_v"].values.take(pa.array(longs(r[f"l_l{j}_c"]))) for j in range(len(labels))]
                left = longs(r["l__rid"]).copy(), own
            X, Y = matrix(r["l_x"], d), matrix(r["r_x"], d)
            values = [r[f"r_l{j}_v"].as_py() for j in range(len(labels))]
            ends = np.cumsum([0, *map(len, values)])
            member = np.zeros((len(Y), ends[-1]))
            for j, first in enumerate(ends[:-1]):
                member[np.arange(len(Y)), first + longs(r[f"r_l{j}_c"])] = 1.0
            dsum = np.empty((len(X), ends[-1]))
            for at, D in squares(X, Y):
                dsum[at:at + len(D)] = np.sqrt(D, out=D) @ member
            cnt = member.sum(0).astype(np.int64)
            for j, first in enumerate(ends[:-1]):
                for i, cluster in enumerate(values[j], first):
                    known = sums[j].get(cluster)
                    sums[j][cluster] = (dsum[:, i].copy(), cnt[i]) if known is None else (known[0] + dsum[:, i], known[1] + cnt[i])
        if left:
            yield from flushed(left, sums)
    return fn


def silhouette_rows(df: DataFrame, features: str, labels, key: str,
                    block_rows: int = BLOCK_ROWS, n_rows: int | None = None) -> DataFrame:
    """Per-row exact silhouette for every labelling: (rid, j, s).

    ``key`` tells rows apart (rows are equal where it is); a row's id is a hash of it, so a repeated task makes the same rows.
    """
    labels = list(labels)
    n = n_rows if n_rows is not None else df.count()
    width = df.select(F.size(features).alias("d")).where("d >= 0").first()
    d = int(width["d"]) if width else 0
    # larger blocks on larger inputs, within the memory cap
    block_rows = min(max(block_rows, math.ceil(n / TARGET_BLOCKS)), max(block_rows, MAX_BLOCK_ROWS))
    integral = all(isinstance(df.schema[c].dataType, (T.IntegerType, T.LongType, T.ShortType, T.ByteType))
                   for c in labels)
    label_type = "bigint" if integral else "string"
    coded = {f"l{j}": label_type for j in range(len(labels))}
    rows = df.select(F.col(features).alias("x"), F.xxhash64(key).alias("_rid"), *[F.col(c).cast(label_type).alias(f"l{j}") for j, c in enumerate(labels)])
    blocks = packed_blocks(rows, "x", "_rid", [], n, d, block_rows, coded)
    codes = [f"{c}_{part}" for c in coded for part in "vc"]
    schema = f"rid bigint, j int, cluster {label_type}, own {label_type}, dsum double, cnt bigint"
    sums = block_pairs(blocks, ["x", "_rid", *codes], ["x", *codes]).mapInArrow(_sums_fn(labels, label_type, d), schema)
    per = sums.groupBy("rid", "j", "cluster", "own").agg(F.sum("dsum").alias("dsum"), F.sum("cnt").alias("cnt"))
    own = F.col("cluster") == F.col("own")
    pt = per.groupBy("rid", "j").agg(
        F.max(F.when(own, F.try_divide(F.col("dsum"), F.col("cnt") - 1))).alias("a"),
        F.max(F.when(own, F.col("cnt"))).alias("own_cnt"),
        F.min(F.when(~own, F.col("dsum") / F.col("cnt"))).alias("b"))
    s = (F.when(F.col("own_cnt") <= 1, F.lit(0.0))
          .otherwise(F.try_divide(F.col("b") - F.col("a"), F.greatest("a", "b"))))
    return pt.select("rid", "j", F.coalesce(s, F.lit(0.0)).alias("s"))


def silhouette_exact(df: DataFrame, features: str, labels, key: str, block_rows: int = BLOCK_ROWS) -> DataFrame:
    """V1: mean exact silhouette per labelling: (labelling, silhouette)."""
    labels = list(labels)
    rows = silhouette_rows(df, features, labels, key, block_rows)
    names = df.sparkSession.createDataFrame([(j, c) for j, c in enumerate(labels)], "j int, labelling string")
    return (rows.groupBy("j").agg(F.avg("s").alias("silhouette"))
                .join(F.broadcast(names), "j").select("labelling", "silhouette"))


def silhouette_squared(df: DataFrame, features: str, label: str) -> float:
    """V2: Spark ML's linear-cost squared-Euclidean silhouette."""
    from pyspark.ml.evaluation import ClusteringEvaluator
    from pyspark.ml.functions import array_to_vector
    known = df.where(F.col(label).isNotNull())
    names = known.agg(F.sort_array(F.collect_set(F.col(label).cast("string")))).scalar()  # one entry a cluster
    data = known.select(array_to_vector(F.col(features).cast("array<double>")).alias("_v"),
                        F.array_position(names, F.col(label).cast("string")).cast("double").alias("_p"))
    ev = ClusteringEvaluator(featuresCol="_v", predictionCol="_p", metricName="silhouette",
                             distanceMeasure="squaredEuclidean")
    return float(ev.evaluate(data))


def silhouettes_squared(df: DataFrame, features: str, labels) -> dict:
    """V2 for several labellings in two passes over the rows: {labelling: silhouette}, the same values as ``silhouette_squared``.

    The first pass adds up per cluster its rows, their squared norms and their vectors, the second each row's silhouette from these; a null
    label leaves its row out of that labelling, and a labelling of fewer than two clusters has 0.
    """
    from segkit.operators.kmeans import arrow_matrix, summed, task_vector
    labels = list(labels)
    sets = df.agg(*[F.sort_array(F.collect_set(F.col(c).cast("string"))).alias(f"_{j}") for j, c in enumerate(labels)]).first()  # one entry a cluster
    sizes = [len(s) for s in sets]
    ends = np.concatenate([[0], np.cumsum(sizes)]).astype(int)
    codes = [F.coalesce(F.array_position(F.array(*[F.lit(v) for v in s]).cast("array<string>"), F.col(c).cast("string")) - 1, F.lit(-1)).cast("int")
             for s, c in zip(sets, labels)]
    rows = df.select(F.col(features).cast("array<double>").alias("x"), F.array(*codes).alias("c"))

    def matrices(batches):
        for batch in batches:
            for a in range(0, batch.num_rows, BLOCK_ROWS):
                part = batch.slice(a, BLOCK_ROWS)
                yield arrow_matrix(part.column(0)), arrow_matrix(part.column(1)).astype(np.int64)

    def states(batches):
        total = 0.0
        for X, C in matrices(batches):
            A = np.zeros((len(X), ends[-1] + 1))
            for j, first in enumerate(ends[:-1]):
                A[np.arange(len(X)), np.where(C[:, j] < 0, ends[-1], first + C[:, j])] = 1.0
            A = A[:, :-1]
            total = total + np.hstack([A.sum(0)[:, None], (A.T @ (X ** 2).sum(1))[:, None], A.T @ X])
        if not np.isscalar(total):
            yield task_vector(total.ravel())
    state = summed(rows.mapInArrow(states, "part int, v binary"))
    if state is None or not ends[-1]:
        return {c: 0.0 for c in labels}
    state = state.reshape(ends[-1], -1)
    n, square, vector = state[:, 0], state[:, 1], state[:, 2:]

    def values(batches):
        total = np.zeros(2 * len(labels))
        for X, C in matrices(batches):
            mean = np.maximum((X ** 2).sum(1)[:, None] + (square / n)[None, :] - 2.0 * (X @ (vector / n[:, None]).T), 0.0)
            for j, (first, last) in enumerate(zip(ends[:-1], ends[1:])):
                known = np.flatnonzero(C[:, j] >= 0)
                total[2 * j] += len(known)
                if last - first < 2 or not len(known):
                    continue
                own, at = C[known, j], np.arange(len(known))
                m, size = mean[known, first:last].copy(), n[first:last][own]
                a = m[at, own] * size / np.maximum(size - 1, 1)
                m[at, own] = np.inf
                b = m.min(axis=1)
                most = np.maximum(a, b)
                total[2 * j + 1] += float(np.where((size > 1) & (most > 0), (b - a) / np.where(most > 0, most, 1.0), 0.0).sum())
        yield task_vector(total)
    total = summed(rows.mapInArrow(values, "part int, v binary"))
    return {c: float(total[2 * j + 1] / max(total[2 * j], 1.0)) for j, c in enumerate(labels)}


def silhouettes(df: DataFrame, features: str, labels, key: str, metric: str = "squared") -> tuple[dict, str]:
    """Silhouette of several labellings; returns ({label: s}, metric's name).

    ``metric``: "squared" (V2, linear) or "exact" (V1, O(n^2)); the same at every number of rows.
    """
    labels = list(labels)
    if metric == "squared":
        return silhouettes_squared(df, features, labels), "squared_euclidean"
    if metric != "exact":
        raise ValueError(f"unknown silhouette metric {metric!r}")
    got = {r["labelling"]: r["silhouette"] for r in silhouette_exact(df, features, labels, key).collect()}  # one row a labelling
    return {lab: float(got[lab]) for lab in labels}, "euclidean"


def _comb2(c):
    return c * (c - 1) / 2.0


def pair_counts(df: DataFrame, truth: str, models: dict) -> DataFrame:
    """A20 contingency of several labellings in one pass: (model, truth, pred, n) over rows with both labels."""
    named = F.array(*[F.struct(F.lit(name).alias("model"), F.col(c).cast("string").alias("pred")) for name, c in models.items()])
    return (df.where(F.col(truth).isNotNull()).select(F.col(truth).cast("string").alias("truth"), F.explode(named).alias("_m"))
              .select("_m.model", "truth", "_m.pred").where(F.col("pred").isNotNull())
              .groupBy("model", "truth", "pred").agg(F.count(F.lit(1)).alias("n")))


def scores(df: DataFrame, truth: str, models: dict) -> DataFrame:
    """V3 + V4 for several labellings: (model, ari, nmi).

    Marginals are aggregates joined back to the contingency rows, and every sum is written over its cells:
      ARI = (S - E) / ((A + B) / 2 - E),  E = A B / C(N, 2), with sums of C(n, 2) over cells and marginals;
      MI = (1/N) sum n ln n + ln N - (1/N) sum n ln a - (1/N) sum n ln b.
    """
    cont = pair_counts(df, truth, models)
    rows = cont.groupBy("model", "truth").agg(F.sum("n").cast("double").alias("a"))
    cols = cont.groupBy("model", "pred").agg(F.sum("n").cast("double").alias("b"))
    cells = cont.withColumn("n", F.col("n").cast("double")).join(rows, ["model", "truth"]).join(cols, ["model", "pred"])
    n, a, b = F.col("n"), F.col("a"), F.col("b")
    t = cells.groupBy("model").agg(F.sum(n).alias("N"), F.sum(_comb2(n)).alias("S"),
                                   F.sum(_comb2(a) * n / a).alias("A"), F.sum(_comb2(b) * n / b).alias("B"),
                                   F.sum(n * F.log(n)).alias("Ln"), F.sum(n * F.log(a)).alias("La"), F.sum(n * F.log(b)).alias("Lb"),
                                   F.sum(n / a).alias("kt"), F.sum(n / b).alias("kp"))   # one per marginal: how many there are
    N = F.col("N")
    expected = F.col("A") * F.col("B") / _comb2(N)
    denom = (F.col("A") + F.col("B")) / 2.0 - expected
    ari = F.when(denom == 0, F.lit(1.0)).otherwise((F.col("S") - expected) / denom)
    h_t = F.log(N) - F.col("La") / N
    h_p = F.log(N) - F.col("Lb") / N
    mi = F.col("Ln") / N + F.log(N) - F.col("La") / N - F.col("Lb") / N
    nmi = (F.when((F.col("kt") < 1.5) & (F.col("kp") < 1.5), F.lit(1.0))
            .when(F.abs(mi) <= F.lit(1e-15), F.lit(0.0))
            .otherwise(F.greatest(mi, F.lit(0.0)) / ((h_t + h_p) / 2.0)))
    return t.select("model", ari.alias("ari"), nmi.alias("nmi"))


def ari_nmi(df: DataFrame, truth: str, pred: str) -> DataFrame:
    """V3 + V4 of one labelling: one row (ari, nmi)."""
    return scores(df, truth, {"only": pred}).select("ari", "nmi")


def model_comparison(df: DataFrame, truth: str, models: dict, digits: int = 6) -> DataFrame:
    """V5: one row per model label column: (model, ari, nmi), in one pass over the rows."""
    from segkit.functions.scalar import fixed_round
    return scores(df, truth, models).select("model", fixed_round("ari", digits).alias("ari"), fixed_round("nmi", digits).alias("nmi"))
