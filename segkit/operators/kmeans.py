"""Lloyd k-means with many restarts and many k at once (K1-K4, K9).

The rows are packed once into blocks: one binary matrix of up to ``BLOCK_ROWS`` feature rows with their key hashes, cached for the run.
Each Lloyd iteration is ONE Spark job for all (k, restart) runs: every task assigns its blocks' rows to the nearest centre of every active
run (numpy) and emits its counts, costs and sums as one vector.  About sqrt(cores) tasks add the vectors up (``summed``), so the driver
sees that many of ``sum(k) x (d + 2)`` numbers and nothing is planned or compiled per pass.  The number of passes over the data is the
iteration count, not runs x k x iterations.

Seeding is k-means||: starting from one row, every round draws rows from the WHOLE table with probability proportional to their squared
distance from the candidates so far (by a hash of seed, round and key, so partitioning and companions in the call don't matter); the
candidates, weighted by the rows nearest to them, are reduced to k by weighted k-means++ on the driver, once per restart.  A model's
seeds depend on its own seed and k only.  Start centres may be given instead.

Converged runs drop out of later passes.  An empty cluster moves to the row that is farthest from its centre.  A k beyond the number of
distinct rows gives one cluster per distinct row.  Cluster ids are canonical: size descending, then first coordinate.  Every run keeps a log
of its passes: cost, moved centres and shift.
"""

from __future__ import annotations

from dataclasses import dataclass, field

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

SEED_ROUNDS = 2        # k-means|| rounds; more follow while there are fewer than k candidates
OVERSAMPLING = 2.0     # expected candidates per round, as a multiple of k
CHUNK_ROWS = 2048      # rows per distance block inside a task (memory ~ CHUNK_ROWS x total centres)
BLOCK_ROWS = 2048      # rows of a packed block (about 2 MB at 128 features)


@dataclass
class KMeansRun:
    k: int
    run: int
    centers: np.ndarray
    cost: float
    n_iter: int
    sizes: list
    converged: bool
    log: list = field(default_factory=list)   # per pass: (cost before the move, centres that moved, summed squared shift)


def weighted_kmeanspp(X: np.ndarray, w: np.ndarray, k: int, rng: np.random.Generator) -> np.ndarray:
    """k-means++ on weighted candidates; at most one centre per distinct candidate."""
    xn = (X ** 2).sum(1)

    def draw(p):
        return min(int(np.searchsorted(np.cumsum(p), rng.random() * p.sum())), len(p) - 1)
    idx = [draw(w)]
    d2 = np.maximum(xn - 2.0 * (X @ X[idx[0]]) + xn[idx[0]], 0.0)
    d2[idx[0]] = 0.0
    for _ in range(1, min(k, len(X))):
        left = d2 * w
        i = draw(left) if left.sum() > 0 else next(j for j in range(len(X)) if j not in idx)
        idx.append(i)
        d2 = np.minimum(d2, np.maximum(xn - 2.0 * (X @ X[i]) + xn[i], 0.0))
        d2[i] = 0.0
    return X[idx].copy()


def _nearest_distance(X: np.ndarray, C: np.ndarray) -> np.ndarray:
    """Squared distance of each row to its nearest centre, in blocks."""
    cn = (C ** 2).sum(1)
    out = np.empty(len(X))
    for a in range(0, len(X), CHUNK_ROWS):
        B = X[a:a + CHUNK_ROWS]
        out[a:a + CHUNK_ROWS] = np.maximum((B ** 2).sum(1) + (cn[None, :] - 2.0 * (B @ C.T)).min(axis=1), 0.0)
    return out


def packed(df: DataFrame, features: str, key: str, d: int) -> DataFrame:
    """(n, x, h): blocks of rows as binary matrices (n x d doubles) with the keys' hashes."""

    def fn(batches):
        for batch in batches:
            for a in range(0, batch.num_rows, BLOCK_ROWS):
                part = batch.slice(a, BLOCK_ROWS)
                yield pa.RecordBatch.from_pydict({"n": pa.array([part.num_rows], pa.int32()),
                                                  "x": pa.array([arrow_matrix(part.column(0), d).tobytes()], pa.binary()),
                                                  "h": pa.array([part.column(1).to_numpy().tobytes()], pa.binary())})
    return df.select(F.col(features).cast("array<double>").alias("x"), F.xxhash64(key).alias("h")).mapInArrow(fn, "n int, x binary, h binary")


def _chunks(batches, d: int):
    """(rows, hashes) of packed blocks, ``CHUNK_ROWS`` at a time: bounds the n x centres matrices."""
    for batch in batches:
        for n, x, h in zip(*(batch.column(c) for c in ("n", "x", "h"))):   # a batch may hold 64 MB: its values are read in place
            n = n.as_py()
            X, H = np.frombuffer(x.as_buffer(), np.float64).reshape(n, d), np.frombuffer(h.as_buffer(), np.int64)
            for a in range(0, n, CHUNK_ROWS):
                yield X[a:a + CHUNK_ROWS], H[a:a + CHUNK_ROWS]


def seed_candidates(blocks: DataFrame, models: list, d: int) -> dict:
    """k-means|| for several models ``(tag, k, seed)`` in shared passes: {tag: (candidates, weights)}."""

    from segkit.functions.hashing import uniform_np

    def start(batches):
        best: dict = {}
        for X, h in _chunks(batches, d):
            for i, (_, _, seed) in enumerate(models):
                u = uniform_np(h, seed, -1)
                j = int(np.lexsort((h, u))[0])
                if i not in best or (u[j], h[j]) < best[i][:2]:
                    best[i] = (float(u[j]), int(h[j]), X[j])
        if best:
            yield pa.RecordBatch.from_pydict({"m": pa.array(list(best), pa.int32()), "u": pa.array([v[0] for v in best.values()]),
                                              "h": pa.array([v[1] for v in best.values()], pa.int64()), "x": pa.array([v[2].tolist() for v in best.values()], pa.list_(pa.float64()))})
    first = (blocks.mapInArrow(start, "m int, u double, h long, x array<double>").groupBy("m")
             .agg(F.min_by("x", F.struct("u", "h")).alias("x")).collect())  # one row a model
    sets: list = [None] * len(models)
    for r in first:
        sets[r["m"]] = np.array([r["x"]], dtype=np.float64)

    def costs(active):
        def fn(batches):
            total = {i: 0.0 for i in active}
            for X, _ in _chunks(batches, d):
                for i in active:
                    total[i] += float(_nearest_distance(X, sets[i]).sum())
            yield pa.RecordBatch.from_pydict({"m": pa.array(list(total), pa.int32()), "cost": pa.array(list(total.values()), pa.float64())})
        out = blocks.mapInArrow(fn, "m int, cost double").groupBy("m").agg(F.sum("cost").alias("cost"))
        return {r["m"]: r["cost"] for r in out.collect()}  # one row a model

    def drawn(active, cost, turn):
        def fn(batches):
            for X, h in _chunks(batches, d):
                for i in active:
                    chance = OVERSAMPLING * models[i][1] * _nearest_distance(X, sets[i]) / cost[i]
                    hit = np.flatnonzero(uniform_np(h, models[i][2], turn) < chance)
                    if len(hit):
                        yield pa.RecordBatch.from_pydict({"m": pa.array(np.full(len(hit), i, np.int32)), "x": pa.array(X[hit].tolist(), pa.list_(pa.float64()))})
        got = blocks.mapInArrow(fn, "m int, x array<double>").toArrow()  # about OVERSAMPLING x k rows a model
        m = got.column("m").to_numpy()
        X = arrow_matrix(got.column("x"), d)
        return {i: X[m == i] for i in active}

    # rounding in the expanded distance form leaves a little cost on rows that are candidates themselves
    active, turn = list(range(len(models))), 0
    scale = None
    while active:
        cost = costs(active)
        scale = scale or max(cost.values()) or 1.0
        active = [i for i in active if cost[i] > 1e-9 * scale and (turn < SEED_ROUNDS or len(sets[i]) < models[i][1])]
        if not active:
            break
        for i, X in drawn(active, cost, turn).items():
            sets[i] = np.unique(np.vstack([sets[i], X]), axis=0)
        turn += 1
    weights = lloyd_pass(blocks, [(i, c) for i, c in enumerate(sets)], d)
    return {tag: (sets[i], np.maximum(weights[i][1], 1e-9).astype(float)) for i, (tag, _, _) in enumerate(models)}


def arrow_matrix(col, d: int | None = None) -> np.ndarray:
    """(n, d) float64 matrix from an Arrow list<double/float> column (no per-row objects)."""
    if isinstance(col, pa.ChunkedArray):
        col = pa.concat_arrays(col.chunks) if col.num_chunks != 1 else col.chunk(0)
    n = len(col)
    if n == 0:
        return np.zeros((0, d or 0))
    if col.null_count:
        raise ValueError("null feature vector")
    offsets = col.offsets.to_numpy()
    width = int(offsets[1] - offsets[0])
    if not np.all(np.diff(offsets) == width):
        raise ValueError("feature vectors differ in length")
    values = col.values.slice(int(offsets[0]), n * width).to_numpy(zero_copy_only=False).astype(np.float64, copy=False)
    if not np.isfinite(values).all():
        raise ValueError("feature vector with a null, NaN or infinite entry")
    return values.reshape(n, width)


def summed(partial: DataFrame) -> np.ndarray | None:
    """The sum of the vectors of ``partial`` (part int, v binary: doubles, one row a task, all of one length); None without rows.

    About sqrt(cores) tasks add up what the first tasks send, and the driver adds up theirs, in the order of ``part``: no place sees
    more than its share of the tasks, nothing is planned per component, and a rerun adds in the same order.
    """
    fan = max(1, math.isqrt(partial.sparkSession.sparkContext.defaultParallelism))

    def add(batches):
        total, first = None, 0
        for batch in batches:
            for part, v in zip(batch.column(0).to_pylist(), batch.column(1)):
                x = np.frombuffer(v.as_buffer(), np.float64)
                if total is None:
                    total, first = x.copy(), part
                else:
                    total += x
        if total is not None:
            yield pa.RecordBatch.from_pydict({"part": pa.array([first], pa.int32()), "v": pa.array([total.tobytes()], pa.binary())})
    out = partial.repartition(fan, "part").sortWithinPartitions("part").mapInArrow(add, "part int, v binary").toArrow()  # ``fan`` rows at most
    vectors = [np.frombuffer(v, np.float64) for _, v in sorted(zip(out.column("part").to_pylist(), out.column("v").to_pylist()))]
    return np.sum(vectors, axis=0) if vectors else None


def task_vector(v: np.ndarray) -> pa.RecordBatch:
    """A task's row for ``summed``."""
    from pyspark import TaskContext
    return pa.RecordBatch.from_pydict({"part": pa.array([TaskContext.get().partitionId()], pa.int32()), "v": pa.array([v.tobytes()], pa.binary())})


def _partial_sums_fn(run_centers: list, d: int):
    """mapInArrow body: a task's counts, costs and sums of all runs' clusters, in one vector.

    One distance matrix for all runs' centres, one 0/1 assignment matrix, one
    matrix product for the sums — the only Python loop is an argmin per run.
    """

    all_c = np.vstack([c for _, c in run_centers])
    sizes = [len(c) for _, c in run_centers]
    lo = np.concatenate([[0], np.cumsum(sizes)])
    cn = (all_c ** 2).sum(1)

    def fn(batches):
        tot = len(all_c)
        acc_s, acc_n, acc_cost = np.zeros((tot, d)), np.zeros(tot), np.zeros(tot)
        for X, _ in _chunks(batches, d):
            rows, xn = np.arange(len(X)), (X ** 2).sum(1)
            G = cn[None, :] - 2.0 * (X @ all_c.T)
            A = np.zeros((len(X), tot))
            for a, b in zip(lo[:-1], lo[1:]):
                own = np.argmin(G[:, a:b], axis=1)
                A[rows, a + own] = 1.0
                acc_cost[a:b] += np.bincount(own, np.maximum(G[rows, a + own] + xn, 0.0), b - a)
                acc_n[a:b] += np.bincount(own, minlength=b - a)
            acc_s += A.T @ X
        if acc_n.any():
            yield task_vector(np.concatenate([acc_n, acc_cost, acc_s.ravel()]))
    return fn


def lloyd_pass(blocks: DataFrame, run_centers: list, d: int) -> dict:
    """One distributed assignment pass over packed rows: {run: (sums k×d, counts k, costs k)}."""
    ends = np.concatenate([[0], np.cumsum([len(c) for _, c in run_centers])])
    total = summed(blocks.mapInArrow(_partial_sums_fn(run_centers, d), "part int, v binary"))
    if total is None:
        total = np.zeros(int(ends[-1]) * (d + 2))
    n, cost, sums = total[:ends[-1]], total[ends[-1]:2 * ends[-1]], total[2 * ends[-1]:].reshape(-1, d)
    # counts are whole numbers, exact in a double up to 2^53
    return {rid: (sums[a:b].copy(), n[a:b].astype(np.int64), cost[a:b].copy()) for (rid, _), a, b in zip(run_centers, ends[:-1], ends[1:])}


def farthest_rows(df: DataFrame, features: str, key: str, wanted: list, d: int) -> dict:
    """{run: rows} with the largest distance to their centre, for ``wanted`` (run, centres, how many)."""

    return _farthest(packed(df, features, key, d), wanted, d)


def _farthest(blocks: DataFrame, wanted: list, d: int) -> dict:
    def fn(batches):
        best = {rid: (np.zeros(0), np.zeros((0, d)), np.zeros(0, np.int64)) for rid, _, _ in wanted}
        for X, h in _chunks(batches, d):
            for rid, c, many in wanted:
                d2 = np.concatenate([best[rid][0], _nearest_distance(X, c)])
                keep = np.lexsort((np.concatenate([best[rid][2], h]), -d2))[:many]
                best[rid] = (d2[keep], np.vstack([best[rid][1], X])[keep], np.concatenate([best[rid][2], h])[keep])
        for rid, (d2, X, h) in best.items():
            if len(d2):
                yield pa.RecordBatch.from_pydict({"run": pa.array(np.full(len(d2), rid, np.int32)), "d2": pa.array(d2), "h": pa.array(h), "x": pa.array(X.tolist(), pa.list_(pa.float64()))})
    most = {rid: many for rid, _, many in wanted}
    ranked = blocks.mapInArrow(fn, "run int, d2 double, h long, x array<double>").withColumn(
        "_r", F.row_number().over(Window.partitionBy("run").orderBy(F.desc("d2"), "h"))).where(F.col("_r") <= max(most.values()))
    out: dict = {rid: [] for rid in most}
    for r in ranked.orderBy("run", "_r").collect():  # as many rows as there are empty clusters
        if len(out[r["run"]]) < most[r["run"]] and r["d2"] > 0:
            out[r["run"]].append(np.array(r["x"]))
    return out


def kmeans_multi(df: DataFrame, features: str, key: str, ks, n_init: int = 10, max_iter: int = 300,
                 tol: float = 1e-4, seed: int = 42) -> dict:
    """Fit every k in ``ks`` with ``n_init`` restarts; return {k: best KMeansRun}.

    ``df`` should be persisted by the caller (it is scanned once per iteration).
    """
    return kmeans_specs(df, features, key, [(k, n_init, max_iter) for k in ks], tol, seed)


def kmeans_specs(df: DataFrame, features: str, key: str, specs, tol: float = 1e-4, seed: int = 42, start: dict | None = None) -> dict:
    """Fit several models in the same passes over the data.

    ``specs`` items are ``(k, n_init, max_iter)`` (result keyed by k) or ``(tag, k, n_init, max_iter, seed)`` (result keyed by tag).
    ``start`` gives a tag's start centres (one run); a negative ``tol`` keeps a run going until ``max_iter``.
    Returns the best run (lowest cost over its restarts) per key.  A model's result does not depend on the others.
    """
    norm, start = [], start or {}
    for sp in specs:
        if len(sp) == 3:
            k, r, m = sp
            norm.append((int(k), int(k), int(r), int(m), seed))
        else:
            tag, k, r, m, sd = sp
            norm.append((tag, int(k), int(r), int(m), int(sd)))
    width = df.select(F.size(features).alias("d")).first()
    if width is None:
        raise ValueError("no rows to cluster")
    d = int(width["d"])
    blocks = packed(df, features, key, d).persist()
    try:
        return _fitted(blocks, d, norm, tol, start)
    finally:
        blocks.unpersist()


def _fitted(blocks: DataFrame, d: int, norm: list, tol: float, start: dict) -> dict:
    (sums, n, square), = lloyd_pass(blocks, [(0, np.zeros((1, d)))], d).values()
    total = max(int(n[0]), 1)
    tol_abs = tol * max(float(square[0] / total - ((sums[0] / total) ** 2).sum()) / d, 0.0)  # tol x the mean variance of the columns
    open_ = [(tag, k, sd + 1000 * k) for tag, k, _, _, sd in norm if tag not in start]
    seeds = seed_candidates(blocks, open_, d) if open_ else {}
    runs = {}
    for tag, k, n_init, max_iter, sd in norm:
        for r in range(1 if tag in start else n_init):
            centers = np.array(start[tag], np.float64) if tag in start else weighted_kmeanspp(*seeds[tag], k, np.random.default_rng(sd + 1000 * k + r))
            runs[len(runs)] = dict(tag=tag, k=len(centers), run=r, centers=centers, n_iter=0, converged=False, max_iter=max_iter, log=[])
    while True:
        active = {i: v for i, v in runs.items() if not (v["converged"] or v["n_iter"] >= v["max_iter"])}
        if not active:
            break
        sums = lloyd_pass(blocks, [(i, v["centers"]) for i, v in active.items()], d)
        wanted = [(i, v["centers"], int((sums[i][1] == 0).sum())) for i, v in active.items() if (sums[i][1] == 0).any()]
        moved = _farthest(blocks, wanted, d) if wanted else {}
        for i, v in active.items():
            s, n, cost = sums[i]
            new = v["centers"].copy()
            filled = n > 0
            new[filled] = s[filled] / n[filled][:, None]
            for c, x in zip(np.flatnonzero(~filled), moved.get(i, [])):
                new[c] = x
            change = ((new - v["centers"]) ** 2).sum(1)
            v["log"].append((float(cost.sum()), int((change > 0).sum()), float(change.sum())))
            v["centers"], v["n_iter"], v["converged"] = new, v["n_iter"] + 1, float(change.sum()) <= tol_abs
    last = lloyd_pass(blocks, [(i, v["centers"]) for i, v in runs.items()], d)
    best: dict = {}
    for i, v in runs.items():
        run = KMeansRun(v["k"], v["run"], v["centers"], float(last[i][2].sum()), v["n_iter"], [int(x) for x in last[i][1]], v["converged"], v["log"])
        if v["tag"] not in best or run.cost < best[v["tag"]].cost:
            best[v["tag"]] = run
    return {t: canonical(r) for t, r in best.items()}


def start_rows(df: DataFrame, features: str, key: str, k: int, salt: str = "start") -> np.ndarray:
    """Start centres that depend on the keys alone: the k rows with the smallest md5(salt:key)."""
    from segkit.functions.hashing import hash_rank_key
    order = [hash_rank_key(salt, key), F.col(key)]
    return np.array([r[0] for r in df.orderBy(*order).limit(k).select(F.col(features).cast("array<double>")).collect()])


def canonical(run: KMeansRun) -> KMeansRun:
    """Relabel clusters by size (descending), then by first coordinate, then old id."""
    order = sorted(range(run.k), key=lambda c: (-run.sizes[c], float(run.centers[c][0]), c))
    return KMeansRun(run.k, run.run, run.centers[order], run.cost, run.n_iter,
                     [run.sizes[c] for c in order], run.converged, run.log)


def _labels(col, all_c: np.ndarray, bounds) -> np.ndarray:
    """Nearest centre of each row within each set of centres (n x sets); the first on ties."""
    X = arrow_matrix(col, all_c.shape[1])
    cn = (all_c ** 2).sum(1)
    out = np.zeros((len(X), len(bounds) - 1), np.int32)
    for a in range(0, len(X), CHUNK_ROWS):
        G = cn[None, :] - 2.0 * (X[a:a + CHUNK_ROWS] @ all_c.T)
        for j in range(len(bounds) - 1):
            out[a:a + CHUNK_ROWS, j] = G[:, bounds[j]:bounds[j + 1]].argmin(axis=1)
    return out


def assign_many(df: DataFrame, center_sets: dict, features: str = "features") -> DataFrame:
    """K9: label rows against one or more centre sets (output column → centres) in ONE Arrow-batched pass."""

    names = list(center_sets)
    mats = [np.asarray(center_sets[n], dtype=np.float64) for n in names]
    all_c, bounds = np.vstack(mats), np.cumsum([0] + [m.shape[0] for m in mats])

    @F.arrow_udf(T.ArrayType(T.IntegerType()))
    def nearest_all(col: pa.Array) -> pa.Array:
        labels = _labels(col, all_c, bounds)
        ends = np.arange(len(labels) + 1, dtype=np.int32) * labels.shape[1]
        return pa.ListArray.from_arrays(pa.array(ends), pa.array(labels.ravel()))

    tmp = "_labels"
    out = df.withColumn(tmp, nearest_all(F.col(features).cast("array<double>")))
    return out.withColumns({n: F.col(tmp)[i] for i, n in enumerate(names)}).drop(tmp)


def assign(df: DataFrame, centers: np.ndarray, features: str = "features", output: str = "prediction") -> DataFrame:
    """Label each row with its nearest centre."""
    return assign_many(df, {output: centers}, features)


def nearest_label(df: DataFrame, centers: DataFrame, features: str, output: str) -> DataFrame:
    """K9 for centres that are a table (label, center), one row a label: the label of the nearest one, in the plan itself."""
    table = centers.agg(F.sort_array(F.collect_list(F.struct(F.col(centers.columns[0]).alias("l"), F.col("center").alias("c"))))).scalar()
    best = F.array_min(F.transform(F.col("_centers"), lambda t: F.struct(squared_distance(F.col(features), t["c"]).alias("d"), t["l"].alias("l"))))
    return df.withColumn("_centers", table).withColumn(output, best["l"]).drop("_centers")


def centers_frame(spark, centers: np.ndarray, names=None):
    """Centres as a small DataFrame (cluster, coordinates array)."""
    rows = [(i, [float(v) for v in c]) for i, c in enumerate(np.asarray(centers))]
    return spark.createDataFrame(rows, "cluster int, center array<double>")


def centers_by(df: DataFrame, group: str, array_col: str) -> DataFrame:
    """(group, center): element-wise mean of an array column, one partial sum a task and group."""
    from pyspark.ml.functions import array_to_vector, vector_to_array
    from pyspark.ml.stat import Summarizer
    vector = array_to_vector(F.col(array_col).cast("array<double>"))
    return df.groupBy(group).agg(vector_to_array(Summarizer.mean(vector)).alias("center"))


def squared_distance(a: Column, b: Column) -> Column:
    return F.aggregate(F.zip_with(a, b, lambda x, y: (x - y) * (x - y)), F.lit(0.0), lambda acc, v: acc + v)


def wcss_by_label(df: DataFrame, features: str, label: str) -> DataFrame:
    """K3 for given labels: centroid per label (Spark aggregate), then the sum of
    squared distances of each row to its own centroid.  Centroids are joined
    back on the label."""
    from segkit.operators.joins import lookup_join
    cents = centers_by(df, label, features)
    joined = lookup_join(df.select(label, F.col(features).cast("array<double>").alias(features)), cents, on=label)
    return joined.groupBy(label).agg(F.count(F.lit(1)).alias("n"),
                                     F.sum(squared_distance(F.col(features), F.col("center"))).alias("wcss"))
