"""Ward clustering of the rows themselves (K7, K8), in rounds that merge all reciprocal nearest neighbours at once.

Ward linkage is reducible: a merge never brings two other clusters closer than their nearest neighbours were.  So all pairs that are each
other's nearest neighbour may be merged in the same round, and the merges are those of the greedy closest-pair loop, in another order.

1. Equal rows are one weighted point.
2. A cluster keeps a list of its nearest clusters and a bound that all others are beyond.  Merges update both without a look at the rows
   (``lists_after``); as a merge brings nobody nearer, a list's first is the nearest neighbour as long as it is below the bound.
3. Each round, clusters without such a first (merged ones, and those whose list is used up) are packed into blocks that meet the blocks of all
   clusters (``pairs``: nothing is replicated); a task keeps the nearest of each row among the blocks it sees (numpy on packed matrices), and
   an aggregate keeps the nearest of all.  Then all reciprocal pairs merge.  Should rounding leave none, the closest pair of all merges.
4. When one block holds them, the clusters are merged by one task down to ``finish``, and the driver ends the tree, both with the
   nearest-neighbour chain of ``ward.ward_merges``.

Comparing all pairs is what the exact tree costs: points ^ 2 in the first round, later rounds the clusters that seek times those left, spread
over tasks of bounded memory; what a round shuffles and writes grows with its clusters.  For more rows than that allows, ``ward.fit_ward`` works
on summaries.  The tree is a table of merges; ``cut_rows`` cuts it by pointer jumping in Spark.

No rows give no merges.  Rows with null or infinite features raise.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from segkit.operators.kmeans import arrow_matrix
from segkit.operators.pairs import BLOCK_BYTES, SLICE_ROWS, block_pairs, longs, matrix, packed_blocks, records, written
from segkit.operators.ward import ward_merges

BLOCK_ROWS = 4096         # and the clusters that one task merges: their distance matrix is 128 MB
FINISH = 1024
NEAR = 15                 # neighbours a cluster knows
CANDIDATES = 1 << 16      # distances a task looks at in one step
NOBODY = np.iinfo(np.int64).max
MERGES = "a long, b long, distance double, size long"
NEAR_TYPE = "array<struct<d2: double, other: bigint>>"
BLOCK_TYPES = pa.int64(), pa.int64(), pa.float64(), pa.int64(), pa.list_(pa.float64())


def points(df: DataFrame, features: str) -> DataFrame:
    """(id, size, x): distinct feature rows with their number, under ids of no meaning."""
    rows = df.select(F.col(features).cast("array<double>").alias("x")).groupBy("x").agg(F.count(F.lit(1)).alias("size"))
    return written(rows.withColumn("id", F.monotonically_increasing_id()).select("id", "size", "x"), "ward-points")


def nearest(clusters: DataFrame, left: int, d: int, block_rows: int = BLOCK_ROWS, some: DataFrame | None = None, n_some: int = 0) -> DataFrame:
    """(id, size, other, d2, near, far) of ``some`` (``n_some``; all without it) among ``left`` clusters, by squared Ward distance.

    ``near`` is up to ``NEAR`` clusters (d2, other) by (d2, other), the first of them as other and d2; no other cluster is nearer than ``far``.
    Distances in ``near`` are sums of squared differences, the same for both clusters of a pair; a matrix product only finds the candidates.
    """
    blocks = packed_blocks(clusters, "x", "id", ["size"], left, d, block_rows)
    mine = blocks if some is None else packed_blocks(some, "x", "id", ["size"], n_some, d, block_rows)
    keep = NEAR + 1

    def fn(batches):
        best: dict = {}   # block: (ids, sizes, d2, other) of its rows so far, nearest first; a task sees the blocks of two partitions
        for r in records(batches):
            X, Y, a, b = matrix(r["l_x"], d), matrix(r["r_x"], d), longs(r["l_id"]), longs(r["r_id"])
            n, m = 1.0 / longs(r["l_size"]), 1.0 / longs(r["r_size"])
            *_, near, other = best.setdefault(r["l_b"].as_py(), (a.copy(), longs(r["l_size"]).copy(), np.full((len(a), keep), np.inf), np.full((len(a), keep), NOBODY)))
            # squared Ward distance < t  <=>  |y|^2 - 2 xy - t/2 m < t/2 n - |x|^2: one product and one comparison
            yn = (Y ** 2).sum(1)
            right = np.concatenate([-2.0 * Y, yn[:, None], m[:, None]], axis=1).T
            right_single = right.astype(np.float32)
            for at in range(0, len(X), SLICE_ROWS):
                rows = slice(at, at + SLICE_ROWS)
                x, half = X[rows], near[rows, -1] / 2.0
                xn = (x ** 2).sum(1)
                if np.isfinite(half).all():
                    left_, most = np.concatenate([x, np.ones((len(x), 1)), -half[:, None]], axis=1), half * n[rows] - xn
                    # single precision finds them too where its error, a bound of which is added, is small beside the distances
                    error = (d + 8) * np.finfo(np.float32).eps * (2.0 * (xn + yn.max()) + half * (n[rows] + m.max()))
                    if (error < 0.01 * half).all():
                        hit = left_.astype(np.float32) @ right_single < (most + error).astype(np.float32)[:, None]
                    else:
                        hit = left_ @ right < most[:, None]
                    row, col = np.divmod(np.flatnonzero(hit), len(Y))
                elif len(Y) > keep + 1:
                    D = (np.concatenate([x, np.ones((len(x), 1))], axis=1) @ right[:-1] + xn[:, None]) / (n[rows, None] + m[None, :])
                    col = np.argpartition(D, keep, axis=1)[:, :keep + 1].ravel()   # one more, as a row may find itself
                    row = np.repeat(np.arange(len(x)), keep + 1)
                else:
                    row, col = (v.ravel() for v in np.indices((len(x), len(Y))))
                for k in range(0, len(row), CANDIDATES):
                    i, j = at + row[k:k + CANDIDATES], col[k:k + CANDIDATES]
                    i, j = i[a[i] != b[j]], j[a[i] != b[j]]
                    closer(near, other, i, b[j], ((X[i] - Y[j]) ** 2).sum(1) * (2.0 / (n[i] + m[j])))
        for ids, sizes, near, other in best.values():
            found = other != NOBODY
            ends = np.concatenate([[0], found.sum(1).cumsum()])
            pairs = pa.StructArray.from_arrays([pa.array(near[found]), pa.array(other[found])], ["d2", "other"])
            yield pa.RecordBatch.from_pydict({"id": pa.array(ids), "size": pa.array(sizes), "near": pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pairs)})
    found = block_pairs(mine, ["x", "id", "size"], ["x", "id", "size"], blocks).mapInArrow(fn, f"id long, size long, near {NEAR_TYPE}")
    best = found.groupBy("id").agg(F.first("size").alias("size"), F.slice(F.sort_array(F.flatten(F.collect_list("near"))), 1, keep).alias("near"))
    return best.select("id", "size", F.col("near")[0]["other"].alias("other"), F.col("near")[0]["d2"].alias("d2"), F.slice("near", 1, NEAR).alias("near"),
                       F.coalesce(F.get("near", F.lit(NEAR))["d2"], F.lit(float("inf"))).alias("far"))


def closer(near: np.ndarray, other: np.ndarray, row: np.ndarray, ids: np.ndarray, d2: np.ndarray) -> None:
    """Puts candidates (``ids`` at ``d2`` of ``row``) into the rows' sorted lists ``near`` and ``other``, in place; the lists keep their length."""
    if not len(row):
        return
    keep = near.shape[1]
    order = np.lexsort((ids, d2, row))
    row, ids, d2 = row[order], ids[order], d2[order]
    at, start, count = np.unique(row, return_index=True, return_counts=True)
    place = np.arange(len(row)) - np.repeat(start, count)
    slot, few = np.repeat(np.arange(len(at)), count), place < keep
    wide = keep + min(keep, int(count.max()))
    D, I = np.full((len(at), wide), np.inf), np.full((len(at), wide), NOBODY)
    D[:, :keep], I[:, :keep] = near[at], other[at]
    D[slot[few], keep + place[few]], I[slot[few], keep + place[few]] = d2[few], ids[few]
    order = np.lexsort((I, D), axis=1)[:, :keep]
    near[at], other[at] = np.take_along_axis(D, order, 1), np.take_along_axis(I, order, 1)


def lists_after(lists: DataFrame, joined: DataFrame) -> DataFrame:
    """(id, near, far) of the clusters that did not merge, after the merges ``joined``.

    Where both halves of a merged cluster were in the list, its distance follows from theirs (Lance-Williams); where one was, the other is no
    nearer than ``far``, which bounds the merged cluster's distance and so lowers ``far``.  Where none was, it is no nearer than ``far``.
    """
    halves = [joined.select(F.col(old).alias("old"), F.col("id").alias("new"), F.col(n).alias("n_old"), F.col(m).alias("n_with"), F.col("d2").alias("within"))
              for old, n, m in (("id", "n1", "n2"), ("other", "n2", "n1"))]
    halves = halves[0].unionByName(halves[1])
    edges = lists.join(halves.select(F.col("old").alias("id")), "id", "left_anti").select("id", "size", "far", F.explode("near").alias("e"))
    edges = edges.select("id", "size", "far", "e.*").join(halves, F.col("other") == F.col("old"), "left").repartition("id")
    n = F.col("size")
    sums = edges.groupBy("id", F.coalesce("new", "other").alias("other")).agg(
        F.first("far").alias("far"), F.first("n_old").alias("n_old"), F.first("n_with").alias("n_with"), F.first("within").alias("within"), F.first("size").alias("size"),
        F.count(F.lit(1)).alias("seen"), F.sum(F.when(F.col("old").isNull(), F.col("d2")).otherwise((F.col("n_old") + n) * F.col("d2"))).alias("sum"))
    unseen = F.when(F.col("seen") == 1, (F.col("n_with") + n) * F.col("far")).otherwise(F.lit(0.0))
    d2 = F.when(F.col("within").isNull(), F.col("sum")).otherwise((F.col("sum") + unseen - n * F.col("within")) / (F.col("n_old") + F.col("n_with") + n))
    known = F.col("within").isNull() | (F.col("seen") == 2)
    after = sums.select("id", "far", F.when(known, F.struct(d2.alias("d2"), "other")).alias("e"), F.when(~known, d2).alias("bound")).groupBy("id").agg(
        F.least(F.first("far"), F.min("bound")).alias("far"), F.sort_array(F.collect_list("e")).alias("near"))
    return after.select("id", F.filter("near", lambda e: e["d2"] < F.col("far")).alias("near"), "far")


def finished(clusters: DataFrame, d: int, finish: int) -> DataFrame:
    """A block's worth of clusters merged in one task down to ``finish``: (a, b, distance, size, x), a merge, or where b is null a cluster that is left."""
    def fn(batches):
        rows = pa.Table.from_batches(list(batches))
        rows = rows.take(pa.array(np.argsort(rows.column("id").to_numpy(), kind="stable")))
        ids, sizes, X = rows.column("id").to_pylist(), rows.column("size").to_numpy(), arrow_matrix(rows.column("x"), d)
        merges = named(ids, ward_merges(X, sizes))[:max(0, len(ids) - finish)]
        now = {i: (int(n), x) for i, n, x in zip(ids, sizes, X)}
        for a, b, _, _ in merges:
            (n, x), (m, y) = now[a], now.pop(b)
            now[a] = n + m, (x * n + y * m) / (n + m)
        out = [(a, b, distance, n, None) for a, b, distance, n in merges] + [(i, None, None, n, x) for i, (n, x) in now.items()]
        yield pa.RecordBatch.from_arrays([pa.array(v, t) for v, t in zip(zip(*out), BLOCK_TYPES)], ["a", "b", "distance", "size", "x"])
    return written(clusters.select("id", "size", "x").coalesce(1).mapInArrow(fn, f"{MERGES}, x array<double>"), "ward-block")


def named(ids: list, merges: list) -> list:
    """(a, b, distance, size) of the merges of ``ward_merges``, which number the clusters; a merged cluster keeps the smaller id."""
    rows, name = [], dict(enumerate(ids))
    for step, i, j, distance, size in merges:
        a, b = sorted((name[i], name[j]))
        name[len(ids) + step] = a
        rows.append((a, b, float(distance), int(size)))
    return rows


def ward_rows(df: DataFrame, features: str, block_rows: int = BLOCK_ROWS, finish: int = FINISH) -> tuple[DataFrame, DataFrame]:
    """(points (id, size, x), merges (a, b, distance, size)): cluster b joins cluster a, which keeps the smaller id."""
    spark = df.sparkSession
    leaves = points(df, features)
    no_list = F.lit(None).cast(NEAR_TYPE).alias("near"), F.lit(None).cast("double").alias("far")
    now, parts = leaves.select("*", *no_list), []
    first = leaves.select(F.size("x").alias("d")).first()
    d = first["d"] if first else 0
    known = F.coalesce(F.get("near", F.lit(0))["d2"] < F.col("far"), F.lit(False))
    left, n_some = counted(now, known)
    while left > max(finish, min(block_rows, BLOCK_BYTES // (8 * max(d, 1)))):
        lists = now.where(known).select("id", "size", "near", "far")
        if n_some:
            found = nearest(now, left, d, block_rows, *((now.where(~known), n_some) if n_some < left else ()))
            lists = lists.unionByName(written(found.select("id", "size", "near", "far"), "ward-near"))
        pairs = lists.select("id", F.col("near")[0]["other"].alias("other"), F.col("near")[0]["d2"].alias("d2"))
        pairs = pairs.groupBy(F.least("id", "other").alias("id"), F.greatest("id", "other").alias("other")).agg(
            F.min("d2").alias("d2"), F.count(F.lit(1)).alias("sides"))
        joined = merge(now, pairs.where("sides = 2"))
        if joined.isEmpty():   # distances that differ by rounding only may run in a circle; the closest pair of all may always merge
            joined = merge(now, pairs.orderBy("d2", "id", "other").limit(1))
        parts.append(joined.select(F.col("id").alias("a"), F.col("other").alias("b"), F.sqrt("d2").alias("distance"), "size"))
        now = now.select("id", "size", "x").join(lists_after(lists, joined), "id").unionByName(joined.select("id", "size", "x", *no_list))
        now = written(now, "ward-clusters")
        left, n_some = counted(now, known)
    if left > max(finish, 1):
        block = finished(now, d, finish)
        parts.append(block.where("b is not null").drop("x"))
        now = block.where("b is null").select(F.col("a").alias("id"), "size", "x")
    rest = now.orderBy("id").toArrow()  # ``finish`` clusters at most
    merges = spark.createDataFrame(named(rest.column("id").to_pylist(), ward_merges(arrow_matrix(rest.column("x"), d), rest.column("size").to_numpy())), MERGES)
    for part in parts:
        merges = merges.unionByName(part)
    return leaves, written(merges, "ward-merges")


def counted(now: DataFrame, known) -> tuple[int, int]:
    """Clusters, and those among them whose nearest neighbour has to be sought."""
    r = now.agg(F.count(F.lit(1)).alias("n"), F.count_if(~known).alias("some")).first()
    return r["n"], r["some"]


def merge(now: DataFrame, merged: DataFrame) -> DataFrame:
    """(id, other, d2, n1, n2, size, x): the pairs ``merged`` (id, other, d2) as clusters."""
    # names of their own: inside the lambda, "size" would be the new column
    one = now.select("id", F.col("size").alias("n1"), F.col("x").alias("x1"))
    two = now.select(F.col("id").alias("other"), F.col("size").alias("n2"), F.col("x").alias("x2"))
    return written(merged.select("id", "other", "d2").join(one, "id").join(two, "other").select(
        "id", "other", "d2", "n1", "n2", (F.col("n1") + F.col("n2")).alias("size"),
        F.zip_with("x1", "x2", lambda u, v: (u * F.col("n1") + v * F.col("n2")) / (F.col("n1") + F.col("n2"))).alias("x")), "ward-merged")


def linkage_rows(leaves: DataFrame, merges: DataFrame) -> DataFrame:
    """K8: (step, a, b, distance, size) by rising distance; a and b are the clusters' smallest leaves, ``step`` counts from 0."""
    counts = written(merges.repartitionByRange("distance", "size", "a", "b").sortWithinPartitions("distance", "size", "a", "b")
                     .withColumn("_at", F.monotonically_increasing_id()), "ward-order")
    part = F.shiftright("_at", 33)
    before, total = [], 0
    for p, n in sorted((r["p"], r["n"]) for r in counts.groupBy(part.alias("p")).agg(F.count(F.lit(1)).alias("n")).collect()):  # one row a partition
        before.append((p, total))
        total += n
    bases = merges.sparkSession.createDataFrame(before, "_p long, _base long")
    return (counts.withColumn("_p", part).join(bases, "_p")
            .select((F.col("_base") + F.col("_at").bitwiseAND((1 << 33) - 1)).alias("step"), "a", "b", "distance", "size"))


def cut_rows(leaves: DataFrame, merges: DataFrame, k: int) -> DataFrame:
    """(id, root): the clusters left when all but the k - 1 last merges are made; roots by pointer jumping."""
    keep = leaves.count() - k
    if keep < 0:
        raise ValueError(f"k={k} exceeds the number of distinct rows")
    up = linkage_rows(leaves, merges).where(F.col("step") < keep).select(F.col("b").alias("id"), F.col("a").alias("to"))
    now = leaves.select("id").join(up, "id", "left").select("id", F.coalesce("to", "id").alias("root"))
    now = written(now, "ward-roots")
    while True:
        on = now.select(F.col("id").alias("root"), F.col("root").alias("next"))
        later = written(now.join(on, "root").select("id", F.col("next").alias("root"), (F.col("next") != F.col("root")).alias("moved")), "ward-roots")
        now = later.select("id", "root")
        if not later.where("moved").limit(1).count():
            return now


def label_rows(df: DataFrame, features: str, k: int, output: str = "agglomerative_cluster", **how) -> DataFrame:
    """``df`` with the cluster of Ward on the rows, cut at k; ids by falling size, then by the smallest leaf."""
    leaves, merges = ward_rows(df, features, **how)
    tagged = cut_rows(leaves, merges, k).join(leaves, "id")
    sizes = sorted((-r["n"], r["root"]) for r in tagged.groupBy("root").agg(F.sum("size").alias("n")).collect())  # k rows
    number = df.sparkSession.createDataFrame([(root, i) for i, (_, root) in enumerate(sizes)], f"root long, {output} int")
    labels = tagged.join(number, "root").select(F.col("x").alias("_x"), output)
    return df.join(labels, F.col(features).cast("array<double>") == F.col("_x")).drop("_x")
