"""Variance-minimising (Ward) hierarchical clustering at scale (K7, K8).

1. Spark k-means summarises the rows into at most ``m`` (default 512) weighted micro-clusters, whatever the number of rows; with no more
   than ``m`` distinct rows every distinct row is its own micro-cluster, and the result is Ward on the rows.
2. Ward merges run over those weighted points with the nearest-neighbour-chain algorithm (Lance-Williams updates, O(m^2) time and
   memory) — the only driver-side work, bounded by ``m``.
3. The cut at ``k`` maps micro-cluster → cluster; rows get their cluster by
   nearest micro-centroid (a distributed, Arrow-batched assignment).

Ward distance between clusters a, b: sqrt(2 n_a n_b / (n_a + n_b)) * ||c_a - c_b||.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from segkit.operators import kmeans as KM

MICRO_CLUSTERS = 512
MICRO_MAX_ITER = 20  # micro-clusters only summarise rows for Ward


@dataclass
class WardModel:
    micro_centers: np.ndarray
    micro_sizes: np.ndarray
    linkage: list          # (step, left, right, distance, size)
    micro_to_cluster: np.ndarray
    k: int

    def linkage_frame(self, spark) -> DataFrame:
        return spark.createDataFrame([(int(s), int(a), int(b), float(d), int(n)) for s, a, b, d, n in self.linkage],
                                     "step int, left int, right int, distance double, size bigint")

    def transform(self, df: DataFrame, features: str = "features", output: str = "ward_cluster") -> DataFrame:
        labelled = KM.assign(df, self.micro_centers, features, "_micro")
        mapping = F.array(*[F.lit(int(c)) for c in self.micro_to_cluster])
        return labelled.withColumn(output, F.element_at(mapping, F.col("_micro") + 1).cast("int")).drop("_micro")


def ward_merges(centers: np.ndarray, sizes: np.ndarray) -> list:
    """Full Ward merge sequence over weighted points (ids follow the scipy convention).

    Nearest-neighbour chain: Ward linkage is reducible, so following chains of
    nearest neighbours until two clusters are mutual nearest neighbours yields the
    same hierarchy as the greedy closest-pair loop, in O(m^2) instead of O(m^3).
    Distances are updated with Lance-Williams; merges are sorted by distance and
    relabelled at the end.
    """
    m = centers.shape[0]
    if m < 2:
        return []
    size = sizes.astype(np.float64).copy()
    c = centers.astype(np.float64)
    nrm = (c ** 2).sum(1)
    sq = np.maximum(nrm[:, None] + nrm[None, :] - 2.0 * (c @ c.T), 0.0)
    D = 2.0 * size[:, None] * size[None, :] / (size[:, None] + size[None, :]) * sq   # squared Ward distance
    np.fill_diagonal(D, np.inf)
    active = np.ones(m, dtype=bool)
    raw = []            # (slot a, slot b, squared distance, merged size); slot a keeps the merged cluster
    chain: list = []
    for _ in range(m - 1):
        if not chain:
            chain.append(int(np.flatnonzero(active)[0]))
        while True:
            a = chain[-1]
            b = int(np.argmin(D[a]))
            if len(chain) > 1 and D[a, chain[-2]] <= D[a, b]:
                b = chain[-2]
            if len(chain) > 1 and b == chain[-2]:
                break
            chain.append(b)
        a = chain.pop()
        b = chain.pop()
        if a > b:
            a, b = b, a
        d2 = D[a, b]
        na, nb = size[a], size[b]
        new = ((na + size) * D[a] + (nb + size) * D[b] - size * d2) / (na + nb + size)
        new[~active] = np.inf
        new[a] = np.inf
        new[b] = np.inf
        D[a, :] = new
        D[:, a] = new
        D[b, :] = np.inf
        D[:, b] = np.inf
        active[b] = False
        size[a] = na + nb
        raw.append((a, b, float(d2), int(na + nb)))
    # sort by distance (stable) and give merged clusters scipy ids m, m+1, ...
    order = sorted(range(len(raw)), key=lambda i: raw[i][2])
    parent = list(range(m))
    label = list(range(m))

    def find(x):
        while parent[x] != x:
            parent[x] = parent[parent[x]]
            x = parent[x]
        return x
    out = []
    for step, i in enumerate(order):
        a, b, d2, n = raw[i]
        ra, rb = find(a), find(b)
        out.append((step, min(label[ra], label[rb]), max(label[ra], label[rb]), float(np.sqrt(max(d2, 0.0))), n))
        parent[rb] = ra
        label[ra] = m + step
    return out


def cut(linkage: list, m: int, k: int) -> np.ndarray:
    """Micro-cluster → flat cluster id after keeping the first m-k merges."""
    parent = list(range(m))

    def find(x):
        while parent[x] != x:
            parent[x] = parent[parent[x]]
            x = parent[x]
        return x
    node_rep = {i: i for i in range(m)}
    for step, a, b, _d, _n in linkage[: m - k]:
        ra, rb = find(node_rep[a]), find(node_rep[b])
        parent[rb] = ra
        node_rep[m + step] = ra
    roots = [find(i) for i in range(m)]
    uniq = {r: i for i, r in enumerate(sorted(set(roots)))}
    return np.array([uniq[r] for r in roots])


def fit_ward(df: DataFrame, features: str, key: str, k: int, micro: int = MICRO_CLUSTERS,
             seed: int = 42, max_iter: int = MICRO_MAX_ITER) -> WardModel:
    """``max_iter`` bounds the micro-cluster k-means: it only summarises the rows."""
    run = KM.kmeans_specs(df, features, key, [micro_spec(micro, seed, max_iter)])[("micro", micro)]
    return ward_from_micro(*micro_summary(run), k)


def micro_spec(micro: int = MICRO_CLUSTERS, seed: int = 42, max_iter: int = MICRO_MAX_ITER) -> tuple:
    """The micro-cluster k-means as an entry of ``kmeans_specs``."""
    return ("micro", micro), micro, 1, max_iter, seed


def micro_summary(run: KM.KMeansRun):
    """(centres, sizes) of the micro-clusters that hold rows."""
    keep = np.array(run.sizes) > 0
    return run.centers[keep], np.array(run.sizes, dtype=np.float64)[keep]


def ward_from_micro(centers: np.ndarray, sizes: np.ndarray, k: int) -> WardModel:
    m = centers.shape[0]
    if k > m:
        raise ValueError(f"k={k} exceeds the number of micro-clusters ({m})")
    link = ward_merges(centers, sizes)
    labels = cut(link, m, k)
    # canonical ids: cluster size descending, then smallest micro id
    csize = np.bincount(labels, weights=sizes, minlength=k)
    first = [int(np.where(labels == c)[0].min()) for c in range(k)]
    order = sorted(range(k), key=lambda c: (-csize[c], first[c]))
    remap = {c: i for i, c in enumerate(order)}
    return WardModel(centers, sizes, link, np.array([remap[c] for c in labels]), k)
