"""End-to-end segmentation: clean → encode → k sweep → k-means + Ward → labelled table.

Scale notes:
- the encoded feature table is written once with ``checkpoint()`` into the
  shared ``spark.checkpoint.dir`` (cuts the dedup/impute lineage, survives lost
  executors) and cached for the iterative passes;
- every Lloyd iteration is one job for all (k, restart) runs;
- k is chosen by the linear (squared Euclidean) silhouette at every size; the 0.02 gap rule applies to its values;
- Ward runs on at most ``micro`` weighted centroids on the driver.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession

from segkit.operators import kmeans as KM
from segkit.operators.features import FeatureModel, fit_features
from segkit.operators.modelsel import AMBIGUITY_GAP, DEFAULT_K, choose_k
from segkit.operators.profile import profile_with_top
from segkit.operators.quality import same_counts
from segkit.operators.validate import silhouettes
from segkit.operators.ward import MICRO_CLUSTERS, WardModel, micro_spec, micro_summary, ward_from_micro
from segkit.plans.clean import clean_buyers, dedup_buyers
from segkit.session import ensure_checkpoint_dir
from segkit.sources.fixtures import buyers_ordered

from segkit.fixed_values import (CATEGORICAL_FEATURES as CATEGORICAL, FINAL_MAX_ITER, FINAL_RESTARTS,
                                 K_RANGE, NUMERIC_FEATURES as NUMERIC, RANDOM_SEED, SWEEP_MAX_ITER,
                                 SWEEP_RESTARTS)
KEY = "client_id"
LABEL = "cohort_label"


@dataclass
class Segmentation:
    features: FeatureModel
    k: int
    decision: dict
    k_table: list                     # (k, silhouette, inertia, n_iter, metric)
    kmeans: KM.KMeansRun
    ward: WardModel | None
    labelled: DataFrame               # clean rows + features + kmeans_cluster + agglomerative_cluster
    imputer: object = None
    extra: dict = field(default_factory=dict)

    def release(self) -> None:
        """Drop the cached labelled table (the report, export and dashboard reuse it) and the feature table below it."""
        self.labelled.unpersist()
        self.extra["features_table"].unpersist()

    def k_table_frame(self, spark) -> DataFrame:
        return spark.createDataFrame(
            [(int(k), float(s), float(i), int(n), m, int(k) == self.k) for k, s, i, n, m in self.k_table],
            "k int, silhouette double, inertia double, n_iter int, metric string, selected boolean")


def encode(df: DataFrame, model: FeatureModel | None = None):
    fm = model or fit_features(df, NUMERIC, CATEGORICAL)
    return fm, fm.transform(df)


# Rows per partition of the encoded feature table (~1 GB of features at ~140 doubles a row).
ROWS_PER_PARTITION = 1_000_000


def materialise(clean: DataFrame, model: FeatureModel, rows: int, partitions: int | None = None) -> DataFrame:
    """Spread the narrow cleaned rows evenly (by hash of the key), encode them where they land, write a reliable checkpoint into
    the shared folder (cuts lineage), and cache it for the iterative passes.

    The partition count follows the data (``rows`` / ``ROWS_PER_PARTITION``) with the cluster's cores as the floor."""
    import math
    spark = clean.sparkSession
    ensure_checkpoint_dir(spark)
    parts = partitions or max(spark.sparkContext.defaultParallelism, math.ceil(rows / ROWS_PER_PARTITION))
    return model.transform(clean.repartition(parts, KEY)).checkpoint(eager=True).persist()


def k_sweep(X: DataFrame, ks, n_init: int = 10, max_iter: int = 300, seed: int = 42,
            features: str = "features", key: str = KEY, extra_specs=(), silhouette: str = "squared"):
    """Fit every k (``n_init`` restarts each) plus any ``extra_specs`` in shared passes, then score the sweep's best runs."""
    specs = [(("sweep", k), k, n_init, max_iter, seed) for k in ks] + list(extra_specs)
    fitted = KM.kmeans_specs(X, features, key, specs)
    runs = {k: fitted[("sweep", k)] for k in ks}
    labelled = KM.assign_many(X.select(key, features), {f"k{k}": r.centers for k, r in runs.items()}, features).persist()
    sil, metric = silhouettes(labelled, features, [f"k{k}" for k in runs], key, silhouette)
    labelled.unpersist()
    table = [(k, sil[f"k{k}"], runs[k].cost, runs[k].n_iter, metric) for k in sorted(runs)]
    return runs, table, {t: r for t, r in fitted.items() if t[0] != "sweep"}


def segment(raw: DataFrame, ks=K_RANGE, n_init_sweep: int = SWEEP_RESTARTS, n_init_final: int = FINAL_RESTARTS,
            max_iter_sweep: int = SWEEP_MAX_ITER, max_iter_final: int = FINAL_MAX_ITER,
            default_k: int = DEFAULT_K, gap: float = AMBIGUITY_GAP, micro: int = MICRO_CLUSTERS,
            seed: int = RANDOM_SEED, with_ward: bool = True, silhouette: str = "squared", order_by: str = "seq") -> Segmentation:
    """The whole modelling run over raw buyers with their order column.  ``silhouette`` names the metric of the k choice
    ("squared", linear, or "exact")."""
    import time
    times = {}
    t0 = time.time()

    def lap(name):
        times[name] = time.time() - t0 - sum(times.values())
    # the deduplicated table feeds the fit jobs and the feature write: compute it once
    deduped = dedup_buyers(raw, order_by).persist()
    n_clean = deduped.count()
    clean = clean_buyers(raw, deduped=deduped)
    lap("clean")
    fm = fit_features(clean.df, NUMERIC, CATEGORICAL)
    lap("encode")
    X = materialise(clean.df, fm, n_clean)
    deduped.unpersist()
    lap("materialise")
    # Ward's micro-clusters do not depend on the chosen k: they share the sweep's passes
    runs, table, fitted = k_sweep(X, list(ks), n_init_sweep, max_iter_sweep, seed,
                                  extra_specs=[micro_spec(micro, seed)] if with_ward else [], silhouette=silhouette)
    lap("sweep")
    k_table = raw.sparkSession.createDataFrame([(int(k), float(s), float(i)) for k, s, i, _, _ in table], "k int, silhouette double, inertia double")
    decision = choose_k(k_table, default_k=default_k, gap=gap).first().asDict()
    k = int(decision["k"])
    lap("choose")
    final = KM.kmeans_specs(X, "features", KEY, [(("final", k), k, n_init_final, max_iter_final, seed + 7)])[("final", k)]
    same_counts(n_clean, sum(final.sizes))  # Q5: every cleaned row has its label
    labelled = KM.assign(X, final.centers, "features", "kmeans_cluster")
    lap("final")
    ward = None
    if with_ward:
        ward = ward_from_micro(*micro_summary(fitted[("micro", micro)]), k)
        labelled = ward.transform(labelled, "features", "agglomerative_cluster")
    labelled = labelled.persist()  # reused by the report, the export and the dashboard
    lap("ward")
    return Segmentation(fm, k, decision, table, final, ward, labelled, clean.imputer, extra={"seconds": times, "features_table": X})


def collect_all(frames: dict, threads: int = 4) -> dict:
    """Run independent result queries concurrently (one Spark job each, separate threads)."""
    from concurrent.futures import ThreadPoolExecutor
    with ThreadPoolExecutor(max_workers=threads) as pool:
        futures = {name: pool.submit(df.collect) for name, df in frames.items()}
        return {name: f.result() for name, f in futures.items()}


def cluster_report(seg: Segmentation, cluster_col: str = "kmeans_cluster") -> DataFrame:
    """Profile per cluster with the top country (report blocks B/C)."""
    return profile_with_top(seg.labelled, cluster_col, "country")


def flagship(spark: SparkSession, sf_dir: str) -> DataFrame:
    """entry(): full segmentation on the buyer fixture, k-means cluster profile."""
    seg = segment(buyers_ordered(spark, sf_dir))
    return cluster_report(seg).orderBy("kmeans_cluster")
