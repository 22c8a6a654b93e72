"""Run report (V6): the tables a segmentation run prints, as DataFrames."""

from __future__ import annotations

from pyspark.sql import DataFrame

from segkit.functions.scalar import fixed_round
from segkit.operators.profile import cluster_sizes, purity
from segkit.operators.validate import model_comparison, silhouettes
from segkit.plans.segmentation import KEY, LABEL, Segmentation, cluster_report


def run_report(seg: Segmentation) -> dict[str, DataFrame]:
    """A: k-table with the selected k; B/C: profiles of both models with top country;
    D: ARI/NMI/silhouette per model; E: k-means purity; F: feature inventory;
    sizes per model including empty clusters."""
    spark = seg.labelled.sparkSession
    models = {"kmeans": "kmeans_cluster"}
    if "agglomerative_cluster" in seg.labelled.columns:
        models["agglomerative"] = "agglomerative_cluster"
    sil, metric = silhouettes(seg.labelled.select(KEY, "features", *models.values()), "features", list(models.values()), KEY,
                              "exact" if seg.k_table[0][4] == "euclidean" else "squared")
    sil_df = spark.createDataFrame([(m, float(sil[c]), metric) for m, c in models.items()],
                                   "model string, silhouette double, silhouette_metric string")
    validation = (model_comparison(seg.labelled, LABEL, models)
                  .join(sil_df.withColumn("silhouette", fixed_round("silhouette", 6)), "model"))
    out = {
        "k_table": seg.k_table_frame(spark),
        "profile_kmeans": cluster_report(seg, "kmeans_cluster"),
        "validation": validation,
        "purity_kmeans": purity(seg.labelled, "kmeans_cluster", LABEL),
        "features": seg.features.inventory(spark),
        "sizes_kmeans": cluster_sizes(seg.labelled, "kmeans_cluster", seg.k),
    }
    if "agglomerative" in models:
        out["profile_agglomerative"] = cluster_report(seg, "agglomerative_cluster")
        out["sizes_agglomerative"] = cluster_sizes(seg.labelled, "agglomerative_cluster", seg.k)
        out["linkage"] = seg.ward.linkage_frame(spark)
    out["decision"] = spark.createDataFrame([tuple(seg.decision[c] for c in
                                                   ("k", "winner", "runner_up", "gap", "elbow_k", "decision"))],
                                            "k int, winner int, runner_up int, gap double, elbow_k int, decision string")
    return out
