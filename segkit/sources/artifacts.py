"""Model artefacts on shared storage (S5, S6), in versions.

A save writes a new folder ``versions/<id>`` with Spark writers (JSON text and parquet), then its manifest (the artefacts with a checksum
each), and last a small file in ``current`` that names the version.  Readers follow the newest name whose manifest is there, so they see
a whole save or the one before, never half of one, whatever moment a save is cut off.  Training metrics (cost, iterations) are saved
beside the centres because a reloaded model has no training summary.  Artefacts that were not saved are skipped; one whose content does not
fit its checksum raises.
"""

from __future__ import annotations

import hashlib
import json
import uuid

import numpy as np
from pyspark.sql import SparkSession
from pyspark.sql import functions as F
from pyspark.errors import AnalysisException

from segkit.operators.features import FeatureModel
from segkit.operators.kmeans import KMeansRun, centers_frame
from segkit.operators.ward import WardModel


def _write_json(spark: SparkSession, path: str, obj: dict) -> None:
    spark.createDataFrame([(json.dumps(obj),)], "value string").coalesce(1).write.mode("overwrite").text(path)


def _read_json(spark: SparkSession, path: str) -> dict | None:
    try:
        rows = spark.read.text(path).collect()
    except AnalysisException:
        return None
    return json.loads(rows[0][0]) if rows else None


class DamagedArtefact(ValueError):
    """An artefact does not fit its manifest."""


def _checksum(spark: SparkSession, path: str, kind: str) -> str:
    """Of the rows, whatever files they are in."""
    rows = spark.read.text(path) if kind == "json" else spark.read.parquet(path)
    n, total = rows.agg(F.count(F.lit(1)), F.sum(F.xxhash64(*sorted(rows.columns)).cast("decimal(38,0)"))).first()
    return hashlib.sha256(f"{n}:{total}".encode()).hexdigest()


def _versions(spark: SparkSession, base: str) -> list[str]:
    """Names of the versions, the newest first."""
    try:
        rows = spark.read.text(f"{base}/current").collect()  # one row a save
    except AnalysisException:
        return []
    return [v for _, v in sorted((json.loads(r[0]) for r in rows), reverse=True)]


def save_models(spark: SparkSession, path: str, features: FeatureModel | None = None,
                kmeans: KMeansRun | None = None, ward: WardModel | None = None,
                imputer_fills: dict | None = None) -> str:
    """Writes a version and makes it the current one; returns the folder of all versions."""
    root = path.rstrip("/")
    known = _versions(spark, root)
    version = uuid.uuid4().hex[:12]
    base, written = f"{root}/versions/{version}", {}

    def put_json(name, obj):
        _write_json(spark, f"{base}/{name}", obj)
        written[name] = "json"

    def put_table(name, df):
        df.write.mode("overwrite").parquet(f"{base}/{name}")
        written[name] = "parquet"

    if features is not None:
        put_json("features", json.loads(features.to_json()))
    if imputer_fills is not None:
        put_json("imputer", imputer_fills)
    if kmeans is not None:
        put_table("kmeans/centers", centers_frame(spark, kmeans.centers))
        put_json("kmeans/metrics", dict(k=kmeans.k, cost=kmeans.cost, n_iter=kmeans.n_iter, sizes=kmeans.sizes,
                                        converged=kmeans.converged, run=kmeans.run))
    if ward is not None:
        rows = [(i, [float(v) for v in c], float(s), int(m))
                for i, (c, s, m) in enumerate(zip(ward.micro_centers, ward.micro_sizes, ward.micro_to_cluster))]
        put_table("ward/micro", spark.createDataFrame(rows, "micro int, center array<double>, size double, cluster int"))
        put_table("ward/linkage", ward.linkage_frame(spark))
        put_json("ward/meta", dict(k=ward.k))
    _write_json(spark, f"{base}/manifest", {name: [kind, _checksum(spark, f"{base}/{name}", kind)] for name, kind in written.items()})
    _publish(spark, root, version, len(known))
    return root


def _publish(spark: SparkSession, root: str, version: str, turn: int) -> None:
    """The last step of a save: one more row that names its version."""
    spark.createDataFrame([(json.dumps([turn, version]),)], "value string").coalesce(1).write.mode("append").text(f"{root}/current")


def load_models(spark: SparkSession, path: str) -> dict:
    """The artefacts of the newest whole version; one that was not saved is skipped."""
    root = path.rstrip("/")
    for version in _versions(spark, root):
        base = f"{root}/versions/{version}"
        manifest = _read_json(spark, f"{base}/manifest")
        if manifest is not None:
            break
    else:
        return {}
    for name, (kind, want) in manifest.items():
        try:
            found = _checksum(spark, f"{base}/{name}", kind)
        except AnalysisException:
            found = None
        if found != want:
            raise DamagedArtefact(f"artefact '{name}' of version {version} does not fit its checksum")
    out = {}
    if "features" in manifest:
        out["features"] = FeatureModel(**_read_json(spark, f"{base}/features"))
    if "imputer" in manifest:
        out["imputer"] = _read_json(spark, f"{base}/imputer")
    if "kmeans/metrics" in manifest:
        meta = _read_json(spark, f"{base}/kmeans/metrics")
        rows = spark.read.parquet(f"{base}/kmeans/centers").orderBy("cluster").collect()
        centers = np.array([r["center"] for r in rows])
        out["kmeans"] = KMeansRun(meta["k"], meta["run"], centers, meta["cost"], meta["n_iter"],
                                  meta["sizes"], meta["converged"])
    if "ward/meta" in manifest:
        rows = spark.read.parquet(f"{base}/ward/micro").orderBy("micro").collect()
        link = [tuple(r) for r in spark.read.parquet(f"{base}/ward/linkage").orderBy("step").collect()]
        out["ward"] = WardModel(np.array([r["center"] for r in rows]), np.array([r["size"] for r in rows]),
                                link, np.array([r["cluster"] for r in rows]), _read_json(spark, f"{base}/ward/meta")["k"])
    return out
