"""Session defaults and the shared checkpoint folder.

The library never creates its own session on a cluster; it only reads settings
from the one it is given.  ``local_session`` is for tests, benches and notebooks.
"""

from __future__ import annotations

import os
import tempfile

from pyspark.sql import SparkSession

CHECKPOINT_CONF = "spark.checkpoint.dir"


def local_session(cores: int | str = "*", shuffle_partitions: int | None = None,
                  app: str = "segkit", extra: dict | None = None) -> SparkSession:
    """A local session with the settings the library assumes (UTC, ANSI, AQE, no UI)."""
    parts = shuffle_partitions or (8 if cores == "*" else int(cores))
    builder = (
        SparkSession.builder.master(f"local[{cores}]").appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.shuffle.partitions", str(parts))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .config("spark.driver.memory", os.environ.get("SEGKIT_DRIVER_MEMORY", "16g"))
    )
    for k, v in (extra or {}).items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    ship_package(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the shared checkpoint folder named by ``spark.checkpoint.dir``.

    On a cluster this setting must point at shared storage and is only read.
    Only a local-mode session without the setting gets a private scratch folder.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    configured = spark.conf.get(CHECKPOINT_CONF, None) or sc.getConf().get(CHECKPOINT_CONF, None)
    if configured:
        sc.setCheckpointDir(configured)
        return sc.getCheckpointDir()
    if not sc.master.startswith("local"):
        raise RuntimeError(
            f"{CHECKPOINT_CONF} is not set; point it at a shared folder (HDFS/S3/ABFS) "
            "so that lineage cuts survive lost executors")
    path = tempfile.mkdtemp(prefix="segkit-ckpt-")
    spark.conf.set(CHECKPOINT_CONF, path)
    sc.setCheckpointDir(path)
    return sc.getCheckpointDir()


def scratch_path(spark: SparkSession, name: str) -> str:
    """A unique sub-folder of the shared checkpoint folder for written tables."""
    import uuid

    base = ensure_checkpoint_dir(spark).rstrip("/")
    return f"{base}/segkit-{name}-{uuid.uuid4().hex[:12]}"


def ship_package(spark: SparkSession) -> None:
    """Make ``segkit`` importable in executor Python workers (like ``--py-files``).

    Task closures refer to functions of this package by module name, so workers
    must be able to import it.  The package is zipped once per session and added
    with ``SparkContext.addPyFile``; Spark distributes it to every executor.
    """
    import zipfile

    sc = spark.sparkContext
    if getattr(sc, "_segkit_shipped", False):
        return
    pkg_dir = os.path.dirname(os.path.abspath(__file__))
    root = os.path.dirname(pkg_dir)
    path = os.path.join(tempfile.mkdtemp(prefix="segkit-pyfiles-"), "segkit.zip")
    with zipfile.ZipFile(path, "w", zipfile.ZIP_DEFLATED) as z:
        for folder, _dirs, files in os.walk(pkg_dir):
            for f in files:
                if f.endswith(".py"):
                    full = os.path.join(folder, f)
                    z.write(full, os.path.relpath(full, root))
    sc.addPyFile(path)
    sc._segkit_shipped = True
