import glob
import os

import numpy as np
import pytest

from segkit.operators.kmeans import KMeansRun
from segkit.sources import artifacts as A


def run(value):
    return KMeansRun(2, 0, np.array([[value, 0.0], [0.0, 1.0]]), float(value), 3, [5, 4], True)


def test_a_cut_off_save_leaves_the_version_before(spark, tmp_path, monkeypatch):
    path = str(tmp_path / "m")
    assert A.load_models(spark, path) == {}
    A.save_models(spark, path, kmeans=run(1.0), imputer_fills={"a": "x"})
    A.save_models(spark, path, kmeans=run(2.0))
    loaded = A.load_models(spark, path)
    assert loaded["kmeans"].cost == 2.0 and "imputer" not in loaded

    def cut(*_):
        raise RuntimeError("lost")
    for step in ("_checksum", "_publish"):
        with monkeypatch.context() as m:
            m.setattr(A, step, cut)
            with pytest.raises(RuntimeError):
                A.save_models(spark, path, kmeans=run(3.0))
        assert A.load_models(spark, path)["kmeans"].centers[0, 0] == 2.0
    A.save_models(spark, path, kmeans=run(4.0))
    assert A.load_models(spark, path)["kmeans"].cost == 4.0
    assert len(os.listdir(f"{path}/versions")) == 5


def test_a_damaged_artefact_is_told(spark, tmp_path):
    path = str(tmp_path / "m")
    A.save_models(spark, path, kmeans=run(1.0))
    folder = glob.glob(f"{path}/versions/*/kmeans/centers")[0]
    spark.createDataFrame([(0, [9.0, 9.0])], "cluster int, center array<double>").write.mode("append").parquet(folder)
    with pytest.raises(A.DamagedArtefact, match="kmeans/centers"):
        A.load_models(spark, path)
