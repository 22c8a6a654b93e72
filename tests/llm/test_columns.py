"""Stages and filters keep columns of any name and type."""

import pytest
from pyspark.sql import functions as F

import corpus_pipeline as P
from tests.conftest import SF_SMALL

ODD = ["_id", "_times", "_crc", "_both", "_part", "_one", "_row", "_mark", "_x", "_bucket", "_rank", "_copy", "score", "rejected", "lang_pred", "a b", "c.d", "e`f", "k0", "size",
       "start", "members", "cid", "u", "v", "taken", "SLOT2"]


@pytest.mark.parametrize("name, stage", P.STAGES, ids=[n for n, _ in P.STAGES])
def test_stages_keep_columns_of_any_name(spark, tmp_path, name, stage):
    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet").where("doc_id < 80")
    odd = docs.select("*", *[F.concat(F.lit(n + ":"), F.col("doc_id").cast("string")).alias(n) for n in ODD])
    odd.write.parquet(str(tmp_path / "odd"))
    odd = spark.read.parquet(str(tmp_path / "odd"))
    plain, out = stage(spark, docs, SF_SMALL), stage(spark, odd, SF_SMALL)
    assert out.columns == [*odd.columns, *(["shard", "slot"] if name == "sharding" else [])]
    rows = out.collect()
    assert rows and all(r[len(docs.columns) + i] == f"{n}:{r['doc_id']}" for r in rows for i, n in enumerate(ODD))
    assert sorted(r["doc_id"] for r in rows) == sorted(r["doc_id"] for r in plain.collect())


def test_sharding_replaces_only_its_own_columns(spark):
    from segkit.llm.shard_shuffle import shuffled_documents
    docs = spark.createDataFrame([(i % 4, "same text", i, 9, i) for i in range(50)], "doc_id long, text string, _crc int, shard int, Slot int")
    out = shuffled_documents(docs, shards=5)
    assert out.columns == ["doc_id", "text", "_crc", "shard", "slot"]
    a, b = ({r["_crc"]: (r["shard"], r["slot"]) for r in shuffled_documents(d, shards=5).collect()} for d in (docs, docs.repartition(7)))
    assert a == b and len(a) == 50 and sorted(a.values()) == [(s, k) for s in range(5) for k in range(10)]
