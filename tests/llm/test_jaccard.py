import random

from segkit.llm.jaccard_rtree import first_documents, similar_components
from tests.conftest import SF_MID
from tests.llm import brute


def _check(df):
    got = sorted(map(tuple, similar_components(df).drop("mark").collect()), key=str)
    rows = [(r["doc_id"], r["text"]) for r in df.select("doc_id", "text").collect()]
    assert got == sorted(brute.jaccard_components(rows), key=str)


def test_documents_match_brute_force(spark):
    _check(spark.read.parquet(f"{SF_MID}/documents.parquet"))


def test_awkward_rows(spark):
    _check(brute.awkward_documents(spark))


def test_near_copies_of_one_text(spark, monkeypatch):
    import segkit.llm.jaccard_rtree as J
    monkeypatch.setattr(J, "CHUNK_ROWS", 40)  # several chunks in one candidate group
    rng = random.Random(3)
    rows = []
    for i in range(400):
        w = [f"t{j}" for j in range(rng.choice([30, 120, 150]))]
        for _ in range(rng.randrange(0, 7)):
            w[rng.randrange(len(w))] = f"e{rng.randrange(50)}"
        rows.append((i, " ".join(w)))
    _check(spark.createDataFrame(rows, "doc_id long, text string"))


def test_one_document_of_each_group_stays(spark):
    docs = brute.awkward_documents(spark)
    kept = first_documents(docs)
    assert kept.columns == docs.columns
    assert sorted((r["doc_id"] for r in kept.collect()), key=str) == sorted([1, 2, 3, 4, 5, 7, 9], key=str)


def test_empty_table(spark):
    assert similar_components(spark.createDataFrame([], "doc_id long, text string")).collect() == []
