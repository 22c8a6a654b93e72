from segkit.llm import winnowing as W
from tests.conftest import SF_MID
from tests.llm import brute


def _check(docs, items):
    got = sorted(map(tuple, W.digest(docs, items).collect()), key=str)
    want = brute.contamination([(r["doc_id"], r["text"]) for r in docs.collect()], [(r["item_id"], r["text"]) for r in items.collect()])
    assert got == sorted(want, key=str)
    bad = {r[0] for r in want if r[5]}
    kept = W.clean_documents(docs, items)
    assert kept.columns == docs.columns
    assert not bad & {r["doc_id"] for r in kept.collect()} and kept.count() == docs.count() - sum(r[5] for r in want)


def test_documents_match_brute_force(spark):
    _check(spark.read.parquet(f"{SF_MID}/documents.parquet"), spark.read.parquet(f"{SF_MID}/benchmark.parquet"))


def test_short_items_ties_and_awkward_rows(spark):
    items = spark.createDataFrame([(1, "a b c"), (2, "One!"), (3, None), (4, "..."), (5, "x " * 40), (6, " ".join(f"w{i}" for i in range(90, 130))),
                                   (7, "w1 w2 w3 w4 w5 w6 w7 w8 w9 w10 w11 w12"), (None, "x y z"), (8, "q Été")], "item_id long, text string")
    docs = brute.awkward_documents(spark).unionByName(spark.createDataFrame(
        [(20, "x " * 13), (21, "x " * 12), (22, "y " + "X, x " * 30 + "z"), (23, " ".join(f"w{i}" for i in range(100, 112)) + " q"),
         (24, "q " * 300 + " ".join(f"w{i}" for i in range(95, 108)))], "doc_id long, text string"), allowMissingColumns=True)
    _check(docs, items)


def test_empty_tables(spark):
    docs, items = brute.awkward_documents(spark), spark.createDataFrame([], "item_id long, text string")
    assert not any(r["contaminated"] for r in W.digest(docs, items).collect())
    assert W.digest(docs.limit(0), spark.createDataFrame([(1, "a b")], "item_id long, text string")).collect() == []
