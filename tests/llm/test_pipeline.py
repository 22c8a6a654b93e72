import zlib
from collections import Counter

import corpus_pipeline as P
from tests.conftest import SF_MID
from tests.llm import brute, test_mixing


def test_stages_match_plain_python(spark):
    docs = spark.read.parquet(f"{SF_MID}/documents.parquet")
    columns = docs.columns
    items = [(r["item_id"], r["text"]) for r in spark.read.parquet(f"{SF_MID}/benchmark.parquet").collect()]
    before = docs
    for (name, stage), check in zip(P.STAGES, ("language", "near", "bench", "mix", "shard"), strict=True):
        after = stage(spark, before, SF_MID).persist()
        rows, kept = before.collect(), after.collect()
        assert set(columns) <= set(after.columns) and (check == "shard" or after.columns == columns)
        ids, texts = Counter(r["doc_id"] for r in kept), {r["doc_id"]: r["text"] for r in rows}
        if check == "language":  # these documents are all in learned languages
            assert all(any(c.isalpha() for c in texts[i]) for i in ids) and len(kept) >= 0.99 * len(rows)
        if check == "near":
            want = {c for _, _, c in brute.jaccard_components([(r["doc_id"], r["text"]) for r in rows])}
            assert ids == Counter(want)
        if check == "bench":
            assert ids == Counter(r[0] for r in brute.contamination([(r["doc_id"], r["text"]) for r in rows], items) if not r[5])
        if check == "mix":
            sizes, target = test_mixing.brute_targets([(r["source"], len(brute.words(r["text"]))) for r in rows])
            got = Counter()
            for r in kept:
                got[r["source"]] += len(brute.words(r["text"]))
            longest = max(len(brute.words(t)) for t in texts.values())
            assert all(abs(got[s] - target[s]) <= 6 * 64 + longest for s in sizes) and max(ids.values()) <= 2
        if check == "shard":
            assert ids == Counter(r["doc_id"] for r in rows)
            sizes = Counter(r["shard"] for r in kept)
            assert max(sizes.values()) - min(sizes[s] for s in range(40)) <= 1
        before = after.select(*columns)


def test_run_and_empty(spark, tmp_path):
    out = P.run(spark, SF_MID)
    assert out.count() > 0 and {"shard", "slot"} <= set(out.columns)
    again = {zlib.crc32(str(r).encode()) for r in P.run(spark, SF_MID).collect()}
    assert again == {zlib.crc32(str(r).encode()) for r in out.collect()}


def test_awkward_rows(spark):
    docs = brute.awkward_documents(spark)
    for name, stage in P.STAGES:
        none = stage(spark, docs.limit(0), SF_MID)
        assert none.collect() == []
        docs = stage(spark, docs, SF_MID)
        docs.collect()
