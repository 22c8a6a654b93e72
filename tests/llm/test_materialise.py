import base64

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from segkit.llm import materialise as M
from segkit.llm.store import model_folder
from tests.conftest import SF_SMALL
from tests.llm import brute


def test_permutation_and_inverse():
    for n in (1, 2, 3, 17, 1000, 65_537):
        f = M.Feistel(n, 3)
        y = f(np.arange(n))
        assert sorted(y) == list(range(n))
        assert (f.inverse(y) == np.arange(n)).all()


@pytest.fixture(scope="module")
def whole():
    import tiktoken
    with open(M.VOCABULARY, "rb") as f:
        raw = f.read()
    ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, raw.splitlines())}
    return M.Encoder(raw), tiktoken.Encoding("own", pat_str=M.PATTERN, mergeable_ranks=ranks, special_tokens={})


@settings(max_examples=200, deadline=None)
@given(st.lists(st.text(alphabet=st.sampled_from(list("ab1.,'s \n\t\r\x0b é  ß漢\x00")), max_size=40), max_size=5))
def test_chunks_encode_like_whole_texts(whole, texts):
    import pyarrow as pa
    tokens, offsets = whole[0].encode(pa.array(texts, pa.string()))
    for t, a, b in zip(texts, offsets[:-1], offsets[1:]):
        assert tokens[a:b].tolist() == [*whole[1].encode_ordinary(t), M.END]


def _round_trip(spark, docs, whole, **args):
    out, layout = M.materialise(docs, model_folder(spark, "test-shards"), **args)
    rows = sorted(out.collect(), key=lambda r: r["slot"])
    assert [r["slot"] for r in rows] == list(range(layout["sequences"]))
    got = M.read(layout, 0, layout["sequences"])
    order = M.Feistel(layout["sequences"], layout["key"])(np.arange(layout["sequences"]))
    assert [r["sequence"] for r in sorted(rows, key=lambda r: r["sequence"])] == list(range(layout["sequences"]))
    stream = got[order].ravel()[:layout["tokens"]]
    ends = np.flatnonzero(stream == M.END)
    texts = [whole[1].decode(t[:-1].tolist()) for t in np.split(stream, ends + 1)[:-1]]
    assert sorted(texts) == sorted((r["text"] or "") for r in docs.collect())
    assert (M.read(layout, 5, 3) == got[5:8]).all()


def test_round_trip(spark, whole):
    _round_trip(spark, spark.read.parquet(f"{SF_SMALL}/documents.parquet").repartition(5, "doc_id"), whole, length=64, per_shard=50)


def test_awkward_rows(spark, whole):
    docs = brute.awkward_documents(spark)
    _round_trip(spark, docs, whole, length=32, per_shard=7)
    assert M.materialise(docs.limit(0))[0].collect() == []
