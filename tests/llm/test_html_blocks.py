import html
import re

import numpy as np
import pytest

from segkit.llm import html_blocks as H
from tests.conftest import SF_MID


def plain(page):
    """The article of the given pages, whose markup is known: blocks between p, h1 and br tags."""
    inner = re.search(r"<article>(.*)</article>", page or "", re.S)
    parts = re.split(r"<p>|</p>|</?h1>", inner[1]) if inner else []
    texts = [" ".join(html.unescape(re.sub(r"<[^<>]*>", " ", p)).split()) for p in parts]
    return "\n".join(t for t in texts if t)


@pytest.fixture(scope="module")
def weights(spark):
    return H.fit(spark.read.parquet(f"{SF_MID}/pages.parquet"))


def test_articles_come_out_whole(spark, weights):
    pages = spark.read.parquet(f"{SF_MID}/pages.parquet")
    got = {r["page_id"]: r for r in H.extract(pages, weights).collect()}
    want = {r["page_id"]: plain(r["html"]) for r in pages.collect()}
    assert sum(got[i]["text"] == want[i] for i in want) >= 0.99 * len(want)
    assert all(r["n_chars"] == len(r["text"]) for r in got.values())


def test_altered_pages(spark, weights):
    rng, right, total = np.random.default_rng(99), 0, 0
    pages = [r["html"] for r in spark.read.parquet("/root/testdata/sf0.1/pages.parquet").where("page_id >= 2000").limit(200).collect()]
    model, vectors = H.Labeller(weights), H.Vectors()
    for page in pages:
        text, y = H.altered(plain(page).split("\n"), rng)
        made = H.blocks(text)
        kept = model.keep(vectors.of([made]))[0]
        assert len(made) == len(y)
        right += (kept == np.array(y, bool)).sum()
        total += len(y)
    assert right > 0.97 * total, right / total


def test_blocks():
    page = ("<!DOCTYPE html><title>t</title><script>var a='<p>no</p>';</script><body><p>One &amp; <b>two</b>\n three<p>four<br>five"
            "<ul><li>a<li><a href=x>b &lt;c&gt;</a></ul>1 < 2<!-- <p>no --><div class='Ad box'>x&nbsp;y</div><p title='a>b'>z</p><p title=\"broken>w</p>")
    got = [(b.text, b.path[-1] if b.path else "") for b in H.blocks(page)]
    assert got == [("One & two three", "p"), ("four five", "p"), ("a", "li"), ("b <c>", "li"), ("1 < 2", "body"), ("x y", "div.ad.box"), ("z", "p"), ("w", "p")]
    assert H.blocks(None) == H.blocks("") == H.blocks("<p> </p>") == []


def test_heads_without_an_end_tag():
    for start in ("<html><head><title>t</title><meta charset=x><body>", "<head><script>a<b</script><link href=x>", "<head><style>p{}</style><noscript><link></noscript><body class=x>",
                  "<head><title>t</title></head><body>", "<head><title>t</title><body></head>"):
        got = H.blocks(start + "<article><p>One<p>two</article>")
        assert [b.text for b in got] == ["One", "two"] and all(H.told(b) == 1 for b in got), start
    assert [b.text for b in H.blocks("<head><meta x>\n<title>t</title> bare text <p>two")] == ["bare text", "two"]


def test_hidden_elements():
    for name in ("noscript", "svg", "select", "iframe", "template", "math", "object", "canvas"):
        got = [b.text for b in H.blocks(f"<article><p>One</p><{name} x=y><p>two</p></article><p>three")]
        assert got == ["One", "two", "three"], name
    for name in ("noscript", "svg", "select", "iframe", "template"):
        page = f"<p>One</p><{name}>no</{name}><p>two</p><{name}><p>three</p><{name}>no<{name}>no</{name}>no</{name}><p>four"
        assert [b.text for b in H.blocks(page)] == ["One", "two", "three", "four"], name
        script = f"<p>One</p><script>'<{name}>'</script><{name}><script>'</{name}>'</script>no</{name}><{name}/><p>two"
        assert [b.text for b in H.blocks(script)] == ["One", "two"], name
    page = ("<article><p>If <math><semantics><mrow><mi>x</mi><mo>=</mo><mn>2</mn></mrow><annotation encoding=tex>x=2</annotation></semantics></math> then"
            " <object data=a>a <b>plan</b></object> and <canvas>a chart</canvas> follow</p></article>")
    assert [(b.text, b.path[-1]) for b in H.blocks(page)] == [("If x=2 then a plan and a chart follow", "p")]
    assert len(H.blocks("<svg>" * 200_000 + "<p>end")) == 1


def test_gradients_match_differences():
    rng = np.random.default_rng(0)
    pages = [rng.standard_normal((n, H.WIDTH)).astype(np.float32) for n in (3, 5)]
    x, mask = H._pad(pages)
    y = rng.integers(0, 2, mask.shape).astype(np.float32)
    model = H.Labeller(seed=1)
    model.w = {k: v.astype(np.float64) for k, v in model.w.items()}
    g = model.gradients(x.astype(np.float64), mask, y)

    def loss():
        p = model.forward(x.astype(np.float64), mask)
        return -((y * np.log(p) + (1 - y) * np.log(1 - p)) * mask).sum() / mask.sum()
    for k in model.w:
        at = np.unravel_index(np.abs(g[k]).argmax(), g[k].shape)
        kept = model.w[k][at]
        model.w[k][at] = kept + 1e-3
        up = loss()
        model.w[k][at] = kept - 1e-3
        down = loss()
        model.w[k][at] = kept
        assert (up - down) / 2e-3 == pytest.approx(g[k][at], rel=0.02), k


def test_awkward_rows(spark, weights):
    pages = spark.createDataFrame([(1, "u", None, 1), (1, "u", None, 1), (2, None, "", 2), (None, "v", "<article><p>" + "long words here. " * 20_000 + "</p></article>", 3),
                                   (3, "w", "<p>" * 3000 + "deep", 4)], "page_id long, url string, html string, text int")
    rows = H.extract(pages, weights).collect()
    assert len(rows) == 5 and rows[0]["text"] == "" and rows[0]["n_chars"] == 0
    assert H.digest(pages.limit(0)).collect() == []
