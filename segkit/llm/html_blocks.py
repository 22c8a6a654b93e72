"""Main text of web pages: a recurrent labeller over the sequence of text blocks.

* A page becomes its leaf blocks: runs of text between block-level tags, with character references decoded, white space
  joined, and the path of open elements.  Scripts, styles, titles and text areas (which run to their end tag), comments, the head, and
  hidden elements that have an end tag (templates, frames, drawings and so on) are not text.  A head ends where its end tag is left
  out as in browsers, at the first element or text that cannot stand in it; the start tag of a hidden element without an end tag counts for nothing.
* A block's vector holds its path (elements, classes, ids and roles, hashed with signs), its words (hashed), and its length,
  share of linked text and place.  A bidirectional LSTM (numpy) reads the page's blocks in order, so that each block is
  judged in the context of the whole page, and keeps or drops it.
* Learning is on the driver, from ``pages`` sampled pages (a documented bound; drawn by a hash of id and url).  Blocks of a
  sampled page are labelled by its own markup where that tells them (an article or main element, and what names itself a menu, an
  advert and so on).  Each sampled page is also used in ``variants`` altered copies: the article's element takes other names
  or none, and blocks of furniture of many kinds, made of the page's own words, are put around and inside it.

Null and empty pages, and pages without kept blocks, have the empty text; repeated rows come out once each; extra columns are
ignored; an empty table gives an empty result; where no sampled page tells its article, labels come from the altered copies of
pages made of their text.  Pages of any length are read whole.
"""

from __future__ import annotations

import html
import re
import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from segkit.llm.tokens import WordHasher, slices, space_words

SAMPLE, VARIANTS = 300, 4
PATHS, WORDS, HIDDEN = 96, 32, 16
WIDTH = PATHS + WORDS + 8
TAG = re.compile(r"""<!--.*?(?:-->|\Z)|<(/?)([a-zA-Z][^\s/>]*+)((?:[^>"']|"[^"]*+"|'[^']*+')*+)>|<(/?)([a-zA-Z][^\s/>]*+)([^>]*+)>|<[!?/][^>]*+>""", re.S)
NAMES = re.compile(r"""\b(class|id|role|itemprop)\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+))""", re.I)
INLINE = frozenset("a abbr acronym b bdi bdo big cite code data del dfn em font i img ins kbd mark nobr q rp rt ruby s samp small span strike strong "
                   "sub sup time tt u var wbr br label object canvas "
                   "math semantics mi mn mo ms mtext mspace mrow mfrac msqrt mroot mstyle merror mpadded mphantom menclose msub msup msubsup munder mover "
                   "munderover mmultiscripts mprescripts none mtable mtr mtd".split())
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style title textarea".split())
UNSEEN = frozenset("template noscript iframe svg select annotation annotation-xml".split())
IN_HEAD = frozenset("base basefont bgsound link meta title noscript noframes style script template head".split())
CLOSES = {"li": ("li",), "dt": ("dt", "dd"), "dd": ("dt", "dd"), "tr": ("tr", "td", "th"), "td": ("td", "th"), "th": ("td", "th"), "option": ("option",)}
CONTENT = frozenset("article main".split())
FURNITURE_TAGS = frozenset("nav header footer aside form button dialog menu fieldset".split())
FURNITURE_WORDS = frozenset("""ad ads advert advertisement advertising sponsor sponsored promo banner nav navbar navigation menu breadcrumb breadcrumbs sidebar
side widget related recommended share social comment comments respond reply replies disqus cookie cookies consent notice alert popup modal newsletter
subscribe signup login search footer header masthead copyright legal pagination pager toolbar byline tags""".split())


class Block:
    __slots__ = ("text", "path", "linked")

    def __init__(self, text: str, path: tuple[str, ...], linked: int):
        self.text, self.path, self.linked = text, path, linked


def _names(attributes: str) -> list[str]:
    return [w for m in NAMES.finditer(attributes) for w in re.split(r"[^a-z]+", (m[2] or m[3] or m[4] or "").lower()) if w]


def _raw_end(page: str, name: str, at: int) -> int | None:
    """Where the end tag of a raw text element ends."""
    end = re.compile(rf"</{re.escape(name)}[^>]*>", re.I).search(page, at)
    return end.end() if end else None


def _hidden_ends(page: str) -> dict[int, int]:
    """Where hidden elements end, by the end of their start tags; an end tag belongs to the last open start tag of its name."""
    started: dict[str, list[int]] = {}
    ends: dict[int, int] = {}
    endless: set[str] = set()
    at = 0
    while (m := TAG.search(page, at)) is not None:
        at = m.end()
        name = (m[2] or m[5] or "").lower()
        if m[1] or m[4]:
            if started.get(name):
                ends[started[name].pop()] = at
        elif m[0].endswith("/>"):
            continue
        elif name in UNSEEN:
            started.setdefault(name, []).append(at)
        elif name in RAW and name not in endless:
            end = _raw_end(page, name, at)
            if end is None:
                endless.add(name)
            else:
                at = end
    return ends


def blocks(page: str | None) -> list[Block]:
    """Leaf blocks of a page in order; a path entry is an element and the words of its names, joined by dots."""
    page = page or ""
    out: list[Block] = []
    stack: list[tuple[str, str]] = []
    text: list[str] = []
    linked = at = 0
    hidden_ends: dict[int, int] | None = None

    def flush():
        nonlocal linked
        if text:
            joined = " ".join(html.unescape("".join(text)).split())
            if joined:
                out.append(Block(joined, tuple(e for _, e in stack), linked))
            text.clear()
        linked = 0

    def close_to(i: int):
        if any(t not in INLINE for t, _ in stack[i:]):
            flush()
        del stack[i:]

    def add(piece: str):
        nonlocal linked
        if piece:
            if stack and stack[-1][0] == "head" and piece.strip():
                close_to(len(stack) - 1)
            text.append(piece)
            if any(t == "a" for t, _ in stack):
                linked += len(piece)

    while at < len(page):
        m = TAG.search(page, at)
        if m is None:
            add(page[at:])
            break
        add(page[at:m.start()])
        at = m.end()
        name = (m[2] or m[5] or "").lower()
        if not name:
            continue
        if m[1] or m[4]:
            i = next((i for i in range(len(stack) - 1, -1, -1) if stack[i][0] == name), None)
            if i is not None:
                close_to(i)
            elif name not in INLINE:
                flush()
            continue
        if name not in IN_HEAD:
            i = next((i for i in range(len(stack) - 1, -1, -1) if stack[i][0] == "head"), None)
            if i is not None:
                close_to(i)
        if name in RAW:
            if not m[0].endswith("/>"):
                at = _raw_end(page, name, at) or len(page)
            continue
        if name in UNSEEN:
            if not m[0].endswith("/>"):
                if hidden_ends is None:
                    hidden_ends = _hidden_ends(page)
                at = hidden_ends.get(at, at)
            continue
        if name in INLINE or name == "hr":
            if name in ("br", "hr"):
                text.append(" ")
                if name == "hr":
                    flush()
        else:
            flush()
            p = next((i for i in range(len(stack) - 1, -1, -1) if stack[i][0] == "p"), None)
            if p is not None:
                close_to(p)
            for shut in CLOSES.get(name, ()):
                i = next((i for i in range(len(stack) - 1, max(-1, len(stack) - 4), -1) if stack[i][0] == shut), None)
                if i is not None:
                    close_to(i)
        if name not in VOID:
            stack.append((name, ".".join([name, *_names(m[3] or m[6] or "")])))
    flush()
    return [b for b in out if not any(e.split(".", 1)[0] == "head" for e in b.path)]


def told(block: Block) -> int | None:
    """1 or 0 where the markup tells the article from furniture, else None."""
    parts = [e.split(".") for e in block.path]
    if any(p[0] in FURNITURE_TAGS or FURNITURE_WORDS & set(p[1:]) for p in parts):
        return 0
    return 1 if any(p[0] in CONTENT for p in parts) else None


def _slot(part: str, width: int) -> tuple[int, float]:
    h = zlib.crc32(part.encode("utf-8", "replace"))
    return h % width, 1.0 if h >> 16 & 1 else -1.0


class Vectors:
    def __init__(self):
        self.hasher, self.parts = WordHasher(space_words()), {}

    def _path(self, path: tuple[str, ...]) -> np.ndarray:
        got = self.parts.get(path)
        if got is None:
            if len(self.parts) > 50_000:
                self.parts.clear()
            got = np.zeros(PATHS, np.float32)
            for depth, entry in enumerate(reversed(path)):
                names = entry.split(".")
                for part in [("e:" if names[0] not in INLINE else "i:") + names[0], *("n:" + n for n in names[1:])] + (["l:" + names[0]] if depth == 0 else []):
                    i, sign = _slot(part, PATHS)
                    got[i] += sign
            self.parts[path] = got
        return got

    def of(self, pages: list[list[Block]]) -> list[np.ndarray]:
        """One matrix per page, one row per block."""
        every = [b for p in pages for b in p]
        if not every:
            return [np.zeros((0, WIDTH), np.float32) for _ in pages]
        out = np.zeros((len(every), WIDTH), np.float32)
        out[:, :PATHS] = np.stack([self._path(b.path) for b in every])
        h, offsets, *_ = self.hasher.words_of(pa.array([b.text for b in every], pa.large_string()))
        row = np.repeat(np.arange(len(every)), np.diff(offsets))
        np.add.at(out, (row, PATHS + (h % np.uint64(WORDS)).astype(np.int64)), np.where(h >> np.uint64(40) & np.uint64(1), 1.0, -1.0).astype(np.float32))
        n = np.maximum(np.diff(offsets), 1)
        out[:, PATHS:PATHS + WORDS] /= np.sqrt(n)[:, None]
        chars = np.array([len(b.text) for b in every])
        tail = out[:, PATHS + WORDS:]
        tail[:, 0] = np.log1p(n) / 4
        tail[:, 1] = np.minimum(np.array([b.linked for b in every]) / np.maximum(chars, 1), 1.0)
        tail[:, 2] = np.array([b.text[-1] in ".!?" for b in every])
        size = np.array([len(p) for p in pages])
        place = np.concatenate([np.arange(s) for s in size])
        tail[:, 3] = (place + 0.5) / np.repeat(size, size)
        tail[:, 4] = 1 / (1 + place)
        tail[:, 5] = 1 / (1 + np.repeat(size, size) - 1 - place)
        tail[:, 6] = n <= 4
        tail[:, 7] = 1
        return np.split(out, np.cumsum(size)[:-1])


def _sigmoid(x):
    return 1 / (1 + np.exp(-np.clip(x, -30, 30)))


def _pad(pages: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    long = max(len(p) for p in pages)
    x, mask = np.zeros((long, len(pages), WIDTH), np.float32), np.zeros((long, len(pages)), np.float32)
    for i, p in enumerate(pages):
        x[:len(p), i], mask[:len(p), i] = p, 1
    return x, mask


class Labeller:
    """Bidirectional LSTM and a logistic output, on padded batches (step, page, ...)."""

    def __init__(self, weights: dict[str, np.ndarray] | None = None, seed: int = 5):
        if weights is None:
            rng = np.random.default_rng(seed)
            weights = {}
            for d in "fb":
                weights["W" + d] = (rng.standard_normal((WIDTH, 4 * HIDDEN)) / np.sqrt(WIDTH)).astype(np.float32)
                weights["U" + d] = (rng.standard_normal((HIDDEN, 4 * HIDDEN)) / np.sqrt(HIDDEN)).astype(np.float32)
                weights["c" + d] = np.concatenate([np.zeros(HIDDEN), np.ones(HIDDEN), np.zeros(2 * HIDDEN)]).astype(np.float32)
            weights |= {"o": (rng.standard_normal(2 * HIDDEN + WIDTH) * 0.05).astype(np.float32), "ob": np.zeros(1, np.float32)}
        self.w = weights

    def _run(self, x, mask, d):
        steps = range(len(x)) if d == "f" else range(len(x) - 1, -1, -1)
        h, c = np.zeros((x.shape[1], HIDDEN), np.float32), np.zeros((x.shape[1], HIDDEN), np.float32)
        xw = x @ self.w["W" + d] + self.w["c" + d]
        hs, kept = np.zeros((len(x), x.shape[1], HIDDEN), np.float32), [None] * len(x)
        for t in steps:
            z = xw[t] + h @ self.w["U" + d]
            i, f, o, g = _sigmoid(z[:, :HIDDEN]), _sigmoid(z[:, HIDDEN:2 * HIDDEN]), _sigmoid(z[:, 2 * HIDDEN:3 * HIDDEN]), np.tanh(z[:, 3 * HIDDEN:])
            m = mask[t][:, None]
            new = f * c + i * g
            kept[t] = (i, f, o, g, c, np.tanh(new), h, m)
            c, h = m * new + (1 - m) * c, m * o * np.tanh(new) + (1 - m) * h
            hs[t] = h
        return hs, kept

    def forward(self, x, mask):
        self.f, self.kf = self._run(x, mask, "f")
        self.b, self.kb = self._run(x, mask, "b")
        return _sigmoid(np.concatenate([self.f, self.b, x], axis=2) @ self.w["o"] + self.w["ob"])

    def _back(self, x, grad, kept, d, g):
        steps = range(len(x) - 1, -1, -1) if d == "f" else range(len(x))
        dh, dc = np.zeros_like(grad[0]), np.zeros_like(grad[0])
        dz_all = np.zeros((len(x), x.shape[1], 4 * HIDDEN), np.float32)
        for t in steps:
            i, f, o, c_in, c_old, th, h_old, m = kept[t]
            total = dh + grad[t]
            live = total * m
            dnew = (live * o * (1 - th * th) + dc * m)
            dz = np.concatenate([dnew * c_in * i * (1 - i), dnew * c_old * f * (1 - f), live * th * o * (1 - o), dnew * i * (1 - c_in * c_in)], axis=1)
            dz_all[t] = dz
            g["U" + d] += h_old.T @ dz
            dc = dnew * f + dc * (1 - m)
            dh = dz @ self.w["U" + d].T + total * (1 - m)
        g["W" + d] += np.tensordot(x, dz_all, ([0, 1], [0, 1]))
        g["c" + d] += dz_all.sum(axis=(0, 1))

    def gradients(self, x, mask, y):
        p = self.forward(x, mask)
        err = (p - y) * mask / mask.sum()
        g = {k: np.zeros_like(v) for k, v in self.w.items()}
        feats = np.concatenate([self.f, self.b, x], axis=2)
        g["o"], g["ob"] = np.tensordot(err, feats, ([0, 1], [0, 1])), np.array([err.sum()], np.float32)
        back = err[:, :, None] * self.w["o"][None, None]
        self._back(x, back[:, :, :HIDDEN], self.kf, "f", g)
        self._back(x, back[:, :, HIDDEN:2 * HIDDEN], self.kb, "b", g)
        return g

    def train(self, pages, labels, epochs: int = 12, batch: int = 32, rate: float = 0.01, seed: int = 6):
        rng = np.random.default_rng(seed)
        m = {k: np.zeros_like(v) for k, v in self.w.items()}
        v2 = {k: np.zeros_like(v) for k, v in self.w.items()}
        step = 0
        for _ in range(epochs):
            order = np.array(sorted(rng.permutation(len(pages)), key=lambda i: len(pages[i]) // 8))
            for at in rng.permutation(np.arange(0, len(order), batch)):
                rows = order[at:at + batch]
                x, mask = _pad([pages[i] for i in rows])
                y = np.zeros(mask.shape, np.float32)
                for j, i in enumerate(rows):
                    y[:len(labels[i]), j] = labels[i]
                g = self.gradients(x, mask, y)
                norm = np.sqrt(sum(float((a * a).sum()) for a in g.values()))
                step += 1
                for k in self.w:
                    a = g[k] * min(1.0, 1.0 / (norm + 1e-9)) + 1e-5 * self.w[k]
                    m[k] = 0.9 * m[k] + 0.1 * a
                    v2[k] = 0.999 * v2[k] + 0.001 * a * a
                    self.w[k] = (self.w[k] - rate * (m[k] / (1 - 0.9**step)) / (np.sqrt(v2[k] / (1 - 0.999**step)) + 1e-8)).astype(np.float32)
        return self

    def keep(self, pages: list[np.ndarray], cells: int = 30_000) -> list[np.ndarray]:
        """Which blocks stay, per page; pages of like length share a batch of bounded cells."""
        out = [np.zeros(len(p), bool) for p in pages]
        order = sorted((i for i in range(len(pages)) if len(pages[i])), key=lambda i: len(pages[i]))
        while order:
            take = max(1, min(len(order), cells // len(pages[order[-1]])))
            rows, order = order[-take:], order[:-take]
            x, mask = _pad([pages[i] for i in rows])
            p = self.forward(x, mask)
            for j, i in enumerate(rows):
                out[i] = p[:len(pages[i]), j] >= 0.5
        return out


#: How altered copies of sampled pages may name the parts: (opening tag, whether it is the article).
SHELLS = ['<article>', '<main>', '<div class="content">', '<div id="content">', '<section class="post">', '<div class="article-body">', '<div class="entry-content">',
          '<div class="story">', '<div>', '<div id="main">', '<div role="main">', '<section>', '<td>', '<div class="text">']
BEFORE = ['<nav>', '<header>', '<div class="menu">', '<ul class="nav">', '<div id="header">', '<div class="cookie-notice">', '<div class="banner">', '<div class="ad">',
          '<div class="breadcrumb">', '<div role="navigation">', '<form>', '<form class="search">', '<div class="alert">', '<div id="nav">', '<div role="banner">', '<div class="notice">', '<div class="topbar">']
AFTER = ['<footer>', '<aside>', '<div class="sidebar">', '<div id="sidebar">', '<div class="comments">', '<section id="comments">', '<div class="related">', '<div class="share">',
         '<form class="newsletter">', '<div id="footer">', '<div class="copyright">', '<div class="comment">', '<div class="ads">', '<div class="pagination">', '<div role="contentinfo">',
         '<section class="comments">', '<ol class="commentlist">', '<div class="advertisement">', '<div class="widget">', '<div class="cookie-banner">', '<div role="complementary">', '<div class="sponsored">']
INSIDE = ['<div class="ad">', '<aside>', '<div class="share">', '<div class="related">', '<form>', '<nav>', '<div class="advert">', '<div class="newsletter">', '<div class="notice">', '<footer>', '<header>',
          '<div class="promo">', '<div class="comments">', '<section class="comments">', '<div id="comments">', '<div class="sidebar">']


def _close(tag: str) -> str:
    return f"</{re.match('<([a-z0-9]+)', tag)[1]}>"


def altered(article: list[str], rng: np.random.Generator) -> tuple[str, list[int]]:
    """A page made of an article's block texts and invented furniture, and the label of each of its blocks."""
    words = " ".join(article).split()
    pick = lambda n: " ".join(words[i] for i in rng.integers(0, len(words), n))
    esc = html.escape
    page, labels = ["<html><body>"], []

    def furniture(tag):
        kind = rng.integers(0, 4)
        parts = []
        if tag.startswith(("<ul", "<ol")) or kind == 0:
            n = int(rng.integers(1, 7))
            parts = [f'<li><a href="#">{esc(pick(int(rng.integers(1, 4))))}</a></li>' for _ in range(n)]
            parts = ["<ul>", *parts, "</ul>"] if not tag.startswith(("<ul", "<ol")) else parts
        elif kind == 1:
            n = 1
            parts = [esc(pick(int(rng.integers(2, 15))))]
        else:
            n = int(rng.integers(1, 5))
            inner = "h3" if kind == 2 and rng.random() < 0.3 else "p"
            parts = [f"<{inner}>{esc(pick(int(rng.integers(3, 40))))}</{inner}>" for _ in range(n)]
        page.extend([tag, *parts, _close(tag)])
        labels.extend([0] * n)

    if rng.random() < 0.5:
        page.append('<div class="wrapper">')
    for _ in range(rng.integers(0, 4)):
        furniture(BEFORE[rng.integers(len(BEFORE))])
    shell = SHELLS[rng.integers(len(SHELLS))]
    page.append(shell)
    head = rng.random() < 0.8
    late = rng.random() < 0.4
    for i, text in enumerate(article):
        tag = "h1" if i == 0 and head else ("h2" if rng.random() < 0.05 else ("li" if rng.random() < 0.03 else ("blockquote" if rng.random() < 0.03 else "p")))
        if rng.random() < 0.05:
            text = pick(int(rng.integers(1, 5)))
        page.append(f"<{tag}>{esc(text)}</{tag}>")
        labels.append(1)
        if i and rng.random() < 0.08:
            furniture(INSIDE[rng.integers(len(INSIDE))])
    if late:
        furniture(INSIDE[rng.integers(len(INSIDE))])
    page.append(_close(shell))
    for _ in range(rng.integers(0, 5)):
        furniture(AFTER[rng.integers(len(AFTER))])
    page.append("</body></html>")
    return "".join(page), labels


def fit(pages: DataFrame, sample: int = SAMPLE, variants: int = VARIANTS, seed: int = 5) -> dict[str, np.ndarray]:
    """Weights learned from ``sample`` pages (html)."""
    draw = F.xxhash64("page_id", "url")
    # about twice the sample passes the draw, so that what tasks send for the exact cut doesn't grow with their number
    share = min(1.0, 2 * sample / max(pages.count(), 1))
    drawn = [r["html"] for r in pages.where(F.pmod(draw, F.lit(2**40)) <= int(share * 2**40)).where("length(html) > 0")
             .orderBy(draw, "page_id").select("html").limit(sample).collect()]
    rng, vectors = np.random.default_rng(seed), Vectors()
    found, labels = [], []
    for page in drawn:
        own = blocks(page)
        known = [told(b) for b in own]
        if 1 in known:
            found.append(own)
            labels.append([k or 0 for k in known])
        article = [b.text for b, k in zip(own, known) if k == 1] or [b.text for b in own if k_free(b)]
        if article:
            for _ in range(variants):
                text, y = altered(article, rng)
                made = blocks(text)
                if len(made) == len(y):
                    found.append(made)
                    labels.append(y)
    model = Labeller(seed=seed)
    if found:
        model.train(vectors.of(found), labels)
    return model.w


def k_free(block: Block) -> bool:
    """Not told to be furniture."""
    return told(block) != 0


def extract(pages: DataFrame, weights: dict[str, np.ndarray]) -> DataFrame:
    """(page_id, url, text, n_chars) of every page."""
    def run(batches):
        model, vectors = Labeller(weights), Vectors()
        for batch in batches:
            for part in slices(batch, "html", 2 << 20):
                found = [blocks(p) for p in part.column("html").to_pylist()]
                kept = model.keep(vectors.of(found))
                texts = ["\n".join(b.text for b, k in zip(bs, ks) if k) for bs, ks in zip(found, kept)]
                yield pa.RecordBatch.from_arrays([part.column("page_id"), part.column("url"), pa.array(texts, pa.string()), pa.array([len(t) for t in texts], pa.int64())],
                                                 names=["page_id", "url", "text", "n_chars"])
    return pages.select("page_id", "url", "html").mapInArrow(run, f"page_id {dict(pages.dtypes)['page_id']}, url string, text string, n_chars long")


def digest(pages: DataFrame) -> DataFrame:
    """One row per page: its main text."""
    return extract(pages, fit(pages))
