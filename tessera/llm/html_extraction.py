"""Main-text extraction by a recurrent block labeller.

A page is read into leaf blocks (runs of text between block tags) in page
order.  A block is described by hashed features of its tag path (tags, class
and id words of all ancestors) and of its words; a bidirectional LSTM in numpy
reads the page's whole sequence of blocks and labels each as main text or not.
The text is the main blocks in page order, joined by newlines.

Training: at most SAMPLE_PAGES pages (those with the smallest hash of their
html) are labelled by their semantic tags (inside article or main, outside
boilerplate elements).  Each is also varied: its main text moves to another
usual container and usual boilerplate (menus, sidebars, notices, forms,
comments, ...) with words of the sample is put around and inside it, so that
the labeller learns those paths whatever the words are.  A page without an
article or main has no such labels: in its place stand variations of labelled
pages (of built-in layouts where the sample has none) with their main text in
a usual container without semantic tags or in that of the page's own longest
block, between the page's blocks that are boilerplate by their tags or names.  Weights start from a
fixed seed; the model is a few hundred kB and goes to the tasks in the closure.

Defined results: null html is an empty page with an empty text; blocks of
white space only are none; character references are decoded, white space runs
inside a block are one space; an unclosed comment, script or style runs to the
end of the page; repeated pages are each read.
"""

from __future__ import annotations

import html as references
import random
import re
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import bounded_sample, slices

SAMPLE_PAGES = 300
PATH_DIM, WORD_DIM, HIDDEN = 2048, 64, 12
EPOCHS, BATCH, RATE = 16, 32, 0.02
TRAIN_BLOCKS = 200         # blocks of a sample page that the fit reads
TRAIN_WORDS = 200          # words of a block that enter the vocabulary of the fit's variations
PAGES_AT_ONCE = 64
CELLS = 1 << 15            # steps x pages labelled at once (or one longer page)

# Elements that end the block before them.
BLOCK_TAGS = frozenset("""html head title body main article section nav header footer aside div p h1 h2 h3 h4 h5 h6
ul ol li dl dt dd table caption thead tbody tfoot tr td th form fieldset legend label button select option textarea
blockquote pre figure figcaption address details summary hr noscript iframe object video audio dialog menu template
center""".split())
RAW_TAGS = frozenset(("script", "style", "template", "iframe", "noembed"))
FOREIGN_TAGS = frozenset(("svg", "math"))      # a / at the end of a tag in them closes it
VOID_TAGS = frozenset("area base br col embed hr img input link meta param source track wbr".split())
CLOSES_P = BLOCK_TAGS - {"label", "button", "option"}
# Containers that hold or surround the main text on usual pages.
MAIN_PATHS = (("article",), ("main",), ("main", "article"), ("div.content",), ("div#content",), ("div.post",),
              ("div.article",), ("div.entry-content",), ("section.article-body",), ("div#main", "div.text"),
              ("article.post", "div.body"))
BARE_PATHS = tuple(p for p in MAIN_PATHS if not {e.partition(".")[0] for e in p} & {"article", "main"}) + (
    (), ("div",), ("div", "div"), ("table", "tr", "td"), ("table", "tbody", "tr", "td"), ("center",))
SIDE_PATHS = (("nav", "ul", "li"), ("nav", "a"), ("div.menu", "ul", "li"), ("ul.nav", "li"), ("div#navigation", "p"),
              ("div.breadcrumbs", "span"), ("header", "div"), ("header", "h1"), ("header", "p"), ("div.header", "p"),
              ("div#header", "h2"), ("footer", "p"), ("footer",), ("div.footer", "p"), ("div#footer", "div"), ("aside", "p"),
              ("aside", "h3"), ("aside", "ul", "li"), ("aside.sidebar", "div"), ("div.sidebar", "p"), ("div#sidebar", "li"),
              ("div.notice", "p"), ("div.notice",), ("div.cookie-notice", "p"), ("div#cookie-banner", "button"), ("div.alert", "p"),
              ("div.banner", "p"), ("div.cookies",), ("div.popup", "p"), ("dialog", "p"), ("div.ad",), ("div.ad", "p"),
              ("div.ads", "p"), ("div.advert", "p"), ("div.advertisement",), ("div#ad", "p"), ("div.sponsored", "p"),
              ("div.promo", "p"), ("form", "label"), ("form", "button"), ("form", "p"), ("form.search", "legend"),
              ("form", "select", "option"), ("form", "textarea"), ("form", "fieldset", "legend"), ("div.newsletter", "p"), ("div.subscribe", "p"),
              ("section.comments", "p"), ("section.comments", "h2"), ("section#comments", "div.comment", "p"),
              ("div.comments", "p"), ("div#comments", "li"), ("div.comment", "p"), ("ol.commentlist", "li"),
              ("ul.comments", "li", "p"), ("div.reader-comments", "blockquote"), ("div.share", "li"), ("div.related", "li"),
              ("div.social", "p"), ("div.tags", "li"), ("noscript", "p"), ("noscript",))
SIDE_TAGS = frozenset("nav header footer aside form button select textarea dialog menu noscript head title".split())

# Attributes as HTML reads them: a quote opens a value only directly after =,
# any other quote is part of a name or of an unquoted value.
_ATTRS = r"""(?:[\s/]++|[^\s/>][^\s/>=]*+(?:\s*+=\s*+(?:"[^"]*+(?:"|\Z)|'[^']*+(?:'|\Z)|[^\s>"'][^\s>]*+)?+)?+)*+"""
_TOKEN = re.compile(r"<!--(?:-?>|.*?(?:--!?>|\Z))|<(?P<end>/?)(?P<tag>[A-Za-z][^\s/>]*)(?P<attrs>" + _ATTRS + r")(?:>|\Z)|<[!?/][^>]*(?:>|\Z)", re.S)
_ATTR = re.compile(r"\b(class|id|role)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>\"']+))", re.I)
_IN_VALUE = re.compile(r"=\s*[^\s\"'>][^\s>]*\Z")   # a / there belongs to an unquoted value
_NAME = re.compile(r"[a-z]+")


def _element(tag: str, attrs: str) -> tuple[str, ...]:
    """Path features of one element: its tag and the words of its class, id
    and role."""
    if not attrs or "=" not in attrs:
        return (tag,)
    out = [tag]
    for name, a, b, c in _ATTR.findall(attrs):
        out += [f"{name.lower()}={w}" for w in _NAME.findall((a or b or c).lower())]
    return tuple(out)


def blocks(page: str) -> list[tuple[tuple[tuple[str, ...], ...], str]]:
    """Leaf blocks (path of elements, text) of a page in order."""
    out: list = []
    stack: list[tuple[str, tuple[str, ...]]] = []
    held: list[str] = []

    def end_block() -> None:
        text = " ".join(references.unescape("".join(held)).split())
        held.clear()
        if text:
            out.append((tuple(e for _, e in stack), text))
    at = 0
    for m in iter(lambda: _TOKEN.search(page, at), None):
        if m.start() > at:
            held.append(page[at:m.start()])
        at = m.end()
        if at == m.start():
            break
        if m["tag"] is None:
            continue
        tag = m["tag"].lower()
        if m["end"]:
            if tag in BLOCK_TAGS:
                end_block()
            if any(t == tag for t, _ in stack):
                while stack.pop()[0] != tag:
                    pass
            continue
        if tag == "br":
            held.append(" ")
            continue
        if tag in BLOCK_TAGS:
            end_block()
            same = {"li": ("li",), "dt": ("dt", "dd"), "dd": ("dt", "dd"), "tr": ("tr", "td", "th"), "td": ("td", "th"),
                    "th": ("td", "th"), "option": ("option",)}.get(tag, ("p",) if tag in CLOSES_P else ())
            for k in range(len(stack) - 1, -1, -1):
                if stack[k][0] in same:
                    del stack[k:]
                    break
                if stack[k][0] in BLOCK_TAGS and stack[k][0] not in same:
                    break
        if tag in RAW_TAGS:
            close = re.compile(rf"</{tag}\s*[^>]*(?:>|\Z)", re.I).search(page, at)
            at = close.end() if close else len(page)
            continue
        attrs = m["attrs"]
        if tag in VOID_TAGS or (attrs.endswith("/") and not _IN_VALUE.search(attrs)
                                and (tag in FOREIGN_TAGS or any(t in FOREIGN_TAGS for t, _ in stack))):
            continue
        stack.append((tag, _element(tag, attrs)))
    held.append(page[at:])
    end_block()
    return out


def _path_ids(path: tuple[tuple[str, ...], ...]) -> list[int]:
    names = {f for e in path for f in e}
    names.add(f"leaf={path[-1][0]}" if path else "leaf=")
    return sorted({zlib.crc32(n.encode()) % PATH_DIM for n in names})


class Features:
    """Hashed features of blocks: ids of the path features with their offsets,
    and a matrix of word shares."""

    def __init__(self):
        self.paths: dict = {}
        self.words: dict[str, int] = {}

    def of(self, pages: list[list[tuple]]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        ids, ends, cells, counts = [], [0], [], []
        for page in pages:
            for path, text in page:
                own = self.paths.get(path)
                if own is None:
                    if len(self.paths) > 50_000:
                        self.paths.clear()
                    own = self.paths[path] = _path_ids(path)
                ids += own
                ends.append(len(ids))
                base, split = WORD_DIM * len(counts), text.split()
                counts.append(len(split))
                for w in split:
                    k = self.words.get(w)
                    if k is None:
                        if len(self.words) > 200_000:
                            self.words.clear()
                        k = self.words[w] = zlib.crc32(w.encode("utf-8", "replace")) % WORD_DIM
                    cells.append(base + k)
        words = np.bincount(np.array(cells, np.int64), minlength=WORD_DIM * len(counts)).reshape(-1, WORD_DIM)
        shares = 0.3 * words / np.maximum(1, np.array(counts))[:, None]
        return np.array(ids, np.int64), np.array(ends, np.int64), shares.astype(np.float32)


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 1.0 / (1.0 + np.exp(-np.clip(x, -30, 30)))


class Labeller:
    """Bidirectional LSTM over block sequences with a logistic output."""

    def __init__(self, seed: int = 7):
        rng = np.random.default_rng(seed)
        h = HIDDEN
        self.p = {}
        for d in "fb":
            self.p["x" + d] = rng.normal(0, 0.15, (PATH_DIM, 4 * h))
            self.p["w" + d] = rng.normal(0, 0.15, (WORD_DIM, 4 * h))
            self.p["h" + d] = rng.normal(0, 0.15, (h, 4 * h))
            bias = np.zeros(4 * h)
            bias[h:2 * h] = 1.0
            self.p["c" + d] = bias
        self.p["o"] = rng.normal(0, 0.15, 2 * h)
        self.p["s"] = np.zeros(1)
        self.p = {k: v.astype(np.float32) for k, v in self.p.items()}

    def _inputs(self, d: str, feats, place: np.ndarray, steps: int, pages: int) -> np.ndarray:
        ids, ends, shares = feats
        out = np.zeros((steps * pages, 4 * HIDDEN), np.float32)
        if len(ends) > 1:
            out[place] = np.add.reduceat(self.p["x" + d][ids], ends[:-1], axis=0) + shares @ self.p["w" + d]
        return out.reshape(steps, pages, -1)

    def forward(self, feats, lengths: np.ndarray, keep: bool = True):
        """Logits per block (flat, page after page) and, with ``keep``, what
        backward needs; without it no step's gates or cells are kept.  Every
        block has at least one feature."""
        pages, steps, h = len(lengths), int(lengths.max(initial=0)), HIDDEN
        step = np.concatenate([np.arange(n) for n in lengths]) if pages else np.zeros(0, np.int64)
        page = np.repeat(np.arange(pages), lengths)
        alive = np.arange(steps)[:, None] < lengths[None, :]
        saved, outs = {}, []
        for d in "fb":
            own = step if d == "f" else lengths[page] - 1 - step     # backward: from the last block
            place = own * pages + page
            x = self._inputs(d, feats, place, steps, pages) + self.p["c" + d]
            hs = np.zeros((steps + 1, pages, h), np.float32)
            cs = np.zeros((steps + 1 if keep else 1, pages, h), np.float32)
            gates = np.zeros((steps if keep else 1, pages, 4 * h), np.float32)
            for t in range(steps):
                z = x[t] + hs[t] @ self.p["h" + d]
                g, before = gates[t if keep else 0], cs[t if keep else 0]
                g[:, :3 * h] = _sigmoid(z[:, :3 * h])                # input, forget, output
                g[:, 3 * h:] = np.tanh(z[:, 3 * h:])
                c = g[:, h:2 * h] * before + g[:, :h] * g[:, 3 * h:]
                cs[t + 1 if keep else 0] = np.where(alive[t][:, None], c, before)
                hs[t + 1] = np.where(alive[t][:, None], g[:, 2 * h:3 * h] * np.tanh(c), hs[t])
            outs.append(hs[1:].reshape(-1, h)[place])
            if keep:
                saved[d] = (hs, cs, gates, place)
        both = np.concatenate(outs, axis=1)
        return both @ self.p["o"] + self.p["s"], (saved, both, alive)

    def gradients(self, feats, lengths, labels) -> dict[str, np.ndarray]:
        logits, (saved, both, alive) = self.forward(feats, lengths)
        d_logit = (_sigmoid(logits) - labels) / max(1, len(labels))
        grads = {"o": both.T @ d_logit, "s": np.array([d_logit.sum()])}
        ids, ends, shares = feats
        pages, steps, h = len(lengths), alive.shape[0], HIDDEN
        for k, d in enumerate("fb"):
            hs, cs, gates, place = saved[d]
            above = np.zeros((steps * pages, h), np.float32)
            above[place] = d_logit[:, None] * self.p["o"][k * h:(k + 1) * h]
            above = above.reshape(steps, pages, h)
            dz_all = np.zeros((steps, pages, 4 * h), np.float32)
            dh, dc = np.zeros((2, pages, h), np.float32)
            grads["h" + d] = np.zeros_like(self.p["h" + d])
            for t in range(steps - 1, -1, -1):
                live = alive[t][:, None]
                dh_t = (dh + above[t]) * live
                i, f, o, g = (gates[t][:, q * h:(q + 1) * h] for q in range(4))
                tc = np.tanh(cs[t + 1])
                dc_t = (dc + dh_t * o * (1 - tc * tc)) * live
                dz = np.concatenate([dc_t * g * i * (1 - i), dc_t * cs[t] * f * (1 - f), dh_t * tc * o * (1 - o),
                                     dc_t * i * (1 - g * g)], axis=1)
                dz_all[t] = dz
                grads["h" + d] += hs[t].T @ dz
                dh = np.where(live, dz @ self.p["h" + d].T, dh)
                dc = np.where(live, dc_t * f, dc)
            flat = dz_all.reshape(-1, 4 * h)[place]
            grads["c" + d] = flat.sum(axis=0)
            grads["w" + d] = shares.T @ flat
            grads["x" + d] = np.zeros_like(self.p["x" + d])
            order = np.argsort(ids, kind="stable")
            some, starts = np.unique(ids[order], return_index=True)
            spread = np.repeat(flat, np.diff(ends), axis=0)[order]
            grads["x" + d][some] = np.add.reduceat(spread, starts, axis=0)
        return grads

    def fit(self, pages: list[tuple[list, np.ndarray]], seed: int = 11) -> Labeller:
        """Adam over shuffled batches of (blocks, labels)."""
        rng, features, t = np.random.default_rng(seed), Features(), 0
        m = {k: np.zeros_like(v) for k, v in self.p.items()}
        s = {k: np.zeros_like(v) for k, v in self.p.items()}
        pages = [p for p in pages if p[0]]
        for epoch in range(EPOCHS):
            order = rng.permutation(len(pages))
            rate = RATE * (1 - epoch / EPOCHS) + 1e-3
            for a in range(0, len(order), BATCH):
                batch = [pages[i] for i in order[a:a + BATCH]]
                lengths = np.array([len(b[0]) for b in batch])
                grads = self.gradients(features.of([b[0] for b in batch]), lengths, np.concatenate([b[1] for b in batch]))
                t += 1
                for k, g in grads.items():
                    g = np.clip(g, -1, 1)
                    m[k] = 0.9 * m[k] + 0.1 * g
                    s[k] = 0.99 * s[k] + 0.01 * g * g
                    self.p[k] -= rate * (m[k] / (1 - 0.9 ** t)) / (np.sqrt(s[k] / (1 - 0.99 ** t)) + 1e-8)
        return self

    def main(self, pages: list[list], features: Features) -> list[np.ndarray]:
        """Per page, which blocks are main text."""
        out: list[np.ndarray] = [np.zeros(0, bool)] * len(pages)
        some = sorted((i for i, p in enumerate(pages) if p), key=lambda i: len(pages[i]))
        while some:
            n = 1                                   # the longest comes last and sets the steps
            while n < min(len(some), PAGES_AT_ONCE) and (n + 1) * len(pages[some[n]]) <= CELLS:
                n += 1
            own, some = some[:n], some[n:]
            lengths = np.array([len(pages[i]) for i in own])
            logits, _ = self.forward(features.of([pages[i] for i in own]), lengths, keep=False)
            for i, part in zip(own, np.split(logits > 0, np.cumsum(lengths)[:-1])):
                out[i] = part
        return out


def _parse(path: tuple[str, ...]) -> tuple[tuple[str, ...], ...]:
    out = []
    for e in path:
        tag, kind, name = re.fullmatch(r"([a-z0-9]+)(?:([.#])(.+))?", e).groups()
        out.append((tag, *[f"{'class' if kind == '.' else 'id'}={w}" for w in _NAME.findall(name or "")]))
    return tuple(out)


_SIDE_WORDS = frozenset(f for p in SIDE_PATHS for e in _parse(p) for f in e if "=" in f)


def is_side(path: tuple[tuple[str, ...], ...]) -> bool:
    return any(e[0] in SIDE_TAGS or not _SIDE_WORDS.isdisjoint(e) for e in path)


def semantic_labels(page: list) -> np.ndarray:
    """Labels of a page's blocks by its own markup."""
    def main(path) -> bool:
        return bool({e[0] for e in path} & {"article", "main"}) and not is_side(path)
    return np.array([main(path) for path, _ in page], float)


def has_semantics(page: list) -> bool:
    return any(e[0] in ("article", "main") for path, _ in page for e in path)


def built_in(words: list[str], rng: random.Random) -> list:
    """Main text of usual shape with the given words."""
    path = (("html",), ("body",), ("article",))
    tails = [(("h1",),)] * rng.randint(0, 1) + [rng.choice(((("p",),), (("p",),), (("p",),), (("h2",),), (("ul",), ("li",)), (("blockquote",),)))
                                              for _ in range(rng.randint(1, 12))]
    out = []
    for tail in tails:
        n = rng.choice((2, 5, 10)) if tail[0][0] in ("h1", "h2") else rng.choice((5, 12, 40, 80))
        start = rng.randrange(max(1, len(words) - n))
        out.append((path + tail, " ".join(words[start:start + n])))
    return out


def varied(page: list, labels: np.ndarray, words: list[str], rng: random.Random, container=None) -> tuple[list, np.ndarray]:
    """The page with another main container and usual boilerplate before,
    after and inside its main text."""
    body = (("html",), ("body",))
    if container is None:
        container = _parse(rng.choice(MAIN_PATHS))
    bold = {"b", "i", "a", "em", "strong", "span"}
    mains = []
    for (path, text), y in zip(page, labels):
        if y:
            tail = [e for e in path if e[0] not in ("html", "body", "article", "main", "div", "section") and e[0] not in bold]
            mains.append((body + container + tuple(tail or [("p",)]), text))

    def side(prefix) -> list:
        path, out = _parse(rng.choice(SIDE_PATHS)), []
        for _ in range(rng.randint(1, 4)):
            n = rng.choice((1, 2, 5, 12, 40))
            start = rng.randrange(max(1, len(words) - n))
            out.append((prefix + path, " ".join(words[start:start + n])))
        return out
    before = [b for _ in range(rng.randint(0, 4)) for b in side(body)]
    after = [b for _ in range(rng.randint(0, 4)) for b in side(body)]
    out = [(b, 0.0) for b in before]
    for b in mains:
        out.append((b, 1.0))
        if rng.random() < 0.08:
            out += [(x, 0.0) for x in side(body + container)]
    out += [(b, 0.0) for b in after]
    return [b for b, _ in out], np.array([y for _, y in out])


def train(pages: list[str], seed: int = 3) -> Labeller:
    rng = random.Random(seed)
    read = [blocks(p) for p in pages]
    words = [w for p in read for _, text in p for w in text.split()[:TRAIN_WORDS]] or ["x"]
    labelled = [(p, semantic_labels(p)) for p in read if has_semantics(p)]
    if read and not any(y.any() for _, y in labelled):
        labelled += [(p, np.ones(len(p))) for p in (built_in(words, rng) for _ in range(60))]
    data = list(labelled)
    for p, y in labelled:
        data += [varied(p, y, words, rng) for _ in range(2)]
    bases = [(p, y) for p, y in labelled if y.any()]
    for page in read:
        if not page or has_semantics(page):
            continue
        sides = [is_side(path) for path, _ in page]
        first = sides.index(False) if False in sides else len(page)
        before, after = page[:first], [b for b, side in zip(page[first:], sides[first:]) if side]
        longest = max((b for b, side in zip(page, sides) if not side), key=lambda b: len(b[1]), default=((), ""))[0]
        own = tuple(e for e in longest if e[0] in ("div", "section", "table", "tbody", "tr", "td", "center"))
        for k in range(3):
            p, y = rng.choice(bases) if rng.random() < 0.5 else (main := built_in(words, rng), np.ones(len(main)))
            p, y = varied(p, y, words, rng, own if k else _parse(rng.choice(BARE_PATHS)))
            data.append((before + p + after, np.concatenate([np.zeros(len(before)), y, np.zeros(len(after))])))
    return Labeller().fit([(p[:TRAIN_BLOCKS], y[:TRAIN_BLOCKS]) for p, y in data])


def extract(pages: DataFrame, model: Labeller) -> DataFrame:
    """One row per page: page_id, url, text, n_chars, n_blocks, n_main."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        features = Features()
        for part in slices(batches, "html"):
            read = [blocks(p or "") for p in part.column("html").to_pylist()]
            chosen = model.main(read, features)
            texts = ["\n".join(t for (_, t), y in zip(p, c) if y) for p, c in zip(read, chosen)]
            yield pa.RecordBatch.from_arrays(
                [part.column("page_id"), part.column("url"), pa.array(texts, pa.string()),
                 pa.array([len(t) for t in texts], pa.int64()), pa.array([len(p) for p in read], pa.int32()),
                 pa.array([int(c.sum()) for c in chosen], pa.int32())],
                names=["page_id", "url", "text", "n_chars", "n_blocks", "n_main"])
    rows = pages.select(F.col("page_id").cast("long").alias("page_id"), "url", "html")
    return rows.mapInArrow(run, "page_id long, url string, text string, n_chars long, n_blocks int, n_main int")


def sample(pages: DataFrame, n: int = SAMPLE_PAGES) -> list[str]:
    """The pages that the labeller is fitted on: a bounded sample."""
    rows = bounded_sample(pages.filter(F.length("html") > 0).select("page_id", "html"), n, "page_id", "html")
    return [r["html"] for r in rows.collect()]


def extract_pages(pages: DataFrame) -> DataFrame:
    return extract(pages, train(sample(pages)))
