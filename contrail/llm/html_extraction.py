"""Main text of web pages: a bidirectional LSTM labels the leaf blocks of a page.

A page is cut into leaf blocks, runs of inline text between block-level tags,
with the tags and the class and id words above them.  Each block becomes a
vector of hashed path entries, hashed words and a few measures; a recurrent
network in numpy reads the sequence of all blocks of the page in both
directions and labels each block main text or not.

Training needs no labels from outside: at most ``max_pages`` pages (smallest
hashes of their ids) of at most ``max_train_chars`` characters, which bounds
what the driver collects, give texts and, where they mark up their article, blocks
with weak labels; layouts composed from those texts by ``layout`` add
sequences whose labels are known by construction.  The ids are chosen first and
only their pages fetched; equal rows count once.

An open element knows the element above it and the path entries of both, so a
tag costs the same however deep it lies.

Defined results: null, empty and markup-only pages give an empty text.  Text
outside any tag is a block.  Unclosed tags, comments and quotes reach to the
next place where they can end, at last the end of the page.  Every page is
read whole; equal pages give equal texts.  Other columns pass through.
"""

from __future__ import annotations

import html
import math
import re
import zlib
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Elements by their role in HTML.
SKIPPED = frozenset("script style noscript template svg math head title iframe object select option textarea button canvas audio video".split())
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
BLOCKS = frozenset("""address article aside blockquote body center dd details dialog dir div dl dt fieldset figcaption figure footer form
    h1 h2 h3 h4 h5 h6 header hgroup hr html legend li main menu nav ol p pre section summary table tbody td tfoot th thead tr ul""".split())
_TAG = re.compile(r"""<!--.*?(?:-->|\Z)|<(/?)([a-zA-Z][a-zA-Z0-9:-]*)((?:[^>"']++|"[^"]*+"|'[^']*+')*+)>|<(/?)([a-zA-Z][a-zA-Z0-9:-]*)([^>]*+)(?:>|\Z)|<[!?][^>]*+(?:>|\Z)""", re.DOTALL)
_ATTR = re.compile(r"""\b(class|id|role)\s*=\s*("[^"]*"|'[^']*'|[^\s>]+)""", re.IGNORECASE)
_WORDS = re.compile(r"[a-z]+")
_SKIP_ENDS = {t: re.compile(rf"</{t}\b[^>]*+(?:>|\Z)", re.IGNORECASE) for t in SKIPPED}
# Elements that mark out main text or its surroundings.
LANDMARKS = frozenset("article main nav aside footer form".split())
_UPPER, _DIGIT = re.compile(r"[A-Z]"), re.compile(r"[0-9]")
PATHS, WORDS, MEASURES = 256, 64, 10
WIDTH = PATHS + WORDS + MEASURES
HIDDEN = 24


@dataclass
class Block:
    text: str
    path: tuple[int, ...]   # hashed entries of the elements above
    depth: int
    linked: int             # characters inside links
    tags: frozenset         # landmarks above


class _Open:
    """An open element: its tag, what is above it, and all entries and landmarks on the way, entries as bits."""

    __slots__ = ("tag", "above", "bits", "depth", "tags", "_path")

    def __init__(self, tag: str, bits: int, above: _Open | None):
        self.tag, self.above, self._path = tag, above, None
        self.bits = bits | (above.bits if above else 0)
        self.depth = 1 + (above.depth if above else 0)
        tags = above.tags if above else frozenset()
        self.tags = tags | {tag} if tag in LANDMARKS else tags

    def path(self) -> tuple[int, ...]:
        if self._path is None:
            bits, out = self.bits | 1 << _bucket("^" + self.tag, PATHS), []
            while bits:
                low = bits & -bits
                out.append(low.bit_length() - 1)
                bits ^= low
            self._path = tuple(out)
        return self._path


def _bucket(name: str, n: int) -> int:
    return zlib.crc32(name.encode()) % n


def _entries(tag: str, attrs: str) -> int:
    bits = 1 << _bucket("<" + tag, PATHS)
    for _, value in _ATTR.findall(attrs) if attrs else ():
        for w in _WORDS.findall(value.lower()):
            bits |= 1 << _bucket("." + w, PATHS)
    return bits


def leaf_blocks(page: str) -> list[Block]:
    """Leaf blocks of a page in order, texts with character references decoded and single spaces."""
    top: _Open | None = None
    count: Counter = Counter()  # open elements by tag
    out: list[Block] = []
    pieces: list[str] = []
    linked, at, n = 0, 0, len(page)
    known: dict[tuple[str, str], int] = {}
    endless: set[str] = set()   # tags without another end in the page

    def close() -> None:
        nonlocal pieces, linked
        raw = "".join(pieces)
        text = " ".join((html.unescape(raw) if "&" in raw else raw).split())
        if text:
            out.append(Block(text, top.path(), top.depth, linked, top.tags) if top else Block(text, (), 0, linked, frozenset()))
        pieces, linked = [], 0

    def pop() -> str:
        nonlocal top
        tag, top = top.tag, top.above
        count[tag] -= 1
        return tag

    while at < n:
        m = _TAG.search(page, at)
        end = m.start() if m else n
        if end > at:
            pieces.append(page[at:end])
            if count["a"]:
                linked += end - at
        if not m:
            break
        at = m.end()
        tag = (m[2] or m[5] or "").lower()
        if not tag:
            continue
        if m[1] or m[4]:
            if count[tag]:
                if tag in BLOCKS:
                    close()
                while pop() != tag:
                    pass
            continue
        attrs = m[3] or m[6] or ""
        if tag in SKIPPED and not attrs.rstrip().endswith("/"):
            if tag in BLOCKS:
                close()
            done = None if tag in endless else _SKIP_ENDS[tag].search(page, at)
            if done:
                at = done.end()
            else:
                endless.add(tag)
                at = n if tag in ("script", "style") else at
            continue
        if tag in BLOCKS:
            close()
            if count["p"]:  # a block ends an open paragraph
                while pop() != "p":
                    pass
            if tag in ("li", "tr", "td", "th", "dt", "dd") and top and top.tag == tag:
                pop()
        elif tag == "br":
            pieces.append(" ")
        if tag not in VOID:
            key = (tag, attrs)
            if key not in known:
                known[key] = _entries(tag, attrs)
            top = _Open(tag, known[key], top)
            count[tag] += 1
    close()
    return out


def vectors(blocks: list[Block]) -> np.ndarray:
    """(blocks, WIDTH) inputs of the network."""
    n = len(blocks)
    x = np.zeros((n, WIDTH), dtype=np.float32)
    for i, b in enumerate(blocks):
        x[i, list(b.path)] = 1
        text, chars = b.text, len(b.text)
        words = text.lower().encode().split(b" ")
        # every word of the block; a long one's count less each, so that blocks of any length weigh alike
        x[i, PATHS: PATHS + WORDS] = np.bincount([zlib.crc32(w) % WORDS for w in words], minlength=WORDS) * min(0.5, 3 / len(words))
        words = len(words)
        x[i, PATHS + WORDS:] = (math.log1p(chars) / 5, math.log1p(words) / 4, min(1.0, b.linked / chars), text.count(",") / words, text[-1] in ".?!:;",
                                len(_UPPER.findall(text)) / chars, len(_DIGIT.findall(text)) / chars, i / n, b.depth / 10, n / (n + 20))
    return x


class BiLstm:
    """A bidirectional LSTM with one logistic output per step, trained by Adam."""

    def __init__(self, width: int = WIDTH, hidden: int = HIDDEN, seed: int = 5):
        rng = np.random.default_rng(seed)
        self.hidden = hidden
        draw = lambda *shape: rng.normal(0, 1 / np.sqrt(shape[0]), shape).astype(np.float32)
        self.p = {}
        for d in "fb":
            self.p |= {"x" + d: draw(width, 4 * hidden) / 2, "h" + d: draw(hidden, 4 * hidden), "c" + d: np.zeros(4 * hidden, np.float32)}
            self.p["c" + d][hidden: 2 * hidden] = 1  # remember at first
        self.p |= {"o": draw(2 * hidden), "q": np.zeros(1, np.float32)}

    def _walk(self, x, mask, d, keep):
        """Hidden states of one direction; x (steps, batch, width)."""
        n, h = self.hidden, np.zeros((x.shape[1], self.hidden), np.float32)
        c = h.copy()
        pre = x @ self.p["x" + d] + self.p["c" + d]
        steps = range(len(x)) if d == "f" else range(len(x) - 1, -1, -1)
        out, tape = np.zeros((*x.shape[:2], n), np.float32), []
        for t in steps:
            z = pre[t] + h @ self.p["h" + d]
            i, f, o = (1 / (1 + np.exp(-z[:, k * n:(k + 1) * n])) for k in (0, 1, 3))
            g, m = np.tanh(z[:, 2 * n: 3 * n]), mask[t][:, None]
            new = f * c + i * g
            th = np.tanh(new)
            if keep:
                tape.append((t, h, c, i, f, g, o, th, m))
            h, c = m * o * th + (1 - m) * h, m * new + (1 - m) * c
            out[t] = h
        return out, tape

    def logits(self, x, mask, keep=False):
        f, tf = self._walk(x, mask, "f", keep)
        b, tb = self._walk(x, mask, "b", keep)
        both = np.concatenate([f, b], axis=2)
        return both @ self.p["o"] + self.p["q"][0], both, (tf, tb)

    def gradient(self, x, mask, y):
        """Gradients of the mean cross entropy over the steps under the mask."""
        z, both, tapes = self.logits(x, mask, keep=True)
        dz = ((1 / (1 + np.exp(-z))) - y) * mask / mask.sum()
        g = {"o": np.einsum("tb,tbh->h", dz, both), "q": np.array([dz.sum()])}
        dboth = dz[:, :, None] * self.p["o"]
        n = self.hidden
        for d, tape, dout in (("f", tapes[0], dboth[:, :, :n]), ("b", tapes[1], dboth[:, :, n:])):
            dpre = np.zeros((*x.shape[:2], 4 * n), np.float32)
            gh = np.zeros_like(self.p["h" + d])
            dh = np.zeros((x.shape[1], n), np.float32)
            dc = dh.copy()
            for t, h, c, i, f, gg, o, th, m in reversed(tape):
                dh = dh + dout[t]
                down, cown = dh * m, dc * m + dh * m * o * (1 - th ** 2)
                dzs = np.concatenate([cown * gg * i * (1 - i), cown * c * f * (1 - f), cown * i * (1 - gg ** 2), down * th * o * (1 - o)], axis=1)
                dpre[t] = dzs
                gh += h.T @ dzs
                dh, dc = dh * (1 - m) + dzs @ self.p["h" + d].T, dc * (1 - m) + cown * f
            g |= {"x" + d: x.reshape(-1, x.shape[2]).T @ dpre.reshape(-1, 4 * n), "h" + d: gh, "c" + d: dpre.sum((0, 1))}
        return g

    def train(self, pages: list[tuple[np.ndarray, np.ndarray]], epochs: int = 10, batch: int = 24, rate: float = 0.015, seed: int = 3) -> None:
        rng = np.random.default_rng(seed)
        first = {k: np.zeros_like(v) for k, v in self.p.items()}
        second = {k: np.zeros_like(v) for k, v in self.p.items()}
        step = 0
        for _ in range(epochs):
            order = sorted(rng.permutation(len(pages)).tolist(), key=lambda k: len(pages[k][0]) // 8)
            groups = [order[i: i + batch] for i in range(0, len(order), batch)]
            for k in rng.permutation(len(groups)).tolist():
                x, mask, y = padded([pages[i] for i in groups[k]])
                step += 1
                for name, g in self.gradient(x, mask, y).items():
                    g = np.clip(g, -1, 1)
                    first[name] += 0.1 * (g - first[name])
                    second[name] += 0.01 * (g * g - second[name])
                    self.p[name] -= (rate * (first[name] / (1 - 0.9 ** step)) / (np.sqrt(second[name] / (1 - 0.99 ** step)) + 1e-7)).astype(np.float32)

    def predict(self, xs: list[np.ndarray]) -> list[np.ndarray]:
        """Whether each block of each page is main text; pages of like length run together."""
        out: list = [None] * len(xs)
        order = sorted(range(len(xs)), key=lambda k: len(xs[k]))
        at = 0
        while at < len(order):
            longest, n = max(1, len(xs[order[min(at + 63, len(order) - 1)]])), 64
            if longest > 512:  # padded inputs stay small
                n = max(1, 64 * 512 // longest)
            group = order[at: at + n]
            at += n
            x, mask, _ = padded([(xs[k], np.zeros(len(xs[k]))) for k in group])
            z, _, _ = self.logits(x, mask)
            for j, k in enumerate(group):
                out[k] = z[: len(xs[k]), j] > 0
        return out


def padded(pages) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    steps = max(1, max(len(x) for x, _ in pages))
    x = np.zeros((steps, len(pages), WIDTH), np.float32)
    mask, y = np.zeros((steps, len(pages)), np.float32), np.zeros((steps, len(pages)), np.float32)
    for j, (xs, ys) in enumerate(pages):
        x[: len(xs), j], mask[: len(xs), j], y[: len(ys), j] = xs, 1, ys
    return x, mask, y


# --- training pages

MAIN = ""  # marks main text in composed pages
# Words seen in class and id attributes of each part, as a general web page has them.
NAMES = {
    "header": "header masthead top banner logo branding site-header page-header", "nav": "nav menu navbar navigation breadcrumb breadcrumbs links topnav pagination toc tabs",
    "notice": "cookie notice consent alert gdpr privacy message popup modal cookie-banner overlay", "ad": "ad ads advert advertisement sponsor sponsored promo promotion banner-ad adbox",
    "side": "sidebar aside widget related recent popular trending share social tags author-box recommended", "form": "form newsletter subscribe search login signup contact",
    "comments": "comments comment comment-list responses discussion replies disqus reviews respond", "footer": "footer copyright bottom legal site-footer colophon credits",
    "main": "content article post entry story body text main post-content entry-content article-body page-content",
}
SAYINGS = {
    "notice": ["We use cookies to improve this site.", "This site uses cookies. Accept all?", "Please note our privacy policy.", "You are offline."],
    "form": ["Subscribe to our newsletter", "Your e-mail address", "Search", "Log in", "Sign up now", "Send"],
    "footer": ["&copy; 2024 All rights reserved.", "&copy; {w} &middot; {w}", "Terms of use", "Privacy policy", "Contact us"],
    "comments": ["Comments", "3 comments", "Leave a reply", "Reply", "says:"], "side": ["Related articles", "Most read", "Share this", "About the author", "Tags"],
    "ad": ["Advertisement", "Sponsored"],
}


def layout(rng: np.random.Generator, texts: list[str], words: list[str]) -> str:
    """A composed page; its main blocks begin with ``MAIN``."""
    pick = lambda xs: xs[int(rng.integers(len(xs)))]
    esc = html.escape
    word = lambda: esc(pick(words))
    some = lambda: " ".join(word() for _ in range(int(rng.integers(1, 6))))
    text = lambda: esc(pick(texts))
    name = lambda part: f' {pick(["class", "class", "id"])}="{pick(NAMES[part].split())}"' if rng.random() < 0.9 else ""
    saying = lambda part: pick(SAYINGS[part]).replace("{w}", some()) if rng.random() < 0.5 else some()
    link = lambda: f'<a href="/{word()}">{some()}</a>'
    links = lambda: "<ul>" + "".join(f"<li>{link()}</li>" for _ in range(int(rng.integers(2, 9)))) + "</ul>"

    def box(part: str, tags: list[str], inner: str) -> str:
        tag = pick(tags)
        given = name(part) if tag in ("div", "section", "ul", "p", "span") else pick(["", name(part)])
        return f"<{tag}{given}>{inner}</{tag}>"

    def header() -> str:
        return box("header", ["header", "div", "header"], pick([f"<a href='/'>{some()}</a>", f"<p>{some()}</p>", f"<h2>{some()}</h2><p>{text()}</p>", some(), f"<h1>{some()}</h1>" + links()]))

    def nav() -> str:
        return box("nav", ["nav", "nav", "div"], pick([links(), links(), " | ".join(link() for _ in range(4)), f"<p>{link()} &gt; {link()}</p>"]))

    def notice() -> str:
        return box("notice", ["div", "div", "section", "p"], pick([saying("notice"), text(), f"<p>{saying('notice')}</p><a href='#'>OK</a>", f"<p>{text()}</p>"]))

    def ad() -> str:
        return box("ad", ["div", "div", "aside", "section"], pick([saying("ad"), text(), text(), f"<p>{text()}</p>", f"<a href='#'>{some()}</a> {text()}"]))

    def side() -> str:
        return box("side", ["aside", "aside", "div", "section"], pick([f"<h3>{saying('side')}</h3>" + links(), f"<h3>{saying('side')}</h3><p>{text()}</p>", f"<p>{text()}</p>", text()]))

    def form() -> str:
        inner = pick([f"<label>{saying('form')}</label><input>", f"<p>{saying('form')}</p><p>{text()}</p><input type='text'>", f"<h3>{saying('form')}</h3><div>{some()}</div>"])
        return f"<form>{inner}</form>" if rng.random() < 0.7 else box("form", ["div", "section"], inner)

    def comments() -> str:
        one = lambda: pick(["<li>{}</li>", "<div class='comment'><b>" + some() + "</b><p>{}</p></div>", "<p>{}</p>", "<article class='comment'><p>{}</p></article>", "<div>{}</div>"]).format(text())
        inner = f"<h3>{saying('comments')}</h3>" + "".join(one() for _ in range(int(rng.integers(1, 6))))
        return box("comments", ["section", "div"], inner) if rng.random() < 0.9 else f"<ol class='comments'>{inner}</ol>"

    def footer() -> str:
        return box("footer", ["footer", "footer", "div"], pick([saying("footer"), f"&copy; {some()} &middot; {text()}", links(), f"<p>{saying('footer')}</p><p>{text()}</p>", f"<p>{text()}</p>"]))

    def main() -> str:
        tag = pick(["article", "article", "main", "div", "div", "section", "td"])
        given = name("main") if tag in ("div", "section", "td") else pick(["", "", name("main")])
        parts = [pick(["<h1>{}</h1>", "<h1>{}</h1>", "<h2>{}</h2>", "<p><b>{}<br>", "<header><h1>{}</h1></header>"]).format(MAIN + pick([some(), text()]))]
        if rng.random() < 0.05:
            parts = []
        for _ in range(int(rng.choice([0, 1, 2, 4, 8, 16]))):
            form_of = pick(["<p>{}</p>"] * 8 + ["<p>{}", "<p><b>{}<br>", "<h2>{}</h2>", "<blockquote>{}</blockquote>", "<ul><li>{}</li></ul>", "<div>{}</div>", "{}<br><br>", "<pre>{}</pre>", "<h3>{}</h3>", "<table><tr><td>{}</td></tr></table>"])
            parts.append(form_of.format(MAIN + (some() if rng.random() < 0.15 else text())))
            if rng.random() < 0.05:
                parts.append(pick([ad, side, form])())
        if not parts:
            parts = [f"<p>{MAIN}{text()}</p>"]
        inner = f"<{tag}{given}>" + "".join(parts) + f"</{tag}>"
        return pick([inner, inner, f"<div class='wrapper'>{inner}</div>", f"<main>{inner}</main>", f"<div id='page'><div class='row'>{inner}</div></div>"])

    before = [f() for f in (header, nav, notice, ad, side, form) if rng.random() < 0.4]
    after = [f() for f in (ad, side, form, comments, nav, notice, footer) if rng.random() < 0.4]
    rng.shuffle(before)
    return "<html><body>" + "".join(before) + main() + "".join(after) + pick(["</body></html>", ""])


def weak_labels(blocks: list[Block]) -> list[bool] | None:
    """Blocks of the element that the page itself marks as its article; None if there is none."""
    inside = [bool(b.tags & {"article", "main"}) and not b.tags & {"nav", "aside", "footer", "form"} for b in blocks]
    return inside if any(inside) else None


def fit_labeller(pages: list[str], layouts: int = 1200, seed: int = 11, epochs: int = 8) -> BiLstm:
    """A labeller trained on pages with weak labels and on composed layouts of their texts."""
    rng = np.random.default_rng(seed)
    data, texts = [], []
    for page in pages:
        blocks = leaf_blocks(page)
        texts += [b.text.replace(MAIN, "") for b in blocks]
        labels = weak_labels(blocks)
        if labels:
            data.append((vectors(blocks), np.array(labels, dtype=np.float32)))
    texts = [t for t in texts if t] or ["text"]
    words = sorted({w for t in texts for w in t.split()[:20]})
    long = [t for t in texts if len(t) > 60] or texts
    for _ in range(layouts):
        blocks = leaf_blocks(layout(rng, long, words))
        labels = [b.text.startswith(MAIN) for b in blocks]
        for b in blocks:
            b.text = b.text.replace(MAIN, "") or "-"
        if blocks:
            data.append((vectors(blocks), np.array(labels, dtype=np.float32)))
    model = BiLstm()
    model.train(data, epochs=epochs)
    return model


def training_pages(pages: DataFrame, max_pages: int, max_train_chars: int) -> list[str]:
    """The pages to learn from: at most ``max_pages`` distinct rows of at most ``max_train_chars`` characters, by the hash of their ids.

    Tasks rank keys of two longs; then each sends those of the chosen pages that it has.
    """
    some = pages.where(F.length("html") <= max_train_chars).select(F.xxhash64("page_id").alias("k"), F.xxhash64("page_id", "html").alias("t"), "html")
    keys = some.select("k", "t").distinct().orderBy("k", "t").limit(max_pages).collect()
    chosen = pages.sparkSession.createDataFrame(keys, "k long, t long")  # max_pages rows at most
    found = some.join(F.broadcast(chosen), ["k", "t"], "left_semi").groupBy("k", "t").agg(F.first("html").alias("html")).collect()
    return [r["html"] for r in sorted(found, key=lambda r: (r["k"], r["t"]))]


def extract_text(pages: DataFrame, max_pages: int = 200, max_train_chars: int = 20_000, **settings) -> DataFrame:
    """All columns of pages (page_id, html, ...) but ``html``, with ``text`` and ``n_chars``."""
    spark = pages.sparkSession
    model = spark.sparkContext.broadcast(fit_labeller(training_pages(pages, max_pages, max_train_chars), **settings))
    others = [c for c in pages.columns if c != "html"]
    rows = pages.select(F.struct(*[F.col(f"`{c}`") for c in others]).alias("rest"), "html")
    rest = rows.schema["rest"].dataType

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 256):
                part = batch.slice(at, 256)
                blocks = [leaf_blocks(x or "") for x in part.column("html").to_pylist()]
                keep = model.value.predict([vectors(b) for b in blocks])
                texts = ["\n\n".join(b.text for b, k in zip(bs, ks) if k) for bs, ks in zip(blocks, keep)]
                yield pa.RecordBatch.from_arrays([part.column("rest"), pa.array(texts, pa.string()), pa.array([len(t) for t in texts], pa.int64())], ["rest", "text", "n_chars"])

    out = rows.mapInArrow(run, f"rest {rest.simpleString()}, text string, n_chars long")
    return out.select(*[F.col(f"rest.`{c}`").alias(c) for c in others if c not in ("text", "n_chars")], "text", "n_chars")
