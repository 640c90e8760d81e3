"""Main text of web pages by a recurrent block labeller.

A page is read into a sequence of leaf blocks, each with its tag path and its text. A bidirectional LSTM in
numpy reads for every block hashed vectors of the path and of the words, and labels it as main text or not in
the context of the whole page. The text is the main blocks in page order, one per line.

The labeller is trained on at most ``SAMPLE_PAGES`` pages, taken by the hash of the id, and on variants of
them with parts that pages often have but the sample may not: page headers, side bars, notices, forms, adverts,
reader comments, and articles without an article tag. Teacher labels come from the meaning of
element and class names (``NOT_MAIN``); the labeller must find them from context, also where names are new to it.

White space inside a block becomes one space; scripts, styles, templates, frames, form texts, comments and markup have
no text, up to their closing tag or, if there is none, to the end of the page, as in a browser. Text inside svg, math,
object, canvas and noscript is judged like other text. A null or empty page, or one without main blocks, has the
empty text. Pages of any length are read whole, with memory in proportion to a page. Equal pages get equal texts.
Without any page to train on the result is empty.
"""

from __future__ import annotations

import html
import re
from collections.abc import Iterator
from functools import lru_cache
from math import log1p
from zlib import crc32

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

SAMPLE_PAGES = 300
PATHS, WORDS, HIDDEN = 96, 32, 16
EXTRA = 4
INPUTS = PATHS + WORDS + EXTRA
BATCH_CELLS = 40_000

#: Elements that separate blocks, elements without content, and elements whose content is no text (fixed values).
BLOCK = frozenset(
    "address article aside blockquote body button center dd details dialog div dl dt fieldset figcaption figure footer "
    "form h1 h2 h3 h4 h5 h6 head header hr html label legend li main menu nav ol option p pre section select summary "
    "table tbody td tfoot th thead title tr ul".split()
)
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = "script|style|template|iframe|textarea"
#: Elements inside which, and for which, a closing slash ends the element.
FOREIGN = frozenset(("svg", "math"))

#: Names that say that an element is not main text (fixed values).
NOT_MAIN = frozenset(
    "ad ads advert advertisement adverts aside banner breadcrumb breadcrumbs button comment comments consent cookie "
    "cookies dialog disqus footer form header login menu menus modal nav navbar navigation newsletter notice notices "
    "popup promo promoted reaction reactions related reply replies responses search select share sharing sidebar "
    "signup social sponsor sponsored subscribe title toolbar widget".split()
)
MAIN = frozenset("article main content post entry story".split())

_TOKEN = re.compile(
    rf"<!--.*?(?:-->|\Z)|<({RAW})(?=[\s/>])[^>]*>.*?(?:</\1\s*>|\Z)"
    r"|<(/?)([a-zA-Z][a-zA-Z0-9:-]*)((?:[^>\"']|\"[^\"]*\"|'[^']*')*)>|<[!?/a-zA-Z][^>]*>",
    re.S | re.I,
)
_NAMES = re.compile(r"""\b(?:class|id|role)\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s>"']+))""", re.I)
_PARTS = re.compile(r"[a-z]+")


@lru_cache(maxsize=20_000)
def _element(tag: str, attributes: str) -> tuple[str, ...]:
    """A tag and the words of its class, id and role names."""
    named = (part for m in _NAMES.finditer(attributes) for part in _PARTS.findall((m[1] or m[2] or m[3] or "").lower()))
    return (tag, *(f".{n}" for n in named))


def blocks(page: str | None) -> list[tuple[tuple[tuple[str, ...], ...], str, float]]:
    """(path, text, share of link text) of the leaf blocks with text, in page order."""
    found: list[tuple[tuple[tuple[str, ...], ...], str, float]] = []
    stack: list[tuple[str, ...]] = []
    pieces: list[str] = []
    linked, links = 0, 0

    def close() -> None:
        nonlocal linked
        if pieces:
            text = " ".join(html.unescape("".join(pieces)).split())
            if text:
                path = tuple(e for e in stack if e[0] in BLOCK or e[1:])
                found.append((path, text, linked / max(1, sum(map(len, pieces)))))
            pieces.clear()
        linked = 0

    def take(raw: str) -> None:
        nonlocal linked
        if raw:
            pieces.append(raw)
            linked += len(raw) if links else 0

    page, at = page or "", 0
    for m in _TOKEN.finditer(page):
        take(page[at : m.start()])
        at = m.end()
        tag = (m[3] or "").lower()
        if not tag:
            continue
        if tag in VOID:
            if tag == "hr":
                close()
            else:
                pieces.append(" ")
            continue
        open_names = [e[0] for e in stack]
        foreign = not FOREIGN.isdisjoint(open_names)
        inner = tag in FOREIGN or foreign and (tag not in BLOCK or tag == "title")
        if inner and not m[2] and (m[4] or "").endswith("/"):
            pieces.append(" ")
            continue
        if tag in BLOCK:
            close()
        if not m[2]:
            if foreign and not inner and "foreignobject" not in open_names:  # a block ends an open svg
                del stack[min(open_names.index(f) for f in FOREIGN if f in open_names) :]
            if tag in BLOCK and tag != "body" and not inner:
                names = [e[0] for e in stack]
                if "p" in names:  # a block ends an open paragraph
                    del stack[names.index("p") :]
                if tag in ("li", "td", "th", "tr", "dt", "dd", "option") and stack and stack[-1][0] == tag:
                    stack.pop()
            stack.append(_element(tag, m[4] or ""))
        else:
            for i in range(len(stack) - 1, -1, -1):
                if stack[i][0] == tag:
                    del stack[i:]
                    break
        links = sum(e[0] == "a" for e in stack[-4:])
    take(page[at:])
    close()
    return found


def teacher(path: tuple[tuple[str, ...], ...], has_article: bool) -> bool:
    """Whether the names on a path say main text; a header inside an article belongs to it."""
    inside = False
    for element in path:
        names = {n.lstrip(".") for n in element}
        if names & MAIN and not names & NOT_MAIN:
            inside = True
        elif names & NOT_MAIN and not (inside and element == ("header",)):
            return False
    return inside or not has_article


def _bucket(text: str, size: int) -> int:
    return crc32(text.encode("utf-8", "replace")) % size


class _WordBuckets(dict):
    def __missing__(self, word: str) -> int:
        if len(self) >= 200_000:
            self.clear()
        value = self[word] = _bucket(word.lower(), WORDS)
        return value


_word_buckets = _WordBuckets()


@lru_cache(maxsize=50_000)
def _path_vector(path: tuple[tuple[str, ...], ...]) -> tuple[int, ...]:
    """Buckets of a path's names; the two innermost elements have buckets of their own too."""
    names = [n for e in path for n in e]
    inner = [f"{i}:{n}" for i, e in enumerate(reversed(path[-2:])) for n in e]
    return tuple({_bucket(n, PATHS) for n in [*names, *inner]})


def vectors(page_blocks) -> np.ndarray:
    """Input vectors of a page's blocks."""
    n = len(page_blocks)
    x = np.zeros((n, INPUTS), dtype=np.float32)
    buckets, sizes, rows, names, extra = [], [], [], [], []
    for i, (path, text, linked) in enumerate(page_blocks):
        words = text.split()
        buckets += map(_word_buckets.__getitem__, words)
        sizes.append(len(words))
        on = _path_vector(path)
        names += on
        rows += [i] * len(on)
        extra.append((log1p(len(words)) / 5, linked, text.count(",") / len(words), text[-1] in ".!?…"))
    if n:
        x[rows, names] = 1
        of_block = np.repeat(np.arange(0, n * WORDS, WORDS), sizes)
        counts = np.bincount(of_block + np.array(buckets), minlength=n * WORDS).reshape(n, WORDS)
        x[:, PATHS : PATHS + WORDS] = counts / np.array(sizes)[:, None]
        x[:, PATHS + WORDS :] = extra
    return x


class Labeller:
    """Two LSTMs over a page's blocks and a logistic output on both states."""

    def __init__(self, seed: int = 7):
        rng = np.random.default_rng(seed)
        self.p = {"out": rng.normal(0, 0.1, 2 * HIDDEN + 1)}
        for d in ("forth", "back"):
            self.p[d] = rng.normal(0, 0.15, (INPUTS + HIDDEN + 1, 4 * HIDDEN))
            self.p[d][-1, HIDDEN : 2 * HIDDEN] += 1  # forget gates start open

    def _run(self, d: str, x: np.ndarray, mask: np.ndarray, keep: bool) -> tuple[np.ndarray, list]:
        """States (time, page, HIDDEN); padding leaves the state as it is."""
        w = self.p[d].astype(x.dtype)
        steps, pages = x.shape[:2]
        fed = x @ w[:INPUTS] + w[-1]
        h = np.zeros((pages, HIDDEN), x.dtype)
        c = np.zeros_like(h)
        states, tape = np.zeros((steps, pages, HIDDEN), x.dtype), []
        for t in range(steps) if d == "forth" else range(steps - 1, -1, -1):
            z = fed[t] + h @ w[INPUTS:-1]
            gates = 1 / (1 + np.exp(-np.clip(z[:, : 3 * HIDDEN], -30, 30)))
            i, f, o = gates[:, :HIDDEN], gates[:, HIDDEN : 2 * HIDDEN], gates[:, 2 * HIDDEN :]
            g = np.tanh(z[:, 3 * HIDDEN :])
            m = mask[t][:, None]
            c1 = np.where(m, f * c + i * g, c)
            tanh_c = np.tanh(c1)
            h1 = np.where(m, o * tanh_c, h)
            if keep:
                tape.append((t, h, c, i, f, o, g, tanh_c, m))
            h, c = h1, c1
            states[t] = h
        return states, tape

    def forward(self, x: np.ndarray, mask: np.ndarray, keep: bool = False):
        runs = [self._run(d, x, mask, keep) for d in ("forth", "back")]
        both = np.concatenate([r[0] for r in runs], axis=2)
        z = both @ self.p["out"][:-1].astype(x.dtype) + self.p["out"][-1]
        return 1 / (1 + np.exp(-np.clip(z, -30, 30))), both, [r[1] for r in runs]

    def _gradients(self, x: np.ndarray, mask: np.ndarray, y: np.ndarray) -> dict[str, np.ndarray]:
        p, both, tapes = self.forward(x, mask, keep=True)
        dz = np.where(mask, p - y, 0) / mask.sum()
        grads = {"out": np.append(np.tensordot(dz, both, 2), dz.sum())}
        d_both = dz[:, :, None] * self.p["out"][:-1]
        for d, tape, d_states in zip(("forth", "back"), tapes, np.split(d_both, 2, axis=2)):
            w, grad = self.p[d], np.zeros_like(self.p[d])
            dh = np.zeros(x.shape[1:2] + (HIDDEN,))
            dc = np.zeros_like(dh)
            for t, h0, c0, i, f, o, g, tanh_c, m in reversed(tape):
                dh = dh + d_states[t]
                on = np.where(m, dh, 0)
                d_c = np.where(m, dc, 0) + on * o * (1 - tanh_c**2)
                d_gates = np.concatenate(
                    (d_c * g * i * (1 - i), d_c * c0 * f * (1 - f), on * tanh_c * o * (1 - o), d_c * i * (1 - g**2)), axis=1
                )
                grad += np.concatenate((x[t], h0, np.ones((len(h0), 1))), axis=1).T @ d_gates
                dh = np.where(m, d_gates @ w[INPUTS:-1].T, dh)
                dc = np.where(m, d_c * f, dc)
            grads[d] = grad
        return grads

    def train(self, pages: list[tuple[np.ndarray, np.ndarray]], epochs: int = 12, batch: int = 32, seed: int = 7) -> None:
        """Adam on the cross-entropy of every block."""
        rng = np.random.default_rng(seed)
        first = {k: np.zeros_like(v) for k, v in self.p.items()}
        second = {k: np.zeros_like(v) for k, v in self.p.items()}
        step = 0
        for _ in range(epochs):
            order = rng.permutation(len(pages))
            for at in range(0, len(order), batch):
                part = [pages[i] for i in order[at : at + batch]]
                x, mask = padded([p[0].astype(np.float64) for p in part])
                y = np.zeros(mask.shape)
                for i, (_, labels) in enumerate(part):
                    y[: len(labels), i] = labels
                step += 1
                for k, g in self._gradients(x, mask, y).items():
                    first[k] = 0.9 * first[k] + 0.1 * g
                    second[k] = 0.99 * second[k] + 0.01 * g**2
                    rate = 0.01 * np.sqrt(1 - 0.99**step) / (1 - 0.9**step)
                    self.p[k] = self.p[k] - rate * first[k] / (np.sqrt(second[k]) + 1e-8)

    def label(self, pages: list[np.ndarray]) -> list[np.ndarray]:
        """For every page, which blocks are main text; pages of like length are run together."""
        out: list[np.ndarray] = [np.zeros(0, bool)] * len(pages)
        order = sorted(range(len(pages)), key=lambda i: len(pages[i]))
        at = 0
        while at < len(order):
            end = at + 1
            while end < len(order) and len(pages[order[end]]) * (end + 1 - at) <= BATCH_CELLS:
                end += 1
            part = order[at:end]
            x, mask = padded([pages[i] for i in part])
            if len(x):
                p = self.forward(x, mask)[0]
                for k, i in enumerate(part):
                    out[i] = p[: len(pages[i]), k] >= 0.5
            at = end
        return out


def padded(pages: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """Pages as one array (time, page, INPUTS), and where it holds blocks."""
    steps = max((len(p) for p in pages), default=0)
    x = np.zeros((steps, len(pages), INPUTS), pages[0].dtype if pages else np.float32)
    mask = np.zeros((steps, len(pages)), bool)
    for i, p in enumerate(pages):
        x[: len(p), i], mask[: len(p), i] = p, True
    return x, mask


def variants(pages: list[str], seed: int = 7) -> list[str]:
    """The pages, and each once more with some other parts around, inside and after its article."""
    rng = np.random.default_rng(seed)
    lines = [text for page in pages for _, text, _ in blocks(page)] or ["text"]

    def some(tag: str = "p", least: int = 1, most: int = 3) -> str:
        picked = rng.integers(0, len(lines), rng.integers(least, most + 1))
        return "".join(f"<{tag}>{html.escape(lines[i])}</{tag}>" for i in picked)

    before = [
        lambda: f"<header><h1>{html.escape(lines[rng.integers(len(lines))][:40])}</h1>{some()}</header>",
        lambda: f'<div class="cookie-notice">{some()}<button>OK</button></div>',
        lambda: f'<div class="banner">{some("span")}</div>',
        lambda: f'<ul class="menu">{some("li", 2, 6)}</ul>',
        lambda: f'<form action="/search"><label>{html.escape(lines[rng.integers(len(lines))][:20])}</label></form>',
        lambda: f"<aside>{some()}</aside>",
        lambda: f'<div class="notice">{some()}</div>',
    ]
    after = [
        lambda: f"<aside>{some('p', 1, 4)}</aside>",
        lambda: f'<div class="sidebar"><ul>{some("li", 2, 5)}</ul></div>',
        lambda: f'<section class="comments"><h2>Comments</h2>{some("p", 1, 5)}</section>',
        lambda: f'<div id="comments">{"".join(f"<div class=comment>{some()}</div>" for _ in range(3))}</div>',
        lambda: f'<form class="newsletter">{some()}<button>Send</button></form>',
        lambda: f'<div class="related">{some("li", 2, 4)}</div>',
        lambda: f'<div class="ad">{some()}</div>',
        lambda: f'<div class="share">{some("span")}</div>',
    ]
    made = []
    for page in pages:
        made.append(page)
        head, opening, rest = page.partition("<article>")
        body, closing, tail = rest.partition("</article>")
        if not opening or not closing:
            continue
        pick = lambda parts, n: "".join(parts[i]() for i in rng.integers(0, len(parts), rng.integers(0, n + 1)))
        paragraphs = body.split("</p>")
        where = int(rng.integers(1, len(paragraphs))) if len(paragraphs) > 1 else 0
        if where and rng.random() < 0.4:
            paragraphs[where] = pick([after[0], after[6], after[4], after[5]], 1) + paragraphs[where]
        body = "</p>".join(paragraphs)
        opened, closed = [
            ("<article>", "</article>"), ("<main><article>", "</article></main>"), ("<main>", "</main>"),
            ('<div class="content">', "</div>"), ('<div class="post">', "</div>"),
            ('<div id="main"><article class="post">', "</article></div>"),
        ][int(rng.integers(0, 6))]
        inside = pick(after[2:4], 1) if rng.random() < 0.3 else ""
        made.append(head + pick(before, 3) + opened + body + inside + closed + pick(after, 3) + tail)
    return made


def train(pages: list[str]) -> Labeller | None:
    examples = []
    for page in variants(pages):
        found = blocks(page)
        if found:
            has_article = any(MAIN & {n.lstrip(".") for n in e} for path, _, _ in found for e in path)
            examples.append((vectors(found), np.array([teacher(path, has_article) for path, _, _ in found], float)))
    if not examples:
        return None
    labeller = Labeller()
    labeller.train(examples)
    return labeller


def sample(pages: DataFrame, id_col: str = "page_id", n: int = SAMPLE_PAGES) -> list[str]:
    """At most ``n`` pages, those with the least id hashes."""
    ids = pages.where(F.col("html").isNotNull()).select(F.col(id_col).alias("id")).orderBy(F.xxhash64("id"), "id").limit(n)
    chosen = [r["id"] for r in ids.collect()]
    rows = pages.where(F.col(id_col).isin(chosen)).select(F.col(id_col).alias("id"), "html")
    return [r["html"] for r in rows.orderBy("id", "html").limit(n).collect() if r["html"]]


def main_text(pages: DataFrame, id_col: str = "page_id", labeller: Labeller | None = None) -> DataFrame:
    """``pages`` with a column ``text``: the main text of ``html`` (a column of that name is replaced)."""
    labeller = labeller or train(sample(pages, id_col))

    def of(parts: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for part in parts:
            read = [blocks(page) for page in part]
            if labeller is None:
                yield pd.Series([""] * len(read))
                continue
            labels = labeller.label([vectors(b) for b in read])
            yield pd.Series(["\n".join(t for (_, t, _), on in zip(b, ok) if on) for b, ok in zip(read, labels)])

    return pages.withColumn("text", F.pandas_udf(of, "string")(F.col("html")))
