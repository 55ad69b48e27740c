"""Main text of web pages: a linear-chain CRF over DOM leaf blocks.

A page is cut into leaf blocks: runs of text between block-level tags, each with the tags, classes, ids and
roles of its ancestors.  The chain's states are *main* and *other*; emissions are sparse weights of
ancestor and text features, transitions are learned with them, and Viterbi decodes a page at once.

The CRF is trained on labelled pages: layouts whose regions are known (articles with menus, notices, adverts,
comments and so on in and around them), filled with texts of a bounded sample of the pages themselves.
"""

from __future__ import annotations

import html
import random
import re
from collections.abc import Iterator
from dataclasses import dataclass, field
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Pages (distinct) whose texts fill the training layouts, and texts kept of each.
SAMPLE_PAGES, TEXTS_PER_PAGE = 200, 12
TRAINING_PAGES = 500
EPOCHS, RATE, DECAY = 150, 0.15, 1e-4

# Fixed values of HTML: elements by their role in the cutting of a page.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style noscript template textarea iframe svg title".split())
BLOCK = frozenset("""address article aside blockquote body button caption center dd details dialog dir div dl dt
 fieldset figcaption figure footer form frameset h1 h2 h3 h4 h5 h6 head header hgroup hr html li legend main menu nav
 ol optgroup option p pre section select summary table tbody td tfoot th thead tr ul""".split())
CLOSES = {"li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"},
          "th": {"td", "th"}, "option": {"option"}, "tbody": {"tr", "td", "th", "thead", "tbody"}}
ENDS_P = BLOCK - {"button", "option", "optgroup", "legend", "summary", "caption", "body", "head", "html"}
LISTS = {"li": {"ul", "ol", "menu"}, "dt": {"dl"}, "dd": {"dl"}, "tr": {"table"}, "td": {"table"}, "th": {"table"},
         "option": {"select"}, "tbody": {"table"}}

#: Elements whose content is skipped, but that do not take the rest of a page with them when they stay open.
NESTED = frozenset("svg template noscript".split())

#: Comments, declarations and tags.  A quote opens a value only right after the equals sign; elsewhere, also in a
#: value without quotes, it is a sign like any other.
PIECE = re.compile(
    r"""<!--.*?(?:-->|\Z)|<[!?][^>]*(?:>|\Z)"""
    r"""|<(/?)([a-zA-Z][^\s/>]*)((?:[^>=]++|=\s*+(?:"[^"]*+"|'[^']*+'|[^\s"'>][^\s>]*+)?)*+)(?:>|\Z)""", re.S)
ATTRIBUTE = re.compile(r"""\b(class|id|role)\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+))""", re.I)
NAME = re.compile(r"[a-z]+")
SPACE = re.compile(r"\s+")


@dataclass
class Block:
    """A leaf block: its text (references decoded, white space joined), ancestors and linked signs."""

    text: str
    path: tuple[tuple[str, tuple[str, ...]], ...]
    linked: float


def names_of(attributes: str) -> tuple[str, ...]:
    """Lower-case words of class, id and role."""
    if "=" not in attributes:
        return ()
    out: list[str] = []
    for _, *values in ATTRIBUTE.findall(attributes):
        out += NAME.findall("".join(values).lower())
    return tuple(dict.fromkeys(out))


def blocks_of(page: str | None) -> list[Block]:
    """Leaf blocks in page order.  Unclosed and misnested elements end where HTML ends them or with
    their parent; comments, raw-text elements and the head's title give no text."""
    out: list[Block] = []
    stack: list[tuple[str, tuple[str, ...]]] = []
    parts: list[str] = []
    linked = links = 0
    at, text = 0, page or ""

    def flush() -> None:
        nonlocal linked
        if parts:
            joined = SPACE.sub(" ", html.unescape("".join(parts))).strip()
            if joined:
                out.append(Block(joined, tuple(stack), min(1.0, linked / len(joined))))
            parts.clear()
        linked = 0

    def pop_to(depth: int) -> None:
        nonlocal links
        if any(t in BLOCK for t, _ in stack[depth:]):
            flush()
        links -= sum(t == "a" for t, _ in stack[depth:])
        del stack[depth:]

    while True:
        m = PIECE.search(text, at)
        raw = text[at:m.start()] if m else text[at:]
        if raw:
            parts.append(raw)
            if links:
                linked += len(raw)
        if not m:
            break
        at = m.end()
        tag = m.group(2)
        if not tag:
            continue
        tag = tag.lower()
        if m.group(1):
            for depth in range(len(stack) - 1, -1, -1):
                if stack[depth][0] == tag:
                    pop_to(depth)
                    break
            else:
                if tag in BLOCK:
                    flush()
            continue
        if tag in RAW:
            if not (tag == "svg" and m.group(3).rstrip().endswith("/")):
                at = _skipped(text, tag, at)
            continue
        if tag == "br":
            parts.append(" ")
            continue
        if tag in BLOCK:
            flush()
            if tag in ENDS_P:
                _close(stack, {"p"}, BLOCK - {"p"}, pop_to)
            if tag in CLOSES:
                _close(stack, CLOSES[tag], LISTS[tag], pop_to)
        if tag not in VOID and not m.group(3).rstrip().endswith("/"):
            stack.append((tag, names_of(m.group(3))))
            links += tag == "a"
    flush()
    return out


@lru_cache(maxsize=64)
def _tags_of(tag: str) -> re.Pattern:
    return re.compile(f"<(/?){tag}(?=[\\s/>])[^>]*>?", re.I)


def _skipped(text: str, tag: str, at: int) -> int:
    """Where the content of the raw element ``tag`` that begins at ``at`` ends: after its own end tag (NESTED ones may
    hold their like); without one, at the end of the page, or of NESTED ones at once."""
    depth = 1
    for m in _tags_of(tag).finditer(text, at):
        if m.group(1):
            depth -= 1
        elif tag in NESTED and not m.group().rstrip(">").rstrip().endswith("/"):
            depth += 1
        if not depth:
            return m.end()
    return at if tag in NESTED else len(text)


def _close(stack, tags: set[str], until: set[str] | frozenset[str], pop_to) -> None:
    """End the outermost open element of ``tags`` inside the nearest one of ``until``."""
    found = None
    for depth in range(len(stack) - 1, -1, -1):
        if stack[depth][0] in tags:
            found = depth
        elif stack[depth][0] in until:
            break
    if found is not None:
        pop_to(found)


def features(blocks: list[Block]) -> list[list[str]]:
    """Feature names of every block of a page."""
    out = []
    for i, b in enumerate(blocks):
        tags = [t for t, _ in b.path]
        own = next((t for t in reversed(tags) if t in BLOCK), "none")
        names = {f"tag={own}"}
        names.update(f"in={t}" for t in tags if t in BLOCK)
        names.update(f"name={x}" for _, all_ in b.path for x in all_)
        regions = [t for t in tags if t in BLOCK and t not in ("p", "div", "li", "ul", "ol", "body", "html", "section")]
        names.add(f"region={regions[-1] if regions else 'none'}")
        n, words = len(b.text), b.text.count(" ") + 1
        names.add("linked" if b.linked > 0.5 else "plain")
        names.add(f"words={min(6, words.bit_length())}")
        names.add("sentence" if b.text[-1] in ".!?\"'”»…" else "fragment")
        if "©" in b.text or "all rights reserved" in b.text.lower():
            names.add("rights")
        if i == 0 or i == len(blocks) - 1:
            names.add("first" if i == 0 else "last")
        if n < 25:
            names.add("short")
        out.append(sorted(names))
    return out


@dataclass
class Crf:
    """Two states (0 other, 1 main): feature weights for main against other, and transitions."""

    weight: dict[str, float] = field(default_factory=dict)
    start: tuple[float, float] = (0.0, 0.0)
    step: tuple[tuple[float, float], tuple[float, float]] = ((0.0, 0.0), (0.0, 0.0))

    def viterbi(self, page: list[list[str]]) -> list[int]:
        """Best labels of a page's blocks (ties: other)."""
        get, back = self.weight.get, []
        a = b = 0.0
        (oo, om), (mo, mm) = self.step
        for i, names in enumerate(page):
            e = sum(get(x, 0.0) for x in names)
            if i == 0:
                a, b = self.start[0], self.start[1] + e
                continue
            other, main = (a + oo, b + mo), (a + om, b + mm)
            back.append((other[1] > other[0], main[1] > main[0]))
            a, b = max(other), max(main) + e
        if not page:
            return []
        out = [int(b > a)]
        for was in reversed(back):
            out.append(int(was[out[-1]]))
        return out[::-1]


def train(pages: list[list[list[str]]], labels: list[list[int]], epochs: int = EPOCHS) -> Crf:
    """Maximum likelihood with L2 decay: forward-backward over all pages at once, Adam steps."""
    number: dict[str, int] = {}
    longest, count = max(map(len, pages)), len(pages)
    row, col = [], []
    for p, page in enumerate(pages):
        for t, names in enumerate(page):
            ids = [number.setdefault(x, len(number)) for x in names]
            row += [p * longest + t] * len(ids)
            col += ids
    row, col = np.array(row), np.array(col)
    size = np.array([len(x) for x in pages])
    live = np.arange(longest) < size[:, None]
    gold = np.zeros((count, longest), np.int64)
    for p, y in enumerate(labels):
        gold[p, :len(y)] = y
    k = len(number)
    theta, m1, m2 = (np.zeros(k + 6) for _ in range(3))
    gold_w = np.bincount(col, gold.reshape(-1)[row], minlength=k)
    gold_start = np.bincount(gold[:, 0], minlength=2)
    both = live[:, 1:] & live[:, :-1]
    gold_step = np.bincount((gold[:, :-1] * 2 + gold[:, 1:])[both], minlength=4).reshape(2, 2)
    for epoch in range(1, epochs + 1):
        w, start, step = theta[:k], theta[k:k + 2], theta[k + 2:].reshape(2, 2)
        emit = np.zeros((count, longest, 2))
        emit[:, :, 1] = np.bincount(row, w[col], minlength=count * longest).reshape(count, longest)
        fwd, bwd = np.zeros_like(emit), np.zeros_like(emit)
        fwd[:, 0] = start + emit[:, 0]
        for t in range(1, longest):
            new = np.logaddexp.reduce(fwd[:, t - 1, :, None] + step, axis=1) + emit[:, t]
            fwd[:, t] = np.where(live[:, t, None], new, fwd[:, t - 1])
        for t in range(longest - 2, -1, -1):
            new = np.logaddexp.reduce(step + (emit[:, t + 1] + bwd[:, t + 1])[:, None, :], axis=2)
            bwd[:, t] = np.where(live[:, t + 1, None], new, 0.0)
        z = np.logaddexp.reduce(fwd[:, -1], axis=1)
        p1 = np.exp(fwd[:, :, 1] + bwd[:, :, 1] - z[:, None]) * live
        pair = np.exp(fwd[:, :-1, :, None] + step + (emit + bwd)[:, 1:, None, :] - z[:, None, None, None])
        grad = np.concatenate([
            gold_w - np.bincount(col, p1.reshape(-1)[row], minlength=k),
            gold_start - np.array([count - p1[:, 0].sum(), p1[:, 0].sum()]),
            (gold_step - (pair * both[:, :, None, None]).sum((0, 1))).reshape(-1)]) / count - DECAY * theta
        m1, m2 = 0.9 * m1 + 0.1 * grad, 0.999 * m2 + 0.001 * grad * grad
        theta = theta + RATE * (m1 / (1 - 0.9 ** epoch)) / (np.sqrt(m2 / (1 - 0.999 ** epoch)) + 1e-8)
    return Crf({x: float(theta[i]) for x, i in number.items()}, tuple(theta[k:k + 2].tolist()),
               tuple(map(tuple, theta[k + 2:].reshape(2, 2).tolist())))


# Regions of the training layouts: tag, class or id, and whether it is main text.
MAIN = [("article", ""), ("main", ""), ("div", "content"), ("div", "post"), ("section", "story"), ("div", "entry"),
        ("div", "article"), ("main", "main"), ("div", "text"), ("article", "post")]
OTHER = [("nav", ""), ("header", ""), ("footer", ""), ("aside", ""), ("form", ""), ("menu", ""),
         *(("div", x) for x in """ad ads advert advertisement advertising sponsored sponsor promo banner sidebar widget cookie cookies
 consent notice alert gdpr popup modal overlay comments comment respond replies reply discussion disqus newsletter subscribe signup
 login related recommended share social breadcrumb breadcrumbs pagination menu navigation navbar nav header footer masthead
 copyright toolbar search tags""".split()),
         ("section", "comments"), ("section", "comment"), ("ul", "comments"), ("ol", "comment"), ("ul", "menu"),
         ("aside", "sidebar"), ("p", "notice"), ("p", "ad"), ("div", "notice"), ("dialog", ""), ("section", "ad"),
         ("section", "related"), ("article", "comment")]


def training_page(rng: random.Random, texts: list[str]) -> tuple[str, list[int]]:
    """A labelled page: HTML, and the labels of its leaf blocks in order."""
    labels: list[int] = []

    def text(short: bool = False) -> str:
        t = rng.choice(texts)
        if short:
            t = " ".join(t.split(" ")[:rng.randint(1, 5)])
        return html.escape(t, quote=False) or "x"

    def leaf(tag: str, label: int, short: bool = False) -> str:
        labels.append(label)
        inner = text(short)
        if rng.random() < 0.15:
            inner = f"<b>{inner}" + ("</b>" if rng.random() < 0.5 else "<br>")
        return f"<{tag}>{inner}" + (f"</{tag}>" if rng.random() < 0.8 or tag not in ("p", "li") else "")

    def other() -> str:
        tag, name = rng.choice(OTHER)
        mark = f' {rng.choice(["class", "id"])}="{name}"' if name else ""
        kind = rng.random()
        if tag == "p":
            labels.append(0)
            body = text(rng.random() < 0.5)
        elif kind < 0.3 and tag not in ("form", "dialog"):
            body = ""
            for _ in range(rng.randint(1, 6)):
                labels.append(0)
                body += f'<li><a href="/x">{text(True)}</a></li>'
            body = body if tag in ("ul", "ol", "menu") else f"<ul>{body}</ul>"
        elif tag in ("ul", "ol", "menu"):
            body = "".join(leaf("li", 0, rng.random() < 0.5) for _ in range(rng.randint(1, 4)))
        elif kind < 0.6:
            labels.append(0)
            body = ("&copy; " if "foot" in tag + name and rng.random() < 0.8 else "") + text(rng.random() < 0.5)
        else:
            body = (leaf(rng.choice(("h1", "h2", "h3", "h4")), 0, True) if rng.random() < 0.5 else "") + "".join(
                leaf("p", 0, rng.random() < 0.3) for _ in range(rng.randint(1, 4)))
        return f"<{tag}{mark}>{body}</{tag}>"

    def main() -> str:
        out = leaf("h1", 1, rng.random() < 0.7) if rng.random() < 0.8 else ""
        for _ in range(rng.randint(1, 9)):
            kind = rng.random()
            if kind < 0.1:
                out += other()
            elif kind < 0.17:
                out += leaf("h2", 1, True)
            elif kind < 0.24:
                out += f"<ul>{''.join(leaf('li', 1, rng.random() < 0.5) for _ in range(rng.randint(1, 4)))}</ul>"
            elif kind < 0.3:
                out += f"<blockquote>{leaf('p', 1)}</blockquote>"
            elif kind < 0.33:
                out += f"<figure><img src='x'>{leaf('figcaption', 1, True)}</figure>"
            elif kind < 0.36:
                labels.append(1)
                out += f"<pre>{text(True)}</pre>"
            else:
                out += leaf("p", 1, rng.random() < 0.15)
        return out

    head = "".join(other() for _ in range(rng.randint(0, 3)))
    tag, name = rng.choice(MAIN[:1] * 8 + MAIN)
    bare = rng.random() < 0.08
    mark = f' {rng.choice(["class", "id"])}="{name}"' if name else ""
    body = main() if bare else f"<{tag}{mark}>{main()}</{tag}>"
    if rng.random() < 0.2:
        body = f'<div class="{rng.choice(["wrapper", "container", "page", "row"])}">{body}</div>'
    tail = "".join(other() for _ in range(rng.randint(0, 3)))
    return f"<html><head><title>t</title></head><body>{head}{body}{tail}</body></html>", labels


def _cut_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(h, first texts) of the batches' distinct pages."""
    seen: set[int] = set()
    for b in batches:
        new = {h: t for h, t in zip(b.column(0).to_pylist(), b.column(1).to_pylist()) if h not in seen}
        seen.update(new)
        texts = [[x.text[:2000] for x in blocks_of(t)[:TEXTS_PER_PAGE]] for t in new.values()]
        yield pa.RecordBatch.from_arrays([pa.array(new, pa.int64()), pa.array(texts, pa.list_(pa.string()))],
                                         names=["h", "texts"])


def sample_texts(pages: DataFrame, sample_pages: int = SAMPLE_PAGES) -> list[str]:
    """Texts of leaf blocks of the ``sample_pages`` distinct pages with the smallest hash of page_id and html (not empty).

    Repeated rows are one page; the blocks are cut on the executors, and only their texts, bounded in number
    and length, reach the driver.
    """
    h = F.xxhash64("page_id", "html")
    rows = pages.select("page_id", F.col("html").cast("string").alias("html")).filter("html <> ''").select(h.alias("h"), "html")
    least = rows.select("h").distinct().orderBy("h").limit(sample_pages)
    kept = rows.join(F.broadcast(least), "h").mapInArrow(_cut_batches, "h bigint, texts array<string>")
    out = [t for r in kept.groupBy("h").agg(F.min("texts").alias("texts")).orderBy("h").collect() for t in r.texts]
    return out or ["a line of text that says nothing."]


def fit(pages: DataFrame, sample_pages: int = SAMPLE_PAGES, seed: int = 11) -> Crf:
    """CRF trained on labelled layouts filled with the texts of a bounded sample of ``pages``."""
    texts, rng = sample_texts(pages, sample_pages), random.Random(seed)
    made = [training_page(rng, texts) for _ in range(TRAINING_PAGES)]
    cut = [(blocks_of(h), y) for h, y in made]
    kept = [(features(b), y) for b, y in cut if b and len(b) == len(y)]
    return train([x for x, _ in kept], [y for _, y in kept])


def extract(model: Crf, page: str | None) -> str:
    """Main text of a page: its main blocks, joined by line breaks (none: empty)."""
    blocks = blocks_of(page)
    return "\n".join(b.text for b, y in zip(blocks, model.viterbi(features(blocks))) if y)


def _extract_batches(batches: Iterator[pa.RecordBatch], sent) -> Iterator[pa.RecordBatch]:
    model = sent.value
    for b in batches:
        text = pa.array([extract(model, t) for t in b.column(2).to_pylist()], pa.string())
        yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), text], names=["page_id", "url", "text"])


def main_text(pages: DataFrame, model: Crf) -> DataFrame:
    """``(page_id, url, text, n_chars)`` for every row of ``pages(page_id, url, html)``.

    White space inside a block is one space, blocks are joined by one line break, nothing else is dropped or
    capped.  Defined cases: null and empty html and pages without main text have an empty text; html of any
    length is decoded as one chain; repeated rows are answered each; null ids and urls stay null; an empty
    table gives no rows; other columns are ignored.
    """
    sent = pages.sparkSession.sparkContext.broadcast(model)
    out = (pages.select(F.col("page_id").cast("bigint").alias("page_id"), F.col("url").cast("string").alias("url"),
                        F.col("html").cast("string").alias("html"))
           .mapInArrow(lambda x: _extract_batches(x, sent), "page_id bigint, url string, text string"))
    return out.withColumn("n_chars", F.length("text").cast("bigint"))
