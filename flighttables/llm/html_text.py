"""Main text of web pages by a maximum-scoring region.

A page is a sequence of tags and words.  Each gets a weight: the log odds that it stands inside the content,
learned from pages that label their content themselves (an ``article`` or ``main`` element), on top of prior
counts that make words positive and tags negative.  Words are told apart by where they stand: in plain text,
in links, or in a part that is boilerplate by its element, role, class or id.  One linear scan finds the contiguous
region of the greatest total weight.  The text is that of the region's blocks, without the boilerplate parts in it.
"""

from __future__ import annotations

import html
import math
import re
from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from flighttables.llm._common import blocks, in_arrow

# Names of HTML elements and of usual page parts.
RAW = {"script", "style", "textarea", "title", "noscript", "template", "iframe", "noembed", "noframes", "xmp"}
VOID = {"area", "base", "br", "col", "embed", "hr", "img", "input", "link", "meta", "param", "source", "track", "wbr"}
INLINE = {"a", "abbr", "acronym", "b", "bdi", "bdo", "big", "cite", "code", "data", "del", "dfn", "em", "font", "i", "img", "ins",
          "kbd", "mark", "q", "rp", "rt", "ruby", "s", "samp", "small", "span", "strike", "strong", "sub", "sup", "time", "tt", "u",
          "var", "wbr"}
CONTENT = {"article", "main"}
BOILERPLATE = {"nav", "footer", "aside", "form", "button", "select", "dialog", "menu", "svg", "object", "audio", "video", "canvas", "head"}
ROLES = {"navigation", "banner", "contentinfo", "complementary", "search", "form", "alert", "dialog", "menu", "menubar", "note", "status"}
NAMES = {"ad", "ads", "advert", "adverts", "advertisement", "advertising", "banner", "breadcrumb", "breadcrumbs", "comment",
         "comments", "consent", "cookie", "cookies", "disqus", "footer", "gdpr", "header", "login", "masthead", "menu", "modal",
         "nav", "navbar", "navigation", "newsletter", "notice", "notices", "pager", "pagination", "popup", "promo", "related",
         "replies", "reply", "respond", "share", "sharing", "sidebar", "signup", "social", "sponsor", "sponsored", "subscribe",
         "toolbar", "widget"}

_MARKUP = re.compile(r"""<(?:!--(?:>|->|[\s\S]*?(?:--!?>|\Z))|[!?][^>]*(?:>|\Z)|(/?)([a-zA-Z][^\s/>]*)((?:[^"'>]|"[^"]*"|'[^']*')*+)>|(/?)([a-zA-Z][^\s/>]*)([^>]*)>)""")
_ATTRIBUTE = re.compile(r"""([^\s"'>/=]+)(?:\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+)))?""")
_NAME_WORD = re.compile(r"[a-z]+")

#: Prior counts (inside, outside) of a word in plain text, in a link, in boilerplate, and of any tag.
PRIOR = {"word": (20.0, 10.0), "link": (5.0, 15.0), "boilerplate": (1.0, 30.0), "tag": (4.0, 9.0)}


def _attributes(text: str) -> dict[str, str]:
    return {k.lower(): a or b or c for k, a, b, c in _ATTRIBUTE.findall(text)}


def _is_boilerplate(tag: str, attributes: str, inside_content: bool) -> bool:
    if tag in BOILERPLATE or (tag == "header" and not inside_content):
        return True
    if tag in CONTENT or tag in ("html", "body") or not attributes or attributes.isspace():
        return False
    found = _attributes(attributes)
    if "hidden" in found or found.get("role", "").lower() in ROLES or "display:none" in found.get("style", "").replace(" ", "").lower():
        return True
    if tag in INLINE:
        return False
    return not NAMES.isdisjoint(_NAME_WORD.findall((found.get("class", "") + " " + found.get("id", "")).lower()))


class Item:
    """A tag, or the text up to the next one."""

    __slots__ = ("kind", "words", "text", "breaks", "labelled", "dropped")

    def __init__(self, kind, words, text, breaks, labelled, dropped):
        self.kind, self.words, self.text, self.breaks, self.labelled, self.dropped = kind, words, text, breaks, labelled, dropped


def items_of(page: str) -> list[Item]:
    """Tags and texts in page order, with where they stand.  Anything that is no markup by its form is text."""
    out: list[Item] = []
    stack: list[tuple[str, bool, bool]] = []  # tag, boilerplate, content
    dropped, content, link, at = 0, 0, 0, 0
    while True:
        m = _MARKUP.search(page, at)
        text = page[at:m.start() if m else len(page)]
        if text:
            text = html.unescape(text)
            n = len(text.split())
            kind = "boilerplate" if dropped else "link" if link else "word"
            out.append(Item(kind, n, text, False, content > 0, dropped > 0))
        if not m:
            return out
        at = m.end()
        tag = m[2] or m[5]
        if not tag:
            continue
        tag = tag.lower()
        closing, attributes = bool(m[1] or m[4]), (m[3] if m[2] else m[6]) or ""
        if closing:
            depth = next((i for i in range(len(stack) - 1, -1, -1) if stack[i][0] == tag), None)
            if depth is not None and not (tag in INLINE and any(t not in INLINE for t, _, _ in stack[depth + 1:])):
                for t, bad, good in stack[depth:]:
                    dropped, content, link = dropped - bad, content - good, link - (t == "a")
                del stack[depth:]
            out.append(Item("/" + tag, 0, "", tag not in INLINE, content > 0, dropped > 0))
            continue
        bad = _is_boilerplate(tag, attributes, content > 0)
        out.append(Item(tag, 0, "", tag not in INLINE, content > 0, bad or dropped > 0))
        if tag in RAW:
            if not attributes.endswith("/"):
                end = re.compile(rf"</{re.escape(tag)}(?=[\s/>]|\Z)[^>]*(?:>|\Z)", re.I).search(page, at)
                at = end.end() if end else len(page)
            continue
        if tag in VOID or (attributes.endswith("/") and tag in INLINE):
            continue
        if tag not in INLINE and tag in ("p", "li", "dt", "dd", "tr", "td", "th", "option", "h1", "h2", "h3", "h4", "h5", "h6"):
            _close_implied(stack, tag)
        stack.append((tag, bad, tag in CONTENT))
        dropped, content, link = dropped + bad, content + (tag in CONTENT), link + (tag == "a")


def _close_implied(stack: list[tuple[str, bool, bool]], tag: str) -> None:
    """A new ``p`` closes an open one, and so on; only parts that are no boilerplate, so no count changes."""
    for i in range(len(stack) - 1, -1, -1):
        t, bad, good = stack[i]
        if bad or good or t == "a":
            return
        if t == tag:
            del stack[i:]
            return
        if t not in INLINE:
            return


def feature(item: Item) -> str:
    """What the weight of a tag or a word goes by; ``div`` and the like in boilerplate are told from others."""
    return f"{item.kind} in boilerplate" if item.dropped and item.kind != "boilerplate" else item.kind


def weight(inside: float, outside: float, kind: str) -> float:
    a, b = PRIOR[kind if kind in PRIOR else "boilerplate" if kind.endswith("boilerplate") else "tag"]
    return math.log((inside + a) / (outside + b))


def label_counts(page: str, inside: Counter, outside: Counter) -> None:
    """Add the words and tags of a page that labels its content."""
    items = items_of(page)
    if any(i.labelled for i in items):
        for i in items:
            if n := i.words if i.text else 1:
                (inside if i.labelled and not i.dropped else outside)[feature(i)] += n


def best_region(scores: list[float]) -> tuple[int, int]:
    """``[start, stop)`` of the greatest sum, the first and shortest of equal ones; (0, 0) if none is positive."""
    best, start, stop, total, begin = 0.0, 0, 0, 0.0, 0
    for i, s in enumerate(scores):
        if total <= 0:
            total, begin = 0.0, i
        total += s
        if total > best:
            best, start, stop = total, begin, i + 1
    return start, stop


def main_text(page: str | None, weights: dict[str, float]) -> str:
    """Text of the best region: its blocks, white space made one space, trimmed, joined by a line feed."""
    if not page:
        return ""
    items = items_of(page)
    scores = []
    for i in items:
        k = feature(i)
        w = weights.get(k)
        if w is None:
            w = weights[k] = weight(0, 0, k)
        # boilerplate within a content element is cut out below; it does not part what stands around it
        scores.append(0.0 if i.labelled and i.dropped else w * (i.words if i.text else 1))
    start, stop = best_region(scores)
    while stop < len(items) and items[stop].text and not items[stop].dropped and not items[stop].words:
        stop += 1
    found, block = [], []
    for i in items[start:stop]:
        if i.breaks:
            found.append("".join(block))
            block = []
        elif i.text and not i.dropped:
            block.append(i.text)
    found.append("".join(block))
    return "\n".join(t for b in found if (t := " ".join(b.split())))


def learn_weights(pages: DataFrame, max_train: int, id_col: str, html_col: str) -> dict[str, float]:
    """Weights from at most ``max_train`` pages (those with the least id hash) as far as they label their content."""
    ids = pages.select(pages[id_col].alias("id")).where("id is not null").distinct().orderBy(F.xxhash64("id"), "id").limit(max_train)
    ids = pages.sparkSession.createDataFrame(ids.collect(), ids.schema)
    chosen = pages.select(pages[id_col].alias("id"), pages[html_col].alias("text")).join(F.broadcast(ids), "id").select("text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        inside, outside = Counter(), Counter()
        for b in batches:
            for page in b.column("text").to_pylist():
                if page:
                    label_counts(page, inside, outside)
        kinds = sorted(inside.keys() | outside.keys())
        yield pa.RecordBatch.from_arrays([pa.array(kinds, pa.string()), pa.array([inside[k] for k in kinds], pa.int64()),
                                          pa.array([outside[k] for k in kinds], pa.int64())], names=["kind", "i", "o"])

    got = in_arrow(chosen, run, "kind string, i long, o long").groupBy("kind").agg(F.sum("i").alias("i"), F.sum("o").alias("o"))
    return {r["kind"]: weight(r["i"], r["o"], r["kind"]) for r in got.collect()}


def extract_text(pages: DataFrame, max_train: int = 1000, id_col: str = "page_id", html_col: str = "html",
                 also: tuple[str, ...] = ("url",)) -> DataFrame:
    """One row per page: id, the columns ``also``, ``text`` of the content ("" if none) and ``n_chars`` (code points).

    Null and empty pages have no text; broken markup is read as far as it goes (an unclosed comment or script ends
    with the page).  Without labelled pages the prior weights hold.  Repeated rows give equal rows; other columns are
    not read.
    """
    weights = pages.sparkSession.sparkContext.broadcast(learn_weights(pages, max_train, id_col, html_col))  # a float per kind of tag

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = dict(weights.value)
        for b in blocks(batches, "_html"):
            texts = [main_text(p, known) for p in b.column("_html").to_pylist()]
            yield pa.RecordBatch.from_arrays([*b.columns[1:], pa.array(texts, pa.string()), pa.array(list(map(len, texts)), pa.int64())],
                                             names=[*b.schema.names[1:], "text", "n_chars"])

    rows = pages.select(pages[html_col].alias("_html"), *[pages[c].alias(c) for c in (id_col, *also)])
    kept = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in rows.schema.fields[1:])
    return in_arrow(rows, run, f"{kept}, text string, n_chars long")
