"""Main text of HTML pages by the maximum-scoring contiguous run of tokens.

A page is cut into tags and words. Words score positive, but negative inside an
element whose words are mostly outside the main text; tags score negative, the
more the rarer they are inside it. Both sets of weights are learned from labelled
pages: those with exactly one <article>, whose inside is the main text. Counts
are summed by Spark over all pages; the elements and class words that may carry a
weight are fixed lists, so the table of weights has a fixed bound. One linear scan
then finds the best run, and the blocks in it, without what sits in negative
elements, are the text.

Defined results: a null or empty page, or one without words, gives the empty
string; unclosed elements end with their parent; comments, scripts and styles are
dropped before scoring, also when they are not closed.
"""

from __future__ import annotations

import html as entities
import math
import re

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shelfcast.llm.shipping import append_column, map_arrow

_PARTS = re.compile(
    r"<!--.*?(?:-->|\Z)|<(script|style|noscript|template|svg|iframe|object|textarea|select)\b.*?(?:</\1\s*>|\Z)"
    r"|<!\[CDATA\[.*?\]\]>|<[!?][^>]*>|<(/?)([a-zA-Z][a-zA-Z0-9]*)((?:[^>\"']|\"[^\"]*\"|'[^']*')*)>|([^<]+|<)",
    re.S | re.I,
)
_NAMES = re.compile(r"""\b(?:class|id|role)\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s>]+))""", re.I)

#: Elements that end a block, that have no content, and elements and class words that mark other content.
BLOCKS = frozenset(
    "address article aside blockquote body br caption center dd details dialog div dl dt fieldset figcaption figure "
    "footer form h1 h2 h3 h4 h5 h6 header hr html li main nav ol option p pre section summary table tbody td tfoot th "
    "thead tr ul".split()
)
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
ASIDE = frozenset("nav header footer aside form menu button dialog head title".split())
MARKS = (
    "ad ads advert advertisement banner sponsor sponsored promo nav navigation menu breadcrumb sidebar footer header "
    "masthead comment comments cookie consent notice popup modal subscribe newsletter share social related recommended "
    "pagination form login search widget"
).split()
_MARK = frozenset(MARKS)


def _key(name: str, attributes: str) -> str:
    """The element, with the first class word that marks other content."""
    if attributes:
        for m in _NAMES.finditer(attributes):
            for word in re.split(r"[^a-z]+", (m[1] or m[2] or m[3] or "").lower()):
                if word in _MARK:
                    return f"{name}.{word}"
    return name


#: What an aside element within main text costs, and log odds of words from which an element counts as main text.
ASIDE_COST, HOST = 0.5, 1.0


def tokens(page: str):
    """("open" | "close", element, key) and ("text", raw text, "") in page order."""
    for m in _PARTS.finditer(page):
        if m[5] is not None:
            yield "text", m[5], ""
        elif m[3]:
            name = m[3].lower()
            yield ("close", name, name) if m[2] else ("open", name, _key(name, m[4]))


def _walk(page: str):
    """Every token with the keys of the elements it is in."""
    stack: list[tuple[str, str]] = []
    for kind, name, key in tokens(page):
        if kind == "close":
            for i in range(len(stack) - 1, -1, -1):
                if stack[i][0] == name:
                    del stack[i:]
                    break
            yield kind, name, key, stack
        else:
            yield kind, name, key, stack
            if kind == "open" and name not in VOID:
                if name in ("p", "li") and stack and stack[-1][0] == name:
                    stack.pop()
                stack.append((name, key))


def learn(pages: DataFrame, html: str = "html") -> dict[str, tuple[float, float]]:
    """Per element key: (words, tags) log odds of being main text on the labelled pages."""

    def count(batches):
        total: dict[tuple[str, int], list[int]] = {}
        for batch in batches:
            for page in batch.column(0).to_pylist():
                if not page or len(re.findall(r"<article[\s>]", page, re.I)) != 1:
                    continue
                inside = 0
                for kind, name, key, stack in _walk(page):
                    main = int(any(n == "article" for n, _ in stack))
                    if kind == "text":
                        n = len(name.split())
                        for k in {k for e, k in stack if e not in ("html", "body", "article")}:
                            total.setdefault((k, 0), [0, 0])[main] += n
                    else:
                        total.setdefault((key, 1), [0, 0])[main and name != "article"] += 1
                    inside += main
        if total:
            yield pa.RecordBatch.from_arrays(
                [pa.array([k for k, _ in total]), pa.array([t for _, t in total], pa.int32()), *(pa.array([v[j] for v in total.values()], pa.int64()) for j in (0, 1))],
                ["k", "t", "other", "main"],
            )

    rows = map_arrow(pages.select(F.col(f"`{html}`")), count, "k string, t int, other bigint, main bigint")
    known = [e for e in sorted(BLOCKS | VOID | ASIDE | frozenset("a b i em strong span small code font u s sub sup q cite abbr".split()))]
    allowed = known + [f"{e}.{m}" for e in known for m in MARKS]
    summed = rows.filter(F.col("k").isin(allowed)).groupBy("k", "t").agg(F.sum("other").alias("o"), F.sum("main").alias("m"))
    weights: dict[str, list[float]] = {}
    for k, t, o, m in summed.collect():
        weights.setdefault(k, [0.0, 0.0])[t] = math.log((m + 0.5) / (o + 0.5))
    return {k: (w, t) for k, (w, t) in weights.items()}


def best_run(score: list[float]) -> tuple[int, int]:
    """Bounds of the contiguous run with the greatest sum, the first and shortest among equals; empty if none is positive."""
    best, begin, end, running, start = 0.0, 0, 0, 0.0, 0
    for i, s in enumerate(score):
        if running <= 0:
            running, start = 0.0, i
        running += s
        if running > best:
            best, begin, end = running, start, i + 1
    return begin, end


def extract(page: str | None, weights: dict[str, tuple[float, float]]) -> str:
    """The page's main text, blocks joined by line feeds.

    An aside element within main text costs ASIDE_COST whatever it holds, so
    that an advert or a form of any length is left out without ending the run;
    elsewhere its words count against the run.
    """
    if not page:
        return ""

    def is_aside(name: str, key: str) -> bool:
        if name in ("html", "body", "article", "main"):
            return False
        words = weights.get(key, (0.0, 0.0))[0]
        # Marked elements are aside unless their words are mostly main text; others need clear evidence.
        return words < -2 or (name in ASIDE or "." in key) and words <= 0

    def is_host(name: str, key: str) -> bool:
        return name in ("article", "main") or name not in ("html", "body") and weights.get(key, (0.0, 0.0))[0] > HOST

    def place(stack) -> tuple[bool, bool]:
        """Is the innermost element aside, and if so, within main text."""
        host = False
        for name, key in stack:
            if is_aside(name, key):
                return True, host
            host = host or is_host(name, key)
        return False, False

    items, score, hosted = [], [], False
    for kind, name, key, stack in _walk(page):
        out, inside = place(stack)
        if kind == "text":
            items.append(("text", name, out))
            n = len(name.split())
            score.append(0.0 if inside else -n if out else n)
        else:
            items.append((kind, name, False))
            odds = weights.get(key, (0.0, -1.0))[1]
            cost = 0.01 if odds > 0 else min(8.0, 0.1 - odds)
            if inside or hosted:
                cost = 0.0  # within the element, or its end
            elif kind == "open" and place([*stack, (name, key)])[1]:
                cost = min(cost, ASIDE_COST)
            score.append(-cost)
        hosted = inside
    begin, end = best_run(score)
    blocks, block = [], []

    def close():
        text = " ".join(entities.unescape("".join(block)).split())
        if text:
            blocks.append(text)
        block.clear()

    for kind, name, out in items[begin:end]:
        if kind == "text":
            if not out:
                block.append(name)
        elif name in BLOCKS:
            close()
    close()
    return "\n".join(blocks)


def main_text(pages: DataFrame, html: str = "html", out: str = "main_text") -> DataFrame:
    """`pages` with the main text, by weights learned from all of its labelled pages."""
    sent = pages.sparkSession.sparkContext.broadcast(learn(pages, html))

    def texts(column: pa.Array) -> pa.Array:
        return pa.array([extract(p, sent.value) for p in column.to_pylist()], pa.string())

    return append_column(pages, html, out, "string", texts, rows=500)
