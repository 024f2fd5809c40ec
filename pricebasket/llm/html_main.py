"""Main text of web pages as the best-scoring run of words and tags.

Words score positive and tags negative. A linear scan finds the contiguous run of greatest sum. The weights
come from labelled pages, those with an article or main element: how many of the words below an element
of some kind (its name and first class or id) are content there. A word weighs the least share of the
elements that are open at it; a tag costs the more, the less its kind holds content.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from html import unescape

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pricebasket.llm import batches
from pricebasket.session import stage

# Fixed values of HTML: elements without an end, elements whose content is no markup, elements that break a block.
VOID = set("area base br col embed hr img input link meta param source track wbr".split())
RAW = set("script style noscript template textarea iframe noembed noframes xmp svg math".split())
BLOCK = set(
    "address article aside blockquote body br caption center dd details dialog div dl dt fieldset figcaption figure footer form"
    " h1 h2 h3 h4 h5 h6 header hgroup hr html li main menu nav ol p pre section summary table tbody td tfoot th thead title tr ul".split())
CLOSES_P = BLOCK - {"br"}
LABELS = {"article", "main"}
# What a kind is taken for before any labelled page speaks of it.
BOILER = set("nav footer aside header form button select option label head title dialog menu figcaption".split()) | RAW
BOILER_NAME = re.compile(
    r"(?:^|[-_])(?:ads?|advert\w*|banner|breadcrumbs?|comments?|cookies?|disqus|footer|header|login|menu|modal|nav\w*|newsletter"
    r"|notices?|popup|promo\w*|recommend\w*|related|share|sharing|sidebar|social|sponsor\w*|subscribe|toolbar|widget)(?:$|[-_])", re.I)

TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)|<!\[CDATA\[.*?(?:\]\]>|\Z)|<[!?][^>]*>|<(/?)([a-zA-Z][a-zA-Z0-9:_-]*)((?:[^'\">]|\"[^\"]*\"|'[^']*')*)>", re.S)
NAME = re.compile(r"(?:^|\s)(class|id)\s*=\s*(?:\"\s*([^\"\s]+)[^\"]*\"|'\s*([^'\s]+)[^']*'|([^\s\"'>]+))", re.I)

#: A word must weigh as much to be put out, a run as much to be taken; what a tag of no content costs.
KEEP, ENOUGH, COST, STEP = 0.3, 0.5, 2.0, 0.01
#: Labelled pages and kinds of elements that the weights come from, at most.
PAGES, KINDS = 2_000, 5_000


class Part:
    """A piece of text or a tag, with the kinds of the elements that are open at it."""

    __slots__ = ("text", "kind", "breaks", "open", "label")

    def __init__(self, text, kind, breaks, open_, label):
        self.text, self.kind, self.breaks, self.open, self.label = text, kind, breaks, open_, label


def parts(html: str) -> Iterator[Part]:
    stack: list[tuple[str, str]] = []
    kinds: tuple[str, ...] = ()
    label = 0
    at = 0
    while at < len(html):
        found = TOKEN.search(html, at)
        text = html[at : found.start() if found else len(html)]
        if text and not text.isspace():
            yield Part(unescape(text), "", False, kinds, label > 0)
        elif text:
            yield Part(" ", "", False, kinds, label > 0)
        if not found:
            return
        at = found.end()
        name = (found[2] or "").lower()
        if not name:
            continue
        if found[1]:
            if any(name == open_ for open_, _ in stack):
                while True:
                    open_, kind = stack.pop()
                    label -= open_ in LABELS
                    if open_ == name:
                        break
                kinds = tuple(kind for _, kind in stack)
                yield Part("", kind, name in BLOCK, kinds, label > 0)
            continue
        if name in CLOSES_P or name in LABELS:
            closing = "p" if any(open_ == "p" for open_, _ in stack) else ""
            if name == "li" and any(open_ == "li" for open_, _ in stack[-2:]):
                closing = "li"
            if closing and name not in VOID:
                while True:
                    open_, _ = stack.pop()
                    label -= open_ in LABELS
                    if open_ == closing:
                        break
        kind = name
        if found[3]:
            attribute = NAME.search(found[3])
            if attribute:
                kind = f"{name}.{(attribute[2] or attribute[3] or attribute[4]).lower()}"
        kinds = tuple(open_kind for _, open_kind in stack)
        if name in RAW:
            end = re.compile(rf"</{re.escape(name)}\s*>", re.I).search(html, at)
            at = end.end() if end else len(html)
            yield Part("", kind, False, kinds, label > 0)
            continue
        yield Part("", kind, name in BLOCK, kinds, label > 0)
        if name not in VOID:
            stack.append((name, kind))
            label += name in LABELS
            kinds = (*kinds, kind)


def counted(html: str) -> Counter:
    """Words below elements of each kind, inside and outside the labelled element.

    Where an element is open that is taken for no content anyway, such as a menu, its words say nothing
    about the plain lists and links in it.
    """
    found: Counter = Counter()
    for part in parts(html):
        if part.text:
            n = len(part.text.split())
            known = {kind for kind in part.open if prior(kind) < 0.5}
            for kind in known or set(part.open):
                found[(kind, part.label)] += n
    return found


def prior(kind: str) -> float:
    name, _, mark = kind.partition(".")
    return 0.02 if name in BOILER or (mark and BOILER_NAME.search(mark)) else 0.9


class Weights:
    """A kind's share of content: labelled words, and a prior worth ``trust`` words."""

    def __init__(self, counts: dict[str, tuple[int, int]], trust: float = 20.0):
        self.counts, self.trust, self._known = counts, trust, {}

    def share(self, kind: str) -> float:
        if kind not in self._known:
            inside, outside = self.counts.get(kind, (0, 0))
            if kind.partition(".")[0] in LABELS | {"html", "body"}:
                found = 1.0
            else:
                found = (inside + self.trust * prior(kind)) / (inside + outside + self.trust)
            if len(self._known) > 100_000:
                self._known.clear()
            self._known[kind] = found
        return self._known[kind]

    def word(self, open_: tuple[str, ...]) -> float:
        return min(map(self.share, open_), default=0.5)


def main_text(html: str | None, weights: Weights) -> str:
    """The words of the best run, blocks on lines of their own; empty if no run has enough."""
    if not html:
        return ""
    pieces = list(parts(html))
    scores, weight_of = [], {}
    for piece in pieces:
        if piece.text:
            weight = weight_of.get(piece.open)
            if weight is None:
                weight = weight_of[piece.open] = weights.word(piece.open)
            scores.append(weight * len(piece.text.split()))
        else:
            scores.append(-STEP - COST * (1 - weights.share(piece.kind)))
    best, first, last, total, start = 0.0, 0, 0, 0.0, 0
    for i, score in enumerate(scores):
        if total <= 0:
            total, start = 0.0, i
        total += score
        if total > best:
            best, first, last = total, start, i + 1
    if best < ENOUGH:
        return ""
    blocks: list[list[str]] = [[]]
    for piece in pieces[first:last]:
        if piece.breaks:
            blocks.append([])
        elif piece.text and weight_of[piece.open] >= KEEP:
            blocks[-1].append(piece.text)
    lines = (" ".join("".join(block).split()) for block in blocks)
    return "\n".join(line for line in lines if line)


def train(pages: DataFrame, most_pages: int = PAGES, most_kinds: int = KINDS) -> Weights:
    """Weights from at most ``most_pages`` distinct labelled pages, those of the least hash of page_id and html.

    Only hashes are sorted to choose them. Each task counts those among its own pages where it reads them, so no
    page moves; a page that comes again counts once. At most ``most_kinds`` kinds, the ones with the most
    words, come to the driver.
    """
    labelled = pages.filter(F.lower("html").rlike(r"<(?:article|main)[\s>]")).withColumn("key", F.xxhash64("page_id", "html"))
    first = stage(labelled.select("key").distinct().orderBy("key").limit(most_pages), "labelled")  # at most most_pages numbers
    chosen = labelled.select("key", "html").join(F.broadcast(first), "key", "left_semi")

    def count(some: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        seen: set[int] = set()
        for batch in some:
            for key, html in zip(batch["key"].tolist(), batch["html"].tolist()):
                if key not in seen:
                    seen.add(key)
                    found = counted(html)
                    kinds = list(dict.fromkeys(kind for kind, _ in found))
                    if kinds:
                        yield pd.DataFrame({
                            "key": key, "kind": kinds, "inside": [found[kind, True] for kind in kinds],
                            "outside": [found[kind, False] for kind in kinds]})

    each = chosen.mapInPandas(batches.released(count), "key long, kind string, inside long, outside long").dropDuplicates(["key", "kind"])
    sums = (
        each.groupBy("kind")
        .agg(F.sum("inside").alias("inside"), F.sum("outside").alias("outside"))
        .orderBy((F.col("inside") + F.col("outside")).desc(), "kind").limit(most_kinds)
    )
    return Weights({r["kind"]: (r["inside"], r["outside"]) for r in sums.collect()})


def extract(pages: DataFrame, **bounds) -> DataFrame:
    """The main text of every row of ``pages`` (page_id, url, html), from the whole html.

    Result, one row per input row: page_id, url, text, n_chars (code points). Character references are decoded;
    white space within a block becomes one blank, blocks are joined by a line break. A page that is null,
    empty or without a run of words that weighs enough has an empty text. Markup that is cut off
    or unbalanced is read as browsers do in the main: a tag that never ends is text, an end without a
    start is ignored. Without labelled pages the prior weights hold. Rows with a null or repeated
    page_id are pages of their own; of runs that score alike the first is taken. Other columns are ignored.
    """
    rows = pages.select("page_id", F.col("url").cast("string"), F.col("html").cast("string"))
    weights = train(rows, **bounds)

    def texts(htmls: list[str | None]) -> dict:
        found = [main_text(html, weights) for html in htmls]
        return {"text": found, "n_chars": [len(text) for text in found]}

    return batches.with_columns(rows, ["html"], texts, "text string, n_chars long", ("html",))
