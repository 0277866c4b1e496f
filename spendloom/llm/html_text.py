"""Main text of web pages by the maximum-scoring subsequence.

A page is read as a sequence of words and tags. Words score by the kind of
block they stand in and by whether they are link text, tags score below zero,
and the contiguous run with the largest sum, found in one linear scan, is the
content region (Pasternack and Roth 2009). Where the markup names the content,
the region's edges become those of the <article> that holds most of its words,
or of the <main> around it.

Weights come from labelled pages: pages with an <article> tell which words and
tags lie inside the content and which outside. A weight is the logarithm of
the two smoothed frequencies' ratio, counted over all labelled pages; the
smoothing is a prior (words +1, link words -1, tags -0.2) that also holds
where nothing is labelled.

Containers that are no article text never count: menus, headers, footers,
asides, forms, scripts, styles by their tag; sidebars, notices, adverts, comments by
their class, id or role, unless they hold an <article> or <main> that is not
named so itself, or, where a page has neither, FRAME_SHARE of its words.

Defined results: null or empty html, and pages without words outside such
containers, give empty text. Unclosed elements are closed where their parent
or the page ends; repeated rows are extracted each.
"""

from __future__ import annotations

import html
import math
import re
from collections import Counter

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from spendloom.llm.common import by_batch

_TOKEN = re.compile(r"<!--.*?(?:-->|\Z)|<[!?][^>]*(?:>|\Z)|<(/?)([a-zA-Z][a-zA-Z0-9:-]*)((?:\"[^\"]*\"|'[^']*'|[^>\"'])*+)(?:>|\Z)", re.S)
_ATTRIBUTE = re.compile(r"([a-zA-Z_:-]+)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+))|([a-zA-Z_:-]+)")

BLOCKS = frozenset("address article aside blockquote body br caption center dd details dialog div dl dt fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 "
                   "head header hr html legend li main menu nav ol p pre section summary table tbody td tfoot th thead title tr ul".split())
#: Their content is never text of the page.
RAW = frozenset("script style noscript template iframe textarea title svg math object".split())
NO_TEXT = RAW | frozenset("head nav header footer aside form select button menu dialog datalist canvas audio video map".split())
VOID = frozenset("area base br col embed hr img input link meta source track wbr".split())
#: Words of a class, id or role that name what is no article text.
NO_TEXT_NAMES = frozenset("ad ads adv advert adverts advertisement advertising sponsor sponsored promo promotion banner cookie cookies consent gdpr notice notices notification "
                          "popup modal overlay newsletter subscribe subscription signup login nav navbar navigation menu menubar breadcrumb breadcrumbs pagination pager sidebar "
                          "sidenav aside complementary widget widgets related recommended recommendations share sharing social comment comments commentlist reply replies respond "
                          "disqus footer contentinfo masthead topbar toolbar skip copyright search alert".split())
MODIFIERS = frozenset("has have with without no not hide hides".split())
#: Share of a page's words from which an element is the page's frame, whatever its name.
FRAME_SHARE = 0.75
_NAME = re.compile(r"[a-z]+")
_CAMEL = re.compile(r"(?<=[a-z])(?=[A-Z])")
CONTENT = ("article", "main")
PRIOR = {"word": 1.0, "link": -1.0, "tag": -0.2}
LIMIT = 4.0
PRIOR_COUNT = 50.0


def _unwanted(tag: str, attributes: str) -> bool:
    if tag in NO_TEXT:
        return True
    if not attributes or tag in ("html", "body", *CONTENT):
        return False
    for name, a, b, c, bare in _ATTRIBUTE.findall(attributes):
        name, value = (name or bare).lower(), a or b or c
        if name == "hidden" or name == "aria-hidden" and value == "true" or name == "style" and re.search(r"display\s*:\s*none", value):
            return True
    return False


def _named(attributes: str) -> bool:
    """Whether the class, id or role names what is no article text; what follows a modifier (has-sidebar) names something else."""
    for name, a, b, c, bare in _ATTRIBUTE.findall(attributes):
        if (name or bare).lower() in ("class", "id", "role"):
            for part in _CAMEL.sub("-", a or b or c).lower().split():
                for word in _NAME.findall(part):
                    if word in MODIFIERS:
                        break
                    if word in NO_TEXT_NAMES:
                        return True
    return False


class Page:
    """Blocks and tags of a page, in order, outside unwanted containers.

    `items` are (block, word key or tag key, how many): block is an index into
    `texts`, or -1 for a tag.
    """

    def __init__(self, source: str):
        self.texts: list[str] = []
        self.items: list[tuple[int, str, int]] = []
        self.spans: list[tuple[str, int, int]] = []  # content elements and their item ranges
        self._parts: list[tuple[str, bool]] = []
        self._tag = "body"
        self._link = 0
        self._words: list[int] | None = None
        opened: list[tuple[str, int]] = []
        tokens = [(m.start(), m.end(), bool(m[1]), (m[2] or "").lower(), m[3] or "") for m in _TOKEN.finditer(source)]
        at = i = 0
        while i < len(tokens):
            start, end, closes, tag, attributes = tokens[i]
            if start < at:  # inside what was skipped
                i += 1
                continue
            self._text(source[at:start])
            at = end
            i += 1
            if not tag:
                continue
            if not closes and tag not in VOID and (_unwanted(tag, attributes) or self._other_by_name(source, tokens, i, tag, attributes)):
                self._break()
                if not attributes.rstrip().endswith("/"):
                    i = self._after(tokens, i, tag)
                    at = tokens[i - 1][1] if i < len(tokens) or tokens[-1][2] and tokens[-1][3] == tag else len(source)
                    if i < len(tokens) and not (tokens[i - 1][2] and tokens[i - 1][3] == tag):
                        at = tokens[i][0]  # closed by what follows
                continue
            if tag == "a":
                self._link = 0 if closes else 1
            if tag in BLOCKS:
                self._break()
                self._tag = "body" if closes or tag == "br" else tag
                self._link = 0
                self.items.append((-1, ("/" if closes else "") + tag, 1))
                if tag in CONTENT:
                    if not closes:
                        opened.append((tag, len(self.items)))
                    elif opened:
                        self.spans.append((*opened.pop(), len(self.items) - 1))
        self._text(source[at:])
        self._break()
        self.spans += [(*start, len(self.items)) for start in opened]

    def _other_by_name(self, source: str, tokens: list, i: int, tag: str, attributes: str) -> bool:
        """Whether the element that opened before token i is no article text by its name, and its content does not tell otherwise."""
        if not attributes or tag in ("html", "body", *CONTENT) or not _named(attributes):
            return False
        end = len(tokens) if attributes.rstrip().endswith("/") else self._after(tokens, i, tag)
        if any(name in CONTENT and not closes and not _named(own) for _, _, closes, name, own in tokens[i:end]):
            return False  # it holds the content
        if any(name in CONTENT for _, _, _, name, _ in tokens):
            return True
        if self._words is None:
            self._words = self._words_before(source, tokens)
        inside = self._words[min(end, len(tokens))] - self._words[i - 1]
        return not inside or inside < FRAME_SHARE * self._words[-1]

    def _words_before(self, source: str, tokens: list) -> list[int]:
        """Words before each token, and of the whole page, outside elements that never hold text."""
        counts, total, at, skip = [], 0, 0, 0
        for k, (start, end, closes, tag, attributes) in enumerate(tokens):
            if k >= skip:
                total += len(source[at:start].split())
            counts.append(total)
            at = end
            if k >= skip and tag and not closes and tag not in VOID and _unwanted(tag, attributes) and not attributes.rstrip().endswith("/"):
                skip = self._after(tokens, k + 1, tag)
                if skip == len(tokens) and not (tokens[-1][2] and tokens[-1][3] == tag):
                    skip += 1  # never closed
        return [*counts, total + (len(source[at:].split()) if skip <= len(tokens) else 0)]

    @staticmethod
    def _after(tokens: list, i: int, tag: str) -> int:
        """The token after an unwanted element that opened before token i."""
        depth = 1
        for k in range(i, len(tokens)):
            _, _, closes, name, _ = tokens[k]
            if tag == "p" and name in BLOCKS and name != "br":
                return k + 1 if closes and name == "p" else k
            if name == tag:
                if tag in RAW and not closes:
                    continue
                depth += -1 if closes else 1
                if not depth:
                    return k + 1
        if tag in RAW:
            return len(tokens)
        for k in range(i, len(tokens)):  # never closed: up to the next content element
            if tokens[k][3] in CONTENT or tokens[k][3] == "body":
                return k
        return len(tokens)

    def _text(self, raw: str) -> None:
        if raw:
            self._parts.append((raw, bool(self._link)))

    def _break(self) -> None:
        if not self._parts:
            return
        linked = sum(len(html.unescape(t).split()) for t, link in self._parts if link)
        text = " ".join(html.unescape("".join(t for t, _ in self._parts)).split())
        self._parts = []
        if text:
            n = text.count(" ") + 1
            self.texts.append(text)
            self.items.append((len(self.texts) - 1, "word " + self._tag, max(0, n - linked)))
            if linked:
                self.items.append((len(self.texts) - 1, "link " + self._tag, linked))


def prior(key: str) -> float:
    return PRIOR.get(key.split(" ")[0], PRIOR["tag"])


def labelled_counts(pages: DataFrame, html_col: str = "html") -> DataFrame:
    """(key, inside, outside): words and tags of all pages with an <article>, by their place."""

    def count(batch: pa.RecordBatch) -> pa.RecordBatch | None:
        inside: Counter = Counter()
        outside: Counter = Counter()
        for source in batch.column("html").to_pylist():
            page = Page(source)
            if not page.spans:
                continue
            marks = [False] * len(page.items)
            for _, a, b in page.spans:
                marks[a:b] = [True] * (b - a)
            for (_, key, n), mark in zip(page.items, marks):
                (inside if mark else outside)[key] += n
        keys = sorted({*inside, *outside})
        return pa.RecordBatch.from_arrays([pa.array(keys, pa.string()), pa.array([inside[k] for k in keys], pa.int64()), pa.array([outside[k] for k in keys], pa.int64())],
                                          names=["key", "inside", "outside"]) if keys else None

    labelled = _html(pages, html_col).filter("html ilike '%<article%'").select("html")
    return by_batch(labelled, count, "key string, inside long, outside long").groupBy("key").agg(F.sum("inside").alias("inside"), F.sum("outside").alias("outside"))


def learn_weights(counts: DataFrame) -> dict[str, float]:
    """Smoothed log ratios by key. Keys are block names: a bounded table.

    A tag's weight stays below zero, and no weight passes LIMIT.
    """
    rows = counts.collect()
    totals = [max(1.0, float(sum(r[c] for r in rows))) for c in ("inside", "outside")]
    weights = {}
    for r in rows:
        # the prior is worth PRIOR_COUNT occurrences split in its ratio
        up = math.exp(prior(r.key))
        ratio = (r.inside / totals[0] * 1e4 + PRIOR_COUNT * up / (1 + up)) / (r.outside / totals[1] * 1e4 + PRIOR_COUNT / (1 + up))
        weight = max(-LIMIT, min(LIMIT, math.log(ratio)))
        weights[r.key] = weight if " " in r.key else min(weight, -0.05)
    return weights


def best_run(scores: list[float]) -> tuple[int, int]:
    """The contiguous run with the largest sum (the first of the longest such); (0, 0) if none is positive."""
    best, best_at, total, start = 0.0, (0, 0), 0.0, 0
    for i, score in enumerate(scores):
        if total < 0 or i == start:
            total, start = 0.0, i
        total += score
        if total > best or total == best and best > 0 and i + 1 - start > best_at[1] - best_at[0]:
            best, best_at = total, (start, i + 1)
    return best_at


def main_text(source: str, weights: dict[str, float]) -> str:
    page = Page(source)
    scores = [n * weights.get(key, prior(key)) for _, key, n in page.items]
    first, last = best_run(scores)
    words = [n if block >= 0 else 0 for block, _, n in page.items]
    # the <article> with most of the run's words, or else a <main> around the run
    elements = sorted(page.spans, key=lambda s: (s[0] == "article", sum(words[s[1] : s[2]])), reverse=True)
    for tag, a, b in elements:
        if tag == "article" and 2 * sum(words[a:b]) >= sum(words[first:last]) or a <= first and last <= b:
            first, last = a, b
            break
    kept = sorted({block for block, _, _ in page.items[first:last] if block >= 0})
    return "\n".join(page.texts[k] for k in kept)


def _html(pages: DataFrame, html_col: str, *others: str) -> DataFrame:
    return pages.select(*others, F.coalesce(F.col(html_col), F.lit("")).alias("html"))


def extract_text(pages: DataFrame, weights: dict[str, float] | None = None, id_col: str = "page_id", url_col: str = "url",
                 html_col: str = "html") -> DataFrame:
    """(page_id, url, text, n_chars) per row of `pages`; weights are learned from `pages` unless given."""
    if weights is None:
        weights = learn_weights(labelled_counts(pages, html_col))
    kind = pages.schema[id_col].dataType.simpleString()

    def extract(batch: pa.RecordBatch) -> pa.RecordBatch:
        found = [main_text(source, weights) for source in batch.column("html").to_pylist()]
        return pa.RecordBatch.from_arrays([batch.column("page_id"), batch.column("url"), pa.array(found, pa.string()), pa.array(map(len, found), pa.int64())],
                                          names=["page_id", "url", "text", "n_chars"])

    return by_batch(_html(pages, html_col, F.col(id_col).alias("page_id"), F.col(url_col).cast("string").alias("url")), extract,
                    f"page_id {kind}, url string, text string, n_chars long")
