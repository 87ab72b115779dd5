"""Main text of HTML pages: what a host's suffix array leaves of their articles.

``parse`` cuts a page to blocks and says of each whether its element or class names leave it out, and whether the page marks its
article (``article``, ``main`` or role main). The token streams of all pages of a host, what is left out included, are put end to end, and
the host's suffixes, cut to ``RUN`` tokens, are sorted in buckets of the key (host, fingerprint of the next ``RUN`` tokens). Equal neighbours of
distinct pages are repeated runs. What they say depends on where they stand:

* on a page without a marked article, tokens that repeated runs of such pages cover are removed, and unique runs stay;
* a marked article loses a block if runs cover all of it that stand in most articles of the host (more than half of them, and
  ``SITE_PAGES`` or more) and also outside of an article. A teaser stands in one article only, a quoted line in few, or in no menu or
  footer: these stay, as do headlines, and an article that would lose every block.

A page of whose text repeated runs cover ``COPY_SHARE`` or more is itself a copy of another page: what only such pages share is their text and
stays; a run is boilerplate where pages with a text of their own have it too.

Scale: pages are packed to blocks (``packed``), and no text is shuffled. Every run has an anchor, the smallest fingerprint of ``ANCHOR`` tokens
in it; equal runs have equal anchors. First only distinct anchors are sent, about one for three tokens; then the
runs whose anchor repeats; then those that repeat themselves, with what is known of copies. A block sends a key once,
so a host with a third of all pages meets as a few numbers per block; no host is gathered.

Defined cases: a null or empty html gives an empty text; a null url is a host of its own name (empty); an element that is never closed ends
at the next ``article`` or ``main``, or with the page; rows that repeat a page are distinct pages; an empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

import hashlib
import html
import re
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cohortlens.session import materialise

from . import packed as P
from .common import map_arrow

#: tokens of a repeated run, and of its anchor
RUN, ANCHOR = 8, 4
#: share of a page's tokens in repeated runs from which on it counts as a copy
COPY_SHARE = 0.9
#: articles a run stands in, at least, before it can be the site's and not theirs
SITE_PAGES = 3
#: before a line of a stream: left out, headline. White space, so no block holds them
LEFT, HEADLINE = "\x1c", "\x1d"
HEADLINES = {"h1", "h2", "h3", "h4", "h5", "h6"}

# Names of elements and words in class names.
RAW = "script|style|textarea|title|noscript|iframe|xmp|noembed|noframes|template"
LEFT_OUT = {"head", "nav", "aside", "footer", "header", "form", "button", "select", "menu", "dialog", "svg", "canvas", "object", "audio", "video", "map", "datalist"}
BLOCK = {
    "address", "article", "aside", "blockquote", "body", "center", "dd", "details", "dialog", "dir", "div", "dl", "dt", "fieldset", "figcaption", "figure", "footer", "form",
    "h1", "h2", "h3", "h4", "h5", "h6", "header", "hgroup", "hr", "html", "li", "main", "nav", "ol", "p", "pre", "section", "summary", "table", "caption", "tbody", "thead", "tfoot", "tr", "ul",
}
SPACED = {"br", "td", "th", "option", "img", "wbr"}
VOID = {"area", "base", "br", "col", "embed", "hr", "img", "input", "link", "meta", "param", "source", "track", "wbr"}
BAD_WORDS = {
    "ad", "ads", "advert", "adverts", "advertisement", "adslot", "sponsor", "sponsored", "promo", "promotion", "banner", "cookie", "cookies", "consent", "gdpr", "notice", "notices", "alert",
    "sidebar", "sidebars", "menu", "menus", "nav", "navbar", "navigation", "breadcrumb", "breadcrumbs", "footer", "comment", "comments", "disqus", "reply", "replies", "respond", "share", "sharing", "social",
    "newsletter", "subscribe", "signup", "login", "related", "recommended", "popup", "modal", "widget", "toolbar", "pagination", "pager", "skip",
}
#: on an article, main or body these words do not count
WRAPPERS = {"article", "main", "body", "html"}
BAD_ROLES = {"navigation", "banner", "contentinfo", "complementary", "search", "form", "menu", "menubar", "dialog", "alert", "alertdialog"}

_ATTRS = r"""(?:"[^"]*"|'[^']*'|[^'">])*"""
_MARKUP = re.compile(
    rf"<!--.*?(?:-->|\Z)|<(?P<raw>{RAW})\b{_ATTRS}>.*?(?:</(?P=raw)\s*>|\Z)|<(?P<close>/?)(?P<name>[a-zA-Z][^\s/>]*)(?P<attrs>{_ATTRS})(?:>|\Z)|<[!?/][^>]*(?:>|\Z)", re.S | re.I
)
_ATTR = re.compile(r"""(class|id|role|hidden|aria-hidden|aria-label|style)\s*(?:=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+)))?""", re.I)
_NAME_WORD = re.compile(r"[a-z]+")
_HIDDEN = re.compile(r"display\s*:\s*none|visibility\s*:\s*hidden", re.I)


def _is_boilerplate(name: str, attrs: str, inside: bool) -> bool:
    if name in LEFT_OUT:
        return not (name == "header" and inside)  # an article's own header holds its headline
    if not attrs.strip() or name in {"body", "html"}:
        return False
    for key, a, b, c in _ATTR.findall(attrs):
        key, value = key.lower(), (a or b or c).lower()
        if key == "hidden" or key == "aria-hidden" and value == "true" or key == "style" and _HIDDEN.search(value):
            return True
        if key == "role" and value in BAD_ROLES:
            return True
        if key in ("class", "id"):
            words = set(_NAME_WORD.findall(value))
            if name in WRAPPERS:
                words &= {"comment", "comments", "related", "ad", "ads", "advert", "sponsored", "promo"}
            if words & BAD_WORDS:
                return True
    return False


def _is_main(name: str, attrs: str) -> bool:
    return name in ("article", "main") or "main" in attrs and bool(re.search(r"""\brole\s*=\s*["']?main\b""", attrs, re.I))


def parse(page: str) -> tuple[list[str], bool]:
    """The page's blocks in order and whether it marks its article. ``LEFT`` precedes those that are not its text, ``HEADLINE`` its headlines."""
    blocks: list[tuple[str, str, bool]] = []  # where it stands (left out, in the article, or neither), its text, whether it is a headline
    found = False
    piece: list[str] = []  # of the block that is open
    opened = ""  # the element that began it
    skip, depth = "", 0  # element that is left out, and how many of its name are open
    inside, levels = "", 0  # element that marks the article, and how many of its name are open
    at = 0

    def close_block() -> None:
        if piece:
            text = " ".join(html.unescape("".join(piece)).split())
            piece.clear()
            if text:
                blocks.append(("left" if skip else "article" if inside else "", text, opened in HEADLINES))

    for m in _MARKUP.finditer(page):
        if m.start() > at:
            piece.append(page[at : m.start()])
        at = m.end()
        name = m["name"]
        if name is None:
            continue
        name = name.lower()
        closing, attrs = bool(m["close"]), m["attrs"]
        if skip:
            if not closing and not inside and _is_main(name, attrs) and not _is_boilerplate(name, attrs, False):
                close_block()
                skip = ""  # what was open is never closed
            else:
                ends = closing and name == inside
                if name == skip and name not in VOID:
                    depth += -1 if closing else 1
                    ends = depth == 0
                if ends or name in BLOCK:
                    close_block()
                elif name in SPACED:
                    piece.append(" ")
                if ends:
                    skip = ""
                if skip or name != inside:
                    continue
        if name in BLOCK:
            close_block()
            opened = "" if closing else name
        elif name in SPACED:
            piece.append(" ")
        if closing:
            if name == inside:
                levels -= 1
                if levels == 0:
                    inside = ""
            continue
        if name in VOID:
            continue
        if _is_boilerplate(name, attrs, bool(inside)):
            close_block()
            skip, depth = name, 1
        elif inside:
            levels += name == inside
        elif _is_main(name, attrs):
            inside, levels, found = name, 1, True
    if at < len(page):
        piece.append(page[at:])
    close_block()
    marked = found and any(where == "article" for where, _, _ in blocks)
    left = {"left", ""} if marked else {"left"}
    return [(LEFT if where in left else HEADLINE if headline else "") + text for where, text, headline in blocks], marked


def host_of(url: str | None) -> str:
    m = re.match(r"[a-z][a-z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:]*)", (url or "").strip().lower())
    return m[1] if m else ""


#: where a run stands: on a page without marked article, in a marked article, or left out
FREE, ARTICLE, ASIDE = range(3)


class Pages:
    """The pages of one block end to end: lines, the runs of their tokens, and what they ask."""

    def __init__(self, row: dict):
        self.marked = np.array([r["marked"] for r in row["rows"]], bool)
        # of a page, what is left out comes last: no run crosses
        found = [(p, line) for p, text in enumerate(row["texts"]) for line in sorted(text.split("\n") if text else [], key=lambda x: x[0] == LEFT)]
        self.page = np.array([p for p, _ in found], np.int64)
        self.left = np.array([line[0] == LEFT for _, line in found], bool)
        self.headline = np.array([line[0] == HEADLINE for _, line in found], bool)
        self.lines = [line[1:] if line[0] in (LEFT, HEADLINE) else line for _, line in found]
        counts = np.array([line.count(" ") + 1 for line in self.lines], np.int64)
        self.ends = np.cumsum(counts)
        self.begins = self.ends - counts
        self.line_of = np.repeat(np.arange(len(counts)), counts)
        self.hosts = np.array([int.from_bytes(hashlib.blake2b(host_of(r["url"]).encode(), digest_size=8).digest(), "big") for r in row["rows"]], dtype=P.U64)
        self._runs()

    def _runs(self) -> None:
        """``places`` of runs (first tokens), with ``keys`` (two independent ones) and ``anchors``."""
        n = len(self.line_of)
        raw = np.frombuffer((" ".join(self.lines) + " ").encode(), np.uint8)
        stops = np.flatnonzero(raw == 0x20)[:n]
        rolling = P.rolling()
        words = rolling.of(rolling.sums(raw), np.concatenate([[0], stops[:-1] + 1])[:n], stops)
        page = self.page[self.line_of]
        segment = 2 * page + self.left[self.line_of]
        self.places = np.flatnonzero(segment[: max(0, n - RUN + 1)] == segment[RUN - 1 :])
        grams = self.hosts[page[: max(0, n - ANCHOR + 1)]]
        for k in range(ANCHOR):
            grams = P.mix(grams * P.U64(0x9E3779B97F4A7C15) + words[k : k + len(grams)])
        first, last = grams[self.places], grams[self.places + RUN - ANCHOR]
        self.keys = P.mix(first * P.U64(0xC2B2AE3D27D4EB4F) + last), P.mix(P.mix(first) * P.U64(0x9E3779B97F4A7C15) ^ last) >> P.U64(8)
        self.anchors = first
        for k in range(1, RUN - ANCHOR + 1):
            self.anchors = np.minimum(self.anchors, grams[self.places + k])
        self.run_page = page[self.places]
        self.kind = np.where(self.left[self.line_of[self.places]], ASIDE, np.where(self.marked[self.run_page], ARTICLE, FREE))

    def facts(self, runs: np.ndarray, which: np.ndarray, size: int, own: np.ndarray, totals: np.ndarray | None = None) -> np.ndarray:
        """Of each key, from its ``runs``: pages without marked article (3: or more), pages with a text of their own that have it in the article
        (3: or more), whether it stands outside of articles, whether a page without marked article and with a text of its own has it.

        With ``totals`` (articles of each page's host) also how many of those articles exactly, and of how many.
        """
        page, kind = self.run_page[runs], self.kind[runs]

        def pages(mask: np.ndarray) -> np.ndarray:
            pairs = np.unique(which[mask] * len(self.marked) + page[mask])
            return np.bincount(pairs // len(self.marked), minlength=size)

        def some(mask: np.ndarray) -> np.ndarray:
            return np.bincount(which[mask], minlength=size) > 0

        articles = pages((kind == ARTICLE) & own[page])
        short = np.minimum(pages(kind == FREE), 3) | np.minimum(articles, 3) << 2 | some(kind != ARTICLE) << 4 | some((kind == FREE) & own[page]) << 5
        if totals is None:
            return short.astype(np.uint8)
        of = np.zeros(size, np.int64)
        of[which] = totals[page]
        return short | articles << 8 | of << 32

    def ask_anchors(self) -> tuple[np.ndarray, np.ndarray]:
        """Distinct anchors, and which of them each run has."""
        return np.unique(self.anchors, return_inverse=True)

    def ask_runs(self, runs: np.ndarray, buckets: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Distinct keys of ``runs`` in sending order (for the bucket, to compare), and which of them each run has."""
        keys, at, which = np.unique(self.keys[1][runs], return_index=True, return_inverse=True)
        where = self.keys[0][runs][at]
        order = np.argsort(P.split_keys(where, buckets)[0], kind="stable")
        rank = np.empty(len(order), np.int64)
        rank[order] = np.arange(len(order))
        return where[order], keys[order], rank[which]

    def covered(self, runs: np.ndarray) -> np.ndarray:
        """The tokens that ``runs`` cover."""
        edges = np.zeros(len(self.line_of) + RUN + 1, np.int64)
        np.add.at(edges, self.places[runs], 1)
        np.add.at(edges, self.places[runs] + RUN, -1)
        return np.cumsum(edges)[: len(self.line_of)] > 0

    def said(self, answers: np.ndarray, runs: np.ndarray) -> np.ndarray:
        """Those of ``runs`` that stand in the text of a page and of which the answer for such pages (1: without marked article, 2: with) is yes."""
        kind = self.kind[runs]
        return runs[(kind == FREE) & (answers & 1 > 0) | (kind == ARTICLE) & (answers & 2 > 0)]

    def own(self, repeated: np.ndarray) -> np.ndarray:
        """The pages that are no copies: repeated runs cover less than ``COPY_SHARE`` of their text."""
        text = ~self.left[self.line_of]
        page = self.page[self.line_of]
        sizes = np.bincount(page[text], minlength=len(self.marked))
        gone = np.bincount(page[text & self.covered(repeated)], minlength=len(self.marked))
        return (gone == 0) | (gone / np.maximum(sizes, 1) < COPY_SHARE)

    def texts(self, runs: np.ndarray) -> Iterator[list[str]]:
        """The blocks of each page's text: without the tokens that ``runs`` cover, of marked articles without the blocks that they cover whole."""
        gone = self.covered(runs)
        sums = np.concatenate([[0], np.cumsum(gone)])
        hit = sums[self.ends] - sums[self.begins]
        whole = (hit == self.ends - self.begins) & ~self.headline
        edges = np.searchsorted(self.page, np.arange(len(self.marked) + 1))
        for p, marked in enumerate(self.marked):
            own = [k for k in range(edges[p], edges[p + 1]) if not self.left[k]]
            if marked:
                kept = [k for k in own if not whole[k]]
                yield [self.lines[k] for k in kept or own]
            else:
                parts = [" ".join(t for t, x in zip(self.lines[k].split(" "), gone[self.begins[k] : self.ends[k]], strict=True) if not x) if hit[k] else self.lines[k] for k in own]
                yield [x for x in parts if x]


def _judge(keys: np.ndarray, facts: np.ndarray) -> np.ndarray:
    """1: the run repeats on pages without marked article, 2: it repeats in articles, 3: both.

    Facts with totals: 1 if one of those pages has a text of its own; 2 if most articles of the host have the run, and it stands outside of them.
    """
    final = facts.dtype != np.uint8
    order = np.argsort(keys, kind="stable")
    ranked, facts = keys[order], facts[order].astype(np.int64)
    begins = np.flatnonzero(np.concatenate([[True], ranked[1:] != ranked[:-1]]))
    marks = np.bitwise_or.reduceat(facts, begins)
    free = np.add.reduceat(facts & 3, begins) > 1
    if final:
        articles, of = np.add.reduceat(facts >> 8 & 0xFFFFFF, begins), facts[begins] >> 32
        free, articles = free & (marks >> 5 & 1 > 0), (articles >= SITE_PAGES) & (2 * articles > of) & (marks >> 4 & 1 > 0)
    else:
        articles = np.add.reduceat(facts >> 2 & 3, begins) > 1
    out = np.empty(len(keys), np.uint8)
    out[order] = np.repeat(free + 2 * articles, np.diff(np.append(begins, len(keys))))
    return out


def parsed(pages: DataFrame) -> DataFrame:
    """page_id, url, stream (the lines of ``parse``), marked (whether the page marks its article)."""
    rows = pages.select("page_id", "url", F.coalesce("html", F.lit("")).alias("html"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            results = [parse(h) for h in batch.column("html").to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [batch.column("page_id"), batch.column("url"), pa.array(["\n".join(r[0]) for r in results], pa.string()), pa.array([r[1] for r in results], pa.bool_())],
                names=["page_id", "url", "stream", "marked"],
            )

    kinds = dict(rows.dtypes)
    return map_arrow(rows, run, f"page_id {kinds['page_id']}, url {kinds['url']}, stream string, marked boolean")


def extract(pages: DataFrame) -> DataFrame:
    """One row per page: page_id, url, text, n_chars."""
    buckets = P.shuffle_parts(pages.sparkSession)
    streams = parsed(pages)
    table = P.blocks(streams.withColumn("none", F.lit(0)), "html", "none", "stream", carry=True, compression="zstd")

    def candidates(row: dict) -> tuple[Pages, np.ndarray]:
        """The block, and its runs whose anchor repeats."""
        block = Pages(row)
        anchors, which = block.ask_anchors()
        tied = P.answers_of(row["anchors"], anchors, buckets)[which]
        return block, np.flatnonzero((block.kind == FREE) & (tied & 1 > 0) | (tied & 2 > 0))

    def repeated(row: dict) -> tuple[Pages, np.ndarray, np.ndarray]:
        """The block, its runs that repeat, and its pages that are no copies."""
        block, runs = candidates(row)
        where, _, which = block.ask_runs(runs, buckets)
        answers = P.answers_of(row["repeated"], where, buckets)[which]
        return block, runs[answers > 0], block.own(block.said(answers, runs))

    def ask_anchors(row: dict) -> Iterator[dict]:
        block = Pages(row)
        anchors, which = block.ask_anchors()
        facts = block.facts(np.arange(len(which)), which, len(anchors), np.ones(len(block.marked), bool))
        yield from P.question_rows(row["block"], anchors, facts, buckets, own_flags=True)

    def ask_runs(row: dict) -> Iterator[dict]:
        block, runs = candidates(row)
        where, keys, which = block.ask_runs(runs, buckets)
        facts = block.facts(runs, which, len(where), np.ones(len(block.marked), bool))
        yield from P.question_rows(row["block"], where, facts, buckets, wide=keys, own_flags=True)

    def articles(row: dict) -> Iterator[dict]:
        block, _, own = repeated(row)
        hosts, counts = np.unique(block.hosts[own & block.marked].view(np.int64), return_counts=True)
        for host, n in zip(hosts.tolist(), counts.tolist(), strict=True):
            yield {"block": row["block"], "host": host, "n": n}

    def ask_site(row: dict) -> Iterator[dict]:
        block, runs, own = repeated(row)
        known = {a["host"]: a["total"] for a in row["articles"] or ()}
        totals = np.array([known.get(h, 0) for h in block.hosts.view(np.int64).tolist()], np.int64)
        where, keys, which = block.ask_runs(runs, buckets)
        yield from P.question_rows(row["block"], where, block.facts(runs, which, len(where), own, totals), buckets, wide=keys, own_flags=True)

    def judge(size: int) -> Callable[[int, list[bytes], list[np.ndarray]], np.ndarray]:
        return lambda _, parts, facts: P.judged(_judge, parts, facts, size)

    def asked(ask: Callable[[dict], Iterator[dict]], size: int, name: str, facts: type = np.uint8) -> DataFrame:
        answers = P.answer(P.each_block(table, ask, P.QUESTION), judge(size), facts)
        return P.with_answers(table, materialise(answers, f"html-{name}"), name)

    def apply(row: dict) -> Iterator[dict]:
        block, runs, _ = repeated(row)
        where, _, which = block.ask_runs(runs, buckets)
        gone = block.said(P.answers_of(row["site"], where, buckets)[which], runs)
        for old, text in zip(row["rows"], block.texts(gone), strict=True):
            yield {"page_id": old["page_id"], "url": old["url"], "text": "\n".join(text)}

    table = asked(ask_anchors, P.NARROW, "anchors")
    table = asked(ask_runs, P.WIDE, "repeated")
    counts = materialise(P.each_block(table, articles, "block long, host long, n long"), "html-articles")
    totals = counts.join(counts.groupBy("host").agg(F.sum("n").alias("total")), "host").groupBy("block").agg(F.collect_list(F.struct("host", "total")).alias("answers"))
    table = P.with_answers(table, materialise(totals, "html-hosts"), "articles")
    table = asked(ask_site, P.WIDE, "site", np.int64)
    kinds = dict(streams.dtypes)
    out = P.each_block(table, apply, f"page_id {kinds['page_id']}, url {kinds['url']}, text string")
    return out.select("page_id", "url", "text", F.length("text").cast("long").alias("n_chars"))
