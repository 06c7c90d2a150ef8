"""Main text of web pages, with site templates removed.

Each page is read into elements, of which the subtrees are hashed. Spark counts, for each host,
on how many different pages a subtree occurs; subtrees that many pages of a host share are
deleted, besides those whose tag, role or class names them as menus, notices and the like.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from html import unescape

import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .util import beside, durable, read

#: Comments, declarations and tags; a quoted value may have any length and hold '>'. A quote that
#: is never closed ends nothing: the tag then ends at the next '>' (and from the MOST_BROKEN-th such
#: tag of a page on, quotes no longer count, so that reading stays linear).
TOKEN = re.compile(
    r"<!--.*?(?:--!?>|\Z)|<[!?][^>]*+>"
    r"|<(?P<end>/?)(?P<tag>[a-zA-Z][^\s/>]*+)(?P<attrs>(?:[^>\"'=]++|=\s*+(?:\"[^\"]*+\"|'[^']*+')?+|[\"'])*+)>",
    re.S,
)
PLAIN_TAG = re.compile(r"<(?P<end>/?)(?P<tag>[a-zA-Z][^\s/>]*+)(?P<attrs>[^>]*+)>")
MOST_BROKEN = 64
ATTR = re.compile(r"""([a-zA-Z_:][-\w:.]*)(?:\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+)))?""")
TELLING = re.compile(r"class|id|role|hidden|style", re.I)
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
#: Elements whose content is text up to their end tag.
RAW = frozenset("script style textarea title iframe noembed noframes xmp".split())
INLINE = frozenset("a abbr acronym b bdi bdo big br cite code data del dfn em font i img ins kbd label mark q rp rt ruby s samp small span strike strong sub sup time tt u var wbr".split())
#: An opening tag closes an open element of these kinds, up to the nearest of the second set.
CLOSES = {
    "li": ({"li"}, {"ul", "ol", "menu"}), "dt": ({"dt", "dd"}, {"dl"}), "dd": ({"dt", "dd"}, {"dl"}), "tr": ({"tr", "td", "th"}, {"table"}),
    "td": ({"td", "th"}, {"tr", "table"}), "th": ({"td", "th"}, {"tr", "table"}), "option": ({"option"}, {"select"}),
}
PARAGRAPH = frozenset(["p"])
P_BOUNDS = frozenset("table td th caption button object".split())
DROPPED = frozenset("head nav footer aside form script style noscript template iframe svg math button select textarea dialog menu object embed canvas audio video title noembed noframes map".split())
ROLES = frozenset("navigation banner contentinfo complementary search form dialog alertdialog alert menu menubar toolbar status".split())
NAMED = frozenset(
    "ad ads adv advert adverts advertisement advertising adsense sponsor sponsored promo promotion banner cookie cookies consent gdpr notice notices popup modal overlay "
    "newsletter subscribe subscription signup sidebar sidenav widget widgets menu nav navbar navigation breadcrumb breadcrumbs footer masthead topbar comment comments "
    "reply replies respond disqus share sharing social related recommended recommendations pagination pager toolbar login search skip".split()
)
#: Names that mean a part of the page outside an article, and of the article inside.
OUTSIDE = frozenset(["header"])
MAIN = frozenset(["article", "main"])
CONTAINERS = frozenset("div section ul ol dl table figure details fieldset center".split())
NO_TEMPLATES = INLINE | MAIN | RAW | {"#", "html", "head", "body"}
HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())
#: A subtree is a site's template if it is on so many of a host's different pages, however many the
#: host has; in an article, where pages may quote each other, on twice as many.
LEAST_PAGES, LEAST_IN_ARTICLE = 5, 10
#: Templates up to which a host's set of them is sent to its pages.
BROADCAST_TEMPLATES = 200_000


class Page:
    """Elements of a page in document order, their parents and digests, and the pieces of text."""

    def __init__(self, html: str, hashed: bool = True):
        self.hashed = hashed
        self.tags, self.parents, self.dropped, self.holds, self.within = ["#"], [-1], [False], [False], [False]
        self.digests: list[int] = [0]
        self.parts: list[list[str]] = [[]]
        self.runs: list[tuple[int, int, str]] = []  # element, block, text
        self.block = 0
        self._stack = [0]
        self._paragraphs = 0
        self._read(html)
        while self._stack:
            self._close()

    def _close(self) -> None:
        node = self._stack.pop()
        if self.tags[node] == "p":
            self._paragraphs -= 1
        if not self.hashed:
            return
        self.digests[node] = xxhash.xxh64_intdigest("\x00".join([self.tags[node], *self.parts[node]])) >> 1
        if self._stack and self.parts[node]:
            self.parts[self._stack[-1]].append(f"{self.digests[node]:x}")

    def _text(self, raw: str) -> None:
        if raw:
            if self.hashed and not raw.isspace():
                self.parts[self._stack[-1]].append(" ".join(raw.split()))
            self.runs.append((self._stack[-1], self.block, raw))

    def _open(self, tag: str, attrs: str) -> None:
        parent = self._stack[-1]
        inside = self.within[parent]
        drop = tag in DROPPED or (tag in OUTSIDE and not inside)
        named = False
        if attrs and not drop and TELLING.search(attrs):
            own = {m[1].lower(): m[2] or m[3] or m[4] or "" for m in ATTR.finditer(attrs)}
            names = set(re.split(r"[^a-z0-9]+", f"{own.get('class', '')} {own.get('id', '')}".lower()))
            named = bool(names & NAMED or (names & OUTSIDE and not inside)) or own.get("role", "").lower() in ROLES
            named = named or "hidden" in own or own.get("aria-hidden", "").lower() == "true" or bool(re.search(r"display\s*:\s*none", own.get("style", "")))
            named = named and tag not in ("html", "body") and not (inside and tag in HEADINGS)
        self.tags.append(tag)
        self.parents.append(parent)
        self.dropped.append(drop or named)
        self.holds.append(False)
        node = len(self.tags) - 1
        main = tag in MAIN and not named
        self.within.append(inside or main)
        self.digests.append(0)
        self.parts.append([])
        if main:
            # a name doesn't drop what holds the article, only a tag does
            up = parent
            while up >= 0 and not self.holds[up]:
                self.holds[up] = True
                up = self.parents[up]
        self._stack.append(node)
        if tag == "p":
            self._paragraphs += 1

    def _pop_to(self, at: int) -> None:
        while len(self._stack) > at:
            self._close()

    def _find(self, kinds, bounds) -> int:
        for at in range(len(self._stack) - 1, 0, -1):
            tag = self.tags[self._stack[at]]
            if tag in kinds:
                return at
            if tag in bounds:
                break
        return 0

    def _read(self, html: str) -> None:
        at, n, broken, last = 0, len(html), 0, html.rfind(">")
        begin = 0
        while at < n:
            start = html.find("<", at)
            m = None
            if 0 <= start <= last or html.startswith("<!--", start):
                m = TOKEN.match(html, start) if broken < MOST_BROKEN else None
                if not m:
                    m = PLAIN_TAG.match(html, start)
                    broken += m is not None
            elif start < 0 or start > last:
                break
            if not m:
                at = start + 1
                continue
            self._text(html[begin:start])
            begin = at = m.end()
            tag = (m["tag"] or "").lower()
            if not tag:
                continue
            if tag not in INLINE:
                self.block += 1
            elif tag == "br":
                self._text(" ")
            if m["end"]:
                if tag in INLINE:
                    # only an inline element inside the innermost block is closed by it
                    found = next((k for k in range(len(self._stack) - 1, 0, -1) if self.tags[self._stack[k]] == tag or self.tags[self._stack[k]] not in INLINE), 0)
                    if found and self.tags[self._stack[found]] == tag:
                        self._pop_to(found)
                elif found := self._find({tag}, ("article", "body") if tag in ("p", "li", "div") else ()):
                    self._pop_to(found)
                continue
            if self._paragraphs and tag not in INLINE and tag not in VOID and (found := self._find(PARAGRAPH, P_BOUNDS)):
                self._pop_to(found)
            if tag in CLOSES and (found := self._find(*CLOSES[tag])):
                self._pop_to(found)
            if tag in VOID:
                continue
            self._open(tag, m["attrs"] or "")
            if tag in RAW:
                end = re.compile(rf"</{re.escape(tag)}(?=[\s/>]|\Z)", re.I).search(html, at)
                stop = end.start() if end else n
                self._text(html[at:stop])
                begin = at = stop
        self._text(html[begin:])

    def marks(self, templates: frozenset[int] = frozenset()) -> tuple[list[bool], list[bool], bool]:
        """By element: whether it is dropped, by itself or from above, and whether it lies in an article; whether there is one."""
        gone, inside = [], []
        kind = None
        for k, tag in enumerate(self.tags):
            up = self.parents[k]
            drop = self.dropped[k] and not (self.holds[k] and tag not in DROPPED)
            drop = drop or (bool(templates) and not self.holds[k] and self.counts(k) and self.digest(k) in templates)
            gone.append(drop or (up >= 0 and gone[up]))
            if tag in MAIN and not gone[k] and (kind is None or tag == "article"):
                kind = tag
        for k, tag in enumerate(self.tags):
            up = self.parents[k]
            inside.append((tag == kind and not gone[k]) or (up >= 0 and inside[up]))
        return gone, inside, kind is not None

    def counts(self, k: int) -> bool:
        """Whether an element may be a template: a block of a page, but of an article's only what holds other blocks.

        Paragraphs of articles are text, even if many pages share them (a licence, a passage).
        """
        tag = self.tags[k]
        if self.within[k]:
            return tag in CONTAINERS and bool(self.parts[k])
        return bool(self.parts[k]) and tag not in NO_TEMPLATES

    def digest(self, k: int) -> int:
        """The subtree's digest; its lowest bit tells those within an article, which have a bar of their own."""
        return self.digests[k] & ~1 | self.within[k]

    def subtrees(self) -> set[int]:
        return {self.digest(k) for k in range(len(self.tags)) if not self.holds[k] and self.counts(k)}

    def text(self, templates: frozenset[int] = frozenset()) -> str:
        gone, inside, main = self.marks(templates)
        blocks: dict[int, list[str]] = {}
        for node, block, raw in self.runs:
            if not gone[node] and (inside[node] or not main):
                blocks.setdefault(block, []).append(raw)
        joined = (" ".join((unescape(t) if "&" in t else t).split()) for t in map("".join, blocks.values()))
        return "\n\n".join(b for b in joined if b)


def host_of(url: Column) -> Column:
    """Lower-case host of a URL without user and port; '' if there is none."""
    return F.coalesce(F.regexp_extract(F.lower(url), r"^\s*(?:[a-z][a-z0-9+.-]*:)?//(?:[^/?#@]*@)?([^/?#:]*)", 1), F.lit(""))


def templates(pages: DataFrame) -> DataFrame:
    """host, digest of the subtrees that many different pages of a host share."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            hosts, digests, roots = [], [], []
            for host, html in zip(batch["host"].to_pylist(), batch["html"], strict=True):
                page = Page(html.as_py() or "")
                for d in page.subtrees():
                    hosts.append(host)
                    digests.append(d)
                    roots.append(page.digests[0])
            yield pa.RecordBatch.from_arrays([pa.array(hosts, pa.string()), pa.array(digests, pa.int64()), pa.array(roots, pa.int64())], ["host", "digest", "root"])

    seen = pages.select(host_of(F.col("url")).alias("host"), "html").mapInArrow(run, "host string, digest long, root long").distinct()
    within = F.col("digest").bitwiseAND(F.lit(1).cast("long")) == 1
    counts = seen.groupBy("host", "digest").agg(F.count("*").alias("n"))
    return counts.where((F.col("n") >= LEAST_PAGES) & (~within | (F.col("n") >= LEAST_IN_ARTICLE))).select("host", "digest")


def main_text(pages: DataFrame) -> DataFrame:
    """page_id, url, text, n_chars of each row of `pages` (page_id, url, html).

    The text of a page's articles (or its main element, or its body) without what is dropped;
    blocks are joined by two newlines. A null or empty html gives an empty text, a null url belongs
    to the host ''. Repeated rows stay; pages of equal content count once among a host's. Other
    columns are ignored; an empty table gives no rows.

    A site's templates go to its pages by a broadcast if there are few in all; otherwise pages are
    joined with their hosts' sets, and adaptive execution splits a host of very many pages.
    """
    found = durable(templates(pages))
    lists = found.groupBy("host").agg(F.collect_set("digest").alias("templates"))
    rows = pages.select("page_id", "url", "html", host_of(F.col("url")).alias("host"))
    rows = beside(rows, lists, ["host"], found.count(), BROADCAST_TEMPLATES).select("page_id", "url", "html", "templates")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known: dict[tuple, frozenset] = {}
        for batch in batches:
            texts = []
            for html, own in zip(batch["html"], batch["templates"].to_pylist(), strict=True):
                key = tuple(own or ())
                texts.append(Page(html.as_py() or "", bool(key)).text(known.setdefault(key, frozenset(key))))
                if len(known) > 1000:
                    known.clear()
            yield pa.RecordBatch.from_arrays([batch["page_id"], batch["url"], pa.array(texts, pa.string()), pa.array([len(t) for t in texts], pa.int64())], ["page_id", "url", "text", "n_chars"])

    return rows.withColumn("page_id", F.col("page_id").cast("long")).mapInArrow(run, "page_id long, url string, text string, n_chars long")


def op3_site_templates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return main_text(read(spark, sf_dir, "pages"))
