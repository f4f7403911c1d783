"""HTML extraction by site template removal.

Element subtrees are hashed with all they hold and counted per host, over pages with different
articles. A subtree on many pages of a host is its template and is deleted wherever it stands on
that host; what one page alone shows of menus, adverts and the like goes by the element's name,
role and class. The rest of the article is the text. Classes tell nothing of an element that holds
the article.

A paragraph or heading directly in an article is never a template, since articles may quote the same
passage, and pages with the same article count as one, so that copies don't delete each other.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass, field
from functools import lru_cache
from html.parser import HTMLParser

import pandas as pd
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from boletim.llm import urls
from boletim.llm.common import let_workers_import
from boletim.storage import shared_folder

#: Pages with different articles from which a subtree of a host is its template.
TEMPLATE_PAGES = 5

# Kinds of elements in HTML.
_VOID = set("area base br col embed hr img input link meta source track wbr".split())
_HIDDEN = set("script style noscript template head iframe svg canvas object math".split())
_FURNITURE = set(
    "nav footer aside form button select option textarea dialog menu label fieldset".split()
)
_BLOCKS = set(
    "address article aside blockquote body caption center dd details dialog div dl dt fieldset"
    " figcaption figure footer form h1 h2 h3 h4 h5 h6 header hr html legend li main menu nav ol p"
    " pre section summary table tbody td tfoot th thead title tr ul".split()
)
_TEXT = set("p h1 h2 h3 h4 h5 h6 pre blockquote".split())
_CLOSED_BY = {
    "li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"},
    "td": {"td", "th"}, "th": {"td", "th"}, "option": {"option"},
}
_LISTS = {"ul", "ol", "menu", "dl", "table"}
# Classes, ids and roles, or last parts of them, that tell what an element is for.
_USES = set(
    "ad ads advert adverts advertisement sponsor sponsored promo promotion banner cookie cookies"
    " consent notice alert sidebar menu nav navbar navigation breadcrumb breadcrumbs footer"
    " comment comments disqus share sharing social related newsletter subscribe popup modal"
    " login signup search complementary contentinfo dialog toolbar pagination".split()
)
_PAGE_HEADS = {"header", "masthead", "topbar"}
# First parts of a class that tells what a page has around its text.
_STATES = set("has have no not with without is hide show".split())
# Elements that classes tell nothing of.
_FRAMES = {"html", "body", "main", "article"}
_PARTS = re.compile("[^a-z0-9]+")
_BLANK = re.compile(r"\s+")


@lru_cache(1 << 14)
def _is_named(names: str, main: bool) -> bool:
    """Whether a whole class, id or role, or the last part of one, tells of furniture."""
    uses = _USES if main else _USES | _PAGE_HEADS
    for name in names.lower().split():
        parts = [p for p in _PARTS.split(name) if p]
        if parts and parts[-1] in uses and (len(parts) == 1 or parts[0] not in _STATES):
            return True
    return False


@dataclass
class _Element:
    tag: str
    hidden: bool
    named: bool
    main: bool
    furniture: bool = False
    holds_main: bool = False
    kept: list = field(default_factory=list)


class _Page(HTMLParser):
    """Blocks of text with the elements around them, and the hash of every subtree."""

    def __init__(self):
        super().__init__(convert_charrefs=True)
        self.stack = [_Element("", False, False, False)]
        self.mains: list[list[_Element]] = []
        self.blocks: list[tuple[str, list[_Element]]] = []
        self.text: list[str] = []
        self.hashes: dict[int, tuple[_Element, int]] = {}

    def _flush(self) -> None:
        text = _BLANK.sub(" ", "".join(self.text)).strip()
        self.text = []
        if text:
            self.stack[-1].kept.append(text)
            self.blocks.append((text, self.stack[1:]))

    def _is_hidden(self, tag: str, attrs: dict, main: bool) -> bool:
        if tag in _HIDDEN or tag in _FURNITURE or (tag == "header" and not main):
            return True
        return "hidden" in attrs or attrs.get("aria-hidden") == "true"

    def handle_starttag(self, tag: str, attrs: list) -> None:
        if tag in _VOID:
            if tag in ("br", "hr", "img"):
                self.text.append(" ")
            if tag == "hr":
                self._flush()
            return
        if tag in _BLOCKS:
            self._flush()
            self._close_implied(tag)
        up = self.stack[-1]
        named = dict(attrs)
        begins = tag in ("article", "main") or named.get("role") == "main"
        main = up.main or begins
        told = bool(attrs) and not begins and tag not in _FRAMES and _is_named(
            " ".join(named.get(k) or "" for k in ("class", "id", "role")), up.main
        )
        self.stack.append(_Element(tag, self._is_hidden(tag, named, up.main), told, main))
        if begins:
            self.mains.append(list(self.stack))

    def _close_implied(self, tag: str) -> None:
        ended = _CLOSED_BY.get(tag, set()) | {"p"}
        for depth in range(len(self.stack) - 1, 0, -1):
            at = self.stack[depth].tag
            if at in ended:
                self._pop_to(depth)
            elif at in _LISTS or at in ("article", "main", "section", "div", "body"):
                return

    def handle_endtag(self, tag: str) -> None:
        for depth in range(len(self.stack) - 1, 0, -1):
            if self.stack[depth].tag == tag:
                if tag in _BLOCKS:
                    self._flush()
                self._pop_to(depth)
                return

    def _pop_to(self, depth: int) -> None:
        """Close the elements from this depth on."""
        if any(e.tag in _BLOCKS for e in self.stack[depth:]):
            self._flush()
        while len(self.stack) > depth:
            done = self.stack.pop()
            if done.kept:
                body = "\x1f".join([done.tag, *done.kept])
                digest = xxhash.xxh64_intdigest(body.encode("utf-8", "surrogatepass"))
                self.hashes[id(done)] = (done, digest - (digest >> 63 << 64))
                self.stack[-1].kept.append(f"{digest:x}")

    def handle_data(self, data: str) -> None:
        self.text.append(data)

    def finish(self) -> None:
        self.close()
        self._flush()
        self._pop_to(1)
        self._settle()

    def _settle(self) -> None:
        """Tell furniture, now that it is known what holds the article.

        The article is what begins within the fewest elements named as furniture; others in a list
        of related ones, say, are within more.
        """
        shown = [around for around in self.mains if not any(e.hidden for e in around)]
        fewest = min((sum(e.named for e in around) for around in shown), default=0)
        articles = [a for a in shown if sum(e.named for e in a) == fewest]
        for element in (e for around in articles for e in around):
            element.named, element.holds_main = False, True
        for around in [*self.mains, *(around for _, around in self.blocks)]:
            gone = False
            for element in around:
                gone = gone or element.hidden or element.named
                element.furniture = gone
        for around in self.mains:
            if not around[-1].furniture:
                for element in around:
                    element.holds_main = True


def _parsed(html: str) -> tuple[list[tuple[str, list[int]]], list[int], int]:
    """Blocks that are no furniture, each with the hashes of the subtrees it is in; the hashes of
    all subtrees that may be templates; the hash of the article."""
    page = _Page()
    page.feed(html)
    page.finish()
    within = any(e.main and not e.furniture for _, around in page.blocks for e in around)
    shown = lambda e: page.hashes[id(e)][1]

    def may(e: _Element) -> bool:
        """Whether a subtree may be a template: a block that is not around the article, nor a
        paragraph or heading in it."""
        text = e.main and e.tag in _TEXT
        return e.tag in _BLOCKS and not (e.holds_main or text or e.tag == "body")

    blocks = [
        (text, [shown(e) for e in around if may(e)])
        for text, around in page.blocks
        if around and not around[-1].furniture and (around[-1].main or not within)
    ]
    article = xxhash.xxh64_intdigest(
        "\n".join(t for t, _ in blocks).encode("utf-8", "surrogatepass")
    )
    subtrees = {h for e, h in page.hashes.values() if may(e)}
    return blocks, sorted(subtrees), article - (article >> 63 << 64)


def _subtrees(pages: DataFrame) -> DataFrame:
    """``host, page, article, subtrees``: what may be a template of each page, as hashes."""
    def hashed(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            rows = [
                (host, page, article, subtrees)
                for host, page, html in zip(batch["host"], batch["page"], batch["html"])
                for _, subtrees, article in [_parsed(html)]
            ]
            yield pd.DataFrame(rows, columns=["host", "page", "article", "subtrees"])

    return pages.select("host", "page", "html").mapInPandas(
        hashed, "host bigint, page bigint, article bigint, subtrees array<bigint>"
    )


def templates(
    pages: DataFrame, least: int = TEMPLATE_PAGES, folder: str | None = None
) -> DataFrame:
    """``page, gone``: the template subtrees of every page that has some.

    ``pages`` have ``host`` (a hash of it), ``page`` (a hash of host and html) and ``html``.
    Their subtrees are hashed once and written to ``folder`` in the shared space. A host or subtree
    with very many pages is counted on the map side first.
    """
    spark = pages.sparkSession
    folder = folder or shared_folder(spark, "subtrees")
    _subtrees(pages).write.parquet(folder)
    subtrees = spark.read.parquet(folder).withColumn("subtree", F.explode("subtrees"))
    recurring = (
        subtrees.select("host", "subtree", "article").distinct()
        .groupBy("host", "subtree").agg(F.count("*").alias("pages"))
        .where(F.col("pages") >= least)
    )
    return subtrees.select("host", "subtree", "page").join(recurring, ["host", "subtree"]).groupBy(
        "page"
    ).agg(F.collect_set("subtree").alias("gone"))


def extract(
    pages: DataFrame,
    keep: tuple[str, ...] = ("page_id", "url"),
    url: str = "url",
    html: str = "html",
    least: int = TEMPLATE_PAGES,
    folder: str | None = None,
) -> DataFrame:
    """``keep``, ``text`` and ``n_chars`` of every page.

    The text is the blocks of the article (of the body, where no article or main part is marked) in
    page order, white space within a block being one space, joined by an empty line. A null html
    has an empty text. Repeated rows count as one page and have the same text. A null URL, or one
    without host, has the empty host.
    """
    let_workers_import(pages.sparkSession)
    plain = pages.select(
        F.struct(*keep).alias("kept"),
        F.xxhash64(urls.host(F.col(url))).alias("host"),
        F.coalesce(F.col(html), F.lit("")).alias("html"),
    ).withColumn("page", F.xxhash64("host", "html"))

    def parse(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for texts in batches:
            yield pd.Series([
                [{"text": t, "within": w} for t, w in _parsed(html)[0]] for html in texts
            ])

    parsed = F.pandas_udf(parse, "array<struct<text:string,within:array<bigint>>>")
    blocks = plain.select("kept", "page", parsed("html").alias("blocks"))
    gone = templates(plain, least, folder)
    nothing = F.array().cast("array<bigint>")
    left = F.filter(
        "blocks",
        lambda b: ~F.arrays_overlap(b["within"], F.coalesce(F.col("gone"), nothing)),
    )
    return (
        blocks.join(gone, "page", "left")
        .select("kept.*", F.array_join(F.transform(left, lambda b: b["text"]), "\n\n").alias("text"))
        .withColumn("n_chars", F.length("text").cast("bigint"))
    )
