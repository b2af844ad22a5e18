"""Fetched pages -> articles (S3, S9, H1-H6, with F1-F3).

Parsing is the one per-row step that needs Python: a single ``mapInPandas``
pass over the ``pages(url, html)`` table runs the stdlib HTML parser once per
page and returns raw pieces (title text, direct <p> text nodes, links, author,
paywall flag). Everything after that — cleaning, joining nodes, URL filters,
site selection, assembly, counts — is Catalyst expressions and aggregations.
"""

from __future__ import annotations

import codecs
import re
from collections.abc import Iterator, Sequence
from functools import lru_cache
from html.parser import HTMLParser
from urllib.parse import urljoin

import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidewater.functions import text as T

# Per-site selectors (links of a search page, article title, author), by a part of the host's name.
SITE_PROFILES = {
    "gcaptain": {"links": "div.article a.headline", "title": "h1", "author": "div.meta a.author"},
    "loadstar": {"links": "div.col-4.col-tab-7.col-mob-14 article.card.pad a", "title": "h1 a", "author": None},
    "maritime-executive": {"links": "div.list-group button a", "title": "h1", "author": None},
    "tradewinds": {"links": "div.col-12 a.card-link.text-reset", "title": "h1.article-title", "author": None},
    "vesselfinder": {"links": "section.listing h2.atitle a", "title": "h1.title", "author": None},
    "default": {"links": "a", "title": "h1", "author": None},
}
PAYWALL = "div.sub-paywall-container"
HOST = r"^[A-Za-z][A-Za-z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:]*)"
VOID = {"br", "img", "hr", "meta", "link", "input", "source", "wbr", "area", "base", "col", "embed", "param",
        "track"}

PARSED_SCHEMA = ("page_id long, url string, site string, title_raw string, nodes array<string>, "
                 "links array<string>, author string, paywalled boolean, problem string")


def site_profile(url: Column) -> Column:
    """H4: the site whose name lies in the url's host, else 'default'; what follows the host doesn't count."""
    host = F.lower(F.regexp_extract(url, HOST, 1))
    site = F.lit("default")
    for name in reversed([n for n in SITE_PROFILES if n != "default"]):
        site = F.when(F.contains(host, F.lit(name)), F.lit(name)).otherwise(site)
    return site


def site_of(url: str) -> str:
    """The same rule for one url."""
    host = re.match(HOST, url or "")
    name = host[1].lower() if host else ""
    return next((n for n in SITE_PROFILES if n != "default" and n in name), "default")


@lru_cache(maxsize=256)
def selector(css: str | None) -> tuple[tuple[bool, str, frozenset], ...]:
    """A selector of tags and classes as steps (is a direct child, tag or '', classes), outermost first.

    A blank means any descendant, '>' a child: 'section.listing > h2.atitle a'.
    """
    steps, child = [], False
    for part in (css or "").replace(">", " > ").split():
        if part == ">":
            child = True
            continue
        tag, *classes = part.split(".")
        steps.append((child, tag, frozenset(classes)))
        child = False
    return tuple(steps)


def matches(steps, path) -> bool:
    """Does the innermost element of ``path``, the open elements (tag, classes, ...), match the whole selector?"""
    def fits(step, element):
        return step[1] in ("", element[0]) and step[2] <= element[1]

    def above(s, at):  # steps[s] must be met by an element above place at
        if s < 0:
            return True
        if steps[s + 1][0]:
            return at > 0 and fits(steps[s], path[at - 1]) and above(s - 1, at - 1)
        return any(fits(steps[s], path[i]) and above(s - 1, i) for i in range(at - 1, -1, -1))

    return bool(steps) and bool(path) and fits(steps[-1], path[-1]) and above(len(steps) - 2, len(path) - 1)


class _PageParser(HTMLParser):
    """Collects what the article extractors need in one pass.

    Rules: a new <p> closes an open one; script/style text is ignored; only
    text whose parent element is a class-less <p> counts as a body node.
    """

    def __init__(self, profile):
        super().__init__(convert_charrefs=True)
        self.wanted = {part: selector(profile[part]) for part in ("links", "title", "author")}
        self.paywall = selector(PAYWALL)
        self.stack: list[tuple[str, frozenset, set]] = []  # open elements: tag, classes, whose text it may give
        self.nodes: list[str] = []
        self.links: list[str] = []
        self.texts: dict[str, str] = {}
        self.paywalled = False
        self._skip = 0

    def handle_starttag(self, tag, attrs):
        a = dict(attrs)
        if tag == "p" and any(e[0] == "p" for e in self.stack):
            while self.stack.pop()[0] != "p":
                pass
        if tag in ("script", "style"):
            self._skip += 1
        gives = {"body"} if tag == "p" and "class" not in a else set()
        self.stack.append((tag, frozenset((a.get("class") or "").split()), gives))
        if matches(self.paywall, self.stack):
            self.paywalled = True
        if a.get("href") and matches(self.wanted["links"], self.stack):
            self.links.append(a["href"])
        gives.update(part for part in ("title", "author") if part not in self.texts and matches(self.wanted[part], self.stack))
        if tag in VOID:
            self.stack.pop()

    def handle_endtag(self, tag):
        if tag in ("script", "style") and self._skip:
            self._skip -= 1
        for i in range(len(self.stack) - 1, -1, -1):
            if self.stack[i][0] == tag:
                del self.stack[i:]
                break

    def handle_data(self, data):
        if self._skip or not self.stack:
            return
        gives = self.stack[-1][2]
        if "body" in gives:
            self.nodes.append(data)
        for part in gives - {"body"}:
            self.texts.setdefault(part, data)


def parse_page(url: str, html: str) -> dict:
    """The raw pieces of one page. A null page has none; where the parser gives up, ``problem`` says so beside what it had read."""
    site, problem = site_of(url), None
    p = _PageParser(SITE_PROFILES[site])
    links = []
    try:
        p.feed(html or "")
        p.close()
        links = [urljoin(url or "", h) for h in p.links]
    except Exception as e:  # noqa: BLE001 - a malformed page or link is data, not a failed job
        problem = f"{type(e).__name__}: {e}"
    return {"site": site, "title_raw": p.texts.get("title"), "nodes": p.nodes, "links": links,
            "author": p.texts.get("author"), "paywalled": p.paywalled, "problem": problem}


#: Pages that are parsed before their pieces go on: it bounds what a task holds beside the batch that came.
PARSED_PAGES = 64


def _parse_batches(it):
    kinds = [pa.string(), pa.string(), pa.list_(pa.string()), pa.list_(pa.string()), pa.string(), pa.bool_(), pa.string()]
    names = ["site", "title_raw", "nodes", "links", "author", "paywalled", "problem"]
    for batch in it:
        for s in range(0, batch.num_rows, PARSED_PAGES):
            part = batch.slice(s, PARSED_PAGES)
            ids, urls, htmls = (part.column(c) for c in ("page_id", "url", "html"))
            rows = [parse_page(urls[i].as_py(), htmls[i].as_py()) for i in range(part.num_rows)]
            yield pa.RecordBatch.from_arrays([ids, urls, *(pa.array([r[c] for r in rows], k) for c, k in zip(names, kinds))], ["page_id", "url", *names])


def parse_pages(pages: DataFrame) -> DataFrame:
    """S3 + H4: one parsing pass (mapInArrow) -> raw pieces per page."""
    return pages.select(F.col("page_id").cast("long"), "url", "html").mapInArrow(_parse_batches, PARSED_SCHEMA)


BOMS = [(codecs.BOM_UTF8, "utf-8-sig"), (codecs.BOM_UTF16_LE, "utf-16"), (codecs.BOM_UTF16_BE, "utf-16")]
DECLARED = re.compile(rb"<meta[^>]*charset\s*=\s*[\"']?\s*([A-Za-z0-9_.:-]+)", re.I)


def decode_page(raw: bytes) -> tuple[str, str, str | None]:
    """(html, charset, problem) of a page's bytes: charset by byte order mark, else by a meta tag, else UTF-8.

    An unknown charset counts as UTF-8. Bytes that the charset doesn't have become U+FFFD and are told in the problem.
    """
    declared = DECLARED.search(raw)
    charset = next((name for mark, name in BOMS if raw.startswith(mark)), declared[1].decode("ascii").lower() if declared else "utf-8")
    problem = None
    try:
        codecs.lookup(charset)
    except LookupError:
        charset, problem = "utf-8", f"unknown charset {charset}"
    try:
        return raw.decode(charset), charset, problem
    except UnicodeDecodeError as e:
        return raw.decode(charset, "replace"), charset, f"byte {e.start}: {e.reason}"


def scan_page_dumps(spark: SparkSession, folder: str, glob: str = "*.html") -> DataFrame:
    """S3: saved pages, one file each -> (path, html, charset, problem); broken bytes are data. Empty files hold no page; Spark doesn't list them."""
    def decode(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for files in batches:
            pages = [(path, *decode_page(raw)) for path, raw in zip(files["path"], files["content"])]
            yield pd.DataFrame(pages, columns=["path", "html", "charset", "problem"])

    raw = spark.read.format("binaryFile").option("pathGlobFilter", glob).load(folder).select("path", "content")
    return raw.mapInPandas(decode, "path string, html string, charset string, problem string")


def extract_links(parsed: DataFrame) -> DataFrame:
    """H1: (page_id, position, link) for every matching anchor, resolved against the page url."""
    return parsed.select("page_id", F.posexplode("links").alias("position", "link"))


def extract_title(parsed: DataFrame) -> DataFrame:
    """H2: first text directly in an element of the site's title selector, cleaned; '' if absent."""
    return parsed.select("page_id", T.clean_text(F.coalesce("title_raw", F.lit(""))).alias("title"))


def extract_body(parsed: DataFrame) -> DataFrame:
    """H3: cleaned direct <p> text nodes joined by one space, ends trimmed (empty nodes stay)."""
    body = F.trim(F.array_join(F.transform("nodes", lambda n: T.clean_text(n)), " "))
    return parsed.select("page_id", body.alias("body"))


def article_kept(drop_editorial: bool = True, drop_paywalled: bool = True, article_urls_only: Sequence[str] = ("maritime-executive",)) -> Column:
    """F1-F3 over parsed pages: no editorial author, no paywall, and an article's url for the sites that need one."""
    kept = F.lit(True)
    if drop_editorial:
        kept &= ~F.coalesce(F.col("author").contains("Editorial"), F.lit(False))
    if drop_paywalled:
        kept &= ~F.col("paywalled")
    if article_urls_only:
        needs = F.col("site").isin(list(article_urls_only))
        kept &= ~needs | F.coalesce(F.col("url").contains("article") & ~F.col("url").contains("editorial"), F.lit(False))
    return kept


def assemble_articles(parsed: DataFrame, drop_editorial: bool = True, drop_paywalled: bool = True,
                      article_urls_only: Sequence[str] = ("maritime-executive",)) -> DataFrame:
    """H5 with F1-F3: Article rows (_id = link = page url), '' for the unfilled fields."""
    d = parsed.where(article_kept(drop_editorial, drop_paywalled, article_urls_only))
    body = F.trim(F.array_join(F.transform("nodes", lambda n: T.clean_text(n)), " "))
    title = T.clean_text(F.coalesce("title_raw", F.lit("")))
    return d.select(F.col("url").alias("_id"), title.alias("headline"), body.alias("description"),
                    F.lit("").alias("severity"), F.lit("").alias("main_risk"), F.lit("").alias("country"),
                    F.lit("").alias("state"), F.col("url").alias("link"))


def crawl_counts(parsed: DataFrame) -> DataFrame:
    """H6: pages per site, articles kept by F1-F3, paywalled ones."""
    return parsed.groupBy("site").agg(F.count(F.lit(1)).alias("pages"), F.count_if(article_kept()).alias("kept"),
                                      F.count_if(F.col("paywalled")).alias("paywalled"))


def crawl_frontier(spark: SparkSession, template: str, keywords: DataFrame | None = None,
                   pages: tuple[int, int] = (1, 10), keyword_col: str = "keyword") -> DataFrame:
    """Start URLs = keywords x page numbers filled into a template ('{keyword}', '{page}')."""
    lo, hi = pages
    if keywords is None:
        base = spark.range(1).select(F.lit("").alias(keyword_col))
    else:
        base = keywords.select(keyword_col)
    d = base.select(keyword_col, F.explode(F.sequence(F.lit(lo), F.lit(hi))).alias("page"))
    url = F.replace(F.replace(F.lit(template), F.lit("{keyword}"), F.col(keyword_col)),
                    F.lit("{page}"), F.col("page").cast("string"))
    return d.select(keyword_col, "page", url.alias("url"))
