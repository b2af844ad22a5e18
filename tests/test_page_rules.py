"""Selectors of the sites on pages with decoys, direct title text, hosts, counts, page dumps."""

import os
import tempfile

import pytest
from pyspark.sql import functions as F

from tidewater.sources import pages as P

PAGES = {
    "https://gcaptain.com/?s=x": ("<a class='headline' href='/menu'>m</a><div class='article'><span><a class='headline big' href='/1'>a</a></span>"
                                  "<a href='/plain'>p</a></div><a class='headline' href='/after'>z</a>", ["/1"]),
    "https://theloadstar.com/": ("<article class='card pad'><a href='/side'>s</a></article><div class='col-4 col-tab-7 col-mob-14 x'><article class='card'>"
                                 "<a href='/nopad'>n</a></article><article class='pad card'><h2><a href='/2'>b</a></h2></article></div>", ["/2"]),
    "https://www.maritime-executive.com/search": ("<button><a href='/login'>l</a></button><div class='list-group'><a href='/bare'>b</a>"
                                                  "<button><a href='/3'>c</a></button></div>", ["/3"]),
    "https://www.tradewindsnews.com/archive": ("<a class='card-link text-reset' href='/top'>t</a><div class='col-12'><a class='card-link' href='/half'>h</a>"
                                               "<img><a class='text-reset card-link' href='/4'>d</a></div>", ["/4"]),
    "https://www.vesselfinder.com/news": ("<h2 class='atitle'><a href='/menu'>m</a></h2><section class='listing'><h2><a href='/h2'>h</a></h2>"
                                          "<div><h2 class='atitle'><a href='/5'>e</a></h2></div></section>", ["/5"]),
    "https://other.org/": ("<a href='/6'>f</a><a>none</a><a href=''>empty</a>", ["/6"]),
}


def test_links_of_each_site_among_decoys(spark):
    rows = [(i, u, h) for i, (u, (h, _)) in enumerate(PAGES.items())] + [(99, None, None)]
    got = P.extract_links(P.parse_pages(spark.createDataFrame(rows, "page_id long, url string, html string"))).collect()
    want = [(i, n, "/".join(u.split("/")[:3]) + link) for i, (u, (_, links)) in enumerate(PAGES.items()) for n, link in enumerate(links)]
    assert sorted(tuple(r) for r in got) == want


def test_child_steps():
    def path(*elements):
        return [(t, frozenset(c.split())) for t, c in elements]
    assert P.matches(P.selector("div.a > b"), path(("div", "a"), ("b", "")))
    assert not P.matches(P.selector("div.a > b"), path(("div", "a"), ("i", ""), ("b", "")))
    assert P.matches(P.selector("div > p b"), path(("div", ""), ("p", ""), ("p", ""), ("b", "")))  # the nearer p isn't the one
    assert not P.matches(P.selector(None), path(("b", "")))


@pytest.mark.parametrize("html,title", [("<h1><span>inner</span></h1>", None), ("<h1><b>x</b> tail</h1>", " tail"), ("<h1>a &amp; b<br>c</h1>", "a & b"),
                                        ("<h1><i>x</i></h1><h1>second</h1>", "second"), ("", None)])
def test_title_is_direct_text(html, title):
    assert P.parse_page("https://e.org/", html)["title_raw"] == title


def test_sites_go_by_host(spark):
    urls = {"https://gcaptain.com/a": "gcaptain", "https://example.org/tag/gcaptain": "default", "http://u@WWW.TheLoadStar.com:80/x": "loadstar",
            "https://example.org?u=vesselfinder.com": "default", "gcaptain.com/a": "default", "": "default", None: "default"}
    rows = spark.createDataFrame([(u,) for u in urls], "url string").select("url", P.site_profile(F.col("url")).alias("site")).collect()
    assert {r.url: r.site for r in rows} == urls and all(P.site_of(u) == s for u, s in urls.items())


def test_counts_follow_the_filters(spark):
    lock = "<div class='sub-paywall-container'></div>"
    rows = [(1, "https://www.maritime-executive.com/article/a", ""), (2, "https://www.maritime-executive.com/editorial/article", ""), (3, "https://www.maritime-executive.com/x", ""),
            (4, "https://www.tradewindsnews.com/a", lock), (5, "https://www.tradewindsnews.com/b", None), (6, "https://gcaptain.com/c", "<div class='meta'><a class='author'>Editorial</a></div>")]
    parsed = P.parse_pages(spark.createDataFrame(rows, "page_id long, url string, html string"))
    got = {r.site: (r.pages, r.kept, r.paywalled) for r in P.crawl_counts(parsed).collect()}
    assert got == {"maritime-executive": (3, 1, 0), "tradewinds": (2, 1, 1), "gcaptain": (1, 0, 0)}
    assert sorted(r._id for r in P.assemble_articles(parsed).collect()) == [rows[0][1], rows[4][1]]


def test_page_dumps_keep_broken_pages(spark):
    d = tempfile.mkdtemp(prefix="tw-dumps-")
    files = {"a.html": ("<p>é</p>".encode(), "<p>é</p>", "utf-8", False), "b.html": (b"<meta charset='ISO-8859-1'><p>\xe9</p>", "<meta charset='ISO-8859-1'><p>é</p>", "iso-8859-1", False),
             "c.html": ("<p>ü</p>".encode("utf-16"), "<p>ü</p>", "utf-16", False), "d.html": (b"<p>\xff!</p>", "<p>�!</p>", "utf-8", True),
             "e.html": (b"<meta charset=nope>x", "<meta charset=nope>x", "utf-8", True), "f.html": (b"", "", "utf-8", False), "g.html": ("﻿x".encode(), "x", "utf-8-sig", False)}
    for name, (raw, *_) in files.items():
        with open(os.path.join(d, name), "wb") as f:
            f.write(raw)
    got = {os.path.basename(r.path): (r.html, r.charset, r.problem is not None) for r in P.scan_page_dumps(spark, d).collect()}
    assert got == {name: tuple(rest) for name, (raw, *rest) in files.items() if raw}  # Spark lists no empty files
