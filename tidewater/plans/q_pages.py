"""Queries for page extraction (S3, S9, H1-H6) on the pages table."""

from __future__ import annotations

from pyspark.sql import functions as F

from tidewater.plans.registry import query
from tidewater.plans.q_text import s_clean
from tidewater.sources import pages as P
from tidewater.sources.tables import scan_table


def parsed(spark, sf_dir):
    return P.parse_pages(scan_table(spark, sf_dir, "pages"))


@query("extract_title", sql=f"""
SELECT page_id, {s_clean("replace(regexp_extract(html, '<h1[^>]*>([^<]*)', 1), '&amp;', '&')")} AS title FROM pages
""")
def q_extract_title(spark, sf_dir):
    """H2: first text node of each page's <h1>, cleaned."""
    return P.extract_title(parsed(spark, sf_dir))


@query("extract_links")
def q_extract_links(spark, sf_dir):
    """H1: anchors in order, resolved against the page url."""
    return P.extract_links(parsed(spark, sf_dir))


@query("extract_body")
def q_extract_body(spark, sf_dir):
    """H3: direct text nodes of class-less <p>, cleaned and joined."""
    return P.extract_body(parsed(spark, sf_dir))


@query("assemble_articles")
def q_assemble_articles(spark, sf_dir):
    """H5 (+F1-F3): Article rows from pages, keyed by url."""
    return P.assemble_articles(parsed(spark, sf_dir))


def _site_sql() -> str:
    out = "'default'"
    for name in reversed([n for n in P.SITE_PROFILES if n != "default"]):
        out = f"CASE WHEN contains(lower(regexp_extract(url, '{P.HOST}', 1)), '{name}') THEN '{name}' ELSE {out} END"
    return out


# The stand-in for a crawl: pages moved to the sites' hosts, some with an author or a paywall, some with a site's name in the path only.
SITE_PAGES_SQL = """
SELECT page_id, 'https://' || CASE page_id % 6 WHEN 0 THEN 'gcaptain.com' WHEN 1 THEN 'theloadstar.com' WHEN 2 THEN 'www.maritime-executive.com'
         WHEN 3 THEN 'www.tradewindsnews.com' WHEN 4 THEN 'www.vesselfinder.com' ELSE 'example.org' END
         || CASE page_id % 5 WHEN 0 THEN '/editorial/article/' WHEN 1 THEN '/tag/gcaptain/' ELSE '/article/' END || page_id AS url,
       CASE WHEN page_id % 4 = 0 THEN '<div class="meta"><a class="author">Editorial Team</a></div>' ELSE '' END
         || CASE WHEN page_id % 7 = 0 THEN '<div class="x sub-paywall-container">y</div>' ELSE '' END || html AS html
FROM pages
"""


def site_pages(spark, sf_dir):
    """Pages as a crawl of the known sites would give them, by the same SQL on Spark."""
    return spark.sql(SITE_PAGES_SQL.replace("FROM pages", "FROM {pages}"), pages=scan_table(spark, sf_dir, "pages"))


@query("crawl_counts", sql=f"""
SELECT site, count(*) AS pages, count(*) FILTER (WHERE NOT editorial AND NOT paywalled AND fits) AS kept,
       count(*) FILTER (WHERE paywalled) AS paywalled
FROM (SELECT {_site_sql()} AS site, site = 'gcaptain' AND contains(html, '<a class="author">Editorial') AS editorial,
        contains(html, '<div class="x sub-paywall-container">') AS paywalled,
        site <> 'maritime-executive' OR (contains(url, 'article') AND NOT contains(url, 'editorial')) AS fits
      FROM ({SITE_PAGES_SQL})) GROUP BY site
""")
def q_crawl_counts(spark, sf_dir):
    """H6 with F1-F3: pages, kept and paywalled counts per site."""
    return P.crawl_counts(P.parse_pages(site_pages(spark, sf_dir)))


TEMPLATE = "https://news.example.com/search?q={keyword}&page={page}"


@query("crawl_frontier", sql=f"""
SELECT event_type AS keyword, page,
       replace(replace('{TEMPLATE}', '{{keyword}}', event_type), '{{page}}', CAST(page AS VARCHAR)) AS url
FROM (SELECT DISTINCT event_type FROM events), range(1, 11) t(page)
""")
def q_crawl_frontier(spark, sf_dir):
    """Search URLs for every event type x pages 1..10."""
    kw = scan_table(spark, sf_dir, "events").select(F.col("event_type").alias("keyword")).distinct()
    return P.crawl_frontier(spark, TEMPLATE, kw, (1, 10)).select("keyword", F.col("page").cast("long"), "url")


@query("site_profile", sql=f"SELECT page_id, {_site_sql()} AS site FROM ({SITE_PAGES_SQL})")
def q_site_profile(spark, sf_dir):
    """H4: the selector profile chosen for every page by its host, without a parse."""
    return site_pages(spark, sf_dir).select("page_id", P.site_profile(F.col("url")).alias("site"))
