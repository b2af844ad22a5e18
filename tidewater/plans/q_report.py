"""Queries for the reporting operators (A2-A9, A12, S2, F7) on orders / documents / labels."""

from __future__ import annotations

from pyspark.sql import functions as F

from tidewater.operators import filters, report
from tidewater.plans.registry import query
from tidewater.plans.views import ARTICLES_SQL, articles
from tidewater.sources.tables import scan_filtered, scan_table

# orders stand in for processed articles: priority = risk type, status = severity
PCT = "round_even(n * 1000.0 / total, 0) / 10.0"


@query("risk_severity_matrix", sql=f"""
WITH c AS (
  SELECT o_orderpriority AS risk, o_orderstatus AS severity, count(*) AS n FROM orders
  WHERE o_orderpriority IS NOT NULL AND o_orderstatus IS NOT NULL GROUP BY ALL
  UNION ALL
  SELECT 'All', o_orderstatus, count(*) FROM orders
  WHERE o_orderpriority IS NOT NULL AND o_orderstatus IS NOT NULL GROUP BY ALL
), w AS (
  SELECT risk, coalesce(sum(n) FILTER (WHERE severity = 'F'), 0) AS nf,
         coalesce(sum(n) FILTER (WHERE severity = 'O'), 0) AS no_,
         coalesce(sum(n) FILTER (WHERE severity = 'P'), 0) AS np, sum(n) AS total
  FROM c GROUP BY risk
)
SELECT risk, round_even(nf * 1000.0 / total, 0) / 10.0 AS "F",
       round_even(no_ * 1000.0 / total, 0) / 10.0 AS "O",
       round_even(np * 1000.0 / total, 0) / 10.0 AS "P"
FROM w
""")
def q_risk_severity_matrix(spark, sf_dir):
    """A4: priority x status crosstab, row percent, with the All row."""
    o = scan_table(spark, sf_dir, "orders")
    return report.risk_severity_matrix(o, "o_orderpriority", "o_orderstatus", severities=["F", "O", "P"])


@query("dominant_severity", sql=f"""
WITH c AS (
  SELECT o_orderpriority AS risk, o_orderstatus AS severity, count(*) AS n FROM orders
  WHERE o_orderpriority IS NOT NULL AND o_orderstatus IS NOT NULL GROUP BY ALL
), t AS (SELECT risk, severity, n, sum(n) OVER (PARTITION BY risk) AS total FROM c),
p AS (SELECT risk, severity, {PCT} AS pct FROM t)
SELECT risk, severity AS dominant_severity, pct AS dominant_pct FROM (
  SELECT *, row_number() OVER (PARTITION BY risk ORDER BY pct DESC, severity) AS rk FROM p) WHERE rk = 1
""")
def q_dominant_severity(spark, sf_dir):
    """A5: most common status per priority (smallest label on ties)."""
    o = scan_table(spark, sf_dir, "orders")
    return report.dominant_severity(o, "o_orderpriority", "o_orderstatus", severities=["F", "O", "P"])


@query("value_counts", sql="""
SELECT o_orderpriority, count(*) AS count FROM orders WHERE o_orderpriority IS NOT NULL GROUP BY ALL
""")
def q_value_counts(spark, sf_dir):
    """A3: rows per priority, descending."""
    return report.value_counts(scan_table(spark, sf_dir, "orders"), "o_orderpriority")


@query("pending_counts", sql=f"""
SELECT count(*) AS total, count(*) FILTER (WHERE main_risk = '' AND is_unique) AS matching,
       count(*) - count(*) FILTER (WHERE main_risk = '' AND is_unique) AS remaining
FROM ({ARTICLES_SQL})
""")
def q_pending_counts(spark, sf_dir):
    """A2: articles, articles pending a category, and the rest."""
    a = articles(spark, sf_dir)
    return report.pending_counts(a, filters.pending_category_predicate())


@query("severity_distribution", sql=f"""
WITH c AS (SELECT o_orderpriority, o_orderstatus, count(*) AS n FROM orders
           WHERE o_orderstatus IS NOT NULL GROUP BY ALL),
t AS (SELECT *, sum(n) OVER (PARTITION BY o_orderpriority) AS total FROM c)
SELECT o_orderpriority, o_orderstatus, n, {PCT} AS pct FROM t
""")
def q_severity_distribution(spark, sf_dir):
    """Percent of orders per status, per priority (the 'model' dimension)."""
    o = scan_table(spark, sf_dir, "orders")
    return report.severity_distribution(o, "o_orderstatus", by=["o_orderpriority"])


@query("scan_filtered", sql="""
SELECT o_orderkey, o_orderpriority, o_totalprice FROM orders WHERE o_orderstatus = 'O'
ORDER BY o_orderkey LIMIT 500
""")
def q_scan_filtered(spark, sf_dir):
    """S2 (and F6 run cap): predicate + field list + ordered limit of 500."""
    o = scan_table(spark, sf_dir, "orders")
    return scan_filtered(o, F.col("o_orderstatus") == "O", ["o_orderkey", "o_orderpriority", "o_totalprice"],
                         limit=500, order_by=["o_orderkey"])


@query("pending_category", sql=f"""
SELECT _id, headline FROM ({ARTICLES_SQL}) WHERE main_risk = '' AND is_unique
""")
def q_pending_category(spark, sf_dir):
    """articles with an empty category that are unique."""
    return filters.pending_category(articles(spark, sf_dir)).select("_id", "headline")


@query("catalogue_text", sql="""
SELECT lang, array_to_string(list_sort(list(chr(9) || '- ' || source || ': ' || CAST(n AS VARCHAR) || ' documents')), chr(10)) AS catalogue
FROM (SELECT lang, source, count(*) AS n FROM documents GROUP BY ALL) GROUP BY lang
""")
def q_catalogue_text(spark, sf_dir):
    """Per language, one bullet string of sources and their document counts."""
    d = scan_table(spark, sf_dir, "documents").groupBy("lang", "source").agg(F.count(F.lit(1)).alias("n"))
    d = d.withColumn("desc", F.concat(F.col("n").cast("string"), F.lit(" documents")))
    return report.catalogue_text(d, "source", "desc", by=["lang"])


CLUSTER_SUMMARY_SQL = """
WITH s AS (SELECT source, count(*) AS size FROM documents GROUP BY source),
r AS (SELECT source, doc_id, headline FROM (
        SELECT source, doc_id, replace(text, chr(10), ' ') AS headline,
               row_number() OVER (PARTITION BY source ORDER BY doc_id) AS rk FROM documents) WHERE rk <= 20),
f AS (SELECT source, list(headline ORDER BY doc_id) AS sample_texts FROM r GROUP BY source)
SELECT s.source, s.size, f.sample_texts FROM s JOIN f USING (source)
"""


def _cluster_summary(spark, sf_dir):
    d = scan_table(spark, sf_dir, "documents").select(
        "source", "doc_id", F.translate("text", "\n", " ").alias("headline"))
    return report.cluster_summary(d, "source", "headline", "doc_id", samples=20)


@query("cluster_summary", sql=CLUSTER_SUMMARY_SQL)
def q_cluster_summary(spark, sf_dir):
    """Per source (as cluster) its size and first 20 headlines by doc_id."""
    return _cluster_summary(spark, sf_dir)


@query("format_risk_analysis", sql=f"""
SELECT source AS category, size AS number_of_incidents,
       array_to_string(sample_texts[1:3], chr(10)) AS example_incidents FROM ({CLUSTER_SUMMARY_SQL})
""")
def q_format_risk_analysis(spark, sf_dir):
    """Category, Number of Incidents, first three examples."""
    return report.format_risk_analysis(_cluster_summary(spark, sf_dir), category="source")


@query("concat_tables", sql="""
SELECT doc_id, text, lang, NULL::BIGINT AS item_id FROM documents
UNION ALL
SELECT NULL::BIGINT, text, NULL::VARCHAR, item_id FROM benchmark
""")
def q_concat_tables(spark, sf_dir):
    """Documents and benchmark appended by name, missing columns null."""
    d = scan_table(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    b = scan_table(spark, sf_dir, "benchmark").select("text", "item_id")
    return report.concat_tables([d, b])
