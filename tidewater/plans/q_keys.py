"""Queries for keyed writes and lookup joins (K1-K6, K9, J1-J3) on events / documents / labels."""

from __future__ import annotations

from pyspark.sql import functions as F

from tidewater.functions import text as T
from tidewater.operators import filters, joins, report, upsert
from tidewater.plans.registry import query
from tidewater.plans.views import ARTICLES_SQL, articles
from tidewater.schemas import ARTICLE_FIELDS
from tidewater.sources.tables import scan_table

TARGET_TYPES = ["click", "view"]


def _events_split(spark, sf_dir):
    e = scan_table(spark, sf_dir, "events")
    stored = e.where(F.col("event_type").isin(TARGET_TYPES))
    target = upsert.latest_per_key(stored, "user_id", ["ts", "event_id"])
    incoming = e.where(~F.col("event_type").isin(TARGET_TYPES)).drop("props")
    return target, incoming


UPSERT_SQL = """
WITH t AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) AS rn
                          FROM events WHERE event_type IN ('click', 'view')) WHERE rn = 1),
i AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) AS rn
                     FROM events WHERE event_type NOT IN ('click', 'view')) WHERE rn = 1)
SELECT coalesce(t.user_id, i.user_id) AS user_id,
       CASE WHEN i.user_id IS NOT NULL THEN i.event_id ELSE t.event_id END AS event_id,
       CASE WHEN i.user_id IS NOT NULL THEN i.ts ELSE t.ts END AS ts,
       CASE WHEN i.user_id IS NOT NULL THEN i.event_type ELSE t.event_type END AS event_type,
       CASE WHEN i.user_id IS NOT NULL THEN i.value ELSE t.value END AS value,
       t.props AS props
FROM t FULL OUTER JOIN i ON t.user_id = i.user_id
"""


@query("upsert_by_key", sql=UPSERT_SQL)
def q_upsert_by_key(spark, sf_dir):
    """K1: click/view events are the stored table, the other events arrive without props."""
    target, incoming = _events_split(spark, sf_dir)
    return upsert.upsert_by_key(target, incoming, "user_id", ["ts", "event_id"])


@query("latest_per_key", sql="""
SELECT user_id, event_id, ts, event_type, value, props FROM (
  SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) AS rn FROM events) WHERE rn = 1
""")
def q_latest_per_key(spark, sf_dir):
    """K1 / D6 first step: one row per key, last write wins."""
    return upsert.latest_per_key(scan_table(spark, sf_dir, "events"), "user_id", ["ts", "event_id"])


@query("unprocessed", sql="SELECT doc_id, source FROM documents WHERE doc_id NOT IN (SELECT doc_id FROM labels)")
def q_unprocessed(spark, sf_dir):
    """Documents without a labels row (anti join)."""
    d = scan_table(spark, sf_dir, "documents").select("doc_id", "source")
    return joins.unprocessed(d, scan_table(spark, sf_dir, "labels"), key="doc_id")


BLOCK_FIELDS_SQL = """
SELECT regexp_extract(b, '[^\\x{09}-\\x{0D}\\x{1C}-\\x{20}]+') AS _id,
       regexp_replace(split_part(substr(b, strpos(b, 'Port Affected:') + 14), 'Date:', 1),
                      '^[\\x{09}-\\x{0D}\\x{1C}-\\x{20}]+|[\\x{09}-\\x{0D}\\x{1C}-\\x{20}]+$', '', 'g') AS port_affected
FROM (SELECT ' ' || CAST(doc_id AS VARCHAR) || chr(10) || 'Disruption event:  x' || chr(10) ||
             CASE WHEN lang <> 'de' THEN 'Port Affected: ' ELSE '' END || source || chr(10) || 'Date: ' || chr(10) ||
             lang || chr(10) AS b FROM documents)
WHERE contains(b, 'Port Affected:')
"""


@query("attach_article", sql=f"""
SELECT x._id, x.port_affected, a.headline, a.link, a.severity
FROM ({BLOCK_FIELDS_SQL}) x JOIN ({ARTICLES_SQL}) a ON x._id = a._id
WHERE NOT coalesce(a.is_editorial, false)
""")
def q_attach_article(spark, sf_dir):
    """Extraction blocks joined to their (non-editorial) article; fields default ''."""
    blocks = scan_table(spark, sf_dir, "documents").select(
        F.concat(F.lit(" "), F.col("doc_id").cast("string"), F.lit("\nDisruption event:  x\n"),
                 F.when(F.col("lang") != "de", F.lit("Port Affected: ")).otherwise(F.lit("")),
                 F.col("source"), F.lit("\nDate: \n"), F.col("lang"), F.lit("\n")).alias("block"))
    ex = blocks.where(T.block_is_complete("block")).select(*T.extract_block_fields("block"))
    out = joins.attach_article(ex, articles(spark, sf_dir), copy=["headline", "link", "severity"])
    return out.select("_id", "port_affected", "headline", "link", "severity")


@query("positional_join", sql="""
WITH c AS (SELECT conv_id, turn, row_number() OVER (ORDER BY conv_id, turn) AS p FROM conversations
           WHERE role = 'assistant'),
d AS (SELECT doc_id, row_number() OVER (ORDER BY doc_id) AS p FROM documents)
SELECT c.conv_id, c.turn, d.doc_id FROM c LEFT JOIN d ON d.p = c.p + 1
""")
def q_positional_join(spark, sf_dir):
    """Assistant answer i <-> document i+1 (explicit ordinals, offset 1)."""
    c = scan_table(spark, sf_dir, "conversations").where(F.col("role") == "assistant").select("conv_id", "turn")
    d = scan_table(spark, sf_dir, "documents").select("doc_id")
    return joins.positional_join(c, ["conv_id", "turn"], d, ["doc_id"], offset=1) \
        .select("conv_id", "turn", "doc_id")


@query("update_fields_by_key", sql=f"""
SELECT a._id, CASE WHEN l.doc_id IS NOT NULL THEN 'quality ' || CAST(l.quality AS VARCHAR) ELSE a.main_risk END
       AS main_risk, a.severity
FROM ({ARTICLES_SQL}) a LEFT JOIN labels l ON a._id = CAST(l.doc_id AS VARCHAR)
""")
def q_update_fields_by_key(spark, sf_dir):
    """K3: labels set main_risk on existing articles only."""
    a = articles(spark, sf_dir).select("_id", "main_risk", "severity")
    u = scan_table(spark, sf_dir, "labels").select(
        F.col("doc_id").cast("string").alias("_id"),
        F.concat(F.lit("quality "), F.col("quality").cast("string")).alias("main_risk"))
    return upsert.update_fields_by_key(a, u, "_id")


def _others_assignment(a):
    others = a.where(F.col("main_risk") == "Others")
    return others.select("_id", (F.substring("state", 4, 10).cast("int") % 5).alias("cluster"))


BULK_SQL = f"""
WITH a AS ({ARTICLES_SQL}),
asg AS (SELECT _id, CAST(substr(state, 4) AS INTEGER) % 5 AS cluster FROM a WHERE main_risk = 'Others'),
nm AS (SELECT DISTINCT cluster, 'Risk group ' || CAST(cluster AS VARCHAR) AS name FROM asg),
u AS (SELECT asg._id, nm.name FROM asg JOIN nm USING (cluster))
"""


def _bulk(spark, sf_dir):
    a = upsert.copy_column(articles(spark, sf_dir).select("_id", "main_risk", "state"))
    asg = _others_assignment(a)
    names = asg.select("cluster").distinct().select(
        "cluster", F.concat(F.lit("Risk group "), F.col("cluster").cast("string")).alias("name"))
    return upsert.bulk_update_others(a, asg, names)


@query("bulk_update_others", sql=BULK_SQL + """
SELECT a._id, CASE WHEN u._id IS NOT NULL THEN u.name ELSE a.main_risk END AS final_risk
FROM a LEFT JOIN u ON a._id = u._id
""")
def q_bulk_update_others(spark, sf_dir):
    """K5 + K4: final_risk = main_risk, then Others rows get their cluster's name."""
    return _bulk(spark, sf_dir)[0].select("_id", "final_risk")


@query("bulk_update_modified", sql=BULK_SQL + """
SELECT count(*) AS modified_count FROM u JOIN a ON u._id = a._id WHERE u.name IS DISTINCT FROM a.main_risk
""")
def q_bulk_update_modified(spark, sf_dir):
    """K4: the reported modified count."""
    return _bulk(spark, sf_dir)[1]


@query("delete_discovered", sql="""
SELECT _id FROM (SELECT CASE WHEN n_chars % 2 = 0 THEN CAST(doc_id AS VARCHAR) ELSE 'd' || CAST(doc_id AS VARCHAR) END
                 AS _id FROM documents) WHERE TRY_CAST(_id AS INTEGER) IS NOT NULL
""")
def q_delete_discovered(spark, sf_dir):
    """K6: ids that are integers survive; generated ids are dropped."""
    c = scan_table(spark, sf_dir, "documents").select(
        F.when(F.col("n_chars") % 2 == 0, F.col("doc_id").cast("string"))
        .otherwise(F.concat(F.lit("d"), F.col("doc_id").cast("string"))).alias("_id"))
    return upsert.delete_discovered(c)


@query("numbered_lines", sql="""
SELECT row_number() OVER (ORDER BY doc_id) AS n,
       CAST(row_number() OVER (ORDER BY doc_id) AS VARCHAR) || '. ' || replace(text, chr(10), ' ') || chr(10) || chr(10)
       AS line FROM documents
""")
def q_numbered_lines(spark, sf_dir):
    """K9: '{n}. {headline}' records numbered from 1 in doc_id order."""
    d = scan_table(spark, sf_dir, "documents").select("doc_id", F.translate("text", "\n", " ").alias("h"))
    return upsert.numbered_lines(d, "h", ["doc_id"])


@query("append_rows", sql=f"""
SELECT _id, {', '.join(f"coalesce({c}, '') AS {c}" if c in ('_id', 'headline', 'link') else f"'' AS {c}"
                       for c in ARTICLE_FIELDS[1:])}
FROM (SELECT CAST(item_id AS VARCHAR) AS _id, text AS headline, NULL AS link FROM benchmark)
""")
def q_append_rows(spark, sf_dir):
    """K2: benchmark items appended to an empty article table; missing fields ''."""
    b = scan_table(spark, sf_dir, "benchmark").select(
        F.col("item_id").cast("string").alias("_id"), F.col("text").alias("headline"),
        F.lit(None).cast("string").alias("link"))
    return upsert.append_rows(None, b, ARTICLE_FIELDS)


@query("append_to_articles", sql=f"""
SELECT _id, headline, link, severity FROM ({ARTICLES_SQL})
UNION ALL
SELECT CAST(item_id AS VARCHAR), text, '', '' FROM benchmark
""")
def q_append_to_articles(spark, sf_dir):
    """K2: benchmark items appended to the articles, whose rows stay as they are."""
    b = scan_table(spark, sf_dir, "benchmark").select(F.col("item_id").cast("string").alias("_id"), F.col("text").alias("headline"))
    a = articles(spark, sf_dir).select("_id", "headline", "link", "severity")
    return upsert.append_rows(a, b, ["_id", "headline", "link", "severity"])


# ------------------------------------------------------------------ S1, F8, J8, A10, D5, D6, T7, T18


@query("scan_table", sql="SELECT * FROM orders")
def q_scan_table(spark, sf_dir):
    """A whole collection as a table."""
    return scan_table(spark, sf_dir, "orders")


@query("others_with_minimum", sql=f"SELECT _id, headline FROM ({ARTICLES_SQL}) WHERE main_risk = 'Others'")
def q_others_with_minimum(spark, sf_dir):
    """F8: 'Others' articles, guarded by a minimum count (50 here; the reference's default is 500)."""
    return filters.others_with_minimum(articles(spark, sf_dir), minimum=50).select("_id", "headline")


@query("name_clusters", sql=BULK_SQL + """
SELECT asg._id, asg.cluster, nm.name FROM asg LEFT JOIN nm USING (cluster)
""")
def q_name_clusters(spark, sf_dir):
    """Cluster id -> category name for every 'Others' article (joined by id, not position)."""
    a = articles(spark, sf_dir).select("_id", "main_risk", "state")
    asg = _others_assignment(a)
    names = asg.select("cluster").distinct().select(
        "cluster", F.concat(F.lit("Risk group "), F.col("cluster").cast("string")).alias("name"))
    return joins.name_clusters(asg, names).select("_id", "cluster", "name")


@query("sample_rows")
def q_sample_rows(spark, sf_dir):
    """A10: 100 documents without replacement, repeatable (seed 42), independent of partitioning."""
    return report.sample_rows(scan_table(spark, sf_dir, "documents").select("doc_id", "source"), 100, 42, "doc_id")


@query("dedup_by_url", sql="""
SELECT u AS url, page_id FROM (
  SELECT regexp_replace(url, '[?#].*$', '') AS u, page_id,
         row_number() OVER (PARTITION BY regexp_replace(url, '[?#].*$', '') ORDER BY page_id DESC) AS rn
  FROM pages) WHERE rn = 1
""")
def q_dedup_by_url(spark, sf_dir):
    """Pages stored once per url (query and fragment dropped), the latest page wins."""
    p = scan_table(spark, sf_dir, "pages").select(F.regexp_replace("url", r"[?#].*$", "").alias("url"), "page_id")
    return upsert.latest_per_key(p, "url", ["page_id"])
