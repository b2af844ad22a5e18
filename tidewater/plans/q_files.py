"""Round-trip queries for record-file sources and sinks.

Each query writes a text/CSV export derived from the given tables into the
shared scratch folder (under spark.checkpoint.dir) and reads it back with the
source operator, so the result is comparable with SQL over the same tables.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from tidewater.operators import upsert
from tidewater.plans.registry import query
from tidewater.session import scratch_path
from tidewater.sources import records
from tidewater.sources.tables import scan_table

BLOCK_SQL_PORT = """
SELECT CAST(doc_id AS VARCHAR) AS _id, 'event ' || CAST(doc_id AS VARCHAR) AS event, source AS port_affected,
       lang AS date FROM documents
"""


def _files(df):
    """How many files an export is dealt to: more the more tasks its table's scan has, so that no task writes or reads a fixed share."""
    return max(3, 4 * (df.rdd.getNumPartitions() - 1))


def text_field():
    """Line 'Text: <the whole text>' of an exported record, line ends as spaces; a null text is empty."""
    return F.concat(F.lit("\nText: "), F.translate(F.coalesce("text", F.lit("")), "\n", " "))


@query("scan_id_blocks", sql=BLOCK_SQL_PORT)
def q_scan_id_blocks(spark, sf_dir):
    """Documents exported as 'id:' blocks (several files), read back and parsed."""
    d = scan_table(spark, sf_dir, "documents")
    path = scratch_path(spark, "id-blocks")
    blocks = d.select(F.concat(F.lit("id: "), F.col("doc_id").cast("string"), F.lit("\nDisruption event: event "),
                               F.col("doc_id").cast("string"), F.lit("\nPort Affected: "), F.col("source"),
                               F.lit("\nDate: "), F.col("lang"), text_field(), F.lit("\n\n")).alias("value"))
    blocks.write.mode("overwrite").text(path)
    return records.scan_id_blocks(spark, path).select("_id", "event", "port_affected", "date")


@query("scan_blank_line_records", sql="""
SELECT CAST(doc_id AS VARCHAR) AS id, source AS port, lang AS date FROM documents
""")
def q_scan_blank_line_records(spark, sf_dir):
    """S4 + T10: documents exported as blank-line separated 'Key: value' records, read back by folder."""
    d = scan_table(spark, sf_dir, "documents")
    path = scratch_path(spark, "records")
    recs = d.select(F.concat(F.lit("id: "), F.col("doc_id").cast("string"), text_field(), F.lit("\nPort Affected: "),
                             F.col("source"), F.lit("\nDate: "), F.col("lang")).alias("value"))
    recs.repartition(_files(d)).write.mode("overwrite").option("lineSep", "\n\n").text(path)
    r = records.scan_blank_line_records(spark, path).where(F.size("kv") > 0)
    return r.select(F.col("kv")["id"].alias("id"), F.col("kv")["Port Affected"].alias("port"),
                    F.col("kv")["Date"].alias("date"))


@query("scan_numbered_lines", sql="""
SELECT row_number() OVER (ORDER BY doc_id) AS n, replace(text, chr(10), ' ') AS text, '' AS label FROM documents
""")
def q_scan_numbered_lines(spark, sf_dir):
    """K9 + S7: headlines written as numbered records, read back as (n, text, label)."""
    d = scan_table(spark, sf_dir, "documents").select("doc_id", F.translate("text", "\n", " ").alias("h"))
    path = scratch_path(spark, "numbered")
    upsert.write_numbered_text(d, path, "h", ["doc_id"])
    return records.scan_numbered_lines(spark, path).select(F.col("n").cast("long").alias("n"), "text", "label")


@query("scan_word_vectors", sql="""
SELECT 'w' || CAST(vec_id AS VARCHAR) AS token, list_transform(embedding, lambda x: CAST(x AS DOUBLE)) AS vector
FROM embeddings
""")
def q_scan_word_vectors(spark, sf_dir):
    """Embeddings exported as 'token f1 ... fn' lines and parsed back."""
    e = scan_table(spark, sf_dir, "embeddings")
    path = scratch_path(spark, "vectors")
    lines = e.select(F.concat_ws(" ", F.concat(F.lit("w"), F.col("vec_id").cast("string")),
                                 F.array_join(F.transform("embedding", lambda x: x.cast("string")), " ")).alias("v"))
    lines.write.mode("overwrite").text(path)
    v = records.scan_word_vectors(spark, path)
    return v.select("token", F.transform("vector", lambda x: x.cast("float").cast("double")).alias("vector"))


@query("scan_sheet", sql="SELECT CAST(o_orderkey AS VARCHAR) AS o_orderkey, o_orderpriority FROM orders")
def q_scan_sheet(spark, sf_dir):
    """K8 + S8: orders exported as a header CSV with an index column, read back without the index."""
    o = scan_table(spark, sf_dir, "orders").select(F.monotonically_increasing_id().alias("idx"),
                                                   "o_orderkey", "o_orderpriority")
    path = scratch_path(spark, "sheet")
    upsert.export_table(o, path, "csv")
    return records.scan_sheet(spark, path, index_col=True)


def _section_sql() -> str:
    from tidewater.plans.q_text import WS, s_strip
    sec = ("'Disruption event: ' || replace(text, chr(10), ' ') || chr(10) || 'Port Affected: ' || source || "
           "chr(10) || 'Date: ' || lang || CASE WHEN n_chars % 2 = 0 THEN chr(10) || "
           "'Final Classification: **Port Closure**' ELSE '' END || chr(10) || chr(10)")
    ev = f"Disruption event:{WS}*(.*)\\n"
    fc = f"Final Classification:{WS}*\\*\\*(.*)\\*\\*"
    return f"""
SELECT CASE WHEN regexp_matches(sec, '{ev}') THEN {s_strip(f"regexp_extract(sec, '{ev}', 1)")} END AS disruption_event,
       {s_strip(f"regexp_extract(sec, 'Port Affected:{WS}*(.*)', 1)")} AS port_affected,
       {s_strip(f"regexp_extract(sec, 'Date:{WS}*(.*)', 1)")} AS date,
       CASE WHEN regexp_matches(sec, '{fc}') THEN {s_strip(f"regexp_extract(sec, '{fc}', 1)")} END
         AS final_classification
FROM (SELECT {sec} AS sec FROM documents)
"""


@query("scan_numbered_sections", sql=_section_sql())
def q_scan_numbered_sections(spark, sf_dir):
    """S6 + T13: documents exported as numbered answer sections (several files), read back."""
    from tidewater.operators.upsert import numbered_lines
    d = scan_table(spark, sf_dir, "documents")
    body = F.concat(F.lit("Disruption event: "), F.translate("text", "\n", " "), F.lit("\nPort Affected: "),
                    F.col("source"), F.lit("\nDate: "), F.col("lang"),
                    F.when(F.col("n_chars") % 2 == 0, F.lit("\nFinal Classification: **Port Closure**"))
                    .otherwise(F.lit("")))
    lines = numbered_lines(d.select("doc_id", body.alias("b")), "b", ["doc_id"])
    path = scratch_path(spark, "sections")
    records.write_text_with_header(lines.repartitionByRange(_files(d), "n").sortWithinPartitions("n").select("line"),
                                   path, "Answers\n")
    return records.scan_numbered_sections(spark, path).select(
        "disruption_event", "port_affected", "date", "final_classification")


@query("drop_incomplete_by_file", sql="""
SELECT CAST(doc_id AS VARCHAR) AS id, source AS port FROM documents WHERE lang <> 'de'
""")
def q_drop_incomplete_by_file(spark, sf_dir):
    """F5 with per-file keys: records missing a key that other records of the same file have are dropped."""
    from tidewater.operators.filters import drop_incomplete_by_file
    d = scan_table(spark, sf_dir, "documents")
    path = scratch_path(spark, "records-f5")
    date = F.when(F.col("lang") != "de", F.concat(F.lit("\nDate: "), F.col("lang"))).otherwise(F.lit(""))
    recs = d.select(F.concat(F.lit("id: "), F.col("doc_id").cast("string"), text_field(), F.lit("\nPort Affected: "),
                             F.col("source"), date).alias("value"))
    recs.repartition(_files(d)).write.mode("overwrite").option("lineSep", "\n\n").text(path)
    r = records.scan_blank_line_records(spark, path).where(F.size("kv") > 0)
    kept = drop_incomplete_by_file(r, record="kv", file="file")
    return kept.select(F.col("kv")["id"].alias("id"), F.col("kv")["Port Affected"].alias("port"))
