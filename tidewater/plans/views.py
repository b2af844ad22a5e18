"""Stand-in views over the shared test tables, each with the same definition in SQL.

``documents`` plays the Article collection (doc_id -> _id, text -> description)
and ``labels`` supplies the flags; ``events`` is the keyed upsert stream.
The SQL strings are the oracle side of the same derivations.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidewater.sources.tables import scan_table

# Sites used to give each document a link, chosen by doc_id mod 3.
SITES = ["www.gcaptain.com", "theloadstar.com", "www.maritime-executive.com"]


def articles(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Article-shaped rows (8 string fields + flags) derived from documents and labels."""
    docs = scan_table(spark, sf_dir, "documents").select("doc_id", "text", "lang", "source")
    labels = scan_table(spark, sf_dir, "labels")
    site = F.element_at(F.array(*[F.lit(s) for s in SITES]), (F.pmod("doc_id", F.lit(3)) + 1).cast("int"))
    link = F.concat(F.lit("https://"), site, F.lit("/news/"), F.col("doc_id").cast("string"))
    return docs.join(labels, "doc_id", "left").select(
        F.col("doc_id").cast("string").alias("_id"),
        F.substring_index("text", "\n", 1).alias("headline"),
        F.col("text").alias("description"),
        F.lit("").alias("severity"),
        F.when(F.col("quality").isNull(), F.lit("")).when(F.col("quality") == 0, F.lit("Others"))
         .otherwise(F.col("lang")).alias("main_risk"),
        F.col("lang").alias("country"),
        F.col("source").alias("state"),
        link.alias("link"),
        (F.col("toxic") == 1).alias("is_editorial"),
        F.coalesce(F.col("toxic") == 0, F.lit(True)).alias("is_unique"),
        F.col("quality").isNull().alias("is_new"),
    )


ARTICLES_SQL = """
SELECT CAST(d.doc_id AS VARCHAR) AS _id,
       split_part(d.text, chr(10), 1) AS headline,
       d.text AS description,
       '' AS severity,
       CASE WHEN l.quality IS NULL THEN '' WHEN l.quality = 0 THEN 'Others' ELSE d.lang END AS main_risk,
       d.lang AS country,
       d.source AS state,
       'https://' || (['www.gcaptain.com', 'theloadstar.com', 'www.maritime-executive.com'])[(d.doc_id % 3) + 1]
         || '/news/' || CAST(d.doc_id AS VARCHAR) AS link,
       (l.toxic = 1) AS is_editorial,
       coalesce(l.toxic = 0, true) AS is_unique,
       (l.quality IS NULL) AS is_new
FROM documents d LEFT JOIN labels l ON d.doc_id = l.doc_id
"""

