"""A corpus pipeline over ``documents``: each stage works on all that the stage before it kept.

``run(spark, sf_dir)`` applies STAGES in order. Each stage takes (spark, docs, sf_dir) and returns a
DataFrame that is written as Parquet and read again as the next stage's docs.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidewater.llm import bpe, decontam, odd_sketch, pii, zstd_quality
from tidewater.llm.util import row_key, store, table, unused


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps the documents that the compression classifier doesn't reject."""
    model = zstd_quality.fit_on_fold(docs, table(spark, sf_dir, "labels"))
    return docs.where(zstd_quality.score(model, F.col("text")) >= zstd_quality.THRESHOLD)


def _key() -> Column:
    """Names a row by its id and text; rows that share either but not both differ."""
    return row_key("doc_id", "text")


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps one row of each group of near duplicates, that with the smallest id (rows without an id come last).

    Rows with an empty set are near duplicates of nothing and all stay.
    """
    row = F.struct(F.col("doc_id").isNull().alias("unnamed"), F.col("doc_id").alias("id"), _key().alias("key"))
    judged = store(odd_sketch.near_duplicates(docs.select(row.alias("row"), "text"), "row").select("row.key", "n_shingles", "kept"), "judged")
    key = unused(docs, "row_key")
    keyed = docs.withColumn(key, _key()).join(judged.where("NOT kept").select(F.col("key").alias(key)).distinct(), key, "left_anti")
    copies = judged.where("kept AND n_shingles > 0").groupBy(F.col("key").alias(key)).agg(F.count(F.lit(1)).alias("n")).where("n > 1").select(key)
    single = keyed.join(copies, key, "left_anti")
    one = keyed.join(copies, key, "left_semi").dropDuplicates([key])
    return single.unionByName(one).select(*docs.columns)


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps the rows that aren't contaminated by the benchmark, whose items count with or without an id."""
    bad = decontam.judged(docs, table(spark, sf_dir, "benchmark")).where("contaminated")
    key = unused(docs, "row_key")
    return docs.withColumn(key, _key()).join(bad.select(F.col("key").alias(key)).distinct(), key, "left_anti").select(*docs.columns)


def personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, with personal data in their texts replaced by its kind; n_chars follows the text."""
    out = pii.redact(docs, pii.fit(docs))
    return out.withColumn("n_chars", F.when(F.col("text").isNull(), F.col("n_chars")).otherwise(F.length("text").cast(docs.schema["n_chars"].dataType)))


def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token counts and digests of the kept texts."""
    return bpe.round_trip(docs)


STAGES = [
    ("quality", quality),
    ("near_duplicates", near_duplicates),
    ("decontaminate", decontaminate),
    ("personal_data", personal_data),
    ("tokens", tokens),
]

ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = store(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return docs
