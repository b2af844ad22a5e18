"""From clusters of 'Others' rows to named categories (M7 after the clustering, K2, K4, A9 as one job).

Names come from the texts: the words that set a cluster apart from all others (class-based TF-IDF). The
categories are appended to the catalogue (K2), the rows get the name of their cluster (K4), and the risk analysis
lists them (A9). Everything of the corpus' size stays in Spark; only one row of totals passes the driver.
"""

from __future__ import annotations

from collections.abc import Sequence
from typing import NamedTuple

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidewater.functions import text as T
from tidewater.operators import report, upsert
from tidewater.operators.ranking import top_n_per_group
from tidewater.session import cut_lineage


class Discovery(NamedTuple):
    """What ``apply_categories`` returns, one frame each."""
    catalogue: DataFrame
    table: DataFrame
    modified: DataFrame
    analysis: DataFrame


def cluster_terms(df: DataFrame, cluster: str, text: str, n: int = 5, stop_words: Sequence[str] = (), min_chars: int = 3) -> DataFrame:
    """(cluster, rank, term, score): the ``n`` words of each cluster that set it apart from the other clusters.

    score = tf / words of the cluster * ln(1 + words a cluster / occurrences in all clusters), over alphabetic lower-case
    words of at least ``min_chars`` letters that are no stop words; ties go to the smaller word. Counts are partial
    aggregations, so a cluster that holds a third of the rows is combined before any shuffle. Null and empty
    texts have no words; a cluster without words has no row, rows without a cluster are left out.
    """
    words = F.transform(T.alpha_tokens(F.col(text)), lambda w: F.lower(w))
    words = T.drop_stop_words(F.filter(words, lambda w: F.length(w) >= min_chars), stop_words)
    hits = df.where(F.col(cluster).isNotNull()).select(F.col(cluster).alias("_c"), F.explode_outer(words).alias("term")).where(F.col("term").isNotNull())
    counts = cut_lineage(hits.groupBy("_c", "term").agg(F.count(F.lit(1)).alias("tf")))
    sizes = counts.groupBy("_c").agg(F.sum("tf").alias("words"))
    total = sizes.agg(F.sum("words").alias("words"), F.count(F.lit(1)).alias("clusters")).first()
    everywhere = counts.groupBy("term").agg(F.sum("tf").alias("f"))
    mean = (total["words"] or 0) / max(1, total["clusters"])
    scored = counts.join(everywhere, "term").join(sizes, "_c") \
        .withColumn("score", F.col("tf") / F.col("words") * F.log(F.lit(1.0) + F.lit(mean) / F.col("f")))
    ranked = top_n_per_group(scored, ["_c"], [F.col("score").desc(), F.col("term")], n)
    return ranked.select(F.col("_c").alias(cluster), "rank", "term", "score")


def name_by_terms(terms: DataFrame, clusters: DataFrame, cluster: str, in_name: int = 3) -> DataFrame:
    """(cluster, category, description) for every row of ``clusters``: name of its first words, all its words described.

    A cluster without words is ``Unnamed <cluster>``. Of clusters with equal names the later ones, by cluster,
    get a number, so a name stands for one cluster. One row a cluster.
    """
    got = terms.groupBy(cluster).agg(F.array_sort(F.collect_list(F.struct("rank", "term"))).alias("_t"))
    got = clusters.select(cluster).join(got.select(cluster, F.transform("_t", lambda x: x["term"]).alias("_t")), cluster, "left")
    named = F.array_join(F.transform(F.slice("_t", 1, in_name), lambda w: F.initcap(w)), ", ")
    got = got.select(cluster, F.coalesce(named, F.concat(F.lit("Unnamed "), F.col(cluster).cast("string"))).alias("_n"),
                     F.coalesce(F.concat(F.lit("Reports on "), F.array_join("_t", ", "), F.lit(".")), F.lit("Reports without words.")).alias("description"))
    again = F.row_number().over(Window.partitionBy("_n").orderBy(cluster))
    return got.withColumn("_k", again) \
        .select(cluster, F.when(F.col("_k") == 1, F.col("_n")).otherwise(F.concat("_n", F.lit(" ("), F.col("_k").cast("string"), F.lit(")"))).alias("category"), "description")


def named_clusters(df: DataFrame, cluster: str, text: str, order: str, samples: int = 20, stop_words: Sequence[str] = (),
                   terms: int = 5, in_name: int = 3) -> DataFrame:
    """A8 with names: (cluster, size, sample_texts, category, description), one row a cluster."""
    summary = report.cluster_summary(df.where(F.col(cluster).isNotNull()), cluster, text, order, samples)
    names = name_by_terms(cluster_terms(df, cluster, text, terms, stop_words), summary, cluster, in_name)
    return summary.join(names, cluster)


def append_categories(catalogue: DataFrame, categories: DataFrame, cluster: str = "cluster", run: str = "discovered") -> DataFrame:
    """K2: the categories as further rows of the catalogue; ids ``<run>-<cluster>``, which K6 takes for discovered ones."""
    rows = categories.select(F.concat(F.lit(run + "-"), F.col(cluster).cast("string")).alias("_id"), "category", "description", F.lit("discovered").alias("origin"))
    return upsert.append_rows(catalogue, rows, catalogue.columns)


def apply_categories(table: DataFrame, assignment: DataFrame, categories: DataFrame, catalogue: DataFrame, key: str = "_id",
                     cluster: str = "cluster", field: str = "final_risk", run: str = "discovered") -> Discovery:
    """The rest of the job: catalogue + categories (K2), rows named by their cluster (K4, after K5 where ``field`` is new), analysis.

    ``assignment`` has (key, cluster) of the clustered rows with one row a key; rows of ``table`` that it doesn't list, null keys
    among them, keep their value.
    """
    categories = cut_lineage(categories)
    if field not in table.columns:
        table = upsert.copy_column(table, "main_risk", field)
    updated, modified = upsert.bulk_update_others(table, assignment, categories, key, cluster, "category", field)
    return Discovery(append_categories(catalogue, categories, cluster, run), updated, modified, report.format_risk_analysis(categories))
