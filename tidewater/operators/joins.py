"""Lookup joins (J1-J3, J8, J9): what the reference does with one find_one per row."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidewater.operators import filters
from tidewater.operators.ranking import with_ordinal


def unprocessed(scraped: DataFrame, processed: DataFrame, key: str = "_id") -> DataFrame:
    """Scraped rows whose key is not processed yet (anti join; AQE picks broadcast or shuffle)."""
    return scraped.join(processed.select(key), key, "left_anti")


def attach_article(extractions: DataFrame, articles: DataFrame, key: str = "_id",
                   copy: Sequence[str] = ("headline", "description", "severity", "main_risk",
                                          "country", "state", "link"),
                   flags: Sequence[str] = ("editorial", "is_editorial", "is_deduplicated")) -> DataFrame:
    """Extraction record x article on id; unmatched and flagged rows dropped; fields default ''."""
    a = filters.drop_flagged(articles, [f for f in flags if f in articles.columns])
    a = a.select(key, *[F.coalesce(F.col(c), F.lit("")).alias(c) for c in copy])
    return extractions.join(a, key, "inner")


def positional_join(left: DataFrame, left_order: Sequence[str], right: DataFrame,
                    right_order: Sequence[str], offset: int = 0) -> DataFrame:
    """Item i of ``left`` <-> row i + offset of ``right``, by explicit consecutive ordinals.

    Items that land outside the right side's range are returned with nulls
    (callers decide whether that is an error).
    """
    lo = with_ordinal(left, list(left_order), "_pos_l")
    ro = with_ordinal(right, list(right_order), "_pos_r")
    lo = lo.withColumn("_pos", F.col("_pos_l") + F.lit(offset))
    return lo.join(ro, lo["_pos"] == ro["_pos_r"], "left").drop("_pos", "_pos_r")


def name_clusters(rows: DataFrame, names: DataFrame, cluster: str = "cluster") -> DataFrame:
    """Cluster id -> category name for each row (joined by id, never by list position).

    The name table has one row per cluster; the optimizer broadcasts it when its bytes allow.
    """
    return rows.join(names, cluster, "left")


def label_scores(rows: DataFrame, labels: Sequence[str], score, key: str, text: str) -> DataFrame:
    """Every row x every candidate label -> best label and its score.

    The candidate list is a fixed parameter (five severity descriptions), folded
    into each row as a literal array, so no join is planned; ``score(text, label)``
    is a Column expression. Ties go to the earlier label.
    """
    arr = F.array(*[F.struct(F.lit(i).alias("i"), F.lit(v).alias("label")) for i, v in enumerate(labels)])
    scored = F.transform(arr, lambda l: F.struct(score(F.col(text), l["label"]).alias("score"),
                                                 (-l["i"]).alias("neg_i"), l["label"].alias("label")))
    best = F.array_max(scored)
    return rows.select(key, best["label"].alias("best_label"), best["score"].alias("score"))
