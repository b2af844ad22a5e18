"""Filters and predicates (F1-F10). Plain Column predicates so Catalyst can push them to the scan."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidewater.functions import text as T


def drop_editorial_author(df: DataFrame, author: str = "author") -> DataFrame:
    """skip pages whose author text contains 'Editorial'; a missing author is kept."""
    return df.where(~F.coalesce(F.col(author).contains("Editorial"), F.lit(False)))


def keep_article_urls(df: DataFrame, url: str = "url") -> DataFrame:
    """url contains 'article' and not 'editorial' (case-sensitive, whole url)."""
    u = F.col(url)
    return df.where(u.contains("article") & ~u.contains("editorial"))


def drop_paywalled(df: DataFrame, flag: str = "paywalled") -> DataFrame:
    """skip pages that carry the paywall element."""
    return df.where(~F.coalesce(F.col(flag), F.lit(False)))


def flag_is_set(*flags: str) -> Column:
    out = F.lit(False)
    for f in flags:
        out = out | F.coalesce(F.col(f), F.lit(False))
    return out


def drop_flagged(df: DataFrame, flags: Sequence[str] = ("is_editorial",)) -> DataFrame:
    """drop rows where any listed flag is present and true (absent/null counts as false)."""
    present = [f for f in flags if f in df.columns]
    return df.where(~flag_is_set(*present)) if present else df


def drop_incomplete(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """drop records lacking any of the declared keys (null)."""
    return df.na.drop("any", subset=list(keys))


def drop_incomplete_by_file(df: DataFrame, record: str = "record", file: str = "file") -> DataFrame:
    """F5 with keys that vary per file: a record must hold every key seen in its file.

    The per-file key set is an aggregation over (file, key) pairs, joined back
    on the file, so no file's records are gathered in one place.
    """
    keys = df.select(file, F.explode(F.map_keys(record)).alias("k")).distinct()
    per_file = keys.groupBy(file).agg(F.collect_set("k").alias("file_keys"))
    j = df.join(per_file, file, "left")
    return j.where(F.forall(F.coalesce("file_keys", F.array().cast("array<string>")),
                            lambda k: F.array_contains(F.map_keys(record), k))).drop("file_keys")


def run_cap(df: DataFrame, n: int, order: Sequence[str] = ("_id",)) -> DataFrame:
    """stop after n handled rows; apply after the filters so skipped rows do not count."""
    return df.orderBy(*order).limit(n)


def pending_category_predicate() -> Column:
    return (F.col("main_risk") == "") & F.coalesce(F.col("is_unique"), F.lit(False))


def pending_category(df: DataFrame) -> DataFrame:
    """main_risk == '' and 'is unique'."""
    return df.where(pending_category_predicate())


class NotEnoughRows(ValueError):
    pass


def others_with_minimum(df: DataFrame, minimum: int = 500, risk: str = "main_risk",
                        value: str = "Others") -> DataFrame:
    """F8: rows of the 'Others' category; error if fewer than ``minimum``.

    The guard is a bounded count (stops at ``minimum`` rows).
    """
    out = df.where(F.col(risk) == value)
    n = out.limit(minimum).count() if minimum > 0 else 0
    if n < minimum:
        raise NotEnoughRows(
            f"minimum_samples is {minimum} but only {n} rows are categorised as '{value}'; "
            "lower the minimum to proceed")
    return out


def split_new_seen(df: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(seen, new): seen = not new and unique; new = is new."""
    new = F.coalesce(F.col("is_new"), F.lit(False))
    unique = F.coalesce(F.col("is_unique"), F.lit(False))
    return df.where(~new & unique), df.where(new)


def drop_unmatched_extractions(df: DataFrame, block: str = "block") -> DataFrame:
    """keep an 'id:' block only if id, event, port and date patterns all match."""
    return df.where(T.block_is_complete(F.col(block)))
