"""Aggregations, ranking, top-k, sampling and set operations (A1-A12 except the vector ones).

All of them are grouped aggregations with map-side partial aggregation, so a
hot key (one risk type holding a third of all rows) is combined before the
shuffle; only the tiny aggregated frames are pivoted or windowed.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidewater.operators.ranking import top_n_per_group

ALL_LABEL = "All"


def _pct(n: Column, total: Column) -> Column:
    """Percent rounded to one decimal, half-even, computed on exact tenths.

    ``n * 1000 / total`` is exact at every .5 tie, so the rounding does not
    depend on the floating-point order of operations.
    """
    return F.bround(n * F.lit(1000.0) / total, 0) / F.lit(10.0)


def risk_severity_counts(df: DataFrame, risk: str, severity: str) -> DataFrame:
    """Long-form crosstab counts with the margin row: (risk, severity, n).

    One aggregation over grouping sets ((risk, severity), (severity)); the
    margin row gets the label ``All``. Rows with a null key are dropped first.
    """
    base = df.select(F.col(risk).cast("string").alias("risk"),
                     F.col(severity).cast("string").alias("severity")) \
        .where(F.col("risk").isNotNull() & F.col("severity").isNotNull())
    g = base.rollup("severity", "risk").agg(F.count(F.lit(1)).alias("n"),
                                             F.grouping("risk").alias("g_risk"),
                                             F.grouping("severity").alias("g_sev"))
    g = g.where(F.col("g_sev") == 0)  # drop the grand total; keep (sev, risk) and (sev, All)
    return g.select(F.when(F.col("g_risk") == 1, F.lit(ALL_LABEL)).otherwise(F.col("risk")).alias("risk"),
                    "severity", "n")


def risk_severity_matrix(df: DataFrame, risk: str, severity: str,
                         severities: Sequence[str] | None = None) -> DataFrame:
    """A4: row-normalised crosstab x 100 rounded to 1 decimal, plus an ``All`` row, no ``All`` column.

    Wide form: one column per severity value, absent cells 0. Pass
    ``severities`` to fix the column set (skips the job that finds the values).
    """
    counts = risk_severity_counts(df, risk, severity)
    wide = counts.groupBy("risk").pivot("severity", list(severities) if severities else None).agg(F.sum("n"))
    value_cols = [c for c in wide.columns if c != "risk"]
    wide = wide.fillna(0, value_cols)
    total = sum((F.col(f"`{c}`") for c in value_cols), F.lit(0))
    return wide.select("risk", *[_pct(F.col(f"`{c}`"), total).alias(c) for c in value_cols])


def risk_severity_long(df: DataFrame, risk: str, severity: str,
                       severities: Sequence[str] | None = None, drop_last: bool = False) -> DataFrame:
    """A4 in long form: (risk, severity, pct) for every risk x severity, absent cells 0."""
    wide = risk_severity_matrix(df, risk, severity, severities)
    value_cols = sorted(c for c in wide.columns if c != "risk")
    if drop_last:
        value_cols = value_cols[:-1]
    return wide.unpivot("risk", value_cols, "severity", "pct")


def dominant_severity(df: DataFrame, risk: str, severity: str, drop_last: bool = False,
                      severities: Sequence[str] | None = None) -> DataFrame:
    """A5: per risk the severity with the highest percent, smallest label on ties.

    ``drop_last=True`` reproduces the reference's slice, where the highest
    severity label can never win.
    """
    long = risk_severity_long(df, risk, severity, severities, drop_last).where(F.col("risk") != ALL_LABEL)
    w = Window.partitionBy("risk").orderBy(F.col("pct").desc(), F.col("severity").asc())
    return (long.withColumn("rk", F.row_number().over(w)).where("rk = 1")
            .select("risk", F.col("severity").alias("dominant_severity"), F.col("pct").alias("dominant_pct")))


def value_counts(df: DataFrame, col: str) -> DataFrame:
    """A3: rows per value, descending, nulls skipped (order: count desc, value asc)."""
    return (df.where(F.col(col).isNotNull()).groupBy(col).agg(F.count(F.lit(1)).alias("count"))
            .orderBy(F.col("count").desc(), F.col(col).asc()))


def pending_counts(df: DataFrame, predicate: Column) -> DataFrame:
    """A2: total, matching and remaining counts in one aggregation."""
    return df.agg(F.count(F.lit(1)).alias("total"),
                  F.count_if(predicate).alias("matching")) \
        .withColumn("remaining", F.col("total") - F.col("matching"))


def severity_distribution(df: DataFrame, severity: str, by: Sequence[str] = ()) -> DataFrame:
    """Percent of rows per severity (optionally per model / group)."""
    by = list(by)
    g = df.where(F.col(severity).isNotNull()).groupBy(*by, severity).agg(F.count(F.lit(1)).alias("n"))
    w = Window.partitionBy(*by) if by else Window.partitionBy()
    return g.select(*by, severity, "n", _pct(F.col("n"), F.sum("n").over(w)).alias("pct"))


def catalogue_text(df: DataFrame, name: str, description: str, by: Sequence[str] = ()) -> DataFrame:
    """Category rows -> one bullet string ``\\t- Name: Description`` lines, sorted."""
    bullet = F.concat(F.lit("\t- "), F.col(name), F.lit(": "), F.col(description))
    return df.groupBy(*by).agg(F.array_join(F.array_sort(F.collect_list(bullet)), "\n").alias("catalogue"))


def cluster_summary(df: DataFrame, cluster: str, text: str, order: str, samples: int = 20) -> DataFrame:
    """Per cluster its size and the first ``samples`` texts in input order.

    The size is a partial aggregation; only ``samples`` rows per cluster are
    ranked and collected, so a huge cluster never lands in one list.
    """
    sizes = df.groupBy(cluster).agg(F.count(F.lit(1)).alias("size"))
    firsts = (top_n_per_group(df.select(cluster, order, text), [cluster], [F.col(order)], samples,
                              salt_key=order, rank_col="rk")
              .groupBy(cluster)
              .agg(F.array_sort(F.collect_list(F.struct(F.col("rk"), F.col(text).alias("t")))).alias("s"))
              .select(cluster, F.transform("s", lambda x: x["t"]).alias("sample_texts")))
    return sizes.join(firsts, cluster)


def format_risk_analysis(summary: DataFrame, category: str = "category") -> DataFrame:
    """Category, Number of Incidents, first three sample texts joined by newlines."""
    return summary.select(F.col(category).alias("category"),
                          F.col("size").alias("number_of_incidents"),
                          F.array_join(F.slice("sample_texts", 1, 3), "\n").alias("example_incidents"))


def sample_rows(df: DataFrame, n: int, seed: int, key: str) -> DataFrame:
    """A10: n rows without replacement, repeatable and independent of partitioning.

    A top-n by a seeded hash of the key: each partition keeps its n smallest,
    so no shuffle of the whole table.
    """
    return df.orderBy(F.xxhash64(F.col(key), F.lit(seed)), F.col(key)).limit(n)


def concat_tables(frames: Sequence[DataFrame]) -> DataFrame:
    """Append tables whose columns differ; missing columns become null."""
    out = frames[0]
    for f in frames[1:]:
        out = out.unionByName(f, allowMissingColumns=True)
    return out
