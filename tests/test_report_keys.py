"""Reporting, keyed writes and k choice on hand-made rows."""

import pytest
from pyspark.sql import functions as F

from tidewater.operators import clustering, report, upsert


def test_matrix_and_dominant(spark):
    rows = [("a", "1"), ("a", "2"), ("a", "2"), ("b", "1"), ("b", "3"), (None, "1"), ("c", "3")]
    df = spark.createDataFrame(rows, "risk string, sev string")
    m = {r["risk"]: (r["1"], r["2"], r["3"]) for r in report.risk_severity_matrix(df, "risk", "sev").collect()}
    assert m["a"] == (33.3, 66.7, 0.0) and m["b"] == (50.0, 0.0, 50.0) and m["All"] == (33.3, 33.3, 33.3)
    d = {r["risk"]: r["dominant_severity"] for r in report.dominant_severity(df, "risk", "sev").collect()}
    assert d == {"a": "2", "b": "1", "c": "3"}  # tie in b -> smallest label
    d2 = {r["risk"]: r["dominant_severity"] for r in report.dominant_severity(df, "risk", "sev", True).collect()}
    assert d2["c"] == "1"  # the highest label can never win with the reference's slice


def test_upsert_semantics(spark):
    target = spark.createDataFrame([("k1", "old", "keep"), ("k2", "x", "y")], "_id string, a string, extra string")
    inc = spark.createDataFrame([("k1", "new1", 1), ("k1", "new2", 2), ("k3", "n", 1)], "_id string, a string, seq int")
    out = {r["_id"]: (r["a"], r["extra"]) for r in upsert.upsert_by_key(target, inc, "_id", ["seq"]).collect()}
    assert out == {"k1": ("new2", "keep"), "k2": ("x", "y"), "k3": ("n", None)}
    again = upsert.upsert_by_key(upsert.upsert_by_key(target, inc, "_id", ["seq"]), inc, "_id", ["seq"])
    assert {r["_id"]: r["a"] for r in again.collect()} == {k: v[0] for k, v in out.items()}  # idempotent


def test_ordinals_are_consecutive(spark):
    df = spark.range(0, 1000, 1, 7).withColumn("k", (F.col("id") * 7919) % 1000)
    from tidewater.operators.ranking import with_ordinal
    got = sorted((r["k"], r["ordinal"]) for r in with_ordinal(df, ["k"]).collect())
    assert [o for _, o in got] == list(range(1, 1001))


def test_choose_k_both_half_even(spark):
    # inertia curve with an elbow at k=2, silhouette best at k=3 -> both = round(2.5) = 2
    m = spark.createDataFrame([(1, 100.0, 0.0), (2, 20.0, 0.1), (3, 15.0, 0.5), (4, 12.0, 0.2), (5, 10.0, 0.1)],
                              "k long, inertia double, silhouette double")
    r = clustering.choose_k(m, "both").first()
    assert (r["elbow_k"], r["best_silhouette_k"], r["optimal_k"]) == (2, 3, 2)
    with pytest.raises(clustering.InvalidMethodError):
        clustering.choose_k(m, "gap")


def test_no_elbow(spark):
    m = spark.createDataFrame([(1, 10.0, 0.0), (2, 8.0, 0.1), (3, 6.0, 0.2)], "k long, inertia double, silhouette double")
    with pytest.raises(clustering.NoElbowError):
        clustering.chosen_k(m, "elbow")


def test_sample_rows_independent_of_partitioning(spark):
    a = spark.range(0, 500, 1, 1).withColumnRenamed("id", "k")
    b = spark.range(0, 500, 1, 9).withColumnRenamed("id", "k")
    sa = [r["k"] for r in report.sample_rows(a, 25, 42, "k").collect()]
    sb = [r["k"] for r in report.sample_rows(b, 25, 42, "k").collect()]
    assert sa == sb and len(set(sa)) == 25


def test_positional_join_offsets_and_out_of_range(spark):
    from tidewater.operators import joins
    left = spark.createDataFrame([(i, f"answer {i}") for i in range(1, 5)], "n long, a string")
    right = spark.createDataFrame([(i * 10,) for i in range(3)], "row long")
    got = sorted((r["n"], r["row"]) for r in joins.positional_join(left, ["n"], right, ["row"], offset=-1).collect())
    assert got == [(1, None), (2, 0), (3, 10), (4, 20)]
