"""Rows that must not be lost, ties that must be settled, and moments that must not cancel."""

import pytest
from pyspark.sql import functions as F

from cardloom.operators import aggregate as ag, folds as fo, profile as pf, quantile as qt, windows as wi
from cardloom.operators.joins import align


def test_positions_of_rows_without_time_or_key(spark):
    df = spark.createDataFrame([(1, "2018-01-01", 1), (1, None, 2), (1, "2018-01-02", 3), (None, "2018-01-01", 4), (None, None, 5)],
                               "card_id long, t string, n int").withColumn("t", F.to_timestamp("t"))
    got = {r["n"]: r["position"] for r in wi.with_position(df, ["card_id"], ["t", "n"]).collect()}
    assert got == {2: 0, 1: 1, 3: 2, 5: 0, 4: 1}
    prev = {r["n"]: r["prev_n"] for r in wi.with_previous(df, "card_id", ["t", "n"], ["n"]).collect()}
    assert prev == {2: None, 1: 2, 3: 1, 5: None, 4: 5}


def test_nan_is_missing_in_a_median(spark):
    df = spark.createDataFrame([(1, v) for v in (-1.0, 1.0, 2.0, 3.0, float("nan"))], "card_id long, v double")
    assert qt.median(df, "card_id", "v", "m").collect()[0]["m"] == 1.5


def test_a_card_without_a_prediction_is_told(spark):
    a = spark.createDataFrame([("x", 1.0), ("y", 2.0)], "card_id string, pred double")
    b = a.filter("card_id = 'x'")
    assert align({"a": a, "b": a}).count() == 2
    with pytest.raises(Exception, match="no prediction of b for y"):
        align({"a": a, "b": b}).collect()


def test_small_samples_and_text_keys(spark):
    df = spark.range(200_000).select(F.concat(F.lit("C_ID_"), "id").alias("card_id"))
    n = fo.sample(df, "card_id", 0.0005).count()
    assert 50 < n < 160
    assert fo.sample(df, "card_id", 0.0).count() == 0 and fo.sample(df, "card_id", 1.0).count() == 200_000


def test_latest_takes_one_row(spark):
    df = spark.createDataFrame([(1, 5, 1, 9), (1, 5, 2, 3), (1, 4, 8, 8)], "card_id long, t int, a int, b int")
    assert [tuple(r) for r in ag.latest(df, "card_id", "t", ["a", "b"]).collect()] == [(1, 5, 2, 3)]


def test_correlation_with_large_offset(spark):
    labels = spark.createDataFrame([(i, float(i % 7)) for i in range(100)], "card_id long, y double")
    offset = labels.select("card_id", F.lit("far").alias("feature"), (F.col("y") + 1e9).alias("v"))
    constant = labels.select("card_id", F.lit("constant").alias("feature"), F.lit(1e9).alias("v"))
    part = labels.filter("y > 3").select("card_id", F.lit("part").alias("feature"), F.col("y").alias("v"))
    got = {r["feature"]: r["abs_corr"] for r in pf.corr_long(offset.union(constant).union(part), labels, "card_id", "y").collect()}
    whole = labels.select(F.corr(F.when(F.col("y") > 3, F.col("y")).otherwise(0.0), "y").alias("c")).collect()[0]["c"]
    assert got["far"] == pytest.approx(1.0, abs=1e-6)
    assert got["part"] == pytest.approx(whole)
    assert got["constant"] is None or got["constant"] < 1e-6
