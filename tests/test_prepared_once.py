"""Prepared transactions are moved once, by card, and read where they lie."""

import pytest
from pyspark.sql import functions as F

from cardloom.operators import encode as en, pivot as pv, skew as sk
from cardloom.plans import baseline as ba, prepare as pp
from cardloom.sources.fixtures import ROW_ORDER, Tables


@pytest.fixture(scope="module")
def raw(spark, folder):
    t = Tables(spark, folder)
    txn = t.txn.withColumn("card_id", F.when(F.col("ord_1") % 50 > 0, F.col("card_id")))
    merchants = pp.prepare_merchants(t.merchants.withColumn("avg_purchases_lag12", F.col("avg_purchases_lag6")))
    return t, pp.stage_transactions(txn.filter("month_lag >= 0"), txn.filter("month_lag < 0")), merchants


def hashed(df):
    df.collect()
    return df._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0].count("Exchange hashpartitioning(card_id")


def test_differences_and_cross_sums_move_no_row_after_staging(raw):
    t, rows, merchants = raw
    assert sk.lies_by_key(rows, "card_id") and rows.filter("card_id IS NULL").count() == 0 and rows.filter("card_id = -1").count() > 0
    second = pp.prepare_staged(rows, merchants, 2, ROW_ORDER)
    # differences of these few cards run in chunks, since each has more than a thousandth of the rows
    assert second._jdf.queryExecution().optimizedPlan().toString().count("lineitem.parquet") == 0
    first = pp.prepare_staged(rows, merchants, 1, ROW_ORDER)
    assert sk.lies_by_key(first, "card_id") and second.count() == rows.count()
    sums = pv.cross_sums(first, "card_id", ["city_id", "category_3"], ["amount_units"])
    assert hashed(sums) == 0
    # nothing is written again where the rows lie
    assert set(sums.inputFiles()) >= set(rows.inputFiles())
    assert sums.filter("column = 'city_id'").agg(F.sum("amount_units")).first()[0] == rows.agg(F.sum("amount_units")).first()[0]


def test_rows_that_lie_by_card_are_staged_where_they_lie(raw):
    _, rows, _ = raw
    again = sk.staged_by_key(rows.select("card_id", "month_lag"), "card_id", bucket_rows=7)
    assert sk._partitioning(again).split(", ")[1:] == sk._partitioning(rows).split(", ")[1:]
    assert sorted(map(repr, again.collect())) == sorted(map(repr, rows.select("card_id", "month_lag").collect()))


def test_narrow_dimensions_are_broadcast_by_size(spark):
    narrow, text = spark.range(5).select("id", F.lit(1).alias("code")), spark.range(5).select("id", F.lit("x").alias("name"))
    assert en.broadcast_rows(narrow) > 1_000_000 and en.broadcast_rows(text) == en.SMALL_ROWS
    assert en.broadcast_rows(narrow, 10, most_bytes=0) == 10
