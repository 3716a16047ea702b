"""Rows are moved before they are multiplied, and once per key where no key is hot."""

import datetime as dt

import pytest
from pyspark.ml.linalg import Vectors
from pyspark.sql import functions as F

from cardloom.operators import aggregate as ag, pivot as pv, quantile as qt, skew as sk, text as tx, windows as wi
from cardloom.plans import refined as rf
from queries.features import vector_entries

ORDER = ["ts", "seq"]


@pytest.fixture(scope="module")
def facts(spark):
    # 1,500 cards of two or three rows: none has more than a thousandth of them
    rows = spark.range(4000).select((F.col("id") % 1500).alias("card"), F.col("id").alias("seq"), (F.col("id") % 7).alias("a"),
                                    F.concat(F.lit("No "), (F.col("id") % 40).cast("string")).alias("b"), (F.col("id") % 3 - 1).alias("lag"))
    return rows.withColumn("ts", F.lit(dt.datetime(2020, 1, 1)) + F.make_dt_interval((F.col("seq") % 11).cast("int")))


def plan(df):
    df.collect()
    return df._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]


def test_id_lists_are_numbered_before_they_are_multiplied(facts):
    text = plan(tx.id_documents(facts, "card", ["a", "b"], ORDER, {"new": "lag >= 0", "hist": "lag < 0", "all": None}))
    assert text.index("Generate") < text.index("Window") and text.count("Exchange hashpartitioning") == 1 and "Join" not in text


def test_previous_row_moves_rows_once(facts):
    text = plan(wi.with_previous(facts, "card", ORDER, ["a"]))
    assert text.count("Exchange hashpartitioning") == 1 and "Join" not in text


def hashed(df):
    return plan(df).count("Exchange hashpartitioning")


def test_steps_by_card_move_nothing_after_the_buckets(facts):
    toks = tx.document_tokens(facts, "card", ["a", "b"], ORDER, {"new": "lag >= 0", "all": None})
    assert hashed(tx.count_terms(toks, "card")) == 0 and hashed(tx.bigrams(toks, "card", ORDER)) == 0
    assert hashed(pv.cross_sums(facts, "card", ["a", "b"], ["lag"])) == 0
    assert hashed(ag.two_level_many(facts, "card", [("a", "b")], ["a", "b"], "seq", "lag")) == 0


def test_quantiles_of_bucketed_rows_move_nothing(facts):
    # odd and even groups, ties, -0.0, infinities, missing values, a card without a value and rows without a card
    v = F.when(F.col("seq") % 13 == 0, None).when(F.col("seq") % 17 == 0, float("inf")).when(F.col("seq") % 19 == 0, -0.0).otherwise((F.col("seq") % 5).cast("double"))
    rows = facts.select(F.when(F.col("card") > 2, F.col("card")).alias("card_id"), F.when(F.col("card") != 9, v).alias("purchase_amount"), (F.col("a") - 3).alias("month_diff"),
                        F.col("lag").alias("month_lag"))
    wide, segs = sk.staged_by_key(rows, "card_id"), {"hist_last2_": "month_lag < 0", "new_": "month_lag >= 0", "all_": "true"}
    ranks = {"low": lambda n: F.floor((n - 1) / 2), "high": lambda n: F.floor(n / 2), "q": qt.element_rank(0.975)}

    def both(step):
        return [sorted(map(repr, step(df).collect())) for df in (wide, rows)]

    here, there = both(lambda df: qt.rank_values(df, "card_id", "purchase_amount", ranks))
    assert here == there
    here, there = both(lambda df: rf._order_statistics(df, segs))
    assert here == there and len(here) == 1497
    assert sk.lies_by_key(wide, "card_id") and hashed(rf._order_statistics(wide, segs)) == 0


def test_a_hot_key_is_not_put_into_one_bucket(spark, facts):
    rows = sk.staged_by_key(facts, "card", bucket_rows=1)
    assert sk.lies_by_key(rows, "card") and rows.count() == 4000
    hot = facts.withColumn("card", F.when(F.col("seq") % 3 > 0, F.col("card")))
    assert not sk.lies_by_key(sk.staged_by_key(hot, "card", bucket_rows=10), "card")


def test_a_join_of_unlike_parts_does_not_lie_by_key(spark, facts):
    # one side is spread over the cores and the other is not, as with a small and a large table
    joined = facts.repartition(3).join(spark.range(4000).hint("merge"), F.col("seq") == F.col("id")).drop("id")
    assert not sk.lies_by_key(joined, "card")
    last = wi.days_to_last(joined, "card", "ts").agg(F.count("purchase_day_since_reference_day")).first()
    assert last[0] == 4000


def test_vector_entries_are_not_made_dense(spark):
    # a dense array of the first would not fit
    df = spark.createDataFrame([(1, Vectors.sparse(2_000_000_000, {5: 2.0, 1_999_999_999: 3.0})), (2, Vectors.dense([0.0, 4.0])), (3, Vectors.dense([]))], ["card_id", "v"])
    assert sorted(map(tuple, vector_entries(df, "v").collect())) == [(1, 5, 2.0), (1, 1_999_999_999, 3.0), (2, 1, 4.0)]
