"""Row order on one (card, day) that holds a third of all rows: pieces of bounded size, same results."""

import datetime as dt

import numpy as np
import pytest
from pyspark.sql import functions as F

from cardloom.operators import windows as wi

SHARES = 40
ORDER = ["ts", "seq"]


@pytest.fixture(scope="module")
def table(spark):
    draw = np.random.default_rng(31)
    day = dt.datetime(2020, 1, 5)
    data = [(7, day + dt.timedelta(seconds=int(s)), i, float(v)) for i, (s, v) in enumerate(zip(draw.integers(0, 3000, 4000), draw.normal(size=4000)))]
    data += [(7, day + dt.timedelta(days=int(d)), 10_000 + i, 1.0) for i, d in enumerate(draw.integers(-3, 3, 300))]
    data += [(int(k), day + dt.timedelta(days=int(d)), 20_000 + i, 2.0) for i, (k, d) in enumerate(zip(draw.integers(0, 40, 7000), draw.integers(0, 60, 7000)))]
    data += [(None, day, 40_000, 3.0), (None, day, 40_001, 4.0), (8, None, 40_002, 5.0), (8, None, 40_003, 6.0)]
    return data, spark.createDataFrame(data, "k long, ts timestamp_ntz, seq long, v double").repartition(6)


def in_order(data):
    by = {}
    for r in data:
        by.setdefault(r[0], []).append(r)
    for own in by.values():
        own.sort(key=lambda r: (r[1] is not None, r[1] or dt.datetime.min, r[2]))
    return by


def test_pieces_are_bounded_and_ordered(table):
    data, df = table
    rows = wi.split_hot_chunks(df.withColumn("_chunk", F.to_date("ts")), ["k"], ORDER, SHARES)
    sizes = [r["n"] for r in rows.groupBy("k", "_chunk", "_piece").agg(F.count("*").alias("n")).collect()]
    assert sum(sizes) == len(data) and max(sizes) < 2 * len(data) / SHARES
    hot = [r for r in rows.filter("k = 7 AND _piece > 0").groupBy("_piece").agg(F.min(F.struct(*ORDER)).alias("a"), F.max(F.struct(*ORDER)).alias("b")).orderBy("_piece").collect()]
    assert len(hot) > 10 and all(x["b"] < y["a"] for x, y in zip(hot, hot[1:]))


@pytest.mark.parametrize("shares", [SHARES, 1])
def test_previous_rows_and_positions(table, shares):
    data, df = table
    prev = {r["seq"]: (r["prev_v"], r["prev_seq"]) for r in wi.with_previous(df, "k", ORDER, ["v", "seq"], shares=shares).collect()}
    at = {r["seq"]: r["position"] for r in wi.with_position(df, ["k"], ORDER, shares=shares).collect()}
    assert len(prev) == len(at) == len(data)
    for own in in_order(data).values():
        for i, r in enumerate(own):
            assert prev[r[2]] == ((own[i - 1][3], own[i - 1][2]) if i else (None, None))
            assert at[r[2]] == i


def test_rows_that_tie_stay_together(spark):
    df = spark.createDataFrame([(1, 5, float(i)) for i in range(500)] + [(1, 6, 0.0)], "k long, t long, v double")
    rows = wi.split_hot_chunks(df.withColumn("_chunk", F.lit(0)), ["k"], ["t"], 10)
    assert rows.filter("t = 5").select("_piece").distinct().count() == 1


def test_no_hot_chunk_needs_no_bounds(spark):
    df = spark.range(1000).select((F.col("id") % 100).alias("k"), F.col("id").alias("t"))
    rows = wi.split_hot_chunks(df.withColumn("_chunk", F.lit(0)), ["k"], ["t"], 50)
    assert "Join" not in rows._jdf.queryExecution().optimizedPlan().toString()
    assert rows.select("_piece").distinct().collect()[0][0] == 0
