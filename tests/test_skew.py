"""One card holds most rows: results still equal brute force, and no group is collected."""

import datetime as dt
import math
from collections import Counter

import pytest
from pyspark.sql import functions as F

from cardloom.operators import aggregate as ag, folds as fo, joins as jo, skew as sk, text as tx, windows as wi

ORDER = ["ts", "seq"]


@pytest.fixture(scope="module")
def facts(spark):
    start = dt.datetime(2018, 1, 1)
    data = []
    for i in range(3000):
        card = 1 if i % 3 else 2 + i % 50
        ident = None if i % 11 == 0 else f"M{i * 31 % 97} x{i % 7}"
        data.append((card, start + dt.timedelta(hours=i * 7 % 4001), i, ident, i % 13 - 6, float(i * 17 % 1009)))
    return data, spark.createDataFrame(data, "card int, ts timestamp_ntz, seq int, id string, lag int, v double").repartition(5)


def by_card(data):
    groups = {}
    for r in sorted(data, key=lambda r: (r[1], r[2])):
        groups.setdefault(r[0], []).append(r)
    return groups


def test_previous_rows_cross_chunks(facts):
    data, df = facts
    got = {r["seq"]: r["prev_v"] for r in wi.with_previous(df, "card", ORDER, ["v"]).collect()}
    want = {}
    for rows in by_card(data).values():
        for a, b in zip([None, *rows], rows):
            want[b[2]] = None if a is None else a[5]
    assert got == want


def test_positions(facts):
    data, df = facts
    got = {r["seq"]: r["position"] for r in wi.with_position(df, ["card"], ORDER).collect()}
    assert got == {r[2]: i for rows in by_card(data).values() for i, r in enumerate(rows)}


def test_bigrams_and_weights(facts, spark):
    data, df = facts
    toks = tx.document_tokens(df, "card", ["id"], ORDER, {"all": None})
    counts = tx.count_terms(toks, "card").unionByName(tx.count_terms(tx.bigrams(toks, "card", ORDER), "card"))
    want = {}
    for card, rows in by_card(data).items():
        words = [w for r in rows for w in ("nan" if r[3] is None else r[3].lower()).split() if len(w) > 1]
        want[card] = Counter(words) + Counter(" ".join(p) for p in zip(words, words[1:]))
    got = {}
    for r in counts.collect():
        got.setdefault(r["card"], {})[r["term"]] = r["tf"]
    assert got == {k: dict(v) for k, v in want.items()}

    n = len(want)
    seen = Counter(t for c in want.values() for t in c)
    weights = {}
    for card, c in want.items():
        raw = {t: (1 + math.log(f)) * (math.log((1 + n) / (1 + seen[t])) + 1) for t, f in c.items() if 3 <= seen[t] <= 0.9 * n}
        norm = math.sqrt(sum(w * w for w in raw.values()))
        weights.update({(card, t): w / norm for t, w in raw.items()})
    result = {(r["card"], r["term"]): r["weight"] for r in tx.tfidf(counts, F.lit(n), "card").collect()}
    assert set(result) == set(weights)
    assert all(abs(result[k] - w) < 1e-9 for k, w in weights.items())


def test_in_row_bigrams_equal_windowed_ones(spark):
    df = spark.createDataFrame([(1, "aa bb cc"), (2, "zz"), (3, "a bb c dd"), (4, "")], "k int, t string")
    got = sorted((r["k"], r["token"]) for r in tx.text_bigrams(df, "k", "t").collect())
    assert got == [(1, "aa bb"), (1, "bb cc"), (3, "bb dd")]


def test_distinct_counts(facts):
    data, df = facts
    got = {r[0]: r[1] for r in ag.distinct_counts(df, "card", ["id"], {"": None}).collect()}
    assert got == {c: len({r[3] for r in rows} - {None}) for c, rows in by_card(data).items()}


def test_first_row_per_key(facts):
    data, df = facts
    got = {r["card"]: r["seq"] for r in wi.first_per_key(df, "card", ORDER).collect()}
    assert got == {c: rows[0][2] for c, rows in by_card(data).items()}


def test_keyed_join_splits_hot_and_missing_keys(spark):
    data = [(None if i % 5 == 0 else 1 if i % 3 else i % 40, i) for i in range(6000)]
    df = spark.createDataFrame(data, "k int, v int")
    table = spark.createDataFrame([(k, f"n{k}") for k in range(0, 40, 1) if k != 7], "k int, name string")
    for how in ("left", "inner", "left_semi"):
        plain = df.join(table, "k", how)
        split = sk.keyed_join(df, table, "k", how, shares=20)
        assert split.columns == plain.columns
        assert sorted(map(str, split.collect())) == sorted(map(str, plain.collect()))
    sized = df.filter("k IS NOT NULL").groupBy("k").agg(F.max("v").alias("m"), F.count(F.lit(1)).alias("n"))
    got = sk.keyed_join(df, sized, "k", size="n", shares=20)
    assert sorted(map(str, got.collect())) == sorted(map(str, df.join(sized.drop("n"), "k", "left").collect()))


def test_hot_keys_are_few_and_salted_by_size(spark):
    counts = spark.createDataFrame([(1, 4000), (2, 300), (3, 10), (4, 5690)], "k int, n bigint")
    got = {r["k"]: r["_salts"] for r in sk.hot_keys(counts, ["k"], "n", shares=100).collect()}
    assert got == {1: 40, 2: 3, 4: 57}


def test_salted_rows_of_a_hot_key_are_spread_over_partitions(spark):
    conf = {"spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
            "spark.sql.adaptive.coalescePartitions.enabled": "false"}
    old = {k: spark.conf.get(k, None) for k in conf}
    try:
        for k, v in conf.items():
            spark.conf.set(k, v)
        df = spark.range(0, 20000, 1, 4).select(F.when(F.col("id") % 3 > 0, 1).otherwise(F.col("id") % 90 + 2).alias("k"), "id")
        table = df.groupBy("k").agg(F.max("id").alias("m"), F.count(F.lit(1)).alias("n"))
        parts = sk.keyed_join(df, table, "k", size="n", shares=200).groupBy(F.spark_partition_id().alias("p")).count().collect()
    finally:
        for k, v in old.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)
    assert max(r["count"] for r in parts) < 20000 * 0.3


def test_folds_partition_the_keys(spark):
    df = spark.range(1003).withColumnRenamed("id", "card_id")
    got = fo.assign_folds(df, "card_id", 5, seed=7, repeats=2).collect()
    for rep in (0, 1):
        folds = Counter(r["fold"] for r in got if r["repeat"] == rep)
        assert sorted(folds) == [0, 1, 2, 3, 4] and max(folds.values()) - min(folds.values()) <= 1
        assert len({r["card_id"] for r in got if r["repeat"] == rep}) == 1003
    again = fo.assign_folds(df.repartition(7), "card_id", 5, seed=7, repeats=2).collect()
    assert sorted(map(tuple, got)) == sorted(map(tuple, again))


def test_join_features_keeps_all_base_rows(spark):
    base = spark.createDataFrame([(1, "a"), (2, "b")], "k int, x string")
    feats = spark.createDataFrame([(1, "z", 5)], "k int, x string, f int")
    assert sorted(map(tuple, jo.join_features(base, [feats], "k").collect())) == [(1, "a", 5), (2, "b", None)]


def test_keyed_join_reads_only_what_is_wanted(spark, folder):
    lines = spark.read.parquet(f"{folder}/lineitem.parquet")
    table = spark.read.parquet(f"{folder}/orders.parquet").select(F.col("o_orderkey").alias("l_orderkey"), "o_custkey")
    joined = sk.keyed_join(lines, table, "l_orderkey", row_id=["l_orderkey", "l_linenumber"]).select("l_quantity", "o_custkey")
    plan = joined._jdf.queryExecution().executedPlan().toString()
    assert "l_quantity" in plan and "l_shipdate" not in plan and "l_comment" not in plan and "l_extendedprice" not in plan


def test_equal_rows_of_a_hot_key_are_spread(spark):
    df = spark.range(20_000).select(F.lit(7).alias("k"), F.lit("same").alias("v"), F.col("id").alias("row"))
    table = spark.createDataFrame([(7, 20_000)], "k int, n long")
    joined = sk.keyed_join(df, table, "k", size="n", shares=200, row_id=["row"]).select("k", "v")
    parts = joined.groupBy(F.spark_partition_id().alias("p")).count().collect()
    assert sum(r["count"] for r in parts) == 20_000
