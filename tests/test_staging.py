"""Bucketed joins, key filters, published versions and sketches."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from cardloom.operators import clean as cl, joins as jo, keyfilter as kf, sketches as sk
from cardloom.sources import tables as tb


def test_eight_bucketed_families_join_without_an_exchange(spark, tmp_path):
    families = {f"family{i}": spark.range(i, 100 + i).select(F.col("id").alias("card_id"), (F.col("id") * i).alias(f"v{i}"), F.lit(i).alias("shared")) for i in range(8)}
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        df = jo.join_bucketed(families, "card_id", 4, str(tmp_path))
        df.collect()
        plan = df._jdf.queryExecution().executedPlan().toString()
        assert "Exchange" not in plan.replace("ReusedExchange", "") and plan.count("SortMergeJoin") >= 7
        got = {r["card_id"]: r.asDict() for r in df.collect()}
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
        for name in families:
            spark.sql(f"DROP TABLE IF EXISTS {name}")
    assert got == {k: {"card_id": k, "shared": 0, **{f"v{i}": k * i if k >= i else None for i in range(8)}} for k in range(100)}


@pytest.mark.parametrize("most_bytes", [kf.MOST_BYTES, 64])
def test_every_known_key_passes_and_few_others(spark, most_bytes):
    keys = spark.range(500).select((F.col("id") * 7).cast("string").alias("k")).union(spark.sql("SELECT CAST(NULL AS STRING)"))
    facts = spark.range(20_000).select(F.col("id").cast("string").alias("k"), F.col("id").alias("v")).union(spark.sql("SELECT CAST(NULL AS STRING), 1L"))
    passed = {r["k"] for r in kf.only_known(facts, keys, "k", most_bytes).collect()}
    known = {str(7 * i) for i in range(500)}
    assert known <= passed and None not in passed
    if most_bytes == kf.MOST_BYTES:
        assert len(passed) < len(known) + 500
    assert {r["k"] for r in cl.restrict_to(facts, keys.filter("k IS NOT NULL"), "k").collect()} == known


def test_no_keys_let_nothing_pass(spark):
    assert kf.only_known(spark.range(50), spark.range(0), "id").count() == 0


def test_readers_see_published_versions_only(spark, tmp_path):
    folder, frame = str(tmp_path / "features"), lambda n: spark.range(n).withColumnRenamed("id", "card_id")
    with pytest.raises(ValueError, match="nothing is published"):
        tb.current_version(spark, folder)
    first = tb.write_version(frame(3), folder)
    tb.publish(spark, folder, first)
    pinned = tb.current_version(spark, folder)
    second = tb.write_version(frame(5), folder)
    # the writer ends here: readers still have the whole old table
    assert tb.read_version(spark, folder).count() == 3
    tb.publish(spark, folder, second)
    assert tb.read_version(spark, folder).count() == 5 and tb.read_version(spark, folder, pinned).count() == 3
    with pytest.raises(Exception, match="PATH_NOT_FOUND|does not exist"):
        tb.publish(spark, folder, "vnever_written")
    assert tb.drop_old_versions(spark, folder, keep=[first]) == []
    assert tb.drop_old_versions(spark, folder) == [first] and tb.drop_old_versions(spark, folder) == []
    assert tb.read_version(spark, folder).count() == 5 and spark.read.parquet(f"{folder}/{first}").count() == 0
    tb.publish(spark, folder, tb.write_version(frame(7), folder))
    assert tb.read_version(spark, folder).count() == 7


def test_sketches_stay_within_their_bound(spark):
    draw = np.random.default_rng(41)
    data = [(int(k), int(m), float(v)) for k, m, v in zip(draw.integers(0, 3, 30_000), draw.integers(0, 6, 30_000), draw.normal(0, 10, 30_000))]
    df = spark.createDataFrame(data + [(5, 0, None), (6, 1, float("nan")), (6, 1, 2.0)], "k long, m int, v double").repartition(5)
    states = sk.fold_sketches(df, ["k", "m"], ["v"])
    early, late = sk.fold_sketches(df.filter("m < 3"), ["k", "m"], ["v"]), sk.fold_sketches(df.filter("m >= 3"), ["k", "m"], ["v"])
    points, segments = {"q10": 0.1, "q50": 0.5, "q975": 0.975}, {"_a": "m < 2", "": None}
    for table in (states, sk.merge_sketches(early.unionByName(late), ["k", "m"], ["v"])):
        got = {r["k"]: r for r in sk.quantiles(table, "k", "v", points, segments).collect()}
        assert got[5]["q50"] is None and got[6]["q50"] == 2.0 and got[6]["q10_a"] == 2.0
        for k in range(3):
            for seg, own in (("_a", [v for a, m, v in data if a == k and m < 2]), ("", [v for a, m, v in data if a == k])):
                own = np.sort(own)
                for n, q in points.items():
                    rank = np.searchsorted(own, got[k][n + seg], "right") / len(own)
                    assert abs(rank - q) <= sk.rank_error()
