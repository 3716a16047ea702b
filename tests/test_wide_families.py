"""Wide columns and statistics per segment cost a row for what it has, not for every segment and feature."""

import datetime as dt

from pyspark.sql import functions as F

from cardloom.operators import aggregate as ag, pivot as pv, skew as sk, states as st

SEGMENTS = {"hist_": "lag < 0", "new_": "lag >= 0", "never_": "lag > 99"}


def facts(spark):
    rows = spark.range(6000).select((F.col("id") % 1500).alias("card"), F.col("id").alias("seq"), (F.col("id") % 3 - 1).alias("lag"), (F.col("id") % 7).cast("double").alias("a"),
                                    F.when(F.col("id") % 11 > 0, F.concat(F.lit("1"), F.when(F.col("id") % 2 > 0, ".").otherwise("_"), F.lit("0"))).alias("b"))
    # a card without days and rows without a card; two values of b have one name
    days = F.date_add(F.lit(dt.date(2020, 1, 1)), (F.col("seq") % 5).cast("int"))
    return rows.select(F.when(F.col("card") != 3, F.col("card")).alias("card"), "seq", "lag", "a", "b", F.when(F.col("card") != 4, days).alias("day"))


def plain(df):
    return sorted(map(repr, df.collect()))


def test_columns_from_the_totals_are_those_of_the_long_form(spark):
    lying = sk.staged_by_key(facts(spark), "card")
    rollup = sk.kept_by_key(pv.value_rollup(lying, "card", ["a", "b"], "seq", "day", SEGMENTS), "card")
    assert sk.lies_by_key(rollup, "card")
    long = pv.pivot_features(rollup, "card", list(SEGMENTS), ["a"])
    places = pv.feature_places(rollup, "card", list(SEGMENTS), ["a"])
    names = pv.feature_list(long)
    assert sorted(places) == names and len(places["new_b_cnt_pivot_1_0"]) == 2
    # the two values of one name: a card that has both may take either
    sure = [n for n in names if "_b_" not in n]
    got = pv.rollup_to_wide(rollup, "card", places, [*sure, "not_there"], len(SEGMENTS), ["a"])
    assert plain(got.drop("not_there")) == plain(pv.to_wide(long.filter(F.col("feature").isin(*sure)), "card", sure, fill=None))
    text = got._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]
    assert "Generate" not in text and "Exchange hashpartitioning" not in text and got.agg(F.count("not_there")).first()[0] == 0
    one = pv.rollup_to_wide(rollup, "card", places, ["new_b_cnt_pivot_1_0"], len(SEGMENTS), ["a"])
    assert one.filter("`new_b_cnt_pivot_1_0` IS NOT NULL").count() == long.filter("feature = 'new_b_cnt_pivot_1_0'").select("card").distinct().count()
    assert not sk.lies_by_key(sk.kept_by_key(facts(spark), "card"), "card")


def test_a_state_is_merged_only_for_the_segments_that_have_it(spark):
    states = st.fold(facts(spark), ["card", "lag", "day"], {"a": 2}).withColumn("_lag", F.col("lag"))
    spec = {"a": ("mean", "std", "max"), "_lag": ("nunique",)}
    got = st.statistics(states, "card", spec, SEGMENTS, by_key=["_lag"])
    tree = got._jdf.queryExecution().optimizedPlan().toString()
    # the totals of a column are summed once, whatever the number of segments
    assert any("Aggregate [card" in line and "_seg" in line and "CASE WHEN _in" not in line for line in tree.splitlines())
    every = {r["card"]: r for r in got.collect()}
    want = {r["card"]: r for r in ag.segmented_agg(facts(spark).withColumn("_lag", F.col("lag")), "card", spec, SEGMENTS).collect()}
    assert set(every) == set(want) and None in every
    for k, w in want.items():
        names = [c for c in w.asDict() if k is not None or "nunique" not in c]
        assert [None if every[k][c] is None else round(every[k][c], 9) for c in names] == [None if w[c] is None else round(w[c], 9) for c in names]
    assert (every[None]["_lag_nuniquehist_"], every[None]["_lag_nuniquenever_"]) == (1, None)


def test_unpivoted_numbers_are_not_made_text(spark):
    df = facts(spark)
    got = ag.two_level_many(df, "card", [("day", "seq"), ("b", "a")], ["lag", "b"], "seq", "a")
    text = got._jdf.queryExecution().optimizedPlan().toString()
    assert "cast(seq" not in text and "cast(day" not in text and "cast(lag" not in text
    want = ag.two_level(df, "card", "day", "seq", "nunique").join(ag.two_level(df, "card", "b", "a", "nunique"), "card").join(ag.two_level(df, "card", "lag", "seq", "count"), "card")
    names = want.columns
    # NULL keys match nothing in the joins
    kept = got.filter("card IS NOT NULL AND card <> 4").select(*[F.round(c, 9).alias(c) for c in names])
    assert plain(kept) == plain(want.select(*[F.round(c, 9).alias(c) for c in names])) and kept.count() > 1400
