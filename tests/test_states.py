"""Mergeable states: equal to recomputation in any grouping, stable beside large offsets, one read of the facts."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from cardloom.operators import aggregate as ag, states as st
from cardloom.operators.skew import lies_by_key, staged_by_key
from cardloom.plans import prepare as pp, refined as rf
from cardloom.session import staged
from cardloom.sources.fixtures import Tables

AS_OF = "2002-01-01 00:00:00"
STATS = ("sum", "mean", "min", "max", "var", "std", "skew", "count")
SEGMENTS = {"_a": "m < 2", "_b": "m >= 2", "": None}


def table(spark, offset=0.0):
    draw = np.random.default_rng(21)
    data = [(int(k), int(m), int(d), None if v < -1.8 else float(offset + v), int(w))
            for k, m, d, v, w in zip(draw.integers(0, 5, 800), draw.integers(0, 4, 800), draw.integers(0, 9, 800), draw.normal(0, 1, 800), draw.integers(0, 60, 800))]
    data += [(9, 3, 0, 5.0, 1), (9, 3, 0, 5.0, 1), (9, 3, 1, 5.0, 2), (10, 0, 0, None, 0), (11, None, None, 1.0, 3), (11, 1, 0, offset + 2.0, 3)]
    return spark.createDataFrame(data, "k long, m int, d int, v double, w int")


def rows(df):
    return {r["k"]: r.asDict() for r in df.collect()}


def same(got, want, tol=1e-9):
    assert set(got) == set(want)
    for k, w in want.items():
        assert set(got[k]) == set(w)
        for c, v in w.items():
            if isinstance(v, float):
                assert got[k][c] == pytest.approx(v, rel=tol, abs=1e-12), (k, c)
            else:
                assert got[k][c] == v, (k, c)


@pytest.mark.parametrize("keys", [["k", "m"], ["k", "m", "d"]])
def test_statistics_from_states_are_those_of_the_rows(spark, keys):
    df, spec = table(spark), {"v": STATS, "w": ("nunique", "mean")}
    states = st.fold(df, keys, st.powers({"v": STATS, "w": ("mean",)}), {"w": (0, 59)})
    same(rows(st.statistics(states, "k", spec, SEGMENTS)), rows(ag.segmented_agg(df, "k", spec, SEGMENTS)))


def test_values_of_keys_are_counted_per_segment(spark):
    df = table(spark)
    states = st.fold(df, ["k", "m", "d"], {"v": 1}).withColumn("day", F.col("d"))
    got = st.statistics(states, "k", {"day": ("nunique",)}, SEGMENTS, by_key=["day"])
    same(rows(got), rows(ag.segmented_agg(df.withColumn("day", F.col("d")), "k", {"day": ["nunique"]}, SEGMENTS)))


def test_appended_equals_recomputed(spark):
    df, keys, columns = table(spark), ["k", "m", "d"], {"v": 3, "w": 2}
    whole = st.fold(df, keys, columns, {"w": (0, 59)})
    # the parts share groups, as late rows of an old month do
    parts = [st.fold(df.filter(F.pmod(F.xxhash64("v", "w"), F.lit(3)) == i), keys, columns, {"w": (0, 59)}) for i in range(3)]
    joined = parts[0]
    for p in parts[1:]:
        joined = st.append(joined, p, keys, columns, ["w"])

    def plain(states):
        return {(r["k"], r["m"], r["d"]): (r["rows"], r["w_mask"], [float(x or 0) for x in (*r["v"], *r["w"])]) for r in states.collect()}

    a, b = plain(joined), plain(whole)
    assert set(a) == set(b)
    for key, (n, bits, values) in b.items():
        assert a[key][:2] == (n, bits) and a[key][2] == pytest.approx(values, rel=1e-9, abs=1e-9)


def test_a_large_offset_does_not_cancel(spark):
    offset = 1e9
    df = table(spark, offset)
    got = rows(st.statistics(st.fold(df, ["k", "m", "d"], {"v": 3}), "k", {"v": ("std", "skew")}, {"": None}))
    by = {}
    for r in df.collect():
        if r["v"] is not None:
            by.setdefault(r["k"], []).append(r["v"] - offset)
    for k, own in by.items():
        own = np.array(own)
        if k < 5:
            n, d = len(own), own - own.mean()
            skew = np.sqrt(n * (n - 1)) / (n - 2) * (d ** 3).mean() / (d ** 2).mean() ** 1.5
            # the values themselves are rounded to 1e-7 beside the offset
            assert got[k]["v_std"] == pytest.approx(own.std(ddof=1), rel=1e-5)
            assert got[k]["v_skew"] == pytest.approx(skew, rel=1e-3, abs=1e-4)


def test_a_value_outside_its_domain_raises(spark):
    with pytest.raises(Exception, match="w outside its stated domain"):
        st.fold(table(spark), ["k"], {"w": 1}, {"w": (0, 9)}).collect()


@pytest.fixture(scope="module")
def facts(spark, folder):
    t = Tables(spark, folder)
    return t, pp.clean_transactions(t.txn.withColumn("is_new", F.col("month_lag") >= 0), -1)


def test_a_new_month_appended_gives_the_same_families(facts):
    _, df = facts
    every = rf.staged_rows(df)
    old, late = rf.state_table(every.filter("month_lag <> 0"), AS_OF), rf.state_table(every.filter("month_lag = 0"), AS_OF)
    assert late.limit(1).count()
    both = rf.merge_states(staged(old), late)
    a, b = (rf.base_statistics(every, AS_OF, states=s) for s in (both, rf.state_table(every, AS_OF)))
    got, want = ({r["card_id"]: r for r in d.collect()} for d in (a, b))
    assert set(got) == set(want)
    for k, w in want.items():
        plain = [[float("nan") if x is None else float(x) for x in r] for r in (got[k], w)]
        assert plain[0] == pytest.approx(plain[1], rel=1e-9, abs=1e-6, nan_ok=True)


def test_staging_moves_neither_functions_of_the_moment_nor_unread_columns(spark, facts):
    t, df = facts

    def written(every):
        return set(spark.read.parquet(*every.inputFiles()).columns)

    def plain(rows):
        return sorted(map(repr, rows.collect()))

    every, pivots = rf.staged_rows(df), rf.staged_rows(df, rf.PIVOT_COLUMNS, t.txn_sizes)
    assert not {*rf.DAY_PARTS, "hour", "purchase_date_floorday"} & written(every)
    assert written(pivots) == {"card_id", "is_new", "authorized_flag", "category_1", "category_2", "category_3", "month_lag", "subsector_id", "merchant_id", "purchase_date"}
    assert lies_by_key(every, "card_id") and lies_by_key(pivots, "card_id")
    assert every.dtypes == df.select(*rf.FACT_COLUMNS).dtypes and plain(every) == plain(df.select(*rf.FACT_COLUMNS))
    assert plain(pivots) == plain(df.select(*rf.PIVOT_COLUMNS))


def test_rows_of_a_card_are_counted_from_the_keys(spark, facts):
    t, df = facts
    got, want = (sorted(map(tuple, d.groupBy("card_id").agg(n).collect())) for d, n in ((t.txn_sizes, F.sum("_n")), (df, F.count("*"))))
    assert got == want and scans(t.txn_sizes, "part") + scans(t.txn_sizes, "supplier") == 0
    # a hot key is found by the numbers alone
    sizes = spark.createDataFrame([(1, 900), (2, 100)], "card_id long, _n long")
    few = spark.range(10).select(F.col("id").alias("card_id"))
    assert not lies_by_key(staged_by_key(few, "card_id", bucket_rows=10, sizes=sizes), "card_id")


def test_base_statistics_move_nothing_after_staging(facts, monkeypatch):
    _, df = facts
    every = rf.staged_rows(df, rf.BASE_COLUMNS)

    def plain(got):
        return {r["card_id"]: [float("nan") if x is None else float(x) for x in r] for r in got.collect()}

    here = rf.base_statistics(every, AS_OF)
    small = plain(here)
    text = here._jdf.queryExecution().executedPlan().toString()
    assert len(small) > 1 and "Exchange hashpartitioning" not in text and "BroadcastHashJoin" in text
    # categories with more values than may be broadcast
    monkeypatch.setattr(rf, "is_small", lambda table: False)
    large = plain(rf.base_statistics(every, AS_OF))
    assert set(small) == set(large)
    for k, v in large.items():
        assert small[k] == pytest.approx(v, rel=1e-9, abs=1e-9, nan_ok=True)


def scans(df, table):
    text = df._jdf.queryExecution().toString().split("== Physical Plan ==")[1]
    return text.count(f"{table}.parquet")


def test_families_read_no_facts_after_staging(facts):
    t, df = facts
    every = rf.staged_rows(df)
    states = staged(rf.state_table(every, AS_OF))
    for family in (rf.base_statistics(every, AS_OF, states=states), rf.card_profile(every, t.cards, AS_OF, states=states, features=[])):
        assert scans(family, "lineitem") == 0
    assert scans(df, "lineitem") == 1
