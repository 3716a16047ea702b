"""Edge frames: NULL, NaN, infinities, tiny and constant groups, ties and borders."""

import math
import statistics

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from cardloom.functions import scalars as sc, semantics as se
from cardloom.operators import aggregate as ag, clean as cl, encode as en, pivot as pv, profile as pr, quantile as qt, select as sl


def rows(df, *order):
    return [tuple(r) for r in df.orderBy(*order).collect()]


def test_division_by_zero(spark):
    df = spark.createDataFrame([(1.0, 0.0), (-1.0, 0.0), (0.0, 0.0), (None, 0.0), (4.0, 2.0), (4.0, None)], "a double, b double")
    assert [r[0] for r in df.select(se.div_inf("a", "b")).collect()] == [math.inf, -math.inf, None, None, 2.0, None]


def test_floor_division_of_negatives(spark):
    df = spark.createDataFrame([(-1,), (-30,), (29,), (30,), (None,)], "a int")
    assert [r[0] for r in df.select(se.floor_div("a", 30)).collect()] == [-1, -1, 0, 1, None]


def test_skewness_small_and_constant_groups(spark):
    data = [("one", 1.0), ("two", 1.0), ("two", 5.0)] + [("flat", 2.0)] * 4 + [("bent", v) for v in (1.0, 2.0, 3.0, 10.0)]
    df = spark.createDataFrame(data, "k string, v double").groupBy("k")
    got = {r[0]: r[1] for r in df.agg(se.skew_g1("v")).collect()}
    assert got["one"] is None and got["two"] is None and got["flat"] is None
    assert abs(got["bent"] - 1.7636) < 1e-3
    assert {r[0]: r[1] for r in df.agg(se.skew_g1("v", True)).collect()}["flat"] == 0.0


def test_sample_deviation_and_empty_sum(spark):
    df = spark.createDataFrame([("a", None), ("a", None), ("b", 1.0)], "k string, v double")
    got = rows(ag.agg_spec(df, "k", {"v": ["sum", "std", "count", "size", "nunique"]}), "k")
    assert got == [("a", 0.0, None, 0, 2, 0), ("b", 1.0, None, 1, 1, 1)]


def test_empty_segment_is_null_everywhere(spark):
    df = spark.createDataFrame([("a", 1, 2.0), ("b", -1, 3.0)], "k string, m int, v double")
    got = rows(ag.segmented_agg(df, "k", {"v": ["sum", "nunique", "size"]}, {"_old": "m < 0", "_new": "m >= 0"}), "k")
    assert got == [("a", None, None, None, 2.0, 1, 1), ("b", 3.0, 1, 1, None, None, None)]


def test_mask_count_equals_plain_count_and_refuses_strays(spark):
    df = spark.createDataFrame([("a", 0), ("a", 62), ("a", 62), ("a", None), ("b", None)], "k string, v int")
    masked = rows(ag.agg_spec(df, "k", {"v": ["nunique"]}, domains={"v": (0, 62)}), "k")
    assert masked == rows(ag.agg_spec(df, "k", {"v": ["nunique"]}), "k") == [("a", 2), ("b", 0)]
    with pytest.raises(PySparkException):
        ag.agg_spec(df, "k", {"v": ["nunique"]}, domains={"v": (0, 5)}).collect()


def test_signed_zero_is_one_value(spark):
    df = spark.createDataFrame([("a", 0.0), ("a", -0.0)], "k string, v double")
    assert rows(ag.distinct_counts(df, "k", ["v"], {"": None}), "k") == [("a", 1)]


def test_order_statistics_against_python(spark):
    groups = {"neg": [-5.0, -1.5, 0.0, 2.0, 1e-9, -1e-9], "one": [3.0], "inf": [1.0, math.inf, -math.inf],
              "many": [float((i * 7919) % 1000) / 7 for i in range(501)], "dup": [2.0] * 9 + [3.0]}
    df = spark.createDataFrame([(k, v) for k, vs in groups.items() for v in vs] + [("null", None)], "k string, v double")
    q = {r[0]: r[1:] for r in qt.element_quantile(df, "k", "v", {"q0": 0.0, "q25": 0.25, "q975": 0.975, "q1": 1}).collect()}
    m = {r[0]: r[1] for r in qt.median(df, "k", "v", "m").collect()}
    assert set(q) == set(groups)
    for k, vs in groups.items():
        s, n = sorted(vs), len(vs)
        assert tuple(q[k]) == (s[0], s[int(n * 0.25)], s[int(n * 0.975)], s[-1]), k
        assert m[k] == statistics.median(vs), k


def test_bucket_never_decreases(spark):
    values = sorted([0.0, 1e-300, 1e300, math.inf, -math.inf] + [s * 1.0001 ** i for i in range(0, 4000, 3) for s in (1, -1)])
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], "i int, v double")
    codes = [r[0] for r in df.orderBy("i").select(qt.value_bucket(F.col("v"))).collect()]
    assert codes == sorted(codes) and len(set(codes)) > 500


def test_infinities_and_means(spark):
    df = spark.createDataFrame([(math.inf, 1.0, None), (3.0, math.inf, 2.0), (None, 7.0, 4.0)], "a double, b double, c double")
    done = rows(cl.fill_with_mean(cl.replace_infinite(df, ["a", "b"]), ["c"]), "c", "b")
    assert done == [(3.0, 7.0, 2.0), (7.0, 1.0, 3.0), (None, 7.0, 4.0)]


def test_sentinels_and_maps(spark):
    df = spark.createDataFrame([(-1,), (999,), (0,), (3,)], "v int")
    assert [r[0] for r in df.select(sc.rewrite_installments("v")).collect()] == [None, None, 1, 3]
    assert [r[0] for r in df.select(sc.map_values("v", {0: 7})).collect()] == [None, None, 7, None]


def test_row_statistics_skip_nulls(spark):
    df = spark.createDataFrame([(1, 2, 6), (1, None, 3), (None, None, 5)], "a int, b int, c int")
    s = sc.row_stats(["a", "b", "c"])
    got = [tuple(r) for r in df.select(s["sum"], s["max"], s["min"], F.round(s["std"], 6)).collect()]
    assert got == [(9.0, 6.0, 1.0, 2.645751), (None, 3.0, 1.0, 1.414214), (None, 5.0, 5.0, None)]


def test_codes_are_dense_and_ordered(spark):
    df = spark.createDataFrame([(v,) for v in ("b", "-1", "Z", "a", "b", "é")], "v string")
    expected = {v: i for i, v in enumerate(sorted({"b", "-1", "Z", "a", "é"}))}
    assert {r[0]: r[1] for r in en.fit_codes(df, "v").collect()} == expected
    # the range-sorted path gives the same dictionary
    assert {r[0]: r[1] for r in en.fit_codes(df, "v", rows=1).collect()} == expected
    assert [r[0] for r in en.ordinal_encode(df, "v").collect()] == [expected[v] for v in ("b", "-1", "Z", "a", "b", "é")]
    assert rows(en.apply_codes(spark.createDataFrame([("new",)], "v string"), en.fit_codes(df, "v"), "v"), "v") == [(None,)]


def test_target_encoding_of_an_unseen_value(spark):
    fit = spark.createDataFrame([("a", 1), ("a", 0)], "c string, y int")
    new = spark.createDataFrame([("a",), ("b",)], "c string")
    assert rows(en.target_encode(fit, new, "c", "y", "m"), "c") == [("a", 0.5), ("b", None)]


def test_top_k_ties_and_nulls(spark):
    df = spark.createDataFrame([("c", 0.5), ("a", 0.5), ("b", 0.5), ("n", None), ("z", 0.9)], "feature string, abs_corr double")
    assert sl.top_names(df, 3) == ["z", "a", "b"]
    assert sl.top_names(df, 5)[-1] == "n"


def test_correlation_of_constants_is_null(spark):
    df = spark.createDataFrame([(1.0, 2.0, 5.0), (2.0, 2.0, 3.0), (None, 2.0, 9.0)], "a double, flat double, y double")
    got = {r[0]: r[1] for r in pr.corr_with_target(df, ["a", "flat"], "y").collect()}
    assert got["flat"] is None and abs(got["a"] - 0.981981) < 1e-5


def test_pivot_rows_add_up(spark):
    df = spark.createDataFrame([(1, "x", 1), (1, "y", 1), (1, "y", None), (2, "x", 3), (2, None, 3)], "k int, c string, m int")
    assert rows(pv.count_pivot(df, "k", "c", "m", ["x", "y"]), "k") == [(1, 1, 1), (2, 1, 0)]


def test_downcast_is_strict_at_the_border(spark):
    df = spark.createDataFrame([(127, 126, 40000), (0, -127, 1)], "a int, b int, c bigint")
    assert [f.dataType.simpleString() for f in cl.downcast(df).schema.fields] == ["smallint", "tinyint", "int"]


def test_name_rules():
    kept = ["hist_card_id_size", "new_cardf_month_diff_mean", "hist_last2_card_id_cnt"]
    dropped = ["auth_cardf_subsector_id_cnt_pivot_3", "hist_last2_month_diff_mean", "x_month_diff_std", "target", "min_num"]
    assert [n for n in kept + dropped if not cl.pruned_by_name(n)] == kept
