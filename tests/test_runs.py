"""Plan checks, model properties and the three end-to-end runs on the smallest tables."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from cardloom.operators import aggregate as ag, blend as bl, folds as fo, models as mo
from cardloom.plans import baseline as ba, refined as rf, runs
from cardloom.sources.fixtures import ROW_ORDER, Tables
from queries.plans import AS_OF, _prepared, _rows


@pytest.fixture(scope="module")
def tables(spark, folder):
    return Tables(spark, folder)


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_card_statistics_stay_in_the_jvm_without_expand(tables):
    plan = plan_of(ba.card_statistics(_prepared(tables, 2)))
    assert "Expand" not in plan and "Python" not in plan and "collect_set" not in plan and "CartesianProduct" not in plan


def test_refined_families_do_not_join_or_collect_the_facts(tables):
    rows = _rows(tables)
    for df in (rf.base_statistics(rows, AS_OF), rf.two_level_features(rows),
               rf.card_profile(rows, tables.cards, AS_OF, features=["hist_cardf_weekend_cnt_pivot_1"])):
        plan = plan_of(df)
        assert "Expand" not in plan and "Python" not in plan and "CartesianProduct" not in plan
        assert "collect_set" not in plan


def test_first_shuffle_carries_partial_states(tables):
    plan = plan_of(ag.agg_spec(tables.txn, "card_id", {"amount_units": ["sum", "mean"]}))
    assert "partial_sum" in plan and plan.count("hashpartitioning(card_id") == 1


def test_scan_reads_only_needed_columns(tables):
    plan = plan_of(ag.agg_spec(tables.txn, "card_id", {"month_lag": ["max"]}))
    scan = next(line for line in plan.splitlines() if "lineitem" in line and "ReadSchema" in line)
    read = scan.split("ReadSchema:")[1]
    assert "l_shipdate" in read and "l_extendedprice" not in read and "l_returnflag" not in read


def test_card_statistics_width(tables):
    # 112 columns for each of three segments, and the key
    assert len(ba.card_statistics(_prepared(tables, 2)).columns) == 337


def test_bayesian_ridge_matches_least_squares_on_clean_data():
    rng = np.random.default_rng(5)
    x = rng.normal(size=(400, 3))
    y = x @ np.array([0.5, -1.0, 2.0]) + 3 + rng.normal(scale=0.01, size=400)
    z = np.column_stack([np.ones(400), x, y])
    coef, intercept = bl.bayesian_ridge(z.T @ z)
    assert np.allclose(coef, [0.5, -1.0, 2.0], atol=0.01) and abs(intercept - 3) < 0.01


def test_bayesian_ridge_shrinks_noise():
    rng = np.random.default_rng(6)
    x, y = rng.normal(size=(60, 3)), rng.normal(size=60)
    z = np.column_stack([np.ones(60), x, y])
    coef, _ = bl.bayesian_ridge(z.T @ z)
    assert np.abs(coef).sum() < np.abs(np.linalg.lstsq(z[:, :4], y, rcond=None)[0][1:]).sum()


def test_stack_reads_every_row_once_per_repeat(spark):
    rng = np.random.default_rng(7)
    y = rng.normal(size=300)
    data = [(i, float(v + rng.normal() * 0.1), float(v + rng.normal() * 0.5), float(v)) for i, v in enumerate(y)]
    df = spark.createDataFrame(data, "card_id bigint, a double, b double, target double")
    oof = fo.assign_folds(df, "card_id", 5, seed=1, repeats=2)
    oof_pred, test_pred, fits = bl.stack(oof, df.drop("target"), ["a", "b"], "target")
    assert len(fits) == 10 and oof_pred.count() == 300
    error = oof_pred.agg(bl.rmse("pred", "target")).first()[0]
    assert error < 0.15 and test_pred.count() == 300


def test_out_of_fold_beats_the_mean(spark):
    df = spark.range(600).select(
        F.col("id").alias("card_id"), (F.col("id") % 7).cast("double").alias("x"), (F.col("id") % 3).cast("double").alias("z"))
    df = df.withColumn("target", F.col("x") * 2 - F.col("z"))
    matrix = mo.assemble_matrix(df, ["x", "z"], "card_id", "target")
    fitted = mo.oof_fit_predict(matrix, matrix, mo.forest(numTrees=10, minInstancesPerNode=2), k=3)
    assert fitted.oof.count() == 600 == fitted.oof.select("card_id").distinct().count()
    spread = df.agg(F.stddev_pop("target")).first()[0]
    assert all(r["score"] < spread / 2 for r in fitted.scores.collect())
    assert set(fitted.summary().columns) == {"mean_score", "std_score"}


def test_baseline_run(tables, tmp_path):
    t = tables
    merchants = t.merchants.withColumn("avg_purchases_lag12", F.col("avg_purchases_lag6"))
    cards = t.cards.withColumn("first_active_month", F.date_format("first_active_month", "yyyy-MM"))
    out = runs.run_baseline(cards, t.txn.filter("month_lag < 0"), t.txn.filter("month_lag >= 0"), merchants, ROW_ORDER,
                            str(tmp_path), top=12, forest={"numTrees": 5, "minInstancesPerNode": 5},
                            grid={"featureSubsetStrategy": ["all", "6"]})
    assert out.columns == ["card_id", "target"]
    assert out.filter("target IS NOT NULL").count() == t.cards.filter("split = 'test'").count()
    assert t.spark.read.parquet(f"{tmp_path}/oof").count() == t.cards.filter("split = 'train'").count()


def test_grid_is_checked_before_anything_is_read():
    with pytest.raises(ValueError, match="12 features"):
        runs.run_baseline(None, None, None, None, ROW_ORDER, "", top=12, grid={"featureSubsetStrategy": ["all", "80"]})


def test_refined_run(tables, tmp_path):
    t = tables
    out = runs.run_refined(t.cards, t.txn.filter("month_lag < 0"), t.txn.filter("month_lag >= 0"), AS_OF, str(tmp_path), now="2002-01-01",
                           outlier_below=1000.0, rounds=1, folds=2, top=8, presets=("first", "selector"), missing_merchant=-1)
    n = t.cards.filter("split = 'test'").count()
    assert set(out) == {"mean", "stacked", "two_stage", "two_stage_and_stack"}
    for df in out.values():
        assert df.filter("target IS NOT NULL").count() == n
    kinds = t.spark.read.parquet(f"{tmp_path}/test").select("model", "target_kind").distinct().count()
    assert kinds == 6


def test_id_vector_run(tables, tmp_path):
    t = tables
    dense = t.cards.select("card_id", "target", "split", "feature_1", "feature_2")
    out = runs.run_id_vectors(t.cards, t.txn, dense, ROW_ORDER, str(tmp_path), top=10, draws=2, rounds=2, folds=2)
    assert out.filter("target IS NOT NULL").count() == t.cards.filter("split = 'test'").count()
