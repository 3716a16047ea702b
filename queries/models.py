"""Model work: folds, fits, searches and importances on per-card features. Rows-only checks."""

from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from cardloom.operators import aggregate as ag, models as mo
from cardloom.operators.folds import fold_of
from cardloom.session import staged

from .registry import query

FEATS = ["feature_1", "feature_2", "feature_3", "amount_units_sum_hist", "amount_units_mean_hist", "amount_units_sum_new",
         "amount_units_std_new", "merchant_id_count_hist", "merchant_id_count_new"]


def _table(t):
    stats = ag.segmented_agg(t.txn, "card_id", {"amount_units": ["sum", "mean", "std"], "merchant_id": ["count"]},
                             {"_hist": "month_lag < 0", "_new": "month_lag >= 0"})
    # the fixture label is independent of the transactions: add a visible dependence
    label = F.col("target") + F.coalesce(F.col("amount_units_mean_hist"), F.lit(0.0)) / 5e4 - F.col("feature_1") * 900
    df = t.cards.join(stats, "card_id", "left").withColumn("target", label)
    return df.filter("split = 'train'"), df.filter("split = 'test'")


def _matrices(t):
    train, test = _table(t)
    # training reads the matrix many times
    return staged(mo.assemble_matrix(train, FEATS, "card_id", "target")), mo.assemble_matrix(test, FEATS, "card_id")


@query("m02_out_of_fold_predictions")
def _(t):
    train, test = _matrices(t)
    return mo.oof_fit_predict(train, test, mo.forest(numTrees=20), k=5, seed=22).oof.select("card_id", "fold", "pred")


@query("m03_random_forest")
def _(t):
    train, test = _matrices(t)
    model = mo.forest(featureSubsetStrategy="all").setLabelCol("target").fit(train)
    return model.transform(test).select("card_id", F.col("prediction").alias("pred"))


@query("m04_boosted_trees")
def _(t):
    train, test = _matrices(t)
    model = mo.boosted_regressor("second", 10, early_stop=False, maxDepth=5).setLabelCol("target").fit(train)
    return model.transform(test).select("card_id", F.col("prediction").alias("pred"))


@query("m05_outlier_probability")
def _(t):
    train, test = _table(t)
    rows, label, kind = mo.target_variants(train, below=-3000.0)["binary"]
    matrix = mo.assemble_matrix(rows, FEATS, "card_id", label)
    fitted = mo.oof_fit_predict(matrix, mo.assemble_matrix(test, FEATS, "card_id"),
                                mo.boosted_classifier("third", 5, maxDepth=3), y=label, kind=kind, k=3, seed=18)
    return fitted.test


@query("m06_early_stopping")
def _(t):
    train, _ = _matrices(t)
    fitted = mo.oof_fit_predict(train, None, mo.boosted_regressor("third", 20, maxDepth=3), k=2, seed=18)
    trees = [(i, m.getNumTrees) for i, m in enumerate(fitted.models)]
    return fitted.scores.join(t.spark.createDataFrame(trees, "fold int, trees int"), "fold")


@query("m07_grid_search")
def _(t):
    train, _ = _matrices(t)
    _, _, table = mo.grid_search(mo.forest(numTrees=20), {"featureSubsetStrategy": ["all", "onethird"]}, train)
    return table


@query("m08_random_search")
def _(t):
    train, _ = _matrices(t)
    space = {**mo.SEARCH_SPACES["second"], "maxDepth": (2, 4)}
    _, _, table = mo.random_search(mo.boosted_regressor("second", 5, early_stop=False), space, 4, train)
    return table


@query("m09_importance_selection")
def _(t):
    train, _ = _table(t)
    _, scores = mo.importance_select(train, FEATS, 5, rounds=5, folds=3)
    return scores


# One split on a flag: a fit is the mean of each side, so that folds and searches have exact SQL.
_ONE_SPLIT = dict(numTrees=1, maxDepth=1, bootstrap=False, subsamplingRate=1.0, featureSubsetStrategy="all", minInstancesPerNode=1)


def _one_split(t):
    return mo.assemble_matrix(t.cards.filter("split = 'train'"), ["feature_3"], "card_id", "target")


def _fold_sql(k, seed, rows="cards WHERE split = 'train'"):
    return f"f AS (SELECT card_id, target, feature_3, CAST((card_id * 7919 + {seed}) % {k} AS INT) AS fold FROM {rows})"


@query("m02_one_split_out_of_fold", f"""
WITH {_fold_sql(5, 22)}
SELECT a.card_id, a.fold, round(avg(b.target), 4) AS pred FROM f a JOIN f b ON b.fold <> a.fold AND b.feature_3 = a.feature_3 GROUP BY a.card_id, a.fold""")
def _(t):
    fitted = mo.oof_fit_predict(_one_split(t), None, mo.forest(**_ONE_SPLIT), k=5, fold=fold_of(F.col("card_id"), 5, 22))
    return fitted.oof.select("card_id", "fold", F.round("pred", 4).alias("pred"))


def _errors_sql(name):
    """(fold, split, flat): held-out error of the mean of each side and of the mean of all, of the rows in ``name``."""
    return (f"(SELECT a.fold, avg(pow(a.target - s.m, 2)) AS split, avg(pow(a.target - w.m, 2)) AS flat FROM {name} a "
            f"JOIN (SELECT o.k, feature_3, avg(target) AS m FROM {name} JOIN (VALUES (0), (1)) o(k) ON o.k <> fold GROUP BY 1, 2) s ON s.k = a.fold AND s.feature_3 = a.feature_3 "
            f"JOIN (SELECT o.k, avg(target) AS m FROM {name} JOIN (VALUES (0), (1)) o(k) ON o.k <> fold GROUP BY 1) w ON w.k = a.fold GROUP BY a.fold)")


@query("m07_one_split_grid", f"""
WITH {_fold_sql(2, 22)}, e AS (SELECT * FROM {_errors_sql('f')}),
g AS (SELECT 0 AS setting, 'minInfoGain=0.0' AS params, avg(split) AS m, stddev_pop(split) AS s FROM e UNION ALL SELECT 1, 'minInfoGain=1e+18', avg(flat), stddev_pop(flat) FROM e)
SELECT CAST(setting AS INT) AS setting, params, round(m, 3) AS mean_mse, round(2 * s, 3) AS two_std, round(sqrt(m), 6) AS rmse FROM g""")
def _(t):
    _, _, table = mo.grid_search(mo.forest(**_ONE_SPLIT), {"minInfoGain": [0.0, 1e18]}, _one_split(t), fold=fold_of(F.col("card_id"), 2, 22))
    return table.select("setting", "params", F.round("mean_mse", 3).alias("mean_mse"), F.round("two_std", 3).alias("two_std"), F.round("rmse", 6).alias("rmse"))


# Settings of which the last alone may split.
_HALVED = [{"minInfoGain": g, "maxDepth": d, "minInstancesPerNode": n} for g, d, n in (
    (1e18, 0, 1), (1e18, 0, 1_000_000_000), (1e18, 1, 1), (1e18, 1, 1_000_000_000), (0.0, 0, 1), (0.0, 0, 1_000_000_000), (0.0, 1, 1_000_000_000), (0.0, 1, 1))]


def _halving_sql():
    ctes, plan = [_fold_sql(2, 22)], mo.rungs(len(_HALVED), 8)
    for i, rung in enumerate(plan):
        bound = int(rung.share * (1 << 52))
        ctes.append(f"p{i} AS (SELECT * FROM f WHERE ('0x' || substr(md5(card_id || ':22'), 1, 13))::BIGINT < {bound})" if rung.share < 1 else f"p{i} AS (SELECT * FROM f)")
        before = "(SELECT unnest(range(8)) AS setting)" if i == 0 else f"(SELECT setting FROM r{i - 1} WHERE kept)"
        ctes.append(f"r{i} AS (SELECT *, row_number() OVER (ORDER BY round(mean_mse, 3), setting) <= {-(-rung.settings // 2)} AS kept FROM "
                    f"(SELECT {i} AS rung, setting, {rung.rounds} AS rounds, {rung.share}::DOUBLE AS share, CASE WHEN setting = 7 THEN (SELECT avg(split) FROM e{i}) "
                    f"ELSE (SELECT avg(flat) FROM e{i}) END AS mean_mse FROM {before}))")
        ctes.insert(-1, f"e{i} AS (SELECT * FROM {_errors_sql(f'p{i}')})")
    return "WITH " + ", ".join(ctes) + " UNION ALL ".join(
        f" SELECT CAST(rung AS INT) AS rung, CAST(setting AS INT) AS setting, CAST(rounds AS INT) AS rounds, share, round(mean_mse, 3) AS mean_mse, kept FROM r{i}" for i in range(len(plan)))


@query("m08_successive_halving", _halving_sql())
def _(t):
    est = mo.forest(**{k: v for k, v in _ONE_SPLIT.items() if k not in ("numTrees", "maxDepth", "minInstancesPerNode")})
    _, _, table = mo.halving_search(est, _HALVED, "numTrees", 8, _one_split(t), fold=fold_of(F.col("card_id"), 2, 22))
    return table.withColumn("mean_mse", F.round("mean_mse", 3))


@query("m15_target_variants", """
SELECT 'all' AS variant, count(*) AS n, count(*) FILTER (target < -900) AS outliers FROM cards WHERE split = 'train'
UNION ALL SELECT 'normal', count(*), 0 FROM cards WHERE split = 'train' AND target >= -900
UNION ALL SELECT 'binary', count(*), count(*) FILTER (target < -900) FROM cards WHERE split = 'train'""")
def _(t):
    out = None
    for name, (rows, _, _) in mo.target_variants(t.cards.filter("split = 'train'"), below=-900.0).items():
        one = rows.agg(F.lit(name).alias("variant"), F.count(F.lit(1)).alias("n"), F.coalesce(F.sum("outliers"), F.lit(0)).alias("outliers"))
        out = one if out is None else out.unionByName(one)
    return out


# ---- trees that SQL can state ------------------------------------------------
# One split of a 0/1 feature without sampling: every prediction is a group mean.

def _flag_matrices(t, label):
    train = t.cards.filter("split = 'train'").withColumn("y", label)
    return mo.assemble_matrix(train, ["feature_3"], "card_id", "y"), mo.assemble_matrix(
        t.cards.filter("split = 'test'"), ["feature_3"], "card_id")


_GROUP_MEAN = """
WITH m AS (SELECT feature_3, avg(target) AS pred FROM cards WHERE split = 'train' GROUP BY 1)
SELECT card_id, round(pred, 6) AS pred FROM cards JOIN m ON m.feature_3 = cards.feature_3 WHERE split = 'test'"""


@query("m03_forest_of_group_means", _GROUP_MEAN)
def _(t):
    train, test = _flag_matrices(t, F.col("target"))
    trees = mo.forest(numTrees=3, bootstrap=False, featureSubsetStrategy="all", minInstancesPerNode=1)
    return trees.setLabelCol("y").fit(train).transform(test).select("card_id", F.round("prediction", 6).alias("pred"))


@query("m04_one_boosting_round", _GROUP_MEAN)
def _(t):
    train, test = _flag_matrices(t, F.col("target"))
    model = mo.boosted_regressor("third", 1, early_stop=False).setLabelCol("y").fit(train)
    return model.transform(test).select("card_id", F.round("prediction", 6).alias("pred"))


@query("m05_one_round_probability", """
WITH m AS (SELECT feature_3, avg(CASE WHEN target < 0 THEN 1.0::DOUBLE ELSE -1 END) AS f FROM cards WHERE split = 'train' GROUP BY 1)
SELECT card_id, round(1 / (1 + exp(-2 * f)), 6) AS pred FROM cards JOIN m ON m.feature_3 = cards.feature_3 WHERE split = 'test'""")
def _(t):
    train, test = _flag_matrices(t, (F.col("target") < 0).cast("double"))
    model = mo.boosted_classifier("third", 1, early_stop=False).setLabelCol("y").fit(train)
    return model.transform(test).select("card_id", F.round(vector_to_array("probability")[1], 6).alias("pred"))
