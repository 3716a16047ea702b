"""Fitting and scoring with MLlib tree ensembles on deterministic folds.

Training reads one staged table of (key, label, fold, vector). Every fit is
a distributed MLlib job; the driver holds models and a few scores only.
"""

from __future__ import annotations

import random
from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass

from pyspark.ml import Estimator
from pyspark.ml.evaluation import RegressionEvaluator
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.ml.classification import GBTClassifier
from pyspark.ml.regression import GBTRegressor, RandomForestRegressor
from pyspark.ml.tuning import CrossValidator, ParamGridBuilder
from pyspark.sql import DataFrame, functions as F

from ..functions.semantics import INF, dbl
from ..session import shared_folder, staged
from .blend import METRICS, score_summary
from .clean import flag_outliers, without_outliers
from .folds import assign_folds, sample
from .select import importance_scores, top_names

# Settings of the random forest and its grid.
FOREST = {"numTrees": 80, "maxDepth": 10, "minInstancesPerNode": 30, "seed": 22}
FOREST_GRID = {"featureSubsetStrategy": ["all", "80"]}
# Three boosting settings (step, depth, row and column shares, leaf size, seed).
# A leaf limit becomes the depth that allows as many leaves.
BOOSTERS = {
    "first": {"stepSize": 0.01, "maxDepth": 6, "subsamplingRate": 0.9, "featureSubsetStrategy": "0.9",
              "minInstancesPerNode": 32, "seed": 11},
    "second": {"stepSize": 0.05, "maxDepth": 10, "subsamplingRate": 0.8, "featureSubsetStrategy": "0.8",
               "minInstancesPerNode": 40, "seed": 2018},
    "third": {"stepSize": 0.05, "maxDepth": 9, "subsamplingRate": 1.0, "featureSubsetStrategy": "all",
              "minInstancesPerNode": 1, "seed": 11},
    "selector": {"stepSize": 0.1, "maxDepth": 5, "subsamplingRate": 0.7, "featureSubsetStrategy": "0.7",
                 "minInstancesPerNode": 20, "seed": 2020},
}
FOLD_SEEDS = {"first": 4096, "second": 2018, "third": 18, "selector": 2020}
# Search boxes (low, high) of the two tuning runs.
SEARCH_SPACES = {
    "first": {"stepSize": (0.01, 0.5), "subsamplingRate": (0.5, 1.0), "featureSubsetStrategy": (0.5, 1.0),
              "minInstancesPerNode": (1, 30)},
    "second": {"stepSize": (0.02, 0.2), "subsamplingRate": (0.5, 1.0), "featureSubsetStrategy": (0.5, 1.0),
               "minInstancesPerNode": (1, 30), "maxDepth": (5, 12)},
}
MISSING = -999.0
VALIDATION = "is_validation"


def assemble_matrix(df: DataFrame, feats: Sequence[str], *keep: str, missing: float = MISSING, out: str = "features") -> DataFrame:
    """``keep`` columns and one vector of ``feats``; NULL, NaN and infinities become ``missing``."""
    def clean(c):
        v = dbl(F.col(f"`{c}`"))
        return F.when(v.isNull() | F.isnan(v) | (F.abs(v) == INF), F.lit(missing)).otherwise(v)

    # plain names keep dots and & out of the assembler
    names = [f"_x{i}" for i in range(len(feats))]
    flat = df.select(*[F.col(c) for c in keep], *[clean(c).alias(n) for c, n in zip(feats, names)])
    return VectorAssembler(inputCols=names, outputCol=out).transform(flat).select(*keep, out)


def forest(**params) -> RandomForestRegressor:
    return RandomForestRegressor(**{**FOREST, **params})


def boosted_regressor(preset: str, rounds: int = 100, early_stop: bool = True, **params) -> GBTRegressor:
    """Boosted trees; with ``early_stop`` rounds end once the held-out fold stops improving."""
    est = GBTRegressor(maxIter=rounds, **{**BOOSTERS[preset], **params})
    return est.setValidationIndicatorCol(VALIDATION) if early_stop else est


def boosted_classifier(preset: str, rounds: int = 100, early_stop: bool = True, **params) -> GBTClassifier:
    est = GBTClassifier(maxIter=rounds, **{**BOOSTERS[preset], **params})
    return est.setValidationIndicatorCol(VALIDATION) if early_stop else est


@dataclass
class OutOfFold:
    oof: DataFrame      # key, fold, pred, label
    test: DataFrame     # key, pred
    scores: DataFrame   # fold, score
    models: list

    def summary(self) -> DataFrame:
        return score_summary(self.scores)


def _scored(model, df: DataFrame, kind: str, out: str) -> DataFrame:
    """The prediction column; the positive-class probability for a classifier."""
    made = model.transform(df)
    value = vector_to_array("probability")[1] if kind == "binary" else F.col("prediction")
    return made.select(*df.columns, value.alias(out))


def _with_folds(rows: DataFrame, key: str, k: int, seed: int, fold: Column | None) -> DataFrame:
    return assign_folds(rows, key, k, seed).drop("repeat") if fold is None else rows.withColumn("fold", fold)


def oof_fit_predict(train: DataFrame, test: DataFrame | None, estimator: Estimator, key: str = "card_id", y: str = "target",
                    kind: str = "regression", k: int = 5, seed: int = 0, features: str = "features", fold: Column | None = None) -> OutOfFold:
    """Fit on k-1 folds, predict the held-out one, and average the k models on the test rows.

    ``train`` has (key, y, vector). ``fold`` gives the folds, otherwise they are balanced and shuffled. An estimator with a validation column sees
    the held-out fold for early stopping. The test rows pass all models in one
    scan, without a shuffle.
    """
    est = estimator.copy()
    est.setLabelCol("_label").setFeaturesCol(features)
    early = est.hasParam("validationIndicatorCol") and est.isSet("validationIndicatorCol")
    rows = _with_folds(train.select(key, y, features), key, k, seed, fold)
    staged = shared_folder(train.sparkSession)
    rows.withColumn("_label", dbl(y)).write.parquet(staged)
    rows = train.sparkSession.read.parquet(staged)
    models, parts = [], []
    for fold in range(k):
        held = F.col("fold") == fold
        fit_rows = rows.withColumn(VALIDATION, held) if early else rows.filter(~held)
        model = est.fit(fit_rows)
        models.append(model)
        parts.append(_scored(model, rows.filter(held), kind, "pred").select(key, "fold", "pred", y))
    oof = parts[0]
    for p in parts[1:]:
        oof = oof.unionByName(p)
    scores = oof.groupBy("fold").agg(METRICS[kind]("pred", y).alias("score"))
    scored = None
    if test is not None:
        scored = test.select(key, features)
        for i, model in enumerate(models):
            scored = _scored(model, scored, kind, f"_p{i}")
        total = sum((F.col(f"_p{i}") for i in range(1, k)), F.col("_p0"))
        scored = scored.select(key, (total / F.lit(float(k))).alias("pred"))
    return OutOfFold(oof, scored, scores, models)


def target_variants(train: DataFrame, y: str = "target", below: float = -30.0) -> dict[str, tuple[DataFrame, str, str]]:
    """Name -> (rows, label column, kind): all rows, rows without outliers, and the outlier flag."""
    flagged = flag_outliers(train, y, below)
    return {"all": (flagged, y, "regression"), "normal": (without_outliers(flagged), y, "regression"),
            "binary": (flagged, "outliers", "binary")}


def fit_all(train: DataFrame, test: DataFrame, feats: Sequence[str], presets: Sequence[str] = ("first", "second", "third"),
            rounds: int = 100, k: int = 5, below: float = -30.0, key: str = "card_id") -> dict[tuple[str, str], OutOfFold]:
    """Every preset on every target variant."""
    test_rows = assemble_matrix(test, feats, key)
    out = {}
    for name, (rows, label, kind) in target_variants(train, below=below).items():
        matrix = assemble_matrix(rows, feats, key, label)
        for preset in presets:
            make = boosted_classifier if kind == "binary" else boosted_regressor
            out[preset, name] = oof_fit_predict(matrix, test_rows, make(preset, rounds), key, label, kind, k, FOLD_SEEDS[preset])
    return out


def _param_maps(est: Estimator, settings: Sequence[Mapping]) -> list[dict]:
    return [{est.getParam(name): value for name, value in s.items()} for s in settings]


def _search(est: Estimator, settings: Sequence[Mapping], rows: DataFrame, key: str, y: str, folds: int, seed: int,
            parallelism: int, features: str, fold: Column | None = None):
    # every fit and every score reads the rows again
    labelled = staged(_with_folds(rows.select(key, y, features), key, folds, seed, fold).withColumn("_label", dbl(y)))
    est = est.copy()
    est.setLabelCol("_label").setFeaturesCol(features)
    cv = CrossValidator(estimator=est, estimatorParamMaps=_param_maps(est, settings), numFolds=folds, foldCol="fold",
                        evaluator=RegressionEvaluator(labelCol="_label", metricName="mse"), parallelism=parallelism)
    fitted = cv.fit(labelled)
    names = sorted({n for s in settings for n in s})
    table = rows.sparkSession.createDataFrame(
        [(i, ", ".join(f"{n}={s[n]}" for n in names if n in s), float(m), float(2 * d), float(m) ** 0.5)
         for i, (s, m, d) in enumerate(zip(settings, fitted.avgMetrics, fitted.stdMetrics))],
        "setting int, params string, mean_mse double, two_std double, rmse double")
    best = min(range(len(settings)), key=lambda i: fitted.avgMetrics[i])
    return fitted.bestModel, dict(settings[best]), table


def grid_search(est: Estimator, grid: Mapping[str, Sequence], rows: DataFrame, key: str = "card_id", y: str = "target",
                folds: int = 2, seed: int = 22, parallelism: int = 4, features: str = "features", fold: Column | None = None):
    """Exhaustive search by mean squared error: (best model, best setting, table of mean and 2 * std per setting)."""
    builder = ParamGridBuilder()
    for name, values in grid.items():
        builder = builder.addGrid(est.getParam(name), list(values))
    settings = [{p.name: v for p, v in m.items()} for m in builder.build()]
    return _search(est, settings, rows, key, y, folds, seed, parallelism, features, fold)


@dataclass
class Rung:
    """What one rung of a halving search costs: its settings, the rounds of each fit and the share of the rows."""

    settings: int
    rounds: int
    share: float


def rungs(settings: int, rounds: int, keep: int = 2, smallest: float = 0.25) -> list[Rung]:
    """From all settings to the last one, each rung with 1/``keep`` of the settings, ``keep`` times the rounds and a growing share.

    Rounds start so that the last rung has them all; a rung costs about as much as any other, and all of them together
    ``rounds`` times the number of rungs, in place of ``rounds`` times the number of settings.
    """
    counts = [settings]
    while counts[-1] > 1:
        counts.append(-(-counts[-1] // keep))
    last = len(counts) - 1
    return [Rung(n, max(1, rounds // keep ** (last - i)), max(smallest, 1.0 / keep ** (last - i)) if i < last else 1.0) for i, n in enumerate(counts)]


def halving_search(est: Estimator, settings: Sequence[Mapping], budget: str, rounds: int, rows: DataFrame, key: str = "card_id", y: str = "target",
                   keep: int = 2, folds: int = 2, seed: int = 22, parallelism: int = 4, features: str = "features", fold: Column | None = None):
    """Successive halving: (best model, best setting, table of every rung).

    ``budget`` names the parameter that counts rounds or trees. The settings of a rung are fitted side by side on a sample of the
    keys; samples of later rungs hold those of earlier ones. The better half by held-out mean squared error goes on; errors
    that agree to nine digits are ordered as the settings are. The last setting is fitted on all rows with all rounds.
    """
    alive, table, model = list(range(len(settings))), [], None
    for at, rung in enumerate(rungs(len(settings), rounds, keep)):
        part = rows if rung.share == 1.0 else sample(rows, key, rung.share, seed)
        model, _, scores = _search(est, [{**settings[i], budget: rung.rounds} for i in alive], part, key, y, folds, seed, parallelism, features, fold)
        errors = {alive[r["setting"]]: float(r["mean_mse"]) for r in scores.collect()}
        order = sorted(alive, key=lambda i: (float(f"{errors[i]:.9g}"), i))
        stay = -(-len(alive) // keep) if len(alive) > 1 else 1
        table += [(at, i, rung.rounds, rung.share, errors[i], i in order[:stay]) for i in alive]
        alive = sorted(order[:stay])
    return model, dict(settings[alive[0]]), rows.sparkSession.createDataFrame(
        table, "rung int, setting int, rounds int, share double, mean_mse double, kept boolean")


def draw_settings(space: Mapping[str, tuple], n: int, seed: int) -> list[dict]:
    """Seeded uniform draws from a box; whole-number bounds draw whole numbers, shares are written as text."""
    rng = random.Random(seed)
    draws = []
    for _ in range(n):
        one = {}
        for name, (low, high) in sorted(space.items()):
            if isinstance(low, int) and isinstance(high, int):
                one[name] = rng.randint(low, high)
            else:
                value = min(max(rng.uniform(low, high), low), high)
                one[name] = f"{value:.3f}" if name == "featureSubsetStrategy" else value
        draws.append(one)
    return draws


def random_search(est: Estimator, space: Mapping[str, tuple], n: int, rows: DataFrame, key: str = "card_id", y: str = "target",
                  folds: int = 2, seed: int = 2020, parallelism: int = 4, features: str = "features"):
    """The best of ``n`` draws; the draws are independent, so they are fitted side by side."""
    return _search(est, draw_settings(space, n, seed), rows, key, y, folds, seed, parallelism, features)


def importance_select(train: DataFrame, feats: Sequence[str], k: int = 300, key: str = "card_id", y: str = "target",
                      rounds: int = 100, folds: int = 5, make: Callable[..., Estimator] = boosted_regressor):
    """(names, scores): the k features with the largest importance summed over the fold models."""
    matrix = assemble_matrix(train, feats, key, y)
    fitted = oof_fit_predict(matrix, None, make("selector", rounds), key, y, k=folds, seed=FOLD_SEEDS["selector"])
    scores = importance_scores(fitted.models, feats, train.sparkSession)
    return top_names(scores, k, "importance"), scores
