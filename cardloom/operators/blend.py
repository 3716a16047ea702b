"""Metrics, voting, stacking and the two-stage blend."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

import numpy as np
from pyspark.sql import Column, DataFrame, functions as F

from ..functions.semantics import dbl

# Fixed value: the label of the rare outlier cards.
OUTLIER_VALUE = -33.219281


def rmse(pred: Column | str, y: Column | str) -> Column:
    return F.sqrt(F.avg(F.pow(dbl(pred) - dbl(y), F.lit(2.0))))


def log_loss(pred: Column | str, y: Column | str, eps: float = 1e-15) -> Column:
    p = F.greatest(F.least(dbl(pred), F.lit(1 - eps)), F.lit(eps))
    y = dbl(y)
    return -F.avg(y * F.ln(p) + (1 - y) * F.ln(1 - p))


METRICS = {"regression": rmse, "binary": log_loss}


def fold_scores(df: DataFrame, kind: str, pred: str = "pred", y: str = "target") -> DataFrame:
    return df.groupBy("fold").agg(METRICS[kind](pred, y).alias("score"))


def score_summary(scores: DataFrame) -> DataFrame:
    """Mean and population deviation of the fold scores."""
    return scores.agg(F.avg("score").alias("mean_score"), F.stddev_pop("score").alias("std_score"))


def blend(wide: DataFrame, weights: Mapping[str, float] | Sequence[str], key: str = "card_id", out: str = "target") -> DataFrame:
    """Weighted sum of prediction columns; a list of columns is averaged."""
    if isinstance(weights, Mapping):
        terms = [F.col(c) * F.lit(float(w)) for c, w in weights.items()]
        value = sum(terms[1:], terms[0])
    else:
        cols = [F.col(c) for c in weights]
        value = sum(cols[1:], cols[0]) / F.lit(float(len(cols)))
    return wide.select(key, value.alias(out))


def two_stage(p: Column | str, normal: Column | str, value: float = OUTLIER_VALUE) -> Column:
    """Expected label from the outlier probability and the outlier-free model."""
    return dbl(p) * F.lit(value) + (F.lit(1.0) - dbl(p)) * dbl(normal)


def mixed(two: Column, stack: Column | str, w: float = 0.5) -> Column:
    return two * F.lit(w) + dbl(stack) * F.lit(1 - w)


def gram(df: DataFrame, xs: Sequence[str], y: str, by: Sequence[str] = ("repeat", "fold")) -> DataFrame:
    """n, sums and cross products of the columns and the label per fold: a fixed number of values."""
    z = [F.lit(1.0), *[dbl(c) for c in xs], dbl(y)]
    names = ["1", *xs, "y"]
    return df.groupBy(*by).agg(*[
        F.sum(z[i] * z[j]).alias(f"{names[i]}*{names[j]}") for i in range(len(z)) for j in range(i, len(z))])


def _moments(row, xs: Sequence[str]) -> np.ndarray:
    names = ["1", *xs, "y"]
    m = np.zeros((len(names), len(names)))
    for i in range(len(names)):
        for j in range(i, len(names)):
            m[i, j] = m[j, i] = row[f"{names[i]}*{names[j]}"]
    return m


def bayesian_ridge(m: np.ndarray, iterations: int = 300, tol: float = 1e-3) -> tuple[np.ndarray, float]:
    """Weights and intercept by evidence maximisation from the moment matrix of (1, x, y).

    Gamma(1e-6, 1e-6) priors on both precisions; the design is centred.
    """
    n = m[0, 0]
    mean = m[0, 1:] / n
    centred = m[1:, 1:] - n * np.outer(mean, mean)
    xx, xy, yy = centred[:-1, :-1], centred[:-1, -1], centred[-1, -1]
    prior = 1e-6
    values, vectors = np.linalg.eigh(xx)
    values = np.clip(values, 0, None)
    rotated = vectors.T @ xy
    noise, ridge = 1.0 / (yy / n + np.finfo(float).eps), 1.0
    coef = None
    for _ in range(iterations):
        new = vectors @ (rotated / (values + ridge / noise))
        rss = yy - 2 * new @ xy + new @ xx @ new
        gamma = float(np.sum(noise * values / (ridge + noise * values)))
        ridge = (gamma + 2 * prior) / (float(new @ new) + 2 * prior)
        noise = (n - gamma + 2 * prior) / (max(float(rss), 0.0) + 2 * prior)
        if coef is not None and np.sum(np.abs(coef - new)) < tol:
            coef = new
            break
        coef = new
    coef = vectors @ (rotated / (values + ridge / noise))
    return coef, float(mean[-1] - mean[:-1] @ coef)


def stack(oof: DataFrame, test: DataFrame, xs: Sequence[str], y: str, key: str = "card_id"):
    """Stack prediction columns on repeated folds.

    ``oof`` has ``repeat`` and ``fold``. One aggregate gives each fold's moment
    matrix; a fold's training moments are its repeat's total minus its own, so
    no fit reads the rows again. Returns (out-of-fold predictions averaged over
    repeats, test predictions averaged over all fits, fitted weights).
    """
    rows = gram(oof, xs, y).collect()  # repeats * folds rows of fixed width
    moments = {(r["repeat"], r["fold"]): _moments(r, xs) for r in rows}
    fits = {}
    for (rep, fold), own in moments.items():
        total = sum(m for (r, _), m in moments.items() if r == rep)
        fits[rep, fold] = bayesian_ridge(total - own)

    def linear(fit):
        coef, intercept = fit
        value = F.lit(intercept)
        for c, w in zip(xs, coef):
            value = value + dbl(c) * F.lit(float(w))
        return value

    held_out = None
    for (rep, fold), fit in fits.items():
        hit = (F.col("repeat") == rep) & (F.col("fold") == fold)
        held_out = F.when(hit, linear(fit)) if held_out is None else held_out.when(hit, linear(fit))
    oof_pred = oof.withColumn("_p", held_out).groupBy(key).agg(F.avg("_p").alias("pred"), F.max(y).alias(y))
    # the mean of linear fits is one linear function
    coef = np.mean([c for c, _ in fits.values()], axis=0)
    test_pred = test.select(key, linear((coef, float(np.mean([b for _, b in fits.values()])))).alias("pred"))
    return oof_pred, test_pred, fits
