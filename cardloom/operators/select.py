"""Feature selection."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, functions as F

from .clean import drop_sparse_columns, feature_names
from .profile import corr_with_target

TOP = 300


def top_features(scores: DataFrame, k: int = TOP, score: str = "abs_corr") -> DataFrame:
    """The k best-scored features: NULL scores last, ties by name."""
    return scores.orderBy(F.col(score).desc_nulls_last(), "feature").limit(k)


def top_names(scores: DataFrame, k: int = TOP, score: str = "abs_corr") -> list[str]:
    return [r.feature for r in top_features(scores, k, score).orderBy(F.col(score).desc_nulls_last(), "feature").collect()]


def select_by_correlation(train: DataFrame, key: str = "card_id", y: str = "target", k: int = TOP,
                          sparse_limit: float | None = 0.99) -> list[str]:
    """Drop near-empty columns, then the k features most correlated with the label."""
    if sparse_limit is not None:
        train = drop_sparse_columns(train, sparse_limit, keep=(key, y))
    return top_names(corr_with_target(train, feature_names(train, (key, y)), y), k)


def importance_scores(models: Sequence, names: Sequence[str], spark) -> DataFrame:
    """(feature, importance): summed over fitted tree models that share one vector layout."""
    total = [0.0] * len(names)
    for model in models:
        for i, v in zip(model.featureImportances.indices, model.featureImportances.values):
            total[i] += float(v)
    return spark.createDataFrame(list(zip(names, total)), "feature string, importance double")
