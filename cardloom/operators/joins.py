"""Keyed joins of features, dimensions and predictions."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import DataFrame, functions as F

from ..sources.tables import write_bucketed
from .clean import drop_overlap
from .encode import lookup


def join_features(base: DataFrame, tables: Sequence[DataFrame], key: str) -> DataFrame:
    """Left join of tables that each have one row per key; all hash on the same key."""
    return reduce(lambda left, right: left.join(drop_overlap(left, right, key), key, "left"), tables, base)


def join_bucketed(families: Mapping[str, DataFrame], key: str, buckets: int, folder: str | None = None) -> DataFrame:
    """Families of one row per key, each staged in the same buckets under its name, then joined: no join moves a row.

    The first family tells the keys; one that another family lacks has NULL there. A column that an earlier family has is not
    taken again.
    """
    tables = [write_bucketed(df, name, key, buckets, None if folder is None else f"{folder}/{name}") for name, df in families.items()]
    return reduce(lambda left, right: left.join(drop_overlap(left, right, key), key, "left"), tables)


def enrich(fact: DataFrame, dim: DataFrame, key: str, cols: Sequence[str]) -> DataFrame:
    """Dimension columns on every fact row."""
    return lookup(fact, dim.select(key, *cols), key)


def union_all(*tables: DataFrame) -> DataFrame:
    """Rows of all tables by column name; a column missing from one is NULL there."""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), tables)


def tagged_union(tables: Mapping[str, DataFrame], tag: str = "split") -> DataFrame:
    return union_all(*[d.withColumn(tag, F.lit(name)) for name, d in tables.items()])


def in_order_of(cards: DataFrame, preds: DataFrame, key: str) -> DataFrame:
    """Predictions of any row order for the rows of ``cards``: matched by key, so that no order has to be kept or restored."""
    return cards.select(key).join(preds, key, "left")


def align(preds: Mapping[str, DataFrame], key: str = "card_id", pred: str = "pred") -> DataFrame:
    """One column per model, matched by key and never by row position.

    A key that one of the models has no prediction for stops the job: no card may fall out of a blend unseen.
    """
    named = [d.select(key, F.col(pred).alias(name)) for name, d in preds.items()]
    whole = reduce(lambda a, b: a.join(b, key, "full"), named)
    return whole.select(key, *[
        F.coalesce(name, F.raise_error(F.concat(F.lit(f"no prediction of {name} for "), F.col(key).cast("string"))).cast("double"))
        .alias(name) for name in preds])
