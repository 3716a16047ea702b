"""Quantiles from mergeable KLL sketches, beside the exact form of ``quantile``.

A sketch per group of keys is folded once and merged over days, segments and later rows. With ``k`` the rank of an answer is off
by about 1.7 / k^0.9 of the values at most (two times the usual error), 1.3 % at 200; the size of a sketch hardly grows with its rows.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, functions as F

from ..functions.semantics import dbl
from .aggregate import Segments, predicate

K = 200


def rank_error(k: int = K) -> float:
    """Bound of the share of values by which a rank may be off, at about 99 %."""
    return 2.296 / k ** 0.9021


def fold_sketches(rows: DataFrame, keys: Sequence[str], columns: Sequence[str], k: int = K) -> DataFrame:
    """(keys, a sketch per column): NULL and NaN are missing; a group without a value has none."""
    values = {c: F.when(~F.isnan(dbl(c)), dbl(c)) for c in columns}
    return rows.groupBy(*keys).agg(*[F.when(F.count(v) > 0, F.kll_sketch_agg_double(v, F.lit(k))).alias(c) for c, v in values.items()])


def merge_sketches(sketches: DataFrame, keys: Sequence[str], columns: Sequence[str], condition: Column | None = None, k: int = K) -> DataFrame:
    """The sketches of coarser groups, of several tables put together, or of the groups that a condition takes."""
    def of(c: str) -> Column:
        own = F.col(c) if condition is None else F.when(condition, F.col(c))
        return F.when(F.count(own) > 0, F.kll_merge_agg_double(own, F.lit(k))).alias(c)

    return sketches.groupBy(*keys).agg(*[of(c) for c in columns])


def quantiles(sketches: DataFrame, key: str, column: str, points: Mapping[str, float], segments: Segments, k: int = K,
              name=lambda seg, out: f"{out}{seg}") -> DataFrame:
    """The quantiles of a column per key for every segment, which is a condition on the keys of the sketches."""
    out = []
    for seg, p in segments.items():
        own = F.col(column) if p is None else F.when(predicate(p), F.col(column))
        merged = F.when(F.count(own) > 0, F.kll_merge_agg_double(own, F.lit(k)))
        out += [F.kll_sketch_get_quantile_double(merged, F.lit(float(q))).alias(name(seg, n)) for n, q in points.items()]
    return sketches.groupBy(key).agg(*out)
