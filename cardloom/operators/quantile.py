"""Exact order statistics per key without collecting any group.

Values are counted by (key, value), then by (key, bucket) where the bucket is a
closed-form, order-preserving code of the value. The cumulative bucket counts
tell which bucket holds each wanted rank, and only those buckets are sorted. A
hot key is therefore spread over its distinct values and buckets. Rows that lie in
buckets by key have no hot key: there the counted values of a key are one window,
and nothing is moved.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping

from pyspark.sql import Column, DataFrame, Window, functions as F

from ..functions.semantics import INF, dbl
from .skew import lies_by_key

# 1024 buckets per doubling of the magnitude.
_STEPS = 1024 / 0.6931471805599453
_SHIFT = 1 << 22


def value_bucket(v: Column) -> Column:
    """A whole number that never decreases as ``v`` grows."""
    size = F.abs(v)
    code = F.when(size == INF, F.lit(2 * _SHIFT).cast("bigint")).otherwise(
        F.floor(F.ln(F.when((size > 0) & (size < INF), size)) * _STEPS).cast("bigint") + _SHIFT)
    zero = F.lit(0).cast("bigint")
    # never NULL, so a join on it adds no filter that would keep the two readers of the counts apart
    return F.coalesce(F.when(v > 0, code).when(v < 0, -code), zero)


def rank_values(df: DataFrame, key: str | list[str], value: str,
                ranks: Mapping[str, Callable[[Column], Column]]) -> DataFrame:
    """The value at a 0-based rank of each key's sorted values; NULL and NaN are missing.

    ``ranks`` maps an output column to a function of the group size.
    """
    keys = [key] if isinstance(key, str) else list(key)
    counted = (df.select(*keys, dbl(value).alias("_v")).filter(F.col("_v").isNotNull() & ~F.isnan("_v"))
               .groupBy(*keys, "_v").agg(F.count(F.lit(1)).alias("_c")))
    if lies_by_key(df, keys[0]):
        return _ranked_in_place(counted, keys, ranks)
    counted = counted.withColumn("_b", value_bucket(F.col("_v")))
    buckets = counted.groupBy(*keys, "_b").agg(F.sum("_c").alias("_bc"))
    ordered = Window.partitionBy(*keys).orderBy("_b")
    placed = (buckets
              .withColumn("_upto", F.sum("_bc").over(ordered.rowsBetween(Window.unboundedPreceding, 0)))
              .withColumn("_n", F.sum("_bc").over(Window.partitionBy(*keys)))
              .withColumn("_from", F.col("_upto") - F.col("_bc")))
    wanted = F.array(*[F.struct(F.lit(out).alias("_out"), fn(F.col("_n")).cast("bigint").alias("_rank"))
                       for out, fn in ranks.items()])
    targets = (placed.select(*keys, "_b", "_from", "_upto", F.explode(wanted).alias("_w"))
               .select(*keys, "_b", "_from", "_upto", "_w.*")
               .filter((F.col("_rank") >= F.col("_from")) & (F.col("_rank") < F.col("_upto")))
               .groupBy(*keys, "_b", "_from").agg(F.collect_list(F.struct("_out", "_rank")).alias("_wants")))
    inside = Window.partitionBy(*keys, "_b").orderBy("_v").rowsBetween(Window.unboundedPreceding, 0)
    hits = (counted.join(targets, [*keys, "_b"])
            .withColumn("_end", F.col("_from") + F.sum("_c").over(inside))
            .select(*keys, "_v", "_c", "_end", F.explode("_wants").alias("_w"))
            .filter((F.col("_w._rank") < F.col("_end")) & (F.col("_w._rank") >= F.col("_end") - F.col("_c"))))
    return hits.groupBy(*keys).agg(*[
        F.max(F.when(F.col("_w._out") == out, F.col("_v"))).alias(out) for out in ranks])


def _ranked_in_place(counted: DataFrame, keys: list[str], ranks: Mapping[str, Callable[[Column], Column]]) -> DataFrame:
    # as where buckets are joined, rows without a key have no answer
    counted = counted.na.drop(subset=list(keys))
    whole = Window.partitionBy(*keys).orderBy("_v")
    placed = (counted.withColumn("_end", F.sum("_c").over(whole.rowsBetween(Window.unboundedPreceding, 0)))
              .withColumn("_n", F.sum("_c").over(whole.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing))))
    here = {out: fn(F.col("_n")).cast("bigint") for out, fn in ranks.items()}
    return placed.groupBy(*keys).agg(*[
        F.max(F.when((rank < F.col("_end")) & (rank >= F.col("_end") - F.col("_c")), F.col("_v"))).alias(out) for out, rank in here.items()])


def element_rank(p: float) -> Callable[[Column], Column]:
    """Rank of the p-quantile taken as an element: floor(n * p), the last one for p = 1."""
    if p == 1:
        return lambda n: n - 1
    return lambda n: F.floor(n * F.lit(float(p)))


def element_quantile(df: DataFrame, key: str | list[str], value: str, points: Mapping[str, float]) -> DataFrame:
    return rank_values(df, key, value, {out: element_rank(p) for out, p in points.items()})


def median(df: DataFrame, key: str | list[str], value: str, out: str) -> DataFrame:
    """Exact median: the middle value, or the mean of the two middle values."""
    keys = [key] if isinstance(key, str) else list(key)
    mids = rank_values(df, keys, value, {
        "_low": lambda n: F.floor((n - 1) / 2), "_high": lambda n: F.floor(n / 2)})
    return mids.select(*keys, ((F.col("_low") + F.col("_high")) / 2).alias(out))
