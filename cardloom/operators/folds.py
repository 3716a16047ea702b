"""Deterministic folds and samples."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from .windows import distributed_rank


def fold_of(key: Column, k: int, seed: int = 0) -> Column:
    """Fold by arithmetic on a whole-number key: the same on every engine."""
    return F.pmod(key * F.lit(7919) + F.lit(seed), F.lit(k)).cast("int")


def assign_folds(df: DataFrame, key: str, k: int = 5, seed: int = 0, repeats: int = 1) -> DataFrame:
    """Balanced shuffled folds: sizes differ by at most one per repeat.

    Rows carry ``repeat`` and ``fold``. The order is a seeded hash of the key,
    so the same key always lands in the same fold. Keys are numbered per hash
    slot plus slot offsets; no task sees all keys.
    """
    out = None
    for rep in range(repeats):
        h = F.xxhash64(F.col(key), F.lit(seed + rep))
        ranked = distributed_rank(df.withColumn("_h", h), ["_h", key], F.col("_h"), "_rank").drop("_h")
        one = ranked.withColumn("repeat", F.lit(rep)).withColumn("fold", (F.col("_rank") % k).cast("int")).drop("_rank")
        out = one if out is None else out.unionByName(one)
    return out


def sample(df: DataFrame, key: str, fraction: float, seed: int = 0) -> DataFrame:
    """Rows whose key, of any type, is hashed below a share of the range: stable across runs and engines."""
    digest = F.md5(F.concat(F.col(key).cast("string"), F.lit(f":{seed}")))
    slot = F.conv(F.substring(digest, 1, 13), 16, 10).cast("long")
    return df.filter(slot < int(fraction * (1 << 52)))
