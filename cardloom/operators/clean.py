"""Missing values, infinities, column choice and type choice."""

from __future__ import annotations

from collections.abc import Iterable, Mapping, Sequence

from pyspark.sql import DataFrame, functions as F
from pyspark.sql.types import (ByteType, DoubleType, IntegerType, LongType, NumericType, ShortType, StringType,
                               TimestampNTZType, TimestampType)

from ..functions.semantics import INF, dbl
from .keyfilter import only_known
from .skew import keyed_join


def fill(df: DataFrame, values: Mapping[str, object]) -> DataFrame:
    """Replace NULLs by a constant per column."""
    return df.na.fill(dict(values))


def fit_means(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """One row with the mean of each column."""
    return df.agg(*[F.avg(c).alias(c) for c in cols])


def fill_with_mean(df: DataFrame, cols: Sequence[str], means: DataFrame | None = None) -> DataFrame:
    """NULL -> column mean; the single row of means is read inside the plan."""
    means = fit_means(df, cols) if means is None else means
    return df.select(*[
        F.coalesce(dbl(c), means.select(c).scalar()).alias(c) if c in cols else F.col(c) for c in df.columns])


def finite_max(df: DataFrame, cols: Sequence[str], infinity_as: float = -99.0) -> DataFrame:
    """One row: the largest value over a set of columns, +inf counting as ``infinity_as``."""
    tops = [F.max(F.when(dbl(c) == INF, F.lit(infinity_as)).otherwise(dbl(c))) for c in cols]
    return df.agg((F.greatest(*tops) if len(tops) > 1 else tops[0]).alias("finite_max"))


def replace_infinite(df: DataFrame, cols: Sequence[str], fitted: DataFrame | None = None) -> DataFrame:
    """+inf -> the shared finite maximum of the column set, fitted on ``df`` or given."""
    top = (finite_max(df, cols) if fitted is None else fitted).select("finite_max").scalar()
    return df.select(*[
        F.when(dbl(c) == INF, top).otherwise(dbl(c)).alias(c) if c in cols else F.col(c) for c in df.columns])


def null_ratios(df: DataFrame, cols: Sequence[str] | None = None) -> DataFrame:
    """(feature, null_ratio), from one aggregate over all columns."""
    cols = list(cols or df.columns)
    wide = df.agg(*[F.avg(F.col(f"`{c}`").isNull().cast("int")).alias(f"_{i}") for i, c in enumerate(cols)])
    return wide.select(F.inline(F.array(*[
        F.struct(F.lit(c).alias("feature"), F.col(f"_{i}").alias("null_ratio")) for i, c in enumerate(cols)])))


def drop_sparse_columns(df: DataFrame, limit: float = 0.99, keep: Iterable[str] = ()) -> DataFrame:
    """Drop columns whose NULL ratio reaches ``limit``. Reads one row per column name."""
    kept = set(keep)
    cols = [c for c in df.columns if c not in kept]
    sparse = {r.feature for r in null_ratios(df, cols).filter(F.col("null_ratio") >= limit).collect()}
    return df.drop(*sparse)


def numeric_columns(df: DataFrame) -> list[str]:
    """Columns that are neither text nor timestamps."""
    out = (StringType, TimestampType, TimestampNTZType)
    return [f.name for f in df.schema.fields if not isinstance(f.dataType, out)]


def feature_names(df: DataFrame, exclude: Iterable[str] = ("card_id", "target")) -> list[str]:
    drop = set(exclude)
    return [c for c in df.columns if c not in drop]


def select_features(df: DataFrame, names: Sequence[str], *extra: str) -> DataFrame:
    return df.select(*[F.col(f"`{c}`") for c in (*extra, *names)])


def with_affix(df: DataFrame, key: str, prefix: str = "", suffix: str = "") -> DataFrame:
    return df.toDF(*[c if c == key else f"{prefix}{c}{suffix}" for c in df.columns])


def drop_overlap(left: DataFrame, right: DataFrame, key: str) -> DataFrame:
    """``right`` without the columns that ``left`` has, except the key."""
    have = set(left.columns) - {key}
    return right.drop(*[c for c in right.columns if c in have])


def flag_outliers(df: DataFrame, c: str = "target", below: float = -30.0, out: str = "outliers") -> DataFrame:
    """1 where the target is under the threshold, otherwise 0."""
    return df.withColumn(out, F.when(F.col(c) < below, F.lit(1)).otherwise(F.lit(0)))


def without_outliers(df: DataFrame, flag: str = "outliers") -> DataFrame:
    return df.filter(F.col(flag) == 0)


def restrict_to(facts: DataFrame, entities: DataFrame, key: str, row_id: Sequence[str] | None = None) -> DataFrame:
    """Facts of known entities only; most others are dropped by a filter of the keys before the join moves them."""
    return keyed_join(only_known(facts, entities, key), entities.select(key), key, "left_semi", row_id=row_id)


# The name rules that remove columns from the refined feature table.
PRUNE_CONTAINING = ("subsector_id_cnt_", "month_diff_std", "month_diff_gap", "target")
PRUNE_CONTAINING_ALL = (("month_diff", "hist_last2_"),)
PRUNE_EQUAL = ("min_num", "target1", "card_id_cnt_ht_pivot_supp")


def pruned_by_name(name: str) -> bool:
    return (any(part in name for part in PRUNE_CONTAINING)
            or any(all(p in name for p in parts) for parts in PRUNE_CONTAINING_ALL)
            or name in PRUNE_EQUAL)


def names_containing(df: DataFrame, parts: Iterable[str]) -> list[str]:
    """The column names that contain any of the parts, in the table's order."""
    parts = list(parts)
    return [c for c in df.columns if any(p in c for p in parts)]


def prune_by_name(df: DataFrame, keep: Iterable[str] = ()) -> DataFrame:
    """Drop text and timestamp columns and the columns the name rules reject."""
    kept, numeric = set(keep), set(numeric_columns(df))
    return df.select(*[F.col(f"`{c}`") for c in df.columns
                       if c in kept or (c in numeric and not pruned_by_name(c))])


_INT_TYPES = ((ByteType(), 7), (ShortType(), 15), (IntegerType(), 31), (LongType(), 63))


def column_ranges(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """(feature, low, high) from one aggregate."""
    wide = df.agg(*[F.min(c).cast("double").alias(f"_l{i}") for i, c in enumerate(cols)],
                  *[F.max(c).cast("double").alias(f"_h{i}") for i, c in enumerate(cols)])
    return wide.select(F.inline(F.array(*[
        F.struct(F.lit(c).alias("feature"), F.col(f"_l{i}").alias("low"), F.col(f"_h{i}").alias("high"))
        for i, c in enumerate(cols)])))


def downcast(df: DataFrame, floats: bool = False) -> DataFrame:
    """Cast integer columns to the smallest type strictly holding their range.

    Doubles become floats only when asked, since that loses precision.
    """
    fields = {f.name: f.dataType for f in df.schema.fields}
    ints = [n for n, t in fields.items() if isinstance(t, NumericType) and t.typeName() in (
        "byte", "short", "integer", "long")]
    ranges = {r.feature: (r.low, r.high) for r in column_ranges(df, ints).collect()} if ints else {}
    casts = {}
    for c in ints:
        low, high = ranges[c]
        if low is None:
            continue
        casts[c] = next((t for t, bits in _INT_TYPES if low > -2 ** bits and high < 2 ** bits - 1), fields[c])
    if floats:
        casts.update({n: "float" for n, t in fields.items() if isinstance(t, DoubleType)})
    return df.select(*[F.col(f"`{c}`").cast(casts[c]).alias(c) if c in casts else F.col(f"`{c}`") for c in df.columns])

