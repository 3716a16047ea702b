"""Codes and encodings fitted on one table and applied to another."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window, functions as F

from ..functions.scalars import map_values
from ..session import ensure_checkpoint_dir
from .skew import keyed_join

# A dictionary up to this many rows may be ranked in one task and broadcast.
SMALL_ROWS = 100_000
# A table whose columns all have a fixed width may be broadcast up to about this size.
SMALL_BYTES = 32 << 20
_WIDTHS = {"boolean": 1, "tinyint": 1, "smallint": 2, "int": 4, "bigint": 8, "float": 4, "double": 8, "date": 4, "timestamp": 8, "timestamp_ntz": 8}


def is_small(df: DataFrame, rows: int = SMALL_ROWS) -> bool:
    """Whether the table has at most ``rows`` rows; reads no more than it must."""
    return df.limit(rows + 1).count() <= rows


def broadcast_rows(table: DataFrame, rows: int = SMALL_ROWS, most_bytes: int = SMALL_BYTES) -> int:
    """How many rows a table may have to be broadcast: ``rows``, or more of narrow ones. Each row has about 16 bytes besides its columns."""
    widths = [_WIDTHS.get(kind) for _, kind in table.dtypes]
    return rows if None in widths else max(rows, most_bytes // (16 + sum(widths)))


def lookup(facts: DataFrame, table: DataFrame, key: str, how: str = "left", rows: int | None = None) -> DataFrame:
    """Join a keyed table to facts: broadcast when its size is checked, otherwise a shuffled join with hot keys split."""
    if is_small(table, broadcast_rows(table) if rows is None else rows):
        return facts.join(F.broadcast(table), key, how)
    return keyed_join(facts, table, key, how)


def fit_codes(df: DataFrame, c: str, out: str = "code", rows: int = SMALL_ROWS) -> DataFrame:
    """Distinct values sorted ascending -> 0..n-1.

    A dictionary larger than ``rows`` is range-sorted over all tasks; each
    sorted partition numbers its own rows and adds the size of the partitions
    before it.
    """
    values = df.select(c).filter(F.col(c).isNotNull()).distinct()
    if is_small(values, rows):
        return values.select(c, (F.row_number().over(Window.orderBy(c)) - 1).cast("int").alias(out))
    ensure_checkpoint_dir(df.sparkSession)
    ids = values.orderBy(c).withColumn("_id", F.monotonically_increasing_id()).checkpoint()
    parts = ids.withColumn("_part", F.shiftright("_id", 33))
    sizes = parts.groupBy("_part").agg(F.count(F.lit(1)).alias("_n"))
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sizes.select("_part", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_off"))
    within = F.col("_id").bitwiseAND(F.lit((1 << 33) - 1))
    # one offset row per partition of the sort
    return parts.join(F.broadcast(offsets), "_part").select(c, (F.col("_off") + within).cast("int").alias(out))


def apply_codes(df: DataFrame, codes: DataFrame, c: str, out: str | None = None, code: str = "code") -> DataFrame:
    """Replace (or add) the code of ``c``; a value outside the dictionary is NULL."""
    out = out or c
    keyed = codes.select(F.col(c).alias("_value"), F.col(code).alias("_code"))
    joined = lookup(df.withColumn("_value", F.col(c)), keyed, "_value")
    if out in df.columns:
        return joined.select(*[F.col("_code").alias(out) if x == out else F.col(x) for x in df.columns])
    return joined.select(*df.columns, F.col("_code").alias(out))


# Up to this many values a dictionary is inlined as an expression instead of joined.
INLINE_VALUES = 128


def small_dictionaries(df: DataFrame, cols: Sequence[str], limit: int = INLINE_VALUES) -> dict[str, list]:
    """Sorted distinct values of each text column with at most ``limit`` of them, from one job.

    Columns with more values are absent from the result.
    """
    pairs = F.array(*[F.struct(F.lit(c).alias("column"), F.col(c).alias("value")) for c in cols])
    seen = df.select(F.inline(pairs)).filter(F.col("value").isNotNull()).distinct()
    sizes = seen.groupBy("column").agg(F.count(F.lit(1)).alias("n"))
    kept = seen.join(sizes.filter(F.col("n") <= limit), "column").collect()  # at most limit * columns rows
    out = {c: [] for c in cols}
    for r in kept:
        out[r["column"]].append(r["value"])
    return {c: sorted(v) for c, v in out.items() if v}


def ordinal_encode(df: DataFrame, *cols: str, missing: str | None = None) -> DataFrame:
    """Replace each column by its dictionary code, optionally giving NULL its own text first.

    Short dictionaries become an expression, so the facts are neither shuffled
    nor joined; longer ones are joined.
    """
    text = {c: F.col(c).cast("string") if missing is None else F.coalesce(F.col(c).cast("string"), F.lit(missing))
            for c in cols}
    src = df.select(*[text[c].alias(c) if c in text else F.col(c) for c in df.columns])
    small = small_dictionaries(src, cols)
    codes = {c: map_values(c, {v: i for i, v in enumerate(values)}) for c, values in small.items()}
    out = src.select(*[codes[c].alias(c) if c in codes else F.col(c) for c in src.columns])
    for c in cols:
        if c not in codes:
            out = apply_codes(out, fit_codes(src, c), c)
    return out


def encode_together(tables: dict[str, DataFrame], c: str, missing: str | None = None) -> dict[str, DataFrame]:
    """One dictionary over the union of several tables, applied to each."""
    filled = {k: d if missing is None else d.withColumn(c, F.coalesce(F.col(c).cast("string"), F.lit(missing)))
              for k, d in tables.items()}
    union = None
    for d in filled.values():
        union = d.select(c) if union is None else union.unionByName(d.select(c))
    codes = fit_codes(union, c)
    return {k: apply_codes(d, codes, c) for k, d in filled.items()}


def target_encode(fit: DataFrame, apply_to: DataFrame, c: str, y: str, out: str) -> DataFrame:
    """Mean of ``y`` per value of ``c`` on ``fit``; an unseen value is NULL."""
    means = fit.groupBy(c).agg(F.avg(y).alias(out))
    return lookup(apply_to, means, c)


def mean_encode(df: DataFrame, c: str, y: str, out: str) -> DataFrame:
    """Group mean of ``y`` on every row, as an aggregate and a join; a NULL group is NULL."""
    means = df.filter(F.col(c).isNotNull()).groupBy(c).agg(F.avg(y).alias(out))
    return lookup(df, means, c)
