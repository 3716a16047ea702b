"""Mergeable moment states: statistics of any coarser group, and of rows that come later, without the old rows.

The state of a column in a group is its number of values, their sum, least and largest, and the sums of squared and cubed
deviations from their mean. States of parts merge: with d the distance of a part's mean from the common one, M2 is the
sum of m2 + n d^2, and M3 that of m3 + 3 d m2 + n d^3. Deviations stay deviations, so a large common offset does not
cancel. Integer columns of a small range carry a bit mask of their values, for distinct counts.

A state table has one row per group of its keys (a card's month, say). Months are folded once and appended; the rows of a card
are as many as its groups, whatever its number of transactions, so that merging them needs no splitting of hot cards.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from ..functions.semantics import dbl
from .aggregate import Segments, Spec, predicate

#: Highest power of deviations that a statistic needs.
_POWER = {"var": 2, "std": 2, "skew": 3}
ROWS = "rows"


def powers(spec: Spec) -> dict[str, int]:
    """The highest power that each column of a ``{column: [statistics]}`` table needs."""
    return {c: max([1, *(_POWER.get(s, 1) for s in stats)]) for c, stats in spec.items()}


def _mask_name(c: str) -> str:
    return f"{c}_mask"


def mask(c: Column | str, low: int, high: int, name: str = "column") -> Column:
    """The bit of a whole number within (low, high), at most 63 values wide. A value outside raises an error."""
    if high - low > 62:
        raise ValueError(f"domain of {name} is wider than 63 values")
    v = F.col(c) if isinstance(c, str) else c
    slot = F.when(v.between(low, high), v - low).otherwise(
        F.raise_error(F.concat(F.lit(f"{name} outside its stated domain: "), v.cast("string"))).cast("int"))
    return F.when(v.isNotNull(), F.call_function("shiftleft", F.lit(1).cast("bigint"), slot.cast("int")))


def _folded(c: str, power: int) -> Column:
    v = dbl(c)
    n, flat = F.count(v), F.min(v) == F.max(v)
    parts = [n.alias("n"), F.sum(v).alias("total"), F.min(v).alias("low"), F.max(v).alias("high")]
    m2 = F.when(flat, F.lit(0.0)).otherwise(F.var_pop(v) * n)
    if power > 1:
        parts.append(F.coalesce(m2, F.lit(0.0)).alias("m2"))
    if power > 2:
        m3 = F.when(flat, F.lit(0.0)).otherwise(F.skewness(v) * F.sqrt(m2 * m2 * m2 / F.nullif(n, F.lit(0))))
        parts.append(F.coalesce(m3, F.lit(0.0)).alias("m3"))
    return F.struct(*parts).alias(c)


def fold(rows: DataFrame, keys: Sequence[str], columns: Mapping[str, int], masks: Mapping[str, tuple[int, int]] | None = None,
         also: Sequence[Column] = ()) -> DataFrame:
    """The states of ``columns`` (name -> power) per group: one partial/final aggregate, one row per group.

    ``also`` are further aggregates that their user merges.
    """
    return rows.groupBy(*keys).agg(
        F.count(F.lit(1)).alias(ROWS), *[_folded(c, p) for c, p in columns.items()],
        *[F.coalesce(F.bit_or(mask(c, *d, c)), F.lit(0).cast("bigint")).alias(_mask_name(c)) for c, d in (masks or {}).items()], *also)


def constant(value: Column, rows: Column | str = ROWS, power: int = 3) -> Column:
    """The state of a column that has one value in the whole group, such as a function of its keys."""
    v, n = dbl(value), F.when(value.isNotNull(), F.col(rows) if isinstance(rows, str) else rows).otherwise(F.lit(0).cast("bigint"))
    parts = [n.alias("n"), (v * n).alias("total"), v.alias("low"), v.alias("high")]
    return F.struct(*parts, *[F.lit(0.0).alias(f"m{p}") for p in range(2, power + 1)])


def _deviations(c: str, power: int, n: Column, m2: Column | None, m3: Column | None, mean: Column) -> list[Column]:
    """What a part adds to M2 and M3 of the whole, whose mean is given."""
    d = F.try_divide(F.col(f"{c}.total"), n) - mean
    out = []
    if power > 1:
        out.append(m2 + n * d * d)
    if power > 2:
        out.append(m3 + 3 * d * m2 + n * d * d * d)
    return out


def _fields(c: str, power: int) -> tuple[Column, Column | None, Column | None]:
    return F.col(f"{c}.n"), F.col(f"{c}.m2") if power > 1 else None, F.col(f"{c}.m3") if power > 2 else None


def merge(states: DataFrame, keys: Sequence[str], columns: Mapping[str, int], masks: Sequence[str] = ()) -> DataFrame:
    """The states of the coarser groups that ``keys`` make."""
    whole, deep = Window.partitionBy(*keys), {c: p for c, p in columns.items() if p > 1}
    parts = states.select("*", *[F.try_divide(F.sum(f"{c}.total").over(whole), F.sum(f"{c}.n").over(whole)).alias(f"_mean_{c}") for c in deep])
    out = [F.sum(ROWS).alias(ROWS)]
    for c, p in columns.items():
        fields = [F.sum(f"{c}.n").alias("n"), F.sum(f"{c}.total").alias("total"), F.min(f"{c}.low").alias("low"), F.max(f"{c}.high").alias("high")]
        added = _deviations(c, p, *_fields(c, p), F.col(f"_mean_{c}")) if p > 1 else []
        fields += [F.coalesce(F.sum(a), F.lit(0.0)).alias(f"m{k}") for k, a in enumerate(added, 2)]
        out.append(F.struct(*fields).alias(c))
    out += [F.bit_or(_mask_name(c)).alias(_mask_name(c)) for c in masks]
    return parts.groupBy(*keys).agg(*out)


def append(states: DataFrame, later: DataFrame, keys: Sequence[str], columns: Mapping[str, int], masks: Sequence[str] = ()) -> DataFrame:
    """Old and new states together; groups that both have are merged, so late rows of an old month count as well."""
    return merge(states.unionByName(later), keys, columns, masks)


def _finished(stat: str, n: Column, total: Column, low: Column, high: Column, m2: Column | None, m3: Column | None) -> Column:
    size = n.cast("double")
    if stat == "count":
        return n
    if stat == "sum":
        return F.coalesce(total, F.lit(0.0))
    if stat == "mean":
        return F.try_divide(total, size)
    if stat == "min":
        return low
    if stat == "max":
        return high
    if stat in ("var", "std"):
        var = F.when(n > 1, m2 / F.greatest(size - 1, F.lit(1.0)))
        return var if stat == "var" else F.sqrt(var)
    if stat == "skew":
        factor = F.try_divide(F.sqrt(size * (size - 1)), size - 2)
        value = F.try_divide(F.sqrt(size) * m3, F.pow(m2, F.lit(1.5)))
        return F.when((n > 2) & (low < high), factor * value)
    raise ValueError(f"unknown statistic {stat}")


def statistics(states: DataFrame, key: str, spec: Spec, segments: Segments, name: Callable[[str, str, str], str] = lambda seg, c, s: f"{c}_{s}{seg}",
               masks: Mapping[str, Column] | None = None, by_key: Sequence[str] = (),
               also: Mapping[str, Column] | None = None) -> DataFrame:
    """``{column: [statistics]}`` per key for every segment, as ``segmented_agg`` gives them, from states alone.

    Segments are conditions on the keys of the state table. ``size`` counts rows. ``nunique`` counts the bits of a column's
    mask, which ``masks`` may give as an expression of the keys, or the different values of a column named in ``by_key``, which
    is a key of the state table or a function of them. ``also`` are further aggregates, whose names follow the segment's.
    """
    masks = dict(masks or {})
    need = powers({c: [s for s in stats if s != "nunique"] for c, stats in spec.items()})
    inside = [F.when(F.lit(True) if p is None else F.coalesce(predicate(p), F.lit(False)), F.lit(i)) for i, p in enumerate(segments.values())]
    # a state enters once per segment that has it, and not every segment's aggregates for each state; a key without a segment keeps a row
    parts = states.withColumn("_seg", F.explode_outer(F.array_compact(F.array(*inside))))
    whole = Window.partitionBy(key, "_seg")
    for c in by_key:  # one row of each value that the segment has stands for it; the last order serves the means as well
        first = F.col(c).isNotNull() & ~F.lag(c).over(whole.orderBy(c)).eqNullSafe(F.col(c))
        parts = parts.withColumn(f"_first_{c}", first)
    means = {c: f"_mean_{c}" for c, p in need.items() if p > 1}
    parts = parts.select("*", *[F.try_divide(F.sum(f"{c}.total").over(whole), F.sum(f"{c}.n").over(whole)).alias(out) for c, out in means.items()])
    exprs, names = [], {}
    for c, stats in spec.items():
        p, sums = need[c], {}
        if set(stats) - {"nunique", "size"}:
            n, m2, m3 = _fields(c, p)
            added = _deviations(c, p, n, m2, m3, F.col(means[c])) if p > 1 else []
            sums = dict(n=F.coalesce(F.sum(n), F.lit(0).cast("bigint")), total=F.sum(f"{c}.total"), low=F.min(f"{c}.low"), high=F.max(f"{c}.high"),
                        m2=F.coalesce(F.sum(added[0]), F.lit(0.0)) if p > 1 else None, m3=F.coalesce(F.sum(added[1]), F.lit(0.0)) if p > 2 else None)
        for s in stats:
            names[c, s] = out = f"_s{len(names)}"
            if s == "size":
                exprs.append(F.sum(ROWS).alias(out))
            elif s == "nunique" and c in by_key:
                exprs.append(F.count(F.when(F.col(f"_first_{c}"), F.lit(1))).alias(out))
            elif s == "nunique":
                bits = masks[c] if c in masks else F.col(_mask_name(c))
                exprs.append(F.coalesce(F.bit_count(F.bit_or(bits)).cast("bigint"), F.lit(0).cast("bigint")).alias(out))
            else:
                exprs.append(_finished(s, **sums).alias(out))
    every = parts.groupBy(key, "_seg").agg(*exprs, *[x.alias(f"_also_{n}") for n, x in (also or {}).items()])
    out = []
    for i, seg in enumerate(segments):
        own = {name(seg, c, s): x for (c, s), x in names.items()} | {f"{seg}{n}": f"_also_{n}" for n in also or {}}
        out += [F.max(F.when(F.col("_seg") == i, F.col(x))).alias(n) for n, x in own.items()]
    return every.groupBy(key).agg(*out)
