"""Category values turned into features: kept long, widened only on demand.

Long tables are (key, column, value, ...). Every step is a partial aggregate on
a key that includes the category value, so a hot card is spread over its values
(and days); only the last step has one row per card.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from ..functions.semantics import dbl, div_inf
from .aggregate import Segments, _texts, predicate
from .skew import lies_by_key, staged_by_key

# A data-dependent column list longer than this is refused; the long form has no limit.
MAX_COLUMNS = 20_000


def _named_values(df: DataFrame, cols: Sequence[str], total: bool = False) -> Column:
    text = _texts(df)
    parts = [F.struct(F.lit(c).alias("column"), text(c).alias("value")) for c in cols]
    if total:
        parts.append(F.struct(F.lit("").alias("column"), F.lit("").alias("value")))
    return F.array(*parts)


def cross_sums(df: DataFrame, key: str, cats: Sequence[str], nums: Sequence[str]) -> DataFrame:
    """Sum of each numeric column per (key, category column, category value): long form.

    The rows are put into buckets by the key before they are unpivoted, unless they lie there.
    """
    wanted = df.select(*dict.fromkeys([key, *cats, *nums]))
    df = wanted if lies_by_key(wanted, key) else staged_by_key(wanted, key)
    rows = df.select(key, *nums, F.explode(_named_values(df, cats)).alias("_s")).select(key, *nums, "_s.*")
    return (rows.filter(F.col("value").isNotNull()).groupBy(key, "column", "value")
            .agg(*[F.coalesce(F.sum(dbl(n)), F.lit(0.0)).alias(n) for n in nums]))


def cross_features(sums: DataFrame, key: str, nums: Sequence[str]) -> DataFrame:
    """(key, feature, v) rows named ``column&value&number``."""
    return sums.select(key, F.inline(F.array(*[
        F.struct(F.concat_ws("&", "column", "value", F.lit(n)).alias("feature"), F.col(n).alias("v")) for n in nums])))


def value_rollup(df: DataFrame, key: str, cols: Sequence[str], counted: str, day: str,
                 segments: Segments | None = None) -> DataFrame:
    """Per (key, column, value): for each segment ``n_i`` non-NULL ``counted`` rows and ``days_i`` distinct days.

    The row with column '' covers all rows of the key. A segment the group has
    no rows in is NULL.
    """
    segs = list((segments or {"": None}).values())
    flags = [F.lit(True) if p is None else F.coalesce(predicate(p), F.lit(False)) for p in segs]
    rows = df.select(key, F.to_date(day).alias("_day"), F.col(counted).isNotNull().alias("_has"),
                     *[f.alias(f"_in{i}") for i, f in enumerate(flags)],
                     F.explode(_named_values(df, cols, total=True)).alias("_s"))
    rows = rows.select(key, "_day", "_has", *[f"_in{i}" for i in range(len(segs))], "_s.*")
    daily = rows.filter(F.col("value").isNotNull()).groupBy(key, "column", "value", "_day").agg(
        *[F.count(F.when(F.col(f"_in{i}") & F.col("_has"), F.lit(1))).alias(f"_n{i}") for i in range(len(segs))],
        *[F.bool_or(f"_in{i}").alias(f"_in{i}") for i in range(len(segs))])
    out = []
    for i in range(len(segs)):
        here = F.max(f"_in{i}")
        out.append(F.when(here, F.sum(f"_n{i}")).alias(f"n_{i}"))
        out.append(F.when(here, F.count(F.when(F.col(f"_in{i}"), F.col("_day")))).alias(f"days_{i}"))
    return daily.groupBy(key, "column", "value").agg(*out)


def pivot_name(column: Column, kind: str, value: Column) -> Column:
    return F.concat(column, F.lit(f"_{kind}_"), F.regexp_replace(value, r"\.", "_"))


def _with_shares(rollup: DataFrame, key: str, segments: int, shares_of: Sequence[str]) -> DataFrame:
    """(key, column, value, n_i, share_i) without the rows that cover all values."""
    # a key has one row per category value here, so the dictionaries bound the window group
    whole = Window.partitionBy(key)
    rows = rollup.select("*", *[
        F.max(F.when(F.col("column") == "", F.col(f"days_{i}"))).over(whole).alias(f"_all{i}") for i in range(segments)])
    shared = F.col("column").isin(*shares_of) if shares_of else F.lit(False)
    return rows.filter(F.col("column") != "").select(key, "column", "value", *[dbl(f"n_{i}").alias(f"n_{i}") for i in range(segments)], *[
        F.when(shared, div_inf(f"days_{i}", f"_all{i}")).alias(f"share_{i}") for i in range(segments)])


#: Kinds of features of a value and the column that has them.
KINDS = {"cnt_pivot": "n", "day_nunique_pct": "share"}


def pivot_features(rollup: DataFrame, key: str, segments: Sequence[str], shares_of: Sequence[str]) -> DataFrame:
    """(key, feature, v): counts per value, and distinct-day shares for the columns in ``shares_of``."""
    rows = _with_shares(rollup, key, len(segments), shares_of)
    entries = [F.struct(F.concat(F.lit(seg), pivot_name(F.col("column"), kind, F.col("value"))).alias("feature"), F.col(f"{c}_{i}").alias("v"))
               for i, seg in enumerate(segments) for kind, c in KINDS.items()]
    return rows.select(key, F.inline(F.array(*entries))).filter(F.col("v").isNotNull())


def feature_places(rollup: DataFrame, key: str, segments: Sequence[str], shares_of: Sequence[str],
                   limit: int = MAX_COLUMNS) -> dict[str, list[tuple[str, str, str]]]:
    """Each name that ``pivot_features`` gives, and where it is found: (column, value, n_i or share_i), from the totals per value.

    The names become column names, so their number must be bounded.
    """
    rows, n = _with_shares(rollup, key, len(segments), shares_of), range(len(segments))
    seen = rows.groupBy("column", "value").agg(*[F.bool_or(F.col(f"{c}_{i}").isNotNull()).alias(f"{c}_{i}") for c in KINDS.values() for i in n])
    places = {}
    for r in seen.filter(" OR ".join(f"{c}_{i}" for c in KINDS.values() for i in n)).limit(limit + 1).collect():
        for i, seg in enumerate(segments):
            for kind, c in KINDS.items():
                if r[f"{c}_{i}"]:
                    places.setdefault(f"{seg}{r['column']}_{kind}_{r['value'].replace('.', '_')}", []).append((r["column"], r["value"], f"{c}_{i}"))
    if len(places) > limit:
        raise ValueError(f"more than {limit} features: keep the long form or select first")
    return places


def rollup_to_wide(rollup: DataFrame, key: str, places: Mapping[str, Sequence[tuple[str, str, str]]], names: Sequence[str], segments: int,
                   shares_of: Sequence[str]) -> DataFrame:
    """One row per key with the named columns, as ``to_wide`` makes them of ``pivot_features``; a value is one row and not one per feature."""
    wanted = [p for n in names for p in places.get(n, ())]
    pairs = {p: i for i, p in enumerate(dict.fromkeys((c, v) for c, v, _ in wanted))}
    kinds = list(dict.fromkeys(k for _, _, k in wanted))
    rows = _with_shares(rollup, key, segments, shares_of)
    if not pairs:
        return rows.select(key).distinct().select(key, *[F.lit(None).cast("double").alias(n) for n in names])
    slots = rollup.sparkSession.createDataFrame([(c, v, i) for (c, v), i in pairs.items()], "column string, value string, _slot int")
    wide = rows.join(F.broadcast(slots), ["column", "value"]).groupBy(key).pivot("_slot", list(pairs.values())).agg(*[F.first(k).alias(k) for k in kinds])
    # what is two kinds has the kind in its name
    at = {p: F.col(f"`{pairs[p[:2]]}_{p[2]}`" if len(kinds) > 1 else f"`{pairs[p[:2]]}`") for p in wanted}
    return wide.select(key, *[(F.coalesce(*[at[tuple(p)] for p in places[n]]) if places.get(n) else F.lit(None).cast("double")).alias(n) for n in names])


def feature_list(features: DataFrame, limit: int = MAX_COLUMNS) -> list[str]:
    """The distinct feature names, sorted; they become column names, so their number must be bounded."""
    names = [r.feature for r in features.select("feature").distinct().limit(limit + 1).collect()]
    if len(names) > limit:
        raise ValueError(f"more than {limit} features: keep the long form or select first")
    return sorted(names)


def to_wide(features: DataFrame, key: str, names: Sequence[str] | None = None, fill: float | None = 0.0) -> DataFrame:
    """One row per key, one column per feature. ``names`` may be a selection made on the long form."""
    names = feature_list(features) if names is None else list(names)
    wide = features.groupBy(key).pivot("feature", names).agg(F.first("v"))
    return wide if fill is None else wide.na.fill(fill, names)


def count_pivot(df: DataFrame, key: str, c: str, counted: str, values: Sequence) -> DataFrame:
    """Non-NULL ``counted`` per value of ``c`` as columns, 0 where the key never has the value."""
    rows = df.filter(F.col(c).isNotNull())
    wide = rows.groupBy(key).pivot(c, list(values)).agg(F.count(counted)).na.fill(0)
    return wide.toDF(key, *[f"{c}_cnt_pivot_{str(v).replace('.', '_')}" for v in values])


def day_share_pivot(df: DataFrame, key: str, c: str, day: str, values: Sequence) -> DataFrame:
    """Distinct days with each value of ``c`` over the key's distinct days, as columns."""
    rollup = value_rollup(df, key, [c], day, day)
    feats = pivot_features(rollup, key, [""], [c])
    names = {f"{c}_day_nunique_pct_{str(v).replace('.', '_')}": v for v in values}
    return to_wide(feats.filter(F.col("feature").isin(*names)), key, list(names))
