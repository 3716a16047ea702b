"""Distributions, correlations and their comparison between two samples."""

from __future__ import annotations

from collections.abc import Sequence
from itertools import combinations

from pyspark.sql import DataFrame, functions as F

from ..functions.semantics import dbl, safe_corr
from ..functions.scalars import text_or


def distribution(df: DataFrame, c: str) -> DataFrame:
    """(value, n, ratio): non-NULL values over all rows."""
    total = df.agg(F.count(F.lit(1)).alias("_t"))
    return (df.groupBy(F.col(c).alias("value")).agg(F.count(F.lit(1)).alias("n"))
            .filter(F.col("value").isNotNull())
            .select("value", "n", (F.col("n") / total.scalar()).alias("ratio")))


def joint_distribution(df: DataFrame, a: str, b: str) -> DataFrame:
    """Distribution of ``a&b``, a NULL counting as the text 'nan'."""
    return distribution(df.select(F.concat_ws("&", text_or(a, "nan"), text_or(b, "nan")).alias("pair")), "pair")


def compare_distributions(first: DataFrame, second: DataFrame, cols: Sequence[str], pairs: bool = False,
                          names: tuple[str, str] = ("train", "test")) -> DataFrame:
    """(column, value, ratio in each sample) over the union of values, 0 where absent.

    With ``pairs`` the columns are all pairs ``a&b``. One pass over both
    samples, whatever the number of columns.
    """
    def rows(df: DataFrame, which: int) -> DataFrame:
        if pairs:
            made = {f"{a}&{b}": F.concat_ws("&", text_or(a, "nan"), text_or(b, "nan")) for a, b in combinations(cols, 2)}
            df = df.select(*[c.alias(n) for n, c in made.items()])
            use = list(made)
        else:
            use = list(cols)
        quoted = [F.struct(F.lit(c).alias("column"), F.col(f"`{c}`").cast("string").alias("value")) for c in use]
        return df.select(F.inline(F.array(*quoted))).withColumn("_w", F.lit(which))

    totals = [d.agg(F.count(F.lit(1)).alias("_t")).scalar() for d in (first, second)]
    both = rows(first, 0).unionByName(rows(second, 1)).filter(F.col("value").isNotNull())
    counted = both.groupBy("column", "value").agg(*[
        F.count(F.when(F.col("_w") == i, F.lit(1))).alias(f"_n{i}") for i in (0, 1)])
    return counted.select("column", "value", *[
        (F.col(f"_n{i}") / totals[i]).alias(f"{names[i]}_ratio") for i in (0, 1)])


def histogram(df: DataFrame, c: str, bins: int) -> DataFrame:
    """Equal-width bins over [min, max], the last one closed: (bin, low, high, n, density)."""
    v = dbl(c)
    edges = df.agg(F.min(v).alias("lo"), F.max(v).alias("hi"), F.count(v).alias("n"))
    lo, hi, n = (edges.select(x).scalar() for x in ("lo", "hi", "n"))
    width = (hi - lo) / F.lit(float(bins))
    b = F.least(F.floor(F.try_divide(v - lo, width)), F.lit(bins - 1).cast("bigint"))
    counts = df.filter(v.isNotNull()).groupBy(F.coalesce(b, F.lit(0).cast("bigint")).alias("bin")).agg(
        F.count(F.lit(1)).alias("n"))
    return counts.select("bin", (lo + F.col("bin") * width).alias("low"), (lo + (F.col("bin") + 1) * width).alias("high"),
                         "n", F.try_divide(F.col("n").cast("double"), n * width).alias("density"))


def corr_with_target(df: DataFrame, feats: Sequence[str], y: str, chunk: int = 200) -> DataFrame:
    """(feature, abs_corr): |Pearson| with the label, NULLs as 0; NULL for a constant feature.

    One aggregate per ``chunk`` features keeps the generated code bounded.
    """
    label = F.coalesce(dbl(y), F.lit(0.0))
    out = None
    for start in range(0, len(feats), chunk):
        part = feats[start:start + chunk]
        wide = df.agg(*[F.abs(safe_corr(F.coalesce(dbl(F.col(f"`{c}`")), F.lit(0.0)), label)).alias(f"_{i}")
                        for i, c in enumerate(part)])
        rows = wide.select(F.inline(F.array(*[
            F.struct(F.lit(c).alias("feature"), F.col(f"_{i}").alias("abs_corr")) for i, c in enumerate(part)])))
        out = rows if out is None else out.unionByName(rows)
    return out


def corr_long(features: DataFrame, labels: DataFrame, key: str, y: str) -> DataFrame:
    """|Pearson| of long (key, feature, v) rows with the label, a missing (key, feature) counting as 0.

    Only present entries are read: the label is centred, and the zero entries
    enter through the number of keys.
    """
    stats = labels.agg(F.count(F.lit(1)).alias("n"), F.avg(dbl(y)).alias("m"), F.stddev_pop(dbl(y)).alias("s"))
    n, m, s = (stats.select(c).scalar() for c in ("n", "m", "s"))
    rows = features.join(labels.select(key, (dbl(y) - m).alias("_y")), key)
    # moments about the means of the present rows; the absent ones, all 0 in the feature, are merged pairwise
    present = rows.groupBy("feature").agg(
        F.count(F.lit(1)).alias("_k"), F.avg("v").alias("_x"), F.avg("_y").alias("_y"), F.var_pop("v").alias("_vx"),
        F.covar_pop("v", "_y").alias("_c"))
    share = F.col("_k") / n
    variance = share * (F.col("_vx") + (1 - share) * F.col("_x") * F.col("_x"))
    covariance = share * (F.col("_c") + F.col("_x") * F.col("_y"))
    # the label is centred over all keys, so the absent rows' mean label is -_k _y / (n - _k)
    return present.select("feature", F.abs(F.try_divide(covariance, F.sqrt(variance) * s)).alias("abs_corr"))


def corr_matrix(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """(a, b, corr) for all ordered pairs of columns."""
    pairs = [(a, b) for a in cols for b in cols]
    wide = df.agg(*[safe_corr(a, b).alias(f"_{i}") for i, (a, b) in enumerate(pairs)])
    return wide.select(F.inline(F.array(*[
        F.struct(F.lit(a).alias("a"), F.lit(b).alias("b"), F.col(f"_{i}").alias("corr"))
        for i, (a, b) in enumerate(pairs)])))
