"""Row-order operators that never hold a whole key in one task.

A key with at most 1/SHARES of all rows is one window. The rows of any other key
are cut into chunks along the order (a calendar day by default). Windows run
inside (key, chunk); what must cross a chunk border is carried by one row per
(key, chunk), whose number per key is bounded by the calendar, not by the number
of rows. A chunk that alone holds more than 1/SHARES of all rows is cut further,
at places of the order that a sample of its rows tells, so that no window holds
much more than that share.

The rows are staged once: counts, samples, carries and windows read them there.
Carries are put in front of their chunk's rows, so that only the windows move rows.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from ..functions.semantics import floor_div
from ..session import staged
from .skew import SHARES, hot_keys, keyed_join, lies_by_key

#: Sampled rows per piece of a hot chunk, and bounds that are compared side by side.
SAMPLES, STEP = 64, 16


def _chunk(order: Sequence[str], chunk: Column | None) -> Column:
    return F.to_date(order[0]) if chunk is None else chunk


def _matching(left: Sequence[str], prefix: str) -> Column:
    """Equality that also finds rows without a key or a time: they have a chunk of their own."""
    out = F.lit(True)
    for c in left:
        out = out & F.col(c).eqNullSafe(F.col(f"{prefix}{c}"))
    return out


def split_hot_chunks(rows: DataFrame, keys: Sequence[str], order: Sequence[str], shares: int = SHARES) -> DataFrame:
    """``rows``, which have ``_chunk``, with ``_piece``: the number of the piece of their chunk, in the order; 0 in most chunks.

    Fewer than ``shares`` chunks can be hot, and they have fewer than twice as many pieces, which bounds the sample and the
    broadcast table of bounds. Rows that tie on the whole order stay together.
    """
    keys = [*keys, "_chunk"]
    counts = rows.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n"))
    hot = staged(hot_keys(counts, keys, "_n", shares).join(counts.withColumnsRenamed({k: f"_hot_{k}" for k in keys}), _matching(keys, "_hot_"))
                 .select(*[F.col(f"_hot_{k}") for k in keys], F.col("_salts").alias("_pieces"), "_n"))
    if not hot.limit(1).count():
        return rows.withColumn("_piece", F.lit(0))
    place = F.pmod(F.xxhash64(*order), F.lit(1 << 30))
    sample = rows.join(F.broadcast(hot), _matching(keys, "_hot_")).filter(place * F.col("_n") < F.col("_pieces") * F.lit(SAMPLES << 30))
    at = F.col("_found")
    bounds = (sample.groupBy(*[f"_hot_{k}" for k in keys]).agg(F.array_sort(F.collect_list(F.struct(*order))).alias("_found"), F.first("_pieces").alias("_pieces"))
              .withColumn("_bounds", F.when(F.col("_pieces") > 1, F.transform(F.sequence(F.lit(1), F.col("_pieces") - 1), lambda i: F.get(
                  at, F.floor(i * F.size(at) / F.col("_pieces")).cast("int")))))
              .withColumn("_coarse", F.filter("_bounds", lambda b, i: i % STEP == 0)).drop("_found", "_pieces"))
    own = F.struct(*order)
    joined = rows.join(F.broadcast(bounds), _matching(keys, "_hot_"), "left")
    # of the bounds that are not above the row, first every STEP-th, then those that follow the last of them
    coarse = F.size(F.filter("_coarse", lambda b: b <= own))
    fine = F.size(F.filter(F.slice("_bounds", F.greatest(coarse - 1, F.lit(0)) * STEP + 1, STEP), lambda b: b <= own))
    return joined.select(*[F.col(f"`{c}`") for c in rows.columns], F.when(F.col("_bounds").isNull() | (coarse == 0), F.lit(0)).otherwise(
        (coarse - 1) * STEP + fine).alias("_piece"))


def _in_parts(df: DataFrame, keys: Sequence[str], order: Sequence[str], chunk: Column | None, shares: int,
              is_staged: bool) -> tuple[DataFrame, bool]:
    """The staged rows, and whether a key holds more than 1/shares of them.

    Only then are there ``_hot``, ``_chunk`` and ``_piece``; a key that is not hot is one part, whatever its days.
    """
    rows = df if is_staged or lies_by_key(df, keys[0]) else staged(df)
    counts = rows.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n"))
    found = counts.agg(F.sum("_n").alias("total"), F.max("_n").alias("most")).first()
    if not found["total"] or found["most"] * shares <= found["total"]:
        return rows, False
    hot = hot_keys(counts, keys, "_n", shares).select(*[F.col(k).alias(f"_hot_{k}") for k in keys], F.lit(True).alias("_hot"))
    marked = (rows.join(F.broadcast(hot), _matching(keys, "_hot_"), "left")
              .select(*[F.col(f"`{c}`") for c in rows.columns], F.coalesce("_hot", F.lit(False)).alias("_hot"))
              .withColumn("_chunk", F.when(F.col("_hot"), _chunk(order, chunk))))
    return split_hot_chunks(marked, keys, order, shares), True


def with_previous(df: DataFrame, key: str | Sequence[str], order: Sequence[str], cols: Sequence[str],
                  chunk: Column | None = None, name=lambda c: f"prev_{c}", shares: int = SHARES, is_staged: bool = False) -> DataFrame:
    """Each row's predecessor values within its key; NULL on the first row.

    ``chunk`` must be a non-decreasing function of the order. Rows that tie on
    ``order`` have no defined predecessor, so give a total order. ``is_staged``: the rows come from a staged table.
    """
    keys = [key] if isinstance(key, str) else list(key)
    rows, split = _in_parts(df, keys, order, chunk, shares, is_staged)
    if not split:
        inside = Window.partitionBy(*keys).orderBy(*order)
        return rows.select(*[F.col(f"`{c}`") for c in df.columns], *[F.lag(c).over(inside).alias(name(c)) for c in cols])
    part = [*keys, "_chunk", "_piece"]
    last = (rows.filter("_hot").groupBy(*part)
            .agg(F.max(F.struct(*order, *[F.col(c).alias(f"_v{i}") for i, c in enumerate(cols)])).alias("_last")))
    across = Window.partitionBy(*keys).orderBy("_chunk", "_piece")
    # what a part takes over is a row before its first one, so that no join moves the rows again
    carry = last.select(*part, F.lit(0).alias("_row"), *[
        F.lag(F.col("_last")[f"_v{i}"]).over(across).alias(f"_carry{i}") for i in range(len(cols))])
    both = rows.withColumn("_row", F.lit(1)).unionByName(carry, allowMissingColumns=True)
    inside = Window.partitionBy(*part).orderBy("_row", *order)
    marked = both.select("*", *[
        F.lag(F.when(F.col("_row") == 0, F.col(f"_carry{i}")).otherwise(F.col(f"`{c}`"))).over(inside).alias(f"_lag{i}") for i, c in enumerate(cols)])
    return marked.filter("_row = 1").select(*[F.col(f"`{c}`") for c in df.columns], *[
        F.col(f"_lag{i}").alias(name(c)) for i, c in enumerate(cols)])


def with_position(df: DataFrame, keys: Sequence[str], order: Sequence[str], out: str = "position",
                  chunk: Column | None = None, shares: int = SHARES, within: Mapping[str, Column] | None = None) -> DataFrame:
    """0-based position of each row in its key's order; rows without a time come first, those without a key are one group.

    ``within`` maps output columns to conditions: the position among the key's rows that fulfil it, NULL for the others.
    """
    keys, within = list(keys), {out: F.lit(True)} if within is None else dict(within)
    rows, split = _in_parts(df, keys, order, chunk, shares, False)
    part = [*keys, "_chunk", "_piece"] if split else keys
    ones = {n: F.when(p, F.lit(1)) for n, p in within.items()}
    if split:
        sizes = rows.filter("_hot").groupBy(*part).agg(*[F.count(one).alias(f"_n{i}") for i, one in enumerate(ones.values())])
        before = Window.partitionBy(*keys).orderBy("_chunk", "_piece").rowsBetween(Window.unboundedPreceding, -1)
        offsets = sizes.select(*part, F.lit(0).alias("_row"), *[
            F.coalesce(F.sum(f"_n{i}").over(before), F.lit(0)).alias(f"_off{i}") for i in range(len(ones))])
        rows = rows.withColumn("_row", F.lit(1)).unionByName(offsets, allowMissingColumns=True)
        order, ones = ["_row", *order], {n: F.when(F.col("_row") == 1, one) for n, one in ones.items()}
    inside = Window.partitionBy(*part).orderBy(*order).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    placed = rows.select("*", *[(F.count(one).over(inside) - 1 + (F.coalesce(F.first(f"_off{i}").over(inside), F.lit(0)) if split else F.lit(0)))
                                .alias(f"_at{i}") for i, one in enumerate(ones.values())])
    placed = placed.filter("_row = 1") if split else placed
    return placed.select(*[F.col(f"`{c}`") for c in df.columns], *[F.when(p, F.col(f"_at{i}")).alias(n) for i, (n, p) in enumerate(within.items())])


def group_diff(df: DataFrame, key: str, order: Sequence[str], cols: Sequence[str],
               chunk: Column | None = None, shares: int = SHARES) -> DataFrame:
    """``{col}_diff``: value minus the previous row's value within the key."""
    prev = with_previous(df, key, order, cols, chunk, lambda c: f"_prev_{c}", shares)
    return prev.select(*df.columns, *[(F.col(c) - F.col(f"_prev_{c}")).alias(f"{c}_diff") for c in cols])


def gap_days(df: DataFrame, key: str, order: Sequence[str], chunk: Column | None = None,
             prefix: str = "purchase") -> DataFrame:
    """Days, weeks and 30-day months since the key's previous row.

    Inside a day chunk the gap is 0, so only each day's first row looks back.
    """
    ts = order[0]
    prev = with_previous(df, key, order, [ts], chunk, name=lambda c: "_prev_ts")
    gap = F.datediff(F.to_date(ts), F.to_date("_prev_ts"))
    return prev.select(*df.columns, gap.alias(f"{prefix}_day_diff"),
                       floor_div(gap, 7).alias(f"{prefix}_week_diff"), floor_div(gap, 30).alias(f"{prefix}_month_diff"))


def days_to_last(df: DataFrame, keys: str | Sequence[str], ts: str,
                 out: str = "purchase_day_since_reference_day") -> DataFrame:
    """Days from each row to its key's last day.

    The maximum is a partial aggregate joined back by key with hot keys split.
    """
    keys = [keys] if isinstance(keys, str) else list(keys)
    last = df.groupBy(*keys).agg(F.to_date(F.max(ts)).alias("_last_day"), F.count(F.lit(1)).alias("_rows"))
    return (keyed_join(df, last, keys, size="_rows")
            .withColumn(out, F.datediff(F.col("_last_day"), F.to_date(ts))).drop("_last_day"))


def first_per_key(df: DataFrame, key: str, order: Sequence[str]) -> DataFrame:
    """The first row of each key in the given order, as a partial aggregate."""
    rest = [c for c in df.columns if c != key]
    first = F.min_by(F.struct(*rest), F.struct(*order))
    return df.groupBy(key).agg(first.alias("_first")).select(key, *[F.col("_first")[c].alias(c) for c in rest])


def distributed_rank(df: DataFrame, order: Sequence[str], spread: Column, out: str, slots: int = 4096) -> DataFrame:
    """A dense 0..n-1 numbering by (spread slot, order) without a single-task window.

    ``spread`` is an evenly distributed whole number of the row, such as a hash.
    """
    rows = df.withColumn("_slot", F.pmod(spread, F.lit(slots)).cast("int"))
    sizes = rows.groupBy("_slot").agg(F.count(F.lit(1)).alias("_n"))
    # at most ``slots`` rows, so one task and a broadcast are bounded
    before = Window.orderBy("_slot").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sizes.select("_slot", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_off"))
    inside = Window.partitionBy("_slot").orderBy(*order)
    return (rows.withColumn("_rn", F.row_number().over(inside))
            .join(F.broadcast(offsets), "_slot")
            .select(*df.columns, (F.col("_off") + F.col("_rn") - 1).alias(out)))
