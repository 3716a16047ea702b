"""Row-level value expressions used by the cleaning and feature operators."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, functions as F

from .semantics import col, dbl, round_even

# Amounts are published as a linear transform of the real
# amount; these two constants invert it.
AMOUNT_SCALE = 0.00150265118
AMOUNT_SHIFT = 497.06

# Decay rate per elapsed day, week and month, by column suffix.
DECAYS = {
    "ddgd_98": ("day", 0.98),
    "ddgd_99": ("day", 0.99),
    "wdgd_96": ("week", 0.96),
    "wdgd_97": ("week", 0.97),
    "mdgd_90": ("month", 0.90),
    "mdgd_80": ("month", 0.80),
}
UNIT_DAYS = {"day": 1, "week": 7, "month": 30}


def clamp(v: Column, low: float | None = None, high: float | None = None) -> Column:
    """``v`` kept within the given ends; NULL stays NULL."""
    out = v.cast("double")
    if low is not None:
        out = F.when(out < low, F.lit(float(low))).otherwise(out)
    if high is not None:
        out = F.when(out > high, F.lit(float(high))).otherwise(out)
    return out


def whole_number(v: Column) -> Column:
    """The nearest whole number, half away from zero."""
    return F.round(v).cast("int")


def map_values(c: Column | str, mapping: Mapping) -> Column:
    """Literal lookup; a value outside the mapping becomes NULL."""
    c = col(c)
    out = None
    for key, value in mapping.items():
        out = F.when(c == F.lit(key), F.lit(value)) if out is None else out.when(c == F.lit(key), F.lit(value))
    return out


def rewrite_installments(c: Column | str) -> Column:
    """-1 and 999 mean missing; a plan of 0 instalments is one payment."""
    c = col(c)
    return F.when(c.isin(-1, 999), F.lit(None)).when(c == 0, F.lit(1)).otherwise(c)


def restore_amount(c: Column | str) -> Column:
    shifted = round_even(dbl(c) / F.lit(AMOUNT_SCALE) + F.lit(AMOUNT_SHIFT), 8)
    return round_even(shifted, 0)


def decayed(amount: Column | str, days: Column | str, suffix: str) -> Column:
    """amount * rate ^ (whole units since the last purchase)."""
    unit, rate = DECAYS[suffix]
    units = F.floor(col(days) / F.lit(UNIT_DAYS[unit]))
    return dbl(amount) * F.pow(F.lit(rate), units.cast("double"))


def row_stats(cols: Sequence[str]) -> dict[str, Column]:
    """Statistics across columns of one row.

    sum and mean are NULL when any input is NULL; max, min and the sample
    deviation skip NULLs.
    """
    vals = [dbl(c) for c in cols]
    total = vals[0]
    for v in vals[1:]:
        total = total + v
    present = sum((v.isNotNull().cast("int") for v in vals[1:]), vals[0].isNotNull().cast("int"))
    zeroed = [F.coalesce(v, F.lit(0.0)) for v in vals]
    mean = F.try_divide(sum(zeroed[1:], zeroed[0]), present.cast("double"))
    squares = [F.coalesce((v - mean) * (v - mean), F.lit(0.0)) for v in vals]
    spread = sum(squares[1:], squares[0])
    return {
        "sum": total,
        "mean": total / F.lit(float(len(vals))),
        "max": F.greatest(*vals),
        "min": F.least(*vals),
        "std": F.when(present > 1, F.sqrt(spread / (present - 1))),
    }


def join_name(*parts: Column | str, sep: str = "&") -> Column:
    return F.concat_ws(sep, *[p if isinstance(p, Column) else F.lit(p) for p in parts])


def text_or(c: Column | str, missing: str) -> Column:
    return F.coalesce(col(c).cast("string"), F.lit(missing))
