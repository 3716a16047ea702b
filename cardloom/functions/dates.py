"""Calendar expressions. Weekdays count from Monday = 0."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from .semantics import col, floor_div

DAY_SECONDS = 86400


def year_month(ts: Column | str) -> Column:
    return F.date_format(ts, "yyyy-MM")


def hour_section(ts: Column | str) -> Column:
    """Quarter of the day: 0 night, 1 morning, 2 afternoon, 3 evening."""
    return floor_div(F.hour(ts), 6)


def weekend_section(ts: Column | str) -> Column:
    """0 on workdays, 1 on Saturday and Sunday."""
    return floor_div(F.weekday(ts), 5)


def is_weekend(ts: Column | str) -> Column:
    return (F.weekday(ts) >= 5).cast("int")


def year_prefix(month_text: Column | str) -> Column:
    """The year of a 'YYYY-MM' text, 0 when it is missing."""
    return F.coalesce(F.split(col(month_text), "-").getItem(0).cast("int"), F.lit(0))


def parse_month(month_text: Column | str) -> Column:
    return F.to_date(col(month_text), "yyyy-MM")


def floor_day(ts: Column | str) -> Column:
    return F.to_date(ts)


def days_between(later: Column | str, earlier: Column | str) -> Column:
    return F.datediff(F.to_date(later), F.to_date(earlier))


def day_parts(ts: Column | str) -> dict[str, Column]:
    return {
        "year": F.year(ts),
        "month": F.month(ts),
        "day": F.day(ts),
        "hour": F.hour(ts),
        "weekofyear": F.weekofyear(ts),
        "dayofweek": F.weekday(ts),
        "dayofyear": F.dayofyear(ts),
        "weekend": is_weekend(ts),
    }


def elapsed_days(as_of: str, ts: Column | str) -> Column:
    """Whole days from ``ts`` to the moment ``as_of``, rounded down."""
    seconds = F.unix_timestamp(F.lit(as_of).cast("timestamp_ntz")) - F.unix_timestamp(ts)
    return floor_div(seconds, DAY_SECONDS)


def whole_days(later: Column | str, earlier: Column | str) -> Column:
    """Full 24-hour days between two moments, rounded down."""
    return floor_div(F.unix_timestamp(F.to_timestamp(later)) - F.unix_timestamp(F.to_timestamp(earlier)), DAY_SECONDS)


def month_diff(as_of: str, ts: Column | str, month_lag: Column | str) -> Column:
    """Thirty-day months from the event to ``as_of``, shifted by the month lag."""
    return floor_div(elapsed_days(as_of, ts), 30) + col(month_lag)


def epoch_seconds(ts: Column | str) -> Column:
    return F.unix_timestamp(ts)
