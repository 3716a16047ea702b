"""The first feature set: cross sums and segment statistics per card."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, functions as F

from ..operators import aggregate as ag, pivot as pv
from ..operators.clean import drop_overlap, restrict_to
from ..operators.profile import corr_long
from ..operators.select import TOP, top_names
from ..operators.skew import staged_by_key
from .prepare import TRANSACTION_CATEGORIES

CROSS_NUMBERS = ("purchase_amount", "installments")
# Columns and statistics of the per-card segment statistics.
STAT_COLUMNS = ("authorized_flag", "category_1", "installments", "category_3", "month_lag", "purchase_month",
                "purchase_day", "purchase_day_diff", "purchase_month_diff", "purchase_amount", "category_2",
                "purchase_hour_section", "most_recent_sales_range", "most_recent_purchases_range", "category_4")
STATS = ("nunique", "mean", "min", "max", "var", "skew", "sum")
ID_COLUMNS = ("city_id", "merchant_category_id", "merchant_id", "state_id", "subsector_id")
# Value ranges that hold by construction: day sections, differences of a 0/1 flag.
STAT_DOMAINS = {"purchase_hour_section": (0, 3), "purchase_day": (0, 1), "purchase_day_diff": (-1, 1)}
SEGMENTS = {"_hist": "month_lag < 0", "_new": "month_lag >= 0", "": None}


def cross_features(transactions: DataFrame, cards: DataFrame, key: str = "card_id",
                   cats: Sequence[str] = TRANSACTION_CATEGORIES, nums: Sequence[str] = CROSS_NUMBERS) -> DataFrame:
    """(card, feature, v): sums per category value of known cards, kept long."""
    known = restrict_to(transactions, cards, key)
    return pv.cross_features(pv.cross_sums(known, key, cats, nums), key, nums)


def card_statistics(transactions: DataFrame, key: str = "card_id") -> DataFrame:
    """Seven statistics of fifteen columns and distinct ids, for history, new and all rows: 336 columns.

    The prepared rows are staged once, in buckets by card, so that the window and the joins before run once.
    A card without rows in a segment gets NULL there, whichever segment it is.
    """
    rows = transactions.withColumn("_card", F.col(key))
    spec = {**{c: STATS for c in STAT_COLUMNS}, **{c: ("nunique",) for c in ID_COLUMNS}, "_card": ("size", "count")}

    def name(seg, c, s):
        return f"{key if c == '_card' else c}_{s}{seg}"

    rows = staged_by_key(rows.select(key, *[c for c in spec if c != key]), key)
    return ag.segmented_agg(rows, key, spec, SEGMENTS, name, STAT_DOMAINS, is_staged=True)


def assemble(cards: DataFrame, cross: DataFrame, stats: DataFrame, key: str = "card_id",
             names: Sequence[str] | None = None) -> DataFrame:
    """Cards with the widened cross sums and the statistics, missing values 0.

    ``names`` limits the cross sums to a selection made on the long form.
    """
    base = cards.join(pv.to_wide(cross, key, names), key, "left")
    joined = base.join(drop_overlap(base, stats, key), key, "left")
    return joined.na.fill(0)


def select_cross_features(cross: DataFrame, train: DataFrame, key: str = "card_id", y: str = "target", k: int = TOP) -> list[str]:
    """The cross sums most correlated with the label, chosen before anything is widened."""
    return top_names(corr_long(cross, train, key, y), k)
