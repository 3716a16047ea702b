"""Cleaning of the card, merchant and transaction tables."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, functions as F

from ..functions import dates, scalars
from ..operators.clean import fill_with_mean, replace_infinite
from ..operators.encode import encode_together, ordinal_encode
from ..operators.joins import enrich, union_all
from ..operators.skew import keyed_join, staged_by_key
from ..operators.windows import days_to_last, first_per_key, gap_days, group_diff

# Column roles of the merchant table.
MERCHANT_TEXT = ("category_1", "most_recent_sales_range", "most_recent_purchases_range", "category_4")
MERCHANT_CATEGORIES = ("merchant_id", "merchant_group_id", "merchant_category_id", "subsector_id", "category_1",
                       "most_recent_sales_range", "most_recent_purchases_range", "category_4", "city_id",
                       "state_id", "category_2")
MERCHANT_NUMBERS = ("numerical_1", "numerical_2", "avg_sales_lag3", "avg_purchases_lag3", "active_months_lag3",
                    "avg_sales_lag6", "avg_purchases_lag6", "active_months_lag6",
                    "avg_sales_lag12", "avg_purchases_lag12", "active_months_lag12")
MERCHANT_INFINITE = ("avg_purchases_lag3", "avg_purchases_lag6", "avg_purchases_lag12")
SHARED_WITH_TRANSACTIONS = ("merchant_category_id", "subsector_id", "category_1", "city_id", "state_id", "category_2")
# Merchant attributes joined to transactions, and the
# transaction columns treated as categories after the join.
MERCHANT_ATTRIBUTES = ("most_recent_sales_range", "most_recent_purchases_range", "category_4")
TRANSACTION_CATEGORIES = ("authorized_flag", "city_id", "category_1", "category_3", "merchant_category_id", "month_lag",
                          "most_recent_sales_range", "most_recent_purchases_range", "category_4",
                          "purchase_month", "purchase_hour_section", "purchase_day")
TRANSACTION_IDS = ("card_id", "city_id", "merchant_category_id", "merchant_id", "category_2", "state_id", "subsector_id")
# Fixed value: the merchant id that stands in for a missing one.
MISSING_MERCHANT = "M_ID_00a6ca8a8a"


def _fill_minus_one(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    kinds = {f.name: f.dataType.simpleString() for f in df.schema.fields}
    return df.na.fill({c: "-1" if kinds[c] == "string" else -1 for c in cols if c in kinds})


def prepare_cards(train: DataFrame, test: DataFrame) -> tuple[DataFrame, DataFrame]:
    """First active month -> code from a dictionary over both tables."""
    done = encode_together({"train": train, "test": test}, "first_active_month", missing="nan")
    return done["train"], done["test"]


def prepare_merchants(merchants: DataFrame, order: Sequence[str] | None = None) -> DataFrame:
    """Codes for text categories, -1 for missing categories, no infinities, means for missing numbers, one row per merchant.

    ``order`` decides which of several rows of a merchant is kept; without one, all columns in turn.
    """
    have = merchants.columns
    order = order or [c for c in ("merchant_id", *sorted(set(have) - {"merchant_id", *SHARED_WITH_TRANSACTIONS})) if c in have]
    df = ordinal_encode(merchants, *[c for c in MERCHANT_TEXT if c in have])
    df = _fill_minus_one(df, MERCHANT_CATEGORIES)
    df = replace_infinite(df, [c for c in MERCHANT_INFINITE if c in have])
    df = fill_with_mean(df, [c for c in MERCHANT_NUMBERS if c in have])
    return first_per_key(df.drop(*SHARED_WITH_TRANSACTIONS), "merchant_id", order)


def stage_transactions(new: DataFrame, hist: DataFrame, sizes: DataFrame | None = None, key: str = "card_id",
                       columns: Sequence[str] | None = None) -> DataFrame:
    """New and historical transactions as they came, written once in buckets by card, for dictionaries, joins, windows and totals.

    ``columns`` are those that the reader needs, all by default; ``sizes`` is as in ``staged_by_key``. A missing card is -1 before,
    since a key that is computed after reading does not lie in its bucket for Spark.
    """
    df = _fill_minus_one(union_all(new, hist), [key])
    return staged_by_key(df if columns is None else df.select(*[c for c in df.columns if c in columns]), key, sizes=sizes)


def prepare_transactions(new: DataFrame, hist: DataFrame, merchants: DataFrame, plan: int, order: Sequence[str],
                         sizes: DataFrame | None = None) -> DataFrame:
    """New and historical transactions, cleaned and joined to merchant attributes, from one staged table."""
    return prepare_staged(stage_transactions(new, hist, sizes), merchants, plan, order)


def prepare_staged(rows: DataFrame, merchants: DataFrame, plan: int, order: Sequence[str]) -> DataFrame:
    """The rows of ``stage_transactions``, cleaned and joined to merchant attributes; nothing moves them where they lie by card.

    Plan 1 marks missing categories -1 and turns categories into text, for the
    cross sums. Plan 2 leaves missing merchant attributes NULL and adds
    per-card differences to the previous row, for the card statistics.
    ``merchants`` is already prepared; ``order`` starts with the timestamp.
    """
    ts = order[0]
    df = rows.withColumn("purchase_month", dates.year_month(ts))
    df = ordinal_encode(df, "authorized_flag", "category_1", "category_3", "purchase_month", missing="-1")
    df = _fill_minus_one(df, [c for c in TRANSACTION_IDS if c != "card_id"])
    if "category_2" in df.columns:
        df = df.withColumn("category_2", F.col("category_2").cast("int"))
    df = df.withColumns({
        "purchase_hour_section": dates.hour_section(ts),
        "purchase_day": dates.weekend_section(ts)})
    df = enrich(df, merchants, "merchant_id", MERCHANT_ATTRIBUTES)
    if plan == 1:
        df = df.na.fill(-1, list(MERCHANT_ATTRIBUTES))
        return df.select(*[F.col(c).cast("string").alias(c) if c in TRANSACTION_CATEGORIES else F.col(c)
                           for c in df.columns if c != ts])
    diffs = group_diff(df, "card_id", order, ["purchase_day", "purchase_month"])
    return diffs.drop(ts)


def clean_transactions(df: DataFrame, missing_merchant=MISSING_MERCHANT, category_3: Mapping[str, int] | None = None) -> DataFrame:
    """Row-local cleaning for the refined features: no shuffle.

    Flags become 1/0, missing categories take their usual value, instalment
    sentinels go, amounts are restored, and date parts are added.
    """
    letters = category_3 or {"A": 0, "B": 1, "C": 2}
    flag = {"Y": 1, "N": 0}
    return df.withColumns({
        "authorized_flag": scalars.map_values("authorized_flag", flag),
        "category_1": scalars.map_values("category_1", flag),
        "category_2": F.coalesce(F.col("category_2").cast("double"), F.lit(1.0)),
        "category_3": scalars.map_values(F.coalesce("category_3", F.lit("A")), letters),
        "merchant_id": F.coalesce("merchant_id", F.lit(missing_merchant)),
        "installments": scalars.rewrite_installments("installments"),
        "purchase_amount": scalars.restore_amount("purchase_amount"),
        "purchase_date_floorday": dates.floor_day("purchase_date"),
        **dates.day_parts("purchase_date")})


def expand_transactions(df: DataFrame, cards: DataFrame, order: Sequence[str], key: str = "card_id",
                        missing_merchant=MISSING_MERCHANT) -> DataFrame:
    """Cleaned rows with days since activation, since the card's last purchase and since the previous row, and decayed amounts.

    The rows are put into buckets by card once; joins and windows by card read them there.
    """
    from ..functions.semantics import floor_div

    rows = clean_transactions(staged_by_key(df, key), missing_merchant)
    rows = keyed_join(rows, cards.select(key, F.to_date("first_active_month").alias("first_active_month")), key, row_id=order)
    active = F.datediff("purchase_date_floorday", "first_active_month")
    rows = rows.withColumn("purchase_day_since_active_day", active).withColumns({
        "purchase_month_since_active_day": floor_div("purchase_day_since_active_day", 30),
        "purchase_week_since_active_day": floor_div("purchase_day_since_active_day", 7)})
    since = "purchase_day_since_reference_day"
    rows = days_to_last(rows, key, "purchase_date", since).withColumns({
        "purchase_week_since_reference_day": floor_div(since, 7),
        "purchase_month_since_reference_day": floor_div(since, 30)})
    rows = gap_days(rows, key, order)
    return rows.withColumns({f"purchase_amount_{s}": scalars.decayed("purchase_amount", since, s) for s in scalars.DECAYS})
