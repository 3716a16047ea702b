"""The refined feature set: profiles, decays, pivots and two-level statistics per card.

The facts are cleaned, projected and staged once. Moments, day bounds, decays and
shares before activation come from one table of mergeable states per (card,
table, flag, month, day); distinct values, pivots and quantiles from roll-ups of
the staged rows. No family joins facts: what needs the card's activation month,
last purchase day or a group mean is computed on these totals. A card has at most
a few rows per calendar day there, whatever its number of transactions.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from ..functions import dates, scalars
from ..functions.semantics import dbl, div_inf
from ..operators import aggregate as ag, pivot as pv, quantile as qt, states as st
from ..operators.clean import flag_outliers, prune_by_name, pruned_by_name
from ..operators.encode import is_small, target_encode
from ..operators.joins import join_features
from ..operators.skew import kept_by_key, keyed_join, lies_by_key, staged_by_key
from ..session import staged

KEY = "card_id"
# Statistics of the base family.
BASE_SPEC = {
    "category_1": ("mean",), "category_2": ("mean",), "category_3": ("mean",),
    "installments": ("mean", "max", "min", "std"),
    "month_lag": ("nunique", "mean", "max", "min", "std"),
    "month": ("nunique", "mean", "max", "min", "std"),
    "hour": ("nunique", "mean", "max", "min", "std"),
    "weekofyear": ("nunique", "mean", "max", "min", "std"),
    "dayofweek": ("nunique", "mean"), "weekend": ("mean",), "year": ("nunique",),
    "card_id": ("size", "count"), "purchase_date": ("max", "min"),
    "price": ("mean", "max", "min", "std"),
    "duration": ("mean", "min", "max", "std", "skew"),
    "amount_month_ratio": ("mean", "min", "max", "std", "skew"),
}
# Calendar ranges, for distinct counts as bit masks.
CALENDAR = {"month": (1, 12), "hour": (0, 23), "weekofyear": (1, 53), "dayofweek": (0, 6)}
GROUP_MEANS = ("category_2", "category_3")
# Columns of the profile families.
PROFILE_DISTINCT = ("category_1", "category_2", "category_3", "state_id", "city_id", "installments", "merchant_id",
                    "merchant_category_id", "subsector_id", "month_lag", "purchase_date_floorday")
RECENT_DISTINCT = ("state_id", "city_id", "installments", "merchant_id", "merchant_category_id", "purchase_date_floorday")
PIVOTS = ("category_1", "category_2", "category_3", "month_lag", "subsector_id", "weekend")
SHARE_PIVOTS = ("category_1", "category_2", "category_3", "month_lag", "subsector_id")
RECENT_DECAYS = ("ddgd_98", "wdgd_96", "mdgd_90", "mdgd_80")
# Fixed values: (level, column) pairs and levels of the two-level family.
LEVEL_PAIRS = (
    ("month_lag", "state_id"), ("month_lag", "city_id"), ("month_lag", "subsector_id"),
    ("month_lag", "merchant_category_id"), ("month_lag", "merchant_id"), ("month_lag", "purchase_date_floorday"),
    ("subsector_id", "merchant_category_id"), ("subsector_id", "merchant_id"),
    ("subsector_id", "purchase_date_floorday"), ("subsector_id", "month_lag"),
    ("merchant_category_id", "merchant_id"), ("merchant_category_id", "purchase_date_floorday"),
    ("merchant_category_id", "month_lag"),
    ("purchase_date_floorday", "merchant_id"), ("purchase_date_floorday", "merchant_category_id"),
    ("purchase_date_floorday", "subsector_id"))
LEVELS = ("month_lag", "state_id", "city_id", "subsector_id", "merchant_category_id", "merchant_id", "purchase_date_floorday")

# Rows are cleaned transactions; ``is_new`` tells the new from the historical table.
BASE_SEGMENTS = {
    "auth_": "NOT is_new AND authorized_flag = 1",
    "hist_": "NOT is_new AND authorized_flag = 0",
    "new_": "is_new"}
PROFILE_SEGMENTS = {
    "auth_cardf_": "NOT is_new AND authorized_flag = 1",
    "hist_cardf_": "NOT is_new",
    "new_cardf_": "is_new",
    "hist_last2_": "NOT is_new AND month_lag >= -2"}


def tag_rows(hist: DataFrame, new: DataFrame) -> DataFrame:
    return hist.withColumn("is_new", F.lit(False)).unionByName(new.withColumn("is_new", F.lit(True)))


#: Columns that the families read.
FACT_COLUMNS = (KEY, "is_new", "authorized_flag", "category_1", "category_2", "category_3", "installments", "month_lag", "purchase_amount",
                "purchase_date", "purchase_date_floorday", "month", "hour", "weekofyear", "dayofweek", "weekend", "year",
                "merchant_id", "merchant_category_id", "subsector_id", "city_id", "state_id")
#: Columns that the pivots read.
PIVOT_COLUMNS = (KEY, "is_new", "authorized_flag", *PIVOTS, "merchant_id", "purchase_date_floorday")
#: Columns that the base statistics read.
BASE_COLUMNS = (KEY, "is_new", "authorized_flag", "category_1", "category_2", "category_3", "installments", "month_lag", "purchase_amount",
                "purchase_date", "purchase_date_floorday", *CALENDAR, "weekend", "year")
#: Keys of the state table; every segment is a condition on them.
STATE_KEYS = (KEY, "is_new", "authorized_flag", "month_lag", "purchase_date_floorday")
#: What the states keep of each row-level column: the highest power of deviations.
STATE_COLUMNS = {"category_1": 1, "category_2": 1, "category_3": 1, "installments": 2, "hour": 2, "price": 2, "duration": 3,
                 "amount_month_ratio": 3, "purchase_amount": 2, "month_diff": 1, "moment": 1}
# Functions of the day, which need no state of their own.
DAY_PARTS = ("month", "weekofyear", "dayofweek", "weekend", "year")


def staged_rows(rows: DataFrame, columns: Sequence[str] = FACT_COLUMNS, sizes: DataFrame | None = None) -> DataFrame:
    """The columns that the families read, written once, in buckets by card.

    What is a function of the moment is not moved and written with the rows, but computed where they are read. A reader of one
    family names its ``columns``. ``sizes`` is as in ``staged_by_key``.
    """
    wanted = [c for c in columns if c in rows.columns]
    parts = {**dates.day_parts("purchase_date"), "purchase_date_floorday": dates.floor_day("purchase_date")} if "purchase_date" in rows.columns else {}
    moved = dict.fromkeys("purchase_date" if c in parts else c for c in wanted)
    return staged_by_key(rows.select(*moved), KEY, sizes=sizes).select(*[parts[c].alias(c) if c in parts else c for c in wanted])


def kept_states(rows: DataFrame, as_of: str) -> DataFrame:
    """The state table for several readers. It is wider than its rows, so where these lie by card it is folded again, which moves
    nothing, and otherwise written."""
    states = state_table(rows, as_of)
    return states if lies_by_key(rows, KEY) else staged(states)


def state_table(rows: DataFrame, as_of: str) -> DataFrame:
    """Mergeable states per (card, table, flag, month, day). Later rows are folded the same way and merged in by ``merge_states``."""
    df = rows.withColumn("month_diff", dates.month_diff(as_of, "purchase_date", "month_lag")).withColumns({
        "price": div_inf("purchase_amount", "installments"),
        "duration": dbl("purchase_amount") * F.col("month_diff"),
        "amount_month_ratio": div_inf("purchase_amount", "month_diff"),
        "moment": dates.epoch_seconds("purchase_date")})
    return st.fold(df, STATE_KEYS, STATE_COLUMNS, {"hour": CALENDAR["hour"]}, [F.max("purchase_date").alias("last_moment")])


def merge_states(states: DataFrame, later: DataFrame) -> DataFrame:
    """The states of old and later rows; a day that both have is merged."""
    both = states.unionByName(later)
    last = both.groupBy(*STATE_KEYS).agg(F.max("last_moment").alias("last_moment")).withColumnsRenamed({k: f"_{k}" for k in STATE_KEYS})
    merged = st.merge(both.drop("last_moment"), STATE_KEYS, STATE_COLUMNS, ["hour"])
    same = [F.col(k).eqNullSafe(F.col(f"_{k}")) for k in STATE_KEYS]
    return merged.join(last, same).drop(*[f"_{k}" for k in STATE_KEYS])


def _with_key_states(states: DataFrame) -> DataFrame:
    """With the states of the keys and of the functions of the day."""
    parts = {n: c for n, c in dates.day_parts("purchase_date_floorday").items() if n in DAY_PARTS}
    return states.withColumns(parts).withColumns({
        **{f"_{c}": st.constant(F.col(c), power=2) for c in (*DAY_PARTS, "month_lag")},
        "_flag": st.constant(F.col("authorized_flag"), power=1), "_key": st.constant(F.col(KEY), power=1)})


def base_statistics(rows: DataFrame, as_of: str, segments: Mapping[str, str] = BASE_SEGMENTS, states: DataFrame | None = None) -> DataFrame:
    """Statistics of amounts, dates and ratios per card for every segment, from the state table."""
    states = state_table(rows, as_of) if states is None else states
    own = {c: f"_{c}" for c in (*DAY_PARTS, "month_lag")} | {KEY: "_key", "purchase_date": "moment"}
    spec = {own.get(c, c): s for c, s in BASE_SPEC.items()}
    of = {v: k for k, v in own.items()}

    def name(seg, c, s):
        return f"{seg}{of.get(c, c)}_{s}"

    calendar = {f"_{c}": st.mask(c, *d, c) for c, d in CALENDAR.items() if c in DAY_PARTS}
    table = _with_key_states(states).withColumns({"_month_lag_key": F.col("month_lag"), "_year_key": F.col("year")})
    counted = {c: ("nunique",) for c in ("_month_lag_key", "_year_key")}
    spec = {c: [s for s in stats if not (s == "nunique" and c in ("_month_lag", "_year"))] for c, stats in spec.items()}
    of |= {"_month_lag_key": "month_lag", "_year_key": "year"}
    stats = st.statistics(table, KEY, {c: s for c, s in spec.items() if s} | counted, segments, name, calendar, list(counted))
    # least and largest values have the type of their column
    kinds = dict(rows.dtypes) | {"purchase_date": "bigint"}
    stats = stats.select(KEY, *[F.col(n).cast(kinds[c]) if s in ("min", "max") and c in kinds else F.col(n)
                                for seg in segments for c, own in BASE_SPEC.items() for s in own for n in [f"{seg}{c}_{s}"]])
    return stats.join(group_mean_means(rows, segments), KEY, "left")


def group_mean_means(df: DataFrame, segments: Mapping[str, str]) -> DataFrame:
    """Per card and segment, the mean over its rows of each row's category mean amount.

    Category means come from (card, category value) totals, so the facts are
    not joined to them.
    """
    segs = list(segments)
    rows = df.select(KEY, F.col("purchase_amount").alias("_a"), *[F.expr(segments[s]).alias(f"_in{i}") for i, s in enumerate(segs)],
                     F.explode(F.array(*[F.struct(F.lit(c).alias("column"), dbl(c).alias("value")) for c in GROUP_MEANS])).alias("_s"))
    totals = (rows.select(KEY, "_a", *[f"_in{i}" for i in range(len(segs))], "_s.*").filter(F.col("value").isNotNull())
              .groupBy(KEY, "column", "value").agg(
                  *[F.count(F.when(F.col(f"_in{i}"), F.lit(1))).alias(f"_n{i}") for i in range(len(segs))],
                  *[F.sum(F.when(F.col(f"_in{i}"), F.col("_a"))).alias(f"_t{i}") for i in range(len(segs))]))
    means = staged(totals.groupBy("column", "value").agg(*[
        F.try_divide(F.sum(f"_t{i}"), F.sum(f"_n{i}")).alias(f"_m{i}") for i in range(len(segs))],
        F.count(F.lit(1)).alias("_cards")))
    # a category has a handful of values, each shared by a large part of the cards: they are brought to the totals, which stay by card
    if is_small(means):
        joined = totals.join(F.broadcast(means.drop("_cards")), ["column", "value"])
    else:
        joined = keyed_join(totals, means, ["column", "value"], "inner", size="_cards")
    out = []
    for i, s in enumerate(segs):
        for c in GROUP_MEANS:
            here = (F.col("column") == c) & (F.col(f"_n{i}") > 0)
            out.append(F.try_divide(F.sum(F.when(here, F.col(f"_n{i}") * F.col(f"_m{i}"))),
                                    F.sum(F.when(here, F.col(f"_n{i}")))).alias(f"{s}{c}_mean_mean"))
    return joined.groupBy(KEY).agg(*out)


def daily_totals(states: DataFrame, segments: Mapping[str, str] = PROFILE_SEGMENTS) -> DataFrame:
    """(card, is_new, day): flagged-row count and amount per segment, and days since the card's last day of that table."""
    flagged, amount = F.when(F.col("authorized_flag").isNotNull(), F.col(st.ROWS)).otherwise(F.lit(0)), F.col("purchase_amount")
    daily = states.groupBy(KEY, "is_new", F.col("purchase_date_floorday").alias("day")).agg(*[
        agg.alias(f"{name}_{i}") for i, p in enumerate(segments.values()) for name, agg in (
            ("n", F.coalesce(F.sum(F.when(F.expr(p), flagged)), F.lit(0).cast("bigint"))), ("amount", F.sum(F.when(F.expr(p), amount["total"]))),
            ("amounts", F.coalesce(F.sum(F.when(F.expr(p), amount["n"])), F.lit(0).cast("bigint"))))])
    # at most one row per calendar day in a window group
    last = F.max("day").over(Window.partitionBy(KEY, "is_new"))
    return daily.withColumn("since", F.datediff(last, F.col("day")))


def decayed_sums(daily: DataFrame, segments: Sequence[str] = tuple(PROFILE_SEGMENTS)) -> DataFrame:
    """Sums of amounts decayed by the days, weeks and months since the card's last purchase."""
    out = []
    for i, seg in enumerate(segments):
        present = F.max(F.col(f"amounts_{i}") + F.col(f"n_{i}"))
        for s in (RECENT_DECAYS if seg == "hist_last2_" else scalars.DECAYS):
            total = F.coalesce(F.sum(scalars.decayed(f"amount_{i}", "since", s)), F.lit(0.0))
            out.append(F.when(present > 0, total).alias(f"{seg}card_id_purchase_amount_{s}_sum"))
    return daily.groupBy(KEY).agg(*out)


def before_activation(daily: DataFrame, cards: DataFrame, segment: str = "new_cardf_",
                      segments: Sequence[str] = tuple(PROFILE_SEGMENTS)) -> DataFrame:
    """Count, sum and mean of a segment's purchases made before the activation month."""
    i = list(segments).index(segment)
    months = cards.select(KEY, F.to_date("first_active_month").alias("_active"))
    early = daily.join(months, KEY).filter((F.col("day") < F.col("_active")) & (F.col(f"amounts_{i}") + F.col(f"n_{i}") > 0))
    total = F.coalesce(F.sum(f"amount_{i}"), F.lit(0.0))
    return early.groupBy(KEY).agg(
        F.sum(f"n_{i}").alias(f"{segment}card_id_part_cnt"),
        total.alias(f"{segment}card_id_part_purchase_amount_sum"),
        F.try_divide(F.sum(f"amount_{i}"), F.sum(f"amounts_{i}")).alias(f"{segment}card_id_part_purchase_amount_mean"))


def _profile_spec(seg: str) -> dict[str, Sequence[str]]:
    amount = ("sum", "mean", "std") if seg == "hist_last2_" else ("sum", "mean", "std", "max", "min")
    spec = {"authorized_flag": ("count", "mean", "sum"), "month_diff": ("mean",), "purchase_amount": amount}
    if seg != "hist_last2_":
        spec["installments"] = ("sum",)
    return spec


def _order_statistics(rows: DataFrame, segments: Mapping[str, str]) -> DataFrame:
    """Medians and quantiles of every segment; a row enters once per segment it belongs to."""
    segs = F.array(*[F.when(F.expr(p), F.lit(s)) for s, p in segments.items()])
    tagged = (rows.select(KEY, "purchase_amount", "month_diff", F.explode(segs).alias("_seg"))
              .filter(F.col("_seg").isNotNull()))
    low, high = (lambda n: F.floor((n - 1) / 2)), (lambda n: F.floor(n / 2))
    amount = qt.rank_values(tagged, [KEY, "_seg"], "purchase_amount", {
        "low": low, "high": high, **{f"q{p}": qt.element_rank(p) for p in (0.025, 0.25, 0.75, 0.975)}})
    months = qt.rank_values(tagged, [KEY, "_seg"], "month_diff", {"mlow": low, "mhigh": high})

    def pick(c, s):
        return F.max(F.when(F.col("_seg") == s, F.col(f"`{c}`")))

    of_amount, of_months = [], []
    for s in segments:
        of_amount.append(((pick("low", s) + pick("high", s)) / 2).alias(f"{s}card_id_purchase_amount_median"))
        if s == "hist_last2_":
            continue
        of_months.append(((pick("mlow", s) + pick("mhigh", s)) / 2).alias(f"{s}month_diff_median"))
        of_amount += [pick("q0.25", s).alias(f"{s}purchase_amount_25_quantile"),
                      pick("q0.75", s).alias(f"{s}purchase_amount_75_quantile"),
                      (pick("q0.975", s) - pick("q0.025", s)).alias(f"{s}card_id_purchase_amount_range2")]
    # one row per card before the join, since a join by card and segment would move the rows of a card
    amounts = amount.groupBy(KEY).agg(*of_amount)
    return amounts.join(months.groupBy(KEY).agg(*of_months), KEY, "full") if of_months else amounts


def _days(later: Column, earlier: Column) -> Column:
    return F.datediff(later, earlier)


def profile_totals(rows: DataFrame, states: DataFrame, segments: Mapping[str, str] = PROFILE_SEGMENTS) -> DataFrame:
    """Counts, means, sums, day bounds and rows-per-distinct ratios per card and segment; ``rows`` are staged."""
    day, lag = F.col("purchase_date_floorday"), F.col("month_lag")
    bounds = {"first_day": F.min(day), "last_day": F.max(day), "last_moment": F.max("last_moment"), "month_lag_min": F.min(lag), "month_lag_max": F.max(lag)}
    spec = {}
    for seg in segments:
        for c, stats in _profile_spec(seg).items():
            spec.setdefault("_flag" if c == "authorized_flag" else c, set()).update(stats)
    totals = st.statistics(_with_key_states(states), KEY, {c: sorted(s) for c, s in spec.items()}, segments,
                           lambda seg, c, s: f"{seg}{'authorized_flag' if c == '_flag' else c}_{s}", also=bounds)
    uniq = ag.distinct_counts(rows, KEY, PROFILE_DISTINCT, segments, lambda seg, c: f"{seg}card_id_{c}_nunique", is_staged=True)
    return totals.join(uniq, KEY)


def card_profile(rows: DataFrame, cards: DataFrame, as_of: str, hist_now: str = "2018-03-01", new_now: str = "2018-05-01",
                 features: Sequence[str] | None = None, drop_pruned: bool = False, states: DataFrame | None = None) -> DataFrame:
    """The four profile families (authorised, history, new, last two months) in one row per card. ``rows`` are staged.

    ``features`` fixes the pivot columns, none if it is empty; otherwise they are
    found from the data. ``drop_pruned`` skips pivot columns that the final name rules remove.
    """
    df = rows.withColumn("month_diff", dates.month_diff(as_of, "purchase_date", "month_lag"))
    states = kept_states(rows, as_of) if states is None else states
    totals = profile_totals(rows, states)
    daily = daily_totals(states)
    ranks = _order_statistics(df, PROFILE_SEGMENTS)
    names, wide = list(features or ()), None
    if features is None or names:
        # the names and the columns are both read from the totals per value, which are made once
        rollup = kept_by_key(pv.value_rollup(rows, KEY, PIVOTS, "merchant_id", "purchase_date_floorday", PROFILE_SEGMENTS), KEY)
        places = pv.feature_places(rollup, KEY, list(PROFILE_SEGMENTS), SHARE_PIVOTS)
        names = names or sorted(places)
        if drop_pruned:
            names = [n for n in names if not pruned_by_name(n)]
        wide = pv.rollup_to_wide(rollup, KEY, places, names, len(PROFILE_SEGMENTS), SHARE_PIVOTS)
    activation = cards.select(KEY, F.to_date("first_active_month").alias("_active"))
    joined = (totals.join(activation, KEY, "left").join(decayed_sums(daily), KEY, "left")
              .join(before_activation(daily, cards), KEY, "left").join(ranks, KEY, "left"))
    joined = joined if wide is None else joined.join(wide, KEY, "left")
    # a card with rows in the segment but none of a value counts 0 there, otherwise NULL
    empty = {s: F.when(F.col(f"{s}authorized_flag_count").isNotNull(), F.lit(0.0)) for s in PROFILE_SEGMENTS}
    return joined.select(KEY, *_profile_columns(hist_now, new_now), *[
        F.coalesce(F.col(f"`{n}`"), empty[_segment_of(n)]).alias(n) for n in names])


def _segment_of(name: str) -> str:
    return next(s for s in PROFILE_SEGMENTS if name.startswith(s))


def _profile_columns(hist_now: str, new_now: str) -> list[Column]:
    c = F.col
    out = []

    def add(seg, name, value):
        out.append(value.alias(f"{seg}{name}"))

    for seg in PROFILE_SEGMENTS:
        cnt = c(f"{seg}authorized_flag_count")
        amount = f"{seg}purchase_amount"
        add(seg, "card_id_cnt", cnt)
        if seg in ("hist_cardf_", "hist_last2_"):
            add(seg, "card_id_isau_mean", c(f"{seg}authorized_flag_mean"))
            add(seg, "card_id_isau_sum", c(f"{seg}authorized_flag_sum"))
        add(seg, "month_diff_mean", c(f"{seg}month_diff_mean"))
        for s in ("sum", "mean", "std"):
            add(seg, f"card_id_purchase_amount_{s}", c(f"{amount}_{s}"))
        out.append(c(f"{seg}card_id_purchase_amount_median"))
        for d in (RECENT_DISTINCT if seg == "hist_last2_" else PROFILE_DISTINCT):
            n = c(f"{seg}card_id_{d}_nunique")
            out.append(n)
            add(seg, f"card_id_cnt_divide_{d}_nunique", div_inf(cnt, n))
        for s in (RECENT_DECAYS if seg == "hist_last2_" else scalars.DECAYS):
            out.append(c(f"{seg}card_id_purchase_amount_{s}_sum"))
        if seg == "hist_last2_":
            continue
        add(seg, "card_id_installments_sum", c(f"{seg}installments_sum"))
        for s in ("max", "min"):
            add(seg, f"card_id_purchase_amount_{s}", c(f"{amount}_{s}"))
        add(seg, "card_id_purchase_amount_range", c(f"{amount}_max") - c(f"{amount}_min"))
        out += [c(f"{seg}month_diff_median"), c(f"{seg}purchase_amount_25_quantile"),
                c(f"{seg}purchase_amount_75_quantile"), c(f"{seg}card_id_purchase_amount_range2")]

    seg = "hist_cardf_"
    first, last, active = c(f"{seg}first_day"), c(f"{seg}last_day"), c("_active")
    now = F.lit(hist_now).cast("date")
    first_to_active, active_to_last, span = _days(first, active), _days(last, active), _days(last, first)
    add(seg, "first_to_activation_day", first_to_active)
    add(seg, "activation_to_reference_day", active_to_last)
    add(seg, "first_to_reference_day", span)
    add(seg, "reference_day_to_now", _days(now, last))
    add(seg, "first_day_to_now", _days(now, first))
    add(seg, "card_id_month_lag_min", c(f"{seg}month_lag_min"))
    present = c(f"{seg}authorized_flag_count").isNotNull()
    add(seg, "is_purchase_before_activation", F.when(present, F.coalesce(first_to_active < 0, F.lit(False)).cast("int")))
    add(seg, "first_to_reference_day_divide_activation_to_reference_day", div_inf(span, dbl(active_to_last) + F.lit(0.01)))
    add(seg, "days_per_count", div_inf(span, c(f"{seg}authorized_flag_count")))

    seg = "new_cardf_"
    # the reference keeps its time of day, so a started day does not count
    ref, now = c("hist_cardf_last_moment"), F.lit(new_now).cast("date")
    first, last = c(f"{seg}first_day"), c(f"{seg}last_day")
    ref = F.when(first.isNotNull(), ref)
    ref_to_last, span = dates.whole_days(last, ref), _days(last, first)
    add(seg, "reference_day_to_first_day", dates.whole_days(first, ref))
    add(seg, "reference_day_to_last_day", ref_to_last)
    add(seg, "first_to_last_day", span)
    add(seg, "activation_to_first_day", _days(first, active))
    add(seg, "activation_to_last_day", _days(last, active))
    add(seg, "reference_day_to_now", _days(now, F.to_date(ref)))
    add(seg, "first_day_to_now", _days(now, first))
    add(seg, "card_id_month_lag_max", c(f"{seg}month_lag_max"))
    add(seg, "first_to_last_day_divide_reference_to_last_day", div_inf(span, dbl(ref_to_last) + F.lit(0.01)))
    add(seg, "days_per_count", div_inf(span, c(f"{seg}authorized_flag_count")))
    for s in ("cnt", "purchase_amount_sum", "purchase_amount_mean"):
        out.append(c(f"{seg}card_id_part_{s}"))
    add(seg, "card_id_part_purchase_amount_sum_percent", div_inf(
        f"{seg}card_id_part_purchase_amount_sum", dbl(f"{seg}purchase_amount_sum") + F.lit(0.01)))
    return out


def two_level_features(rows: DataFrame, prefix: str = "hist_levelAB_", is_staged: bool = False) -> DataFrame:
    """Mean, maximum and deviation per card of inner counts and sums over the historical rows: 90 columns."""
    return ag.two_level_many(rows.filter("NOT is_new"), KEY, LEVEL_PAIRS, LEVELS, "merchant_id", "purchase_amount", prefix, is_staged)


def card_attributes(cards: DataFrame, now: str = "2018-03-01") -> DataFrame:
    """Year, elapsed days, week, day of year and month of the activation month."""
    month = F.to_date("first_active_month")
    return cards.withColumns({
        "year": F.coalesce(F.year(month), F.lit(0)),
        "elapsed_time": F.datediff(F.lit(now).cast("date"), month),
        "weekofyear": F.weekofyear(month), "dayofyear": F.dayofyear(month), "month": F.month(month)})


def final_ratios(df: DataFrame) -> DataFrame:
    """Products and ratios across the feature families."""
    c, feats = F.col, ("feature_1", "feature_2", "feature_3")
    row = scalars.row_stats(feats)
    new_amount, hist_amount = (dbl(f"{s}_cardf_card_id_purchase_amount_sum") for s in ("new", "hist"))
    new_inst, auth_inst = (dbl(f"{s}_cardf_card_id_installments_sum") for s in ("new", "auth"))
    first = {}
    for i, f in enumerate(feats, 1):
        first[f"days_feature{i}"] = c("elapsed_time") * c(f)
        first[f"days_feature{i}_ratio"] = div_inf(f, "elapsed_time")
    first |= {
        "feature_sum": row["sum"], "feature_mean": row["mean"], "feature_max": row["max"], "feature_min": row["min"],
        "feature_var": row["std"],
        "card_id_total": c("hist_card_id_size") + c("new_card_id_size"),
        "card_id_cnt_total": c("hist_card_id_count") + c("new_card_id_count"),
        "card_id_cnt_ratio": div_inf("new_card_id_count", "hist_card_id_count"),
        "purchase_amount_total": hist_amount + new_amount,
        "purchase_amount_ratio": div_inf(new_amount, hist_amount),
        "month_diff_ratio": div_inf("new_cardf_month_diff_mean", "hist_cardf_month_diff_mean"),
        "installments_total": new_inst + auth_inst,
        "installments_ratio": div_inf(new_inst, auth_inst),
        "new_CLV": div_inf(dbl("new_card_id_count") * new_amount, "new_cardf_month_diff_mean"),
        "hist_CLV": div_inf(dbl("hist_card_id_count") * hist_amount, "hist_cardf_month_diff_mean")}
    return df.withColumns(first).withColumns({
        "price_total": div_inf("purchase_amount_total", "installments_total"),
        "CLV_ratio": div_inf("new_CLV", "hist_CLV")})


def refined_features(cards: DataFrame, rows: DataFrame, as_of: str, now: str = "2018-03-01", outlier_below: float = -30.0,
                     hist_now: str | None = None, new_now: str = "2018-05-01", sizes: DataFrame | None = None) -> DataFrame:
    """All families on every card, with outlier flag, target encodings and the name rules applied.

    ``cards`` has a ``split`` column; encodings are fitted on train only. The
    key, label and split stay in the result. ``sizes`` is as in ``staged_by_key``.
    """
    # encodings need only the narrow card table, so they come before the wide joins
    df = flag_outliers(card_attributes(cards, now), "target", outlier_below)
    train = df.filter("split = 'train'")
    for f in ("feature_1", "feature_2", "feature_3"):
        df = target_encode(train, df, f, "outliers", f"{f}_outliers_mean")
    rows = staged_rows(rows, sizes=sizes)
    states = kept_states(rows, as_of)
    profile = card_profile(rows, cards, as_of, hist_now or now, new_now, drop_pruned=True, states=states)
    df = join_features(df, [base_statistics(rows, as_of, states=states), profile, two_level_features(rows, is_staged=True)], KEY)
    return prune_by_name(final_ratios(df), keep=(KEY, "target", "split", "outliers"))
