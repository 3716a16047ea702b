"""Composite feature operators C1-C12."""

from pyspark.sql import functions as F

from cardloom.functions import scalars
from cardloom.operators import pivot as pv
from cardloom.operators.clean import pruned_by_name
from cardloom.plans import baseline as ba, prepare as pp, refined as rf
from cardloom.sources.fixtures import ROW_ORDER

from .registry import ORACLES, query
from .rows import AMOUNT

AS_OF = "2002-01-01 00:00:00"
ORDER = "purchase_date, ord_1, ord_2, ord_3"
LINE = ["card_id", "ord_1", "ord_2", "ord_3"]
ORDS = "ord_1, ord_2, ord_3"


def _code(expr, table):
    return f"CAST(dense_rank() OVER (ORDER BY {expr}) - 1 AS INT)"


_MERCHANTS = """
    mt AS (SELECT greatest(max(CASE WHEN isinf(avg_purchases_lag3) THEN -99 ELSE avg_purchases_lag3 END), max(avg_purchases_lag6)) AS top, avg(numerical_1) AS mean FROM merchants),
    pm AS (SELECT merchant_id, CAST(dense_rank() OVER (ORDER BY most_recent_sales_range) - 1 AS INT) AS most_recent_sales_range,
             CAST(dense_rank() OVER (ORDER BY most_recent_purchases_range) - 1 AS INT) AS most_recent_purchases_range,
             CAST(dense_rank() OVER (ORDER BY category_4) - 1 AS INT) AS category_4,
             coalesce(numerical_1, mean) AS numerical_1, CASE WHEN isinf(avg_purchases_lag3) THEN top ELSE avg_purchases_lag3 END AS avg_purchases_lag3, avg_purchases_lag6
           FROM merchants, mt)"""


@query("c01_prepare_merchants", f"""
WITH {_MERCHANTS} SELECT merchant_id, most_recent_sales_range, most_recent_purchases_range, category_4, round(numerical_1, 6) AS numerical_1,
       avg_purchases_lag3, avg_purchases_lag6 FROM pm""")
def _(t):
    # the third column stands for the wider raw table's last lag
    df = t.merchants.withColumn("avg_purchases_lag12", F.col("avg_purchases_lag6"))
    done = pp.prepare_merchants(df).drop("avg_purchases_lag12")
    return done.withColumn("numerical_1", F.round("numerical_1", 6))


_PREPARED = _MERCHANTS + f""",
    pt AS (SELECT t.card_id, coalesce(t.merchant_id, -1) AS merchant_id, merchant_category_id, subsector_id, city_id, state_id,
             CAST(dense_rank() OVER (ORDER BY authorized_flag) - 1 AS INT) AS authorized_flag, CAST(dense_rank() OVER (ORDER BY category_1) - 1 AS INT) AS category_1,
             coalesce(category_2, -1) AS category_2, CAST(dense_rank() OVER (ORDER BY coalesce(category_3, '-1')) - 1 AS INT) AS category_3,
             installments, month_lag, purchase_amount, amount_units, ord_1, ord_2, ord_3, purchase_date,
             CAST(dense_rank() OVER (ORDER BY strftime(purchase_date, '%Y-%m')) - 1 AS INT) AS purchase_month,
             CAST(hour(purchase_date) // 6 AS INT) AS purchase_hour_section, CAST((isodow(purchase_date) - 1) // 5 AS INT) AS purchase_day,
             m.most_recent_sales_range, m.most_recent_purchases_range, m.category_4
           FROM txn t LEFT JOIN pm m ON m.merchant_id = coalesce(t.merchant_id, -1)),
    p2 AS (SELECT *, purchase_day - lag(purchase_day) OVER w AS purchase_day_diff, purchase_month - lag(purchase_month) OVER w AS purchase_month_diff
           FROM pt WINDOW w AS (PARTITION BY card_id ORDER BY {ORDER}))"""


def _raw(t, columns=None):
    return pp.stage_transactions(t.txn.filter("month_lag >= 0"), t.txn.filter("month_lag < 0"), t.txn_sizes, columns=columns)


def _prepared(t, plan, rows=None):
    merchants = pp.prepare_merchants(t.merchants.withColumn("avg_purchases_lag12", F.col("avg_purchases_lag6")))
    return pp.prepare_staged(_raw(t) if rows is None else rows, merchants, plan, ROW_ORDER)


#: What cross sums and statistics read of a transaction.
_CROSS_COLUMNS = ("card_id", "merchant_id", "merchant_category_id", "city_id", "authorized_flag", "category_1", "category_3", "installments", "month_lag",
                  "amount_units", "purchase_date")
_STAT_COLUMNS = ("card_id", "merchant_id", "merchant_category_id", "subsector_id", "city_id", "state_id", "authorized_flag", "category_1", "category_2", "category_3",
                 "installments", "month_lag", "purchase_amount", *ROW_ORDER)


_TEXT = ", ".join(f"CAST(coalesce({c}, -1) AS VARCHAR) AS {c}" if c in pp.MERCHANT_ATTRIBUTES else f"CAST({c} AS VARCHAR) AS {c}"
                  for c in pp.TRANSACTION_CATEGORIES)


@query("c02_prepare_transactions_plan1", f"""
WITH {_PREPARED} SELECT card_id, {ORDS}, merchant_id, subsector_id, state_id, category_2, installments, purchase_amount, amount_units, {_TEXT} FROM pt""")
def _(t):
    return _prepared(t, 1)


@query("c02_prepare_transactions_plan2", f"WITH {_PREPARED} SELECT * EXCLUDE (purchase_date) FROM p2")
def _(t):
    return _prepared(t, 2)


@query("c03_cross_sums", f"WITH {_PREPARED}, tx AS (SELECT card_id, amount_units, installments, {_TEXT} FROM pt) "
       + " UNION ALL ".join(f"SELECT card_id, '{c}&' || {c} || '&{n}' AS feature, CAST(sum({n}) AS DOUBLE) AS v FROM tx GROUP BY 1, 2"
                            for c in pp.TRANSACTION_CATEGORIES for n in ("amount_units", "installments")))
def _(t):
    return ba.cross_features(_prepared(t, 1, _raw(t, _CROSS_COLUMNS)), t.cards, nums=("amount_units", "installments"))


# Statistic -> (DuckDB text, digits, shift). Amounts are not whole numbers here, so their sums depend on the order of addition. The
# shifts keep values that are exact decimals off the border between two roundings.
_C4_STATS = {"nunique": ("count(DISTINCT {c}) FILTER ({p})", None), "mean": ("avg({c}) FILTER ({p})", (9, 0.0)), "min": ("min({c}) FILTER ({p})", None),
             "max": ("max({c}) FILTER ({p})", None), "var": ("var_samp({c}) FILTER ({p})", (5, 0.0000037)),
             "skew": ("CASE WHEN min({c}) FILTER ({p}) < max({c}) FILTER ({p}) THEN skewness({c}) FILTER ({p}) END", (6, 0.0)),
             "sum": ("CAST(coalesce(sum({c}) FILTER ({p}), 0) AS DOUBLE)", None)}
_C4_AMOUNT = {"mean": (3, 0.000371293), "var": (0, 0.371293), "skew": (5, 0.0), "sum": (3, 0.000371293)}
_C4_PARTS = (("_hist", "month_lag < 0"), ("_new", "month_lag >= 0"), ("", "TRUE"))


def _c4_rule(c, s):
    return _C4_AMOUNT.get(s, _C4_STATS[s][1]) if c == "purchase_amount" else _C4_STATS[s][1]


def _rounded_sql(expr, rule):
    return expr if rule is None else f"round({expr} + {rule[1]:.12f}::DOUBLE, {rule[0]})"


def _rounded_col(name, rule):
    return F.col(f"`{name}`") if rule is None else F.round(F.col(f"`{name}`") + rule[1], rule[0]).alias(name)


_C4_NAMES = [(f"{c}_{s}{seg}", _c4_rule(c, s)) for seg, _ in _C4_PARTS for c in ba.STAT_COLUMNS for s in ba.STATS]
_C4_NAMES += [(f"{c}_nunique{seg}", None) for seg, _ in _C4_PARTS for c in ba.ID_COLUMNS]
_C4_NAMES += [(f"card_id_{s}{seg}", None) for seg, _ in _C4_PARTS for s in ("size", "count")]
_C4_SQL = ("SELECT card_id," + ",".join(
    [f"CASE WHEN count(*) FILTER ({p}) > 0 THEN {_rounded_sql(_C4_STATS[s][0].format(c=c, p=p), _c4_rule(c, s))} END AS {c}_{s}{seg}"
     for seg, p in _C4_PARTS for c in ba.STAT_COLUMNS for s in ba.STATS]
    + [f"CASE WHEN count(*) FILTER ({p}) > 0 THEN count(DISTINCT {c}) FILTER ({p}) END AS {c}_nunique{seg}" for seg, p in _C4_PARTS for c in ba.ID_COLUMNS]
    + [f"CASE WHEN count(*) FILTER ({p}) > 0 THEN count(*) FILTER ({p}) END AS card_id_{s}{seg}" for seg, p in _C4_PARTS for s in ("size", "count")])
    + " FROM p2 GROUP BY card_id")


@query("c04_card_statistics", f"WITH {_PREPARED} {_C4_SQL}")
def _(t):
    return ba.card_statistics(_prepared(t, 2, _raw(t, _STAT_COLUMNS))).select("card_id", *[_rounded_col(n, rule) for n, rule in _C4_NAMES])


# ---- refined families --------------------------------------------------------

_ROWS = f"""
    crow AS (SELECT card_id, CASE authorized_flag WHEN 'Y' THEN 1 ELSE 0 END AS authorized_flag, CASE category_1 WHEN 'Y' THEN 1 ELSE 0 END AS category_1,
               CAST(coalesce(category_2, 1) AS DOUBLE) AS category_2, CASE coalesce(category_3, 'A') WHEN 'A' THEN 0 WHEN 'B' THEN 1 ELSE 2 END AS category_3,
               coalesce(merchant_id, -1) AS merchant_id, CASE WHEN installments IN (-1, 999) THEN NULL WHEN installments = 0 THEN 1 ELSE installments END AS installments,
               {AMOUNT} AS purchase_amount, purchase_date, CAST(purchase_date AS DATE) AS day, month_lag, month_lag >= 0 AS is_new, city_id, state_id,
               merchant_category_id, subsector_id, {ORDS}, CAST(month(purchase_date) AS INT) AS month, CAST(weekofyear(purchase_date) AS INT) AS weekofyear,
               CAST(hour(purchase_date) AS INT) AS hour, CAST(isodow(purchase_date) - 1 AS INT) AS dayofweek, CAST(year(purchase_date) AS INT) AS year,
               CASE WHEN isodow(purchase_date) >= 6 THEN 1 ELSE 0 END AS weekend,
               CAST(floor(date_diff('day', purchase_date, TIMESTAMP '{AS_OF}') / 30.0::DOUBLE) AS INT) + month_lag AS month_diff FROM txn),
    act AS (SELECT card_id, CAST(first_active_month AS DATE) AS active FROM cards)"""


def _rows(t):
    return pp.clean_transactions(t.txn.withColumn("is_new", F.col("month_lag") >= 0), -1)


_UNITS = {"d": "sr", "w": "sr // 7", "m": "sr // 30"}


def _decay_sql(suffix, amount="purchase_amount"):
    unit, rate = scalars.DECAYS[suffix]
    return f"{amount} * pow({rate}::DOUBLE, CAST({_UNITS[suffix[0]]} AS DOUBLE))"


@query("c05_expand_transactions", f"""
WITH {_ROWS}, g AS (SELECT card_id, max(day) AS m FROM crow GROUP BY card_id),
  x AS (SELECT crow.*, date_diff('day', active, day) AS sa, date_diff('day', day, m) AS sr,
          date_diff('day', lag(day) OVER (PARTITION BY crow.card_id ORDER BY {ORDER}), day) AS gap
        FROM crow JOIN g ON g.card_id = crow.card_id LEFT JOIN act ON act.card_id = crow.card_id)
SELECT card_id, {ORDS}, authorized_flag, category_1, category_2, purchase_amount, installments, category_3, merchant_id, month_lag, year, month, hour, weekofyear,
  dayofweek, weekend, CAST(sa AS INT) AS purchase_day_since_active_day,
  CAST(floor(sa / 30.0::DOUBLE) AS INT) AS purchase_month_since_active_day, CAST(floor(sa / 7.0::DOUBLE) AS INT) AS purchase_week_since_active_day,
  CAST(sr AS INT) AS purchase_day_since_reference_day, CAST(sr // 7 AS INT) AS purchase_week_since_reference_day,
  CAST(sr // 30 AS INT) AS purchase_month_since_reference_day, CAST(gap AS INT) AS purchase_day_diff,
  CAST(gap // 7 AS INT) AS purchase_week_diff, CAST(gap // 30 AS INT) AS purchase_month_diff, """ + ", ".join(
      f"round({_decay_sql(d)} + 0.00037::DOUBLE, 1) AS purchase_amount_{d}" for d in scalars.DECAYS) + " FROM x")
def _(t):
    df = pp.expand_transactions(t.txn, t.cards, ROW_ORDER, missing_merchant=-1)
    since = [f"purchase_{u}_since_{d}_day" for u in ("day", "week", "month") for d in ("active", "reference")]
    return df.select(*LINE, "authorized_flag", "category_1", "category_2", "purchase_amount", "installments", "category_3", "merchant_id", "month_lag",
                     "year", "month", "hour", "weekofyear", "dayofweek", "weekend", *since, *[f"purchase_{u}_diff" for u in ("day", "week", "month")],
                     *[F.round(F.col(f"purchase_amount_{d}") + 0.00037, 1).alias(f"purchase_amount_{d}") for d in scalars.DECAYS])


_BASE = (("auth_", "NOT is_new AND authorized_flag = 1"), ("hist_", "NOT is_new AND authorized_flag = 0"), ("new_", "is_new"))


# Column -> (value, digits of mean, deviation and skewness). The divided amounts are not whole numbers.
_BASE_VALUES = {"card_id": "card_id", "purchase_date": "purchase_date", "price": "purchase_amount / installments",
                "duration": "purchase_amount * month_diff", "amount_month_ratio": "purchase_amount / month_diff"}
_BASE_DIGITS = {"price": (1, 1, 4), "amount_month_ratio": (1, 1, 4), "duration": (1, 0, 4)}


def _base_stat(c, s):
    """(DuckDB text over ``{v}`` and ``{w}``, rule of rounding) of one statistic."""
    mean, std, skew = _BASE_DIGITS.get(c, (6, 6, 5))
    bound = "CAST(epoch({f}({v}) {w}) AS BIGINT)" if c == "purchase_date" else "{f}({v}) {w}"
    return {"mean": ("avg({v}) {w}", (mean, 0.0000371293)), "std": ("stddev_samp({v}) {w}", (std, 0.0000371293)),
            "skew": ("CASE WHEN min({v}) {w} < max({v}) {w} THEN skewness({v}) {w} END", (skew, 0.0)),
            "nunique": ("count(DISTINCT {v}) {w}", None), "size": ("count(*) {w}", None), "count": ("count({v}) {w}", None),
            "min": (bound.replace("{f}", "min"), (2, 0.000371293) if c == "amount_month_ratio" else None),
            "max": (bound.replace("{f}", "max"), (2, 0.000371293) if c == "amount_month_ratio" else None)}[s]


_BASE_NAMES = [(f"{seg}{c}_{s}", _base_stat(c, s)[1]) for seg, _ in _BASE for c, own in rf.BASE_SPEC.items() for s in own]
_BASE_NAMES += [(f"{seg}{c}_mean_mean", (2, 0.000371293)) for seg, _ in _BASE for c in rf.GROUP_MEANS]


def _base_sql(seg, p):
    w, out = f"FILTER ({p})", []
    for c, own in rf.BASE_SPEC.items():
        for s in own:
            text, rule = _base_stat(c, s)
            out.append((f"{seg}{c}_{s}", _rounded_sql(text.format(v=_BASE_VALUES.get(c, c), w=w), rule)))
    out += [(f"{seg}{c}_mean_mean", _rounded_sql(f"avg(m_{c}_{seg}) {w}", (2, 0.000371293))) for c in rf.GROUP_MEANS]
    return [f"CASE WHEN count(*) {w} > 0 THEN {expr} END AS {n}" for n, expr in out]


_BASE_SQL = f"WITH {_ROWS}, y AS (SELECT *, " + ", ".join(
    f"avg(purchase_amount) FILTER ({p}) OVER (PARTITION BY {c}) AS m_{c}_{s}" for s, p in _BASE for c in rf.GROUP_MEANS) + " FROM crow) SELECT card_id, " + ",".join(
    x for s, p in _BASE for x in _base_sql(s, p)) + " FROM y GROUP BY card_id"


@query("c06_base_statistics", _BASE_SQL)
def _(t):
    df = rf.base_statistics(rf.staged_rows(_rows(t), rf.BASE_COLUMNS, t.txn_sizes), AS_OF)
    return df.select("card_id", *[_rounded_col(n, rule) for n, rule in _BASE_NAMES])


_SEGS = (("auth_cardf_", "NOT is_new AND authorized_flag = 1"), ("hist_cardf_", "NOT is_new"), ("new_cardf_", "is_new"))


def _div(a, b):
    return (f"CASE WHEN {b} = 0 THEN CASE WHEN {a} > 0 THEN CAST('Infinity' AS DOUBLE) WHEN {a} < 0 THEN CAST('-Infinity' AS DOUBLE) END "
            f"ELSE CAST({a} AS DOUBLE) / {b} END")


_DAY_OF = {"purchase_date_floorday": "day"}


def _profile_stats(seg, p):
    """(name, DuckDB text, rule of rounding) of the columns of one profile family, but for its day bounds."""
    w, recent = f"FILTER ({p})", seg == "hist_last2_"
    ranked = f"list_sort(list(purchase_amount) {w})"

    def at(x):
        return f"{ranked}[CAST(floor(count(*) {w} * {x}::DOUBLE) AS BIGINT) + 1]"

    cols = [("card_id_cnt", f"count(authorized_flag) {w}", None), ("month_diff_mean", f"avg(month_diff) {w}", (6, 0.0000371293)),
            ("card_id_purchase_amount_sum", f"sum(purchase_amount) {w}", None), ("card_id_purchase_amount_mean", f"avg(purchase_amount) {w}", None),
            ("card_id_purchase_amount_std", f"stddev_samp(purchase_amount) {w}", (1, 0.00371293)),
            ("card_id_purchase_amount_median", f"median(purchase_amount) {w}", None)]
    if seg in ("hist_cardf_", "hist_last2_"):
        cols += [("card_id_isau_mean", f"CAST(avg(authorized_flag) {w} AS DOUBLE)", None), ("card_id_isau_sum", f"CAST(sum(authorized_flag) {w} AS DOUBLE)", None)]
    for d in (rf.RECENT_DISTINCT if recent else rf.PROFILE_DISTINCT):
        n = f"count(DISTINCT {_DAY_OF.get(d, d)}) {w}"
        cols += [(f"card_id_{d}_nunique", n, None), (f"card_id_cnt_divide_{d}_nunique", _div(f"count(authorized_flag) {w}", n), None)]
    cols += [(f"card_id_purchase_amount_{d}_sum", f"coalesce(sum({_decay_sql(d)}) {w}, 0)", (0, 0.371293))
             for d in (rf.RECENT_DECAYS if recent else scalars.DECAYS)]
    if not recent:
        cols += [("card_id_installments_sum", f"CAST(coalesce(sum(installments) {w}, 0) AS DOUBLE)", None),
                 ("card_id_purchase_amount_max", f"max(purchase_amount) {w}", None), ("card_id_purchase_amount_min", f"min(purchase_amount) {w}", None),
                 ("card_id_purchase_amount_range", f"max(purchase_amount) {w} - min(purchase_amount) {w}", None),
                 ("month_diff_median", f"CAST(median(month_diff) {w} AS DOUBLE)", None),
                 ("purchase_amount_25_quantile", at(0.25), None), ("purchase_amount_75_quantile", at(0.75), None),
                 ("card_id_purchase_amount_range2", f"{at(0.975)} - {at(0.025)}", None)]
    return [(seg + n, expr, rule) for n, expr, rule in cols]


def _profile_sql(segments):
    return ", ".join(f"CASE WHEN count(*) FILTER ({p}) > 0 THEN {_rounded_sql(expr, rule)} END AS {n}" for s, p in segments for n, expr, rule in _profile_stats(s, p))


_REF = "ref AS (SELECT crow.*, active, date_diff('day', day, max(day) OVER (PARTITION BY crow.card_id, is_new)) AS sr FROM crow LEFT JOIN act ON act.card_id = crow.card_id)"
_RECENT = (("hist_last2_", "NOT is_new AND month_lag >= -2"),)


def _profile(t):
    # pivots have entries of their own, in long form
    return rf.card_profile(rf.staged_rows(_rows(t), sizes=t.txn_sizes), t.cards, AS_OF, "2002-01-01", "2002-03-01", features=[])


_PROFILE_SQL = f"WITH {_ROWS}, {_REF} SELECT card_id, {_profile_sql(_SEGS)} FROM ref GROUP BY card_id"
_RECENT_SQL = f"WITH {_ROWS}, {_REF} SELECT card_id, {_profile_sql(_RECENT)} FROM ref GROUP BY card_id"


@query("c07_card_profile", _PROFILE_SQL)
def _(t):
    return _profile(t).select("card_id", *[_rounded_col(n, rule) for s, p in _SEGS for n, _, rule in _profile_stats(s, p)])


def _pivot_sql(segments):
    def text(c):
        return f"printf('%.1f', {c})" if c == "category_2" else f"CAST({c} AS VARCHAR)"

    parts = []
    for seg, p in segments:
        w = f"FILTER ({p})"
        for c in rf.PIVOTS:
            named = f"replace({text(c)}, '.', '_')"
            parts.append(f"SELECT card_id, '{seg}{c}_cnt_pivot_' || {named} AS feature, CAST(count(merchant_id) {w} AS DOUBLE) AS v FROM ref WHERE {c} IS NOT NULL "
                         f"GROUP BY card_id, {c} HAVING count(*) {w} > 0")
        for c in rf.SHARE_PIVOTS:
            named = f"replace({text('r.' + c) if c != 'category_2' else text(c)}, '.', '_')"
            parts.append(f"SELECT r.card_id, '{seg}{c}_day_nunique_pct_' || {named} AS feature, CAST(count(DISTINCT day) {w} AS DOUBLE) / any_value(d_{seg}) AS v "
                         f"FROM ref r JOIN days ON days.card_id = r.card_id WHERE r.{c} IS NOT NULL GROUP BY r.card_id, r.{c} HAVING count(*) {w} > 0")
    days = "days AS (SELECT card_id, " + ", ".join(f"count(DISTINCT day) FILTER ({p}) AS d_{seg}" for seg, p in segments) + " FROM ref GROUP BY card_id)"
    return f"WITH {_ROWS}, {_REF}, {days} " + " UNION ALL ".join(parts)


@query("c07_pivot_features", _pivot_sql((*_SEGS, *_RECENT)))
def _(t):
    # every value that the data have, of all four families, without a limit on their number
    rows = rf.staged_rows(_rows(t), rf.PIVOT_COLUMNS, t.txn_sizes)
    rollup = pv.value_rollup(rows, "card_id", rf.PIVOTS, "merchant_id", "purchase_date_floorday", rf.PROFILE_SEGMENTS)
    return pv.pivot_features(rollup, "card_id", list(rf.PROFILE_SEGMENTS), rf.SHARE_PIVOTS)


@query("c07_card_lifecycle", f"""
WITH {_ROWS}, {_REF}, g AS (SELECT card_id, any_value(active) AS active, min(day) FILTER (NOT is_new) AS hf, max(day) FILTER (NOT is_new) AS hl, min(day) FILTER (is_new) AS nf,
  max(day) FILTER (is_new) AS nl, count(*) FILTER (NOT is_new) AS hn, count(*) FILTER (is_new) AS nn, CAST(avg(authorized_flag) FILTER (NOT is_new) AS DOUBLE) AS am,
  CAST(sum(authorized_flag) FILTER (NOT is_new) AS DOUBLE) AS asum, min(month_lag) FILTER (NOT is_new) AS mmin, max(month_lag) FILTER (is_new) AS mmax,
  count(authorized_flag) FILTER (is_new AND day < active) AS pn, sum(purchase_amount) FILTER (is_new AND day < active) AS ps, avg(purchase_amount) FILTER (is_new AND day < active) AS pm,
  sum(purchase_amount) FILTER (is_new) AS ns FROM ref GROUP BY card_id)
SELECT card_id, am AS hist_cardf_card_id_isau_mean, asum AS hist_cardf_card_id_isau_sum,
  CAST(date_diff('day', active, hf) AS INT) AS hist_cardf_first_to_activation_day, CAST(date_diff('day', active, hl) AS INT) AS hist_cardf_activation_to_reference_day,
  CAST(date_diff('day', hf, hl) AS INT) AS hist_cardf_first_to_reference_day, CAST(date_diff('day', hl, DATE '2002-01-01') AS INT) AS hist_cardf_reference_day_to_now,
  CAST(date_diff('day', hf, DATE '2002-01-01') AS INT) AS hist_cardf_first_day_to_now, mmin AS hist_cardf_card_id_month_lag_min,
  CASE WHEN hn > 0 THEN CASE WHEN date_diff('day', active, hf) < 0 THEN 1 ELSE 0 END END AS hist_cardf_is_purchase_before_activation,
  date_diff('day', hf, hl) / (date_diff('day', active, hl) + 0.01::DOUBLE) AS hist_cardf_first_to_reference_day_divide_activation_to_reference_day,
  CASE WHEN hn > 0 THEN date_diff('day', hf, hl) / CAST(hn AS DOUBLE) END AS hist_cardf_days_per_count,
  CAST(date_diff('day', hl, nf) AS INT) AS new_cardf_reference_day_to_first_day, CAST(date_diff('day', hl, nl) AS INT) AS new_cardf_reference_day_to_last_day,
  CAST(date_diff('day', nf, nl) AS INT) AS new_cardf_first_to_last_day, CAST(date_diff('day', active, nf) AS INT) AS new_cardf_activation_to_first_day,
  CAST(date_diff('day', active, nl) AS INT) AS new_cardf_activation_to_last_day, CASE WHEN nn > 0 THEN CAST(date_diff('day', hl, DATE '2002-03-01') AS INT) END AS new_cardf_reference_day_to_now,
  CAST(date_diff('day', nf, DATE '2002-03-01') AS INT) AS new_cardf_first_day_to_now, mmax AS new_cardf_card_id_month_lag_max,
  date_diff('day', nf, nl) / (date_diff('day', hl, nl) + 0.01::DOUBLE) AS new_cardf_first_to_last_day_divide_reference_to_last_day,
  CASE WHEN nn > 0 THEN date_diff('day', nf, nl) / CAST(nn AS DOUBLE) END AS new_cardf_days_per_count,
  CASE WHEN pn > 0 THEN pn END AS new_cardf_card_id_part_cnt, ps AS new_cardf_card_id_part_purchase_amount_sum, pm AS new_cardf_card_id_part_purchase_amount_mean,
  ps / (ns + 0.01::DOUBLE) AS new_cardf_card_id_part_purchase_amount_sum_percent FROM g""")
def _(t):
    names = ["card_id_isau_mean", "card_id_isau_sum", "first_to_activation_day", "activation_to_reference_day", "first_to_reference_day",
             "reference_day_to_now", "first_day_to_now", "card_id_month_lag_min", "is_purchase_before_activation",
             "first_to_reference_day_divide_activation_to_reference_day", "days_per_count"]
    new = ["reference_day_to_first_day", "reference_day_to_last_day", "first_to_last_day", "activation_to_first_day", "activation_to_last_day",
           "reference_day_to_now", "first_day_to_now", "card_id_month_lag_max", "first_to_last_day_divide_reference_to_last_day", "days_per_count",
           "card_id_part_cnt", "card_id_part_purchase_amount_sum", "card_id_part_purchase_amount_mean", "card_id_part_purchase_amount_sum_percent"]
    return _profile(t).select("card_id", *[f"hist_cardf_{n}" for n in names], *[f"new_cardf_{n}" for n in new])


@query("c08_recent_profile", _RECENT_SQL)
def _(t):
    return _profile(t).select("card_id", *[_rounded_col(n, rule) for s, p in _RECENT for n, _, rule in _profile_stats(s, p)])


def _levels_sql():
    parts = []
    sel = {"purchase_date_floorday": "day"}
    for lv, c in rf.LEVEL_PAIRS:
        parts.append((f"{lv}_{c}_nunique", sel.get(lv, lv), f"count(DISTINCT {sel.get(c, c)})"))
    for lv in rf.LEVELS:
        parts.append((f"{lv}_count", sel.get(lv, lv), "count(merchant_id)"))
        parts.append((f"{lv}_purchase_amount_sum", sel.get(lv, lv), "sum(purchase_amount)"))
    tables, cols = [], []
    for i, (name, lv, expr) in enumerate(parts):
        tables.append(f"l{i} AS (SELECT card_id, avg(v) AS a, max(v) AS m, stddev_samp(v) AS s FROM (SELECT card_id, {lv}, {expr} AS v FROM crow WHERE NOT is_new GROUP BY card_id, {lv}) GROUP BY card_id)")
        big = name.endswith("_sum")
        cols.append(f"{f'l{i}.a' if big else f'round(l{i}.a, 9)'} AS hist_levelAB_{name}_mean, l{i}.m AS hist_levelAB_{name}_max, round(l{i}.s, {0 if big else 6}) AS hist_levelAB_{name}_std")
    joins = " ".join(f"JOIN l{i} ON l{i}.card_id = l0.card_id" for i in range(1, len(parts)))
    return f"WITH {_ROWS}, " + ", ".join(tables) + " SELECT l0.card_id, " + ", ".join(cols) + f" FROM l0 {joins}"


def _level_col(c):
    if c.endswith("_mean"):
        # means of whole-number sums are exact
        return F.col(c) if "_amount_sum" in c else F.round(c, 9).alias(c)
    if c.endswith("_std"):
        return F.round(c, 0 if "_amount_sum" in c else 6).alias(c)
    return F.col(c)


@query("c09_two_level_features", _levels_sql())
def _(t):
    df = rf.two_level_features(_rows(t))
    return df.select("card_id", *[_level_col(c) for c in df.columns if c != "card_id"])


@query("c10_card_attributes", """
SELECT card_id, coalesce(CAST(year(first_active_month) AS INT), 0) AS year, CAST(date_diff('day', CAST(first_active_month AS DATE), DATE '2002-01-01') AS INT) AS elapsed_time,
  CAST(weekofyear(first_active_month) AS INT) AS weekofyear, CAST(dayofyear(first_active_month) AS INT) AS dayofyear, CAST(month(first_active_month) AS INT) AS month FROM cards""")
def _(t):
    return rf.card_attributes(t.cards, "2002-01-01").select("card_id", "year", "elapsed_time", "weekofyear", "dayofyear", "month")


_FEATURES = ("feature_1", "feature_2", "feature_3")
# Column -> (DuckDB text over v, rule of rounding).
_RATIOS = {
    "outliers": ("outliers", None), **{f"{f}_outliers_mean": (f"e{i}.m", None) for i, f in enumerate(_FEATURES, 1)},
    **{f"days_feature{i}": (f"CAST(elapsed * v.{f} AS INT)", None) for i, f in enumerate(_FEATURES, 1)},
    **{f"days_feature{i}_ratio": (_div(f"v.{f}", "elapsed"), None) for i, f in enumerate(_FEATURES, 1)},
    "feature_sum": ("CAST(f1 + f2 + f3 AS DOUBLE)", None), "feature_mean": ("(f1 + f2 + f3) / 3.0::DOUBLE", None),
    "feature_max": ("greatest(f1, f2, f3)", None), "feature_min": ("least(f1, f2, f3)", None),
    "feature_var": ("sqrt((pow(f1 - fm, 2) + pow(f2 - fm, 2) + pow(f3 - fm, 2)) / 2)", (9, 0.0)),
    "card_id_total": ("hs + ns", None), "card_id_cnt_total": ("hs + ns", None), "card_id_cnt_ratio": (_div("ns", "hs"), None),
    "purchase_amount_total": ("ha + na", None), "purchase_amount_ratio": (_div("na", "ha"), None), "month_diff_ratio": (_div("nm", "hm"), (9, 0.0)),
    "installments_total": ("CAST(ni + ai AS DOUBLE)", None), "installments_ratio": (_div("ni", "ai"), None),
    "new_CLV": (_div("(ns * na)", "nm"), (1, 0.0)), "hist_CLV": (_div("(hs * ha)", "hm"), (1, 0.0)),
    "price_total": (_div("(ha + na)", "(ni + ai)"), None), "CLV_ratio": (_div(f"({_div('(ns * na)', 'nm')})", f"({_div('(hs * ha)', 'hm')})"), (9, 0.0))}


def _present(p, expr):
    return f"CASE WHEN count(*) FILTER ({p}) > 0 THEN {expr} END"


_RATIO_SQL = f"""
WITH {_ROWS}, g AS (SELECT card_id, {_present("NOT is_new AND authorized_flag = 0", "count(*) FILTER (NOT is_new AND authorized_flag = 0)")} AS hs,
  {_present("is_new", "count(*) FILTER (is_new)")} AS ns, sum(purchase_amount) FILTER (NOT is_new) AS ha, sum(purchase_amount) FILTER (is_new) AS na,
  avg(month_diff) FILTER (NOT is_new) AS hm, avg(month_diff) FILTER (is_new) AS nm,
  {_present("is_new", "coalesce(sum(installments) FILTER (is_new), 0)")} AS ni,
  {_present("NOT is_new AND authorized_flag = 1", "coalesce(sum(installments) FILTER (NOT is_new AND authorized_flag = 1), 0)")} AS ai FROM crow GROUP BY card_id),
  v AS (SELECT c.card_id, feature_1, feature_2, feature_3, CASE WHEN target < -900 THEN 1 ELSE 0 END AS outliers, hs, ns, ha, na, hm, nm, ni, ai,
    CAST(feature_1 AS DOUBLE) AS f1, CAST(feature_2 AS DOUBLE) AS f2, CAST(feature_3 AS DOUBLE) AS f3, (feature_1 + feature_2 + feature_3) / 3.0::DOUBLE AS fm,
    date_diff('day', active, DATE '2002-01-01') AS elapsed FROM cards c LEFT JOIN g ON g.card_id = c.card_id LEFT JOIN act ON act.card_id = c.card_id),
  """ + ", ".join(f"e{i} AS (SELECT {f}, avg(CASE WHEN target < -900 THEN 1 ELSE 0 END) AS m FROM cards WHERE split = 'train' GROUP BY 1)" for i, f in enumerate(_FEATURES, 1)) + """
SELECT card_id, """ + ", ".join(f"{_rounded_sql(expr, rule)} AS {n}" for n, (expr, rule) in _RATIOS.items()) + " FROM v " + " ".join(
    f"LEFT JOIN e{i} ON e{i}.{f} = v.{f}" for i, f in enumerate(_FEATURES, 1))


def _refined(t):
    return rf.refined_features(t.cards, _rows(t), AS_OF, "2002-01-01", -900.0, new_now="2002-03-01", sizes=t.txn_sizes)


@query("c11_final_ratios", _RATIO_SQL)
def _(t):
    return _refined(t).select("card_id", *[_rounded_col(n, rule) for n, (_, rule) in _RATIOS.items()])


def _assembled_names():
    """The columns of the refined table but for its pivots, as expressions that round like the SQL of the families."""
    out = {n: _rounded_col(n, rule) for n, rule in _BASE_NAMES}
    out |= {n: _rounded_col(n, rule) for s, p in (*_SEGS, *_RECENT) for n, _, rule in _profile_stats(s, p)}
    out |= {n: _rounded_col(n, rule) for n, (_, rule) in _RATIOS.items()}
    out |= {n: F.col(n) for n in (*_LIFECYCLE, "year", "elapsed_time", "weekofyear", "dayofyear", "month", *_FEATURES)}
    return {n: c for n, c in out.items() if not pruned_by_name(n)}


_LIFECYCLE = [f"hist_cardf_{n}" for n in (
    "first_to_activation_day", "activation_to_reference_day", "first_to_reference_day", "reference_day_to_now", "first_day_to_now", "card_id_month_lag_min",
    "is_purchase_before_activation", "first_to_reference_day_divide_activation_to_reference_day", "days_per_count")] + [f"new_cardf_{n}" for n in (
        "reference_day_to_first_day", "reference_day_to_last_day", "first_to_last_day", "activation_to_first_day", "activation_to_last_day",
        "reference_day_to_now", "first_day_to_now", "card_id_month_lag_max", "first_to_last_day_divide_reference_to_last_day", "days_per_count",
        "card_id_part_cnt", "card_id_part_purchase_amount_sum", "card_id_part_purchase_amount_mean", "card_id_part_purchase_amount_sum_percent")]


def _assembled_sql():
    parts = [ORACLES[n] for n in ("c06_base_statistics", "c07_card_profile", "c07_card_lifecycle", "c08_recent_profile", "c09_two_level_features",
                                  "c10_card_attributes", "c11_final_ratios")]
    profile = [n for s, p in (*_SEGS, *_RECENT) for n, _, _ in _profile_stats(s, p)]
    names = [n for n in [*[n for n, _ in _BASE_NAMES], *profile, *_RATIOS, *_LIFECYCLE, "year", "elapsed_time", "weekofyear", "dayofyear", "month", *_FEATURES]
             if not pruned_by_name(n)]
    of = {**{n: "t0" for n, _ in _BASE_NAMES}, **{n: "t1" for n in profile if not n.startswith("hist_last2_")},
          **{n: "t3" for n in profile if n.startswith("hist_last2_")}, **{n: "t2" for n in _LIFECYCLE}, **{n: "t6" for n in _RATIOS},
          **{n: "t5" for n in ("year", "elapsed_time", "weekofyear", "dayofyear", "month")}, **{n: "c" for n in _FEATURES}}
    joins = " ".join(f"LEFT JOIN ({q}) t{i} ON t{i}.card_id = c.card_id" for i, q in enumerate(parts))
    return f"SELECT c.card_id, c.target, c.split, {', '.join(f'{of[n]}.{n} AS {n}' for n in names)}, t4.* EXCLUDE (card_id) FROM cards c {joins}"


@query("c12_assemble_refined", _assembled_sql())
def _(t):
    df, names = _refined(t), _assembled_names()
    return df.select("card_id", "target", "split", *names.values(), *[_level_col(c) for c in df.columns if c.startswith("hist_levelAB_")])


# Category -> its codes, of those that have few.
_CROSSED = {"authorized_flag": range(2), "category_1": range(2), "category_3": range(4), "purchase_day": range(2), "purchase_hour_section": range(1)}
_CROSS_NAMES = [(c, v, n) for c, codes in _CROSSED.items() for v in codes for n in ba.CROSS_NUMBERS]


@query("c12_assemble_baseline", f"""
WITH {_PREPARED}, s AS ({_C4_SQL}), x AS (SELECT card_id, """ + ", ".join(
    f"round(coalesce(sum({n}) FILTER ({c} = {v}), 0) + 0.000371293::DOUBLE, 3) AS \"{c}&{v}&{n}\"" for c, v, n in _CROSS_NAMES) + """ FROM pt GROUP BY card_id)
SELECT c.card_id, feature_1, feature_2, feature_3, coalesce(target, 0) AS target, split, """ + ", ".join(
    [f"coalesce(x.\"{c}&{v}&{n}\", 0) AS \"{c}&{v}&{n}\"" for c, v, n in _CROSS_NAMES]
    + [f"coalesce(s.{n}, 0) AS {n}" for n, _ in _C4_NAMES]) + """
FROM cards c LEFT JOIN s ON s.card_id = c.card_id LEFT JOIN x ON x.card_id = c.card_id""")
def _(t):
    names = [f"{c}&{v}&{n}" for c, v, n in _CROSS_NAMES]
    # both plans read one staged table
    rows = _raw(t, _STAT_COLUMNS)
    cross = ba.cross_features(_prepared(t, 1, rows), t.cards)
    df = ba.assemble(t.cards, cross, ba.card_statistics(_prepared(t, 2, rows)), names=names)
    return df.select("card_id", "feature_1", "feature_2", "feature_3", "target", "split", *[_rounded_col(n, (3, 0.000371293)) for n in names],
                     *[_rounded_col(n, rule) for n, rule in _C4_NAMES])
