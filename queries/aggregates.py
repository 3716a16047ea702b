"""Aggregations A1-A15 and A26-A29."""

from pyspark.sql import functions as F

from cardloom.operators import aggregate as ag, quantile as qt, sketches as sk, states as st

from cardloom.operators.skew import keyed_join
from cardloom.session import staged

from cardloom.sources.fixtures import ROW_ORDER

from .registry import query

HIST, NEW = "month_lag < 0", "month_lag >= 0"


def r(c, digits=4):
    return F.round(c, digits)


@query("a01_group_statistics", """
SELECT card_id, count(installments) AS h_installments_count, round(avg(installments), 6) AS h_installments_mean,
       min(purchase_amount) AS h_purchase_amount_min, max(purchase_amount) AS h_purchase_amount_max,
       round(sum(purchase_amount), 5) AS h_purchase_amount_sum,
       count(DISTINCT merchant_id) AS h_merchant_id_nunique
FROM txn GROUP BY card_id""")
def _(t):
    df = ag.agg_spec(t.txn, "card_id", {"installments": ["count", "mean"], "purchase_amount": ["min", "max", "sum"],
                                        "merchant_id": ["nunique"]}, prefix="h_")
    return (df.withColumn("h_installments_mean", r("h_installments_mean", 6))
            .withColumn("h_purchase_amount_sum", r("h_purchase_amount_sum", 5)))


@query("a02_size_and_count", """
SELECT card_id, count(*) AS merchant_id_size, count(merchant_id) AS merchant_id_count FROM txn GROUP BY card_id""")
def _(t):
    return ag.agg_spec(t.txn, "card_id", {"merchant_id": ["size", "count"]})


@query("a03_distinct_counts", """
SELECT card_id, count(DISTINCT merchant_id) AS merchant_id_nunique,
       count(DISTINCT category_2) AS category_2_nunique, count(DISTINCT city_id) AS city_id_nunique,
       count(DISTINCT purchase_amount) AS purchase_amount_nunique,
       count(DISTINCT state_id) AS state_id_nunique
FROM txn GROUP BY card_id""")
def _(t):
    # state_id and city_id have a fixed range: counted as bit masks
    return ag.agg_spec(t.txn, "card_id", {c: ["nunique"] for c in (
        "merchant_id", "category_2", "city_id", "purchase_amount", "state_id")},
        domains={"state_id": (0, 4), "city_id": (0, 24)})


@query("a04_sum_mean_min_max", """
SELECT card_id, sum(amount_units) AS amount_units_sum, avg(amount_units) AS amount_units_mean,
       min(amount_units) AS amount_units_min, max(amount_units) AS amount_units_max,
       CAST(coalesce(sum(category_2), 0) AS DOUBLE) AS category_2_sum
FROM txn GROUP BY card_id""")
def _(t):
    return ag.agg_spec(t.txn, "card_id", {"amount_units": ["sum", "mean", "min", "max"], "category_2": ["sum"]})


@query("a05_sample_deviation", """
SELECT card_id, round(var_samp(installments), 4) AS installments_var, round(stddev_samp(purchase_amount), 4) AS purchase_amount_std
FROM txn GROUP BY card_id""")
def _(t):
    df = ag.agg_spec(t.txn, "card_id", {"installments": ["var"], "purchase_amount": ["std"]})
    return df.select("card_id", r("installments_var").alias("installments_var"),
                     r("purchase_amount_std").alias("purchase_amount_std"))


@query("a06_skewness", """
SELECT card_id, round(skewness(purchase_amount), 6) AS purchase_amount_skew,
       CASE WHEN count(category_2) > 2 AND min(category_2) < max(category_2) THEN round(skewness(category_2), 6) END AS category_2_skew
FROM txn GROUP BY card_id""")
def _(t):
    df = ag.agg_spec(t.txn, "card_id", {"purchase_amount": ["skew"], "category_2": ["skew"]})
    return df.select("card_id", r("purchase_amount_skew", 6).alias("purchase_amount_skew"),
                     r("category_2_skew", 6).alias("category_2_skew"))


@query("a07_exact_median", """
SELECT card_id, median(purchase_amount) AS purchase_amount_median, CAST(median(month_lag) AS DOUBLE) AS month_lag_median
FROM txn GROUP BY card_id""")
def _(t):
    return qt.median(t.txn, "card_id", "purchase_amount", "purchase_amount_median").join(
        qt.median(t.txn, "card_id", "month_lag", "month_lag_median"), "card_id")


@query("a08_element_quantiles", """
WITH s AS (SELECT card_id, list_sort(list(purchase_amount)) AS v, count(*) AS n FROM txn GROUP BY card_id)
SELECT card_id, v[CAST(floor(n * 0.025::DOUBLE) AS BIGINT) + 1] AS q025, v[CAST(floor(n * 0.25::DOUBLE) AS BIGINT) + 1] AS q25,
       v[CAST(floor(n * 0.75::DOUBLE) AS BIGINT) + 1] AS q75, v[CAST(floor(n * 0.975::DOUBLE) AS BIGINT) + 1] AS q975, v[n] AS q100
FROM s""")
def _(t):
    return qt.element_quantile(t.txn, "card_id", "purchase_amount",
                               {"q025": 0.025, "q25": 0.25, "q75": 0.75, "q975": 0.975, "q100": 1})


@query("a08_sketched_quantiles", """
WITH s AS (SELECT category_1, list_sort(list(purchase_amount)) AS v, count(*) AS n FROM txn GROUP BY category_1)
SELECT category_1, v[CAST(floor(n * 0.25::DOUBLE) AS BIGINT) + 1] AS q25, v[CAST(floor(n * 0.5::DOUBLE) AS BIGINT) + 1] AS q50,
       v[CAST(floor(n * 0.975::DOUBLE) AS BIGINT) + 1] AS q975, TRUE AS q25_near, TRUE AS q50_near, TRUE AS q975_near
FROM s""")
def _(t):
    # the exact values, and whether those of sketches folded by month and merged lie within the bound of their ranks
    points = {"q25": 0.25, "q50": 0.5, "q975": 0.975}
    rows = staged(t.txn.select("category_1", "month_lag", "purchase_amount"))
    exact = qt.element_quantile(rows, "category_1", "purchase_amount", points)
    states = staged(sk.fold_sketches(rows, ["category_1", "month_lag"], ["purchase_amount"]))
    near = sk.quantiles(states, "category_1", "purchase_amount", {f"_{n}": p for n, p in points.items()}, {"": None})
    ranks = rows.join(near, "category_1").groupBy("category_1").agg(*[
        (F.abs(F.avg((F.col("purchase_amount") <= F.col(f"_{n}")).cast("int")) - p) <= sk.rank_error()).alias(f"{n}_near") for n, p in points.items()])
    return exact.join(ranks, "category_1")


@query("a09_ranges", """
WITH s AS (SELECT card_id, list_sort(list(purchase_amount)) AS v, count(*) AS n FROM txn GROUP BY card_id)
SELECT card_id, round(v[n] - v[1], 4) AS amount_range,
       round(v[CAST(floor(n * 0.975::DOUBLE) AS BIGINT) + 1] - v[CAST(floor(n * 0.025::DOUBLE) AS BIGINT) + 1], 4) AS amount_range2
FROM s""")
def _(t):
    ends = t.txn.groupBy("card_id").agg((F.max("purchase_amount") - F.min("purchase_amount")).alias("_r"))
    q = qt.element_quantile(t.txn, "card_id", "purchase_amount", {"a": 0.025, "b": 0.975})
    return ends.join(q, "card_id").select("card_id", r("_r").alias("amount_range"),
                                          r(F.col("b") - F.col("a")).alias("amount_range2"))


@query("a10_rows_per_distinct", """
SELECT card_id,
       CASE WHEN count(DISTINCT category_3) = 0 THEN CAST('Infinity' AS DOUBLE)
            ELSE CAST(count(authorized_flag) AS DOUBLE) / count(DISTINCT category_3) END AS card_id_cnt_divide_category_3_nunique,
       CASE WHEN count(DISTINCT merchant_id) = 0 THEN CAST('Infinity' AS DOUBLE)
            ELSE CAST(count(authorized_flag) AS DOUBLE) / count(DISTINCT merchant_id) END AS card_id_cnt_divide_merchant_id_nunique
FROM txn GROUP BY card_id""")
def _(t):
    return ag.count_per_distinct(t.txn, "card_id", "authorized_flag", ["category_3", "merchant_id"])


@query("a11_latest_row", """
SELECT card_id, max(purchase_date) AS purchase_date,
       max(purchase_amount ORDER BY purchase_amount) AS top_amount
FROM (SELECT *, max(purchase_date) OVER (PARTITION BY card_id) AS m FROM txn) WHERE purchase_date = m GROUP BY card_id""")
def _(t):
    return ag.latest(t.txn, "card_id", ["purchase_date", "purchase_amount"]).withColumnRenamed("purchase_amount", "top_amount")


def _two_level_sql(level, value, inner, name):
    digits = 0 if inner == "sum" else 4
    expr = {"nunique": f"count(DISTINCT {value})", "count": f"count({value})", "sum": f"coalesce(sum({value}), 0)"}[inner]
    return f"""
SELECT card_id, round(avg(v), {2 if inner == 'sum' else 6}) AS {name}_mean, max(v) AS {name}_max,
       round(stddev_samp(v), {digits}) AS {name}_std
FROM (SELECT card_id, {level} AS lv, {expr} AS v FROM txn WHERE {level} IS NOT NULL GROUP BY card_id, {level}) GROUP BY card_id"""


def _two_level_query(level, value, inner, tag):
    name = ag.two_level_name(level, value, inner)

    @query(f"a12_two_level_{tag}", _two_level_sql(level, value, inner, name))
    def _(t):
        df = ag.two_level(t.txn, "card_id", level, value, inner)
        return df.select("card_id", r(f"{name}_mean", 2 if inner == "sum" else 6).alias(f"{name}_mean"), f"{name}_max",
                         r(f"{name}_std", 0 if inner == "sum" else 4).alias(f"{name}_std"))


_two_level_query("month_lag", "merchant_id", "nunique", "nunique")
_two_level_query("subsector_id", "merchant_id", "count", "count")
_two_level_query("city_id", "amount_units", "sum", "sum")


@query("a26_distinct_keys", "SELECT DISTINCT card_id FROM txn")
def _(t):
    return t.txn.select("card_id").distinct()


_SEG_STATS = """
       CASE WHEN count(*) FILTER ({p}) > 0 THEN coalesce(sum(amount_units) FILTER ({p}), 0) END AS amount_units_sum{s},
       avg(amount_units) FILTER ({p}) AS amount_units_mean{s},
       round(stddev_samp(amount_units) FILTER ({p}), 0) AS amount_units_std{s},
       CASE WHEN count(*) FILTER ({p}) > 0 THEN count(DISTINCT merchant_id) FILTER ({p}) END AS merchant_id_nunique{s},
       CASE WHEN count(*) FILTER ({p}) > 0 THEN count(*) FILTER ({p}) END AS merchant_id_size{s}"""


@query("a27_segment_statistics", "SELECT card_id," + ",".join(
    _SEG_STATS.format(p=p, s=s) for s, p in (("_hist", HIST), ("_new", NEW), ("", "TRUE")))
    + " FROM txn GROUP BY card_id")
def _(t):
    df = ag.segmented_agg(t.txn, "card_id", {"amount_units": ["sum", "mean", "std"], "merchant_id": ["nunique", "size"]},
                          {"_hist": HIST, "_new": NEW, "": None})
    return df.select("card_id", *[(r(c, 0) if "_std" in c else F.col(c)).alias(c) for c in df.columns[1:]])


@query("a29_share_before_activation", """
SELECT t.card_id,
       CASE WHEN count(*) FILTER (p) > 0 THEN count(authorized_flag) FILTER (p) END AS part_cnt,
       CASE WHEN count(*) FILTER (p) > 0 THEN sum(amount_units) FILTER (p) END AS part_amount_units_sum,
       avg(amount_units) FILTER (p) AS part_amount_units_mean,
       CASE WHEN count(*) FILTER (p) > 0 THEN sum(amount_units) FILTER (p) END / (sum(amount_units) + 0.01::DOUBLE) AS part_amount_units_sum_percent
FROM (SELECT x.*, coalesce(x.purchase_date < c.first_active_month, FALSE) AS p
      FROM txn x LEFT JOIN cards c ON c.card_id = x.card_id) t GROUP BY t.card_id""")
def _(t):
    rows = keyed_join(t.txn, t.cards.select("card_id", "first_active_month"), "card_id", row_id=ROW_ORDER)
    before = F.col("purchase_date") < F.col("first_active_month").cast("timestamp_ntz")
    return ag.part_share(rows, "card_id", before, "authorized_flag", "amount_units")


@query("j07_share_of_total", """
WITH s AS (SELECT card_id, category_3, count(DISTINCT purchase_date) AS part_n FROM txn WHERE category_3 IS NOT NULL GROUP BY 1, 2),
     g AS (SELECT card_id, count(DISTINCT purchase_date) AS total_n FROM txn GROUP BY 1)
SELECT s.card_id, s.category_3, part_n, total_n, CAST(part_n AS DOUBLE) / total_n AS share FROM s JOIN g ON g.card_id = s.card_id""")
def _(t):
    return ag.share_of_total(t.txn, "card_id", "category_3", "purchase_date")
_MERGED = {"amount_units": ("sum", "mean", "std", "skew", "min", "max", "count"), "installments": ("mean", "var", "sum")}


@query("a27_merged_states", "SELECT card_id, " + ", ".join(
    [f"CASE WHEN count(*) FILTER ({p}) > 0 THEN {e.format(w=f'FILTER ({p})')} END AS {c}{seg}" for seg, p in (("_hist", "month_lag < 0"), ("_new", "month_lag >= 0"), ("", "TRUE")) for c, e in (
        ("amount_units_sum", "coalesce(sum(amount_units) {w}, 0)"), ("amount_units_mean", "avg(amount_units) {w}"),
        ("amount_units_std", "round(stddev_samp(amount_units) {w}, 2)"),
        ("amount_units_skew", "CASE WHEN min(amount_units) {w} < max(amount_units) {w} THEN round(skewness(amount_units) {w}, 6) END"),
        ("amount_units_min", "min(amount_units) {w}"), ("amount_units_max", "max(amount_units) {w}"), ("amount_units_count", "count(amount_units) {w}"),
        ("installments_mean", "round(avg(installments) {w}, 6)"), ("installments_var", "round(var_samp(installments) {w} + 0.0000037::DOUBLE, 5)"),
        ("installments_sum", "CAST(coalesce(sum(installments) {w}, 0) AS DOUBLE)"))]
    + ["count(DISTINCT month_lag) AS month_lag_nunique"]) + " FROM txn GROUP BY card_id")
def _(t):
    # the months up to the last but two are folded first, the later ones are appended
    keys, columns = ["card_id", "month_lag"], st.powers(_MERGED)
    early = staged(st.fold(t.txn.filter("month_lag < 0"), keys, columns))
    later = st.fold(t.txn.filter("month_lag >= 0"), keys, columns)
    states = st.append(early, later, keys, columns).withColumn("lag", F.col("month_lag"))
    spec = dict(_MERGED) | {"lag": ("nunique",)}
    df = st.statistics(states, "card_id", spec, {"_hist": "month_lag < 0", "_new": "month_lag >= 0", "": None}, by_key=["lag"])
    digits = {"amount_units_std": (2, 0.0), "amount_units_skew": (6, 0.0), "installments_mean": (6, 0.0), "installments_var": (5, 0.0000037)}
    names = [f"{c}_{s}{seg}" for seg in ("_hist", "_new", "") for c, own in _MERGED.items() for s in own]
    of = {n: next((d for k, d in digits.items() if n.startswith(k)), None) for n in names}
    return df.select("card_id", *[F.round(F.col(n) + of[n][1], of[n][0]).alias(n) if of[n] else F.col(n) for n in names],
                     F.col("lag_nunique").alias("month_lag_nunique"))


