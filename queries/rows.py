"""Row-level work: projections, scalar functions, joins, windows and unions."""

import uuid

from pyspark.sql import functions as F

from cardloom.functions import dates as d, scalars as sc, semantics as se
from cardloom.operators import aggregate as ag, clean as cl, encode as en, joins as jo, windows as wi
from cardloom.operators.skew import keyed_join
from cardloom.session import shared_folder, staged
from cardloom.sources.fixtures import ROW_ORDER

from .registry import query

ORDS = "ord_1, ord_2, ord_3"
LINE = ["card_id", "ord_1", "ord_2", "ord_3"]


# ---- projections and filters -------------------------------------------------

@query("p01_project_columns", "SELECT card_id, purchase_amount, month_lag FROM txn")
def _(t):
    return cl.select_features(t.txn, ["purchase_amount", "month_lag"], "card_id")


@query("p02_drop_columns", "SELECT card_id, feature_1, feature_2, feature_3 FROM cards")
def _(t):
    return t.cards.drop("first_active_month", "target", "split", "not_there")


@query("p03_affix_names", "SELECT card_id, feature_1 AS new_feature_1_x, feature_2 AS new_feature_2_x FROM cards")
def _(t):
    return cl.with_affix(t.cards.select("card_id", "feature_1", "feature_2"), "card_id", "new_", "_x")


@query("p04_segment_filters", """
SELECT 'hist' AS segment, count(*) AS n, sum(amount_units) AS units FROM txn WHERE month_lag < 0
UNION ALL SELECT 'new', count(*), sum(amount_units) FROM txn WHERE month_lag >= 0
UNION ALL SELECT 'all', count(*), sum(amount_units) FROM txn""")
def _(t):
    hit = {"hist": F.col("month_lag") < 0, "new": F.col("month_lag") >= 0, "all": F.lit(True)}
    wide = t.txn.agg(*[F.struct(F.lit(k).alias("segment"), F.count(F.when(p, 1)).alias("n"),
                                F.sum(F.when(p, F.col("amount_units"))).alias("units")).alias(k)
                       for k, p in hit.items()])
    return wide.select(F.inline(F.array(*hit)))


@query("p05_recent_rows", f"SELECT card_id, {ORDS}, month_lag FROM txn WHERE month_lag >= -2")
def _(t):
    return t.txn.filter("month_lag >= -2").select(*LINE, "month_lag")


@query("p06_before_activation", f"""
SELECT x.card_id, {ORDS} FROM txn x JOIN cards c ON c.card_id = x.card_id WHERE x.purchase_date < c.first_active_month""")
def _(t):
    cards = t.cards.select("card_id", F.col("first_active_month").cast("timestamp_ntz").alias("m"))
    return keyed_join(t.txn, cards, "card_id", "inner", row_id=ROW_ORDER).filter(F.col("purchase_date") < F.col("m")).select(*LINE)


@query("p07_authorized_rows", f"SELECT card_id, {ORDS} FROM txn WHERE authorized_flag = 'Y'")
def _(t):
    flag = sc.map_values("authorized_flag", {"Y": 1, "N": 0})
    return t.txn.filter(flag == 1).select(*LINE)


@query("p08_without_outliers", "SELECT card_id, target FROM cards WHERE split = 'train' AND NOT target < -900")
def _(t):
    train = cl.flag_outliers(t.cards.filter("split = 'train'"), below=-900.0)
    return cl.without_outliers(train).select("card_id", "target")


@query("p09_outlier_flag", "SELECT card_id, CASE WHEN target < -900 THEN 1 ELSE 0 END AS outliers FROM cards")
def _(t):
    return cl.flag_outliers(t.cards, below=-900.0).select("card_id", "outliers")


@query("p10_prune_by_name", """
SELECT card_id, feature_1 AS kept, feature_3 AS hist_month_diff_mean FROM cards""")
def _(t):
    wide = t.cards.select(
        "card_id", F.col("feature_1").alias("kept"), F.col("feature_1").alias("new_subsector_id_cnt_3"),
        F.col("feature_2").alias("hist_last2_month_diff_mean"), F.col("feature_2").alias("a_month_diff_std"),
        F.col("feature_3").alias("hist_month_diff_mean"), F.col("feature_3").alias("min_num"),
        "target", "split", "first_active_month")
    return cl.prune_by_name(wide)


@query("p11_drop_overlap", "SELECT card_id, first_active_month IS NULL AS no_month FROM cards")
def _(t):
    left = t.cards.select("card_id", "feature_1", "target")
    right = t.cards.select("card_id", "feature_1", "target", F.col("first_active_month").isNull().alias("no_month"))
    return cl.drop_overlap(left, right, "card_id")


@query("p12_drop_sparse_columns", "SELECT card_id, purchase_amount FROM txn")
def _(t):
    rare = F.when((F.col("card_id") == 7) & (F.col("month_lag") == 0), F.col("month_lag")).alias("rare")
    return cl.drop_sparse_columns(t.txn.select("card_id", "purchase_amount", rare), 0.99)


@query("p13_numeric_columns", "SELECT card_id, feature_1, feature_2, feature_3, target FROM cards")
def _(t):
    return t.cards.select(*cl.numeric_columns(t.cards))


@query("p14_feature_list", "SELECT feature_1, feature_2, feature_3, split FROM cards")
def _(t):
    return t.cards.select(*cl.feature_names(t.cards, ("card_id", "target", "first_active_month")))


# ---- scalar functions --------------------------------------------------------

@query("f01_purchase_month", f"SELECT card_id, {ORDS}, strftime(purchase_date, '%Y-%m') AS purchase_month FROM txn")
def _(t):
    return t.txn.select(*LINE, d.year_month("purchase_date").alias("purchase_month"))


@query("f02_hour_section", "SELECT event_id, CAST(hour(ts) // 6 AS INT) AS purchase_hour_section FROM events")
def _(t):
    return t.base("events").select("event_id", d.hour_section("ts").alias("purchase_hour_section"))


@query("f03_weekend_section", "SELECT event_id, CAST((isodow(ts) - 1) // 5 AS INT) AS purchase_day FROM events")
def _(t):
    return t.base("events").select("event_id", d.weekend_section("ts").alias("purchase_day"))


@query("f04_year_prefix", """
SELECT card_id, coalesce(CAST(split_part(strftime(first_active_month, '%Y-%m'), '-', 1) AS INT), 0) AS year FROM cards""")
def _(t):
    return t.cards.select("card_id", d.year_prefix(d.year_month("first_active_month")).alias("year"))


@query("f05_parse_dates", """
SELECT event_id, CAST(strptime(strftime(ts, '%Y-%m'), '%Y-%m') AS DATE) AS month_start,
       CAST(strftime(ts, '%Y-%m-%d %H:%M:%S') AS TIMESTAMP) AS ts_seconds FROM events""")
def _(t):
    text = F.date_format("ts", "yyyy-MM-dd HH:mm:ss")
    return t.base("events").select("event_id", d.parse_month(d.year_month("ts")).alias("month_start"),
                                   F.to_timestamp_ntz(text, F.lit("yyyy-MM-dd HH:mm:ss")).alias("ts_seconds"))


@query("f06_date_parts", """
SELECT event_id, CAST(year(ts) AS INT) AS year, CAST(month(ts) AS INT) AS month, CAST(day(ts) AS INT) AS day,
       CAST(hour(ts) AS INT) AS hour, CAST(weekofyear(ts) AS INT) AS weekofyear, CAST(isodow(ts) - 1 AS INT) AS dayofweek,
       CAST(dayofyear(ts) AS INT) AS dayofyear, CASE WHEN isodow(ts) >= 6 THEN 1 ELSE 0 END AS weekend FROM events""")
def _(t):
    return t.base("events").select("event_id", *[c.alias(n) for n, c in d.day_parts("ts").items()])


@query("f07_weekend_flag", f"SELECT card_id, {ORDS}, CASE WHEN isodow(purchase_date) >= 6 THEN 1 ELSE 0 END AS weekend FROM txn")
def _(t):
    return t.txn.select(*LINE, d.is_weekend("purchase_date").alias("weekend"))


@query("f08_floor_day", "SELECT event_id, CAST(ts AS DATE) AS day FROM events")
def _(t):
    return t.base("events").select("event_id", d.floor_day("ts").alias("day"))


@query("f09_days_between", f"""
SELECT x.card_id, {ORDS}, CAST(date_diff('day', CAST(c.first_active_month AS DATE), CAST(x.purchase_date AS DATE)) AS INT) AS days
FROM txn x LEFT JOIN cards c ON c.card_id = x.card_id""")
def _(t):
    rows = keyed_join(t.txn, t.cards.select("card_id", "first_active_month"), "card_id", row_id=ROW_ORDER)
    return rows.select(*LINE, d.days_between("purchase_date", "first_active_month").alias("days"))


@query("f10_floor_buckets", f"""
SELECT card_id, {ORDS}, CAST(floor(month_lag / 7.0::DOUBLE) AS INT) AS weeks, CAST(floor(month_lag / 30.0::DOUBLE) AS INT) AS months FROM txn""")
def _(t):
    return t.txn.select(*LINE, se.floor_div("month_lag", 7).alias("weeks"), se.floor_div("month_lag", 30).alias("months"))


@query("f11_month_diff", """
SELECT event_id, CAST(floor(floor(epoch(TIMESTAMP '2024-06-01 12:00:00' - ts_s) / 86400) / 30) AS INT) + CAST(event_id % 14 AS INT) - 13 AS month_diff
FROM (SELECT event_id, date_trunc('second', ts) AS ts_s FROM events)""")
def _(t):
    lag = F.col("event_id").cast("int") % 14 - 13
    return t.base("events").withColumn("lag", lag).select(
        "event_id", d.month_diff("2024-06-01 12:00:00", "ts", "lag").alias("month_diff"))


@query("f12_epoch_seconds", "SELECT event_id, CAST(floor(epoch(ts)) AS BIGINT) AS seconds FROM events")
def _(t):
    return t.base("events").select("event_id", d.epoch_seconds("ts").alias("seconds"))


AMOUNT = "round_even(round_even(purchase_amount / 0.00150265118::DOUBLE + 497.06::DOUBLE, 8), 0)"


@query("f13_restore_amount", f"SELECT card_id, {ORDS}, {AMOUNT} AS amount FROM txn")
def _(t):
    return t.txn.select(*LINE, sc.restore_amount("purchase_amount").alias("amount"))


# the small shift keeps short decimal products away from rounding ties
@query("f14_decayed_amounts", f"""
WITH g AS (SELECT card_id, max(purchase_date) AS m FROM txn GROUP BY card_id),
     x AS (SELECT t.*, date_diff('day', t.purchase_date, g.m) AS dd FROM txn t JOIN g ON g.card_id = t.card_id)
SELECT card_id, {ORDS}, """ + ", ".join(
    f"round(amount_units * pow({rate}::DOUBLE, CAST(dd // {sc.UNIT_DAYS[unit]} AS DOUBLE)) + 0.00037::DOUBLE, 2) AS amount_{name}"
    for name, (unit, rate) in sc.DECAYS.items()) + " FROM x")
def _(t):
    rows = wi.days_to_last(t.txn, "card_id", "purchase_date", "dd")
    return rows.select(*LINE, *[F.round(sc.decayed("amount_units", "dd", s) + 0.00037, 2).alias(f"amount_{s}") for s in sc.DECAYS])


@query("f15_ratios", f"""
SELECT card_id, {ORDS}, CASE WHEN k = 0 THEN CASE WHEN amount_units > 0 THEN CAST('Infinity' AS DOUBLE)
       WHEN amount_units < 0 THEN CAST('-Infinity' AS DOUBLE) END ELSE amount_units / k END AS price, amount_units * month_lag AS duration
FROM (SELECT *, CAST(installments AS DOUBLE) AS k FROM txn)""")
def _(t):
    return t.txn.select(*LINE, se.div_inf("amount_units", "installments").alias("price"),
                        (F.col("amount_units") * F.col("month_lag")).alias("duration"))


@query("f16_row_statistics", """
SELECT card_id, CAST(feature_1 + feature_2 + feature_3 AS DOUBLE) AS feature_sum,
       CAST(feature_1 + feature_2 + feature_3 AS DOUBLE) / 3 AS feature_mean,
       CAST(greatest(feature_1, feature_2, feature_3) AS DOUBLE) AS feature_max,
       CAST(least(feature_1, feature_2, feature_3) AS DOUBLE) AS feature_min,
       round(list_aggregate([feature_1, feature_2, feature_3], 'stddev_samp'), 9) AS feature_std FROM cards""")
def _(t):
    s = sc.row_stats(["feature_1", "feature_2", "feature_3"])
    return t.cards.select("card_id", *[(F.round(c, 9) if n == "std" else c).alias(f"feature_{n}") for n, c in s.items()])


@query("f17_abs_sqrt", "SELECT card_id, abs(target) AS a, sqrt(abs(target)) AS s FROM cards")
def _(t):
    return t.cards.select("card_id", F.abs("target").alias("a"), F.sqrt(F.abs("target")).alias("s"))


@query("f18_fill_constants", f"""
SELECT card_id, {ORDS}, coalesce(category_2, 1) AS category_2, coalesce(category_3, 'A') AS category_3,
       coalesce(merchant_id, -1) AS merchant_id FROM txn""")
def _(t):
    return cl.fill(t.txn, {"category_2": 1, "category_3": "A", "merchant_id": -1}).select(
        *LINE, "category_2", "category_3", "merchant_id")


@query("f19_fill_with_mean", """
SELECT merchant_id, round(coalesce(numerical_1, (SELECT avg(numerical_1) FROM merchants)), 6) AS numerical_1 FROM merchants""")
def _(t):
    return cl.fill_with_mean(t.merchants, ["numerical_1"]).select("merchant_id", F.round("numerical_1", 6).alias("numerical_1"))


@query("f20_rewrite_sentinels", f"""
SELECT card_id, {ORDS}, CASE WHEN installments IN (-1, 999) THEN NULL WHEN installments = 0 THEN 1 ELSE installments END AS installments FROM txn""")
def _(t):
    return t.txn.select(*LINE, sc.rewrite_installments("installments").alias("installments"))


@query("f21_replace_infinite", """
WITH m AS (SELECT greatest(max(CASE WHEN isinf(avg_purchases_lag3) THEN -99 ELSE avg_purchases_lag3 END), max(avg_purchases_lag6)) AS top FROM merchants)
SELECT merchant_id, CASE WHEN isinf(avg_purchases_lag3) THEN top ELSE avg_purchases_lag3 END AS avg_purchases_lag3, avg_purchases_lag6
FROM merchants, m""")
def _(t):
    return cl.replace_infinite(t.merchants, ["avg_purchases_lag3", "avg_purchases_lag6"]).select(
        "merchant_id", "avg_purchases_lag3", "avg_purchases_lag6")


@query("f22_casts", f"""
SELECT card_id, {ORDS}, CAST(state_id AS VARCHAR) AS state_text, TRY_CAST(replace(merchant_category_id, 'Brand#', '') AS INT) AS brand,
       TRY_CAST(subsector_id AS INT) AS not_a_number, CAST(month_lag AS DOUBLE) AS lag FROM txn""")
def _(t):
    brand = F.regexp_replace("merchant_category_id", "Brand#", "").try_cast("int")
    return t.txn.select(*LINE, F.col("state_id").cast("string").alias("state_text"), brand.alias("brand"),
                        F.col("subsector_id").try_cast("int").alias("not_a_number"), F.col("month_lag").cast("double").alias("lag"))


@query("f23_join_names", f"SELECT card_id, {ORDS}, 'state_id&' || state_id || '&purchase_amount' AS name FROM txn")
def _(t):
    return t.txn.select(*LINE, sc.join_name("state_id", F.col("state_id").cast("string"), "purchase_amount").alias("name"))


@query("f24_downcast", "SELECT CAST(state_id AS TINYINT) AS state_id, CAST(installments AS SMALLINT) AS installments, purchase_amount, category_3 FROM txn")
def _(t):
    return cl.downcast(t.txn.select("state_id", "installments", "purchase_amount", "category_3"))


@query("f25_names_containing", " UNION ALL ".join(
    f"SELECT '{c}' AS feature, count({c}) AS n FROM txn" for c in ("category_1", "category_2", "category_3", "merchant_category_id", "merchant_id")))
def _(t):
    names = cl.names_containing(t.txn, ("category", "merchant"))
    counts = t.txn.agg(*[F.count(c).alias(c) for c in names])
    return counts.select(F.inline(F.array(*[F.struct(F.lit(c).alias("feature"), F.col(c).alias("n")) for c in names])))


@query("f27_array_element", "SELECT doc_id, string_split(text, ' ')[1] AS first_word, len(string_split(text, ' ')) AS n FROM documents")
def _(t):
    words = F.split(F.col("text"), " ")
    return t.base("documents").select("doc_id", F.element_at(words, 1).alias("first_word"), F.size(words).cast("bigint").alias("n"))


# ---- joins and unions --------------------------------------------------------

@query("j01_join_features", """
WITH a AS (SELECT card_id, sum(amount_units) AS hist_units FROM txn WHERE month_lag < 0 GROUP BY card_id),
     b AS (SELECT card_id, count(*) AS new_rows FROM txn WHERE month_lag >= 0 GROUP BY card_id)
SELECT c.card_id, feature_1, hist_units, new_rows FROM cards c LEFT JOIN a ON a.card_id = c.card_id LEFT JOIN b ON b.card_id = c.card_id""")
def _(t):
    a = t.txn.filter("month_lag < 0").groupBy("card_id").agg(F.sum("amount_units").alias("hist_units"))
    b = t.txn.filter("month_lag >= 0").groupBy("card_id").agg(F.count(F.lit(1)).alias("new_rows"))
    return jo.join_features(t.cards.select("card_id", "feature_1"), [a, b], "card_id")


@query("j01_join_bucketed", """
WITH a AS (SELECT card_id, sum(amount_units) AS hist_units, count(*) AS n_rows FROM txn WHERE month_lag < 0 GROUP BY card_id),
     b AS (SELECT card_id, count(*) AS new_rows FROM txn WHERE month_lag >= 0 GROUP BY card_id),
     m AS (SELECT card_id, count(DISTINCT merchant_id) AS merchants FROM txn GROUP BY card_id)
SELECT c.card_id, feature_1, hist_units, n_rows, new_rows, merchants FROM cards c
LEFT JOIN a ON a.card_id = c.card_id LEFT JOIN b ON b.card_id = c.card_id LEFT JOIN m ON m.card_id = c.card_id""")
def _(t):
    rows = staged(t.txn.select("card_id", "month_lag", "amount_units", "merchant_id"))
    a = rows.filter("month_lag < 0").groupBy("card_id").agg(F.sum("amount_units").alias("hist_units"), F.count(F.lit(1)).alias("n_rows"))
    b = rows.filter("month_lag >= 0").groupBy("card_id").agg(F.count(F.lit(1)).alias("new_rows"), F.count(F.lit(1)).alias("n_rows"))
    m = ag.count_bits(ag.value_bits(rows, ["card_id"], "merchant_id"), ["card_id"], ["merchants"])
    run = uuid.uuid4().hex
    families = {"cards": t.cards.select("card_id", "feature_1"), "history": a, "new": b, "merchants": m}
    return jo.join_bucketed({f"{n}_{run}": df for n, df in families.items()}, "card_id", 8, shared_folder(t.spark))


@query("j02_enrich_with_merchant", f"""
SELECT x.card_id, {ORDS}, m.most_recent_sales_range, m.category_4 FROM txn x LEFT JOIN merchants m ON m.merchant_id = x.merchant_id""")
def _(t):
    return jo.enrich(t.txn, t.merchants, "merchant_id", ["most_recent_sales_range", "category_4"]).select(
        *LINE, "most_recent_sales_range", "category_4")


@query("j03_attach_activation", f"""
SELECT x.card_id, {ORDS}, CAST(c.first_active_month AS DATE) AS first_active_month FROM txn x LEFT JOIN cards c ON c.card_id = x.card_id""")
def _(t):
    cards = t.cards.select("card_id", F.to_date("first_active_month").alias("first_active_month"))
    return keyed_join(t.txn, cards, "card_id", row_id=ROW_ORDER).select(*LINE, "first_active_month")


@query("j04_reference_day", f"""
SELECT x.card_id, {ORDS}, h.reference_day FROM txn x
LEFT JOIN (SELECT card_id, max(purchase_date) AS reference_day FROM txn WHERE month_lag < 0 GROUP BY card_id) h ON h.card_id = x.card_id
WHERE x.month_lag >= 0""")
def _(t):
    return ag.attach_reference(t.txn.filter("month_lag >= 0"), t.txn.filter("month_lag < 0"), "card_id",
                               "purchase_date").select(*LINE, "reference_day")


@query("j05_map_values", f"""
SELECT card_id, {ORDS}, CASE authorized_flag WHEN 'Y' THEN 1 WHEN 'N' THEN 0 END AS flag,
       CASE category_3 WHEN 'A' THEN 0 WHEN 'B' THEN 1 END AS code FROM txn""")
def _(t):
    return t.txn.select(*LINE, sc.map_values("authorized_flag", {"Y": 1, "N": 0}).alias("flag"),
                        sc.map_values("category_3", {"A": 0, "B": 1}).alias("code"))


@query("j06_target_encoding", """
WITH m AS (SELECT feature_1, avg(CASE WHEN target < 0 THEN 1 ELSE 0 END) AS v FROM cards WHERE split = 'train' GROUP BY feature_1)
SELECT c.card_id, m.v AS feature_1_outliers_mean FROM cards c LEFT JOIN m ON m.feature_1 = c.feature_1""")
def _(t):
    cards = cl.flag_outliers(t.cards, below=0.0)
    return en.target_encode(cards.filter("split = 'train'"), cards, "feature_1", "outliers",
                            "feature_1_outliers_mean").select("card_id", "feature_1_outliers_mean")


@query("j10_known_cards_only", "SELECT card_id, count(*) AS n FROM txn WHERE card_id IN (SELECT card_id FROM cards WHERE split = 'test') GROUP BY card_id")
def _(t):
    known = cl.restrict_to(t.txn, t.cards.filter("split = 'test'"), "card_id")
    return known.groupBy("card_id").agg(F.count(F.lit(1)).alias("n"))


@query("j11_shared_columns", "SELECT card_id, target FROM cards")
def _(t):
    left, right = t.cards.select("card_id", "target", "feature_1"), t.cards.select("target", "card_id", "split")
    return t.cards.select(*[c for c in left.columns if c in set(right.columns)])


@query("u01_union_new_and_history", f"SELECT card_id, {ORDS}, purchase_amount FROM txn")
def _(t):
    new, hist = t.txn.filter("month_lag >= 0"), t.txn.filter("month_lag < 0")
    return jo.union_all(new, hist).select(*LINE, "purchase_amount")


@query("u02_union_train_and_test", "SELECT card_id, split AS part, CASE WHEN split = 'train' THEN target END AS target FROM cards")
def _(t):
    train = t.cards.filter("split = 'train'").select("card_id", "target")
    test = t.cards.filter("split = 'test'").select("card_id")
    return jo.tagged_union({"train": train, "test": test}, "part")


@query("u03_distinct_value_union", "SELECT feature_1 AS value FROM cards UNION SELECT feature_2 FROM cards")
def _(t):
    a, b = t.cards.select(F.col("feature_1").alias("value")), t.cards.select(F.col("feature_2").alias("value"))
    return a.unionByName(b).distinct()


# ---- windows and codes -------------------------------------------------------

@query("w01_group_difference", f"""
SELECT card_id, {ORDS}, month_lag - lag(month_lag) OVER w AS month_lag_diff, category_2 - lag(category_2) OVER w AS category_2_diff
FROM txn WINDOW w AS (PARTITION BY card_id ORDER BY purchase_date, {ORDS})""")
def _(t):
    return wi.group_diff(t.txn, "card_id", ROW_ORDER, ["month_lag", "category_2"]).select(*LINE, "month_lag_diff", "category_2_diff")


@query("w02_gap_days", f"""
SELECT card_id, {ORDS}, CAST(g AS INT) AS purchase_day_diff, CAST(g // 7 AS INT) AS purchase_week_diff, CAST(g // 30 AS INT) AS purchase_month_diff
FROM (SELECT *, date_diff('day', lag(purchase_date) OVER (PARTITION BY card_id ORDER BY purchase_date, {ORDS}), purchase_date) AS g FROM txn)""")
def _(t):
    return wi.gap_days(t.txn, "card_id", ROW_ORDER).select(*LINE, "purchase_day_diff", "purchase_week_diff", "purchase_month_diff")


@query("w03_days_to_last", f"""
SELECT card_id, {ORDS}, CAST(date_diff('day', purchase_date, max(purchase_date) OVER (PARTITION BY card_id)) AS INT) AS purchase_day_since_reference_day FROM txn""")
def _(t):
    return wi.days_to_last(t.txn, "card_id", "purchase_date").select(*LINE, "purchase_day_since_reference_day")


@query("w04_mean_encoding", f"""
SELECT card_id, {ORDS}, CASE WHEN category_2 IS NOT NULL THEN avg(amount_units) OVER (PARTITION BY category_2) END AS category_2_mean FROM txn""")
def _(t):
    return en.mean_encode(t.txn, "category_2", "amount_units", "category_2_mean").select(*LINE, "category_2_mean")


@query("w05_first_per_key", f"""
SELECT merchant_id, card_id, {ORDS}, amount_units FROM txn WHERE merchant_id IS NOT NULL
QUALIFY row_number() OVER (PARTITION BY merchant_id ORDER BY purchase_date, {ORDS}, card_id) = 1""")
def _(t):
    rows = t.txn.filter("merchant_id IS NOT NULL").select("merchant_id", "purchase_date", *LINE, "amount_units")
    return wi.first_per_key(rows, "merchant_id", (*ROW_ORDER, "card_id")).drop("purchase_date")


@query("w06_ordinal_codes", f"""
SELECT card_id, {ORDS}, CAST(dense_rank() OVER (ORDER BY coalesce(category_3, '-1')) - 1 AS INT) AS category_3,
       CAST(dense_rank() OVER (ORDER BY subsector_id) - 1 AS INT) AS subsector_id FROM txn""")
def _(t):
    df = en.ordinal_encode(t.txn, "category_3", missing="-1")
    return en.ordinal_encode(df, "subsector_id").select(*LINE, "category_3", "subsector_id")


@query("w06_shared_dictionary", """
SELECT card_id, split, CAST(dense_rank() OVER (ORDER BY coalesce(strftime(first_active_month, '%Y-%m'), 'nan')) - 1 AS INT) AS first_active_month FROM cards""")
def _(t):
    cards = t.cards.select("card_id", "split", d.year_month("first_active_month").alias("first_active_month"))
    parts = {s: cards.filter(F.col("split") == s) for s in ("train", "test")}
    return jo.union_all(*en.encode_together(parts, "first_active_month", missing="nan").values())
