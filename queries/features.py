"""Pivots, profiles, selection, text vectors, folds and blends."""

from itertools import combinations

from pyspark.sql import functions as F

from cardloom.functions import dates as d
from cardloom.functions.scalars import clamp, whole_number
from cardloom.operators import (blend as bl, clean as cl, folds as fo, pivot as pv, profile as pr, select as se, text as tx)
from cardloom.operators.joins import align, in_order_of
from cardloom.operators.skew import keyed_join, staged_by_key
from cardloom.sources.fixtures import ROW_ORDER
from cardloom.sources.tables import to_submission

from .registry import query

ORDER = "purchase_date, ord_1, ord_2, ord_3"


# ---- pivots ------------------------------------------------------------------

@query("a13_cross_sums", """
SELECT card_id, 'city_id' AS "column", CAST(city_id AS VARCHAR) AS value, CAST(sum(amount_units) AS DOUBLE) AS amount_units, CAST(sum(installments) AS DOUBLE) AS installments FROM txn GROUP BY card_id, city_id
UNION ALL SELECT card_id, 'month_lag', CAST(month_lag AS VARCHAR), sum(amount_units), sum(installments) FROM txn GROUP BY card_id, month_lag
UNION ALL SELECT card_id, 'category_3', category_3, sum(amount_units), sum(installments) FROM txn WHERE category_3 IS NOT NULL GROUP BY card_id, category_3""")
def _(t):
    return pv.cross_sums(t.txn, "card_id", ["city_id", "month_lag", "category_3"], ["amount_units", "installments"])


@query("a13_cross_sums_wide", "SELECT card_id," + ",".join(
    f"coalesce(sum(amount_units) FILTER (state_id = {i}), 0) AS \"state_id&{i}&amount_units\"" for i in range(5))
    + " FROM txn GROUP BY card_id")
def _(t):
    sums = pv.cross_sums(t.txn, "card_id", ["state_id"], ["amount_units"])
    return pv.to_wide(pv.cross_features(sums, "card_id", ["amount_units"]), "card_id",
                      [f"state_id&{i}&amount_units" for i in range(5)])


@query("a14_count_pivot", "SELECT card_id," + ",".join(
    f"count(merchant_id) FILTER (category_2 = {v}) AS category_2_cnt_pivot_{v}" for v in range(1, 6))
    + " FROM txn WHERE category_2 IS NOT NULL GROUP BY card_id")
def _(t):
    return pv.count_pivot(t.txn, "card_id", "category_2", "merchant_id", [1, 2, 3, 4, 5])


@query("a15_day_share_pivot", "SELECT card_id," + ",".join(
    f"CAST(count(DISTINCT purchase_date) FILTER (category_3 = '{v}') AS DOUBLE) / count(DISTINCT purchase_date) AS category_3_day_nunique_pct_{v}"
    for v in "ABC") + " FROM txn GROUP BY card_id HAVING count(category_3) > 0")
def _(t):
    return pv.day_share_pivot(t.txn, "card_id", "category_3", "purchase_date", ["A", "B", "C"])


@query("a15_segment_value_features", " UNION ALL ".join(f"""
SELECT card_id, '{s}' || name || '_cnt_pivot_' || value AS feature, CAST(count(merchant_id) AS DOUBLE) AS v FROM u WHERE {p} GROUP BY card_id, name, value
UNION ALL SELECT u.card_id, '{s}' || name || '_day_nunique_pct_' || value, CAST(count(DISTINCT purchase_date) AS DOUBLE) / any_value(n)
FROM u JOIN (SELECT card_id, count(DISTINCT purchase_date) AS n FROM txn WHERE {p} GROUP BY card_id) g ON g.card_id = u.card_id
WHERE {p} GROUP BY u.card_id, name, value""" for s, p in (("hist_", "month_lag < 0"), ("new_", "month_lag >= 0"))).join((
    """WITH u AS (SELECT card_id, month_lag, purchase_date, merchant_id, 'subsector_id' AS name, subsector_id AS value FROM txn
       UNION ALL SELECT card_id, month_lag, purchase_date, merchant_id, 'category_1', category_1 FROM txn) """, "")))
def _(t):
    segs = {"hist_": "month_lag < 0", "new_": "month_lag >= 0"}
    roll = pv.value_rollup(t.txn, "card_id", ["subsector_id", "category_1"], "merchant_id", "purchase_date", segs)
    return pv.pivot_features(roll, "card_id", list(segs), ["subsector_id", "category_1"])


# ---- distributions and correlations ------------------------------------------

@query("a16_distribution", """
SELECT feature_1 AS value, count(*) AS n, CAST(count(*) AS DOUBLE) / (SELECT count(*) FROM cards) AS ratio FROM cards WHERE feature_1 IS NOT NULL GROUP BY 1""")
def _(t):
    return pr.distribution(t.cards, "feature_1").orderBy("value")


@query("a17_joint_distribution", """
SELECT coalesce(strftime(first_active_month, '%Y-%m'), 'nan') || '&' || feature_2 AS value, count(*) AS n,
       CAST(count(*) AS DOUBLE) / (SELECT count(*) FROM cards) AS ratio FROM cards GROUP BY 1""")
def _(t):
    return pr.joint_distribution(t.cards.withColumn("first_active_month", d.year_month("first_active_month")),
                                 "first_active_month", "feature_2")


@query("a18_histogram", """
WITH e AS (SELECT min(target) AS lo, max(target) AS hi, count(target) AS n FROM cards),
     b AS (SELECT least(CAST(floor((target - lo) / ((hi - lo) / 20)) AS BIGINT), 19) AS bin, count(*) AS n FROM cards, e GROUP BY 1)
SELECT bin, round(lo + bin * ((hi - lo) / 20), 6) AS low, round(lo + (bin + 1) * ((hi - lo) / 20), 6) AS high, b.n, round(b.n / (e.n * ((hi - lo) / 20)), 12) AS density FROM b, e""")
def _(t):
    h = pr.histogram(t.cards, "target", 20)
    return h.select("bin", F.round("low", 6).alias("low"), F.round("high", 6).alias("high"), "n", F.round("density", 12).alias("density"))


_CORR = ["purchase_amount", "installments", "category_2", "city_id", "month_lag", "flat"]


@query("a19_correlation_with_label", " UNION ALL ".join(
    f"SELECT '{c}' AS feature, round(abs(CASE WHEN min(coalesce({c}, 0)) < max(coalesce({c}, 0)) THEN corr(coalesce({c}, 0), y) END), 9) AS abs_corr FROM z"
    for c in _CORR).join(("WITH z AS (SELECT t.*, 1 AS flat, c.target AS y FROM txn t JOIN cards c ON c.card_id = t.card_id WHERE c.split = 'train') ", "")))
def _(t):
    labels = t.cards.filter("split = 'train'").select("card_id", "target")
    df = keyed_join(t.txn, labels, "card_id", "inner", row_id=ROW_ORDER).withColumn("flat", F.lit(1))
    return pr.corr_with_target(df, _CORR, "target").select("feature", F.round("abs_corr", 9).alias("abs_corr"))


@query("a19_correlation_of_cross_sums", """
WITH f AS (SELECT card_id, subsector_id, sum(amount_units) AS v FROM txn GROUP BY 1, 2), l AS (SELECT card_id, target FROM cards WHERE split = 'train'),
     names AS (SELECT DISTINCT subsector_id FROM f JOIN l ON l.card_id = f.card_id)
SELECT 'subsector_id&' || n.subsector_id || '&amount_units' AS feature, round(abs(corr(coalesce(f.v, 0), l.target)), 7) AS abs_corr
FROM l CROSS JOIN names n LEFT JOIN f ON f.card_id = l.card_id AND f.subsector_id = n.subsector_id GROUP BY 1""")
def _(t):
    sums = pv.cross_sums(t.txn, "card_id", ["subsector_id"], ["amount_units"])
    feats = pv.cross_features(sums, "card_id", ["amount_units"])
    df = pr.corr_long(feats, t.cards.filter("split = 'train'"), "card_id", "target")
    return df.select("feature", F.round("abs_corr", 7).alias("abs_corr"))


@query("a20_correlation_matrix", " UNION ALL ".join(
    f"SELECT '{a}' AS a, '{b}' AS b, round(corr({a}, {b}), 9) AS corr FROM cards" for a in ("target", "feature_1", "feature_3") for b in ("target", "feature_1", "feature_3")))
def _(t):
    return pr.corr_matrix(t.cards, ["target", "feature_1", "feature_3"]).select("a", "b", F.round("corr", 9).alias("corr"))


@query("a21_label_counts", "SELECT CASE WHEN target < -900 THEN 1 ELSE 0 END AS value, count(*) AS n, CAST(count(*) AS DOUBLE) / (SELECT count(*) FROM cards) AS ratio FROM cards GROUP BY 1")
def _(t):
    return pr.distribution(cl.flag_outliers(t.cards, below=-900.0), "outliers")


@query("a23_column_means", "SELECT round(avg(numerical_1), 6) AS numerical_1, round(avg(avg_purchases_lag6), 6) AS avg_purchases_lag6 FROM merchants")
def _(t):
    m = cl.fit_means(t.merchants, ["numerical_1", "avg_purchases_lag6"])
    return m.select(*[F.round(c, 6).alias(c) for c in m.columns])


@query("a24_finite_maximum", """
SELECT greatest(max(CASE WHEN isinf(avg_purchases_lag3) THEN -99 ELSE avg_purchases_lag3 END), max(avg_purchases_lag6)) AS finite_max FROM merchants""")
def _(t):
    return cl.finite_max(t.merchants, ["avg_purchases_lag3", "avg_purchases_lag6"])


@query("a25_null_ratios", " UNION ALL ".join(
    f"SELECT '{c}' AS feature, avg(CASE WHEN {c} IS NULL THEN 1.0::DOUBLE ELSE 0 END) AS null_ratio FROM txn" for c in ("merchant_id", "category_2", "category_3", "card_id")))
def _(t):
    return cl.null_ratios(t.txn, ["merchant_id", "category_2", "category_3", "card_id"])


@query("a28_column_ranges", " UNION ALL ".join(
    f"SELECT '{c}' AS feature, CAST(min({c}) AS DOUBLE) AS low, CAST(max({c}) AS DOUBLE) AS high FROM txn" for c in ("installments", "month_lag", "city_id")))
def _(t):
    return cl.column_ranges(t.txn, ["installments", "month_lag", "city_id"])


_CARD_MONTH = "coalesce(CAST(CAST(first_active_month AS DATE) AS VARCHAR), 'nan')"
_J8 = {"first_active_month": _CARD_MONTH, "feature_1": "CAST(feature_1 AS VARCHAR)", "feature_2": "CAST(feature_2 AS VARCHAR)",
       "feature_3": "CAST(feature_3 AS VARCHAR)"}


@query("j08_compare_distributions", " UNION ALL ".join(f"""
SELECT '{n}' AS "column", {e} AS value, CAST(count(*) FILTER (split = 'train') AS DOUBLE) / (SELECT count(*) FROM cards WHERE split = 'train') AS train_ratio,
       CAST(count(*) FILTER (split = 'test') AS DOUBLE) / (SELECT count(*) FROM cards WHERE split = 'test') AS test_ratio FROM cards GROUP BY 2""" for n, e in _J8.items()))
def _(t):
    cards = t.cards.withColumn("first_active_month", F.to_date("first_active_month"))
    return pr.compare_distributions(cards.filter("split = 'train'"), cards.filter("split = 'test'"), list(_J8))


@query("j08_compare_joint_distributions", " UNION ALL ".join(f"""
SELECT '{a}&{b}' AS "column", {_J8[a]} || '&' || {_J8[b]} AS value, CAST(count(*) FILTER (split = 'train') AS DOUBLE) / (SELECT count(*) FROM cards WHERE split = 'train') AS train_ratio,
       CAST(count(*) FILTER (split = 'test') AS DOUBLE) / (SELECT count(*) FROM cards WHERE split = 'test') AS test_ratio FROM cards GROUP BY 2""" for a, b in combinations(_J8, 2)))
def _(t):
    cards = t.cards.withColumn("first_active_month", F.to_date("first_active_month"))
    return pr.compare_distributions(cards.filter("split = 'train'"), cards.filter("split = 'test'"),
                                    list(_J8), pairs=True)


# ---- sorts and top-k ---------------------------------------------------------

@query("t01_latest_by_order", f"SELECT card_id, ord_1, ord_2, ord_3 FROM txn QUALIFY row_number() OVER (PARTITION BY card_id ORDER BY purchase_date DESC, ord_1 DESC, ord_2 DESC, ord_3 DESC) = 1")
def _(t):
    last = F.max(F.struct(*ROW_ORDER)).alias("_l")
    return t.txn.groupBy("card_id").agg(last).select("card_id", "_l.ord_1", "_l.ord_2", "_l.ord_3")


@query("t02_top_features", """
WITH f AS (SELECT card_id, subsector_id, sum(amount_units) AS v FROM txn GROUP BY 1, 2), l AS (SELECT card_id, target FROM cards WHERE split = 'train'),
     names AS (SELECT DISTINCT subsector_id FROM f JOIN l ON l.card_id = f.card_id)
SELECT 'subsector_id&' || n.subsector_id || '&amount_units' AS feature, round(abs(corr(coalesce(f.v, 0), l.target)), 7) AS abs_corr
FROM l CROSS JOIN names n LEFT JOIN f ON f.card_id = l.card_id AND f.subsector_id = n.subsector_id GROUP BY 1 ORDER BY 2 DESC NULLS LAST, 1 LIMIT 30""")
def _(t):
    sums = pv.cross_sums(t.txn, "card_id", ["subsector_id"], ["amount_units"])
    feats = pv.cross_features(sums, "card_id", ["amount_units"])
    scores = pr.corr_long(feats, t.cards.filter("split = 'train'"), "card_id", "target")
    return se.top_features(scores.select("feature", F.round("abs_corr", 7).alias("abs_corr")), 30)


@query("t03_ordered_distribution", "SELECT feature_2 AS value, count(*) AS n, CAST(count(*) AS DOUBLE) / (SELECT count(*) FROM cards) AS ratio FROM cards GROUP BY 1 ORDER BY 1")
def _(t):
    return pr.distribution(t.cards, "feature_2").orderBy("value")


#: Whole texts of a bucket, about.
DOCUMENTS = 10_000


# ---- id lists and texts ------------------------------------------------------

ID_COLUMNS = ["merchant_id", "merchant_category_id", "state_id", "subsector_id", "city_id"]
SEGS = {"new": "month_lag >= 0", "hist": "month_lag < 0", "all": None}
SEG_SQL = {"new": "month_lag >= 0", "hist": "month_lag < 0", "all": "TRUE"}


def _docs_sql(cols, segments=SEG_SQL):
    return " UNION ALL ".join(
        f"SELECT card_id, '{c}_{s}' AS document, purchase_date, ord_1, ord_2, ord_3, coalesce(CAST({c} AS VARCHAR), 'nan') AS id FROM txn WHERE {p}"
        for c in cols for s, p in segments.items())


@query("a22_id_documents", f"""
WITH docs AS ({_docs_sql(ID_COLUMNS)})
SELECT card_id, document, row_number() OVER (PARTITION BY card_id, document ORDER BY {ORDER}) - 1 AS position, id FROM docs""")
def _(t):
    return tx.id_documents(t.txn, "card_id", ID_COLUMNS, ROW_ORDER, SEGS)


@query("v01_tokens", """
SELECT doc_id, array_to_string(regexp_extract_all(lower(text), '[\\p{L}\\p{N}_]{2,}'), ' ') AS tokens FROM documents""")
def _(t):
    return t.base("documents").select("doc_id", F.array_join(tx.tokens("text"), " ").alias("tokens"))


@query("v02_count_vectors", f"""
WITH docs AS ({_docs_sql(ID_COLUMNS)}),
     tok AS (SELECT card_id, document, unnest(regexp_extract_all(lower(id), '[\\p{{L}}\\p{{N}}_]{{2,}}')) AS term FROM docs)
SELECT card_id, document, term, count(*) AS tf FROM tok GROUP BY ALL""")
def _(t):
    toks = tx.document_tokens(t.txn, "card_id", ID_COLUMNS, ROW_ORDER, SEGS)
    return tx.count_terms(toks, "card_id")


_WEIGHTS = """
     df AS (SELECT document, term, count(*) AS df FROM tf GROUP BY ALL),
     w AS (SELECT tf.{key}, tf.document, tf.term, (1 + ln(tf)) * (ln((1.0::DOUBLE + n) / (1.0::DOUBLE + df)) + 1) AS w
           FROM tf JOIN df ON df.document = tf.document AND df.term = tf.term, total WHERE df >= 3 AND df <= n * 0.9::DOUBLE)
SELECT {key}, document, term, round(w / sqrt(sum(w * w) OVER (PARTITION BY {key}, document)), 9) AS weight FROM w"""


@query("v03_tfidf_of_ids", f"""
WITH docs AS ({_docs_sql(ID_COLUMNS)}),
     tok AS (SELECT card_id, document, purchase_date, ord_1, ord_2, ord_3, unnest(l) AS token, generate_subscripts(l, 1) AS i
             FROM (SELECT *, regexp_extract_all(lower(id), '[\\p{{L}}\\p{{N}}_]{{2,}}') AS l FROM docs)),
     pairs AS (SELECT card_id, document, lag(token) OVER (PARTITION BY card_id, document ORDER BY {ORDER}, i) || ' ' || token AS term FROM tok),
     tf AS (SELECT card_id, document, term, count(*) AS tf FROM (SELECT card_id, document, token AS term FROM tok UNION ALL SELECT * FROM pairs WHERE term IS NOT NULL) GROUP BY ALL),
     total AS (SELECT count(*) AS n FROM cards),""" + _WEIGHTS.format(key="card_id"))
def _(t):
    toks = tx.document_tokens(t.txn, "card_id", ID_COLUMNS, ROW_ORDER, SEGS)
    pairs = tx.bigrams(toks, "card_id", ROW_ORDER)
    # a pair has a blank and a token has none: counted apart, neither is moved
    counts = tx.count_terms(toks, "card_id").unionByName(tx.count_terms(pairs, "card_id"))
    w = tx.tfidf(counts, tx.count_documents(t.cards), "card_id")
    return w.withColumn("weight", F.round("weight", 9))


@query("v03_tfidf_of_texts", """
WITH l AS (SELECT doc_id, regexp_extract_all(lower(text), '[\\p{L}\\p{N}_]{2,}') AS l FROM documents),
     tok AS (SELECT doc_id, unnest(l) AS token, generate_subscripts(l, 1) AS i FROM l),
     pairs AS (SELECT doc_id, unnest(list_zip(l[:-2], l[2:])) AS p FROM l WHERE len(l) > 1),
     tf AS (SELECT doc_id, 'text' AS document, term, count(*) AS tf FROM (SELECT doc_id, token AS term FROM tok UNION ALL SELECT doc_id, p[1] || ' ' || p[2] FROM pairs) GROUP BY ALL),
     total AS (SELECT count(*) AS n FROM documents),""" + _WEIGHTS.format(key="doc_id"))
def _(t):
    docs = staged_by_key(t.base("documents").select("doc_id", "text"), "doc_id", bucket_rows=DOCUMENTS)
    # a pair has a blank and a token has none: counted apart, neither is moved
    counts = tx.count_terms(tx.text_tokens(docs, "doc_id", "text"), "doc_id").unionByName(
        tx.count_terms(tx.text_bigrams(docs, "doc_id", "text"), "doc_id"))
    w = tx.tfidf(counts, tx.count_documents(docs), "doc_id")
    return w.withColumn("weight", F.round("weight", 9))


@query("v04_shared_vocabulary", f"""
WITH docs AS ({_docs_sql(ID_COLUMNS)}), tok AS (SELECT DISTINCT 'x' AS x, document || '&' || unnest(regexp_extract_all(lower(id), '[\\p{{L}}\\p{{N}}_]{{2,}}')) AS feature FROM docs)
SELECT feature, CAST(row_number() OVER (ORDER BY feature) - 1 AS INT) AS code FROM tok""")
def _(t):
    toks = tx.document_tokens(t.txn, "card_id", ID_COLUMNS, ROW_ORDER, SEGS)
    return tx.fit_vocabulary(tx.count_terms(toks, "card_id"))


def _terms_sql(segments):
    return f"""
docs AS ({_docs_sql(ID_COLUMNS, segments)}),
tok AS (SELECT card_id, document || '&' || term AS feature, count(*) AS tf
        FROM (SELECT card_id, document, unnest(regexp_extract_all(lower(id), '[\\p{{L}}\\p{{N}}_]{{2,}}')) AS term FROM docs) GROUP BY ALL),
voc AS (SELECT feature, row_number() OVER (ORDER BY feature) - 1 AS code FROM (SELECT DISTINCT feature FROM tok)),
entries AS (SELECT card_id, code, tf FROM tok JOIN voc ON voc.feature = tok.feature)"""


def vector_entries(df, vector):
    """(card_id, position, value) of the entries that are not 0."""
    v = F.unwrap_udt(vector)
    # a sparse vector is read as it is stored; only a dense one has a value for every position
    at = F.when(v["type"] == 0, v["indices"]).otherwise(F.transform(v["values"], lambda x, i: i))
    entries = F.arrays_zip(at.alias("position"), v["values"].alias("value"))
    return df.select("card_id", F.inline(F.transform(entries, lambda e: F.struct(e["position"].alias("position"), e["value"].alias("value"))))).filter("value <> 0")


@query("v05_assembled_vectors", f"WITH {_terms_sql(SEG_SQL)}," + """
dense AS (SELECT * FROM cards WHERE card_id IN (SELECT card_id FROM entries))
SELECT card_id, CAST(code + 3 AS INT) AS position, CAST(tf AS DOUBLE) AS value FROM entries""" + "".join(
    f" UNION ALL SELECT card_id, {i}, CAST(feature_{i + 1} AS DOUBLE) FROM dense WHERE feature_{i + 1} <> 0" for i in range(3)))
def _(t):
    toks = tx.document_tokens(t.txn, "card_id", ID_COLUMNS, ROW_ORDER, SEGS)
    counts = tx.count_terms(toks, "card_id")
    vocabulary = tx.fit_vocabulary(counts)
    size = vocabulary.count()
    vectors = tx.to_sparse(counts, vocabulary, size, "card_id", "tf")
    joined = vectors.join(t.cards.select("card_id", "feature_1", "feature_2", "feature_3"), "card_id")
    whole = tx.assemble(joined, ["feature_1", "feature_2", "feature_3"], {"vector": size})
    return vector_entries(whole, "features")


# ---- folds, samples, metrics and blends --------------------------------------

_FOLD = "CAST((card_id * 7919 + {seed}) % 5 AS INT)"


@query("m01_folds_by_key", f"SELECT card_id, {_FOLD.format(seed=3)} AS fold FROM cards WHERE split = 'train'")
def _(t):
    return t.cards.filter("split = 'train'").select("card_id", fo.fold_of(F.col("card_id"), 5, 3).alias("fold"))


@query("m01_balanced_fold_sizes", """
WITH n AS (SELECT count(*) AS n FROM cards WHERE split = 'train'), f AS (SELECT unnest(range(5)) AS fold), r AS (SELECT unnest(range(2)) AS repeat)
SELECT CAST(repeat AS INT) AS repeat, CAST(fold AS INT) AS fold, n // 5 + CASE WHEN fold < n % 5 THEN 1 ELSE 0 END AS cards FROM n, f, r""")
def _(t):
    folds = fo.assign_folds(t.cards.filter("split = 'train'").select("card_id"), "card_id", 5, seed=2020, repeats=2)
    return folds.groupBy("repeat", "fold").agg(F.count(F.lit(1)).alias("cards"))


@query("m14_row_sample", f"""
SELECT card_id FROM cards WHERE ('0x' || substr(md5(card_id::VARCHAR || ':48'), 1, 13))::BIGINT < {int(0.1 * (1 << 52))}""")
def _(t):
    return fo.sample(t.cards.select("card_id"), "card_id", 0.1, 48)


def _fake(t):
    """Three prediction columns derived from the card table, with labels."""
    c = t.cards.select("card_id", "target", "feature_1", "feature_2", "feature_3")
    return {"randomforest": c.select("card_id", (F.col("target") * 0.5 + F.col("feature_1") * 10.0).alias("pred")),
            "lightgbm": c.select("card_id", (F.col("target") * 0.75 + F.col("feature_2") * 16.0).alias("pred")),
            "xgboost": c.select("card_id", (F.col("target") * 0.25 - F.col("feature_3") * 8.0).alias("pred"))}


_FAKE = """preds AS (SELECT card_id, target, target * 0.5::DOUBLE + feature_1 * 10.0::DOUBLE AS randomforest,
    target * 0.75::DOUBLE + feature_2 * 16.0::DOUBLE AS lightgbm, target * 0.25::DOUBLE - feature_3 * 8.0::DOUBLE AS xgboost, split FROM cards)"""


@query("j09_align_predictions", f"WITH {_FAKE} SELECT card_id, randomforest, lightgbm, xgboost FROM preds")
def _(t):
    return align(_fake(t))


@query("m10_fold_metrics", f"""
WITH {_FAKE}, s AS (SELECT {_FOLD.format(seed=0)} AS fold, sqrt(avg(power(lightgbm - target, 2))) AS rmse,
  -avg((target < 0)::INT * ln(p) + (1 - (target < 0)::INT) * ln(1 - p)) AS log_loss
  FROM (SELECT *, 1 / (1 + exp(target / 5000.0::DOUBLE)) AS p FROM preds) GROUP BY 1)
SELECT fold, round(rmse, 6) AS rmse, round(log_loss, 9) AS log_loss FROM s""")
def _(t):
    df = align(_fake(t)).join(t.cards.select("card_id", "target"), "card_id").withColumn("fold", fo.fold_of(F.col("card_id"), 5))
    p = F.lit(1.0) / (F.lit(1.0) + F.exp(F.col("target") / 5000.0))
    return df.groupBy("fold").agg(F.round(bl.rmse("lightgbm", "target"), 6).alias("rmse"),
                                  F.round(bl.log_loss(p, (F.col("target") < 0).cast("int")), 9).alias("log_loss"))


@query("m10_score_summary", f"""
WITH {_FAKE}, s AS (SELECT {_FOLD.format(seed=0)} AS fold, sqrt(avg(power(lightgbm - target, 2))) AS rmse FROM preds GROUP BY 1)
SELECT round(avg(rmse), 6) AS mean_score, round(stddev_pop(rmse), 6) AS std_score FROM s""")
def _(t):
    df = align(_fake(t)).join(t.cards.select("card_id", "target"), "card_id").withColumn("fold", fo.fold_of(F.col("card_id"), 5))
    s = bl.score_summary(bl.fold_scores(df, "regression", "lightgbm"))
    return s.select(*[F.round(c, 6).alias(c) for c in s.columns])


@query("m11_voting", f"""
WITH {_FAKE} SELECT card_id, round((randomforest + lightgbm + xgboost) / 3, 6) AS mean_vote,
  round(randomforest * 0.2::DOUBLE + lightgbm * 0.3::DOUBLE + xgboost * 0.5::DOUBLE, 6) AS weighted_vote FROM preds""")
def _(t):
    wide = align(_fake(t))
    mean = bl.blend(wide, ["randomforest", "lightgbm", "xgboost"], out="mean_vote")
    weighted = bl.blend(wide, {"randomforest": 0.2, "lightgbm": 0.3, "xgboost": 0.5}, out="weighted_vote")
    return mean.join(weighted, "card_id").select("card_id", F.round("mean_vote", 6).alias("mean_vote"),
                                                 F.round("weighted_vote", 6).alias("weighted_vote"))


_XS = ["randomforest", "lightgbm", "xgboost"]
_Z = [("1", "1.0::DOUBLE"), *[(x, x) for x in _XS], ("y", "target")]


@query("m12_fold_moments", f"WITH {_FAKE} SELECT {_FOLD.format(seed=0)} AS fold," + ",".join(
    f'round(sum({_Z[i][1]} * {_Z[j][1]}) / 1000, 1) AS "{_Z[i][0]}*{_Z[j][0]}"' for i in range(5) for j in range(i, 5))
    + " FROM preds WHERE split = 'train' GROUP BY 1")
def _(t):
    df = align(_fake(t)).join(t.cards.filter("split = 'train'").select("card_id", "target"), "card_id")
    g = bl.gram(df.withColumn("fold", fo.fold_of(F.col("card_id"), 5)), _XS, "target", by=("fold",))
    return g.select("fold", *[F.round(F.col(f"`{c}`") / 1000, 1).alias(c) for c in g.columns[1:]])


@query("m12_stacked_predictions")
def _(t):
    wide = align(_fake(t))
    # noise by arithmetic keeps the three columns from determining the label
    noisy = wide.withColumn("xgboost", F.col("xgboost") + (F.col("card_id") * 37 % 101).cast("double") * 20)
    labelled = noisy.join(t.cards.filter("split = 'train'").select("card_id", "target"), "card_id")
    oof = fo.assign_folds(labelled, "card_id", 5, seed=2020, repeats=2)
    test = noisy.join(t.cards.filter("split = 'test'").select("card_id"), "card_id", "left_semi")
    _, pred, _ = bl.stack(oof, test, _XS, "target")
    return pred


@query("m13_two_stage", f"""
WITH {_FAKE}, x AS (SELECT *, 1 / (1 + exp(target / 5000.0::DOUBLE)) AS p FROM preds)
SELECT card_id, round(p * -33.219281::DOUBLE + (1 - p) * lightgbm, 6) AS trick,
       round((p * -33.219281::DOUBLE + (1 - p) * lightgbm) * 0.5::DOUBLE + xgboost * 0.5::DOUBLE, 6) AS trick_and_stack FROM x""")
def _(t):
    wide = align(_fake(t)).join(t.cards.select("card_id", "target"), "card_id")
    p = F.lit(1.0) / (F.lit(1.0) + F.exp(F.col("target") / 5000.0))
    two = bl.two_stage(p, "lightgbm")
    return wide.select("card_id", F.round(two, 6).alias("trick"), F.round(bl.mixed(two, "xgboost"), 6).alias("trick_and_stack"))


@query("s07_submission", f"WITH {_FAKE} SELECT card_id, lightgbm AS target FROM preds WHERE split = 'test'")
def _(t):
    return to_submission(t.cards.filter("split = 'test'"), _fake(t)["lightgbm"])


@query("f26_clamped_scores", """
SELECT card_id, CAST(least(greatest(target / 1000, 0), 1) AS DOUBLE) AS share, CAST(round(greatest(target / 1000, 0)) AS INT) AS whole FROM cards""")
def _(t):
    return t.cards.select("card_id", clamp(F.col("target") / 1000, 0, 1).alias("share"), whole_number(clamp(F.col("target") / 1000, 0)).alias("whole"))


@query("t04_predictions_in_card_order", f"SELECT card_id, {_FOLD.format(seed=3)} AS fold, target AS pred FROM cards WHERE split = 'train'")
def _(t):
    folded = t.cards.filter("split = 'train'").select("card_id", fo.fold_of(F.col("card_id"), 5, 3).alias("fold"), F.col("target").alias("pred"))
    return in_order_of(t.cards.filter("split = 'train'"), folded.orderBy("fold"), "card_id")
