"""The three end-to-end runs: tables in, one submission per run out.

Only the per-card feature table is staged; facts are read straight from their
source by the roll-ups.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, functions as F

from ..operators import blend as bl, models as mo, text as tx
from ..operators.clean import feature_names, finite_max, replace_infinite, restrict_to
from ..operators.folds import assign_folds, sample
from ..operators.joins import align
from ..operators.select import TOP, select_by_correlation, top_names
from ..operators.profile import corr_long
from ..operators.pivot import to_wide
from ..session import cut
from ..sources.tables import read_table, to_submission, write_predictions, write_stage
from . import baseline as ba, prepare as pp, refined as rf

KEY, LABEL, SPLIT = "card_id", "target", "split"
# Ratio columns whose infinities are replaced before boosting.
INFINITE = ("new_cardf_card_id_cnt_divide_installments_nunique", "hist_last2_card_id_cnt_divide_installments_nunique")
ID_COLUMNS = ("merchant_id", "merchant_category_id", "state_id", "subsector_id", "city_id")
ID_SEGMENTS = {"new": "month_lag >= 0", "hist": "month_lag < 0", "all": None}


def _halves(df: DataFrame) -> tuple[DataFrame, DataFrame]:
    return df.filter(F.col(SPLIT) == "train"), df.filter(F.col(SPLIT) == "test")


def _staged(df: DataFrame, path: str) -> DataFrame:
    write_stage(df, path)
    return read_table(df.sparkSession, path)


def run_baseline(cards: DataFrame, hist: DataFrame, new: DataFrame, merchants: DataFrame, order: Sequence[str], folder: str,
                 top: int = TOP, forest: dict | None = None, grid: dict | None = None,
                 merchant_order: Sequence[str] | None = None) -> DataFrame:
    """Cross sums and card statistics, the most correlated features, a tuned forest, fold-averaged predictions.

    A ``grid`` setting that asks for more features than ``top`` raises before any table is read. ``merchant_order`` decides
    which of several rows of a merchant counts.
    """
    grid = mo.FOREST_GRID if grid is None else grid
    wide = [s for s in grid.get("featureSubsetStrategy", ()) if s.isdigit() and int(s) > top]
    if wide:
        raise ValueError(f"{top} features are chosen; the grid asks for {', '.join(wide)}")
    train, test = _halves(cards)
    train, test = pp.prepare_cards(train, test)
    coded = train.unionByName(test)
    ready = pp.prepare_merchants(merchants, merchant_order)
    rows = pp.stage_transactions(new, hist)
    cross = ba.cross_features(pp.prepare_staged(rows, ready, 1, order), cards)
    chosen = ba.select_cross_features(cross, train, k=top)
    stats = ba.card_statistics(pp.prepare_staged(rows, ready, 2, order))
    table = _staged(ba.assemble(coded, cross, stats, names=chosen), f"{folder}/baseline_features")
    train, test = _halves(table)
    names = select_by_correlation(train.drop(SPLIT), k=top, sparse_limit=None)
    matrix = mo.assemble_matrix(train, names, KEY, LABEL)
    est = mo.forest(**(forest or {}))
    _, best, _ = mo.grid_search(est, grid, matrix)
    fitted = mo.oof_fit_predict(matrix, mo.assemble_matrix(test, names, KEY), est.copy({est.getParam(n): v for n, v in best.items()}), seed=22)
    save_predictions(fitted, "randomforest", "all", folder)
    return to_submission(test, fitted.test)


def save_predictions(fitted: mo.OutOfFold, model: str, kind: str, folder: str) -> None:
    tag = {"model": F.lit(model), "target_kind": F.lit(kind)}
    write_predictions(fitted.oof.select(KEY, "fold", "pred").withColumns(tag), f"{folder}/oof")
    write_predictions(fitted.test.select(KEY, F.lit(None).cast("int").alias("fold"), "pred").withColumns(tag), f"{folder}/test")


def run_refined(cards: DataFrame, hist: DataFrame, new: DataFrame, as_of: str, folder: str, now: str = "2018-03-01",
                outlier_below: float = -30.0, rounds: int = 100, folds: int = 5, top: int | None = None,
                presets: Sequence[str] = ("first", "second", "third"), missing_merchant=pp.MISSING_MERCHANT) -> dict[str, DataFrame]:
    """Refined features, three boosters on three targets, then mean, stacked and two-stage blends."""
    rows = pp.clean_transactions(rf.tag_rows(hist, new), missing_merchant)
    table = _staged(rf.refined_features(cards, rows, as_of, now, outlier_below), f"{folder}/refined_features")
    train, test = _halves(table)
    top_value = finite_max(train, INFINITE)
    train, test = (replace_infinite(d, INFINITE, top_value) for d in (train, test))
    feats = feature_names(train, (KEY, LABEL, SPLIT, "outliers"))
    if top is not None:
        feats = select_by_correlation(train.select(KEY, LABEL, *feats), k=top)
    fits = mo.fit_all(train, test, feats, presets, rounds=rounds, k=folds, below=outlier_below)
    for (preset, kind), fitted in fits.items():
        save_predictions(fitted, preset, kind, folder)
    stacked = {}
    for kind in ("all", "normal", "binary"):
        label = "outliers" if kind == "binary" else LABEL
        oof = align({p: fits[p, kind].oof for p in presets}).join(train.select(KEY, label), KEY)
        oof = assign_folds(oof, KEY, 5, seed=2020, repeats=2)
        stacked[kind] = bl.stack(oof, align({p: fits[p, kind].test for p in presets}), presets, label)[1]
    parts = align({"p": stacked["binary"], "normal": stacked["normal"], "stack": stacked["all"]})
    two = bl.two_stage("p", "normal")
    return {
        "mean": to_submission(test, bl.blend(align({p: fits[p, "all"].test for p in presets}), presets, out="pred")),
        "stacked": to_submission(test, stacked["all"]),
        "two_stage": to_submission(test, parts.select(KEY, two.alias("pred"))),
        "two_stage_and_stack": to_submission(test, parts.select(KEY, bl.mixed(two, "stack").alias("pred")))}


def id_term_weights(cards: DataFrame, transactions: DataFrame, order: Sequence[str]) -> tuple[DataFrame, DataFrame]:
    """(counts, TF-IDF weights) of the fifteen id documents of every card, long."""
    known = restrict_to(transactions, cards, KEY, order)
    toks = tx.document_tokens(known, KEY, ID_COLUMNS, order, ID_SEGMENTS)
    counts = tx.count_terms(toks, KEY)
    counts = cut(counts)
    pairs = tx.count_terms(tx.bigrams(toks, KEY, order), KEY)
    return counts, tx.tfidf(counts.unionByName(pairs), tx.count_documents(cards), KEY)


def run_id_vectors(cards: DataFrame, transactions: DataFrame, dense: DataFrame, order: Sequence[str], folder: str, top: int = TOP,
                   draws: int = 26, rounds: int = 100, folds: int = 5, search_share: float = 0.1) -> DataFrame:
    """ID documents as terms, the most correlated terms beside the dense features, a searched booster.

    Terms are chosen on the long form; only the chosen ones become vector entries. The search fits ``search_share`` of
    the training cards.
    """
    counts, weights = id_term_weights(cards, transactions, order)
    dense = cut(dense)
    terms = counts.select(KEY, F.concat_ws("&", F.lit("count"), "document", "term").alias("feature"), F.col("tf").cast("double").alias("v"))
    terms = terms.unionByName(weights.select(KEY, F.concat_ws("&", F.lit("tfidf"), "document", "term").alias("feature"), F.col("weight").alias("v")))
    terms = cut(terms)
    names = top_names(corr_long(terms, cards.filter(F.col(SPLIT) == "train"), KEY, LABEL), top)
    wide = to_wide(terms.join(F.broadcast(cards.sparkSession.createDataFrame([(n,) for n in names], "feature string")), "feature"), KEY, names)
    table = _staged(dense.join(wide, KEY, "left").na.fill(0.0, names), f"{folder}/id_features")
    train, test = _halves(table)
    feats = feature_names(train, (KEY, LABEL, SPLIT, "outliers"))
    matrix = mo.assemble_matrix(train, feats, KEY, LABEL)
    searched = mo.boosted_regressor("second", rounds, early_stop=False)
    sampled = sample(matrix, KEY, search_share, 2020)
    _, best, _ = mo.random_search(searched, mo.SEARCH_SPACES["second"], draws, sampled)
    fitted = mo.oof_fit_predict(matrix, mo.assemble_matrix(test, feats, KEY), mo.boosted_regressor("second", rounds, **best), seed=2020, k=folds)
    save_predictions(fitted, "second", "all", folder)
    return to_submission(test, fitted.test)
