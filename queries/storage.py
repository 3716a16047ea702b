"""Sources and sinks: each query writes a given table to the shared folder and reads it back."""

from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, LongType, StringType, StructField, StructType, TimestampNTZType

from cardloom.operators import folds as fo, text as tx
from cardloom.session import shared_folder
from cardloom.sources import tables as tb
from cardloom.sources.fixtures import ROW_ORDER

from .features import ID_COLUMNS, _terms_sql, vector_entries
from .registry import query


def _fields(**kinds):
    return StructType([StructField(n, k()) for n, k in kinds.items()])


@query("s01_read_csv", "SELECT merchant_id, numerical_1, avg_purchases_lag3, category_4 FROM merchants")
def _(t):
    path = shared_folder(t.spark) + ".csv"
    tb.write_stage(t.merchants.select("category_4", "merchant_id", "numerical_1", "avg_purchases_lag3"), path, "csv")
    return tb.read_table(t.spark, path, _fields(merchant_id=LongType, numerical_1=DoubleType, avg_purchases_lag3=DoubleType,
                                                category_4=StringType))


@query("s02_read_csv_with_timestamps", "SELECT card_id, ord_1, ord_2, ord_3, purchase_date, category_3 FROM txn")
def _(t):
    path = shared_folder(t.spark) + ".csv"
    text = t.txn.select("card_id", "ord_1", "ord_2", "ord_3", F.date_format("purchase_date", "yyyy-MM-dd HH:mm:ss").alias("purchase_date"), "category_3")
    tb.write_stage(text, path, "csv")
    back = tb.read_table(t.spark, path, _fields(card_id=LongType, ord_1=LongType, ord_2=LongType, ord_3=LongType,
                                                purchase_date=TimestampNTZType, category_3=StringType))
    return back.withColumn("ord_2", F.col("ord_2").cast("int"))


def _predictions(t):
    return t.cards.select("card_id", fo.fold_of(F.col("card_id"), 5).alias("fold"), F.col("target").alias("pred"),
                          F.when(F.col("feature_3") == 1, "a").otherwise("b").alias("model"), F.lit("all").alias("target_kind"))


_PRED = """SELECT card_id, CAST((card_id * 7919) % 5 AS INT) AS fold, target AS pred, CASE WHEN feature_3 = 1 THEN 'a' ELSE 'b' END AS model, 'all' AS target_kind FROM cards"""


@query("s03_read_predictions", f"SELECT * FROM ({_PRED}) WHERE model = 'a'")
def _(t):
    path = shared_folder(t.spark)
    tb.write_predictions(_predictions(t), path)
    return tb.read_predictions(t.spark, path, model="a")


@query("s04_stage_parquet", "SELECT card_id, first_active_month IS NULL AS idle, feature_1, target FROM cards")
def _(t):
    path = shared_folder(t.spark)
    tb.write_stage(t.cards.select("card_id", F.col("first_active_month").isNull().alias("idle"), "feature_1", "target"), path)
    return tb.read_table(t.spark, path)


@query("s05_write_predictions", _PRED)
def _(t):
    path = shared_folder(t.spark)
    tb.write_predictions(_predictions(t), path)
    return tb.read_predictions(t.spark, path)


@query("s06_stage_sparse_vectors", f"WITH {_terms_sql({'all': 'TRUE'})} SELECT card_id, CAST(code AS INT) AS position, CAST(tf AS DOUBLE) AS value FROM entries")
def _(t):
    toks = tx.document_tokens(t.txn, "card_id", ID_COLUMNS, ROW_ORDER, {"all": None})
    counts = tx.count_terms(toks, "card_id")
    vocabulary = tx.fit_vocabulary(counts)
    path = shared_folder(t.spark)
    tb.write_stage(tx.to_sparse(counts, vocabulary, vocabulary.count(), "card_id", "tf"), path)
    return vector_entries(tb.read_table(t.spark, path), "vector")
