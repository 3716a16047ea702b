"""Typed readers and keyed writers."""

from __future__ import annotations

import uuid
from collections.abc import Iterable

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.types import (DateType, DoubleType, IntegerType, LongType, StringType,
                               StructField, StructType, TimestampNTZType)

from ..functions.semantics import nan_to_null

_TYPES = {"s": StringType(), "i": IntegerType(), "l": LongType(), "d": DoubleType(),
          "t": TimestampNTZType(), "date": DateType()}


def _schema(**cols: str) -> StructType:
    return StructType([StructField(n, _TYPES[t]) for n, t in cols.items()])


TRAIN = _schema(card_id="s", first_active_month="s", feature_1="i", feature_2="i", feature_3="i", target="d")
TEST = _schema(card_id="s", first_active_month="s", feature_1="i", feature_2="i", feature_3="i")
MERCHANTS = _schema(
    merchant_id="s", merchant_group_id="i", merchant_category_id="i", subsector_id="i", category_1="s",
    numerical_1="d", numerical_2="d", most_recent_sales_range="s", most_recent_purchases_range="s",
    avg_sales_lag3="d", avg_purchases_lag3="d", active_months_lag3="i",
    avg_sales_lag6="d", avg_purchases_lag6="d", active_months_lag6="i",
    avg_sales_lag12="d", avg_purchases_lag12="d", active_months_lag12="i",
    category_4="s", city_id="i", state_id="i", category_2="d")
TRANSACTIONS = _schema(
    authorized_flag="s", card_id="s", city_id="i", category_1="s", installments="i", category_3="s",
    merchant_category_id="i", merchant_id="s", month_lag="i", purchase_amount="d", purchase_date="t",
    category_2="d", state_id="i", subsector_id="i")
SUBMISSION = _schema(card_id="s", target="d")
PREDICTIONS = _schema(card_id="s", fold="i", pred="d", model="s", target_kind="s")


def read_table(spark: SparkSession, path: str, schema: StructType | None = None, fmt: str | None = None,
               header: bool = True, timestamp_format: str = "yyyy-MM-dd HH:mm:ss") -> DataFrame:
    """Read a CSV or Parquet table with a declared schema.

    Nothing is inferred, so a CSV is read once. An empty field, ``nan`` or
    ``NaN`` is NULL; ``inf`` stays an infinity. CSV columns are bound by header
    name, so the file's column order does not matter.
    """
    fmt = fmt or ("csv" if path.rstrip("/").endswith((".csv", ".csv.gz")) else "parquet")
    if fmt == "parquet":
        reader = spark.read.schema(schema) if schema is not None else spark.read
        return reader.parquet(path)
    if schema is None:
        raise ValueError("a CSV table needs a declared schema")
    reader = (spark.read.option("header", header).option("nanValue", "nan").option("positiveInf", "inf")
              .option("negativeInf", "-inf").option("timestampNTZFormat", timestamp_format)
              .option("timestampFormat", timestamp_format))
    if header:
        names = reader.csv(path).columns
        fields = {f.name: f for f in schema.fields}
        ordered = StructType([fields.get(n, StructField(n, StringType())) for n in names])
        df = reader.schema(ordered).csv(path).select(*[n for n in schema.names if n in names])
    else:
        df = reader.schema(schema).csv(path)
    return df.select(*[
        nan_to_null(f.name).alias(f.name) if isinstance(f.dataType, DoubleType) else F.col(f.name)
        for f in df.schema.fields])


# Below this size a scan has too few row groups to keep all cores busy.
SPREAD_BELOW_BYTES = 64 << 20


def spread_small(df: DataFrame) -> DataFrame:
    """Spread a small scan over the cores; a Parquet row group is never split between tasks.

    Larger tables already have enough row groups and are left alone.
    """
    size = int(str(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))
    cores = df.sparkSession.sparkContext.defaultParallelism
    return df.repartition(cores) if (1 << 20) < size < SPREAD_BELOW_BYTES else df


def read_predictions(spark: SparkSession, path: str, model: str | None = None,
                     target_kind: str | None = None) -> DataFrame:
    """Keyed predictions; the filters prune partition directories."""
    df = spark.read.parquet(path)
    if model is not None:
        df = df.filter(F.col("model") == model)
    if target_kind is not None:
        df = df.filter(F.col("target_kind") == target_kind)
    return df


def write_stage(df: DataFrame, path: str, fmt: str = "parquet") -> None:
    """Overwrite a staged table. Vector columns need Parquet."""
    writer = df.write.mode("overwrite")
    if fmt == "csv":
        writer.option("header", True).csv(path)
    else:
        writer.format(fmt).save(path)


def write_bucketed(df: DataFrame, table: str, key: str, buckets: int, folder: str | None = None) -> DataFrame:
    """A table in ``buckets`` files by the hash of ``key``, each sorted by it: joins with others of that kind move nothing.

    Without ``folder`` the table lies in the session's warehouse.
    """
    writer = df.repartition(buckets, key).write.mode("overwrite").format("parquet").bucketBy(buckets, key).sortBy(key)
    if folder is not None:
        writer = writer.option("path", folder)
    writer.saveAsTable(table)
    return df.sparkSession.table(table)


# ---- versions ----------------------------------------------------------------

#: Part of a versioned folder that lists what was published, one small file each.
PUBLISHED = "published"


def write_version(df: DataFrame, folder: str) -> str:
    """Write ``df`` as a new version beside the ones that readers use; none of them sees it before ``publish``."""
    version = f"v{uuid.uuid4().hex}"
    df.write.parquet(f"{folder}/{version}")
    return version


def _published(spark: SparkSession, folder: str) -> list[tuple[int, str]]:
    try:
        rows = spark.read.schema("number long, version string, live boolean").json(f"{folder}/{PUBLISHED}").collect()
    except AnalysisException:  # nothing was published yet
        return []
    gone = {r["version"] for r in rows if not r["live"]}
    return sorted((r["number"], r["version"]) for r in rows if r["live"] and r["version"] not in gone)


def _note(spark: SparkSession, folder: str, number: int, version: str, live: bool) -> None:
    row = spark.createDataFrame([(number, version, live)], "number long, version string, live boolean")
    row.coalesce(1).write.mode("append").json(f"{folder}/{PUBLISHED}")


def publish(spark: SparkSession, folder: str, version: str) -> None:
    """Make a version the current one by one more pointer file, which its writer's commit makes visible at once.

    A version that was not written whole has no files to read and is refused. One publisher at a time.
    """
    spark.read.parquet(f"{folder}/{version}").schema
    last = _published(spark, folder)
    _note(spark, folder, last[-1][0] + 1 if last else 1, version, True)


def current_version(spark: SparkSession, folder: str) -> str:
    """The name of the version published last. A reader that keeps it reads the same table whatever is published later."""
    known = _published(spark, folder)
    if not known:
        raise ValueError(f"nothing is published in {folder}")
    return known[-1][1]


def read_version(spark: SparkSession, folder: str, version: str | None = None) -> DataFrame:
    """The published version, or the one that is named."""
    return spark.read.parquet(f"{folder}/{version or current_version(spark, folder)}")


def drop_old_versions(spark: SparkSession, folder: str, keep: Iterable[str] = ()) -> list[str]:
    """Empty the published versions that are neither current nor named, and take them off the list."""
    kept, dropped = {current_version(spark, folder), *keep}, []
    for _, version in _published(spark, folder):
        if version not in kept:
            _note(spark, folder, 0, version, False)
            old = f"{folder}/{version}"
            spark.createDataFrame([], spark.read.parquet(old).schema).write.mode("overwrite").parquet(old)
            dropped.append(version)
    return dropped


def write_predictions(df: DataFrame, path: str) -> None:
    """Predictions keyed by card, one directory per model and target kind.

    Only the directories that ``df`` covers are replaced.
    """
    (df.write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
       .partitionBy("model", "target_kind").parquet(path))


def to_submission(template: DataFrame, preds: DataFrame, key: str = "card_id", pred: str = "pred",
                  target: str = "target") -> DataFrame:
    """One row per template card with its prediction, joined by key."""
    return template.select(key).join(preds.select(key, F.col(pred).alias(target)), key, "left")
