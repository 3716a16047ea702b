"""Helpers that several operators of this folder share."""

from __future__ import annotations

import ctypes
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F

from cardloom.session import shared_folder

#: Words are runs of anything but these code points (space and tab to carriage return).
BLANKS = "\\x20\\x09-\\x0D"


def documents(spark: SparkSession, folder: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/documents.parquet")


def stage(df: DataFrame, compression: str = "snappy") -> DataFrame:
    """Write ``df`` once to the shared folder and read it back: the lineage ends there, lost executors cost nothing."""
    path = shared_folder(df.sparkSession)
    df.write.option("compression", compression).parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def hand_back() -> None:
    """Give free memory back to the system: a worker lives on beside the stages that follow."""
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
    if trim is not None:
        trim(0)


def tidy(run: Callable[[Iterator], Iterator]) -> Callable[[Iterator], Iterator]:
    """``run`` over the batches of a task, after which free memory is handed back."""
    def wrapped(batches: Iterator) -> Iterator:
        yield from run(batches)
        hand_back()

    return wrapped


def tidy_group(run: Callable) -> Callable:
    """``run`` over one group, after which free memory is handed back."""
    def wrapped(frame):
        out = run(frame)
        hand_back()
        return out

    return wrapped


def whole(text: Column) -> Column:
    """The text, empty where it is null."""
    return F.coalesce(text.cast("string"), F.lit(""))


def word_count(text: Column) -> Column:
    """Number of runs of non-blank characters."""
    squeezed = F.regexp_replace(whole(text), f"[{BLANKS}]+", " ")
    inner = F.btrim(squeezed)
    return F.when(inner == "", F.lit(0)).otherwise(F.length(inner) - F.length(F.replace(inner, F.lit(" "))) + 1).cast("long")


def running_offsets(sums: DataFrame, keys: list[str], order: str, value: str, name: str) -> DataFrame:
    """Exclusive running totals over a small table that holds one row per key and chunk."""
    w = Window.partitionBy(*[F.col(k) for k in keys]).orderBy(order).rowsBetween(Window.unboundedPreceding, -1)
    return sums.withColumn(name, F.coalesce(F.sum(value).over(w), F.lit(0)))


#: Slots of a bitmap of keys; a multiple of 64.
SLOTS = 1 << 22


def bitmap(keys: DataFrame, column: str) -> DataFrame:
    """One row: ``bits``, an array of 64-bit numbers in which the slots of the keys are set. Its size is fixed."""
    slot = F.pmod(F.xxhash64(column), F.lit(SLOTS))
    words = keys.select(F.floor(slot / 64).alias("word"), (slot % 64).cast("int").alias("bit")).groupBy("word").agg(
        F.bit_or(F.expr("shiftleft(1L, bit)")).alias("bits"))
    every = keys.sparkSession.range(SLOTS // 64).withColumnRenamed("id", "word").join(words, "word", "left")
    return stage(every.agg(F.transform(F.array_sort(F.collect_list(F.struct("word", F.coalesce("bits", F.lit(0)).alias("bits")))),
                                       lambda x: x["bits"]).alias("bits")))


def may_have(rows: DataFrame, key: Column, keys: DataFrame, column: str) -> tuple[DataFrame, DataFrame]:
    """``rows`` in two: those whose key is surely not among ``keys``, and those that a join has to tell.

    Only the second part needs a shuffle: about the rows of the keys, as long as these are few beside ``SLOTS``.
    """
    slot = F.pmod(F.xxhash64(key), F.lit(SLOTS))
    known = F.getbit(F.get(bitmap(keys, column).scalar(), F.floor(slot / 64).cast("int")), slot % 64) == 1
    return rows.filter(~known), rows.filter(known)
