"""A filter of known keys that drops fact rows without a partner before they move.

Keys set bits of a bitmap that is sized by their counted number, up to a fixed bound; beyond it the filter lets more rows pass
and the join that follows does the rest. The bitmap is put together from words that every task has merged by OR, and travels as
one scalar. A key that is known always passes, so results do not change.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from ..session import staged

#: Bits per key, bits that a key sets, and the most bytes of a bitmap.
PER_KEY, PROBES, MOST_BYTES = 12, 3, 32 << 20
_SEEDS = (17, 101, 9973)


def _slots(key: Column, bits: int) -> list[Column]:
    return [F.pmod(F.xxhash64(key, F.lit(seed)), F.lit(bits)) for seed in _SEEDS[:PROBES]]


def bits_for(keys: int, most_bytes: int = MOST_BYTES) -> int:
    """Bits of the bitmap: a multiple of 64."""
    return 64 * max(1, min(-(-keys * PER_KEY // 64), most_bytes // 8))


def key_bitmap(keys: DataFrame, key: str, most_bytes: int = MOST_BYTES) -> tuple[DataFrame, int]:
    """One row with ``bits``, an array of 64-bit words, and how many bits it has. Null keys are not in it."""
    known = keys.filter(F.col(key).isNotNull())
    size = bits_for(known.count(), most_bytes)
    slots = known.select(F.explode(F.array(*_slots(F.col(key), size))).alias("slot"))
    words = slots.groupBy(F.floor(F.col("slot") / 64).alias("word")).agg(
        F.bit_or(F.call_function("shiftleft", F.lit(1).cast("bigint"), (F.col("slot") % 64).cast("int"))).alias("bits"))
    every = keys.sparkSession.range(size // 64).withColumnRenamed("id", "word").join(words, "word", "left")
    listed = F.array_sort(F.collect_list(F.struct("word", F.coalesce("bits", F.lit(0).cast("bigint")).alias("bits"))))
    return staged(every.agg(F.transform(listed, lambda w: w["bits"]).alias("bits"))), size


def only_known(facts: DataFrame, keys: DataFrame, key: str, most_bytes: int = MOST_BYTES) -> DataFrame:
    """The fact rows whose key may be among ``keys``: all that are, and few others."""
    bitmap, size = key_bitmap(keys, key, most_bytes)
    words, passes = bitmap.scalar(), F.col(key).isNotNull()
    for slot in _slots(F.col(key), size):
        passes = passes & (F.getbit(F.get(words, F.floor(slot / 64).cast("int")), (slot % 64).cast("int")) == 1)
    return facts.filter(passes)
