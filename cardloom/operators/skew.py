"""A keyed join that splits hot keys.

The runtime's own skew join does not apply when one side is an aggregate on
the join key, because that side has no shuffle of its own at the join. So the
split is part of the plan: keys with more than 1/SHARES of the rows are salted
in proportion to their size. By counting, there are fewer than SHARES of them,
which bounds the broadcast hot-key list.
"""

from __future__ import annotations

import re
import uuid
from collections.abc import Sequence

from pyspark.errors import IllegalArgumentException
from pyspark.sql import DataFrame, functions as F

from ..session import shared_folder, staged
from ..sources.tables import write_bucketed

SHARES = 1000
#: Rows of a bucket, about; a key with fewer rows is never hot there.
BUCKET_ROWS = 100_000


def hot_keys(counts: DataFrame, keys: Sequence[str], n: str, shares: int = SHARES) -> DataFrame:
    """(keys, _salts) of the keys above 1/shares of the rows: fewer than ``shares`` rows."""
    total = counts.agg(F.sum(n).alias("t")).scalar()
    part = F.col(n) * F.lit(shares) / total
    return counts.filter(part > 1).select(*keys, F.ceil(part).cast("int").alias("_salts"))


def keyed_join(facts: DataFrame, table: DataFrame, keys: str | Sequence[str], how: str = "left", size: str | None = None,
               shares: int = SHARES, row_id: Sequence[str] | None = None) -> DataFrame:
    """Join facts to a table with one row per key.

    ``row_id`` names columns that tell the fact rows apart; they alone spread a hot key, so that other columns need not be
    read and equal rows do not stay together. Without it all columns of ``facts`` are hashed: select the wanted ones first.

    ``size`` names a table column holding the number of fact rows of the key;
    it is dropped from the result. Without it the fact keys are counted first.
    Every salted slice of a hot key is about 1/shares of the rows; NULL keys
    match nothing and are spread out. Facts of ``staged_by_key`` are joined where they lie.
    """
    keys = [keys] if isinstance(keys, str) else list(keys)
    if lies_by_key(facts, keys[0]):
        # no key is hot there
        table = table if size is None else table.drop(size)
        out = [c for c in facts.columns if c not in keys] + [c for c in table.columns if c not in keys and how != "left_semi"]
        return facts.join(table, keys, how).select(*keys, *[F.col(f"`{c}`") for c in out])
    if size is None:
        counts = facts.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n"))
    else:
        counts = table.select(*keys, F.col(size).alias("_n"))
        table = table.drop(size)
    hot = F.broadcast(hot_keys(counts, keys, "_n", shares))
    spread = F.xxhash64(*[F.col(f"`{c}`") for c in row_id or facts.columns])
    missing = F.lit(False)
    for k in keys:
        missing = missing | F.col(k).isNull()
    salt = (F.when(F.col("_salts").isNotNull(), F.pmod(spread, F.col("_salts")))
            .when(missing, F.pmod(spread, F.lit(shares))).otherwise(F.lit(0))).cast("int")
    left = facts.join(hot, keys, "left").withColumn("_salt", salt).drop("_salts")
    right = (table.join(hot, keys, "left")
             .withColumn("_salt", F.explode(F.sequence(F.lit(0), F.coalesce(F.col("_salts"), F.lit(1)) - 1))).drop("_salts"))
    joined = left.join(right, [*keys, "_salt"], how)
    out = [c for c in facts.columns if c not in keys]
    if how != "left_semi":
        out += [c for c in table.columns if c not in keys]
    return joined.select(*keys, *[F.col(f"`{c}`") for c in out])


def staged_by_key(df: DataFrame, key: str, shares: int = SHARES, bucket_rows: int = BUCKET_ROWS, sizes: DataFrame | None = None) -> DataFrame:
    """Write rows once, in buckets by their key: no later aggregate, window or join by the key, alone or with more columns, moves them.

    A key with more than 1/shares of the rows, and more than a bucket's, would fill one task. Then the rows are staged as
    they lie, and every later step spreads them by its own keys. ``sizes`` may be a cheaper table that has as many rows of each
    key, or more, or their numbers in a column ``_n``. Rows that lie by the key already are written where they lie.
    """
    if lies_by_key(df, key):
        return kept_by_key(df, key)
    sized = df if sizes is None else sizes
    counts = sized.groupBy(key).agg((F.sum("_n") if sizes is not None and "_n" in sizes.columns else F.count(F.lit(1))).alias("_n"))
    found = counts.agg(F.sum("_n").alias("total"), F.max("_n").alias("most")).first()
    total, most = found["total"] or 0, found["most"] or 0
    if most > bucket_rows and most * shares > total:
        return staged(df)
    buckets = max(df.sparkSession.sparkContext.defaultParallelism, -(-total // bucket_rows))
    return write_bucketed(df, f"stage_{uuid.uuid4().hex}", key, buckets, shared_folder(df.sparkSession))


def _partitioning(df: DataFrame) -> str:
    try:
        return df._jdf.queryExecution().sparkPlan().outputPartitioning().toString()
    except IllegalArgumentException:  # a join of sides that are still to be moved, and have different numbers of parts
        return ""


def lies_by_key(df: DataFrame, key: str) -> bool:
    """Whether the rows lie in buckets by ``key``, so that computing from them again by it moves nothing."""
    return _partitioning(df).startswith(f"hashpartitioning({key}#")


def kept_by_key(df: DataFrame, key: str) -> DataFrame:
    """An intermediate that several steps read, written once: in the buckets in which its rows lie, so that none moves, or else as they lie."""
    found = re.match(rf"hashpartitioning\({re.escape(key)}#\w+, (\d+)\)", _partitioning(df))
    return staged(df) if found is None else write_bucketed(df, f"stage_{uuid.uuid4().hex}", key, int(found[1]), shared_folder(df.sparkSession))
