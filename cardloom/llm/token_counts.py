"""Exact histogram of encoded lengths and what its suffix sums answer.

Documents are counted by encoded length inside the tasks that encode them; one row per task and length is shuffled. The
suffix sums over lengths (documents and tokens of all documents at least as long) answer totals, quantiles and the
tokens that are left under any context limit. Lengths are summed by ranges first, so that no task sees all of them.

Defined results: a null or empty text has length 0, or the one end id where one is asked for. Copies count each. An
empty table gives no rows. Other columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window, functions as F

from .common import running_offsets, stage
from .tokens import encoder, vocabulary

#: Lengths whose sums are taken together.
RANGE = 1024


def length_histogram(docs: DataFrame, path: str | None = None, text_col: str = "text", end: bool = False) -> DataFrame:
    """(length, n_docs): how many documents have each encoded length."""
    path, more = path or vocabulary("byte_bpe_50k.json"), int(end)

    def count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        encode, found = encoder(path), {}
        for batch in batches:
            for at in range(0, len(batch), 512):
                for ids in encode(batch["text"].iloc[at:at + 512]):
                    found[len(ids) // 4 + more] = found.get(len(ids) // 4 + more, 0) + 1
        yield pd.DataFrame({"length": np.array(list(found), np.int64), "n_docs": np.array(list(found.values()), np.int64)})

    return (docs.select(F.col(text_col).cast("string").alias("text")).mapInPandas(count, "length long, n_docs long")
            .groupBy("length").agg(F.sum("n_docs").alias("n_docs")))


def suffix_sums(histogram: DataFrame) -> DataFrame:
    """Per length that occurs: n_docs, docs_at_least, tokens_at_least, truncated_total and the share of documents up to it.

    ``truncated_total`` is the number of tokens left when every document is cut at ``length`` tokens.
    """
    rows = stage(histogram).select("length", "n_docs", (F.col("length") * F.col("n_docs")).alias("tokens"),
                            (-F.floor(F.col("length") / RANGE)).alias("range"), F.lit(0).alias("all"))
    sums = stage(rows.groupBy("all", "range").agg(F.sum("n_docs").alias("docs"), F.sum("tokens").alias("words")))
    sums = running_offsets(sums, ["all"], "range", "docs", "docs_above")
    sums = running_offsets(sums, ["all"], "range", "words", "tokens_above")
    total = sums.withColumns({"total_docs": F.sum("docs").over(Window.partitionBy("all")),
                              "total_tokens": F.sum("words").over(Window.partitionBy("all"))})
    above = Window.partitionBy("range").orderBy(F.col("length").desc()).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    joined = rows.drop("all").join(total.drop("docs", "words", "all"), "range")
    at_least = {"docs_at_least": F.sum("n_docs").over(above) + F.col("docs_above"),
                "tokens_at_least": F.sum("tokens").over(above) + F.col("tokens_above")}
    return joined.withColumns(at_least).select(
        "length", "n_docs", "docs_at_least", "tokens_at_least",
        (F.col("total_tokens") - F.col("tokens_at_least") + F.col("length") * F.col("docs_at_least")).alias("truncated_total"),
        ((F.col("total_docs") - F.col("docs_at_least") + F.col("n_docs")) / F.col("total_docs")).alias("share_up_to"),
        "total_docs", "total_tokens")


def truncated_total(sums: DataFrame, limit: int) -> DataFrame:
    """One row: the tokens left under a context limit, whether or not a document has that length."""
    longer = F.col("length") >= limit
    return sums.agg((F.coalesce(F.sum(F.when(~longer, F.col("length") * F.col("n_docs"))), F.lit(0))
                     + F.coalesce(F.sum(F.when(longer, F.col("n_docs"))), F.lit(0)) * limit).alias("truncated_total"))


def quantile(sums: DataFrame, share: float) -> DataFrame:
    """One row: the least length that at least this share of the documents do not exceed."""
    return sums.filter(F.col("share_up_to") >= share).agg(F.min("length").alias("length"))
