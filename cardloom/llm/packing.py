"""Vector best-fit packing of token pieces into sequences of fixed capacity.

A sequence has three capacities: tokens, documents and attention cost (the sum of squared piece lengths, as pieces attend
within themselves). A piece goes to the open sequence that fits it under every capacity and scores best: by the least
weighted norm of what would be left of the capacities (``norm``), or by the largest weighted dot product of the piece's
needs with what is left (``dot``). Pieces come in descending length.

A piece is described by its length alone, so that the packing needs the histogram of lengths only, never the pieces:
sequences in the same state form a run of numbers, and a run takes as many pieces of one length as it has sequences. The
histogram has one row per length up to the capacity, and the plan a few times as many rows, whatever the input is. Pieces
are numbered within their length by chunks of bounded size, and pick their place from the plan by length and number.

Defined results: a null or empty text is the end id alone. Only a document longer than the capacity is cut; its first
piece takes what is over, all others are full. Documents with equal or null ids are packed like any others. An empty
table gives no rows. Other columns are not read.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window, functions as F

from .common import running_offsets, stage, tidy
from .tokens import encoder, vocabulary

LENGTH = 1024
END = 2
#: Pieces that are numbered together in one task.
CHUNK = 50_000

# ids pass pandas as text, where whole numbers beside nulls would turn into fractions
PIECES = "doc_id string, piece int, start long, length long, ids_crc32 long"


def pieces(docs: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text", length: int = LENGTH,
           end: int = END, with_ids: bool = False) -> DataFrame:
    """Per piece: doc_id, piece, start, length, ids_crc32 and, where asked for, ids (little-endian unsigned 32-bit)."""
    last = np.array([end], "<u4").tobytes()

    def cut(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        encode = encoder(path)
        for batch in batches:
            for at in range(0, len(batch), 512):
                part, rows = batch.iloc[at:at + 512], []
                for doc, ids in zip(part["doc_id"], encode(part["text"])):
                    ids += last
                    start, stop, piece = 0, (len(ids) // 4 - 1) % length + 1, 0
                    while start < len(ids) // 4:
                        own = ids[4 * start:4 * stop]
                        rows.append((doc, piece, start, stop - start, zlib.crc32(own), own)[:6 if with_ids else 5])
                        start, stop, piece = stop, stop + length, piece + 1
                yield pd.DataFrame(rows, columns=["doc_id", "piece", "start", "length", "ids_crc32", "ids"][:6 if with_ids else 5])

    return docs.select(F.col(id_col).cast("string").alias("doc_id"), F.col(text_col).cast("string").alias("text")).mapInPandas(
        tidy(cut), PIECES + (", ids binary" if with_ids else "")).withColumn("doc_id", F.col("doc_id").cast("long"))


def best_fit(histogram: dict[int, int], capacity: tuple[int, int, int], rule: str = "norm",
             weights: tuple[float, float, float] = (1.0, 0.0, 0.0)) -> list[tuple[int, int, int, int, int]]:
    """Rows (length, first number, pieces, first sequence, offset) that place every piece of the histogram."""
    full, weight = np.array(capacity, float), np.array(weights, float)
    left = np.zeros((0, 3))  # capacities left, one row per run of sequences
    first, many = np.zeros(0, np.int64), np.zeros(0, np.int64)
    plan, sequences = [], 0
    for length in sorted(histogram, reverse=True):
        count, number, need = histogram[length], 0, np.array([length, 1, length * length], float)
        per_sequence = int((full // need).min())
        if per_sequence < 1:
            raise ValueError(f"a piece of {length} tokens does not fit an empty sequence")
        while count:
            fits = np.flatnonzero((left >= need).all(1))
            if not len(fits):
                break
            if rule == "norm":
                score = (weight * ((left[fits] - need) / full) ** 2).sum(1)
            else:
                score = -(weight * (need / full) * (left[fits] / full)).sum(1)
            run = fits[np.argmin(score)]
            take = min(count, int(many[run]))
            plan.append((length, number, take, int(first[run]), int(full[0] - left[run, 0])))
            if take < many[run]:  # the rest of the run stays as it is
                left = np.vstack([left, left[run]])
                first, many = np.append(first, first[run] + take), np.append(many, many[run] - take)
                many[run] = take
            left[run] -= need
            count, number = count - take, number + take
        if count:
            for each, runs in ((per_sequence, count // per_sequence), (count % per_sequence, 1)):
                if each and runs:
                    for layer in range(each):
                        plan.append((length, number, runs, sequences, layer * length))
                        number += runs
                    left = np.vstack([left, full - each * need])
                    first, many = np.append(first, sequences), np.append(many, runs)
                    sequences += runs
        open_ = (left[:, 0] > 0) & (left[:, 1] > 0) & (left[:, 2] > 0)
        left, first, many = left[open_], first[open_], many[open_]
    return plan


def numbered(cut: DataFrame, chunk: int = CHUNK) -> DataFrame:
    """With ``number``, counted from 0 within each length. No task sees more than about ``chunk`` pieces of a length."""
    chunks = -(-cut.count() // chunk) or 1
    split = cut.withColumn("chunk", F.pmod(F.xxhash64("doc_id", "piece", "ids_crc32"), F.lit(chunks)))
    sums = running_offsets(split.groupBy("length", "chunk").agg(F.count("*").alias("n")), ["length"], "chunk", "n", "before")
    own = F.row_number().over(Window.partitionBy("length", "chunk").orderBy("doc_id", "piece", "ids_crc32"))
    return (split.withColumn("own", own).join(stage(sums.drop("n")), ["length", "chunk"])
            .withColumn("number", F.col("own") - 1 + F.col("before")).drop("own", "before", "chunk"))


def packed(docs: DataFrame, path: str | None = None, id_col: str = "doc_id", text_col: str = "text", length: int = LENGTH,
           end: int = END, most_documents: int | None = None, most_cost: int | None = None, rule: str = "norm",
           weights: tuple[float, float, float] = (1.0, 0.0, 0.0), chunk: int = CHUNK) -> DataFrame:
    """One row per piece: doc_id, piece, start, length, ids_crc32, sequence_id, offset.

    Without ``most_documents`` and ``most_cost`` these two capacities are what ``length`` tokens can need at most, so
    that the tokens alone bind and as few sequences as possible are used.
    """
    path = path or vocabulary("byte_bpe_50k.json")
    cut = stage(pieces(docs, path, id_col, text_col, length, end))
    histogram = {int(r["length"]): int(r["n"]) for r in cut.groupBy("length").agg(F.count("*").alias("n")).collect()}
    plan = best_fit(histogram, (length, most_documents or length, most_cost or length * length), rule, weights)
    places = docs.sparkSession.createDataFrame(
        plan, "length long, first_number long, many long, first_sequence long, offset long")
    inside = (F.col("number") >= F.col("first_number")) & (F.col("number") < F.col("first_number") + F.col("many"))
    # a few rows per length up to the capacity, whatever the input
    return (numbered(cut, chunk).withColumnRenamed("length", "_length")
            .join(F.broadcast(places), (F.col("_length") == F.col("length")) & inside)
            .select("doc_id", "piece", "start", "length", "ids_crc32",
                    (F.col("first_sequence") + F.col("number") - F.col("first_number")).alias("sequence_id"), "offset"))
