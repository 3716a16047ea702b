"""Token ids in files: canonical length-limited Huffman codes from global counts, decoded by table in independent blocks.

Writing encodes every text, counts the ids of all documents, gives each id a code length by package-merge under a limit
and turns the lengths into canonical codes, so that the lengths alone restore code and table. Documents are put in
ascending order of id by ranges; each range is written as blocks of a fixed number of ids. A block holds its bits, the bit
offset of every ``STEP``-th id and the documents its ids belong to. A reader decodes all stretches of a block side by side
with one table, and any block without its neighbours.

The container is a folder of two Parquet tables: ``code`` (id, count, bits) and ``blocks``. A task holds one block at a
time. Only the counts, at most one row per vocabulary entry, and the sums per range pass the driver or one task.

Defined results: a null or empty text has the end id alone. Documents are ordered by id, null first, those that share
an id by a hash of their ids and then the ids. A document may span any number of blocks. An empty table gives no rows.
Other columns are not read.
"""

from __future__ import annotations

import zlib
from array import array
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession, functions as F

from cardloom.session import shared_folder

from .common import running_offsets, stage, tidy
from .tokens import encoder, vocabulary

END = 1
#: Most bits of a code; one table of 2 ** LIMIT entries decodes. 25 at most, raised by itself for larger vocabularies.
LIMIT = 16
#: Ids in a block, and ids between two of its bit offsets.
BLOCK, STEP = 1 << 19, 256
#: Bytes, about, of each of the two generations of chunks that a worker remembers while it encodes.
REMEMBERED = 160 << 20

BLOCKS = ("part int, block int, first_id long, n_ids int, first_document long, doc_ids array<bigint>, n_tokens array<int>, "
          "continues boolean, goes_on boolean, bit_offsets binary, bits binary")


# --- the code ---------------------------------------------------------------------------------------------------------

def code_lengths(counts: np.ndarray, limit: int) -> np.ndarray:
    """Bits of each symbol by package-merge: the least total under ``limit`` bits. All counts are positive."""
    n = len(counts)
    if n <= 1:
        return np.ones(n, np.uint8)
    order = np.argsort(counts, kind="stable")
    leaves, packages, levels = counts[order].astype(np.int64), np.zeros(0, np.int64), []
    for _ in range(limit):
        both = np.concatenate([leaves, packages])
        rank = np.argsort(both, kind="stable")
        levels.append(rank < n)
        both = both[rank]
        packages = both[:len(both) // 2 * 2].reshape(-1, 2).sum(1)
    bits, wanted = np.zeros(n, np.int64), 2 * n - 2
    for is_leaf in reversed(levels):
        own = int(is_leaf[:wanted].sum())
        bits[:own] += 1
        wanted = 2 * (wanted - own)
    out = np.zeros(n, np.uint8)
    out[order] = bits
    return out


class Code:
    """Canonical code of ids with given numbers of bits: shorter codes first, equal lengths by id."""

    def __init__(self, ids: np.ndarray, bits: np.ndarray):
        order = np.lexsort((ids, bits))
        ids, bits = ids[order].astype(np.int64), bits[order].astype(np.int64)
        self.width = int(bits.max(initial=1))
        spans = np.left_shift(1, self.width - bits)  # table entries of each code
        starts = np.cumsum(spans) - spans
        self.code = np.zeros(int(ids.max(initial=0)) + 1, np.uint64)
        self.bits = np.zeros(len(self.code), np.int64)
        self.code[ids], self.bits[ids] = starts >> (self.width - bits), bits
        self.symbol, self.length = np.zeros(1 << self.width, np.uint32), np.ones(1 << self.width, np.uint8)
        self.symbol[:spans.sum()], self.length[:spans.sum()] = np.repeat(ids, spans), np.repeat(bits, spans)

    def encode(self, ids: np.ndarray, step: int) -> tuple[bytes, bytes]:
        """Bits of the ids, and the bit offset of each ``step``-th id as little-endian unsigned 32-bit."""
        bits = self.bits[ids]
        ends = np.cumsum(bits)
        starts = ends - bits
        word, shift = starts >> 5, (64 - (starts & 31) - bits).astype(np.uint64)
        window = self.code[ids] << shift  # a code lies in the 64 bits from its first word on
        words = np.zeros(int(ends[-1] >> 5) + 2, np.uint64)
        runs = np.flatnonzero(np.diff(word, prepend=-1))
        words[word[runs]] += np.add.reduceat(window >> np.uint64(32), runs)
        words[word[runs] + 1] += np.add.reduceat(window & np.uint64(0xFFFFFFFF), runs)
        return words.astype(">u4").tobytes()[:int(ends[-1] + 7) // 8], starts[::step].astype("<u4").tobytes()

    def decode(self, bits: bytes, offsets: bytes, n: int, step: int) -> np.ndarray:
        """The ``n`` ids, all stretches of ``step`` ids side by side."""
        raw = np.frombuffer(bits + bytes(8), np.uint8).astype(np.uint32)
        window = raw[:-3] << np.uint32(24) | raw[1:-2] << np.uint32(16) | raw[2:-1] << np.uint32(8) | raw[3:]
        at = np.frombuffer(offsets, "<u4").astype(np.int64)
        out, last = np.empty((len(at), step), np.uint32), len(window) - 1
        mask, room = np.uint32((1 << self.width) - 1), 32 - self.width
        for k in range(min(step, n)):
            entry = window[np.minimum(at >> 3, last)] >> (room - (at & 7)).astype(np.uint32) & mask
            out[:, k] = self.symbol[entry]
            at += self.length[entry]
        return out.reshape(-1)[:n]


# --- checksums of documents that span blocks ------------------------------------------------------------------------

#: The checksum's polynomial, lowest power in the highest bit.
POLYNOMIAL = 0xEDB88320


def _times(a: int, b: int) -> int:
    """Product of two polynomials over GF(2) modulo the checksum's."""
    out = 0
    for power in range(31, -1, -1):
        if a >> power & 1:
            out ^= b
        b = b >> 1 ^ (POLYNOMIAL if b & 1 else 0)
    return out


def joined_checksum(first: int, second: int, n_bytes: int) -> int:
    """Checksum of two byte strings, one after the other, from theirs and the second's length."""
    shift, square, power = 1 << 31, 1 << 30, 8 * n_bytes  # 1 and x
    while power:
        if power & 1:
            shift = _times(shift, square)
        square, power = _times(square, square), power >> 1
    return _times(first, shift) ^ second


# --- writing and reading ----------------------------------------------------------------------------------------------

def width(path: str, end: int = END) -> str:
    """H where all ids of the vocabulary take 16 bits, else I."""
    from tokenizers import Tokenizer

    return "H" if max(Tokenizer.from_file(path).get_vocab_size(), end + 1) <= 1 << 16 else "I"


def encoded(docs: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text", end: int = END) -> DataFrame:
    """Per row of ``docs``: doc_id, ids (little-endian, of the width that ``width`` tells, the end id last).

    A task adds one row without ``ids`` that has in ``seen`` and ``times`` which ids it wrote and how often.
    """
    kind = width(path, end)
    last = array(kind, [end]).tobytes()

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        encode, total = encoder(path, kind, REMEMBERED), np.zeros(0, np.int64)
        for batch in batches:
            for at in range(0, len(batch), 512):
                part = batch.iloc[at:at + 512]
                ids = [x + last for x in encode(part["text"])]
                found = np.bincount(np.frombuffer(b"".join(ids), kind), minlength=len(total))
                found[:len(total)] += total
                total = found
                yield pd.DataFrame({"doc_id": part["doc_id"], "ids": ids, "seen": None, "times": None})
        seen = np.flatnonzero(total)
        yield pd.DataFrame({"doc_id": [None], "ids": [None], "seen": [seen], "times": [total[seen]]})

    # ids pass pandas as text, where whole numbers beside nulls would turn into fractions
    return docs.select(F.col(id_col).cast("string").alias("doc_id"), F.col(text_col).cast("string").alias("text")).mapInPandas(
        tidy(run), "doc_id string, ids binary, seen array<long>, times array<long>").withColumn("doc_id", F.col("doc_id").cast("long"))


def id_counts(rows: DataFrame) -> DataFrame:
    """(id, count) over the ids of all rows, from what each task counted."""
    pairs = rows.filter("seen IS NOT NULL").select(F.explode(F.arrays_zip("seen", "times")).alias("pair"))
    return pairs.groupBy(F.col("pair.seen").alias("id")).agg(F.sum("pair.times").alias("count"))


def write(docs: DataFrame, folder: str, path: str | None = None, id_col: str = "doc_id", text_col: str = "text",
          end: int = END, limit: int = LIMIT, block: int = BLOCK, step: int = STEP) -> None:
    """Encode all texts and write their ids, in ascending order of document id, to ``folder``."""
    spark = docs.sparkSession
    path = path or vocabulary("word_bpe_49k.json")
    kind = width(path, end)
    rows = stage(encoded(docs, path, id_col, text_col, end), "zstd")
    counts, rows = id_counts(rows), rows.filter("ids IS NOT NULL").select("doc_id", "ids")
    counts = counts.toPandas().sort_values("id")  # one row per vocabulary entry at most
    limit = max(limit, int(len(counts)).bit_length())
    bits = code_lengths(counts["count"].to_numpy(), limit)
    spark.createDataFrame(counts.assign(bits=bits.astype(np.int32)), "id long, count long, bits int").coalesce(1).write.parquet(
        f"{folder}/code")
    ids, bits = counts["id"].to_numpy().astype(np.int64), bits.astype(np.int64)

    def to_blocks(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        code, part = Code(ids, bits), 0
        held, ends, documents, size = [], [], [], 0  # ids, then per document its end among the held ids and its id
        number, first_id, first_document, continues = 0, 0, 0, False

        def take(n: int) -> pd.DataFrame:
            nonlocal held, ends, documents, size, number, first_id, first_document, continues
            stream = held[0] if len(held) == 1 else np.concatenate(held)
            upto = np.array(ends)
            inside = int(np.searchsorted(upto, n, "left")) + 1  # documents with ids among the first n
            inner = np.minimum(upto[:inside], n)
            goes_on = bool(upto[inside - 1] > n)
            bits_, offsets = code.encode(stream[:n], step)
            row = (part, number, first_id, n, first_document, documents[:inside], np.diff(inner, prepend=0).tolist(),
                   continues, goes_on, offsets, bits_)
            done = inside - goes_on
            held, size = ([stream[n:]] if n < size else []), size - n
            ends, documents = [e - n for e in ends[done:]], documents[done:]
            number, first_id, first_document, continues = number + 1, first_id + n, first_document + done, goes_on
            return pd.DataFrame([row], columns=[c.split()[0] for c in BLOCKS.split(", ")])

        for batch in batches:
            part = int(batch["part"].iloc[0]) if len(batch) else part
            for doc, raw in zip(batch["doc_id"], batch["ids"]):
                own = np.frombuffer(raw, kind)
                held.append(own)
                size += len(own)
                ends.append(size)
                documents.append(None if doc is None else int(doc))
                while size >= block:
                    yield take(block)
        if size:
            yield take(size)

    hashed = F.xxhash64("ids")
    ordered = (rows.withColumn("hash", hashed).repartitionByRange(F.col("doc_id").asc_nulls_first(), "hash")
               .sortWithinPartitions(F.col("doc_id").asc_nulls_first(), "hash", "ids"))
    ordered.select(F.col("doc_id").cast("string"), "ids", F.spark_partition_id().alias("part")).mapInPandas(tidy(to_blocks), BLOCKS).write.option(
        "compression", "none").parquet(f"{folder}/blocks")


def read(spark: SparkSession, folder: str, step: int = STEP, with_ids: bool = False) -> DataFrame:
    """Decode the files: part, document (its number in the part), block, doc_id, first_id, n_tokens, ids_crc32, whole
    and, where asked for, ids. One row per document and block; ``whole`` tells those that lie in one block."""
    code_rows = spark.read.parquet(f"{folder}/code").toPandas()
    ids, bits = code_rows["id"].to_numpy().astype(np.int64), code_rows["bits"].to_numpy().astype(np.int64)
    columns = ["part", "document", "block", "doc_id", "first_id", "n_tokens", "ids_crc32", "whole", "ids"][:9 if with_ids else 8]

    def decode(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        code = Code(ids, bits)
        for batch in batches:
            for b in batch.itertuples():
                raw = memoryview(code.decode(b.bits, b.bit_offsets, b.n_ids, step).astype("<u4", copy=False)).cast("B")
                rows, at, last = [], 0, len(b.n_tokens) - 1
                for k, (doc, n) in enumerate(zip(b.doc_ids, b.n_tokens)):
                    own = raw[4 * at:4 * (at + n)]
                    whole = not (k == 0 and b.continues or k == last and b.goes_on)
                    rows.append((b.part, b.first_document + k, b.block, doc, b.first_id + at, n,
                                 zlib.crc32(own), whole, *([bytes(own)] if with_ids else [])))
                    at += int(n)
                yield pd.DataFrame(rows, columns=columns)

    schema = ("part int, document long, block int, doc_id string, first_id long, n_tokens long, ids_crc32 long, whole boolean"
              + (", ids binary" if with_ids else ""))
    blocks = spark.read.schema(BLOCKS).parquet(f"{folder}/blocks")
    return blocks.withColumn("doc_ids", F.col("doc_ids").cast("array<string>")).mapInPandas(tidy(decode), schema).withColumn(
        "doc_id", F.col("doc_id").cast("long"))


def document_table(spark: SparkSession, folder: str, step: int = STEP) -> DataFrame:
    """From the files alone, per document: doc_id, start, n_tokens, ids_crc32."""
    found = stage(read(spark, folder, step))

    def join_parts(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            rows = []
            for pieces in batch["pieces"]:
                crc = 0
                for p in pieces:
                    crc = joined_checksum(crc, p["ids_crc32"], 4 * p["n_tokens"])
                rows.append(crc)
            yield batch[["part", "doc_id", "first_id", "n_tokens"]].assign(ids_crc32=rows)

    # one short row per block that a document touches
    split = (found.filter("not whole").groupBy("part", "document").agg(
        F.first("doc_id").alias("doc_id"), F.min("first_id").alias("first_id"), F.sum("n_tokens").alias("n_tokens"),
        F.sort_array(F.collect_list(F.struct("block", "n_tokens", "ids_crc32"))).alias("pieces"))
        .select("part", F.col("doc_id").cast("string"), "first_id", "n_tokens", "pieces")
        .mapInPandas(join_parts, "part int, doc_id string, first_id long, n_tokens long, ids_crc32 long")
        .withColumn("doc_id", F.col("doc_id").cast("long")))
    rows = found.filter("whole").select("part", "doc_id", "first_id", "n_tokens", "ids_crc32").unionByName(split)
    parts = (spark.read.schema(BLOCKS).parquet(f"{folder}/blocks").groupBy("part").agg(F.sum("n_ids").alias("n_ids"))
             .withColumn("all", F.lit(0)))
    parts = stage(running_offsets(parts, ["all"], "part", "n_ids", "before").select("part", "before"))
    return rows.join(parts, "part").select("doc_id", (F.col("before") + F.col("first_id")).alias("start"), "n_tokens", "ids_crc32")


def written_and_read(docs: DataFrame, path: str | None = None, id_col: str = "doc_id", text_col: str = "text", end: int = END,
                     limit: int = LIMIT, block: int = BLOCK, step: int = STEP) -> DataFrame:
    """Write the ids of ``docs`` to a fresh shared folder, read the files back and describe each document by them."""
    folder = shared_folder(docs.sparkSession)
    write(docs, folder, path, id_col, text_col, end, limit, block, step)
    return document_table(docs.sparkSession, folder, step)
