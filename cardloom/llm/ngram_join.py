"""Exact Jaccard join of documents on word shingles, as a join in a metric space.

Jaccard distance is a metric, so pivots split the documents into Voronoi regions: a document is at home with its nearest
pivot, and goes as a guest to every other region where the triangle inequality leaves room for a partner. A region is
joined by itself: for each document at home all partners are there, so no link is lost. Regions that are still large are
split again with pivots of their own. Comparisons that could only join what links already connect are left out, so that a
large group of near copies costs as many comparisons as it has documents.

Documents without a common shingle are at distance 1 from each other whatever the pivots are, and no pivot document can
tell them apart. The first split therefore takes as pivots single shingles, those rare in the corpus first. Partners at
distance 0.2 at most share at least one of the first floor(0.2 n) + 1 of their n shingles in that order (each lacks at
most 0.2 n of the other's), so a document goes to those of them that others have; with less than 80% of its shingles
shared it can have no partner. Regions that share a document are put together; only their members' whole shingle sets are
moved. From there on pivots are documents. With radius ``WIDE`` documents far from all pivots make a region of their own,
again with its guests.

How many documents have a shingle is counted in buckets of bounded size, and told to the documents that have it.

Defined results: words are runs of non-blank characters, A-Z in lower case. With fewer than five words the whole sequence
is the one shingle. A text that is null or has no words has no shingles and no links. Documents with equal sets are one
class and link with each other. Rows with a null id link like others but never name a component; a component without any
id is null. Rows that share an id stay rows of their own. An empty table gives no rows. Other columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F

from .common import may_have, stage, tidy, tidy_group, whole, word_count
from .components import connected

WORDS = 5
#: Least similarity in hundredths.
PERCENT = 80
#: Shingles of a chunk of documents, of a bucket that counts them, and slots of the bitmap of region members.
CHUNK_SHINGLES, BUCKET, SLOTS = 1 << 20, 1 << 21, 1 << 22
#: Documents and shingles that a region may hold before it is split.
LEAF, LEAF_SHINGLES = 1000, 1 << 22
#: Pivots per split, splits in a row, and how far a split may multiply its documents before blocks take over.
PIVOTS, ROUNDS, GROWTH = 64, 8, 2
#: Distance from a pivot up to which a region keeps documents at home.
WIDE = 0.5
#: Documents of one region that a task compares with its pivots at a time.
CHUNK = 2_000
#: Bytes of text whose words are hashed at a time.
BYTES = 1 << 20

_DRAW = np.random.default_rng(20240229)
_BYTE = _DRAW.integers(0, 1 << 64, 256, np.uint64, False)
_PLACE = _DRAW.integers(0, 1 << 64, WORDS, np.uint64, False) | np.uint64(1)
_BASE = np.uint64(0x9E3779B97F4A7C15)


def _mixed(x: np.ndarray) -> np.ndarray:
    """Spread the bits of each number over all of its bits, one to one."""
    x = x ^ (x >> np.uint64(31))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(33))


_POWERS = np.ones(1, np.uint64)


def _powers(n: int) -> np.ndarray:
    global _POWERS
    if len(_POWERS) < n:
        _POWERS = np.cumprod(np.concatenate([np.ones(1, np.uint64), np.full(max(n, BYTES * 5 // 4), _BASE)]), dtype=np.uint64)
    return _POWERS


def _word_hashes(data: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """64-bit hashes of the words of texts that lie back to back, and how many words each text has."""
    hashes, counts, at = [], np.zeros(len(ends), np.int64), 0
    while at < len(data):
        stop = min(at + BYTES, len(data))
        if stop < len(data):  # on to where no word is cut
            border = ends[np.searchsorted(ends, stop)]
            ahead = stop
            while ahead < border:
                gap = np.flatnonzero(_blank(data[ahead:min(ahead + 4096, border)]))
                if len(gap):
                    border = ahead + gap[0]
                    break
                ahead += 4096
            stop = int(border)
        part = data[at:stop]
        part = np.where((part >= 65) & (part <= 90), part + 32, part)
        inside = ~_blank(part)
        first = inside.copy()
        first[1:] &= ~inside[:-1]
        own = ends[np.searchsorted(ends, at, "right"):np.searchsorted(ends, stop)] - at  # texts that end within
        own = own[(own > 0) & (own < len(part))]
        first[own] |= inside[own]
        last = inside.copy()
        last[:-1] &= ~inside[1:]
        last[own - 1] |= inside[own - 1]
        starts, stops = np.flatnonzero(first), np.flatnonzero(last) + 1
        power = _powers(len(part) + 1)
        sums = np.zeros(len(part) + 1, np.uint64)
        np.cumsum(_BYTE[part] * power[:len(part)], out=sums[1:])
        hashes.append(_mixed((sums[stops] - sums[starts]) * power[len(part) - starts]
                             * _inverse(len(part)) + (stops - starts).astype(np.uint64)))
        counts += np.bincount(np.searchsorted(ends, starts + at, "right"), minlength=len(ends))
        at = stop
    return (np.concatenate(hashes) if hashes else np.zeros(0, np.uint64)), counts


def _blank(data: np.ndarray) -> np.ndarray:
    return (data == 32) | ((data >= 9) & (data <= 13))


def _inverse(n: int) -> np.uint64:
    """The base to the power of -n modulo 2 ** 64, so that a word's hash does not depend on where it stands."""
    return np.uint64(pow(pow(int(_BASE), -1, 1 << 64), n, 1 << 64))


def shingle_sets(data: np.ndarray, ends: np.ndarray) -> list[np.ndarray]:
    """The sorted distinct shingles of each text."""
    words, counts = _word_hashes(data, ends)
    out, at = [], 0
    for n in counts.tolist():
        own = words[at:at + n]
        at += n
        if n == 0:
            out.append(np.zeros(0, np.uint64))
        elif n < WORDS:
            total = np.array([n], np.uint64)
            for k in range(n):
                total = _mixed(total + own[k:k + 1] * _PLACE[k])
            out.append(total)
        else:
            m = n - WORDS + 1
            total = own[:m] * _PLACE[0]
            for k in range(1, WORDS):
                total = total + own[k:k + m] * _PLACE[k]
            out.append(np.unique(_mixed(total)))
    return out


def _texts(batch: pa.RecordBatch, column: str) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """(first row, last row + 1, bytes, ends) of groups of rows of about ``BYTES`` bytes."""
    texts = batch.column(column)
    if pa.types.is_string(texts.type):
        texts = texts.cast(pa.large_string())
    marks = np.frombuffer(texts.buffers()[1], np.int64)[texts.offset:texts.offset + len(texts) + 1] if len(texts) else np.zeros(1, np.int64)
    data = np.frombuffer(texts.buffers()[2] or b"", np.uint8)
    row = 0
    while row < len(texts):
        last = max(row + 1, int(np.searchsorted(marks, marks[row] + BYTES)) - 1)
        last = min(last, len(texts))
        yield row, last, data[marks[row]:marks[last]], marks[row + 1:last + 1] - marks[row]
        row = last


def _sets(batch: pa.RecordBatch) -> Iterator[tuple[int, np.ndarray]]:
    for row, _, data, ends in _texts(batch, "text"):
        yield from enumerate(shingle_sets(data, ends), row)


def _class_key(shingles: np.ndarray) -> tuple[int, int]:
    """Two 64-bit sums of mixed shingles: the name of a set."""
    one, two = _mixed(shingles ^ np.uint64(0xA5A5A5A5A5A5A5A5)).sum(dtype=np.uint64), _mixed(shingles * _PLACE[1]).sum(dtype=np.uint64)
    return int(one.astype(np.int64)), int(two.astype(np.int64))


def _lists(arrays: list[np.ndarray]) -> pa.Array:
    marks = np.concatenate([[0], np.cumsum([len(a) for a in arrays])]).astype(np.int32)
    flat = np.concatenate(arrays) if arrays else np.zeros(0, np.uint64)
    return pa.ListArray.from_arrays(pa.array(marks), pa.array(flat.view(np.int64)))


# --- a bitmap of fixed size ---------------------------------------------------------------------------------------------

def _bitmap(rows: DataFrame) -> np.ndarray:
    """Which of ``SLOTS`` slots the numbers in column ``node`` fall on; SLOTS / 8 bytes reach the driver."""
    def mark(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        seen = np.zeros(SLOTS, bool)
        for batch in batches:
            seen[batch["node"].to_numpy() % SLOTS] = True
        bits = np.packbits(seen).reshape(64, -1)
        kept = np.flatnonzero(bits.any(1))
        yield pd.DataFrame({"slice": kept, "bits": [bits[k].tobytes() for k in kept]})

    def merge(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        total: dict[int, np.ndarray] = {}
        for batch in batches:
            for k, raw in zip(batch["slice"], batch["bits"]):
                bits = np.frombuffer(raw, np.uint8)
                total[k] = total[k] | bits if k in total else bits
        yield pd.DataFrame({"slice": list(total), "bits": [x.tobytes() for x in total.values()]})

    out = np.zeros((64, SLOTS // 512), np.uint8)
    for r in rows.mapInPandas(mark, "slice int, bits binary").repartition("slice").mapInPandas(merge, "slice int, bits binary").collect():
        out[r["slice"]] = np.frombuffer(r["bits"], np.uint8)
    return np.unpackbits(out.reshape(-1)).astype(bool)


# --- which shingles are shared ----------------------------------------------------------------------------------------

SENT = ("bucket int, chunk long, code binary, owner binary, many binary, doc_ids array<string>, sizes array<bigint>, ones array<bigint>, "
        "twos array<bigint>")
_SENT = pa.schema([("bucket", pa.int32()), ("chunk", pa.int64()), ("code", pa.binary()), ("owner", pa.binary()), ("many", pa.binary()),
                   ("doc_ids", pa.list_(pa.string())), *[(c, pa.list_(pa.int64())) for c in ("sizes", "ones", "twos")]])


def _send(chunk: int, ids: list, sets: list[np.ndarray], buckets: int) -> pa.RecordBatch:
    """A chunk of documents as rows: its distinct shingles by bucket, each with one document that has it and how many have it;
    and, under a bucket below zero, the documents and where those shingles stand that several of them have.

    Within a bucket a shingle is told by 32 bits; two that fall together count as shared, which costs work and no link.
    """
    flat = np.concatenate(sets) if sets else np.zeros(0, np.uint64)
    owner = np.repeat(np.arange(len(sets), dtype=np.uint16), [len(x) for x in sets])
    code = (flat >> np.uint64(32)) % np.uint64(buckets) << np.uint64(32) | flat & np.uint64(0xFFFFFFFF)
    order = np.argsort(code, kind="stable")
    code, owner = code[order], owner[order]
    first = np.flatnonzero(np.concatenate([np.ones(min(len(code), 1), bool), code[1:] != code[:-1]]))
    many = np.diff(np.append(first, len(code)))
    twice = np.repeat(many > 1, many)
    edges = np.searchsorted(code[first] >> np.uint64(32), np.arange(buckets + 1, dtype=np.uint64))
    keys = [_class_key(x) for x in sets]
    rows = [(-1 - chunk % buckets, chunk, code[twice].tobytes(), owner[twice].tobytes(), None, ids, [len(x) for x in sets],
             [k[0] for k in keys], [k[1] for k in keys])]
    for b in np.flatnonzero(np.diff(edges)):
        own = first[edges[b]:edges[b + 1]]
        rows.append((int(b), chunk, (code[own] & np.uint64(0xFFFFFFFF)).astype("<u4").tobytes(), owner[own].astype("<u2").tobytes(),
                     np.minimum(many[edges[b]:edges[b + 1]], 255).astype(np.uint8).tobytes(), None, None, None, None))
    return pa.RecordBatch.from_pydict(dict(zip(_SENT.names, map(list, zip(*rows)))), schema=_SENT)


def shared_shingles(texts: DataFrame) -> DataFrame:
    """Per chunk of documents the rows of ``SENT``: its documents, and of its shingles those that other documents have as well.

    A chunk sends each distinct shingle once, so that a shingle of very many documents arrives once per chunk. What comes
    back has in ``many`` how many documents have it.
    """
    spark = texts.sparkSession
    characters = texts.agg(F.sum(F.length("text"))).first()[0] or 0
    buckets = int(max(characters // (6 * BUCKET), int(spark.conf.get("spark.sql.shuffle.partitions")), 1))

    def send(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        chunk, ids, sets, size = TaskContext.get().partitionId() << 32, [], [], 0
        for batch in batches:
            names = batch.column("doc_id").cast(pa.string()).to_pylist()
            for row, shingles in _sets(batch):
                ids.append(names[row])
                sets.append(shingles)
                size += len(shingles)
                if size >= CHUNK_SHINGLES or len(sets) == 1 << 16:
                    yield _send(chunk, ids, sets, buckets)
                    chunk, ids, sets, size = chunk + 1, [], [], 0
        if sets:
            yield _send(chunk, ids, sets, buckets)

    def answer(rows: pd.DataFrame) -> pd.DataFrame:
        bucket = int(rows["bucket"].iloc[0])
        if bucket < 0:
            return rows
        codes = [np.frombuffer(x, "<u4") for x in rows["code"]]
        flat = np.concatenate(codes)
        many = np.concatenate([np.frombuffer(x, np.uint8) for x in rows["many"]]).astype(np.int64)
        order = np.argsort(flat, kind="stable")
        new = np.concatenate([[True], flat[order][1:] != flat[order][:-1]])
        total = np.empty(len(flat), np.int64)
        total[order] = np.add.reduceat(many[order], np.flatnonzero(new))[np.cumsum(new) - 1]
        out, at = [], 0
        for chunk, own, owner in zip(rows["chunk"], codes, rows["owner"]):
            count = total[at:at + len(own)]
            at += len(own)
            kept = count > 1
            if kept.any():
                code = own[kept].astype(np.uint64) | np.uint64(bucket << 32)
                out.append((bucket, chunk, code.tobytes(), np.frombuffer(owner, "<u2")[kept].tobytes(),
                            np.minimum(count[kept], 65535).astype("<u2").tobytes(), None, None, None, None))
        return pd.DataFrame(out, columns=list(rows.columns))

    return texts.mapInArrow(tidy(send), SENT).groupBy("bucket").applyInPandas(tidy_group(answer), SENT)


def rare_heads(rows: pd.DataFrame, percent: int) -> pd.DataFrame:
    """Of one chunk, per document that may have a partner: one, and the pivots it goes to.

    At least ``percent`` hundredths of its shingles must be shared. The rarest come first, those of this document alone
    before all; of the first (1 - percent / 100) n + 1, the shared ones are the pivots.
    """
    meta = rows[rows["bucket"] < 0].iloc[0]
    rest = rows[rows["bucket"] >= 0]
    code = np.concatenate([np.zeros(0, np.uint64), *[np.frombuffer(x, np.uint64) for x in rest["code"]]])
    owner = np.concatenate([np.zeros(0, np.uint16), *[np.frombuffer(x, np.uint16) for x in rest["owner"]]])
    many = np.concatenate([np.zeros(0, np.uint16), *[np.frombuffer(x, np.uint16) for x in rest["many"]]])
    order = np.argsort(code)
    code, owner, many = code[order], owner[order], many[order]
    twice, holders = np.frombuffer(meta["code"], np.uint64), np.frombuffer(meta["owner"], np.uint16)
    once = ~np.isin(code, twice)
    code, owner, many = (np.concatenate([code[once], twice]), np.concatenate([owner[once], holders]),
                         np.concatenate([many[once], many[np.searchsorted(code, twice)] if len(twice) else many[:0]]))
    order = np.lexsort((code, many, owner))
    code, owner = code[order], owner[order]
    sizes = np.asarray(meta["sizes"], np.int64)
    marks = np.searchsorted(owner, np.arange(len(sizes) + 1))
    shared, least = np.diff(marks), (percent * sizes + 99) // 100
    own = np.flatnonzero((sizes > 0) & (shared >= least))
    pivots = [code[marks[i]:marks[i] + shared[i] - least[i] + 1].view(np.int64) for i in own]
    return pd.DataFrame({"one": np.asarray(meta["ones"], np.int64)[own], "pivots": pd.Series(pivots, dtype=object)})


# --- joining within a region ----------------------------------------------------------------------------------------

class Postings:
    """Which of some sets hold a shingle."""

    def __init__(self, sets: list[np.ndarray]):
        flat = np.concatenate(sets) if sets else np.zeros(0, np.int64)
        owner = np.repeat(np.arange(len(sets)), [len(x) for x in sets])
        order = np.argsort(flat, kind="stable")
        self.flat, self.owner, self.sizes = flat[order], owner[order], np.array([len(x) for x in sets], np.int64)

    def shared(self, own: np.ndarray) -> np.ndarray:
        """How many shingles ``own`` shares with each of the sets."""
        low, high = np.searchsorted(self.flat, own, "left"), np.searchsorted(self.flat, own, "right")
        n = high - low
        at = np.repeat(low - np.cumsum(n) + n, n) + np.arange(n.sum())
        return np.bincount(self.owner[at], minlength=len(self.sizes))


def _lowest(groups: np.ndarray, members: np.ndarray) -> None:
    """Merge the groups of ``members`` under the lowest of their numbers."""
    found = np.unique(groups[members])
    groups[np.isin(groups, found)] = found[0]


MEMBER = "region string, key binary, settled boolean, home boolean, shingles array<bigint>"
EDGE = "key binary, other binary"


def _join_leaf(rows: pd.DataFrame, percent: int) -> pd.DataFrame:
    """Edges that connect all documents of a region that links connect. Settled ones are known to be connected.

    One document after the other is compared with all that are left, until those left are all connected.
    """
    keys, sets = rows["key"].to_numpy(), list(rows["shingles"])
    settled = rows["settled"].to_numpy(bool)
    postings, group, left = Postings(sets), np.arange(len(sets)), np.ones(len(sets), bool)
    if settled.any():
        group[settled] = np.flatnonzero(settled)[0]
    before = group.copy()
    while True:
        names, counts = np.unique(group[left], return_counts=True)
        if len(names) < 2 or not (left & ~settled).any():
            break
        minor = np.flatnonzero(left & ~settled & (group != names[counts.argmax()]))
        me = minor[0] if len(minor) else np.flatnonzero(left & ~settled)[0]
        both = postings.shared(sets[me])
        linked = 100 * both >= percent * (postings.sizes + len(sets[me]) - both)
        _lowest(group, np.flatnonzero(linked & left))
        left[me] = False
    moved = np.flatnonzero(group != np.arange(len(group)))
    moved = moved[(group[moved] != before[moved]) | ~settled[moved]]
    return pd.DataFrame({"key": keys[moved], "other": keys[group[moved]]})


def _split(members: DataFrame, sizes: DataFrame, percent: int) -> tuple[DataFrame, DataFrame, DataFrame]:
    """One round over regions that are too large: edges found, the members of the regions that come of them, and the members
    of regions whose documents lie so evenly that the windows would put most of them everywhere (``GROWTH``).

    Every document is compared with the pivots of its region, which settles the pivots. Cells whose pivots are connected
    make one region; in it, the documents linked with its pivots are connected already ("settled").
    """
    reach = 1 - percent / 100 + 1e-9
    salts = sizes.select("region", F.ceil(F.col("n") / CHUNK).alias("salts"))
    order = Window.partitionBy("region").orderBy(F.xxhash64("key", "region"), "key")
    pivots = stage(members.filter("not settled").withColumn("pivot", F.row_number().over(order) - 1)
                   .filter(F.col("pivot") < PIVOTS).select("region", "pivot", "key", "shingles"))
    salted = members.join(salts, "region").withColumn("salt", F.pmod(F.xxhash64("key"), F.col("salts"))).drop("salts")
    spread = pivots.join(salts, "region").withColumn(
        "salt", F.explode(F.sequence(F.lit(0).cast("long"), F.col("salts") - 1))).drop("salts")

    def measure(rows: pd.DataFrame, near: pd.DataFrame) -> pd.DataFrame:
        near = near.sort_values("pivot")
        names, postings = set(near["key"]), Postings(list(near["shingles"]))
        group, out = np.arange(len(near) + 1), []  # the last stands for the settled documents
        for key, settled, home, own in zip(rows["key"], rows["settled"], rows["home"], rows["shingles"]):
            both = postings.shared(own)
            either = postings.sizes + len(own) - both
            d = 1 - both / np.maximum(either, 1)
            links = np.flatnonzero(100 * both >= percent * either)
            if settled:
                links = np.append(links, len(near))
            if len(links) > 1:
                _lowest(group, links)
            nearest = d.min(initial=1.0)
            best = int(d.argmin()) if nearest <= WIDE else -1
            cells = [best, *[int(j) for j in np.flatnonzero((d <= nearest + 2 * reach) & (d <= WIDE + reach)) if j != best]]
            if best >= 0 and nearest > WIDE - reach:
                cells.append(-1)
            out.append((key, home, own, int(links[0]) if len(links) else -2, cells, [float(d[j]) if j >= 0 else 0.0 for j in cells],
                        key in names))
        frame = pd.DataFrame(out, columns=["key", "home", "shingles", "link", "cells", "gaps", "is_pivot"])
        merged = [(int(i), int(g)) for i, g in enumerate(group) if i != g]
        more = pd.DataFrame({"key": [b""] * len(merged), "home": False, "shingles": [[]] * len(merged), "link": [m[0] for m in merged],
                             "cells": [[m[1]] for m in merged], "gaps": [[]] * len(merged), "is_pivot": None})
        frame = pd.concat([frame, more], ignore_index=True) if merged else frame
        return frame.assign(region=rows["region"].iloc[0] if len(rows) else near["region"].iloc[0], last=len(near))

    measured = stage(salted.groupBy("region", "salt").cogroup(spread.groupBy("region", "salt")).applyInPandas(
        measure, "region string, key binary, home boolean, shingles array<bigint>, link int, cells array<int>, "
                 "gaps array<double>, is_pivot boolean, last int"))
    rows = measured.filter("is_pivot is not null")

    def merge(pairs: pd.DataFrame) -> pd.DataFrame:
        last = int(pairs["last"].iloc[0])
        group = np.arange(last + 1)
        for a, b in zip(pairs["link"], pairs["cell"]):
            _lowest(group, np.array([a, b]))
        return pd.DataFrame({"region": pairs["region"].iloc[0], "number": np.arange(last + 1), "group": group})

    # per region at most one row for every two pivots
    pairs = measured.filter("is_pivot is null").select("region", "last", "link", F.col("cells")[0].alias("cell")).distinct()
    alone = pivots.groupBy("region").agg(F.count("*").cast("int").alias("last")).select("region", "last", F.lit(0).alias("link"), F.lit(0).alias("cell"))
    groups = stage(pairs.unionByName(alone).groupBy("region").applyInPandas(merge, "region string, number int, group int"))
    own_group = groups.withColumnRenamed("number", "link").withColumnRenamed("group", "own")
    names = pivots.select("region", F.col("pivot").alias("link"), F.col("key").alias("other"))
    edges = rows.filter("link >= 0").join(names, ["region", "link"]).select("key", "other").unionByName(
        groups.filter("number <> group").join(names.withColumnRenamed("link", "number").withColumnRenamed("other", "key"), ["region", "number"])
        .join(names.withColumnRenamed("link", "group"), ["region", "group"]).select("key", "other"))
    # a cell reaches as far as the farthest document at home in it
    radius = stage(rows.filter("home").groupBy("region", F.col("cells")[0].alias("cell")).agg(F.max(F.col("gaps")[0]).alias("radius")))
    linked = rows.filter("not is_pivot").join(own_group, ["region", "link"], "left").drop("link", "is_pivot")
    inside = (F.col("cell") < 0) | (F.col("gap") <= F.col("radius") + reach)
    cells = linked.select("region", F.explode(F.arrays_zip("cells", "gaps")).alias("to")).select(
        "region", F.col("to.cells").alias("cell"), F.col("to.gaps").alias("gap"))
    calm = stage(cells.join(radius, ["region", "cell"]).filter(inside).groupBy("region").agg(F.count("*").alias("after")).join(
        sizes.select("region", "n"), "region").filter(F.col("after") <= GROWTH * F.col("n")).select("region"))
    # the largest group of connected documents of a region that is left as it is
    largest = linked.filter("own is not null").groupBy("region", "own").agg(F.count("*").alias("n")).groupBy("region").agg(
        F.max(F.struct("n", "own"))["own"].alias("largest"))
    stuck = linked.join(calm, "region", "left_anti").join(largest, "region", "left").select(
        "region", "key", F.coalesce(F.col("own") == F.col("largest"), F.lit(False)).alias("settled"), "home", "shingles")
    placed = linked.join(calm, "region").select("region", "key", "home", "shingles", "own", "last", F.posexplode(F.arrays_zip("cells", "gaps"))
                           .alias("rank", "to")).select("*", F.col("to.cells").alias("cell"), F.col("to.gaps").alias("gap"))
    placed = placed.join(radius, ["region", "cell"]).filter(inside)
    # the far region's own group is that of the documents settled before
    grouped = placed.withColumn("number", F.when(F.col("cell") < 0, F.col("last")).otherwise(F.col("cell"))).join(groups, ["region", "number"])
    where = F.concat_ws("/", "region", F.when(F.col("cell") < 0, F.lit(-1)).otherwise(F.col("group")))
    return edges, (grouped.select(where.alias("region"), "key", F.coalesce(F.col("own") == F.col("group"), F.lit(False)).alias("settled"),
                                  (F.col("home") & (F.col("rank") == 0)).alias("home"), "shingles", "rank")
                   .withColumn("first", F.row_number().over(Window.partitionBy("region", "key").orderBy("rank"))).filter("first = 1")
                   .drop("first", "rank")), stuck


def _in_blocks(members: DataFrame) -> DataFrame:
    """Regions that pivots do not make smaller: every two blocks are a region, but for two of settled documents only."""
    half = F.greatest(F.floor(F.least(F.lit(LEAF / 2), LEAF_SHINGLES / 2 * F.col("n") / F.col("shingles"))), F.lit(1))
    blocks = members.groupBy("region").agg(
        F.count("*").alias("n"), F.sum(F.size("shingles")).alias("shingles"), F.count_if("settled").alias("known")).filter(
        "known < n").select("region", F.ceil(F.col("known") / half).alias("quiet"),
                            F.greatest(F.ceil((F.col("n") - F.col("known")) / half), F.lit(2)).alias("open"))
    draw = F.xxhash64("key")
    own = members.join(stage(blocks), "region").withColumn(
        "own", F.when(F.col("settled"), F.pmod(draw, F.greatest("quiet", F.lit(1)))).otherwise(F.col("quiet") + F.pmod(draw, "open")))
    pairs = own.withColumn("with", F.explode(F.sequence(F.lit(0).cast("long"), F.col("quiet") + F.col("open") - 1))).filter(
        (F.col("own") != F.col("with")) & ((F.col("own") >= F.col("quiet")) | (F.col("with") >= F.col("quiet"))))
    return pairs.select(F.concat_ws("/", "region", F.least("own", "with"), F.greatest("own", "with")).alias("region"),
                        "key", "settled", "home", "shingles")


def linking_edges(members: DataFrame, percent: int = PERCENT, rounds: int = ROUNDS) -> DataFrame:
    """(key, other): edges with the connected components of all links within the regions of ``members``."""
    found: list[DataFrame] = []

    def leaf(rows: pd.DataFrame) -> pd.DataFrame:
        return _join_leaf(rows, percent)

    def measured(rows: DataFrame) -> DataFrame:
        """Regions that still hold two documents to compare: a guest that is not settled may link with a settled one at home."""
        return stage(rows.groupBy("region").agg(
            F.count("*").alias("n"), F.sum(F.size("shingles")).alias("shingles"), F.count_if("home").alias("own"),
            F.count_if(~F.col("settled")).alias("open")).filter("n > 1 and own > 0 and open > 0"))

    small = (F.col("n") <= LEAF) & (F.col("shingles") <= LEAF_SHINGLES) | (F.col("n") <= 2)
    for at in range(rounds + 1):
        sizes = measured(members)
        found.append(members.join(sizes.filter(small).select("region"), "region").groupBy("region").applyInPandas(leaf, EDGE))
        large = stage(sizes.filter(~small))
        if large.isEmpty():
            break
        rest = members.join(large.select("region"), "region")
        if at == rounds:
            found.append(_in_blocks(rest).groupBy("region").applyInPandas(leaf, EDGE))
            break
        edges, smaller, stuck = _split(rest, large, percent)
        found.append(stage(edges))
        found.append(_in_blocks(stuck).groupBy("region").applyInPandas(leaf, EDGE))
        members = stage(smaller)
    out = found[0]
    for more in found[1:]:
        out = out.unionByName(more)
    return out


# --- the whole join -------------------------------------------------------------------------------------------------

def components(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", percent: int = PERCENT) -> DataFrame:
    """One row per input row: doc_id, n_shingles, component_id."""
    texts = docs.select(F.col(id_col).cast("long").alias("doc_id"), whole(F.col(text_col)).alias("text"))
    answers = stage(shared_shingles(texts))
    rows = answers.filter("bucket < 0").select(F.explode(F.arrays_zip("doc_ids", "sizes", "ones", "twos")).alias("x")).select(
        F.col("x.doc_ids").cast("long").alias("doc_id"), F.col("x.sizes").alias("n_shingles"), F.col("x.ones").alias("one"), F.col("x.twos").alias("two"))

    def heads(chunk: pd.DataFrame) -> pd.DataFrame:
        return rare_heads(chunk, percent)

    meets = stage(answers.groupBy("chunk").applyInPandas(tidy_group(heads), "one long, pivots array<bigint>")).select("one", F.explode("pivots").alias("pivot"))
    shared = meets.groupBy("pivot").agg(F.min("one").alias("least"), F.max("one").alias("most")).filter("least <> most")
    bonds = meets.join(shared.select("pivot", "least").hint("shuffle_hash"), "pivot").filter("one <> least").select("one", "least")
    regions = connected(bonds.distinct(), "one", "least")

    slots = _bitmap(regions.select("node"))

    def fetch(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keys, sets, seen = [], [], set()
            for _, shingles in _sets(batch):
                key = _class_key(shingles)
                if len(shingles) and slots[key[0] % SLOTS] and key not in seen:
                    seen.add(key)
                    keys.append(key)
                    sets.append(shingles)
            yield pa.RecordBatch.from_pydict({"one": pa.array([k[0] for k in keys], pa.int64()),
                                              "two": pa.array([k[1] for k in keys], pa.int64()), "shingles": _lists(sets)})

    key = F.unhex(F.concat(*[F.lpad(F.hex(c), 16, "0") for c in ("one", "two")]))
    sets = texts.mapInArrow(tidy(fetch), "one long, two long, shingles array<bigint>").join(
        regions.select(F.col("node").alias("one"), F.col("root").cast("string").alias("region")), "one")
    members = stage(sets.dropDuplicates(["one", "two"]).select(
        "region", key.alias("key"), F.lit(False).alias("settled"), F.lit(True).alias("home"), "shingles"))
    roots = connected(linking_edges(members, percent), "key", "other")
    classes = rows.filter("n_shingles > 0").groupBy("one", "two").agg(F.min("doc_id").alias("least_id")).withColumn("key", key)
    named = stage(classes.join(roots.withColumnRenamed("node", "key"), "key", "left").withColumn("root", F.coalesce("root", "key")))
    least = stage(named.groupBy("root").agg(F.min("least_id").alias("component_id")))
    answer = stage(named.join(least, "root").select("one", "two", "component_id"))
    empty = rows.filter("n_shingles = 0").select("doc_id", "n_shingles", F.col("doc_id").alias("component_id"))
    return rows.filter("n_shingles > 0").join(answer, ["one", "two"]).select(
        "doc_id", "n_shingles", "component_id").unionByName(empty)


def one_of_each_component(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", percent: int = PERCENT) -> DataFrame:
    """The rows of ``docs`` with one row per component, that of the least id, with all its columns.

    Rows without words and rows with a null id all stay. Of rows with words that share an id at most one stays.
    """
    found = components(docs, id_col, text_col, percent).filter("n_shingles > 0 and doc_id is not null and component_id is not null")
    # ids that go, and ids of which several rows may stay though one should
    marks = stage(found.groupBy(F.col("doc_id").alias("_mark")).agg(
        F.count("*").alias("rows"), F.max(F.col("doc_id") == F.col("component_id")).alias("_stays")).filter("not _stays or rows > 1"))
    rows = docs.select(F.struct("*").alias("_row"), F.col(id_col).alias("_id"), word_count(F.col(text_col)).alias("_words"))
    clear, rest = may_have(rows, F.coalesce(F.col("_id").cast("long"), F.lit(-1)), marks, "_mark")
    marked = rest.join(marks, (F.col("_id") == F.col("_mark")) & (F.col("_words") > 0), "left")
    plain = marked.filter(F.col("_mark").isNull()).unionByName(marked.filter("_stays").dropDuplicates(["_id"]))
    return clear.select("_row.*").unionByName(plain.select("_row.*"))
