"""Spelling variants: words that differ by one letter, and the far more frequent form that each is likely meant to be.

Words are counted first, merged in each task before they move. Every word then gets a 64-bit hash that tells the hash of any
one-letter edit of it from sums over its letters. The vocabulary's hashes are put into blocked Bloom filters, one per word
length, built block range by block range. A round broadcasts the filters of some lengths, ``ROUND_BYTES`` at most; a filter
that is larger by itself is sent in parts. The edits of all words are probed against them: letters left out fall on the
length below, letters put in the place of others on the same one; an inserted letter is the longer word's left out one, and of
two words that differ in a letter the one with the smaller letter asks, so every pair is asked for once. Only edits that
pass a filter are shuffled: a join with the vocabulary on length and hash finds the word, if any, and a comparison of both words
removes what only shares a hash. So filters bound the work, and the result is exact.

Defined results: a null or empty text has no words. A null id counts as empty text where an id is hashed. Rows that repeat count as
often as they are there. A word of any length is taken; its edits are hashed in slices. Of near words with equal counts the
smallest in code-point order is the form. An empty table has no words. Columns other than the id and the text are not read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from .common import stage, whole

#: A letter of a word; capital letters are lowered from A to Z only.
LETTER = "[A-Za-zÀ-ÿ]"
ALPHABET = [*range(ord("a"), ord("z") + 1), *range(0xC0, 0x100)]
#: Shortest word, fewest occurrences, and how many times more frequent a form must be.
SHORTEST, FEWEST, TIMES = 7, 2, 10
#: One word in so many loses a letter in a trial.
SLIPS = 31

#: Filter bits per word, bits set per word, bits of a block, blocks that are built together, and bytes of filters that are broadcast at a time.
PER_WORD, PROBES, BLOCK, TOGETHER, ROUND_BYTES = 20, 8, 512, 1024, 32 << 20
#: Words whose edits a task asks for: a small table of words is a lot of work.
PER_TASK = 1 << 16
#: Letters whose edits are hashed at a time.
SLICE = 1 << 16
_BASE, _MIX, _SPREAD = 0xBF58476D1CE4E5B9, 0x94D049BB133111EB, 0x9E3779B97F4A7C15
_BACK = np.uint64(pow(_BASE, -1, 1 << 64))


def runs(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shortest: int = SHORTEST) -> DataFrame:
    """(id, word): every maximal run of at least ``shortest`` letters, A-Z lowered."""
    found = F.explode(F.regexp_extract_all(whole(F.col(text_col)), F.lit(f"({LETTER}{{{shortest},}})"), 1))
    run = F.col("run")
    lowered = F.when(F.octet_length(run) == F.length(run), F.lower(run)).otherwise(
        F.translate(run, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"))
    return docs.select(whole(F.col(id_col)).alias("id"), found.alias("run")).select("id", lowered.alias("word"))


def slipped(words: DataFrame, every: int = SLIPS) -> DataFrame:
    """The words, one in ``every`` (by the crc32 of id and word) without one of its letters."""
    hashed, word = F.crc32(F.concat("id", F.lit(":"), "word")), F.col("word")
    at = F.pmod(F.col("h"), F.length(word)).cast("int")
    return words.withColumn("h", hashed).select("id", F.when(F.pmod(F.col("h"), F.lit(every)) == 0, F.concat(
        F.substring(word, F.lit(1), at), F.substring(word, at + 2, F.length(word)))).otherwise(word).alias("word"))


def vocabulary(words: DataFrame, shortest: int = SHORTEST, fewest: int = FEWEST) -> DataFrame:
    """(word, n, length, key) of the words that are long and frequent enough."""
    counts = (words.filter(F.length("word") >= shortest).groupBy("word").agg(F.count("*").alias("n"))
              .filter(F.col("n") >= fewest).withColumn("length", F.length("word")))

    def keyed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keys = np.zeros(len(batch), np.uint64)
            for rows, codes in by_length(batch.column("word").to_pylist()):
                keys[rows] = mixed(sums(codes))
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(keys.view(np.int64))], [*batch.schema.names, "key"])

    return stage(counts.mapInArrow(keyed, counts.withColumn("key", F.lit(0).cast("long")).schema))


def by_length(words: list[str]) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(rows, codes) of words of one length, a letter per column; a few words at a time where they are long."""
    lengths = np.array([len(w) for w in words])
    for length in np.unique(lengths):
        own = np.flatnonzero(lengths == length)
        for rows in np.array_split(own, -(-len(own) * int(length) // (2 * SLICE))):
            if len(rows):
                # every letter has a code below 256
                yield rows, np.frombuffer("".join([words[k] for k in rows]).encode("latin-1"), np.uint8).reshape(len(rows), length)


def _powers(low: int, high: int) -> np.ndarray:
    out = np.full(high - low, np.uint64(_BASE))
    out[0] = pow(_BASE, low, 1 << 64)
    return np.multiply.accumulate(out)


def _slices(codes: np.ndarray) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    for low in range(0, codes.shape[1], SLICE):
        part = codes[:, low:low + SLICE]
        yield low, part.astype(np.uint64), _powers(low, low + part.shape[1])


def sums(codes: np.ndarray) -> np.ndarray:
    """One number per word, modulo 2**64: the letters' codes times powers of a base by their place."""
    out = np.zeros(len(codes), np.uint64)
    for _, part, power in _slices(codes):
        out += (part * power).sum(1, dtype=np.uint64)
    return out


def mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * np.uint64(_MIX)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(_SPREAD)
    return x ^ (x >> np.uint64(31))


def left_out(codes: np.ndarray, total: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(row, key) of the words without one letter, once for a run of equal letters."""
    before, last = np.zeros(len(codes), np.uint64), np.full(len(codes), 256, np.uint64)
    for _, part, power in _slices(codes):
        term = part * power
        upto = before[:, None] + np.cumsum(term, axis=1, dtype=np.uint64)
        rest = (upto - term) + (total[:, None] - upto) * _BACK
        first = part != np.concatenate([last[:, None], part[:, :-1]], axis=1)
        yield np.nonzero(first)[0], mixed(rest[first])
        before, last = upto[:, -1], part[:, -1]


def replaced(codes: np.ndarray, total: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(row, key) of the words with a larger letter in the place of one."""
    for _, part, power in _slices(codes):
        rows, places = np.indices(part.shape, np.int32)
        order = np.argsort(part, axis=None, kind="stable")
        value, at, power = part.ravel()[order], rows.ravel()[order], power[places.ravel()[order]]
        base = total[at] - value * power
        for letter in ALPHABET:
            below = np.searchsorted(value, letter)
            yield at[:below], mixed(base[:below] + np.uint64(letter) * power[:below])


def blocks(words: int) -> int:
    """Blocks of the filter for so many words."""
    return max(1, -(-words * PER_WORD // BLOCK))


def places(keys: np.ndarray, count: int) -> np.ndarray:
    return ((keys >> np.uint64(32)) * np.uint64(count)) >> np.uint64(32)


def _bit(mix: np.ndarray, k: int) -> np.ndarray:
    """The bit in its block that a hash tells: four of them lie in ``_mixes(keys, k)``."""
    return mix >> np.uint64(9 * (k % 4)) & np.uint64(BLOCK - 1)


def _mixes(keys: np.ndarray, k: int) -> np.ndarray:
    return mixed(keys + np.uint64(k // 4 + 1))


class Filter:
    """Blocks ``first`` to ``last`` (not included) of a blocked Bloom filter of ``count`` blocks."""

    def __init__(self, count: int, first: int, last: int):
        self.count, self.first, self.last = count, first, last
        self.words = np.zeros((last - first) * BLOCK // 64, np.uint64)

    def _word(self, place: np.ndarray, bit: np.ndarray) -> np.ndarray:
        return ((place - np.uint64(self.first)) * np.uint64(BLOCK // 64) + (bit >> np.uint64(6))).astype(np.int64)

    def add(self, keys: np.ndarray) -> None:
        place = places(keys, self.count)
        for k in range(PROBES):
            bit = _bit(_mixes(keys, k), k)
            np.bitwise_or.at(self.words, self._word(place, bit), np.uint64(1) << (bit & np.uint64(63)))

    def may_have(self, keys: np.ndarray) -> np.ndarray:
        """The indices of the keys that are in a block of this part and have all their bits there."""
        place = places(keys, self.count)
        left = np.arange(len(keys)) if self.last - self.first == self.count else np.flatnonzero((place >= self.first) & (place < self.last))
        for k in range(0, PROBES, 4):
            mix = _mixes(keys[left], k)
            for j in range(k, k + 4):
                bit = _bit(mix, j)
                on = self.words[self._word(place[left], bit)] >> (bit & np.uint64(63)) & np.uint64(1) == 1
                left, mix = left[on], mix[on]
        return left


def rounds(sizes: dict[int, int], most: int = ROUND_BYTES) -> list[dict[int, tuple[int, int, int]]]:
    """Per round, by length, (blocks of the filter, first and last block that are sent); at most ``most`` bytes a round."""
    room, out, free = max(TOGETHER, most // (BLOCK // 8)), [], 0
    for length, words in sorted(sizes.items()):
        count = blocks(words)
        for first in range(0, count, room // TOGETHER * TOGETHER):
            last = min(count, first + room // TOGETHER * TOGETHER)
            if last - first > free or not out:
                out.append({})
                free = room
            if length in out[-1]:
                out.append({})
                free = room
            out[-1][length] = (count, first, last)
            free -= last - first
    return out


def filters(vocab: DataFrame, wanted: dict[int, tuple[int, int, int]]) -> dict[int, Filter]:
    """The filters of a round, built by ranges of blocks and put together on the driver: ``ROUND_BYTES`` at most."""
    bounds = vocab.sparkSession.createDataFrame([(k, *v) for k, v in wanted.items()], "length int, count long, first long, last long")
    place = F.shiftright(F.shiftrightunsigned("key", 32) * F.col("count"), 32)
    own = (vocab.select("length", "key").join(F.broadcast(bounds), "length").withColumn("place", place)
           .filter("place >= first AND place < last").select("length", "key", F.floor(F.col("place") / TOGETHER).alias("part")))

    def build(frame: pd.DataFrame) -> pd.DataFrame:
        length, part = int(frame["length"].iloc[0]), int(frame["part"].iloc[0])
        count = wanted[length][0]
        made = Filter(count, part * TOGETHER, min(count, (part + 1) * TOGETHER))
        made.add(frame["key"].to_numpy().view(np.uint64))
        return pd.DataFrame({"length": [length], "part": [part], "bits": [made.words.tobytes()]})

    out = {k: Filter(*v) for k, v in wanted.items()}
    for r in own.groupBy("length", "part").applyInPandas(build, "length int, part long, bits binary").collect():
        bits, at = np.frombuffer(r["bits"], np.uint64), (r["part"] * TOGETHER - out[r["length"]].first) * BLOCK // 64
        out[r["length"]].words[at:at + len(bits)] = bits
    return out


def near_pairs(vocab: DataFrame, round_bytes: int = ROUND_BYTES) -> DataFrame:
    """(word, n, near, near_n): every two words of the vocabulary that differ by one letter, once."""
    # one row per length of a word
    sizes = {r["length"]: r["words"] for r in vocab.groupBy("length").agg(F.count("*").alias("words")).collect()}
    context, hits = vocab.sparkSession.sparkContext, None
    for wanted in rounds(sizes, round_bytes):
        sent = context.broadcast(filters(vocab, wanted))

        def probe(batches: Iterator[pa.RecordBatch], sent=sent) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                words = batch.column("word").to_pylist()
                at, lengths, keys = [np.zeros(0, np.int64)], [np.zeros(0, np.int32)], [np.zeros(0, np.uint64)]
                for rows, codes in by_length(words):
                    total, length = sums(codes), codes.shape[1]
                    for size, edits in ((length - 1, left_out), (length, replaced)):
                        own = sent.value.get(size)
                        for row, key in edits(codes, total) if own else ():
                            hit = own.may_have(key)
                            at.append(rows[row[hit]])
                            lengths.append(np.full(len(hit), size, np.int32))
                            keys.append(key[hit])
                at = pa.array(np.concatenate(at))
                yield pa.RecordBatch.from_arrays(
                    [batch.column("word").take(at), batch.column("n").take(at), pa.array(np.concatenate(lengths)),
                     pa.array(np.concatenate(keys).view(np.int64))], ["word", "n", "length", "key"])

        lengths = [k for k in sizes if k in wanted or k - 1 in wanted]
        asked = vocab.filter(F.col("length").isin(lengths)).select("word", "n").repartition(1 + sum(sizes[k] for k in lengths) // PER_TASK, "word")
        found = stage(asked.mapInArrow(probe, "word string, n long, length int, key long"))
        sent.unpersist()
        hits = found if hits is None else hits.unionByName(found)
    if hits is None:
        return vocab.select("word", "n", F.col("word").alias("near"), F.col("n").alias("near_n")).limit(0)
    known = vocab.select(F.col("word").alias("near"), F.col("n").alias("near_n"), "length", "key")
    return hits.join(known, ["length", "key"]).filter(F.levenshtein("word", "near", 1) == 1).select("word", "n", "near", "near_n")


def roots(forms: DataFrame) -> DataFrame:
    """(word, root): where the forms lead to in the end. ``forms`` has (word, form); counts rise along them, so they end."""
    at = stage(forms.select("word", F.col("form").alias("root")))
    while True:
        onward = at.select(F.col("word").alias("root"), F.col("root").alias("further"))
        at = stage(at.join(onward, "root", "left").select("word", F.coalesce("further", "root").alias("root"), F.col("further").isNotNull().alias("moved")))
        if not at.filter("moved").limit(1).count():
            return at.select("word", "root")
        at = at.select("word", "root")


def variants(vocab: DataFrame, times: int = TIMES, round_bytes: int = ROUND_BYTES) -> DataFrame:
    """One row per word: word, form, root, n, n_near, form_n.

    The form is the near word of the largest count, if that is at least ``times`` the word's own; the root is where forms lead.
    """
    pairs = stage(near_pairs(vocab, round_bytes))
    both = pairs.unionByName(pairs.select(F.col("near").alias("word"), F.col("near_n").alias("n"), F.col("word").alias("near"), F.col("n").alias("near_n")))
    best = both.groupBy("word").agg(F.count("*").alias("n_near"), F.min(F.struct((-F.col("near_n")).alias("rank"), "near")).alias("best"))
    form_n = -F.col("best.rank")
    known = stage(vocab.select("word", "n").join(best, "word", "left").withColumn("holds", F.coalesce(form_n >= times * F.col("n"), F.lit(False))).select(
        "word", F.when(F.col("holds"), F.col("best.near")).alias("form"), "n", F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"),
        F.when(F.col("holds"), form_n).alias("form_n")))
    return known.join(roots(known.filter("form IS NOT NULL")), "word", "left").select(
        "word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")
