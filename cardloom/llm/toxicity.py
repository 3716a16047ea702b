"""Toxicity by FTRL-proximal logistic regression over hashed word n-grams and skip-grams.

A word is a run of ASCII letters and digits and of other characters that are not spaces or general punctuation, after
lower-casing. The features of a text are its distinct words, word pairs and triples in a row, and pairs with one or two words
between them, each a 32-bit hash; a feature is there or not, however often it occurs.

The weights are learnt by FTRL-proximal steps: every coordinate has its own rate, which falls with the gradients it has
seen, and a weight stays 0 until its gradients exceed the L1 penalty. So few weights are left, and they are broadcast with the
tasks. Learning is spread: blocks of about ``BLOCK`` examples run through their rows from the common state (z, n) and give
back how it changed; the changes are averaged and the next round begins. A block is packed into one row once, so a round
moves no examples. A coordinate enters a block's state if ``SEEN`` of its examples have it.

At most about ``PER_LABEL`` examples of each label are drawn by a hash of the id. A second model, learnt without every
``APART``-th of them, tells by these how its scores must be stretched and shifted to be probabilities; the first gets the same
stretch, and its bias is shifted back by the odds of the draw. Of a drawn text with more than ``MOST`` distinct features those of the smallest hashes are learnt, the same ones in every text.
Scoring takes all features of every whole text, in stretches of bounded size.

Defined results: a null or empty text has no feature and gets the score of the bias alone; so does any text where no labelled
row was there to learn from, with a bias of ``PRIOR``. Labels other than 0 and 1 are not read; an id with both counts as
toxic, and of several rows of an id the smallest text is learnt. Rows with a null id are neither learnt from nor held out. Copies of a text get the same score. A text of any
length is cut into stretches, and features across a cut are kept. An empty table gives no rows. Columns other than the id,
the text and the label are not read.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from .common import stage, tidy, whole

#: Examples drawn of each label at most (about), examples of a block, distinct features of an example that are learnt.
PER_LABEL, BLOCK, MOST = 4000, 2000, 1 << 14
#: One in so many examples is set apart for the stretch.
APART = 5
#: Examples of a block that must have a feature before it has a coordinate, and rounds.
SEEN, ROUNDS = 3, 6
#: The four parameters of FTRL-proximal: rate, its smoothing, L1 and L2.
ALPHA, BETA, L1, L2 = 1.0, 1.0, 3.0, 0.5
#: Log odds without any labelled row, and the score from which a text counts as toxic.
PRIOR, LEAST = -2.0, 0.7
#: Bytes of text that are hashed at a time.
STRETCH = 1 << 19

_WORD, _PLACE, _MIX = 0x9E3779B97F4A7C15, 0xBF58476D1CE4E5B9, 0x94D049BB133111EB
_ONE = np.uint64(1)
#: Words that a feature may span.
SPAN = 4


def remainder(doc_id: Column) -> Column:
    """crc32 of the id as text, modulo 3."""
    return F.pmod(F.crc32(doc_id.cast("string")), F.lit(3))


def _mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(29))) * np.uint64(_MIX)
    return x ^ (x >> np.uint64(32))


def _powers(base: int, n: int) -> np.ndarray:
    out = np.full(n, np.uint64(base))
    out[:1] = 1
    return np.multiply.accumulate(out)


_UP = _powers(_PLACE, STRETCH + 1)
_DOWN = _powers(pow(_PLACE, -1, 1 << 64), STRETCH + 1)


def word_bytes(data: np.ndarray) -> np.ndarray:
    """Which bytes of UTF-8 text belong to words: not ASCII marks and blanks, nor U+0080-U+00BF, U+2000-U+207F, U+3000-U+303F."""
    folded = data | 0x20
    inside = (data >= 0x80) | ((folded >= 97) & (folded <= 122)) | ((data >= 48) & (data <= 57))
    for at in np.flatnonzero(data == 0xC2):
        inside[at:at + 2] = False
    for lead, second in ((0xE2, (0x80, 0x81)), (0xE3, (0x80,))):
        at = np.flatnonzero(data[:-1] == lead)
        for k in at[np.isin(data[at + 1], second)]:
            inside[k:k + 3] = False
    return inside


def word_hashes(data: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The place and hash of each word of lower-cased UTF-8 bytes, at most ``STRETCH`` of them."""
    inside = word_bytes(data)
    edges = np.flatnonzero(np.diff(np.concatenate([[False], inside, [False]]).astype(np.int8)))
    begins, ends = edges[::2], edges[1::2]
    sums = np.concatenate([[np.uint64(0)], np.cumsum((data.astype(np.uint64) + _ONE) * _UP[:len(data)])])
    return begins, _mixed((sums[ends] - sums[begins]) * _DOWN[begins] + (ends - begins).astype(np.uint64) * np.uint64(_WORD))


def _feature(hashes: np.ndarray) -> np.ndarray:
    """32 bits of a hash, never 0: that is the bias."""
    return np.maximum((hashes >> np.uint64(32)).astype(np.uint32), np.uint32(1))


def grams(words: np.ndarray, owner: np.ndarray, fresh: int = 0) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(owner, feature) of the n-grams and skip-grams whose last word is not among the first ``fresh``."""
    yield owner[fresh:], _feature(words[fresh:])
    for kind, steps in ((1, (1,)), (2, (1, 2)), (3, (2,)), (4, (3,))):
        reach = steps[-1]
        first = max(fresh - reach, 0)
        n = len(words) - reach - first
        if n <= 0:
            continue
        same = owner[first:first + n] == owner[first + reach:]
        value = words[first:first + n] * np.uint64(_PLACE)
        for k, step in enumerate(steps):
            value = _mixed(value + words[first + step:first + step + n] * np.uint64(_WORD + 2 * k)) + np.uint64(kind)
        yield owner[first:first + n][same], _feature(_mixed(value[same]))


def stretches(texts: list[str | None]) -> Iterator[tuple[np.ndarray, np.ndarray, int]]:
    """(words, owner, fresh) of texts: the first ``fresh`` words were already given and only give context.

    Short texts are taken together; a long one is cut between words, and its last words lead the next stretch.
    """
    pending, owners, size = [], [], 0

    def together():
        places, hashes = word_hashes(np.frombuffer(b" ".join(pending), np.uint8))
        marks = np.cumsum([0] + [len(x) + 1 for x in pending])
        return hashes, np.array(owners)[np.searchsorted(marks, places, "right") - 1], 0

    for k, text in enumerate(texts):
        if not text:
            continue
        raw = text.lower().encode("utf-8", "replace")
        if size + len(raw) >= STRETCH and pending:
            yield together()
            pending, owners, size = [], [], 0
        if len(raw) < STRETCH:
            pending.append(raw)
            owners.append(k)
            size += len(raw) + 1
            continue
        data, low, before = np.frombuffer(raw, np.uint8), 0, np.zeros(0, np.uint64)
        while low < len(data):
            part = data[low:low + STRETCH]
            if low + len(part) < len(data):
                gaps = np.flatnonzero(~word_bytes(part))
                # a word longer than a stretch is cut into words
                part = part[:gaps[-1] + 1] if len(gaps) else part
            words = np.concatenate([before, word_hashes(part)[1]])
            yield words, np.full(len(words), k), len(before)
            before, low = words[max(len(words) - SPAN + 1, 0):], low + len(part)
    if pending:
        yield together()


def examples(texts: list[str | None], most: int = MOST) -> list[np.ndarray]:
    """The distinct features of each text, in ascending order; of more than ``most`` the smallest."""
    out = [np.zeros(0, np.uint32) for _ in texts]
    for words, owner, fresh in stretches(texts):
        found = list(grams(words, owner, fresh))
        owners, values = (np.concatenate([f[i] for f in found]) for i in (0, 1))
        order = np.argsort(owners, kind="stable")
        owners, values = owners[order], values[order]
        cuts = np.flatnonzero(np.diff(owners)) + 1
        for own, k in zip(np.split(values, cuts), owners[np.concatenate([[0], cuts])] if len(owners) else []):
            out[k] = np.unique(np.concatenate([out[k], own]))[:most]
    return out


@dataclass
class State:
    """z and n of FTRL-proximal for the features that have a coordinate; the first one is the bias."""

    features: np.ndarray
    z: np.ndarray
    n: np.ndarray

    @classmethod
    def empty(cls) -> State:
        return cls(np.zeros(1, np.uint32), np.zeros(1), np.zeros(1))

    def weights(self) -> np.ndarray:
        w = (np.sign(self.z) * L1 - self.z) / ((BETA + np.sqrt(self.n)) / ALPHA + L2)
        w[np.abs(self.z) <= L1] = 0
        w[0] = -self.z[0] / ((BETA + np.sqrt(self.n[0])) / ALPHA)
        return w

    def on(self, features: np.ndarray) -> State:
        """The same state with a coordinate for each of the given features, in their order."""
        out = State(features, np.zeros(len(features)), np.zeros(len(features)))
        at = np.searchsorted(features, self.features)
        here = at < len(features)
        here[here] = features[at[here]] == self.features[here]
        out.z[at[here]], out.n[at[here]] = self.z[here], self.n[here]
        return out


@dataclass
class Block:
    """Examples by the places of their features among those that have a coordinate; place 0 is the bias."""

    features: np.ndarray
    rows: list[np.ndarray]
    labels: np.ndarray
    apart: np.ndarray

    @classmethod
    def of(cls, examples: list[np.ndarray], labels: np.ndarray, apart: np.ndarray, seen: int = SEEN) -> Block:
        values, counts = np.unique(np.concatenate(examples), return_counts=True)
        kept = np.concatenate([np.zeros(1, np.uint32), values[counts >= min(seen, len(examples))]])
        rows = [np.searchsorted(kept, np.intersect1d(x, kept, assume_unique=True)).astype(np.int32) for x in examples]
        return cls(kept, rows, labels.astype(np.int32), apart.astype(bool))

    def packed(self) -> pd.DataFrame:
        sizes = np.array([len(r) for r in self.rows], np.int32)
        cells = {"features": self.features, "places": np.concatenate(self.rows), "sizes": sizes, "labels": self.labels, "apart": self.apart}
        return pd.DataFrame({k: [v.tobytes()] for k, v in cells.items()})

    @classmethod
    def unpacked(cls, row: pd.Series) -> Block:
        sizes = np.frombuffer(row["sizes"], np.int32)
        rows = np.split(np.frombuffer(row["places"], np.int32), np.cumsum(sizes)[:-1])
        return cls(np.frombuffer(row["features"], np.uint32), rows, np.frombuffer(row["labels"], np.int32), np.frombuffer(row["apart"], bool))


PACKED = "features binary, places binary, sizes binary, labels binary, apart binary"


def pass_through(state: State, block: Block, order: np.ndarray) -> State:
    """FTRL-proximal steps over a block's examples in this order, one by one; the state of the block's own coordinates."""
    own = state.on(block.features)
    z, n = own.z, own.n
    for k in order:
        here = np.concatenate([[0], block.rows[k]])
        zs, ns = z[here], n[here]
        root = np.sqrt(ns)
        w = np.where(np.abs(zs) <= L1, 0.0, (np.sign(zs) * L1 - zs) / ((BETA + root) / ALPHA + L2))
        w[0] = -zs[0] / ((BETA + root[0]) / ALPHA)
        g = 1 / (1 + np.exp(-np.clip(w.sum(), -35, 35))) - block.labels[k]
        n[here] = ns + g * g
        z[here] = zs + g - (np.sqrt(ns + g * g) - root) / ALPHA * w
    return own


def merged(state: State, blocks: list[State]) -> State:
    """The common state moved by the mean of the blocks' changes."""
    features = np.unique(np.concatenate([state.features, *[b.features for b in blocks]]))
    out = state.on(features)
    for b in blocks:
        before, at = state.on(b.features), np.searchsorted(features, b.features)
        out.z[at] += (b.z - before.z) / len(blocks)
        out.n[at] += (b.n - before.n) / len(blocks)
    return out


@dataclass
class Model:
    """Sparse weights by feature, in ascending order, with a small table that most other features do not pass."""

    features: np.ndarray
    weights: np.ndarray
    bias: float

    def __post_init__(self):
        self.marks = np.zeros(1 << 16, bool)
        self.marks[self.features & np.uint32(0xFFFF)] = True

    @classmethod
    def of(cls, state: State) -> Model:
        w = state.weights()
        used = np.flatnonzero(w[1:]) + 1
        return cls(state.features[used], w[used], float(w[0]))

    def logit(self, features: np.ndarray) -> float:
        """Log odds of a text with these distinct features."""
        return self.bias + float(self.weights[np.isin(self.features, features, assume_unique=True)].sum())

    def scores(self, texts: list[str | None]) -> np.ndarray:
        """The probability of label 1 of each text."""
        owners, places = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
        for words, owner, fresh in stretches(texts):
            for own, value in grams(words, owner, fresh):
                may = self.marks[value & np.uint32(0xFFFF)]
                own, value = own[may], value[may]
                at = np.searchsorted(self.features, value)
                at[at == len(self.features)] = 0
                hit = self.features[at] == value if len(self.features) else np.zeros(len(at), bool)
                owners.append(own[hit])
                places.append(at[hit])
        seen = np.unique(np.stack([np.concatenate(owners), np.concatenate(places)]), axis=1)
        logit = np.full(len(texts), self.bias)
        np.add.at(logit, seen[0], self.weights[seen[1]])
        return 1 / (1 + np.exp(-np.clip(logit, -35, 35)))


def drawn(labels: DataFrame, id_col: str = "doc_id", label_col: str = "toxic", per_label: int = PER_LABEL) -> tuple[DataFrame, float]:
    """(id, label) of about ``per_label`` ids of each label that may be learnt from, and the log odds that the draw shifted."""
    usable = labels.select(F.col(id_col).cast("string").alias("id"), F.col(label_col).cast("int").alias("label")).filter(
        F.col("label").isin(0, 1) & F.col("id").isNotNull() & (remainder(F.col("id")) != 1))
    counts = {r["label"]: r["n"] for r in usable.groupBy("label").agg(F.count("*").alias("n")).collect()}
    shares = {k: min(1.0, per_label / n) for k, n in counts.items()}
    place = F.pmod(F.xxhash64("id", F.lit(13)), F.lit(1 << 40)) / F.lit(float(1 << 40))
    share = F.when(F.col("label") == 1, F.lit(shares.get(1, 0.0))).otherwise(F.lit(shares.get(0, 0.0)))
    own = usable.filter(place < share).groupBy("id").agg(F.max("label").alias("label"))
    shift = float(np.log(shares[0] / shares[1])) if len(shares) == 2 else 0.0
    return stage(own), shift


def _packed(frame: pd.DataFrame) -> pd.DataFrame:
    frame = frame.sort_values("id")
    return Block.of(examples(list(frame["text"])), frame["label"].to_numpy(), frame["apart"].to_numpy()).packed()


def learn(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "toxic",
          per_label: int = PER_LABEL, block: int = BLOCK, rounds: int = ROUNDS) -> Model:
    """Weights from the labelled rows that are not held out."""
    own, shift = drawn(labels, id_col, label_col, per_label)
    rows = docs.select(F.col(id_col).cast("string").alias("id"), whole(F.col(text_col)).alias("text"))
    # the drawn ids are bounded by ``per_label``; repeated rows of one id are merged before they move
    sample = stage(rows.join(F.broadcast(own), "id").groupBy("id").agg(F.min("label").alias("label"), F.min("text").alias("text")))
    size = sample.count()
    if not size:
        return Model(np.zeros(0, np.uint32), np.zeros(0), PRIOR)
    sample = sample.withColumns({"block": F.pmod(F.xxhash64("id", F.lit(31)), F.lit(-(-size // block))),
                                 "apart": F.pmod(F.xxhash64("id", F.lit(5)), F.lit(APART)) == 0})
    table = stage(sample.groupBy("block").applyInPandas(_packed, PACKED))
    # model 0 is learnt without the examples set apart, model 1 with all
    states = [State.empty(), State.empty()]
    for turn in range(rounds):
        def run(frames: Iterator[pd.DataFrame], states: list[State] = states, turn: int = turn) -> Iterator[pd.DataFrame]:
            for frame in frames:
                for _, row in frame.iterrows():
                    part = Block.unpacked(row)
                    # another order in each round, the same in each run
                    order = np.random.default_rng(turn).permutation(len(part.rows))
                    for model, state in enumerate(states):
                        got = pass_through(state, part, order if model else order[~part.apart[order]])
                        yield pd.DataFrame({"model": [model], "features": [got.features.tobytes()], "z": [got.z.tobytes()], "n": [got.n.tobytes()]})

        # two rows per block, and about 2 * ``per_label`` / ``block`` blocks
        done = table.mapInPandas(run, "model int, features binary, z binary, n binary").orderBy("model", "features").collect()
        states = [merged(s, [State(*(np.frombuffer(r[c], t) for c, t in (("features", np.uint32), ("z", float), ("n", float))))
                             for r in done if r["model"] == k]) for k, s in enumerate(states)]
    models = [Model.of(s) for s in states]

    def tried(frames: Iterator[pd.DataFrame], model: Model = models[0]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            for _, row in frame.iterrows():
                part = Block.unpacked(row)
                own = np.flatnonzero(part.apart)
                yield pd.DataFrame({"label": part.labels[own], "logit": [model.logit(part.features[part.rows[k]]) for k in own]})

    pairs = table.mapInPandas(tried, "label int, logit double").orderBy("logit", "label").collect()
    slope, move = stretch(np.array([r["logit"] for r in pairs]), np.array([r["label"] for r in pairs]))
    return Model(models[1].features, models[1].weights * slope, models[1].bias * slope + move + shift)


def stretch(logits: np.ndarray, labels: np.ndarray, prior: float = 1.0) -> tuple[float, float]:
    """(slope, move) such that slope * logit + move are the log odds of label 1, drawn toward (1, 0) where there is little to learn from."""
    slope, move = 1.0, 0.0
    for _ in range(100):
        p = 1 / (1 + np.exp(-np.clip(slope * logits + move, -35, 35)))
        toward = np.array([((p - labels) * logits).sum() + prior * (slope - 1), (p - labels).sum() + prior * move])
        s = p * (1 - p)
        bend = np.array([[(s * logits ** 2).sum() + prior, (s * logits).sum()], [(s * logits).sum(), s.sum() + prior]])
        step = np.clip(np.linalg.solve(bend, toward), -0.5, 0.5)
        slope, move = max(slope - step[0], 0.1), move - step[1]
    return float(slope), float(move)


def scored(docs: DataFrame, model: Model, keep: list[Column], text: Column, least: float = LEAST) -> DataFrame:
    """The columns ``keep`` of each row with score and predicted."""
    rows = docs.select(*keep, whole(text).alias("_text"))
    kept = [f.name for f in rows.schema.fields if f.name != "_text"]
    out = docs.select(*keep).withColumns({"score": F.lit(0.0), "predicted": F.lit(0)}).schema

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            score = model.scores(batch.column("_text").to_pylist())
            yield pa.RecordBatch.from_arrays(
                [*[batch.column(n) for n in kept], pa.array(score), pa.array((score >= least).astype(np.int32))], [*kept, "score", "predicted"])

    return rows.mapInArrow(tidy(run), out)


def toxicity(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "toxic") -> DataFrame:
    """One row per input row: doc_id, held_out, score, predicted."""
    model = learn(docs, labels, id_col, text_col, label_col)
    held_out = F.coalesce(remainder(F.col(id_col)) == 1, F.lit(False))
    return scored(docs, model, [F.col(id_col).alias("doc_id"), held_out.alias("held_out")], F.col(text_col))
