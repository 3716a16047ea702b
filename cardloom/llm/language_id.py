"""Language identification by averaged hashed subword embeddings and a linear softmax, with calibrated rejection.

A text's subwords are its byte 2-, 3- and 4-grams after lower-casing. Each falls by a hash on one of ``BUCKETS`` embedding
rows; the mean of the rows of all subwords goes through a linear layer and a softmax. Embeddings and layer are trained
together by stochastic gradient descent in numpy, on ``PER_LANGUAGE`` labelled documents of each language at most, drawn
by a hash of their ids, each seen as a few windows of up to ``WINDOW`` characters of differing length. A part of these
documents is set apart: on it a temperature is fitted, so that scores are probabilities, and the threshold is set below
which a prediction is rejected, such that at most ``REJECTED`` of the right ones are.

For prediction, layer and embeddings are multiplied once into a table of class scores per bucket. Every whole text is
scored, in stretches of bounded size, and only the text matters.

Defined results: a text that is null or has no letter gets ``und`` with score 0 and is rejected; so does every text where
no labelled row was there to learn from. Rows with a null id are never learnt from and never held out. Rows with a null
language are not learnt from. Copies of a text get the same answer. An empty table gives no rows. Columns other than the
id, the text and, for learning, the language are not read.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F

from .common import tidy, whole

#: Labelled documents of one language that are learnt from at most, windows of each and their longest length.
PER_LANGUAGE, WINDOWS, WINDOW = 500, 3, 1000
#: Embedding rows, their width, and the subword lengths in bytes.
BUCKETS, WIDTH, ORDERS = 1 << 16, 12, (2, 3, 4)
#: Passes over the windows and steps at least, windows per step, and the first step width.
PASSES, STEPS, BATCH, RATE = 6, 1200, 32, 30.0
#: Share of the documents set apart, and the largest share of right predictions among them that may be rejected.
APART, REJECTED = 0.2, 0.001
#: Bytes scored at a time.
STRETCH = 1 << 19
UNKNOWN = "und"

_ODD = {2: 0x9E3779B1, 3: 0x85EBCA77, 4: 0xC2B2AE3D}


def remainder(doc_id: Column) -> Column:
    """crc32 of the id as text, modulo 4."""
    return F.pmod(F.crc32(doc_id.cast("string")), F.lit(4))


def subwords(data: np.ndarray, ends: np.ndarray, order: int) -> np.ndarray:
    """The bucket of the subword that begins at each byte; ``BUCKETS`` where it would run over the end of its text."""
    padded = np.concatenate([data, np.zeros(3, np.uint8)]).astype(np.uint32)
    key = padded[:len(data)].copy()
    for k in range(1, order):
        key |= padded[k:k + len(data)] << np.uint32(8 * k)
    out = (key * np.uint32(_ODD[order]) >> np.uint32(32 - BUCKETS.bit_length() + 1)).astype(np.int64)
    for k in range(1, order):
        at = ends - k
        out[at[(at >= 0) & (at < len(out))]] = BUCKETS
    return out


@dataclass
class Model:
    languages: list[str]
    table: np.ndarray  # class scores by bucket, the last row for no subword
    bias: np.ndarray
    threshold: float

    def scores(self, data: np.ndarray, ends: np.ndarray) -> np.ndarray:
        """Class probabilities of texts that lie back to back."""
        sums, starts = np.zeros((len(ends), len(self.languages))), np.concatenate([[0], ends[:-1]])
        by_class = np.ascontiguousarray(self.table.T)
        for low in range(0, len(data), STRETCH):
            high = min(low + STRETCH, len(data))
            ahead = min(high + 3, len(data))
            inside = np.arange(np.searchsorted(ends, low, "right"), np.searchsorted(ends, high - 1, "right") + 1)
            inside = inside[starts[inside] < ends[inside]]
            begins = np.maximum(starts[inside], low) - low
            for order in ORDERS:
                bucket = subwords(data[low:ahead], ends - low, order)[:high - low]
                for k, row in enumerate(by_class):
                    sums[inside, k] += np.add.reduceat(row[bucket], begins)
        n = sum(np.maximum(ends - starts - order + 1, 0) for order in ORDERS)
        logits = sums / np.maximum(n, 1)[:, None] + self.bias
        logits = np.exp(logits - logits.max(1, keepdims=True))
        return logits / logits.sum(1, keepdims=True)


def train(texts: list[str], languages: list[str], owners: list[str], seed: int = 5) -> Model:
    """From lower-cased windows, their language and the document that each comes from."""
    names = sorted(set(languages))
    draw = np.random.default_rng(seed)
    raw = [t.encode() for t in texts]
    ends = np.cumsum([len(x) for x in raw])
    data, starts = np.frombuffer(b"".join(raw), np.uint8), ends - [len(x) for x in raw]
    grams = [subwords(data, ends, order) for order in ORDERS]
    bags = []
    for a, b in zip(starts, ends):
        own = np.concatenate([g[a:b] for g in grams])
        bags.append(np.unique(own[own < BUCKETS], return_counts=True))
    target = np.searchsorted(names, languages)
    order = np.unique(owners)
    apart = set(draw.permutation(order)[:int(len(order) * APART)])
    held = np.array([o in apart for o in owners])
    embedding = (draw.random((BUCKETS, WIDTH)) - 0.5) / WIDTH
    layer, bias = np.zeros((WIDTH, len(names))), np.zeros(len(names))
    usable = np.array([len(b[0]) > 0 for b in bags])
    learn = np.flatnonzero(~held & usable)
    per_pass = max(1, -(-len(learn) // BATCH))
    passes = max(PASSES, -(-STEPS // per_pass))
    steps, step = passes * per_pass, 0
    for _ in range(passes):
        for part in np.array_split(draw.permutation(learn), per_pass):
            if not len(part):
                continue
            rate = RATE * (1 - step / steps) / len(part)
            step += 1
            rows = np.concatenate([bags[i][0] for i in part])
            share = np.concatenate([bags[i][1] / bags[i][1].sum() for i in part])
            marks = np.cumsum([0] + [len(bags[i][0]) for i in part[:-1]])
            mean = np.add.reduceat(embedding[rows] * share[:, None], marks)
            error = mean @ layer + bias
            error = np.exp(error - error.max(1, keepdims=True))
            error /= error.sum(1, keepdims=True)
            error[np.arange(len(part)), target[part]] -= 1
            back = error @ layer.T
            layer -= rate * mean.T @ error
            bias -= 0.1 * rate * error.sum(0)
            sizes = [len(bags[i][0]) for i in part]
            np.add.at(embedding, rows, -rate * np.repeat(back, sizes, 0) * share[:, None])
    table = np.concatenate([embedding @ layer, np.zeros((1, len(names)))])
    check = np.flatnonzero(held & usable)
    if not len(check):
        check = learn
    logits = np.array([(table[bags[i][0]] * bags[i][1][:, None]).sum(0) / bags[i][1].sum() + bias for i in check]).reshape(len(check), -1)
    best, heat = np.inf, 1.0
    for t in np.geomspace(0.05, 20, 60):
        z = logits * t
        z -= z.max(1, keepdims=True)
        loss = float((np.log(np.exp(z).sum(1)) - z[np.arange(len(check)), target[check]]).mean())
        if loss < best - 1e-9:
            best, heat = loss, t
    model = Model(names, table * heat, bias * heat, 0.0)
    if len(check):
        p = np.exp(logits * heat - (logits * heat).max(1, keepdims=True))
        p /= p.sum(1, keepdims=True)
        right = p.argmax(1) == target[check]
        if right.any():
            model.threshold = float(min(0.5, np.quantile(p.max(1)[right], REJECTED)))
    return model


def learn(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang",
          per_language: int = PER_LANGUAGE) -> Model | None:
    """A model from the labelled rows that are not held out; None without any."""
    labelled = docs.select(F.col(id_col).cast("string").alias("id"), F.col(lang_col).cast("string").alias("lang"),
                           F.col(text_col).cast("string").alias("text")).filter(
        F.col("lang").isNotNull() & F.col("id").isNotNull() & (remainder(F.col("id")) != 2))
    order = Window.partitionBy("lang").orderBy(F.xxhash64("id"), "id")
    drawn = (labelled.select("id", "lang").distinct().withColumn("place", F.row_number().over(order))
             .filter(F.col("place") <= per_language).select("id", "lang"))
    lower, windows = F.lower("text"), []
    for k in range(WINDOWS):  # lengths from a few words to the longest, at places told by the id
        length = F.lit(WINDOW >> 2 * k)
        start = F.pmod(F.xxhash64("id", F.lit(k)), F.greatest(F.length(lower) - length + 1, F.lit(1))) + 1
        windows.append(F.substring(lower, start.cast("int"), length))
    rows = (labelled.join(drawn, ["id", "lang"], "left_semi").select("id", "lang", F.array(*windows).alias("windows"))
            .groupBy("id", "lang").agg(F.min("windows").alias("windows")).orderBy("lang", "id").toPandas())
    seen = [(t, lang, doc) for doc, lang, own in zip(rows["id"], rows["lang"], rows["windows"]) for t in own if t]
    return train(*map(list, zip(*seen))) if seen else None


def predict(docs: DataFrame, model: Model | None, keep: list[Column], text: Column) -> DataFrame:
    """The columns ``keep`` of each row with lang_pred, score and rejected."""
    letters = F.coalesce(text.cast("string").rlike("\\p{L}"), F.lit(False))
    rows = docs.select(*keep, F.when(letters, F.lower(whole(text))).alias("_text"))
    kept = [f for f in rows.schema.fields if f.name != "_text"]
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in kept) + ", lang_pred string, score double, rejected boolean"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column("_text")
            n = len(texts)
            known = ~np.asarray(texts.is_null()) if model and n else np.zeros(n, bool)
            names, score = np.full(n, UNKNOWN, object), np.zeros(n)
            for low in range(0, n, 256):
                own = [x.as_py().encode() for x in texts.slice(low, 256) if x.is_valid] if model else []
                if own:
                    p = model.scores(np.frombuffer(b"".join(own), np.uint8), np.cumsum([len(x) for x in own]))
                    at = low + np.flatnonzero(known[low:low + 256])
                    score[at], names[at] = p.max(1), np.array(model.languages, object)[p.argmax(1)]
            rejected = ~known | (score < (model.threshold if model else 1))
            yield pa.RecordBatch.from_arrays(
                [*[batch.column(f.name) for f in kept], pa.array(names, pa.string()), pa.array(score), pa.array(rejected)],
                [*[f.name for f in kept], "lang_pred", "score", "rejected"])

    return rows.mapInArrow(tidy(run), schema)


def identified(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang") -> DataFrame:
    """One row per input row: doc_id, held_out, lang_pred, score, rejected."""
    model = learn(docs, id_col, text_col, lang_col)
    held_out = F.coalesce(remainder(F.col(id_col)) == 2, F.lit(False))
    return predict(docs, model, [F.col(id_col).alias("doc_id"), held_out.alias("held_out")], F.col(text_col))


def accepted(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang") -> DataFrame:
    """The rows of ``docs`` whose language the model tells with enough certainty, with all their columns."""
    model = learn(docs, id_col, text_col, lang_col)
    return predict(docs, model, [F.struct("*").alias("_row")], F.col(text_col)).filter("not rejected").select("_row.*")
