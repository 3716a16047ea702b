"""Spelling variants, Merkle manifest and toxicity against plain Python, on the small tables and on edge cases."""

import re
import zlib
from collections import Counter
from hashlib import sha256

import numpy as np
import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry
from cardloom.llm import manifest, spelling, toxicity
from tests.llm.test_edges import LONG, SCHEMA, rows

QUERIES = entry.queries()


@pytest.fixture(scope="module")
def docs(spark):
    return spark.createDataFrame(rows(), SCHEMA)


@pytest.fixture(scope="module")
def none(spark):
    return spark.createDataFrame([], SCHEMA)


def lowered(text):
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text)


# ---- spelling ----------------------------------------------------------------

def brute_words(pairs):
    out = Counter()
    for doc, text in pairs:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = lowered(run)
            h = zlib.crc32(f"{'' if doc is None else doc}:{run}".encode())
            if h % 31 == 0:
                run = run[:h % len(run)] + run[h % len(run) + 1:]
            if len(run) >= 7:
                out[run] += 1
    return {w: n for w, n in out.items() if n >= 2}


def one_apart(a, b):
    if len(a) < len(b):
        a, b = b, a
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    return len(a) == len(b) + 1 and any(a[:i] + a[i + 1:] == b for i in range(len(a)))


def brute_variants(vocab, times=10):
    near = {w: [v for v in vocab if abs(len(v) - len(w)) < 2 and one_apart(w, v)] for w in vocab}
    form = {}
    for w, own in near.items():
        best = min(own, key=lambda v: (-vocab[v], v), default=None)
        form[w] = best if best is not None and vocab[best] >= times * vocab[w] else None
    out = {}
    for w in vocab:
        root = w
        while form[root] is not None:
            root = form[root]
        out[w] = (form[w], root, vocab[w], len(near[w]), vocab[form[w]] if form[w] else None)
    return out


def variants_of(frame, **more):
    got = spelling.variants(spelling.vocabulary(spelling.slipped(spelling.runs(frame))), **more).collect()
    return {r["word"]: (r["form"], r["root"], r["n"], r["n_near"], r["form_n"]) for r in got}


def test_variants_of_the_edge_table(docs):
    assert variants_of(docs) == brute_variants(brute_words((r[0], r[1]) for r in rows()))


def test_words_near_each_other(spark):
    draw = np.random.default_rng(11)
    stems, texts = ["receive", "definitely", "aaaaaaaa", "éÀßtraße", "abcdefgh", "zzzzzzzzz"], []
    letters = "abzéÀÿ"
    for doc in range(400):
        word = stems[int(draw.integers(0, 6)) if draw.random() < 0.5 else 0]
        for _ in range(int(draw.integers(0, 3))):
            at, letter = int(draw.integers(0, len(word))), letters[int(draw.integers(0, 6))]
            word = [word[:at] + word[at + 1:], word[:at] + letter + word[at:], word[:at] + letter + word[at + 1:]][int(draw.integers(0, 3))]
        texts.append(f"{word} receive 12 {word.upper() if word.isascii() else word}")
    frame = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    want = brute_variants(brute_words(enumerate(texts)))
    assert sum(v[3] for v in want.values()) > 50 and any(v[0] for v in want.values())
    assert variants_of(frame) == want
    # filters that are sent in parts give the same
    assert variants_of(frame, round_bytes=64) == want


def test_parts_of_a_filter_answer_for_all_its_words(monkeypatch):
    monkeypatch.setattr(spelling, "TOGETHER", 4)
    draw = np.random.default_rng(12)
    keys = draw.integers(0, 1 << 63, 2000).astype(np.uint64) * np.uint64(2) + np.uint64(1)
    planned = spelling.rounds({7: 2000, 8: 3}, most=64 * 20)
    assert all(sum(last - first for _, first, last in r.values()) <= 20 for r in planned)
    found = np.zeros(len(keys), int)
    for wanted in planned:
        if 7 in wanted:
            own = spelling.Filter(*wanted[7])
            place = spelling.places(keys, own.count)
            own.add(keys[(place >= own.first) & (place < own.last)])
            found[own.may_have(keys)] += 1
    assert (found == 1).all()
    whole = spelling.Filter(spelling.blocks(2000), 0, spelling.blocks(2000))
    whole.add(keys)
    others = draw.integers(0, 1 << 63, 20_000).astype(np.uint64) * np.uint64(2)
    assert len(whole.may_have(others)) < 100


def test_edits_by_slices(monkeypatch):
    words = ["abcdefghij", "aabbccddee", "zzzzzzzzzz"]
    codes = np.frombuffer("".join(words).encode("latin-1"), np.uint8).reshape(3, 10)
    results = []
    for size in (1 << 16, 3):
        monkeypatch.setattr(spelling, "SLICE", size)
        total = spelling.sums(codes)
        results.append([sorted((int(r), int(k)) for rows_, keys in edits(codes, total) for r, k in zip(rows_, keys))
                        for edits in (spelling.left_out, spelling.replaced)])

    def key(word):
        return int(spelling.mixed(spelling.sums(np.frombuffer(word.encode("latin-1"), np.uint8).reshape(1, -1)))[0])

    left = sorted({(k, key(w[:i] + w[i + 1:])) for k, w in enumerate(words) for i in range(10)})
    swapped = sorted((k, key(w[:i] + chr(c) + w[i + 1:])) for k, w in enumerate(words) for i in range(10) for c in spelling.ALPHABET if c > ord(w[i]))
    assert results[0] == results[1] == [left, swapped]


def test_roots_of_a_long_chain(spark):
    forms = spark.createDataFrame([(f"w{i}", f"w{i + 1}") for i in range(11)] + [("v", "w5")], "word string, form string")
    assert {r["word"]: r["root"] for r in spelling.roots(forms).collect()} == {**{f"w{i}": "w11" for i in range(11)}, "v": "w11"}


def test_a_very_long_word(spark):
    long = "ab" * 40_000
    frame = spark.createDataFrame([(1, long), (2, long), (3, long + "b"), (4, long + "b")], "doc_id long, text string")
    got = {len(k): v[3] for k, v in variants_of(frame).items()}
    want = brute_words([(1, long), (2, long), (3, long + "b"), (4, long + "b")])
    assert set(got) == set(map(len, want)) and (len(want) < 2 or set(got.values()) == {1})


# ---- manifest ----------------------------------------------------------------

def H(text):
    return sha256(text.encode()).hexdigest()


def brute_manifest(table):
    def leaf(d, text):
        return H("".join("-" if v is None else f"{len(str(v).encode())}:{v}" for v in (d["doc_id"], d["source"], d["lang"], d["n_chars"], text)))

    def levels(nodes):
        out = [nodes]
        while len(out[-1]) > 1:
            out.append([H("".join(out[-1][k:k + 16])) for k in range(0, len(out[-1]), 16)])
        return out

    def path(own, k):
        out = []
        for level in own[:-1]:
            first = k - k % 16
            out.append((level[first:k], level[k + 1:first + 16]))
            k //= 16
        return out

    by = {}
    for d in table:
        by.setdefault(d["source"], []).append(d)
    order = sorted(by, key=lambda s: (s is not None, (s or "").encode()))
    for own in by.values():
        own.sort(key=lambda d: (d["doc_id"] is not None, d["doc_id"] or 0, leaf(d, d["text"])))
    trees = {s: levels([leaf(d, d["text"]) for d in by[s]]) for s in order}
    over, out = levels([trees[s][-1][0] for s in order]), []
    for j, s in enumerate(order):
        for k, d in enumerate(by[s]):
            whole, node = path(trees[s], k) + path(over, j), trees[s][0][k]
            if d["doc_id"] is not None and zlib.crc32(str(d["doc_id"]).encode()) % 5 == 0:
                node = leaf(d, d["text"] and lowered(d["text"]))
            for before, after in whole:
                node = H("".join([*before, node, *after]))
            out.append((d["doc_id"], trees[s][0][k], trees[s][-1][0], over[-1][0], H("".join(x for b, a in whole for x in b + a)), node,
                        node == over[-1][0]))
    return Counter(out)


def test_manifest_of_the_small_table(spark, folder):
    table = [r.asDict() for r in spark.read.parquet(f"{folder}/documents.parquet").collect()]
    got = QUERIES["op12_merkle_manifest"](spark, folder).collect()
    assert Counter(map(tuple, got)) == brute_manifest(table)
    assert {r["verified"] for r in got} == {True, False}


def test_manifest_of_the_edge_table(docs):
    got = manifest.verified_rows(docs).collect()
    assert Counter(map(tuple, got)) == brute_manifest([r.asDict() for r in docs.collect()])


@pytest.mark.parametrize("sizes", [[1], [2, 1], [16, 17, 1], [256, 257, 300], [4097, 1, 1], [1] * 40])
def test_manifest_of_trees_of_many_sizes(spark, sizes):
    table = [{"doc_id": i, "source": f"s{k}" if k else None, "lang": "en", "n_chars": 3, "text": f"Text {k} {i}"}
             for k, n in enumerate(sizes) for i in range(k * 10_000, k * 10_000 + n)]
    frame = spark.createDataFrame([tuple(d.values()) for d in table], "doc_id long, source string, lang string, n_chars long, text string")
    want = brute_manifest(table)
    for levels in (2, 1):
        assert Counter(map(tuple, manifest.verified_rows(frame.repartition(3), height=levels).collect())) == want


# ---- toxicity ----------------------------------------------------------------

def words_of(text):
    return re.findall("[a-z0-9À-￿]+", text.lower())


def test_features_are_words_pairs_triples_and_skips():
    text = "One two, three—four «one» two"
    words = ["one", "two", "three", "four", "one", "two"]
    want = set(words) | {(1, *words[i:i + 2]) for i in range(5)} | {(2, *words[i:i + 3]) for i in range(4)} | {
        (3, words[i], words[i + 2]) for i in range(4)} | {(4, words[i], words[i + 3]) for i in range(3)}
    assert len(toxicity.examples([text])[0]) == len(want)
    same = toxicity.examples(["", None, "ONE TWO", "one  two!", "two one", "one"])
    assert len(same[0]) == len(same[1]) == 0 and (same[2] == same[3]).all() and len(same[2]) == 3
    assert not np.isin(same[4][~np.isin(same[4], same[5])], same[2]).all()


def test_features_do_not_depend_on_stretches(monkeypatch):
    texts = [LONG, "été " * 50 + "Ende", "a b c d e f g", LONG[:5000] + " stop"]
    whole = toxicity.examples(texts, most=1 << 30)
    model = toxicity.Model(np.unique(np.concatenate([w[::7] for w in whole])), None, 0.1)
    model.weights = np.linspace(-1, 1, len(model.features)) / 100
    scores = model.scores(texts)
    for size in (97, 4096):
        monkeypatch.setattr(toxicity, "STRETCH", size)
        got = toxicity.examples(texts, most=1 << 30)
        assert all((a == b).all() for a, b in zip(whole, got))
        assert model.scores(texts) == pytest.approx(scores)
    for text, score in zip(texts, scores):
        assert model.scores([text])[0] == pytest.approx(score)
        assert score == pytest.approx(1 / (1 + np.exp(-model.logit(toxicity.examples([text], 1 << 30)[0]))))


def plain_ftrl(examples, labels, turns):
    """FTRL-proximal as published, one coordinate at a time."""
    z, n = Counter(), Counter()

    def weight(i):
        if i and abs(z[i]) <= toxicity.L1:
            return 0.0
        penalty, shrink = (toxicity.L1, toxicity.L2) if i else (0.0, 0.0)
        return -(z[i] - np.sign(z[i]) * penalty) / ((toxicity.BETA + np.sqrt(n[i])) / toxicity.ALPHA + shrink)

    for order in turns:
        for k in order:
            own = [0, *examples[k].tolist()]
            w = {i: weight(i) for i in own}
            g = 1 / (1 + np.exp(-sum(w.values()))) - labels[k]
            for i in own:
                z[i] += g - (np.sqrt(n[i] + g * g) - np.sqrt(n[i])) / toxicity.ALPHA * w[i]
                n[i] += g * g
    return {i: weight(i) for i in z}


def test_steps_are_those_of_the_published_algorithm():
    draw = np.random.default_rng(13)
    examples = [np.unique(draw.integers(1, 30, 8)).astype(np.uint32) for _ in range(80)]
    labels = np.array([int(5 in x or 6 in x) for x in examples])
    block = toxicity.Block.unpacked(toxicity.Block.of(examples, labels, labels > 5, seen=1).packed().iloc[0])
    state, turns = toxicity.State.empty(), [draw.permutation(80) for _ in range(3)]
    for order in turns:
        state = toxicity.merged(state, [toxicity.pass_through(state, block, order)])
    want = plain_ftrl(examples, labels, turns)
    assert dict(zip(state.features.tolist(), state.weights())) == pytest.approx({i: want.get(i, 0.0) for i in state.features.tolist()})
    assert (state.weights() == 0).sum() > 3 and state.weights()[list(state.features).index(5)] > 0.5


def planted(n=600):
    draw = np.random.default_rng(14)
    calm, bad = [f"calm{k}" for k in range(200)], [f"nasty{k}" for k in range(6)]
    out = []
    for i in range(n):
        toxic = int(draw.random() < 0.2)
        words = list(draw.choice(calm, int(draw.integers(5, 60))))
        for _ in range(toxic * 3):
            words.insert(int(draw.integers(0, len(words))), str(draw.choice(bad)))
        out.append((i, " ".join(words), toxic))
    return out


def test_toxic_texts_are_found_among_held_out_rows(spark):
    table = planted()
    docs = spark.createDataFrame([(i, t) for i, t, _ in table] + [(None, "nasty1 nasty2 calm3"), (9001, None), (9002, "")], "doc_id long, text string")
    # labels of held-out rows are turned round: they must not matter
    labels = spark.createDataFrame([(i, 1 - x if zlib.crc32(str(i).encode()) % 3 == 1 else x) for i, _, x in table] + [(None, 0), (5, None), (6, 7)],
                                   "doc_id long, toxic int")
    got = toxicity.toxicity(docs, labels).collect()
    assert len(got) == len(table) + 3
    by_id = {r["doc_id"]: r for r in got}
    truth = {i: x for i, _, x in table}
    held = [i for i in truth if zlib.crc32(str(i).encode()) % 3 == 1]
    assert all(by_id[i]["held_out"] == (i in set(held)) for i in truth) and not by_id[None]["held_out"]
    hit = [i for i in held if by_id[i]["predicted"]]
    assert all(truth[i] for i in hit) and len(hit) > 0.9 * sum(truth[i] for i in held)
    assert all(0 <= r["score"] <= 1 and r["predicted"] == int(r["score"] >= 0.7) for r in got)
    assert by_id[9001]["score"] == by_id[9002]["score"] and by_id[None]["predicted"] == 1
    again = toxicity.toxicity(docs.repartition(5), labels.repartition(3)).collect()
    assert {r["doc_id"]: r["score"] for r in again} == {r["doc_id"]: r["score"] for r in got}


def test_draw_is_bounded_and_its_odds_are_undone(spark):
    labels = spark.range(20_000).select(F.col("id").alias("doc_id"), (F.col("id") % 10 == 0).cast("int").alias("toxic"))
    own, shift = toxicity.drawn(labels, per_label=500)
    counts = {r["label"]: r["count"] for r in own.groupBy("label").count().collect()}
    assert all(400 < n < 600 for n in counts.values())
    assert shift == pytest.approx(np.log(1 / 9), abs=0.1)
    assert own.filter(toxicity.remainder(F.col("id")) == 1).count() == 0


def test_stretch_gives_probabilities():
    draw = np.random.default_rng(15)
    logits = draw.normal(0, 1, 4000)
    labels = (draw.random(4000) < 1 / (1 + np.exp(-(2.5 * logits - 1)))).astype(int)
    assert toxicity.stretch(logits, labels) == pytest.approx((2.5, -1), abs=0.25)
    assert toxicity.stretch(np.zeros(0), np.zeros(0)) == (1.0, 0.0)


def test_toxicity_of_the_edge_table(spark, docs):
    labels = spark.createDataFrame([(i, i % 2, "c") for i in range(17)] + [(3, 0, "c"), (3, 1, "c")], "doc_id long, toxic int, text string")
    got = toxicity.toxicity(docs, labels).collect()
    assert Counter(r["doc_id"] for r in got) == Counter(r[0] for r in rows())
    empty = {r["score"] for r in got if r["doc_id"] in (0, 1, 2, 8)}
    assert len(empty) == 1
    unlearnt = toxicity.toxicity(docs, labels.limit(0)).collect()
    assert {(round(r["score"], 9), r["predicted"]) for r in unlearnt} == {(round(1 / (1 + np.exp(2.0)), 9), 0)}


@pytest.mark.parametrize("name", ["spelling", "manifest", "toxicity"])
def test_empty_tables(none, name):
    labels = none.selectExpr("doc_id", "1 AS toxic")
    run = {"spelling": lambda: variants_of(none), "manifest": lambda: manifest.verified_rows(none).collect(),
           "toxicity": lambda: toxicity.toxicity(none, labels).collect()}[name]
    assert not run()
