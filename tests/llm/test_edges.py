"""Nulls, empty and very long texts, ties, repeated rows, empty tables and clashing columns, for every operator and stage."""

import hashlib
import zlib
from array import array
from collections import Counter

import numpy as np
import pytest

import corpus_pipeline
from cardloom.llm import (exact_dedup, fingerprints, language_id, licenses, mixing, ngram_join, packing, secrets, token_counts,
                          token_files)

SCHEMA = ("doc_id long, text string, lang string, source string, n_chars long, row string, rank double, size string, _row string, "
          "name string, key string, label string, bucket string, chunk string, part string, _copies string, target string")
LONG = " ".join(f"w{i * 7919 % 5003}x" for i in range(60_000))
TEXTS = [None, "", " \n\t ", "same text here, five words and more", "same text here, five words and more", "Same TEXT here, five words and more",
         "one two", "ONE two", "!!! ???", LONG, LONG + " tail", 'key token = "aebccd4559894937c75946a5f6a3ed5b13ef9ee9" then',
         "Lead\nReleased under the MIT License.\nEnd", "é" * 5000, "日本語のテキスト", "a" * 40_000, "x"]


def rows():
    out = [(i, t, "en" if i % 2 else "fr", ["b", "a", None][i % 3], None) for i, t in enumerate(TEXTS)]
    out += [(3, TEXTS[3], "en", "a", 1), (3, TEXTS[3], "en", "a", 1), (3, "another text of the same id", "en", "b", 1)]
    out += [(None, TEXTS[3], None, None, None), (None, None, None, "a", None), (None, "no id but words enough for a shingle", "fr", "a", 2)]
    return [r + ("c",) * 1 + (1.0,) + ("c",) * 10 for r in out]


@pytest.fixture(scope="module")
def docs(spark):
    return spark.createDataFrame(rows(), SCHEMA)


@pytest.fixture(scope="module")
def none(spark):
    return spark.createDataFrame([], SCHEMA)


OPERATORS = {
    "op1": licenses.scan, "op2": fingerprints.edited_and_next, "op3": secrets.scan, "op4": ngram_join.components, "op5": language_id.identified,
    "op6": lambda d: token_counts.suffix_sums(token_counts.length_histogram(d)), "op7": exact_dedup.exact_duplicates,
    "op8": packing.packed, "op9": token_files.written_and_read, "op10": mixing.mixture}


@pytest.mark.parametrize("name", OPERATORS)
def test_empty_table(none, name):
    assert OPERATORS[name](none).collect() == []


@pytest.mark.parametrize("at", range(5))
def test_stage_on_empty_table(spark, none, at):
    step = corpus_pipeline.STAGES[at][1]
    out = step(spark, none, "")
    assert out.collect() == []
    assert at == 4 or out.columns == none.columns


@pytest.mark.parametrize("at", range(4))
def test_stage_keeps_columns_and_rows(spark, docs, at):
    out = corpus_pipeline.STAGES[at][1](spark, docs, "")
    assert out.columns == docs.columns
    known = Counter(map(tuple, docs.collect()))
    assert set(map(tuple, out.collect())) <= set(known)


def test_licenses(docs):
    found = licenses.scan(docs).collect()  # the paragraph has 6 bigrams, the notice 4 of them
    assert [(r["doc_id"], r["part"], r["position"], r["license"], r["dice"]) for r in found] == [
        (12, "line", 1, "MIT", 1.0), (12, "paragraph", 0, "MIT", 0.8)]


def test_license_bounds_do_not_lose_a_match(spark):
    wording = "alpha beta gamma delta epsilon zeta eta theta"
    texts = [wording, wording + " iota kappa lambda", "alpha beta gamma delta epsilon zeta", "alpha beta gamma", wording + "\n" + wording,
             "alpha beta gamma delta\nepsilon zeta eta theta", "x " * 500]
    frame = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = {(r["doc_id"], r["part"], r["position"]): r["dice"] for r in licenses.scan(frame, [("T", wording)], 0.6).collect()}
    want = {}

    def grams(t):
        w = t.split()
        return set(zip(w, w[1:]))

    for i, t in enumerate(texts):
        parts = [("line", k, x) for k, x in enumerate(t.split("\n"))] + ([("paragraph", 0, t)] if "\n" in t else [])
        for part, k, x in parts:
            a, b = grams(x), grams(wording)
            if a and 2 * len(a & b) / (len(a) + len(b)) >= 0.6:
                want[i, part, k] = 2 * len(a & b) / (len(a) + len(b))
    assert got == pytest.approx(want) and len(want) > 4


def test_fingerprints(docs):
    got = fingerprints.edited_and_next(docs).collect()
    assert len(got) == docs.count()
    plain = rows()
    known = sorted([r for r in plain if r[0] is not None], key=lambda r: (-r[0], hashlib.sha256((r[1] or "").encode()).hexdigest()), reverse=False)
    assert Counter((r["doc_id"], r["n_chars"]) for r in got) == Counter((r[0], len(r[1] or "")) for r in plain)
    by_id = {r["doc_id"]: r for r in got}
    ids = sorted({r[0] for r in known}, reverse=True)
    for at, doc in enumerate(ids):
        own = [r[1] or "" for r in known if r[0] == doc]
        after = [r[1] or "" for r in known if r[0] == ids[at + 1]] if at + 1 < len(ids) else None
        if len(own) == 1 and after and len(after) == 1:
            half = len(own[0]) // 2
            edited = own[0][:len(own[0]) - half] + after[0][:half]
            assert by_id[doc]["edited_sha256"] == hashlib.sha256(edited.encode()).hexdigest()
    assert all(0 <= r[c] <= 1 for r in got for c in ("near_edited", "near_next"))
    assert len({r["fingerprint"] for r in got if r["n_chars"] == len(TEXTS[3]) and r["doc_id"] in (3, 4)} - {None}) <= 2


def test_one_document_follows_itself(spark):
    got = fingerprints.edited_and_next(spark.createDataFrame([(1, "abcdef ghi")], "doc_id long, text string")).collect()
    assert got[0]["edited_sha256"] == hashlib.sha256(b"abcdeabcde").hexdigest()
    assert got[0]["near_next"] == 1.0


def test_groups_of_consecutive_documents(spark):
    texts = {i: "".join(chr(97 + (i * k) % 26) for k in range(i % 9)) for i in range(100)}
    frame = spark.createDataFrame([(i, t) for i, t in texts.items()], "doc_id long, text string")
    got = {r["doc_id"]: r["edited_sha256"] for r in fingerprints.edited_and_next(frame, group=7).collect()}
    for i, t in texts.items():
        half, after = len(t) // 2, texts[(i - 1) % 100]
        assert got[i] == hashlib.sha256((t[:len(t) - half] + after[:half]).encode()).hexdigest()


def test_secrets(docs):
    found = secrets.scan(docs).collect()
    value = "aebccd4559894937c75946a5f6a3ed5b13ef9ee9"
    hit = [r for r in found if r["doc_id"] == 11]
    assert [r["value_sha256"] for r in hit] == [hashlib.sha256(value.encode()).hexdigest()]


def test_secrets_learn_from_given_labels(spark):
    import random
    draw = random.Random(3)
    token = ["".join(draw.choices("0123456789abcdef", k=40)) for _ in range(60)]
    card = ["".join(draw.choices("0123456789", k=16)) for _ in range(60)]
    labelled = spark.createDataFrame([(v, "paid with", "src", False) for v in card[:40]] + [(v, "token = \"", "src", True) for v in token[:40]],
                                     "value string, before string, path string, secret boolean")
    texts = [f'that is my token = "{v}" now' for v in token[40:]] + [f"was paid with {v} then" for v in card[40:]]
    frame = spark.createDataFrame([(i, t, "src") for i, t in enumerate(texts)], "doc_id long, text string, source string")
    got = {r["doc_id"]: r["secret"] for r in secrets.scan(frame, labelled).collect()}
    assert got == {i: i < 20 for i in range(40)}


def brute_components(texts, percent=80):
    sets = []
    for t in texts:
        w = "".join(c.lower() if "A" <= c <= "Z" else c for c in t or "").replace("\n", " ").replace("\t", " ").split(" ")
        w = [x for x in w if x]
        sets.append({tuple(w[i:i + 5]) for i in range(len(w) - 4)} if len(w) >= 5 else {tuple(w)} if w else set())
    group = list(range(len(texts)))
    for i in range(len(texts)):
        for j in range(i):
            if sets[i] and sets[j] and 100 * len(sets[i] & sets[j]) >= percent * len(sets[i] | sets[j]):
                a, b = group[i], group[j]
                group = [min(a, b) if g in (a, b) else g for g in group]
    return [len(s) for s in sets], group


def test_ngram_join_edges(docs):
    got = ngram_join.components(docs).collect()
    plain = rows()
    sizes, group = brute_components([r[1] for r in plain])
    least = {}
    for r, g in zip(plain, group):
        if r[0] is not None:
            least[g] = min(least.get(g, r[0]), r[0])
    want = Counter((r[0], n, least.get(g) if n else r[0]) for r, n, g in zip(plain, sizes, group))
    assert Counter(map(tuple, got)) == want


@pytest.mark.parametrize("leaf,pivots,rounds,growth", [(2, 2, 3, 99), (3, 4, 1, 2), (2, 1, 0, 2), (2, 3, 3, 0)])
def test_ngram_join_by_pivots(spark, monkeypatch, leaf, pivots, rounds, growth):
    draw = np.random.default_rng(leaf)
    texts = []
    for family in range(6):
        base = [f"f{family}w{k}" for k in range(60)]
        for _ in range(9):
            own = list(base)
            for k in draw.integers(0, 60, draw.integers(0, 4)):
                own[k] = f"n{draw.integers(0, 1 << 30)}"
            texts.append(" ".join(own[:60 - draw.integers(0, 9)]) + " shared passage of many words that repeats")
    for name, value in (("LEAF", leaf), ("PIVOTS", pivots), ("GROWTH", growth), ("CHUNK", 4), ("CHUNK_SHINGLES", 500), ("BUCKET", 400)):
        monkeypatch.setattr(ngram_join, name, value)
    monkeypatch.setattr(ngram_join.linking_edges, "__defaults__", (80, rounds))
    got = ngram_join.components(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")).collect()
    sizes, group = brute_components(texts)
    assert {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in got} == {i: (n, g) for i, (n, g) in enumerate(zip(sizes, group))}


def test_language_of_edges(docs):
    got = language_id.identified(docs).collect()
    assert len(got) == docs.count()
    known = {r["doc_id"]: r for r in got}
    for doc in (0, 1, 2, 8):
        assert (known[doc]["lang_pred"], known[doc]["score"]) == ("und", 0.0)
    assert all(r["lang_pred"] in ("en", "fr", "und") for r in got)
    assert all(not r["held_out"] for r in got if r["doc_id"] is None)


def test_subwords_are_those_of_each_text_alone():
    texts = ["abc", "", "x", "été où", "abcdefghij" * 30]
    model = language_id.train(["aaa bbb", "ccc ddd"] * 20, ["l", "m"] * 20, [str(i) for i in range(40)])
    together = b"".join(t.encode() for t in texts)
    ends = np.cumsum([len(t.encode()) for t in texts])
    both = model.scores(np.frombuffer(together, np.uint8), ends)
    for k, t in enumerate(texts):
        raw = t.encode()
        alone = model.scores(np.frombuffer(raw, np.uint8), np.array([len(raw)]))
        assert both[k] == pytest.approx(alone[0])
    whole, language_id.STRETCH = language_id.STRETCH, 7
    try:
        assert model.scores(np.frombuffer(together, np.uint8), ends) == pytest.approx(both)
    finally:
        language_id.STRETCH = whole


def test_exact_dedup_edges(docs):
    got = exact_dedup.exact_duplicates(docs, block=7).collect()
    plain = rows()
    size = Counter(r[1] or "" for r in plain)
    top = {}
    for r in plain:
        t = r[1] or ""
        if r[0] is not None:
            top[t] = max(top.get(t, r[0]), r[0])
    want = Counter((r[0], top.get(r[1] or ""), size[r[1] or ""], hashlib.sha256((r[1] or "").encode()).hexdigest()) for r in plain)
    assert Counter((r["doc_id"], r["keep_id"], r["group_size"], r["text_sha256"]) for r in got) == want
    kept = [r for r in got if r["kept"]]
    assert len(kept) == len(size) and all(r["doc_id"] == r["keep_id"] for r in kept)
    left = exact_dedup.drop_exact_duplicates(docs).collect()
    assert Counter(r["text"] or "" for r in left) == Counter(list(size))


def test_a_label_for_two_blocks_stops_the_job(spark):
    from pyspark.sql import functions as F
    frame = spark.createDataFrame([(1, "aa"), (2, "bb")], "doc_id long, text string")
    with pytest.raises(Exception, match="two blocks share a label"):
        exact_dedup.exact_duplicates(frame, label=lambda b: F.length(b)).collect()


def test_packing_edges(docs):
    got = packing.packed(docs, length=64, chunk=5).collect()
    assert Counter(r["doc_id"] for r in got if r["piece"] == 0) == Counter(r[0] for r in rows())
    used = {}
    for r in got:
        used.setdefault(r["sequence_id"], []).append((r["offset"], r["length"]))
    for own in used.values():
        at = 0
        for offset, n in sorted(own):
            assert offset == at
            at += n
        assert at <= 64


@pytest.mark.parametrize("rule", ["norm", "dot"])
def test_packing_under_every_capacity(rule):
    draw = np.random.default_rng(8)
    histogram = Counter(int(x) for x in draw.integers(1, 101, 3000))
    plan = packing.best_fit(histogram, (100, 4, 5000 + 5000), rule, (1.0, 0.5, 0.5))
    tokens, documents, cost, places = Counter(), Counter(), Counter(), Counter()
    for length, first, many, sequence, _ in plan:
        places[length] += many
        for k in range(many):
            tokens[sequence + k] += length
            documents[sequence + k] += 1
            cost[sequence + k] += length * length
    assert places == histogram
    assert max(tokens.values()) <= 100 and max(documents.values()) <= 4 and max(cost.values()) <= 10_000


def test_token_files_edges(docs):
    got = token_files.written_and_read(docs, block=1000, step=16).collect()
    assert len(got) == docs.count()
    at = 0
    for r in sorted(got, key=lambda r: r["start"]):
        assert r["start"] == at
        at += r["n_tokens"]
    from tests.llm.test_brute_force import library_ids
    ids = {r[0]: x + [1] for r, x in zip(rows(), library_ids("word_bpe_49k.json", [r[1] for r in rows()]))}
    for r in got:
        if r["doc_id"] not in (None, 3):
            assert (r["n_tokens"], r["ids_crc32"]) == (len(ids[r["doc_id"]]), zlib.crc32(array("I", ids[r["doc_id"]]).tobytes()))


def test_large_ids_beside_a_null_one(spark):
    ids = [9007199254740993, None, 9007199254740995]
    frame = spark.createDataFrame([(i, "a b c d e f", "en", "s") for i in ids], "doc_id long, text string, lang string, source string").coalesce(1)
    for name in ("op1", "op2", "op4", "op5", "op7", "op8", "op9", "op10"):
        got = OPERATORS[name](frame).collect()
        assert name == "op1" or Counter(r["doc_id"] for r in got) == Counter(ids), name


def test_huffman_lengths_are_optimal_under_the_limit():
    import heapq
    draw = np.random.default_rng(9)
    for n in (1, 2, 3, 50, 700):
        counts = draw.integers(1, 10 ** draw.integers(1, 6), n)
        bits = token_files.code_lengths(counts, 20).astype(int)
        assert sum(2.0 ** -bits) <= 1
        heap, cost = list(map(int, counts)), 0
        heapq.heapify(heap)
        while len(heap) > 1:
            both = heapq.heappop(heap) + heapq.heappop(heap)
            cost += both
            heapq.heappush(heap, both)
        if n > 1:
            assert (counts * bits).sum() == cost
        tight = token_files.code_lengths(counts, max(1, int(n - 1).bit_length()))
        assert tight.max() <= max(1, int(n - 1).bit_length()) and sum(2.0 ** -tight.astype(float)) <= 1
        code = token_files.Code(np.arange(n) * 3, bits)
        ids = draw.choice(n, 5000, p=counts / counts.sum()) * 3
        assert (code.decode(*code.encode(ids, 64), len(ids), 64) == ids).all()


def test_checksums_join():
    a, b = b"some bytes", b"more of them" * 99
    assert token_files.joined_checksum(zlib.crc32(a), zlib.crc32(b), len(b)) == zlib.crc32(a + b)
    assert token_files.joined_checksum(0, zlib.crc32(b), len(b)) == zlib.crc32(b)


def test_mixing_edges(docs):
    got = mixing.mixture(docs).collect()
    assert len(got) == docs.count()
    for r in got:
        assert 0 <= r["taken"] <= 2 * r["size"] and r["taken"] == r["copies"] * r["size"]
    assert Counter(map(tuple, got)) == Counter(map(tuple, mixing.mixture(docs).collect()))


def test_mixing_near_targets_in_any_slotting(spark):
    draw = np.random.default_rng(10)
    data = [(i, " ".join(["w"] * int(n)), f"s{min(int(s), 4)}") for i, (n, s) in enumerate(zip(draw.integers(0, 300, 900), draw.exponential(1.5, 900)))]
    frame = spark.createDataFrame(data, "doc_id long, text string, source string")
    results = []
    for slot in (10, 100_000):
        rows_ = mixing.mixture(frame, slot=slot).collect()
        results.append(Counter(map(tuple, rows_)))
        taken, target = Counter(), {}
        for r in rows_:
            source = data[r["doc_id"]][2]
            taken[source] += r["taken"]
            target[source] = r["target"]
        total = sum(r["size"] for r in rows_)
        assert sum(target.values()) == pytest.approx(1.5 * total)
        for source, t in target.items():
            assert abs(taken[source] - t) <= 10
    assert results[0] == results[1]


def test_links_between_documents_that_a_split_settles_apart(spark, monkeypatch):
    """Chains of versions: pivots near both ends settle their halves, and the links between the halves are all that joins them."""
    from cardloom.llm.components import connected
    monkeypatch.setattr(ngram_join, "LEAF", 4)
    monkeypatch.setattr(ngram_join, "PIVOTS", 2)
    monkeypatch.setattr(ngram_join, "GROWTH", 100)
    members = spark.createDataFrame(
        [(f"r{r}", f"r{r}v{v}".encode(), False, True, list(range(5 * v, 5 * v + 100))) for r in range(120) for v in range(8)],
        "region string, key binary, settled boolean, home boolean, shingles array<bigint>")
    got = connected(ngram_join.linking_edges(members, rounds=3), "key", "other").collect()
    roots = {bytes(r["node"]): bytes(r["root"]) for r in got}
    assert roots == {f"r{r}v{v}".encode(): f"r{r}v0".encode() for r in range(120) for v in range(8)}


def test_secrets_every_run_of_a_word(spark):
    one, two = "aebccd4559894937c75946a5f6a3ed5b13ef9ee9", "ghp_0123456789abcdefABCDEF"
    texts = [f'{{"a":"{one}","b":"{two}"}}', f"see https://h/?token={two}&user=bob now", f"password={one};host=db", f"{two},{two},internationalisation"]
    frame = spark.createDataFrame([(i, t, "src") for i, t in enumerate(texts)], "doc_id long, text string, source string")
    digest = {hashlib.sha256(v.encode()).hexdigest(): v for v in (one, two)}
    got = {(r["doc_id"], r["position"], r["offset"]): digest[r["value_sha256"]] for r in secrets.scan(frame).collect()}
    assert got == {(0, 0, 6): one, (0, 0, texts[0].index(two)): two, (1, 1, 17): two, (2, 0, 9): one, (3, 0, 0): two, (3, 0, 27): two}
    before = {(r["doc_id"], r["offset"]): r["before"] for r in secrets.candidates(frame).collect()}
    assert before[1, 17] == "see https://h/?token=" and before[0, texts[0].index(two)].endswith(',"b":"')


def test_secrets_count_the_words_of_all_texts(spark):
    value = "internal-window-98765432109"
    texts = [f"x {value} y", "the internal window", "an internal Window far away from any candidate", f"again {value}"]
    frame = spark.createDataFrame([(i, t, "src") for i, t in enumerate(texts)], "doc_id long, text string, source string")
    counts = {r["word"]: r["n"] for r in secrets.word_counts(frame).collect()}
    assert (counts["internal"], counts["window"], counts["again"]) == (2, 2, 1)
    found = secrets.candidates(frame).withColumn("finding", secrets.F.col("doc_id"))
    got = secrets.described(found, secrets.word_counts(frame)).collect()
    assert [r["coverage"] for r in got] == pytest.approx([14 / len(value)] * 2)
    assert all(r["transitions"] > -6 for r in got)
