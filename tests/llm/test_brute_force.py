"""Queries that SQL cannot say, against plain Python over the same small table."""

import hashlib
import zlib
from array import array
from collections import Counter

import numpy as np
import pytest

import __spark_entry__ as entry
from cardloom.llm.tokens import ChunkEncoder, vocabulary

QUERIES = entry.queries()


@pytest.fixture(scope="module")
def docs(spark, folder):
    return [r.asDict() for r in spark.read.parquet(f"{folder}/documents.parquet").collect()]


def library_ids(name, texts):
    from tokenizers import Tokenizer
    tokenizer = Tokenizer.from_file(vocabulary(name))
    return [e.ids for e in tokenizer.encode_batch([t or "" for t in texts], add_special_tokens=False)]


def crc(ids):
    return zlib.crc32(array("I", ids).tobytes())


def test_chunked_encoding_is_that_of_the_library(docs):
    odd = ["", " ", "\n", "a  b", " a", "a ", "a\n\nb", "a \n b", "a\tb c", "don't we'll x's", "<|endoftext|> a", "a<|endoftext|>b c",
           "Ärger ÉTÉ é éa İ ſ ΑΣ ΣΑΣ.", " x y  z", "x\x00y z", "1234 5a a5 ½ ² x2,. ...", "日本 語。 🙂🙂 \U0001F600 a",
           "word,### next%%% !!THE!!", "\x1cx \x1c y", "a\u0000 b", "ǅ ǆa Ǆ", "İstanbul I", "﻿x y", "ﬁn ﬁ, x'", "'s 's' a's,", "_a_ b_ _c", "a ×. b ÷, c", "x. y, z.\nw,\nv", "ª. º, µ. b", "日. a, b", "4.0, 2. 0", ". a", ", a", "a., b", "a,. b"]
    texts = odd + [d["text"] for d in docs] + [" ".join(odd)]
    for name in ("byte_bpe_50k.json", "word_bpe_49k.json"):
        for remembered in (50, 10 ** 6):
            encoder = ChunkEncoder(vocabulary(name), remembered)
            got = [array("I", x).tolist() for x in encoder.encode(texts)]
            assert got == library_ids(name, texts)


def test_op2(spark, folder, docs):
    rows = {r["doc_id"]: r for r in QUERIES["op2_document_fingerprints"](spark, folder).collect()}
    ordered = sorted(docs, key=lambda d: -d["doc_id"])
    assert len(rows) == len(docs)
    for d, after in zip(ordered, ordered[1:] + ordered[:1]):
        text, follow, r = d["text"] or "", after["text"] or "", rows[d["doc_id"]]
        half = len(text) // 2
        edited = text[:len(text) - half] + follow[:half]
        assert r["n_chars"] == len(text)
        assert r["edited_sha256"] == hashlib.sha256(edited.encode()).hexdigest()
        assert 0 <= r["near_edited"] <= 1 and 0 <= r["near_next"] <= 1
        a, b, c = ([p[i:i + 4] for i in range(0, len(p), 4)] for p in (
            r["fingerprint"], r["edited_fingerprint"], rows[after["doc_id"]]["fingerprint"]))
        for other, near in ((b, r["near_edited"]), (c, r["near_next"])):
            used = [(x, y) for x, y in zip(a, other) if x != "...." or y != "...."]
            assert near == pytest.approx(sum(x == y for x, y in used) / len(used) if used else 1.0)
    by_text = {}
    for d in docs:
        assert by_text.setdefault(d["text"], rows[d["doc_id"]]["fingerprint"]) == rows[d["doc_id"]]["fingerprint"]
    assert np.mean([r["near_edited"] for r in rows.values()]) > 2 * np.mean([r["near_next"] for r in rows.values()])


def test_op5_on_held_out_rows(spark, folder, docs):
    rows = {r["doc_id"]: r for r in QUERIES["op5_language_id"](spark, folder).collect()}
    assert len(rows) == len(docs)
    right = []
    for d in docs:
        r = rows[d["doc_id"]]
        assert r["held_out"] == (zlib.crc32(str(d["doc_id"]).encode()) % 4 == 2)
        assert 0 <= r["score"] <= 1
        if r["held_out"]:
            right.append(r["lang_pred"] == d["lang"])
    assert np.mean(right) > 0.95
    assert np.mean([r["rejected"] for r in rows.values()]) < 0.03


def test_op6(spark, folder, docs):
    lengths = [len(x) for x in library_ids("byte_bpe_50k.json", [d["text"] for d in docs])]
    rows = {r["length"]: r for r in QUERIES["op6_token_counts"](spark, folder).collect()}
    assert set(rows) == set(lengths)
    for n, count in Counter(lengths).items():
        r = rows[n]
        assert r["n_docs"] == count
        assert r["docs_at_least"] == sum(x >= n for x in lengths)
        assert r["tokens_at_least"] == sum(x for x in lengths if x >= n)
        assert r["truncated_total"] == sum(min(x, n) for x in lengths)
        assert r["share_up_to"] == sum(x <= n for x in lengths) / len(lengths)
        assert (r["total_docs"], r["total_tokens"]) == (len(lengths), sum(lengths))


def test_op8(spark, folder, docs):
    ids = {d["doc_id"]: x + [2] for d, x in zip(docs, library_ids("byte_bpe_50k.json", [d["text"] for d in docs]))}
    rows = QUERIES["op8_best_fit_packing"](spark, folder).collect()
    pieces, sequences = {}, {}
    for r in rows:
        pieces.setdefault(r["doc_id"], []).append(r)
        sequences.setdefault(r["sequence_id"], []).append((r["offset"], r["length"]))
    assert set(pieces) == set(ids)
    for doc, own in pieces.items():
        own.sort(key=lambda r: r["piece"])
        assert [r["piece"] for r in own] == list(range(len(own)))
        at = 0
        for r in own:
            assert r["start"] == at
            assert r["ids_crc32"] == crc(ids[doc][at:at + r["length"]])
            at += r["length"]
        assert at == len(ids[doc])
        assert len(own) == -(-at // 1024) and all(r["length"] == 1024 for r in own[1:])
    for own in sequences.values():
        at = 0
        for offset, length in sorted(own):
            assert offset == at
            at += length
        assert at <= 1024
    # plain best fit, one piece at a time
    bins = []
    for n in sorted((r["length"] for r in rows), reverse=True):
        fits = [i for i, left in enumerate(bins) if left >= n]
        if fits:
            bins[min(fits, key=lambda i: bins[i])] -= n
        else:
            bins.append(1024 - n)
    assert len(sequences) <= len(bins)


def test_op9(spark, folder, docs):
    ordered = sorted(docs, key=lambda d: d["doc_id"])
    ids = [x + [1] for x in library_ids("word_bpe_49k.json", [d["text"] for d in ordered])]
    want, at = [], 0
    for d, own in zip(ordered, ids):
        want.append((d["doc_id"], at, len(own), crc(own)))
        at += len(own)
    got = QUERIES["op9_token_files"](spark, folder).select("doc_id", "start", "n_tokens", "ids_crc32").orderBy("doc_id").collect()
    assert [tuple(r) for r in got] == want
