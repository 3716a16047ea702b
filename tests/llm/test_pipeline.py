"""The pipeline, stage by stage, against plain Python and SQL over what the stage before left."""

from collections import Counter

import duckdb
import pytest

import corpus_pipeline
from cardloom.llm import language_id, queries
from tests.llm.test_brute_force import crc, library_ids
from tests.llm.test_edges import brute_components


@pytest.fixture(scope="module")
def tables(spark, folder, tmp_path_factory):
    """The input and what each stage wrote."""
    out = [spark.read.parquet(f"{folder}/documents.parquet")]
    for at, (_, step) in enumerate(corpus_pipeline.STAGES):
        path = str(tmp_path_factory.mktemp("stage") / str(at))
        step(spark, out[-1], folder).write.parquet(path)
        out.append(spark.read.parquet(path))
    return out


def rows(df):
    return [r.asDict() for r in df.collect()]


def test_language_stage_drops_what_is_rejected(tables):
    kept = {r["doc_id"] for r in language_id.identified(tables[0]).collect() if not r["rejected"]}
    assert {r["doc_id"] for r in rows(tables[1])} == kept
    assert len(kept) > 0.97 * tables[0].count()
    assert tables[1].columns == tables[0].columns


def test_of_equal_texts_the_largest_id_stays(tables):
    last = {}
    for r in rows(tables[1]):
        last[r["text"]] = max(last.get(r["text"], -1), r["doc_id"])
    assert sorted(r["doc_id"] for r in rows(tables[2])) == sorted(last.values())


def test_one_of_each_near_copy_group_stays(tables):
    before = sorted(rows(tables[2]), key=lambda r: r["doc_id"])
    sizes, group = brute_components([r["text"] for r in before])
    want = [r["doc_id"] for i, (r, n) in enumerate(zip(before, sizes)) if n == 0 or group[i] == i]
    assert sorted(r["doc_id"] for r in rows(tables[3])) == want
    assert len(want) < len(before)


def test_mix_takes_what_the_sql_says(tables):
    con = duckdb.connect()
    arrow = tables[3].toArrow()
    con.register("documents", arrow)
    want = {r[0]: r[1] for r in con.execute(f"SELECT doc_id, copies FROM ({queries.ORACLES['op10_source_mixing']})").fetchall()}
    got = Counter(r["doc_id"] for r in rows(tables[4]))
    assert got == {k: v for k, v in want.items() if v}
    assert tables[4].columns == tables[0].columns


def test_packing_holds_every_row_of_the_mix(tables):
    mixed, packed = rows(tables[4]), rows(tables[5])
    ids = {r["doc_id"]: x + [2] for r, x in zip(mixed, library_ids("byte_bpe_50k.json", [r["text"] for r in mixed]))}
    copies = Counter(r["doc_id"] for r in mixed)
    want = Counter()
    for doc, own in ids.items():
        first = (len(own) - 1) % 1024 + 1
        cuts = [0, first, *range(first + 1024, len(own) + 1, 1024)]
        for k, (a, b) in enumerate(zip(cuts, cuts[1:])):
            want[doc, k, a, b - a, crc(own[a:b])] += copies[doc]
    assert Counter((r["doc_id"], r["piece"], r["start"], r["length"], r["ids_crc32"]) for r in packed) == want
    sequences = {}
    for r in packed:
        sequences.setdefault(r["sequence_id"], []).append((r["offset"], r["length"]))
    for own in sequences.values():
        at = 0
        for offset, n in sorted(own):
            assert offset == at
            at += n
        assert at <= 1024


def test_run_is_the_stages_in_a_row(spark, folder, tables):
    got = corpus_pipeline.run(spark, folder)
    key = ["doc_id", "piece", "start", "length", "ids_crc32"]
    assert Counter(map(tuple, got.select(key).collect())) == Counter(map(tuple, tables[5].select(key).collect()))
