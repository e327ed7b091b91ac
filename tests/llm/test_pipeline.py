"""The corpus pipeline: each stage against brute force on its own input, and the registered queries."""

import zlib
from collections import Counter, defaultdict
from pathlib import Path

import pytest

import corpus_pipeline
from catalog_sync.llm import queries
from catalog_sync.scratch import stage
from check_oracles import compare, connect
from test_text_dedup import groups_by_hand, lines_by_hand

FOLDER = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not Path(FOLDER).exists(), reason="driver tables not present")


@pytest.fixture(scope="module")
def stages(spark):
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet")
    out = [("documents", docs)]
    for name, function in corpus_pipeline.STAGES:
        docs = stage(function(spark, docs, FOLDER), name)
        out.append((name, docs))
    return dict(out)


def texts(df):
    return [(r.doc_id, r.text) for r in df.select("doc_id", "text").collect()]


def test_names_and_columns(stages):
    assert [n for n, _ in corpus_pipeline.STAGES] == ["toxicity", "line_dedup", "near_dedup", "mixing", "packing"]
    for name in list(stages)[:-1]:
        assert stages[name].columns == stages["documents"].columns


def test_toxic_documents_go(spark, stages):
    from catalog_sync.llm.toxicity import score_toxicity

    labels = spark.read.parquet(f"{FOLDER}/labels.parquet")
    clean = score_toxicity(stages["documents"], labels).where("predicted = 0")
    assert Counter(texts(stages["toxicity"])) == Counter(texts(stages["documents"].join(clean, "doc_id")))


def test_lines_go(stages):
    want = [(i, t) for i, _, _, t in lines_by_hand(texts(stages["toxicity"]), 10)]
    assert sorted(texts(stages["line_dedup"])) == sorted(want)
    assert stages["line_dedup"].where("n_chars <> length(text)").count() == 0


def test_one_of_each_group_stays(stages):
    rows = texts(stages["line_dedup"])
    found = groups_by_hand(rows, 5, 80)
    assert sorted(texts(stages["near_dedup"])) == sorted((i, t) for i, t in rows if found[i][2])


def test_mix_takes_effect(stages):
    before, after = Counter(texts(stages["near_dedup"])), Counter(texts(stages["mixing"]))
    assert set(after) <= set(before) and max(after.values()) <= 2
    words = lambda c: sum(n * len(t.split()) for (_, t), n in c.items())
    assert abs(words(after) / words(before) - 1.5) < 0.25


def test_packing_holds_everything(stages):
    rows, by = stages["packing"].collect(), defaultdict(list)
    for r in rows:
        by[r.sequence_id].append((r.offset, r.length))
    for own in by.values():
        at = 0
        for offset, length in sorted(own):
            assert offset == at
            at += length
        assert at <= 2048
    assert Counter(r.doc_id for r in rows if r.piece == 0) == Counter(i for i, _ in texts(stages["mixing"]))


@pytest.mark.parametrize("name", sorted(queries.SQL))
def test_query_equals_sql(spark, name):
    _, problems = compare(queries.RUNS[name](spark, FOLDER), connect(FOLDER), queries.SQL[name])
    assert problems == []


def test_one_query_per_operator():
    numbers = sorted(int(name[2:].split("_")[0]) for name in queries.RUNS)
    assert numbers == list(range(1, 14))


def test_held_out_rule(spark):
    out = queries.RUNS["op9_toxicity"](spark, FOLDER).collect()
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 4 == 2) for r in out)
