"""Toxicity scores: held-out accuracy, and the cases that must not break."""

import random
import zlib

import pytest
from pyspark.sql import functions as F

from catalog_sync.llm.toxicity import FEATURES, Lexicon, features, fit, score_toxicity, without_toxic

BAD = ["idiot", "moron", "loser", "scum"]


@pytest.fixture(scope="module")
def corpus():
    rng = random.Random(1)
    docs, labels = [], []
    for i in range(600):
        words = [f"w{rng.randrange(400)}" for _ in range(rng.randrange(5, 80))]
        toxic = rng.random() < 0.3
        if toxic:
            for at in rng.sample(range(len(words)), 2):
                words[at] = rng.choice(BAD) + rng.choice(["", "!", "s,"])
        docs.append((i, " ".join(words)))
        labels.append((i, int(toxic)))
    return docs, labels


def test_held_out_accuracy(spark, documents, corpus):
    docs, labels = corpus
    table = spark.createDataFrame([*labels, (1, None), (None, 1), (77_777, 1)], "doc_id long, toxic int")
    odd = [(1000, None), (1001, ""), (None, "you idiot moron loser"), (1002, "word " * 50_000), (1003, "1d10t IDIOT you")]
    out = score_toxicity(documents(docs + odd), table).collect()
    assert len(out) == len(docs) + len(odd)
    truth, right, held = dict(labels), 0, 0
    for r in out:
        assert 0 <= r.score <= 1 and r.predicted == int(r.score >= 0.3)
        assert r.held_out == (r.doc_id is not None and zlib.crc32(str(r.doc_id).encode()) % 4 == 2)
        if r.held_out and r.doc_id in truth:
            held += 1
            right += r.predicted == truth[r.doc_id]
    assert held > 100 and right >= 0.95 * held
    kept = without_toxic(documents(docs + odd), table)
    assert kept.columns == documents(docs).columns
    assert {r.doc_id for r in kept.collect() if r.doc_id is not None} == {
        r.doc_id for r in out if not r.predicted and r.doc_id is not None
    }


def test_held_out_labels_teach_nothing(spark, documents, corpus):
    docs, labels = corpus

    schema = "doc_id long, toxic int"
    frame = spark.createDataFrame(labels, schema)
    turned = [(i, 1 - y if zlib.crc32(str(i).encode()) % 4 == 2 else y) for i, y in labels]
    one, two = fit(documents(docs), frame), fit(documents(docs), spark.createDataFrame(turned, schema))
    assert one.lexicon.terms.tolist() == two.lexicon.terms.tolist()
    assert one.trees.toDebugString.split("\n")[1:] == two.trees.toDebugString.split("\n")[1:]


def test_labels_without_documents_use_up_no_sample(spark, documents, corpus):
    docs, labels = corpus
    schema = "doc_id long, toxic int"
    more = [(10_000 + i, i % 2) for i in range(3000)]
    one = fit(documents(docs), spark.createDataFrame(labels, schema), sample=200)
    two = fit(documents(docs), spark.createDataFrame(labels + more, schema), sample=200)
    assert (one.lexicon.terms == two.lexicon.terms).all() and len(one.lexicon.terms)
    assert one.trees.toDebugString.split("\n", 1)[1] == two.trees.toDebugString.split("\n", 1)[1]


@pytest.mark.parametrize("labels", [[], [(1, 0)], [(1, 1), (3, 1)]])
def test_without_both_labels(spark, documents, labels):
    table = spark.createDataFrame(labels, "doc_id long, toxic int")
    out = score_toxicity(documents([(1, "a"), (3, "b")]), table).collect()
    assert {r.score for r in out} == {1.0 if len(labels) == 2 else 0.0}


def test_no_documents(spark, documents):
    labels = spark.createDataFrame([(1, 0)], "doc_id long, toxic int")
    assert score_toxicity(documents([]).where(F.lit(False)), labels).count() == 0


def test_features():
    import numpy as np

    from catalog_sync.llm.toxicity import document_terms

    terms = np.sort(document_terms(b"idiot"))
    words = Lexicon(terms, np.ones(len(terms)))
    named = lambda t: dict(zip(FEATURES, features(t.encode(), words), strict=True))
    assert set(named("").values()) == {0.0}
    assert named("You IDIOT!")["peak"] == 1 and named("You IDIOT!")["near_second_person"] == 1
    assert named("1d10t here")["undone_gain"] == 1 and named("1d10t here")["peak"] == 0
    assert named("i.d.i.o.t")["undone_peak"] == 1 and named("so f*ne")["obfuscated_rate"] > 0
    assert named("ALL CAPS")["capital_words"] == 1 and named("noooo")["stretched_rate"] > 0
