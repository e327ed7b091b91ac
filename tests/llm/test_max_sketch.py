"""Lexical search against brute force: sketches of any width must give the same rows."""

import math
import random
import re
from collections import Counter

import numpy as np
import pytest

from catalog_sync.llm import max_sketch
from catalog_sync.llm.max_sketch import Lexicon, Scoring, counted, folded, search, sketch_rows

TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def terms(text):
    return TERM.findall((text or "").translate(LOWER))


def by_hand(docs, items, k=10):
    counts = [(i, Counter(terms(t))) for i, t in docs]
    counts = [(i, c) for i, c in counts if c]
    n_docs, length = len(counts), sum(sum(c.values()) for _, c in counts)
    df = Counter(t for _, c in counts for t in c)
    ranked = list({(i, t): (i, c) for (i, t), c in zip(docs, [Counter(terms(t)) for _, t in docs], strict=True) if i is not None}.values())
    out = set()
    for item, text in set(items):
        scores = []
        for i, c in ranked:
            n = sum(c.values())
            if n:
                m = 10 + 90 * n * n_docs // length
                score = sum(
                    math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[t] + 1))) * (10**9 * c[t] // (1000 * c[t] + 8 * m))
                    for t in set(terms(text)) if c[t]
                )
                scores += [(-score, i)] * (score > 0)
        out |= {(item, r, i, -s) for r, (s, i) in enumerate(sorted(scores)[:k], 1)}
    return out


VOCABULARY = ["the", "of", "Zürich", "x1", "naïve", "漢字", "B2B", "don", "t", "ß", "rare", "İ", "q"] + [f"w{i}" for i in range(60)]


def corpus(seed, n):
    rng = random.Random(seed)
    weights = [1 / (i + 1) for i in range(len(VOCABULARY))]
    text = lambda: " ".join(rng.choices(VOCABULARY, weights, k=rng.randint(1, 80)))
    rows = [(i, text()) for i in range(n)]
    rows += [(n + i, rows[3][1].upper() + "!") for i in range(40)]  # copies but for case and punctuation
    rows += [(n + 100, None), (n + 101, ""), (n + 102, "--- \x00 !"), (None, "rare w1 w2"), (None, None)]
    rows += [(5, "other text of doc 5 rare"), (6, "same row twice"), (6, "same row twice")]
    rows += [(n + 103, "rare " * 5000 + "w5 w9"), (n + 104, " ".join(f"u{i}" for i in range(30_000)) + " rare")]
    return rows


ITEMS = [
    (1, "The rare Zürich, don't!"), (2, None), (3, "..."), (4, "nothing here occurs-anywhere w1w2"), (5, "w3 w9 w20 w59"),
    (6, " ".join(VOCABULARY)), (6, " ".join(VOCABULARY)), (7, "same row twice"), (None, "b2b ß"), (1, "w7"), (8, "u7 u9"),
]


@pytest.mark.parametrize(("width", "seeds"), [(1 << 20, 32), (64, 2), (8, 1)])
def test_like_brute_force(spark, documents, width, seeds):
    docs = corpus(width, 300)
    items = spark.createDataFrame([(i, t, 1, "s") for i, t in ITEMS], "item_id long, text string, rank int, doc_id string")
    got = [tuple(r) for r in search(documents(docs), items, width=width, seeds=seeds).collect()]
    assert len(got) == len(set(got)) and set(got) == by_hand(docs, ITEMS)


def test_batches_and_ties(spark, documents, monkeypatch):
    monkeypatch.setattr(max_sketch, "ITEMS", 2)
    docs = [(i, "alpha beta" if i % 2 else "alpha gamma") for i in range(30, 0, -1)]
    asked = [(9, "alpha"), (8, "gamma beta"), (7, "beta")]
    items = spark.createDataFrame(asked, "item_id int, text string")
    got = search(documents(docs), items, k=4)
    assert got.dtypes == [("item_id", "int"), ("rank", "int"), ("doc_id", "bigint"), ("score", "bigint")]
    assert {tuple(r) for r in got.collect()} == by_hand(docs, asked, 4)


def test_empty_tables(spark, documents):
    items = spark.createDataFrame([(1, "a b")], "item_id long, text string")
    assert search(documents([]).where("false"), items).count() == 0
    assert search(documents([(1, "a")]), items.where("false")).count() == 0
    assert search(documents([(1, None)]), items).count() == 0
    assert search(documents([(1, "c d")]), items).count() == 0


def test_sketch_is_never_below_the_score():
    rng = random.Random(3)
    texts = [folded(" ".join(rng.choices(VOCABULARY, k=rng.randint(0, 50))).encode()) for _ in range(200)]
    lexicon = Lexicon(sorted({t for x in texts for t in x.split()}))
    n, (owner, term, count), every = counted(texts, lexicon)
    assert n.tolist() == [len(x.split()) for x in texts]
    impact = Scoring(200, int(n.sum()), np.zeros(0), []).impact
    for row, sketch in enumerate(sketch_rows(len(texts), *every, width=16)):
        entries = np.frombuffer(sketch, dtype="<u4")
        most = dict(zip((entries >> 12).tolist(), (entries & 4095).tolist(), strict=True))
        assert len(most) == len(entries) <= 16
        own = count[owner == row]
        assert sorted(most.values())[-1:] == sorted(own.tolist())[-1:]
        assert sum(most.values()) <= own.sum()
        assert impact(np.array([3]), np.array([50])) > impact(np.array([2]), np.array([50]))
    assert sorted(count.tolist()) == sorted(every[2].tolist())


def test_terms_of_one_hash_are_told_apart(monkeypatch):
    monkeypatch.setattr(max_sketch.words, "span_hashes", lambda sums, start, end: np.zeros(len(start), dtype=np.uint64))
    lexicon = Lexicon([b"abc", b"abd", b"ab"])
    _, (owner, term, count), _ = counted([b"abd ab abd", b"abx abc"], lexicon)
    assert list(zip(owner, term, count, strict=True)) == [(0, 1, 2), (0, 2, 1), (1, 0, 1)]


def test_long_texts_are_cut_between_terms(monkeypatch):
    monkeypatch.setattr(max_sketch, "GROUP", 10)
    lexicon = Lexicon([b"long", b"x" * 40])
    n, (owner, term, count), every = counted([b"long " * 9 + b"x" * 40, b"", b"long"], lexicon)
    assert n.tolist() == [10, 0, 1] and count.tolist() == [9, 1, 1] and term.tolist() == [0, 1, 0]
    assert owner.tolist() == [0, 0, 2] == every[0].tolist()
