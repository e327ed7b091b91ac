"""Packing by rounds and by tree, token ids and mixing, against brute force and round trips."""

import json
import random
import zlib
from bisect import bisect_left, insort
from collections import Counter, defaultdict
from pathlib import Path

import numpy as np
import pytest

from catalog_sync.llm.mixing import copies, mix
from catalog_sync.llm.sync_packing import bands, pack
from catalog_sync.llm.tokens import pieces, runs_of
from catalog_sync.llm.tree_packing import best_fit_decreasing, packed_rows

TOKENS = "/opt/tokenizers/word_bpe_49k.json"
needs_tokenizer = pytest.mark.skipif(not Path(TOKENS).exists(), reason="no tokenizer files")
TEXTS = [
    (1, "The idiot's café, “naïve” thinking 123 x²! <|endoftext|> A<|endoftext|>b"), (2, None), (3, ""),
    (4, "word " * 5000), (5, "   ǅ İ. Σας ½… don't we'll!!!"), (None, "no key"), (1, "repeated key"),
    (6, "中文 字符\n\ttabs"), (7, "x" * 30_000),
]


def ids_by_hand(text):
    return runs_of(TOKENS).encode(text or "", add_special_tokens=False).ids + [0]


def sequences_by_hand(lengths, capacity):
    """Best-fit-decreasing over a sorted list of gaps."""
    gaps, n = [], 0
    for length in sorted(lengths, reverse=True):
        at = bisect_left(gaps, length)
        gap = gaps.pop(at) if at < len(gaps) else capacity
        n += gap == capacity
        insort(gaps, gap - length) if gap > length else None
    return n


@pytest.mark.parametrize("seed", [0, 1, 2])
def test_tree_is_best_fit_decreasing(seed):
    rng = random.Random(seed)
    lengths = [rng.randint(1, rng.choice([10, 64])) for _ in range(500)]
    made = best_fit_decreasing(lengths, 64)
    assert sorted(i for s in made for i in s) == list(range(500))
    assert all(sum(lengths[i] for i in s) <= 64 for s in made)
    assert len(made) == sequences_by_hand(lengths, 64)


@pytest.mark.parametrize("capacity", [1, 64, 100])
def test_rounds_pack_without_gaps(spark, capacity):
    rng = random.Random(capacity)
    lengths = [min(capacity, rng.choice([1, 2, 3, 7, 30, 31, 60, 64, rng.randint(1, 64)])) for _ in range(600)]
    rows = [(i, n, "kept") for i, n in enumerate(lengths)]
    out = pack(spark.createDataFrame(rows, "i int, length int, rank string"), ["i"], capacity).collect()
    assert sorted((r.i, r.length) for r in out) == [r[:2] for r in rows]
    by = defaultdict(list)
    for r in out:
        by[r.sequence_id].append((r.offset, r.length))
    for own in by.values():
        at = 0
        for offset, length in sorted(own):
            assert offset == at
            at += length
        assert at <= capacity
    assert len(by) == sequences_by_hand(lengths, capacity)


def test_rounds_refuse_and_empty(spark):
    schema = "i int, length int"
    assert pack(spark.createDataFrame([], schema), ["i"], 8).count() == 0
    for bad in (0, 9, None):
        with pytest.raises(ValueError):
            pack(spark.createDataFrame([(1, bad)], schema), ["i"], 8)
    assert bands(2048)[0] == (1024, 2047) and bands(2048)[-1][0] == 1


@needs_tokenizer
def test_pieces_give_the_ids_back(documents):
    out = defaultdict(list)
    for r in pieces(documents(TEXTS), "doc_id", "text", TOKENS, 64, 0, with_ids=True).collect():
        assert zlib.crc32(r.ids) == r.ids_crc32 and len(r.ids) == 4 * r.length and r.start == 64 * r.piece
        out[r.key].append((r.piece, r.ids))
    want = defaultdict(list)
    for i, t in TEXTS:
        want[i] += ids_by_hand(t)
    for i in want:
        got = Counter(np.frombuffer(b"".join(p for _, p in sorted(out[i])), "<u4").tolist())
        assert got == Counter(want[i])
    for i, t in TEXTS:
        if i not in (1, None):
            assert np.frombuffer(b"".join(p for _, p in sorted(out[i])), "<u4").tolist() == ids_by_hand(t)


@needs_tokenizer
def test_known_runs_encode_like_whole_texts():
    rng = random.Random(4)
    letters = "ab cdE'sFé.!?-’“”…$9½İǅσΣςÁ̧   ẞ中文\n\tı<|>"
    for _ in range(1500):
        text = "".join(rng.choice(letters) for _ in range(rng.randint(0, 14)))
        packed = next(runs_of(TOKENS).ids([text.encode()]))
        assert np.frombuffer(packed, "<u4").tolist() == ids_by_hand(text)[:-1], text


@needs_tokenizer
@pytest.mark.parametrize("block", [50, 1 << 20])
def test_matrices_give_the_documents_back(documents, block):
    rows = packed_rows(documents(TEXTS), TOKENS, size=32, block=block).collect()
    assert len({r.sequence_id for r in rows}) == len(rows)
    parts = defaultdict(list)
    for r in rows:
        ids, places = np.frombuffer(r.ids, "<u2"), np.frombuffer(r.positions, "<u2")
        assert len(ids) == len(places) == 32 and r.cu_seqlens[-1] == r.length and not ids[r.length :].any()
        for doc, a, b in zip(r.docs, r.cu_seqlens, r.cu_seqlens[1:], strict=False):
            parts[doc.doc_id].append((doc.start, ids[a:b].tolist()))
            assert places[a:b].tolist() == list(range(b - a))
    for i, t in TEXTS:
        if i != 1:
            assert sum((p for _, p in sorted(parts[i])), []) == ids_by_hand(t)
    assert packed_rows(documents([]).where("false"), TOKENS).count() == 0


@needs_tokenizer
def test_matrices_do_not_follow_small_partitions(documents):
    rng = random.Random(6)
    docs = documents([(i, "a " * rng.randint(1, 200)) for i in range(600)])
    rows = packed_rows(docs.repartition(100), TOKENS, size=256).select("length").collect()
    assert sum(r.length for r in rows) >= 0.99 * 256 * len(rows)
    few = packed_rows(docs.repartition(100), TOKENS, size=256, block=2000).select("length").collect()
    assert sum(r.length for r in few) == sum(r.length for r in rows)


def mixture(rows):
    """(target by source, takes by hand) by plain loops."""
    sizes = Counter()
    for _, t, s in rows:
        sizes[s] += len((t or "").split())
    order = sorted((s for s in sizes if s is not None)) + [None] * (None in sizes)
    weight = {s: (3.0, 1.0, 2.0)[i % 3] for i, s in enumerate(order)}
    budget, capped = 1.5 * sum(sizes.values()), set()
    while True:
        free = [s for s in order if s not in capped]
        level = (budget - sum(2 * sizes[s] for s in capped)) / sum(weight[s] for s in free) if free else 0
        more = {s for s in free if 2 * sizes[s] < level * weight[s]}
        if not more:
            return sizes, {s: 2.0 * sizes[s] if s in capped else level * weight[s] for s in order}
        capped |= more


def test_mix_comes_near_its_targets(documents):
    rng = random.Random(3)
    rows = [(i, "w " * rng.choice([0, 1, 5, 40, 300]), rng.choice(["a", "b", "c", "d", "é", None, "a"])) for i in range(900)]
    rows += [(5000, None, "a"), (5001, "", "z"), (None, "no key", "a"), (1, "again", "b"), (1, "again", "b")]
    sizes, goals = mixture(rows)
    out = copies(documents(rows)).collect()
    assert len(out) == len(rows)
    taken = Counter()
    for r in out:
        assert r.source_size == sizes[r.source] and r.target == pytest.approx(goals[r.source])
        assert 0 <= r.taken <= 2 * r.size and r.taken == r.copies * r.size
        taken[r.source] += r.taken
    for s, goal in goals.items():
        assert abs(taken[s] - goal) <= 300
    again = copies(documents(rows)).collect()
    key = lambda r: json.dumps(r.asDict(), sort_keys=True)
    assert sorted(map(key, out)) == sorted(map(key, again))
    emitted = mix(documents(rows))
    assert emitted.columns == documents(rows).columns
    want = Counter()
    for r in out:
        want[r.doc_id, r.source, r.mark] += r.copies
    got = Counter((r.doc_id, r.source, r.m) for r in emitted.selectExpr("*", "xxhash64(text) m").collect())
    assert got == Counter({k: n for k, n in want.items() if n})


def test_mix_of_nothing(documents):
    empty = documents([]).where("false")
    assert copies(empty).count() == 0 and mix(empty).count() == 0
    assert [r.taken for r in copies(documents([(1, None), (2, "")])).collect()] == [0, 0]


def test_a_full_cache_keeps_the_runs_met_first(monkeypatch):
    from catalog_sync.llm import tokens

    monkeypatch.setattr(tokens, "CACHED", 50)
    monkeypatch.setattr(tokens, "KEPT", 5, raising=False)
    runs = tokens.Runs(TOKENS)
    texts = [b"the cat and the dog", " ".join(f"word{i}" for i in range(200)).encode(), b"the last dog"]
    want = [b"".join(tokens.Runs(TOKENS).ids([t])) for t in texts]
    assert [b"".join(runs.ids([t])) for t in texts] == want
    assert b"the" in runs and len(runs) < 50
    runs.trim()
    assert len(runs) <= 5 and b"the" in runs and [b"".join(runs.ids([t])) for t in texts] == want
