"""Hard negatives against brute force in Python's integers."""

import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from catalog_sync.llm.hard_negatives import Heaps, hard_negatives, strassen

SCHEMA = "vec_id long, embedding array<double>, label int, id string, rank string, units int"
NAN, INF = float("nan"), float("inf")


@pytest.fixture
def vectors(spark):
    def make(rows):
        full = [(i, None if v is None else [None if x is None else float(x) for x in v], label, "c", "r", 1) for i, v, label in rows]
        return spark.createDataFrame(full, SCHEMA).repartition(3)

    return make


def by_hand(rows, anchor, positives=5, negatives=3, low=50, high=95, scale=256):
    known = {}
    for i, v, label in rows:
        if i is not None and label is not None and v and all(x is not None and math.isfinite(x) for x in v):
            units = [math.floor(scale * x) for x in v]
            bytes_ = b"".join((u % 2**64).to_bytes(8, "little") for u in units)
            known[i] = min(known.get(i, (label, bytes_, units)), (label, bytes_, units))
    out = set()
    for a, (label, _, units) in known.items():
        if not anchor(a):
            continue
        scored = sorted((-sum(x * y for x, y in zip(units, u, strict=True)), i, k) for i, (k, _, u) in known.items() if i != a)
        for s, p, _ in [x for x in scored if x[2] == label][:positives]:
            inside = [x for x in scored if x[2] != label and low * -s <= 100 * -x[0] <= high * -s]
            out |= {(a, p, r, i, -s, -n) for r, (n, i, _) in enumerate(inside[:negatives], 1)}
    return out


def clustered(seed, n, dims, labels):
    rng = np.random.default_rng(seed)
    centres = rng.standard_normal((labels, dims))
    rows = []
    for i in rng.permutation(n):
        label = int(rng.integers(labels)) if rng.random() > 0.4 else 0  # label 0 is hot
        rows.append((int(i), (0.5 * centres[label] + rng.standard_normal(dims) + 0.6).tolist(), label))
    return rows


ODD = [
    (9000, None, 1), (9001, [], 1), (9002, [NAN] * 7, 1), (9003, [INF] + [1.0] * 6, 1), (9004, [None] + [1.0] * 6, 1),
    (9005, [1.0] * 7, None), (None, [1.0] * 7, 1), (9010, [0.0] * 7, 3), (9015, [-1.0] * 7, 3), (9020, [1.0] * 7, 77),
]


@pytest.mark.parametrize(("block", "round_"), [(56 * 10, 56 * 7), (1 << 21, 1 << 25)])
def test_like_brute_force(vectors, block, round_):
    rows = clustered(1, 260, 7, 4) + ODD
    rows += [(500 + i, rows[3][1], i % 3) for i in range(40)]  # ties
    rows += [rows[5], (rows[6][0], rows[7][1], rows[6][2])]  # repeated keys
    out = hard_negatives(vectors(rows), F.col("id") % 5 == 0, block_bytes=block, round_bytes=round_)
    got = [tuple(r) for r in out.collect()]
    assert out.columns == ["anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score"]
    assert len(got) == len(set(got)) and set(got) == by_hand(rows, lambda i: i % 5 == 0)


def test_large_values_stay_exact(vectors):
    rng = random.Random(2)
    rows = [(i, [float(rng.randint(-(2**19), 2**19)) for _ in range(40)], i % 3) for i in range(60)]
    got = {tuple(r) for r in hard_negatives(vectors(rows), F.col("id") % 5 == 0).collect()}
    assert got == by_hand(rows, lambda i: i % 5 == 0) and any(r[4] > 2**54 for r in got)


@pytest.mark.parametrize("value", [1e10, 1e300])
def test_what_does_not_fit_raises(vectors, value):
    rows = [(i, [value, 1.0], 1) for i in range(10)]
    with pytest.raises(Exception, match="64 bits"):
        hard_negatives(vectors(rows), F.col("id") % 5 == 0).collect()


def test_few_and_none(vectors):
    one = [(5, [1.0, 0.0], 1), (6, [1.0, 0.0], 1), (7, [0.75, 0.0], 2)]
    got = {tuple(r) for r in hard_negatives(vectors(one), F.col("id") % 5 == 0).collect()}
    assert got == {(5, 6, 1, 7, 65536, 49152)} == by_hand(one, lambda i: i % 5 == 0)
    assert hard_negatives(vectors(one[:1]), F.col("id") % 5 == 0).count() == 0
    assert hard_negatives(vectors([]).where("false"), F.col("id") % 5 == 0).count() == 0
    with pytest.raises(Exception, match="dimensions"):
        hard_negatives(vectors([*one, (8, [1.0], 2)]), F.col("id") % 5 == 0).collect()


@pytest.mark.parametrize("seed", range(5))
def test_strassen(seed):
    rng = np.random.default_rng(seed)
    for top in (3, 2**20, 2**62):
        m, d, n = rng.integers(0, 70, 3)
        a, b = rng.integers(-top, top, (m, d)), rng.integers(-top, top, (d, n))
        exact = a.astype(object) @ b.astype(object) if d else np.zeros((m, n), dtype=object)
        exact = np.vectorize(lambda x: (int(x) + 2**63) % 2**64 - 2**63, otypes=[object])(exact) if m and n else exact
        assert (strassen(a, b, leaf=4) == exact).all()


def test_heaps_merge():
    rng, entries = random.Random(4), []
    heaps, other = Heaps(3, 4), Heaps(3, 4)
    for turn in range(20):
        scores, ids = [rng.randint(0, 5) for _ in range(9)], rng.sample(range(1000), 9)
        (heaps if turn % 2 else other).offer(1, np.array(scores), np.array(ids))
        entries += zip(scores, ids, strict=True)
    heaps.merge(np.arange(3), other.scores, other.ids, other.filled)
    assert list(zip(heaps.scores[1], heaps.ids[1], strict=True)) == sorted(entries, key=lambda e: (-e[0], e[1]))[:4]
    assert not heaps.filled[[0, 2]].any()
