"""Near vectors and exact top-k against brute force."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from catalog_sync.llm import vector_dedup
from catalog_sync.llm.impact_search import top_k
from catalog_sync.llm.vector_dedup import bucket_passes, near_vectors

SCHEMA = "vec_id long, embedding array<double>, label int, rank string, id string"
NAN, INF = float("nan"), float("inf")


@pytest.fixture
def vectors(spark):
    def make(rows):
        full = [(i, None if v is None else [None if x is None else float(x) for x in v], 1, "r", "i") for i, v in rows]
        return spark.createDataFrame(full, SCHEMA).repartition(3)

    return make


def clustered(seed, groups, dims=16):
    rng, rows = np.random.default_rng(seed), []
    for n in groups:
        centre = rng.standard_normal(dims)
        rows += [centre + rng.standard_normal(dims) * rng.choice([0.02, 0.1, 0.2]) for _ in range(n)]
    return [(int(i), v.tolist()) for i, v in zip(rng.permutation(len(rows)), rows, strict=True)]


ODD = [
    (9001, None), (9002, []), (9003, [0.0] * 16), (9004, [NAN] * 16), (9005, [INF] + [1.0] * 15),
    (9006, [None] + [1.0] * 15), (9007, [1e300] * 16), (9008, [1e-300] * 16),
]


def links_by_hand(rows, threshold):
    rows = [r for r in rows if r[1] and all(x is not None and np.isfinite(x) for x in r[1]) and any(r[1])]
    ids = np.array([r[0] for r in rows])
    unit = np.array([np.array(r[1]) / max(map(abs, r[1])) for r in rows])
    unit /= np.linalg.norm(unit, axis=1, keepdims=True)
    near = unit @ unit.T >= threshold
    np.fill_diagonal(near, False)
    low = ids.copy()
    while True:
        new = np.minimum(low, np.where(near, low[None, :], 1 << 60).min(axis=1))
        if (new == low).all():
            return {int(i): (int(n), int(c)) for i, n, c in zip(ids, near.sum(axis=1), low, strict=True)}
        low = new


def test_links_like_brute_force(vectors):
    rows = clustered(1, [1] * 60 + [2] * 20 + [40, 150]) + ODD
    rows += [(500 + i, rows[0][1]) for i in range(30)] + [(600, [2 * x for x in rows[0][1]])]
    want = links_by_hand(rows, 0.95) | {i: (0, i) for i in range(9001, 9007)}
    out = near_vectors(vectors(rows), window=32, block=64).collect()
    got = {r.vec_id: (r.n_links, r.component_id) for r in out}
    assert len(out) == len(rows) and all(r.kept == (r.vec_id == r.component_id) for r in out)
    linked = [i for i in want if want[i][0]]
    assert sum(got[i] == want[i] for i in linked) >= 0.98 * len(linked)
    assert all(got[i] == want[i] for i in want if not want[i][0])


def test_recall_at_the_threshold(vectors):
    """Pairs of cosine 0.95 to 0.96, the hardest, among many strangers."""
    rng, rows = np.random.default_rng(5), []
    for i in range(400):
        a = rng.standard_normal(64)
        a /= np.linalg.norm(a)
        b = rng.standard_normal(64)
        b -= (b @ a) * a
        c = rng.uniform(0.9505, 0.96)
        rows += [(2 * i, a.tolist()), (2 * i + 1, (c * a + np.sqrt(1 - c * c) * b / np.linalg.norm(b)).tolist())]
    rows += [(10_000 + i, v.tolist()) for i, v in enumerate(rng.standard_normal((3000, 64)))]
    found = near_vectors(vectors(rows)).where("n_links > 0 AND vec_id < 800").count()
    assert found >= 0.9 * 800


def dense_pairs(n, pairs, rho, seed=7, dims=64, near=(0.951, 0.97)):
    """``n`` vectors of cosine about ``rho`` to each other, then ``pairs`` of them again, turned a little."""
    rng = np.random.default_rng(seed)
    rows = np.sqrt(rho) * np.eye(dims)[0] + np.sqrt((1 - rho) / dims) * rng.standard_normal((n, dims))
    rows /= np.linalg.norm(rows, axis=1, keepdims=True)
    of = rows[:pairs]
    aside = rng.standard_normal(of.shape)
    aside -= (aside * of).sum(axis=1, keepdims=True) * of
    c = rng.uniform(*near, (pairs, 1))
    return np.concatenate([rows, c * of + np.sqrt(1 - c * c) * aside / np.linalg.norm(aside, axis=1, keepdims=True)])


@pytest.mark.parametrize("signs", [None, 3])
def test_dense_groups_lose_no_pairs(vectors, monkeypatch, signs):
    """Windows far smaller than a dense group, as those of 256 are in a large table."""
    if signs:
        monkeypatch.setattr(vector_dedup, "_signs", lambda *_: signs)
        monkeypatch.setattr(vector_dedup, "BUCKET_BLOCK", 500)
    rows = [(i, v.tolist()) for i, v in enumerate(dense_pairs(3000, 300, 0.8))]
    want = links_by_hand(rows, 0.95)
    out = {r.vec_id: (r.n_links, r.component_id) for r in near_vectors(vectors(rows), passes=2, window=4).collect()}
    linked = [i for i in want if want[i][0]]
    assert len(linked) >= 600 and all(out[i] == want[i] for i in want if not want[i][0])
    assert sum(out[i] == want[i] for i in linked) >= (0.98 if signs else 1) * len(linked)


def test_large_tables_lose_no_pairs_either(vectors, monkeypatch):
    """As a large table is answered: a dear pair made the old code choose many signs, which miss some links."""
    monkeypatch.setattr(vector_dedup, "PAIR_S", 1.0, raising=False)
    monkeypatch.setattr(vector_dedup, "BUCKET_BLOCK", 500)
    rows = [(i, v.tolist()) for i, v in enumerate(dense_pairs(3000, 1500, 0.5, near=(0.9501, 0.9502)))]
    want = links_by_hand(rows, 0.95)
    out = {r.vec_id: (r.n_links, r.component_id) for r in near_vectors(vectors(rows), passes=2, window=4).collect()}
    assert out == want and sum(n > 0 for n, _ in want.values()) >= 3000


def test_passes_follow_the_signs():
    assert bucket_passes(0, 0.95) == 1
    for signs in range(1, 20):
        meets = (1 - np.arccos(0.95) / np.pi) ** signs
        assert (1 - meets) ** bucket_passes(signs, 0.95) <= 0.005 < (1 - meets) ** (bucket_passes(signs, 0.95) - 1)


def test_repeated_and_missing_keys_and_no_vectors(vectors):
    a = [1.0] + [0.0] * 15
    out = near_vectors(vectors([(1, a), (1, a), (2, a), (None, a), (None, a), (3, None), (3, a)])).collect()
    assert sorted(((r.vec_id, r.n_links, r.component_id, r.kept) for r in out), key=repr) == sorted(
        [(1, 2, 1, True), (2, 2, 1, False), (3, 2, 1, False), (None, 0, None, False)], key=repr)
    assert near_vectors(vectors([]).where("false")).count() == 0


def best_by_hand(rows, k, of):
    usable = {}
    for i, v in rows:
        if i is not None and v and all(x is not None and np.isfinite(x) for x in v):
            units = np.floor(np.array(v) * 1024).astype("<i8")
            if i not in usable or np.frombuffer(units.tobytes(), "u1").tolist() < np.frombuffer(usable[i].tobytes(), "u1").tolist():
                usable[i] = units
    ids = sorted(usable)
    out = set()
    for q in ids:
        if of(q):
            scores = sorted((-int(usable[q].astype(object) @ usable[i].astype(object)), i) for i in ids if i != q)
            out |= {(q, n, i, -s) for n, (s, i) in enumerate(scores[:k], 1)}
    return out


@pytest.mark.parametrize(("block", "batch"), [(40, 7), (8192, 512)])
def test_top_k_like_brute_force(vectors, block, batch):
    rows = clustered(2, [1] * 100 + [30, 60]) + [r for r in ODD if r[0] != 9007]
    rows += [(700 + i, rows[3][1]) for i in range(25)] + [(None, rows[0][1]), (4, rows[9][1])]
    out = top_k(vectors(rows), F.col("id") % 5 == 0, k=10, block=block, batch=batch)
    assert {tuple(r) for r in out.collect()} == best_by_hand(rows, 10, lambda i: i % 5 == 0)


def test_few_candidates(vectors):
    one = [(5, [0.5] * 4), (10, [-0.5] * 4), (11, [0.25] * 4)]
    out = {tuple(r) for r in top_k(vectors(one), F.col("id") % 5 == 0).collect()}
    assert out == best_by_hand(one, 10, lambda i: i % 5 == 0) and len(out) == 4
    assert top_k(vectors([]).where("false"), F.col("id") % 5 == 0).count() == 0
    assert top_k(vectors(one[:1]), F.col("id") % 5 == 0).count() == 0


def test_large_components_take_part(vectors):
    rows = [(0, [1.0, 2.0]), (1, [70_000.0, 1.0]), (2, [3.0, 1.0]), (3, [1.0, 1.0]), (4, [65_536.0, -1e5]),
            (5, [1e5, 1e5]), (6, [1e9, 0.0]), (7, [-1e9, 3.0]), (10, [0.0, 1.0])]
    rows += [(20 + i, [float(i), 1e6 - i]) for i in range(90)]
    for block in (7, 8192):
        out = top_k(vectors(rows), F.col("id").isin(0, 2, 10, 40), k=10, block=block)
        assert {tuple(r) for r in out.collect()} == best_by_hand(rows, 10, lambda i: i in (0, 2, 10, 40))


def test_scores_beyond_a_long_raise(vectors):
    rows = [(1, [4e9, 0.0]), (2, [4e9, 1.0]), (3, [-4e9, 1.0]), (4, [0.0, 1.0])]
    with pytest.raises(Exception, match="does not fit a long"):
        top_k(vectors(rows), F.col("id") == 1, k=1).collect()
    # The lowest score of query 1 is not asked for here, so nothing has to hold it.
    out = top_k(vectors([rows[0], *rows[2:]]), F.col("id") == 1, k=1).collect()
    assert [(r.vec_id, r.score) for r in out] == [(4, 0)]
    with pytest.raises(Exception, match="does not fit 64 bits"):
        top_k(vectors([(1, [1e300])]), F.col("id") == 1).collect()


def test_rounds_of_queries(vectors):
    rows = clustered(5, [40, 40])
    out = top_k(vectors(rows), F.col("id") % 2 == 0, k=3, block=30, batch=4, round_bytes=16 * 8 * 7)
    assert {tuple(r) for r in out.collect()} == best_by_hand(rows, 3, lambda i: i % 2 == 0)
