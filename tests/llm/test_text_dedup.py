"""Line dedup and MinHash near-dedup against brute force."""

import random
from collections import Counter

import pytest

from catalog_sync.llm import minhash, shared
from catalog_sync.llm.line_dedup import drop_repeated_lines, filter_bits
from catalog_sync.llm.minhash import keep_one, near_duplicates

SPACE = " \t\n\r\x0b\x0c"
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def lines_by_hand(rows, min_docs):
    keys = [[x.strip(SPACE).translate(LOWER) for x in (t or "").split("\n")] for _, t in rows]
    found = Counter(k for own in keys for k in set(own) if k)
    out = []
    for (i, t), own in zip(rows, keys, strict=True):
        kept = [x for x, k in zip((t or "").split("\n"), own, strict=True) if not (k and found[k] >= min_docs)]
        out.append((i, len(own), len(own) - len(kept), None if t is None else "\n".join(kept)))
    return sorted(out, key=repr)


LINES = [
    (1, "Shared line\nown 1"), (2, "  shared LINE\t\nown 2\n"), (3, "shared line"), (4, None), (5, ""),
    (6, "\n\n"), (7, "É "), (8, "é"), (None, "shared line\nx"), (2, "shared line\nshared line\nagain"),
    (9, "y" * 200_000 + "\nshared line"),
]


@pytest.mark.parametrize("bits", [None, 1 << 20])
def test_lines_like_brute_force(documents, bits):
    out = drop_repeated_lines(documents(LINES), min_docs=4, bits=bits)
    got = sorted(((r.doc_id, r.n_lines, r.n_dropped, r.text) for r in out.collect()), key=repr)
    assert got == lines_by_hand(LINES, 4)


def test_rows_without_key_keep_their_own_lines(documents):
    rows = [(None, f"shared {i % 7}\nshared {i % 11}\nown {i}") for i in range(300)]
    out = drop_repeated_lines(documents(rows), min_docs=28)
    got = sorted(((r.doc_id, r.n_lines, r.n_dropped, r.text) for r in out.collect()), key=repr)
    assert got == lines_by_hand(rows, 28)


def test_a_full_filter_changes_nothing(documents):
    rows = [(i, "\n".join(f"line {j}" for j in range(i, i + 400))) for i in range(40)]
    out = drop_repeated_lines(documents(rows), min_docs=5, bits=1 << 10)
    got = sorted(((r.doc_id, r.n_lines, r.n_dropped, r.text) for r in out.collect()), key=repr)
    assert got == lines_by_hand(rows, 5)


def test_first_occurrence_stays(documents):
    rows = [(3, "a\nb"), (1, "x\na\na"), (2, "a")]
    out = {r.doc_id: r.text for r in drop_repeated_lines(documents(rows), min_docs=2, keep_first=True).collect()}
    assert out == {1: "x\na", 2: "", 3: "b"}


def test_no_lines(documents):
    out = drop_repeated_lines(documents([]).where("false"))
    assert out.count() == 0 and {"n_lines", "n_dropped", "rank", "component"} <= set(out.columns)


def test_filter_size_is_bounded():
    assert filter_bits(0) == 1 << 20 and filter_bits(10**12) == 1 << 28


def shingle_sets(rows, width):
    out = {}
    for i, t in rows:
        w = [x for x in "".join(" " if c in SPACE else c for c in (t or "").translate(LOWER)).split(" ") if x]
        n = min(width, len(w))
        out[i] = {tuple(w[j : j + n]) for j in range(len(w) - n + 1)} if n else set()
    return out


def groups_by_hand(rows, width, percent):
    sets = shingle_sets(rows, width)
    root = {i: i for i in sets}
    def find(i):
        while root[i] != i:
            i = root[i]
        return i
    for a in sets:
        for b in sets:
            same = len(sets[a] & sets[b])
            if a < b and same and 100 * same >= percent * (len(sets[a]) + len(sets[b]) - same):
                x, y = find(a), find(b)
                root[max(x, y)] = min(x, y)
    return {i: (len(sets[i]), find(i), find(i) == i) for i in sets}


def changed(words, n, rng):
    words = list(words)
    for at in rng.sample(range(len(words)), n):
        words[at] = f"z{rng.random()}"
    return words


def corpus(seed):
    rng, rows = random.Random(seed), []
    for g in range(12):
        base = [f"w{rng.randrange(300)}" for _ in range(rng.choice([1, 2, 3, 8, 60, 200]))]
        rows += [" ".join(base)] * rng.randrange(1, 4)
        for _ in range(6):
            base = changed(base, len(base) // 60, rng)  # a chain: ends may differ by more than is allowed
            rows.append("  ".join(base).upper() if rng.random() < 0.3 else " ".join(base))
    return [(i, t) for i, t in enumerate(rows)] + [(900, None), (901, ""), (902, " \n\t"), (903, "One"), (904, "one")]


@pytest.mark.parametrize("width", [2, 5])
def test_groups_like_brute_force(documents, width):
    rows = corpus(width)
    out = near_duplicates(documents(rows), words=width, percent=80)
    got = {r.doc_id: (r.n_shingles, r.component_id, r.kept) for r in out.collect()}
    assert got == groups_by_hand(rows, width, 80)


def test_links_past_the_centre_of_a_star(documents, monkeypatch):
    """0 is the centre of every bucket; 1 and 2 are like each other, not like it."""
    monkeypatch.setattr(minhash, "bands", lambda sig: __import__("numpy").arange(25, dtype="uint64"))
    words = [f"w{i}" for i in range(100)]
    other = [f"v{i}" for i in range(100)]
    rows = [(0, " ".join(words)), (1, " ".join(other)), (2, " ".join([*other, "end"])), (3, " ".join([*words, "end"]))]
    monkeypatch.setattr(minhash, "_signed", _signed_in_one_bucket(minhash._signed))
    out = near_duplicates(documents(rows), words=2)
    assert {r.doc_id: r.component_id for r in out.collect()} == {0: 0, 1: 1, 2: 1, 3: 0}


@pytest.mark.parametrize("block", [16, 4096])
def test_blocks_change_nothing(documents, monkeypatch, block):
    """Buckets larger and smaller than a block: all rows share every bucket."""
    monkeypatch.setattr(minhash, "BLOCK", block)
    monkeypatch.setattr(minhash, "SLAB", 7, raising=False)
    monkeypatch.setattr(minhash, "_signed", _signed_in_one_bucket(minhash._signed))
    rows = [(100 * g + i, " ".join([f"w{g}_{k}" for k in range(40)] + [f"end{i}"] * (i % 3))) for g in range(12) for i in range(4)]
    out = near_duplicates(documents(rows), words=2)
    got = {r.doc_id: (r.n_shingles, r.component_id, r.kept) for r in out.collect()}
    assert got == groups_by_hand(rows, 2, 80)


def test_members_of_a_bucket_meet_once(documents, monkeypatch):
    """600 documents in one bucket: they go to one group, not to one for each pair of blocks."""
    labels, real = [], minhash.stage
    monkeypatch.setattr(minhash, "stage", lambda df, label: labels.append(label) or real(df, label))
    monkeypatch.setattr(minhash, "_signed", _signed_in_one_bucket(minhash._signed))
    rows = [(i, f"a{i} b{i} c{i}") for i in range(600)]
    out = near_duplicates(documents(rows), words=2)
    assert out.where("kept").count() == 600 and "meet" not in labels


def test_small_tables_are_staged_in_few_files(documents, spark, monkeypatch):
    """Where nothing joins a shuffle's partitions, a few hundred rows are not dealt out to a file each."""
    files, real = {}, minhash.stage

    def stage(df, label):
        out = real(df, label)
        files.setdefault(label, []).append(len(out.inputFiles()))
        return out

    monkeypatch.setattr(minhash, "stage", stage)
    monkeypatch.setattr(shared, "stage", stage)
    rows = [(i, " ".join(f"w{i % 40}_{k}" for k in range(60)) + " end" * (i % 3)) for i in range(300)]
    options = {"spark.sql.shuffle.partitions": "64", "spark.sql.adaptive.coalescePartitions.enabled": "false"}
    before = {k: spark.conf.get(k) for k in options}
    try:
        for k, v in options.items():
            spark.conf.set(k, v)
        got = {r.doc_id: (r.n_shingles, r.component_id, r.kept) for r in near_duplicates(documents(rows), words=2).collect()}
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)
    assert got == groups_by_hand(rows, 2, 80)
    cores = spark.sparkContext.defaultParallelism
    small = ("classes", "buckets", "members", "star", "texts", "edges", "low", "large", "of")
    assert {label: n for label, n in files.items() if label in small and max(n) > cores} == {}


def _signed_in_one_bucket(real):
    from pyspark.sql import functions as F

    def signed(*args):
        return real(*args).withColumn("__bands", F.expr("sequence(1L, 25L)"))

    return signed


def test_repeated_and_missing_keys(documents):
    a, b = " ".join(f"a{i}" for i in range(40)), " ".join(f"b{i}" for i in range(40))
    rows = [(5, a), (5, b), (7, b), (3, a), (None, a), (8, None), (8, b)]
    got = [(r.doc_id, r.n_shingles > 0, r.component_id) for r in near_duplicates(documents(rows)).collect()]
    assert sorted(got, key=repr) == sorted([
        (5, True, 3), (5, True, 3), (7, True, 3), (3, True, 3), (None, True, None), (8, False, 8), (8, True, 3),
    ], key=repr)
    kept = keep_one(documents(rows)).collect()
    assert sorted(((r.doc_id, r.text) for r in kept), key=repr) == sorted([(3, a), (None, a), (8, None)], key=repr)


def test_no_documents(documents):
    empty = documents([]).where("false")
    assert near_duplicates(empty).count() == 0 and keep_one(empty).columns == empty.columns
