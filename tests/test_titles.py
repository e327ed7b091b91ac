"""The title index: the same rows as a search of all titles, whatever was published since it was made."""

import random

import pytest
from pyspark.sql import functions as F

from catalog_sync.operators.incremental import title_search
from catalog_sync.operators.upsert import update_tagged
from catalog_sync.plans.titles import extend, find_titles, grams, indexed_version
from catalog_sync.schemas import TITLE_GRAMS
from catalog_sync.sources.snapshots import Rewrite, SnapshotStore

MOVIES = "id bigint, title string, popularity double"


def by_hand(text):
    low = text.lower()
    return list(dict.fromkeys(low[i : i + 3] for i in range(len(low) - 2)))


def test_grams(spark):
    texts = ["", "ab", "abc", "aaaa", "Alien³ – Ünder", "日本沈没 2", "😀x😀y", "a.*b\\c[d]$ ^", "x" * 3000 + "yz", "  \n\t "]
    df = spark.createDataFrame([(t,) for t in [*texts, None]], "t string")
    got = {r.t: r.g for r in df.select("t", grams(F.col("t")).alias("g")).collect()}
    assert got[None] is None
    for t in texts:
        assert (got[t] or []) == by_hand(t), t


QUERIES = iter(["r", "RING", "ed w", "日本沈", "zzz", "a.*", "ring of", "bca", "Éta", "the ring of rings", "red"] * 2)


def agree(store, *queries):
    """Some queries give what a look at all titles gives."""
    tables = store.tables()
    rows = [tuple(r) for r in tables["movies"].select("id", "title", "popularity").collect()]
    for q in queries or (next(QUERIES), next(QUERIES)):
        want = [r for r in rows if r[0] is not None and r[1] is not None and q.lower() in r[1].lower()]
        got = find_titles(tables, q).select("id", "title", "popularity").collect()
        assert sorted(map(tuple, got), key=repr) == sorted(want, key=repr), q


@pytest.mark.parametrize("buckets", [0, 4])
def test_index_and_scan_agree(spark, tmp_path, buckets):
    rng = random.Random(buckets)
    words = ["ring", "Red", "widget", "the", "of", "rings", "éta", "日本沈没", "abcabca", "a.*b", "x"]
    rows = [(i, " ".join(rng.choices(words, k=rng.randint(0, 5))), float(i % 7)) for i in range(80)]
    rows += [(100, None, 1.0), (101, "ring", None), (None, "red ring", 3.0)]
    movies = lambda some: spark.createDataFrame(some, MOVIES).coalesce(2)
    store = SnapshotStore(spark, str(tmp_path / "store"), buckets)
    store.publish(replace={"movies": movies(rows[:50])})
    agree(store, "ring")  # no index yet
    extend(store)
    assert indexed_version(store.tables()) == 1
    store.publish(append={"movies": movies(rows[50:])})
    agree(store)  # parts written since
    listed = store.table(TITLE_GRAMS).count()
    extend(store)
    every = sum(len(by_hand(t or "")) for i, t, _ in rows[50:] if i is not None)
    assert store.table(TITLE_GRAMS).count() - listed == every

    new = movies([(3, "The Ring of rings", 9.0), (4, None, 9.0), (5, rows[5][1], 9.5)])
    store.publish(rewrite={"movies": Rewrite(
        lambda: new.select("id"), lambda old: update_tagged(old, new, ["id"], ["title", "popularity"]))})
    agree(store, "ring of ring")
    listed = store.table(TITLE_GRAMS).count()
    extend(store)  # the changed titles only, though whole slots were rewritten
    assert store.table(TITLE_GRAMS).count() - listed <= len(by_hand("The Ring of rings"))
    agree(store, "ring of ring", "zzz")
    assert extend(store) is None
    store.compact("movies", most=1)
    store.compact(TITLE_GRAMS, most=1)
    agree(store)
    extend(store)
    extend(store, afresh=True)
    agree(store, "red")
    tables = store.tables()
    pages = [[r.id for r in find_titles(tables, "red", 3, p).collect()] for p in (1, 2)]
    whole = tables["movies"].where("id IS NOT NULL")
    assert pages == [[r.id for r in title_search(whole, "red", page_size=3, page=p).collect()] for p in (1, 2)]
    assert [r.id for r in find_titles(tables, "7").collect()] == [7]


def test_search_reads_its_own_slots(spark, tmp_path):
    store = SnapshotStore(spark, str(tmp_path / "store"), 16)
    rows = [(i, f"film number {i}" + (" kestrel" if i == 77 else ""), 1.0) for i in range(400)]
    store.publish(replace={"movies": spark.createDataFrame(rows, MOVIES)})
    extend(store)
    tables = store.tables()
    found = find_titles(tables, "Kestrel")
    assert [r.id for r in found.collect()] == [77]
    read = {f for f in found.inputFiles() if "/movies/" in f}
    assert read and len(read) < len(tables["movies"].inputFiles()) / 4


def test_empty_catalog(spark, tmp_path):
    store = SnapshotStore(spark, str(tmp_path / "store"), 4)
    store.publish(replace={"movies": spark.createDataFrame([], MOVIES)})
    extend(store)
    assert find_titles(store.tables(), "ring").count() == 0
    assert extend(store) is None
