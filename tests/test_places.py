"""Rows picked by their places, and batches whose documents are written once and read where they lie."""

import datetime as dt
import random
from pathlib import Path

import pytest
from pyspark.sql import functions as F
from test_jobs import AS_OF, cast, doc
from test_ledger import drop

from catalog_sync.operators.places import BLOCK_ROWS, FILE, PLACE, bitmaps, located, nowhere, rows_at
from catalog_sync.plans import jobs
from catalog_sync.plans.jobs import Changes
from catalog_sync.plans.ledger import landed
from catalog_sync.scratch import scratch_root
from catalog_sync.sources.snapshots import SnapshotStore
from catalog_sync.streaming import stream_catalog


def test_rows_at_their_places(spark, tmp_path, rows):
    n = 2 * BLOCK_ROWS + 10
    for name, first in (("a", 0), ("b", n), ("c", 2 * n)):
        spark.range(first, first + (n if name != "c" else 9), 1, 1).write.parquet(str(tmp_path / name))
    scan = located(spark.read.schema("id bigint").parquet(*[str(tmp_path / x) for x in "abc"]))
    edges = [0, 1, 7, 8, BLOCK_ROWS - 1, BLOCK_ROWS, n - 1, n, n + BLOCK_ROWS, 2 * n - 1, 2 * n + 8]
    some = sorted({*edges, *random.Random(1).sample(range(2 * n + 9), 500)})
    wanted = spark.createDataFrame([(i,) for i in some], "id bigint")
    maps = bitmaps(scan.join(wanted, "id").select(FILE, PLACE))
    assert 4 <= maps.count() <= 7
    for most in (100, 0):  # beyond the bound they are joined without a broadcast
        assert rows(rows_at(scan, maps, most), "id") == sorted([(i,) for i in some], key=repr)
    assert rows_at(scan, bitmaps(scan.limit(0))).isEmpty()
    assert rows_at(nowhere(spark.range(0)), maps).isEmpty()


def _run(spark, drops, store, tmp_path):
    stream_catalog(spark, str(drops), store, str(tmp_path / "cp"), now=lambda: AS_OF).awaitTermination()


def _store(spark, tmp_path, buckets):
    store = SnapshotStore(spark, str(tmp_path / "store"), buckets=buckets)
    jobs.publish(store, Changes(replace=jobs.empty_tables(spark)))
    drops = tmp_path / "in"
    for kind in ("details", "credits", "persons"):
        (drops / kind).mkdir(parents=True)
    return store, drops


@pytest.mark.parametrize("buckets", [0, 4, 20])
def test_the_newest_of_all_fetches(spark, tmp_path, rows, buckets):
    """Copies, fetches without time or of one time, bad ones, and earlier batches: one film per id."""
    store, drops = _store(spark, tmp_path, buckets)
    late = "2025-01-01T00:00:00Z"
    drop(drops, "details", "a", [
        doc(1, "old"), doc(1, "new", fetched=late), doc(2, "copy"), doc(2, "copy"), doc(3, "untimed", fetched=None),
        doc(4, "timed"), doc(4, "untimed", fetched=None), doc(5, "whole"), {"id": 5, "title": "bare", "fetched_at": late},
        doc(6, "good"), doc(6, "failed", fetched=late, fetch_status="timeout"), doc(7, "x"), doc(7, "y"), doc(0, "none"),
        doc(None, "none"), "{broken", doc(8, "first")])
    drop(drops, "details", "b", [doc(2, "copy"), doc(1, "older", fetched="2023-01-01T00:00:00Z")])
    drop(drops, "credits", "a", [
        {"movie_id": 1, "cast": cast(11, 12), "fetched_at": "2024-01-01T00:00:00Z"},
        {"movie_id": 1, "cast": cast(13), "fetched_at": late}, {"movie_id": 5, "cast": cast(14)}, {"movie_id": 2, "cast": cast(15)},
        {"movie_id": 2, "cast": cast(15)}, {"movie_id": 3, "cast": []}, {"movie_id": 99, "cast": cast(16)}])
    drop(drops, "persons", "a", [{"id": i, "name": f"n{i}"} for i in range(11, 18)])
    _run(spark, drops, store, tmp_path)
    films = rows(store.table("movies"), "id", "title")
    assert [f for f in films if f[0] != 7] == [
        (1, "new"), (2, "copy"), (3, "untimed"), (4, "timed"), (6, "good"), (8, "first")]
    assert [f[1] in ("x", "y") for f in films if f[0] == 7] == [True]
    assert rows(store.table("credits"), "movie_id", "person_id") == [(1, 13), (2, 15)]
    assert rows(store.table("people"), "id") == [(13,), (15,)]
    assert store.table("landed_details").count() == 15 and store.table("landed_credits").count() == 7
    assert rows(store.table("errors"), "category", "id") == sorted([
        ("processing_error", None), ("timeout", 6), *[("no_credits", i) for i in (3, 4, 6, 7, 8)]], key=repr)
    # An older fetch changes nothing, a newer one does; credits find the details of the batch before.
    drop(drops, "details", "c", [doc(8, "older", fetched="2020-01-01T00:00:00Z"), doc(2, "newer", fetched=late), doc(9, "added")])
    drop(drops, "credits", "c", [{"movie_id": 8, "cast": cast(17)}, {"movie_id": 4, "cast": cast(11)}])
    _run(spark, drops, store, tmp_path)
    assert [f for f in rows(store.table("movies"), "id", "title") if f[0] != 7] == [
        (1, "new"), (2, "newer"), (3, "untimed"), (4, "timed"), (6, "good"), (8, "first"), (9, "added")]
    assert rows(store.table("credits"), "movie_id", "person_id") == [(1, 13), (2, 15), (4, 11), (8, 17)]
    assert rows(store.table("people"), "id") == [(11,), (13,), (15,), (17,)]
    assert spark.conf.get("spark.sql.maxConcurrentOutputFileWriters") == "0"


def _bytes(folders):
    return sum(f.stat().st_size for folder in folders for f in Path(folder).rglob("*.parquet"))


def test_a_batch_keeps_its_texts_once(spark, tmp_path):
    """Lines and documents are not staged besides: what a batch leaves in the scratch folder does not grow with
    its texts."""
    store, drops = _store(spark, tmp_path, 4)
    text = lambda i: random.Random(i).randbytes(20_000).hex()
    drop(drops, "details", "a", [doc(i, "t", overview=text(i)) for i in range(1, 51)])
    scratch = Path(scratch_root(spark)) / "catalog_sync"
    before = set(scratch.glob("*"))
    _run(spark, drops, store, tmp_path)
    staged, kept = _bytes(set(scratch.glob("*")) - before), _bytes([tmp_path / "store" / "landed_details"])
    assert store.table("movies").where("length(overview) = 40000").count() == 50
    assert kept > 1_000_000 > 10 * staged


def test_documents_are_not_shuffled(spark, tmp_path):
    store, _ = _store(spark, tmp_path, 4)
    lines = spark.createDataFrame([('{"id": 1, "title": "t", "release_date": ""}',)], "value string")
    credits = spark.createDataFrame([('{"movie_id": 1, "cast": [{"id": 1}]}',)], "value string")
    new = {"details": landed(store, lines, "details")[0], "credits": landed(store, credits, "credits")[0],
           "persons": landed(store, lines.limit(0), "persons")[0]}
    assert "landed_details" not in store.tables()  # nothing of it is published yet
    changes = jobs.sync_arrived(jobs.current_tables(store), new, AS_OF)
    for name in ("movies", "genres", "credits"):
        plan = changes.append[name]._jdf.queryExecution().executedPlan().toString()
        assert "BroadcastHashJoin" in plan and "Exchange hashpartitioning" not in plan, name
    done = store.publish(append={"landed_details": new["details"], "landed_credits": new["credits"]})
    assert done.rows == {"landed_details": 1, "landed_credits": 1} and done.counters["landed_details"]["insert"] == 1


def test_parts_of_another_layout_are_dealt_again(spark, tmp_path, rows):
    """Rows written ahead for a store without slots, published after the table got slots."""
    root = str(tmp_path / "store")
    plain, slotted = SnapshotStore(spark, root), SnapshotStore(spark, root, buckets=4)
    df = spark.createDataFrame([(i, i % 3, dt.date(2020, 1, i)) for i in range(1, 10)], "id bigint, n int, day date")
    ahead = plain.write_ahead("landed_persons", df, ["id", "day"], F.col("n") != 0)
    assert rows(ahead.rest, "id", "n") == [(3, 0), (6, 0), (9, 0)] and ahead.rows.count() == 6
    slotted.publish(replace={"landed_persons": df.where("id = 1").select("id", "day")})
    plain.publish(append={"landed_persons": ahead})
    tables = plain.tables()
    assert rows(tables["landed_persons"], "id") == [(1,), (1,), (2,), (4,), (5,), (7,), (8,)]
    assert all(p.slot is not None for p in tables.parts("landed_persons"))
    assert tables.bounds("landed_persons", "day") == (dt.date(2020, 1, 1), dt.date(2020, 1, 8))
