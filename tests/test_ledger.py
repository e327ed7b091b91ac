"""Documents taken in once, jobs over them, errors and counters of jobs, and one publish per batch."""

import datetime as dt
import json

import pytest
from pyspark.sql import functions as F
from test_jobs import AS_OF, CREDITS, DETAILS, PERSONS, cast, catalog, director, doc, landing_root  # noqa: F401

from catalog_sync.operators.quality import error_counts
from catalog_sync.plans import jobs
from catalog_sync.plans.jobs import Changes, Landing
from catalog_sync.plans.ledger import forget_superseded, landing_of, list_files, take_in
from catalog_sync.sources.snapshots import Conflict, SnapshotStore
from catalog_sync.streaming import stream_catalog


def drop(root, kind, name, docs):
    (root / kind).mkdir(parents=True, exist_ok=True)
    lines = [d if isinstance(d, str) else json.dumps(d) for d in docs]
    (root / kind / f"{name}.json").write_text("\n".join(lines) + "\n")


@pytest.fixture
def store(spark, tmp_path, catalog):  # noqa: F811
    made = SnapshotStore(spark, str(tmp_path / "store"), buckets=4)
    jobs.publish(made, Changes(replace=dict(catalog)))
    return made


def test_files_are_taken_in_once(spark, store, landing_root, tmp_path, rows):  # noqa: F811
    assert list_files(spark, landing_root).count() == 3
    (done,) = take_in(store, landing_root)
    assert done.rows["landed_files"] == 3 and done.rows["landed_details"] == 10
    logged = {r.category: r.n for r in done.log.groupBy("category").agg(F.count("*").alias("n")).collect()}
    assert logged == {"timeout": 1, "processing_error": 2}
    assert take_in(store, landing_root) == []
    drops = tmp_path / "drops"
    drop(drops, "details", "b [1]*", [doc(1, "newer", fetched="2025-01-01T00:00:00Z")])
    drop(drops, "details", "c", [doc(90, "next")])
    one, two = take_in(store, str(drops), most_files=1)
    assert one.rows["landed_details"] == two.rows["landed_details"] == 1
    assert store.table("landed_files").count() == 5
    before = rows(jobs.release_listing(landing_of(store.tables())), "id", "title")
    assert (1, "newer") in before and (90, "next") in before
    assert forget_superseded(store).counters["landed_details"]["delete"] >= 0
    assert rows(jobs.release_listing(landing_of(store.tables())), "id", "title") == before
    assert store.table("landed_details").filter("id = 1").count() == 1


def test_jobs_over_taken_in_documents(spark, store, landing_root, catalog, rows):  # noqa: F811
    take_in(store, landing_root)
    raw, tables = Landing.read(spark, landing_root), store.tables()
    kept = landing_of(tables)
    plan = jobs._documents(kept, "left")._jdf.queryExecution().executedPlan().toString()
    assert "crew" not in plan and "cast#" not in plan
    for name, df in jobs.initial_build(kept).replace.items():
        assert rows(df) == rows(jobs.initial_build(raw).replace[name]), name
    ids = spark.createDataFrame([(7,), (3,)], "id bigint")
    for given in (None, ids):
        for name, df in jobs.refresh(tables, kept, AS_OF, given).replace.items():
            assert rows(df) == rows(jobs.refresh(catalog, raw, AS_OF, given).replace[name]), name
    for name, df in jobs.add_new(tables, kept, "2000").append.items():
        assert rows(df) == rows(jobs.add_new(catalog, raw, "2000").append[name]), name
    assert rows(jobs.search(tables, kept, "REL")) == rows(jobs.search(catalog, raw, "REL"))


def test_a_listing_narrows_the_scan(store, landing_root):  # noqa: F811
    take_in(store, landing_root)
    plan = jobs.release_listing(landing_of(store.tables()))._jdf.queryExecution().executedPlan().toString()
    assert "overview" not in plan and "genres" not in plan


def test_result_pages_are_the_listing(spark, store, landing_root, tmp_path, rows):  # noqa: F811
    drop(tmp_path / "in", "pages", "p", [
        {"page": 1, "total_pages": 1, "results": [{"id": 10, "release_date": "2024-05-01", "popularity": 2.0},
                                                  {"id": 10, "release_date": "2024-05-01", "popularity": 1.0}]},
        "{broken"])
    take_in(store, landing_root)
    (done,) = take_in(store, str(tmp_path / "in"))
    assert [(r.category, r.stage) for r in done.log.collect()] == [("processing_error", "pages")]
    landing = landing_of(store.tables())
    assert rows(jobs.discover(landing)) == [(10,)]
    assert rows(jobs.add_new(store.tables(), landing, "2000").append["movies"], "id") == [(10,)]


def test_refresh_of_one_id_writes_its_slots(spark, store, landing_root, rows):  # noqa: F811
    take_in(store, landing_root)
    for i in range(60, 90):
        store.publish(append={"movies": jobs._table_shape(spark.createDataFrame([(i, "x")], "id bigint, title string"), "movies")})
    store.compact("movies")
    tables = jobs.current_tables(store)
    ids = spark.createDataFrame([(7,)], "id bigint")
    done = jobs.publish(store, jobs.refresh(tables, landing_of(tables), AS_OF, ids), "refresh")
    assert done.parts["movies"] == 1 and done.rows["movies"] < tables.rows("movies")
    assert done.counters["movies"] == {"insert": 0, "update": 1, "unchanged": 0, "delete": 0}
    assert done.counters["genres"]["insert"] == 1 and done.counters["credits"]["insert"] == 2
    assert rows(store.table("movies").filter("id < 60"), "id", "title") == [
        (1, "before"), (2, "before"), (50, "before"), (7, "new")]
    assert store.table("movies").count() == 34
    again = jobs.refresh(jobs.current_tables(store), landing_of(store.tables()), AS_OF, ids)
    assert jobs.publish(store, again).counters["movies"]["unchanged"] == 1


def test_max_cast_reaches_the_jobs(spark, landing_root, catalog, rows):  # noqa: F811
    landing = Landing.read(spark, landing_root)
    built = jobs.initial_build(landing, max_cast=None).replace["credits"]
    assert built.filter("movie_id = 1 AND credit_type = 'cast'").count() == 10
    refreshed = jobs.refresh(catalog, landing, AS_OF, max_cast=1).replace["credits"]
    assert refreshed.filter("movie_id = 1 AND credit_type = 'cast'").count() == 1
    added = jobs.add_new(catalog, landing, "month", max_cast=0).append["credits"]
    assert rows(added, "person_id", "credit_type") == [(130, "crew")]


def test_every_job_logs_its_errors(spark, store, landing_root, tmp_path, rows):  # noqa: F811
    take_in(store, landing_root)
    jobs.sync(store, landing_of(store.tables()), "2000", AS_OF)
    log = store.table("errors")
    assert rows(log.filter("job = 'refresh'"), "category", "id") == [("no_credits", 2), ("removed_movies", 50)]
    assert rows(log.filter("job = 'add-new'"), "category", "id") == [
        ("no_actors", 5), ("no_credits", 5), ("not_found", 6)]
    counts = {r.category: (r.ids, r.without_id) for r in error_counts(log).collect()}
    assert counts["processing_error"] == (0, 2) and counts["no_credits"] == (2, 0) and counts["rate_limit"] == (0, 0)
    wanted = spark.createDataFrame([(8,), (77,), (4,)], "id bigint")
    added = jobs.add_documents(jobs.current_tables(store), Landing.read(spark, landing_root), wanted)
    assert {("timeout", 8), ("not_found", 8), ("not_found", 77), ("no_credits", 4)} <= set(rows(added.errors(), "category", "id"))


def test_commit_starts_again(spark, store, landing_root, rows):  # noqa: F811
    take_in(store, landing_root)
    turns = []

    def job(tables):
        changes = jobs.add_new(tables, landing_of(tables), "month")
        if not turns:  # another run adds the same film first
            other = jobs.add_new(jobs.current_tables(store), landing_of(tables), "month")
            jobs.publish(SnapshotStore(spark, store.root), other)
        turns.append(rows(changes.append["movies"], "id"))
        return changes

    jobs.commit(store, job)
    assert turns == [[(10,)], []] and store.table("movies").filter("id = 10").count() == 1
    with pytest.raises(Conflict):
        def stubborn(tables):
            turns.clear()
            return job(jobs.Snapshot(store, store._layout(2)).over(jobs.empty_tables(spark)))
        jobs.commit(store, stubborn, attempts=2)


def test_a_batch_reads_its_slots_in_one_publish(spark, tmp_path, rows):
    store = SnapshotStore(spark, str(tmp_path / "store"), buckets=8)
    jobs.publish(store, Changes(replace=jobs.empty_tables(spark)))
    drops = tmp_path / "in"
    for kind in ("details", "credits", "persons"):
        (drops / kind).mkdir(parents=True)

    def run():
        stream_catalog(spark, str(drops), store, str(tmp_path / "cp"), now=lambda: AS_OF).awaitTermination()

    drop(drops, "details", "a", [doc(i, f"t{i}") for i in range(1, 60)] + ["{broken"])
    drop(drops, "credits", "a", [{"movie_id": i, "cast": cast(100 + i), "crew": []} for i in range(1, 60)])
    drop(drops, "persons", "a", [{"id": 100 + i, "name": f"n{i}"} for i in range(1, 60)])
    run()
    version = store.version()
    assert store.table("movies").count() == store.table("people").count() == 59
    drop(drops, "details", "b", [doc(5, "newer", fetched="2025-01-01T00:00:00Z")])
    run()
    assert store.version() == version + 1
    record = store._record(version + 1)["tables"]
    assert len(record["movies"]["removed"]) == 1 and record["movies"]["actions"]["update"] == 1
    assert len(record["people"]["removed"]) == 1 and rows(store.table("movies").filter("id = 5"), "title") == [("newer",)]
    for v in range(2, store.version() + 1):  # no version holds films without their people
        at = store.tables(v)
        assert at["credits"].join(at["people"], F.col("person_id") == F.col("id"), "left_anti").count() == 0
    assert store.table("errors").filter("category = 'processing_error'").count() == 1
    # Someone the catalog mentions already, and someone it does not.
    drop(drops, "persons", "b", [{"id": 105, "name": "later", "fetched_at": "2025-01-01T00:00:00Z"}, {"id": 9, "name": "no"}])
    run()
    assert rows(store.table("people").filter("id IN (9, 105)"), "id", "name") == [(105, "later")]


def test_late_and_mentioned(spark, store, rows):
    """Persons mentioned by credits that a job published, not the stream."""
    mentioned = store.table("mentioned")
    assert rows(mentioned) == [(1,)]
    credits = jobs._table_shape(spark.createDataFrame([(1, 555, "crew")], "movie_id bigint, person_id bigint, credit_type string"), "credits")
    jobs.publish(store, Changes(append={"credits": credits}))
    assert rows(store.table("mentioned")) == [(1,), (555,)]
    jobs.publish(store, Changes(append={"credits": credits.limit(0)}))
    assert store.table("mentioned").count() == 2 and director(1) and dt.date.min
