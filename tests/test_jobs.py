"""The jobs on hand-written documents that hold every awkward case."""

import datetime as dt
import json

import pytest
from pyspark.sql import functions as F

from catalog_sync.operators.quality import error_summary
from catalog_sync.plans import jobs
from catalog_sync.plans.jobs import Changes, Landing
from catalog_sync.schemas import TABLES
from catalog_sync.sources.csv_files import write_catalog
from catalog_sync.sources.landing import read_documents
from catalog_sync.sources.snapshots import SnapshotStore
from catalog_sync.streaming import stream_catalog, stream_upsert

AS_OF = dt.datetime(2024, 6, 1)
OLD = dt.datetime(2020, 1, 1)


def doc(id_, title="t", date="2020-01-01", fetched="2024-01-01T00:00:00Z", **more):
    return {"id": id_, "title": title, "release_date": date, "fetched_at": fetched, **more}


def cast(*ids):
    return [{"id": i, "name": f"n{i}", "character": f"c{i}", "order": o} for o, i in enumerate(ids)]


def director(id_, **more):
    return {"id": id_, "job": "Director", **more}


DETAILS = [
    doc(1, "plain", genres=[{"name": "Drama"}, {"name": "Action"}], budget="1e3", popularity="9"),
    doc(2, "no credits", "2020-1-5", genres=[]),
    doc(3, "crew only", ""),
    doc(4, "bad date", "2020-02-30"),
    doc(5, "bad budget", budget="abc"),
    {"id": 6, "release_date": "2020-01-01"},
    doc(7, "old", genres=[{"name": "Old"}]),
    doc(7, "new", fetched="2024-02-01T00:00:00Z", genres=[{"name": "New"}]),
    doc(8, "late fetch", fetch_status="timeout"),
    doc(9, "adult", "2024-05-01", adult=True),
    doc(10, "released", "2024-05-01", genres=[{"name": "Drama"}], popularity="5"),
]
CREDITS = [
    {"movie_id": 1, "cast": cast(*range(101, 111)), "crew": [director(120), director(121)]},
    {"movie_id": 3, "cast": [], "crew": [director(101, department="D")]},
    {"movie_id": 7, "cast": cast(101, 101, 999), "crew": [director(None), director(120)]},
    {"movie_id": 10, "cast": cast(130), "crew": [director(130)]},
]
PERSONS = [{"id": i, "name": f"person {i}", "gender": 1} for i in [*range(101, 111), 120, 130, 500]]


@pytest.fixture(scope="module")
def landing_root(tmp_path_factory):
    root = tmp_path_factory.mktemp("landing")
    for kind, docs in {"details": DETAILS, "credits": CREDITS, "persons": PERSONS}.items():
        (root / kind).mkdir()
        lines = [json.dumps(d) for d in docs]
        if kind == "details":
            lines += ["{broken", '{"id": "x", "title": "wrong type"}']
        (root / kind / "part.json").write_text("\n".join(lines) + "\n")
    return str(root)


@pytest.fixture(scope="module")
def landing(spark, landing_root):
    return Landing.read(spark, landing_root)


@pytest.fixture(scope="module")
def built(spark, landing):
    requested = spark.createDataFrame([(i,) for i in [*range(1, 9), 77]], "id bigint")
    return jobs.initial_build(landing, requested)


def test_initial_build(built, rows):
    t = built.replace
    assert rows(t["movies"], "id", "title", "budget") == [
        (1, "plain", 1000), (2, "no credits", None), (3, "crew only", None), (7, "new", None)]
    assert rows(t["movies"], "id", "release_date")[1] == (2, dt.date(2020, 1, 5))
    assert rows(t["genres"]) == [(1, "Action"), (1, "Drama"), (7, "New")]
    assert rows(t["credits"].filter("movie_id > 1"), "movie_id", "person_id", "credit_type") == [
        (3, 101, "crew"), (7, 101, "cast"), (7, 999, "cast")]
    assert t["credits"].filter("movie_id = 1").count() == 9
    assert rows(t["people"], "id") == [(i,) for i in [*range(101, 109), 120]]


def test_initial_build_errors(built):
    log = built.errors()
    got = {r.category: r.ids for r in error_summary(log).collect() if r.ids}
    assert got == {"not_found": 2, "timeout": 1, "validation_error": 3, "no_credits": 1,
                   "no_actors": 2}
    assert log.filter("category = 'processing_error'").count() == 2
    reasons = {r.id: r.detail for r in log.filter("category = 'validation_error'").collect()}
    assert reasons == {4: "bad_release_date", 5: "bad_budget", 6: "missing_title"}


def test_csv_load(spark, built, tmp_path, rows):
    write_catalog(built.replace, str(tmp_path))
    loaded = jobs.load_csv(spark, str(tmp_path)).replace
    assert rows(loaded["movies"], "id") == [(1,), (2,), (3,), (7,)]
    # 999 has no person row: the credit is dropped, unless foreign keys are off.
    assert (7, 999) not in rows(loaded["credits"], "movie_id", "person_id")
    free = jobs.load_csv(spark, str(tmp_path), enforce_foreign_keys=False).replace
    assert (7, 999) in rows(free["credits"], "movie_id", "person_id")

    target = jobs.empty_tables(spark)
    target["movies"] = loaded["movies"].filter("id = 1").withColumn("title", F.lit("mine"))
    again = jobs.load_csv(spark, str(tmp_path), target)
    assert not again.replace
    assert rows(again.append["movies"], "id") == [(2,), (3,), (7,)]
    assert rows(again.append["credits"]) == rows(loaded["credits"])


def test_load_into_an_empty_catalog_joins_nothing(spark, built, tmp_path):
    write_catalog(built.replace, str(tmp_path))
    movies = jobs.load_csv(spark, str(tmp_path)).replace["movies"]
    assert "Join" not in movies._jdf.queryExecution().executedPlan().toString()
    assert {c: t.upper() for c, t in movies.dtypes} == TABLES["movies"]


@pytest.fixture(scope="module")
def catalog(spark):
    """Movies 1, 2, 7 and 50 under old values; 50 is in no source."""
    tables = jobs.empty_tables(spark)
    movies = spark.createDataFrame(
        [(i, "before", dt.date(2024, 4, 20), OLD) for i in (1, 2, 7, 50)],
        "id bigint, title string, release_date date, updated_at timestamp")
    tables["movies"] = tables["movies"].unionByName(movies, allowMissingColumns=True)
    tables["credits"] = tables["credits"].unionByName(
        spark.createDataFrame([(i, 1, "cast") for i in (1, 2, 50)],
                              "movie_id bigint, person_id bigint, credit_type string"),
        allowMissingColumns=True)
    tables["genres"] = spark.createDataFrame(
        [(i, "Before") for i in (1, 2, 50)], "movie_id bigint, genre_name string")
    tables["people"] = tables["people"].unionByName(
        spark.createDataFrame([(101, "before"), (2, "kept")], "id bigint, name string"),
        allowMissingColumns=True)
    return tables


def test_refresh(landing, catalog, rows):
    t = jobs.refresh(catalog, landing, AS_OF).replace
    assert rows(t["movies"], "id", "title", "updated_at") == [
        (1, "plain", AS_OF), (2, "before", OLD), (50, "before", OLD), (7, "new", AS_OF)]
    # 2 has no credits document: not refreshed, children stay. 3 and 10 are not in the catalog.
    assert rows(t["genres"]) == [(1, "Action"), (1, "Drama"), (2, "Before"), (50, "Before"),
                                 (7, "New")]
    assert rows(t["credits"].filter("movie_id <> 1"), "movie_id", "person_id") == [
        (2, 1), (50, 1), (7, 101), (7, 999)]
    people = dict(rows(t["people"], "id", "name"))
    assert people[101] == "person 101" and people[2] == "kept" and 500 not in people


def test_refresh_errors(spark, landing, catalog, rows):
    log = jobs.refresh(catalog, landing, AS_OF).errors()
    assert rows(log, "category", "id") == [("no_credits", 2), ("removed_movies", 50)]
    ids = spark.createDataFrame([(50,), (3,), (7,)], "id bigint")
    log = jobs.refresh(catalog, landing, AS_OF, ids).errors()
    assert rows(log, "category", "id") == [("not_found", 3), ("removed_movies", 50)]


def test_refresh_is_idempotent(landing, catalog, rows):
    once = jobs.refresh(catalog, landing, AS_OF).replace
    twice = jobs.refresh(once, landing, AS_OF).replace
    for name in once:
        assert rows(once[name]) == rows(twice[name])


def test_refresh_selected(spark, landing, catalog, rows):
    ids = spark.createDataFrame([(7,), (3,)], "id bigint")
    t = jobs.refresh(catalog, landing, AS_OF, ids, with_people=False).replace
    assert "people" not in t
    assert rows(t["movies"].filter(F.col("updated_at") == F.lit(AS_OF)), "id") == [(7,)]


def test_refresh_touches_every_row_once(spark, rows):
    n = 250
    details = spark.range(1, n + 1).select(
        "id", F.lit("new").alias("title"), F.lit("").alias("release_date"), F.array().cast("array<struct<name:string>>").alias("genres"),
        *[F.lit(None).cast("string").alias(c) for c in (
            "original_title", "overview", "runtime", "status", "vote_average",
            "vote_count", "popularity", "poster_path", "backdrop_path", "budget", "revenue")])
    credits = spark.range(1, n + 1).select(
        F.col("id").alias("movie_id"),
        F.lit(None).cast("array<struct<id:bigint,name:string,character:string,order:bigint>>").alias("cast"),
        F.lit(None).cast("array<struct<id:bigint,name:string,job:string,department:string>>").alias("crew"))
    tables = jobs.empty_tables(spark)
    tables["movies"] = tables["movies"].unionByName(
        spark.range(1, n + 1).select("id"), allowMissingColumns=True)
    t = jobs.refresh(tables, Landing(details, credits), AS_OF).replace
    done = t["movies"].filter(F.col("updated_at") == F.lit(AS_OF))
    assert done.count() == n and done.distinct().count() == n


def test_add_new(spark, landing, catalog, rows):
    changes = jobs.add_new(catalog, landing)
    assert not changes.replace
    assert rows(changes.append["movies"], "id", "title") == [(10, "released")]
    assert rows(changes.append["genres"]) == [(10, "Drama")]
    assert rows(changes.append["credits"], "person_id", "credit_type") == [
        (130, "cast"), (130, "crew")]
    assert rows(changes.append["people"], "id") == [(130,)]
    # Looking back further: 3 has no date and 6 no title; a bad budget (5) is no obstacle here.
    back = jobs.add_new(catalog, landing, "2000").append["movies"]
    assert [r[0] for r in rows(back, "id")] == [10, 5]
    capped = jobs.add_new(catalog, landing, "2000", max_pages=1, page_size=1).append["movies"]
    assert rows(capped, "id") == [(10,)]
    assert jobs.add_new(jobs.empty_tables(spark), landing) == Changes()
    with pytest.raises(ValueError):
        jobs.add_new(catalog, landing, "decade")


def test_add_new_from_result_pages(spark, landing, landing_root, catalog, tmp_path, rows):
    pages = [
        {"page": 1, "total_pages": 3, "results": [
            {"id": 10, "release_date": "2024-05-01"}, {"id": 5, "release_date": "soon"},
            {"id": 9, "release_date": "2024-05-01", "adult": True}, {"id": 0}]},
        {"page": 2, "total_pages": 3, "results": [
            {"id": 10, "release_date": "2024-05-01"}, {"id": 1, "release_date": "2024-05-02"}]},
        {"page": 4, "total_pages": 3, "results": [{"id": 8, "release_date": "2024-05-01"}]},
    ]
    (tmp_path / "pages").mkdir()
    (tmp_path / "pages" / "p.json").write_text("\n".join(map(json.dumps, pages)))
    read = read_documents(spark, str(tmp_path), "pages")
    changes = jobs.add_new(catalog, landing, "week", releases=jobs.release_pages(read))
    assert rows(changes.append["movies"], "id") == [(10,)]


def test_search(landing, catalog, rows):
    found = rows(jobs.search(catalog, landing, "REL"), "ordinal", "id", "line", "genre_line")
    assert found == [(1, 10, "1. released (2024-05-01) - ID: 10", "   Genres: Drama")]
    assert rows(jobs.search(catalog, landing, "3"), "id") == [(3,)]
    assert rows(jobs.search(catalog, landing, "1"), "id") == []  # already there
    assert rows(jobs.search(catalog, landing, "old"), "id") == []  # only a superseded version
    added = jobs.search_and_add(catalog, landing, "released", select=1).append
    assert rows(added["movies"], "id") == [(10,)]
    assert jobs.search_and_add(catalog, landing, "released", select=0) == Changes()


def test_discover(landing, rows):
    assert rows(jobs.discover(landing, latest_year=2024)) == [(1,), (10,), (2,), (5,), (6,), (7,)]


def test_refresh_of_a_bucketed_store_does_not_shuffle_movies(
    spark, landing, catalog, tmp_path, rows
):
    store = SnapshotStore(spark, str(tmp_path / "store"), buckets=4)
    jobs.publish(store, Changes(replace=catalog))
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        changes = jobs.refresh(store.tables(), landing, AS_OF)
        movies = changes.replace["movies"].repartition(4, "id")
        plan = movies._jdf.queryExecution().executedPlan().toString()
        assert "Bucketed: true" in plan and plan.count("Exchange") == 1
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    want = rows(changes.replace["movies"])
    jobs.publish(store, changes)
    assert rows(store.table("movies")) == want


@pytest.mark.parametrize("buckets", [0, 4])
def test_sync(spark, landing, catalog, tmp_path, rows, buckets):
    store = SnapshotStore(spark, str(tmp_path / "store"), buckets=buckets)
    jobs.publish(store, Changes(replace=catalog))
    refreshed, added = jobs.sync(store, landing, "week", AS_OF)
    assert added.rows == {"movies": 1, "credits": 2, "genres": 1, "people": 1}
    assert rows(store.table("movies"), "id") == [(1,), (10,), (2,), (50,), (7,)]
    assert refreshed.version == 2 and store.version() == 3


def test_stream_equals_batch(spark, landing_root, catalog, tmp_path, rows):
    drops = tmp_path / "landing"
    for kind in ("credits", "persons"):
        (drops / kind).mkdir(parents=True)
        lines = open(f"{landing_root}/{kind}/part.json").read()
        (drops / kind / "part.json").write_text(lines)
    (drops / "details").mkdir()
    lines = open(f"{landing_root}/details/part.json").read().splitlines()
    store = SnapshotStore(spark, str(tmp_path / "store"))
    jobs.publish(store, Changes(replace=catalog))
    for n, part in enumerate((lines[:7], lines[7:])):
        (drops / "details" / f"{n}.json").write_text("\n".join(part) + "\n")
        run = stream_catalog(spark, str(drops), store, str(tmp_path / "cp"), now=lambda: AS_OF)
        run.awaitTermination()
    version = store.version()
    run = stream_catalog(spark, str(drops), store, str(tmp_path / "cp"), now=lambda: AS_OF)
    run.awaitTermination()
    assert store.version() == version  # nothing new, nothing published

    batch = SnapshotStore(spark, str(tmp_path / "batch"))
    jobs.publish(batch, Changes(replace=catalog))
    jobs.publish(batch, jobs.sync_documents(batch.tables(), Landing.read(spark, str(drops)), AS_OF))
    for name in ("movies", "credits", "genres", "people"):
        assert rows(store.table(name)) == rows(batch.table(name)), name


def test_late_credits_and_persons(spark, tmp_path, rows):
    drops, store = tmp_path / "drops", SnapshotStore(spark, str(tmp_path / "store"))
    for kind in ("details", "credits", "persons"):
        (drops / kind).mkdir(parents=True)
    jobs.publish(store, Changes(replace=jobs.empty_tables(spark)))

    def drop(kind, name, line):
        (drops / kind / f"{name}.json").write_text(json.dumps(line) + "\n")
        stream_catalog(spark, str(drops), store, str(tmp_path / "cp"), now=lambda: AS_OF).awaitTermination()

    person = {"id": 101, "name": "OLD", "fetched_at": "2024-01-01T00:00:00Z"}
    drop("details", "a", doc(1, "plain"))
    assert rows(store.table("movies"), "id") == [(1,)] and store.table("credits").count() == 0
    drop("credits", "a", {"movie_id": 1, "cast": cast(101), "crew": [], "fetched_at": "2024-01-01T00:00:00Z"})
    assert rows(store.table("credits"), "movie_id", "person_id") == [(1, 101)]
    assert store.table("people").count() == 0
    drop("persons", "a", person)
    assert rows(store.table("people"), "id", "name") == [(101, "OLD")]
    drop("persons", "b", person | {"name": "NEW", "fetched_at": "2024-02-01T00:00:00Z"})
    assert rows(store.table("people"), "id", "name") == [(101, "NEW")]


def test_a_new_checkpoint_loses_nothing(spark, tmp_path, rows):
    schema = "k bigint, at timestamp, v string"
    (tmp_path / "in").mkdir()
    (tmp_path / "in" / "a.json").write_text('{"k": 1, "at": "2024-01-01T00:00:00Z", "v": "x"}\n')
    store = SnapshotStore(spark, str(tmp_path / "store"))
    run = lambda cp: stream_upsert(
        spark.readStream.schema(schema).json(str(tmp_path / "in")), store, "t", ["k"], "at",
        str(tmp_path / cp)).awaitTermination()
    run("cp1")
    run("cp1")  # nothing new
    assert store.version() == 1 and rows(store.table("t"), "k", "v") == [(1, "x")]
    (tmp_path / "in" / "b.json").write_text('{"k": 2, "at": "2024-01-02T00:00:00Z", "v": "y"}\n')
    run("cp2")  # a lost checkpoint counts its batches from 0 again
    assert rows(store.table("t"), "k", "v") == [(1, "x"), (2, "y")]


def test_late_and_repeated_fetches_are_dropped_with_a_delay(spark, tmp_path, rows):
    (tmp_path / "in").mkdir()
    store = SnapshotStore(spark, str(tmp_path / "store"))
    for name, lines in (
        ("a", '{"k": 1, "at": "2024-01-05T00:00:00Z", "v": "x"}\n{"v": "none", "k": 4}'),
        ("b", '{"k": 1, "at": "2024-01-05T00:00:00Z", "v": "again"}\n{"k": 2, "at": "2024-01-01T00:00:00Z", "v": "late"}'),
        ("c", '{"k": 3, "at": "2024-01-04T23:30:00Z", "v": "in time"}'),
    ):
        (tmp_path / "in" / f"{name}.json").write_text(lines + "\n")
        source = spark.readStream.schema("k bigint, at timestamp, v string").json(str(tmp_path / "in"))
        stream_upsert(source, store, "t", ["k"], "at", str(tmp_path / "cp"), delay="1 hour").awaitTermination()
    assert rows(store.table("t"), "k", "v") == [(1, "x"), (3, "in time"), (4, "none")]


def test_a_replayed_batch_is_skipped(spark, tmp_path):
    store = SnapshotStore(spark, str(tmp_path / "store"))
    store.publish(append={"t": spark.range(1)}, stream="t@one", batch=3)
    assert store.last_batch("t@one") == 3 and store.last_batch("t@two") == -1


def test_unwanted_documents_are_not_taken_apart(spark):
    """The wanted ids filter the documents below a union and the columns derived there."""
    schema = "id bigint, title string, release_date string, fetched_at timestamp"
    raw = spark.createDataFrame([(1, "a", "2020-01-01", None), (2, "b", "2020-01-01", None)], schema)
    rest = {c: F.lit(None).cast("string") for c in ("original_title", "overview", "runtime", "status", "vote_average",
            "vote_count", "popularity", "poster_path", "backdrop_path", "budget", "revenue")}
    genres = F.transform(F.split("title", " "), lambda w: F.struct(w.alias("name")))
    details = raw.withColumns({**rest, "genres": genres}).union(raw.withColumns({**rest, "genres": genres}))
    credits = spark.createDataFrame([], f"movie_id bigint, {jobs.CREDIT_LIST} array<string>, fetched_at timestamp")
    docs = jobs._documents(Landing(details, credits), "left", spark.createDataFrame([(2,)], "id bigint"))
    assert [r.id for r in docs.collect()] == [2]
    plan = docs._jdf.queryExecution().optimizedPlan().toString()
    lines = plan.split("\n")
    derived = [i for i, line in enumerate(lines) if "transform(split(" in line]
    assert len(derived) == 2 and all("LeftSemi" in lines[i + 1] for i in derived), plan


def test_a_build_takes_requested_documents_apart_only(spark, monkeypatch):
    plans, real = {}, jobs.stage

    def stage(df, label):
        plans[label] = df._jdf.queryExecution().optimizedPlan().toString().split("\n")
        return real(df, label)

    monkeypatch.setattr(jobs, "stage", stage)
    schema = "id bigint, title string, release_date string"
    raw = spark.createDataFrame([(1, "a", "2020-01-01"), (2, "b", "2020-01-01")], schema)
    rest = {c: F.lit(None).cast("string") for c in ("original_title", "overview", "runtime", "status", "vote_average",
            "vote_count", "popularity", "poster_path", "backdrop_path", "budget", "revenue")}
    genres = F.transform(F.split("title", " "), lambda w: F.struct(w.alias("name")))
    details = raw.withColumns({**rest, "genres": genres})
    credits = spark.createDataFrame([], f"movie_id bigint, {jobs.CREDIT_LIST} {_CREDITS}, fetched_at timestamp")
    wanted = spark.createDataFrame([(2,), (2,), (None,)], "id bigint")
    built = jobs.initial_build(Landing(details.union(details).withColumn("fetched_at", F.lit(None).cast("timestamp")), credits), wanted)
    assert [r.id for r in built.replace["movies"].collect()] == [2]
    plan = plans["checked-details"]
    derived = [i for i, line in enumerate(plan) if "transform(split(" in line]
    assert derived and all("LeftSemi" in plan[i + 1] for i in derived), plan


_CREDITS = """array<struct<person_id: bigint, credit_type: string, character_name: string, credit_order: bigint,
    department: string, job: string>>"""


def test_add_new_goes_by_the_newest_fetch(spark, tmp_path, rows):
    """A film listed as released by an old fetch only is not added, one by its newest fetch is."""
    old, new = "2024-01-01T00:00:00Z", "2024-01-02T00:00:00Z"
    lines = [doc(1, date="2020-01-01"), doc(2, date="2020-02-01", fetched=old), doc(2, date="2010-01-01", fetched=new),
             doc(3, date="2010-01-01", fetched=old), doc(3, date="2020-02-01", fetched=new), doc(4, date="2010-01-01")]
    (tmp_path / "details").mkdir()
    (tmp_path / "details/a.json").write_text("\n".join(map(json.dumps, lines)))
    (tmp_path / "credits").mkdir()
    (tmp_path / "credits/a.json").write_text(json.dumps({"movie_id": 1, "cast": [], "crew": []}))
    landing = Landing(read_documents(spark, str(tmp_path), "details"), read_documents(spark, str(tmp_path), "credits"))
    tables = jobs.initial_build(landing, spark.createDataFrame([(1,)], "id bigint")).replace
    added = jobs.add_new({**jobs.empty_tables(spark), **tables}, landing, "week")
    assert rows(added.append["movies"], "id") == [(3,)]
