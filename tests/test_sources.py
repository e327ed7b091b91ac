import datetime as dt

import pytest
from pyspark.sql import functions as F

from catalog_sync.operators.dedup import ORDINAL, first_wins
from catalog_sync.schemas import CSV_COLUMNS, TABLES, table_ddl
from catalog_sync.scratch import scratch_dir, stage
from catalog_sync.sources import csv_files, definitions, jdbc, landing
from catalog_sync.sources.snapshots import SnapshotStore


def write(path, text, mode="w"):
    path.parent.mkdir(parents=True, exist_ok=True)
    with open(path, mode, encoding="utf-8", newline="") as f:
        f.write(text)
    return str(path)


def test_csv_dialect(spark, tmp_path):
    path = write(tmp_path / "genres.csv", '"movie_id","genre_name"\n'
                 '"1","say ""hi"""\n"2","back\\\\slash"\n\n"3","a,b"\n"4","two\nlines"\n'
                 '"5","tail\\\\"\n"6", "led"\n"7","x","extra"\n"8"\n"9","  pad "\n')
    cells = csv_files.read_text_cells(spark, path)
    got = {r.movie_id: r.genre_name for r in cells.collect()}
    assert got == {"1": 'say "hi"', "2": "back\\slash", "3": "a,b", "4": "two\nlines",
                   "5": "tail\\", "6": "led", "8": None, "9": "  pad "}


def test_csv_round_trip_with_pandas_reading_it_too(spark, tmp_path):
    pandas = pytest.importorskip("pandas")
    values = ['q"q', '"wrapped"', "back\\slash", "tail\\", "a,b", "two\nlines", "  pad\t", "", "é漢"]
    df = spark.createDataFrame([(str(i), v) for i, v in enumerate(values)], "movie_id string, v string")
    out = str(tmp_path / "cells")
    csv_files.write_text_cells(df.coalesce(1), out)
    back = csv_files.read_text_cells(spark, out).drop(ORDINAL)
    assert {r.movie_id: r.v for r in back.collect()} == {str(i): v for i, v in enumerate(values)}
    part = next((tmp_path / "cells").glob("part-*.csv"))
    other = pandas.read_csv(part, escapechar="\\", quoting=1, dtype=str, keep_default_na=False)
    assert list(other.v) == values
    assert part.read_text(encoding="utf-8").splitlines()[0] == '"movie_id","v"'
    assert '"7",""' in part.read_text(encoding="utf-8")


def test_csv_files_in_order_first_wins(spark, tmp_path, rows):
    header = '"id","name","profile_path","gender","known_for_department"\n'
    write(tmp_path / "people.csv" / "a.csv", header + '"1","first","","2",""\n"1.9","one","","",""\n')
    write(tmp_path / "people.csv" / "b.csv", header + '"1","later","","1",""\n"abc","x","","",""\n'
          '"","y","","",""\n"3"," None ","NA","1.0","d"\n')
    people = csv_files.read_table(spark, str(tmp_path / "people.csv"))
    unique = first_wins(people, ["id"], [F.col(ORDINAL)])
    assert rows(unique, "id", "name", "profile_path", "gender") == [
        (1, "first", "", 2), (3, "None", "", 1)]


def test_csv_missing_columns(spark, tmp_path):
    short = write(tmp_path / "credits.csv", '"person_id","movie_id","credit_type"\n"5","4","cast"\n')
    row = csv_files.read_table(spark, short).first()
    assert (row.movie_id, row.person_id, row.job, row.credit_order) == (4, 5, None, None)
    keyless = write(tmp_path / "movies.csv", '"title"\n"x"\n')
    with pytest.raises(ValueError, match="id"):
        csv_files.read_table(spark, keyless)
    with pytest.raises(ValueError, match="unknown CSV table"):
        csv_files.read_table(spark, str(tmp_path / "other.csv"))


def test_each_file_has_its_own_header(spark, tmp_path, rows):
    folder = tmp_path / "genres.csv"
    write(folder / "a.csv", '"movie_id","genre_name"\n"1","Drama"\n')
    write(folder / "b c.csv", '"genre_name","movie_id"\n"War","2"\n"x","3","over"\n')
    write(folder / "empty.csv", "")
    read = csv_files.read_table(spark, str(folder))
    assert rows(read, "movie_id", "genre_name") == [(1, "Drama"), (2, "War")]
    lost = csv_files.overlong_lines(spark, str(folder)).collect()
    assert len(lost) == 1 and "over" in lost[0].cells and lost[0].file.endswith("c.csv")
    write(folder / "d.csv", '"genre_name"\n"War"\n')
    with pytest.raises(ValueError, match="d.csv"):
        csv_files.read_table(spark, str(folder))


def movie_row(**values):
    return tuple(values.get(c) for c in TABLES["movies"])


def test_movies_csv_typing(spark, tmp_path):
    movies = spark.createDataFrame([
        movie_row(id=1, title=" a,\nb ", overview="x, y", release_date=dt.date(2020, 1, 5),
                  vote_average=7.12344, budget=10, title2=None),
        movie_row(id=2, title="None"),
    ], table_ddl("movies"))
    out = str(tmp_path / "movies.csv")
    csv_files.write_table(movies.coalesce(1), out)
    text = next((tmp_path / "movies.csv").glob("part-*.csv")).read_text()
    assert '"1","a  b","","x  y","2020-01-05","","","7.1234","","","","","10",""' in text
    back = {r.id: r for r in csv_files.read_table(spark, out).collect()}
    assert back[1].title == "a  b" and back[1].vote_average == 7.1234 and back[1].runtime is None
    assert back[2].title == "" and back[2].release_date == dt.date(1970, 1, 1)
    raw = write(tmp_path / "raw" / "movies.csv", '"id","runtime","release_date"\n'
                '"1.7","2.5","2020-1-5"\n"""3""","x","2020-02-30"\n')
    typed = {r.id: (r.runtime, r.release_date) for r in csv_files.read_table(spark, raw).collect()}
    assert typed == {2: (2, dt.date(2020, 1, 5)), 3: (None, None)}


def test_json_landing_keeps_bad_lines(spark, tmp_path):
    write(tmp_path / "persons" / "p.json",
          '{"id": 1, "name": "a", "gender": 2}\n{"id": "x", "name": "b"}\n{broken\n{"id": 3}\n')
    docs = landing.read_documents(spark, str(tmp_path), "persons").collect()
    assert [(d.id, d.name, d._corrupt_record is not None) for d in docs] == [
        (1, "a", False), (None, "b", True), (None, None, True), (3, None, False)]


def test_parse_documents(spark):
    lines = spark.createDataFrame([('{"page": 1, "total_pages": 2, "results": [{"id": 5}]}',)], "t string")
    doc = landing.parse_documents(lines, "t", "pages").first()
    assert doc.page == 1 and doc.results[0].id == 5


def test_snapshots(spark, tmp_path, rows):
    store = SnapshotStore(spark, str(tmp_path / "store"))
    frame = lambda *ids: spark.createDataFrame([(i,) for i in ids], "id int")
    assert store.version() == 0 and store.tables() == {} and store.last_batch("s") == -1
    first = store.publish(replace={"a": frame(1, 2), "b": frame(9)})
    assert (first.version, first.rows) == (1, {"a": 2, "b": 1})
    store.publish(append={"a": frame(3)}, stream="s", batch=4)
    assert rows(store.table("a")) == [(1,), (2,), (3,)] and rows(store.table("b")) == [(9,)]
    assert store.last_batch("s") == 4 and store.last_batch("other") == -1
    # A table may be rewritten from itself: the files being read stay where they are.
    store.publish(replace={"a": store.table("a").filter("id > 1")}, append={"b": frame()})
    assert rows(store.table("a")) == [(2,), (3,)] and rows(store.table("b")) == [(9,)]
    assert rows(store.table("a", version=1)) == [(1,), (2,)]
    assert store.publish(replace={"a": frame(5)}, append={"a": frame(6)}).rows == {"a": 2}
    assert rows(store.table("a")) == [(5,), (6,)]
    with pytest.raises(ValueError):
        store.tables(version=99)


def test_bucketed_snapshots(spark, tmp_path, rows):
    store = SnapshotStore(spark, str(tmp_path / "store"), buckets=4)
    people = lambda lo, hi: spark.range(lo, hi).withColumn("name", F.lit("x"))
    genres = spark.createDataFrame([(1, "g")], "movie_id bigint, genre_name string")
    assert store.publish(replace={"people": people(0, 50), "genres": genres}).rows == {
        "people": 50, "genres": 1}
    store.publish(append={"people": people(50, 60)})
    other = SnapshotStore(spark, str(tmp_path / "store"))  # knows from the manifest
    assert rows(other.table("people"), "id") == sorted([(i,) for i in range(60)], key=repr)
    for t in spark.catalog.listTables():
        if t.name.startswith("snapshot_people"):
            spark.sql(f"DROP TABLE {t.name}")  # as in a new session: the files stay
    assert other.table("people").count() == 60
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        hits = people(0, 9).select("id", F.lit(True).alias("hit"))
        joined = other.table("people").join(hits, "id", "left")
        plan = joined._jdf.queryExecution().executedPlan().toString()
        # Both appends stand behind one declaration: the table side is not shuffled.
        assert plan.count("Bucketed: true") == 1 and plan.count("Exchange") == 1
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert joined.filter("hit").count() == 9 and joined.count() == 60
    other.publish(append={"people": people(60, 61)})  # dealt out as the table is
    assert other.table("people").count() == 61
    with pytest.raises(ValueError, match="absolute"):
        SnapshotStore(spark, "relative/path", buckets=4)


def test_unpublished_write_is_invisible(spark, tmp_path, rows):
    store = SnapshotStore(spark, str(tmp_path / "store"))
    good = spark.createDataFrame([(1,)], "id int")
    store.publish(replace={"a": good})
    bad = good.select(F.raise_error(F.lit("boom")).cast("int").alias("id"))
    with pytest.raises(Exception, match="boom"):
        store.publish(replace={"a": spark.createDataFrame([(2,)], "id int"), "b": bad})
    assert store.version() == 1 and rows(store.table("a")) == [(1,)]
    assert store.publish(replace={"a": good}).version == 2


def test_table_definitions(spark, tmp_path):
    script = definitions.catalog_script(str(tmp_path / "tables"), prefix="def_")
    assert definitions.run_script(spark, script + ";\n;") == 4
    definitions.run_script(spark, script)  # a second run changes nothing
    for name, columns in TABLES.items():
        got = {c: t.upper() for c, t in spark.read.table(f"def_{name}").dtypes}
        assert got == columns
    assert "updated_at" not in CSV_COLUMNS["movies"]


def test_jdbc_options():
    split = jdbc.KeyRange("id", 0, 1000, 8)
    options = jdbc.read_options("jdbc:x", "movies", split)
    assert options["numPartitions"] == "8" and options["partitionColumn"] == "id"
    assert "partitionColumn" not in jdbc.read_options("jdbc:x", "movies")
    assert jdbc.write_options("jdbc:x", "movies", 500)["batchsize"] == "500"


def test_stage_uses_the_shared_folder(spark):
    root = spark.conf.get("spark.checkpoint.dir")
    assert scratch_dir(spark, "x").startswith(root)
    staged = stage(spark.range(5), "ids")
    assert staged.count() == 5 and all(root in f for f in staged.inputFiles())


def test_two_publishers_from_one_version(spark, tmp_path):
    root = str(tmp_path / "store")
    SnapshotStore(spark, root).publish(replace={"a": spark.range(2), "b": spark.range(1)})
    one, two = SnapshotStore(spark, root), SnapshotStore(spark, root)
    base = one._layout()
    two._layout = lambda real=two._layout, first=[base]: first.pop() if first else real()
    one.publish(append={"a": spark.range(10, 12)})
    assert two.publish(append={"a": spark.range(20, 21)}).version == 3
    ids = lambda version=None: sorted(r.id for r in one.table("a", version).collect())
    assert ids() == [0, 1, 10, 11, 20] and ids(2) == [0, 1, 10, 11]
    late = SnapshotStore(spark, root)
    late._layout = lambda real=late._layout, first=[base]: first.pop() if first else real()
    with pytest.raises(RuntimeError, match="changed a"):
        late.publish(replace={"a": spark.range(5)})
    assert ids() == [0, 1, 10, 11, 20] and one.version() == 3


def test_staged_rows_parts_and_packed_lines(spark, tmp_path):
    """What is written on the way is packed densely, and reads back the same."""
    frame = spark.range(500).selectExpr("id", "repeat(cast(id as string), 20) AS name")
    want = sorted(map(tuple, frame.collect()))
    staged = stage(frame, "packed")
    assert all(".zstd." in f for f in staged.inputFiles()) and sorted(map(tuple, staged.collect())) == want
    for buckets in (0, 4):
        store = SnapshotStore(spark, str(tmp_path / f"store-{buckets}"), buckets)
        store.publish(replace={"people": frame})
        held = store.table("people").select("id", "name")
        assert all(".zstd." in f for f in held.inputFiles()) and sorted(map(tuple, held.collect())) == want
    landing.write_json(frame, str(tmp_path / "lines"), compression="gzip")
    assert list((tmp_path / "lines").glob("*.json.gz"))
    assert sorted(map(tuple, landing.read_json(spark, str(tmp_path / "lines"), "id bigint, name string").collect())) == want
