import datetime as dt

import pytest
from pyspark.sql import functions as F

from catalog_sync.operators.shape import (
    credit_rows,
    distinct_by,
    first_match,
    genre_rows,
    genre_string,
    latest_documents,
    needed_people,
)
from catalog_sync.schemas import CREDITS_DOC, MOVIE_DOC, PERSON_DOC


def cast(*ids):
    return [(i, f"p{i}", f"c{n}", n) for n, i in enumerate(ids)]


def crew(*members):
    return [(i, "x", job, department) for i, job, department in members]


@pytest.fixture(scope="module")
def credits(spark):
    director = ("Director", "Directing2")
    docs = [
        (1, cast(*range(1, 11)), crew((50, *director), (51, *director))),
        (2, cast(1, 2, None, 4, 5, 6, 7, 8, 9), []),
        (3, cast(0, 2), None),
        (4, None, crew((None, *director), (51, *director))),
        (5, cast(7, 7, 8), crew((60, "Writer", None), (7, "Director", None))),
        (6, [], []),
    ]
    return spark.createDataFrame([(*d, None, None, None) for d in docs], CREDITS_DOC)


def test_credit_rows(credits, rows):
    got = rows(credit_rows(credits), "movie_id", "person_id", "credit_type", "credit_order")
    by_movie = {m: [r[1:] for r in got if r[0] == m] for m in range(1, 7)}
    assert [r[0] for r in by_movie[1] if r[1] == "cast"] == list(range(1, 9))
    assert (50, "crew", None) in by_movie[1] and len(by_movie[1]) == 9
    assert [r[0] for r in by_movie[2]] == [1, 2, 4, 5, 6, 7, 8]  # the cut precedes the id check
    assert by_movie[3] == [(2, "cast", 1)]
    assert by_movie[4] == []  # a first director without id has no stand-in
    assert sorted(by_movie[5], key=repr) == [(7, "cast", 0), (7, "crew", None), (8, "cast", 2)]
    assert by_movie[6] == []


def test_credit_labels(credits, rows):
    row = credit_rows(credits).filter("movie_id = 5 AND credit_type = 'crew'").first()
    assert (row.department, row.job) == ("Directing", "Director")
    labels = lambda legacy: rows(
        credit_rows(credits, legacy).filter("movie_id = 3"), "department", "job")
    assert labels(False) == [("Acting", "Actor")]
    assert labels(True) == [(None, None)]


def movie(spark, *docs):
    columns = [c.split()[0] for c in MOVIE_DOC.replace("<name: STRING>", "").split(", ")]
    return spark.createDataFrame([tuple(d.get(c) for c in columns) for d in docs], MOVIE_DOC)


def test_genres(spark, rows):
    docs = movie(
        spark,
        {"id": 1, "genres": [("Drama",), ("Action",), ("Drama",)]},
        {"id": 2, "genres": []}, {"id": 3}, {"id": 4, "genres": [(None,)]},
    )
    assert rows(genre_rows(docs)) == [(1, "Action"), (1, "Drama")]
    shown = rows(docs.select("id", genre_string(F.col("genres"))))
    assert shown[:3] == [(1, "Drama, Action, Drama"), (2, "No genres"), (3, "No genres")]


def test_latest_documents(spark, rows):
    t = lambda day: dt.datetime(2024, 1, day)
    docs = movie(
        spark,
        {"id": 1, "title": "old", "fetched_at": t(1), "fetch_status": "ok"},
        {"id": 1, "title": "new", "fetched_at": t(2)},
        {"id": 1, "title": "failed", "fetched_at": t(3), "fetch_status": "timeout"},
        {"id": 2, "title": "broken", "_corrupt_record": "{"},
        {"id": 0, "title": "zero"}, {"title": "no id"},
    )
    assert rows(latest_documents(docs, "id"), "id", "title") == [(1, "new")]


def test_needed_people(spark, rows, credits):
    persons = spark.createDataFrame(
        [(i, f"n{i}", None, 1, None, None, None, None) for i in (1, 2, 7, 99)], PERSON_DOC)
    wanted = credit_rows(credits)
    assert rows(needed_people(wanted, persons), "id") == [(1,), (2,), (7,)]
    known = spark.createDataFrame([(2,)], "id bigint")
    assert rows(needed_people(wanted, persons, known), "id") == [(1,), (7,)]


def test_array_helpers(spark):
    df = spark.sql("SELECT array(named_struct('k', 1, 'v', 'a'), named_struct('k', 1, 'v', 'b'), "
                   "named_struct('k', 2, 'v', 'c')) AS a, cast(null AS array<int>) AS n")
    kept = distinct_by(F.col("a"), "k", "array<struct<k:int,v:string>>")
    row = df.select(kept.alias("kept"), first_match(F.col("a"), lambda x: x["k"] > 5).alias("none"),
                    first_match(F.col("n"), lambda x: x > 0).alias("null")).first()
    assert [r.v for r in row.kept] == ["a", "c"]
    assert row.none is None and row.null is None
