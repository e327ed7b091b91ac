import pytest
from pyspark.sql import functions as F

from catalog_sync.operators.quality import (
    FAILED_RULE,
    check,
    childless,
    children_counts,
    duplicate_keys,
    error_rows,
    error_samples,
    error_summary,
    fetch_errors,
    key_audit,
    movie_rules,
    not_found,
    orphans,
    route,
    row_counts,
    table_profile,
)
from catalog_sync.schemas import ERROR_CATEGORIES, NUMERIC_FIELDS, PERSON_DOC

GOOD = {"id": 1, "title": "t", "release_date": "2020-01-05", **{c: "1" for c in NUMERIC_FIELDS}}


@pytest.mark.parametrize("change, failed", [
    ({}, None),
    ({"title": None}, "missing_title"),
    ({"title": ""}, None),
    ({"release_date": None}, "missing_release_date"),
    ({"release_date": ""}, None),
    ({"release_date": "2020-02-30"}, "bad_release_date"),
    ({"release_date": "soon"}, "bad_release_date"),
    ({"release_date": "2020-1-5"}, None),
    ({"budget": ""}, "bad_budget"),
    ({"budget": "abc"}, "bad_budget"),
    ({"budget": "1e3"}, None),
    ({"budget": "2.5"}, None),
    ({"budget": "1d"}, "bad_budget"),
    ({"budget": None}, None),
    ({"runtime": "x", "revenue": "x"}, "bad_runtime"),
])
def test_movie_rules(spark, change, failed):
    doc = {**GOOD, **change}
    schema = ", ".join(f"{c} {'bigint' if c == 'id' else 'string'}" for c in doc)
    df = spark.createDataFrame([tuple(doc.values())], schema)
    assert check(df, movie_rules()).first()[FAILED_RULE] == failed
    valid, invalid = route(df, movie_rules())
    assert (valid.count(), invalid.count()) == ((1, 0) if failed is None else (0, 1))
    assert FAILED_RULE not in valid.columns


@pytest.fixture(scope="module")
def errors(spark):
    many = spark.range(1, 5001).select(F.lit("timeout").alias("category"), "id")
    few = spark.createDataFrame([("not_found", 7), ("not_found", 7), ("not_found", 3)],
                                "category string, id bigint")
    return error_rows(many.union(few), F.col("category"), "test", "id")


def test_error_summary_lists_every_category(errors):
    got = {r.category: r.ids for r in error_summary(errors).collect()}
    assert got == {**{c: 0 for c in ERROR_CATEGORIES}, "timeout": 5000, "not_found": 2}


def test_error_samples(errors):
    got = {r.category: r.sample_ids for r in error_samples(errors).collect()}
    assert got == {"timeout": list(range(1, 11)), "not_found": [3, 7]}


def test_not_found_is_whole(errors, rows):
    assert rows(not_found(errors)) == [(3,), (7,)]


def test_fetch_errors(spark, rows):
    docs = spark.createDataFrame(
        [(1, "timeout", None), (2, "ok", None), (3, None, None), (4, "teapot", None),
         (None, None, "{bad")],
        "id bigint, fetch_status string, _corrupt_record string")
    assert rows(fetch_errors(docs, "id", "details"), "category", "id", "detail") == [
        ("api_error", 4, "teapot"), ("processing_error", None, "{bad"), ("timeout", 1, "timeout")]
    assert "fetch_status" in PERSON_DOC


@pytest.fixture(scope="module")
def family(spark):
    parents = spark.createDataFrame([(1,), (2,), (2,), (3,)], "id int")
    children = spark.createDataFrame(
        [(1, "cast"), (1, "crew"), (2, "crew"), (9, "cast"), (None, "cast")], "pid int, kind string")
    return parents, children


def test_relations(family, rows):
    parents, children = family
    assert rows(childless(parents, children, {"id": "pid"})) == [(3,)]
    actors = children.filter("kind = 'cast'")
    assert rows(childless(parents, actors, {"id": "pid"})) == [(2,), (2,), (3,)]
    assert rows(orphans(children, parents, {"pid": "id"})) == [(9, "cast")]
    assert rows(duplicate_keys(parents, ["id"])) == [(2, 2)]
    counts = children_counts(children, "pid", "kind", {"actors": "cast", "directors": "crew"})
    assert (1, 1, 1) in rows(counts) and (2, 0, 1) in rows(counts)


def test_audits(family, rows):
    parents, children = family
    tables = {"parents": parents, "children": children}
    assert rows(row_counts(tables)) == [("children", 5), ("parents", 4)]
    assert rows(table_profile(tables)) == [
        ("children", 1, "pid", "int", 5), ("children", 2, "kind", "string", 5),
        ("parents", 1, "id", "int", 4)]
    got = key_audit(tables, {"parents": ["id"]}, {"children": [("pid", "parents", "id")]})
    assert rows(got) == [("children", "pid->parents.id", 1), ("parents", "unique(id)", 1)]
