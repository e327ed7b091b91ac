import datetime as dt

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from catalog_sync.operators.upsert import (
    ACTION,
    action_counts,
    insert_absent,
    insert_ignore,
    replace_children,
    update_by_key,
    upsert,
    upsert_tagged,
)

AS_OF = dt.datetime(2024, 6, 1)
OLD = dt.datetime(2020, 1, 1)
SCHEMA = "id int, v string, w int, updated_at timestamp"


@pytest.fixture(scope="module")
def target(spark):
    return spark.createDataFrame(
        [(1, "a", 10, OLD), (2, "b", 20, None), (3, None, 30, OLD)], SCHEMA
    )


def test_update_overwrites_with_nulls_and_stamps_hits(spark, rows, target):
    source = spark.createDataFrame([(1, None), (3, "c"), (9, "z")], "id int, v string")
    got = update_by_key(target, source, ["id"], ["v"], ("updated_at", AS_OF))
    assert rows(got) == [(1, None, 10, AS_OF), (2, "b", 20, None), (3, "c", 30, AS_OF)]


def test_update_with_all_null_source_row_is_a_hit(spark, rows, target):
    source = spark.createDataFrame([(2, None, None)], "id int, v string, w int")
    got = update_by_key(target, source, ["id"], ["v", "w"], ("updated_at", AS_OF))
    assert (2, None, None, AS_OF) in rows(got)


def test_replace_children_with_empty_set(spark, rows):
    children = spark.createDataFrame([(1, "x"), (1, "y"), (2, "z"), (None, "n")], "pid int, c string")
    updated = spark.createDataFrame([(1,), (2,), (5,)], "id int")
    fresh = spark.createDataFrame([(1, "new")], "pid int, c string")
    got = replace_children(children, updated, fresh, "pid", "id")
    assert rows(got) == [(1, "new"), (None, "n")]


def test_insert_absent(spark, rows, target):
    source = spark.createDataFrame([(3, "no", 0, None), (4, "yes", 1, None)], SCHEMA)
    got = insert_absent(target, source, ["id"])
    assert rows(got, "id", "v") == [(1, "a"), (2, "b"), (3, None), (4, "yes")]


def test_insert_ignore_existing_then_first(spark, rows):
    target = spark.createDataFrame([(1, "kept")], "id int, v string")
    incoming = spark.createDataFrame(
        [(1, "late", 0), (2, "second", 2), (2, "first", 1), (3, "only", 3)],
        "id int, v string, o int",
    )
    got = insert_ignore(target, incoming, ["id"], [F.col("o")])
    assert got.columns == ["id", "v"]
    assert rows(got) == [(1, "kept"), (2, "first"), (3, "only")]


def test_upsert_actions(spark, rows, target):
    source = spark.createDataFrame(
        [(1, "a", 10), (2, "new", 20), (4, "d", 40)], "id int, v string, w int"
    )
    tagged = upsert_tagged(target, source, ["id"], ["v", "w"], ("updated_at", AS_OF))
    assert rows(tagged, "id", "v", ACTION, "updated_at") == [
        (1, "a", "unchanged", AS_OF), (2, "new", "update", AS_OF),
        (3, None, "skipped", OLD), (4, "d", "insert", AS_OF)]
    assert action_counts(tagged).first().asDict() == {
        "insert": 1, "update": 1, "unchanged": 1, "skipped": 1, "processed": 3}


def test_upsert_ignores_older_rows(spark, rows):
    target = spark.createDataFrame([(1, 5, "new"), (2, 5, "old")], "id int, at int, v string")
    source = spark.createDataFrame([(1, 4, "late"), (2, 6, "newer")], "id int, at int, v string")
    got = upsert(target, source, ["id"], ["at", "v"], newest_by="at")
    assert rows(got) == [(1, 5, "new"), (2, 6, "newer")]


keyed = st.dictionaries(st.integers(0, 8), st.one_of(st.none(), st.sampled_from("abc")), max_size=8)


@settings(max_examples=10, deadline=None, suppress_health_check=list(HealthCheck))
@given(before=keyed, change=keyed)
def test_upsert_equals_dict_update_and_is_idempotent(spark, rows, before, change):
    frame = lambda m: spark.createDataFrame(list(m.items()), "id int, v string")
    once = upsert(frame(before), frame(change), ["id"], ["v"])
    assert rows(once) == sorted({**before, **change}.items(), key=repr)
    assert rows(upsert(once, frame(change), ["id"], ["v"])) == rows(once)
