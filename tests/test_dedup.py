import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from catalog_sync.operators.dedup import (
    _split_counts,
    first_wins,
    fresh_latest,
    top_n,
    union_ids,
    union_rows,
)
from catalog_sync.operators.joins import (
    attach_first_children,
    exclude_existing,
    existing_keys,
    fits_broadcast,
    keep_known,
    keep_unknown,
)


@pytest.fixture(scope="module")
def skewed(spark):
    """A third of the rows share one key, a third are copies of one row."""
    rng = random.Random(7)
    data = [(0, rng.randint(0, 50), i) for i in range(1000)] + [(1, 7, 7)] * 1000
    data += [(rng.randint(1, 40), rng.randint(0, 50), i) for i in range(1000)]
    return data, spark.createDataFrame(data, "k bigint, v bigint, i bigint").repartition(8)


@pytest.mark.parametrize("n", [1, 8, 700])
@pytest.mark.parametrize("threshold", ["1000", "0"])
def test_top_n_equals_brute_force(spark, skewed, rows, n, threshold):
    data, df = skewed
    groups = {}
    for row in sorted(data, key=lambda r: (r[0], r[1], r[2])):
        groups.setdefault(row[0], []).append(row)
    want = sorted((r for g in groups.values() for r in g[:n]), key=repr)
    option = "spark.sql.optimizer.windowGroupLimitThreshold"
    before = spark.conf.get(option)
    spark.conf.set(option, threshold)
    try:
        got = rows(top_n(df, ["k"], [F.col("v"), F.col("i")], n))
    finally:
        spark.conf.set(option, before)
    assert got == want


def test_split_counts():
    assert _split_counts(8) == [8] and _split_counts(20_000) == [20_000, 141, 11]


def test_many_splits(spark, skewed, rows):
    data, df = skewed
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", "80")
    spark.conf.set("spark.sql.optimizer.windowGroupLimitThreshold", "0")
    try:
        got = rows(top_n(df, ["k"], [F.col("v"), F.col("i")], 2))
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
        spark.conf.unset("spark.sql.optimizer.windowGroupLimitThreshold")
    assert got == rows(top_n(df, ["k"], [F.col("v"), F.col("i")], 2))


def test_top_n_rank(spark, rows):
    df = spark.createDataFrame([("a", 3), ("a", 1), ("b", 2)], "k string, v int")
    assert rows(top_n(df, ["k"], [F.col("v")], 2, rank="n"), "k", "v", "n") == [
        ("a", 1, 1), ("a", 3, 2), ("b", 2, 1)]


def test_first_wins_keeps_null_keys_apart(spark, rows):
    df = spark.createDataFrame([(1, "x", 2), (1, "y", 1), (None, "z", 3)], "k int, v string, o int")
    assert rows(first_wins(df, ["k"], [F.col("o")]), "k", "v") == [(1, "y"), (None, "z")]


def test_fresh_latest(spark, rows):
    t = lambda m: dt.datetime(2024, 1, 1, 12, m)
    df = spark.createDataFrame(
        [("a", t(1), 1), ("a", t(5), 2), ("b", t(0), 3), ("c", None, 4)],
        "k string, at timestamp_ntz, v int",
    )
    assert rows(fresh_latest(df, ["k"], "at"), "k", "v") == [("a", 2), ("b", 3), ("c", 4)]
    # Age must be below the limit: b is exactly 300 s old.
    fresh = fresh_latest(df, ["k"], "at", as_of=t(5), ttl_seconds=300)
    assert rows(fresh, "k", "v") == [("a", 2)]


def test_unions(spark, rows):
    a = spark.createDataFrame([(1, "x")], "id int, name string")
    b = spark.createDataFrame([(2,), (1,)], "id int")
    assert rows(union_rows(a, b)) == [(1, "x"), (1, None), (2, None)]
    assert rows(union_ids("id", a.select("id"), b)) == [(1,), (2,)]


@pytest.mark.parametrize("max_rows", [0, 1000])
def test_exclude_existing_both_ways(spark, rows, max_rows):
    source = spark.createDataFrame([(1,), (2,), (2,), (None,)], "id int")
    target = spark.createDataFrame([(2,), (3,), (None,)], "key int")
    got = exclude_existing(source, target, {"id": "key"}, max_rows)
    assert rows(got) == [(1,), (None,)]


@pytest.mark.parametrize("max_rows", [0, 1000])
def test_existing_keys_both_ways(spark, rows, max_rows):
    keys = spark.createDataFrame([(1,), (2,)], "id int")
    target = spark.createDataFrame([(2,), (2,), (3,), (None,)], "key int")
    assert rows(existing_keys(keys, target, {"id": "key"}, max_rows)) == [(2,)]


def test_text_keys_are_never_broadcast(spark):
    ids = spark.createDataFrame([(1,)], "id bigint")
    assert fits_broadcast(ids) and not fits_broadcast(ids, max_rows=0)
    assert not fits_broadcast(ids.select(F.col("id").cast("string")))


def test_known_and_unknown(spark, rows):
    df = spark.createDataFrame([(1, "a"), (2, "b"), (None, "c")], "id int, v string")
    parents = spark.createDataFrame([(1,), (1,), (None,)], "pid int")
    assert rows(keep_known(df, parents, {"id": "pid"})) == [(1, "a")]
    assert rows(keep_unknown(df, parents, {"id": "pid"})) == [(2, "b"), (None, "c")]


@pytest.mark.parametrize("bounded", [True, False])
def test_attach_first_children(spark, rows, bounded):
    parents = spark.createDataFrame([(1,), (2,)], "id int")
    children = spark.createDataFrame([(1, 5), (1, 3), (1, 4), (3, 1)], "pid int, v int")
    got = attach_first_children(
        parents, children, {"id": "pid"}, [F.col("v")], 2,
        candidate_keys=parents if bounded else None,
    )
    assert rows(got, "id", "v", "child_rank") == [(1, 3, 1), (1, 4, 2), (2, None, None)]
