import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from catalog_sync.operators.paging import ordinals, page_after, page_cursors

KEYS = ["at", "id"]


@pytest.fixture(params=["timestamp_ntz", "date"])
def queue(spark, request):
    rng = random.Random(5)
    times = [None] * 4 + [dt.datetime(2024, 1, 1 + n) for n in range(5)]
    times = [t if t is None or request.param != "date" else t.date() for t in times]
    data = [(rng.choice(times), i) for i in range(331)]
    rng.shuffle(data)
    df = spark.createDataFrame(data, f"at {request.param}, id bigint").repartition(5)
    return df, sorted(data, key=lambda r: (r[0] is not None, str(r[0]), r[1]))


def test_ordinals(queue):
    df, expected = queue
    out = ordinals(df, [F.col("at").asc_nulls_first(), F.col("id")])
    assert [(r.at, r.id) for r in sorted(out.collect(), key=lambda r: r.ordinal)] == expected
    assert out.columns == ["at", "id", "ordinal"]
    down = ordinals(df, [F.col("at").desc_nulls_last(), F.col("id").desc()], "n")
    assert [(r.at, r.id) for r in sorted(down.collect(), key=lambda r: r.n)] == expected[::-1]


def test_ordinals_of_rows_alike_and_of_none(spark):
    df = spark.createDataFrame([(None,), (1,), (1,), (None,), (0,)], "v int")
    out = ordinals(df, [F.col("v")]).orderBy("ordinal").collect()
    assert [(r.v, r.ordinal) for r in out] == [(None, 1), (None, 2), (0, 3), (1, 4), (1, 5)]
    assert ordinals(df.where("false"), [F.col("v")]).count() == 0


def test_pages_by_cursor(queue):
    df, expected = queue
    cursors = {r.page: (r.at, r.id) for r in page_cursors(df, KEYS, 60).collect()}
    assert cursors == {n: expected[n * 60 - 1] for n in range(1, 6)}
    for n in range(6):
        page = [tuple(r) for r in page_after(df, KEYS, 60, cursors.get(n)).collect()]
        assert page == expected[n * 60 : n * 60 + 60]
    assert page_after(df, KEYS, 60, expected[-1]).count() == 0


def test_the_cursor_reaches_the_scan(spark, tmp_path, queue):
    queue[0].write.parquet(f"{tmp_path}/q")
    stored = spark.read.parquet(f"{tmp_path}/q")
    plan = page_after(stored, KEYS, 20, queue[1][200])._jdf.queryExecution().executedPlan().toString()
    assert "GreaterThanOrEqual(at" in plan and "TakeOrderedAndProject(limit=20" in plan
