import datetime as dt

import pytest
from pyspark.sql import functions as F

from catalog_sync.operators import incremental as inc

D = dt.date


@pytest.fixture(scope="module")
def movies(spark):
    data = [
        (1, "Alpha", D(2019, 5, 1), 5.0, False, None), (2, "Beta", D(2020, 1, 1), 9.0, None, False),
        (3, "Alphabet", D(2020, 12, 31), 7.0, True, False), (4, "Gamma", None, 1.0, False, False),
        (5, "ALPHA 2", D(2024, 2, 1), 7.0, False, False), (0, "Zero", D(2020, 6, 1), 99.0, None, None),
    ]
    return spark.createDataFrame(
        data, "id bigint, title string, release_date date, popularity double, adult boolean, "
              "video boolean")


def test_watermark(movies):
    assert inc.watermark(movies, "release_date") == D(2024, 2, 1)
    assert inc.watermark(movies, "release_date", ceiling=D(2020, 12, 31)) == D(2020, 12, 31)
    assert inc.watermark(movies.filter("false"), "release_date") is None


def test_scalars(movies):
    assert inc.earliest_year(movies, "release_date").first()[0] == 2019
    assert inc.row_count(movies).first()[0] == 6
    assert inc.distinct_ids(movies.union(movies), "id").first()[0] == 6


def test_filters(movies, rows):
    ids = lambda df: [r[0] for r in rows(df, "id")]
    assert ids(inc.since(movies, "release_date", D(2020, 12, 31))) == [3, 5]
    assert ids(inc.in_years(movies, "release_date", 2020, 2020)) == [0, 2, 3]
    assert ids(inc.exclude_flags(movies, ["adult", "video"])) == [0, 1, 2, 4, 5]
    assert ids(inc.above_id(movies, "id", 3)) == [4, 5]
    assert len(ids(inc.above_id(movies, "id", None))) == len(ids(inc.above_id(movies, "id", 0))) == 6


@pytest.mark.parametrize("kind", ["timestamp", "timestamp_ntz"])
def test_recent_is_strict(spark, rows, kind):
    now = dt.datetime(2024, 1, 1, 12)
    df = spark.createDataFrame(
        [(1, now - dt.timedelta(minutes=59)), (2, now - dt.timedelta(minutes=60)), (3, None)],
        f"id int, at {kind}")
    as_of = df.filter("id = 2").first().at + dt.timedelta(hours=1)
    assert rows(inc.recent(df, "at", as_of), "id") == [(1,)]


def test_newest_and_stalest(movies, spark, rows):
    top = inc.newest_first(movies, "release_date", "id", max_pages=1, page_size=2)
    assert rows(top, "id") == [(3,), (5,)]
    assert inc.newest_first(movies, "release_date", "id").count() == 6
    queue = spark.createDataFrame([(1, 5), (2, None), (3, 1), (4, 1)], "id int, at int")
    page = [r.id for r in inc.stalest_page(queue, "at", "id", limit=2, offset=1).collect()]
    assert page == [3, 4]


def test_title_search(movies):
    found = lambda q, **kw: [r.id for r in inc.title_search(movies, q, **kw).collect()]
    assert sorted(found("alpha")) == [1, 3, 5]
    assert found("alpha", page_size=9) == [3, 5, 1]
    assert found("alpha", flags=["adult"], page_size=9) == [5, 1]
    assert found("alpha", page_size=1) == [3] and found("alpha", page_size=1, page=2) == [5]
    assert found("4") == [4] and found("77") == [] and found("nothing") == []


def test_listing(movies):
    page = inc.title_search(movies, "a", page_size=3)
    shown = inc.listing(page, [F.col("popularity").desc(), F.col("id")],
                        date=F.col("release_date").cast("string"), genres=F.lit("No genres"))
    lines = [r.line for r in shown.orderBy("ordinal").collect()]
    assert lines[0] == "1. Beta (2020-01-01) - ID: 2" and len(lines) == 3
    missing = inc.listing(movies.filter("id = 4"), [F.col("id")], date=F.lit(None).cast("string"))
    assert missing.first().line == "1. Gamma (N/A) - ID: 4"


def test_listing_of_all_matches(movies):
    order = [F.col("popularity").desc(), F.col("id")]
    page = inc.listing(movies, order, page_size=20)
    assert sorted(inc.listing(movies, order).collect()) == sorted(page.collect())
    plan = inc.listing(movies, order)._jdf.queryExecution().executedPlan().toString()
    assert "row_number" not in plan  # only the counts per range meet in one task


def test_pages(spark, rows):
    pages = spark.createDataFrame(
        [(1, 2, [(1,), (2,)]), (2, 2, [(3,)]), (3, 2, [(4,)])],
        "page int, total_pages int, results array<struct<id: bigint>>")
    assert rows(inc.page_results(pages, 20)) == [(1, 1), (1, 2), (2, 3)]
    assert rows(inc.page_results(pages, 1)) == [(1, 1), (1, 2)]


def test_discover(movies):
    ids = lambda **kw: [r.id for r in inc.discover_ids(movies, **kw).collect()]
    assert ids() == [1, 2, 5]  # id 0 is unusable, 3 adult, 4 undated
    assert ids(latest_year=2023) == [1, 2]
    assert ids(since_id=1) == [2, 5] and ids(year=2024) == [5]
    # The cap looks at the page before ids are judged: 0 takes the only place in 2020.
    assert ids(max_pages=1, page_size=1, latest_year=2023) == [1]
