"""What the physical plans must look like for the operators to hold at scale."""

import datetime as dt
import re

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry
from catalog_sync.operators.dedup import first_wins, top_n
from catalog_sync.operators.incremental import discover_ids, in_years, newest_first, since
from catalog_sync.operators.joins import exclude_existing, keep_known, keep_unknown
from catalog_sync.operators.upsert import upsert

FOLDER = "/root/testdata/sf0.001"


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def exchanges(df):
    return len(re.findall(r"Exchange hashpartitioning", plan(df)))


@pytest.fixture(scope="module")
def orders(spark):
    return spark.read.parquet(f"{FOLDER}/orders.parquet")


@pytest.fixture(scope="module")
def lines(spark):
    return spark.read.parquet(f"{FOLDER}/lineitem.parquet")


@pytest.fixture(autouse=True)
def no_automatic_broadcast(spark):
    """As with tables too large to broadcast."""
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    yield
    spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_picks_are_cut_before_the_shuffle(lines):
    for df in (first_wins(lines, ["l_orderkey"], [F.col("l_linenumber")]),
               top_n(lines, ["l_orderkey"], [F.col("l_linenumber")], 8)):
        text = plan(df)
        assert text.index("Final") < text.index("Exchange") < text.index("Partial")
        assert exchanges(df) == 1


def test_deep_cut_splits_the_group_first(orders):
    df = top_n(orders, ["o_orderstatus"], [F.col("o_orderkey")], 5000, row_id=["o_orderkey"])
    assert "_split" in re.search(r"Exchange hashpartitioning\([^)]*_split[^)]*\)", plan(df)).group()
    assert exchanges(df) == 2


def test_dates_reach_the_scan(orders):
    day = dt.date(2000, 1, 1)
    for df in (since(orders, "o_orderdate", day), in_years(orders, "o_orderdate", 1997, 1999)):
        assert "GreaterThanOrEqual(o_orderdate" in plan(df)


def test_only_needed_columns_are_read(orders):
    ids = discover_ids(orders, id_="o_orderkey", date="o_orderdate", flags=[],
                       sort=[F.col("o_totalprice").desc(), F.col("o_orderkey")])
    schema = re.search(r"ReadSchema: struct<([^>]*)>", plan(ids)).group(1)
    assert "o_custkey" not in schema and "o_orderpriority" not in schema


def test_new_rows_do_not_shuffle_the_target(orders):
    source = orders.filter("o_orderkey > 1490")
    small = plan(exclude_existing(source, orders, ["o_orderkey"]))
    assert "BroadcastHashJoin" in small
    # Beyond the bound nothing is broadcast.
    large = plan(exclude_existing(source, orders, ["o_orderkey"], max_rows=0))
    assert "Broadcast" not in large and "SortMergeJoin" in large


def test_semi_and_anti_collapse_the_right_side(orders, lines):
    for join in (keep_known, keep_unknown):
        df = join(orders, lines, {"o_orderkey": "l_orderkey"})
        text = plan(df)
        # Partial distinct, one shuffle, final distinct, and the join takes it as it is.
        assert text.count("HashAggregate") == 2 and exchanges(df) == 2


def test_upsert_is_one_join(orders):
    df = upsert(orders, orders.select("o_orderkey", "o_totalprice"), ["o_orderkey"], ["o_totalprice"])
    assert plan(df).count("SortMergeJoin") == 1 and exchanges(df) == 2


def test_capped_listing_is_a_top_k(orders):
    text = plan(newest_first(orders, "o_orderdate", "o_orderkey", 20, 20))
    assert "TakeOrderedAndProject" in text and "Exchange" not in text


JOBLESS = [n for n in sorted(entry.queries())
           if n in ("clean_text", "numeric_coerce", "cast_credits", "crew_credits", "validate_route",
                    "error_summary", "first_wins_dedup", "upsert", "replace_children",
                    "add_new_since_watermark", "title_search", "fk_semi_join")]


@pytest.mark.parametrize("name", JOBLESS)
def test_no_python_in_the_plan(spark, name):
    text = plan(entry.queries()[name](spark, FOLDER))
    assert not re.search(r"Python|Pandas|ArrowEval|CartesianProduct|BroadcastNestedLoop", text)
