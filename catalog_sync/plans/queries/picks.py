"""Order-dependent picks per key and unions."""

from __future__ import annotations

from pyspark.sql import functions as F

from catalog_sync.operators.dedup import first_wins, fresh_latest, top_n, union_ids, union_rows
from catalog_sync.operators.incremental import sorted_ids, watermark
from catalog_sync.operators.quality import duplicate_keys
from catalog_sync.plans.registry import query, table
from catalog_sync.schemas import RESPONSE_TTL_SECONDS

LINE_ORDER = [
    "l_linenumber", "l_partkey", "l_suppkey", "l_quantity", "l_extendedprice", "l_discount",
    "l_tax", "l_returnflag", "l_linestatus", "l_shipdate",
]
_LINE_ORDER_SQL = ", ".join(LINE_ORDER)


def line_order():
    return [F.col(c) for c in LINE_ORDER]


@query(
    "top_n_children",
    f"""SELECT *, row_number() OVER (PARTITION BY l_orderkey ORDER BY {_LINE_ORDER_SQL})
          AS child_rank FROM lineitem QUALIFY child_rank <= 3""",
)
def first_lines(spark, d):
    top = top_n(table(spark, d, "lineitem"), ["l_orderkey"], line_order(), 3, rank="child_rank")
    return top.withColumn("child_rank", F.col("child_rank").cast("bigint"))


@query(
    "first_matching_child",
    f"""SELECT * FROM lineitem WHERE l_returnflag = 'R'
       QUALIFY row_number() OVER (PARTITION BY l_orderkey ORDER BY {_LINE_ORDER_SQL}) = 1""",
)
def first_return(spark, d):
    returns = table(spark, d, "lineitem").filter(F.col("l_returnflag") == "R")
    return first_wins(returns, ["l_orderkey"], line_order())


@query(
    "first_wins_dedup",
    f"""SELECT * FROM lineitem QUALIFY row_number() OVER (
         PARTITION BY l_orderkey, l_linenumber ORDER BY {_LINE_ORDER_SQL}) = 1""",
)
def unique_lines(spark, d):
    return first_wins(table(spark, d, "lineitem"), ["l_orderkey", "l_linenumber"], line_order())


@query(
    "duplicate_report",
    """SELECT l_orderkey, l_linenumber, count(*) AS copies FROM lineitem
       GROUP BY ALL HAVING count(*) > 1""",
)
def repeated_lines(spark, d):
    return duplicate_keys(table(spark, d, "lineitem"), ["l_orderkey", "l_linenumber"])


def _top_per_year_sql(n: int) -> str:
    return f"""SELECT o_orderkey, o_totalprice, CAST(year(o_orderdate) AS INTEGER) AS order_year
       FROM orders QUALIFY row_number() OVER (
         PARTITION BY year(o_orderdate) ORDER BY o_totalprice DESC, o_orderkey) <= {n}"""


def _top_per_year(spark, d, n: int):
    orders = table(spark, d, "orders").select(
        "o_orderkey", "o_totalprice", F.year("o_orderdate").alias("order_year")
    )
    order = [F.col("o_totalprice").desc(), F.col("o_orderkey")]
    return top_n(orders, ["order_year"], order, n, row_id=["o_orderkey"])


@query("top_per_year", _top_per_year_sql(50))
def top_per_year(spark, d):
    return _top_per_year(spark, d, 50)


@query("top_per_year_many_pages", _top_per_year_sql(1500))
def top_per_year_many_pages(spark, d):
    return _top_per_year(spark, d, 1500)


@query(
    "fresh_latest",
    f"""SELECT * FROM events
       QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) = 1
         AND ts > (SELECT max(ts) FROM events) - INTERVAL {RESPONSE_TTL_SECONDS} SECOND""",
)
def fresh_events(spark, d):
    events = table(spark, d, "events")
    return fresh_latest(
        events, ["user_id"], "ts", watermark(events, "ts"), RESPONSE_TTL_SECONDS,
        [F.col("event_id").desc()],
    )


@query(
    "latest_per_key",
    """SELECT * FROM events
       QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) = 1""",
)
def latest_events(spark, d):
    events = table(spark, d, "events")
    return fresh_latest(events, ["user_id"], "ts", tie_break=[F.col("event_id").desc()])


@query(
    "union_missing_columns",
    """SELECT c_custkey AS id, c_name AS name, c_acctbal AS balance, c_mktsegment AS segment
       FROM customer
       UNION ALL SELECT s_suppkey, s_name, s_acctbal, NULL FROM supplier""",
)
def parties(spark, d):
    customers = table(spark, d, "customer").select(
        F.col("c_custkey").alias("id"), F.col("c_name").alias("name"),
        F.col("c_acctbal").alias("balance"), F.col("c_mktsegment").alias("segment"),
    )
    suppliers = table(spark, d, "supplier").select(
        F.col("s_suppkey").alias("id"), F.col("s_name").alias("name"),
        F.col("s_acctbal").alias("balance"),
    )
    return union_rows(customers, suppliers)


@query(
    "union_distinct_ids",
    "SELECT o_custkey AS id FROM orders UNION SELECT c_custkey FROM customer",
)
def all_customer_ids(spark, d):
    return union_ids(
        "id",
        table(spark, d, "orders").select("o_custkey"),
        table(spark, d, "customer").select("c_custkey"),
    )


@query("sorted_ids", "SELECT DISTINCT o_custkey FROM orders ORDER BY o_custkey")
def ordering_customers(spark, d):
    return sorted_ids(table(spark, d, "orders"), "o_custkey")
