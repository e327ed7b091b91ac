"""Key joins: known and unknown rows, lookups, audits of references."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import functions as F

from catalog_sync.functions import literal_for
from catalog_sync.operators.incremental import since
from catalog_sync.operators.joins import enrich, exclude_existing, keep_known, key_set
from catalog_sync.operators.quality import childless, children_counts, orphans
from catalog_sync.plans.registry import query, table

CUT = dt.date(2001, 1, 1)
_LINE_KEY = ["l_orderkey", "l_linenumber", "l_partkey", "l_suppkey"]


def _orders_before(spark, d):
    orders = table(spark, d, "orders")
    return orders.filter(F.col("o_orderdate") < literal_for(orders, "o_orderdate", CUT))


@query(
    "anti_join_existing",
    f"""SELECT c_custkey, c_name FROM customer c
       WHERE NOT EXISTS (SELECT 1 FROM orders o WHERE o.o_custkey = c.c_custkey
                           AND o.o_orderdate >= DATE '{CUT}')""",
)
def customers_without_orders(spark, d):
    customers = table(spark, d, "customer").select("c_custkey", "c_name")
    recent = since(table(spark, d, "orders"), "o_orderdate", CUT)
    return exclude_existing(customers, recent, {"c_custkey": "o_custkey"})


@query(
    "enrich_inner",
    """SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, p_name, p_brand
       FROM lineitem JOIN part ON l_partkey = p_partkey""",
)
def lines_with_part(spark, d):
    part = table(spark, d, "part").select("p_partkey", "p_name", "p_brand")
    return enrich(table(spark, d, "lineitem").select(*_LINE_KEY), part, {"l_partkey": "p_partkey"})


@query(
    "enrich_left_empty",
    """SELECT o_orderkey, o_totalprice, count(l_orderkey) AS line_count
       FROM orders LEFT JOIN lineitem ON o_orderkey = l_orderkey
       GROUP BY o_orderkey, o_totalprice""",
)
def orders_with_line_count(spark, d):
    counts = table(spark, d, "lineitem").groupBy("l_orderkey").agg(F.count("*").alias("n"))
    orders = table(spark, d, "orders").select("o_orderkey", "o_totalprice")
    joined = enrich(orders, counts, {"o_orderkey": "l_orderkey"}, "left")
    return joined.select(
        "o_orderkey", "o_totalprice", F.coalesce("n", F.lit(0)).alias("line_count")
    )


@query(
    "distinct_people_lookup",
    """SELECT s_suppkey, s_name, s_acctbal FROM supplier
       WHERE s_suppkey IN (SELECT l_suppkey FROM lineitem) AND s_acctbal >= 0""",
)
def mentioned_suppliers(spark, d):
    suppliers = table(spark, d, "supplier").select("s_suppkey", "s_name", "s_acctbal")
    seen = suppliers.filter(F.col("s_acctbal") < 0)
    ids = key_set(table(spark, d, "lineitem"), ["l_suppkey"]).toDF("s_suppkey")
    return enrich(exclude_existing(ids, seen, ["s_suppkey"]), suppliers, ["s_suppkey"])


@query(
    "refresh_join",
    """SELECT o_orderkey, o_custkey FROM orders o
       WHERE EXISTS (SELECT 1 FROM lineitem l WHERE l.l_orderkey = o.o_orderkey)
         AND EXISTS (SELECT 1 FROM customer c WHERE c.c_custkey = o.o_custkey)""",
)
def refreshable_orders(spark, d):
    orders = table(spark, d, "orders").select("o_orderkey", "o_custkey")
    with_lines = keep_known(orders, table(spark, d, "lineitem"), {"o_orderkey": "l_orderkey"})
    customers = table(spark, d, "customer")
    return keep_known(with_lines, customers, {"o_custkey": "c_custkey"}, unique=True)


@query(
    "fk_semi_join",
    f"""SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey FROM lineitem l
       WHERE l_orderkey IN (SELECT o_orderkey FROM orders WHERE o_orderdate < DATE '{CUT}')
         AND l_partkey IN (SELECT p_partkey FROM part WHERE p_type <> 'PROMO')""",
)
def lines_with_parents(spark, d):
    lines = table(spark, d, "lineitem").select(*_LINE_KEY)
    parts = table(spark, d, "part").filter(F.col("p_type") != "PROMO")
    known = keep_known(lines, parts, {"l_partkey": "p_partkey"}, unique=True)
    return keep_known(known, _orders_before(spark, d), {"l_orderkey": "o_orderkey"}, unique=True)


@query(
    "orphan_audit",
    f"""SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey FROM lineitem
       WHERE l_orderkey NOT IN (SELECT o_orderkey FROM orders WHERE o_orderdate < DATE '{CUT}')""",
)
def orphan_lines(spark, d):
    lines = table(spark, d, "lineitem").select(*_LINE_KEY)
    return orphans(lines, _orders_before(spark, d), {"l_orderkey": "o_orderkey"})


@query(
    "parents_without_children",
    """SELECT o_orderkey, 'no_lines' AS problem FROM orders
       WHERE o_orderkey NOT IN (SELECT l_orderkey FROM lineitem)
       UNION ALL
       SELECT o_orderkey, 'no_returns' FROM orders
       WHERE o_orderkey NOT IN (SELECT l_orderkey FROM lineitem WHERE l_returnflag = 'R')""",
)
def parents_without_children(spark, d):
    orders = table(spark, d, "orders").select("o_orderkey")
    lines = table(spark, d, "lineitem").select("l_orderkey", "l_returnflag")
    on = {"o_orderkey": "l_orderkey"}
    returns = lines.filter(F.col("l_returnflag") == "R")
    none = childless(orders, lines, on).withColumn("problem", F.lit("no_lines"))
    return none.unionByName(
        childless(orders, returns, on).withColumn("problem", F.lit("no_returns"))
    )


@query(
    "children_counts_by_type",
    """SELECT l_orderkey, count(*) FILTER (l_returnflag = 'A') AS actors,
         count(*) FILTER (l_returnflag = 'R') AS directors
       FROM lineitem GROUP BY l_orderkey""",
)
def line_types(spark, d):
    types = {"actors": "A", "directors": "R"}
    return children_counts(table(spark, d, "lineitem"), "l_orderkey", "l_returnflag", types)


@query(
    "since_date",
    f"SELECT o_orderkey, o_orderdate FROM orders WHERE o_orderdate >= DATE '{CUT}'",
)
def orders_since(spark, d):
    return since(table(spark, d, "orders").select("o_orderkey", "o_orderdate"), "o_orderdate", CUT)
