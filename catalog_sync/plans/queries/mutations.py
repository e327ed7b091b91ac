"""Insert, update, replace and upsert over the order tables."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import functions as F

from catalog_sync.functions import literal_for, parse_number, truncate_to_int
from catalog_sync.operators.joins import keep_known
from catalog_sync.operators.upsert import (
    action_counts,
    insert_absent,
    insert_ignore,
    replace_children,
    update_by_key,
    upsert,
    upsert_tagged,
)
from catalog_sync.plans.queries.cleaning import NUMBER_SQL
from catalog_sync.plans.registry import query, table

_AS_OF_SQL = "TIMESTAMP '2024-06-01 12:00:00'"
_KEY = ["o_orderkey"]
_LINES = ["l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_quantity"]


def _stamp():
    return "updated_at", F.lit("2024-06-01 12:00:00").cast("timestamp_ntz")


def _orders(spark, d):
    return table(spark, d, "orders").select("o_orderkey", "o_totalprice", "o_orderdate")


def _halves(spark, d):
    """A catalog up to 1998 and a delivery from 1997 on: part overlap, part new. The delivery
    changes prices except in 1998."""
    orders = _orders(spark, d)
    day = lambda y: literal_for(orders, "o_orderdate", dt.date(y, 1, 1))
    date = F.col("o_orderdate")
    price = F.col("o_totalprice")
    same = (date >= day(1998)) & (date < day(1999))
    delivered = orders.filter(date >= day(1997)).withColumn(
        "o_totalprice", F.when(same, price).otherwise(price + 1)
    )
    return orders.filter(date < day(1999)), delivered


_HALVES_SQL = """
  target AS (SELECT o_orderkey, o_totalprice, o_orderdate FROM orders
             WHERE o_orderdate < DATE '1999-01-01'),
  delivery AS (SELECT o_orderkey, CASE WHEN year(o_orderdate) = 1998 THEN o_totalprice
                 ELSE o_totalprice + 1 END AS o_totalprice, o_orderdate FROM orders
               WHERE o_orderdate >= DATE '1997-01-01')"""


@query(
    "insert_ignore",
    """SELECT o_orderkey, CASE o_orderstatus WHEN 'F' THEN o_totalprice ELSE o_totalprice + 1 END
         AS o_totalprice FROM orders""",
)
def bulk_insert(spark, d):
    orders = table(spark, d, "orders")
    target = orders.filter(F.col("o_orderstatus") == "F").select("o_orderkey", "o_totalprice")
    copies = F.explode(F.array(F.lit(2), F.lit(1))).alias("copy")
    rows = orders.select("o_orderkey", "o_totalprice", copies).withColumn(
        "o_totalprice", F.col("o_totalprice") + F.col("copy")
    )
    return insert_ignore(target, rows, _KEY, [F.col("copy")])


@query(
    "update_by_key",
    f"""SELECT o_orderkey, o_orderdate, CASE
           WHEN o_orderpriority <> '1-URGENT' THEN o_totalprice
           WHEN o_orderstatus = 'P' THEN NULL ELSE o_totalprice * 2 END AS o_totalprice,
         CASE WHEN o_orderpriority = '1-URGENT' THEN {_AS_OF_SQL} END AS updated_at
       FROM orders""",
)
def price_update(spark, d):
    orders = table(spark, d, "orders")
    never = F.lit(None).cast("timestamp_ntz").alias("updated_at")
    target = orders.select("o_orderkey", "o_totalprice", "o_orderdate", never)
    price = F.when(F.col("o_orderstatus") != "P", F.col("o_totalprice") * 2)
    source = orders.filter(F.col("o_orderpriority") == "1-URGENT").select(
        "o_orderkey", price.alias("o_totalprice")
    )
    return update_by_key(target, source, _KEY, ["o_totalprice"], _stamp())


@query(
    "replace_children",
    f"""SELECT {', '.join(_LINES)} FROM lineitem JOIN orders ON l_orderkey = o_orderkey
       WHERE o_orderpriority <> '5-LOW'
       UNION ALL
       SELECT l_orderkey, l_linenumber + 100, l_partkey, l_suppkey, l_quantity
       FROM lineitem JOIN orders ON l_orderkey = o_orderkey
       WHERE o_orderpriority = '5-LOW' AND o_orderstatus = 'F'""",
)
def replaced_lines(spark, d):
    lines = table(spark, d, "lineitem").select(*_LINES)
    orders = table(spark, d, "orders")
    updated = orders.filter(F.col("o_orderpriority") == "5-LOW")
    refilled = updated.filter(F.col("o_orderstatus") == "F")
    fresh = keep_known(lines, refilled, {"l_orderkey": "o_orderkey"}, unique=True).withColumn(
        "l_linenumber", F.col("l_linenumber") + 100
    )
    return replace_children(lines, updated, fresh, "l_orderkey", "o_orderkey")


@query(
    "insert_absent",
    f"""WITH {_HALVES_SQL}
       SELECT * FROM target
       UNION ALL
       SELECT * FROM delivery WHERE o_orderkey NOT IN (SELECT o_orderkey FROM target)""",
)
def inserted_orders(spark, d):
    return insert_absent(*_halves(spark, d), _KEY)


@query(
    "upsert",
    f"""WITH {_HALVES_SQL}
       SELECT * FROM delivery
       UNION ALL
       SELECT * FROM target WHERE o_orderkey NOT IN (SELECT o_orderkey FROM delivery)""",
)
def upserted_orders(spark, d):
    return upsert(*_halves(spark, d), _KEY, ["o_totalprice", "o_orderdate"])


@query(
    "action_counts",
    f"""WITH {_HALVES_SQL}
       SELECT count(*) FILTER (t.o_orderkey IS NULL) AS insert,
         count(*) FILTER (t.o_totalprice <> s.o_totalprice) AS update,
         count(*) FILTER (t.o_totalprice = s.o_totalprice) AS unchanged,
         count(*) FILTER (s.o_orderkey IS NULL) AS skipped,
         count(s.o_orderkey) AS processed
       FROM target t FULL JOIN delivery s ON t.o_orderkey = s.o_orderkey""",
)
def upsert_actions(spark, d):
    tagged = upsert_tagged(*_halves(spark, d), _KEY, ["o_totalprice", "o_orderdate"])
    return action_counts(tagged)


@query(
    "refresh_all_once",
    f"""SELECT o_orderkey, o_totalprice + 1 AS o_totalprice, {_AS_OF_SQL} AS updated_at
       FROM orders""",
)
def refreshed_orders(spark, d):
    orders = table(spark, d, "orders")
    target = orders.select("o_orderkey", "o_totalprice", F.col("o_orderdate").alias("updated_at"))
    source = orders.select("o_orderkey", (F.col("o_totalprice") + 1).alias("o_totalprice"))
    return update_by_key(target, source, _KEY, ["o_totalprice"], _stamp())


@query(
    "drop_invalid_ids",
    f"""
    WITH raw AS (
      SELECT p_name, CASE p_type WHEN 'PROMO' THEN concat(p_partkey, '.9')
        WHEN 'LARGE' THEN concat(p_partkey, 'd') WHEN 'SMALL' THEN NULL
        ELSE CAST(p_partkey AS VARCHAR) END AS raw FROM part),
    ids AS (SELECT CAST(trunc({NUMBER_SQL.format('raw')}) AS BIGINT) AS id, p_name FROM raw)
    SELECT * FROM ids WHERE id IS NOT NULL""",
)
def parts_with_id(spark, d):
    kind, key = F.col("p_type"), F.col("p_partkey")
    raw = (
        F.when(kind == "PROMO", F.concat(key, F.lit(".9")))
        .when(kind == "LARGE", F.concat(key, F.lit("d")))
        .when(kind != "SMALL", key.cast("string"))
    )
    ids = table(spark, d, "part").select(truncate_to_int(parse_number(raw)).alias("id"), "p_name")
    return ids.dropna(subset=["id"])
