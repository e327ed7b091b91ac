"""Watermarks, discovery, search and bounded listings."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import functions as F

from catalog_sync.functions import literal_for, period_start
from catalog_sync.operators.dedup import union_rows
from catalog_sync.operators.incremental import (
    above_id,
    discover_ids,
    distinct_ids,
    earliest_year,
    exclude_flags,
    in_years,
    listing,
    newest_first,
    recent,
    row_count,
    since,
    stalest_page,
    title_search,
    watermark,
    watermark_frame,
)
from catalog_sync.operators.joins import attach_first_children, exclude_existing
from catalog_sync.operators.paging import ordinals, page_after, page_cursors
from catalog_sync.operators.quality import row_counts
from catalog_sync.plans.queries.picks import _LINE_ORDER_SQL, line_order
from catalog_sync.plans.registry import query, table
from catalog_sync.schemas import MAX_PAGES_PER_YEAR, MAX_PAGES_SINCE_DATE

CUT = dt.date(2001, 1, 1)
PAGE_SIZE = 20
_TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()


@query(
    "add_new_since_watermark",
    f"""
    WITH target AS (SELECT * FROM orders WHERE o_orderdate < DATE '{CUT}'),
    start AS (SELECT max(o_orderdate) - INTERVAL 30 DAY AS day FROM target),
    fresh AS (
      SELECT o.* FROM orders o, start WHERE o.o_orderdate >= start.day
        AND NOT EXISTS (SELECT 1 FROM target t WHERE t.o_orderkey = o.o_orderkey)),
    firsts AS (
      SELECT *, row_number() OVER (PARTITION BY l_orderkey ORDER BY {_LINE_ORDER_SQL})
        AS child_rank FROM lineitem QUALIFY child_rank <= 3)
    SELECT o_orderkey, o_custkey, o_orderdate, o_totalprice, child_rank, l_linenumber, l_partkey,
      l_suppkey, l_quantity
    FROM fresh LEFT JOIN firsts ON o_orderkey = l_orderkey""",
)
def add_new_since_watermark(spark, d):
    orders = table(spark, d, "orders").select(
        "o_orderkey", "o_custkey", "o_orderdate", "o_totalprice"
    )
    target = orders.filter(F.col("o_orderdate") < literal_for(orders, "o_orderdate", CUT))
    start = period_start(watermark(target, "o_orderdate"), "month")
    candidates = since(orders, "o_orderdate", start)
    fresh = exclude_existing(candidates, target, ["o_orderkey"])
    lines = table(spark, d, "lineitem")
    added = attach_first_children(
        fresh, lines, {"o_orderkey": "l_orderkey"}, line_order(), 3, candidate_keys=candidates
    )
    return added.select(
        "o_orderkey", "o_custkey", "o_orderdate", "o_totalprice",
        F.col("child_rank").cast("bigint").alias("child_rank"),
        "l_linenumber", "l_partkey", "l_suppkey", "l_quantity",
    )


@query("watermark_max", "SELECT max(o_orderdate) AS watermark FROM orders")
def order_watermark(spark, d):
    return watermark_frame(table(spark, d, "orders"), "o_orderdate")


@query(
    "watermark_with_ceiling",
    f"SELECT max(o_orderdate) AS watermark FROM orders WHERE o_orderdate <= DATE '{CUT}'",
)
def order_watermark_ceiling(spark, d):
    return watermark_frame(table(spark, d, "orders"), "o_orderdate", ceiling=CUT)


@query("earliest_year", "SELECT CAST(min(year(o_orderdate)) AS INTEGER) AS year FROM orders")
def first_order_year(spark, d):
    return earliest_year(table(spark, d, "orders"), "o_orderdate")


@query("distinct_ids", "SELECT count(DISTINCT l_partkey) AS n FROM lineitem")
def ordered_parts(spark, d):
    return distinct_ids(table(spark, d, "lineitem"), "l_partkey")


@query("row_count", "SELECT count(*) AS n FROM lineitem")
def line_count(spark, d):
    return row_count(table(spark, d, "lineitem"))


@query(
    "row_count_all",
    " UNION ALL ".join(f"SELECT '{t}' AS table_name, count(*) AS row_count FROM {t}"
                       for t in _TABLES),
)
def all_row_counts(spark, d):
    return row_counts({t: table(spark, d, t) for t in _TABLES})


@query(
    "newest_capped",
    f"""SELECT o_orderkey, o_orderdate FROM orders ORDER BY o_orderdate DESC, o_orderkey DESC
       LIMIT {MAX_PAGES_SINCE_DATE * PAGE_SIZE}""",
)
def newest_orders(spark, d):
    orders = table(spark, d, "orders").select("o_orderkey", "o_orderdate")
    return newest_first(orders, "o_orderdate", "o_orderkey", MAX_PAGES_SINCE_DATE, PAGE_SIZE)


@query(
    "stalest_page",
    """SELECT o_orderkey, updated_at
       FROM (SELECT o_orderkey, CASE WHEN o_orderpriority <> '1-URGENT' OR o_orderstatus <> 'P'
               THEN o_orderdate END AS updated_at FROM orders)
       ORDER BY updated_at ASC NULLS FIRST, o_orderkey LIMIT 100 OFFSET 200""",
)
def refresh_queue_page(spark, d):
    return stalest_page(_queue(spark, d), "updated_at", "o_orderkey", limit=100, offset=200)


def _queue(spark, d):
    seen = (F.col("o_orderpriority") != "1-URGENT") | (F.col("o_orderstatus") != "P")
    return table(spark, d, "orders").select(
        "o_orderkey", F.when(seen, F.col("o_orderdate")).alias("updated_at")
    )


_QUEUE_SQL = """WITH queue AS (
         SELECT o_orderkey, CASE WHEN o_orderpriority <> '1-URGENT' OR o_orderstatus <> 'P'
           THEN o_orderdate END AS updated_at FROM orders),
       numbered AS (SELECT *, row_number() OVER (ORDER BY updated_at ASC NULLS FIRST, o_orderkey) AS ordinal
         FROM queue)"""


@query("queue_positions", f"{_QUEUE_SQL} SELECT o_orderkey, updated_at, ordinal FROM numbered")
def queue_positions(spark, d):
    """The place of each row in the whole queue."""
    return ordinals(_queue(spark, d), [F.col("updated_at").asc_nulls_first(), F.col("o_orderkey")])


@query(
    "queue_page_cursors",
    f"""{_QUEUE_SQL} SELECT CAST(ordinal // 100 AS BIGINT) AS page, updated_at, o_orderkey
        FROM numbered WHERE ordinal % 100 = 0""",
)
def queue_cursors(spark, d):
    return page_cursors(_queue(spark, d), ["updated_at", "o_orderkey"], 100)


@query(
    "queue_last_page",
    f"""{_QUEUE_SQL} SELECT o_orderkey, updated_at FROM numbered
        WHERE ordinal > (SELECT (count(*) // 100) * 100 - 100 FROM queue)
          AND ordinal <= (SELECT (count(*) // 100) * 100 FROM queue)""",
)
def queue_last_page(spark, d):
    """The last full page, read from the cursor of the page before."""
    queue = _queue(spark, d)
    cursors = page_cursors(queue, ["updated_at", "o_orderkey"], 100)
    last = cursors.orderBy(F.desc("page")).limit(2).collect()
    cursor = (last[1].updated_at, last[1].o_orderkey) if len(last) > 1 else None
    page = page_after(queue, ["updated_at", "o_orderkey"], 100, cursor)
    return page if last else page.limit(0)


@query(
    "title_search",
    f"""
    (SELECT p_partkey, p_name, p_retailprice FROM part
     WHERE contains(lower(p_name), lower('Gear')) AND p_type <> 'PROMO'
     ORDER BY p_retailprice DESC, p_partkey LIMIT {PAGE_SIZE})
    UNION ALL
    (SELECT p_partkey, p_name, p_retailprice FROM part WHERE p_partkey = 42)""",
)
def part_search(spark, d):
    parts = table(spark, d, "part").select(
        "p_partkey", "p_name", "p_retailprice", (F.col("p_type") == "PROMO").alias("adult")
    )
    columns = {"id_": "p_partkey", "title": "p_name", "popularity": "p_retailprice"}
    by_title = title_search(parts, "Gear", page_size=PAGE_SIZE, flags=["adult"], **columns)
    return union_rows(by_title, title_search(parts, "42", **columns)).drop("adult")


_RING = "SELECT p_partkey, p_name, p_retailprice FROM part WHERE contains(lower(p_name), 'ring')"


@query("title_search_all", _RING)
def part_search_all(spark, d):
    parts = table(spark, d, "part").select("p_partkey", "p_name", "p_retailprice")
    return title_search(parts, "Ring", "p_partkey", "p_name", "p_retailprice")


@query(
    "title_search_page_2",
    f"{_RING} ORDER BY p_retailprice DESC, p_partkey LIMIT {PAGE_SIZE} OFFSET {PAGE_SIZE}",
)
def part_search_page_2(spark, d):
    parts = table(spark, d, "part").select("p_partkey", "p_name", "p_retailprice")
    return title_search(parts, "Ring", "p_partkey", "p_name", "p_retailprice", PAGE_SIZE, page=2)


@query(
    "numbered_listing",
    f"""
    WITH page AS (
      SELECT * FROM part WHERE contains(lower(p_name), 'ring')
      ORDER BY p_retailprice DESC, p_partkey LIMIT {PAGE_SIZE}),
    numbered AS (
      SELECT *, row_number() OVER (ORDER BY p_retailprice DESC, p_partkey) AS n FROM page)
    SELECT CAST(n AS INTEGER) AS ordinal, p_partkey,
      concat(n, '. ', p_name, ' (', CASE p_type WHEN 'PROMO' THEN 'N/A' ELSE p_type END,
        ') - ID: ', p_partkey) AS line,
      concat('   Genres: ', p_brand) AS genre_line
    FROM numbered""",
)
def part_listing(spark, d):
    parts = table(spark, d, "part")
    page = title_search(parts, "ring", "p_partkey", "p_name", "p_retailprice", PAGE_SIZE)
    lines = listing(
        page,
        [F.col("p_retailprice").desc(), F.col("p_partkey")],
        id_="p_partkey",
        title="p_name",
        date=F.when(F.col("p_type") != "PROMO", F.col("p_type")),
        genres=F.col("p_brand"),
        page_size=PAGE_SIZE,
    )
    return lines.select("ordinal", "p_partkey", "line", "genre_line")


@query(
    "numbered_listing_all",
    """SELECT CAST(row_number() OVER (ORDER BY p_retailprice DESC, p_partkey) AS INTEGER) AS ordinal, p_partkey,
         concat(row_number() OVER (ORDER BY p_retailprice DESC, p_partkey), '. ', p_name, ' (', p_type, ') - ID: ',
           p_partkey) AS line
       FROM part WHERE contains(lower(p_name), 'ring')""",
)
def part_listing_all(spark, d):
    """All matches numbered, by ranges."""
    hits = title_search(table(spark, d, "part"), "ring", "p_partkey", "p_name", "p_retailprice")
    order = [F.col("p_retailprice").desc(), F.col("p_partkey")]
    return listing(hits, order, "p_partkey", "p_name", F.col("p_type")).select("ordinal", "p_partkey", "line")


@query("high_water_ids", "SELECT o_orderkey FROM orders WHERE o_orderkey > 1000")
def orders_above(spark, d):
    return above_id(table(spark, d, "orders").select("o_orderkey"), "o_orderkey", 1000)


@query(
    "recent_rows",
    """SELECT event_id, ts FROM events
       WHERE ts > (SELECT max(ts) FROM events) - INTERVAL 1 HOUR""",
)
def recent_events(spark, d):
    events = table(spark, d, "events").select("event_id", "ts")
    return recent(events, "ts", watermark(events, "ts"))


@query(
    "recent_count",
    """SELECT count(*) AS n FROM events
       WHERE ts > (SELECT max(ts) FROM events) - INTERVAL 24 HOUR""",
)
def recent_event_count(spark, d):
    events = table(spark, d, "events")
    return row_count(recent(events, "ts", watermark(events, "ts"), hours=24))


@query(
    "year_range",
    """SELECT o_orderkey, o_orderdate FROM orders
       WHERE year(o_orderdate) BETWEEN 1997 AND 1999""",
)
def orders_in_years(spark, d):
    orders = table(spark, d, "orders").select("o_orderkey", "o_orderdate")
    return in_years(orders, "o_orderdate", 1997, 1999)


@query(
    "flag_exclusion",
    "SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey FROM lineitem "
    "WHERE l_returnflag = 'N' AND l_linestatus = 'O'",
)
def plain_lines(spark, d):
    flag, status = F.col("l_returnflag"), F.col("l_linestatus")
    lines = table(spark, d, "lineitem").select(
        "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey",
        F.when(flag != "N", True).alias("adult"), (status != "O").alias("video"),
    )
    return exclude_flags(lines, ["adult", "video"]).drop("adult", "video")


@query(
    "discover_ids",
    """
    WITH listed AS (
      SELECT o_orderkey, year(o_orderdate) AS y, o_totalprice FROM orders
      WHERE o_orderstatus <> 'P' AND o_orderdate < DATE '2001-01-01'
      QUALIFY row_number() OVER (PARTITION BY y ORDER BY o_totalprice DESC, o_orderkey) <= 500)
    SELECT DISTINCT o_orderkey FROM listed WHERE o_orderkey > 100 ORDER BY o_orderkey""",
)
def discovered_orders(spark, d):
    orders = table(spark, d, "orders").withColumn("adult", F.col("o_orderstatus") == "P")
    return discover_ids(
        orders,
        id_="o_orderkey",
        date="o_orderdate",
        sort=[F.col("o_totalprice").desc(), F.col("o_orderkey")],
        latest_year=2000,
        since_id=100,
        max_pages=25,
        page_size=PAGE_SIZE,
        flags=["adult"],
    )


@query(
    "discover_ids_one_year",
    """SELECT o_orderkey FROM orders WHERE year(o_orderdate) = 1999 AND o_orderkey <> 0
       QUALIFY row_number() OVER (ORDER BY o_totalprice DESC, o_orderkey) <= 6000
       ORDER BY o_orderkey""",
)
def discovered_orders_of_year(spark, d):
    return discover_ids(
        table(spark, d, "orders"),
        id_="o_orderkey",
        date="o_orderdate",
        sort=[F.col("o_totalprice").desc(), F.col("o_orderkey")],
        year=1999,
        max_pages=MAX_PAGES_PER_YEAR,
        flags=[],
    )


@query(
    "discover_all_years",
    """SELECT o_orderkey FROM orders WHERE o_orderkey <> 0 AND o_orderstatus <> 'P'
       AND o_orderdate IS NOT NULL ORDER BY o_orderkey""",
)
def discovered_orders_of_all_years(spark, d):
    orders = table(spark, d, "orders").withColumn("adult", F.col("o_orderstatus") == "P")
    return discover_ids(orders, id_="o_orderkey", date="o_orderdate", flags=["adult"])
