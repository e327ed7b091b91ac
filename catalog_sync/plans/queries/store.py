"""The snapshot store at work: publishes that meet, slots, differences, documents taken in, errors and
counters of jobs."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from catalog_sync.operators.joins import exclude_existing
from catalog_sync.operators.quality import error_counts
from catalog_sync.operators.upsert import update_tagged
from catalog_sync.plans import jobs
from catalog_sync.plans.jobs import Changes, Landing, add_new, commit, publish, refresh, sync
from catalog_sync.plans.ledger import landing_of, take_in
from catalog_sync.plans.queries.catalog import AS_OF, _early_catalog, _early_sql, _stale_catalog
from catalog_sync.plans.queries.landing import (
    CREDITS_SQL,
    DETAILS_SQL,
    GENRES_SQL,
    PEOPLE_SQL,
    landing,
)
from catalog_sync.plans.registry import query, table
from catalog_sync.plans.titles import extend, find_titles
from catalog_sync.schemas import CORRUPT, ERROR_CATEGORIES, SIDE_KEYS
from catalog_sync.scratch import scratch_dir
from catalog_sync.sources.landing import write_json
from catalog_sync.sources.snapshots import Conflict, Published, Rewrite, SnapshotStore
from catalog_sync.streaming import fresh_fetches, stream_catalog

SLOTS = 8


def _orders(spark: SparkSession) -> SnapshotStore:
    keys = {"orders": ["o_orderkey"]}
    root = scratch_dir(spark, "order-store")
    return SnapshotStore(spark, root, SLOTS, bucket_keys={"orders": "o_orderkey"}, keys=keys)


def _raise(store: SnapshotStore, status: str, by: int) -> tuple[int, dict[str, Rewrite]]:
    """The version read, and what raises the prices of the orders of a status."""
    tables = store.tables()
    picked = tables["orders"].filter(F.col("o_orderstatus") == status).select(
        "o_orderkey", (F.col("o_totalprice") + by).alias("o_totalprice")
    )
    change = Rewrite(
        lambda: picked.select("o_orderkey"),
        lambda rows: update_tagged(rows, picked, ["o_orderkey"], ["o_totalprice"]),
    )
    return tables.version, {"orders": change}


@query(
    "snapshot_concurrent_updates",
    """SELECT o_orderkey, o_orderstatus, o_totalprice
         + CASE o_orderstatus WHEN 'F' THEN 1 WHEN 'O' THEN 2 ELSE 0 END AS o_totalprice, 1 AS conflicts
       FROM orders""",
)
def concurrent_updates(spark, d):
    """Two updates computed from one version: the second is refused and computed again."""
    store = _orders(spark)
    orders = table(spark, d, "orders").select("o_orderkey", "o_orderstatus", "o_totalprice")
    store.publish(replace={"orders": orders})
    base, first = _raise(store, "F", 1)
    _, second = _raise(store, "O", 2)
    store.publish(rewrite=first, base=base)
    conflicts = 0
    try:
        store.publish(rewrite=second, base=base)
    except Conflict:
        conflicts += 1
        base, second = _raise(store, "O", 2)
        store.publish(rewrite=second, base=base)
    return store.table("orders").withColumn("conflicts", F.lit(conflicts))


@query("snapshot_concurrent_adds", "SELECT o_orderkey, o_orderstatus, o_custkey, 1 AS conflicts FROM orders")
def concurrent_adds(spark, d):
    """Two inserts of overlapping keys, each found absent at one version: no key is there twice."""
    store = _orders(spark)
    orders = table(spark, d, "orders").select("o_orderkey", "o_orderstatus", "o_custkey")
    status = F.col("o_orderstatus")
    store.publish(replace={"orders": orders.filter(status == "F")})
    tables = store.tables()
    absent = lambda t, df: exclude_existing(df, t["orders"], ["o_orderkey"])
    first, second = orders.filter(status == "O"), orders.filter(status != "F")
    store.publish(append={"orders": absent(tables, first)}, base=tables.version)
    conflicts = 0
    try:
        store.publish(append={"orders": absent(tables, second)}, base=tables.version)
    except Conflict:
        conflicts += 1
        tables = store.tables()
        store.publish(append={"orders": absent(tables, second)}, base=tables.version)
    return store.table("orders").withColumn("conflicts", F.lit(conflicts))


@query(
    "snapshot_compact",
    """SELECT o_orderkey, o_totalprice, 4 * 8 AS parts_before, 8 AS parts_after FROM orders""",
)
def compact(spark, d):
    """Appends leave a part per slot each; merging them keeps the rows."""
    store = _orders(spark)
    orders = table(spark, d, "orders")
    rows = orders.select("o_orderkey", "o_totalprice")
    for turn in range(4):
        some = F.col("o_custkey") % 4 == turn
        store.publish(append={"orders": orders.filter(some).select(*rows.columns)})
    before = len(store.tables().parts("orders"))
    store.compact("orders", most=1)
    tables = store.tables()
    return tables["orders"].withColumns({
        "parts_before": F.lit(before), "parts_after": F.lit(len(tables.parts("orders")))
    })


@query(
    "version_changes",
    """SELECT o_orderkey, o_orderstatus, o_totalprice + 5 AS o_totalprice, 'update' AS action
       FROM orders WHERE o_orderstatus = 'F'
       UNION ALL SELECT o_orderkey, o_orderstatus, o_totalprice, 'insert' FROM orders
       WHERE o_orderstatus = 'P'""",
)
def version_changes(spark, d):
    store = _orders(spark)
    orders = table(spark, d, "orders").select("o_orderkey", "o_orderstatus", "o_totalprice")
    held = F.col("o_orderstatus") == "P"
    since = store.publish(replace={"orders": orders.filter(~held)}).version
    base, raised = _raise(store, "F", 5)
    store.publish(rewrite=raised, base=base)
    store.publish(append={"orders": orders.filter(held)})
    return store.changes("orders", since).withColumnRenamed("_action", "action")


@query(
    "snapshot_statistics",
    """SELECT count(*) AS n, min(o_orderdate)::DATE AS first_day, max(o_orderdate)::DATE AS last_day,
         min(o_orderkey) AS first_key, max(o_orderkey) AS last_key,
         count(*) FILTER (WHERE o_orderdate >= DATE '2000-01-01') AS late FROM orders""",
)
def statistics(spark, d):
    """Counts and bounds from the manifest, and a range that skips the parts out of it."""
    store = _orders(spark)
    orders = table(spark, d, "orders").withColumn("o_orderdate", F.col("o_orderdate").cast("date"))
    late = F.col("o_orderdate") >= F.lit("2000-01-01").cast("date")
    store.publish(append={"orders": orders.filter(~late)})
    store.publish(append={"orders": orders.filter(late)})
    tables = store.tables()
    days, keys = tables.bounds("orders", "o_orderdate"), tables.bounds("orders", "o_orderkey")
    some = tables.between("orders", "o_orderdate", low=dt.date(2000, 1, 1)).filter(late)
    return some.agg(F.count(F.lit(1)).alias("late")).select(
        F.lit(tables.rows("orders")).cast("bigint").alias("n"),
        F.lit(days[0]).alias("first_day"), F.lit(days[1]).alias("last_day"),
        F.lit(keys[0]).cast("bigint").alias("first_key"), F.lit(keys[1]).cast("bigint").alias("last_key"), "late",
    )


# --- documents taken in ------------------------------------------------------------------


def _drop(root: str, documents: Landing, some) -> None:
    """Land the documents of some ids as JSON files."""
    for kind, key in (("details", "id"), ("credits", "movie_id"), ("persons", "id")):
        docs = getattr(documents, kind).filter(some(F.col(key))).drop(CORRUPT)
        write_json(docs, f"{root}/{kind}", mode="append", compression="gzip")


@query(
    "ledger_add_new",
    f"""{_early_sql(0)}
       SELECT id, CASE WHEN id IN (SELECT id FROM known) THEN 'old' ELSE title END AS title, release_date, runtime,
         2 AS publishes
       FROM details WHERE release_date IS NOT NULL AND (source <> 'src13' OR id IN (SELECT id FROM known))""",
)
def ledger_add_new(spark, d):
    """Two drops of documents, each taken in once and looked at by an add-new of its own."""
    store = SnapshotStore(spark, scratch_dir(spark, "ledger-store"), SLOTS)
    publish(store, Changes(replace=_early_catalog(spark, d)))
    root, documents = scratch_dir(spark, "ledger-landing"), landing(spark, d)
    publishes = 0
    for turn in (0, 1):
        _drop(root, documents, lambda key, turn=turn: key % 2 == turn)
        publishes += len(take_in(store, root))
        commit(store, lambda tables: add_new(tables, landing_of(tables), 36_500))
    assert not take_in(store, root)
    return store.table("movies").select("id", "title", "release_date", "runtime").withColumn(
        "publishes", F.lit(publishes)
    )


_CATEGORIES = f"(VALUES {', '.join(f'({c!r})' for c in ERROR_CATEGORIES)}) AS c(category)"
_COUNTED_SQL = f"""
  SELECT c.category, count(DISTINCT f.id) AS ids,
    count(*) FILTER (WHERE f.category IS NOT NULL AND f.id IS NULL) AS without_id
  FROM {_CATEGORIES} LEFT JOIN found f ON f.category = c.category GROUP BY c.category"""


@query(
    "error_summary_unreadable",
    f"""WITH found AS (
         SELECT 'processing_error' AS category, NULL::BIGINT AS id FROM documents WHERE n_chars % 7 = 0
         UNION ALL SELECT 'timeout', doc_id FROM documents WHERE n_chars % 7 = 1) {_COUNTED_SQL}""",
)
def unreadable_lines(spark, d):
    """Lines that do not parse are counted, though nobody knows their id."""
    chars = F.col("n_chars") % 7
    document = F.to_json(F.struct(
        F.col("doc_id").alias("id"), F.col("text").alias("title"),
        F.when(chars == 1, "timeout").otherwise("ok").alias("fetch_status"),
    ))
    root = scratch_dir(spark, "broken-landing")
    lines = F.when(chars == 0, F.concat(F.lit("{"), document)).otherwise(document)
    table(spark, d, "documents").select(lines.alias("value")).write.text(f"{root}/details")
    store = SnapshotStore(spark, scratch_dir(spark, "broken-store"), SLOTS)
    take_in(store, root)
    return error_counts(store.table("errors"))


_ADD_ERRORS_SQL = """
  SELECT 'timeout' AS category, id FROM added WHERE source = 'src5'
  UNION ALL SELECT 'no_credits', id FROM added WHERE id NOT IN (SELECT movie_id FROM credits)
  UNION ALL SELECT 'no_actors', id FROM added
    WHERE id NOT IN (SELECT movie_id FROM credits WHERE credit_type = 'cast')"""


@query("add_new_errors", f"{_early_sql(30)}, found AS ({_ADD_ERRORS_SQL}) {_COUNTED_SQL}")
def add_new_errors(spark, d):
    return error_counts(add_new(_early_catalog(spark, d), landing(spark, d), "month").errors())


@query(
    "sync_errors",
    f"""{_early_sql(7)}, found AS (
         SELECT 'timeout' AS category, id FROM known WHERE source = 'src5'
         UNION ALL SELECT 'no_credits', id FROM known WHERE source = 'src9'
         UNION ALL {_ADD_ERRORS_SQL}) {_COUNTED_SQL}""",
)
def sync_errors(spark, d):
    """The errors of both jobs of a sync, as published with them."""
    store = SnapshotStore(spark, scratch_dir(spark, "sync-store"))
    publish(store, Changes(replace=_early_catalog(spark, d)))
    sync(store, landing(spark, d), "week", AS_OF)
    return error_counts(store.table("errors"))


@query(
    "stream_errors",
    f"""WITH {DETAILS_SQL}, {CREDITS_SQL}, found AS (
         SELECT 'timeout' AS category, id FROM details WHERE source = 'src5'
         UNION ALL SELECT 'processing_error', NULL FROM benchmark
         UNION ALL SELECT 'no_credits', id FROM details WHERE id NOT IN (SELECT movie_id FROM credits))
       {_COUNTED_SQL}""",
)
def stream_errors(spark, d):
    root, documents = scratch_dir(spark, "stream-landing"), landing(spark, d)
    _drop(root, documents, lambda key: key >= 0)
    broken = table(spark, d, "benchmark").select(F.concat(F.lit("{"), F.col("item_id")).alias("value"))
    broken.write.mode("append").text(f"{root}/details")
    store = SnapshotStore(spark, scratch_dir(spark, "stream-store"), SLOTS)
    publish(store, Changes(replace=jobs.empty_tables(spark)))
    stream_catalog(spark, root, store, scratch_dir(spark, "stream-checkpoint"), lambda: AS_OF).awaitTermination()
    return error_counts(store.table("errors"))


# --- counters -------------------------------------------------------------------------


def _counters(spark: SparkSession, done: Published) -> DataFrame:
    """What a publish counted while writing: one row per table."""
    rows = [(name, *[n[k] for k in ("insert", "update", "unchanged", "delete")]) for name, n in done.counters.items()]
    return spark.createDataFrame(
        rows, "table_name string, inserted bigint, updated bigint, unchanged bigint, deleted bigint"
    )


@query(
    "refresh_counters",
    f"""WITH {CREDITS_SQL}, {GENRES_SQL}, {PEOPLE_SQL}, {DETAILS_SQL.lstrip()},
       refreshed AS (SELECT * FROM details WHERE source <> 'src9'),
       fresh AS (SELECT id IN (SELECT s_suppkey FROM supplier) AS known FROM persons
         WHERE id IN (SELECT person_id FROM credits))
       SELECT 'movies' AS table_name, 0::BIGINT AS inserted, count(*) AS updated,
         0::BIGINT AS unchanged, 0::BIGINT AS deleted FROM refreshed
       UNION ALL SELECT 'credits', (SELECT count(*) FROM credits), 0, 0, count(*) FROM refreshed
       UNION ALL SELECT 'genres', (SELECT count(*) FROM genres JOIN refreshed ON id = movie_id), 0, 0, count(*) FROM refreshed
       UNION ALL SELECT 'people', count(*) FILTER (WHERE NOT known), count(*) FILTER (WHERE known), 0, 0 FROM fresh""",
)
def refresh_counters(spark, d):
    store = SnapshotStore(spark, scratch_dir(spark, "refresh-store"), SLOTS)
    publish(store, Changes(replace=_stale_catalog(spark, d)))
    return _counters(spark, commit(store, lambda tables: refresh(tables, landing(spark, d), AS_OF)))


@query(
    "add_new_counters",
    f"""{_early_sql(30)},
       new_credits AS (SELECT * FROM credits WHERE movie_id IN (SELECT id FROM added))
       SELECT 'movies' AS table_name, count(*) AS inserted, 0::BIGINT AS updated, 0::BIGINT AS unchanged,
         0::BIGINT AS deleted FROM added
       UNION ALL SELECT 'credits', count(*), 0, 0, 0 FROM new_credits
       UNION ALL SELECT 'genres', count(*), 0, 0, 0 FROM genres WHERE movie_id IN (SELECT id FROM added)
       UNION ALL SELECT 'people', count(*), 0, 0, 0 FROM persons WHERE id IN (SELECT person_id FROM new_credits)""",
)
def add_new_counters(spark, d):
    store = SnapshotStore(spark, scratch_dir(spark, "add-store"), SLOTS)
    publish(store, Changes(replace=_early_catalog(spark, d)))
    return _counters(spark, commit(store, lambda tables: add_new(tables, landing(spark, d), "month")))


@query(
    "stream_fresh_latest",
    """WITH fetched AS (
         SELECT user_id, ts, event_id FROM events
         UNION ALL SELECT user_id, (SELECT max(ts) FROM events) + INTERVAL 1 DAY, event_id FROM events
           WHERE event_type = 'view')
       SELECT user_id, max(ts) AS ts, CAST(max_by(event_id, (ts, event_id)) AS BIGINT) AS event_id,
         count(*) AS fetches FROM fetched GROUP BY user_id""",
)
def fresh_latest_stream(spark, d):
    """Four deliveries: all events, the same again, old ones under new ids (late, dropped), and new ones."""
    events = table(spark, d, "events").select("user_id", "ts", "event_id")
    newest = events.agg(F.max("ts").alias("newest"))
    views = table(spark, d, "events").where("event_type = 'view'").crossJoin(F.broadcast(newest))
    late = events.select("user_id", (F.col("ts") - F.expr("INTERVAL 400 DAYS")).alias("ts"), "event_id")
    new = views.select("user_id", (F.col("newest") + F.expr("INTERVAL 1 DAY")).alias("ts"), "event_id")
    inbox, done = scratch_dir(spark, "fetches"), scratch_dir(spark, "fresh")
    checkpoint = scratch_dir(spark, "fresh-checkpoint")
    for delivery in (events, events, late, new):
        delivery.write.mode("append").parquet(inbox)
        rows = spark.readStream.schema(events.schema).parquet(inbox)
        fresh = fresh_fetches(rows, ["user_id", "event_id"], "ts", "1 hour")
        out = fresh.writeStream.option("checkpointLocation", checkpoint).trigger(availableNow=True)
        out.format("parquet").outputMode("append").start(done).awaitTermination()
    return spark.read.parquet(done).groupBy("user_id").agg(
        F.max("ts").alias("ts"), F.max_by("event_id", F.struct("ts", "event_id")).alias("event_id"),
        F.count(F.lit(1)).alias("fetches"),
    )


_PART_TITLES = {"table": "part", "id_": "p_partkey", "title": "p_name"}


def _indexed_parts(spark: SparkSession, d: str) -> tuple[SnapshotStore, DataFrame]:
    """A store of the parts whose index covers those of even keys."""
    keys = {"part": ["p_partkey"], **SIDE_KEYS}
    store = SnapshotStore(
        spark, scratch_dir(spark, "part-store"), SLOTS, bucket_keys={"part": "p_partkey"}, keys=keys
    )
    parts = table(spark, d, "part").select("p_partkey", "p_name", "p_retailprice")
    even = F.col("p_partkey") % 2 == 0
    store.publish(replace={"part": parts.filter(even)})
    extend(store, **_PART_TITLES)
    store.publish(append={"part": parts.filter(~even)})
    return store, parts


@query("title_index_search", "SELECT p_partkey, p_name, p_retailprice FROM part WHERE contains(lower(p_name), 'ring')")
def title_index_search(spark, d):
    """Posting lists for the indexed half, titles for the parts written since."""
    store, _ = _indexed_parts(spark, d)
    return find_titles(store.tables(), "Ring", popularity="p_retailprice", **_PART_TITLES)


@query(
    "title_index_renamed",
    """SELECT p_partkey, concat(p_name, ' mk2') AS p_name, p_retailprice FROM part WHERE p_partkey % 5 = 0
         AND contains(lower(concat(p_name, ' mk2')), 'gear mk')
       ORDER BY p_retailprice DESC, p_partkey LIMIT 100""",
)
def title_index_renamed(spark, d):
    """Renamed rows are listed anew, what they no longer contain is not found; the first page of matches."""
    store, parts = _indexed_parts(spark, d)
    renamed = parts.filter(F.col("p_partkey") % 5 == 0).select(
        "p_partkey", F.concat("p_name", F.lit(" mk2")).alias("p_name")
    )
    change = Rewrite(
        lambda: renamed.select("p_partkey"), lambda rows: update_tagged(rows, renamed, ["p_partkey"], ["p_name"])
    )
    store.publish(rewrite={"part": change}, base=store.version())
    extend(store, **_PART_TITLES)
    return find_titles(store.tables(), "Gear mk", 100, popularity="p_retailprice", **_PART_TITLES)
