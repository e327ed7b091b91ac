"""Files in and out: CSV, JSON, snapshots, table definitions, streams."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import functions as F

from catalog_sync.functions import literal_for
from catalog_sync.operators.dedup import ORDINAL
from catalog_sync.plans.registry import query, table
from catalog_sync.scratch import scratch_dir
from catalog_sync.sources.csv_files import read_text_cells, write_text_cells
from catalog_sync.sources.definitions import create_statement, run_script
from catalog_sync.sources.landing import read_json, read_json_stream, write_json
from catalog_sync.sources.snapshots import SnapshotStore
from catalog_sync.streaming.sync import stream_upsert


@query("csv_round_trip", "SELECT doc_id, text, lang, source, n_chars FROM documents")
def csv_round_trip(spark, d):
    documents = table(spark, d, "documents")
    path = scratch_dir(spark, "csv")
    write_text_cells(documents.select(*[F.col(c).cast("string") for c in documents.columns]), path)
    cells = read_text_cells(spark, path).drop(ORDINAL)
    kinds = dict(documents.dtypes)
    return cells.select(*[F.col(c).try_cast(kinds[c]).alias(c) for c in documents.columns])


@query(
    "csv_mixed_headers",
    """SELECT doc_id, lang, CASE WHEN doc_id % 3 <> 0 THEN source END AS source FROM documents""",
)
def csv_mixed_headers(spark, d):
    """Files of one folder with other column orders, and one kind that lacks a column."""
    cells = table(spark, d, "documents").select(F.col("doc_id").cast("string"), "lang", "source")
    path = scratch_dir(spark, "csv")
    turn = F.col("doc_id").cast("long") % 3
    write_text_cells(cells.filter(turn == 0).drop("source"), path)
    write_text_cells(cells.filter(turn == 1).select("source", "doc_id", "lang"), path, "append")
    write_text_cells(cells.filter(turn == 2), path, "append")
    return read_text_cells(spark, path).select(
        F.col("doc_id").cast("long").alias("doc_id"), "lang", "source"
    )


@query(
    "csv_bad_lines",
    r"""SELECT 'kept' AS state, count(*) AS n, count(text) AS texts,
               coalesce(sum(length(text)), 0)::BIGINT AS chars
        FROM (SELECT CASE WHEN doc_id % 4 <> 1 THEN replace(text, '"', '') || '\end' END AS text
              FROM documents WHERE doc_id % 4 <> 3)
        UNION ALL
        SELECT 'overlong', count(*), 0, 0 FROM documents WHERE doc_id % 4 = 3""",
)
def csv_bad_lines(spark, d):
    """Padding and backslashes, short lines (no text) and lines with a field too many."""
    documents = table(spark, d, "documents")
    escaped = lambda c: F.replace(F.replace(c, F.lit("\\"), F.lit("\\\\")), F.lit('"'), F.lit('""'))
    quoted = lambda c: F.concat(F.lit('"'), escaped(c), F.lit('"'))
    kind = F.col("doc_id") % 4
    key = quoted(F.col("doc_id").cast("string"))
    cell = quoted(F.concat(F.replace("text", F.lit('"')), F.lit("\\end")))
    line = (
        F.when(kind == 1, key)
        .when(kind == 3, F.concat_ws(",", key, cell, F.lit('"extra"')))
        .otherwise(F.concat(key, F.lit(",  "), cell))
    )
    path = scratch_dir(spark, "csv")
    documents.select(line.alias("doc_id,text")).write.options(
        header="true", quote="", escape="\u0002", sep="\u0001", ignoreLeadingWhiteSpace="false",
        ignoreTrailingWhiteSpace="false",
    ).csv(path)
    kept = read_text_cells(spark, path)
    over = read_text_cells(spark, path, overlong=True)
    count = lambda df, state: df.select(
        F.lit(state).alias("state"), F.count(F.lit(1)).alias("n"), F.count("text").alias("texts"),
        F.coalesce(F.sum(F.length("text")), F.lit(0)).cast("long").alias("chars"),
    )
    lost = over.withColumn("text", F.lit(None).cast("string"))
    return count(kept, "kept").union(count(lost, "overlong"))


@query("json_landing", "SELECT event_id, ts, user_id, event_type, value, props FROM events")
def json_landing(spark, d):
    events = table(spark, d, "events")
    path = scratch_dir(spark, "json")
    write_json(events, path)
    schema = ", ".join(f"{c} {t}" for c, t in events.dtypes)
    return read_json(spark, path, schema)


@query("multi_file_scan", "SELECT * FROM lineitem")
def multi_file_scan(spark, d):
    lines = table(spark, d, "lineitem")
    path = scratch_dir(spark, "parts")
    lines.filter(F.col("l_returnflag") == "R").write.parquet(f"{path}/returned")
    lines.filter(F.col("l_returnflag") != "R").write.parquet(f"{path}/kept")
    return spark.read.schema(lines.schema).parquet(f"{path}/returned", f"{path}/kept")


@query(
    "snapshot_publish",
    """SELECT 'first' AS state, o_orderkey, o_totalprice FROM orders WHERE o_orderstatus = 'F'
       UNION ALL SELECT 'appended', o_orderkey, o_totalprice FROM orders
       UNION ALL SELECT 'replaced', o_orderkey, o_totalprice + 1 FROM orders""",
)
def snapshots(spark, d):
    orders = table(spark, d, "orders").select("o_orderkey", "o_totalprice", "o_orderstatus")
    final = F.col("o_orderstatus") == "F"
    store = SnapshotStore(spark, scratch_dir(spark, "store"))
    store.publish(replace={"orders": orders.filter(final).drop("o_orderstatus")})
    store.publish(append={"orders": orders.filter(~final).drop("o_orderstatus")})
    raised = store.table("orders").withColumn("o_totalprice", F.col("o_totalprice") + 1)
    store.publish(replace={"orders": raised})
    frames = [
        store.table("orders", v).withColumn("state", F.lit(s))
        for v, s in [(1, "first"), (2, "appended"), (3, "replaced")]
    ]
    return frames[0].unionByName(frames[1]).unionByName(frames[2])


@query("schema_ddl", "SELECT * FROM customer")
def schema_ddl(spark, d):
    customers = table(spark, d, "customer")
    location = scratch_dir(spark, "table")
    name = "t_" + location.rsplit("-", 1)[-1]
    columns = ", ".join(f"{c} {t}" for c, t in customers.dtypes)
    statement = create_statement(name, columns, location)
    run_script(spark, f"{statement};\n{statement};\n")
    customers.write.insertInto(name)
    loaded = spark.read.table(name)
    return loaded


@query(
    "sync_stream",
    """SELECT * FROM events
       QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) = 1""",
)
def sync_stream(spark, d):
    events = table(spark, d, "events")
    schema = ", ".join(f"{c} {t}" for c, t in events.dtypes)
    root = scratch_dir(spark, "stream")
    middle = literal_for(events, "ts", dt.datetime(2024, 1, 15))
    store = SnapshotStore(spark, f"{root}/store")
    # The newer half lands first, so the second run must not overwrite newer rows.
    for drop in (F.col("ts") >= middle, F.col("ts") < middle):
        write_json(events.filter(drop), f"{root}/landing", mode="append")
        arriving = read_json_stream(spark, f"{root}/landing", schema)
        run = stream_upsert(
            arriving, store, "events", ["user_id"], "ts", f"{root}/checkpoint", ["event_id"]
        )
        run.awaitTermination()
    return store.table("events").select(*events.columns)
