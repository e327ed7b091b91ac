"""New landing files -> newest row per key -> upsert into the snapshot store.

Each micro-batch is one publish that records the checkpoint's id and the batch number, so a batch
replayed after a failure is recognised and skipped. Batches are upserts by newest fetch: a new
checkpoint reapplies them all without harm (documents are then kept twice until they are compacted). ``availableNow`` makes a run take what is there and stop,
which is how a scheduler drives a sync; a processing-time trigger keeps it running.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from catalog_sync.operators.dedup import fresh_latest
from catalog_sync.operators.joins import existing_keys
from catalog_sync.operators.upsert import upsert_tagged
from catalog_sync.plans.jobs import around
from catalog_sync.plans.ledger import IDS, sync_lines
from catalog_sync.schemas import MAX_CAST
from catalog_sync.scratch import stage
from catalog_sync.sources.snapshots import Conflict, Rewrite, SnapshotStore

ATTEMPTS = 5


def stream_id(batch: DataFrame, name: str) -> str:
    """The id that the query keeps in its checkpoint: batch numbers count within it only, so
    a new checkpoint applies everything again, and streams into one table do not hide each other."""
    query = batch.sparkSession.sparkContext.getLocalProperty("sql.streaming.queryId")
    return f"{name}@{query}"


def _start(
    rows: DataFrame,
    store: SnapshotStore,
    name: str,
    checkpoint: str,
    apply: Callable[[DataFrame, dict], None],
    trigger: dict,
) -> StreamingQuery:
    def once(batch: DataFrame, batch_id: int) -> None:
        stream = stream_id(batch, name)
        if batch_id > store.last_batch(stream):
            apply(batch, {"stream": stream, "batch": batch_id})

    writer = rows.writeStream.queryName(name).option("checkpointLocation", checkpoint)
    return writer.trigger(**(trigger or {"availableNow": True})).foreachBatch(once).start()


def fresh_fetches(rows: DataFrame, keys: Sequence[str], fetched_at: str, delay: str) -> DataFrame:
    """A stream of fetches without those delivered again and those that come late.

    A fetch is known by its keys and time. Fetches more than ``delay`` behind the newest time of earlier batches
    are left out, and the state of older ones is dropped with that, so it holds the fetches of one delay
    however long the stream runs. Give a delay beyond which a fetch is stale whatever it says: what
    must not be lost is the upsert's work, which takes late rows of new keys too. A row without time is a
    fetch of its own time, NULL, and is neither late nor kept for longer than a batch.
    """
    at = "__fetched_at"
    timed = rows.withColumn(at, F.col(fetched_at).cast("timestamp")).withWatermark(at, delay)
    return timed.dropDuplicatesWithinWatermark([*keys, fetched_at]).drop(at)


def stream_upsert(
    rows: DataFrame,
    store: SnapshotStore,
    table: str,
    keys: Sequence[str],
    fetched_at: str,
    checkpoint: str,
    tie_break: Sequence[str] = (),
    delay: str | None = None,
    **trigger,
) -> StreamingQuery:
    """Keep ``table`` at the newest row per key, whatever order the files arrive in. With ``delay`` repeated
    and late fetches are dropped before anything is looked up (``fresh_fetches``). A batch of
    unknown keys only is appended; otherwise the slots of its keys are rewritten (the table, if it
    has none). A batch that another publish got in the way of is applied again."""
    order = [F.col(c).desc() for c in tie_break]

    def apply(batch: DataFrame, mark: dict) -> None:
        source = stage(fresh_latest(batch, keys, fetched_at, tie_break=order), f"{table}-batch")
        columns = [c for c in source.columns if c not in keys]
        first = store.keys.get(table, list(keys))[0]
        rewrite = Rewrite(
            lambda: source.select(first).distinct(),
            lambda rows: upsert_tagged(rows, source, keys, columns, newest_by=fetched_at),
        )
        for left in reversed(range(ATTEMPTS)):
            tables = store.tables()
            try:
                if table not in tables:
                    store.publish(replace={table: source}, base=tables.version, **mark)
                elif existing_keys(source.select(*keys), around(tables, table, source.select(first)), keys).isEmpty():
                    store.publish(append={table: source}, base=tables.version, **mark)
                else:
                    store.publish(rewrite={table: rewrite}, base=tables.version, **mark)
                return
            except Conflict:
                if not left:
                    raise

    if delay is not None:
        rows = fresh_fetches(rows, [*keys, *tie_break], fetched_at, delay)
    return _start(rows, store, table, checkpoint, apply, trigger)


def stream_catalog(
    spark: SparkSession,
    landing_root: str,
    store: SnapshotStore,
    checkpoint: str,
    now: Callable[[], dt.datetime] = dt.datetime.now,
    max_cast: int | None = MAX_CAST,
    **trigger,
) -> StreamingQuery:
    """Sync the four catalog tables as documents land. A film is synced when its details or its
    credits arrive, whichever comes last; a person who arrives later than the credits that mention
    them is added then. A batch parses the lines that arrived, writes their documents beside the catalog,
    reads them from there and looks up earlier ones by slot; all of it is one publish, so no version holds
    films without their people."""
    root = landing_root.rstrip("/")

    def arriving(kind: str) -> DataFrame:
        return spark.readStream.text(f"{root}/{kind}").select("value", F.lit(kind).alias("kind"))

    kinds = [arriving(kind) for kind in IDS]
    lines = kinds[0].union(kinds[1]).union(kinds[2])

    def apply(batch: DataFrame, mark: dict) -> None:
        sync_lines(store, batch, now(), max_cast, **mark)

    return _start(lines, store, "catalog", checkpoint, apply, trigger)
