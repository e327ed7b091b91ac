"""Landing files taken in once: a ledger of files, and typed documents beside the catalog.

``take_in`` lists the landing zone, leaves out the files that the ledger names, parses the others and
publishes their documents, the errors found in them and their ledger rows in one version. Jobs then
read documents from Parquet by the columns they need, never a JSON line twice. Documents are dealt
into slots by id like the catalog, so the documents of a few films are looked up without reading
the others. All fetches of an id are kept until ``forget_superseded``; readers take the newest.

Credits are taken apart on arrival: what is stored, sorted and joined is the list of credits that
the catalog keeps, not the whole cast and crew.
"""

from __future__ import annotations

import datetime as dt
import re
from collections.abc import Mapping
from dataclasses import replace as changed

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from catalog_sync.operators.dedup import union_rows
from catalog_sync.operators.joins import keep_unknown, key_set
from catalog_sync.operators.quality import error_rows, fetch_errors
from catalog_sync.operators.shape import TIE, good_documents, good_fetch, listed_credits, newest_documents
from catalog_sync.plans.jobs import Changes, Landing, commit, publish, sync_arrived
from catalog_sync.schemas import CORRUPT, LANDED_FILES, MAX_CAST
from catalog_sync.scratch import stage
from catalog_sync.sources.landing import DOCUMENTS, parse_documents
from catalog_sync.sources.snapshots import Conflict, Published, Rewrite, Snapshot, SnapshotStore, Written

#: Document kind -> its id.
IDS = {"details": "id", "credits": "movie_id", "persons": "id"}
MOST_FILES = 50_000


def list_files(spark: SparkSession, root: str) -> DataFrame:
    """The files of the landing zone: path, kind, bytes, time. Their contents are not opened."""
    found = spark.createDataFrame([], "path string, kind string, bytes bigint, modified timestamp")
    for kind in DOCUMENTS:
        folder = spark._jvm.org.apache.hadoop.fs.Path(f"{root.rstrip('/')}/{kind}")
        if not folder.getFileSystem(spark._jsc.hadoopConfiguration()).exists(folder):
            continue
        files = spark.read.format("binaryFile").load(folder.toString())
        found = found.union(files.select("path", F.lit(kind), "length", "modificationTime"))
    return found


def arrived(lines: DataFrame, kind: str, max_cast: int | None = MAX_CAST) -> tuple[DataFrame, DataFrame]:
    """(documents, errors) of JSON lines of a kind, parsed once. Documents are as they are stored."""
    docs = parse_documents(lines, "value", kind)
    if kind == "pages":
        docs = stage(docs, "arrived-pages")
        bad = docs.filter(F.col(CORRUPT).isNotNull())
        errors = error_rows(bad, "processing_error", kind, F.lit(None), F.col(CORRUPT))
        return docs.filter(F.col(CORRUPT).isNull()).drop(CORRUPT), errors
    key, docs = IDS[kind], stage(_as_stored(docs, kind, max_cast), f"arrived-{kind}")
    return good_documents(docs, key), fetch_errors(docs, key, kind)


def landed(
    store: SnapshotStore, lines: DataFrame, kind: str, max_cast: int | None = MAX_CAST
) -> tuple[Written, DataFrame]:
    """The same with the documents written where they are kept, once and before their publish."""
    key, docs = IDS[kind], _as_stored(parse_documents(lines, "value", kind), kind, max_cast)
    columns = good_documents(docs, key).columns
    written = store.write_ahead(f"landed_{kind}", docs, columns, good_fetch(docs, key))
    return written, fetch_errors(written.rest, key, kind)


def _as_stored(docs: DataFrame, kind: str, max_cast: int | None) -> DataFrame:
    key = IDS[kind]
    tie = F.xxhash64(*[c for c in docs.columns if c not in (key, "fetched_at", CORRUPT)]).alias(TIE)
    kept = [F.col(c) for c in docs.columns if c not in ("cast", "crew")]
    if kind == "credits":
        kept.append(listed_credits(docs, max_cast=max_cast))
    return docs.select(*kept, tie)


def take_in(
    store: SnapshotStore,
    root: str,
    max_cast: int | None = MAX_CAST,
    most_files: int = MOST_FILES,
    attempts: int = 5,
) -> list[Published]:
    """Take in the landing files that the ledger does not name yet, up to ``most_files`` a publish.

    A file is known by its path: one that is written to afterwards is not read again. Of two runs
    that take in the same file the later fails on the ledger's key and starts again without it."""
    done: list[Published] = []
    while attempts:
        tables = store.tables()
        changes = _new_files(store.spark, tables, root, max_cast, most_files)
        if changes is None:
            return done
        try:
            done.append(publish(store, changes, "take-in"))
        except Conflict:
            attempts -= 1
    raise Conflict(f"other runs keep taking in the files of {root}")


def _new_files(
    spark: SparkSession, tables: Snapshot, root: str, max_cast: int | None, most_files: int
) -> Changes | None:
    files = list_files(spark, root)
    if LANDED_FILES in tables:
        files = keep_unknown(files, tables[LANDED_FILES], ["path"], unique=True)
    files = stage(files.orderBy("modified", "path").limit(most_files), "new-files")
    append: dict[str, DataFrame] = {}
    errors = []
    for kind in DOCUMENTS:
        # A reader takes its files as a list; it is bounded by ``most_files``.
        paths = [re.sub(r"([\[\]{}*?\\])", r"\\\1", r.path) for r in files.filter(F.col("kind") == kind).collect()]
        if paths:
            append[f"landed_{kind}"], bad = arrived(spark.read.text(paths), kind, max_cast)
            errors.append(bad)
    if not append:
        return None
    append[LANDED_FILES] = files
    return Changes(append=append, errors=lambda: union_rows(*errors), base=tables.version)


def landing_of(tables: Snapshot) -> Landing:
    """The documents taken in so far, as jobs read them."""
    spark = tables.store.spark
    found = {kind: tables.get(f"landed_{kind}") for kind in DOCUMENTS}
    for kind in ("details", "credits"):
        if found[kind] is None:
            found[kind], _ = arrived(spark.createDataFrame([], "value string"), kind)
    return Landing(**found)


def forget_superseded(store: SnapshotStore, kinds: Mapping[str, str] = IDS) -> Published:
    """Rewrite the documents to the newest fetch of each id."""
    tables = store.tables()
    rewrite = {}
    for kind, key in kinds.items():
        name = f"landed_{kind}"
        if name in tables:
            rewrite[name] = Rewrite(
                lambda name=name, key=key: key_set(tables[name], [key]), lambda rows, key=key: _newest(rows, key)
            )
    return store.publish(rewrite=rewrite, base=tables.version)


def _newest(rows: DataFrame, key: str) -> DataFrame:
    tied = rows.withColumn("_kept", F.col(TIE))
    return newest_documents(tied, key).withColumnRenamed("_kept", TIE).select(*rows.columns)


def sync_lines(
    store: SnapshotStore, lines: DataFrame, as_of: dt.datetime, max_cast: int | None = MAX_CAST, **stream
) -> Published | None:
    """Take in JSON lines (``kind``, ``value``) and bring the catalog up to date with them, in one
    version: documents, films, people and errors. A line is read once, for its kind."""
    found = {kind: landed(store, lines.filter(F.col("kind") == kind), kind, max_cast) for kind in IDS}
    new = {kind: docs for kind, (docs, _) in found.items()}
    errors = [bad for _, bad in found.values()]

    def job(tables: Snapshot) -> Changes:
        changes = sync_arrived(tables, new, as_of)
        append = changes.append | {f"landed_{kind}": docs for kind, docs in new.items()}
        films = changes.append["movies"].select("id")
        waiting = keep_unknown(films, changes.append["credits"], {"id": "movie_id"})
        bare = error_rows(waiting, "no_credits", "sync", "id")
        return changed(changes, append=append, errors=lambda: union_rows(*errors, bare))

    return commit(store, job, name="stream", **stream)
