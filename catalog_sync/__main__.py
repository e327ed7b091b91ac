"""Run a job on a snapshot store: ``python -m catalog_sync <command> --store PATH ...``."""

from __future__ import annotations

import argparse
import datetime as dt
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from catalog_sync.operators.incremental import above_id
from catalog_sync.operators.quality import error_samples, error_summary, key_audit, table_profile
from catalog_sync.plans import jobs
from catalog_sync.plans.jobs import Changes, Landing
from catalog_sync.plans.ledger import forget_superseded, landing_of, take_in
from catalog_sync.plans.titles import extend, find_titles
from catalog_sync.schemas import FOREIGN_KEYS, KEYS, MAX_CAST
from catalog_sync.sources.csv_files import write_catalog
from catalog_sync.sources.snapshots import Published, Snapshot, SnapshotStore
from catalog_sync.streaming import stream_catalog


def _parser() -> argparse.ArgumentParser:
    parser = argparse.ArgumentParser(prog="catalog_sync", description=__doc__)
    commands = parser.add_subparsers(dest="command", required=True)

    def command(name: str, help_: str, landing: bool = True) -> argparse.ArgumentParser:
        sub = commands.add_parser(name, help=help_)
        sub.add_argument("--store", required=True, help="folder of the published tables")
        sub.add_argument("--buckets", type=int, default=0, help="deal new tables into so many slots by id")
        if landing:
            sub.add_argument("--landing", required=True, help="folder with details/credits/persons, maybe pages")
            sub.add_argument("--max-cast", type=int, default=MAX_CAST, help="actors kept per movie")
        return sub

    build = command("build", "documents to the four tables")
    build.add_argument("--csv", help="also write the tables as CSV files here")
    build.add_argument("--year", type=int, help="only movies released in this year")
    build.add_argument("--since-id", type=int, help="only ids above this one")
    build.add_argument("--max-pages", type=int, help="with --year: so many pages of 20, most popular first")
    load = command("load-csv", "CSV files to the four tables", landing=False)
    load.add_argument("--csv", required=True)
    load.add_argument("--initial", action="store_true", help="empty the tables first")
    refresh = command("refresh", "update all movies, or the given ids")
    refresh.add_argument("--id", type=int, nargs="*", default=[])
    add = command("add-new", "add movies released since the newest known one")
    add.add_argument("--period", help="look-back: day, week, month or a number of days")
    search = command("search", "list matching movies, add one of them with --select")
    search.add_argument("query")
    search.add_argument("--select", type=int, default=0)
    search.add_argument("--page", type=int, default=1)
    search.add_argument("--page-size", type=int, default=20)
    sync = command("sync", "refresh, then add-new")
    sync.add_argument("--period", default="week")
    stream = command("stream", "sync new landing files, then stop")
    stream.add_argument("--checkpoint", required=True)
    command("report", "columns, row counts, key and reference checks", landing=False)
    command("compact", "merge small parts, forget superseded documents", landing=False)
    command("index-titles", "list the titles written since the last time", landing=False)
    titles = command("titles", "movies of the catalog by title or id", landing=False)
    titles.add_argument("query")
    titles.add_argument("--page", type=int, default=1)
    titles.add_argument("--page-size", type=int, default=20)
    changes = command("changes", "rows of a table that differ between two versions", landing=False)
    changes.add_argument("table")
    changes.add_argument("--since", type=int, required=True)
    changes.add_argument("--until", type=int)
    return parser


def _print(df: DataFrame) -> None:
    """All rows, one JSON object a line."""
    for row in df.toJSON().toLocalIterator():
        print(row)


def _report(published: list[Published | None]) -> None:
    """What was written and counted, and the errors logged with it."""
    for done in published:
        print(done or "nothing to do")
        if done and done.log is not None:
            error_summary(done.log).show(truncate=False)
            error_samples(done.log).show(truncate=False)


def _requested(
    landing: Landing, year: int | None, since_id: int | None, max_pages: int | None
) -> DataFrame | None:
    if year:
        return jobs.discover(landing, year=year, since_id=since_id, max_pages=max_pages)
    return above_id(landing.details.select("id"), "id", since_id) if since_id else None


def main(argv: list[str] | None = None) -> None:
    args = _parser().parse_args(argv)
    spark = SparkSession.builder.appName(f"catalog_sync {args.command}").getOrCreate()
    store = SnapshotStore(spark, args.store, args.buckets)
    now = dt.datetime.now()
    if "landing" in args and args.command != "stream":
        _report(take_in(store, args.landing, args.max_cast))
    cast = {"max_cast": args.max_cast} if "max_cast" in args else {}

    def run(job: Callable[[Snapshot], Changes]) -> None:
        _report([jobs.commit(store, job, name=args.command)])

    if args.command == "build":
        landing = landing_of(store.tables())
        requested = _requested(landing, args.year, args.since_id, args.max_pages)
        changes = jobs.initial_build(landing, requested, **cast)
        if args.csv:
            write_catalog(changes.replace, args.csv)
        _report([jobs.publish(store, changes, "build")])
    elif args.command == "load-csv":
        run(lambda tables: jobs.load_csv(spark, args.csv, None if args.initial else tables))
    elif args.command == "refresh":
        ids = spark.createDataFrame([(i,) for i in args.id], "id BIGINT") if args.id else None
        run(lambda tables: jobs.refresh(tables, landing_of(tables), now, ids, **cast))
    elif args.command == "add-new":
        run(lambda tables: jobs.add_new(tables, landing_of(tables), args.period, **cast))
    elif args.command == "search":
        chosen = (args.query, args.select, args.page_size, args.page)
        if args.select:
            run(lambda tables: jobs.search_and_add(tables, landing_of(tables), *chosen))
        else:
            tables = jobs.current_tables(store)
            page = jobs.search(tables, landing_of(tables), args.query, args.page_size, args.page)
            lines = page.orderBy(F.col("ordinal"))
            _print(lines.select("line", "genre_line"))
    elif args.command == "sync":
        _report(jobs.sync(store, landing_of(store.tables()), args.period, now, **cast))
    elif args.command == "stream":
        stream_catalog(spark, args.landing, store, args.checkpoint, **cast).awaitTermination()
    elif args.command == "compact":
        _report([forget_superseded(store), *[store.compact(name) for name in store.tables()]])
    elif args.command == "index-titles":
        _report([extend(store)])
    elif args.command == "titles":
        _print(find_titles(store.tables(), args.query, args.page_size, args.page))
    elif args.command == "changes":
        _print(store.changes(args.table, args.since, args.until))
    else:
        tables = jobs.current_tables(store)
        tables = {name: tables[name] for name in KEYS}
        _print(table_profile(tables))
        _print(key_audit(tables, KEYS, FOREIGN_KEYS))


if __name__ == "__main__":
    main()
