"""The jobs: initial build, CSV load, refresh, add-new, search-and-add, discovery, sync.

A job takes the current tables (a dict of DataFrames, empty for a new catalog) and landing
documents, and returns ``Changes``: which tables to replace, which rows to rewrite or append, and the
errors met. Only ``publish`` writes tables; ``commit`` runs a job and publishes it, again from the start
where another publish got in between. Frames that feed several outputs are staged once.
"""

from __future__ import annotations

import datetime as dt
import uuid
from collections.abc import Callable, Mapping
from dataclasses import dataclass, field, replace as changed
from functools import cache

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from catalog_sync.functions import parse_date, parse_number, period_start
from catalog_sync.operators.dedup import ORDINAL, first_wins, union_ids, union_rows
from catalog_sync.operators.incremental import (
    discover_ids,
    exclude_flags,
    listing,
    newest_first,
    page_results,
    since,
    is_id,
    title_search,
    watermark,
)
from catalog_sync.operators.joins import (
    enrich,
    exclude_existing,
    existing_keys,
    keep_known,
    keep_listed,
    keep_unknown,
    key_set,
    sized,
)
from catalog_sync.operators.places import FILE, PLACE, bitmaps, rows_at
from catalog_sync.operators.quality import (
    FAILED_RULE,
    check,
    childless,
    error_rows,
    fetch_errors,
    movie_rules,
)
from catalog_sync.operators.shape import (
    CREDIT_LIST,
    credit_rows,
    explode_children,
    genre_names,
    genre_rows,
    genre_string,
    good_documents,
    latest_documents,
    listed_credits,
    needed_people,
    newest_documents,
    typed_movie_columns,
    typed_movies,
    usable_id,
)
from catalog_sync.operators.upsert import (
    ACTION,
    ignoring_duplicates,
    replace_children_tagged,
    update_tagged,
    upsert,
    upsert_tagged,
)
from catalog_sync.schemas import (
    CORRUPT,
    CSV_COLUMNS,
    ERRORS,
    KEYS,
    MAX_CAST,
    MENTIONED,
    REQUIRED_FIELDS,
    TABLES,
    UPDATABLE_MOVIE_COLUMNS,
)
from catalog_sync.scratch import stage
from catalog_sync.sources.csv_files import overlong_lines, read_catalog
from catalog_sync.sources.landing import read_documents
from catalog_sync.sources.snapshots import Conflict, Published, Rewrite, Snapshot, SnapshotStore, Written

Tables = Mapping[str, DataFrame]
#: Tables that go with the catalog and are not counted among its rows.
BESIDE = (ERRORS, MENTIONED)
#: Releases with one of these set are not looked at.
RELEASE_FLAGS = ("adult", "video")


@dataclass(frozen=True)
class Landing:
    """Landing documents by kind; ``persons`` and ``pages`` (fetched result pages) may be absent."""

    details: DataFrame
    credits: DataFrame
    persons: DataFrame | None = None
    pages: DataFrame | None = None

    @classmethod
    def read(cls, spark: SparkSession, root: str, pages: bool = False) -> Landing:
        kinds = ("details", "credits", "persons", *(["pages"] if pages else []))
        return cls(**{k: read_documents(spark, root, k) for k in kinds})


@dataclass(frozen=True)
class Changes:
    """``replace`` holds whole tables. Where ``rewrite`` has the table too, a store may apply that to the
    rows concerned instead. ``errors`` plans the error log when it is asked for, ``base`` is the
    version of the store that the tables were read at. ``mentions`` holds the person ids of credits that
    ``rewrite`` adds."""

    replace: dict[str, DataFrame] = field(default_factory=dict)
    append: dict[str, DataFrame] = field(default_factory=dict)
    errors: Callable[[], DataFrame] | None = None
    rewrite: dict[str, Rewrite] = field(default_factory=dict)
    base: int | None = None
    mentions: DataFrame | None = None


def publish(store: SnapshotStore, changes: Changes, job: str | None = None, **stream) -> Published:
    """Publish what a job changed, with the errors it met in the same version."""
    known = store._layout(changes.base).tables
    rewrite = {n: r for n, r in changes.rewrite.items() if n in known}
    replace = {n: df for n, df in changes.replace.items() if n not in rewrite}
    append, log = dict(changes.append), None
    if changes.errors:
        log = stage(error_table(changes.errors(), job), "errors")
        append[ERRORS] = log
    mentions = _mentions(store, changes, replace)
    if mentions is not None:
        append[MENTIONED] = mentions
    done = store.publish(replace, append, rewrite=rewrite, base=changes.base, **stream)
    rows, parts, counters = ({n: v for n, v in x.items() if n not in BESIDE} for x in (done.rows, done.parts, done.counters))
    return changed(done, rows=rows, parts=parts, counters=counters, log=log)


def error_table(errors: DataFrame, job: str | None) -> DataFrame:
    """Errors as the store keeps them: by which run of which job, and when."""
    return errors.select(
        "category", "stage", "id", "detail", F.lit(job).cast("string").alias("job"),
        F.lit(uuid.uuid4().hex).alias("run"), F.lit(dt.datetime.now()).alias("logged_at"),
    )


def _mentions(store: SnapshotStore, changes: Changes, replace: Tables) -> DataFrame | None:
    """Person ids that the changed credits mention and none did before. Kept beside the catalog, so that
    a person who arrives late is not looked for in all credits."""
    given = [changes.append.get("credits"), replace.get("credits"), changes.mentions]
    ids = [key_set(df, ["person_id"]) for df in given if df is not None]
    if not ids:
        return None
    known = store._layout(changes.base).tables
    tables = Snapshot(store, store._layout(changes.base), [n for n in (MENTIONED, "credits") if n in known])
    if MENTIONED not in tables:
        if "credits" in tables:
            ids.append(tables["credits"].select("person_id"))
        return key_set(union_rows(*ids), ["person_id"])
    ids = stage(key_set(union_rows(*ids), ["person_id"]), "mentioned-ids")
    return exclude_existing(ids, tables.around(MENTIONED, ids), ["person_id"])


def commit(
    store: SnapshotStore, job: Callable[[Tables], Changes], attempts: int = 5, name: str | None = None, **stream
) -> Published | None:
    """Run a job on the current tables and publish its changes, all over again if another publish that
    does not go together with them came first. None if there is nothing to do."""
    for left in reversed(range(attempts)):
        changes = job(current_tables(store))
        if not (changes.replace or changes.append or changes.rewrite):
            return None
        try:
            return publish(store, changes, name, **stream)
        except Conflict:
            if not left:
                raise


def _version(tables: Tables) -> int | None:
    return tables.version if isinstance(tables, Snapshot) else None


def around(tables: Tables, name: str, keys: DataFrame) -> DataFrame:
    """The part of a table that may hold some keys, the whole table where nothing tells."""
    return tables.around(name, keys) if isinstance(tables, Snapshot) else tables[name]


def empty_tables(spark: SparkSession) -> dict[str, DataFrame]:
    """Tables the optimizer knows to be empty, so joins and unions with them vanish."""
    nothing = spark.range(1).filter(F.lit(False))
    return {t: _table_shape(nothing.select(), t) for t in TABLES}


def current_tables(store: SnapshotStore) -> Snapshot:
    return store.tables().over(empty_tables(store.spark))


def _table_shape(df: DataFrame, table: str) -> DataFrame:
    """The table's columns in order and type; the update stamp of a new row is NULL."""
    return df.select(
        *[
            (F.col(c) if c in df.columns else F.lit(None)).cast(kind).alias(c)
            for c, kind in TABLES[table].items()
        ]
    )


# --- initial build ----------------------------------------------------------------


def initial_build(
    landing: Landing,
    requested: DataFrame | None = None,
    legacy_labels: bool = False,
    max_cast: int | None = MAX_CAST,
) -> Changes:
    """Documents of the requested ids (default: all) to the four tables plus the error log. Ids are
    narrowed and credits taken apart before fetches of one id meet."""
    details = landing.details
    if requested is not None:
        requested = stage(key_set(requested, ["id"]), "requested-ids")
        details = keep_listed(details, "id", sized(requested))
    checked = stage(check(latest_documents(details, "id"), movie_rules()), "checked-details")
    valid = checked.filter(F.col(FAILED_RULE).isNull())

    listed = listed_credits(landing.credits, legacy_labels, max_cast)
    given = good_documents(landing.credits, "movie_id", [listed])
    documents = newest_documents(keep_known(given, valid, {"movie_id": "id"}, unique=True), "movie_id")
    credits = stage(credit_rows(documents), "credit-rows")
    tables = {
        "movies": _table_shape(typed_movies(valid), "movies"),
        "credits": credits,
        "genres": genre_rows(valid),
    }
    if landing.persons is not None:
        tables["people"] = needed_people(credits, landing.persons)

    return Changes(tables, errors=lambda: _build_errors(landing, requested, checked, credits))


def _fetch_log(landing: Landing, ids: DataFrame | None = None) -> list[DataFrame]:
    """Failed fetches and unreadable lines, of all documents or of some films. Documents that were taken
    in before hold none: theirs were logged then."""
    log = []
    for kind, key in (("details", "id"), ("credits", "movie_id"), ("persons", "id")):
        docs = getattr(landing, kind)
        if docs is None or not {CORRUPT, "fetch_status"} <= set(docs.columns):
            continue
        if ids is not None:
            if kind == "persons":
                continue
            docs = keep_known(docs, ids, {key: "id"}, unique=True)
        log.append(fetch_errors(docs, key, kind))
    return log


def _build_errors(
    landing: Landing, requested: DataFrame | None, checked: DataFrame, credits: DataFrame
) -> DataFrame:
    valid = checked.filter(F.col(FAILED_RULE).isNull())
    invalid = checked.filter(F.col(FAILED_RULE).isNotNull())
    actors = credits.filter(F.col("credit_type") == "cast")
    on = {"id": "movie_id"}
    log = [
        *_fetch_log(landing),
        error_rows(invalid, "validation_error", "validate", "id", F.col(FAILED_RULE)),
        error_rows(childless(valid, credits, on), "no_credits", "shape", "id"),
        error_rows(childless(valid, actors, on), "no_actors", "shape", "id"),
    ]
    if requested is not None:
        missing = keep_unknown(requested, checked, ["id"], unique=True)
        log.append(error_rows(missing, "not_found", "details", "id"))
    return union_rows(*log)


# --- CSV load -----------------------------------------------------------------------


def load_csv(
    spark: SparkSession,
    root: str,
    tables: Tables | None = None,
    enforce_foreign_keys: bool = True,
    multi_line: bool = True,
) -> Changes:
    """Bulk load of the four CSV files. Without ``tables`` the catalog is emptied first; with
    them existing rows win. Duplicates and (unless switched off) children without parent are
    dropped."""
    initial = tables is None
    target = tables or empty_tables(spark)
    rows = read_catalog(spark, root, multi_line)
    known = {}
    loaded = {}
    for name in TABLES:
        order = [F.col(ORDINAL)]
        if name in ("movies", "people"):
            known[name] = union_ids("id", target[name].select("id"), rows[name].select("id"))
        incoming = rows[name]
        if enforce_foreign_keys and name in ("credits", "genres"):
            incoming = keep_known(incoming, known["movies"], {"movie_id": "id"}, unique=True)
            if name == "credits":
                incoming = keep_known(incoming, known["people"], {"person_id": "id"}, unique=True)
        known_rows = target[name]
        if not initial:
            # Only rows under a key of the delivery can be met, so only those are looked at.
            incoming = stage(first_wins(incoming, KEYS[name], order), f"{name}-delivery")
            keys = stage(key_set(incoming, KEYS[name][:1]), f"{name}-keys")
            known_rows = keep_known(around(target, name, keys), sized(keys), KEYS[name][:1], unique=True)
        fresh = ignoring_duplicates(known_rows, incoming, KEYS[name], order)
        loaded[name] = _table_shape(fresh, name)

    def errors() -> DataFrame:
        """Lines with more cells than their header; duplicates and children without parent are none."""
        lines = [
            overlong_lines(spark, f"{root.rstrip('/')}/{name}.csv", multi_line).select(
                F.lit("processing_error").alias("category"), F.lit(f"csv {name}").alias("stage"),
                F.lit(None).cast("bigint").alias("id"),
                F.concat_ws(": ", "file", "cells").alias("detail"),
            )
            for name in TABLES
        ]
        return union_rows(*lines)

    if initial:
        return Changes(replace=loaded, errors=errors)
    return Changes(append=loaded, errors=errors, base=_version(target))


# --- refresh and add --------------------------------------------------------------------


def _documents(
    landing: Landing, how: str, ids: DataFrame | None = None, max_cast: int | None = MAX_CAST
) -> DataFrame:
    """One row per movie document: table columns, genre names, and the credits that are kept
    (NULL when there is no credits document and ``how`` is left). A document lacking a required
    field counts as none. Documents are cut to these columns and wanted ids filter both sides
    before anything is shuffled."""
    shaped = [*_film_columns(), _complete()]
    details, credits = landing.details, landing.credits
    if ids is not None:
        details, credits = keep_listed(details, "id", ids), keep_listed(credits, "movie_id", ids)
    details = good_documents(details, "id", shaped)
    credits = good_documents(credits, "movie_id", [listed_credits(credits, max_cast=max_cast)])
    details = newest_documents(details, "id").filter("_complete").select(*CSV_COLUMNS["movies"], "_genres")
    credits = newest_documents(credits, "movie_id").select("movie_id", CREDIT_LIST)
    return enrich(details, credits, {"id": "movie_id"}, how)


def _film_columns() -> list[Column]:
    """Movie columns but the id, and the genre names."""
    typed = [c for c, name in zip(typed_movie_columns(), CSV_COLUMNS["movies"], strict=True) if name != "id"]
    return [*typed, genre_names(F.col("genres")).alias("_genres")]


def _complete() -> Column:
    complete = F.lit(True)
    for c in REQUIRED_FIELDS:
        complete = complete & F.col(c).isNotNull()
    return complete.alias("_complete")


def _credits_of(docs: DataFrame) -> DataFrame:
    rows = explode_children(docs, "id", F.col(CREDIT_LIST), child_key="movie_id")
    return rows.select(*TABLES["credits"])


def _genres_of(docs: DataFrame) -> DataFrame:
    return docs.select(F.col("id").alias("movie_id"), F.explode("_genres").alias("genre_name"))


def _update_rows(docs: DataFrame, credits: DataFrame, as_of: dt.datetime) -> dict[str, Rewrite]:
    ids = lambda: docs.select("id")
    stamp = ("updated_at", as_of)
    return {
        "movies": Rewrite(ids, lambda rows: update_tagged(rows, docs, ["id"], UPDATABLE_MOVIE_COLUMNS, stamp)),
        "credits": Rewrite(
            ids, lambda rows: replace_children_tagged(rows, docs, credits, "movie_id", "id")
        ),
        "genres": Rewrite(
            ids, lambda rows: replace_children_tagged(rows, docs, _genres_of(docs), "movie_id", "id")
        ),
    }


def _replaced(tables: Tables, rewrite: Mapping[str, Rewrite]) -> dict[str, DataFrame]:
    return {name: r.apply(tables[name]).drop(ACTION) for name, r in rewrite.items()}


def _insert_rows(docs: DataFrame, credits: DataFrame) -> dict[str, DataFrame]:
    return {
        "movies": _table_shape(docs, "movies"),
        "credits": credits,
        "genres": _genres_of(docs),
    }


_PERSON_COLUMNS = [c for c in TABLES["people"] if c != "id"]


def refresh(
    tables: Tables,
    landing: Landing,
    as_of: dt.datetime,
    ids: DataFrame | None = None,
    with_people: bool = True,
    max_cast: int | None = MAX_CAST,
) -> Changes:
    """Bring movies of the catalog (all, or the given ids) up to date, each exactly once. Needs
    both a details and a credits document; ids the catalog lacks are left alone."""
    if ids is None:
        wanted = sized(stage(tables["movies"].select("id"), "catalog-ids"))
    else:
        ids = stage(key_set(ids, ["id"]), "requested-ids")
        wanted = sized(stage(existing_keys(ids, around(tables, "movies", ids), ["id"]), "known-ids"))
    docs = stage(_documents(landing, "inner", wanted, max_cast), "refreshed")
    rewrite = _update_rows(docs, _credits_of(docs), as_of)
    replace = _replaced(tables, rewrite)
    if with_people and landing.persons is not None:
        people = cache(lambda: stage(needed_people(_credits_of(docs), landing.persons), "people"))
        rewrite["people"] = Rewrite(
            lambda: people().select("id"),
            lambda rows: upsert_tagged(rows, people(), ["id"], _PERSON_COLUMNS),
        )
        needed = needed_people(_credits_of(docs), landing.persons)
        replace["people"] = upsert(tables["people"], needed, ["id"], _PERSON_COLUMNS)
    errors = lambda: _refresh_errors(tables, landing, docs, ids)
    mentions = _credits_of(docs).select("person_id")
    return Changes(replace, errors=errors, rewrite=rewrite, base=_version(tables), mentions=mentions)


def _refresh_errors(
    tables: Tables, landing: Landing, docs: DataFrame, ids: DataFrame | None
) -> DataFrame:
    """Catalog movies the source no longer has, those it has without credits, and requested ids
    the catalog lacks."""
    movies = tables["movies"].select("id")
    log = _fetch_log(landing, movies if ids is None else ids)
    if ids is not None:
        movies = around(tables, "movies", ids).select("id")
        unknown = exclude_existing(ids, movies, ["id"])
        log.append(error_rows(unknown, "not_found", "refresh", "id"))
        movies = existing_keys(ids, movies, ["id"])
    stale = stage(keep_unknown(movies, docs, ["id"], unique=True), "stale-ids")
    some = keep_listed(landing.details, "id", sized(key_set(stale, ["id"])))
    details = latest_documents(some, "id").dropna(subset=REQUIRED_FIELDS)
    removed = keep_unknown(stale, details, ["id"], unique=True)
    bare = keep_known(stale, details, ["id"], unique=True)
    return union_rows(
        *log,
        error_rows(removed, "removed_movies", "refresh", "id"),
        error_rows(bare, "no_credits", "refresh", "id"),
    )


def add_documents(
    tables: Tables, landing: Landing, ids: DataFrame, max_cast: int | None = MAX_CAST
) -> Changes:
    """Insert the given ids the catalog lacks, with their children; credits are optional, a
    missing details document drops the id. Appends only."""
    candidates = stage(key_set(ids, ["id"]), "candidate-ids")
    wanted = stage(exclude_existing(candidates, around(tables, "movies", candidates), ["id"]), "new-ids")
    docs = stage(_documents(landing, "left", sized(wanted), max_cast), "new-documents")
    append = _insert_rows(docs, _credits_of(docs))
    if landing.persons is not None:
        people = stage(key_set(append["credits"], ["person_id"]), "credited-ids")
        known = around(tables, "people", people)
        append["people"] = needed_people(append["credits"], landing.persons, known)
    return Changes(append=append, errors=lambda: _add_errors(landing, wanted, docs), base=_version(tables))


def _add_errors(landing: Landing, wanted: DataFrame, docs: DataFrame) -> DataFrame:
    """Wanted ids without a usable document, and films added without credits or without actors."""
    credits = F.coalesce(F.col(CREDIT_LIST), F.array())
    actors = F.filter(credits, lambda c: c["credit_type"] == "cast")
    return union_rows(
        *_fetch_log(landing, wanted),
        error_rows(keep_unknown(wanted, docs, ["id"], unique=True), "not_found", "details", "id"),
        error_rows(docs.filter(F.size(credits) == 0), "no_credits", "add", "id"),
        error_rows(docs.filter(F.size(actors) == 0), "no_actors", "add", "id"),
    )


def release_listing(landing: Landing) -> DataFrame:
    """Released titles as discovery sees them: id, date, popularity and the exclusion flags."""
    return latest_documents(landing.details, "id", _release_columns()).drop("fetched_at")


def _release_columns() -> list[Column]:
    return [
        F.col("title"), parse_date(F.col("release_date")).alias("release_date"),
        parse_number(F.col("popularity")).alias("popularity"), F.col("adult"), F.col("video"),
    ]


def _releases_since(landing: Landing, start: dt.date) -> DataFrame:
    """Of the listing what may have been released on or after ``start``: a document of which no fetch was
    is left out before its fetches are compared."""
    if landing.pages is not None:
        return release_pages(landing.pages)
    fetches = good_documents(landing.details, "id", _release_columns())
    ids = stage(key_set(since(exclude_flags(fetches, RELEASE_FLAGS), "release_date", start), ["id"]), "released-ids")
    return release_listing(changed(landing, details=keep_listed(landing.details, "id", sized(ids))))


def release_pages(pages: DataFrame, max_pages: int | None = None) -> DataFrame:
    """The same listing from fetched result pages, of all of them unless there is a page cap."""
    rows = page_results(pages, max_pages).filter(usable_id(F.col("id")))
    return rows.withColumn("release_date", parse_date(F.col("release_date"))).drop("page")


def _releases(landing: Landing) -> DataFrame:
    return release_listing(landing) if landing.pages is None else release_pages(landing.pages)


def new_candidates(
    listing: DataFrame,
    start: dt.date,
    id_: str = "id",
    date: str = "release_date",
    flags: tuple[str, ...] = RELEASE_FLAGS,
    max_pages: int | None = None,
    page_size: int = 20,
) -> DataFrame:
    """Listed rows released on or after ``start``, newest pages first when capped."""
    rows = since(exclude_flags(listing, flags), date, start)
    return newest_first(rows, date, id_, max_pages, page_size)


def add_new(
    tables: Tables,
    landing: Landing,
    period: str | int | None = None,
    releases: DataFrame | None = None,
    max_pages: int | None = None,
    page_size: int = 20,
    watermark_ceiling: dt.date | None = None,
    max_cast: int | None = MAX_CAST,
) -> Changes:
    """Add what was released since the newest movie of the catalog, minus a look-back period.
    ``releases`` is the listing to look at (default: the fetched result pages if the landing zone was read
    with them, else the documents themselves). An empty catalog has no watermark: nothing to do."""
    mark = _watermark(tables, watermark_ceiling)
    if mark is None:
        return Changes()
    start = period_start(mark, period)
    releases = _releases_since(landing, start) if releases is None else releases
    found = new_candidates(releases, start, max_pages=max_pages, page_size=page_size)
    return add_documents(tables, landing, found.select("id"), max_cast)


def _watermark(tables: Tables, ceiling: dt.date | None) -> dt.date | None:
    """From the parts' statistics where these tell, else from a scan."""
    bounds = tables.bounds("movies", "release_date") if isinstance(tables, Snapshot) else None
    if bounds and (ceiling is None or bounds[1] is None or bounds[1] <= ceiling):
        return bounds[1]
    return watermark(tables["movies"], "release_date", ceiling)


# --- search -----------------------------------------------------------------------------


def search(
    tables: Tables, landing: Landing, query: str, page_size: int | None = 20, page: int = 1
) -> DataFrame:
    """Numbered listing of the movies the catalog lacks on a page of the matches. Known movies take
    their places on the pages; ``page_size=None`` lists all matches at once."""
    docs = landing.details
    if is_id(query):
        docs = docs.filter(F.col("id") == int(query))
    else:
        # Any version of a document may match, only the newest counts: narrow to ids with a
        # match, then decide on their newest version.
        matching = docs.filter(F.contains(F.lower("title"), F.lower(F.lit(query))))
        ids = stage(key_set(matching, ["id"]), "matching-ids")
        docs = keep_known(docs, sized(ids), ["id"], unique=True)
    latest = latest_documents(docs, "id").select(
        *typed_movie_columns(), "adult", genre_string(F.col("genres")).alias("genre_names"),
        F.col("release_date").alias("release_text"),
    )
    hits = title_search(latest, query, page_size=page_size, flags=("adult",), page=page)
    hits = stage(hits, "search-page")
    fresh = exclude_existing(hits, tables["movies"], ["id"])
    return listing(
        fresh,
        [F.col("popularity").desc_nulls_last(), F.col("id")],
        date=F.col("release_text"),
        genres=F.col("genre_names"),
        page_size=page_size,
    ).select("ordinal", "id", "title", "line", "genre_line")


def search_and_add(
    tables: Tables,
    landing: Landing,
    query: str,
    select: int = 1,
    page_size: int | None = 20,
    page: int = 1,
) -> Changes:
    """Add the movie listed under number ``select`` of the page (0 cancels)."""
    if select == 0:
        return Changes()
    chosen = search(tables, landing, query, page_size, page).filter(F.col("ordinal") == select)
    return add_documents(tables, landing, chosen.select("id"))


# --- discovery and sync -------------------------------------------------------------------


def discover(landing: Landing, **options) -> DataFrame:
    """Ids an initial build should request, year by year, from the result pages if there are any. Of
    several listings of one id the latest date counts, then the highest popularity."""
    listed = _releases(landing)
    if landing.pages is not None:
        order = [F.desc_nulls_last("release_date"), F.desc_nulls_last("popularity"), F.col("title")]
        listed = first_wins(listed, ["id"], order)
    return discover_ids(listed, **options)


def sync(
    store: SnapshotStore,
    landing: Landing,
    period: str | int | None,
    as_of: dt.datetime,
    max_cast: int | None = MAX_CAST,
) -> list[Published]:
    """Refresh everything, then add what is new. The watermark is read after the refresh, which
    may have moved release dates."""
    refreshed = commit(store, lambda t: refresh(t, landing, as_of, max_cast=max_cast), name="refresh")
    added = commit(store, lambda t: add_new(t, landing, period, max_cast=max_cast), name="add-new")
    return [done for done in (refreshed, added) if done]


def sync_documents(
    tables: Tables, landing: Landing, as_of: dt.datetime, max_cast: int | None = MAX_CAST
) -> Changes:
    """Upsert of the documents at hand over all four tables: known movies are refreshed (given a
    credits document), others inserted. Without anything to refresh this only appends."""
    arrived = sized(key_set(landing.details, ["id"]))
    docs = stage(_documents(landing, "left", arrived, max_cast), "documents")

    def needed(credits: DataFrame) -> DataFrame | None:
        return None if landing.persons is None else needed_people(credits, landing.persons)

    lists = docs.filter(F.col(CREDIT_LIST).isNotNull()).select(F.col("id").alias("movie_id"), CREDIT_LIST)
    changes = _upserted(tables, docs.select("id"), docs, lists, needed, as_of)
    return changed(changes, errors=lambda: union_rows(*_fetch_log(landing), _bare(docs)))


def _bare(docs: DataFrame) -> DataFrame:
    """Films that wait for their credits or have none."""
    bare = docs.filter(F.size(F.coalesce(F.col(CREDIT_LIST), F.array())) == 0)
    return error_rows(bare, "no_credits", "sync", "id")


def _upserted(
    tables: Tables,
    ids: DataFrame,
    films: DataFrame,
    lists: DataFrame,
    needed: Callable[[DataFrame], DataFrame | None],
    as_of: dt.datetime,
) -> Changes:
    """Upsert of films, given their ids, the movie documents and the credit lists of those that have a credits
    document, and of the people that ``needed`` finds for the credits. Documents and lists meet by id only,
    so neither is shuffled for the other."""
    found = stage(existing_keys(ids, around(tables, "movies", ids), ["id"]), "known-ids")
    known, listed = sized(found), sized(stage(keep_known(found, lists, {"id": "movie_id"}, unique=True), "known-listed"))
    changed_films = keep_known(films, listed, ["id"], unique=True)
    changed_credits = credit_rows(keep_known(lists, listed, {"movie_id": "id"}, unique=True))
    new_credits = credit_rows(keep_unknown(lists, known, {"movie_id": "id"}, unique=True))
    append = _insert_rows(keep_unknown(films, known, ["id"], unique=True), new_credits)
    rewrite: dict[str, Rewrite] = {}
    if not listed.isEmpty():
        rewrite = _update_rows(changed_films, changed_credits, as_of)
    people = needed(changed_credits.unionByName(new_credits))
    if people is not None:
        # People are upserted whatever else the documents hold; a table is appended to where none
        # of them is known.
        found = _people_changes(tables, people)
        rewrite |= found.rewrite
        append |= found.append
    return Changes(
        _replaced(tables, rewrite), append, rewrite=rewrite, base=_version(tables),
        mentions=changed_credits.select("person_id"),
    )


def sync_people(tables: Tables, persons: DataFrame) -> Changes:
    """Upsert of the person documents that the catalog's credits mention."""
    return _people_changes(tables, needed_people(tables["credits"], persons))


def _people_changes(tables: Tables, needed: DataFrame) -> Changes:
    people = stage(needed, "people")
    ids = people.select("id")
    if existing_keys(ids, around(tables, "people", ids), ["id"]).isEmpty():
        return Changes(append={"people": people}, base=_version(tables))
    rewrite = {"people": Rewrite(
        lambda: ids, lambda rows: upsert_tagged(rows, people, ["id"], _PERSON_COLUMNS)
    )}
    return Changes(_replaced(tables, rewrite), rewrite=rewrite, base=_version(tables))


def sync_arrived(tables: Snapshot, arrived: Mapping[str, Written], as_of: dt.datetime) -> Changes:
    """What newly arrived documents (by kind, as written) change: films whose details or credits arrived, the
    people of their credits, and persons that arrived after the credits that mention them. Documents
    that came before are looked up in the slots of these films and people only. The newest
    fetches are picked by id, time and place; documents are then read where they lie, none is shuffled for it."""
    movie_ids = F.col("movie_id").alias("id")
    films = stage(key_set(
        union_rows(arrived["details"].rows.select("id"), arrived["credits"].rows.select(movie_ids)), ["id"]
    ), "arrived-films")
    wanted = sized(films)

    def newest(kind: str, key: str, *columns: Column) -> tuple[DataFrame, DataFrame]:
        """All fetches at hand, and the newest of each film cut down to its place and some columns."""
        name, new = f"landed_{kind}", arrived[kind].located
        cut = lambda docs: good_documents(docs, key, [F.col(FILE), F.col(PLACE), *columns])
        if name not in tables:
            return new, newest_documents(cut(new), key)
        old = tables.located_around(name, films)
        some = union_rows(cut(keep_listed(old, key, wanted)), cut(new))
        return union_rows(old, new), newest_documents(some, key)

    details, found = newest("details", "id", _complete())
    found = stage(found.filter("_complete").select("id", FILE, PLACE), "found-details")
    credits, listed = newest("credits", "movie_id")
    listed = stage(keep_known(listed, found, {"movie_id": "id"}, unique=True), "found-credits")
    docs = rows_at(details, bitmaps(found)).select("id", *_film_columns())
    lists = rows_at(credits, bitmaps(listed)).select("movie_id", CREDIT_LIST)

    def needed(credits: DataFrame) -> DataFrame:
        mentioned = key_set(credits, ["person_id"]).withColumnRenamed("person_id", "id")
        late = stage(key_set(arrived["persons"].rows, ["id"]), "arrived-persons")
        known = around(tables, MENTIONED, late) if MENTIONED in tables else tables["credits"]
        late = existing_keys(late, known, {"id": "person_id"})
        ids = stage(mentioned.union(late).distinct(), "needed-ids")
        persons = arrived["persons"].rows
        if "landed_persons" in tables:
            persons = union_rows(around(tables, "landed_persons", ids), persons)
        return needed_people(ids.withColumnRenamed("id", "person_id"), persons)

    return _upserted(tables, found.select("id"), docs, lists, needed, as_of)
