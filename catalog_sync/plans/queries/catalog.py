"""The jobs, run on documents derived from the text tables (see ``landing``)."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import functions as F

from catalog_sync.operators.quality import error_summary
from catalog_sync.operators.shape import latest_documents, typed_movies
from catalog_sync.plans.jobs import (
    Changes,
    add_new,
    discover,
    empty_tables,
    initial_build,
    load_csv,
    publish,
    refresh,
    search,
    search_and_add,
    sync,
    sync_documents,
)
from catalog_sync.plans.queries.cleaning import loader_sql, writer_sql
from catalog_sync.plans.queries.landing import (
    CREDITS_SQL,
    DETAILS_SQL,
    GENRES_SQL,
    PEOPLE_SQL,
    VALID_SQL,
    landing,
)
from catalog_sync.plans.registry import query, table
from catalog_sync.schemas import CSV_COLUMNS, ERROR_CATEGORIES
from catalog_sync.scratch import scratch_dir
from catalog_sync.sources.csv_files import write_catalog
from catalog_sync.sources.snapshots import SnapshotStore

AS_OF = dt.datetime(2024, 6, 1, 12, 0)
_MOVIES = ", ".join(CSV_COLUMNS["movies"])
_TITLES = "id, title, release_date, runtime"
_KNOWN_UNTIL = "2015-01-01"


# --- initial build -----------------------------------------------------------------

_BUILT_SQL = f"""WITH {VALID_SQL}, {CREDITS_SQL}, {GENRES_SQL}, {PEOPLE_SQL},
  built_credits AS (SELECT c.* FROM credits c JOIN valid v ON c.movie_id = v.id),
  built_genres AS (SELECT g.* FROM genres g JOIN valid v ON g.movie_id = v.id),
  built_people AS (SELECT * FROM persons WHERE id IN (SELECT person_id FROM built_credits))"""


def _requested(spark, d):
    """Every document and every benchmark item, the latter under ids no document has."""
    documents = table(spark, d, "documents").select(F.col("doc_id").alias("id"))
    return documents.union(table(spark, d, "benchmark").select(-F.col("item_id") - 1))


def _build(spark, d) -> Changes:
    return initial_build(landing(spark, d), _requested(spark, d))


@query("initial_build_movies", f"{_BUILT_SQL} SELECT {_MOVIES} FROM valid")
def built_movies(spark, d):
    return _build(spark, d).replace["movies"].drop("updated_at")


@query("initial_build_credits", f"{_BUILT_SQL} SELECT * FROM built_credits")
def built_credits(spark, d):
    return _build(spark, d).replace["credits"]


@query("initial_build_genres", f"{_BUILT_SQL} SELECT * FROM built_genres")
def built_genres(spark, d):
    return _build(spark, d).replace["genres"]


@query("initial_build_people", f"{_BUILT_SQL} SELECT * FROM built_people")
def built_people(spark, d):
    return _build(spark, d).replace["people"]


@query(
    "initial_build_errors",
    f"""{_BUILT_SQL},
       found AS (
         SELECT 'not_found' AS category, -item_id - 1 AS id FROM benchmark
         UNION ALL SELECT 'not_found', doc_id FROM documents WHERE doc_id = 0
         UNION ALL SELECT 'timeout', doc_id FROM documents WHERE source = 'src5'
         UNION ALL SELECT 'validation_error', id FROM details WHERE source IN ('src3', 'src11')
         UNION ALL SELECT 'no_credits', id FROM valid
           WHERE id NOT IN (SELECT movie_id FROM built_credits)
         UNION ALL SELECT 'no_actors', id FROM valid
           WHERE id NOT IN (SELECT movie_id FROM built_credits WHERE credit_type = 'cast'))
       SELECT c.category, count(DISTINCT f.id) AS ids
       FROM (VALUES {', '.join(f"('{c}')" for c in ERROR_CATEGORIES)}) AS c(category)
       LEFT JOIN found f ON f.category = c.category GROUP BY c.category""",
)
def build_errors(spark, d):
    return error_summary(_build(spark, d).errors())


# --- CSV load ------------------------------------------------------------------------


def _loaded(spark, d) -> dict:
    """The built catalog written as CSV and loaded into an empty one."""
    built = _build(spark, d)
    root = scratch_dir(spark, "csv-catalog")
    write_catalog(built.replace, root)
    return load_csv(spark, root).replace


_TEXT_SQL = {
    "title": loader_sql(f"({writer_sql('title', True)})", True, False),
    "overview": loader_sql(f"({writer_sql('overview', True)})", True, True),
}


@query(
    "csv_load_movies",
    f"""{_BUILT_SQL}
       SELECT id, {_TEXT_SQL['title']} AS title, original_title, {_TEXT_SQL['overview']} AS overview,
         coalesce(release_date, DATE '1970-01-01') AS release_date, runtime, status,
         CAST(round_even(vote_average * CAST(10000 AS DOUBLE), 0) AS DOUBLE) / 10000
           AS vote_average, vote_count, popularity, poster_path, '' AS backdrop_path, budget,
         revenue
       FROM valid""",
)
def loaded_movies(spark, d):
    return _loaded(spark, d)["movies"].drop("updated_at")


@query(
    "csv_load_credits",
    f"""{_BUILT_SQL}
       SELECT movie_id, person_id, credit_type,
         {loader_sql('character_name', False, False)} AS character_name, credit_order, department,
         job
       FROM built_credits WHERE person_id IN (SELECT id FROM built_people)""",
)
def loaded_credits(spark, d):
    return _loaded(spark, d)["credits"]


# --- refresh ---------------------------------------------------------------------------


def _stale_catalog(spark, d) -> dict:
    """A catalog holding every document (document 0 included, which landing knows only as an
    unusable id) under an old title, with one old genre and credit each."""
    documents = table(spark, d, "documents")
    details = latest_documents(landing(spark, d).details, "id")
    movies = typed_movies(details).withColumn("title", F.lit("old"))
    never = F.lit(None).cast("timestamp").alias("updated_at")
    zero = documents.filter(F.col("doc_id") == 0).select(F.col("doc_id").alias("id"))
    ids = documents.select(F.col("doc_id").alias("movie_id"))
    tables = empty_tables(spark)
    tables["movies"] = movies.select("*", never).unionByName(zero, allowMissingColumns=True)
    tables["genres"] = ids.select("movie_id", F.lit("old genre").alias("genre_name"))
    tables["credits"] = tables["credits"].unionByName(
        ids.select("movie_id", F.lit(1).cast("bigint").alias("person_id"),
                   F.lit("cast").alias("credit_type")),
        allowMissingColumns=True,
    )
    tables["people"] = tables["people"].unionByName(
        table(spark, d, "supplier").select(
            F.col("s_suppkey").alias("id"), F.col("s_name").alias("name")
        ),
        allowMissingColumns=True,
    )
    return tables


@query(
    "refresh_movies",
    f"""WITH {DETAILS_SQL}
       SELECT id, CASE source WHEN 'src9' THEN 'old' ELSE title END AS title, release_date,
         runtime, vote_count, source <> 'src9' AS refreshed FROM details
       UNION ALL SELECT 0, NULL, NULL, NULL, NULL, false""",
)
def refreshed_movies(spark, d):
    changes = refresh(_stale_catalog(spark, d), landing(spark, d), AS_OF)
    return changes.replace["movies"].select(
        "id", "title", "release_date", "runtime", "vote_count",
        F.col("updated_at").isNotNull().alias("refreshed"),
    )


@query(
    "refresh_credits",
    f"""WITH {CREDITS_SQL}
       SELECT * FROM credits
       UNION ALL
       SELECT doc_id, 1, 'cast', NULL, NULL, NULL, NULL FROM documents
       WHERE doc_id = 0 OR source = 'src9'""",
)
def refreshed_credits(spark, d):
    return refresh(_stale_catalog(spark, d), landing(spark, d), AS_OF).replace["credits"]


@query(
    "refresh_genres",
    f"""WITH {GENRES_SQL}
       SELECT g.* FROM genres g JOIN documents ON doc_id = movie_id WHERE source <> 'src9'
       UNION ALL
       SELECT doc_id, 'old genre' FROM documents WHERE doc_id = 0 OR source = 'src9'""",
)
def refreshed_genres(spark, d):
    return refresh(_stale_catalog(spark, d), landing(spark, d), AS_OF).replace["genres"]


@query(
    "refresh_people",
    f"""WITH {CREDITS_SQL}, {PEOPLE_SQL},
       fresh AS (SELECT * FROM persons WHERE id IN (SELECT person_id FROM credits))
       SELECT * FROM fresh
       UNION ALL
       SELECT s_suppkey, s_name, NULL, NULL, NULL FROM supplier
       WHERE s_suppkey NOT IN (SELECT id FROM fresh)""",
)
def refreshed_people(spark, d):
    return refresh(_stale_catalog(spark, d), landing(spark, d), AS_OF).replace["people"]


@query(
    "refresh_selected",
    f"""WITH {DETAILS_SQL}
       SELECT id, CASE WHEN source <> 'src9' AND id IN (SELECT doc_id FROM labels) THEN title
         ELSE 'old' END AS title FROM details
       UNION ALL SELECT 0, NULL""",
)
def refreshed_selection(spark, d):
    ids = table(spark, d, "labels").select(F.col("doc_id").alias("id"))
    changes = refresh(_stale_catalog(spark, d), landing(spark, d), AS_OF, ids)
    return changes.replace["movies"].select("id", "title")


# --- add new, search, sync ---------------------------------------------------------------


def _early_catalog(spark, d, until: str = _KNOWN_UNTIL) -> dict:
    """What was released up to a day, under an old title."""
    details = latest_documents(landing(spark, d).details, "id")
    movies = typed_movies(details).filter(F.col("release_date") <= F.lit(until).cast("date"))
    never = F.lit(None).cast("timestamp").alias("updated_at")
    return {
        **empty_tables(spark),
        "movies": movies.withColumn("title", F.lit("old")).select("*", never),
    }


def _early_sql(days: int, until: str = _KNOWN_UNTIL) -> str:
    return f"""WITH {DETAILS_SQL}, {CREDITS_SQL}, {GENRES_SQL}, {PEOPLE_SQL},
      known AS (SELECT * FROM details WHERE release_date <= DATE '{until}'),
      added AS (SELECT * FROM details
        WHERE release_date >= (SELECT max(release_date) FROM known) - {days}
          AND source <> 'src13' AND id NOT IN (SELECT id FROM known))"""


@query("add_new_movies", f"{_early_sql(30)} SELECT {_MOVIES} FROM added")
def added_movies(spark, d):
    changes = add_new(_early_catalog(spark, d), landing(spark, d), "month")
    return changes.append["movies"].drop("updated_at")


@query(
    "add_new_credits",
    f"{_early_sql(30)} SELECT * FROM credits WHERE movie_id IN (SELECT id FROM added)",
)
def added_credits(spark, d):
    return add_new(_early_catalog(spark, d), landing(spark, d), "month").append["credits"]


@query(
    "add_new_people",
    f"""{_early_sql(30)} SELECT * FROM persons WHERE id IN
         (SELECT person_id FROM credits WHERE movie_id IN (SELECT id FROM added))""",
)
def added_people(spark, d):
    return add_new(_early_catalog(spark, d), landing(spark, d), "month").append["people"]


_SEARCH_UNTIL = "1999-01-01"
_SEARCH_SQL = f"""{_early_sql(0, _SEARCH_UNTIL)},
  found AS (
    SELECT * FROM details WHERE contains(lower(title), lower('EN, src1')) AND source <> 'src13'
    ORDER BY popularity DESC, id LIMIT 20),
  listed AS (
    SELECT *, row_number() OVER (ORDER BY popularity DESC, id) AS n FROM found
    WHERE id NOT IN (SELECT id FROM known))"""


@query(
    "search_and_add",
    f"""{_SEARCH_SQL},
       names AS (
         SELECT doc_id AS id, string_agg(w, ', ' ORDER BY pos) AS names
         FROM (SELECT doc_id, unnest(string_split(text, ' ')) AS w,
                 generate_subscripts(string_split(text, ' '), 1) AS pos FROM documents)
         WHERE length(w) >= 12 GROUP BY doc_id)
       SELECT CAST(n AS INTEGER) AS ordinal, id, title,
         concat(n, '. ', title, ' (', strftime(release_date, '%Y-%m-%d'), ') - ID: ', id) AS line,
         concat('   Genres: ', coalesce(names, 'No genres')) AS genre_line
       FROM listed LEFT JOIN names USING (id)""",
)
def search_listing(spark, d):
    return search(_early_catalog(spark, d, _SEARCH_UNTIL), landing(spark, d), "EN, src1")


@query("search_and_add_selected", f"{_SEARCH_SQL} SELECT {_MOVIES} FROM listed WHERE n = 2")
def search_selection(spark, d):
    known = _early_catalog(spark, d, _SEARCH_UNTIL)
    changes = search_and_add(known, landing(spark, d), "EN, src1", select=2)
    return changes.append["movies"].drop("updated_at")


@query(
    "discover_catalog_ids",
    f"""WITH {DETAILS_SQL}
       SELECT id FROM details WHERE year(release_date) <= 2012 AND source <> 'src13' AND id > 50
       QUALIFY row_number() OVER (PARTITION BY year(release_date)
         ORDER BY popularity DESC, id) <= 2000""",
)
def discovered_ids(spark, d):
    return discover(landing(spark, d), latest_year=2012, since_id=50, max_pages=100)


@query(
    "sync_week",
    f"""{_early_sql(7)}
       SELECT id, CASE source WHEN 'src9' THEN 'old' ELSE title END AS title, release_date,
         runtime FROM known
       UNION ALL SELECT {_TITLES} FROM added""",
)
def weekly_sync(spark, d):
    store = SnapshotStore(spark, scratch_dir(spark, "sync-store"))
    publish(store, Changes(replace=_early_catalog(spark, d)))
    sync(store, landing(spark, d), "week", AS_OF)
    return store.table("movies").select("id", "title", "release_date", "runtime")


@query(
    "upsert_documents",
    f"""{_early_sql(0)}
       SELECT id, CASE WHEN source = 'src9' AND id IN (SELECT id FROM known) THEN 'old'
         ELSE title END AS title, release_date, runtime FROM details""",
)
def upserted_documents(spark, d):
    store = SnapshotStore(spark, scratch_dir(spark, "upsert-store"))
    publish(store, Changes(replace=_early_catalog(spark, d)))
    publish(store, sync_documents(store.tables(), landing(spark, d), AS_OF))
    return store.table("movies").select("id", "title", "release_date", "runtime")
