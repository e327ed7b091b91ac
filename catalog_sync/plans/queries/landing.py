"""Movie, credits and person documents derived row by row from ``documents`` and ``customer``,
together with SQL that states what the four tables must then hold."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from catalog_sync.plans.jobs import Landing
from catalog_sync.plans.registry import table
from catalog_sync.schemas import CORRUPT

DIRECTOR_LINE = 80
NO_ID_LINE = 300
OWN_DEPARTMENT_LINE = 150
GENRE_LENGTH = 12


def cast_array() -> Column:
    """Every line of the text is a cast member; an empty line has no id."""
    def member(line: Column, i: Column) -> Column:
        return F.struct(
            F.when(line != "", F.ascii(line) + F.length(line)).cast("bigint").alias("id"),
            line.alias("name"),
            line.alias("character"),
            i.cast("bigint").alias("order"),
        )

    return F.transform(F.split("text", "\n"), member).alias("cast")


def crew_array() -> Column:
    """Every line of the text is a crew member; long ones direct, very long ones have no id."""
    def member(line: Column) -> Column:
        n = F.length(line)
        return F.struct(
            F.when(n <= NO_ID_LINE, n).cast("bigint").alias("id"),
            line.alias("name"),
            F.when(n >= DIRECTOR_LINE, "Director").otherwise("Writer").alias("job"),
            F.when(n < OWN_DEPARTMENT_LINE, "Second Unit").alias("department"),
        )

    return F.transform(F.split("text", "\n"), member).alias("crew")


def details(spark: SparkSession, d: str) -> DataFrame:
    """Two fetches per document: an old one with a stale title and the newest, which timed out
    for one source."""
    n, source = F.col("n_chars"), F.col("source")
    long_words = F.filter(F.split("text", " "), lambda w: F.length(w) >= GENRE_LENGTH)
    released = F.date_add(F.lit("1995-01-01").cast("date"), (n % 9000).cast("int"))
    docs = table(spark, d, "documents").select(
        F.col("doc_id").alias("id"),
        F.concat("lang", F.lit(", "), "source").alias("title"),
        source.alias("original_title"),
        F.col("text").alias("overview"),
        F.when(source == "src3", "soon")
        .when(source == "src7", "")
        .otherwise(F.date_format(released, "yyyy-MM-dd"))
        .alias("release_date"),
        F.concat(n % 300, F.lit(".5")).alias("runtime"),
        F.lit("Released").alias("status"),
        F.concat(n % 10, F.lit("."), "doc_id").alias("vote_average"),
        F.when(source == "src11", "many").otherwise(n.cast("string")).alias("vote_count"),
        F.concat(n % 1000, F.lit(".25")).alias("popularity"),
        F.concat(F.lit("/"), "lang", F.lit(".jpg")).alias("poster_path"),
        F.lit(None).cast("string").alias("backdrop_path"),
        (n * 1000).cast("string").alias("budget"),
        F.lit("1e3").alias("revenue"),
        F.when(source == "src13", True).alias("adult"),
        F.lit(False).alias("video"),
        F.transform(long_words, lambda w: F.struct(w.alias("name"))).alias("genres"),
        F.lit(None).cast("string").alias(CORRUPT),
    )
    newest = docs.withColumns({
        "fetched_at": F.lit("2024-01-02").cast("timestamp"),
        "fetch_status": F.when(F.col("original_title") == "src5", "timeout").otherwise("ok"),
    })
    stale = docs.withColumns({
        "title": F.lit("stale"),
        "fetched_at": F.lit("2024-01-01").cast("timestamp"),
        "fetch_status": F.lit("ok"),
    })
    return newest.unionByName(stale)


def credits(spark: SparkSession, d: str) -> DataFrame:
    """Credits of every document but those of one source."""
    docs = table(spark, d, "documents").filter(F.col("source") != "src9")
    return docs.select(
        F.col("doc_id").alias("movie_id"), cast_array(), crew_array(),
        F.lit("2024-01-01").cast("timestamp").alias("fetched_at"),
        F.lit("ok").alias("fetch_status"),
        F.lit(None).cast("string").alias(CORRUPT),
    )


def persons(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "customer").select(
        F.col("c_custkey").alias("id"),
        F.col("c_name").alias("name"),
        F.lit(None).cast("string").alias("profile_path"),
        F.col("c_nationkey").cast("bigint").alias("gender"),
        F.col("c_mktsegment").alias("known_for_department"),
        F.lit("2024-01-01").cast("timestamp").alias("fetched_at"),
        F.lit("ok").alias("fetch_status"),
        F.lit(None).cast("string").alias(CORRUPT),
    )


def landing(spark: SparkSession, d: str) -> Landing:
    return Landing(details(spark, d), credits(spark, d), persons(spark, d))


# --- the same in SQL ------------------------------------------------------------------

DETAILS_SQL = """
  details AS (
    SELECT doc_id AS id, source,
      CASE source WHEN 'src5' THEN 'stale' ELSE concat(lang, ', ', source) END AS title,
      source AS original_title, text AS overview,
      CASE WHEN source NOT IN ('src3', 'src7')
        THEN DATE '1995-01-01' + CAST(n_chars % 9000 AS INTEGER) END AS release_date,
      CAST(round_even(n_chars % 300 + CAST(0.5 AS DOUBLE), 0) AS BIGINT) AS runtime,
      'Released' AS status,
      CAST(concat(n_chars % 10, '.', doc_id) AS DOUBLE) AS vote_average,
      CASE WHEN source <> 'src11' THEN n_chars END AS vote_count,
      n_chars % 1000 + CAST(0.25 AS DOUBLE) AS popularity,
      concat('/', lang, '.jpg') AS poster_path, CAST(NULL AS VARCHAR) AS backdrop_path,
      n_chars * 1000 AS budget, CAST(1000 AS BIGINT) AS revenue
    FROM documents WHERE doc_id <> 0)"""

VALID_SQL = DETAILS_SQL + """,
  valid AS (SELECT * FROM details WHERE source NOT IN ('src3', 'src11'))"""

LINES_SQL = """
  lines AS (
    SELECT doc_id AS movie_id, source, unnest(string_split(text, chr(10))) AS name,
      generate_subscripts(string_split(text, chr(10)), 1) AS pos
    FROM documents)"""

CAST_SQL = """
  cast_ids AS (
    SELECT movie_id, source, name, pos,
      CASE WHEN name <> '' THEN ascii(name) + length(name) END AS person_id
    FROM lines WHERE pos <= 8),
  kept_cast AS (
    SELECT movie_id, source, CAST(person_id AS BIGINT) AS person_id, name, pos FROM cast_ids
    WHERE person_id <> 0
    QUALIFY row_number() OVER (PARTITION BY movie_id, person_id ORDER BY pos) = 1)"""

CREW_SQL = f"""
  lead_crew AS (
    SELECT movie_id, source,
      CASE WHEN length(name) <= {NO_ID_LINE} THEN length(name) END AS person_id,
      CASE WHEN length(name) < {OWN_DEPARTMENT_LINE} THEN 'Second Unit' END AS department
    FROM lines WHERE length(name) >= {DIRECTOR_LINE}
    QUALIFY row_number() OVER (PARTITION BY movie_id ORDER BY pos) = 1)"""

CREDITS_SQL = f"""{LINES_SQL}, {CAST_SQL}, {CREW_SQL},
  credits AS (
    SELECT movie_id, person_id, 'cast' AS credit_type, name AS character_name,
      pos - 1 AS credit_order, 'Acting' AS department, 'Actor' AS job
    FROM kept_cast WHERE source <> 'src9' AND movie_id <> 0
    UNION ALL
    SELECT movie_id, person_id, 'crew', NULL, NULL, coalesce(department, 'Directing'), 'Director'
    FROM lead_crew WHERE person_id <> 0 AND source <> 'src9' AND movie_id <> 0)"""

GENRES_SQL = f"""
  genres AS (
    SELECT DISTINCT doc_id AS movie_id, genre_name
    FROM (SELECT doc_id, unnest(string_split(text, ' ')) AS genre_name FROM documents)
    WHERE length(genre_name) >= {GENRE_LENGTH} AND doc_id <> 0)"""

PEOPLE_SQL = """
  persons AS (
    SELECT c_custkey AS id, c_name AS name, CAST(NULL AS VARCHAR) AS profile_path,
      CAST(c_nationkey AS BIGINT) AS gender, c_mktsegment AS known_for_department
    FROM customer WHERE c_custkey <> 0)"""
