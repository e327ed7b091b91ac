"""Table and document schemas, keys and fixed vocabularies of the catalog."""

from __future__ import annotations

# --- catalog tables ---------------------------------------------------------
# Parents come before children, so a loader that walks the dict satisfies the foreign keys.

TABLES: dict[str, dict[str, str]] = {
    "movies": {
        "id": "BIGINT", "title": "STRING", "original_title": "STRING", "overview": "STRING",
        "release_date": "DATE", "runtime": "BIGINT", "status": "STRING",
        "vote_average": "DOUBLE", "vote_count": "BIGINT", "popularity": "DOUBLE",
        "poster_path": "STRING", "backdrop_path": "STRING", "budget": "BIGINT",
        "revenue": "BIGINT", "updated_at": "TIMESTAMP",
    },
    "people": {
        "id": "BIGINT", "name": "STRING", "profile_path": "STRING", "gender": "BIGINT",
        "known_for_department": "STRING",
    },
    "credits": {
        "movie_id": "BIGINT", "person_id": "BIGINT", "credit_type": "STRING",
        "character_name": "STRING", "credit_order": "BIGINT", "department": "STRING",
        "job": "STRING",
    },
    "genres": {"movie_id": "BIGINT", "genre_name": "STRING"},
}
KEYS: dict[str, list[str]] = {
    "movies": ["id"],
    "people": ["id"],
    "credits": ["movie_id", "person_id", "credit_type"],
    "genres": ["movie_id", "genre_name"],
}
# Tables the store keeps beside the catalog: the ledger of landing files, the documents taken in, the
# person ids that credits mention and the ids by three letters of their titles. Those of LOOSE repeat their key, which only deals them out.
LANDED_FILES, MENTIONED, ERRORS, TITLE_GRAMS = "landed_files", "mentioned", "errors", "title_grams"
SIDE_KEYS: dict[str, list[str]] = {
    LANDED_FILES: ["path"],
    "landed_details": ["id"],
    "landed_credits": ["movie_id"],
    "landed_persons": ["id"],
    MENTIONED: ["person_id"],
    TITLE_GRAMS: ["gram"],
}
LOOSE = {"landed_details", "landed_credits", "landed_persons", MENTIONED, TITLE_GRAMS}
# child table -> [(child column, parent table, parent column)]
FOREIGN_KEYS: dict[str, list[tuple[str, str, str]]] = {
    "credits": [("movie_id", "movies", "id"), ("person_id", "people", "id")],
    "genres": [("movie_id", "movies", "id")],
}
# Columns a CSV file of each table carries (movies without the bookkeeping column).
CSV_COLUMNS: dict[str, list[str]] = {
    name: [c for c in columns if c != "updated_at"] for name, columns in TABLES.items()
}
UPDATABLE_MOVIE_COLUMNS = [c for c in CSV_COLUMNS["movies"] if c != "id"]

# --- landing documents ------------------------------------------------------
# Numbers arrive as STRING so that bad values reach validation instead of being nulled by the
# JSON reader. `fetched_at` / `fetch_status` describe the fetch, `status` is the release state.

CORRUPT = "_corrupt_record"
_LANDING_TAIL = f"fetched_at TIMESTAMP, fetch_status STRING, {CORRUPT} STRING"

MOVIE_DOC = (
    "id BIGINT, title STRING, original_title STRING, overview STRING, release_date STRING, "
    "runtime STRING, status STRING, vote_average STRING, vote_count STRING, popularity STRING, "
    "poster_path STRING, backdrop_path STRING, budget STRING, revenue STRING, "
    "adult BOOLEAN, video BOOLEAN, genres ARRAY<STRUCT<name: STRING>>, " + _LANDING_TAIL
)
CREDITS_DOC = (
    "movie_id BIGINT, "
    "cast ARRAY<STRUCT<id: BIGINT, name: STRING, character: STRING, order: BIGINT>>, "
    "crew ARRAY<STRUCT<id: BIGINT, name: STRING, job: STRING, department: STRING>>, "
    + _LANDING_TAIL
)
PERSON_DOC = (
    "id BIGINT, name STRING, profile_path STRING, gender BIGINT, known_for_department STRING, "
    + _LANDING_TAIL
)
PAGE_DOC = (
    "page INT, total_pages INT, results ARRAY<STRUCT<id: BIGINT, title: STRING, "
    "release_date: STRING, popularity: DOUBLE, adult: BOOLEAN, video: BOOLEAN>>, "
    f"{CORRUPT} STRING"
)

# --- fixed values -----------------------------------------------------------
# The values below must equal those of the catalog being replaced for results to match.

MAX_CAST = 8
LEAD_JOB = "Director"
LEAD_DEPARTMENT = "Directing"
CAST_DEPARTMENT = "Acting"
CAST_JOB = "Actor"
NO_DATE = "N/A"
NO_GENRES = "No genres"
MAX_PAGES_PER_YEAR = 300
MAX_PAGES_SINCE_DATE = 20
RESPONSE_TTL_SECONDS = 3600
ERROR_SAMPLE_SIZE = 10

REQUIRED_FIELDS = ["id", "title", "release_date"]
NUMERIC_FIELDS = ["runtime", "vote_average", "vote_count", "popularity", "budget", "revenue"]
INTEGER_FIELDS = ["runtime", "vote_count", "budget", "revenue"]
DECIMAL_FIELDS = ["vote_average", "popularity"]
TEXT_FIELDS = ["title", "original_title", "overview", "status", "poster_path", "backdrop_path"]

ERROR_CATEGORIES = [
    "not_found",
    "timeout",
    "api_error",
    "processing_error",
    "removed_movies",
    "validation_error",
    "rate_limit",
    "no_credits",
    "no_actors",
]

# Missing-value tokens of a CSV cell: eight named by the catalog, the rest are the public pandas
# read_csv defaults.
NA_TOKENS = [
    "", "NA", "NULL", "null", "None", "none", "nan", "NaN",
    "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan", "1.#IND", "1.#QNAN",
    "<NA>", "N/A", "n/a",
]

# Code points of the characters Python's str.strip() removes.
WHITESPACE = "".join(
    chr(cp)
    for cp in [*range(0x09, 0x0E), *range(0x1C, 0x21), 0x85, 0xA0, 0x1680, *range(0x2000, 0x200B),
               0x2028, 0x2029, 0x202F, 0x205F, 0x3000]
)


def table_ddl(name: str) -> str:
    """Column list of a catalog table, as ``spark.read.schema`` and ``CREATE TABLE`` take it."""
    return ", ".join(f"{column} {kind}" for column, kind in TABLES[name].items())
