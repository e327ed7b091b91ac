"""Nested documents to parent and child rows. Everything here works inside one row, no shuffle."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from catalog_sync.functions import (
    parse_date,
    parse_number,
    round_to_int,
)
from catalog_sync.operators.dedup import fresh_latest
from catalog_sync.operators.joins import exclude_existing, keep_known, key_set, sized
from catalog_sync.schemas import (
    CAST_DEPARTMENT,
    CAST_JOB,
    CORRUPT,
    CSV_COLUMNS,
    DECIMAL_FIELDS,
    INTEGER_FIELDS,
    LEAD_DEPARTMENT,
    LEAD_JOB,
    MAX_CAST,
    NO_GENRES,
)


TIE = "_tie"
CAST_ARRAY = "array<struct<id:bigint,name:string,character:string,order:bigint>>"
CREW_ARRAY = "array<struct<id:bigint,name:string,job:string,department:string>>"
GENRE_ARRAY = "array<struct<name:string>>"


def usable_id(c: Column) -> Column:
    """An id counts as missing when it is NULL or 0."""
    return c.isNotNull() & (c != 0)


def or_empty(array: Column, like: str) -> Column:
    """A missing array is an empty one; ``like`` is its SQL type."""
    return F.coalesce(array, F.array().cast(like))


def first_by_position(array: Column, n: int) -> Column:
    return F.slice(array, 1, n)


def first_match(array: Column, predicate: Callable[[Column], Column]) -> Column:
    """First element satisfying the predicate, NULL when none does."""
    return F.get(F.filter(array, predicate), F.lit(0))


def distinct_by(array: Column, field: str, like: str) -> Column:
    """Keep the first element of each field value; ``like`` is the array's SQL type."""
    def keep_new(kept: Column, x: Column) -> Column:
        seen = F.exists(kept, lambda k: k[field] == x[field])
        return F.when(seen, kept).otherwise(F.concat(kept, F.array(x)))

    return F.reduce(array, F.array().cast(like), keep_new)


def explode_children(
    df: DataFrame, parent_key: str, array: Column, child_key: str | None = None,
    position: str | None = None,
) -> DataFrame:
    """One row per array element: the parent key, optionally the position, the element's fields."""
    exploded = df.select(
        F.col(parent_key).alias(child_key or parent_key),
        F.posexplode(array).alias("_pos", "_item"),
    )
    kept = [child_key or parent_key]
    if position:
        exploded = exploded.withColumnRenamed("_pos", position)
        kept.append(position)
    return exploded.select(*kept, "_item.*")


def genre_names(genres: Column) -> Column:
    names = F.transform(or_empty(genres, GENRE_ARRAY), lambda g: g["name"])
    return F.array_distinct(F.filter(names, lambda n: n.isNotNull()))


def genre_string(genres: Column) -> Column:
    """Names in document order, comma separated; a document without genres says so."""
    names = F.transform(or_empty(genres, GENRE_ARRAY), lambda g: g["name"])
    return F.when(F.size(names) == 0, NO_GENRES).otherwise(F.array_join(names, ", "))


def cast_credits(
    cast: Column, legacy_labels: bool = False, max_cast: int | None = MAX_CAST
) -> Column:
    """First ``max_cast`` cast members (all, if None) as credit structs. The cut comes before the id
    check, so an entry without id uses up its place."""
    top = or_empty(cast, CAST_ARRAY)
    if max_cast is not None:
        top = first_by_position(top, max_cast)
    kept = distinct_by(F.filter(top, lambda p: usable_id(p["id"])), "id", CAST_ARRAY)
    label = (lambda v: F.lit(None).cast("string")) if legacy_labels else F.lit
    return F.transform(
        kept,
        lambda p: F.struct(
            p["id"].alias("person_id"),
            F.lit("cast").alias("credit_type"),
            p["character"].alias("character_name"),
            p["order"].alias("credit_order"),
            label(CAST_DEPARTMENT).alias("department"),
            label(CAST_JOB).alias("job"),
        ),
    )


def crew_credits(crew: Column) -> Column:
    """The first director as an array of at most one credit struct. A first director without id
    is not replaced by the second."""
    lead = first_match(or_empty(crew, CREW_ARRAY), lambda p: p["job"] == LEAD_JOB)
    credit = F.struct(
        lead["id"].alias("person_id"),
        F.lit("crew").alias("credit_type"),
        F.lit(None).cast("string").alias("character_name"),
        F.lit(None).cast("bigint").alias("credit_order"),
        F.coalesce(lead["department"], F.lit(LEAD_DEPARTMENT)).alias("department"),
        lead["job"].alias("job"),
    )
    return F.filter(F.array(credit), lambda c: usable_id(c["person_id"]))


def credit_list(
    df_cast: Column, df_crew: Column, legacy_labels: bool = False, max_cast: int | None = MAX_CAST
) -> Column:
    return F.concat(cast_credits(df_cast, legacy_labels, max_cast), crew_credits(df_crew))


def good_fetch(docs: DataFrame, key: str) -> Column:
    """Failed fetches and unreadable lines carry no document."""
    good = usable_id(F.col(key))
    if CORRUPT in docs.columns:
        good = good & F.col(CORRUPT).isNull()
    if "fetch_status" in docs.columns:
        good = good & (F.coalesce(F.col("fetch_status"), F.lit("ok")) == "ok")
    return good


def good_documents(docs: DataFrame, key: str, columns: Sequence[Column] | None = None) -> DataFrame:
    """Documents of good fetches, one row per fetch, cut down to the given columns (by default all):
    what is taken apart in the row is not shuffled. ``_tie`` orders fetches of one time."""
    good = docs.filter(good_fetch(docs, key)).drop(CORRUPT)
    payload = [c for c in good.columns if c not in ("fetched_at", key)]
    tie = F.col(TIE) if TIE in payload else F.xxhash64(*payload)
    kept = [F.col(c) for c in payload if c != TIE] if columns is None else list(columns)
    fetched = [F.col("fetched_at")] if "fetched_at" in good.columns else []
    return good.select(key, *kept, *fetched, tie.alias(TIE))


def newest_documents(good: DataFrame, key: str) -> DataFrame:
    """The newest of the good fetches per id."""
    if "fetched_at" not in good.columns:
        return good.drop(TIE)
    return fresh_latest(good, [key], "fetched_at", tie_break=[F.col(TIE)]).drop(TIE)


def latest_documents(docs: DataFrame, key: str, columns: Sequence[Column] | None = None) -> DataFrame:
    return newest_documents(good_documents(docs, key, columns), key)


def typed_movie_columns() -> list[Column]:
    """Movie columns in table types. Unparseable numbers and dates become NULL."""
    out = []
    for c in CSV_COLUMNS["movies"]:
        value = F.col(c)
        if c in INTEGER_FIELDS:
            value = round_to_int(parse_number(value))
        elif c in DECIMAL_FIELDS:
            value = parse_number(value)
        elif c == "release_date":
            value = parse_date(value)
        out.append(value.alias(c))
    return out


def typed_movies(details: DataFrame) -> DataFrame:
    return details.select(*typed_movie_columns())


CREDIT_LIST = "_credits"


def listed_credits(
    credits: DataFrame, legacy_labels: bool = False, max_cast: int | None = MAX_CAST
) -> Column:
    """The credits a document gives, from its cast and crew, or as they were listed when it was
    taken in."""
    if CREDIT_LIST in credits.columns:
        return F.col(CREDIT_LIST)
    return credit_list(F.col("cast"), F.col("crew"), legacy_labels, max_cast).alias(CREDIT_LIST)


def credit_rows(
    credits: DataFrame, legacy_labels: bool = False, max_cast: int | None = MAX_CAST
) -> DataFrame:
    rows = explode_children(credits, "movie_id", listed_credits(credits, legacy_labels, max_cast))
    return rows.select(*CSV_COLUMNS["credits"])


def genre_rows(details: DataFrame) -> DataFrame:
    return details.select(
        F.col("id").alias("movie_id"), F.explode(genre_names(F.col("genres"))).alias("genre_name")
    )


def people_rows(persons: DataFrame) -> DataFrame:
    return persons.select(*CSV_COLUMNS["people"])


def needed_people(
    credits: DataFrame, persons: DataFrame, known: DataFrame | None = None
) -> DataFrame:
    """People the credits mention: each once, minus those already known; a person without a
    document is dropped. The person documents are narrowed to the wanted ids first."""
    ids = key_set(credits, ["person_id"]).withColumnRenamed("person_id", "id")
    if known is not None:
        ids = exclude_existing(ids, known, ["id"])
    return people_rows(latest_documents(keep_known(persons, sized(ids), ["id"], unique=True), "id"))
