"""Watermarks, discovery, search and bounded listings."""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from catalog_sync.functions import genre_line, listing_line, literal_for, or_default
from catalog_sync.operators.dedup import top_n
from catalog_sync.operators.paging import ordinals
from catalog_sync.operators.shape import usable_id
from catalog_sync.schemas import NO_DATE


def watermark_frame(df: DataFrame, column: str, ceiling: dt.date | None = None) -> DataFrame:
    """Highest non-null value as a one-row frame; a ceiling ignores anything beyond it."""
    rows = df.filter(F.col(column).isNotNull())
    if ceiling is not None:
        rows = rows.filter(F.col(column) <= literal_for(df, column, ceiling))
    return rows.agg(F.max(column).alias("watermark"))


def watermark(df: DataFrame, column: str, ceiling: dt.date | None = None):
    """The watermark as a value (None on an empty table). One scalar is fetched so that the
    filter built from it is a literal and reaches the scan."""
    return watermark_frame(df, column, ceiling).first()[0]


def row_count(df: DataFrame) -> DataFrame:
    return df.agg(F.count("*").alias("n"))


def distinct_ids(df: DataFrame, column: str) -> DataFrame:
    return df.agg(F.count_distinct(column).alias("n"))


def earliest_year(df: DataFrame, column: str) -> DataFrame:
    return df.agg(F.year(F.min(column)).alias("year"))


def since(df: DataFrame, column: str, start: dt.date) -> DataFrame:
    return df.filter(F.col(column) >= literal_for(df, column, start))


def in_years(df: DataFrame, column: str, first: int | None, last: int | None) -> DataFrame:
    """Inclusive year range written as a date range, which a file scan can evaluate."""
    df = df.filter(F.col(column).isNotNull())
    if first is not None:
        df = df.filter(F.col(column) >= literal_for(df, column, dt.date(first, 1, 1)))
    if last is not None:
        df = df.filter(F.col(column) < literal_for(df, column, dt.date(last + 1, 1, 1)))
    return df


def exclude_flags(df: DataFrame, flags: Sequence[str]) -> DataFrame:
    """Drop rows with any flag set; a missing flag is not set."""
    for flag in flags:
        df = df.filter(~F.coalesce(F.col(flag), F.lit(False)))
    return df


def above_id(df: DataFrame, column: str, since_id: int | None) -> DataFrame:
    return df.filter(F.col(column) > since_id) if since_id else df


def recent(df: DataFrame, column: str, as_of: dt.datetime, hours: int = 1) -> DataFrame:
    oldest = as_of - dt.timedelta(hours=hours)
    return df.filter(F.col(column) > literal_for(df, column, oldest))


def sorted_ids(df: DataFrame, column: str) -> DataFrame:
    return df.select(column).distinct().orderBy(column)


def newest_first(
    df: DataFrame, date: str, id_: str, max_pages: int | None = None, page_size: int = 20
) -> DataFrame:
    """Newest rows first. Without a page cap nothing is sorted away, so the rows come as they
    are: order only matters to the cap."""
    if max_pages is None:
        return df
    order = [F.col(date).desc_nulls_last(), F.col(id_).desc()]
    return df.orderBy(*order).limit(max_pages * page_size)


def stalest_page(
    df: DataFrame, updated_at: str, id_: str, limit: int, offset: int = 0
) -> DataFrame:
    """A page of the refresh queue: never updated first, then the oldest update. A view for the
    front of the queue (offset + limit rows are ranked); further back, ``paging.page_after`` ranks a
    page wherever it is."""
    return df.orderBy(F.col(updated_at).asc_nulls_first(), F.col(id_)).offset(offset).limit(limit)


def page_results(
    pages: DataFrame, max_pages: int | None = None, request: Sequence[str] = ()
) -> DataFrame:
    """Rows of the result pages, of all of them unless there is a page cap; ``request`` columns
    say what was asked."""
    last = F.col("total_pages") if max_pages is None else F.least("total_pages", F.lit(max_pages))
    wanted = pages.filter(F.col("page") <= last)
    return wanted.select(*request, "page", F.inline("results"))


def discover_ids(
    df: DataFrame,
    id_: str = "id",
    date: str = "release_date",
    sort: Sequence[Column] | None = None,
    year: int | None = None,
    latest_year: int | None = None,
    since_id: int | None = None,
    max_pages: int | None = None,
    page_size: int = 20,
    flags: Sequence[str] = ("adult", "video"),
) -> DataFrame:
    """Ids to process, ascending, of all years or of one. With ``max_pages`` only the most popular
    rows of each year, up to so many pages. The listing holds each id once. The high-water filter
    comes after the cap, as it looks at pages already fetched."""
    order = sort or [F.col("popularity").desc_nulls_last(), F.col(id_)]
    df = in_years(exclude_flags(df, flags), date, year, year or latest_year)
    ranked = df.filter(F.col(date).isNotNull())
    if max_pages is not None:
        listed = ranked.withColumn("_year", F.year(date))
        ranked = top_n(listed, ["_year"], order, max_pages * page_size, row_id=[id_])
    ids = above_id(ranked.filter(usable_id(F.col(id_))), id_, since_id)
    return sorted_ids(ids, id_)


def is_id(query: str) -> bool:
    return query.isascii() and query.isdigit()


def title_search(
    df: DataFrame,
    query: str,
    id_: str = "id",
    title: str = "title",
    popularity: str = "popularity",
    page_size: int | None = None,
    flags: Sequence[str] = (),
    page: int = 1,
) -> DataFrame:
    """ASCII digits look up an id; any other text matches inside the title, ignoring case. All hits,
    or with ``page_size`` the given page of them, the most popular first."""
    if is_id(query):
        return df.filter(F.col(id_) == int(query))
    hits = exclude_flags(df, flags).filter(
        F.contains(F.lower(title), F.lower(F.lit(query)))
    )
    return hits if page_size is None else title_page(hits, page_size, page, id_, popularity)


def title_page(
    hits: DataFrame, page_size: int, page: int = 1, id_: str = "id", popularity: str = "popularity"
) -> DataFrame:
    order = [F.col(popularity).desc_nulls_last(), F.col(id_)]
    return hits.orderBy(*order).offset((page - 1) * page_size).limit(page_size)


def listing(
    results: DataFrame,
    order: Sequence[Column],
    id_: str = "id",
    title: str = "title",
    date: Column | None = None,
    genres: Column | None = None,
    page_size: int | None = None,
) -> DataFrame:
    """Numbered display lines. ``page_size`` says that the results are one page of so many rows at most,
    which one task can number; without it they are numbered by ranges."""
    shown = or_default(date if date is not None else F.lit(None).cast("string"), NO_DATE)
    if page_size is None:
        out = ordinals(results, order).withColumn("ordinal", F.col("ordinal").cast("int"))
    else:
        out = results.withColumn("ordinal", F.row_number().over(Window.orderBy(*order)))
    out = out.withColumn("line", listing_line(F.col("ordinal"), F.col(title), shown, F.col(id_)))
    if genres is not None:
        out = out.withColumn("genre_line", genre_line(genres))
    return out
