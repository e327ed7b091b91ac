"""Text cleaning. Every function takes and returns a string Column."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from catalog_sync.schemas import NA_TOKENS, WHITESPACE


def strip(c: Column) -> Column:
    """Trim all Unicode whitespace from both ends (``F.trim`` only knows the space)."""
    return F.btrim(c, F.lit(WHITESPACE))


def _to_space(c: Column, character: str) -> Column:
    # A byte search; F.translate looks every character up in a map and is ~10x slower on long text.
    return F.replace(c, F.lit(character), F.lit(" "))


def newlines_to_space(c: Column) -> Column:
    return _to_space(_to_space(c, "\n"), "\r")


def commas_to_space(c: Column) -> Column:
    return _to_space(c, ",")


def na_to_null(c: Column) -> Column:
    """Missing-value tokens become NULL. Matched on the raw cell, before any trimming."""
    return F.when(~c.isin(NA_TOKENS), c)


def blank_if_na(c: Column) -> Column:
    return F.coalesce(na_to_null(c), F.lit(""))


def valid_utf8(c: Column) -> Column:
    """Drop byte sequences that are not UTF-8; valid strings pass through untouched."""
    cleaned = F.replace(F.make_valid_utf8(c), F.lit("\ufffd"), F.lit(""))
    return F.when(F.is_valid_utf8(c), c).otherwise(cleaned)


def strip_quotes(c: Column) -> Column:
    return F.btrim(c, F.lit('"'))


def is_digits(c: Column) -> Column:
    return c.rlike("^[0-9]+$")


def or_default(c: Column, default: str) -> Column:
    return F.coalesce(c, F.lit(default))


def writer_text(c: Column, drop_commas: bool = False) -> Column:
    """Cell of a text column on its way into a CSV file: a missing value becomes ``''``."""
    out = strip(newlines_to_space(F.coalesce(c, F.lit(""))))
    if drop_commas:
        out = commas_to_space(out)
    return valid_utf8(out)


def loader_text(c: Column, newlines: bool = False, drop_commas: bool = False) -> Column:
    """Cell of a text column on its way out of a CSV file. Trims before replacing newlines, so a
    newline inside the text survives as a space where an outer one is trimmed away."""
    out = strip(blank_if_na(c))
    if newlines:
        out = newlines_to_space(out)
    if drop_commas:
        out = commas_to_space(out)
    return out


def listing_line(ordinal: Column, title: Column, date: Column, id_: Column) -> Column:
    """Display line of a search result; a missing title shows as ``null``."""
    return F.format_string("%d. %s (%s) - ID: %d", ordinal, title, date, id_)


def genre_line(genres: Column) -> Column:
    return F.concat(F.lit("   Genres: "), genres)
