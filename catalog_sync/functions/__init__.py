"""Column -> Column functions (no Python UDFs)."""

from catalog_sync.functions.dates import (
    date_or_epoch,
    days_before,
    format_date,
    is_date_text,
    literal_for,
    parse_date,
    period_days,
    period_start,
    year_of,
)
from catalog_sync.functions.numbers import (
    format_4dp,
    parse_number,
    round_4dp,
    round_to_int,
    truncate_to_int,
)
from catalog_sync.functions.text import (
    blank_if_na,
    commas_to_space,
    genre_line,
    is_digits,
    listing_line,
    loader_text,
    na_to_null,
    newlines_to_space,
    or_default,
    strip,
    strip_quotes,
    valid_utf8,
    writer_text,
)

__all__ = [
    "blank_if_na", "commas_to_space", "date_or_epoch", "days_before", "format_4dp", "format_date",
    "genre_line", "is_date_text", "is_digits", "listing_line", "literal_for", "loader_text", "na_to_null",
    "newlines_to_space", "or_default", "parse_date", "parse_number", "period_days",
    "period_start", "round_4dp", "round_to_int", "strip", "strip_quotes", "truncate_to_int",
    "valid_utf8", "writer_text", "year_of",
]
