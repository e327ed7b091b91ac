"""Number parsing, rounding and rendering."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Plain decimal or scientific notation. Spark's own cast also takes '1d', '1f', 'NaN' and
# 'Infinity', which are not numbers here.
NUMBER_PATTERN = r"^\s*[+-]?(\d+\.?\d*|\.\d+)([eE][+-]?\d+)?\s*$"


def parse_number(c: Column) -> Column:
    """Text to double; anything that is not a finite number becomes NULL."""
    number = F.btrim(c, F.lit(" \t\n\x0b\x0c\r")).try_cast("double")
    return F.when(c.rlike(NUMBER_PATTERN) & (F.abs(number) < F.lit(float("inf"))), number)


def round_to_int(d: Column) -> Column:
    """Nearest integer, ties to even (``F.round`` takes ties away from zero)."""
    return F.rint(d).try_cast("bigint")


def truncate_to_int(d: Column) -> Column:
    return d.try_cast("bigint")


def round_4dp(d: Column) -> Column:
    """Four decimals, scaled and rounded half-even in double arithmetic."""
    return F.rint(d * 10000.0) / 10000.0


def format_4dp(d: Column) -> Column:
    # format_string prints a NULL as 'null'.
    return F.when(d.isNotNull(), F.format_string("%.4f", round_4dp(d)))
