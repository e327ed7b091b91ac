"""CSV exchange format of the four catalog tables.

Dialect: header line, every field quoted, quotes doubled, backslashes doubled, UTF-8. Columns are
read as text and typed afterwards, so bad cells turn into NULL under our rules, not the parser's.
"""

from __future__ import annotations

import csv
from collections.abc import Mapping
from functools import reduce
from urllib.parse import unquote

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from catalog_sync.functions import (
    date_or_epoch,
    format_4dp,
    format_date,
    loader_text,
    parse_date,
    parse_number,
    round_to_int,
    strip_quotes,
    truncate_to_int,
    writer_text,
)
from catalog_sync.operators.dedup import ORDINAL
from catalog_sync.schemas import (
    CSV_COLUMNS,
    DECIMAL_FIELDS,
    INTEGER_FIELDS,
    KEYS,
    TABLES,
    TEXT_FIELDS,
)

_EXTRA = "_extra"
_NEVER = "\u0001"
NEWLINE_COLUMNS = ["overview", "title", "original_title", "name"]
LOADER_COMMA_COLUMNS = ["overview"]
WRITER_COMMA_COLUMNS = ["overview", "title", "original_title"]


def table_of(path: str) -> str:
    """Catalog table a CSV path holds, by its base name."""
    name = path.rstrip("/").rsplit("/", 1)[-1]
    table = name.removesuffix(".csv")
    if table not in TABLES:
        raise ValueError(f"unknown CSV table {name!r}: expected one of {sorted(TABLES)}")
    return table


def _read_options(multi_line: bool) -> dict[str, str]:
    return {
        "header": "true",
        "multiLine": str(multi_line).lower(),
        "quote": '"',
        "escape": '"',
        "encoding": "UTF-8",
        "nullValue": _NEVER,
        "emptyValue": "",
        "ignoreLeadingWhiteSpace": "true",
        "mode": "PERMISSIVE",
    }


def headers(spark: SparkSession, path: str) -> dict[tuple[str, ...], list[str]]:
    """Columns of the header line -> files that have it. One row per file reaches the driver; files
    without any line are left out."""
    lines = spark.read.text(path).select(
        "value", F.col("_metadata.file_path").alias("file"),
        F.struct(
            F.col("_metadata.file_block_start").alias("start"),
            F.monotonically_increasing_id().alias("line"),
        ).alias("at"),
    )
    first = lines.where("at.start = 0").groupBy("file").agg(F.min_by("value", "at").alias("line"))
    found: dict[tuple[str, ...], list[str]] = {}
    for row in first.orderBy("file").collect():
        names = tuple(next(csv.reader([row.line.removeprefix("\ufeff")], skipinitialspace=True), ()))
        found.setdefault(names, []).append(unquote(row.file))
    return found


def read_text_cells(
    spark: SparkSession,
    path: str,
    columns: list[str] | None = None,
    multi_line: bool = True,
    overlong: bool = False,
) -> DataFrame:
    """All cells as text plus ``_ordinal``, the row's place in the input (file, offset, line).

    Each file's own header names its columns; columns that a file lacks are NULL. Lines with too many
    fields are skipped (``overlong``: these instead of the others), short ones padded with NULL. A
    file whose cells hold newlines must be read whole by one task (``multi_line``), so large tables
    should come as many files; with ``multi_line=False`` Spark splits files freely.
    """
    groups = {tuple(columns): [path]} if columns else headers(spark, path)
    if not groups:
        raise ValueError(f"no header line in {path}")
    parts = [_cells(spark, files, list(names), multi_line, overlong) for names, files in groups.items()]
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), parts)


def _cells(
    spark: SparkSession, files: list[str], columns: list[str], multi_line: bool, overlong: bool
) -> DataFrame:
    schema = ", ".join(f"`{c}` STRING" for c in [*columns, _EXTRA])
    raw = spark.read.schema(schema).options(**_read_options(multi_line)).csv(files)
    ordinal = F.struct(
        F.col("_metadata.file_path"),
        F.col("_metadata.file_block_start"),
        F.monotonically_increasing_id().alias("line"),
    )
    return (
        raw.select("*", ordinal.alias(ORDINAL))
        .filter(F.col(_EXTRA).isNotNull() if overlong else F.col(_EXTRA).isNull())
        .select(*[_unescape(F.col(c)).alias(c) for c in [*columns, *[_EXTRA] * overlong]], ORDINAL)
    )


def _unescape(c: Column) -> Column:
    return F.when(F.contains(c, F.lit("\\")), F.regexp_replace(c, r"(?s)\\(.)", "$1")).otherwise(c)


def check_header(table: str, columns: list[str], file: str | None = None) -> None:
    """Key columns must be there, other missing columns are filled with NULL."""
    missing = [c for c in KEYS[table] if c not in columns]
    if missing:
        raise ValueError(f"{file or table + '.csv'} lacks required columns {missing}")


def typed_rows(cells: DataFrame, table: str) -> DataFrame:
    """Text cells to the table's types, rows without a usable key dropped."""
    out = []
    for c in CSV_COLUMNS[table]:
        kind = TABLES[table][c]
        if c not in cells.columns:
            out.append(F.lit(None).cast(kind).alias(c))
            continue
        text = loader_text(F.col(c), c in NEWLINE_COLUMNS, c in LOADER_COMMA_COLUMNS)
        if kind == "BIGINT":
            number = parse_number(strip_quotes(text))
            is_foreign_id = table != "movies" and c in ("id", "movie_id", "person_id")
            text = truncate_to_int(number) if is_foreign_id else round_to_int(number)
        elif kind == "DOUBLE":
            text = parse_number(strip_quotes(text))
        elif kind == "DATE":
            text = parse_date(strip_quotes(text))
        out.append(text.alias(c))
    if ORDINAL in cells.columns:
        out.append(F.col(ORDINAL))
    return cells.select(*out).dropna(subset=KEYS[table])


def read_table(spark: SparkSession, path: str, multi_line: bool = True) -> DataFrame:
    """Typed rows of one catalog CSV (a file or a folder of files), with ``_ordinal``."""
    table = table_of(path)
    groups = headers(spark, path)
    for columns, files in groups.items():
        check_header(table, list(columns), f"{table}.csv ({files[0]})")
    parts = [_cells(spark, files, list(names), multi_line, False) for names, files in groups.items()]
    if not parts:
        raise ValueError(f"no header line in {path}")
    cells = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), parts)
    return typed_rows(cells, table)


def overlong_lines(spark: SparkSession, path: str, multi_line: bool = True) -> DataFrame:
    """The lines that ``read_table`` skips for their excess fields: file and the cells as text."""
    cells = read_text_cells(spark, path, multi_line=multi_line, overlong=True)
    names = [c for c in cells.columns if c != ORDINAL]
    return cells.select(
        F.col(f"{ORDINAL}.file_path").alias("file"), F.to_json(F.struct(*names)).alias("cells")
    )


def read_catalog(spark: SparkSession, root: str, multi_line: bool = True) -> dict[str, DataFrame]:
    return {t: read_table(spark, f"{root.rstrip('/')}/{t}.csv", multi_line) for t in TABLES}


def render_cells(df: DataFrame, table: str) -> DataFrame:
    """Typed rows to CSV text. Only movie text is cleaned; a missing movie date is the epoch."""
    out = []
    for c in CSV_COLUMNS[table]:
        cell = F.col(c)
        if table == "movies" and c in TEXT_FIELDS:
            cell = writer_text(cell, c in WRITER_COMMA_COLUMNS)
        elif c in DECIMAL_FIELDS:
            cell = format_4dp(cell)
        elif c in INTEGER_FIELDS or TABLES[table][c] == "BIGINT":
            cell = cell.cast("bigint").cast("string")
        elif TABLES[table][c] == "DATE":
            cell = format_date(date_or_epoch(cell))
        out.append(cell.alias(c))
    return df.select(*out)


def write_text_cells(df: DataFrame, path: str, mode: str = "errorifexists") -> None:
    """Write text columns in the exchange dialect, many files in parallel."""
    escaped = df.select(
        *[F.replace(F.col(c), F.lit("\\"), F.lit("\\\\")).alias(c) for c in df.columns]
    )
    escaped.write.mode(mode).options(
        header="true",
        quoteAll="true",
        quote='"',
        escape='"',
        encoding="UTF-8",
        nullValue="",
        emptyValue="",
        ignoreLeadingWhiteSpace="false",
        ignoreTrailingWhiteSpace="false",
    ).csv(path)


def write_table(df: DataFrame, path: str, mode: str = "errorifexists") -> None:
    write_text_cells(render_cells(df, table_of(path)), path, mode)


def write_catalog(
    tables: Mapping[str, DataFrame], root: str, mode: str = "errorifexists"
) -> None:
    for name, df in tables.items():
        write_table(df, f"{root.rstrip('/')}/{name}.csv", mode)
