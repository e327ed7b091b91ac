"""Column functions over raw text derived from the tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from catalog_sync.functions import (
    date_or_epoch,
    days_before,
    format_4dp,
    format_date,
    is_digits,
    loader_text,
    parse_date,
    parse_number,
    period_days,
    round_4dp,
    round_to_int,
    strip,
    strip_quotes,
    truncate_to_int,
    valid_utf8,
    writer_text,
    year_of,
)
from catalog_sync.operators.incremental import watermark_frame
from catalog_sync.plans.registry import query, table
from catalog_sync.schemas import NA_TOKENS, WHITESPACE

_TOKENS = ", ".join(f"'{t}'" for t in NA_TOKENS)
NUMBER_SQL = r"""CASE WHEN regexp_full_match({0}, '\s*[+-]?(\d+\.?\d*|\.\d+)([eE][+-]?\d+)?\s*')
  THEN try_cast(trim({0}) AS DOUBLE) END"""
DATE_SQL = r"""CASE WHEN regexp_full_match({0}, '\d{{4}}-\d{{1,2}}-\d{{1,2}}')
  THEN CAST(try_strptime({0}, '%Y-%m-%d') AS DATE) END"""


def strip_sql(c: str) -> str:
    return f"trim({c}, '{WHITESPACE}')"


def writer_sql(c: str, commas: bool) -> str:
    out = strip_sql(f"translate(coalesce({c}, ''), chr(10) || chr(13), '  ')")
    return f"replace({out}, ',', ' ')" if commas else out


def loader_sql(c: str, newlines: bool, commas: bool) -> str:
    out = strip_sql(f"CASE WHEN {c} IS NULL OR {c} IN ({_TOKENS}) THEN '' ELSE {c} END")
    if newlines:
        out = f"translate({out}, chr(10) || chr(13), '  ')"
    return f"replace({out}, ',', ' ')" if commas else out


@query(
    "clean_text",
    f"""
    WITH raw AS (
      SELECT 'conversation' AS origin, conv_id AS id, turn,
        CASE role WHEN 'system' THEN 'None' WHEN 'user' THEN chr(9) || ' ' || text || chr(160)
          ELSE text || chr(13) || chr(10) END AS raw
      FROM conversations
      UNION ALL
      SELECT 'document', doc_id, CAST(NULL AS BIGINT),
        CASE lang WHEN 'fr' THEN NULL WHEN 'de' THEN chr(8195) || text ELSE text || chr(28) END
      FROM documents
    )
    SELECT origin, id, turn, {strip_sql('raw')} AS stripped, {writer_sql('raw', False)} AS written,
      {writer_sql('raw', True)} AS written_no_commas, {loader_sql('raw', False, False)} AS loaded,
      {loader_sql('raw', True, True)} AS loaded_no_commas
    FROM raw""",
)
def clean_text(spark, d):
    text = F.col("text")
    turns = table(spark, d, "conversations").select(
        F.lit("conversation").alias("origin"),
        F.col("conv_id").alias("id"),
        "turn",
        F.when(F.col("role") == "system", "None")
        .when(F.col("role") == "user", F.concat(F.lit("\t "), text, F.lit("\xa0")))
        .otherwise(F.concat(text, F.lit("\r\n")))
        .alias("raw"),
    )
    documents = table(spark, d, "documents").select(
        F.lit("document").alias("origin"),
        F.col("doc_id").alias("id"),
        F.lit(None).cast("bigint").alias("turn"),
        F.when(F.col("lang") == "fr", F.lit(None))
        .when(F.col("lang") == "de", F.concat(F.lit("\u2003"), text))
        .otherwise(F.concat(text, F.lit("\x1c")))
        .alias("raw"),
    )
    raw = F.col("raw")
    return turns.unionByName(documents).select(
        "origin", "id", "turn",
        strip(raw).alias("stripped"),
        writer_text(raw).alias("written"),
        writer_text(raw, drop_commas=True).alias("written_no_commas"),
        loader_text(raw).alias("loaded"),
        loader_text(raw, newlines=True, drop_commas=True).alias("loaded_no_commas"),
    )


@query("valid_utf8", "SELECT page_id, html AS cleaned FROM pages")
def valid_utf8_text(spark, d):
    return table(spark, d, "pages").select("page_id", valid_utf8(F.col("html")).alias("cleaned"))


_LINE_KEY = ["l_orderkey", "l_linenumber", "l_partkey", "l_suppkey"]
_NUMBER_TEXT_SQL = """CASE l_linenumber WHEN 1 THEN concat(l_partkey, '.', l_suppkey)
  WHEN 2 THEN concat(' ', l_partkey, 'e2 ') WHEN 3 THEN concat(l_partkey, 'd') WHEN 4 THEN 'inf'
  WHEN 5 THEN concat('-', l_suppkey) WHEN 6 THEN concat(l_partkey, '_0') ELSE '' END"""


def _number_text():
    n, part, supp = F.col("l_linenumber"), F.col("l_partkey"), F.col("l_suppkey")
    return (
        F.when(n == 1, F.concat(part, F.lit("."), supp))
        .when(n == 2, F.concat(F.lit(" "), part, F.lit("e2 ")))
        .when(n == 3, F.concat(part, F.lit("d")))
        .when(n == 4, F.lit("inf"))
        .when(n == 5, F.concat(F.lit("-"), supp))
        .when(n == 6, F.concat(part, F.lit("_0")))
        .otherwise("")
    )


@query(
    "numeric_coerce",
    f"""
    WITH raw AS (SELECT {', '.join(_LINE_KEY)}, {_NUMBER_TEXT_SQL} AS raw FROM lineitem)
    SELECT *, {NUMBER_SQL.format('raw')} AS number FROM raw""",
)
def numeric_coerce(spark, d):
    raw = table(spark, d, "lineitem").select(*_LINE_KEY, _number_text().alias("raw"))
    return raw.withColumn("number", parse_number(F.col("raw")))


_FRACTION_SQL = "CASE l_returnflag WHEN 'A' THEN '.5' WHEN 'N' THEN '.4999' ELSE '.50001' END"


@query(
    "round_half_even",
    f"""
    WITH n AS (
      SELECT {', '.join(_LINE_KEY)},
        CAST(concat(l_partkey, {_FRACTION_SQL}) AS DOUBLE) AS number,
        CAST(concat(l_linenumber, '.0000', l_suppkey, '5') AS DOUBLE) AS small
      FROM lineitem)
    SELECT *, CAST(round_even(number, 0) AS BIGINT) AS whole,
      CAST(round_even(small * CAST(10000 AS DOUBLE), 0) AS DOUBLE) / 10000 AS four_places
    FROM n""",
)
def round_half_even(spark, d):
    flag = F.col("l_returnflag")
    fraction = F.when(flag == "A", ".5").when(flag == "N", ".4999").otherwise(".50001")
    small = F.concat("l_linenumber", F.lit(".0000"), "l_suppkey", F.lit("5"))
    numbers = table(spark, d, "lineitem").select(
        *_LINE_KEY,
        parse_number(F.concat("l_partkey", fraction)).alias("number"),
        parse_number(small).alias("small"),
    )
    return numbers.withColumns(
        {"whole": round_to_int(F.col("number")), "four_places": round_4dp(F.col("small"))}
    )


@query(
    "float_format",
    f"""
    SELECT {', '.join(_LINE_KEY)},
      printf('%.4f', CAST(round_even(l_extendedprice / 7 * CAST(10000 AS DOUBLE), 0) AS DOUBLE)
        / 10000) AS price_text
    FROM lineitem""",
)
def float_format(spark, d):
    price = F.col("l_extendedprice") / 7
    return table(spark, d, "lineitem").select(*_LINE_KEY, format_4dp(price).alias("price_text"))


@query(
    "date_coerce",
    f"""
    WITH raw AS (
      SELECT o_orderkey, CASE
        WHEN o_orderstatus = 'F' THEN strftime(o_orderdate, '%Y-%m-%d')
        WHEN o_orderstatus = 'O' THEN
          concat(year(o_orderdate), '-', month(o_orderdate), '-', day(o_orderdate))
        WHEN o_orderpriority = '1-URGENT' THEN '2020-02-30'
        WHEN o_orderpriority = '2-HIGH' THEN ''
        ELSE strftime(o_orderdate, '%Y/%m/%d') END AS raw
      FROM orders)
    SELECT o_orderkey, raw, {DATE_SQL.format('raw')} AS parsed,
      strftime(coalesce({DATE_SQL.format('raw')}, DATE '1970-01-01'), '%Y-%m-%d') AS written,
      CAST(year({DATE_SQL.format('raw')}) AS BIGINT) AS release_year
    FROM raw""",
)
def date_coerce(spark, d):
    date, status, priority = F.col("o_orderdate"), F.col("o_orderstatus"), F.col("o_orderpriority")
    raw = (
        F.when(status == "F", F.date_format(date, "yyyy-MM-dd"))
        .when(status == "O", F.concat_ws("-", F.year(date), F.month(date), F.day(date)))
        .when(priority == "1-URGENT", "2020-02-30")
        .when(priority == "2-HIGH", "")
        .otherwise(F.date_format(date, "yyyy/MM/dd"))
    )
    parsed = parse_date(F.col("raw"))
    return table(spark, d, "orders").select("o_orderkey", raw.alias("raw")).select(
        "o_orderkey", "raw",
        parsed.alias("parsed"),
        format_date(date_or_epoch(parsed)).alias("written"),
        year_of(parsed).cast("bigint").alias("release_year"),
    )


@query(
    "id_truncate_vs_round",
    f"""
    WITH n AS (
      SELECT p_partkey, CASE p_type WHEN 'PROMO' THEN concat(p_partkey, '.7')
        WHEN 'SMALL' THEN concat(p_partkey, '.5') WHEN 'LARGE' THEN 'abc'
        ELSE concat('"', p_partkey, '"') END AS raw FROM part)
    SELECT p_partkey, raw, trim(raw, '"') AS unquoted,
      CAST(trunc({NUMBER_SQL.format("trim(raw, '\"')")}) AS BIGINT) AS truncated,
      CAST(round_even({NUMBER_SQL.format("trim(raw, '\"')")}, 0) AS BIGINT) AS rounded
    FROM n""",
)
def id_truncate_vs_round(spark, d):
    kind, key = F.col("p_type"), F.col("p_partkey")
    raw = (
        F.when(kind == "PROMO", F.concat(key, F.lit(".7")))
        .when(kind == "SMALL", F.concat(key, F.lit(".5")))
        .when(kind == "LARGE", "abc")
        .otherwise(F.concat(F.lit('"'), key, F.lit('"')))
    )
    number = parse_number(F.col("unquoted"))
    return (
        table(spark, d, "part")
        .select("p_partkey", raw.alias("raw"))
        .withColumn("unquoted", strip_quotes(F.col("raw")))
        .withColumns({"truncated": truncate_to_int(number), "rounded": round_to_int(number)})
    )


@query(
    "strip_quotes",
    """SELECT doc_id, trim(concat('""', text, '"'), '"') AS unquoted FROM documents""",
)
def strip_quotes_text(spark, d):
    quoted = F.concat(F.lit('""'), "text", F.lit('"'))
    return table(spark, d, "documents").select("doc_id", strip_quotes(quoted).alias("unquoted"))


@query(
    "digits_test",
    """SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, raw,
         regexp_full_match(raw, '[0-9]+') AS digits
       FROM (SELECT *, """ + _NUMBER_TEXT_SQL + """ AS raw FROM lineitem
             UNION ALL
             SELECT *, CAST(l_partkey AS VARCHAR) AS raw FROM lineitem)""",
)
def digits_test(spark, d):
    lines = table(spark, d, "lineitem")
    terms = lines.select(*_LINE_KEY, _number_text().alias("raw")).unionByName(
        lines.select(*_LINE_KEY, F.col("l_partkey").cast("string").alias("raw"))
    )
    return terms.withColumn("digits", is_digits(F.col("raw")))


_PERIODS = ["day", "week", "month", "200", "-3", ""]


@query(
    "period_start_dates",
    """
    SELECT p.period, CAST(w.mark AS DATE) - CAST(p.days AS INTEGER) AS start_date
    FROM (SELECT max(o_orderdate) AS mark FROM orders) w,
      (VALUES ('day', 1), ('week', 7), ('month', 30), ('200', 200), ('-3', -3), ('', 0))
        AS p(period, days)""",
)
def period_start_dates(spark, d):
    mark = watermark_frame(table(spark, d, "orders"), "o_orderdate")
    starts = F.array(
        *[
            F.struct(
                F.lit(p).alias("period"),
                days_before(F.col("watermark").cast("date"), period_days(p)).alias("start_date"),
            )
            for p in _PERIODS
        ]
    )
    return mark.select(F.inline(starts))
