import datetime as dt

import pytest
from pyspark.sql import functions as F

from catalog_sync import functions as fn
from catalog_sync.schemas import NA_TOKENS, WHITESPACE


def apply(spark, values, column, kind="string"):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], f"i int, v {kind}")
    return [r.x for r in df.select("i", column(F.col("v")).alias("x")).orderBy("i").collect()]


def test_strip_equals_python(spark):
    values = [f"{w} a{w}b {w}" for w in WHITESPACE] + ["", " ", "  x", None]
    assert apply(spark, values, fn.strip) == [v.strip() if v is not None else None for v in values]


def test_whitespace_is_what_python_strips():
    assert set(WHITESPACE) == {chr(c) for c in range(0x110000) if chr(c).isspace()}


def test_newlines_and_commas(spark):
    assert apply(spark, ["a\r\nb,c"], fn.newlines_to_space) == ["a  b,c"]
    assert apply(spark, ["a,,b"], fn.commas_to_space) == ["a  b"]


def test_na_tokens_match_before_trimming(spark):
    assert apply(spark, [*NA_TOKENS, " NA", "Nones", "x"], fn.blank_if_na) == [
        *[""] * len(NA_TOKENS), " NA", "Nones", "x"]
    assert apply(spark, [None], fn.blank_if_na) == [""]


def test_writer_and_loader_order(spark):
    raw = ["\n a\nb, c \n", "None", None, " x "]
    assert apply(spark, raw, lambda c: fn.writer_text(c, True)) == ["a b  c", "None", "", "x"]
    assert apply(spark, raw, lambda c: fn.loader_text(c, True, True)) == ["a b  c", "", "", "x"]
    assert apply(spark, ["a\nb"], fn.loader_text) == ["a\nb"]


def test_valid_utf8_drops_bad_bytes(spark):
    df = spark.sql("SELECT cast(X'61FF62' AS string) AS v UNION ALL SELECT 'ok�'")
    assert {r.x for r in df.select(fn.valid_utf8(F.col("v")).alias("x")).collect()} == {
        "ab", "ok�"}


@pytest.mark.parametrize("text, number", [
    ("1", 1.0), (" 12\t", 12.0), ("-.5", -0.5), ("2.", 2.0), ("1e3", 1000.0), ("+7E-1", 0.7),
    ("1d", None), ("1f", None), ("inf", None), ("NaN", None), ("1e400", None), ("", None),
    ("1_000", None), ("abc", None), ("0x10", None), ("1,5", None), (None, None),
])
def test_parse_number(spark, text, number):
    assert apply(spark, [text], fn.parse_number) == [number]


def test_rounding(spark):
    halves = [0.5, 1.5, 2.5, -0.5, -1.5, 1e30, None]
    assert apply(spark, halves, fn.round_to_int, "double") == [0, 2, 2, 0, -2, None, None]
    assert apply(spark, [1.7, -1.7, 7.0], fn.truncate_to_int, "double") == [1, -1, 7]
    numpy = pytest.importorskip("numpy")
    values = [0.00005, 1.00005, 2.67545, 123.45675, 1 / 7, -3.33335]
    assert apply(spark, values, fn.round_4dp, "double") == [float(numpy.round(v, 4)) for v in values]
    assert apply(spark, [7.1, 0.1 + 0.2, None], fn.format_4dp, "double") == [
        "7.1000", "0.3000", None]


def test_parse_date(spark):
    pandas = pytest.importorskip("pandas")
    texts = ["2020-01-05", "2020-1-5", "2020-02-30", "soon", "", " 2020-01-05", "20-01-05",
             "2020-01-05 00:00:00", "2020/01/05", "+2020-01-05"]
    want = [None if pandas.isna(v) else v.date()
            for v in pandas.to_datetime(pandas.Series(texts), format="%Y-%m-%d", errors="coerce")]
    assert apply(spark, texts, fn.parse_date) == want
    written = apply(spark, ["2020-1-5", "soon"],
                    lambda c: fn.format_date(fn.date_or_epoch(fn.parse_date(c))))
    assert written == ["2020-01-05", "1970-01-01"]


def test_digits_and_quotes(spark):
    assert apply(spark, ["12", "1.2", "", "-1", "1\n"], fn.is_digits)[:4] == [
        True, False, False, False]
    assert apply(spark, ['"7"', '""a"b"'], fn.strip_quotes) == ["7", 'a"b']


@pytest.mark.parametrize("period, days", [
    ("day", 1), ("week", 7), ("month", 30), ("200", 200), ("-3", -3), (None, 0), ("", 0), (5, 5),
])
def test_period(period, days):
    mark = dt.date(2024, 3, 1)
    assert fn.period_start(mark, period) == mark - dt.timedelta(days=days)


def test_unknown_period():
    with pytest.raises(ValueError, match="decade"):
        fn.period_days("decade")
