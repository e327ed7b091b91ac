"""Landing zone: JSON documents, one per line, one folder per kind."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from catalog_sync.schemas import CORRUPT, CREDITS_DOC, MOVIE_DOC, PAGE_DOC, PERSON_DOC

DOCUMENTS = {
    "details": MOVIE_DOC,
    "credits": CREDITS_DOC,
    "persons": PERSON_DOC,
    "pages": PAGE_DOC,
}


def json_options() -> dict[str, str]:
    """A line that does not parse keeps its text in the corrupt-record column."""
    return {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": CORRUPT}


def _documents(lines: DataFrame, column: str, schema: str) -> DataFrame:
    text = F.col(column)
    parsed = F.from_json(text, schema, json_options())
    return lines.filter(F.trim(text) != "").select(parsed.alias("_doc")).select("_doc.*")


def read_json(spark: SparkSession, path: str | list[str], schema: str) -> DataFrame:
    """JSON lines. When the schema has the corrupt-record column every line is parsed in full:
    Spark's JSON source only parses the fields a query uses, and then a line counts as corrupt or
    not depending on the query."""
    if CORRUPT in schema:
        return _documents(spark.read.text(path), "value", schema)
    return spark.read.schema(schema).json(path)


def read_json_stream(
    spark: SparkSession, path: str, schema: str, files_per_batch: int | None = None
) -> DataFrame:
    """The same for files as they arrive."""
    reader = spark.readStream
    if files_per_batch:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    if CORRUPT in schema:
        return _documents(reader.text(path), "value", schema)
    return reader.schema(schema).json(path)


def read_documents(spark: SparkSession, root: str, kind: str) -> DataFrame:
    """All documents of a kind, fetch outcome and unreadable lines included."""
    return read_json(spark, f"{root.rstrip('/')}/{kind}", DOCUMENTS[kind])


def parse_documents(lines: DataFrame, column: str, kind: str) -> DataFrame:
    """Documents held as JSON text in a column."""
    return _documents(lines, column, DOCUMENTS[kind])


def write_json(df: DataFrame, path: str, mode: str = "errorifexists", compression: str = "none") -> None:
    """Timestamps keep their microseconds (Spark writes milliseconds by default). Readers know a
    compressed file by its name; each is read by one task."""
    df.write.mode(mode).options(
        timestampFormat="yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX",
        timestampNTZFormat="yyyy-MM-dd'T'HH:mm:ss.SSSSSS",
    ).json(path, compression=compression)
