"""Table definitions in Spark's catalog."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import SparkSession

from catalog_sync.schemas import TABLES, table_ddl


def create_statement(name: str, columns: str, location: str | None = None) -> str:
    where = f" LOCATION '{location}'" if location else ""
    return f"CREATE TABLE IF NOT EXISTS {name} ({columns}) USING parquet{where}"


def catalog_script(location: str | None = None, prefix: str = "") -> str:
    """Definitions of the four catalog tables, one statement each."""
    return ";\n".join(
        create_statement(f"{prefix}{t}", table_ddl(t), f"{location}/{t}" if location else None)
        for t in TABLES
    )


def run_script(spark: SparkSession, script: str) -> int:
    """Run the statements of a ``;``-separated definition file; returns how many ran."""
    statements = [s.strip() for s in script.split(";") if s.strip()]
    for statement in statements:
        spark.sql(statement)
    return len(statements)


def create_tables(
    spark: SparkSession, tables: Mapping[str, str], location: str | None = None
) -> None:
    for name, columns in tables.items():
        where = f"{location.rstrip('/')}/{name}" if location else None
        spark.sql(create_statement(name, columns, where))
