"""Relational databases through Spark's JDBC source (the driver jar is the cluster's to supply)."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession


@dataclass(frozen=True)
class KeyRange:
    """How to cut a table into parallel reads: a numeric column, its bounds, the number of cuts.
    Rows outside the bounds are still read, by the first and last cut."""

    column: str
    lower: int
    upper: int
    partitions: int


def read_options(
    url: str, table: str, split: KeyRange | None = None, fetch_size: int = 10_000
) -> dict[str, str]:
    options = {"url": url, "dbtable": table, "fetchsize": str(fetch_size)}
    if split:
        options |= {
            "partitionColumn": split.column,
            "lowerBound": str(split.lower),
            "upperBound": str(split.upper),
            "numPartitions": str(split.partitions),
        }
    return options


def write_options(
    url: str, table: str, batch_size: int = 1_000, partitions: int | None = None
) -> dict[str, str]:
    options = {"url": url, "dbtable": table, "batchsize": str(batch_size)}
    if partitions:
        options["numPartitions"] = str(partitions)
    return options


def read_table(
    spark: SparkSession, url: str, table: str, split: KeyRange | None = None, **properties: str
) -> DataFrame:
    reader = spark.read.format("jdbc").options(**read_options(url, table, split), **properties)
    return reader.load()


def write_table(
    df: DataFrame, url: str, table: str, mode: str = "append", **properties: str
) -> None:
    df.write.format("jdbc").mode(mode).options(**write_options(url, table), **properties).save()
