"""Rows known by where they lie: the file that holds them and their place in it.

A pick among wide rows need not move them: keys, order and places travel, the places of the rows that
were picked are kept as bitmaps, a bit per row of a file, and these are broadcast over the scan. However
many rows are picked, that costs 4 KB per 32,768 rows of a file.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from catalog_sync.scratch import stage

FILE, PLACE = "_file", "_place"
BLOCK, BITS = "_block", "_bits"
BLOCK_ROWS = 8 * 4096
# Bitmaps that may be broadcast: 64 MB.
MAX_BITMAPS = 16_384


def located(scan: DataFrame) -> DataFrame:
    """The rows of a Parquet scan with their places."""
    file = F.unhex(F.md5(F.col("_metadata.file_path")))
    return scan.select("*", file.alias(FILE), F.col("_metadata.row_index").alias(PLACE))


def nowhere(empty: DataFrame) -> DataFrame:
    """A frame without rows in the same form."""
    return empty.withColumns({FILE: F.lit(None).cast("binary"), PLACE: F.lit(None).cast("bigint")})


def _block() -> Column:
    return F.floor(F.col(PLACE) / BLOCK_ROWS).alias(BLOCK)


def bitmaps(picked: DataFrame) -> DataFrame:
    """The places of the rows picked, staged. Rows of a block meet before they are put together, so no
    task sends bitmaps of all files."""
    at = picked.select(FILE, _block(), (F.col(PLACE) % BLOCK_ROWS).alias(PLACE)).repartition(FILE, BLOCK)
    return stage(at.groupBy(FILE, BLOCK).agg(F.bitmap_construct_agg(PLACE).alias(BITS)), "places")


def rows_at(rows: DataFrame, maps: DataFrame, most: int = MAX_BITMAPS) -> DataFrame:
    """Of the rows of a scan (``located``) those that lie at the places."""
    bit = F.col(PLACE) % BLOCK_ROWS
    byte = F.conv(F.hex(F.substring(BITS, (F.floor(bit / 8) + 1).cast("int"), F.lit(1))), 16, 10).cast("bigint")
    maps = F.broadcast(maps) if maps.count() <= most else maps
    met = rows.withColumn(BLOCK, _block()).join(maps, [FILE, BLOCK])
    return met.where(F.getbit(byte, (bit % 8).cast("int")) == 1).select(*rows.columns)
