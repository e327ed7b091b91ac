"""Pages and positions of an order over a whole table, without ranking it in one task.

Orders are total: ``(column, direction)`` pairs whose last one tells rows apart.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from catalog_sync.functions import literal_for
from catalog_sync.scratch import stage

_ROWS = (1 << 33) - 1


def ordinals(df: DataFrame, order: Sequence[Column], name: str = "ordinal") -> DataFrame:
    """Each row's position (from 1) in the order, NULLs and repeated rows included; rows alike in the
    whole order are numbered in any order. An empty table gives an empty table.

    The rows are dealt by ranges and sorted within them, once; a row's place in its range plus the
    rows of the ranges before is its position. Only one count per range is ranked in one task.
    """
    placed = df.repartitionByRange(*order).sortWithinPartitions(*order)
    # The id counts rows within a task from 0 below bit 33 and holds the task above it.
    placed = stage(placed.withColumn("_row", F.monotonically_increasing_id()), "ordered")
    range_ = F.shiftright("_row", 33)
    row = F.col("_row").bitwiseAND(F.lit(_ROWS))
    counts = placed.groupBy(range_.alias("_range")).agg(F.count(F.lit(1)).alias("_n"))
    before = Window.orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    starts = counts.select("_range", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_before"))
    # A row per range: as many as the shuffle has partitions.
    out = placed.withColumn("_range", range_).join(F.broadcast(starts), "_range")
    return out.withColumn(name, F.col("_before") + row + 1).drop("_range", "_row", "_before")


def beyond(df: DataFrame, keys: Sequence[str], cursor: Sequence) -> Column:
    """Rows behind the cursor in the ascending order of ``keys``, NULLs first. The cursor holds the last
    row's values, None for NULL. Its first key alone is a bound that a scan can evaluate."""
    def behind(key: str, value) -> Column:
        return F.col(key).isNotNull() if value is None else F.col(key) > literal_for(df, key, value)

    def alike(key: str, value) -> Column:
        return F.col(key).isNull() if value is None else F.col(key) == literal_for(df, key, value)

    steps = [
        reduce(Column.__and__, [*map(alike, keys[:i], cursor[:i]), behind(keys[i], cursor[i])])
        for i in range(len(keys))
    ]
    condition = reduce(Column.__or__, steps)
    first = cursor[0]
    return condition if first is None else (F.col(keys[0]) >= literal_for(df, keys[0], first)) & condition


def page_after(
    df: DataFrame, keys: Sequence[str], limit: int, cursor: Sequence | None = None
) -> DataFrame:
    """The ``limit`` rows behind the cursor, the first ones without. Each task keeps ``limit`` rows, however
    far the page is from the front."""
    rows = df if cursor is None else df.filter(beyond(df, keys, cursor))
    return rows.orderBy(*[F.col(k).asc_nulls_first() for k in keys]).limit(limit)


def page_cursors(df: DataFrame, keys: Sequence[str], limit: int) -> DataFrame:
    """page (from 1) and the keys of its last row: the cursors from which all pages but the first can be
    read apart from each other. A last page that is not full has none."""
    order = [F.col(k).asc_nulls_first() for k in keys]
    placed = ordinals(df.select(*keys), order, "_ordinal")
    last = placed.filter(F.col("_ordinal") % limit == 0)
    return last.select((F.col("_ordinal") / limit).cast("long").alias("page"), *keys)
