"""Order-dependent picks per key, and unions.

Distributed rows have no order of their own, so every pick takes an explicit one; it should be
total, or equal rows may swap.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence
from functools import reduce
from math import isqrt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from catalog_sync.functions import literal_for

ORDINAL = "_ordinal"


def _rank(partition: Sequence[str | Column], order: Sequence[Column]) -> Column:
    return F.row_number().over(Window.partitionBy(*partition).orderBy(*order))


def _keep(df: DataFrame, keys: Sequence[str], order: Sequence[Column], n: int, rank: str) -> DataFrame:
    return df.withColumn(rank, _rank(keys, order)).filter(F.col(rank) <= n)


def _split_counts(partitions: int) -> list[int]:
    """Into how many splits a key is cut, round by round, until one task can take the rest."""
    counts = [partitions]
    while counts[-1] > 64:
        counts.append(isqrt(counts[-1]))
    return counts


def top_n(
    df: DataFrame,
    keys: Sequence[str],
    order: Sequence[Column],
    n: int,
    rank: str | None = None,
    row_id: Sequence[str] = (),
) -> DataFrame:
    """First ``n`` rows per key.

    Up to Spark's group-limit threshold each map task already keeps at most ``n`` rows per key, so
    a hot key costs nothing in the shuffle. Beyond the threshold Spark would gather a whole key
    in one task; there a key is split by a hash of its rows, cut to ``n`` per split, the survivors
    split less finely and cut again, and only the last few meet. ``row_id`` names columns that
    tell rows apart and is all that is hashed. Without it copies of one row would hash alike, so
    they are counted first and unfolded to at most ``n``.
    """
    name = rank or "_rank"
    spark = df.sparkSession
    threshold = int(spark.conf.get("spark.sql.optimizer.windowGroupLimitThreshold", "1000"))
    if n > threshold:
        columns = df.columns
        salt = [F.col(c) for c in row_id or columns]
        if not row_id:
            counted = df.groupBy(*columns).agg(F.count(F.lit(1)).alias("_copies"))
            copies = F.sequence(F.lit(1), F.least("_copies", F.lit(n)))
            df = counted.select(*columns, F.explode(copies).alias("_copy"))
            salt.append(F.col("_copy"))
        for splits in _split_counts(int(spark.conf.get("spark.sql.shuffle.partitions"))):
            split = df.withColumn("_split", F.pmod(F.xxhash64(*salt), F.lit(splits)))
            df = _keep(split, [*keys, "_split"], order, n, name).drop("_split", name)
        df = df.select(*columns)
    out = _keep(df, keys, order, n, name)
    return out if rank else out.drop(name)


def first_wins(df: DataFrame, keys: Sequence[str], order: Sequence[Column]) -> DataFrame:
    """One row per key: the first in the given order."""
    return top_n(df, keys, order, 1)


def fresh_latest(
    df: DataFrame,
    keys: Sequence[str],
    fetched_at: str,
    as_of: dt.datetime | None = None,
    ttl_seconds: int | None = None,
    tie_break: Sequence[Column] = (),
) -> DataFrame:
    """Newest row per key; with a TTL a key whose newest row is too old is gone altogether.

    Age is a property of the newest row, so filtering by age first picks the same rows and lets
    the scan skip the stale ones.
    """
    if ttl_seconds is not None:
        oldest = as_of - dt.timedelta(seconds=ttl_seconds)
        df = df.filter(F.col(fetched_at) > literal_for(df, fetched_at, oldest))
    return first_wins(df, keys, [F.col(fetched_at).desc_nulls_last(), *tie_break])


def union_rows(*frames: DataFrame) -> DataFrame:
    """Append row batches; a column one of them lacks is NULL there."""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)


def union_ids(column: str, *ids: DataFrame) -> DataFrame:
    """Distinct ids of several one-column frames, whatever each calls its column."""
    return reduce(DataFrame.union, [i.toDF(column) for i in ids]).distinct()
