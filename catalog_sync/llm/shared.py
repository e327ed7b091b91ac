"""Helpers the operators share: partition counts, ranks without a single task, connected components."""

from __future__ import annotations

import tempfile
import zipfile
from pathlib import Path

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from catalog_sync.scratch import discard, stage

MAX_ROUNDS = 60
ROWS = 1 << 18


_SHIPPED: set[str] = set()


def ship(spark: SparkSession) -> None:
    """Send this package to the Python workers, once per application: they may not share the
    driver's import path."""
    application = spark.sparkContext.applicationId
    if application in _SHIPPED:
        return
    root = Path(__file__).resolve().parents[1]
    path = Path(tempfile.mkdtemp()) / "catalog_sync.zip"
    with zipfile.ZipFile(path, "w") as archive:
        for file in sorted(root.rglob("*.py")):
            archive.write(file, file.relative_to(root.parent))
    spark.sparkContext.addPyFile(str(path))
    _SHIPPED.add(application)


def partitions(spark: SparkSession) -> int:
    """How many partitions a shuffle deals out to, never fewer than there are cores."""
    return max(
        int(spark.conf.get("spark.sql.shuffle.partitions")), spark.sparkContext.defaultParallelism
    )


def gathered(df: DataFrame, rows: int, each: int = ROWS, least: int = 1) -> DataFrame:
    """``df``, of at most ``rows`` rows, in a task per ``each`` of them, ``least`` per core at least.

    A shuffle's partitions are read together where their rows are too few for a task each, as AQE does
    where it is let. Nothing is shuffled for it, and no more tasks are made than there are partitions.
    """
    spark = df.sparkSession
    tasks = max(rows // each + 1, least * spark.sparkContext.defaultParallelism)
    return df.coalesce(tasks) if tasks < partitions(spark) else df


def ranked(df: DataFrame, group: list[str], order: list[str], rank: str = "rank") -> DataFrame:
    """``df`` with the position (from 0) of each row among the rows of its group.

    One range sort by (group, order): a group of any size spreads over many partitions. Each row
    notes its partition and place there; the counts per (group, partition), a few rows each, turn
    those into ranks. Rows that tie on group and order may swap ranks, so callers order totally or
    by columns whose ties are interchangeable. Sorting is ascending, NULLs first.
    """
    spark = df.sparkSession
    place = F.monotonically_increasing_id()
    laid = stage(
        df.repartitionByRange(partitions(spark), *group, *order)
        .sortWithinPartitions(*group, *order)
        .withColumn("__part", F.shiftright(place, 33))
        .withColumn("__place", place.bitwiseAND(F.lit((1 << 33) - 1))),
        "ranked",
    )
    counts = laid.groupBy(*group, "__part").agg(
        F.count(F.lit(1)).alias("__n"), F.min("__place").alias("__first")
    )
    before = Window.partitionBy(*[F.col(g) for g in group]).orderBy("__part")
    offsets = counts.select(
        *[F.col(g).alias(f"__g{i}") for i, g in enumerate(group)],
        F.col("__part").alias("__p"),
        (F.sum("__n").over(before) - F.col("__n") - F.col("__first")).alias("__shift"),
    )
    match = F.col("__part") == F.col("__p")
    for i, g in enumerate(group):
        match = match & F.col(g).eqNullSafe(F.col(f"__g{i}"))
    return laid.join(offsets, match).select(
        *df.columns, (F.col("__place") + F.col("__shift")).alias(rank)
    )


def _stars(edges: DataFrame, rows: int) -> bool:
    """Whether each node has one edge, to a node that has none: all components are found."""
    src, dst = F.col("src"), F.col("dst")
    roots = edges.select(dst.alias("id"), dst.alias("low"), F.lit(1).alias("root")).distinct()
    nodes = edges.select(src.alias("id"), dst.alias("low"), F.lit(0).alias("root")).union(gathered(roots, rows))
    mixed = nodes.groupBy("id").agg(
        F.min("low").alias("low"), F.max("low").alias("high"), F.min("root").alias("leaf"), F.max("root").alias("root")
    )
    return gathered(mixed.where("low <> high OR leaf <> root"), rows).isEmpty()


def components(edges: DataFrame, rows: int | None = None) -> DataFrame:
    """(id, component): the smallest id reachable, for every id that has an edge.

    ``edges`` holds (src, dst) longs in any direction, ``rows`` of them if that is known. Alternating large-star and small-star
    rounds until stars are left; each round is written to the shared folder, so lineage stays short, and
    takes the place of the one before. Each node's smallest neighbour is written before it is joined
    back: both sides of that join then come from plain exchanges, and AQE can split a hub that holds
    many edges. A round makes no more edges than it is given edges and nodes.
    """
    src, dst = F.col("src"), F.col("dst")
    now = (
        edges.where("src <> dst")
        .select(F.greatest(src, dst).alias("src"), F.least(src, dst).alias("dst")).distinct()
    )
    now = stage(now if rows is None else gathered(now, rows), "edges")
    for _ in range(MAX_ROUNDS):
        rows = 3 * now.count()
        if _stars(now, rows):
            roots = now.select(dst.alias("id"), dst.alias("component")).distinct()
            return now.select(src.alias("id"), dst.alias("component")).union(roots)
        both = now.select("src", "dst").union(now.select(dst, src))
        low = both.groupBy("src").agg(F.least(F.min("dst"), F.first("src")).alias("low"))
        low = stage(gathered(low, rows), "low")
        large = (
            both.where("dst > src").join(low, "src")
            .select(dst.alias("src"), F.col("low").alias("dst"))
        )
        large = stage(gathered(gathered(large, rows).distinct(), rows), "large")
        least = stage(gathered(large.groupBy("src").agg(F.min("dst").alias("low")), rows), "low")
        after = gathered(
            large.join(least, "src")
            .select(
                F.when(dst == F.col("low"), src).otherwise(dst).alias("src"),
                F.col("low").alias("dst"),
            ),
            rows,
        ).union(least.select("src", F.col("low").alias("dst"))).distinct()
        after = stage(gathered(after, rows), "edges")
        discard(now, low, large, least)
        now = after
    raise RuntimeError("components did not settle")


def with_component(ids: DataFrame, found: DataFrame, key: str) -> DataFrame:
    """``ids`` with ``component_id``: what ``components`` found for the key, else the key itself."""
    named = found.select(F.col("id").alias("__id"), F.col("component").alias("__component"))
    return ids.join(named, F.col(key) == F.col("__id"), "left").select(
        *ids.columns, F.coalesce("__component", key).alias("component_id")
    )


def text_bytes(name: str = "text") -> Column:
    return F.coalesce(F.col(name), F.lit("")).cast("binary")
