"""Mixing sources to target weights by systematic sampling.

A source's rate is its target over its size in words: the expected copies of each of its documents.
Documents are ranked within their source by size, so the running sum of expected copies is
rate x rank; with one offset per source a document is emitted once per integer this sum crosses. As
neighbours in the order are of like size, the words taken stay within about one of the largest
documents of the target.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from catalog_sync.llm.shared import ranked
from catalog_sync.llm.words import WORD_COUNT
from catalog_sync.scratch import stage

WEIGHTS = (3, 1, 2)
STEPS = 1 << 20


def word_count(text: str) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD_COUNT)), F.lit(0)).cast("long")


def offset(source: str, seed: str) -> Column:
    """A number in [0, 1) fixed by seed and source, a multiple of 2**-20 so that sums stay exact."""
    digits = F.substring(F.md5(F.concat(F.lit(seed), F.coalesce(source, F.lit("")))), 1, 5)
    return F.conv(digits, 16, 10).cast("double") / STEPS


def targets(
    sizes: DataFrame, source: str, weights: tuple[int, ...], share: float, limit: int
) -> DataFrame:
    """source, source_size, target of each source: one row per source.

    Sources in code point order, NULL last, have ``weights`` in turn and share ``share`` x all words; what
    exceeds ``limit`` x a source's size is shared again by weight until none is above.
    """
    totals = sizes.groupBy(source).agg(F.sum("size").alias("source_size"))
    placed = ranked(
        totals.withColumn("__last", F.col(source).isNull()), [], ["__last", source], "__at"
    )
    weight = F.element_at(
        F.array(*[F.lit(float(w)) for w in weights]), (F.col("__at") % len(weights) + 1).cast("int")
    )
    known = stage(
        placed.select(source, "source_size", weight.alias("__weight"),
                      (F.col("source_size") * limit).alias("__cap")),
        "sources",
    )
    budget = share * (known.agg(F.sum("source_size")).first()[0] or 0)
    level, above = 0.0, F.lit(False)
    while True:
        capped, free = known.agg(
            F.coalesce(F.sum(F.when(above, F.col("__cap"))), F.lit(0)),
            F.sum(F.when(~above, F.col("__weight"))),
        ).first()
        if not free or (new := (budget - capped) / free) == level:
            break
        level = new
        above = F.col("__cap") < F.lit(level) * F.col("__weight")
    target = F.when(above, F.col("__cap").cast("double")).otherwise(F.lit(level) * F.col("__weight"))
    return known.select(source, "source_size", target.alias("target"))


def copies(
    docs: DataFrame,
    key: str = "doc_id",
    text: str = "text",
    source: str = "source",
    weights: tuple[int, ...] = WEIGHTS,
    share: float = 1.5,
    limit: int = 2,
    seed: str = "mix",
) -> DataFrame:
    """One row per document: key, source, size, source_size, target, copies, taken, and ``mark``, a
    hash of the text.

    Size is the number of words ``[^\\x20\\x09-\\x0D]+`` (NULL: 0), ``taken`` is copies x size. NULL
    is a source of its own. Documents without words may be emitted, they take nothing. Rows
    that repeat a key count each on their own; equal rows share their copies in any order. An empty table gives an
    empty table.
    """
    sizes = stage(
        docs.select(F.col(key).alias("__key"), F.col(source).alias("__source"), word_count(text).alias("size"),
                    F.xxhash64(text).alias("mark")),
        "sizes",
    )
    goals = targets(sizes, "__source", weights, share, limit).withColumnRenamed("__source", "__of")
    placed = ranked(sizes, ["__source"], ["size", "__key", "mark"])
    joined = placed.join(F.broadcast(goals) if goals.count() <= 100_000 else goals,
                         F.col("__source").eqNullSafe(F.col("__of")))
    rate = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(0.0)
    start = offset("__source", seed)
    crossed = F.floor(rate * (F.col("rank") + 1) + start) - F.floor(rate * F.col("rank") + start)
    return joined.withColumn("copies", F.least(crossed, F.ceil(rate))).select(
        F.col("__key").alias(key), F.col("__source").alias(source), "size", "source_size", "target",
        "copies", (F.col("copies") * F.col("size")).alias("taken"), "mark",
    )


def mix(docs: DataFrame, key: str = "doc_id", text: str = "text", source: str = "source", **options) -> DataFrame:
    """``docs`` with each row as often as ``copies`` says, columns as they were."""
    spans = [F.col(key), F.col(source), F.col("__mark")]
    turn = F.row_number().over(Window.partitionBy(*spans).orderBy(F.lit(1)))
    counted = copies(docs, key, text, source, **options).where("copies > 0").select(
        F.col(key).alias("__k"), F.col(source).alias("__s"), F.col("mark").alias("__m"), "copies"
    )
    counted = counted.withColumn(
        "__t", F.row_number().over(Window.partitionBy("__k", "__s", "__m").orderBy(F.desc("copies")))
    ).withColumnRenamed("copies", "__copies")
    rows = docs.withColumn("__mark", F.xxhash64(text)).withColumn("__turn", turn)
    match = (
        F.col(key).eqNullSafe(F.col("__k")) & F.col(source).eqNullSafe(F.col("__s"))
        & (F.col("__mark") == F.col("__m")) & (F.col("__turn") == F.col("__t"))
    )
    return rows.join(counted, match).withColumn(
        "__copy", F.explode(F.array_repeat(F.lit(0), F.col("__copies").cast("int")))
    ).select(*docs.columns)
