"""The corpus pipeline: five stages, each over all that the stage before it kept.

Toxic documents go, lines that many documents share go, one document of each group of near
duplicates stays, sources are mixed to target weights, and what is left is packed into sequences.
"""

from __future__ import annotations

import gc
from collections.abc import Callable
from functools import wraps

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from catalog_sync.llm.line_dedup import drop_repeated_lines
from catalog_sync.llm.minhash import keep_one
from catalog_sync.llm.mixing import mix
from catalog_sync.llm.queries import SEQUENCE, tokenizer
from catalog_sync.llm.shared import ship
from catalog_sync.llm.sync_packing import pack
from catalog_sync.llm.tokens import pieces
from catalog_sync.llm.toxicity import without_toxic
from catalog_sync.plans.registry import table
from catalog_sync.scratch import discard, recorded, stage

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]
_USED: list[DataFrame] = []


def tidy(function: Stage) -> Stage:
    """A stage that first deletes what the stage before it staged on its way. That stage's output has
    been written by then; where ``docs`` still reads one of those folders, all are left."""
    @wraps(function)
    def run_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
        if _USED:
            read = docs.inputFiles()
            if not any(used.staged_at.rsplit("/", 1)[1] in file for used in _USED for file in read):
                discard(*[used for used in _USED if used.sparkSession is spark])
            _USED.clear()
            # Shuffle files go once nothing on the driver refers to them.
            gc.collect()
            spark._jvm.System.gc()
        with recorded() as frames:
            out = function(spark, docs, sf_dir)
        _USED.extend(frames)
        return out

    return run_stage


@tidy
def toxicity(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that score below 0.3; labels are learnt from those that are not held out."""
    ship(spark)
    return without_toxic(docs, table(spark, sf_dir, "labels"), threshold=0.3)


@tidy
def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without the lines found in 10 documents or more; documents stay, if only as empty texts."""
    ship(spark)
    out = drop_repeated_lines(docs, min_docs=10)
    return out.withColumn("n_chars", F.length("text").cast("long")).select(*docs.columns)


@tidy
def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group linked by five-word shingles of similarity 0.8 or more."""
    ship(spark)
    return keep_one(docs, words=5, percent=80)


@tidy
def mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each document as often as the mix takes it."""
    ship(spark)
    return mix(docs)


@tidy
def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """A row per piece of a document with its place in a sequence."""
    ship(spark)
    cut = stage(
        pieces(docs, "doc_id", "text", tokenizer("word_bpe_49k.json"), SEQUENCE, 0), "pieces"
    ).withColumnRenamed("key", "doc_id")
    return pack(cut, ["doc_id", "piece", "ids_crc32"], SEQUENCE)


STAGES = [
    ("toxicity", toxicity),
    ("line_dedup", line_dedup),
    ("near_dedup", near_dedup),
    ("mixing", mixing),
    ("packing", packing),
]

#: A trained classifier decides the first stage, so no SQL gives the same rows.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, function in STAGES[:-1]:
        docs = stage(function(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
