"""Exact top-k by integer inner product over an impact-ordered index, score at a time.

Components become ``floor(1024 * x)``. Vectors are cut into blocks; a block's postings (vector,
dimension, value) are grouped into segments by quantised impact, the size of the value, highest
first, and each segment carries the norm of what its vectors have left in later segments. A search
adds segment after segment to all scores. Since what is left of a score is at most the norm of the
query times the norm left, every score has bounds, and a query stops as soon as these prove that
all but a few vectors of the block are below its k-th best: those few are possible members and are
rescored exactly on whole vectors in 64-bit integers. The best of all blocks are merged.

Blocks stay where they are written; queries, the smaller side, come to them in rounds of bounded
bytes. Memory per task is one block, one round and the scores of one batch of queries. Units are
64-bit; where a product may pass that, it is taken in whole numbers of any size, and a result that
does not fit a long raises.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from catalog_sync.llm.shared import ranked
from catalog_sync.llm.vectors import matrix
from catalog_sync.scratch import stage

SCALE = 1024
LEVELS = 8
BLOCK = 8192
BATCH = 512
ROUND_BYTES = 1 << 25
FEW = 64


def integers(vectors: DataFrame, key: str, vector: str) -> DataFrame:
    """id and the scaled components (binary, 64-bit) of the usable vectors, one row per id."""

    def scale(batches):
        for batch in batches:
            usable, values = matrix(batch.column(1))
            with np.errstate(over="ignore"):
                whole = np.floor(values * SCALE)
            if (np.abs(whole) >= 2.0**63).any():
                raise OverflowError("a scaled component does not fit 64 bits")
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).filter(pa.array(usable)),
                 pa.array([w.tobytes() for w in whole.astype("<i8")], pa.binary())],
                names=["id", "units"],
            )

    usable = vectors.select(F.col(key).cast("long").alias("id"), vector).where("id IS NOT NULL").mapInArrow(
        scale, "id long, units binary"
    )
    return usable.groupBy("id").agg(F.min("units").alias("units"))


def _rows(column: pd.Series) -> np.ndarray:
    rows = [np.frombuffer(u, dtype="<i8") for u in column]
    if len({len(r) for r in rows}) > 1:
        raise ValueError("vectors of different dimensions meet")
    return np.stack(rows) if rows else np.zeros((0, 0), dtype="<i8")


def index(vectors: DataFrame, top: float, levels: int = LEVELS) -> DataFrame:
    """One row per block: ids, whole vectors, and its segments, that of the highest impacts first.

    ``vectors``: block, id, units. ``top``: the largest absolute value, which fixes the levels.
    """
    names = ["docs", "dims", "values", "left"]
    schema = "block long, ids binary, units binary, " + ", ".join(f"{n} array<binary>" for n in names)

    def build(key, pdf):
        pdf = pdf.sort_values("id")
        units = _rows(pdf["units"])
        impact = np.abs(units.astype(np.float64))
        level = np.minimum((top - impact) * (levels / (top + 1)), levels - 1).astype(np.int64)
        segments: list[list[bytes]] = [[], [], [], []]
        for n in range(levels):
            docs, dims = np.nonzero((level == n) & (units != 0))
            left = np.where(level > n, impact, 0)
            own = docs.astype("<i4"), dims.astype("<i4"), units[docs, dims], np.sqrt((left * left).sum(axis=1))
            for column, values in zip(segments, own, strict=True):
                column.append(values.tobytes())
        row = (key[0], pdf["id"].to_numpy().astype("<i8").tobytes(), units.tobytes(), *segments)
        return pd.DataFrame([row], columns=["block", "ids", "units", *names])

    return vectors.groupBy("block").applyInPandas(build, schema)


def _products(whole: np.ndarray, query: np.ndarray) -> np.ndarray:
    """Exact inner products; whole numbers of any size where 64 bits may not hold them."""
    if (np.abs(whole.astype(np.float64)) @ np.abs(query.astype(np.float64))).max(initial=0) < 2.0**62:
        return whole @ query
    return whole.astype(object) @ query.astype(object)


def _best(asked: np.ndarray, own: np.ndarray, block: dict, k: int):
    """(query position, ids, scores) of up to ``k`` best per query within one block."""
    ids = np.frombuffer(block["ids"], dtype="<i8")
    whole = np.frombuffer(block["units"], dtype="<i8").reshape(len(ids), -1)
    if whole.shape[1] != asked.shape[1]:
        raise ValueError("vectors of different dimensions meet")
    exact_norm = np.linalg.norm(whole.astype(np.float64), axis=1)
    norm = np.linalg.norm(asked.astype(np.float64), axis=1)[:, None]
    self_ = own[:, None] == ids[None, :]
    scores = np.zeros(self_.shape)
    active, possible = np.arange(len(own)), np.ones(self_.shape, dtype=bool)
    # What sums of doubles may be off, relative to the product of the norms.
    rounding = (whole.shape[1] + len(block["left"]) + 8) * 2.0**-52
    for docs, dims, values, left in zip(block["docs"], block["dims"], block["values"], block["left"], strict=True):
        part = np.zeros(whole.shape)
        part[np.frombuffer(docs, dtype="<i4"), np.frombuffer(dims, dtype="<i4")] = np.frombuffer(values, dtype="<i8")
        scores[active] += asked[active].astype(np.float64) @ part.T
        slack = norm[active] * (np.frombuffer(left)[None, :] * (1 + 1e-9) + exact_norm[None, :] * rounding) + 1e-6
        now = np.where(self_[active], -np.inf, scores[active])
        if len(ids) > k:
            kth = np.partition(now - slack, -k, axis=1)[:, [-k]]
            possible[active] = (now + slack >= kth) & ~self_[active]
        else:
            possible[active] = ~self_[active]
        # Proved for a query: no vector outside its possible members can be among its best.
        active = active[possible[active].sum(axis=1) > max(FEW, 2 * k)]
        if not len(active):
            break
    for i in range(len(own)):
        at = np.flatnonzero(possible[i])
        exact = _products(whole[at], asked[i])
        order = sorted(range(len(at)), key=lambda j: (-int(exact[j]), ids[at[j]]))[:k] if exact.dtype == object \
            else np.lexsort((ids[at], -exact))[:k]
        yield i, ids[at[order]], exact[order]


def _found(own: np.ndarray, units: np.ndarray, block: dict, k: int, batch: int) -> pa.RecordBatch:
    """The best of a block for all queries of a round, taken by ``batch`` queries."""
    columns: list[list] = [[], [], []]
    for start in range(0, len(own), batch):
        some = slice(start, start + batch)
        for i, ids, scores in _best(units[some], own[some], block, k):
            columns[0] += [int(own[start + i])] * len(ids)
            columns[1] += ids.tolist()
            columns[2] += [int(s) for s in scores]
    # A score beyond a long is carried as digits; only a result must fit.
    high = [str(s) if not -(1 << 63) <= s < 1 << 63 else None for s in columns[2]]
    low = [s if h is None else (1 << 63) - 1 if s > 0 else -(1 << 63) for s, h in zip(columns[2], high, strict=True)]
    return pa.RecordBatch.from_arrays(
        [pa.array(columns[0], pa.int64()), pa.array(columns[1], pa.int64()), pa.array(low, pa.int64()),
         pa.array(high, pa.string())],
        names=["query_id", "vec_id", "score", "beyond"],
    )


def top_k(
    vectors: DataFrame,
    queries: Column,
    key: str = "vec_id",
    vector: str = "embedding",
    k: int = 10,
    block: int = BLOCK,
    batch: int = BATCH,
    round_bytes: int = ROUND_BYTES,
) -> DataFrame:
    """query_id, rank (from 1), vec_id, score: the ``k`` best of all other vectors per query.

    ``queries`` is a condition on ``id``. Ties go to the smaller id; with fewer than ``k`` others all
    are given. No part take: NULL or empty vectors and those with a NULL or non-finite component. A
    scaled component beyond 64 bits raises, and so does a score among the best that a long cannot
    hold. Rows that repeat an id are one vector, the smallest as bytes; rows without id take no
    part. Vectors must be of one dimension, else it raises. An empty table gives an empty table.
    """
    known = stage(ranked(integers(vectors, key, vector), [], ["id"]), "integers")
    asked = stage(ranked(known.where(queries).select("id", "units"), [], ["id"], "turn"), "queries")

    def largest(batches):
        top, size = 0.0, 0
        for b in batches:
            for units in b.column(0).to_pylist():
                size = len(units)
                top = max(top, float(np.abs(np.frombuffer(units, dtype="<i8").astype(np.float64)).max()))
        yield pa.RecordBatch.from_arrays([pa.array([top], pa.float64()), pa.array([size])], names=["top", "size"])

    top, size = known.select("units").mapInArrow(largest, "top double, size long").agg(
        F.max("top"), F.max("size")
    ).first()
    built = stage(
        index(known.select(F.floor(F.col("rank") / block).alias("block"), "id", "units"), top or 0.0), "index"
    ).drop("block")
    round_ = max(1, round_bytes // max(1, size or 0))
    parts = []
    for start in range(0, asked.count(), round_):
        rows = asked.where((F.col("turn") >= start) & (F.col("turn") < start + round_)).toPandas()
        own, units = rows["id"].to_numpy(), _rows(rows["units"])

        def search(batches, own=own, units=units):
            for b in batches:
                for held in b.to_pylist():
                    yield _found(own, units, held, k, batch)

        parts.append(built.mapInArrow(search, "query_id long, vec_id long, score long, beyond string"))
    if not parts:
        schema = "query_id long, rank int, vec_id long, score long"
        return vectors.sparkSession.createDataFrame([], schema)
    best = parts[0]
    for part in parts[1:]:
        best = best.union(part)
    # Scores beyond a long stand at its ends, so whatever else ties with them there, one of the best raises.
    order = Window.partitionBy("query_id").orderBy(
        F.desc("score"), F.col("beyond").isNull() == (F.col("score") > 0), "vec_id"
    )
    beyond = F.raise_error(F.lit("a score among the best does not fit a long")).cast("long")
    return best.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k).select(
        "query_id", "rank", "vec_id", F.when(F.col("beyond").isNull(), F.col("score")).otherwise(beyond).alias("score")
    )
