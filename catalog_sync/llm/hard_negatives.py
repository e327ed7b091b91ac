"""Hard negatives by Strassen products of anchor and candidate tiles, and mergeable heaps.

Components become ``floor(scale * x)``, scores are integer inner products. Vectors are sorted by label
and cut into blocks that stay where they are written; anchors, the smaller side, come to them in rounds
of bounded size. An anchor tile meets a candidate tile in one matrix product by Strassen's
recursion: both are padded with zeros to even sides at each level, halves are added as integers, and seven
products replace eight until a side is short. All sums are taken modulo 2**64, which is exact for every
score that a 64-bit integer holds; the norms of the tiles prove beforehand that all do.

Scores go into heaps of fixed size, the best first and ties by smaller id. Heaps of tiles merge into
heaps of tasks, and those into the result. The first pass multiplies tiles that share a label and fills
a heap of positives per anchor; each positive's score then opens a window of scores, and the second
pass multiplies tiles of different labels and fills a heap per window. Together they multiply each
tile pair once, save where a tile holds several labels.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from catalog_sync.llm.shared import partitions, ranked
from catalog_sync.llm.vectors import matrix
from catalog_sync.scratch import stage

BLOCK_BYTES = 2 << 20
ROUND_BYTES = 32 << 20
TILE = 512
LEAF = 16
EXACT = float(1 << 53)
MOST = float(1 << 62)
NONE = np.iinfo(np.int64).min


def strassen(a: np.ndarray, b: np.ndarray, leaf: int = LEAF) -> np.ndarray:
    """The product of two int64 matrices modulo 2**64, any shapes that fit together."""
    m, d = a.shape
    n = b.shape[1]
    if min(m, d, n) <= leaf:
        if not d or not m or not n:
            return np.zeros((m, n), dtype=np.int64)
        largest = float(np.abs(a.astype(np.float64)).max()) * float(np.abs(b.astype(np.float64)).max())
        if largest * d < EXACT:  # every partial sum is an integer that a double holds
            return (a.astype(np.float64) @ b.astype(np.float64)).astype(np.int64)
        return a @ b
    a = np.pad(a, ((0, m % 2), (0, d % 2)))
    b = np.pad(b, ((0, d % 2), (0, n % 2)))
    i, k, j = a.shape[0] // 2, a.shape[1] // 2, b.shape[1] // 2
    a11, a12, a21, a22 = a[:i, :k], a[:i, k:], a[i:, :k], a[i:, k:]
    b11, b12, b21, b22 = b[:k, :j], b[:k, j:], b[k:, :j], b[k:, j:]
    p1 = strassen(a11 + a22, b11 + b22, leaf)
    p2 = strassen(a21 + a22, b11, leaf)
    p3 = strassen(a11, b12 - b22, leaf)
    p4 = strassen(a22, b21 - b11, leaf)
    p5 = strassen(a11 + a12, b22, leaf)
    p6 = strassen(a21 - a11, b11 + b12, leaf)
    p7 = strassen(a12 - a22, b21 + b22, leaf)
    out = np.empty((2 * i, 2 * j), dtype=np.int64)
    out[:i, :j] = p1 + p4 - p5 + p7
    out[:i, j:] = p3 + p5
    out[i:, :j] = p2 + p4
    out[i:, j:] = p1 - p2 + p3 + p6
    return out[:m, :n]


def check_range(a: np.ndarray, b: np.ndarray) -> None:
    """Raise unless the norms prove that every score of the two tiles fits a 64-bit integer."""
    longest = [np.sqrt((x.astype(np.float64) ** 2).sum(axis=1).max(initial=0)) for x in (a, b)]
    if longest[0] * longest[1] >= MOST:
        raise OverflowError("inner products of these vectors may not fit 64 bits")


class Heaps:
    """``rows`` heaps of the ``size`` best (score, id), kept as arrays. Heaps merge; all are in order."""

    def __init__(self, rows: int, size: int):
        self.size = size
        self.scores = np.full((rows, size), NONE)
        self.ids = np.zeros((rows, size), dtype=np.int64)
        self.filled = np.zeros((rows, size), dtype=bool)

    def merge(self, at: np.ndarray, scores: np.ndarray, ids: np.ndarray, filled: np.ndarray) -> None:
        """Merge entries (a row of them per heap in ``at``) into those heaps."""
        scores = np.concatenate([self.scores[at], scores], axis=1)
        ids = np.concatenate([self.ids[at], ids], axis=1)
        filled = np.concatenate([self.filled[at], filled], axis=1)
        # Sorted by filled, score and id in turn, each sort keeping the order before it.
        order = np.argsort(ids, axis=1, kind="stable")
        for values in (scores, filled):
            turn = np.take_along_axis(values, order, 1)
            order = np.take_along_axis(order, _descending(turn), 1)
        order = order[:, : self.size]
        self.scores[at], self.ids[at], self.filled[at] = (
            np.take_along_axis(x, order, 1) for x in (scores, ids, filled)
        )

    def least(self, at: int, rows: int) -> np.ndarray:
        """The score that an entry must reach to enter each heap; ties may win by id."""
        heap = slice(at, at + rows)
        return np.where(self.filled[heap, -1], self.scores[heap, -1], NONE)

    def offer(self, heap: int, scores: np.ndarray, ids: np.ndarray) -> None:
        """Offer entries to one heap."""
        if len(scores) > 4 * self.size:
            kth = np.partition(scores, len(scores) - self.size)[len(scores) - self.size]
            scores, ids = scores[scores >= kth], ids[scores >= kth]
        best = np.lexsort((ids, -scores))[: self.size]
        self.merge(np.array([heap]), scores[best][None], ids[best][None], np.ones((1, len(best)), bool))


def _descending(values: np.ndarray) -> np.ndarray:
    """Order of each row from high to low that keeps equal values in place."""
    last = values.shape[1] - 1
    return last - np.argsort(values[:, ::-1], axis=1, kind="stable")[:, ::-1]


def integers(vectors: DataFrame, key: str, vector: str, label: str, scale: int) -> DataFrame:
    """id, label and the scaled components (binary, 64-bit) of the rows that take part, one per id."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            usable, values = matrix(batch.column(2))
            with np.errstate(over="ignore"):
                whole = np.floor(values * float(scale))
            if not (np.abs(whole) < MOST).all():
                raise OverflowError("a scaled component does not fit 64 bits")
            keep = pa.array(usable)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).filter(keep), batch.column(1).filter(keep),
                 pa.array([w.tobytes() for w in whole.astype("<i8")], pa.binary())],
                names=["id", "label", "units"],
            )

    rows = vectors.select(
        F.col(key).cast("long").alias("id"), F.col(label).cast("long").alias("label"), F.col(vector).alias("vector")
    ).where("id IS NOT NULL AND label IS NOT NULL")
    made = rows.mapInArrow(run, "id long, label long, units binary")
    return made.groupBy("id").agg(F.min(F.struct("label", "units")).alias("row")).select("id", "row.*")


def _units(column) -> np.ndarray:
    return np.frombuffer(b"".join(column), dtype="<i8").reshape(len(column), -1)


def blocks(rows: DataFrame, size: int) -> DataFrame:
    """One row per block of up to ``size`` vectors that follow each other by label and id."""

    def pack(key, pdf):
        pdf = pdf.sort_values(["label", "id"])
        if pdf["units"].map(len).nunique() > 1:
            raise ValueError("vectors of different dimensions meet")
        return pd.DataFrame([(
            key[0], len(pdf), pdf["id"].to_numpy().astype("<i8").tobytes(),
            pdf["label"].to_numpy().astype("<i8").tobytes(), b"".join(pdf["units"]),
        )], columns=["block", "n", "ids", "labels", "units"])

    laid = ranked(rows, [], ["label", "id"]).select(
        F.floor(F.col("rank") / size).alias("block"), "id", "label", "units"
    )
    return laid.groupBy("block").applyInPandas(pack, "block long, n long, ids binary, labels binary, units binary")


def _opened(batch: pa.RecordBatch) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    for n, ids, labels, units in zip(*[batch.column(i) for i in range(1, 5)], strict=True):
        yield (
            np.frombuffer(ids.as_py(), dtype="<i8"), np.frombuffer(labels.as_py(), dtype="<i8"),
            np.frombuffer(units.as_py(), dtype="<i8").reshape(n.as_py(), -1),
        )


def _tiles(anchors, block, same: bool, tile: int = TILE):
    """(first anchor, scores, ids, same label and not itself, other label) of every tile pair that may
    hold a partner of the label (``same``) or of another."""
    ids, labels, units = anchors
    block_ids, block_labels, block_units = block
    if units.shape[1] != block_units.shape[1]:
        raise ValueError("vectors of different dimensions meet")
    turned = np.ascontiguousarray(block_units.T)
    for at in range(0, len(ids), tile):
        own = labels[at : at + tile]
        for left in range(0, len(block_ids), tile * 4):
            other = block_labels[left : left + tile * 4]
            # Both are sorted by label.
            shared = own[0] <= other[-1] and other[0] <= own[-1]
            alike = own[0] == own[-1] == other[0] == other[-1]
            if (not shared) if same else alike:
                continue
            a, b = units[at : at + tile], turned[:, left : left + tile * 4]
            check_range(a, b.T)
            equal = own[:, None] == other[None, :]
            partner = block_ids[left : left + tile * 4]
            if same:
                equal &= ids[at : at + tile, None] != partner[None, :]
            yield at, strassen(a, b), partner, equal if same else ~equal


def _entries(heaps: Heaps, names: list[str], owners: list[np.ndarray]) -> pa.RecordBatch:
    row, place = np.nonzero(heaps.filled)
    columns = [pa.array(owner[row]) for owner in owners]
    columns += [pa.array(heaps.ids[row, place]), pa.array(heaps.scores[row, place])]
    return pa.RecordBatch.from_arrays(columns, names=names)


def _first(rows: DataFrame, groups: list[str], id_: str, score: str, n: int) -> DataFrame:
    order = Window.partitionBy(*groups).orderBy(F.desc(score), id_)
    return rows.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= n)


def _positives(held: DataFrame, anchors, n: int) -> DataFrame:
    """The ``n`` best of the anchor's label, merged over the tasks."""
    schema = "anchor_id long, positive_id long, positive_score long"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        heaps = Heaps(len(anchors[0]), n)
        for batch in batches:
            for block in _opened(batch):
                for at, scores, ids, allowed in _tiles(anchors, block, same=True):
                    allowed &= scores >= heaps.least(at, len(scores))[:, None]
                    for i in np.flatnonzero(allowed.any(axis=1)):
                        heaps.offer(at + i, scores[i, allowed[i]], ids[allowed[i]])
        yield _entries(heaps, ["anchor_id", "positive_id", "positive_score"], [anchors[0]])

    return _first(held.mapInArrow(run, schema), ["anchor_id"], "positive_id", "positive_score", n)


def _negatives(held: DataFrame, anchors, positives: pd.DataFrame, percents, n: int) -> DataFrame:
    """The ``n`` best of other labels within the window of each positive, merged over the tasks."""
    schema = "anchor_id long, positive_id long, positive_score long, negative_id long, negative_score long"
    positive = positives.sort_values(["anchor_id", "rank"])
    place = pd.Series(np.arange(len(anchors[0])), index=anchors[0])
    owner = place.loc[positive["anchor_id"]].to_numpy()
    # One heap per (anchor, turn of the positive), so that a tile's rows lie together in each turn.
    turn = positive["rank"].to_numpy().astype(np.int64) - 1
    turns = int(turn.max(initial=-1)) + 1
    shape = (turns, len(anchors[0]))
    low, high = np.full(shape, np.iinfo(np.int64).max), np.full(shape, NONE)  # an empty window
    ids, reached = np.zeros(shape, dtype=np.int64), np.zeros(shape, dtype=np.int64)
    for t, o, i, s in zip(turn, owner, positive["positive_id"], positive["positive_score"], strict=True):
        s = int(s)
        low[t, o], high[t, o] = -(-percents[0] * s // 100), percents[1] * s // 100
        ids[t, o], reached[t, o] = i, s

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        heaps = [Heaps(len(anchors[0]), n) for _ in range(turns)]
        for batch in batches:
            for block in _opened(batch):
                for at, scores, partner, allowed in _tiles(anchors, block, same=False):
                    rows = slice(at, at + len(scores))
                    # The windows of an anchor overlap: one cut for all of them, then each its own.
                    floor = np.maximum([h.least(at, len(scores)) for h in heaps], low[:, rows])
                    allowed &= scores >= floor.min(axis=0)[:, None]
                    allowed &= scores <= high[:, rows].max(axis=0)[:, None]
                    for i in np.flatnonzero(allowed.any(axis=1)):
                        own, ids_ = scores[i, allowed[i]], partner[allowed[i]]
                        for t in range(turns):
                            inside = (own >= floor[t, i]) & (own <= high[t, at + i])
                            if inside.any():
                                heaps[t].offer(at + i, own[inside], ids_[inside])
        for t in range(turns):
            yield _entries(heaps[t], [f.split()[0] for f in schema.split(", ")], [anchors[0], ids[t], reached[t]])

    groups = ["anchor_id", "positive_id", "positive_score"]
    return _first(held.mapInArrow(run, schema), groups, "negative_id", "negative_score", n)


def hard_negatives(
    vectors: DataFrame,
    anchors: Column,
    key: str = "vec_id",
    vector: str = "embedding",
    label: str = "label",
    scale: int = 256,
    positives: int = 5,
    negatives: int = 3,
    percents: tuple[int, int] = (50, 95),
    block_bytes: int = BLOCK_BYTES,
    round_bytes: int = ROUND_BYTES,
) -> DataFrame:
    """anchor_id, positive_id, rank (from 1), negative_id, positive_score, negative_score.

    For each anchor (a condition on ``id``) its best ``positives`` other vectors of the same label,
    and for each of these the best ``negatives`` vectors of other labels whose score lies between the
    two percentages of the positive's, bounds included. Ties go to the smaller id. Fewer are given where there
    are fewer; a positive without a negative in its window has no row, which is so below a score of 0.

    Rows with a NULL key or label, a NULL or empty vector, or a NULL or non-finite component take no
    part. Rows that repeat a key are one vector, that of the smallest label and then bytes. Vectors of
    different dimensions raise, and so do those whose scores may not fit 64 bits. An empty
    table gives an empty table. Anchors are taken by ``round_bytes`` at a time: those, their heaps and
    one tile pair are what a task holds besides a block of ``block_bytes``.
    """
    spark = vectors.sparkSession
    known = stage(integers(vectors, key, vector, label, scale), "integers")
    one = known.select(F.length("units")).first()
    bytes_ = one[0] if one else 1
    made = blocks(known, max(1, block_bytes // bytes_))
    held = stage(made.repartition(partitions(spark)), "blocks")
    asked = stage(ranked(known.where(anchors), [], ["label", "id"], "turn"), "anchors")
    round_ = max(1, round_bytes // bytes_)
    parts = []
    for start in range(0, asked.count(), round_):
        own = asked.where((F.col("turn") >= start) & (F.col("turn") < start + round_)).toPandas()
        own = own.sort_values(["label", "id"])
        now = (own["id"].to_numpy(), own["label"].to_numpy(), _units(own["units"]))
        found = stage(_positives(held, now, positives), "positives").toPandas()  # at most positives * round_
        if len(found):
            parts.append(stage(_negatives(held, now, found, percents, negatives), "negatives"))
    names = ["anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score"]
    if not parts:
        schema = "anchor_id long, positive_id long, rank int, negative_id long, positive_score long, negative_score long"
        return spark.createDataFrame([], schema)
    out = parts[0]
    for part in parts[1:]:
        out = out.union(part)
    return out.select(names)
