"""Bulk-synchronous best-fit packing.

Items and gaps (what is free in an open sequence) are range-sorted by size, which gives each its
rank among those of its size. A round takes the items of one band of lengths, longest first. The
sweep goes over the counts per size, at most ``capacity`` of either kind whatever the size of the
corpus: each length looks for its successor among the gap sizes, the smallest that holds it; where
many items want the same gaps, ranks decide who gets which; what finds no gap opens new sequences.
The sweep's outcome is intervals of ranks, never rows. The executors apply it to the gaps
(each finds its interval by its rank), write the new gaps, and the next round ranks those anew. At
the end the items join their places on (length, rank), a unique key.

Within a round the outcome is what placing the items one by one, longest first, by best fit gives.
"""

from __future__ import annotations

from bisect import bisect_left, insort
from dataclasses import dataclass, field, replace

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from catalog_sync.llm.shared import partitions, ranked
from catalog_sync.scratch import stage

SPAN = 1 << 44


@dataclass
class Cohort:
    """``n`` sequences with equal gaps and contents; those of ranks ``low``... in gap size ``origin``
    (0: opened in this round). ``puts``: (length, rank of the first item, items per sequence)."""

    origin: int
    low: int
    n: int
    gap: int
    puts: list[tuple[int, int, int]] = field(default_factory=list)

    def split(self, n: int) -> tuple[Cohort, Cohort]:
        rest = [(length, first + n * each, each) for length, first, each in self.puts]
        return (
            replace(self, n=n, puts=list(self.puts)),
            replace(self, low=self.low + n, n=self.n - n, puts=rest),
        )


class Sweep:
    """One round over the counts per size."""

    def __init__(self, gaps: dict[int, int], capacity: int):
        self.capacity = capacity
        self.sizes: list[int] = []
        self.of: dict[int, list[Cohort]] = {}
        self.done: list[Cohort] = []
        self.opened = 0
        for gap, n in sorted(gaps.items()):
            self.keep(Cohort(gap, 0, n, gap))

    def keep(self, cohort: Cohort) -> None:
        if cohort.gap <= 0:
            self.done.append(cohort)
            return
        if not self.of.get(cohort.gap):
            self.of[cohort.gap] = []
            insort(self.sizes, cohort.gap)
        self.of[cohort.gap].append(cohort)

    def take(self, length: int) -> Cohort | None:
        """The cohort with the smallest gap that holds ``length``."""
        at = bisect_left(self.sizes, length)
        if at == len(self.sizes):
            return None
        own = self.of[self.sizes[at]]
        cohort = own.pop()
        if not own:
            self.sizes.pop(at)
        return cohort

    def place(self, length: int, n: int) -> None:
        first = 0
        while first < n:
            left = n - first
            cohort = self.take(length)
            if cohort is None:
                fits = self.capacity // length
                cohort = Cohort(0, self.opened, -(-left // fits), self.capacity)
                self.opened += cohort.n
            each = min(cohort.gap // length, left)
            used = min(cohort.n, left // each)
            if used < cohort.n:
                cohort, rest = cohort.split(used)
                self.keep(rest)
            cohort.puts.append((length, first, each))
            cohort.gap -= each * length
            self.keep(cohort)
            first += used * each

    def outcome(self) -> list[Cohort]:
        rest = [c for own in self.of.values() for c in own]
        return sorted(self.done + rest, key=lambda c: (c.origin, c.low))


def _apply(gaps: DataFrame, cohorts: list[Cohort], capacity: int) -> DataFrame:
    """Rows (sequence, gap, rank) to (sequence, new gap, lengths, first ranks, counts, offsets)."""
    starts = np.array([c.origin * SPAN + c.low for c in cohorts], dtype=np.int64)

    def move(batches):
        for batch in batches:
            sequence, gap, rank = (batch.column(i).to_numpy() for i in range(3))
            at = np.searchsorted(starts, gap * SPAN + rank, side="right") - 1
            after, seq, lengths, ranks, offsets = [], [], [], [], []
            for s, g, r, i in zip(sequence.tolist(), gap.tolist(), rank.tolist(), at.tolist(), strict=True):
                c = cohorts[i]
                used = capacity - (g or capacity)
                for length, first, each in c.puts:
                    begin = first + (r - c.low) * each
                    for k in range(each):
                        seq.append(s)
                        lengths.append(length)
                        ranks.append(begin + k)
                        offsets.append(used)
                        used += length
                after.append(c.gap)
            yield pa.RecordBatch.from_arrays(
                [pa.array([*sequence.tolist(), *seq], pa.int64()),
                 pa.array([*after, *[None] * len(seq)], pa.int64()),
                 pa.array([*[None] * len(after), *lengths], pa.int64()),
                 pa.array([*[None] * len(after), *ranks], pa.int64()),
                 pa.array([*[None] * len(after), *offsets], pa.int64())],
                names=["sequence_id", "gap", "length", "rank", "offset"],
            )

    return gaps.select("sequence_id", "gap", "rank").mapInArrow(
        move, "sequence_id long, gap long, length long, rank long, offset long"
    )


def _counts(df: DataFrame, size: str) -> dict[int, int]:
    """Rows per size: as many as the capacity at most."""
    return {r[0]: r[1] for r in df.groupBy(size).count().collect()}


def bands(capacity: int) -> list[tuple[int, int]]:
    """(lowest, highest) length of each round: halves of what is below the capacity, down to 16."""
    out, high = [], capacity - 1
    while high > 0:
        low = high // 2 + 1 if high > 16 else 1
        out.append((low, high))
        high = low - 1
    return out


def pack(items: DataFrame, order: list[str], capacity: int, length: str = "length") -> DataFrame:
    """``items`` with ``sequence_id`` and ``offset``: best-fit-decreasing at ``capacity``.

    ``length`` is from 1 to ``capacity`` (others raise). ``order`` fixes which of the items of one
    length goes where; items that tie on it may swap places. Input columns named ``sequence_id``,
    ``offset`` or ``rank`` are replaced. An empty table gives an empty table.
    """
    spark = items.sparkSession
    columns = [c for c in items.columns if c not in ("sequence_id", "offset", "rank")]
    sized = ranked(items.select(*columns).withColumn(length, F.col(length).cast("long")), [length], order)
    laid = stage(sized, "items")
    waiting = _counts(laid, length)
    if any(n is None or not 0 < n <= capacity for n in waiting):
        raise ValueError(f"lengths must be from 1 to {capacity}")
    opened = waiting.pop(capacity, 0)
    gaps, places = None, []
    for low, high in bands(capacity):
        band = {n: waiting[n] for n in sorted(waiting, reverse=True) if low <= n <= high}
        if not band:
            continue
        sweep = Sweep(_counts(gaps, "gap") if gaps is not None else {}, capacity)
        for size, n in band.items():
            sweep.place(size, n)
        new = spark.range(sweep.opened, numPartitions=partitions(spark)).select(
            (F.col("id") + opened).alias("sequence_id"), F.lit(0).cast("long").alias("gap"),
            F.col("id").alias("rank"),
        )
        opened += sweep.opened
        before = new if gaps is None else ranked(gaps, ["gap"], ["sequence_id"]).unionByName(new)
        round_ = stage(_apply(before, sweep.outcome(), capacity), "round")
        gaps = round_.where("gap > 0").select("sequence_id", "gap")
        places.append(round_.where("gap IS NULL").select("sequence_id", "length", "rank", "offset"))
    whole = laid.where(F.col(length) == capacity).select(
        *columns, F.col("rank").alias("sequence_id"), F.lit(0).cast("long").alias("offset")
    )
    if not places:
        return whole
    placed = places[0]
    for more in places[1:]:
        placed = placed.union(more)
    placed = placed.withColumnsRenamed({"length": "__length", "rank": "__rank"})
    match = (F.col(length) == F.col("__length")) & (F.col("rank") == F.col("__rank"))
    return whole.union(laid.join(placed, match).select(*columns, "sequence_id", "offset"))
