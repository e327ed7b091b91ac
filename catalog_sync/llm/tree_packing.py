"""Packed id matrices: best-fit-decreasing with a segment tree, blocks of documents per task.

A task takes the pieces of its documents in blocks of ``block`` ids and packs each block on its own;
nothing shuffles, memory holds one block, and a lost task is redone alone. Small partitions are put
together first, without a shuffle, until a task has about a block, so the packing does not follow the
layout of many small files. Within a block pieces go longest first to the sequence with the
least free capacity that holds them. The segment tree has a leaf per free capacity and counts the open
sequences in each subtree: the search for the smallest capacity of at least a length walks one path
up and one down.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from catalog_sync.llm.tokens import runs_of

BLOCK = 1 << 22
BYTES = 4


class Capacities:
    """Open sequences by free capacity, in a segment tree over the capacities 0 to ``most``."""

    def __init__(self, most: int):
        self.leaves = 1 << most.bit_length()
        self.tree = [0] * (2 * self.leaves)
        self.open: list[list[int]] = [[] for _ in range(self.leaves)]

    def _count(self, capacity: int, by: int) -> None:
        at = self.leaves + capacity
        while at:
            self.tree[at] += by
            at >>= 1

    def add(self, capacity: int, sequence: int) -> None:
        self.open[capacity].append(sequence)
        self._count(capacity, 1)

    def take(self, length: int) -> tuple[int, int] | None:
        """(capacity, sequence) with the smallest capacity of at least ``length``, removed."""
        at = self.leaves + length
        if not self.tree[at]:
            while at > 1 and not (at & 1 == 0 and self.tree[at + 1]):
                at >>= 1
            if at <= 1:
                return None
            at += 1
            while at < self.leaves:
                at = 2 * at if self.tree[2 * at] else 2 * at + 1
        capacity = at - self.leaves
        self._count(capacity, -1)
        return capacity, self.open[capacity].pop()


def best_fit_decreasing(lengths: list[int], capacity: int) -> list[list[int]]:
    """Positions in ``lengths`` per sequence, in the order they are placed."""
    free, sequences = Capacities(capacity), []
    for i in sorted(range(len(lengths)), key=lambda i: (-lengths[i], i)):
        found = free.take(lengths[i])
        if found is None:
            found = (capacity, len(sequences))
            sequences.append([])
        sequences[found[1]].append(i)
        if found[0] > lengths[i]:
            free.add(found[0] - lengths[i], found[1])
    return sequences


def _in_blocks(docs: DataFrame, text: str, block: int) -> DataFrame:
    """The documents in at most as many partitions as they have blocks, taking ``BYTES`` of text for an id."""
    size = docs.agg(F.sum(F.coalesce(F.octet_length(text), F.lit(0)) + 1)).first()[0] or 0
    return docs.coalesce(max(1, math.ceil(size / (BYTES * block))))


def packed_rows(
    docs: DataFrame, path: str, key: str = "doc_id", text: str = "text", size: int = 2048,
    end_id: int = 0, pad_id: int = 0, block: int = BLOCK,
) -> DataFrame:
    """One row per sequence: a row of the id matrix and what cuts it into segments.

    ``ids`` and ``positions`` are ``size`` little-endian numbers of 16 bits (32 where ids need them, which the tokenizer's
    vocabulary decides); ids after ``length`` are ``pad_id``, positions count from 0 in each
    segment and are 0 in the padding. ``cu_seqlens`` holds the segments' cumulative lengths from 0, ``docs`` the key of each
    segment and where it starts in its document. A document is its text's ids and ``end_id``; one of more than ``size`` ids is
    cut into segments of ``size`` and a rest, which joined by ``start`` give it back. NULL and empty texts are ``end_id`` alone.
    Rows that repeat a key are documents of their own. Sequence ids are unique, not dense. An empty
    table gives an empty table. The documents are read once more for their size.
    """
    from tokenizers import Tokenizer

    wide = "<u2" if Tokenizer.from_file(path).get_vocab_size() <= 1 << 16 and max(end_id, pad_id) < 1 << 16 else "<u4"
    place = "<u2" if size <= 1 << 16 else "<u4"
    kind = docs.schema[key].dataType.simpleString()

    def rows(keys, starts, parts):
        lengths = [len(p) for p in parts]
        for members in best_fit_decreasing(lengths, size):
            bounds = np.concatenate([[0], np.cumsum([lengths[i] for i in members])])
            ids = np.full(size, pad_id, dtype=wide)
            positions = np.zeros(size, dtype=place)
            for i, at in zip(members, bounds.tolist(), strict=False):
                ids[at : at + lengths[i]] = parts[i]
                positions[at : at + lengths[i]] = np.arange(lengths[i])
            yield {
                "length": int(bounds[-1]), "ids": ids.tobytes(), "cu_seqlens": bounds.tolist(),
                "positions": positions.tobytes(),
                "docs": [{key: keys[i], "start": starts[i]} for i in members],
            }

    def pack(batches):
        runs, end = runs_of(path), end_id.to_bytes(4, "little")
        keys, starts, parts, held, schema = [], [], [], 0, None

        def flush():
            made = list(rows(keys, starts, parts))
            for at in range(0, len(made), 1024):
                yield pa.RecordBatch.from_pylist(made[at : at + 1024], schema=schema)
            keys.clear(), starts.clear(), parts.clear()

        for batch in batches:
            schema = pa.schema([
                ("length", pa.int32()), ("ids", pa.binary()), ("cu_seqlens", pa.list_(pa.int32())),
                ("positions", pa.binary()),
                ("docs", pa.list_(pa.struct([(key, batch.schema.field(0).type), ("start", pa.int64())]))),
            ])
            for owner, packed in zip(batch.column(0).to_pylist(), runs.ids(batch.column(1)), strict=True):
                ids = np.frombuffer(packed + end, dtype="<u4").astype(wide)
                for at in range(0, len(ids), size):
                    keys.append(owner)
                    starts.append(at)
                    parts.append(ids[at : at + size])
                held += len(ids)
                if held >= block:
                    yield from flush()
                    held = 0
        if keys:
            yield from flush()
        runs.trim()

    made = _in_blocks(docs.select(key, text), text, block).mapInArrow(
        pack, "length int, ids binary, cu_seqlens array<int>, positions binary, "
        f"docs array<struct<{key}:{kind}, start:bigint>>"
    )
    return made.select(F.monotonically_increasing_id().alias("sequence_id"), "*")


def write_packed(docs: DataFrame, folder: str, path: str, **options) -> None:
    """The packed rows as Parquet, for trainers that read the binary columns as matrix rows."""
    packed_rows(docs, path, **options).write.parquet(folder)
