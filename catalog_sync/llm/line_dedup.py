"""Line dedup with two Bloom filters: once-seen and twice-seen line hashes.

A line's key is the line stripped of ``[\\x20\\x09-\\x0D]`` at both ends with A-Z lower-cased. Every
task fills a once-seen and a twice-seen filter over the lines of its own documents; the filters are
merged chunk by chunk on the executors (a bit that two tasks have set in their once-seen filters is
set in the merged twice-seen one). The merged twice-seen filter has no false negatives, so lines
outside it are in one document only and never shuffle. The suspects shuffle as 128-bit hashes and
are counted exactly; a false positive of a filter only costs one more counted row.

The filter has 128 bits a document, at least 2**20 and at most ``MAX_BITS``: what is broadcast is
32 MB at most at any size of corpus. A fuller filter lets more suspects through, the result is the
same.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from catalog_sync.llm.blooms import Bloom
from catalog_sync.llm.shared import partitions
from catalog_sync.scratch import stage

MAX_BITS = 1 << 28
MIN_BITS = 1 << 20
BITS_PER_DOCUMENT = 128
HASHES = 4
CHUNK = 1 << 14
FANS = 64
STRIPPED = b" \t\n\r\x0b\x0c"


def line_key(line: bytes) -> bytes:
    return line.strip(STRIPPED).lower()


def line_keys(text: bytes, min_chars: int) -> list[tuple[int, bytes]]:
    """(line number, 16-byte hash of the key) of each line whose key has ``min_chars`` code points."""
    found = []
    for i, line in enumerate(text.split(b"\n")):
        key = line_key(line)
        if len(key) >= min_chars and (min_chars <= 1 or len(key.decode()) >= min_chars):
            found.append((i, xxhash.xxh3_128_digest(key)))
    return found


def _halves(digests: list[bytes]) -> np.ndarray:
    return np.frombuffer(b"".join(digests), dtype="<u8").reshape(-1, 2)


def _texts(column: pa.Array) -> list[bytes]:
    return [x or b"" for x in column.cast(pa.binary()).to_pylist()]


def _or_chunks(pdf):
    once = np.zeros(len(pdf["once"].iloc[0]), dtype=np.uint8)
    twice = once.copy()
    for o, t in zip(pdf["once"], pdf["twice"], strict=True):
        o, t = np.frombuffer(o, dtype=np.uint8), np.frombuffer(t, dtype=np.uint8)
        twice |= t | (once & o)
        once |= o
    return pdf.head(1).assign(once=once.tobytes(), twice=twice.tobytes())


def twice_seen(docs: DataFrame, text: str, min_chars: int, bits: int) -> np.ndarray:
    """The merged twice-seen filter: ``bits`` / 8 bytes, whatever the size of the corpus."""
    chunk = min(CHUNK, bits // 8)

    def fill(batches):
        once, twice = Bloom(bits, HASHES), Bloom(bits, HASHES)
        for batch in batches:
            for value in _texts(batch.column(0)):
                if keys := {k for _, k in line_keys(value, min_chars)}:
                    hashes = _halves(sorted(keys))[:, 0]
                    twice.add(hashes[once.holds(hashes)])
                    once.add(hashes)
        a, b = once.data.reshape(-1, chunk), twice.data.reshape(-1, chunk)
        used = np.flatnonzero(a.any(axis=1))
        for at in np.array_split(used, max(1, len(used) // 256)):
            yield pa.RecordBatch.from_arrays(
                [pa.array(at, pa.int64()), pa.array([a[i].tobytes() for i in at], pa.binary()),
                 pa.array([b[i].tobytes() for i in at], pa.binary())],
                names=["chunk", "once", "twice"],
            )

    schema = "chunk long, fan int, once binary, twice binary"
    parts = docs.select(text).mapInArrow(fill, "chunk long, once binary, twice binary")
    parts = parts.withColumn("fan", F.spark_partition_id() % FANS).select("chunk", "fan", "once", "twice")
    merged = (
        parts.groupBy("chunk", "fan").applyInPandas(_or_chunks, schema)
        .groupBy("chunk").applyInPandas(_or_chunks, schema)
    )
    data = np.zeros(bits // 8, dtype=np.uint8)
    for row in merged.select("chunk", "twice").toLocalIterator():
        data[row[0] * chunk : (row[0] + 1) * chunk] = np.frombuffer(row[1], dtype=np.uint8)
    return data


def filter_bits(documents: int) -> int:
    wanted = max(MIN_BITS, documents * BITS_PER_DOCUMENT)
    return min(MAX_BITS, 1 << (wanted - 1).bit_length())


def drop_repeated_lines(
    docs: DataFrame,
    key: str = "doc_id",
    text: str = "text",
    min_docs: int = 10,
    min_chars: int = 1,
    keep_first: bool = False,
    bits: int | None = None,
) -> DataFrame:
    """``docs`` without the lines whose key is found in ``min_docs`` documents or more.

    ``keep_first`` leaves the first occurrence (by key, then line number) of each such line. Adds
    ``n_lines`` (before dropping) and ``n_dropped``; input columns of these names are replaced.

    NULL and empty texts hold one empty line, which has no key of ``min_chars``; a NULL text stays
    NULL. Each row is a document: rows that repeat a key, or have none, count separately and lose
    the same lines. An empty table gives an empty table.
    """
    spark = docs.sparkSession
    bits = bits or filter_bits(docs.count())
    seen = spark.sparkContext.broadcast(twice_seen(docs, text, min_chars, bits))

    def suspect(batches):
        twice = Bloom(bits, HASHES, seen.value)
        for batch in batches:
            owners, lines, digests = [], [], []
            for i, value in enumerate(_texts(batch.column(1))):
                first: dict[bytes, int] = {}
                for line, k in line_keys(value, min_chars):
                    first.setdefault(k, line)
                owners += [i] * len(first)
                lines += first.values()
                digests += first
            halves = _halves(digests)
            keep = np.flatnonzero(twice.holds(halves[:, 0].copy()))
            owner = pa.array(np.asarray(owners, dtype=np.int64)[keep])
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).take(owner), batch.column(2).take(owner), pa.array(halves[keep, 0].view(np.int64)),
                 pa.array(halves[keep, 1].view(np.int64)),
                 pa.array(np.asarray(lines, dtype=np.int64)[keep])],
                names=["__key", "__mark", "__a", "__b", "__line"],
            )

    kind = docs.schema[key].dataType.simpleString()
    # Rows are told apart by key and text, so rows without key do not share one set of lines.
    mark = F.xxhash64(F.col(text))
    suspects = stage(
        docs.select(F.col(key).alias("__key"), text, mark.alias("__mark"))
        .mapInArrow(suspect, f"__key {kind}, __mark long, __a long, __b long, __line long"),
        "suspects",
    )
    first = F.min(F.struct("__key", "__line"))
    dropped = stage(
        suspects.groupBy("__a", "__b")
        .agg(F.count(F.lit(1)).alias("__docs"), first.alias("__first"))
        .where(F.col("__docs") >= min_docs).select("__a", "__b", "__first"),
        "dropped",
    )
    spare = F.col("__first.__key").eqNullSafe(F.col("__key")) if keep_first else F.lit(False)
    hits = (
        suspects.join(dropped, ["__a", "__b"])
        .groupBy("__key", "__mark")
        .agg(F.collect_set(F.struct(
            "__a", "__b", F.when(spare, F.col("__first.__line")).otherwise(-1).alias("__keep")
        )).alias("__hits"))
        .withColumnsRenamed({"__key": "__owner", "__mark": "__of"})
    )
    columns = [c for c in docs.columns if c not in ("n_lines", "n_dropped")]
    at = columns.index(text)

    def rewrite(batches):
        for batch in batches:
            texts, counts, drops = [], [], []
            nulls = batch.column(at).is_null().to_pylist()
            for value, hit in zip(_texts(batch.column(at)), batch.column(len(columns)).to_pylist(), strict=True):
                lines = value.split(b"\n")
                gone = {(h["__a"], h["__b"]): h["__keep"] for h in hit or ()}
                kept = lines
                if gone:
                    kept = []
                    for i, line in enumerate(lines):
                        a, b = np.frombuffer(xxhash.xxh3_128_digest(line_key(line)), dtype="<i8").tolist()
                        if gone.get((a, b), i) == i:
                            kept.append(line)
                texts.append(b"\n".join(kept))
                counts.append(len(lines))
                drops.append(len(lines) - len(kept))
            texts = [None if n else x for n, x in zip(nulls, texts, strict=True)]
            out = [batch.column(i) for i in range(len(columns))]
            out[at] = pa.array(texts, pa.binary()).cast(pa.string())
            yield pa.RecordBatch.from_arrays(
                [*out, pa.array(counts, pa.int64()), pa.array(drops, pa.int64())],
                names=[*columns, "n_lines", "n_dropped"],
            )

    schema = docs.select(*columns).withColumns(
        {"n_lines": F.lit(0).cast("long"), "n_dropped": F.lit(0).cast("long")}
    ).schema
    own = F.col(key).eqNullSafe(F.col("__owner")) & (mark == F.col("__of"))
    joined = docs.select(*columns).join(hits, own, "left")
    return joined.select(*columns, "__hits").mapInArrow(rewrite, schema)
