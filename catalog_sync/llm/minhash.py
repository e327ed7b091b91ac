"""MinHash near-dedup: one-permutation hashing, optimal densification, banded buckets, star edges.

A document's set is its distinct shingles. Documents with equal sets form a class at once (equal
128-bit fingerprints of the sorted set), so a group of exact copies costs one row each. One hash
per shingle gives both its bin (of BANDS x ROWS) and its rank there; an empty bin borrows from the bin
that a hash of (bin, attempt) points to, tried until one is full (optimal densification).

Each band is a bucket. Within a bucket each class is paired with the smallest class only, so a
bucket of n gives n - 1 candidate pairs. Candidates are confirmed on the full sets, recomputed from the texts, and the
confirmed links form components. What a star can miss is a link between two members of which one is
not similar to the centre. So buckets whose members still lie in several components are compared
block by block by signature: each member proposes its nearest member of another component, what is
confirmed joins components, and so on until a round finds few links; then every pair left in different
components is proposed whose sizes allow the similarity and whose estimate is within ``DEVIATIONS``
standard deviations of it. Pairs of sets of ``SMALL`` shingles at most are settled where they meet.
Members of one component are never paired again: a group of near copies gives few pairs.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from catalog_sync.llm.shared import components, gathered, partitions, ranked
from catalog_sync.llm.words import WORD_COUNT, mix, shingles
from catalog_sync.scratch import discard, recorded, stage

BANDS = 25
ROWS = 5
BINS = BANDS * ROWS
DEVIATIONS = 4
BLOCK = 4096
SLAB = 128
SMALL = 256
FEW = 100
PAIRS = 1 << 16
TEXTS = 1 << 12
EMPTY = np.uint64(0xFFFFFFFFFFFFFFFF)


@lru_cache(maxsize=1)
def _walk() -> np.ndarray:
    """(attempt, bin): the bin an empty bin asks at each attempt."""
    attempt, at = np.meshgrid(np.arange(4 * BINS), np.arange(BINS), indexing="ij")
    return (mix((attempt * BINS + at + 1).astype(np.uint64)) % np.uint64(BINS)).astype(np.int64)


def signature(hashes: np.ndarray) -> np.ndarray:
    """One 64-bit minimum per bin; ``hashes`` must not be empty."""
    scrambled = mix(hashes ^ np.uint64(0x5851F42D4C957F2D))
    at = (scrambled % np.uint64(BINS)).astype(np.int64)
    bins = np.full(BINS, EMPTY, dtype=np.uint64)
    np.minimum.at(bins, at, scrambled // np.uint64(BINS))
    empty = np.flatnonzero(bins == EMPTY)
    full = bins != EMPTY
    out = bins.copy()
    for row in _walk():
        if not len(empty):
            return out
        asked = row[empty]
        hit = full[asked]
        out[empty[hit]] = bins[asked[hit]]
        empty = empty[~hit]
    out[empty] = bins[np.flatnonzero(full)[0]]
    return out


def bands(sig: np.ndarray) -> np.ndarray:
    """One 64-bit key per band."""
    rows = sig.reshape(BANDS, ROWS)
    key = np.arange(1, BANDS + 1, dtype=np.uint64)
    for i in range(ROWS):
        key = mix(key * np.uint64(0xD6E8FEB86659FD93) + rows[:, i])
    return key


def _texts(column: pa.Array) -> list[bytes]:
    return [x or b"" for x in column.cast(pa.binary()).to_pylist()]


def _signed(docs: DataFrame, key: str, text: str, width: int) -> DataFrame:
    """key, n_shingles, fingerprint (fa, fb), bands and the low bytes of the signature."""

    def sign(batches):
        for batch in batches:
            sizes, prints, keys, sketches = [], [], [], []
            for value in _texts(batch.column(1)):
                hashes = shingles(value, width)
                sizes.append(len(hashes))
                prints.append(xxhash.xxh3_128_digest(hashes.tobytes()))
                if len(hashes):
                    sig = signature(hashes)
                    keys.append(bands(sig).view(np.int64))
                    sketches.append(sig.astype(np.uint16).tobytes())
                else:
                    keys.append([])
                    sketches.append(b"")
            halves = np.frombuffer(b"".join(prints), dtype="<i8").reshape(-1, 2)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(sizes, pa.int64()), pa.array(halves[:, 0].copy()),
                 pa.array(halves[:, 1].copy()), pa.array(keys, pa.list_(pa.int64())),
                 pa.array(sketches, pa.binary())],
                names=["__key", "n_shingles", "__fa", "__fb", "__bands", "__sketch"],
            )

    return docs.select(F.col(key).cast("long").alias("__key"), text).mapInArrow(
        sign,
        "__key long, n_shingles long, __fa long, __fb long, __bands array<long>, __sketch binary",
    )


def _confirmed(pairs: DataFrame, texts: DataFrame, width: int, percent: int) -> DataFrame:
    """The (src, dst) pairs whose full sets reach ``percent`` of similarity."""
    left = texts.select(F.col("__key").alias("src"), F.col("__text").alias("__ls"))
    right = texts.select(F.col("__key").alias("dst"), F.col("__text").alias("__rs"))
    rows = pairs.count()
    both = gathered(pairs.join(right, "dst"), rows, TEXTS).join(left, "src").select("src", "dst", "__ls", "__rs")
    both = gathered(both, rows, TEXTS, 4)

    def confirm(batches):
        last, kept = None, None
        for batch in batches:
            good = []
            for a, b in zip(_texts(batch.column(2)), _texts(batch.column(3)), strict=True):
                if a != last:
                    last, kept = a, shingles(a, width)
                other = shingles(b, width)
                same = len(np.intersect1d(kept, other, assume_unique=True))
                good.append(100 * same >= percent * (len(kept) + len(other) - same))
            mask = pa.array(good, pa.bool_())
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).filter(mask), batch.column(1).filter(mask)], names=["src", "dst"]
            )

    return both.mapInArrow(confirm, "src long, dst long")


def _least(sizes: np.ndarray, percent: int) -> np.ndarray:
    """How many bins must agree for a pair whose larger set has ``sizes`` shingles to be proposed."""
    p = percent / 100
    deviation = np.sqrt(p * (1 - p) / np.minimum(sizes, BINS))
    return np.maximum(1, BINS * (p - DEVIATIONS * deviation))


def _settled(a: bytes, b: bytes, percent: int) -> bool:
    """False if both sets are at hand and not similar enough."""
    if not a or not b:
        return True
    one, two = np.frombuffer(a, dtype=np.uint64), np.frombuffer(b, dtype=np.uint64)
    same = len(np.intersect1d(one, two, assume_unique=True))
    return 100 * same >= percent * (len(one) + len(two) - same)


def _small_sets(texts: DataFrame, members: DataFrame, width: int) -> DataFrame:
    """(key, set) of the members with ``SMALL`` shingles at most: sorted hashes as bytes."""

    def gather(batches):
        for batch in batches:
            found = [shingles(value, width) for value in _texts(batch.column(1))]
            sets = [h.tobytes() if len(h) <= SMALL else b"" for h in found]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(sets, pa.binary())], names=["__key", "__set"])

    keys = gathered(members.select("__key").distinct(), members.count())
    own = gathered(texts.join(keys, "__key", "left_semi"), texts.count(), TEXTS, 4)
    return own.select("__key", "__text").mapInArrow(gather, "__key long, __set binary")


def _block_pairs(members: DataFrame, sketches: DataFrame) -> DataFrame:
    """The members of buckets of more than ``BLOCK``, a row for each pair of blocks (__i, __j) that their block
    (__block) meets in."""
    bucket = ["__band", "__bucket"]
    placed = stage(
        ranked(members, bucket, ["__component", "__key"], "__rank")
        .withColumn("__block", F.floor(F.col("__rank") / BLOCK)).join(sketches, "__key"),
        "placed",
    )
    blocks = placed.groupBy(*bucket, "__block").agg(
        F.min("__component").alias("__low"), F.max("__component").alias("__high")
    )
    left = blocks.select(*bucket, F.col("__block").alias("__i"), F.col("__low").alias("__l1"), F.col("__high").alias("__h1"))
    right = blocks.select(*bucket, F.col("__block").alias("__j"), F.col("__low").alias("__l2"), F.col("__high").alias("__h2"))
    meet = stage(
        left.join(right, bucket)
        .where("__i <= __j AND NOT (__l1 = __h1 AND __l2 = __h2 AND __l1 = __l2)")
        .select(*bucket, "__i", "__j"),
        "meet",
    )
    sides = meet.withColumn("__block", F.explode(F.array_distinct(F.array("__i", "__j"))))
    return placed.drop("__rank").join(sides, [*bucket, "__block"])


def _mixed_pairs(
    members: DataFrame, sketches: DataFrame, percent: int, nearest: bool
) -> DataFrame:
    """Pairs of bucket members in different components that estimate near the threshold.

    ``members``: band, bucket, key, component and the bucket's size, of the buckets that hold several
    components. A bucket of up to ``BLOCK`` members is one group. A larger one is sorted by component and
    cut into blocks of ``BLOCK``; two blocks meet in a group of their own unless both hold one and the same
    component. Within a group ``SLAB`` members are compared at a time. ``nearest``: of each member's pairs only the best.
    Else a pair is looked at in the first band that it shares, and where the small sets of both are
    at hand (column ``__set`` of ``sketches``) it is settled there: only links leave the task.
    """
    bucket = ["__band", "__bucket"]
    columns = [*bucket, "__i", "__j", "__block", *sketches.columns, "__component"]
    start = [F.lit(0).cast("long").alias(c) for c in ("__i", "__j", "__block")]
    met = members.where(F.col("__n") <= BLOCK).select("*", *start).join(sketches, "__key").select(*columns)
    rows = members.count()
    met = gathered(met, rows)
    large = members.where(F.col("__n") > BLOCK).drop("__n")
    if not large.isEmpty():
        met = met.union(_block_pairs(large, sketches).select(*columns))

    names = [*bucket, "__i", "__j", "__block", "__key", "__component", "__size", "__sketch"]
    names += ["__set"] * ("__set" in sketches.columns)

    def compare(batches):
        for group in _groups(batches, 4):
            i, j = group.column(2)[0], group.column(3)[0]
            a, b = (group.filter(pc.equal(group.column(4), x)) for x in (i, j))
            i, j = i.as_py(), j.as_py()
            one, two = (
                np.frombuffer(b"".join(x.column(8).to_pylist()), dtype=np.uint16).reshape(len(x), BINS)
                for x in (a, b)
            )
            (mine, of, sizes), (other, of2, sizes2) = (
                [x.column(k).to_numpy() for k in (5, 6, 7)] for x in (a, b)
            )
            lefts, rights = [], []
            best, of_best = np.full(len(b), -1), np.zeros(len(b), dtype=np.int64)
            for at in range(0, len(a), SLAB):
                rows = np.arange(at, min(at + SLAB, len(a)))
                # Sorted by component: most slabs hold one, and meet the others only.
                alike = of[rows[0]] == of[rows[-1]]
                columns = np.flatnonzero(of2 != of[at]) if alike else np.arange(len(b))
                if i == j and not nearest:
                    columns = columns[columns >= at]
                large, small = (f.outer(sizes[rows], sizes2[columns]) for f in (np.maximum, np.minimum))
                near = np.not_equal.outer(of[rows], of2[columns]) & (100 * small >= percent * large)
                some, others = np.flatnonzero(near.any(axis=1)), np.flatnonzero(near.any(axis=0))
                if not len(some):
                    continue
                rows, columns, near, large = rows[some], columns[others], near[np.ix_(some, others)], large[np.ix_(some, others)]
                theirs = two[columns]
                same = np.stack([np.count_nonzero(theirs == row, axis=1) for row in one[rows]])
                near &= same >= _least(large, percent)
                if nearest:
                    same = np.where(near, same, -1)
                    first, most = same.argmax(axis=1), same.max(axis=1)
                    lefts.append(rows[most >= 0])
                    rights.append(columns[first[most >= 0]])
                    better = same.max(axis=0) > best[columns]
                    best[columns[better]] = same.max(axis=0)[better]
                    of_best[columns[better]] = rows[same.argmax(axis=0)[better]]
                    continue
                left, right = np.nonzero(near)
                left, right = rows[left], columns[right]
                for part in range(0, len(left), PAIRS):
                    l, r = left[part : part + PAIRS], right[part : part + PAIRS]
                    shared = (one[l] == two[r]).reshape(len(l), BANDS, ROWS).all(axis=2)
                    new = ~shared[:, : group.column(0)[0].as_py()].any(axis=1)
                    lefts.append(l[new])
                    rights.append(r[new])
            if nearest:
                lefts.append(of_best[best >= 0])
                rights.append(np.flatnonzero(best >= 0))
            if not sum(map(len, lefts)):
                continue
            left, right = np.concatenate(lefts), np.concatenate(rights)
            if not nearest:
                sets, sets2 = a.column(9).to_pylist(), b.column(9).to_pylist()
                held = [_settled(sets[x], sets2[y], percent) for x, y in zip(left, right, strict=True)]
                left, right = left[held], right[held]
            left, right = mine[left], other[right]
            found = np.unique(np.stack([np.minimum(left, right), np.maximum(left, right)], axis=1), axis=0)
            if len(found):
                yield pa.RecordBatch.from_arrays(
                    [pa.array(found[:, 0].copy()), pa.array(found[:, 1].copy())], names=["src", "dst"]
                )

    # Dealt out by count: comparing takes time that the rows' size does not show.
    keys = [*bucket, "__i", "__j"]
    met = met.repartition(partitions(members.sparkSession), *keys).sortWithinPartitions(*keys, "__component", "__key")
    return gathered(met.select(*names), rows, TEXTS, 8).mapInArrow(compare, "src long, dst long").distinct()


def _groups(batches: Iterator[pa.RecordBatch], keys: int) -> Iterator[pa.Table]:
    """Runs of rows that agree on the first ``keys`` columns, of sorted batches."""
    held: list[pa.Table] = []
    last = None
    for batch in batches:
        table = pa.Table.from_batches([batch])
        if not len(table):
            continue
        values = np.stack([table.column(i).to_numpy() for i in range(keys)], axis=1)
        cuts = [0, *(np.flatnonzero((values[1:] != values[:-1]).any(axis=1)) + 1).tolist(), len(table)]
        if held and tuple(values[0]) != last:
            yield pa.concat_tables(held).combine_chunks()
            held = []
        for start, end in zip(cuts, cuts[1:], strict=False):
            held.append(table.slice(start, end - start))
            if end < len(table):
                yield pa.concat_tables(held).combine_chunks()
                held = []
        last = tuple(values[-1])
    if held:
        yield pa.concat_tables(held).combine_chunks()


def _repeated_keys(filled: DataFrame, classes: DataFrame) -> DataFrame:
    """Edges that join the classes of rows with one and the same key."""
    rows = filled.count()
    again = filled.groupBy("__key").agg(F.count(F.lit(1)).alias("__n")).where("__n > 1").select("__key")
    repeated = gathered(filled.select("__key", "__fa", "__fb").join(gathered(again, rows), "__key"), rows)
    edges = (
        repeated.join(classes, ["__fa", "__fb"])
        .select(F.col("__key").alias("src"), F.col("__rep").alias("dst")).where("src <> dst")
    )
    return gathered(gathered(edges, rows).distinct(), rows)


def _mixed(members: DataFrame, found: DataFrame) -> DataFrame:
    """The members of buckets that hold several components, with their components and the bucket's size."""
    bucket = ["__band", "__bucket"]
    rows = members.count()
    grouped = (
        members.join(found, members["__key"] == found["id"], "left")
        .select(*bucket, "__key", F.coalesce("component", "__key").alias("__component"))
    )
    grouped = stage(gathered(grouped, rows), "grouped")
    mixed = (
        grouped.groupBy(*bucket).agg(
            F.min("__component").alias("__low"), F.max("__component").alias("__high"), F.count(F.lit(1)).alias("__n")
        ).where("__low <> __high").select(*bucket, "__n")
    )
    out = stage(gathered(grouped.join(mixed, bucket), rows), "mixed")
    discard(grouped)
    return out


def near_duplicates(
    docs: DataFrame, key: str = "doc_id", text: str = "text", words: int = 5, percent: int = 80
) -> DataFrame:
    """One row per row of ``docs``: key, n_shingles, component_id, kept.

    Links join documents whose sets of ``words``-word shingles reach ``percent`` / 100 of Jaccard
    similarity; ``component_id`` is the smallest key reachable, ``kept`` marks that document.
    A text of fewer words is one shingle; a NULL, empty or blank text has no shingle, is linked with
    nothing and kept. Rows that repeat a key are one document: a link of one of them is a link of
    all that have shingles. A NULL key has a NULL component and is kept. An empty table gives an empty table.
    """
    signed = stage(_signed(docs, key, text, words), "signed")
    filled = signed.where("n_shingles > 0 AND __key IS NOT NULL")
    total = signed.count()
    classes = (
        filled.groupBy("__fa", "__fb").agg(
            F.min("__key").alias("__rep"), F.first("n_shingles").alias("n_shingles"),
            F.first("__bands").alias("__bands"),
            F.first("__sketch").alias("__sketch"),
        )
    )
    classes = stage(gathered(classes, total, TEXTS), "classes")
    placed = BANDS * classes.count()
    buckets = (
        classes.select("__rep", F.posexplode("__bands").alias("__band", "__bucket"))
        .groupBy("__band", "__bucket")
        .agg(F.min("__rep").alias("__centre"), F.count(F.lit(1)).alias("__n"))
        .where("__n > 1")
    )
    buckets = stage(gathered(buckets, placed), "buckets")
    members = (
        classes.select(F.col("__rep").alias("__key"), F.posexplode("__bands").alias("__band", "__bucket"))
        .join(buckets, ["__band", "__bucket"])
        .select("__band", "__bucket", "__key", "__centre")
    )
    members = stage(gathered(members, placed), "members")
    star = (
        members.where("__key <> __centre")
        .select(F.col("__centre").alias("src"), F.col("__key").alias("dst")).distinct()
    )
    star = stage(gathered(star, placed), "star")
    keyed = docs.select(F.col(key).cast("long").alias("__key"), F.col(text).alias("__text"))
    near = gathered(members.select("__key").distinct(), placed)
    texts = stage(gathered(keyed.join(near, "__key", "left_semi"), total, TEXTS), "texts")
    links = stage(
        _confirmed(star, texts, words, percent).union(_repeated_keys(filled, classes)), "links"
    )
    # The bands and sketches of every row have served; those of the classes are left.
    rows = stage(signed.select("__key", "n_shingles", "__fa", "__fb"), "rows")
    discard(signed, buckets)
    found = components(links, links.count())
    sketches = classes.select(
        F.col("__rep").alias("__key"), F.col("n_shingles").alias("__size"), "__sketch"
    )
    tested, nearest = star, True
    while True:
        mixed = _mixed(members, found)
        open_ = gathered(mixed.select("__key").distinct(), mixed.count()).count()
        if not open_:
            break
        known = sketches
        if not nearest:
            known = sketches.join(_small_sets(texts, mixed, words), "__key")
        with recorded() as used:
            found_pairs = _mixed_pairs(mixed, known, percent, nearest)
        untested = found_pairs.join(tested, ["src", "dst"], "left_anti")
        pairs = stage(gathered(untested, 2 * mixed.count()) if nearest else untested, "pairs")
        discard(mixed, *used)
        tested = tested.union(pairs)
        more = stage(_confirmed(pairs, texts, words, percent), "links")
        linked = more.count()
        if linked:
            links = links.union(more)
            found = components(links, links.count())
        if not nearest:
            break
        # A round that joins little leaves little: the last one settles all of it.
        nearest = linked * FEW > open_
    rep = classes.select(F.col("__fa").alias("__ca"), F.col("__fb").alias("__cb"), "__rep")
    of = rep.join(found, rep["__rep"] == found["id"], "left").select(
        "__ca", "__cb", F.coalesce("component", "__rep").alias("__component")
    )
    same = (F.col("__fa") == F.col("__ca")) & (F.col("__fb") == F.col("__cb")) & (F.col("n_shingles") > 0)
    component = F.when(F.col("__key").isNotNull(), F.coalesce("__component", "__key"))
    return (
        gathered(rows.join(stage(gathered(of, total), "of"), same, "left"), total)
        .select(F.col("__key").alias(key), "n_shingles", component.alias("component_id"))
        .withColumn("kept", F.coalesce(F.col("component_id") == F.col(key), F.lit(True)))
    )


def keep_one(
    docs: DataFrame, key: str = "doc_id", text: str = "text", words: int = 5, percent: int = 80
) -> DataFrame:
    """``docs`` with one document of each group of near duplicates, that with the smallest key.

    Documents without words or without key are in no group and stay. Of rows that repeat the kept
    key one stays, the first by a hash of its text.
    """
    in_group = F.coalesce(F.col(key).isNotNull() & F.col(text).rlike(WORD_COUNT), F.lit(False))
    flagged = docs.withColumn("__in", in_group)
    grouped = flagged.where("__in").drop("__in")
    kept = stage(
        near_duplicates(grouped, key, text, words, percent).where("kept").select(key).distinct(), "kept"
    )
    turn = Window.partitionBy(key).orderBy(F.xxhash64(text))
    first = grouped.join(kept, key, "left_semi").withColumn("__turn", F.row_number().over(turn))
    return first.where("__turn = 1").select(*docs.columns).union(
        flagged.where("NOT __in").select(*docs.columns)
    )
