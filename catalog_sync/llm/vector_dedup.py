"""Embedding near-dedup by sorted projection passes.

Each pass draws its own random hyperplanes and gives each vector the 62 signs as one number: the
concatenated hashes, most significant first. Sorted by it, vectors with a small angle between them
tend to be near each other. Every vector is compared in double precision with the ``window`` vectors
behind it. The order is cut into blocks of ``block`` ranks; a block also gets the next ``window``
vectors, so no neighbour is missed at a cut. A block's verified pairs are joined at once and leave
it as one edge per vector; the edges of all passes make the components.

Equal vectors form a class first and enter the passes as one. All links lie within components, so
the number of links is counted there exactly, block against block: a group of any size of
near copies is split over many tasks, and only counts leave them.

Windows miss more the larger and the denser a table is, so buckets follow. A pass over buckets draws new
hyperplanes, takes ``SIGNS`` signs and compares all vectors that share them, but for pairs the windows have
put into one component: a bucket of any size is split block against block. With no signs, as here, one
bucket holds the table and all pairs are compared: tables of any size and density are answered by one rule
and lose no link. With signs a pass is cheaper, and so many run that a pair just at the threshold meets
with a chance of ``RECALL``; their number is never chosen by the table.
"""

from __future__ import annotations

import math
from hashlib import blake2b

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from catalog_sync.llm.shared import components, ranked
from catalog_sync.llm.vectors import matrix
from catalog_sync.scratch import stage

PASSES = 12
BITS = 62
WINDOW = 256
BLOCK = 1024

# Buckets: signs, the chance that a pair at the threshold meets if there are any, vectors a block, and how
# many rows of a block are multiplied at a time.
SIGNS = 0
RECALL = 0.995
BUCKET_BLOCK = 16384
SLAB = 256


def _planes(dims: int, seed: int | tuple[int, int]) -> np.ndarray:
    return np.random.default_rng(seed).standard_normal((dims, BITS))


def _unit(values: np.ndarray) -> np.ndarray:
    """Rows of length 1; scaled by the largest component first, so that no square overflows."""
    values = values / np.abs(values).max(axis=1, keepdims=True)
    return values / np.linalg.norm(values, axis=1, keepdims=True)


def _prepared(vectors: DataFrame, key: str, vector: str, passes: int) -> DataFrame:
    """Usable vectors: key, identity (va, vb), unit (binary of doubles), hashes of all passes."""
    weights = 1 << np.arange(BITS - 1, -1, -1, dtype=np.int64)

    def prepare(batches):
        for batch in batches:
            usable, values = matrix(batch.column(1))
            nonzero = values.any(axis=1)
            keys = batch.column(0).filter(pa.array(usable)).filter(pa.array(nonzero))
            values = values[nonzero] + 0.0
            if not len(values):
                continue
            unit = _unit(values)
            marks = b"".join(blake2b(v.tobytes(), digest_size=16).digest() for v in values)
            halves = np.frombuffer(marks, dtype="<i8").reshape(-1, 2)
            hashes = np.stack(
                [(unit @ _planes(unit.shape[1], p) > 0) @ weights for p in range(passes)], axis=1
            )
            yield pa.RecordBatch.from_arrays(
                [keys, pa.array(halves[:, 0].copy()), pa.array(halves[:, 1].copy()),
                 pa.array([u.tobytes() for u in unit], pa.binary()),
                 pa.array(list(hashes), pa.list_(pa.int64()))],
                names=["id", "va", "vb", "unit", "hashes"],
            )

    return vectors.select(F.col(key).cast("long").alias("id"), vector).where("id IS NOT NULL").mapInArrow(
        prepare, "id long, va long, vb long, unit binary, hashes array<long>"
    )


def _units(column: pd.Series) -> np.ndarray:
    return np.frombuffer(b"".join(column), dtype=np.float64).reshape(len(column), -1)


def _roots(n: int, left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """The smallest position reachable from each of ``n`` positions."""
    low = np.arange(n)
    while True:
        new = low.copy()
        both = np.minimum(low[left], low[right])
        np.minimum.at(new, left, both)
        np.minimum.at(new, right, both)
        new = new[new]
        if (new == low).all():
            return low
        low = new


def _windows(classes: DataFrame, passes: int, window: int, block: int, threshold: float) -> DataFrame:
    """Edges (src, dst) of what the windows of all passes link."""
    keyed = classes.select("id", F.posexplode("hashes").alias("turn", "hash"))
    placed = ranked(keyed, ["turn"], ["hash", "id"])
    own = F.floor(F.col("rank") / block)
    halo = F.when((F.col("rank") % block < window) & (own > 0), F.array(own, own - 1)).otherwise(F.array(own))
    spots = placed.select("id", "turn", "rank", F.explode(halo).alias("part"))

    def compare(_, pdf):
        pdf = pdf.sort_values("rank", ignore_index=True)
        unit, ids = _units(pdf["unit"]), pdf["id"].to_numpy()
        own = int((pdf["rank"] // block == pdf["part"].iloc[0]).sum())
        left, right = [], []
        for at in range(0, own, window):
            end = min(at + window, own)
            near = unit[at:end] @ unit[at : end + window].T >= threshold
            a, b = np.nonzero(near)
            ahead = (b > a) & (b - a <= window)
            left.append(a[ahead] + at)
            right.append(b[ahead] + at)
        low = _roots(len(ids), np.concatenate(left), np.concatenate(right))
        moved = np.flatnonzero(low != np.arange(len(ids)))
        return pd.DataFrame({"src": ids[low[moved]], "dst": ids[moved]})

    return (
        spots.join(classes.select("id", "unit"), "id")
        .groupBy("turn", "part").applyInPandas(compare, "src long, dst long").distinct()
    )


def bucket_passes(signs: int, threshold: float, recall: float = RECALL) -> int:
    """How many passes of ``signs`` signs a pair at the threshold needs to share a bucket with a chance of ``recall``."""
    meets = (1 - math.acos(min(1.0, max(-1.0, threshold))) / math.pi) ** signs
    return 1 if meets >= recall else math.ceil(math.log1p(-recall) / math.log1p(-meets)) if meets > 0 else 1 << 30


def _signs() -> int:
    """The number of signs of a bucket, the same for every table."""
    return SIGNS


def _buckets(labelled: DataFrame, signs: int, passes: int, block: int, threshold: float) -> DataFrame:
    """Edges (src, dst) of labels: what is linked among all vectors that share a bucket in any pass.

    ``labelled``: id, label, unit. Pairs of one label are left out.
    """
    weights = 1 << np.arange(signs - 1, -1, -1, dtype=np.int64)

    def place(batches):
        for batch in batches:
            unit = _units(batch.column(2).to_pandas())
            for turn in range(passes):
                planes = _planes(unit.shape[1], (1, turn))[:, :signs]
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0), batch.column(1), pa.array(np.full(len(unit), turn), pa.int32()),
                     pa.array((unit @ planes > 0) @ weights, pa.int64())],
                    names=["id", "label", "turn", "bucket"],
                )

    spots = labelled.select("id", "label", "unit").mapInArrow(place, "id long, label long, turn int, bucket long")
    placed = stage(
        ranked(spots, ["turn", "bucket"], ["label", "id"]).withColumn("block", F.floor(F.col("rank") / block)),
        "buckets",
    )
    # By label, so that a large component fills blocks of its own, which are not compared with each other.
    spans = stage(
        placed.groupBy("turn", "bucket", "block").agg(F.min("label").alias("low"), F.max("label").alias("high")),
        "spans",
    )
    a, b = spans.alias("a"), spans.alias("b")
    pairs = a.join(b, ["turn", "bucket"]).where("a.block <= b.block").where(
        "least(a.low, b.low) < greatest(a.high, b.high)"
    ).select("turn", "bucket", F.col("a.block").alias("i"), F.col("b.block").alias("j"))
    alone = pairs.groupBy("turn", "bucket").agg((F.max("j") == 0).alias("alone"))
    deals = placed.count() // block + 1
    deal = F.when(F.col("alone"), F.pmod(F.xxhash64("turn", "bucket"), F.lit(deals))).otherwise(F.lit(-1).cast("long"))
    pairs = pairs.join(alone, ["turn", "bucket"]).withColumn("deal", deal)
    sides = pairs.withColumn("block", F.explode(F.array_distinct(F.array("i", "j"))))
    met = placed.select("turn", "bucket", "block", "id", "label").join(sides, ["turn", "bucket", "block"]).join(
        labelled.select("id", "unit"), "id"
    )

    def compare(_, pdf):
        found = []
        for (_, _, i, j), own in pdf.groupby(["turn", "bucket", "i", "j"], sort=False):
            one = own if i == j else own[own["block"] == i]
            two = own if i == j else own[own["block"] == j]
            unit, other = _units(one["unit"]), _units(two["unit"])
            mine, theirs = one["label"].to_numpy(), two["label"].to_numpy()
            for at in range(0, len(unit), SLAB):
                near = unit[at : at + SLAB] @ other.T >= threshold
                if near.any():
                    a, b = np.nonzero(near & np.not_equal.outer(mine[at : at + SLAB], theirs))
                    found.append(np.unique(np.stack([mine[a + at], theirs[b]], axis=1), axis=0))
        every = np.concatenate(found) if found else np.zeros((0, 2), dtype=np.int64)
        labels, places = np.unique(every, return_inverse=True)
        places = places.reshape(-1, 2)
        low = _roots(len(labels), places[:, 0], places[:, 1])
        moved = np.flatnonzero(low != np.arange(len(labels)))
        return pd.DataFrame({"src": labels[low[moved]], "dst": labels[moved]})

    group = [F.when(F.col("deal") < 0, F.col(c)).otherwise(-1).alias(f"g{c}") for c in ("turn", "bucket", "i", "j")]
    return (
        met.select("*", *group).groupBy("deal", "gturn", "gbucket", "gi", "gj")
        .applyInPandas(compare, "src long, dst long").distinct()
    )


def _linked(unique: DataFrame, passes: int, window: int, block: int, threshold: float) -> DataFrame:
    """(id, component) of every class that is linked with another one."""
    found = stage(components(_windows(unique, passes, window, block, threshold)), "found")
    labelled = stage(
        unique.select("id", "unit", "hashes").join(found, "id", "left")
        .withColumn("label", F.coalesce("component", "id")), "labelled"
    )
    signs = _signs()
    edges = _buckets(labelled, signs, bucket_passes(signs, threshold), BUCKET_BLOCK, threshold)
    joined = stage(
        components(edges).select(F.col("id").alias("label"), F.col("component").alias("whole")), "joined"
    )
    return labelled.select("id", "label", "component").join(joined, "label", "left").where(
        "component IS NOT NULL OR whole IS NOT NULL"
    ).select("id", F.coalesce("whole", "component").alias("component"))


def _link_counts(members: DataFrame, block: int, threshold: float) -> DataFrame:
    """(id, linked): how many vectors of other classes each class is linked with.

    ``members``: id, component, n (vectors of the class), unit, of components of several classes.
    """
    placed = stage(
        ranked(members, ["component"], ["id"])
        .withColumn("block", F.floor(F.col("rank") / block)), "members"
    )
    blocks = placed.groupBy("component").agg(F.max("block").alias("last"))
    met = placed.join(blocks, "component").withColumn(
        "other", F.explode(F.sequence(F.lit(0), F.col("last").cast("int")))
    ).select(
        "component", F.least("block", "other").alias("i"), F.greatest("block", "other").alias("j"),
        "block", "id", "n", "unit",
    )
    # Small components share groups: a group holds whole components, or one pair of blocks.
    single = F.col("i") == F.col("j")
    deals = placed.count() // 4096 + 1
    dealt = F.pmod(F.xxhash64("component", "i"), F.lit(deals))
    met = met.withColumn("deal", F.when(single, dealt).otherwise(F.lit(-1).cast("long")))

    def count(_, pdf):
        found = []
        for (_, i, j), own in pdf.groupby(["component", "i", "j"], sort=False):
            a, b = own[own["block"] == i], own[own["block"] == j]
            near = _units(a["unit"]) @ _units(b["unit"]).T >= threshold
            if i == j:
                np.fill_diagonal(near, False)
            found.append(pd.DataFrame({"id": a["id"], "linked": near @ b["n"].to_numpy()}))
            if i != j:
                found.append(pd.DataFrame({"id": b["id"], "linked": near.T @ a["n"].to_numpy()}))
        return pd.concat(found)

    pair = [F.when(F.col("deal") < 0, F.col(c)).otherwise(-1).alias(f"g{c}") for c in ("component", "i", "j")]
    return (
        met.select("*", *pair).groupBy("deal", "gcomponent", "gi", "gj")
        .applyInPandas(count, "id long, linked long")
        .groupBy("id").agg(F.sum("linked").alias("linked"))
    )


def near_vectors(
    vectors: DataFrame,
    key: str = "vec_id",
    vector: str = "embedding",
    threshold: float = 0.95,
    passes: int = PASSES,
    window: int = WINDOW,
    block: int = BLOCK,
) -> DataFrame:
    """One row per key: key, n_links, component_id, kept.

    A NULL, empty or zero vector, or one with a NULL or non-finite component, links with nothing. Rows
    that repeat a key are one vector: of differing ones that with the smallest identity hash counts,
    usable ones first. A NULL key has no links, a NULL component and is not kept; such rows are one
    row. Vectors must be of one dimension, else it raises. An empty table gives an empty table.
    """
    usable = _prepared(vectors, key, vector, passes)
    again = ["va", "vb", "unit", "hashes"]
    prepared = stage(
        usable.groupBy("id").agg(F.min_by(F.struct(*again), F.struct("va", "vb")).alias("v")).select("id", "v.*"),
        "vectors",
    )
    narrow = prepared.select("id", "va", "vb")
    classes = stage(narrow.groupBy("va", "vb").agg(F.min("id").alias("rep"), F.count(F.lit(1)).alias("n")), "classes")
    unique = stage(
        prepared.join(classes.select(F.col("rep").alias("id"), "n"), "id").select("id", "n", "unit", "hashes"),
        "unique",
    )
    found = stage(_linked(unique, passes, window, block, threshold), "linked")
    members = unique.join(found, "id").select("id", "component", "n", "unit")
    linked = _link_counts(members, block, threshold)
    of = stage(
        classes.join(found, classes["rep"] == found["id"], "left").drop("id")
        .join(linked, classes["rep"] == linked["id"], "left")
        .select("va", "vb", (F.coalesce("linked", F.lit(0)) + F.col("n") - 1).alias("n_links"),
                F.coalesce("component", "rep").alias("component_id")),
        "of",
    )
    rows = narrow.join(of, ["va", "vb"]).select("id", "n_links", "component_id")
    every = vectors.select(F.col(key).cast("long").alias(key)).distinct()
    return every.join(rows, F.col(key) == F.col("id"), "left").select(
        key, F.coalesce("n_links", F.lit(0).cast("long")).alias("n_links"),
        F.coalesce("component_id", key).alias("component_id"),
    ).withColumn("kept", F.coalesce(F.col("component_id") == F.col(key), F.lit(False)))
