"""Key-based joins: known / unknown rows, lookups, and the checked broadcast.

``on`` is a list of shared column names or a dict ``{left column: right column}``.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from catalog_sync.operators.dedup import top_n

On = Sequence[str] | Mapping[str, str]

# A key frame of up to this many rows may be broadcast, if its columns have a fixed width (a
# BIGINT key costs ~16 bytes: tens of MB at most). Text keys have no such bound.
MAX_BROADCAST_KEYS = 1_000_000
_FIXED_WIDTH = (T.NumericType, T.BooleanType, T.DateType, T.TimestampType, T.TimestampNTZType)


def pairs(on: On) -> list[tuple[str, str]]:
    return list(on.items()) if isinstance(on, Mapping) else [(c, c) for c in on]


def key_set(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Distinct non-null keys. Duplicates of a hot key collapse before the shuffle, and the
    result is partitioned the way a join on the same keys wants it."""
    return df.select(*keys).dropna().distinct()


def _renamed_keys(right: DataFrame, on: On) -> DataFrame:
    return right.select(*[F.col(r).alias(l) for l, r in pairs(on)])


def _left(on: On) -> list[str]:
    return [l for l, _ in pairs(on)]


def fits_broadcast(keys: DataFrame, max_rows: int = MAX_BROADCAST_KEYS) -> bool:
    """Count the keys; only an answer within the bound allows a broadcast."""
    fixed = all(isinstance(f.dataType, _FIXED_WIDTH) for f in keys.schema.fields)
    return fixed and keys.count() <= max_rows


def sized(keys: DataFrame, max_rows: int = MAX_BROADCAST_KEYS) -> DataFrame:
    """The keys with a broadcast hint if, and only if, their count allows it."""
    return F.broadcast(keys) if fits_broadcast(keys, max_rows) else keys


def keep_known(df: DataFrame, parents: DataFrame, on: On, unique: bool = False) -> DataFrame:
    """Rows whose key exists among the parents. ``unique`` says the parents hold a key once."""
    keys = _renamed_keys(parents, on)
    keys = keys if unique else key_set(keys, _left(on))
    return df.join(keys, _left(on), "left_semi")


def keep_listed(df: DataFrame, key: str, ids: DataFrame) -> DataFrame:
    """Rows whose key is among the ids (a frame of one column). A predicate, not a join: it moves below
    unions and whatever derives columns from the rows, so only rows that stay are taken apart."""
    return df.where(F.col(key).isin(ids))


def keep_unknown(df: DataFrame, parents: DataFrame, on: On, unique: bool = False) -> DataFrame:
    """Rows whose key is absent from the parents; a NULL key matches nothing and stays."""
    keys = _renamed_keys(parents, on)
    keys = keys if unique else key_set(keys, _left(on))
    return df.join(keys, _left(on), "left_anti")


def _hits(keys: DataFrame, target: DataFrame, on: On) -> DataFrame:
    # The keys have been counted and the hits are a subset of them: both may be broadcast.
    target_keys = _renamed_keys(target, on)
    return F.broadcast(target_keys.join(F.broadcast(keys), _left(on), "left_semi").distinct())


def existing_keys(
    keys: DataFrame, target: DataFrame, on: On, max_rows: int = MAX_BROADCAST_KEYS
) -> DataFrame:
    """Those of the (distinct) keys the target holds, under the left names.

    A bounded set of keys is the usual case (what is new since yesterday) and the target is the
    whole catalog. A join would shuffle every target key to find a few; instead the keys are
    broadcast over the target scan and only the hits travel. More keys take the plain join.
    """
    if fits_broadcast(keys, max_rows):
        return _hits(keys, target, on)
    return keep_known(keys, target, on)


def exclude_existing(
    source: DataFrame, target: DataFrame, on: On, max_rows: int = MAX_BROADCAST_KEYS
) -> DataFrame:
    """Source rows not yet in the target (a NULL key is not in it), found the same way."""
    keys = key_set(source, _left(on))
    if fits_broadcast(keys, max_rows):
        return source.join(_hits(keys, target, on), _left(on), "left_anti")
    return keep_unknown(source, target, on)


def enrich(df: DataFrame, lookup: DataFrame, on: On, how: str = "inner") -> DataFrame:
    """Attach the columns of a lookup that holds each key once. Catalyst broadcasts a small
    lookup by its size; a larger one is shuffled and a hot key on the left is split by AQE."""
    renamed = lookup
    for l, r in pairs(on):
        if l != r:
            renamed = renamed.withColumnRenamed(r, l)
    return df.join(renamed, _left(on), how)


def attach_first_children(
    parents: DataFrame,
    children: DataFrame,
    on: Mapping[str, str],
    order: Sequence[Column],
    n: int,
    rank: str = "child_rank",
    candidate_keys: DataFrame | None = None,
) -> DataFrame:
    """Left join each parent with its first ``n`` children.

    ``candidate_keys`` is any cheap superset of the parent keys. When it is small the child scan
    is filtered by it in place; otherwise the children are cut to ``n`` per key map-side before
    they are shuffled, so no parent ever brings more than ``n`` rows per map task.
    """
    (parent_key, child_key), = on.items()
    if candidate_keys is not None:
        wanted = key_set(candidate_keys, [parent_key])
        if fits_broadcast(wanted):
            children = keep_known(
                children, F.broadcast(wanted), {child_key: parent_key}, unique=True
            )
    firsts = top_n(children, [child_key], order, n, rank=rank)
    return parents.join(firsts.withColumnRenamed(child_key, parent_key), parent_key, "left")
