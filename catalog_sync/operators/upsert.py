"""Mutations as pure functions: (current rows, changes) -> next rows.

Sources must hold each key once; pass them through ``first_wins`` or ``fresh_latest`` first.
Nothing here writes: the snapshot store publishes the result under a new version.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from catalog_sync.operators.dedup import first_wins, union_rows
from catalog_sync.operators.joins import exclude_existing, keep_unknown

ACTION = "_action"
INSERT, UPDATE, UNCHANGED, SKIPPED = "insert", "update", "unchanged", "skipped"
ACTIONS = [INSERT, UPDATE, UNCHANGED, SKIPPED]

Stamp = tuple[str, dt.datetime | Column]


def _stamp_value(stamp: Stamp) -> Column:
    value = stamp[1]
    return value if isinstance(value, Column) else F.lit(value)


def _packed(source: DataFrame, keys: Sequence[str], columns: Sequence[str]) -> DataFrame:
    # The struct is NULL exactly where an outer join found no source row, so a source NULL stays
    # distinguishable from "no match".
    return source.select(*keys, F.struct(*columns).alias("_new"))


def update_tagged(
    target: DataFrame,
    source: DataFrame,
    keys: Sequence[str],
    columns: Sequence[str],
    stamp: Stamp | None = None,
) -> DataFrame:
    """Overwrite ``columns`` of matching rows (NULLs included) and set the stamp column on them;
    ``_action`` tells what happened to each row. Source rows without a match change nothing."""
    new = F.col("_new")
    hit = new.isNotNull()
    values = {c: F.when(hit, new[c]).otherwise(F.col(c)).alias(c) for c in columns}
    if stamp:
        name = stamp[0]
        values[name] = F.when(hit, _stamp_value(stamp)).otherwise(F.col(name)).alias(name)
    same = F.lit(True)
    for c in columns:
        same = same & new[c].eqNullSafe(F.col(c))
    action = F.when(~hit, SKIPPED).when(same, UNCHANGED).otherwise(UPDATE)
    joined = target.join(_packed(source, keys, columns), list(keys), "left")
    return joined.select(*[values.get(c, F.col(c)) for c in target.columns], action.alias(ACTION))


def update_by_key(
    target: DataFrame,
    source: DataFrame,
    keys: Sequence[str],
    columns: Sequence[str],
    stamp: Stamp | None = None,
) -> DataFrame:
    return update_tagged(target, source, keys, columns, stamp).drop(ACTION)


def replace_children_tagged(
    children: DataFrame,
    updated_parents: DataFrame,
    new_children: DataFrame,
    child_key: str,
    parent_key: str,
) -> DataFrame:
    """Swap the children of every updated parent. The parents drive the removal, so one whose
    new set is empty loses its old children too. ``_action`` tells new children from kept ones."""
    kept = keep_unknown(children, updated_parents, {child_key: parent_key}, unique=True)
    return kept.withColumn(ACTION, F.lit(SKIPPED)).unionByName(new_children.withColumn(ACTION, F.lit(INSERT)))


def replace_children(
    children: DataFrame,
    updated_parents: DataFrame,
    new_children: DataFrame,
    child_key: str,
    parent_key: str,
) -> DataFrame:
    swapped = replace_children_tagged(children, updated_parents, new_children, child_key, parent_key)
    return swapped.drop(ACTION)


def absent_rows(target: DataFrame, source: DataFrame, keys: Sequence[str]) -> DataFrame:
    """The source rows an insert would add."""
    return exclude_existing(source, target, keys)


def insert_absent(target: DataFrame, source: DataFrame, keys: Sequence[str]) -> DataFrame:
    return union_rows(target, absent_rows(target, source, keys))


def ignoring_duplicates(
    target: DataFrame, rows: DataFrame, keys: Sequence[str], order: Sequence[Column]
) -> DataFrame:
    """The rows of a bulk load that survive: first of each key, and only keys the target lacks."""
    return keep_unknown(first_wins(rows, keys, order), target, keys, unique=True)


def insert_ignore(
    target: DataFrame, rows: DataFrame, keys: Sequence[str], order: Sequence[Column]
) -> DataFrame:
    """Bulk load that never fails on a duplicate: existing rows win, then the first input row."""
    return union_rows(target, ignoring_duplicates(target, rows, keys, order).select(*target.columns))


def upsert_tagged(
    target: DataFrame,
    source: DataFrame,
    keys: Sequence[str],
    columns: Sequence[str],
    stamp: Stamp | None = None,
    newest_by: str | None = None,
) -> DataFrame:
    """Update matching rows and insert the others in one outer-join pass; ``_action`` tells what
    happened to each row.

    ``unchanged`` rows were equal already (the stamp still moves, they were refreshed);
    ``skipped`` are target rows the source does not mention. With ``newest_by`` a source row
    older than the target row is not applied, so late deliveries are harmless.
    """
    old = target.select(*keys, F.struct(*[c for c in target.columns if c not in keys]).alias("_old"))
    joined = old.join(_packed(source, keys, columns), list(keys), "full_outer")
    new, prior = F.col("_new"), F.col("_old")
    applies = new.isNotNull()
    if newest_by:
        applies = applies & ~F.coalesce(prior[newest_by] > new[newest_by], F.lit(False))
    same = F.lit(True)
    for c in columns:
        same = same & new[c].eqNullSafe(prior[c])
    action = (
        F.when(~applies, SKIPPED)
        .when(prior.isNull(), INSERT)
        .when(same, UNCHANGED)
        .otherwise(UPDATE)
    )
    out = []
    for c in target.columns:
        if c in keys:
            out.append(F.col(c))
        elif c in columns:
            out.append(F.when(applies, new[c]).otherwise(prior[c]).alias(c))
        elif stamp and c == stamp[0]:
            out.append(F.when(applies, _stamp_value(stamp)).otherwise(prior[c]).alias(c))
        else:
            out.append(prior[c].alias(c))
    return joined.select(*out, action.alias(ACTION))


def upsert(
    target: DataFrame,
    source: DataFrame,
    keys: Sequence[str],
    columns: Sequence[str],
    stamp: Stamp | None = None,
    newest_by: str | None = None,
) -> DataFrame:
    return upsert_tagged(target, source, keys, columns, stamp, newest_by).drop(ACTION)


def action_count_columns(action: str = ACTION) -> list[Column]:
    """One counter per action plus ``processed``, the rows a source spoke about. Usable in ``agg``
    or, to count during a write at no extra pass, in ``DataFrame.observe``."""
    counts = [F.count_if(F.col(action) == a).alias(a) for a in ACTIONS]
    return [*counts, F.count_if(F.col(action) != SKIPPED).alias("processed")]


def action_counts(tagged: DataFrame) -> DataFrame:
    return tagged.agg(*action_count_columns())
