"""Versioned Parquet tables published together.

A table is a set of parts, folders that are written once and never touched again. Each publish
writes new parts and then one manifest record that says which parts every table gains and loses, so
all tables change at once and files being read stay where they are. An insert costs what it adds.

**Slots.** With ``buckets`` every keyed table is dealt into that many slots by a hash of its first
key column, and a part holds one slot. A rewrite reads and replaces the slots that its keys fall
into and leaves the others alone; the parts of a slot that appends left behind are merged by
``compact``. Tables that hold a key once are stored clustered by it as well, all their parts
behind one table declaration, so a join on the key shuffles the other side only, however many
appends there were. Child tables are not: one parent may own a large share of their rows, and a
bucket cannot be split the way a shuffled partition can.

**Transactions.** A publish names the version its rows were computed from. Before its record is
written, all that was published since is checked against it: a part it replaces must still be there, a
table it replaces whole must be as it was, and no key it adds may have been added in between.
Otherwise it raises ``Conflict`` and nothing of it is visible; ``jobs.commit`` computes again.
Records are written aside and renamed, which fails if the version is taken.

**Statistics.** Every part comes with its rows and the least and greatest key and dates, so counts
and watermarks need no scan, and parts out of a range are not read.
"""

from __future__ import annotations

import datetime as dt
import hashlib
import json
import re
import uuid
from collections.abc import Callable, Iterable, Iterator, Mapping, Sequence
from concurrent.futures import ThreadPoolExecutor
from contextlib import contextmanager
from dataclasses import asdict, dataclass, field, replace as changed

from py4j.protocol import Py4JJavaError
from pyspark import inheritable_thread_target
from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from catalog_sync.operators.places import located, nowhere
from catalog_sync.operators.upsert import ACTION, INSERT, SKIPPED, UNCHANGED, UPDATE
from catalog_sync.schemas import KEYS, LOOSE, SIDE_KEYS

SLOT = "_slot"
BUCKET_KEYS = {"movies": "id", "people": "id"}
FULL_EVERY = 32
MOST_PARTS = 4
#: The slot of rows that are written beside a table's and are no part of it.
REST = -1
#: Up to so many slots are dealt out by the tasks that compute the rows, which then hold a file of each
#: open. Their row groups share the size of one.
OPEN_SLOTS = 16
ROW_GROUP = 128 << 20


class Conflict(RuntimeError):
    """What was published since the tables were read does not go together with these changes."""


@dataclass(frozen=True)
class Part:
    """``stats`` holds the least and greatest value of some columns, dates as text."""

    path: str
    slot: int | None
    rows: int
    clustered: bool = False
    stats: dict = field(default_factory=dict, hash=False, compare=False)

    def may_hold(self, column: str, low=None, high=None) -> bool:
        """Whether the part can hold a value from ``low`` to ``high`` (either may be open)."""
        if column not in self.stats:
            return True
        least, greatest = self.stats[column]
        if least is None:
            return False
        return (low is None or greatest >= _plain(low)) and (high is None or least <= _plain(high))


@dataclass(frozen=True)
class Table:
    columns: str
    slots: int
    parts: tuple[Part, ...] = ()


@dataclass(frozen=True)
class Layout:
    version: int = 0
    tables: dict[str, Table] = field(default_factory=dict)
    streams: dict[str, int] = field(default_factory=dict)


@dataclass(frozen=True)
class Published:
    """Rows and parts written by table, and how many rows were inserted, updated, found unchanged, and
    deleted, counted while writing. ``log`` holds the errors published with them."""

    version: int
    rows: dict[str, int]
    parts: dict[str, int] = field(default_factory=dict)
    counters: dict[str, dict[str, int]] = field(default_factory=dict)
    log: DataFrame | None = field(default=None, repr=False, compare=False)


@dataclass(frozen=True)
class Rewrite:
    """A change of the rows under some keys: ``keys`` gives a frame of one column, values of the table's
    first key column, ``apply`` turns rows that hold all of those into the rows to store. If it tags them with
    what happened to them (``_action``), that is counted."""

    keys: Callable[[], DataFrame]
    apply: Callable[[DataFrame], DataFrame]


@dataclass(frozen=True)
class Written:
    """Rows of a table written before they are published, as an append may name them. ``rest`` holds the
    rows that were kept out of the table."""

    table: Table
    rows: DataFrame = field(repr=False, compare=False)
    located: DataFrame = field(repr=False, compare=False)
    rest: DataFrame = field(repr=False, compare=False)


@dataclass
class _Change:
    columns: str
    slots: int
    whole: bool = False
    removed: set[str] = field(default_factory=set)
    added: list[Part] = field(default_factory=list)
    actions: dict[str, int] = field(default_factory=dict)


class Snapshot(dict):
    """Tables by name, read at one version."""

    def __init__(self, store: SnapshotStore, layout: Layout, names: Iterable[str] = ()):
        super().__init__({n: store._open(n, layout.tables[n]) for n in names or layout.tables})
        self.store, self.layout = store, layout

    @property
    def version(self) -> int:
        return self.layout.version

    def over(self, defaults: Mapping[str, DataFrame]) -> Snapshot:
        """The same with default frames for the tables the store lacks."""
        for name, df in defaults.items():
            self.setdefault(name, df)
        return self

    def parts(self, name: str) -> tuple[Part, ...] | None:
        """The parts the table consists of, None if it has been given another frame."""
        known = self.layout.tables.get(name)
        return known.parts if known else None

    def rows(self, name: str) -> int:
        return sum(p.rows for p in self.parts(name) or ())

    def bounds(self, name: str, column: str) -> tuple | None:
        """Least and greatest value of a column from the parts' statistics: (None, None) in a
        table without values, None where a part lacks them."""
        parts = [p for p in self.parts(name) or () if p.rows]
        if any(column not in p.stats for p in parts):
            return None
        some = [p.stats[column] for p in parts if p.stats[column][0] is not None]
        if not some:
            return None, None
        least, greatest = min(s[0] for s in some), max(s[1] for s in some)
        if isinstance(self[name].schema[column].dataType, T.DateType):
            return dt.date.fromisoformat(least), dt.date.fromisoformat(greatest)
        return least, greatest

    def between(self, name: str, column: str, low=None, high=None) -> DataFrame:
        """The table without the parts that cannot hold a value from ``low`` to ``high``."""
        known = self.layout.tables.get(name)
        if known is None:
            return self[name]
        parts = tuple(p for p in known.parts if p.may_hold(column, low, high))
        return self.store._open(name, changed(known, parts=parts))

    def around(self, name: str, keys: DataFrame) -> DataFrame:
        """The table without the slots that hold none of the keys (a frame of one column), for
        looking up a few keys."""
        known = self.layout.tables.get(name)
        if known is None or not known.slots:
            return self[name]
        return self.store._open(name, self._around(known, keys))

    def located_around(self, name: str, keys: DataFrame) -> DataFrame:
        """The same with the places of the rows, of a table the store holds."""
        known = self.layout.tables[name]
        return self.store._located(name, self._around(known, keys) if known.slots else known)

    def _around(self, known: Table, keys: DataFrame) -> Table:
        slots = self.store._touched(keys, known.slots)
        return changed(known, parts=tuple(p for p in known.parts if p.slot in slots))

    def split(
        self, name: str, version: int, keys: DataFrame | None = None
    ) -> tuple[DataFrame, DataFrame, DataFrame]:
        """The table by what an earlier version (0 is before the first) held: the rows in parts that were there
        already, those in parts written since, and the earlier rows in parts that are gone since. ``keys`` (a frame of one column)
        leaves the slots that hold none of them out of the first."""
        now = self.layout.tables[name]
        old = self.store._layout(version).tables.get(name, changed(now, parts=()))
        before, after = set(old.parts), set(now.parts)
        slots = self.store._touched(keys, now.slots) if keys is not None and now.slots else None
        kept = [p for p in now.parts if p in before and (slots is None or p.slot in slots)]
        written = [p for p in now.parts if p not in before]
        gone = [p for p in old.parts if p not in after]
        read = lambda table, parts: self.store._open(name, changed(table, parts=tuple(parts)))
        return read(now, kept), read(now, written), read(old, gone)


def _plain(value):
    return value.isoformat() if isinstance(value, dt.date) else value


def slot_of(key: Column | str, slots: int) -> Column:
    """The slot of a key, by the hash Spark buckets by."""
    return F.pmod(F.hash(key), F.lit(slots))


class SnapshotStore:
    def __init__(
        self,
        spark: SparkSession,
        root: str,
        buckets: int = 0,
        bucket_keys: Mapping[str, str] = BUCKET_KEYS,
        keys: Mapping[str, Sequence[str]] = {**KEYS, **SIDE_KEYS},
    ):
        if buckets and not re.match(r"/|\w+:", root):
            raise ValueError("a bucketed store needs an absolute path")
        self.spark = spark
        self.root = root.rstrip("/")
        self.buckets = buckets
        self.bucket_keys = dict(bucket_keys)
        self.keys = {name: list(k) for name, k in {**{n: [c] for n, c in bucket_keys.items()}, **keys}.items()}
        self._records: dict[int, dict] = {}
        self._seen: int | None = None

    # --- reading ------------------------------------------------------------------

    def version(self) -> int:
        """Newest published version, 0 before the first."""
        return max(self._versions(), default=0)

    def last_batch(self, stream: str) -> int:
        """Highest stream batch already published, -1 for none."""
        return self._layout().streams.get(stream, -1)

    def tables(self, version: int | None = None) -> Snapshot:
        """All tables of a version, by default the newest, which later publishes are checked
        against unless they name another."""
        layout = self._layout(version)
        if version is None:
            self._seen = layout.version
        elif layout.version != version or not version:
            raise ValueError(f"no version {version} in {self.root}")
        return Snapshot(self, layout)

    def table(self, name: str, version: int | None = None) -> DataFrame:
        layout = self._layout(version)
        if version is None:
            self._seen = layout.version
        elif layout.version != version:
            raise ValueError(f"no version {version} in {self.root}")
        return self._open(name, layout.tables[name])

    def _open(self, name: str, table: Table) -> DataFrame:
        schema = T.StructType.fromJson(json.loads(table.columns))
        if not table.parts:
            return self.spark.createDataFrame([], schema)
        if all(p.clustered for p in table.parts):
            return self._open_clustered(name, table, schema)
        return self.spark.read.schema(schema).parquet(*[f"{self.root}/{p.path}" for p in table.parts])

    def _located(self, name: str, table: Table) -> DataFrame:
        df = self._open(name, table)
        return located(df) if table.parts else nowhere(df)

    def _open_clustered(self, name: str, table: Table, schema: T.StructType) -> DataFrame:
        # Spark keeps the bucket layout in its catalog, not with the files: declare it again, each
        # part being a partition with a place of its own.
        paths = sorted(p.path for p in table.parts)
        told = "\n".join([self.spark.sparkContext.applicationId, self.root, *paths])
        known = f"snapshot_{name}_" + hashlib.md5(told.encode()).hexdigest()
        if not self.spark.catalog.tableExists(known):
            columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema.fields)
            key = self.bucket_keys[name]
            self.spark.sql(
                f"CREATE TABLE {known} ({columns}, _part STRING) USING parquet PARTITIONED BY (_part) "
                f"CLUSTERED BY (`{key}`) SORTED BY (`{key}`) INTO {table.slots} BUCKETS "
                f"LOCATION '{self.root}/{name}/declared'"
            )
            try:
                for at in range(0, len(paths), 1000):
                    spots = " ".join(
                        f"PARTITION (_part='{p}') LOCATION '{self.root}/{p}'" for p in paths[at : at + 1000]
                    )
                    self.spark.sql(f"ALTER TABLE {known} ADD {spots}")
            except BaseException:  # a table that lacks parts must not be found again
                self.spark.sql(f"DROP TABLE {known}")
                raise
        return self.spark.read.table(known).drop("_part")

    def changes(self, name: str, since: int, until: int | None = None) -> DataFrame:
        """What became of a keyed table between two versions: its rows with ``_action``, insert, update
        or delete (a deleted row as it was). Reads the parts that only one of the versions has."""
        before, after = self._layout(since).tables[name], self._layout(until).tables[name]
        old = self._open(name, changed(before, parts=tuple(set(before.parts) - set(after.parts))))
        new = self._open(name, changed(after, parts=tuple(set(after.parts) - set(before.parts))))
        keys, names = self.keys[name], [f["name"] for f in json.loads(after.columns)["fields"]]
        pack = lambda df, side: df.select(*keys, F.struct(*[c for c in names if c in df.columns]).alias(side))
        both = pack(old, "_old").join(pack(new, "_new"), keys, "full_outer")
        action = F.when(F.col("_old").isNull(), "insert").when(F.col("_new").isNull(), "delete").otherwise("update")
        row = F.coalesce("_new", "_old")
        differs = ~F.col("_old").eqNullSafe(F.col("_new"))
        return both.where(differs).select(row.alias("_row"), action.alias("_action")).select("_row.*", "_action")

    # --- publishing -----------------------------------------------------------------

    def publish(
        self,
        replace: Mapping[str, DataFrame] | None = None,
        append: Mapping[str, DataFrame | Written] | None = None,
        stream: str | None = None,
        batch: int | None = None,
        rewrite: Mapping[str, Rewrite] | None = None,
        base: int | None = None,
    ) -> Published:
        """Write the given tables, then make them current in one step. Tables not named carry over.

        ``base`` is the version the frames were computed from, by default the one this store read
        last, or the newest if it read none. Raises ``Conflict`` if what was published since does
        not go together with it. Row counts are taken while writing."""
        now = self._layout()
        base = self._seen if base is None else base
        then = now if base is None or base >= now.version else self._layout(base)
        rows: dict[str, int] = {}
        made: dict[str, _Change] = {}
        writes: dict[str, list[Callable[[], None]]] = {}

        def add(name: str, change: _Change, df: DataFrame, gone: Sequence[Part] = ()) -> None:
            made[name] = change
            writes.setdefault(name, []).append(lambda: write(name, change, df, gone))

        def write(name: str, change: _Change, df: DataFrame, gone: Sequence[Part]) -> None:
            known = [f["name"] for f in json.loads(change.columns)["fields"]]
            parts, counted = self._write(name, df.select(*known, *[c for c in [ACTION] if c in df.columns]),
                                         then.version + 1, change.slots)
            written = sum(p.rows for p in parts)
            kept = counted.pop(SKIPPED) + counted[UPDATE] + counted[UNCHANGED] if counted else 0
            counted = counted or {INSERT: written, UPDATE: 0, UNCHANGED: 0}
            counted["delete"] = sum(p.rows for p in gone) - kept
            for kind, n in counted.items():
                change.actions[kind] = change.actions.get(kind, 0) + n
            change.added += parts
            rows[name] = rows.get(name, 0) + written

        for name, df in (replace or {}).items():
            old = then.tables.get(name)
            slots = old.slots if old else self._slots(name)
            gone = old.parts if old else ()
            add(name, _Change(df.drop(ACTION).schema.json(), slots, True, {p.path for p in gone}), df, gone)
        for name, change in (rewrite or {}).items():
            old = then.tables[name]
            parts = old.parts
            if old.slots:
                touched = self._touched(change.keys(), old.slots)
                parts = tuple(p for p in parts if p.slot in touched)
                if not touched:
                    rows[name] = 0  # no key, nothing to do
                    continue
            new = change.apply(self._open(name, changed(old, parts=parts)))
            add(name, _Change(old.columns, old.slots, not old.slots, {p.path for p in parts}), new, parts)
        for name, df in (append or {}).items():
            old = then.tables.get(name)
            if isinstance(df, Written):
                if name not in made and (old is None or old.slots == df.table.slots):
                    rows[name] = sum(p.rows for p in df.table.parts)
                    actions = {INSERT: rows[name], UPDATE: 0, UNCHANGED: 0, "delete": 0}
                    columns = old.columns if old else df.table.columns
                    made[name] = _Change(columns, df.table.slots, added=list(df.table.parts), actions=actions)
                    continue
                df = df.rows  # dealt out for another number of slots
            fresh = _Change(old.columns if old else df.schema.json(), old.slots if old else self._slots(name))
            add(name, made.get(name, fresh), df)
        self._together(writes.values())
        version = self._commit(then, now, made, stream, batch)
        parts = {name: len(c.added) for name, c in made.items()}
        return Published(version, rows, parts, {name: c.actions for name, c in made.items()})

    @staticmethod
    def _together(writes: Iterable[list[Callable[[], None]]]) -> None:
        """Write several tables at once: their jobs share the cluster instead of waiting in line."""
        def run(steps: list[Callable[[], None]]) -> None:
            for step in steps:
                step()

        with ThreadPoolExecutor(4) as pool:
            for done in [pool.submit(inheritable_thread_target(run), steps) for steps in writes]:
                done.result()

    def compact(self, name: str, most: int = MOST_PARTS) -> Published:
        """Merge the parts of each slot that has more than ``most`` of them (of the whole table, if it
        has no slots). The rows stay the same."""
        then = self._layout()
        table = then.tables[name]
        by: dict[int | None, list[Part]] = {}
        for part in table.parts:
            by.setdefault(part.slot, []).append(part)
        many = tuple(p for parts in by.values() if len(parts) > most for p in parts)
        if not many:
            return Published(then.version, {name: 0})
        parts, _ = self._write(name, self._open(name, changed(table, parts=many)), then.version + 1, table.slots)
        change = _Change(table.columns, table.slots, False, {p.path for p in many}, parts)
        version = self._commit(then, self._layout(), {name: change}, None, None)
        return Published(version, {name: sum(p.rows for p in parts)}, {name: len(parts)})

    def _slots(self, name: str) -> int:
        return self.buckets if name in self.keys else 0

    def _touched(self, keys: DataFrame, slots: int) -> set[int]:
        """The slots some keys fall into: never more numbers than there are slots."""
        (key,) = keys.columns
        found = keys.where(F.col(key).isNotNull()).select(slot_of(key, slots).alias(SLOT)).distinct()
        return {r[0] for r in found.collect()}

    def _stats(self, df: DataFrame, name: str) -> dict[str, str]:
        """The columns with statistics: the first key column, if it is a number, and dates."""
        kinds = {f.name: f.dataType for f in df.schema.fields}
        first = self.keys.get(name, [None])[0]
        numbers = [first] if isinstance(kinds.get(first), T.IntegralType) else []
        return {c: f"_{i}" for i, c in enumerate(numbers + [c for c, t in kinds.items() if isinstance(t, T.DateType)])}

    def _write(self, name: str, df: DataFrame, version: int, slots: int) -> tuple[list[Part], dict[str, int]]:
        """The parts written, and the number of rows per action where rows are tagged. What is counted
        while writing is counted in the writing task, so a recomputed shuffle counts nothing twice."""
        path = f"{name}/v={version}-{uuid.uuid4().hex[:8]}"
        place = f"{self.root}/{path}"
        columns = self._stats(df, name)
        measures = _measures(columns)
        kinds = (INSERT, UPDATE, UNCHANGED, SKIPPED) if ACTION in df.columns else ()
        actions = [F.count_if(F.col(ACTION) == k).alias(k) for k in kinds]
        seen = Observation()

        def counted() -> dict[str, int]:
            return {k: seen.get[k] for k in kinds}

        if not slots:
            df.observe(seen, *measures, *actions).drop(ACTION).write.parquet(place, compression="zstd")
            return [_part(seen.get, columns, path, None, False)], counted()
        key = self.keys[name][0]
        clustered = self.bucket_keys.get(name) == key
        # A row without key is in slot 0.
        dealt = df.withColumn(SLOT, F.coalesce(slot_of(key, slots), F.lit(0)))
        # One task per slot. Rows that come out of a join on the key are laid out like this
        # already, and Spark then leaves the shuffle out. Where a key may own many rows, a slot with much
        # of the rows is split among tasks.
        laid = dealt.repartition(slots, key) if clustered else dealt.hint("rebalance", SLOT)
        laid = laid.observe(seen, *actions).drop(ACTION) if kinds else laid
        writer = laid.write.format("parquet").partitionBy(SLOT).options(path=place, compression="zstd")
        if clustered:
            declared = f"snapshot_write_{uuid.uuid4().hex}"
            writer.bucketBy(slots, key).sortBy(key).saveAsTable(declared)
            self.spark.sql(f"DROP TABLE {declared}")
        else:
            writer.save()
        fields = [f for f in df.schema.fields if f.name != ACTION]
        schema = T.StructType([*fields, T.StructField(SLOT, T.IntegerType())])
        found = self.spark.read.schema(schema).parquet(place).groupBy(SLOT).agg(*measures)
        parts = [_part(r, columns, f"{path}/{SLOT}={r[SLOT]}", r[SLOT], clustered) for r in found.collect()]
        return parts, counted()

    def write_ahead(self, name: str, df: DataFrame, columns: Sequence[str], keep: Column) -> Written:
        """Write rows for a keyed table that is not clustered before it is known what else is published with
        them, so that the rest of a publish reads them from there and they are written once. They are no part
        of the table until ``publish`` appends them. Rows of which ``keep`` is not true, and columns other than
        those named, are written beside them. With few slots the rows are not shuffled: each task writes
        a file per slot."""
        now = self._layout()
        old = now.tables.get(name)
        slots = old.slots if old else self._slots(name)
        path = f"{name}/v={now.version + 1}-{uuid.uuid4().hex[:8]}"
        place = f"{self.root}/{path}"
        slot = F.coalesce(slot_of(self.keys[name][0], slots), F.lit(0)) if slots else F.lit(0)
        dealt = df.withColumn(SLOT, F.when(keep, slot).otherwise(F.lit(REST)))
        if slots <= OPEN_SLOTS:
            with _open_files(df.sparkSession, OPEN_SLOTS + 1):
                dealt.write.partitionBy(SLOT).option("parquet.block.size", ROW_GROUP // max(slots, 1)).parquet(
                    place, compression="zstd"
                )
        else:
            dealt.hint("rebalance", SLOT).write.partitionBy(SLOT).parquet(place, compression="zstd")
        schema = df.select(*columns).schema
        stats = self._stats(df.select(*columns), name)
        read = self.spark.read.schema(T.StructType([*schema, T.StructField(SLOT, T.IntegerType())])).parquet(place)
        found = {r[SLOT]: r for r in read.groupBy(SLOT).agg(*_measures(stats)).collect()}
        parts = tuple(
            _part(r, stats, f"{path}/{SLOT}={at}", at if slots else None, False) for at, r in found.items() if at != REST
        )
        table = Table(schema.json(), slots, parts)
        rest = self.spark.createDataFrame([], df.schema)
        if REST in found:
            rest = self.spark.read.schema(df.schema).parquet(f"{place}/{SLOT}={REST}")
        return Written(table, self._open(name, table), self._located(name, table), rest)

    def _commit(self, then: Layout, now: Layout, made: dict[str, _Change], stream, batch) -> int:
        """Record the changes on top of the newest version, which may not be the one they came from."""
        while True:
            for name, change in made.items():
                self._check(name, change, then, now)
            after = _applied(now, {n: asdict(c) for n, c in made.items()}, stream, batch)
            record = {"version": after.version, "stream": stream, "batch": batch, "tables": {
                name: asdict(c) | {"removed": sorted(c.removed)} for name, c in made.items()}}
            if after.version % FULL_EVERY == 0:
                record["full"] = {"streams": after.streams, "tables": {n: asdict(t) for n, t in after.tables.items()}}
            if self._create(f"manifests/v={after.version}.json", json.dumps(record)):
                return after.version
            now = self._layout()

    def _check(self, name: str, change: _Change, then: Layout, now: Layout) -> None:
        """Raise if the changes of the table do not go together with what was published since ``then``."""
        before = then.tables.get(name, Table(change.columns, change.slots))
        current = now.tables.get(name, Table(change.columns, change.slots))
        if before == current:
            return
        lost = change.removed - {p.path for p in current.parts}
        if change.whole or lost:
            raise Conflict(f"version {now.version} of {self.root} changed {name} while it was replaced")
        keys = self.keys.get(name)
        if not keys or name in LOOSE:
            return
        first = keys[0]
        theirs, ours = [p for p in current.parts if p not in set(before.parts)], change.added

        def met(parts: list[Part], others: list[Part]) -> list[Part]:
            return [p for p in parts if any(
                p.slot == o.slot and o.rows and p.may_hold(first, *o.stats.get(first, (None, None))) for o in others
            )]

        ours, theirs = met(ours, theirs), met(theirs, ours)
        if not ours or not theirs:
            return
        table = Table(change.columns, change.slots)
        new = self._open(name, changed(table, parts=tuple(ours))).select(*keys)
        since = self._open(name, changed(table, parts=tuple(theirs))).select(*keys)
        if not new.join(since, keys, "left_semi").isEmpty():
            raise Conflict(f"version {now.version} of {self.root} added keys of {name} that are added here too")

    # --- manifest records -------------------------------------------------------------

    def _layout(self, version: int | None = None) -> Layout:
        """The parts of all tables at a version, by default the newest: from the last full record
        before it and the changes since."""
        versions = self._versions()
        last = max(versions, default=0) if version is None else version
        if last and last not in versions:
            raise ValueError(f"no version {last} in {self.root}")
        start = last - last % FULL_EVERY
        layout = Layout()
        for v in range(max(start, 1), last + 1):
            record = self._record(v)
            if v == start:
                full = record["full"]
                tables = {n: Table(t["columns"], t["slots"], _parts(t["parts"])) for n, t in full["tables"].items()}
                layout = Layout(v, tables, full["streams"])
            else:
                layout = _applied(layout, record["tables"], record["stream"], record["batch"])
        return layout

    def _record(self, version: int) -> dict:
        if version not in self._records:
            while len(self._records) > 4 * FULL_EVERY:
                self._records.pop(next(iter(self._records)))
            self._records[version] = json.loads(self._read(f"manifests/v={version}.json"))
        return self._records[version]

    def _versions(self) -> set[int]:
        names = (re.fullmatch(r"v=(\d+)\.json", n) for n in self._names("manifests"))
        return {int(m.group(1)) for m in names if m}

    def _path(self, name: str):
        return self.spark._jvm.org.apache.hadoop.fs.Path(f"{self.root}/{name}")

    def _files(self):
        return self._path("").getFileSystem(self.spark._jsc.hadoopConfiguration())

    def _names(self, folder: str) -> list[str]:
        files, path = self._files(), self._path(folder)
        return [s.getPath().getName() for s in files.listStatus(path)] if files.exists(path) else []

    def _read(self, name: str) -> str:
        stream = self._files().open(self._path(name))
        try:
            return self.spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
        finally:
            stream.close()

    def _create(self, name: str, text: str) -> bool:
        """Write a small file unless there is one of this name. It appears whole or not at all."""
        jvm, path, aside = self.spark._jvm, self._path(name), self._path(f"manifests/.{uuid.uuid4().hex}")
        out = self._files().create(aside, False)
        try:
            out.write(text.encode())
        finally:
            out.close()
        kind = getattr(jvm.org.apache.hadoop.fs, "Options$Rename")
        options = self.spark.sparkContext._gateway.new_array(kind, 1)
        options[0] = kind.NONE
        context = jvm.org.apache.hadoop.fs.FileContext.getFileContext(path.toUri(), self.spark._jsc.hadoopConfiguration())
        try:
            context.rename(context.makeQualified(aside), context.makeQualified(path), options)
        except Py4JJavaError as e:
            if "AlreadyExists" not in str(e.java_exception):
                raise
            self._files().delete(aside, False)
            return False
        return True


def _measures(columns: Mapping[str, str]) -> list[Column]:
    bounds = [[F.min(c).alias(f"{alias}low"), F.max(c).alias(f"{alias}high")] for c, alias in columns.items()]
    return [F.count(F.lit(1)).alias("_rows"), *sum(bounds, [])]


def _part(row: Mapping, columns: Mapping[str, str], at: str, slot: int | None, clustered: bool) -> Part:
    stats = {c: [_plain(row[f"{a}low"]), _plain(row[f"{a}high"])] for c, a in columns.items()}
    return Part(at, slot, row["_rows"], clustered, stats)


@contextmanager
def _open_files(spark: SparkSession, most: int) -> Iterator[None]:
    """Lets a task keep so many files open instead of sorting its rows by them first, which spills."""
    name = "spark.sql.maxConcurrentOutputFileWriters"
    before = spark.conf.get(name)
    spark.conf.set(name, str(most))
    try:
        yield
    finally:
        spark.conf.set(name, before)


def _parts(records: Iterable[dict]) -> tuple[Part, ...]:
    return tuple(Part(**p) for p in records)


def _applied(layout: Layout, tables: Mapping[str, dict], stream: str | None, batch: int | None) -> Layout:
    """The layout after a record's changes."""
    after = dict(layout.tables)
    for name, change in tables.items():
        old = after.get(name)
        gone, added = set(change["removed"]), _parts(change["added"])
        kept = tuple(p for p in (old.parts if old else ()) if p.path not in gone)
        # An empty part only stands for a table that has nothing else.
        some = tuple(p for p in (*kept, *added) if p.rows)
        columns = old.columns if old and not change["whole"] else change["columns"]
        after[name] = Table(columns, change["slots"], some or (*kept, *added)[:1])
    streams = layout.streams | ({stream: max(batch, layout.streams.get(stream, -1))} if stream is not None else {})
    return Layout(layout.version + 1, after, streams)
