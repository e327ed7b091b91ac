"""A title index beside the catalog: posting lists of the three-letter pieces of titles.

A title that contains a query also contains every run of three letters of it, so the ids that are listed
under all of them are the only ones to look at; their titles are then compared as without an index.

The index may lag behind the catalog and may list too much, never too little: it knows the version it was
made from, parts written since are searched by their titles, and what a title no longer contains falls
out when titles are compared. So any job may publish without caring for it, and ``extend`` adds what is new
whenever it runs. Posting lists are dealt into slots by piece: a search reads the slots of its own
pieces, takes the rarest of them and reads the catalog's slots of the ids found.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from catalog_sync.operators.incremental import is_id, title_search
from catalog_sync.operators.joins import fits_broadcast, keep_known
from catalog_sync.schemas import TITLE_GRAMS
from catalog_sync.scratch import stage
from catalog_sync.sources.snapshots import Published, Snapshot, SnapshotStore

STREAM = "title-index"
LETTERS = 3
RAREST = 3


def grams(text: Column) -> Column:
    """The distinct runs of three letters of a text, lower-cased; NULL for NULL and shorter ones."""
    low = F.lower(text)
    size, letters = F.length(low), F.split(low, "")
    runs = letters
    for i in range(2, LETTERS + 1):
        runs = F.zip_with(runs, F.slice(letters, F.lit(i), size), lambda a, b: F.concat(a, b))
    return F.when(size >= LETTERS, F.array_distinct(F.slice(runs, F.lit(1), size - (LETTERS - 1))))


def title_grams(df: DataFrame, id_: str = "id", title: str = "title") -> DataFrame:
    """gram, id: a row per piece of a title. A NULL id or title has none."""
    return df.where(F.col(id_).isNotNull()).select(F.explode(grams(F.col(title))).alias("gram"), F.col(id_).alias("id"))


def indexed_version(tables: Snapshot) -> int:
    """The version whose titles the index covers, 0 if there is none."""
    return max(0, tables.layout.streams.get(STREAM, 0))


def extend(
    store: SnapshotStore, afresh: bool = False, table: str = "movies", id_: str = "id", title: str = "title"
) -> Published | None:
    """List the titles written since the index was last extended; None if there are none. Reads the parts that came
    or went since. ``afresh`` lists all titles again, which drops what is listed in vain."""
    tables = store.tables()
    if afresh:
        every = title_grams(tables[table], id_, title)
        return store.publish(replace={TITLE_GRAMS: every}, stream=STREAM, batch=tables.version, base=tables.version)
    known = indexed_version(tables)
    _, written, gone = tables.split(table, known)
    new = written.select(id_, title)
    if known:
        if new.isEmpty():
            return None
        # A rewritten slot holds mostly titles that are listed already.
        new = new.join(gone.select(id_, title), [id_, title], "left_anti")
    return store.publish(
        append={TITLE_GRAMS: title_grams(new, id_, title)}, stream=STREAM, batch=tables.version, base=tables.version
    )


def _listed(tables: Snapshot, wanted: DataFrame, id_: str) -> DataFrame | None:
    """The ids listed under the rarest of the wanted pieces (column ``gram``), None if one is listed nowhere."""
    pieces = [r.gram for r in wanted.collect()]  # at most as many as the query has letters
    lists = tables.around(TITLE_GRAMS, wanted).where(F.col("gram").isin(pieces))
    sizes = {r.gram: r["count"] for r in lists.groupBy("gram").count().collect()}
    if len(sizes) < len(pieces):
        return None
    rarest = sorted(pieces, key=lambda g: (sizes[g], g))[:RAREST]
    met = lists.where(F.col("gram").isin(rarest)).distinct().groupBy("id").count()
    return stage(met.where(F.col("count") == len(rarest)).select(F.col("id").alias(id_)), "title-ids")


def find_titles(
    tables: Snapshot,
    query: str,
    page_size: int | None = None,
    page: int = 1,
    flags: Sequence[str] = (),
    table: str = "movies",
    id_: str = "id",
    title: str = "title",
    popularity: str = "popularity",
) -> DataFrame:
    """The rows of ``title_search`` over the table, found by the index.

    Ids, queries of fewer than three letters and stores without an index look at the table itself. Rows whose id is
    NULL are not found."""
    known = indexed_version(tables)
    columns = {"id_": id_, "title": title, "popularity": popularity}
    df = tables[table].where(F.col(id_).isNotNull())
    if is_id(query) or not known or TITLE_GRAMS not in tables:
        return title_search(df, query, page_size=page_size, flags=flags, page=page, **columns)
    wanted = df.sparkSession.range(1).select(F.explode(grams(F.lit(query))).alias("gram"))
    if wanted.isEmpty():
        return title_search(df, query, page_size=page_size, flags=flags, page=page, **columns)
    ids = _listed(tables, wanted, id_)
    if ids is None:
        candidates = tables.split(table, known)[1]
    else:
        few = fits_broadcast(ids)
        kept, written, _ = tables.split(table, known, ids if few else None)
        met = keep_known(kept, F.broadcast(ids) if few else ids, [id_], unique=True)
        candidates = met.unionByName(written)
    candidates = candidates.where(F.col(id_).isNotNull())
    return title_search(candidates, query, page_size=page_size, flags=flags, page=page, **columns)
