"""Ranked lexical search over hashed max-sketches, rescored exactly in descending order of bounds.

A term's impact in a document grows with its count there, so a document's sketch keeps the largest
count of all terms that hash to a coordinate: whatever the corpus counts turn out to be, the impact of
that count is the coordinatewise maximum of the impacts. Summed over a query's coordinates with the
query's weights it is never below the document's score.

1. One pass over whole texts writes the index: sketch, length and the query terms found. Lengths and
   found terms give the corpus counts, hence the weights.
2. A batch of queries is looked up in all sketches. The highest bounds of each query are rescored
   exactly, on the terms themselves in 64-bit integers; its k-th best score is then its threshold.
3. Every document whose bound may still pass its threshold is a candidate, and candidates are rescored
   in waves of descending bounds, each eight times the last, until no bound passes.

Queries are taken in batches of bounded number and bytes; documents stay where they are. What travels
is a few bounds per task, then candidates, and the texts of those.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from catalog_sync.llm import words
from catalog_sync.operators.dedup import top_n
from catalog_sync.operators.joins import sized
from catalog_sync.scratch import stage

WIDTH = 1 << 20
COUNTS = 12
MANY = (1 << COUNTS) - 1
MOST = 1_000_000
GROUP = 1 << 20
ROWS = 512
ITEMS = 4096
ITEM_BYTES = 8 << 20
SEEDS = 32
GROWTH = 8

SEPARATORS = np.zeros(256, dtype=bool)
SEPARATORS[:128] = [not chr(i).isalnum() for i in range(128)]
_FOLD = bytes(32 if SEPARATORS[i] else int(words.LOWER[i]) for i in range(256))

_INDEX = "doc_id long, mark long, n long, digest binary, sketch binary, found array<int>"
_PAIRS = "query int, doc_id long, mark long, digest binary, bound long"
_SCORES = "query int, doc_id long, mark long, score long"


def folded(text: bytes) -> bytes:
    """The terms of a text, A-Z lower-cased, with one space between them."""
    return b" ".join(text.translate(_FOLD).split())


@dataclass
class Lexicon:
    """The terms of a batch of queries by hash. ``order`` gives the number of the term at a place."""

    terms: list[bytes]

    def __post_init__(self):
        self.length = np.array([len(t) for t in self.terms], dtype=np.int64)
        self.start = np.concatenate([[0], np.cumsum(self.length)[:-1]]).astype(np.int64)
        self.pool = np.frombuffer(b"".join(self.terms), dtype=np.uint8)
        hashes = words.span_hashes(words.prefix_sums(self.pool), self.start, self.start + self.length)
        self.order = np.argsort(hashes, kind="stable")
        self.hashes = hashes[self.order]
        _, sizes = np.unique(hashes, return_counts=True)
        self.alike = int(sizes.max(initial=0))

    def hits(self, raw, start, end, hashes) -> tuple[np.ndarray, np.ndarray]:
        """(place among the spans, term) of the spans of ``raw`` that are terms, byte for byte."""
        at = np.searchsorted(self.hashes, hashes)
        spans, found = [], []
        for turn in range(self.alike):
            near = np.minimum(at + turn, len(self.hashes) - 1)
            some = np.flatnonzero((self.hashes[near] == hashes) & (at + turn < len(self.hashes)))
            term = self.order[near[some]]
            same = end[some] - start[some] == self.length[term]
            some, term = some[same], term[same]
            size = self.length[term]
            first = np.cumsum(size) - size
            inner = np.arange(size.sum()) - np.repeat(first, size)
            differ = raw[np.repeat(start[some], size) + inner] != self.pool[np.repeat(self.start[term], size) + inner]
            if differ.any():
                right = np.ones(len(some), dtype=bool)
                right[np.repeat(np.arange(len(some)), size)[differ]] = False
                some, term = some[right], term[right]
            spans.append(some)
            found.append(term)
        if not spans:
            return np.zeros(0, np.int64), np.zeros(0, np.int64)
        return np.concatenate(spans), np.concatenate(found)


def _pieces(texts: list[bytes]) -> Iterator[list[tuple[int, bytes]]]:
    """Groups of (text number, folded bytes) of about ``GROUP`` bytes, long texts cut between terms."""
    group, size = [], 0
    for i, text in enumerate(texts):
        at = 0
        while at < len(text):
            end = len(text)
            if end - at > GROUP:
                end = text.find(b" ", at + GROUP)
                end = len(text) if end < 0 else end
            group.append((i, text[at:end]))
            size += end - at
            at = end
            if size >= GROUP:
                yield group
                group, size = [], 0
    if group:
        yield group


def _summed(owner: np.ndarray, value: np.ndarray, count: np.ndarray | None = None):
    """Distinct (owner, value) in order, and how often each is there."""
    order = np.lexsort((value, owner))
    owner, value = owner[order], value[order]
    new = np.ones(len(owner), dtype=bool)
    new[1:] = (owner[1:] != owner[:-1]) | (value[1:] != value[:-1])
    first = np.flatnonzero(new)
    if count is None:
        total = np.diff(np.append(first, len(owner)))
    else:
        total = np.add.reduceat(count[order], first) if len(first) else count[:0]
    return owner[first], value[first], total


def counted(texts: list[bytes], lexicon: Lexicon, sketches: bool = True):
    """Over folded texts: terms of each, (text, term, count) of the lexicon's terms, and, if asked for,
    (text, hash, count) of all terms."""
    n = np.zeros(len(texts), dtype=np.int64)
    all_terms, hits = [], []
    for group in _pieces(texts):
        raw = np.frombuffer(b" ".join(piece for _, piece in group), dtype=np.uint8)
        starts = np.cumsum([0] + [len(piece) + 1 for _, piece in group])[:-1]
        start, end = words.spans(raw, SEPARATORS)
        hashes = words.span_hashes(words.prefix_sums(raw), start, end)
        owner = np.array([i for i, _ in group])[np.searchsorted(starts, start, side="right") - 1]
        n += np.bincount(owner, minlength=len(texts))
        some, term = lexicon.hits(raw, start, end, hashes)
        hits.append(_summed(owner[some], term))
        if sketches:
            all_terms.append(_summed(owner, hashes))

    def whole(parts):
        if not parts:
            return (np.zeros(0, np.int64),) * 3
        return _summed(*[np.concatenate(column) for column in zip(*parts, strict=True)])

    return n, whole(hits), whole(all_terms)


def sketch_rows(rows: int, owner: np.ndarray, hashes: np.ndarray, count: np.ndarray, width: int = WIDTH) -> list[bytes]:
    """Each text's sketch: coordinate and largest count there, packed into 32 bits, a count of 4,095
    standing for all above."""
    place = (hashes.astype(np.uint64) & np.uint64(width - 1)).astype(np.int64)
    order = np.lexsort((place, owner))
    owner, place, count = owner[order], place[order], count[order]
    new = np.ones(len(owner), dtype=bool)
    new[1:] = (owner[1:] != owner[:-1]) | (place[1:] != place[:-1])
    first = np.flatnonzero(new)
    most = np.maximum.reduceat(count, first) if len(first) else count
    packed = ((place[first] << COUNTS) | np.minimum(most, MANY)).astype("<u4")
    edges = np.searchsorted(owner[first], np.arange(rows + 1))
    return [packed[a:b].tobytes() for a, b in zip(edges[:-1], edges[1:], strict=True)]


def index(docs: DataFrame, key: str, text: str, lexicon: Lexicon, width: int = WIDTH) -> DataFrame:
    """One row per document: its terms, its sketch, the lexicon's terms in it, and a digest of its
    terms in order, by which copies are known."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for at in range(0, whole.num_rows, ROWS):
                batch = whole.slice(at, ROWS)
                texts = [folded(t or b"") for t in batch.column(2).to_pylist()]
                n, (owner, term, _), every = counted(texts, lexicon)
                edges = np.searchsorted(owner, np.arange(len(texts) + 1)).astype(np.int32)
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column(0), batch.column(1), pa.array(n),
                        pa.array([hashlib.blake2b(t, digest_size=16).digest() for t in texts], pa.binary()),
                        pa.array(sketch_rows(len(texts), *every, width), pa.binary()),
                        pa.ListArray.from_arrays(pa.array(edges), pa.array(term.astype(np.int32))),
                    ],
                    names=["doc_id", "mark", "n", "digest", "sketch", "found"],
                )

    return _marked(docs, key, text).mapInArrow(run, _INDEX)


def _marked(docs: DataFrame, key: str, text: str) -> DataFrame:
    return docs.select(
        F.col(key).cast("long").alias("doc_id"), F.xxhash64(text).alias("mark"),
        F.col(text).cast("binary").alias("text"),
    )


@dataclass(frozen=True)
class Scoring:
    """Corpus counts, the weight of each term, and the terms of each query."""

    docs: int
    length: int
    weight: np.ndarray
    queries: list[np.ndarray]

    def norms(self, n: np.ndarray) -> np.ndarray:
        """m of documents of n terms: 10 + (90 * n * N) div L, free of overflow."""
        return np.array([10 + 90 * int(x) * self.docs // max(1, self.length) for x in n], dtype=np.int64)

    @staticmethod
    def impact(count: np.ndarray, m: np.ndarray) -> np.ndarray:
        return 1_000_000_000 * count // (1000 * count + 8 * m)


def _weights(df: dict[int, int], docs: int, terms: int) -> np.ndarray:
    found = np.zeros(terms, dtype=np.int64)
    for term, count in df.items():
        found[term] = math.floor(1000 * math.log((2 * docs + 2) / (2 * count + 1)))
    return found


def _bounds(index_: DataFrame, lexicon: Lexicon, scoring: Scoring, limits, top: int | None, width: int):
    """(query, document, bound) of the documents whose bound may pass the query's limit.

    ``limits`` holds a score and a doc_id per query: a bound passes above the score, or equal to it with
    a smaller doc_id. With ``top`` each task gives its ``top`` highest bounds of a query only.
    """
    place = (words.span_hashes(
        words.prefix_sums(lexicon.pool), lexicon.start, lexicon.start + lexicon.length
    ) & np.uint64(width - 1)).astype(np.int64)
    used, slot = np.unique(place, return_inverse=True)
    lookups = [(slot[q], scoring.weight[q].astype(np.float64)) for q in scoring.queries]
    least = np.array([score for score, _ in limits], dtype=np.int64)
    before = np.array([doc for _, doc in limits], dtype=np.int64)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = np.full(width, -1, dtype=np.int32)
        table[used] = np.arange(len(used))
        kept: list[list] = [[] for _ in lookups]

        def cut(q: int) -> None:
            ids, marks, digests, found = (np.concatenate(c) for c in zip(*kept[q], strict=True))
            order = np.lexsort((ids, -found))[:top]
            kept[q] = [(ids[order], marks[order], digests[order], found[order])]

        def given(queries: list[int]) -> pa.RecordBatch:
            parts = [(q, *part) for q in queries for part in kept[q]]
            own = [np.full(len(part[0]), q, np.int32) for q, *part in parts]
            ids, marks, digests, found = (np.concatenate(c) for c in list(zip(*parts, strict=True))[1:])
            return pa.RecordBatch.from_arrays(
                [pa.array(np.concatenate(own)), pa.array(ids), pa.array(marks),
                 pa.array(digests.tolist(), pa.binary()), pa.array(found)],
                names=["query", "doc_id", "mark", "digest", "bound"],
            )

        for whole in batches:
            for at in range(0, whole.num_rows, ROWS):
                batch = whole.slice(at, ROWS)
                ids, marks, n = (np.asarray(batch.column(i)) for i in range(3))
                digests = np.array(batch.column(3).to_pylist(), dtype=object)
                sketches = batch.column(4).to_pylist()
                entries = np.frombuffer(b"".join(sketches), dtype="<u4")
                owner = np.repeat(np.arange(len(ids)), np.array([len(s) // 4 for s in sketches], dtype=np.int64))
                slots = table[entries >> COUNTS]
                asked = slots >= 0
                slots, owner = slots[asked], owner[asked]
                count = (entries[asked] & MANY).astype(np.int64)
                impact = np.where(count == MANY, MOST, scoring.impact(count, scoring.norms(n)[owner]))
                dense = np.zeros((len(used), len(ids)))
                dense[slots, owner] = impact
                passed = []
                for q, (own, weight) in enumerate(lookups):
                    # Integers below 2**53: the sum of doubles is exact.
                    bound = (weight @ dense[own]).astype(np.int64)
                    some = np.flatnonzero((bound > least[q]) | ((bound == least[q]) & (bound > 0) & (ids < before[q])))
                    if len(some):
                        kept[q].append((ids[some], marks[some], digests[some], bound[some]))
                        passed.append(q)
                        if top is not None and sum(len(k[0]) for k in kept[q]) > 8 * top + ROWS:
                            cut(q)
                if top is None and passed:
                    yield given(passed)
                    for q in passed:
                        kept[q] = []
        if top is not None:
            passed = [q for q in range(len(kept)) if kept[q]]
            for q in passed:
                cut(q)
            if passed:
                yield given(passed)

    columns = index_.where("doc_id IS NOT NULL AND n > 0").select("doc_id", "mark", "n", "digest", "sketch")
    return columns.mapInArrow(run, _PAIRS).distinct()


def _rescored(docs: DataFrame, key: str, text: str, pairs: DataFrame, lexicon: Lexicon, scoring: Scoring) -> DataFrame:
    """Exact scores above 0 of (query, document) pairs, on whole texts."""
    wanted = stage(
        pairs.groupBy("doc_id", "mark").agg(F.collect_list("query").alias("queries")), "wanted"
    )
    # Fixed width but for the list of queries, which a batch bounds.
    few = sized(wanted.select("doc_id", "mark"), 200_000)
    texts = _marked(docs, key, text).join(few, ["doc_id", "mark"], "left_semi")
    sets = [np.sort(q) for q in scoring.queries]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for at in range(0, whole.num_rows, ROWS):
                batch = whole.slice(at, ROWS)
                n, (owner, term, count), _ = counted(
                    [folded(t or b"") for t in batch.column(2).to_pylist()], lexicon, sketches=False
                )
                value = scoring.weight[term] * scoring.impact(count, scoring.norms(n)[owner])
                edges = np.searchsorted(owner, np.arange(len(n) + 1))
                out: list[tuple] = []
                for row, queries in enumerate(batch.column(3).to_pylist()):
                    own, worth = term[edges[row] : edges[row + 1]], value[edges[row] : edges[row + 1]]
                    for q in queries:
                        score = int(worth[np.isin(own, sets[q])].sum())
                        if score > 0:
                            out.append((q, row, score))
                rows = pa.array([r for _, r, _ in out], pa.int64())
                yield pa.RecordBatch.from_arrays(
                    [pa.array([q for q, _, _ in out], pa.int32()), batch.column(0).take(rows),
                     batch.column(1).take(rows), pa.array([s for _, _, s in out], pa.int64())],
                    names=["query", "doc_id", "mark", "score"],
                )

    asked = texts.join(wanted, ["doc_id", "mark"]).select("doc_id", "mark", "text", "queries")
    return asked.mapInArrow(run, _SCORES).distinct()


def _best(scores: DataFrame, k: int) -> DataFrame:
    order = Window.partitionBy("query").orderBy(F.desc("score"), "doc_id", "mark")
    return scores.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)


def _batches(items: DataFrame, key: str, text: str) -> Iterator[list[tuple[object, list[bytes]]]]:
    """(item, its distinct terms), as many at a time as the bounds allow."""
    batch, size = [], 0
    rows = items.select(F.col(key).alias("item"), F.col(text).cast("binary").alias("text")).distinct()
    for row in rows.toLocalIterator():
        terms = sorted(set(folded(bytes(row.text or b"")).split()))
        if not terms:
            continue
        batch.append((row.item, terms))
        size += sum(map(len, terms))
        if len(batch) >= ITEMS or size >= ITEM_BYTES:
            yield batch
            batch, size = [], 0
    if batch:
        yield batch


def search(
    docs: DataFrame,
    items: DataFrame,
    key: str = "doc_id",
    text: str = "text",
    item: str = "item_id",
    k: int = 10,
    width: int = WIDTH,
    seeds: int = SEEDS,
) -> DataFrame:
    """item, rank (from 1), doc_id and score of the ``k`` best documents with a score above 0 per item.

    Equal scores go by ascending doc_id. NULL and empty texts hold no terms; items without terms, or
    whose terms no document holds, have no rows. Documents without doc_id count in the corpus but are
    not ranked. Rows that repeat both doc_id and text count as often as they are there and are ranked
    once; rows of one doc_id with different texts are ranked each. Items that repeat id and text are
    answered once. Empty tables give an empty table.
    """
    spark = docs.sparkSession
    kind = items.schema[item].dataType
    parts = []
    for batch in _batches(items, item, text):
        terms = sorted({t for _, own in batch for t in own})
        number = {t: i for i, t in enumerate(terms)}
        lexicon = Lexicon(terms)
        built = stage(index(docs, key, text, lexicon, width), "sketches")
        total = built.agg(F.count_if(F.col("n") > 0).alias("docs"), F.sum("n").alias("length")).first()
        found = built.select(F.explode("found").alias("term")).groupBy("term").count()
        df = {r["term"]: r["count"] for r in found.collect()}  # no more rows than the batch has terms
        queries = [np.array([number[t] for t in own if number[t] in df], dtype=np.int64) for _, own in batch]
        scoring = Scoring(total.docs, total.length or 0, _weights(df, total.docs, len(terms)), queries)
        best = _searched(docs, key, text, built, lexicon, scoring, k, width, seeds)
        names = spark.createDataFrame([(n, own) for n, (own, _) in enumerate(batch)],
                                      f"query int, item {kind.simpleString()}")
        parts.append(best.join(names, "query").select(F.col("item").alias(item), "rank", "doc_id", "score"))
    if not parts:
        return spark.createDataFrame([], f"{item} {kind.simpleString()}, rank int, doc_id long, score long")
    out = parts[0]
    for part in parts[1:]:
        out = out.union(part)
    return out


def _searched(docs, key, text, built, lexicon, scoring, k, width, seeds) -> DataFrame:
    """query, rank, doc_id and score by waves of descending bounds."""
    open_ = [(0, -(1 << 63))] * len(scoring.queries)
    highest = [F.desc("bound"), F.col("doc_id"), F.col("mark")]

    def chosen(pairs: DataFrame, n: int) -> DataFrame:
        return top_n(pairs, ["query"], highest, n, row_id=["doc_id", "mark"])

    def limits(scores: DataFrame) -> list[tuple[int, int]]:
        out = list(open_)
        for r in _best(scores, k).where(F.col("rank") == k).collect():  # one row per query of the batch
            out[r["query"]] = (r["score"], r["doc_id"])
        return out

    first = stage(chosen(_bounds(built, lexicon, scoring, open_, seeds, width), seeds), "seeds")
    scores = stage(_rescored(docs, key, text, first, lexicon, scoring), "scores")
    passed = limits(scores)
    pairs = _bounds(built, lexicon, scoring, passed, None, width)
    # Copies score alike, so only those of the smallest ids can be among the best.
    copies = top_n(pairs, ["query", "digest"], [F.col("doc_id"), F.col("mark")], k, row_id=["doc_id", "mark"])
    rest = stage(copies.join(first, ["query", "doc_id", "mark"], "left_anti"), "candidates")
    wave = seeds
    while not rest.isEmpty():
        wave *= GROWTH
        now = stage(chosen(rest, wave), "wave")
        scores = stage(scores.union(_rescored(docs, key, text, now, lexicon, scoring)), "scores")
        passed = limits(scores)
        bars = docs.sparkSession.createDataFrame(
            [(q, *p) for q, p in enumerate(passed)], "query int, least long, before long"
        )
        may = (F.col("bound") > F.col("least")) | (
            (F.col("bound") == F.col("least")) & (F.col("doc_id") < F.col("before"))
        )
        left = rest.join(now, ["query", "doc_id", "mark"], "left_anti").join(F.broadcast(bars), "query")
        rest = stage(left.where(may).select(*rest.columns), "candidates")
    return _best(scores, k).select("query", "rank", "doc_id", "score")
