"""Toxicity: gradient-boosted trees over dense features of whole texts, calibrated by isotonic regression.

The lexicon is learnt from labels: words and word beginnings (4 to 8 bytes) that toxic documents
hold more often than others. Features are densities and peaks of lexicon weights, in the text as
it stands and with obfuscation undone, how near hits are to second-person words, and rates of capitals,
punctuation and obfuscation. Texts are handled array-wise as bytes, whole.

Fitting takes at most ``SAMPLE`` labelled rows, chosen by a hash of the key: one part teaches
the lexicon, one the trees, one the calibration. Everything else is per document.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.ml.classification import GBTClassificationModel, GBTClassifier
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.regression import IsotonicRegression, IsotonicRegressionModel
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from catalog_sync.llm.words import LOWER, mix, prefix_sums, span_hashes, spans
from catalog_sync.scratch import stage

SAMPLE = 20_000
TERMS = 3_000
LEAST_TOXIC_DOCS = 4
LEAST_WEIGHT = 1.5
STARTS = (4, 5, 6, 7, 8)
NEAR = 5

# Second-person words of the languages at hand.
SECOND_PERSON = (
    "you your yours yourself u ur du dich dir dein deine deinen ihr euch euer "
    "tu te toi ton ta tes vous votre vos tú ti tus usted ustedes vosotros"
).split()
# Characters that stand for letters.
LOOKALIKE = {"0": "o", "1": "i", "3": "e", "4": "a", "5": "s", "7": "t", "@": "a", "$": "s", "!": "i"}

BYTES = np.arange(256)
UPPER = (BYTES >= 65) & (BYTES <= 90)
LETTER = UPPER | ((BYTES >= 97) & (BYTES <= 122)) | (BYTES >= 128)
NO_LETTER = ~LETTER
SPACE = np.isin(BYTES, [9, 10, 11, 12, 13, 32])
DIGIT = (BYTES >= 48) & (BYTES <= 57)
PUNCTUATION = ~(LETTER | SPACE | DIGIT) & (BYTES > 32)
UNDONE = LOWER.copy()
for _sign, _letter in LOOKALIKE.items():
    UNDONE[ord(_sign)] = ord(_letter)

FEATURES = [
    "weight_density", "hit_rate", "hits", "peak", "second_peak", "third_peak", "undone_peak",
    "undone_gain", "undone_hit_rate", "near_second_person", "second_person_rate", "capital_rate", "capital_words",
    "punctuation_rate", "exclamation_rate", "digit_rate", "obfuscated_rate", "stretched_rate",
    "log_words", "word_length",
]


def _terms(sums: np.ndarray, start: np.ndarray, end: np.ndarray) -> list[tuple[np.ndarray, np.ndarray]]:
    """(which words, their term) for the whole word and each beginning that is shorter than it."""
    out = [(np.arange(len(start)), span_hashes(sums, start, end))]
    for n in STARTS:
        at = np.flatnonzero(end - start > n)
        out.append((at, mix(span_hashes(sums, start[at], start[at] + n) + np.uint64(n))))
    return out


def document_terms(text: bytes) -> np.ndarray:
    raw = LOWER[np.frombuffer(text, dtype=np.uint8)]
    start, end = spans(raw, NO_LETTER)
    return np.unique(np.concatenate([t for _, t in _terms(prefix_sums(raw), start, end)]))


@dataclass
class Lexicon:
    """Sorted term hashes and their weights."""

    terms: np.ndarray
    weights: np.ndarray

    def of(self, sums: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        """The weight of each word: that of its heaviest term, 0 without any."""
        out = np.zeros(len(start))
        if not len(self.terms):
            return out
        for at, terms in _terms(sums, start, end):
            spot = np.minimum(np.searchsorted(self.terms, terms), len(self.terms) - 1)
            found = np.where(self.terms[spot] == terms, self.weights[spot], 0.0)
            out[at] = np.maximum(out[at], found)
        return out


_SECOND = np.sort(np.array(
    [span_hashes(prefix_sums(raw), np.array([0]), np.array([len(raw)]))[0]
     for raw in (np.frombuffer(w.encode(), dtype=np.uint8) for w in SECOND_PERSON)], dtype=np.uint64
))


def features(text: bytes, lexicon: Lexicon) -> list[float]:
    """The values of ``FEATURES``; all 0 for an empty text."""
    raw = np.frombuffer(text, dtype=np.uint8)
    low = LOWER[raw]
    start, end = spans(raw, NO_LETTER)
    n, size = len(start), max(1, len(raw))
    sums = prefix_sums(low)
    weights = lexicon.of(sums, start, end)
    top = np.zeros(3)
    best = np.sort(weights)[::-1][:3]
    top[: len(best)] = best
    hit = np.flatnonzero(weights > 0)
    whole = span_hashes(sums, start, end)
    second = np.flatnonzero(np.isin(whole, _SECOND))
    near = 0
    if len(hit) and len(second):
        at = np.searchsorted(second, hit)
        after = np.abs(second[np.minimum(at, len(second) - 1)] - hit)
        before = np.abs(hit - second[np.maximum(at - 1, 0)])
        near = int((np.minimum(after, before) <= NEAR).sum())

    plain = UNDONE[raw]
    plain = plain[LETTER[plain] | SPACE[plain]]
    s2, e2 = spans(plain, SPACE)
    undone = lexicon.of(prefix_sums(plain), s2, e2)
    peak = float(undone.max(initial=0.0))

    capital = np.concatenate([[0], np.cumsum(UPPER[raw])])
    loud = int(((capital[end] - capital[start] == end - start) & (end - start > 1)).sum()) if n else 0
    inner = 0
    if len(raw) > 2:
        inner = int((LETTER[raw[:-2]] & LETTER[raw[2:]] & ~LETTER[raw[1:-1]] & ~SPACE[raw[1:-1]]).sum())
    stretched = int(((low[2:] == low[1:-1]) & (low[1:-1] == low[:-2]) & LETTER[low[2:]]).sum()) if len(raw) > 2 else 0
    words = max(1, n)
    return [
        float(weights.sum()) / words, len(hit) / words, float(len(hit)), *top.tolist(), peak,
        max(0.0, peak - top[0]), float((undone > 0).sum()) / max(1, len(s2)), float(near),
        len(second) / words, float(UPPER[raw].sum()) / size, loud / words,
        float(PUNCTUATION[raw].sum()) / size, float((raw == 33).sum()) / size, float(DIGIT[raw].sum()) / size,
        inner / words, stretched / words, float(np.log1p(n)), float((end - start).sum()) / words,
    ]


def held_out(key: str) -> Column:
    """Keys whose labels are never learnt from: crc32 of the key as text leaves 2 modulo 4."""
    return F.coalesce(F.crc32(F.col(key).cast("string").cast("binary")) % 4 == 2, F.lit(False))


def _with_features(docs: DataFrame, text: str, lexicon: Lexicon, keep: list[str]) -> DataFrame:
    """The columns ``keep`` and ``__features`` (vector)."""

    def extract(batches):
        for batch in batches:
            values = [
                features(v or b"", lexicon) for v in batch.column(len(keep)).cast(pa.binary()).to_pylist()
            ]
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[: len(keep)], pa.array(values, pa.list_(pa.float64()))],
                names=[*keep, "__features"],
            )

    schema = docs.select(*keep).withColumn("__features", F.array(F.lit(0.0))).schema
    out = docs.select(*keep, F.col(text).alias("__text")).mapInArrow(extract, schema)
    return out.withColumn("__features", array_to_vector("__features"))


def learn_lexicon(labelled: DataFrame) -> Lexicon:
    """From rows (text, label): the ``TERMS`` heaviest terms by log-odds, each in
    ``LEAST_TOXIC_DOCS`` toxic documents at least."""

    def count(batches):
        for batch in batches:
            for label in (0, 1):
                own = batch.filter(pa.array([x == label for x in batch.column(1).to_pylist()]))
                found = [document_terms(v or b"") for v in own.column(0).cast(pa.binary()).to_pylist()]
                if found:
                    terms, n = np.unique(np.concatenate(found), return_counts=True)
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(terms.view(np.int64)), pa.array(n * label), pa.array(n * (1 - label))],
                        names=["term", "toxic", "clean"],
                    )

    totals = labelled.groupBy("label").count().collect()
    n = {r[0]: r[1] for r in totals}
    share = (F.col("toxic") + 0.5) / (n.get(1, 0) + 1.0)
    other = (F.col("clean") + 0.5) / (n.get(0, 0) + 1.0)
    best = (
        labelled.select("text", "label").mapInArrow(count, "term long, toxic long, clean long")
        .groupBy("term").agg(F.sum("toxic").alias("toxic"), F.sum("clean").alias("clean"))
        .where(F.col("toxic") >= LEAST_TOXIC_DOCS)
        .withColumn("weight", F.log(share / other)).where(F.col("weight") >= LEAST_WEIGHT)
        .orderBy((F.col("weight") * F.sqrt("toxic")).desc(), "term").limit(TERMS)
        .select("term", "weight").collect()
    )
    terms = np.array([r[0] for r in best], dtype=np.int64).view(np.uint64)
    order = np.argsort(terms)
    return Lexicon(terms[order], np.array([r[1] for r in best], dtype=float)[order])


@dataclass
class Model:
    lexicon: Lexicon
    trees: GBTClassificationModel | None
    calibration: IsotonicRegressionModel | None
    prior: float

    def score(self, docs: DataFrame, text: str, keep: list[str]) -> DataFrame:
        """``keep`` and ``score``, a probability."""
        if self.trees is None:
            return docs.select(*keep, F.lit(self.prior).alias("score"))
        raw = _margin(self.trees, _with_features(docs, text, self.lexicon, keep))
        scored = self.calibration.transform(raw).withColumnRenamed("__calibrated", "score")
        return scored.select(*keep, F.least(F.lit(1.0), F.greatest(F.lit(0.0), "score")).alias("score"))


def _margin(trees: GBTClassificationModel, df: DataFrame) -> DataFrame:
    return trees.transform(df).withColumn("__margin", vector_to_array("__raw")[1])


def fit(
    docs: DataFrame, labels: DataFrame, key: str = "doc_id", text: str = "text", label: str = "toxic",
    sample: int = SAMPLE,
) -> Model:
    """A model from the labelled documents that are not held out.

    Of labels that repeat a key the highest counts; NULL labels and labels without document teach
    nothing. Without both kinds of label the model gives the share of label 1 to all (0 without any).
    """
    known = (
        labels.select(F.col(key).alias("__key"), F.col(label).cast("int").alias("label"))
        .where(~held_out("__key") & F.col("__key").isNotNull() & F.col("label").isin(0, 1))
        .groupBy("__key").agg(F.max("label").alias("label"))
        .join(docs.select(F.col(key).alias("__key")), "__key", "left_semi")  # before the sample is taken
        .orderBy(F.xxhash64("__key"), "__key").limit(sample)
    )
    chosen = stage(
        docs.select(F.col(key).alias("__key"), F.col(text).alias("text"))
        .join(F.broadcast(known), "__key")  # ``sample`` rows at most
        .withColumn("part", F.pmod(F.xxhash64("__key", F.lit("part")), F.lit(10))),
        "labelled",
    )
    kinds = {r[0]: r[1] for r in chosen.groupBy("label").count().collect()}
    prior = kinds.get(1, 0) / max(1, sum(kinds.values()))
    if len(kinds) < 2:
        return Model(Lexicon(np.zeros(0, np.uint64), np.zeros(0)), None, None, prior)

    def part(condition: str) -> DataFrame:
        own = chosen.where(condition)
        return own if own.select("label").distinct().count() == 2 else chosen

    lexicon = learn_lexicon(part("part < 4"))
    rows = stage(
        _with_features(chosen, "text", lexicon, ["__key", "label", "part"])
        .withColumn("label", F.col("label").cast("double")).coalesce(1).sortWithinPartitions("__key"),
        "features",
    )
    one = rows.coalesce(1)

    def own(condition: str) -> DataFrame:
        found = one.where(condition)
        return found if found.select("label").distinct().count() == 2 else one

    trees = GBTClassifier(
        featuresCol="__features", labelCol="label", predictionCol="__class", maxIter=20, maxDepth=3,
        stepSize=0.3, minInstancesPerNode=5, seed=7,
    ).setRawPredictionCol("__raw").setProbabilityCol("__chance").fit(own("part BETWEEN 4 AND 7"))
    calibration = IsotonicRegression(
        featuresCol="__margin", labelCol="label", predictionCol="__calibrated"
    ).fit(_margin(trees, own("part > 7")))
    return Model(lexicon, trees, calibration, prior)


def score_toxicity(
    docs: DataFrame, labels: DataFrame, key: str = "doc_id", text: str = "text", label: str = "toxic",
    threshold: float = 0.3, sample: int = SAMPLE,
) -> DataFrame:
    """One row per row of ``docs``: key, held_out, score (0 to 1), predicted (1 from ``threshold`` on).

    A score depends on the text alone; NULL counts as empty and both get a score. Rows that repeat
    a key are scored each by its own text; a NULL key is not held out. An empty table gives an empty table.
    """
    model = fit(docs, labels, key, text, label, sample)
    return model.score(docs, text, [key]).select(
        key, held_out(key).alias("held_out"), "score",
        (F.col("score") >= threshold).cast("int").alias("predicted"),
    )


def without_toxic(
    docs: DataFrame, labels: DataFrame, key: str = "doc_id", text: str = "text", label: str = "toxic",
    threshold: float = 0.3, sample: int = SAMPLE,
) -> DataFrame:
    """``docs`` without the rows that score ``threshold`` or more, columns as they were."""
    model = fit(docs, labels, key, text, label, sample)
    names = [c for c in docs.columns if c != "score"]
    whole = docs.select(*names)
    return model.score(whole, text, names).where(F.col("score") < threshold).select(*names)
