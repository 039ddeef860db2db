"""Toxicity scores: gradient-boosted trees over dense features, calibrated by isotonic regression.

The lexicon is learned, not given: words and word beginnings that labelled toxic texts hold far
more often than clean ones. Three disjoint folds of the training rows serve the lexicon, the
trees and the calibration, so that no step sees its own errors. Texts that are equal share a fold. Where labels are so
few that a fold would have next to nothing of a class, all steps learn from all of them.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.ml.classification import GBTClassificationModel, GBTClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.ml.regression import IsotonicRegression, IsotonicRegressionModel
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tramline.llm.common import handing_back, in_slices, landed, ship_package

# The models are fitted on at most this many labelled rows, those with the smallest hash of doc_id.
LABELLED_ROWS = 20_000
# Most entries of each lexicon, and how sure (in standard errors) an entry must be.
LEXICON_WORDS = 1000
LEXICON_STEMS = 500
LEAST_SURE = 3.0
STEMS = range(3, 9)
TREES = 25
DEPTH = 4
TOXIC_FROM = 0.7
# Of ten hash values of a text: up to which it serves the lexicon, and the trees; the rest calibrate.
LEXICON_FOLDS, TREE_FOLDS = 5, 8
# Folds are for themselves if each has so many rows of either class.
FOLD_ROWS = 50

# Addressing words of the languages at hand, and look-alikes of letters.
SECOND_PERSON = frozenset(
    "you your yours yourself u ur ye tu te toi ton ta tes vous votre vos du dich dir dein deine ihr euch euer "
    "tú ti tuyo usted ustedes vosotros su sus".split()
)
LOOK_ALIKES = str.maketrans("013457@$!|€", "oieastasiie")
NEAR = 5

_RUNS_KEPT = 200_000
_LETTERS = re.compile(r"[^\W\d_]+")
_MARKED_INSIDE = re.compile(r"[^\W\d_][\d@$!|*#€][^\W\d_]")
_STRETCHED = re.compile(r"([^\W\d_])\1{3,}")

FEATURES = [
    "word_density", "word_weight", "word_top", "word_kinds", "stem_density", "stem_weight", "stem_top",
    "near_you", "you_density", "capitals", "shouted", "punctuation", "loud", "obfuscated", "stretched", "length",
]


@dataclass(frozen=True)
class Lexicon:
    """Log odds of words and of word beginnings; at most LEXICON_WORDS and LEXICON_STEMS entries."""

    words: dict[str, float]
    stems: dict[str, float]


def _odds(counts: DataFrame, clean: int, toxic: int, most: int) -> dict[str, float]:
    odds = F.log((F.col("toxic") + 0.5) / (toxic + 1.0)) - F.log((F.col("clean") + 0.5) / (clean + 1.0))
    error = F.sqrt(1 / (F.col("toxic") + 0.5) + 1 / (F.col("clean") + 0.5))
    rows = (
        counts.select("entry", odds.alias("odds"), (odds / error).alias("sure"))
        .filter(F.col("sure") >= LEAST_SURE)
        .orderBy(F.desc("sure"), "entry")
        .limit(most)
        .collect()
    )
    return {row["entry"]: row["odds"] for row in rows}


def learn_lexicon(labelled: DataFrame) -> Lexicon:
    """From rows with `text` and `toxic`: entries by the number of documents of each label that hold them."""
    totals = labelled.agg(F.count(F.lit(1)).alias("n"), F.coalesce(F.sum("toxic"), F.lit(0)).alias("toxic")).first()
    clean, toxic = totals["n"] - totals["toxic"], totals["toxic"]
    # Numbered before the words are listed, so that a document counts once however many words begin alike.
    rows = landed(labelled.select("text", "toxic", F.monotonically_increasing_id().alias("row")), "lexicon")
    words = rows.select(
        "row", "toxic", F.explode(F.array_distinct(F.split(F.lower("text"), r"[^\p{L}]+"))).alias("word")
    ).filter(F.length("word") >= 2)

    def counted(entries: DataFrame) -> DataFrame:
        return entries.groupBy("entry").agg(
            F.sum("toxic").alias("toxic"), F.sum(1 - F.col("toxic")).alias("clean")
        ).filter(F.col("toxic") >= 3)

    beginnings = F.array(*[F.when(F.length("word") > n, F.substring("word", 1, n)) for n in STEMS])
    stems = words.select("row", "toxic", F.explode(F.array_compact(beginnings)).alias("entry")).distinct()
    return Lexicon(
        _odds(counted(words.withColumnRenamed("word", "entry")), clean, toxic, LEXICON_WORDS),
        _odds(counted(stems), clean, toxic, LEXICON_STEMS),
    )


class _Features:
    """Dense features of texts; what a run between blanks contributes is worked out once."""

    def __init__(self, lexicon: Lexicon):
        self.lexicon = lexicon
        self.known: dict[str, int] = {}
        self.table = np.zeros((_RUNS_KEPT, 9))

    def _run(self, run: str) -> list[float]:
        low = run.lower()
        words = _LETTERS.findall(low)
        marked = bool(_MARKED_INSIDE.search(low))
        if marked:
            words.append("".join(_LETTERS.findall(low.translate(LOOK_ALIKES))))
            words.append("".join(_LETTERS.findall(low)))
        word = max((self.lexicon.words.get(w, 0.0) for w in words), default=0.0)
        stem = max((self.lexicon.stems.get(w[:n], 0.0) for w in words for n in STEMS if len(w) > n), default=0.0)
        return [
            word, stem, any(w in SECOND_PERSON for w in words), sum(c.isupper() for c in run),
            len(run) > 2 and run.isupper(), sum(not c.isalnum() for c in run), run.count("!") + run.count("?"),
            marked, bool(_STRETCHED.search(low)),
        ]

    def of(self, text: str) -> list[float]:
        runs = text.split()
        if not runs:
            return [0.0] * len(FEATURES)
        known = self.known
        unknown = {run for run in runs if run not in known}
        if len(known) + len(unknown) > len(self.table):
            known.clear()
            unknown = set(runs)
            if len(unknown) > len(self.table):
                self.table = np.zeros((2 * len(unknown), 9))
        for run in unknown:
            known[run] = len(known)
            self.table[known[run]] = self._run(run)
        rows = self.table[[known[run] for run in runs]]
        total = len(runs)
        word, stem, you = rows[:, 0], rows[:, 1], rows[:, 2]
        hits, stems, yours = word > 0, stem > 0, np.flatnonzero(you)
        near = 0.0
        if len(yours):
            at = np.flatnonzero(hits | stems)
            after = np.searchsorted(yours, at)
            ahead = np.abs(yours[np.minimum(after, len(yours) - 1)] - at)
            behind = np.abs(yours[np.maximum(after - 1, 0)] - at)
            near = float(np.mean(np.minimum(ahead, behind) <= NEAR)) if len(at) else 0.0
        sums = rows[:, 3:].sum(axis=0)
        chars = max(1, len(text))
        return [
            hits.sum() / total, word.sum() / total, word.max(), len(set(word[hits].tolist())),
            stems.sum() / total, stem.sum() / total, stem.max(),
            near, len(yours) / total, sums[0] / chars, sums[1] / total, sums[2] / chars, sums[3] / chars,
            sums[4] / total, sums[5] / total, float(np.log1p(total)),
        ]


def with_features(rows: DataFrame, lexicon: Lexicon) -> DataFrame:
    """Adds `features`, an array of doubles, to rows with a `text`, which it drops. A null text counts as empty."""
    ship_package(rows.sparkSession)
    kept = [name for name in rows.columns if name != "text"]
    texts = rows.select(*kept, F.coalesce("text", F.lit("")).alias("text"))
    schema = texts.select(*kept, F.array(F.lit(0.0)).alias("features")).schema

    def worked_out(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        features = _Features(lexicon)
        for batch in in_slices(batches):
            values = [features.of(text) for text in batch.column("text").to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(name) for name in kept), pa.array(values, pa.list_(pa.float64()))], [*kept, "features"]
            )

    return texts.mapInArrow(handing_back(worked_out), schema)


def _vectors(rows: DataFrame) -> DataFrame:
    columns = [F.get("features", F.lit(n)).alias(name) for n, name in enumerate(FEATURES)]
    others = [name for name in rows.columns if name != "features"]
    return VectorAssembler(inputCols=FEATURES, outputCol="vector").transform(rows.select(*others, *columns))


@dataclass(frozen=True)
class ToxicityModel:
    """What was learned; `trees` is None exactly where the labelled rows hold one class only, or none at all."""

    lexicon: Lexicon
    trees: GBTClassificationModel | None
    calibration: IsotonicRegressionModel | None
    constant: float = 0.0

    def score(self, documents: DataFrame) -> DataFrame:
        """Adds `score`, 0 to 1, to rows with a `text`, which it drops. Only the text matters to it."""
        if self.trees is None:
            return documents.drop("text").withColumn("score", F.lit(self.constant))
        others = [name for name in documents.columns if name != "text"]
        return _calibrated(self.trees, self.calibration, _vectors(with_features(documents, self.lexicon))).select(
            *others, "score"
        )


def _calibrated(trees: GBTClassificationModel, calibration: IsotonicRegressionModel, rows: DataFrame) -> DataFrame:
    raw = _raw(trees, rows)
    # A thousandth of the raw score orders documents that calibration puts on one step.
    score = 0.999 * F.col("step") + 0.001 * F.col("raw")
    return calibration.transform(raw).withColumn("score", F.least(F.lit(1.0), F.greatest(F.lit(0.0), score)))


def _raw(trees: GBTClassificationModel, rows: DataFrame) -> DataFrame:
    return trees.transform(rows).withColumn("raw", vector_to_array("probability")[1])


def held_out(doc_id: Column) -> Column:
    """Rows that no label is learned from: crc32 of the id as text leaves 1 modulo 3."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 3 == 1, F.lit(False))


def fit(documents: DataFrame, labels: DataFrame, rows: int = LABELLED_ROWS) -> ToxicityModel:
    """Learns from labelled rows that are not held out, at most `rows` of them, those with the smallest hashes.

    A doc_id labelled more than once is toxic if any label says so; null ids and labels are left
    out. Documents that repeat an id each count, but rows that repeat id and text count once. Where one of the three folds
    has fewer than `FOLD_ROWS` rows of a class, all three steps learn from all rows. With one class only, every score is
    that class; without labels, 0.
    """
    known = (
        labels.filter(F.col("doc_id").isNotNull() & F.col("toxic").isNotNull() & ~held_out(F.col("doc_id")))
        .groupBy("doc_id")
        .agg(F.max(F.col("toxic").cast("int")).alias("toxic"))
        .orderBy(F.xxhash64("doc_id"), "doc_id")
        .limit(rows)
    )
    texts = documents.select("doc_id", F.coalesce("text", F.lit("")).alias("text")).withColumn("hash", F.xxhash64("doc_id", "text"))
    # The limit holds for rows, and they are chosen before any text is moved.
    chosen = texts.join(F.broadcast(known), "doc_id").select("doc_id", "hash", "toxic").distinct().orderBy("hash", "doc_id").limit(rows)
    fold = F.pmod(F.xxhash64("text"), F.lit(10))
    labelled = landed(
        texts.join(F.broadcast(landed(chosen, "chosen")), ["doc_id", "hash"]).dropDuplicates(["doc_id", "hash"])
        .select("doc_id", "text", "toxic", fold.alias("fold")),
        "labelled",
    )
    part = F.when(F.col("fold") < LEXICON_FOLDS, 0).when(F.col("fold") < TREE_FOLDS, 1).otherwise(2)
    per_fold = {(r["part"], r["toxic"]): r["count"] for r in labelled.groupBy(part.alias("part"), "toxic").count().collect()}
    classes = {toxic for _, toxic in per_fold}
    if len(classes) < 2:
        return ToxicityModel(Lexicon({}, {}), None, None, float(max(classes, default=0)))
    shared = len(per_fold) < 6 or min(per_fold.values()) < FOLD_ROWS
    of_fold = lambda rows, only: rows if shared else rows.filter(only)
    lexicon = learn_lexicon(of_fold(labelled, F.col("fold") < LEXICON_FOLDS).select("text", "toxic"))
    rest = of_fold(labelled, F.col("fold") >= LEXICON_FOLDS).select("doc_id", "fold", F.col("toxic").cast("double").alias("toxic"), "text")
    dense = landed(with_features(rest, lexicon), "features")
    examples = _vectors(dense)
    # In a fixed order, so that reruns grow the same trees.
    growing = of_fold(examples, F.col("fold") < TREE_FOLDS).orderBy("doc_id", *FEATURES).coalesce(4)
    trees = GBTClassifier(
        featuresCol="vector", labelCol="toxic", maxIter=TREES, maxDepth=DEPTH, stepSize=0.2, minInstancesPerNode=5, seed=7
    ).fit(growing)
    calibration = IsotonicRegression(featuresCol="raw", labelCol="toxic", predictionCol="step").fit(
        _raw(trees, of_fold(examples, F.col("fold") >= TREE_FOLDS))
    )
    return ToxicityModel(lexicon, trees, calibration)
