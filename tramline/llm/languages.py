"""Language identification by a convolutional network over bytes, in numpy.

A text is cut into windows of a fixed number of bytes. Every byte becomes a short vector; filters of
several widths slide over them, each filter keeps its largest answer in the window, and a softmax over these
answers gives the languages' probabilities. The windows of a text are averaged, weighted by their bytes.

The network is trained on a bounded sample of labelled rows; everything else covers all rows and whole texts.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tramline.llm.common import in_slices, ship_package
from tramline.llm.toxicity import held_out

# Of the rows that labels are learned from: the most languages, the most rows of all and of one language, and
# the windows of each row that the network is trained on. Equal texts of a language are one row.
LANGUAGES = 200
TRAINED_ROWS = 12_000
ROWS_OF_LANGUAGE = 2_000
WINDOWS_OF_ROW = 3

WINDOW = 256
WIDTHS = (2, 3, 4)
FILTERS = 16
BYTE_SIZE = 8
# Windows overlap, so that every run of bytes that a filter can see lies whole in one of them.
STEP = WINDOW - max(WIDTHS) + 1
WINDOWS_AT_ONCE = 128

EPOCHS = 6
BATCH = 64
RATE = 0.004
SEED = 11
UNDETERMINED = "und"

# Hashes are cut down by their remainder of this.
_PARTS = 1 << 30
_LETTER = re.compile(r"[^\W\d_]")


def windows_of(text: bytes) -> np.ndarray:
    """All windows of a text, one a row; the last is filled up with zero bytes."""
    count = max(1, -(-(len(text) - WINDOW) // STEP) + 1)
    padded = np.zeros((count - 1) * STEP + WINDOW, np.uint8)
    padded[: len(text)] = np.frombuffer(text, np.uint8)
    return np.lib.stride_tricks.sliding_window_view(padded, WINDOW)[::STEP]


def _mask() -> np.ndarray:
    """Where a filter has weights: the first `width` bytes of the widest."""
    widest = max(WIDTHS)
    mask = np.zeros((widest * BYTE_SIZE, len(WIDTHS) * FILTERS), np.float32)
    for n, width in enumerate(WIDTHS):
        mask[: width * BYTE_SIZE, n * FILTERS : (n + 1) * FILTERS] = 1
    return mask


@dataclass
class ByteNetwork:
    """Byte vectors, filters and the softmax layer; the last positions of a window serve wide filters only as their ends."""

    byte_vectors: np.ndarray
    filters: np.ndarray
    offsets: np.ndarray
    softmax: np.ndarray
    bias: np.ndarray

    @classmethod
    def new(cls, classes: int, rng: np.random.Generator) -> ByteNetwork:
        widest, total = max(WIDTHS), len(WIDTHS) * FILTERS
        vectors = rng.normal(0, 0.5, (256, BYTE_SIZE)).astype(np.float32)
        vectors[0] = 0
        filters = rng.normal(0, 0.25, (widest * BYTE_SIZE, total)).astype(np.float32) * _mask()
        return cls(
            vectors, filters, np.zeros(total, np.float32),
            rng.normal(0, 0.1, (total, classes)).astype(np.float32), np.zeros(classes, np.float32),
        )

    def parameters(self) -> list[np.ndarray]:
        return [self.byte_vectors, self.filters, self.offsets, self.softmax, self.bias]

    def _seen(self, windows: np.ndarray) -> np.ndarray:
        """What the widest filter sees at each position: (windows, positions, bytes * BYTE_SIZE)."""
        vectors = self.byte_vectors[windows].reshape(len(windows), -1)
        seen = np.lib.stride_tricks.sliding_window_view(vectors, max(WIDTHS) * BYTE_SIZE, axis=1)
        return seen[:, ::BYTE_SIZE]

    def answers(self, windows: np.ndarray) -> np.ndarray:
        """Each filter's answer at each position."""
        seen = np.ascontiguousarray(self._seen(windows))
        flat = seen.reshape(-1, seen.shape[2]) @ self.filters
        return flat.reshape(len(windows), -1, self.filters.shape[1])

    def scores(self, windows: np.ndarray) -> np.ndarray:
        """Log probabilities of each window."""
        pooled = np.maximum(self.answers(windows).max(axis=1) + self.offsets, 0)
        return _log_softmax(pooled @ self.softmax + self.bias)

    def gradients(self, windows: np.ndarray, classes: np.ndarray) -> list[np.ndarray]:
        """Of the mean cross entropy, for each of `parameters()`."""
        answers = self.answers(windows)
        at = answers.argmax(axis=1)
        pooled = np.take_along_axis(answers, at[:, None], axis=1)[:, 0] + self.offsets
        active = pooled > 0
        pooled = np.where(active, pooled, 0)
        wrong = np.exp(_log_softmax(pooled @ self.softmax + self.bias))
        wrong[np.arange(len(classes)), classes] -= 1
        wrong /= len(classes)
        back = np.where(active, wrong @ self.softmax.T, 0)
        # Only the positions that were pooled carry a gradient.
        rows = np.arange(len(windows))[:, None]
        chosen = self._seen(windows)[rows, at]
        to_filters = np.einsum("bf,bfd->df", back, chosen) * _mask()
        to_seen = (back[:, :, None] * self.filters.T[None]).reshape(-1, max(WIDTHS), BYTE_SIZE)
        touched = windows[rows[:, :, None], at[:, :, None] + np.arange(max(WIDTHS))].reshape(-1, max(WIDTHS))
        to_bytes = np.zeros_like(self.byte_vectors)
        np.add.at(to_bytes, touched.ravel(), to_seen.reshape(-1, BYTE_SIZE))
        to_bytes[0] = 0
        return [to_bytes, to_filters.astype(np.float32), back.sum(axis=0), pooled.T @ wrong, wrong.sum(axis=0)]


def _log_softmax(values: np.ndarray) -> np.ndarray:
    values = values - values.max(axis=1, keepdims=True)
    return values - np.log(np.exp(values).sum(axis=1, keepdims=True))


def train(windows: np.ndarray, classes: np.ndarray, count: int, epochs: int = EPOCHS, seed: int = SEED) -> ByteNetwork:
    """Adam on shuffled batches. A part of each batch is cut short, since short texts fill their window up with zeros;
    languages with fewer windows are drawn as often as the others."""
    rng = np.random.default_rng(seed)
    network = ByteNetwork.new(count, rng)
    moments = [(np.zeros_like(p), np.zeros_like(p)) for p in network.parameters()]
    weight = 1 / np.bincount(classes, minlength=count)[classes]
    weight /= weight.sum()
    step = 0
    steps = epochs * -(-len(windows) // BATCH)
    for step in range(1, steps + 1):
        taken = rng.choice(len(windows), BATCH, p=weight)
        batch = windows[taken]
        short = rng.random(BATCH) < 0.4
        lengths = np.where(short, rng.integers(8, WINDOW, BATCH), WINDOW)
        batch = np.where(np.arange(WINDOW) < lengths[:, None], batch, 0)
        rate = RATE * (1 - 0.9 * step / steps)
        for parameter, gradient, (first, second) in zip(network.parameters(), network.gradients(batch, classes[taken]), moments):
            first += 0.1 * (gradient - first)
            second += 0.001 * (gradient * gradient - second)
            parameter -= rate * (first / (1 - 0.9**step)) / (np.sqrt(second / (1 - 0.999**step)) + 1e-8)
    return network


@dataclass(frozen=True)
class LanguageModel:
    """The learned languages in code point order and the network; without a network every text is undetermined."""

    languages: list[str]
    network: ByteNetwork | None

    def texts(self, texts: list[str | None]) -> tuple[list[str], list[float]]:
        """The language and its probability for whole texts; `und` and 0 for null and for texts without a letter."""
        names, scores = [UNDETERMINED] * len(texts), [0.0] * len(texts)
        for n, text in enumerate(texts):
            if self.network is not None and text and _LETTER.search(text):
                names[n], scores[n] = self._language(text.encode())
        return names, scores

    def _language(self, text: bytes) -> tuple[str, float]:
        # Text by text, so that a result does not depend on what else is in a batch.
        windows = windows_of(text)
        summed = np.zeros(len(self.languages))
        for at in range(0, len(windows), WINDOWS_AT_ONCE):
            scores = self.network.scores(windows[at : at + WINDOWS_AT_ONCE])
            weights = np.full(len(scores), float(WINDOW))
            if at + len(scores) == len(windows):
                weights[-1] = len(text) - (len(windows) - 1) * STEP
            summed += weights @ scores
        mean = summed / (len(text) + (len(windows) - 1) * (WINDOW - STEP))
        probabilities = np.exp(_log_softmax(mean[None])[0])
        best = int(probabilities.argmax())
        return self.languages[best], min(1.0, float(probabilities[best]))

    def predict(self, documents: DataFrame) -> DataFrame:
        """`doc_id, lang_pred, score` for every row; only the text matters."""
        ship_package(documents.sparkSession)
        shared = documents.sparkSession.sparkContext.broadcast(self)

        def named(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in in_slices(batches, 256):
                names, scores = shared.value.texts(batch.column("text").to_pylist())
                yield pa.RecordBatch.from_arrays(
                    [batch.column("doc_id"), pa.array(names, pa.string()), pa.array(scores, pa.float64())],
                    ["doc_id", "lang_pred", "score"],
                )

        rows = documents.select("doc_id", "text")
        schema = rows.select("doc_id", F.lit("").alias("lang_pred"), F.lit(0.0).alias("score")).schema
        return rows.mapInArrow(named, schema)


def fit(
    documents: DataFrame, rows: int = TRAINED_ROWS, rows_of_language: int = ROWS_OF_LANGUAGE, languages: int = LANGUAGES
) -> LanguageModel:
    """Learns from `text` and `lang` of rows that are not held out and have a doc_id, a lang and a letter in the text.

    The `languages` most frequent values of lang are learned, from at most `rows_of_language` texts each and `rows`
    in all, chosen by hash. With one value, or none, there is nothing to tell apart: one value is
    always given, and without any every text is undetermined.
    """
    spark = documents.sparkSession
    ship_package(spark)
    known = documents.select("lang", "text", F.xxhash64("text").alias("hash")).filter(
        F.col("doc_id").isNotNull() & F.col("lang").isNotNull() & F.col("text").rlike(r"\p{L}") & ~held_out(F.col("doc_id"))
    )
    # Chosen by hashes alone, so that texts are only read again; texts that are equal count once.
    hashes = known.groupBy("lang", "hash").agg(F.count(F.lit(1)).alias("rows"))
    sizes = hashes.groupBy("lang").agg(F.count(F.lit(1)).alias("texts"), F.sum("rows").alias("rows"))
    sizes = sizes.orderBy(F.desc("rows"), "lang").limit(languages).collect()
    names = sorted(r["lang"] for r in sizes)
    if not names:
        return LanguageModel([], None)
    each = max(1, min(rows_of_language, rows // len(names)))
    # Of a language's texts about twice as many as needed are put in order.
    limits = spark.createDataFrame(
        [(r["lang"], min(_PARTS, -(-2 * each * _PARTS // r["texts"]) + 1)) for r in sizes], "lang string, limit long"
    )
    by_hash = Window.partitionBy("lang").orderBy("hash")
    chosen = (
        hashes.join(F.broadcast(limits), "lang")
        .filter(F.pmod("hash", F.lit(_PARTS)) < F.col("limit"))
        .withColumn("rank", F.row_number().over(by_hash))
        .filter(F.col("rank") <= each)
        .select("lang", "hash")
    )
    numbers = {name: n for n, name in enumerate(names)}

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """A few windows of each text, spread over it."""
        for batch in in_slices(batches):
            rows = []
            for lang, key, text in zip(*(batch.column(name).to_pylist() for name in ("lang", "hash", "text"))):
                of_text = windows_of(text.encode())
                for n in np.unique(np.linspace(0, len(of_text) - 1, WINDOWS_OF_ROW).astype(int)).tolist():
                    rows.append((key, n, numbers[lang], of_text[n].tobytes()))
            columns = list(zip(*rows)) or [(), (), (), ()]
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, kind) for c, kind in zip(columns, (pa.int64(), pa.int32(), pa.int32(), pa.binary()))],
                ["hash", "number", "class", "bytes"],
            )

    windows = known.join(F.broadcast(chosen), ["lang", "hash"]).select("lang", "hash", "text").mapInArrow(
        cut, "hash long, number int, class int, bytes binary"
    )
    sample = (
        windows.groupBy("class", "hash", "number").agg(F.min("bytes").alias("bytes")).toArrow()
        .sort_by([("class", "ascending"), ("hash", "ascending"), ("number", "ascending")])
    )
    windows = np.frombuffer(b"".join(sample.column("bytes").to_pylist()), np.uint8).reshape(-1, WINDOW)
    return LanguageModel(names, train(windows, sample.column("class").to_numpy(), len(names)))
