"""Operator 7: naive Bayes support vectors over byte n-gram indicators."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tabulint.llm.words import mixed, not_letters, prefix_hash, slices, span_hash, word_bounds

ORDERS = (1, 2, 3, 4)
BITS = 18
FIT_ROWS = 4000
SMOOTHING = 1.0
PENALTY = 1.0
PASSES = 30


def held_out(key: str = "doc_id") -> Column:
    """Rows that no model learns from: crc32 of the key as text leaves 1 on division by 3."""
    return F.coalesce(F.crc32(F.col(key).cast("string").cast("binary")) % 3 == 1, F.lit(False))


class Indicators:
    """The distinct hashed n-grams of each text: byte n-grams of ORDERS, and doubled words.

    A digit counts as any digit. An n-gram lies within its text; 2**BITS numbers stand for the n-grams.
    A doubled word, a word bigram of equal words, counts as one n-gram whatever the word, with further
    indicators for two of them, four, eight and so on.
    """

    def __init__(self) -> None:
        self.seen = np.full(1 << BITS, -1, np.int64)
        self.fold = np.arange(256, dtype=np.uint64)
        self.fold[ord("0") : ord("9") + 1] = ord("0")
        self.parts = not_letters()
        self.doubled = (mixed(np.arange(64, dtype=np.uint64) + np.uint64(1 << 60)) >> np.uint64(64 - BITS)).astype(np.int32)

    def of(self, data: np.ndarray, offsets: np.ndarray) -> Iterator[np.ndarray]:
        """For each row its distinct feature numbers."""
        folded = self.fold[data]
        numbers = []
        gram = np.zeros(len(data), np.uint64)
        for n in range(1, max(ORDERS) + 1):
            size = max(len(data) - n + 1, 0)
            gram = gram[:size] * np.uint64(256) + folded[n - 1 :] if n > 1 else folded
            if n in ORDERS:
                numbers.append((n, (mixed(gram + np.uint64(n << 40)) >> np.uint64(64 - BITS)).astype(np.int32)))
        for first, last, doubled in zip(offsets[:-1], offsets[1:], self.doubled_words(data, offsets)):
            grams = [x[first : max(last - n + 1, first)] for n, x in numbers]
            yield self.distinct(np.concatenate([*grams, self.doubled[: int(doubled).bit_length()]]))

    def doubled_words(self, data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
        """How many words of each row equal the word before."""
        start, end, row = word_bounds(data, offsets, self.parts)
        word = span_hash(prefix_hash(data), start, end)
        same = (word[1:] == word[:-1]) & (row[1:] == row[:-1])
        return np.bincount(row[1:][same], minlength=len(offsets) - 1)

    def distinct(self, found: np.ndarray) -> np.ndarray:
        """Each number once: the place that wrote last into its cell."""
        places = np.arange(len(found))
        self.seen[found] = places
        return found[self.seen[found] == places]


@dataclass(frozen=True)
class Model:
    """Weights of the hashed n-grams, ratio times hinge-loss weight, and the curve from margin to score."""

    weights: np.ndarray
    ratios: np.ndarray
    bias: float
    slope: float
    shift: float

    def margin(self, found: np.ndarray) -> float:
        norm = float(np.sqrt(np.square(self.ratios[found]).sum()))
        return self.bias + (float(self.weights[found].sum()) / norm if norm else 0.0)

    def score(self, margins: np.ndarray) -> np.ndarray:
        return 1.0 / (1.0 + np.exp(-np.clip(self.slope * margins + self.shift, -500, 500)))


def log_count_ratios(rows: list[np.ndarray], labels: np.ndarray) -> np.ndarray:
    """ln of an n-gram's smoothed share among label 1 over its share among label 0, by documents."""
    counts = []
    for label in (1, 0):
        count = np.full(1 << BITS, SMOOTHING)
        for row in (r for r, y in zip(rows, labels) if y == label):
            count[row] += 1
        counts.append(np.log(count / count.sum()))
    return counts[0] - counts[1]


def dual_coordinate_descent(
    rows: list[np.ndarray], values: list[np.ndarray], signs: np.ndarray, penalties: np.ndarray, width: int
) -> np.ndarray:
    """Weights of the linear hinge-loss model; the last one is the bias.

    Each step solves one row's dual variable exactly between 0 and its penalty, in a new order each pass.
    """
    weights, duals = np.zeros(width + 1), np.zeros(len(rows))
    norms = np.array([float(v @ v) + 1.0 for v in values])
    order = np.random.default_rng(7)
    for _ in range(PASSES):
        largest = 0.0
        for i in order.permutation(len(rows)):
            row, value = rows[i], values[i]
            gradient = signs[i] * (float(weights[row] @ value) + weights[-1]) - 1.0
            dual = min(max(duals[i] - gradient / norms[i], 0.0), penalties[i])
            step = dual - duals[i]
            if step:
                duals[i] = dual
                weights[row] += (step * signs[i]) * value
                weights[-1] += step * signs[i]
                largest = max(largest, abs(step))
        if largest < 1e-3:
            break
    return weights


def margin_curve(margins: np.ndarray, labels: np.ndarray) -> tuple[float, float]:
    """Slope and shift of the logistic curve that fits labels to margins, by Newton's method."""
    slope, shift = 1.0, 0.0
    n1, n0 = labels.sum(), (1 - labels).sum()
    target = np.where(labels == 1, (n1 + 1) / (n1 + 2), 1 / (n0 + 2))
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(slope * margins + shift, -30, 30)))
        curve = p * (1 - p)
        gradient = np.array([((target - p) * margins).sum() - 1e-3 * slope, (target - p).sum()])
        a, b, c = (curve * margins**2).sum() + 1e-3, (curve * margins).sum(), curve.sum() + 1e-9
        step = np.array([c * gradient[0] - b * gradient[1], a * gradient[1] - b * gradient[0]]) / (a * c - b * b)
        slope, shift = slope + float(np.clip(step[0], -5, 5)), shift + float(np.clip(step[1], -5, 5))
        if np.abs(step).max() < 1e-6:
            break
    return slope, shift


def fit(rows: list[np.ndarray], labels: np.ndarray) -> Model:
    """The model of labelled rows. With one class only, or none, it scores by that class alone.

    A fifth of the rows is kept from the weights and sets the curve from margin to score; the final
    weights come from all rows.
    """
    width = 1 << BITS
    if len(set(labels.tolist())) < 2:
        shift = 0.0 if len(labels) == 0 else float(np.where(labels[0] == 1, 1.0, -1.0))
        return Model(np.zeros(width), np.zeros(width), 0.0, 1.0, shift)
    curve_rows = np.arange(len(rows)) % 5 == 4

    def weigh(chosen: np.ndarray) -> tuple[np.ndarray, np.ndarray, float]:
        picked = [rows[i] for i in np.flatnonzero(chosen)]
        y = labels[chosen]
        ratios = log_count_ratios(picked, y)
        values = [ratios[r] / (np.sqrt(np.square(ratios[r]).sum()) or 1.0) for r in picked]
        share = np.array([(y == 0).mean(), (y == 1).mean()])
        penalties = PENALTY * 0.5 / np.maximum(share, 1e-9)[y]
        w = dual_coordinate_descent(picked, values, np.where(y == 1, 1.0, -1.0), penalties, width)
        return w[:-1] * ratios, ratios, float(w[-1])

    trial = Model(*weigh(~curve_rows), 1.0, 0.0)
    chosen = curve_rows if len(set(labels[curve_rows].tolist())) == 2 else np.ones(len(rows), bool)
    margins = np.array([trial.margin(rows[i]) for i in np.flatnonzero(chosen)])
    slope, shift = margin_curve(margins, labels[chosen])
    return Model(*weigh(np.ones(len(rows), bool)), slope, shift)


def sampled(labelled: DataFrame, rows: int, key: str = "doc_id") -> DataFrame:
    """At most ``rows`` labelled rows, chosen by a hash of the key: the same ones in every run."""
    return labelled.orderBy(F.xxhash64(key), *labelled.columns).limit(rows)


def train(docs: DataFrame, labels: DataFrame, *, key: str = "doc_id", label: str = "quality", rows: int = FIT_ROWS) -> Model:
    """The model of a bounded sample of labelled rows that are not held out.

    ``rows`` bounds the sample, and with it what reaches the driver: at most 2**BITS numbers a row and
    some thousands for a usual text. Rows without a label are left out; a label of 1 or more counts as 1.
    """
    known = labels.filter(F.col(label).isNotNull() & F.col(key).isNotNull() & ~held_out(key))
    chosen = sampled(known.select(F.col(key).alias("__key"), (F.col(label) >= 1).cast("int").alias("__label")).distinct(), rows, "__key")
    texts = docs.select(F.col(key).alias("__id"), "text").join(F.broadcast(chosen), F.col("__id") == F.col("__key"))

    def features(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        indicators = Indicators()
        for batch in batches:
            for first, data, offsets in slices(batch.column("text")):
                found = [np.sort(x).tobytes() for x in indicators.of(data, offsets)]
                part = batch.slice(first, len(found))
                yield pa.RecordBatch.from_arrays([part.column("__key"), part.column("__label"), pa.array(found, pa.binary())], ["k", "y", "x"])

    schema = f"k {chosen.schema['__key'].dataType.simpleString()}, y int, x binary"
    found = sorted(texts.select("text", "__key", "__label").mapInArrow(features, schema).collect())
    return fit([np.frombuffer(r.x, np.int32) for r in found], np.array([r.y for r in found], int))


def score(docs: DataFrame, model: Model, name: str = "score") -> DataFrame:
    """``docs`` with the score of each whole text, 0 to 1; a NULL or empty text has the score of no n-grams.

    A column that has the new name is replaced.
    """
    docs = docs.drop(name)
    sent = docs.sparkSession.sparkContext.broadcast(model)

    def scores(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        indicators, used = Indicators(), sent.value
        for batch in batches:
            margins = [used.margin(x) for _, d, o in slices(batch.column("text")) for x in indicators.of(d, o)]
            column = pa.array(used.score(np.array(margins, float)), pa.float64())
            yield pa.RecordBatch.from_arrays([*batch.columns, column], [*batch.schema.names, name])

    schema = T.StructType([*docs.schema.fields, T.StructField(name, T.DoubleType())])
    return docs.mapInArrow(scores, schema)
