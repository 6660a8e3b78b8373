"""Operator 9: averaged hashed subword embeddings with a linear softmax, and calibrated rejection."""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tabulint.llm.names import free_name
from tabulint.llm.quality import held_out, sampled
from tabulint.llm.words import mixed, slices

ORDERS = (1, 2, 3, 4)
BITS = 16
WIDTH = 16
FIT_ROWS = 3000
PASSES = 4
RATE = 0.5
SNIPPETS = (24, 96)
# Different subwords that a piece of text hands to the fit, the most frequent ones if it has more.
PIECE_SUBWORDS = 1 << 13
# Bytes of a text that are counted at a time.
COUNT_BYTES = 1 << 20
TRUSTED = 0.99
UNKNOWN = "und"


def subword_table() -> np.ndarray:
    """Bytes as subwords see them: lower case, and a space for anything ASCII that is not a letter."""
    table = np.arange(256, dtype=np.uint64)
    table[:128] = ord(" ")
    letters = np.arange(ord("a"), ord("z") + 1)
    table[letters] = letters
    table[letters - 32] = letters
    return table


def subwords(data: np.ndarray, table: np.ndarray) -> list[tuple[int, np.ndarray]]:
    """(order, hashed numbers) of the n-grams at each byte; a space marks where words begin and end."""
    folded, gram, out = table[data], np.zeros(len(data), np.uint64), []
    for n in range(1, max(ORDERS) + 1):
        gram = gram[: max(len(data) - n + 1, 0)] * np.uint64(256) + folded[n - 1 :]
        if n in ORDERS:
            out.append((n, (mixed(gram + np.uint64(n << 40)) >> np.uint64(64 - BITS)).astype(np.int32)))
    return out


# The subwords of a piece of text, and how often each occurs.
Counts = tuple[np.ndarray, np.ndarray]


def counted(data: np.ndarray, table: np.ndarray, most: int = PIECE_SUBWORDS) -> Counts:
    """The subwords of a piece with their counts: the ``most`` frequent ones, ties by number, if it has more."""
    times = np.zeros(1 << BITS, np.int64)
    for low in range(0, len(data), COUNT_BYTES):
        for _, numbers in subwords(data[low : low + COUNT_BYTES + max(ORDERS) - 1], table):
            times += np.bincount(numbers[:COUNT_BYTES], minlength=1 << BITS)
    found = np.flatnonzero(times)
    if len(found) > most:
        found = np.sort(found[np.argsort(-times[found], kind="stable")[:most]])
    return found.astype(np.uint16), times[found].astype(np.uint32)


def pieces(text: bytes, most: int = PIECE_SUBWORDS) -> list[Counts]:
    """The counts of the whole text, then of one snippet of each size for each pass, cut where the text's checksum says."""
    random, table = np.random.default_rng(zlib.crc32(text)), subword_table()
    data = np.frombuffer(text, np.uint8)
    starts = [(int(random.integers(0, max(1, len(data) - size + 1))), size) for _ in range(PASSES) for size in SNIPPETS]
    return [counted(data, table, most), *(counted(data[start : start + size], table, most) for start, size in starts)]


@dataclass(frozen=True)
class Model:
    """Languages, the softmax input that each subword adds, and when a score is trusted."""

    names: tuple[str, ...]
    logits: np.ndarray
    bias: np.ndarray
    sharpness: float
    reject_below: float

    def predict(self, data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(best language, its probability) for each row; a row without bytes gets the bias alone."""
        total = np.zeros((len(offsets) - 1, len(self.names)))
        count = np.zeros(len(offsets) - 1)
        for n, numbers in subwords(data, subword_table()):
            sums = np.zeros((len(numbers) + 1, len(self.names)))
            np.cumsum(self.logits[numbers], axis=0, dtype=float, out=sums[1:])
            first = np.minimum(offsets[:-1], len(numbers))
            last = np.clip(offsets[1:] - n + 1, first, len(numbers))
            total += sums[last] - sums[first]
            count += last - first
        return self.best(total / np.maximum(count, 1)[:, None])

    def best(self, means: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(best language, its probability) for each row of softmax inputs."""
        z = self.sharpness * (means + self.bias)
        p = np.exp(z - z.max(axis=1, keepdims=True))
        p /= p.sum(axis=1, keepdims=True)
        return p.argmax(axis=1), p.max(axis=1)


def gradient_descent(texts: list[list[Counts]], labels: np.ndarray, classes: int) -> tuple[np.ndarray, np.ndarray]:
    """(softmax input of each subword, bias), trained text by text with a falling rate.

    A text is met whole and as short snippets, so that the average over few subwords is learnt too.
    """
    random = np.random.default_rng(11)
    vectors = random.uniform(-1 / WIDTH, 1 / WIDTH, (1 << BITS, WIDTH))
    output, bias = np.zeros((WIDTH, classes)), np.zeros(classes)
    steps = max(1, PASSES * len(texts) * (1 + len(SNIPPETS)))
    step = 0
    for turn in range(PASSES):
        snippets = slice(1 + turn * len(SNIPPETS), 1 + (turn + 1) * len(SNIPPETS))
        for i in random.permutation(len(texts)):
            for found, times in (texts[i][0], *texts[i][snippets]):
                rate = RATE * (1 - step / steps)
                step += 1
                if not len(found):
                    continue
                share = times / times.sum()
                hidden = share @ vectors[found]
                z = hidden @ output + bias
                p = np.exp(z - z.max())
                p /= p.sum()
                p[labels[i]] -= 1
                vectors[found] -= rate * np.outer(share * (len(found) ** 0.5), output @ p)
                output -= rate * np.outer(hidden, p)
                bias -= 0.01 * rate * p
    return vectors @ output, bias


def calibrated(model: Model, texts: list[list[Counts]], labels: np.ndarray) -> Model:
    """The model with the sharpness that makes probabilities honest on held-back texts and their snippets,
    and the lowest score from which at least TRUSTED of the predictions were right."""
    known = [(piece, y) for t, y in zip(texts, labels) for piece in t[: 1 + len(SNIPPETS)] if len(piece[0])]
    if not known:
        return model
    means = np.array([(times / times.sum()) @ model.logits[found].astype(float) for (found, times), _ in known])
    truth = np.array([y for _, y in known])
    best, trial = np.inf, model
    for sharpness in 2.0 ** np.arange(-4, 5, 0.5):
        now = Model(model.names, model.logits, model.bias, float(sharpness), 0.0)
        found, p = now.best(means)
        right = np.where(found == truth, p, (1 - p) / max(1, len(model.names) - 1))
        loss = -np.log(np.maximum(right, 1e-9)).mean()
        if loss < best:
            best, trial, kept = loss, now, (p, found == truth)
    order = np.argsort(-kept[0], kind="stable")
    good = np.cumsum(kept[1][order]) / np.arange(1, len(order) + 1)
    trusted = np.flatnonzero(good >= TRUSTED)
    limit = float(kept[0][order][trusted[-1]]) if len(trusted) else 1.0
    return Model(trial.names, trial.logits, trial.bias, trial.sharpness, limit)


def fit(texts: list[list[Counts]], langs: list[str]) -> Model:
    """The model of labelled texts, each as its ``pieces``; a tenth is held back for calibration.

    Without texts it only knows UNKNOWN.
    """
    names = tuple(sorted(set(langs))) or (UNKNOWN,)
    number = {name: i for i, name in enumerate(names)}
    labels = np.array([number[x] for x in langs], int)
    back = np.arange(len(texts)) % 10 == 9
    logits, bias = gradient_descent([t for t, b in zip(texts, back) if not b], labels[~back], len(names))
    model = Model(names, logits.astype(np.float32), bias, 1.0, 0.0)
    return calibrated(model, [t for t, b in zip(texts, back) if b], labels[back])


def train(docs: DataFrame, *, key: str = "doc_id", lang: str = "lang", rows: int = FIT_ROWS, most: int = PIECE_SUBWORDS) -> Model:
    """The model of a bounded sample of rows with a language and a text that are not held out.

    ``rows`` bounds the sample: keys and languages are chosen by a hash of the key. Their texts stay with the
    workers, which count subwords; the driver gets numbers and counts of the whole text, of its ``most``
    frequent subwords where it has more, and of its snippets: at most 6 bytes a subword, some 70 KB a row.
    """
    known = docs.filter(F.col(lang).isNotNull() & F.col("text").isNotNull() & ~held_out(key))
    chosen = sampled(known.select(F.col(key).alias("__key")).distinct(), rows, "__key")
    texts = known.select(F.col(key).alias("k"), F.col(lang).cast("string").alias("y"), "text")

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                found = pieces(batch.column("text")[i].as_py().encode(), most)
                numbers, times = ([[c[part].tobytes() for c in found]] for part in (0, 1))
                row = batch.slice(i, 1)
                kind = pa.list_(pa.binary())
                yield pa.RecordBatch.from_arrays([row.column("k"), row.column("y"), pa.array(numbers, kind), pa.array(times, kind)], ["k", "y", "numbers", "times"])

    schema = f"k {chosen.schema['__key'].dataType.simpleString()}, y string, numbers array<binary>, times array<binary>"
    wanted = texts.join(F.broadcast(chosen), F.col("k") == F.col("__key")).select("k", "y", "text")
    found = sorted(wanted.mapInArrow(count, schema).collect())
    return fit([[(np.frombuffer(n, np.uint16), np.frombuffer(t, np.uint32)) for n, t in zip(r.numbers, r.times)] for r in found], [r.y for r in found])


def identify(docs: DataFrame, model: Model) -> DataFrame:
    """``docs`` with lang_pred, score (0 to 1) and rejected.

    A text that is NULL or has no letter is UNKNOWN with score 0. Any other text gets a learned language;
    ``rejected`` tells that its score is below what the calibration trusts. Columns that have the new names are replaced.
    """
    docs = docs.drop("lang_pred", "score", "rejected")
    lang, p_name = free_name(docs, "__lang"), free_name(docs, "__p")
    sent = docs.sparkSession.sparkContext.broadcast(model)

    def predictions(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        used = sent.value
        for batch in batches:
            found = [used.predict(data, offsets) for _, data, offsets in slices(batch.column("text"))]
            names = [used.names[i] for best, _ in found for i in best]
            p = np.concatenate([p for _, p in found]) if found else np.zeros(0)
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(names, pa.string()), pa.array(p, pa.float64())], [*batch.schema.names, lang, p_name])

    schema = T.StructType([*docs.schema.fields, T.StructField(lang, T.StringType()), T.StructField(p_name, T.DoubleType())])
    letters = F.coalesce(F.col("text").rlike(r"\p{L}"), F.lit(False))
    return docs.mapInArrow(predictions, schema).select(
        *docs.columns,
        F.when(letters, F.col(lang)).otherwise(UNKNOWN).alias("lang_pred"),
        F.when(letters, F.col(p_name)).otherwise(0.0).alias("score"),
        (~letters | (F.col(p_name) < model.reject_below)).alias("rejected"),
    )
