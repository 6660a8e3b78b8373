"""Operator 13: embedding whitening by the leading eigenvectors of the distributed covariance."""

from __future__ import annotations

import pickle
from collections.abc import Iterator
from dataclasses import dataclass
from decimal import Decimal

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tabulint.llm.eigen import leading_pairs
from tabulint.llm.vectors import dimension, matrix, usable, whole

COMPONENTS = 8
SCALE, SHIFT = 1024, 100_000
# Tasks that add up what all others found; so many square matrices reach the driver.
MERGERS = 8
# Components with a smaller share of the variance are directions in which the vectors do not differ.
LEAST_SHARE = 1e-13


@dataclass(frozen=True)
class Moments:
    """Number of rows, mean, and the sums of products of what is left when the mean is taken away."""

    n: int
    mean: np.ndarray
    products: np.ndarray
    sums: list[int]  # exact sums of whole numbers; empty for other numbers

    @classmethod
    def of(cls, rows: np.ndarray, exact: bool) -> Moments:
        mean = rows.mean(axis=0)
        centred = rows - mean
        sums = [int(s) for s in _exact_sums(rows)] if exact else []
        return cls(len(rows), mean, centred.T @ centred, sums)

    def __add__(self, other: Moments) -> Moments:
        """The moments of both lots of rows, each centred on its own mean before."""
        n = self.n + other.n
        apart = other.mean - self.mean
        products = self.products + other.products + np.outer(apart, apart) * (self.n * other.n / n)
        return Moments(n, self.mean + apart * (other.n / n), products, [a + b for a, b in zip(self.sums, other.sums)])


def _exact_sums(rows: np.ndarray) -> np.ndarray:
    if np.abs(rows).max(initial=0.0) * len(rows) < 2**62:
        return rows.astype(np.int64).sum(axis=0)
    return rows.astype(np.int64).astype(object).sum(axis=0)


def moments(vectors: DataFrame, column: str, size: int, scale: int | None) -> Moments | None:
    """The moments of ``column`` over all rows, of floor(scale * entry) where there is a scale; None without rows.

    Each task sends one matrix, MERGERS tasks add them up, and the driver adds up what those have.
    """

    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = None
        for batch in batches:
            if batch.num_rows:
                rows = matrix(batch.column(0), size)
                part = Moments.of(rows if scale is None else whole(rows, scale), scale is not None)
                total = part if total is None else total + part
        yield from sent(total)

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = None
        for batch in batches:
            for state in batch.column(0):
                part = pickle.loads(state.as_buffer())
                total = part if total is None else total + part
        yield from sent(total)

    def sent(total: Moments | None) -> Iterator[pa.RecordBatch]:
        if total is not None:
            yield pa.RecordBatch.from_arrays([pa.array([pickle.dumps(total)], pa.binary())], ["state"])

    parts = vectors.select(column).mapInArrow(find, "state binary").repartition(MERGERS).mapInArrow(add, "state binary")
    total = None
    for row in parts.collect():
        part = pickle.loads(row.state)
        total = part if total is None else total + part
    return total


@dataclass(frozen=True)
class Whitening:
    """What the fit rows have in common: n, exact sums, and the components with their variances."""

    size: int
    scale: int
    shift: int
    n: int
    sums: list[int]
    components: np.ndarray  # one a column
    variances: np.ndarray
    trace: float

    @property
    def explained(self) -> list[float]:
        return [float(v / self.trace) for v in self.variances]


def fit(vectors: DataFrame, *, column: str = "embedding", components: int = COMPONENTS, scale: int = SCALE, shift: int = SHIFT) -> Whitening:
    """The leading components of floor(scale * entry) + shift over all finite vectors.

    Vectors that are NULL, hold a NULL or non-finite entry, or are not of the commonest length take no
    part. Covariances have divisor n and are centred before multiplying: the tasks' on their own means, and what the
    means differ by is added. Directions without variance are no components, so equal vectors, a
    single one, or none at all have no component.
    """
    size = dimension(vectors, column)
    found = moments(usable(vectors, column, size), column, size, scale) if size else None
    if found is None:
        return Whitening(size, scale, shift, 0, [shift * 0] * size, np.zeros((size, 0)), np.zeros(0), 0.0)
    covariance = found.products / found.n
    covariance = (covariance + covariance.T) / 2
    trace = float(np.trace(covariance))
    values, directions = leading_pairs(covariance, components)
    some = values > LEAST_SHARE * trace
    sums = [s + found.n * shift for s in found.sums]
    return Whitening(size, scale, shift, found.n, sums, directions[:, some], values[some], trace)


def transform(vectors: DataFrame, model: Whitening, *, column: str = "embedding") -> DataFrame:
    """The usable rows of ``vectors`` with deviation (decimal) and whitened (array<double>, one number a component).

    The deviation is the sum over dimensions of (n * x - sum)**2, exact. Repeated rows come out as
    often as they come in, a NULL key too. Columns that have the new names are replaced.
    """
    rows = usable(vectors.drop("deviation", "whitened"), column, model.size)
    sent = vectors.sparkSession.sparkContext.broadcast(model)

    def project(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m: Whitening = sent.value
        mean = np.array([(s - m.n * m.shift) / m.n if m.n else 0.0 for s in m.sums])
        turned = m.components / np.sqrt(m.variances)
        for batch in batches:
            entries = whole(matrix(batch.column(column), m.size), m.scale)
            numbers = (entries - mean) @ turned
            deviation = deviations(entries.astype(np.int64) + m.shift, m.n, m.sums)
            k = numbers.shape[1]
            lists = pa.ListArray.from_arrays(pa.array(np.arange(len(numbers) + 1) * k, pa.int32()), pa.array(numbers.ravel()))
            yield pa.RecordBatch.from_arrays([*batch.columns, deviation, lists], [*batch.schema.names, "deviation", "whitened"])

    schema = T.StructType([*rows.schema.fields]).add("deviation", T.DecimalType(38, 0)).add("whitened", T.ArrayType(T.DoubleType()))
    return rows.mapInArrow(project, schema)


def deviations(x: np.ndarray, n: int, sums: list[int]) -> pa.Array:
    """Sum over dimensions of (n * x - sum)**2, exact; in 64 bits where they hold it."""
    kind = pa.decimal128(38, 0)
    most = max(map(abs, sums), default=0) + n * int(np.abs(x).max(initial=0))
    if most < 2**62:
        apart = n * x - np.array(sums, np.int64)
        if int(np.abs(apart).max(initial=0)) ** 2 * max(1, len(sums)) < 2**63:
            return pa.array((apart * apart).sum(axis=1)).cast(kind)
    apart = n * x.astype(object) - np.array(sums, object)
    return pa.array([Decimal(int(v)) for v in (apart * apart).sum(axis=1)], kind)


def identity_error(whitened: DataFrame, model: Whitening) -> float:
    """The largest absolute entry of the whitened rows' covariance minus the identity; 0 without components."""
    k = len(model.variances)
    found = moments(whitened, "whitened", k, None) if k else None
    return float(np.abs(found.products / found.n - np.eye(k)).max()) if found else 0.0


def whitened_components(vectors: DataFrame, model: Whitening, *, key: str = "vec_id", column: str = "embedding") -> DataFrame:
    """(key, component, n, deviation, whitened, explained, identity_error): one row per usable row and component.

    The deviation is a long here; one that a long cannot hold is NULL.
    """
    rows = transform(vectors.select(key, column), model, column=column)
    error = identity_error(rows, model)
    explained = F.array(*map(F.lit, model.explained)) if model.explained else F.array().cast("array<double>")
    return (
        rows.select(key, F.expr("try_cast(deviation AS long)").alias("deviation"), F.posexplode("whitened").alias("at", "whitened"))
        .select(
            key,
            (F.col("at") + 1).alias("component"),
            F.lit(model.n).cast("long").alias("n"),
            "deviation",
            "whitened",
            F.get(explained, F.col("at")).alias("explained"),
            F.lit(error).alias("identity_error"),
        )
    )
