"""Operator 11: hard negatives by exact scores, several candidates to a Kronecker-packed product."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tabulint.llm.storage import stored
from tabulint.llm.vectors import dimension, matrix, usable, whole

SCALE = 256
POSITIVES, NEGATIVES = 5, 10
# A negative scores between these hundredths of the positive's score.
LOWER, UPPER = 30, 90

# Anchors that meet in one cell of the grid, candidates of a packed row, and candidates of a stripe, at least and at most.
BLOCK_ANCHORS, ROW_CANDIDATES = 16_384, 4096
STRIPE_LEAST, STRIPE_MOST = 8192, 1 << 20
# Anchors whose scores with one packed row are held at once.
GROUP_ANCHORS = 256
# Whole numbers up to 2**53 are exact in double precision, whose matrix products are the fastest.
DOUBLE_BITS = 53
WIDE_FIELDS = 8
LOWEST, LAST_ID = -np.iinfo(np.int64).max, np.iinfo(np.int64).max


@dataclass(frozen=True)
class Fields:
    """How candidates' components are packed: biased by the least component, one field of ``bits`` bits for each candidate.

    A field holds the largest sum of products of biased components, so that no field runs into the next.
    """

    low: int
    high: int
    size: int

    @property
    def bits(self) -> int:
        return max(1, (self.size * (self.high - self.low) ** 2).bit_length())

    @property
    def count(self) -> int:
        return DOUBLE_BITS // self.bits or WIDE_FIELDS

    @property
    def number(self) -> type:
        """Doubles where a packed product fits them, integers of any width otherwise."""
        return float if self.bits <= DOUBLE_BITS else object

    @property
    def stored_as(self) -> np.dtype:
        return next(np.dtype(t) for t in (np.int16, np.int32, np.int64) if np.iinfo(t).min <= self.low and self.high <= np.iinfo(t).max)

    def biased(self, rows: np.ndarray) -> np.ndarray:
        out = rows.astype(np.int64)
        return (out.astype(object) if self.number is object else out) - self.low

    def packed(self, rows: np.ndarray) -> np.ndarray:
        """One column for every ``count`` rows: their biased components, in separate fields of one number."""
        biased = self.biased(rows)
        lines = -(-len(rows) // self.count) * self.count
        padded = np.zeros((lines, self.size), biased.dtype)
        padded[: len(rows)] = biased
        parts = padded.reshape(-1, self.count, self.size)
        shifts = np.array([1 << (self.bits * j) for j in range(self.count)], biased.dtype)
        return (parts * shifts[None, :, None]).sum(axis=1).T.astype(self.number)

    def scores(self, anchors: np.ndarray, packed: np.ndarray, sums: np.ndarray) -> np.ndarray:
        """The exact inner products of anchors and packed candidates: one multiplication per component and packed number.

        ``sums`` has the candidates' sums of components, by which the bias of both sides is taken off again.
        """
        biased = self.biased(anchors)
        products = biased.astype(self.number) @ packed
        fields = products.astype(np.int64) if self.number is float else products
        mask = (1 << self.bits) - 1
        parts = np.stack([(fields >> (self.bits * j)) & mask for j in range(self.count)], axis=2)
        out = parts.reshape(len(anchors), -1)[:, : len(sums)]
        # (a - low)(c - low) summed is ac - low * (sum of a) - low * (sum of c) + size * low * low
        own = self.low * biased.sum(axis=1)[:, None]
        return (out + own + self.low * sums[None, :]).astype(np.int64)


class Best:
    """The ``k`` best (score, id) of each of some lines: higher scores first, then smaller ids."""

    def __init__(self, lines: int, k: int) -> None:
        self.k = k
        self.score = np.full((lines, k), LOWEST)
        self.id = np.full((lines, k), LAST_ID)

    def add(self, line: np.ndarray, score: np.ndarray, id_: np.ndarray) -> None:
        """Takes in further rows of some lines."""
        last = self.score[line, -1]
        better = (score > last) | ((score == last) & (id_ < self.id[line, -1]))
        line, score, id_ = line[better], score[better], id_[better]
        if not len(line):
            return
        some, at = np.unique(line, return_inverse=True)
        lines = np.r_[np.repeat(np.arange(len(some)), self.k), at]
        scores, ids = np.r_[self.score[some].ravel(), score], np.r_[self.id[some].ravel(), id_]
        order = np.lexsort((ids, -scores, lines))
        lines = lines[order]
        rank = np.arange(len(lines)) - np.searchsorted(lines, lines)
        kept = order[rank < self.k]
        self.score[some], self.id[some] = scores[kept].reshape(-1, self.k), ids[kept].reshape(-1, self.k)

    def found(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(line, score, id) of all that is there."""
        line, place = np.nonzero(self.id != LAST_ID)
        return line, self.score[line, place], self.id[line, place]


@dataclass
class Packed:
    """Rows of one packed row: ids, labels, whole components, and for anchors the slots that each is searched for.

    A slot is a range of scores; ``slot_of`` is its anchor.
    """

    ids: np.ndarray
    labels: np.ndarray
    entries: np.ndarray
    positive: np.ndarray
    positive_score: np.ndarray
    slot_of: np.ndarray

    @classmethod
    def of(cls, row: dict, fields: Fields) -> Packed:
        ids, labels, positive, score, slot_of = (np.frombuffer(row[c], np.int64) for c in ("ids", "labels", "positive", "positive_score", "slot_of"))
        return cls(ids, labels, np.frombuffer(row["entries"], fields.stored_as).reshape(len(ids), fields.size), positive, score, slot_of)


class Search:
    """Looks for the best candidates of a packed row of anchors, group by group."""

    def __init__(self, anchors: Packed, fields: Fields, k: int, bounds: tuple[int, int] | None) -> None:
        self.anchors, self.fields, self.bounds = anchors, fields, bounds
        self.groups = [slice(a, a + GROUP_ANCHORS) for a in range(0, len(anchors.ids), GROUP_ANCHORS)]
        self.cuts = np.searchsorted(anchors.slot_of, [g.start for g in self.groups] + [len(anchors.ids)])
        self.best = [Best(int(n), k) for n in np.diff(self.cuts)]

    def meet(self, candidates: Packed) -> None:
        packed, sums = self.fields.packed(candidates.entries), candidates.entries.sum(axis=1, dtype=np.int64)
        if self.fields.number is object:
            sums = sums.astype(object)
        for g, best, a, b in zip(self.groups, self.best, self.cuts[:-1], self.cuts[1:]):
            scores = self.fields.scores(self.anchors.entries[g], packed, sums)
            same = self.anchors.labels[g, None] == candidates.labels[None, :]
            if self.bounds is None:
                able = same & (self.anchors.ids[g, None] != candidates.ids[None, :])
            else:
                able = ~same
            scores = np.where(able, scores, LOWEST)
            for offset in range(0, b - a, GROUP_ANCHORS):
                lines = np.arange(offset, min(offset + GROUP_ANCHORS, b - a))
                self.take(best, scores[self.anchors.slot_of[a + lines] - g.start], lines, self.anchors.positive_score[a + lines], candidates.ids)

    def take(self, best: Best, scores: np.ndarray, lines: np.ndarray, positive_score: np.ndarray, ids: np.ndarray) -> None:
        """Offers the scores of some slots, one a line, that lie within bounds and above the worst that is kept."""
        if self.bounds is not None:
            low, high = within(positive_score, self.bounds)
            scores = np.where((scores >= low[:, None]) & (scores <= high[:, None]), scores, LOWEST)
        least = np.maximum(best.score[lines, -1], LOWEST + 1)
        if scores.shape[1] > best.k:
            kth = np.partition(scores, scores.shape[1] - best.k, axis=1)[:, scores.shape[1] - best.k]
            least = np.maximum(least, kth)
        line, at = np.nonzero(scores >= least[:, None])
        best.add(lines[line], scores[line, at], ids[at])

    def results(self) -> Iterator[pa.RecordBatch]:
        for a, best in zip(self.cuts[:-1], self.best):
            line, score, id_ = best.found()
            if len(line):
                slot = a + line
                columns = [self.anchors.ids[self.anchors.slot_of[slot]], self.anchors.positive[slot], self.anchors.positive_score[slot], id_, score]
                yield pa.RecordBatch.from_arrays([pa.array(c) for c in columns], ["anchor_id", "positive_id", "positive_score", "id", "score"])


def within(positive_score: np.ndarray, bounds: tuple[int, int]) -> tuple[np.ndarray, np.ndarray]:
    """The least and greatest whole score between the two hundredths of each positive score."""
    exact = positive_score.astype(object)
    return (-((-exact * bounds[0]) // 100)).astype(np.int64), ((exact * bounds[1]) // 100).astype(np.int64)


PACKED = "ids binary, labels binary, entries binary, positive binary, positive_score binary, slot_of binary"
FOUND = "anchor_id long, positive_id long, positive_score long, id long, score long"


def pack(rows: pa.Table, fields: Fields, scale: int) -> dict:
    """One packed row of the rows (id, label, vector[, positives]); without positives every row has one slot, for all scores."""
    n = len(rows)
    entries = whole(matrix(rows.column("vector").combine_chunks(), fields.size), scale).astype(fields.stored_as)
    if "positives" in rows.column_names:
        lists = rows.column("positives").combine_chunks()
        pairs = lists.flatten()
        slot_of = np.repeat(np.arange(n), np.diff(lists.offsets.to_numpy()))
        positive, score = (pairs.field(c).to_numpy(zero_copy_only=False).astype(np.int64) for c in ("id", "score"))
    else:
        slot_of, positive, score = np.arange(n), np.zeros(n, np.int64), np.zeros(n, np.int64)
    ids, labels = (rows.column(c).to_numpy().astype(np.int64) for c in ("id", "label"))
    blobs = dict(ids=ids, labels=labels, entries=entries, positive=positive, positive_score=score, slot_of=slot_of.astype(np.int64))
    return {name: [values.tobytes()] for name, values in blobs.items()}


def best_candidates(anchors: DataFrame, candidates: DataFrame, fields: Fields, scale: int, counts: tuple[int, int], k: int, bounds: tuple[int, int] | None) -> DataFrame:
    """FOUND rows: of each anchor's slots the ``k`` best candidates of every stripe.

    Anchors are dealt to blocks, candidates to stripes, in packed rows; block and stripe meet in a cell
    of the grid, which one task works through row by row with the block's best so far. With one block
    every candidate moves once; with more, once a block. How labels or vectors repeat is without effect
    on what a cell holds.
    """
    n_anchors, n_candidates = counts
    blocks = max(1, -(-n_anchors // BLOCK_ANCHORS))
    tasks = int(anchors.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    stripes = max(-(-n_candidates // STRIPE_MOST), min(-(-tasks // blocks), -(-n_candidates // STRIPE_LEAST)), 1)

    def pack_block(rows: pa.Table) -> pa.Table:
        return pa.table({"block": rows.column("block").slice(0, 1), **pack(rows, fields, scale)})

    def pack_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for first in range(0, batch.num_rows, ROW_CANDIDATES):
                part = pa.Table.from_batches([batch.slice(first, ROW_CANDIDATES)])
                yield pa.RecordBatch.from_pydict(pack(part, fields, scale))

    block = F.pmod(F.xxhash64("id"), F.lit(blocks)).cast("int")
    left = anchors.withColumn("block", block).groupBy("block").applyInArrow(pack_block, f"block int, {PACKED}")
    left = left.withColumn("stripe", F.explode(F.sequence(F.lit(0), F.lit(stripes - 1)))).withColumn("candidates", F.lit(False))
    right = candidates.mapInArrow(pack_rows, PACKED).withColumn("stripe", F.pmod(F.xxhash64("ids"), F.lit(stripes)).cast("int"))
    right = right.withColumn("block", F.explode(F.sequence(F.lit(0), F.lit(blocks - 1)))).withColumn("candidates", F.lit(True))
    cells = left.unionByName(right).withColumn("cell", (F.col("block") * stripes + F.col("stripe")).cast("int"))
    dealt = cells.repartitionById(blocks * stripes, F.col("cell")).sortWithinPartitions("cell", "candidates")

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cell, found = None, None
        for batch in batches:
            for i in range(batch.num_rows):
                row = {c: batch.column(c)[i].as_buffer() for c in batch.schema.names if pa.types.is_binary(batch.schema.field(c).type)}
                if cell != batch.column("cell")[i].as_py():
                    if found:
                        yield from found.results()
                    cell, found = batch.column("cell")[i].as_py(), None
                if batch.column("candidates")[i].as_py():
                    if found:
                        found.meet(Packed.of(row, fields))
                else:
                    found = Search(Packed.of(row, fields), fields, k, bounds)
        if found:
            yield from found.results()

    return dealt.mapInArrow(search, FOUND)


def first_of(found: DataFrame, group: list[str], k: int) -> DataFrame:
    """The first ``k`` of each group's rows by falling score and rising id, with rank from 1; cut before the shuffle too."""
    order = Window.partitionBy(*group).orderBy(F.col("score").desc(), "id")
    return found.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)


def hard_negatives(
    vectors: DataFrame,
    anchors: Column,
    *,
    key: str = "vec_id",
    column: str = "embedding",
    label: str = "label",
    scale: int = SCALE,
    positives: int = POSITIVES,
    negatives: int = NEGATIVES,
    bounds: tuple[int, int] = (LOWER, UPPER),
) -> DataFrame:
    """(anchor_id, positive_id, rank, negative_id, positive_score, negative_score) for the rows that ``anchors`` tells.

    Components count as floor(scale * x); a score is the inner product with the anchor, and higher
    scores come first, ties by smaller key. An anchor's positives are its first rows of the same label;
    for each the first rows of other labels come whose score is between the ``bounds``, in hundredths of the
    positive's. Every row is compared with every anchor, in blocks. Rows with a NULL key or label, and
    vectors that are NULL, hold a NULL or non-finite entry, or are not of the commonest length, take no
    part. Key and label have to be whole numbers, and a key names a row: of rows that share one, the
    least by label and vector counts. A positive without negatives in its range has no rows. A score that
    64 bits can't hold is an error.
    """
    for name in (key, label):
        if not isinstance(vectors.schema[name].dataType, T.IntegralType):
            raise TypeError(f"column {name} has to be of whole numbers")
    known = vectors.filter(F.col(key).isNotNull() & F.col(label).isNotNull())
    size = dimension(known, column)
    named = usable(known, column, size).select(
        F.col(key).cast("long").alias("id"), F.struct(F.col(label).cast("long").alias("label"), F.col(column).alias("vector"), anchors.alias("anchor")).alias("row")
    )
    rows = stored(named.groupBy("id").agg(F.min("row").alias("row")).select("id", "row.*"), "vectors")
    seen = rows.agg(F.count(F.lit(1)).alias("n"), F.count(F.when(F.col("anchor"), 1)).alias("anchors"), F.min(F.array_min("vector")).alias("low"), F.max(F.array_max("vector")).alias("high")).first()
    names = ["anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score"]
    if not size or not seen.anchors:
        kinds = "anchor_id long, positive_id long, rank int, negative_id long, positive_score long, negative_score long"
        return vectors.sparkSession.createDataFrame([], kinds)
    low, high = (int(v) for v in whole(np.array([seen.low, seen.high], float), scale))
    fields = Fields(low, high, size)
    if size * max(abs(low), abs(high)) ** 2 >= 2**62:
        raise OverflowError(f"scores of {size} components from {low} to {high} exceed 64 bits")
    chosen, candidates, counts = rows.filter("anchor").drop("anchor"), rows.drop("anchor"), (seen.anchors, seen.n)
    near = first_of(best_candidates(chosen, candidates, fields, scale, counts, positives, None), ["anchor_id"], positives)
    near = stored(near.groupBy("anchor_id").agg(F.collect_list(F.struct("id", "score")).alias("positives")), "positives")
    searched = chosen.join(near, chosen["id"] == near["anchor_id"]).select("id", "label", "vector", "positives")
    found = first_of(best_candidates(searched, candidates, fields, scale, counts, negatives, bounds), ["anchor_id", "positive_id"], negatives)
    return found.withColumnsRenamed({"id": "negative_id", "score": "negative_score"}).select(*names)
