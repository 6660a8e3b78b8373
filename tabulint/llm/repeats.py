"""Repeated windows of bytes over all documents: what brings the strings of suffix-array dedup together.

Equal windows lie in regions of one name (see ``regions``). Regions of a name meet in one shuffle of
narrow rows; equal regions are settled there, and only regions that share a name but differ are
fetched with their text and compared inside, group by group. Where very many different regions share
a name, single windows are settled in the same way as regions, by digests. Names with so many regions
that one task should not hold them are known beforehand, from a sample, and meet by name and digest.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tabulint.llm.regions import Regions, regions
from tabulint.llm.storage import stored
from tabulint.llm.words import byte_values, mixed, rough_span, rough_sums, slices

# A name whose different regions have more bytes in sum is settled window by window, not in one shard.
GROUP_BYTES = 1 << 23
SHARD_UNITS = 1 << 20
# Share of the documents in which names with many regions are looked for, and how many such names there can be.
HOT_SAMPLE = 1 / 64
HOT_NAMES = 100_000
# What a region is among the equal ones of its batch, or by its name.
ALONE, FOREMOST, COPY, HOT = 0, 1, 2, 3

RUNS = "id {key}, first long, n long"


@dataclass(frozen=True)
class Units:
    """How long windows and the grams that name regions are, in bytes."""

    window: int
    gram: int

    def found(self, column: pa.Array) -> Iterator[tuple[int, np.ndarray, Regions, np.ndarray]]:
        """(first row, row of each region, regions with starts inside their text, digests) of slices of a text column."""
        for first, data, offsets in slices(column):
            at = np.arange(max(len(data) - self.gram + 1, 0))
            grams = rough_span(rough_sums(byte_values()[data]), at, at + self.gram)
            got = regions(grams, self.window - self.gram + 1, offsets, self.window)
            row = np.searchsorted(offsets, got.first, "right") - 1
            digest = digests(memoryview(data), got.first, got.first + got.starts + self.window - 1)
            inside = Regions(got.name, got.first - offsets[row], got.starts, got.inner)
            yield first, first + row, inside, digest

    def cut(self, text: bytes, first: np.ndarray, n: np.ndarray) -> list[bytes]:
        """The stretches that ``n`` windows from ``first`` on cover."""
        return [text[a:b] for a, b in zip(first, first + n + self.window - 1)]


def digests(data: memoryview, start: np.ndarray, stop: np.ndarray) -> np.ndarray:
    """The 128-bit BLAKE2b digest of each stretch, as two numbers a row."""
    found = b"".join([hashlib.blake2b(data[a:b], digest_size=16).digest() for a, b in zip(start.tolist(), stop.tolist())])
    return np.frombuffer(found, np.int64).reshape(-1, 2)


def hot_names(docs: DataFrame, units: Units, key: str) -> np.ndarray:
    """Names with so many regions, copies of a batch aside, that they have more than GROUP_BYTES if these differ.

    Counts come from a sample of the documents. They decide how regions of a name meet and not what is
    found, so a name that the sample misses costs time only. At most HOT_NAMES reach the driver.
    """
    least = GROUP_BYTES / units.window * HOT_SAMPLE
    some = docs.sample(HOT_SAMPLE, seed=1) if HOT_SAMPLE < 1 else docs
    counts = narrow_regions(some, units, key, np.zeros(0, np.uint64)).filter(F.col("kind") != COPY).groupBy("name").agg(F.count(F.lit(1)).alias("n"))
    found = counts.filter(F.col("n") >= least).orderBy(F.desc("n"), "name").limit(HOT_NAMES).collect()
    return np.sort(np.array([r.name for r in found], np.int64).view(np.uint64))


def narrow_regions(docs: DataFrame, units: Units, key: str, hot: np.ndarray) -> DataFrame:
    """(name, digest, check, id, first, n, inner, kind): the regions of all texts, each batch's equal ones marked.

    In a batch the first of equal regions, by key and place, stands for all; the others are copies and
    get a name of their own, so that a stretch that very many documents share meets once per batch.
    Regions of ``hot`` names get one name for each digest.
    """
    sent = docs.sparkSession.sparkContext.broadcast(hot)

    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            parts = list(units.found(batch.column("text")))
            if not sum(len(row) for _, row, _, _ in parts):
                continue
            row = np.concatenate([p[1] for p in parts])
            name, first, n, inner = (np.concatenate([getattr(p[2], c) for p in parts]) for c in ("name", "first", "starts", "inner"))
            digest, check = np.concatenate([p[3] for p in parts]).T
            place = pc.rank(batch.column("id"), tiebreaker="dense").to_numpy()[row]
            order = np.lexsort((first, place, check, digest, name))
            row, place, name, first, n, inner, digest, check = (x[order] for x in (row, place, name, first, n, inner, digest, check))
            same = np.r_[False, (name[1:] == name[:-1]) & (digest[1:] == digest[:-1]) & (check[1:] == check[:-1])]
            again = same & np.r_[False, (place[1:] == place[:-1]) & (first[1:] == first[:-1])]
            row, name, first, n, inner, digest, check, same = (x[~again] for x in (row, name, first, n, inner, digest, check, same))
            crowd = np.isin(name, sent.value)
            kind = np.select([same, crowd, np.r_[same[1:], False]], [COPY, HOT, FOREMOST], ALONE)
            alone = mixed(digest.view(np.uint64) ^ mixed(first.astype(np.uint64) * np.uint64(2654435761) + row.astype(np.uint64)))
            name = np.select([same, crowd], [alone, mixed(name ^ mixed(digest.view(np.uint64)))], name)
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(name.view(np.int64)),
                    pa.array(digest),
                    pa.array(check),
                    batch.column("id").take(pa.array(row)),
                    pa.array(first),
                    pa.array(n),
                    pa.array(inner),
                    pa.array(kind.astype(np.int8)),
                ],
                ["name", "digest", "check", "id", "first", "n", "inner", "kind"],
            )

    kind = docs.schema[key].dataType.simpleString()
    some = docs.filter(F.col(key).isNotNull() & F.col("text").isNotNull()).select(F.col(key).alias("id"), "text")
    return some.mapInArrow(find, f"name long, digest long, check long, id {kind}, first long, n long, inner boolean, kind tinyint")


def settled(found: DataFrame, window: int) -> DataFrame:
    """(id, first, n, name, crowded, gone, open): regions that go whole, and regions to be compared inside.

    A region goes if an equal one comes before it. Of equal regions the first is compared, with all
    different regions of its name, or with itself if its name occurs in it twice. ``crowded`` tells that
    these have more than GROUP_BYTES in sum, or that the name is a hot one.
    """
    group = Window.partitionBy("name", "copy")
    sort = group.orderBy("digest", "check", "id", "first")
    before = F.lag(F.struct("digest", "check", "id", "first")).over(sort)
    rows = found.withColumn("copy", F.col("kind") == COPY).withColumn("hot", F.col("kind") == HOT)
    rows = rows.withColumn("before", before)
    equal = F.coalesce((F.col("before.digest") == F.col("digest")) & (F.col("before.check") == F.col("check")), F.lit(False))
    # a repeated row of one document is that document
    rows = rows.filter(~(equal & (F.col("before.id") == F.col("id")) & (F.col("before.first") == F.col("first"))))
    rows = rows.withColumn("gone", equal | F.col("copy"))
    different, size = (F.sum(F.when(F.col("gone"), 0).otherwise(x)).over(group) for x in (F.lit(1), F.col("n") + F.lit(window)))
    rows = rows.withColumn("different", different).withColumn("size", size)
    rows = rows.withColumn("open", ~F.col("gone") & (F.col("inner") | F.col("hot") | (F.col("different") > 1)))
    crowded = F.col("hot") | ((F.col("size") > GROUP_BYTES) & (F.col("different") > 1))
    return rows.filter("gone OR open").select("id", "first", "n", "name", crowded.alias("crowded"), "gone", "open")


def open_texts(docs: DataFrame, regions_: DataFrame, units: Units, key: str) -> DataFrame:
    """(name, id, first, n, body, digest): the regions to be compared, with their text.

    The regions of crowded names come window by window instead, with a digest of 128 bits for a body.
    """
    wanted = regions_.filter("open").groupBy("id").agg(F.collect_list(F.struct("first", "n", "name", "crowded")).alias("regions"))
    texts = docs.select(F.col(key).alias("of"), "text").join(wanted, F.col("of") == F.col("id")).select("id", "text", "regions")

    def fetch(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            parts: list[tuple] = []
            bodies: list[bytes | None] = []
            digests: list[bytes | None] = []
            for i in range(batch.num_rows):
                rows = batch.column("regions")[i].values
                first, n, name = (rows.field(c).to_numpy() for c in ("first", "n", "name"))
                crowded = rows.field("crowded").to_numpy(zero_copy_only=False)
                dealt = np.where(crowded, n, 1)
                at = np.repeat(np.arange(len(n)), dealt)
                inside = np.arange(len(at)) - np.repeat(np.cumsum(dealt) - dealt, dealt)
                alone = crowded[at]
                first, n, name = first[at] + inside, np.where(alone, 1, n[at]), name[at]
                for body, single in zip(units.cut(batch.column("text")[i].as_py().encode(), first, n), alone):
                    bodies.append(None if single else body)
                    digests.append(hashlib.blake2b(body, digest_size=16).digest() if single else None)
                parts.append((name, np.full(len(at), i), first, n))
            if parts:
                name, row, first, n = (np.concatenate(x) for x in zip(*parts))
                ids = batch.column("id").take(pa.array(row))
                columns = [pa.array(name), ids, pa.array(first), pa.array(n), pa.array(bodies, pa.binary()), pa.array(digests, pa.binary())]
                yield pa.RecordBatch.from_arrays(columns, ["name", "id", "first", "n", "body", "digest"])

    kind = docs.schema[key].dataType.simpleString()
    return texts.mapInArrow(fetch, f"name long, id {kind}, first long, n long, body binary, digest binary")


def crowded_windows(texts: DataFrame) -> DataFrame:
    """(id, first, n): the windows of crowded names that go.

    Their first places and numbers are added up before the shuffle, so however many documents share a
    window, a task sends one row of it, and the join back splits it where it is hot.
    """
    windows = texts.filter("digest IS NOT NULL").select("digest", "id", "first", "n")
    firsts = windows.groupBy("digest").agg(F.min(F.struct("id", "first")).alias("least"), F.count(F.lit(1)).alias("times"))
    again = windows.join(firsts.filter("times > 1"), "digest")
    return again.filter((F.col("id") != F.col("least.id")) | (F.col("first") != F.col("least.first"))).select("id", "first", "n")


Compare = Callable[[list[int], np.ndarray, list[bytes]], np.ndarray]


def compared(texts: DataFrame, compare: Compare) -> DataFrame:
    """(id, first, n): the window starts that ``compare`` finds to go.

    Groups arrive one after the other, sorted by key and place, and are handed over in shards of about
    SHARD_UNITS bytes, whole groups each: the name of each region, its number of window starts, and
    its text. ``compare`` gives a flag per start, region after region.
    """
    kind = texts.schema["id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple] = []
        size = 0
        for batch in batches:
            kind_of_id = batch.column("id").type
            for row in zip(*(batch.column(c).to_pylist() for c in ("name", "id", "first", "n", "body"))):
                if size >= SHARD_UNITS and row[0] != held[-1][0]:
                    yield from closed(held, kind_of_id)
                    held, size = [], 0
                held.append(row)
                size += len(row[4])
        if held:
            yield from closed(held, kind_of_id)

    def closed(held: list[tuple], kind_of_id: pa.DataType) -> Iterator[pa.RecordBatch]:
        n = np.array([row[3] for row in held])
        gone = compare([row[0] for row in held], n, [row[4] for row in held])
        region = np.repeat(np.arange(len(held)), n)
        start = np.arange(len(gone)) - np.repeat(np.cumsum(n) - n, n)
        begins = np.flatnonzero(gone & np.r_[True, ~gone[:-1] | (region[1:] != region[:-1])])
        ends = np.flatnonzero(gone & np.r_[~gone[1:] | (region[1:] != region[:-1]), True])
        if len(begins):
            first = np.array([row[2] for row in held])[region[begins]] + start[begins]
            ids = pa.array([held[r][1] for r in region[begins]], kind_of_id)
            yield pa.RecordBatch.from_arrays([ids, pa.array(first), pa.array(ends - begins + 1)], ["id", "first", "n"])

    whole = texts.filter("body IS NOT NULL").drop("digest")
    grouped = whole.repartition("name").sortWithinPartitions("name", "id", "first")
    return grouped.mapInArrow(run, RUNS.format(key=kind))


def runs_to_remove(docs: DataFrame, units: Units, compare: Compare, *, key: str) -> DataFrame:
    """(id, runs): for each document that loses something, its runs (first, n) of window starts that go."""
    found = narrow_regions(docs, units, key, hot_names(docs, units, key))
    known = stored(settled(found, units.window), "regions")
    texts = stored(open_texts(docs, known, units, key), "texts")
    inside = compared(texts, compare).unionByName(crowded_windows(texts))
    runs = known.filter("gone").select("id", "first", "n").unionByName(inside)
    return runs.groupBy("id").agg(F.collect_list(F.struct("first", "n")).alias("runs"))


def covered(size: int, first: np.ndarray, n: np.ndarray, window: int) -> np.ndarray:
    """Which of ``size`` units the windows cover."""
    edges = np.zeros(size + 1, np.int64)
    np.add.at(edges, first, 1)
    np.add.at(edges, first + n + window - 1, -1)
    return np.cumsum(edges[:-1]) > 0


def runs_of(batch: pa.RecordBatch, i: int, column: str) -> tuple[np.ndarray, np.ndarray]:
    """(first, n) of the runs of one row; none for NULL."""
    runs = batch.column(column)[i]
    if not runs.is_valid:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    return runs.values.field("first").to_numpy(), runs.values.field("n").to_numpy()
