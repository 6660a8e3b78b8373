"""Operator 5: document fingerprints by randomised edit embedding, and the near copies they show."""

from __future__ import annotations

import bisect
import hashlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tabulint.llm import edit_embedding as ee
from tabulint.llm.near_dedup import near_classes
from tabulint.llm.ranking import ranked
from tabulint.llm.storage import stored

THRESHOLD = 0.5
LEAST_KEY = -(2**63)
# A document's place in the order of all: its key (LEAST_KEY for NULL) and the hash of its text.
Place = tuple[int, int]


def edited(text: str, following: str) -> str:
    """``text`` whose last half, rounded down, gives way to as many characters of the start of ``following``."""
    half = len(text) // 2
    return text[: len(text) - half] + following[:half]


def fingerprints(docs: DataFrame, *, key: str = "doc_id") -> DataFrame:
    """(key, fingerprint) of each whole text; equal texts have equal fingerprints, NULL counts as empty."""

    def embed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found: list[str] = []
            texts: list[np.ndarray] = []
            size = 0
            for text in batch.column("text"):
                texts.append(ee.code_points(text.as_py() or ""))
                size += len(texts[-1])
                if size >= ee.WALK_CHARS:
                    found += map(ee.spelled, ee.walk(texts))
                    texts, size = [], 0
            found += map(ee.spelled, ee.walk(texts))
            yield pa.RecordBatch.from_arrays([batch.column("k"), pa.array(found, pa.string())], ["k", "fingerprint"])

    kind = docs.schema[key].dataType.simpleString()
    return docs.select(F.col(key).alias("k"), "text").mapInArrow(embed, f"k {kind}, fingerprint string").withColumnRenamed("k", key)


def place(key: str) -> list[Column]:
    return [F.coalesce(F.col(key).cast("long"), F.lit(LEAST_KEY)).alias("o"), F.xxhash64("text").alias("h")]


def ranges(docs: DataFrame, key: str, parts: int) -> tuple[list[Place], dict[Place, set[int]]]:
    """(bounds, place -> parts before it): ranges of places of like size, and the parts that need a range's largest place.

    A key that takes up several ranges is cut by the hashes of its texts. Both hold at most one entry per
    part, however many documents there are.
    """
    order, text_hash = place(key)
    cuts = docs.agg(F.percentile_approx(order, [i / parts for i in range(1, parts)], 100 * parts)).first()[0] if parts > 1 else []
    bounds: list[Place] = []
    for k, n in sorted(Counter(cuts or []).items()):
        bounds += [(k, -(2**63) + 2**64 * j // n - 1) for j in range(1, n + 1)]

    def largest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found: dict[int, Place] = {}
        for batch in batches:
            for at in zip(batch.column("o").to_pylist(), batch.column("h").to_pylist()):
                part = bisect.bisect_left(bounds, at)
                found[part] = max(at, found.get(part, at))
        columns = [pa.array(found, pa.int32()), *(pa.array([at[i] for at in found.values()], pa.int64()) for i in (0, 1))]
        yield pa.RecordBatch.from_arrays(columns, ["part", "o", "h"])

    tops = docs.select(order, text_hash).mapInArrow(largest, "part int, o long, h long").groupBy("part").agg(F.max(F.struct("o", "h")).alias("top"))
    heads = sorted((r.part, (r.top.o, r.top.h)) for r in tops.collect())
    before: dict[Place, set[int]] = {}
    for (_, head), (part, _) in zip(heads, heads[1:] + heads[:1]):
        before.setdefault(head, set()).add(part)
    return bounds, before


def edited_neighbours(docs: DataFrame, *, key: str = "doc_id", parts: int | None = None) -> DataFrame:
    """Each document beside its edited text: fingerprints of both, and how like they are.

    The next document is the one with the next smaller key, after the last one the first; rows with one
    key go by a hash of their texts, falling, and a NULL key comes last, as -2**63 does. Columns: key, n_chars, edited_sha256,
    fingerprint, edited_fingerprint, near_edited, near_next (0 to 1), bands_edited (bands in common with
    the edited text's fingerprint). Texts are shuffled once, by ranges of keys; besides its own rows a
    range gets the first row of the range below, so that no task sees more than its range; a key with very
    many rows takes up several ranges. Keys have to be whole numbers. A text is walked by one task, at about 12 microseconds a character in Python's
    numpy where it has no companions, so one of 100 MB takes some 20 minutes.
    """
    if not isinstance(docs.schema[key].dataType, T.IntegralType):
        raise TypeError(f"column {key} has to be of whole numbers")
    spark = docs.sparkSession
    parts = parts or int(spark.conf.get("spark.sql.shuffle.partitions"))
    bounds, before = ranges(docs, key, parts)
    kind = docs.schema[key].dataType.simpleString()

    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows, to, extra = [], [], []
            for i, at in enumerate(zip(batch.column("o").to_pylist(), batch.column("h").to_pylist())):
                rows.append(i)
                to.append(bisect.bisect_left(bounds, at))
                extra.append(False)
                for part in before.get(at, ()):
                    rows.append(i)
                    to.append(part)
                    extra.append(True)
            picked = batch.take(pa.array(rows, pa.int64()))
            yield pa.RecordBatch.from_arrays([*picked.columns, pa.array(to, pa.int32()), pa.array(extra)], [*picked.schema.names, "part", "extra"])

    def pairs(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[object, str, str]]:
        """(key, text, next text); the first extra row of a range is the next of its last own row."""
        held, closed = None, True
        for batch in batches:
            for k, text, part, extra in zip(batch.column("k"), batch.column("text"), batch.column("part").to_pylist(), batch.column("extra").to_pylist()):
                if held is not None and not closed:
                    yield held[0], held[1], text.as_py() or ""
                    closed = True
                if not extra:
                    held, closed = (k.as_py(), text.as_py() or "", part), False

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        group: list[tuple[object, str, str]] = []
        size = 0
        for row in pairs(batches):
            group.append(row)
            size += 2 * len(row[1])
            if size >= ee.WALK_CHARS:
                yield compared(group)
                group, size = [], 0
        if group:
            yield compared(group)

    def compared(group: list[tuple[object, str, str]]) -> pa.RecordBatch:
        changed = [edited(text, following) for _, text, following in group]
        own = ee.walk([ee.code_points(text) for _, text, _ in group])
        other = ee.walk([ee.code_points(text) for text in changed])
        last = ee.walk([ee.code_points(group[-1][2])])
        following = np.concatenate([own[1:], last])
        columns = {
            "k": pa.array([k for k, _, _ in group], key_type(kind)),
            "n_chars": pa.array([len(text) for _, text, _ in group], pa.int64()),
            "edited_sha256": pa.array([hashlib.sha256(t.encode("utf-8", "surrogatepass")).hexdigest() for t in changed]),
            "fingerprint": pa.array(map(ee.spelled, own)),
            "edited_fingerprint": pa.array(map(ee.spelled, other)),
            "near_edited": pa.array(map(ee.likeness, own, other), pa.float64()),
            "near_next": pa.array(map(ee.likeness, own, following), pa.float64()),
            "bands_edited": pa.array(map(ee.shared_bands, own, other), pa.int64()),
        }
        return pa.RecordBatch.from_arrays(list(columns.values()), list(columns))

    rows = docs.select(F.col(key).alias("k"), "text", *place(key))
    dealt = rows.mapInArrow(deal, f"k {kind}, text string, o long, h long, part int, extra boolean")
    in_order = ("part", "extra", F.desc("o"), F.desc("h"), F.asc_nulls_first("text"))
    placed = dealt.repartitionById(len(bounds) + 1, F.col("part")).sortWithinPartitions(*in_order)
    schema = (
        f"k {kind}, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, "
        "near_edited double, near_next double, bands_edited long"
    )
    return placed.mapInArrow(compare, schema).withColumnRenamed("k", key)


def key_type(kind: str) -> pa.DataType:
    return {"bigint": pa.int64(), "int": pa.int32(), "smallint": pa.int16(), "tinyint": pa.int8()}[kind]


def near_copies(prints: DataFrame, *, key: str = "doc_id", threshold: float = THRESHOLD) -> DataFrame:
    """(key, class_id): documents whose fingerprints share a sampled band and are like enough, by class.

    Equal fingerprints are one node. Candidates meet in the buckets of ``candidate_cells``, whose bands
    are fitted to ``threshold``: a pair just at it has none in common less than once in a thousand
    times. The likeness of whole fingerprints verifies them, and links make classes, named by the least
    key. Short texts fill few cells, so many of them meet, and are told apart by verification.
    """

    def verify(pairs: DataFrame) -> DataFrame:
        both = pairs.join(nodes.toDF("a", "pa"), "a").join(nodes.toDF("b", "pb"), "b")
        return both.select("a", "b", "pa", "pb").mapInArrow(compare, "a binary, b binary, similarity double").filter(F.col("similarity") >= threshold)

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            alike = [ee.likeness(ee.read(a), ee.read(b)) for a, b in zip(batch.column("pa").to_pylist(), batch.column("pb").to_pylist())]
            yield pa.RecordBatch.from_arrays([batch.column("a"), batch.column("b"), pa.array(alike, pa.float64())], ["a", "b", "similarity"])

    def meet(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for low in range(0, len(batch), 256):
                part = batch.slice(low, 256)
                buckets = [ee.candidate_buckets(ee.read(p), threshold) for p in part.column("fingerprint").to_pylist()]
                at = np.repeat(np.arange(len(buckets)), [len(b) for b in buckets])
                yield pa.RecordBatch.from_arrays([part.column("node").take(pa.array(at)), pa.array(np.concatenate(buckets))], ["node", "bucket"])

    node = F.unhex(F.md5("fingerprint"))
    nodes = stored(prints.filter(F.col("fingerprint").isNotNull()).select(node.alias("node"), "fingerprint").distinct(), "prints")
    entries = stored(nodes.mapInArrow(meet, "node binary, bucket long"), "bands")
    shared = entries.groupBy("bucket").agg(F.count(F.lit(1)).alias("n")).filter("n > 1").select("bucket")
    members = stored(entries.join(shared, "bucket"), "members")
    labels = near_classes(stored(ranked(members, ["bucket"], ["node"], "place"), "places"), verify)
    named = prints.join(labels, node == labels["node"], "left").withColumn("label", F.coalesce("label", node))
    least = named.groupBy(F.col("label").alias("of")).agg(F.min(key).alias("class_id"))
    return named.join(least, named["label"].eqNullSafe(least["of"])).select(key, "class_id")
