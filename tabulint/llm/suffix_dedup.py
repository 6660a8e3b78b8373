"""Operator 4: suffix-array dedup. Bytes that a string repeats which started earlier are removed."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tabulint.llm.induced_sorting import permuted_common_prefixes, suffix_array
from tabulint.llm.names import free_name
from tabulint.llm.repeats import Units, covered, runs_of, runs_to_remove

WINDOW_BYTES = 100
GRAM_BYTES = 32
END, PART, FIRST_BYTE = 0, 1, 2


def later_starts(window: int):
    """Flags the window starts whose string another one before it has: one suffix array for the shard.

    The regions lie end to end, parted, in the order of keys and places. Where a suffix shares
    ``window`` bytes with the one sorted before it, both belong to one class of equal strings; the
    first place of a class stays.
    """

    def compare(groups: list[int], n: np.ndarray, bodies: list[bytes]) -> np.ndarray:
        sizes = np.array([len(b) + 1 for b in bodies])
        begins = np.cumsum(sizes) - sizes
        text = np.full(sizes.sum() + 1, PART, np.uint16)
        text[-1] = END
        inside = np.ones(len(text), bool)
        inside[begins + sizes - 1] = inside[-1] = False
        text[inside] = np.frombuffer(b"".join(bodies), np.uint8).astype(np.uint16) + FIRST_BYTE
        order = suffix_array(text, 256 + FIRST_BYTE)
        shared = permuted_common_prefixes(text, order)[order] >= window
        classes = np.flatnonzero(~shared)
        first = np.minimum.reduceat(order, classes)
        later = np.zeros(len(text), bool)
        later[order] = order != np.repeat(first, np.diff(np.r_[classes, len(order)]))
        starts = np.repeat(begins, n) + np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
        return later[starts]

    return compare


def drop_repeated_bytes(docs: DataFrame, *, key: str = "doc_id", window: int = WINDOW_BYTES) -> DataFrame:
    """``docs`` with kept (binary: the UTF-8 bytes that stay), n_bytes, n_removed and spans (start, end).

    A byte goes if a string of ``window`` bytes covers it that also starts earlier: in a document with
    a smaller key, or further up in the same one. Strings are judged on the input and never cross
    documents. A NULL text counts as empty; a text shorter than ``window`` stays whole, as does one
    whose key is NULL. Rows that repeat a document, key and text, count as one document and lose the
    same bytes; different texts need different keys. Columns that have the new names are replaced.
    """
    docs = docs.drop("kept", "n_bytes", "n_removed", "spans")
    units = Units(window=window, gram=min(GRAM_BYTES, window))
    of, gone_at = free_name(docs, "__of"), free_name(docs, "__runs")
    gone = runs_to_remove(docs, units, later_starts(window), key=key).toDF(of, gone_at)

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            kept, sizes, removed, spans = [], [], [], []
            for i, text in enumerate(batch.column("text")):
                data = np.frombuffer((text.as_py() or "").encode(), np.uint8)
                first, n = runs_of(batch, i, gone_at)
                away = covered(len(data), first, n, window)
                edges = np.flatnonzero(np.diff(np.r_[False, away, False]))
                kept.append(data[~away].tobytes() if len(first) else data.tobytes())
                sizes.append(len(data))
                removed.append(int(away.sum()))
                spans.append([{"start": int(a), "end": int(b)} for a, b in edges.reshape(-1, 2)])
            kind = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))
            others = batch.drop_columns([gone_at])
            yield pa.RecordBatch.from_arrays(
                [*others.columns, pa.array(kept, pa.binary()), pa.array(sizes, pa.int64()), pa.array(removed, pa.int64()), pa.array(spans, kind)],
                [*others.schema.names, "kept", "n_bytes", "n_removed", "spans"],
            )

    span = T.StructType([T.StructField("start", T.LongType()), T.StructField("end", T.LongType())])
    added = T.StructType([*docs.schema.fields]).add("kept", "binary").add("n_bytes", "long").add("n_removed", "long")
    added = added.add("spans", T.ArrayType(span))
    joined = docs.join(gone, docs[key] == gone[of], "left").select(*[docs[c] for c in docs.columns], gone[gone_at])
    return joined.mapInArrow(cut, added)


def digests(deduped: DataFrame, key: str = "doc_id") -> DataFrame:
    """(key, n_bytes, n_removed, n_spans, kept_sha256) of what ``drop_repeated_bytes`` gives."""
    return deduped.select(key, "n_bytes", "n_removed", F.size("spans").cast("long").alias("n_spans"), F.sha2("kept", 256).alias("kept_sha256"))
