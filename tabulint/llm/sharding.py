"""Operator 3: rendezvous hashing of stable record keys over weighted shards, in SQL functions only."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tabulint.llm.ranking import ranked
from tabulint.llm.storage import stored

BYTES_PER_ROW = 16
HASH_STEPS = float(2**52)


def draw(key: Column, shard: int) -> Column:
    """A uniform number strictly between 0 and 1 that depends on key and shard alone."""
    bits = F.shiftrightunsigned(F.xxhash64(key, F.lit(shard)), 12)
    return (bits.cast("double") + 0.5) / HASH_STEPS


def rendezvous(key: Column, weights: Sequence[float]) -> Column:
    """The shard with the highest ``-weight / ln(draw)`` for the key; equal scores go to the lower shard.

    A shard's expected share of the keys is its share of all weights. A further shard only takes keys
    whose score on it beats their old best: every other key stays. NULL is a key like any other.
    """
    best = F.greatest(
        *[
            F.struct((-F.lit(float(w)) / F.log(draw(key, s))).alias("score"), F.lit(-s).alias("negated"))
            for s, w in enumerate(weights)
            if w > 0
        ],
        F.struct(F.lit(-1.0).alias("score"), F.lit(0).alias("negated")),
    )
    return (-best["negated"]).cast("int")


def assign_shards(docs: DataFrame, weights: Sequence[float], *, key: str = "doc_id", grow_by: float = 1.0) -> DataFrame:
    """One row per document: where it goes, and where it would go with one more shard of weight ``grow_by``.

    Columns: key, size (UTF-8 bytes and 16; a NULL text has no bytes), text_crc32, law, shard, slot
    (gapless inside a shard), grown_shard. Other columns of ``docs`` are not read. A repeated row gets a
    slot of its own in the same shard; an empty table gives no rows.
    """
    if not any(w > 0 for w in weights):
        raise ValueError("at least one shard needs a positive weight")
    text = F.col("text")
    rows = docs.select(
        F.col(key).alias(key),
        (F.coalesce(F.octet_length(text), F.lit(0)).cast("long") + BYTES_PER_ROW).alias("size"),
        F.crc32(F.coalesce(text, F.lit("")).cast("binary")).alias("text_crc32"),
    )
    rows = stored(
        rows.select(
            "*",
            F.lit("key").alias("law"),
            rendezvous(F.col(key), weights).alias("shard"),
            rendezvous(F.col(key), [*weights, grow_by]).alias("grown_shard"),
        ),
        "shards",
    )
    placed = ranked(rows, ["shard"], [key, "size", "text_crc32"], "slot")
    return placed.select(key, "size", "text_crc32", "law", "shard", "slot", "grown_shard")
