"""Operator 12: exact dedup by composable polynomial fingerprints; equal fingerprints are compared chunk by chunk."""

from __future__ import annotations

import hashlib
import secrets
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tabulint.llm.names import free_name
from tabulint.llm.polynomial import CHUNK, PRIME, polynomial
from tabulint.llm.storage import stored

# A text of more bytes is cut into pieces that tasks hash and compare in parallel.
HUGE, PIECE = 1 << 23, 1 << 20
# A fingerprint that more than one in HOT rows has is dealt out; there can't be HOT of them.
HOT = 1000
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def same(*names: str, left: DataFrame, right: DataFrame) -> Column:
    condition = F.lit(True)
    for name in names:
        condition = condition & left[name].eqNullSafe(right[name])
    return condition


def normalised(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(bytes, offsets) of texts with A-Z in lower case; a NULL has no bytes."""
    column = column.fill_null("").cast(pa.large_binary())
    _, offsets, data = column.buffers()
    offsets = np.frombuffer(offsets, np.int64)[column.offset : column.offset + len(column) + 1]
    data = np.frombuffer(data, np.uint8)[offsets[0] : offsets[-1]] if data is not None and len(column) else np.zeros(0, np.uint8)
    return data + ((data >= ord("A")) & (data <= ord("Z"))).astype(np.uint8) * np.uint8(32), offsets - offsets[0]


def marked(docs: DataFrame, key: str, base: int, *, bodies: bool) -> DataFrame:
    """(id, sha, n, print, no, piece): a row of number 0 for each text, and the pieces of huge ones, from 1.

    With ``bodies`` the row of number 0 has the text, normalised, and huge texts are left out; without,
    it has no text, and that of a huge text no fingerprint.
    """
    names = ["id", "sha", "n", "print", "no", "piece"]

    def mark(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hasher = polynomial(base)
        for batch in batches:
            if not batch.num_rows:
                continue
            data, offsets = normalised(batch.column("text"))
            sizes = np.diff(offsets)
            huge = sizes > HUGE
            prints: list[int | None] = []
            ends = np.r_[0, np.flatnonzero(huge) + 1, len(huge)]
            for a, b in zip(ends[:-1], ends[1:]):
                last = b - 1 if b > a and huge[b - 1] else b
                prints += hasher.of(data, offsets[a : last + 1]) if last > a else []
                prints += [None] * (b - last)
            shas = [hashlib.sha256(data[a:b]).digest() for a, b in zip(offsets[:-1], offsets[1:])]
            body = [data[a:b].tobytes() if bodies and not h else None for a, b, h in zip(offsets[:-1], offsets[1:], huge)]
            columns = [batch.column("id"), pa.array(shas), pa.array(sizes), pa.array(prints, pa.int64()), pa.array(np.zeros(len(sizes), np.int32)), pa.array(body, pa.binary())]
            heads = pa.RecordBatch.from_arrays(columns, names)
            yield heads.filter(pa.array(~huge)) if bodies else heads
            for i in [] if bodies else np.flatnonzero(huge):
                for no, first in enumerate(range(int(offsets[i]), int(offsets[i + 1]), PIECE), start=1):
                    piece = data[first : min(first + PIECE, offsets[i + 1])].tobytes()
                    row = [batch.column("id").slice(i, 1), pa.array([shas[i]]), pa.array(sizes[i : i + 1]), pa.array([None], pa.int64()), pa.array([no], pa.int32()), pa.array([piece])]
                    yield pa.RecordBatch.from_arrays(row, names)

    kind = docs.schema[key].dataType.simpleString()
    rows = docs.select(F.col(key).alias("id"), "text")
    return rows.mapInArrow(mark, f"id {kind}, sha binary, n long, print long, no int, piece binary")


def huge_prints(pieces: DataFrame, base: int) -> DataFrame:
    """(id, sha, print) of texts that come in pieces: pieces are hashed wherever they lie, their hashes put together."""

    def hashed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hasher = polynomial(base)
        for batch in batches:
            found = [hasher.of(data, np.array([0, len(data)]))[0] for data in (np.frombuffer(p.as_buffer(), np.uint8) for p in batch.column("piece"))]
            sizes = [len(p.as_buffer()) for p in batch.column("piece")]
            columns = [*(batch.column(c) for c in ("id", "sha", "no")), pa.array(found, pa.int64()), pa.array(sizes, pa.int64())]
            yield pa.RecordBatch.from_arrays(columns, ["id", "sha", "no", "hash", "size"])

    def joined(parts: pa.Table) -> pa.Table:
        by_number = {no: (value, size) for no, value, size in zip(*(parts.column(c).to_pylist() for c in ("no", "hash", "size")))}
        value, _ = polynomial(base).joined(by_number[no] for no in sorted(by_number))
        return pa.table({"id": parts.column("id").slice(0, 1), "sha": parts.column("sha").slice(0, 1), "print": pa.array([value], pa.int64())})

    kind = pieces.schema["id"].dataType.simpleString()
    dealt = pieces.select("id", "sha", "no", "piece").repartition("id", "sha", "no")
    return dealt.mapInArrow(hashed, f"id {kind}, sha binary, no int, hash long, size long").groupBy("id", "sha").applyInArrow(joined, f"id {kind}, sha binary, print long")


def equal_chunks(a: memoryview, b: memoryview) -> bool:
    """Whether two texts are equal, chunk by chunk up to the first difference."""
    return len(a) == len(b) and all(a[i : i + CHUNK] == b[i : i + CHUNK] for i in range(0, len(a), CHUNK))


def compared(texts: DataFrame, group: list[str]) -> DataFrame:
    """The rows of ``texts`` that start a group, with their piece, and those that differ from it, without (``first`` false).

    Rows stream by, sorted by group and falling key; only the first piece of the group stays in memory.
    """

    def stream(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, kept = None, memoryview(b"")
        for batch in batches:
            keys = list(zip(*(batch.column(c).to_pylist() for c in group)))
            pieces = batch.column("piece")
            shown, first = [], []
            for i, own in enumerate(keys):
                piece = memoryview(pieces[i].as_buffer()).cast("B")
                if own != now:
                    now, kept = own, memoryview(bytes(piece)).cast("B")
                    shown.append(i)
                    first.append(True)
                elif not equal_chunks(piece, kept):
                    shown.append(i)
                    first.append(False)
            taken = batch.take(pa.array(shown, pa.int64()))
            flags = pa.array(first, pa.bool_())
            hot = pc.and_(flags, taken.column("hot"))
            body = pc.if_else(hot, taken.column("piece"), pa.scalar(None, pa.binary()))
            rest = taken.drop_columns(["piece"])
            out = pa.RecordBatch.from_arrays([*rest.columns, body, flags], [*rest.schema.names, "piece", "first"])
            yield out.filter(pc.or_(hot, pc.invert(flags)))

    names = [c for c in texts.columns if c != "piece"]
    kinds = ", ".join(f"{c} {texts.schema[c].dataType.simpleString()}" for c in names)
    dealt = texts.select(*names, "piece").repartition(*group).sortWithinPartitions(*group, F.desc_nulls_last("id"), F.desc("sha"))
    return dealt.mapInArrow(stream, f"{kinds}, piece binary, first boolean")


def salted(rows: DataFrame, hot: DataFrame) -> DataFrame:
    """``rows`` with hot and salt: rows of a hot fingerprint are dealt to as many salts as its share needs."""
    joined = rows.join(F.broadcast(hot.toDF("hot_print", "hot_n", "salts")), (F.col("print") == F.col("hot_print")) & (F.col("n") == F.col("hot_n")), "left")
    salt = F.when(F.col("salts").isNull(), 0).otherwise(F.pmod(F.xxhash64("id", "sha"), "salts")).cast("int")
    return joined.withColumn("salt", salt).withColumn("hot", F.col("salts").isNotNull()).drop("hot_print", "hot_n", "salts")


def hot_prints(prints: DataFrame) -> DataFrame:
    """(print, n, salts) of the fingerprints that more than one in HOT rows has, so fewer than HOT rows."""
    total = prints.count()
    sizes = prints.groupBy("print", "n").agg(F.count(F.lit(1)).alias("rows")).filter(F.col("rows") * HOT > total)
    return sizes.select("print", "n", F.ceil(F.col("rows") * HOT / F.lit(max(total, 1))).cast("int").alias("salts"))


def fingerprinted(docs: DataFrame, key: str, base: int) -> tuple[DataFrame, DataFrame]:
    """((id, sha, n, print) of every row, (id, sha, n, print, no, piece) to be compared), the latter computed when it is read."""
    rows = stored(marked(docs, key, base, bodies=False), "marked")
    heads, pieces = rows.filter("no = 0").drop("no", "piece"), rows.filter("no > 0").drop("print")
    large = heads.filter("print IS NULL").drop("print")
    whole = stored(huge_prints(pieces, base), "huge")
    known = large.join(whole, same("id", "sha", left=large, right=whole)).select(large["id"], large["sha"], "n", "print")
    cut = pieces.join(whole, same("id", "sha", left=pieces, right=whole)).select(pieces["id"], pieces["sha"], "n", "print", "no", "piece")
    return heads.filter("print IS NOT NULL").unionByName(known), marked(docs, key, base, bodies=True).unionByName(cut)


def exact_duplicates(docs: DataFrame, *, key: str = "doc_id", base: int | None = None) -> DataFrame:
    """(key, keep_id, group_size, kept, text_sha256): for each row the one of its text's rows that stays.

    Texts are equal that are identical after A-Z are lower-cased; a NULL text counts as empty. The
    row with the largest key stays, a NULL key being the smallest; of several rows with that key one
    stays. Fingerprints only bring texts together: every text is compared with the first of its
    fingerprint, and where some differ all that have it get fingerprints of another base, until all
    texts of a fingerprint are equal; so the result does not depend on ``base`` (by default drawn at
    random). Rows that share a key and a SHA-256 digest count as having one text. A text of more than
    HUGE bytes is hashed and compared in pieces.
    """
    heads, texts = fingerprinted(docs, key, base or random_base())
    numbered = heads.withColumn("row", F.monotonically_increasing_id()).withColumn("round", F.lit(0))
    pending, settled = stored(numbered, "prints"), None
    while True:
        hot = stored(hot_prints(pending), "hot")
        some = salted(pending, hot)
        found = stored(compared(salted(texts, hot), ["print", "n", "no", "salt"]), "compared")
        starts = found.filter("first").drop("first").withColumnRenamed("salt", "start_salt")
        apart = compared(starts, ["print", "n", "no"]).filter("NOT first")
        unequal = stored(found.filter("NOT first").select("print", "n").unionByName(apart.select("print", "n")).distinct(), "unequal")
        done = some.join(unequal, ["print", "n"], "left_anti")
        settled = done if settled is None else settled.unionByName(done)
        if unequal.isEmpty():
            return decided(settled, key)
        again = some.join(unequal, ["print", "n"], "left_semi").withColumn("round", F.col("round") + 1).drop("print", "hot", "salt")
        again = stored(again, "again")
        rest = docs.select(key, "text").join(again, docs[key].eqNullSafe(again["id"]), "left_semi")
        heads, texts = fingerprinted(rest, key, random_base())
        texts = texts.join(again, same("id", "sha", left=texts, right=again), "left_semi")
        prints = heads.dropDuplicates(["id", "sha"])
        pending = again.join(prints, same("id", "sha", left=again, right=prints)).select(*[again[c] for c in again.columns], "print")
        pending = stored(pending, "pending")


def random_base() -> int:
    return secrets.randbelow(PRIME - (1 << 32)) + (1 << 32)


def decided(rows: DataFrame, key: str) -> DataFrame:
    """The result for rows whose texts are equal if print, n and round are; a hot group is joined by salts."""
    group = ["print", "n", "round"]
    parts = rows.groupBy(*group, "salt").agg(F.count(F.lit(1)).alias("size"), F.max(F.struct("id", "row")).alias("top"))
    classes = parts.groupBy(*group).agg(F.sum("size").alias("group_size"), F.max("top").alias("top"), F.collect_list("salt").alias("salts"))
    classes = classes.select(*group, "group_size", "top", F.explode("salts").alias("salt"))
    return rows.join(classes, [*group, "salt"]).select(
        F.col("id").alias(key),
        F.col("top.id").alias("keep_id"),
        "group_size",
        (F.col("row") == F.col("top.row")).alias("kept"),
        F.lower(F.hex("sha")).alias("text_sha256"),
    )


def drop_exact_duplicates(docs: DataFrame, *, key: str = "doc_id") -> DataFrame:
    """``docs`` with one row of each text, as ``exact_duplicates`` decides; all its columns stay."""
    kept = exact_duplicates(docs, key=key).filter("kept").select(F.col(key).alias("__key"), F.col("text_sha256").alias("__sha"))
    digest = F.sha2(F.translate(F.coalesce("text", F.lit("")), UPPER, LOWER).cast("binary"), 256)
    own = free_name(docs, "__sha")
    rows = docs.withColumn(own, digest)
    found = rows.join(kept, rows[key].eqNullSafe(kept["__key"]) & (rows[own] == kept["__sha"]), "left_semi")
    return found.dropDuplicates([key, own]).drop(own)
