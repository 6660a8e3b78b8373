"""Operator 8: documents as token pieces, packed into sequences by cutting-stock column generation."""

from __future__ import annotations

import base64
import zlib
from collections.abc import Callable, Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tabulint.llm.cutting_stock import plan
from tabulint.llm.ranking import ranked
from tabulint.llm.storage import stored

SEQUENCE = 1024
GRAIN = 4
END = 0
SPECIAL = "<|endoftext|>"

PIECES = "doc_id {key}, start long, length long, ids binary, ids_crc32 long, doc_tokens long"


@lru_cache(maxsize=2)
def encoder(json_path: str, ranks_path: str, pattern: str) -> Callable[[str], np.ndarray]:
    """The token ids of a text, as the tokenizer file at ``json_path`` defines them.

    The same byte-level vocabulary is merged from its ranks file, which gives the same ids several times
    faster; the few texts that spell the special token go through the tokenizer file itself.
    """
    import tiktoken
    from tokenizers import Tokenizer

    with open(ranks_path, "rb") as lines:
        ranks = {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, lines)}
    fast = tiktoken.Encoding("byte_bpe", pat_str=pattern, mergeable_ranks=ranks, special_tokens={})
    exact: list[Tokenizer] = []

    def encode(text: str) -> np.ndarray:
        if SPECIAL in text:
            if not exact:
                exact.append(Tokenizer.from_file(json_path))
            return np.array(exact[0].encode(text, add_special_tokens=False).ids, np.uint32)
        return np.array(fast.encode_ordinary(text), np.uint32)

    return encode


def pieces(docs: DataFrame, tokenizer: tuple[str, str, str], *, key: str = "doc_id", keep_ids: bool = True) -> DataFrame:
    """Each document's ids with END behind them, cut into pieces of SEQUENCE ids and a shorter last one.

    Columns: key, start, length, ids (little-endian unsigned 32-bit; NULL without ``keep_ids``),
    ids_crc32, doc_tokens. A NULL text is an empty one: a single piece that holds END.
    """

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = encoder(*tokenizer)
        for batch in batches:
            keys, rows = batch.column("k"), {"at": [], "start": [], "length": [], "ids": [], "crc": [], "tokens": []}
            for at, text in enumerate(batch.column("text")):
                ids = np.append(encode(text.as_py() or ""), np.uint32(END)).astype("<u4")
                for start in range(0, len(ids), SEQUENCE):
                    piece = ids[start : start + SEQUENCE].tobytes()
                    rows["at"].append(at)
                    rows["start"].append(start)
                    rows["length"].append(len(piece) // 4)
                    rows["ids"].append(piece if keep_ids else None)
                    rows["crc"].append(zlib.crc32(piece))
                    rows["tokens"].append(len(ids))
            yield pa.RecordBatch.from_arrays(
                [
                    keys.take(pa.array(rows["at"], pa.int64())),
                    pa.array(rows["start"], pa.int64()),
                    pa.array(rows["length"], pa.int64()),
                    pa.array(rows["ids"], pa.binary()),
                    pa.array(rows["crc"], pa.int64()),
                    pa.array(rows["tokens"], pa.int64()),
                ],
                [key, "start", "length", "ids", "ids_crc32", "doc_tokens"],
            )

    schema = PIECES.format(key=docs.schema[key].dataType.simpleString()).replace("doc_id", f"`{key}`", 1)
    return docs.select(F.col(key).alias("k"), "text").mapInArrow(cut, schema)


def placements(chosen: list[tuple[dict[int, int], int]]) -> list[tuple[int, int, int, int, int, int]]:
    """(size, first rank, rank behind the last, times a copy, first sequence, place there) per pattern and size."""
    out, used, sequence = [], {}, 0
    for pattern, copies in chosen:
        place = 0
        for size, times in sorted(pattern.items(), reverse=True):
            first = used.get(size, 0)
            used[size] = first + times * copies
            out.append((size, first, used[size], times, sequence, place))
            place += times
        sequence += copies
    return out


def pack(docs: DataFrame, tokenizer: tuple[str, str, str], *, key: str = "doc_id", keep_ids: bool = True) -> DataFrame:
    """The pieces of all documents, each with its sequence_id and its offset there.

    Lengths count in steps of GRAIN ids, rounded up: the linear program then has SEQUENCE / GRAIN rows,
    and a sequence loses less than GRAIN ids for each piece. Only the histogram of these sizes reaches
    the driver, where column generation chooses the patterns; pieces of one size are numbered, and the
    number decides the place. The placements are broadcast: at most SEQUENCE / GRAIN patterns and as
    many sequences for what rounding leaves, with a few sizes each, however large the input. An empty
    table gives no rows; repeated rows are packed as often as they occur.
    """
    sized = pieces(docs, tokenizer, key=key, keep_ids=keep_ids)
    cut = stored(sized.withColumn("size", F.ceil(F.col("length") / GRAIN)), "pieces")
    demand = {r["size"]: r["n"] for r in cut.groupBy("size").agg(F.count(F.lit(1)).alias("n")).collect()}
    table = docs.sparkSession.createDataFrame(
        placements(plan(demand, SEQUENCE // GRAIN)),
        "p_size long, p_first long, p_behind long, p_times long, p_sequence long, p_place long",
    )
    numbered = ranked(cut, ["size"], [key, "start", "ids_crc32"], "p_rank")
    inside = F.col("p_rank") - F.col("p_first")
    placed = numbered.join(
        F.broadcast(table),
        (F.col("size") == F.col("p_size")) & (F.col("p_rank") >= F.col("p_first")) & (F.col("p_rank") < F.col("p_behind")),
    ).select(
        key,
        "start",
        "length",
        *(["ids"] if keep_ids else []),
        "ids_crc32",
        "doc_tokens",
        (F.col("p_sequence") + F.expr("(p_rank - p_first) div p_times")).alias("sequence_id"),
        (F.col("p_place") + inside % F.col("p_times")).alias("place"),
    )
    before = Window.partitionBy("sequence_id").orderBy("place").rowsBetween(Window.unboundedPreceding, -1)
    return placed.withColumn("offset", F.coalesce(F.sum("length").over(before), F.lit(0))).drop("place")


def sequences(packed: DataFrame) -> DataFrame:
    """(sequence_id, n_tokens, ids): the token sequences themselves, unpadded, from ``pack`` with its ids."""
    parts = F.array_sort(F.collect_list(F.struct("offset", "ids")))
    return packed.groupBy("sequence_id").agg(
        F.sum("length").alias("n_tokens"),
        F.aggregate(parts, F.lit(b""), lambda done, part: F.concat(done, part["ids"])).alias("ids"),
    )


def public_tokenizer(name: str = "byte_bpe_50k") -> tuple[str, str, str]:
    """(tokenizer file, ranks file, split pattern) of an installed public tokenizer."""
    import public_tokenizers

    return public_tokenizers.path(f"{name}.json"), public_tokenizers.path(f"{name}.tiktoken"), public_tokenizers.PATTERN


def padding(sequence_tokens: Column) -> Column:
    """How many ids of padding a sequence of so many tokens needs; a power of two needs none."""
    power = F.bit_count(sequence_tokens) == 1
    return F.when(power, F.lit(0)).otherwise(F.lit(SEQUENCE) - sequence_tokens)
