"""Operator 6: prefix-partitioned suffix trees. Words in a stretch that occurs anywhere else are removed."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tabulint.llm.names import free_name
from tabulint.llm.regions import regions
from tabulint.llm.repeats import covered, runs_of
from tabulint.llm.storage import stored
from tabulint.llm.words import byte_values, gram_hash, rough_span, rough_sums, slices, spaces, word_bounds

WINDOW_WORDS = 35
GRAM_WORDS = 8
# A group of suffixes is one task's subtree up to so many bytes of text; a larger one's prefix is lengthened to the whole
# window. A task grows the subtrees of several groups together, about SHARD_BYTES of text.
GROUP_BYTES = 1 << 23
SHARD_BYTES = 1 << 20
# One in so many different runs is looked at for names of larger groups, of which there can be HOT_NAMES.
HOT_SAMPLE = 64
HOT_NAMES = 100_000


def joined_by_spaces(data: np.ndarray, start: np.ndarray, end: np.ndarray) -> tuple[memoryview, np.ndarray]:
    """(bytes, bounds): all words, each with one space behind it, and where each begins there."""
    bounds = np.r_[0, np.cumsum(end - start + 1)]
    out = np.full(bounds[-1], 0x20, np.uint8)
    inside = data[~spaces()[data]]
    out[np.arange(len(inside)) + np.repeat(np.arange(len(start)), end - start)] = inside
    return memoryview(out), bounds


def paths(docs: DataFrame, window: int, key: str) -> DataFrame:
    """(name, digest, id, first, n, inner, size): the runs of neighbouring suffixes with one name, of all texts.

    A window belongs to the run that its least gram of words names, so equal windows have one name, and
    the first prefix by which suffixes are parted is that gram. The digest is of a run's words, the size
    their bytes; ``inner`` tells that the gram occurs in the run again.
    """
    gram = min(GRAM_WORDS, window)
    names = ["name", "digest", "id", "first", "n", "inner", "size"]

    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for first, data, offsets in slices(batch.column("text")):
                start, end, row = word_bounds(data, offsets, spaces())
                word = rough_span(rough_sums(byte_values()[data]), start, end)
                bounds = np.searchsorted(row, np.arange(len(offsets)))
                got = regions(gram_hash(word, gram), window - gram + 1, bounds, window)
                if not len(got.first):
                    continue
                text, place = joined_by_spaces(data, start, end)
                a, b = place[got.first], place[got.first + got.starts + window - 1]
                digest = [hashlib.blake2b(text[x:y], digest_size=16).digest() for x, y in zip(a.tolist(), b.tolist())]
                row = np.searchsorted(bounds, got.first, "right") - 1
                numbers = [pa.array(x.astype(np.int32)) for x in (got.first - bounds[row], got.starts)]
                ids = batch.column("id").take(pa.array(first + row))
                columns = [pa.array(got.name.view(np.int64)), pa.array(digest, pa.binary()), ids, *numbers, pa.array(got.inner), pa.array((b - a).astype(np.int32))]
                yield pa.RecordBatch.from_arrays(columns, names)

    kind = docs.schema[key].dataType.simpleString()
    some = docs.filter(F.col(key).isNotNull() & F.col("text").isNotNull()).select(F.col(key).alias("id"), "text")
    return some.mapInArrow(find, f"name long, digest binary, id {kind}, first int, n int, inner boolean, size int")


def hot_names(known: DataFrame) -> DataFrame:
    """(hot): names whose different runs have more than GROUP_BYTES, as a sample of the runs tells; HOT_NAMES at most.

    They decide how runs meet and not what is found, so a name that the sample misses costs time only.
    """
    some = known.filter(F.pmod(F.xxhash64("digest"), F.lit(HOT_SAMPLE)) == 0).groupBy("name", "digest").agg(F.max("size").alias("size"))
    bytes_ = some.groupBy("name").agg(F.sum("size").alias("bytes")).filter(F.col("bytes") * HOT_SAMPLE > GROUP_BYTES)
    return bytes_.orderBy(F.desc("bytes"), "name").limit(HOT_NAMES).select(F.col("name").alias("hot"))


def grouped(known: DataFrame) -> DataFrame:
    """(name, digest, id, first, n, many, crowded): each different run of a name once, from one of its places.

    ``many`` tells that it has several places. Names with one run at one place are leaves and left out.
    ``crowded`` tells that the runs of the name have more than GROUP_BYTES in sum; those of hot names are
    not brought together to see it, so no task gets all runs of a very frequent name.
    """
    place = F.struct("id", "first")
    runs = known.groupBy("name", "digest").agg(
        F.min(place).alias("place"), F.max(place).alias("last"), F.max("n").alias("n"), F.max("inner").alias("inner"), F.max("size").alias("size")
    )
    hot = F.broadcast(stored(hot_names(known), "hot"))
    some, rest = (runs.join(hot, F.col("name") == F.col("hot"), kind) for kind in ("left_semi", "left_anti"))
    columns, many = ("name", "digest", "place.*", "n"), (F.col("place") != F.col("last")).alias("many")
    name = Window.partitionBy("name")
    rest = rest.withColumn("runs", F.count(F.lit(1)).over(name)).withColumn("bytes", F.sum("size").over(name))
    rest = rest.filter(many | F.col("inner") | (F.col("runs") > 1))
    return rest.select(*columns, many, (F.col("bytes") > GROUP_BYTES).alias("crowded")).unionByName(some.select(*columns, many, F.lit(True).alias("crowded")))


def with_words(docs: DataFrame, runs: DataFrame, window: int, key: str) -> DataFrame:
    """(name, digest, n, many, crowded, body) of ``runs``: with their words, joined by spaces; again for each repeated row."""
    wanted = runs.groupBy("id").agg(F.collect_list(F.struct("name", "digest", "first", "n", "many", "crowded")).alias("runs"))
    texts = docs.select(F.col(key).alias("of"), "text").join(wanted, F.col("of") == F.col("id")).select("text", "runs")
    names = ["name", "digest", "n", "many", "crowded"]

    def fetch(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                rows = batch.column("runs")[i].values
                data = np.frombuffer(batch.column("text")[i].as_buffer(), np.uint8)
                start, end, _ = word_bounds(data, np.array([0, len(data)]), spaces())
                text, place = joined_by_spaces(data, start, end)
                first, n = (rows.field(c).to_numpy().astype(np.int64) for c in ("first", "n"))
                stop = first + n + window - 1
                fits = stop < len(place)  # a repeated key with another text has not all of them
                body = [bytes(text[a:b]) for a, b in zip(place[first[fits]].tolist(), place[stop[fits]].tolist())]
                columns = [rows.field(c).filter(pa.array(fits)) for c in names]
                yield pa.RecordBatch.from_arrays([*columns, pa.array(body, pa.binary())], [*names, "body"])

    schema = "name long, digest binary, n int, many boolean, crowded boolean, body binary"
    return texts.mapInArrow(fetch, schema)


def sorted_suffixes(roots: np.ndarray, starts: np.ndarray, words: np.ndarray, depth: int) -> tuple[np.ndarray, np.ndarray]:
    """(order, shared): the suffixes by root and then by their first ``depth`` words, and how many of these each shares with the one before.

    ``shared`` is -1 where another root begins.
    """
    rows = np.empty((len(starts), depth + 1), ">u4")
    rows[:, 0] = roots
    rows[:, 1:] = words[starts[:, None] + np.arange(depth)]
    order = np.argsort(rows.view(f"S{4 * (depth + 1)}").ravel(), kind="stable")
    rows = rows[order]
    equal = rows[1:] == rows[:-1]
    shared = np.where(equal.all(axis=1), depth + 1, np.argmin(equal, axis=1)) - 1
    return order, np.r_[-1, shared] if len(order) else shared


def deep_nodes(shared: np.ndarray, depth: int) -> tuple[np.ndarray, np.ndarray]:
    """(first, behind the last): the runs of sorted suffixes below the nodes of the tree that are ``depth`` words deep."""
    begins = np.flatnonzero(shared < depth)
    return begins, np.r_[begins[1:], len(shared)]


def repeated_starts(names: list[int], n: np.ndarray, many: np.ndarray, bodies: list[bytes], window: int) -> np.ndarray:
    """Flags the suffixes, run after run, whose first ``window`` words have several places.

    Each name is the root of a subtree of the suffixes of its runs. A node ``window`` words deep with
    several suffixes, or with one of a run that has several places, spells a sequence that is repeated.
    """
    number: dict[bytes, int] = {}
    words = [[number.setdefault(w, len(number)) for w in body.split(b" ")[:-1]] for body in bodies]
    sizes = np.array([len(w) for w in words])
    roots: dict[int, int] = {}
    root = np.array([roots.setdefault(name, len(roots)) for name in names])
    begins = np.cumsum(sizes) - sizes
    run = np.repeat(np.arange(len(n)), n)
    starts = begins[run] + np.arange(len(run)) - np.repeat(np.cumsum(n) - n, n)
    order, shared = sorted_suffixes(root[run], starts, np.array([w for part in words for w in part]), window)
    first, behind = deep_nodes(shared, window)
    repeated = np.add.reduceat(1 + many[run][order].astype(np.int64), first) > 1
    flags = np.zeros(len(run), bool)
    flags[order] = np.repeat(repeated, behind - first)
    return flags


FLAGGED = "name long, digest binary, runs array<struct<first:int,n:int>>"


def flagged(name: list, digest: list, n: np.ndarray, flags: np.ndarray) -> pa.RecordBatch:
    """FLAGGED rows: the runs of flags of each run of suffixes that has some."""
    run = np.repeat(np.arange(len(n)), n)
    start = np.arange(len(run)) - np.repeat(np.cumsum(n) - n, n)
    new = np.r_[True, run[1:] != run[:-1]]
    begins = np.flatnonzero(flags & (new | np.r_[True, ~flags[:-1]]))
    ends = np.flatnonzero(flags & np.r_[new[1:] | ~flags[1:], True])
    some = np.unique(run[begins])
    offsets = np.r_[np.searchsorted(run[begins], some), len(begins)]
    pairs = pa.StructArray.from_arrays([pa.array(x.astype(np.int32)) for x in (start[begins], ends - begins + 1)], ["first", "n"])
    lists = pa.ListArray.from_arrays(pa.array(offsets.astype(np.int32)), pairs)
    return pa.RecordBatch.from_arrays([pa.array([name[i] for i in some], pa.int64()), pa.array([digest[i] for i in some], pa.binary()), lists], ["name", "digest", "runs"])


def subtrees(texts: DataFrame, window: int) -> DataFrame:
    """FLAGGED rows of the groups that fit a task: whole groups, sorted, about SHARD_BYTES of them at a time."""

    def grow(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple] = []
        size = 0
        for batch in batches:
            for row in zip(*(batch.column(c).to_pylist() for c in ("name", "digest", "n", "many", "body"))):
                if held and row[:2] == held[-1][:2]:
                    continue
                if size >= SHARD_BYTES and row[0] != held[-1][0]:
                    yield closed(held)
                    held, size = [], 0
                held.append(row)
                size += len(row[4])
        if held:
            yield closed(held)

    def closed(held: list[tuple]) -> pa.RecordBatch:
        name, digest, n, many, body = zip(*held)
        n = np.array(n)
        return flagged(name, digest, n, repeated_starts(name, n, np.array(many), body, window))

    whole = texts.filter("NOT crowded").drop("crowded")
    return whole.repartition("name").sortWithinPartitions("name", "digest").mapInArrow(grow, FLAGGED)


def crowded_suffixes(texts: DataFrame, window: int) -> DataFrame:
    """FLAGGED rows of the larger groups, whose prefix is the whole window, so that each is one node.

    Its suffixes are counted before the shuffle, so however many there are, a task sends one row for them.
    """

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i, (n, body) in enumerate(zip(batch.column("n").to_pylist(), batch.column("body"))):
                data = np.frombuffer(body.as_buffer(), np.uint8)
                bounds = np.r_[0, np.flatnonzero(data == 0x20) + 1]
                text = memoryview(data)
                found = [hashlib.blake2b(text[a:b], digest_size=16).digest() for a, b in zip(bounds[:n].tolist(), bounds[window : window + n].tolist())]
                at = pa.array(np.full(n, i))
                columns = [pa.array(found, pa.binary()), *(batch.column(c).take(at) for c in ("name", "digest", "many")), pa.array(np.arange(n, dtype=np.int32))]
                yield pa.RecordBatch.from_arrays(columns, ["prefix", "name", "digest", "many", "first"])

    suffixes = texts.filter("crowded").select("name", "digest", "n", "many", "body").dropDuplicates(["name", "digest"])
    suffixes = stored(suffixes.mapInArrow(cut, "prefix binary, name long, digest binary, many boolean, first int"), "suffixes")
    nodes = suffixes.groupBy("prefix").agg(F.sum(F.col("many").cast("int") + 1).alias("places")).filter("places > 1").select("prefix")
    found = suffixes.join(nodes, "prefix").groupBy("name", "digest")
    return found.agg(F.collect_list(F.struct("first", F.lit(1).alias("n"))).alias("runs"))


def runs_to_remove(docs: DataFrame, window: int, key: str) -> DataFrame:
    """(id, runs): for each document that loses something, its runs (first, n) of window starts that go."""
    known = stored(paths(docs, window, key), "paths")
    texts = stored(with_words(docs, grouped(known), window, key), "texts")
    found = stored(subtrees(texts, window).unionByName(crowded_suffixes(texts, window)), "flagged")
    places = known.select("name", "digest", "id", F.col("first").alias("begin")).join(found, ["name", "digest"])
    runs = places.select("id", F.transform("runs", lambda r: F.struct((F.col("begin") + r["first"]).cast("long").alias("first"), r["n"].cast("long").alias("n"))).alias("runs"))
    return runs.groupBy("id").agg(F.flatten(F.collect_list("runs")).alias("runs"))


def drop_repeated_words(docs: DataFrame, *, key: str = "doc_id", window: int = WINDOW_WORDS) -> DataFrame:
    """``docs`` with kept_text (the words that stay, joined by one space), n_words and n_removed.

    Words are runs of characters other than space, tab, line feed, vertical tab, form feed and carriage
    return. A word goes if ``window`` consecutive words of its document cover it whose sequence also
    starts anywhere else, in the same document too; all occurrences go. Sequences are judged on the
    input. A NULL text has no words; a text of fewer words than ``window`` stays whole, as does one whose
    key is NULL. Rows that repeat a document, key and text, count as one document; different texts need
    different keys. Columns that have the new names are replaced.
    """
    docs = docs.drop("kept_text", "n_words", "n_removed")
    of, gone_at = free_name(docs, "__of"), free_name(docs, "__runs")
    gone = runs_to_remove(docs, window, key).toDF(of, gone_at)

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            kept, sizes, removed = [], [], []
            for i, text in enumerate(batch.column("text")):
                words = (text.as_py() or "").encode().split()
                first, n = runs_of(batch, i, gone_at)
                away = covered(len(words), first, n, window)
                kept.append(b" ".join([w for w, a in zip(words, away) if not a]) if len(first) else b" ".join(words))
                sizes.append(len(words))
                removed.append(int(away.sum()))
            others = batch.drop_columns([gone_at])
            yield pa.RecordBatch.from_arrays(
                [*others.columns, pa.array(kept, pa.binary()).cast(pa.string()), pa.array(sizes, pa.int64()), pa.array(removed, pa.int64())],
                [*others.schema.names, "kept_text", "n_words", "n_removed"],
            )

    added = T.StructType([*docs.schema.fields]).add("kept_text", "string").add("n_words", "long").add("n_removed", "long")
    joined = docs.join(gone, docs[key] == gone[of], "left").select(*[docs[c] for c in docs.columns], gone[gone_at])
    return joined.mapInArrow(cut, added)


def digests(deduped: DataFrame, key: str = "doc_id") -> DataFrame:
    """(key, n_words, n_removed, kept_sha256) of what ``drop_repeated_words`` gives."""
    return deduped.select(key, "n_words", "n_removed", F.sha2(F.col("kept_text").cast("binary"), 256).alias("kept_sha256"))
