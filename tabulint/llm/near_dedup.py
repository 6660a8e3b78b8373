"""Operator 1: near-duplicate groups by banded consistent weighted samples, verified by weighted Jaccard similarity."""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tabulint.llm import weighted_minhash as wm
from tabulint.llm.components import components
from tabulint.llm.ranking import ranked
from tabulint.llm.storage import stored

# The columns of one of two members, by name.
Side = Callable[[str], Column]

THRESHOLD = 0.8
PIVOT_GROWTH = 32
# Parts of the hash space in which shared weights are compared: a power of two.
CHUNKS = 32
# A group of copies counts as one document in document frequencies if one document in GROUPS belongs to it.
GROUPS = 1000
# The weight that marks a shingle as shared, and what sums of weights may differ by.
SHARED = -1.0
ROUNDING = 1e-3


def copy_groups(docs: DataFrame) -> dict[int, int]:
    """Group band -> number of documents, of those that one document in GROUPS has at least.

    Fewer than GROUPS times GROUP_BANDS numbers can be, however many documents there are.
    """

    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            parts = [wm.group_bands(found).ravel() for _, found in wm.shingles(batch.column(0))]
            if parts:
                band, n = np.unique(np.concatenate(parts), return_counts=True)
                yield pa.RecordBatch.from_arrays([pa.array(band.view(np.int64)), pa.array(n)], ["band", "n"])

    some = docs.select("text").filter(F.col("text").isNotNull())
    counts = some.mapInArrow(find, "band long, n long").groupBy("band").agg(F.sum("n").alias("n"))
    least = max(2, -(-some.count() // GROUPS))
    return {r.band: r.n for r in counts.filter(F.col("n") >= least).collect()}


def frequency_weights(docs: DataFrame) -> np.ndarray:
    """The inverse document frequency by sketch cell, over all documents.

    Each task adds up its own sketch; the sum of all has a fixed size, SKETCH_ROWS times 2**SKETCH_BITS
    cells, and tells how large a share of the documents has a shingle, to within a share that does not
    grow with their number. The documents of a large group of copies count as one together, so that
    what they share keeps its weight however many they are.
    """
    sent = docs.sparkSession.sparkContext.broadcast(copy_groups(docs))

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cells = np.zeros((wm.SKETCH_ROWS, 1 << wm.SKETCH_BITS))
        documents, groups = 0.0, sent.value
        for batch in batches:
            for _, found in wm.shingles(batch.column(0)):
                share = np.array([1 / max(groups.get(b, 1) for b in row) for row in wm.group_bands(found).view(np.int64).tolist()])
                documents += float(share.sum())
                sizes = np.diff(found.starts)
                by_shingle = np.repeat(share, sizes[sizes > 0])
                for i, c in enumerate(wm.cells(found.hashes)):
                    cells[i] += np.bincount(c, weights=by_shingle, minlength=1 << wm.SKETCH_BITS)
        if documents:
            blocks = cells.reshape(-1, wm.BLOCK)
            yield block_batch([-1, *range(len(blocks))], [np.array([documents]), *blocks])

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[int, np.ndarray] = {}
        for batch in batches:
            for number, part in zip(batch.column(0).to_pylist(), batch.column(1)):
                counts = read(part.as_buffer(), number)
                sums[number] = sums[number] + counts if number in sums else counts
        if sums:
            yield block_batch(list(sums), list(sums.values()))

    def block_batch(numbers: list[int], blocks: list[np.ndarray]) -> pa.RecordBatch:
        values = [narrow(b).tobytes() for b in blocks]
        return pa.RecordBatch.from_arrays([pa.array(numbers, pa.int32()), pa.array(values, pa.binary())], ["block", "counts"])

    def narrow(counts: np.ndarray) -> np.ndarray:
        """The counters of a block in one byte each where they are small whole numbers, else in eight."""
        return counts.astype(np.uint8) if counts.max() < 256 and (counts == np.floor(counts)).all() else counts

    def read(counts: pa.Buffer, number: int) -> np.ndarray:
        one_byte = len(counts) == (1 if number < 0 else wm.BLOCK)
        return np.frombuffer(counts, np.uint8 if one_byte else np.float64).astype(np.float64)

    schema = "block int, counts binary"
    parts = docs.select("text").mapInArrow(count, schema)
    total = {r.block: read(r.counts, r.block) for r in parts.repartition("block").mapInArrow(add, schema).collect()}
    if not total:
        return np.ones((wm.SKETCH_ROWS, 1 << wm.SKETCH_BITS), np.float32)
    documents = float(total.pop(-1)[0])
    counts = np.concatenate([total[i] for i in sorted(total)]).reshape(wm.SKETCH_ROWS, -1)
    return wm.inverse_frequency(counts, documents)


def signatures(docs: DataFrame, table: np.ndarray, key: str) -> DataFrame:
    """(id, digest, bands): bands are NULL for a text without words, the digest for a NULL text too."""
    sent = docs.sparkSession.sparkContext.broadcast(table)

    def sign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sampler = wm.Sampler()
        for batch in batches:
            digests, bands = [], []
            for first, found in wm.shingles(batch.column("text")):
                numbers = sampler.bands(found, wm.weights(found, sent.value)).astype(np.int64)
                for i, row in enumerate(numbers):
                    some = found.starts[i] < found.starts[i + 1]
                    text = batch.column("text")[first + i]
                    if some:
                        digests.append(wm.digest(found, i))
                    else:
                        digests.append(hashlib.md5(text.as_py().encode()).digest() if text.is_valid else None)
                    bands.append(row.tolist() if some else None)
            yield pa.RecordBatch.from_arrays([batch.column("id"), pa.array(digests, pa.binary()), pa.array(bands, pa.list_(pa.int64()))], ["id", "digest", "bands"])

    kind = docs.schema[key].dataType.simpleString()
    return docs.select(F.col(key).alias("id"), "text").mapInArrow(sign, f"id {kind}, digest binary, bands array<bigint>")


def features(docs: DataFrame, wanted: DataFrame, table: np.ndarray, key: str) -> DataFrame:
    """(node, hashes, weights, total, sums) of the ``wanted`` (id, node), from the text of one document each.

    ``sums`` has the weight in each of CHUNKS parts of the hash space.
    """
    sent = docs.sparkSession.sparkContext.broadcast(table)

    def weigh(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for first, found in wm.shingles(batch.column("text")):
                rows = []
                weight = wm.weights(found, sent.value)
                for i, (a, b) in enumerate(zip(found.starts[:-1], found.starts[1:])):
                    if wm.digest(found, i) == batch.column("node")[first + i].as_py():
                        part = weight[a:b]
                        sums = np.bincount(chunk_of(found.hashes[a:b]), weights=part, minlength=CHUNKS)
                        rows.append((first + i, found.hashes[a:b].tobytes(), part.tobytes(), float(sums.sum()), sums))
                if rows:
                    at, hashes, values, totals, sums = zip(*rows)
                    columns = [batch.column("node").take(pa.array(at)), pa.array(hashes), pa.array(values), pa.array(totals)]
                    columns.append(pa.array([s.tolist() for s in sums], pa.list_(pa.float64())))
                    yield pa.RecordBatch.from_arrays(columns, ["node", "hashes", "weights", "total", "sums"])

    texts = docs.select(F.col(key).alias("of"), "text").join(wanted, F.col("of").eqNullSafe(F.col("id")))
    found = texts.select("node", "text").mapInArrow(weigh, "node binary, hashes binary, weights binary, total double, sums array<double>")
    return found.dropDuplicates(["node"])


def chunk_of(hashes: np.ndarray) -> np.ndarray:
    return (hashes >> np.uint64(20)).astype(np.int64) & (CHUNKS - 1)


def shared_weights(feats: DataFrame) -> DataFrame:
    """(node, total, shared, s): the weight of all shingles, and of those that any other node has.

    ``s`` has the latter by CHUNKS parts of the hash space.

    A shingle that a batch holds twice is known to be shared and sent once, without its nodes; so
    however many nodes have a shingle, few rows of it meet.
    """
    parts = 8 * int(feats.sparkSession.conf.get("spark.sql.shuffle.partitions"))

    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            hashes = [np.frombuffer(x.as_buffer(), np.uint64) for x in batch.column("hashes")]
            if not hashes:
                continue
            node = np.repeat(np.arange(len(hashes)), [len(x) for x in hashes])
            weight = np.concatenate([np.frombuffer(x.as_buffer(), np.float32) for x in batch.column("weights")])
            found, first, times = np.unique(np.concatenate(hashes), return_index=True, return_counts=True)
            names = np.frombuffer(b"".join(batch.column("node").to_pylist()), "V16")[node[first]]
            weight = np.where(times == 1, weight[first], SHARED).astype(np.float32)
            part = ((found >> np.uint64(32)) % np.uint64(parts)).astype(np.int64)
            order = np.argsort(part, kind="stable")
            cuts = np.searchsorted(part[order], np.arange(parts + 1))
            rows = [(p, order[a:b]) for p, (a, b) in enumerate(zip(cuts[:-1], cuts[1:])) if b > a]
            blobs = [pa.array([x[at].tobytes() for _, at in rows], pa.binary()) for x in (found, names, weight)]
            yield pa.RecordBatch.from_arrays([pa.array([p for p, _ in rows], pa.int32()), *blobs], ["part", "hashes", "nodes", "weights"])

    def alone(part: pa.Table) -> pa.Table:
        hashes, nodes, weight = (
            np.frombuffer(b"".join(part.column(c).to_pylist()), kind)
            for c, kind in (("hashes", np.uint64), ("nodes", "S16"), ("weights", np.float32))
        )
        _, first, times = np.unique(hashes, return_index=True, return_counts=True)
        single = first[(times == 1) & (weight[first] != SHARED)]
        names, place = np.unique(nodes[single], return_inverse=True)
        cells = place * CHUNKS + chunk_of(hashes[single])
        sums = np.bincount(cells, weights=weight[single], minlength=len(names) * CHUNKS)
        some = np.flatnonzero(sums)
        whole = [names[i].ljust(16, b"\0") for i in some // CHUNKS]
        columns = {"node": pa.array(whole, pa.binary()), "chunk": pa.array((some % CHUNKS).astype(np.int32)), "alone": pa.array(sums[some], pa.float64())}
        return pa.table(columns)

    dealt = feats.select("node", "hashes", "weights").mapInArrow(deal, "part int, hashes binary, nodes binary, weights binary")
    single = dealt.groupBy("part").applyInArrow(alone, "node binary, chunk int, alone double")
    by_chunk = [F.sum(F.when(F.col("chunk") == c, F.col("alone")).otherwise(0.0)) for c in range(CHUNKS)]
    single = single.groupBy("node").agg(F.sum("alone").alias("alone"), F.array(*by_chunk).alias("by_chunk"))
    joined = feats.select("node", "total", "sums").join(single, "node", "left")
    shared = F.when(F.col("alone").isNull(), F.col("sums")).otherwise(F.zip_with("sums", "by_chunk", lambda x, y: x - y))
    return joined.select("node", "total", (F.col("total") - F.coalesce("alone", F.lit(0.0))).alias("shared"), shared.alias("s"))


def may_link(threshold: float) -> Callable[[Side, Side], Column]:
    """Whether two members of a bucket are to be compared here.

    They are if they can be similar enough: what both have in common is in each chunk at most what
    either shares with any node. And they are compared only in the first band they have in common.
    """

    def may(own: Side, other: Side) -> Column:
        shared = F.aggregate(F.zip_with(own("s"), other("s"), lambda x, y: F.least(x, y)), F.lit(0.0), lambda x, y: x + y)
        enough = shared * (1 + threshold) >= (own("total") + other("total")) * threshold - ROUNDING
        before = F.zip_with(F.slice(own("bands"), F.lit(1), own("band")), F.slice(other("bands"), F.lit(1), own("band")), lambda x, y: x == y)
        return enough & ~F.array_contains(before, True)

    return may


def verified(pairs: DataFrame, feats: DataFrame, threshold: float) -> DataFrame:
    """The ``pairs`` (a, b) whose weighted Jaccard similarity is at least ``threshold``, with it."""

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            columns = [batch.column(c) for c in ("ha", "wa", "ta", "hb", "wb", "tb")]
            likeness = [wm.similarity((ha, wa, ta), (hb, wb, tb)) for ha, wa, ta, hb, wb, tb in zip(*(buffers(c) for c in columns))]
            yield pa.RecordBatch.from_arrays([batch.column("a"), batch.column("b"), pa.array(likeness, pa.float64())], ["a", "b", "similarity"])

    def buffers(column: pa.Array) -> Iterator:
        return (v.as_py() if pa.types.is_floating(column.type) else v.as_buffer() for v in column)

    blobs = feats.drop("sums")
    both = pairs.join(blobs.toDF("b", "hb", "wb", "tb"), "b").join(blobs.toDF("a", "ha", "wa", "ta"), "a")
    schema = "a binary, b binary, similarity double"
    return both.select("a", "b", "ha", "wa", "ta", "hb", "wb", "tb").mapInArrow(compare, schema).filter(F.col("similarity") >= threshold)


def near_classes(
    members: DataFrame, verify: Callable[[DataFrame], DataFrame], may: Callable[[Side, Side], Column] | None = None
) -> DataFrame:
    """(node, label) of the nodes that verified links connect with others, the label being the least node of the class.

    ``members`` is (bucket, node, place), places from 0 without gaps and in one order of nodes in all buckets;
    ``verify`` keeps of pairs (a, b) those that are links. In a round the next few places of
    a bucket, the pivots, meet the members behind them that are not yet in their class. First every
    member tries the foremost pivot of all its buckets, so that a group of like texts is one class after one
    link for each member; then the pairs that still are in two classes follow. Only members that stay
    apart go on. Every pair of a bucket is compared unless links already join the two or
    ``may``, of their further columns, says that this is not needed.
    """
    labels, first, width = None, 0, 1
    while True:
        now = labelled(members, labels)
        ends = now.groupBy("bucket").agg(F.max("place").alias("top"), F.min("label").alias("x"), F.max("label").alias("y"))
        open_buckets = ends.filter((F.col("x") != F.col("y")) & (F.col("top") > first)).select("bucket")
        now = stored(now.join(open_buckets, "bucket"), "open")
        members = now.drop("label")
        if now.isEmpty():
            return labels if labels is not None else members.select("node", F.col("node").alias("label")).limit(0)
        pivots = now.filter(F.col("place").between(first, first + width - 1)).select(
            "bucket", F.col("node").alias("a"), *(F.col(c).alias(f"a_{c}") for c in now.columns if c not in ("bucket", "node"))
        )
        apart = (F.col("place") > F.col("a_place")) & (F.col("label") != F.col("a_label"))
        if may is not None:
            apart &= may(F.col, lambda name: F.col(f"a_{name}"))
        met = now.join(pivots, "bucket").filter(apart)
        pairs = stored(met.groupBy("a", F.col("node").alias("b")).agg(F.min("a_place").alias("place")), "pairs")
        foremost = stored(pairs.groupBy("b").agg(F.min(F.struct("place", "a")).alias("top")).select("top.a", "b"), "foremost")
        labels = united(labels, verify(foremost))
        others = pairs.join(foremost, ["a", "b"], "left_anti").select(F.col("a").alias("node"), "b")
        others = labelled(others, labels).select(F.col("node").alias("a"), F.col("b").alias("node"), F.col("label").alias("a_label"))
        others = labelled(others, labels).filter("label <> a_label").select("a", F.col("node").alias("b"))
        labels = united(labels, verify(stored(others, "others")))
        first, width = first + width, width * PIVOT_GROWTH


def labelled(rows: DataFrame, labels: DataFrame | None) -> DataFrame:
    """``rows`` with the label of their node, which is the node itself where no link is known."""
    if labels is None:
        return rows.withColumn("label", F.col("node"))
    return rows.join(labels, "node", "left").withColumn("label", F.coalesce("label", "node"))


def united(labels: DataFrame | None, links: DataFrame) -> DataFrame | None:
    """``labels`` after the classes that ``links`` (a, b) connect are one: components of classes, one link for two of them."""
    links = stored(links.select("a", "b"), "near")
    if links.isEmpty():
        return labels
    if labels is None:
        return components(links)
    ends = labelled(links.select(F.col("a").alias("node"), "b"), labels).select(F.col("b").alias("node"), F.col("label").alias("a"))
    classes = labelled(ends, labels).select("a", F.col("label").alias("b")).filter("a <> b").distinct()
    joined = components(classes).select(F.col("node").alias("was"), F.col("label").alias("now"))
    moved = labels.join(joined, labels["label"] == joined["was"], "left").select("node", F.coalesce("now", "label").alias("label"))
    new = joined.join(labels, joined["was"] == labels["node"], "left_anti").select(F.col("was").alias("node"), F.col("now").alias("label"))
    return stored(moved.unionByName(new), "labels")


def near_duplicates(docs: DataFrame, *, key: str = "doc_id", threshold: float = THRESHOLD) -> DataFrame:
    """(key, class_id, class_size): each document's class, named by the least key in it.

    Two texts are linked if the weighted Jaccard similarity of their TF-IDF shingles of five words is
    at least ``threshold`` and they share a band of samples, which a pair at the threshold misses less
    than once in a thousand times; a class is what links connect. Texts with the same shingles are one
    node whatever their number, so copies cost one row each. Equal texts without any word are one
    class; a NULL text is a class of its own for each key; a class of one is its own key. Repeated rows
    come out as often as they come in.
    """
    table = frequency_weights(docs)
    signed = stored(signatures(docs, table, key), "signatures")
    nodes = signed.filter("bands IS NOT NULL").groupBy(F.col("digest").alias("node")).agg(
        F.min("id").alias("id"), F.first("bands").alias("bands")
    )
    entries = stored(nodes.select("node", "id", "bands", F.posexplode("bands").alias("band", "value")), "bands")
    bucket = [F.col("band"), F.col("value")]
    shared = entries.groupBy(*bucket).agg(F.count(F.lit(1)).alias("n")).filter("n > 1").drop("n")
    members = entries.join(shared, ["band", "value"]).withColumn("bucket", F.xxhash64(*bucket)).drop("value")
    members = stored(members, "members")
    wanted = members.select("id", "node").distinct()
    feats = stored(features(docs, wanted, table, key), "features")
    able = shared_weights(feats).filter(F.col("shared") >= F.lit(threshold) * F.col("total") - ROUNDING)
    members = stored(members.drop("id").join(able, "node"), "members")
    # texts with little of their own come first: they are like the most others
    own = F.floor((1 - F.col("shared") / F.col("total")) * 64)
    places = stored(ranked(members, ["bucket"], ["node"], "place", before=own), "places")
    labels = near_classes(places.drop("shared"), lambda pairs: verified(pairs, feats, threshold), may_link(threshold))
    signed = signed.join(labels, signed["digest"] == labels["node"], "left").withColumn("label", F.coalesce("label", "digest"))
    names = signed.filter("label IS NOT NULL").groupBy(F.col("label").alias("of")).agg(F.min("id").alias("class_id"), F.count(F.lit(1)).alias("n"))
    return signed.join(names, signed["label"] == names["of"], "left").select(
        F.col("id").alias(key), F.coalesce("class_id", "id").alias("class_id"), F.coalesce("n", F.lit(1)).alias("class_size")
    )


def one_of_each_class(docs: DataFrame, *, key: str = "doc_id", threshold: float = THRESHOLD) -> DataFrame:
    """``docs`` with the least key of each class only; of repeated rows one stays, and a NULL text stays."""
    classes = near_duplicates(docs, key=key, threshold=threshold)
    kept = classes.filter(F.col(key).eqNullSafe(F.col("class_id"))).select(F.col(key).alias("__key")).distinct()
    return docs.join(kept, docs[key].eqNullSafe(kept["__key"]), "left_semi").dropDuplicates([key, "text"])
