"""Operator 2: rare n-gram seeds join passages to benchmark items; Smith-Waterman alignment scores them."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.broadcast import Broadcast
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tabulint.llm.storage import stored
from tabulint.llm.words import character_kinds, mixed, not_letters, prefix_hash, slices, span_hash, word_bounds

MATCH, MISMATCH, GAP = 2, -1, -1
THRESHOLD = 0.5
# A seed is two words in order, at most so many places apart in the item and in the text.
REACH = 3
# At so many of an item's seed places a text has to have a seed, where as many are sure to be in common.
SEED_PLACES = 3
# Two tables of so many bits keep documents' grams from the shuffle that no item has.
FILTER_BITS = 22
ROUNDING = 1e-9
# Items whose words a task keeps for the next texts.
KNOWN_ITEMS = 1 << 14
SINGLE, FORMER = np.uint64(0x5851F42D4C957F2D), np.uint64(0xD1342543DE82EF95)


def word_slices(column: pa.Array) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """(first row, number of rows, hashes of all words, row of each) of slices of a text column.

    Words are runs of digits and letters, and single characters of scripts without spaces, in lower case.
    """
    parts = not_letters()
    for first, data, offsets in slices(pc.utf8_lower(column)):
        start, end, row = word_bounds(data, offsets, parts, character_kinds())
        yield first, len(offsets) - 1, span_hash(prefix_hash(data), start, end), first + row


def rows(column: pa.Array) -> Iterator[tuple[int, np.ndarray]]:
    """(row number, hashes of its words) of the rows that have words."""
    for first, n, word, row in word_slices(column):
        bounds = np.searchsorted(row, np.arange(first, first + n + 1))
        for i in np.flatnonzero(np.diff(bounds)).tolist():
            yield first + i, word[bounds[i] : bounds[i + 1]]


def single_grams(words: np.ndarray) -> np.ndarray:
    return mixed(words + SINGLE)


def pair_grams(words: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(place of the first word, gram) of all pairs of words at most REACH places apart."""
    former = mixed(words) * FORMER
    places = [np.arange(max(len(words) - d, 0)) for d in range(1, REACH + 1)]
    grams = [mixed(former[: len(at)] + words[d : d + len(at)]) for d, at in enumerate(places, start=1)]
    return np.concatenate(places), np.concatenate(grams)


def item_grams(words: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(place, gram) of the pairs of an item; an item of one word has that word."""
    return pair_grams(words) if len(words) > 1 else (np.zeros(1, np.int64), single_grams(words))


def least_matches(size: int, threshold: float) -> int:
    """How many words of an item an alignment has to match for ``threshold``: a match scores most, all else costs."""
    return max(int(np.ceil(threshold * size - ROUNDING)), 1)


def longest_passage(size: int, threshold: float) -> int:
    """How many words of a text an alignment can take up that reaches ``threshold``.

    Beside the item's words there are at most as many others as their cost leaves of the score.
    """
    return size + int(np.floor(MATCH * size * (1 - max(threshold, 0)) / -max(MISMATCH, GAP) + ROUNDING))


def places_in_common(size: int, threshold: float) -> int:
    """At how many places of an item, at least, a text has a pair of the item that reaches ``threshold`` with it.

    An alignment of m matches has score left for e = MATCH * (m - threshold * size) errors at most. Of the
    m - 1 pairs of neighbouring matches at most e / REACH have REACH errors between them; the others'
    words stand at most REACH places apart on both sides.
    """
    m = np.arange(least_matches(size, threshold), size + 1)
    errors = np.floor(MATCH * (m - threshold * size) / -max(MISMATCH, GAP) + ROUNDING)
    return int((m - 1 - np.floor(errors / REACH)).min(initial=size))


def seeds(place: np.ndarray, held: np.ndarray, size: int, threshold: float) -> tuple[np.ndarray, int]:
    """(chosen grams, places needed): the places of an item whose grams the fewest documents hold, and at how many a text has to hit.

    Of size - 1 places a text has places_in_common at least, so of any size - 1 - places_in_common + n it
    has n. Where there need be none in common, a text has to hold the whole item, and any place will do.
    """
    common = places_in_common(size, threshold)
    needed = min(common, SEED_PLACES) if common > 0 else 1
    wanted = size - 1 - common + needed if common > 0 else 1
    chosen = np.argsort(np.bincount(place, weights=held), kind="stable")[:wanted]
    return np.flatnonzero(np.isin(place, chosen)), needed


def align(item: np.ndarray, text: np.ndarray) -> tuple[int, int]:
    """(score, end) of the best local alignment of two word sequences: Smith-Waterman with linear gaps.

    A whole row of the table is computed at once; gaps along the row are a running maximum.
    """
    ramp = np.arange(len(text) + 1, dtype=np.int64) * GAP
    above = np.zeros(len(text) + 1, np.int64)
    best, end = 0, 0
    for word in item:
        row = np.zeros(len(text) + 1, np.int64)
        np.maximum(above[:-1] + np.where(text == word, MATCH, MISMATCH), above[1:] + GAP, out=row[1:])
        np.maximum(row, 0, out=row)
        row = np.maximum.accumulate(row - ramp) + ramp
        top = int(row.argmax())
        if row[top] > best:
            best, end = int(row[top]), top
        above = row
    return best, end


def least_within(x: np.ndarray, low: np.ndarray, high: np.ndarray) -> np.ndarray:
    """The least of ``x`` from each ``low`` to its ``high``, both included."""
    out = np.empty(len(low), x.dtype)
    level = np.frexp(high - low + 1)[1] - 1
    for k in range(int(level.max(initial=-1)) + 1):
        some = level == k
        out[some] = np.minimum(x[low[some]], x[high[some] - (1 << k) + 1])
        x = np.minimum(x[: -(1 << k)], x[1 << k :])
    return out


def stretches(item: np.ndarray, text: np.ndarray, threshold: float) -> Iterator[tuple[int, int]]:
    """The stretches of the text that hold all its alignments of the threshold with the item.

    A word of the text that the item has adds at most a match, any other costs a gap or a mismatch;
    the best sum that ends at a word, over as many words as an alignment can take up, bounds the
    score of all alignments that end there.
    """
    own = np.unique(item)
    at = np.flatnonzero(own[np.minimum(np.searchsorted(own, text), len(own) - 1)] == text)
    needed, reach, drop = least_matches(len(item), threshold), longest_passage(len(item), threshold), max(MISMATCH, GAP)
    begin = np.searchsorted(at, at - reach + 1)
    last = np.flatnonzero(np.arange(len(at)) - begin >= needed - 1)
    sums = (MATCH - drop) * np.arange(len(at)) + drop * at
    bound = sums[last] - least_within(sums, begin[last], last) + MATCH
    ends = at[last[bound >= threshold * MATCH * len(item) - ROUNDING]]
    if len(ends):
        for part in np.split(ends, np.flatnonzero(np.diff(ends) >= reach) + 1):
            yield max(0, int(part[0]) - reach + 1), int(part[-1]) + 1


class Text:
    """A text that items are compared with; the grams of its pairs are sorted once."""

    def __init__(self, words: np.ndarray) -> None:
        self.words = words
        self.pairs = np.unique(pair_grams(words)[1])

    def score(self, item: np.ndarray, threshold: float) -> tuple[float, int, int] | None:
        """(score, word behind the passage, places in common) if the text holds the item, whole or edited.

        Only a text with enough places in common is aligned, where the item's words are dense enough.
        """
        common = places_in_common(len(item), threshold)
        place, gram = item_grams(item)
        if len(item) > 1:
            found = self.pairs[np.minimum(np.searchsorted(self.pairs, gram), len(self.pairs) - 1)] == gram if len(self.pairs) else np.zeros(len(gram), bool)
            places = len(np.unique(place[found]))
            if places < max(common, 1):
                return None
        else:
            places = 1
        best, end = 0, 0
        for a, b in stretches(item, self.words, threshold):
            score, behind = align(item, self.words[a:b])
            if score > best:
                best, end = score, a + behind
        likeness = best / (MATCH * len(item))
        return (likeness, end, places) if likeness >= (threshold if common > 0 else 1) else None


class Filter:
    """Two tables of bits, of fixed size, that all wanted grams pass and few others."""

    def __init__(self, cells: np.ndarray) -> None:
        self.some = np.zeros(2 << FILTER_BITS, bool)
        self.some[cells] = True

    @staticmethod
    def cells(grams: np.ndarray) -> np.ndarray:
        """The cells of each gram in both tables, one row a table."""
        first = grams >> np.uint64(64 - FILTER_BITS)
        second = (grams & np.uint64((1 << FILTER_BITS) - 1)) + np.uint64(1 << FILTER_BITS)
        return np.stack([first, second]).astype(np.int64)

    def wanted(self, grams: np.ndarray) -> np.ndarray:
        """The places of the grams that may be wanted."""
        at = np.flatnonzero(self.some[(grams >> np.uint64(64 - FILTER_BITS)).astype(np.int64)])
        return at[self.some[self.cells(grams[at])[1]]]

    def of(self, column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """(row, gram) of the grams of texts that may be wanted, each once a row; all texts of a slice at once."""
        found_rows, found = [np.zeros(0, np.int64)], [np.zeros(0, np.uint64)]
        for _, _, word, row in word_slices(column):
            former = mixed(word) * FORMER
            for d in range(REACH + 1):
                n = max(len(word) - d, 0)
                grams = mixed(former[:n] + word[d:]) if d else single_grams(word)
                at = self.wanted(grams)
                at = at[row[at] == row[at + d]]
                found_rows.append(row[at])
                found.append(grams[at])
        row, gram = np.concatenate(found_rows), np.concatenate(found)
        order = np.lexsort((gram, row))
        row, gram = row[order], gram[order]
        new = np.r_[True, (row[1:] != row[:-1]) | (gram[1:] != gram[:-1])] if len(row) else np.zeros(0, bool)
        return row[new], gram[new].view(np.int64)


def sent_filter(grams: DataFrame) -> Broadcast:
    """A filter of the ``gram`` column: tasks send the cells that they fill, each once, whatever the number of grams."""

    def fill(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        some = np.zeros(2 << FILTER_BITS, bool)
        for batch in batches:
            some[Filter.cells(batch.column(0).to_numpy().view(np.uint64))] = True
        yield pa.RecordBatch.from_arrays([pa.array(np.flatnonzero(some).astype(np.int32))], ["cell"])

    cells = grams.select("gram").mapInArrow(fill, "cell int").distinct().toArrow()
    return grams.sparkSession.sparkContext.broadcast(Filter(cells.column("cell").to_numpy()))


def numbered_items(items: DataFrame, item_key: str) -> DataFrame:
    """(number, item, text): items by a number of their own, as keys may repeat."""
    some = items.filter(F.col("text").isNotNull()).select(F.col(item_key).alias("item"), "text")
    return stored(some.withColumn("number", F.monotonically_increasing_id()), "items")


def candidates(docs: DataFrame, numbered: DataFrame, *, key: str = "doc_id", threshold: float = THRESHOLD) -> DataFrame:
    """(k, number): the documents and items that have enough seeds in common, found by a join of grams.

    One scan of the documents counts how many hold each gram of the items, a second one finds the
    seeds; of both only grams that pass a filter of fixed size are shuffled, and the first are added
    up before. So all documents can meet all items, and neither side is sent whole to anyone.
    """
    kind = docs.schema[key].dataType.simpleString()
    texts = docs.select(F.col(key).alias("k"), "text")

    def spell(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i, words in rows(batch.column("text")):
                place, gram = item_grams(words)
                columns = [batch.column("number").take(pa.array(np.full(len(gram), i))), pa.array(np.full(len(gram), len(words))), pa.array(place), pa.array(gram.view(np.int64))]
                yield pa.RecordBatch.from_arrays(columns, ["number", "size", "place", "gram"])

    grams = stored(numbered.mapInArrow(spell, "number long, size long, place long, gram long"), "grams")
    wanted = sent_filter(grams)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            gram, n = np.unique(wanted.value.of(batch.column("text"))[1], return_counts=True)
            yield pa.RecordBatch.from_arrays([pa.array(gram), pa.array(n)], ["gram", "n"])

    def choose(item: pa.Table) -> pa.Table:
        chosen, needed = seeds(item.column("place").to_numpy(), item.column("held").to_numpy(), item.column("size")[0].as_py(), threshold)
        picked = item.select(["number", "place", "gram"]).take(pa.array(chosen))
        return picked.append_column("needed", pa.array(np.full(len(chosen), needed)))

    counts = texts.mapInArrow(count, "gram long, n long").groupBy("gram").agg(F.sum("n").alias("n"))
    rated = grams.join(counts, "gram", "left").withColumn("held", F.coalesce("n", F.lit(0)))
    seed = stored(rated.groupBy("number").applyInArrow(choose, "number long, place long, gram long, needed long"), "seeds")
    sought = sent_filter(seed)

    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            at, gram = sought.value.of(batch.column("text"))
            yield pa.RecordBatch.from_arrays([batch.column("k").take(pa.array(at)), pa.array(gram)], ["k", "gram"])

    hits = texts.mapInArrow(find, f"k {kind}, gram long").join(seed, "gram").select("k", "number", "place", "needed").distinct()
    return hits.groupBy("k", "number").agg(F.count(F.lit(1)).alias("places"), F.max("needed").alias("needed")).filter("places >= needed").select("k", "number")


def leaks(docs: DataFrame, items: DataFrame, *, key: str = "doc_id", item_key: str = "item_id", threshold: float = THRESHOLD) -> DataFrame:
    """(key, item_key, score, end_word, n_seeds): the items that a document holds, whole or edited.

    The score is the best local alignment of the item's words with the text's, as a share of what the
    item scores against itself; rows below ``threshold`` are left out, and all others are found. Items so short
    that an alignment of the threshold need not have a pair of their words (one or two words at 0.5) are
    found where the text has them whole. n_seeds tells at how many places of the item the text has a pair
    of its words, at most REACH apart. NULL texts and texts without words hold nothing; items without
    words are not looked for. Equal items are reported each, repeated documents too, and a NULL key.
    A text is compared by one task, in some 40 bytes of memory a byte.
    """
    numbered = numbered_items(items, item_key)
    found = stored(candidates(docs, numbered, key=key, threshold=threshold), "candidates")
    per_text = found.join(numbered, "number").groupBy("k").agg(F.collect_list(F.struct("number", "item", F.col("text").alias("passage"))).alias("items"))
    texts = docs.select(F.col(key).alias("of"), "text").join(per_text, F.col("of").eqNullSafe(F.col("k"))).select("k", "text", "items")

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known: dict[int, np.ndarray] = {}
        for batch in batches:
            for i, words in rows(batch.column("text")):
                text, sought = Text(words), batch.column("items")[i].values
                numbers = sought.field("number").to_pylist()
                new = [j for j, number in enumerate(numbers) if number not in known]
                if len(known) + len(new) > KNOWN_ITEMS:
                    known, new = {}, list(range(len(numbers)))
                if new:
                    known.update((numbers[new[j]], item) for j, item in rows(sought.field("passage").take(pa.array(new))))
                scored = [(j, text.score(known[number], threshold)) for j, number in enumerate(numbers)]
                hits = [(j, *hit) for j, hit in scored if hit]
                if hits:
                    at, score, end, n = zip(*hits)
                    k = batch.column("k").take(pa.array([i] * len(at)))
                    yield pa.RecordBatch.from_arrays([k, sought.field("item").take(pa.array(at)), pa.array(score), pa.array(end), pa.array(n)], ["k", "item", "score", "end_word", "n_seeds"])

    kinds = docs.schema[key].dataType, items.schema[item_key].dataType
    schema = T.StructType().add("k", kinds[0]).add("item", kinds[1]).add("score", "double").add("end_word", "long").add("n_seeds", "long")
    return texts.mapInArrow(compare, schema).toDF(key, item_key, "score", "end_word", "n_seeds")


def clean_documents(docs: DataFrame, items: DataFrame, *, key: str = "doc_id", item_key: str = "item_id", threshold: float = THRESHOLD) -> DataFrame:
    """``docs`` without those that hold an item; a document with a NULL key is kept."""
    held = leaks(docs, items, key=key, item_key=item_key, threshold=threshold).select(F.col(key).alias("__key")).distinct()
    return docs.join(held, docs[key] == held["__key"], "left_anti")
