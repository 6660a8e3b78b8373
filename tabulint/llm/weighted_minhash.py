"""TF-IDF shingles of whole Arrow batches and their improved consistent weighted samples, in numpy."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

from tabulint.llm.words import character_kinds, gram_hash, mixed, not_letters, prefix_hash, slices, span_hash, word_bounds

SHINGLE_WORDS = 5
BANDS, ROWS = 10, 3

# The sketch of document frequencies: each shingle counts in one cell of each row.
SKETCH_ROWS, SKETCH_BITS = 2, 20
BLOCK = 4096
# A shingle counts in full while at most one document in COMMON has it, and at least half otherwise.
COMMON, LEAST = 20.0, 0.5
# Steps of an inverse document frequency, far above what the order of summing can change.
STEPS = 256

# Texts that agree in all least shingles of a group band are copies of one another, nearly, and count as one document together.
GROUP_BANDS, GROUP_ROWS = 3, 3


@dataclass(frozen=True)
class Shingles:
    """The distinct shingles of some texts in a row: hashes, sorted inside each text, and how often each occurs."""

    hashes: np.ndarray
    times: np.ndarray
    starts: np.ndarray  # where each text's shingles begin, and the end of the last


def shingles(column: pa.Array) -> Iterator[tuple[int, Shingles]]:
    """(first row, shingles) of slices of a text column.

    Words are runs of digits and letters, and single characters of scripts without spaces, in lower case.
    A text of one to four words has one shingle, all of its words.
    """
    parts = not_letters()
    for first, data, offsets in slices(pc.utf8_lower(column)):
        start, end, row = word_bounds(data, offsets, parts, character_kinds())
        word = span_hash(prefix_hash(data), start, end)
        bounds = np.searchsorted(row, np.arange(len(offsets)))
        grams = gram_hash(word, SHINGLE_WORDS, salt=SHINGLE_WORDS)
        hashes, times, starts = [], [], [0]
        for a, b in zip(bounds[:-1], bounds[1:]):
            if b - a >= SHINGLE_WORDS:
                found, n = np.unique(grams[a : b - SHINGLE_WORDS + 1], return_counts=True)
            elif b > a:
                found, n = gram_hash(word[a:b], b - a, salt=int(b - a)), np.ones(1, np.int64)
            else:
                found, n = np.zeros(0, np.uint64), np.zeros(0, np.int64)
            hashes.append(found)
            times.append(n)
            starts.append(starts[-1] + len(found))
        yield first, Shingles(np.concatenate(hashes), np.concatenate(times), np.array(starts))


def cells(hashes: np.ndarray) -> list[np.ndarray]:
    """The cell of each shingle in each row of the sketch."""
    return [(mixed(hashes + np.uint64(i + 1)) >> np.uint64(64 - SKETCH_BITS)).astype(np.int64) for i in range(SKETCH_ROWS)]


def group_bands(found: Shingles) -> np.ndarray:
    """One row of GROUP_BANDS numbers per text that has shingles, of its least shingles in GROUP_ROWS orders each."""
    draws = np.random.default_rng(11)
    begins = found.starts[:-1][np.diff(found.starts) > 0]
    out = np.zeros((len(begins), GROUP_BANDS), np.uint64)
    if len(begins):
        for k, salt in enumerate(draws.integers(1 << 62, size=GROUP_BANDS * GROUP_ROWS).astype(np.uint64)):
            least = np.minimum.reduceat(mixed(found.hashes + salt), begins)
            out[:, k // GROUP_ROWS] = mixed(out[:, k // GROUP_ROWS] + least + np.uint64(k))
    return out


def inverse_frequency(counts: np.ndarray, documents: float) -> np.ndarray:
    """The weight of a shingle by cell: falls with the logarithm of its share of documents, from 1 to LEAST."""
    share = documents / np.maximum(counts, 1)
    weight = np.clip(np.log(np.maximum(share, 1)) / np.log(COMMON), LEAST, 1)
    return (np.round(weight * STEPS) / STEPS).astype(np.float32)


def weights(found: Shingles, table: np.ndarray) -> np.ndarray:
    """Times in the text times inverse document frequency; a cell can only overstate a shingle's documents."""
    rarest = np.maximum.reduce([table[i][c] for i, c in enumerate(cells(found.hashes))])
    return rarest * found.times.astype(np.float32)


class Sampler:
    """BANDS * ROWS consistent weighted samples of a text, hashed into one number per band.

    Sample k takes the shingle with the least ``c * exp(-r) / y``, where y is the largest value at most
    the weight on a grid with step r and offset beta, all drawn from the shingle's hash: two texts take
    the same shingle at the same grid value with the probability of their weighted Jaccard similarity.
    """

    def __init__(self) -> None:
        draws = np.random.default_rng(20_11)
        self.step = draws.gamma(2.0, 1.0, 1 << 16).astype(np.float32)
        self.log_c = np.log(draws.gamma(2.0, 1.0, 1 << 16)).astype(np.float32)
        self.beta = draws.random(1 << 16).astype(np.float32)
        self.salts = draws.integers(1 << 62, size=BANDS * ROWS).astype(np.uint64) * np.uint64(2) + np.uint64(1)

    def bands(self, found: Shingles, weight: np.ndarray) -> np.ndarray:
        """One row of BANDS numbers per text; zeros for a text without shingles."""
        sizes = np.diff(found.starts)
        some = np.flatnonzero(sizes)
        out = np.zeros((len(sizes), BANDS), np.uint64)
        if not len(some):
            return out
        begins, sizes = found.starts[some], sizes[some]
        base, log_weight = found.hashes ^ (found.hashes >> np.uint64(29)), np.log(weight)
        for k, salt in enumerate(self.salts):
            z = base * salt
            step = self.step[(z >> np.uint64(48)).astype(np.int64)]
            beta = self.beta[((z >> np.uint64(32)) & np.uint64(0xFFFF)).astype(np.int64)]
            level = np.floor(log_weight / step + beta)
            key = self.log_c[((z >> np.uint64(16)) & np.uint64(0xFFFF)).astype(np.int64)] - step * (level - beta + 1)
            least = np.flatnonzero(key == np.repeat(np.minimum.reduceat(key, begins), sizes))
            taken = least[np.searchsorted(least, begins)]
            sample = mixed(found.hashes[taken] ^ mixed(level[taken].astype(np.int64).astype(np.uint64) + salt))
            out[some, k // ROWS] = mixed(out[some, k // ROWS] + sample + np.uint64(k))
        return out


def digest(found: Shingles, i: int) -> bytes:
    """Tells apart texts with different shingles or shingle counts."""
    part = slice(found.starts[i], found.starts[i + 1])
    return hashlib.md5(found.hashes[part].tobytes() + found.times[part].tobytes()).digest()


def similarity(a: tuple[bytes, bytes, float], b: tuple[bytes, bytes, float]) -> float:
    """Weighted Jaccard similarity of two texts given as (sorted hashes, weights, total weight)."""
    ha, hb = np.frombuffer(a[0], np.uint64), np.frombuffer(b[0], np.uint64)
    wa, wb = np.frombuffer(a[1], np.float32), np.frombuffer(b[1], np.float32)
    at = np.searchsorted(hb, ha)
    at[at == len(hb)] = 0
    same = hb[at] == ha if len(hb) else np.zeros(len(ha), bool)
    shared = float(np.minimum(wa[same], wb[at[same]]).sum(dtype=float))
    return shared / max(a[2] + b[2] - shared, 1e-12)
