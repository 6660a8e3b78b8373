"""Word boundaries and hashes of whole Arrow batches at once, in numpy."""

from __future__ import annotations

import unicodedata
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa

from tabulint.llm.polynomial import MASK, PRIME, powers, reduced, shifted, times

# Bytes of text that one vector operation takes; a longer text is taken alone.
SLICE_BYTES = 1 << 19

# What a character beyond ASCII is to words: a part of one, what parts them, or one of its own.
INSIDE, BETWEEN, ALONE = 0, 1, 2
# Scripts written without spaces, but for the ideographs from 0x20000 on.
UNSPACED = [
    (0x0E00, 0x109F), (0x1780, 0x17FF), (0x1950, 0x19FF), (0x1A20, 0x1AAF), (0x1B00, 0x1B7F), (0x2E80, 0x2FDF), (0x3005, 0x312F),
    (0x31A0, 0x31BF), (0x31F0, 0x31FF), (0x3400, 0x4DBF), (0x4E00, 0xA4CF), (0xA980, 0xA9FF), (0xAA60, 0xAADF), (0xF900, 0xFAFF),
    (0xFF66, 0xFF9F), (0x16FE0, 0x1B2FF),
]

# The base of word hashes, modulo the prime 2**61 - 1. Modulo a power of two a polynomial would not tell a
# Thue-Morse string from its complement, whatever its base.
BASE = 0x1E3779B97F4A7C15 % PRIME
INVERSE = pow(BASE, -1, PRIME)
# Bytes of which the sums of halves of their terms stay below 2**64.
SUM_BYTES = 1 << 22

# Fast sums modulo 2**64, which only name things: what has one name is compared before anything follows from it.
ROUGH_BASE = np.uint64(0x9E3779B97F4A7C15)
ROUGH_INVERSE = np.uint64(pow(int(ROUGH_BASE), -1, 2**64))


def spaces() -> np.ndarray:
    """True for the bytes that part words of ``[^\\x20\\x09-\\x0D]+``."""
    table = np.zeros(256, bool)
    table[[0x20, *range(0x09, 0x0E)]] = True
    return table


def not_letters() -> np.ndarray:
    """True for ASCII bytes other than digits and letters; bytes of other characters belong to words."""
    table = np.ones(256, bool)
    table[128:] = False
    for first, last in (b"09", b"AZ", b"az"):
        table[first : last + 1] = False
    return table


def mixed(x: np.ndarray) -> np.ndarray:
    """Scrambles 64-bit numbers so that all bits depend on all bits."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def table_size(size: int) -> int:
    return max(SLICE_BYTES + 1, 1 << int(size).bit_length())


@lru_cache(maxsize=1)
def _powers(size: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Powers of the base, in their upper and lower 32 bits, and of its inverse."""
    steps = powers(BASE, size)
    return steps >> np.uint64(32), steps & np.uint64(0xFFFFFFFF), powers(INVERSE, size)


@lru_cache(maxsize=1)
def _rough_powers(size: int) -> tuple[np.ndarray, np.ndarray]:
    out = []
    for base in (ROUGH_BASE, ROUGH_INVERSE):
        numbers = np.full(size, base, np.uint64)
        numbers[0] = 1
        out.append(np.multiply.accumulate(numbers))
    return out[0], out[1]


@lru_cache(maxsize=1)
def byte_values() -> np.ndarray:
    return mixed(np.arange(1, 257, dtype=np.uint64) * np.uint64(0xD1342543DE82EF95))


def slices(column: pa.Array) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """(first row, bytes, offsets) of runs of rows of about SLICE_BYTES; a NULL has no bytes."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    if len(column) == 0:
        return
    column = column.fill_null("").cast(pa.large_binary())
    _, offsets, data = column.buffers()
    offsets = np.frombuffer(offsets, np.int64)[column.offset : column.offset + len(column) + 1]
    data = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    first = 0
    while first < len(column):
        last = int(np.searchsorted(offsets, offsets[first] + SLICE_BYTES, "right")) - 1
        last = min(max(last, first + 1), len(column))
        yield first, data[offsets[first] : offsets[last]], offsets[first : last + 1] - offsets[first]
        first = last


@lru_cache(maxsize=1)
def character_kinds() -> np.ndarray:
    """INSIDE, BETWEEN or ALONE by code point: punctuation, blanks and controls part words, symbols and characters of
    scripts without spaces are words of their own."""
    table = np.zeros(0x110000, np.uint8)
    for first, last in UNSPACED:
        table[first : last + 1] = ALONE
    table[0x20000:0x40000] = ALONE
    for code in range(0x80, 0x20000):
        category = unicodedata.category(chr(code))
        if category[0] in "PZ" or category == "Cc":
            table[code] = BETWEEN
        elif category[0] == "S":
            table[code] = ALONE
    return table


def special_characters(data: np.ndarray, kinds: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(start, end, kind) of the characters of UTF-8 text beyond ASCII that are not INSIDE words."""
    start = np.flatnonzero(data >= 0xC0)
    lead = data[start].astype(np.int32)
    size = 2 + (lead >= 0xE0) + (lead >= 0xF0)
    code = lead & (0x7F >> size)
    for k in range(1, 4):
        more = size > k
        code[more] = code[more] << 6 | (data[start[more] + k] & 0x3F)
    kind = kinds[code]
    some = kind != INSIDE
    return start[some], (start + size)[some], kind[some]


def word_bounds(
    data: np.ndarray, offsets: np.ndarray, parts: np.ndarray, kinds: np.ndarray | None = None
) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(start, end, row) of every word; rows end words. With ``kinds``, characters beyond ASCII part words or are words by kind."""
    inside = np.zeros(len(data) + 2, np.int8)
    inside[1:-1] = ~parts[data]
    first = last = np.zeros(0, np.int64)
    if kinds is not None:
        first, last, kind = special_characters(data, kinds)
        for k in range(4):
            some = (kind == BETWEEN) & (first + k < last)
            inside[first[some] + k + 1] = 0
        first, last = first[kind == ALONE], last[kind == ALONE]
    begins = inside[1:] > inside[:-1]
    ends = inside[1:] < inside[:-1]
    begins[first], ends[last] = True, True
    ends[first] |= inside[first] == 1
    begins[last] |= inside[last + 1] == 1
    cuts = offsets[1:-1]
    cuts = cuts[(cuts > 0) & (cuts < len(data))]
    joined = cuts[(inside[cuts] == 1) & (inside[cuts + 1] == 1)]
    begins[joined] = True
    ends[joined] = True
    start, end = np.flatnonzero(begins), np.flatnonzero(ends)
    return start, end, np.searchsorted(offsets, start, "right") - 1


def prefix_hash(data: np.ndarray) -> np.ndarray:
    """Running sums of which ``span_hash`` makes the hash of any stretch of bytes, in two rows.

    Each byte's term, a digit times a power of the base, is summed in two halves. The sums may run over 64 bits;
    the differences of two of them do not, for up to SUM_BYTES.
    """
    sums = np.zeros((2, len(data) + 1), np.uint64)
    high, low, _ = _powers(table_size(len(data)))
    digit = data.astype(np.uint64)
    digit += np.uint64(1)
    np.cumsum(digit * high[: len(data)], out=sums[0, 1:])
    np.cumsum(digit * low[: len(data)], out=sums[1, 1:])
    return sums


def span_hash(sums: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """A 64-bit hash of each stretch, the same wherever it lies: its polynomial modulo 2**61 - 1, scrambled."""
    total = np.zeros(len(start), np.uint64)
    first = start
    while True:
        last = np.minimum(end, first + SUM_BYTES)
        high, low = sums[:, last] - sums[:, first]
        total = reduced(total + reduced(shifted(reduced(high)) + reduced(low)))
        if (last == end).all():
            break
        first = last
    return mixed(times(total, _powers(table_size(sums.shape[1] - 1))[2][start]))


def rough_sums(units: np.ndarray) -> np.ndarray:
    """Running sums modulo 2**64 of scrambled units, for ``rough_span``."""
    sums = np.zeros(len(units) + 1, np.uint64)
    np.cumsum(units * _rough_powers(table_size(len(units)))[0][: len(units)], out=sums[1:])
    return sums


def rough_span(sums: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """A 64-bit name of each stretch, the same wherever it lies; long stretches can be made to share one."""
    return mixed((sums[end] - sums[start]) * _rough_powers(table_size(len(sums) - 1))[1][start])


def gram_hash(hashes: np.ndarray, n: int, salt: int = 0) -> np.ndarray:
    """A 64-bit hash of each run of ``n`` neighbouring word hashes, runs across rows included."""
    size = max(len(hashes) - n + 1, 0)
    out = np.full(size, np.uint64(salt), np.uint64)
    for k in range(n):
        out = out * ROUGH_BASE + hashes[k : k + size]
    return mixed(out)
