"""Polynomial fingerprints modulo 2**61 - 1 that compose: those of parts give that of the whole, in numpy."""

from __future__ import annotations

from collections.abc import Iterable
from functools import lru_cache

import numpy as np

PRIME = (1 << 61) - 1
BLOCK = 64
# Bytes of a chunk: what one entry of the block sums covers; and bytes that one vector operation takes.
CHUNK, RUN = 1 << 16, 1 << 19
LOW = np.uint64((1 << 31) - 1)
MASK = np.uint64(PRIME)


def reduced(x: np.ndarray) -> np.ndarray:
    """64-bit numbers modulo the prime."""
    x = (x & MASK) + (x >> np.uint64(61))
    return np.where(x >= MASK, x - MASK, x)


def times(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Products modulo the prime, from halves of 31 bits."""
    a_high, a_low, b_high, b_low = a >> np.uint64(31), a & LOW, b >> np.uint64(31), b & LOW
    middle = a_high * b_low + a_low * b_high
    # 2**62 is 2 and 2**61 is 1 modulo the prime
    middle = (middle >> np.uint64(30)) + ((middle & np.uint64((1 << 30) - 1)) << np.uint64(31))
    return reduced(reduced(a_high * b_high * np.uint64(2) + middle) + a_low * b_low)


def shifted(x: np.ndarray) -> np.ndarray:
    """Numbers below the prime times 2**32: their 61 bits turned by 32."""
    return ((x << np.uint64(32)) & MASK) | (x >> np.uint64(29))


def powers(base: int, size: int) -> np.ndarray:
    """The first ``size`` powers of a base, by doubling."""
    out = np.ones(size, np.uint64)
    done, step = 1, base
    while done < size:
        more = min(done, size - done)
        out[done : done + more] = times(out[:more], np.full(more, step, np.uint64))
        done, step = done + more, step * step % PRIME
    return out


class Polynomial:
    """Fingerprints with one base: the bytes, one added to each, are the digits of a number in that base.

    Texts that differ get the same fingerprint for at most as many bases as they have bytes, so with a
    base drawn at random nobody can prepare texts that do.
    """

    def __init__(self, base: int) -> None:
        self.base = base
        powers = [1]
        for _ in range(BLOCK):
            powers.append(powers[-1] * base % PRIME)
        self.table = np.array([[v * powers[BLOCK - 1 - j] % PRIME for v in range(257)] for j in range(BLOCK)], np.uint64).ravel()
        self.column = (np.arange(BLOCK) * 257).astype(np.int32)
        steps = [1]
        for _ in range(CHUNK // BLOCK):
            steps.append(steps[-1] * powers[BLOCK] % PRIME)
        self.steps = np.array(steps, np.uint64)

    def chunks(self, data: np.ndarray, start: np.ndarray, stop: np.ndarray) -> np.ndarray:
        """The fingerprints of neighbouring stretches of at most CHUNK bytes, none empty."""
        size = stop - start
        blocks = -(-size // BLOCK)
        last = np.cumsum(blocks)
        digits = np.zeros((int(last[-1]), BLOCK), np.int32)
        # a stretch fills its blocks from the right; digits of 0 in front change nothing
        shift = last * BLOCK - stop
        digits.ravel()[np.arange(int(start[0]), int(stop[-1])) + np.repeat(shift, size)] = data[start[0] : stop[-1]].astype(np.int32) + 1
        values = self.table.take(digits + self.column).reshape(-1, BLOCK // 8, 8).sum(axis=2)
        values = reduced(reduced(values).sum(axis=1))
        behind = np.repeat(last, blocks) - 1 - np.arange(int(last[-1]))
        values = times(values, self.steps[behind])
        first = last - blocks
        high, low = np.add.reduceat(values >> np.uint64(32), first), np.add.reduceat(values & np.uint64(0xFFFFFFFF), first)
        return reduced(times(high, np.full(len(high), 1 << 32, np.uint64)) + low)

    def of(self, data: np.ndarray, offsets: np.ndarray) -> list[int]:
        """The fingerprint of each row: of its chunks, put together."""
        sizes = np.diff(offsets)
        parts = -(-sizes // CHUNK)
        row = np.repeat(np.arange(len(sizes)), parts)
        place = np.arange(len(row)) - np.repeat(np.cumsum(parts) - parts, parts)
        start = offsets[:-1][row] + place * CHUNK
        stop = np.minimum(start + CHUNK, offsets[1:][row])
        hashes = []
        runs = np.searchsorted(stop, np.arange(offsets[0], offsets[-1], RUN), "right") if len(row) else []
        for a, b in zip(runs, [*runs[1:], len(row)]):
            if b > a:
                hashes.append(self.chunks(data, start[a:b], stop[a:b]))
        found = np.concatenate(hashes).tolist() if hashes else []
        first = np.cumsum(parts) - parts
        return [
            0 if n == 0 else found[f] if n == 1 else self.joined(zip(found[f : f + n], (stop - start)[f : f + n].tolist()))[0]
            for f, n in zip(first.tolist(), parts.tolist())
        ]

    def joined(self, parts: Iterable[tuple[int, int]]) -> tuple[int, int]:
        """(fingerprint, length) of the stretches (fingerprint, length) laid end to end: each shifts what lies before it."""
        value, length = 0, 0
        for part, size in parts:
            value = (value * pow(self.base, size, PRIME) + part) % PRIME
            length += size
        return value, length


@lru_cache(maxsize=4)
def polynomial(base: int) -> Polynomial:
    return Polynomial(base)
