"""Random walks over characters that map edit distance to Hamming distance, sampled as they go, in numpy."""

from __future__ import annotations

import math
from functools import lru_cache

import numpy as np

from tabulint.llm.words import mixed

CELLS = 256
BANDS, BAND_CELLS = 16, 8
# Candidates: the share of pairs at the threshold that may have no band in common, and how many bands that may take.
MISSED, MOST_BANDS = 1e-3, 600
BLOCK = 1 << 16
# Characters that one call walks over together.
WALK_CHARS = 1 << 24


class Schedule:
    """The shared random choices of all walks: a multiplier for each step, and which steps are sampled.

    Step j draws a cell and a number; it is sampled if the number is the least so far in its cell. So a
    walk of any length leaves in each cell its sample at the step with the least number, and two walks
    of like length sample the same steps.
    """

    def __init__(self) -> None:
        self.multipliers: list[np.ndarray] = []
        self.sampled: list[dict[int, int]] = []
        self.least = np.full(CELLS, np.iinfo(np.uint64).max, np.uint64)

    def block(self, number: int) -> tuple[np.ndarray, dict[int, int]]:
        """(multipliers, step in the block -> cell) for steps from number * BLOCK on."""
        while len(self.sampled) <= number:
            steps = np.arange(BLOCK, dtype=np.uint64) + np.uint64(len(self.sampled) * BLOCK)
            draw = mixed(steps * np.uint64(2) + np.uint64(1))
            value, cell = mixed(draw), (draw % np.uint64(CELLS)).astype(np.int64)
            found = {}
            for j in np.flatnonzero(value < self.least[cell]):
                if value[j] < self.least[cell[j]]:
                    self.least[cell[j]] = value[j]
                    found[int(j)] = int(cell[j])
            self.sampled.append(found)
            self.multipliers.append((mixed(draw + np.uint64(7)) >> np.uint64(32)).astype(np.uint32) | np.uint32(1))
        return self.multipliers[number], self.sampled[number]


@lru_cache(maxsize=1)
def schedule() -> Schedule:
    return Schedule()


def code_points(text: str) -> np.ndarray:
    return np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32)


def walk(texts: list[np.ndarray]) -> np.ndarray:
    """CELLS numbers from 1 to 15 for each text of code points, 0 in cells that a short walk leaves empty.

    At each step a walk writes its present character and goes to the next one if the shared random
    function of step and character says so; what it writes is the embedded text. Walks end with their
    text. All texts go in step, so that a step costs a few vector operations.
    """
    out = np.zeros((len(texts), CELLS), np.uint8)
    order = sorted((i for i, t in enumerate(texts) if len(t)), key=lambda i: -len(texts[i]))
    if not order:
        return out
    sizes = np.array([len(texts[i]) for i in order])
    starts = np.r_[0, np.cumsum(sizes + 1)]
    marks = np.zeros(starts[-1], np.uint32)  # a zero behind each text, where no walk moves
    for i, start in zip(order, starts):
        part = (texts[i].astype(np.uint64) + np.uint64(1)) * np.uint64(0x9E3779B97F4A7C15)
        marks[start : start + len(part)] = (mixed(part) >> np.uint64(32)).astype(np.uint32) | np.uint32(1)
    ends, rows = starts[1:] - 1, np.array(order)
    at = starts[:-1].astype(np.int64)
    number = 0
    while len(at):
        multipliers, sampled = schedule().block(number)
        for low in range(0, BLOCK, 256):
            here, moved = np.empty(len(at), np.uint32), np.empty(len(at), np.uint32)
            for j in range(low, low + 256):
                np.take(marks, at, out=here, mode="clip")
                if j in sampled:
                    alive = here != 0
                    value = (here * np.uint32(multipliers[j] ^ np.uint32(0x5BD1E994))) >> np.uint32(28)
                    out[rows[alive], sampled[j]] = np.maximum(value[alive], 1)
                np.multiply(here, multipliers[j], out=moved)
                np.right_shift(moved, 31, out=moved)
                np.add(at, moved, out=at)
            left = at < ends
            if not left.all():
                at, ends, rows = at[left], ends[left], rows[left]
                if not len(at):
                    break
        number += 1
    return out


def spelled(cells: np.ndarray) -> str:
    """The fingerprint as text, one hexadecimal digit a cell."""
    return bytes(np.frombuffer(b"0123456789abcdef", np.uint8)[cells]).decode()


def read(fingerprint: str) -> np.ndarray:
    """The cells that ``spelled`` wrote."""
    digits = np.frombuffer(fingerprint.encode(), np.uint8)
    return np.where(digits < ord("a"), digits - ord("0"), digits - (ord("a") - 10)).astype(np.uint8)


def likeness(a: np.ndarray, b: np.ndarray) -> float:
    """The share of cells, filled in either fingerprint, that are equal; 1 for two empty texts."""
    filled = (a != 0) | (b != 0)
    n = int(filled.sum())
    return float((a == b)[filled].sum()) / n if n else 1.0


def band_cells() -> np.ndarray:
    """Which cells each band samples."""
    return np.random.default_rng(5).permutation(CELLS)[: BANDS * BAND_CELLS].reshape(BANDS, BAND_CELLS)


def shared_bands(a: np.ndarray, b: np.ndarray) -> int:
    """How many of the BANDS bands two fingerprints have in common."""
    return int((a[band_cells()] == b[band_cells()]).all(axis=1).sum())


@lru_cache
def candidate_cells(threshold: float) -> np.ndarray:
    """Which cells each band samples in which pairs of the likeness ``threshold`` meet, all but a share of MISSED.

    Bands are as long as MOST_BANDS of them allow, so that few other pairs meet. They are cut from
    permutations of all cells; with bands of one cell, one permutation misses no pair.
    """
    same = min(max(math.ceil(threshold * CELLS), 1), CELLS)
    for size in range(BAND_CELLS, 0, -1):
        meet = math.prod(max(same - i, 0) / (CELLS - i) for i in range(size))
        if size > 1 and meet == 0:
            continue
        bands = 1 if size == 1 or meet == 1 else math.ceil(math.log(MISSED) / math.log1p(-meet))
        rounds = -(-bands // (CELLS // size))
        if size == 1 or rounds * (CELLS // size) <= MOST_BANDS:
            break
    random = np.random.default_rng(6)
    cut = [random.permutation(CELLS)[: CELLS // size * size].reshape(-1, size) for _ in range(rounds)]
    return np.concatenate(cut)


def candidate_buckets(cells: np.ndarray, threshold: float) -> np.ndarray:
    """The bucket of each candidate band of a fingerprint; a band of empty cells only has none."""
    bands = candidate_cells(threshold)
    digits = cells[bands].astype(np.int64)
    value = np.arange(len(bands), dtype=np.int64)
    for column in digits.T:
        value = value * 16 + column
    return value[digits.any(axis=1)]
