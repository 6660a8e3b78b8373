"""Suffix arrays of shards by induced sorting, and permuted common prefixes, in numpy."""

from __future__ import annotations

import numpy as np

# A string is induced by whole buckets if it has this many places for each letter, else suffix by suffix.
BUCKET_LETTERS = 256


def suffix_types(text: np.ndarray) -> np.ndarray:
    """True where a suffix is smaller than the one behind it; the last suffix counts as smaller."""
    n = len(text)
    up = np.ones(n, bool)
    up[:-1] = text[:-1] < text[1:]
    level = np.zeros(n, bool)
    level[:-1] = text[:-1] == text[1:]
    decides = np.where(level, n, np.arange(n))
    return up[np.minimum.accumulate(decides[::-1])[::-1]]


def ranges(first: np.ndarray, n: np.ndarray) -> np.ndarray:
    """The numbers first, first + 1, ... of each run of ``n``, one run behind the other."""
    return np.repeat(first - np.cumsum(n) + n, n) + np.arange(n.sum())


def run_places(text: np.ndarray) -> np.ndarray:
    """How many equal letters stand right before each place."""
    at = np.arange(len(text))
    begins = np.r_[True, text[1:] != text[:-1]]
    return at - np.maximum.accumulate(np.where(begins, at, 0))


def induce(text: np.ndarray, smaller: np.ndarray, seeds: np.ndarray, letters: int) -> np.ndarray:
    """The order of all suffixes that the order of the leftmost-smaller ones (``seeds``) induces.

    One pass upward over the letters' buckets places each larger suffix behind the suffix that follows
    it in the text, one pass downward the smaller ones. A bucket first takes in at once what runs of its
    own letter add to it, step by step of the runs; then its suffixes place their left neighbours
    together, in one stable partition by letter.
    """
    n = len(text)
    sizes = np.bincount(text, minlength=letters)
    ends = np.cumsum(sizes)
    begins = ends - sizes
    before = run_places(text)
    order = np.zeros(n, np.int64)
    first = text[seeds]
    held = np.bincount(first, minlength=letters)
    by_letter = np.argsort(first, kind="stable")
    sorted_first = first[by_letter]
    order[(ends - held)[sorted_first] + np.arange(len(seeds)) - (np.cumsum(held) - held)[sorted_first]] = seeds[by_letter]

    def along_runs(found: np.ndarray) -> np.ndarray:
        """Suffixes of one letter with those that their runs place behind them: all first steps, all second ones, ..."""
        steps = before[found]
        if not steps.any():
            return found
        at = np.repeat(np.arange(len(found)), steps + 1)
        step = ranges(np.zeros(len(found), np.int64), steps + 1)
        by = np.argsort(step, kind="stable")
        return found[at[by]] - step[by]

    def partition(found: np.ndarray, c: int, larger: bool) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """The left neighbours of another letter and the wanted type: sorted by letter, their letters, ranks and counts."""
        left = found[found > 0] - 1
        left = left[(smaller[left] != larger) & (text[left] != c)]
        letter = text[left]
        by = np.argsort(letter, kind="stable")
        letter, count = letter[by], np.bincount(letter, minlength=letters)
        return left[by], letter, np.arange(len(left)) - (np.cumsum(count) - count)[letter], count

    free = begins.copy()
    for c in np.flatnonzero(sizes):
        found = along_runs(order[begins[c] : free[c]])
        free[c] = begins[c] + len(found)
        order[begins[c] : free[c]] = found
        for part in (found, order[ends[c] - held[c] : ends[c]]):
            left, letter, rank, count = partition(part, c, True)
            order[free[letter] + rank] = left
            free += count

    larger_ends = free.copy()
    free = ends.copy()
    last = n - 1  # nothing induces the last suffix, the first of its letter's smaller ones
    for c in np.flatnonzero(sizes)[::-1]:
        found = along_runs(order[free[c] : ends[c]][::-1])
        if text[last] == c:
            found = np.r_[found, along_runs(np.array([last]))]
        free[c] = ends[c] - len(found)
        order[free[c] : ends[c]] = found[::-1]
        for part in (found, order[begins[c] : larger_ends[c]][::-1]):
            left, letter, rank, count = partition(part, c, False)
            order[free[letter] - 1 - rank] = left
            free -= count
    return order


def same_as_before(text: np.ndarray, start: np.ndarray, size: np.ndarray) -> np.ndarray:
    """Whether each stretch is equal, letter by letter, to the one before it in the list."""
    same = np.r_[False, size[1:] == size[:-1]]
    at = np.flatnonzero(same)
    if len(at):
        n = size[at]
        equal = text[ranges(start[at], n)] == text[ranges(start[at - 1], n)]
        same[at] = np.logical_and.reduceat(equal, np.cumsum(n) - n)
    return same


def induce_singly(text: np.ndarray, smaller: np.ndarray, seeds: np.ndarray, letters: int) -> np.ndarray:
    """What ``induce`` gives, one suffix at a time: for strings of names, whose buckets hold few suffixes each."""
    n = len(text)
    ends = np.cumsum(np.bincount(text, minlength=letters))
    first = text[seeds]
    held = np.bincount(first, minlength=letters)
    by = np.argsort(first, kind="stable")
    start = np.full(n, -1, np.int64)
    start[(ends - held)[first[by]] + np.arange(len(seeds)) - (np.cumsum(held) - held)[first[by]]] = seeds[by]
    order, last = start.tolist(), int(text[-1])
    # the letter before each suffix if the one that begins there is of the type which a pass places, else -1, as for free slots
    left = np.r_[-1, text[:-1].astype(np.int64)]
    is_smaller = np.r_[False, smaller[:-1]]
    to_larger, to_smaller = ([*np.where(placed, left, -1).tolist(), -1] for placed in (~is_smaller, is_smaller))

    free = (ends - np.bincount(text, minlength=letters)).tolist()
    for i in order:  # meets what it places further on
        c = to_larger[i]
        if c >= 0:
            order[free[c]] = i - 1
            free[c] += 1

    free = ends.tolist()
    free[last] -= 1  # nothing induces the last suffix, the first of its letter's smaller ones
    order[free[last]] = n - 1
    for i in reversed(order):
        c = to_smaller[i]
        if c >= 0:
            free[c] -= 1
            order[free[c]] = i - 1
    return np.array(order, np.int64)


def names_sorted(names: np.ndarray) -> np.ndarray:
    """The suffix array of a string of names, numbered without gaps, of which some occur more than once.

    A name that occurs once decides any comparison that reaches it, so what follows it is looked at only
    from its own start: of neighbours that occur once each, the recursion keeps the first, and the last name.
    """
    single = np.bincount(names)[names] == 1
    kept = ~(single & np.r_[False, single[:-1]])
    kept[-1] = True
    at, away = np.flatnonzero(kept), np.flatnonzero(~kept)
    found, letter = np.unique(names[at], return_inverse=True)
    known = np.r_[at[suffix_array(letter, len(found))], away]
    return known[np.argsort(names[known], kind="stable")]


def suffix_array(text: np.ndarray, letters: int) -> np.ndarray:
    """Start positions of all suffixes, sorted.

    ``text`` ends with the letter 0, which it has nowhere else. Suffixes are classified, the leftmost-smaller
    substrings sorted by induction and named, and the string of names, at most half as long, is sorted by
    recursion, unless each name occurs once. Its order induces that of all suffixes. Strings of names have
    nearly as many letters as places and are induced suffix by suffix; bytes go by whole buckets.
    """
    place = induce if letters * BUCKET_LETTERS <= len(text) else induce_singly
    smaller = suffix_types(text)
    leftmost = np.flatnonzero(smaller[1:] & ~smaller[:-1]) + 1
    if len(leftmost) > 1:
        rough = place(text, smaller, leftmost, letters)
        is_leftmost = np.zeros(len(text), bool)
        is_leftmost[leftmost] = True
        rough = rough[is_leftmost[rough]]
        number = np.zeros(len(text), np.int64)
        number[leftmost] = np.arange(len(leftmost))
        stop = np.minimum(np.r_[leftmost[1:], len(text) - 1] + 1, len(text))[number[rough]]
        name = np.cumsum(~same_as_before(text, rough, stop - rough)) - 1
        if name[-1] + 1 == len(leftmost):
            leftmost = rough
        else:
            reduced = np.zeros(len(leftmost), np.int64)
            reduced[number[rough]] = name
            leftmost = leftmost[names_sorted(reduced)]
    return place(text, smaller, leftmost, letters)


def permuted_common_prefixes(text: np.ndarray, order: np.ndarray) -> np.ndarray:
    """For each position, how many letters its suffix shares with the one before it in ``order``, by comparing them.

    Where the letters before both suffixes are equal too, a position shares one letter less than its left
    neighbour; only the others are compared, and all of them share few letters in sum.
    """
    n = len(text)
    before = np.full(n, -1, np.int64)
    before[order[1:]] = order[:-1]
    at = np.arange(n)
    compared = (before <= 0) | (at == 0)
    rest = np.flatnonzero(~compared)
    compared[rest] = text[rest - 1] != text[before[rest] - 1]
    shared = np.zeros(n, np.int64)
    open_, step = np.flatnonzero(compared & (before >= 0)), 8
    while len(open_):
        width = min(step, max(1, (1 << 22) // len(open_)))
        a, b = open_ + shared[open_], before[open_] + shared[open_]
        along = np.arange(width)
        # the last letter occurs once, so no comparison goes beyond it
        equal = text[np.minimum(a[:, None] + along, n - 1)] == text[np.minimum(b[:, None] + along, n - 1)]
        same = np.where(equal.all(axis=1), width, np.argmin(equal, axis=1))
        shared[open_] += same
        open_, step = open_[same == width], step * 2
    head = np.maximum.accumulate(np.where(compared, at, 0))
    return shared[head] - (at - head)
