"""Content-chosen regions: equal windows of any two texts lie in regions of the same name, in numpy."""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np


@dataclass(frozen=True)
class Regions:
    """Runs of window starts that share the least gram; ``inner`` tells that the gram occurs again in the run."""

    name: np.ndarray  # the least gram's hash
    first: np.ndarray  # first window start
    starts: np.ndarray  # number of window starts
    inner: np.ndarray


def sliding_least(values: np.ndarray, width: int) -> np.ndarray:
    """The least of each ``width`` neighbours, by doubling."""
    least, reach = values, 1
    while reach < width:
        step = min(reach, width - reach)
        least = np.minimum(least[:-step], least[step:])
        reach += step
    return least


def regions(grams: np.ndarray, width: int, bounds: np.ndarray, window: int) -> Regions:
    """The regions of texts laid end to end.

    ``grams`` has the hash of the gram at each place; a window covers ``width`` grams and ``window``
    units, and lies inside one text, whose first units ``bounds`` holds (and the end of the last).
    """
    sizes = np.maximum(np.diff(bounds) - window + 1, 0)
    nothing = np.zeros(0, np.int64)
    if not sizes.sum():
        return Regions(nothing.astype(np.uint64), nothing, nothing, nothing.astype(bool))
    least = sliding_least(grams, width)
    some = np.flatnonzero(sizes)
    begins, sizes = bounds[:-1][some], sizes[some]
    ends = np.cumsum(sizes)
    starts = np.arange(ends[-1]) + np.repeat(begins - (ends - sizes), sizes)
    value = least[starts]
    new = np.r_[True, value[1:] != value[:-1]]
    new[ends[:-1]] = True
    at = np.flatnonzero(new)
    count = np.diff(np.r_[at, len(starts)])
    first, name = starts[at], value[at]
    spans = count + width - 1
    edges = np.cumsum(spans)
    places = np.arange(edges[-1]) + np.repeat(first - (edges - spans), spans)
    again = np.add.reduceat((grams[places] == np.repeat(name, spans)).astype(np.int64), edges - spans) > 1
    return Regions(name, first, count, again)
