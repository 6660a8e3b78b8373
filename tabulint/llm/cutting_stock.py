"""Cutting-stock column generation over a histogram of lengths, in numpy."""

from __future__ import annotations

import numpy as np

MAX_ROUNDS = 20_000
CLOSE = 2e-4


class Knapsack:
    """The best-valued set of lengths for every exact total, each length as often as wished."""

    def __init__(self, lengths: np.ndarray, size: int) -> None:
        self.lengths, self.size = lengths, size

    def solve(self, values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(value of the best set, index of its last length) by total; -inf and -1 where no set fits."""
        by_length = np.full(self.size + 1, -np.inf)
        by_length[self.lengths] = values
        best = np.full(self.size + 1, -np.inf)
        best[0] = 0.0
        last = np.full(self.size + 1, -1)
        for total in range(1, self.size + 1):
            sums = best[:total][::-1] + by_length[1 : total + 1]
            k = int(sums.argmax())
            best[total], last[total] = sums[k], k + 1
        return best, last

    def pattern(self, last: np.ndarray, total: int) -> dict[int, int]:
        found: dict[int, int] = {}
        while total > 0:
            found[int(last[total])] = found.get(int(last[total]), 0) + 1
            total -= int(last[total])
        return found


def patterns(demand: dict[int, int], size: int) -> list[tuple[dict[int, int], float]]:
    """(pattern, how often) of a nearly optimal fractional solution of the cutting-stock linear program.

    Rows are the lengths that occur, at most ``size``; columns are patterns whose total is at most
    ``size``; each sequence costs one. Starts from one pattern per length and, in each round, lets the
    knapsack price the patterns by the duals and brings the best one into the basis (revised simplex
    with an explicit inverse). Ends when no pattern improves the sum by more than CLOSE of it, or when
    the sum is within CLOSE of the total length, which no solution can beat.
    """
    lengths = np.array(sorted(demand))
    need = np.array([demand[int(x)] for x in lengths], float)
    place = {int(x): i for i, x in enumerate(lengths)}
    times = size // lengths
    columns = [{int(x): int(t)} for x, t in zip(lengths, times)]
    inverse = np.diag(1.0 / times)
    level = need / times
    knapsack = Knapsack(lengths, size)
    least = float(lengths @ need) / size
    for _ in range(MAX_ROUNDS):
        if level.sum() <= least * (1 + CLOSE):
            break
        best, last = knapsack.solve(inverse.sum(axis=0))
        total = int(best.argmax())
        if best[total] <= 1 + CLOSE:
            break
        found = knapsack.pattern(last, total)
        entering = sum(n * inverse[:, place[x]] for x, n in found.items())
        ratio = np.full(len(level), np.inf)
        can = entering > 1e-9
        ratio[can] = np.maximum(level[can], 0) / entering[can]
        row = int(ratio.argmin())
        step = ratio[row]
        level -= step * entering
        level[row] = step
        inverse[row] /= entering[row]
        entering[row] = 0.0
        inverse -= np.outer(entering, inverse[row])
        columns[row] = found
    return [(c, float(x)) for c, x in zip(columns, level) if x > 1e-9]


def best_fit(left: dict[int, int], size: int) -> list[dict[int, int]]:
    """Sequences for the few lengths that rounding leaves over: longest first, into the fullest that fits."""
    room_of: list[list[int]] = [[] for _ in range(size + 1)]
    made: list[dict[int, int]] = []
    for length in sorted(left, reverse=True):
        for _ in range(left[length]):
            room = next((r for r in range(length, size + 1) if room_of[r]), None)
            if room is None:
                made.append({})
                at, room = len(made) - 1, size
            else:
                at = room_of[room].pop()
            made[at][length] = made[at].get(length, 0) + 1
            room_of[room - length].append(at)
    return made


def plan(demand: dict[int, int], size: int) -> list[tuple[dict[int, int], int]]:
    """(pattern, how often) that holds every demanded length exactly once.

    The fractional solution is rounded down; what is left over, at most one pattern's lengths for each
    of at most ``size`` patterns, is fitted one by one.
    """
    demand = {int(k): int(v) for k, v in demand.items() if v > 0}
    whole = demand.pop(size, 0)
    chosen = [({size: 1}, whole)] if whole else []
    if not demand:
        return chosen
    left = dict(demand)
    for pattern, times in patterns(demand, size):
        copies = min([int(times + 1e-6), *[left[x] // n for x, n in pattern.items()]])
        if copies > 0:
            chosen.append((pattern, copies))
            for x, n in pattern.items():
                left[x] -= n * copies
    counted: dict[tuple[tuple[int, int], ...], int] = {}
    for pattern in best_fit(left, size):
        key = tuple(sorted(pattern.items()))
        counted[key] = counted.get(key, 0) + 1
    return chosen + [(dict(k), n) for k, n in sorted(counted.items())]
