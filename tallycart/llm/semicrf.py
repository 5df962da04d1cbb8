"""A semi-Markov conditional random field: scores whole segments, sums or maximises over all ways to cut a sequence.

A sequence of n atoms is given as its candidate segments (start, end, features); every atom may also stand alone outside
all segments at score 0. A segment of type k scores the sum of its features' weights for k. Segment length is bounded by
the caller's candidates, so both passes take time linear in the number of candidates.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np


@dataclass(frozen=True)
class Lattice:
    """Candidate segments of one sequence, sorted by end. ``features`` has a row of feature numbers per segment; -1 fills."""

    atoms: int
    starts: np.ndarray
    ends: np.ndarray
    features: np.ndarray

    def scores(self, weights: np.ndarray) -> np.ndarray:
        """Segments by types. The last row of the weights is zero and serves the number -1."""
        return weights[self.features].sum(axis=1)


def log_partition(lattice: Lattice, scores: np.ndarray) -> tuple[float, np.ndarray]:
    """Log of the sum over all segmentations, and the marginal probability of each segment and type."""
    n, total = lattice.atoms, np.logaddexp.reduce(scores, axis=1)
    by_end: list[list[int]] = [[] for _ in range(n + 1)]
    by_start: list[list[int]] = [[] for _ in range(n + 1)]
    for s, (a, b) in enumerate(zip(lattice.starts.tolist(), lattice.ends.tolist(), strict=True)):
        by_end[b].append(s)
        by_start[a].append(s)
    ahead, back = [0.0] * (n + 1), [0.0] * (n + 1)
    for j in range(1, n + 1):
        ways = [ahead[j - 1], *(ahead[lattice.starts[s]] + total[s] for s in by_end[j])]
        ahead[j] = float(np.logaddexp.reduce(ways)) if len(ways) > 1 else ways[0]
    for i in range(n - 1, -1, -1):
        ways = [back[i + 1], *(back[lattice.ends[s]] + total[s] for s in by_start[i])]
        back[i] = float(np.logaddexp.reduce(ways)) if len(ways) > 1 else ways[0]
    outside = np.array(ahead)[lattice.starts] + np.array(back)[lattice.ends] - ahead[n]
    return ahead[n], np.exp(scores + outside[:, None])


def best(lattice: Lattice, scores: np.ndarray) -> list[tuple[int, int, int]]:
    """The segments (start, end, type) of the best segmentation; ties go to fewer segments."""
    n = lattice.atoms
    top, kind = scores.max(axis=1), scores.argmax(axis=1)
    value, back = [0.0] * (n + 1), [-1] * (n + 1)
    s = 0
    for j in range(1, n + 1):
        value[j] = value[j - 1]
        while s < len(lattice.ends) and lattice.ends[s] == j:
            if value[lattice.starts[s]] + top[s] > value[j]:
                value[j], back[j] = value[lattice.starts[s]] + top[s], s
            s += 1
    out, j = [], n
    while j > 0:
        if back[j] < 0:
            j -= 1
        else:
            s = back[j]
            out.append((int(lattice.starts[s]), j, int(kind[s])))
            j = int(lattice.starts[s])
    return out[::-1]


def fit(examples: list[tuple[Lattice, list[tuple[int, int]]]], n_features: int, n_types: int, epochs: int = 8, rate: float = 0.4, decay: float = 1e-3) -> np.ndarray:
    """Weights that maximise the likelihood of the given segmentations (rows of segment and type numbers), by Adagrad in
    the given order: the same examples give the same weights."""
    weights, squares = np.zeros((n_features + 1, n_types)), np.full((n_features + 1, n_types), 1e-6)
    for _ in range(epochs):
        for lattice, gold in examples:
            if not len(lattice.starts):
                continue
            _, marginal = log_partition(lattice, lattice.scores(weights))
            pull = -marginal
            for segment, kind in gold:
                pull[segment, kind] += 1.0
            rows = np.unique(lattice.features[lattice.features >= 0])
            slope = np.zeros((len(rows), n_types))
            place = np.searchsorted(rows, lattice.features)
            for column in range(lattice.features.shape[1]):
                used = lattice.features[:, column] >= 0
                np.add.at(slope, place[used, column], pull[used])
            slope -= decay * weights[rows]
            squares[rows] += slope**2
            weights[rows] += rate * slope / np.sqrt(squares[rows])
    return weights
