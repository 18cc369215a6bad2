"""A linear-chain conditional random field with two labels, in numpy.

Positions carry sets of feature numbers; label 1 scores the sum of their
weights, label 0 scores 0, and neighbouring labels add a transition score.
Sequences of a batch advance together: they are ordered by length, and step t
works on those that are longer than t.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np


@dataclass
class Chain:
    """Weights by feature, transition scores [before, now], start scores."""

    weights: np.ndarray
    moves: np.ndarray
    start: np.ndarray


class Batch:
    """Sequences of given lengths, stored one after another."""

    def __init__(self, lengths: np.ndarray):
        self.lengths = np.asarray(lengths, dtype=np.int64)
        self.begin = np.r_[0, np.cumsum(self.lengths)[:-1]].astype(np.int64) if len(self.lengths) else np.zeros(0, np.int64)
        self.order = np.argsort(-self.lengths, kind="stable")
        longest = int(self.lengths.max()) if len(self.lengths) else 0
        counts = np.bincount(self.lengths, minlength=longest + 1)
        self.alive = len(self.lengths) - np.cumsum(counts)  # sequences longer than t

    def steps(self):
        """For every t, the positions of the t-th members of the sequences that have one."""
        first = self.begin[self.order]
        for t in range(len(self.alive) - 1):
            yield first[: self.alive[t]] + t


def posteriors(chain: Chain, emission: np.ndarray, batch: Batch) -> tuple[np.ndarray, np.ndarray, np.ndarray, float]:
    """Marginals of label 1, expected transitions [before, now], expected
    starts and the log partition sum, by scaled forward and backward sums."""
    n = len(emission)
    top = np.maximum(emission, 0.0)  # a common factor per position keeps numbers small
    local = np.stack([np.exp(-top), np.exp(emission - top)], axis=1)
    moves, start = np.exp(chain.moves), np.exp(chain.start)
    forward, scale = np.empty((n, 2)), np.ones(n)
    before = None
    places = list(batch.steps())
    for at in places:
        now = start * local[at] if before is None else (before[: len(at)] @ moves) * local[at]
        scale[at] = total = now.sum(axis=1)
        before = now / total[:, None]
        forward[at] = before
    backward = np.ones((n, 2))
    for t in range(len(places) - 2, -1, -1):
        after, at = places[t + 1], places[t][: len(places[t + 1])]
        backward[at] = ((local[after] * backward[after]) @ moves.T) / scale[after][:, None]
    marginal = forward * backward
    marginal /= marginal.sum(axis=1, keepdims=True)
    pairs = np.zeros((2, 2))
    if n:
        inside = np.ones(n, dtype=bool)
        inside[batch.begin[batch.lengths > 0]] = False
        now = np.flatnonzero(inside)
        joint = forward[now - 1][:, :, None] * moves[None] * (local[now] * backward[now])[:, None, :]
        pairs = (joint / joint.sum(axis=(1, 2), keepdims=True)).sum(axis=0)
    starts = marginal[batch.begin[batch.lengths > 0]].sum(axis=0) if n else np.zeros(2)
    return marginal[:, 1], pairs, starts, float(np.log(scale).sum() + top.sum())


def viterbi(chain: Chain, emission: np.ndarray) -> list[int]:
    """The most likely labels of one sequence; ties prefer label 0."""
    if not len(emission):
        return []
    (m00, m01), (m10, m11) = chain.moves.tolist()
    s0, s1 = chain.start.tolist()
    values = emission.tolist()
    s1 += values[0]
    back = []
    for e in values[1:]:
        to0, to1 = (0 if s0 + m00 >= s1 + m10 else 1), (0 if s0 + m01 >= s1 + m11 else 1)
        back.append((to0, to1))
        s0, s1 = (s1 + m10 if to0 else s0 + m00), (s1 + m11 if to1 else s0 + m01) + e
    labels = [1 if s1 > s0 else 0]
    for step in reversed(back):
        labels.append(step[labels[-1]])
    return labels[::-1]


def emissions(weights: np.ndarray, ids: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """Sums of the weights of every position's features."""
    upto = np.r_[0.0, np.cumsum(weights[ids])]
    ends = np.cumsum(counts)
    return upto[ends] - upto[ends - counts]


def fit(ids: np.ndarray, counts: np.ndarray, labels: np.ndarray, lengths: np.ndarray, n_features: int,
        rounds: int = 150, l2: float = 1e-3, rate: float = 0.1, seen_weight: np.ndarray | None = None) -> Chain:
    """Maximum likelihood with an L2 penalty, by Adam over all sequences.

    ``ids``/``counts``: features of every position; ``seen_weight``: optional
    weight of every position's share in the gradient of the weights.
    """
    batch = Batch(lengths)
    size = n_features + 6
    theta, m, v = np.zeros(size), np.zeros(size), np.zeros(size)
    n = max(1, len(labels))
    inside = np.ones(len(labels), dtype=bool)
    inside[batch.begin[batch.lengths > 0]] = False
    now = np.flatnonzero(inside)
    seen_pairs = np.zeros((2, 2))
    np.add.at(seen_pairs, (labels[now - 1], labels[now]), 1.0)
    seen_starts = np.bincount(labels[~inside], minlength=2).astype(float)
    for step in range(1, rounds + 1):
        chain = Chain(theta[:n_features], theta[n_features:n_features + 4].reshape(2, 2), theta[n_features + 4:])
        marginal, pairs, starts, _ = posteriors(chain, emissions(chain.weights, ids, counts), batch)
        error = labels - marginal
        if seen_weight is not None:
            error = error * seen_weight
        gradient = np.r_[np.bincount(ids, weights=np.repeat(error, counts), minlength=n_features),
                         (seen_pairs - pairs).ravel(), seen_starts - starts] / n - l2 / n * theta
        m, v = 0.9 * m + 0.1 * gradient, 0.999 * v + 0.001 * gradient**2
        theta = theta + rate * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.999**step)) + 1e-8)
    return Chain(theta[:n_features].copy(), theta[n_features:n_features + 4].reshape(2, 2).copy(), theta[n_features + 4:].copy())
