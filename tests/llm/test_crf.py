"""The chain against sums over all labellings."""

import itertools

import numpy as np

from scribal.llm import crf


def brute(chain, emission):
    best, total, marginal = None, 0.0, np.zeros(len(emission))
    for labels in itertools.product((0, 1), repeat=len(emission)):
        s = chain.start[labels[0]] + sum(e for e, y in zip(emission, labels) if y)
        s += sum(chain.moves[a, b] for a, b in zip(labels, labels[1:]))
        total += np.exp(s)
        marginal += np.exp(s) * np.array(labels)
        if best is None or s > best[0]:
            best = (s, list(labels))
    return best[1], marginal / total, np.log(total)


def test_posteriors_and_viterbi():
    rng = np.random.default_rng(1)
    lengths = np.array([3, 1, 7, 0, 5])
    chain = crf.Chain(np.zeros(0), rng.normal(size=(2, 2)), rng.normal(size=2))
    emission = rng.normal(scale=3, size=lengths.sum())
    got, _, _, log_sum = crf.posteriors(chain, emission, crf.Batch(lengths))
    at, logs = 0, 0.0
    for n in lengths:
        if n:
            labels, marginal, log = brute(chain, emission[at:at + n])
            assert np.allclose(got[at:at + n], marginal)
            assert crf.viterbi(chain, emission[at:at + n]) == labels
            logs += log
        at += n
    assert np.isclose(log_sum, logs)
    assert len(crf.posteriors(chain, np.zeros(0), crf.Batch(np.zeros(0, int)))[0]) == 0


def test_fit_learns_a_run():
    rng = np.random.default_rng(2)
    tags = (rng.random((200, 12)).cumsum(axis=1) % 3 > 1.5).astype(int)
    ids = np.where(rng.random(tags.shape) < 0.1, 1 - tags, tags).ravel()
    chain = crf.fit(ids, np.ones(len(ids), int), tags.ravel(), np.full(200, 12), 2)
    assert chain.weights[1] > chain.weights[0] and chain.moves[1, 1] + chain.moves[0, 0] > chain.moves[0, 1] + chain.moves[1, 0]
