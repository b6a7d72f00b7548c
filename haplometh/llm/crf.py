"""Linear-chain conditional random fields in numpy: training, marginals, Viterbi.

Sequences of one length form a group, so every step of a recursion is one array
operation over all sequences of the group.
"""

from __future__ import annotations

from collections.abc import Iterable, Sequence
from dataclasses import dataclass

import numpy as np


@dataclass
class Group:
    """``count`` sequences of ``length`` items; item ``row[k]`` has feature ``feature[k]``."""

    count: int
    length: int
    feature: np.ndarray
    row: np.ndarray
    label: np.ndarray | None = None  # [count, length]


@dataclass
class Model:
    weight: np.ndarray  # [features, labels]
    transition: np.ndarray  # [labels, labels]
    start: np.ndarray  # [labels]


def emissions(group: Group, weight: np.ndarray) -> np.ndarray:
    rows, labels = group.count * group.length, weight.shape[1]
    out = np.stack([np.bincount(group.row, weight[group.feature, k], rows) for k in range(labels)], axis=1)
    return out.reshape(group.count, group.length, labels)


def _logsum(x: np.ndarray, axis: int) -> np.ndarray:
    top = x.max(axis=axis, keepdims=True)
    return np.log(np.exp(x - top).sum(axis=axis)) + np.squeeze(top, axis)


def marginals(e: np.ndarray, model: Model) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Label probabilities [n, T, L], expected transitions [L, L] and log partition sums [n]."""
    n, length, labels = e.shape
    ahead, back = np.empty_like(e), np.zeros_like(e)
    ahead[:, 0] = model.start + e[:, 0]
    for t in range(1, length):
        ahead[:, t] = _logsum(ahead[:, t - 1, :, None] + model.transition, 1) + e[:, t]
    for t in range(length - 2, -1, -1):
        back[:, t] = _logsum(model.transition + (e[:, t + 1] + back[:, t + 1])[:, None, :], 2)
    total = _logsum(ahead[:, -1], 1)
    node = np.exp(ahead + back - total[:, None, None])
    pair = np.zeros((labels, labels))
    for t in range(1, length):
        step = ahead[:, t - 1, :, None] + model.transition + (e[:, t] + back[:, t])[:, None, :] - total[:, None, None]
        pair += np.exp(step).sum(axis=0)
    return node, pair, total


def train(groups: Sequence[Group], features: int, labels: int, penalty: float = 1e-3, rounds: int = 120, rate: float = 0.15) -> Model:
    """Maximum penalised likelihood by full-batch gradient steps with adaptive rates.

    The result depends on the groups alone: no randomness. ``penalty`` is the
    L2 weight relative to the number of items.
    """
    sizes = [features * labels, labels * labels, labels]
    theta = np.zeros(sum(sizes))
    items = max(1, sum(g.count * g.length for g in groups))
    m, v = np.zeros_like(theta), np.zeros_like(theta)

    def model() -> Model:
        w, t, s = np.split(theta, np.cumsum(sizes)[:-1])
        return Model(w.reshape(features, labels), t.reshape(labels, labels), s)

    for k in range(1, rounds + 1):
        now = model()
        gw, gt, gs = np.zeros_like(now.weight), np.zeros_like(now.transition), np.zeros_like(now.start)
        for g in groups:
            node, pair, _ = marginals(emissions(g, now.weight), now)
            gold = np.eye(labels)[g.label]
            gap = (node - gold).reshape(-1, labels)
            for c in range(labels):
                gw[:, c] += np.bincount(g.feature, gap[g.row, c], features)
            gt += pair
            np.add.at(gt, (g.label[:, :-1].ravel(), g.label[:, 1:].ravel()), -1)
            gs += (node[:, 0] - gold[:, 0]).sum(axis=0)
        grad = np.concatenate([gw.ravel(), gt.ravel(), gs]) / items + penalty * theta
        m, v = 0.9 * m + 0.1 * grad, 0.99 * v + 0.01 * grad**2
        theta = theta - rate * (m / (1 - 0.9**k)) / (np.sqrt(v / (1 - 0.99**k)) + 1e-8)
    return model()


def viterbi(e: np.ndarray, model: Model) -> np.ndarray:
    """The likeliest label sequences [n, T]; ties go to the smaller label."""
    return viterbi_pieces([e], model)


def viterbi_pieces(pieces: Iterable[np.ndarray], model: Model) -> np.ndarray:
    """``viterbi`` of sequences whose emissions come in pieces along T, none of them empty.

    The best scores go from piece to piece and the back pointers through all of
    them, so the result is that of the whole; only one piece's emissions are held.
    """
    best, backs = None, []
    for e in pieces:
        back = np.zeros(e.shape, np.min_scalar_type(e.shape[2]))
        for t in range(e.shape[1]):
            if best is None:
                best = model.start + e[:, 0]
                continue
            ways = best[:, :, None] + model.transition
            back[:, t] = ways.argmax(axis=1)
            best = ways.max(axis=1) + e[:, t]
        backs.append(back)
    n, ends = len(best), np.cumsum([b.shape[1] for b in backs])
    out = np.empty((n, ends[-1]), np.int32)
    last = best.argmax(axis=1)
    for back, end in zip(reversed(backs), reversed(ends), strict=True):
        for t in range(back.shape[1] - 1, -1, -1):
            out[:, end - back.shape[1] + t] = last
            last = back[np.arange(n), t, last]
    return out
