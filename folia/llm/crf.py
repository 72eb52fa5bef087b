"""Linear-chain conditional random field over many sequences at once.

Sequences are the rows offsets[i]:offsets[i + 1] of an array of emission scores.
All of them advance one position together, longest first, so the Python loop is
as long as the longest sequence and not as long as the text.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np


def _order(offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """First rows of the sequences, longest first, and how many are longer than t."""
    lengths = np.diff(offsets)
    order = np.argsort(-lengths, kind="stable")
    lengths = lengths[order]
    longest = int(lengths[0]) if len(lengths) else 0
    active = np.searchsorted(-lengths, -np.arange(longest), "left")
    return offsets[:-1][order], active


def viterbi(scores: np.ndarray, offsets: np.ndarray, transition: np.ndarray) -> np.ndarray:
    """The best label of every row; ties go to the lowest label."""
    first, active = _order(offsets)
    n, k = scores.shape
    labels = np.zeros(n, np.uint8)
    if not len(active):
        return labels
    back = np.zeros((n, k), np.uint8)
    best = np.zeros((len(first), k), scores.dtype)
    best[: active[0]] = scores[first[: active[0]]]
    for t in range(1, len(active)):
        m = active[t]
        rows = first[:m] + t
        ways = best[:m, :, None] + transition
        choice = ways.argmax(1)
        back[rows] = choice
        best[:m] = np.take_along_axis(ways, choice[:, None, :], 1)[:, 0] + scores[rows]
    label = np.zeros(len(first), np.uint8)
    for t in range(len(active) - 1, -1, -1):
        m = active[t]
        over = active[t + 1] if t + 1 < len(active) else 0
        label[over:m] = best[over:m].argmax(1)
        rows = first[:m] + t
        labels[rows] = label[:m]
        label[:m] = back[rows, label[:m]]
    return labels


def _logsum(x: np.ndarray, axis: int) -> np.ndarray:
    top = x.max(axis, keepdims=True)
    return (top + np.log(np.exp(x - top).sum(axis, keepdims=True))).squeeze(axis)


def marginals(scores: np.ndarray, offsets: np.ndarray, transition: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Probability of each label in each row, and expected counts of transitions."""
    first, active = _order(offsets)
    k = scores.shape[1]
    ahead, behind = scores.copy(), np.zeros_like(scores)
    for t in range(1, len(active)):
        rows = first[: active[t]] + t
        ahead[rows] += _logsum(ahead[rows - 1][:, :, None] + transition, 1)
    pairs = np.zeros((k, k))
    total = np.zeros(len(first))
    for t in range(len(active) - 1, -1, -1):
        m = active[t]
        over = active[t + 1] if t + 1 < len(active) else 0
        total[over:m] = _logsum(ahead[first[over:m] + t], 1)
        if over:
            rows = first[:over] + t
            after = scores[rows + 1] + behind[rows + 1]
            joint = ahead[rows][:, :, None] + transition + after[:, None, :]
            pairs += np.exp(joint - total[:over, None, None]).sum(0)
            behind[rows] = _logsum(transition + after[:, None, :], 2)
    each = np.empty_like(total)
    each[:] = total
    share = ahead + behind
    lengths = np.diff(offsets)
    by_row = np.zeros(len(lengths))
    by_row[np.argsort(-lengths, kind="stable")] = each
    return np.exp(share - np.repeat(by_row, lengths)[:, None]), pairs


@dataclass
class Model:
    """weights: a row of label scores per feature; transition: from label to label."""

    weights: np.ndarray
    transition: np.ndarray

    def dense(self, features: np.ndarray) -> np.ndarray:
        return features.astype(np.float32) @ self.weights.astype(np.float32)

    def sparse(self, features: np.ndarray) -> np.ndarray:
        """features: the indexes of each row's active features."""
        out = self.weights[features[:, 0]].copy()
        for j in range(1, features.shape[1]):
            out += self.weights[features[:, j]]
        return out

    def decode(self, scores: np.ndarray, offsets: np.ndarray) -> np.ndarray:
        return viterbi(scores, offsets, self.transition.astype(scores.dtype))


def fit(
    features: np.ndarray, labels: np.ndarray, offsets: np.ndarray, n_labels: int, n_features: int | None = None, steps: int = 80, rate: float = 0.1, decay: float = 1e-3
) -> Model:
    """Maximum conditional likelihood by Adam over the whole sample.

    Features are dense, or with n_features given, indexes of active ones.
    """
    sparse = n_features is not None
    weights = np.zeros((n_features if sparse else features.shape[1], n_labels))
    transition = np.zeros((n_labels, n_labels))
    if not len(labels):
        return Model(weights.astype(np.float32), transition)
    truth = np.zeros((len(labels), n_labels))
    truth[np.arange(len(labels)), labels] = 1
    inner = np.ones(len(labels), bool)
    inner[offsets[:-1][np.diff(offsets) > 0]] = False
    after = np.flatnonzero(inner)
    seen = np.zeros((n_labels, n_labels))
    np.add.at(seen, (labels[after - 1], labels[after]), 1)
    moments = [[np.zeros_like(x), np.zeros_like(x)] for x in (weights, transition)]
    for step in range(1, steps + 1):
        model = Model(weights, transition)
        share, pairs = marginals(model.sparse(features) if sparse else features @ weights, offsets, transition)
        miss = truth - share
        if sparse:
            grad = np.zeros_like(weights)
            for j in range(features.shape[1]):
                for label in range(n_labels):
                    grad[:, label] += np.bincount(features[:, j], miss[:, label], n_features)
        else:
            grad = features.T @ miss
        for x, g, (m, v) in zip((weights, transition), (grad, seen - pairs), moments, strict=True):
            g = g / len(labels) - decay * x / len(labels) ** 0.5
            m += 0.1 * (g - m)
            v += 0.001 * (g * g - v)
            x += rate * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.999**step)) + 1e-9)
    return Model(weights.astype(np.float32), transition)
