"""A semi-Markov conditional random field over short unit sequences.

A labelling cuts a sequence of units into segments: single units outside (label 0) and entities of
one to ``LONGEST`` units with a type. Its score is the sum over entities of weights times features
of the whole span, and of a weight per pair of neighbouring labels. ``fit`` maximises the
conditional likelihood with exact marginals, ``decode`` finds the best labelling by dynamic
programming over end positions, bounded by ``LONGEST``.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

import numpy as np

LONGEST = 16
_NONE = -1e9


@dataclass(frozen=True)
class Model:
    """``weights``: one row of feature weights per type; ``moves[a, b]``: label b follows a."""

    weights: np.ndarray
    moves: np.ndarray

    @property
    def types(self) -> int:
        return len(self.weights)


def _sum(x: np.ndarray, axis: int) -> np.ndarray:
    top = x.max(axis=axis)
    return top + np.log(np.exp(x - np.expand_dims(top, axis)).sum(axis=axis))


def _likelihood(model: Model, x: np.ndarray, valid: np.ndarray, n: np.ndarray):
    """Log partition and the marginals of segments and moves of padded sequences.

    ``x[r, i, k]`` are the features of the span of k + 1 units from i on, ``valid`` says if it is
    one. Label 0 takes one unit and scores 0.
    """
    count, width = x.shape[:2]
    labels = model.types + 1
    score = np.full((count, width, LONGEST, labels), _NONE)
    score[..., 1:] = np.where(valid[..., None], x @ model.weights.T, _NONE)
    score[:, :, 0, 0] = np.where(np.arange(width)[None] < n[:, None], 0.0, _NONE)
    forward = np.full((count, width + 1, labels), _NONE)
    forward[:, 0, 0] = 0.0
    entered = np.full((count, width, labels), _NONE)
    for i in range(width):
        entered[:, i] = _sum(forward[:, i, :, None] + model.moves[None], axis=1)
        for k in range(min(LONGEST, width - i)):
            forward[:, i + k + 1] = np.logaddexp(forward[:, i + k + 1], entered[:, i] + score[:, i, k])
    rows = np.arange(count)
    total = _sum(forward[rows, n], axis=1)
    backward = np.full((count, width + 1, labels), _NONE)
    backward[rows, n] = 0.0
    begun = np.full((count, width, labels), _NONE)
    for i in range(width - 1, -1, -1):
        ends = np.stack(
            [score[:, i, k] + backward[:, i + k + 1] for k in range(min(LONGEST, width - i))], axis=1
        )
        begun[:, i] = _sum(ends, axis=1)
        after = _sum(model.moves[None] + begun[:, i, None, :], axis=2)
        backward[:, i] = np.logaddexp(backward[:, i], after)
    spans = np.zeros_like(score)
    for k in range(LONGEST):
        if k < width:
            stop = width - k
            spans[:, :stop, k] = np.exp(
                entered[:, :stop] + score[:, :stop, k] + backward[:, k + 1 :] - total[:, None, None]
            )
    moves = np.exp(
        forward[:, :-1, :, None] + model.moves + begun[:, :, None, :] - total[:, None, None, None]
    )
    return total, score, spans, moves.sum(axis=(0, 1))


def fit(
    examples: list[tuple[np.ndarray, np.ndarray, list[tuple[int, int, int]]]],
    types: int,
    rounds: int = 100,
    rate: float = 0.3,
    damping: float = 0.002,
) -> Model:
    """Weights for examples (features, valid spans, entities as (start, units, type))."""
    width = max(len(x) for x, _, _ in examples)
    depth = examples[0][0].shape[2]
    x = np.zeros((len(examples), width, LONGEST, depth))
    valid = np.zeros((len(examples), width, LONGEST), dtype=bool)
    n = np.array([len(e[0]) for e in examples])
    want_x, want_moves = np.zeros((types, depth)), np.zeros((types + 1, types + 1))
    for r, (features, is_span, entities) in enumerate(examples):
        x[r, : n[r]], valid[r, : n[r]] = features, is_span
        label = {}
        for start, units, kind in entities:
            label[start] = (units, kind + 1)
            want_x[kind] += features[start, units - 1]
        at, last = 0, 0
        while at < n[r]:
            units, now = label.get(at, (1, 0))
            want_moves[last, now] += 1
            at, last = at + units, now
    weights, moves = np.zeros((types, depth)), np.zeros((types + 1, types + 1))
    power = [np.zeros_like(weights), np.zeros_like(moves)]
    for _ in range(rounds):
        _, _, spans, got_moves = _likelihood(Model(weights, moves), x, valid, n)
        got_x = np.einsum("riky,rikf->yf", spans[..., 1:], x, optimize=True)
        for value, slope, p in zip(
            (weights, moves),
            ((want_x - got_x) / len(n) - damping * weights, (want_moves - got_moves) / len(n) - damping * moves),
            power,
            strict=True,
        ):
            p += slope**2
            value += rate * slope / (np.sqrt(p) + 1e-8)
    return Model(weights, moves)


def decode(
    model: Model,
    n: int,
    features: Callable[[int, int], tuple[np.ndarray, np.ndarray]],
    caution: float = 0.0,
    block: int = 2048,
) -> list[tuple[int, int, int]]:
    """Best entities (start, units, type) of a sequence of ``n`` units.

    ``features(a, b)`` gives features and valid spans for starts a to b - 1, so a sequence of any
    length needs one block of them at a time. Each entity has to score ``caution`` above outside.
    """
    labels = model.types + 1
    best = np.full((n + 1, labels), -np.inf)
    best[0, 0] = 0.0
    come = np.zeros((n + 1, labels, 2), dtype=np.int8)  # units and the label before
    for first in range(0, n, block):
        x, valid = features(first, min(n, first + block))
        score = np.where(valid[..., None], x @ model.weights.T - caution, -np.inf)
        for i in range(len(x)):
            at = first + i
            reach = best[at][:, None] + model.moves
            before = reach.argmax(axis=0)
            entered = reach.max(axis=0)
            if entered[0] > best[at + 1, 0]:
                best[at + 1, 0], come[at + 1, 0] = entered[0], (1, before[0])
            ends = min(LONGEST, n - at)
            value = entered[1:] + score[i, :ends]
            held = best[at + 1 : at + ends + 1, 1:]
            better = value > held
            if better.any():
                held[better] = value[better]
                k, y = np.nonzero(better)
                come[at + k + 1, y + 1, 0], come[at + k + 1, y + 1, 1] = k + 1, before[y + 1]
    found, at, label = [], n, int(best[n].argmax())
    while at > 0:
        units, last = (int(v) for v in come[at, label])
        at -= units
        if label:
            found.append((at, units, label - 1))
        label = last
    return found[::-1]
