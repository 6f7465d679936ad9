"""Linear-chain conditional random field over hashed token features, in numpy."""

from __future__ import annotations

from dataclasses import dataclass, field

import numpy as np

OUTSIDE, BEGIN, INSIDE = 0, 1, 2
N_STATES = 3


def _logsumexp(x: np.ndarray, axis: int) -> np.ndarray:
    top = x.max(axis=axis, keepdims=True)
    return (top + np.log(np.exp(x - top).sum(axis=axis, keepdims=True))).squeeze(axis)


@dataclass
class LinearChain:
    """``weights[f, s]`` for feature ``f`` in state ``s``; ``moves[s, t]`` from state ``s`` to ``t``.

    A sequence begins and ends next to an outside token.
    """

    n_features: int
    weights: np.ndarray = field(default=None)
    moves: np.ndarray = field(default=None)

    def __post_init__(self):
        if self.weights is None:
            self.weights = np.zeros((self.n_features, N_STATES))
        if self.moves is None:
            self.moves = np.zeros((N_STATES, N_STATES))

    def fit(self, tokens: list[list[list[int]]], states: list[list[int]], steps: int = 60, rate: float = 0.3,
            l2: float = 1e-4) -> LinearChain:
        """Maximise the conditional likelihood by full-batch gradient steps (Adam)."""
        if not tokens:
            return self
        n, t = len(tokens), max(map(len, tokens))
        f = max((len(x) for seq in tokens for x in seq), default=1)
        feats = np.full((n, t, f), self.n_features)  # the last row is padding
        gold = np.zeros((n, t), np.int64)
        real = np.zeros((n, t), bool)
        for i, seq in enumerate(tokens):
            for j, x in enumerate(seq):
                feats[i, j, :len(x)] = x
            gold[i, :len(seq)], real[i, :len(seq)] = states[i], True
        rows = np.arange(n)
        before = np.concatenate((np.zeros((n, 1), np.int64), gold[:, :-1]), 1)
        params = [self.weights, self.moves]
        first, second = [np.zeros_like(p) for p in params], [np.zeros_like(p) for p in params]
        pick_gold = np.eye(N_STATES)[gold] * real[..., None]
        gold_moves = np.zeros_like(self.moves)
        np.add.at(gold_moves, (before[real], gold[real]), 1.0)
        last = real.sum(1) - 1
        np.add.at(gold_moves, (gold[rows, last], np.zeros(n, np.int64)), 1.0)
        for step in range(1, steps + 1):
            e = np.concatenate((self.weights, np.zeros((1, N_STATES))))[feats].sum(2)  # n, t, states
            m = self.moves
            alpha = np.zeros((n, t, N_STATES))
            alpha[:, 0] = e[:, 0] + m[OUTSIDE]
            for j in range(1, t):
                alpha[:, j] = e[:, j] + _logsumexp(alpha[:, j - 1, :, None] + m[None], 1)
            beta = np.zeros((n, t, N_STATES))
            for j in range(t - 1, -1, -1):
                if j < t - 1:
                    follow = _logsumexp(m[None] + (e[:, j + 1] + beta[:, j + 1])[:, None, :], 2)
                    beta[:, j] = np.where((last == j)[:, None], m[:, OUTSIDE][None], follow)
                else:
                    beta[:, j] = m[:, OUTSIDE][None]
            total = _logsumexp(alpha[rows, last] + beta[rows, last], 1)
            p = np.exp(alpha + beta - total[:, None, None]) * real[..., None]
            expected = np.zeros_like(m)
            for j in range(1, t):
                both = alpha[:, j - 1, :, None] + m[None] + (e[:, j] + beta[:, j])[:, None, :] - total[:, None, None]
                expected += np.exp(np.minimum(both, 0))[real[:, j]].sum(0)
            expected[OUTSIDE] += p[:, 0].sum(0)
            expected[:, OUTSIDE] += p[rows, last].sum(0)
            diff = pick_gold - p
            flat = feats.reshape(-1)
            grad = np.stack([np.bincount(flat, np.repeat(diff[..., s].reshape(-1), f), self.n_features + 1)[:-1]
                             for s in range(N_STATES)], 1)
            for k, g in enumerate((grad / n - l2 * self.weights, (gold_moves - expected) / n - l2 * self.moves)):
                first[k] = 0.9 * first[k] + 0.1 * g
                second[k] = 0.99 * second[k] + 0.01 * g * g
                params[k] += rate * (first[k] / (1 - 0.9 ** step)) / (np.sqrt(second[k] / (1 - 0.99 ** step)) + 1e-6)
        return self

    def slack(self) -> float:
        """How much the moves can favour a token that isn't outside, at most.

        A token whose score outside is better than any other by more than this is
        outside in every best path, whatever its neighbours are.
        """
        m = self.moves
        via = m[:, :, None] + m[None]  # from, at, to
        return float((via - via[:, OUTSIDE:OUTSIDE + 1]).max())

    def viterbi(self, e: np.ndarray) -> list[int]:
        """Best states of tokens with scores ``e`` between two outside tokens."""
        best, back = e[0] + self.moves[OUTSIDE], []
        for row in e[1:]:
            via = best[:, None] + self.moves
            back.append(via.argmax(0))
            best = via.max(0) + row
        state = int((best + self.moves[:, OUTSIDE]).argmax())
        out = [state]
        for pointers in reversed(back):
            state = int(pointers[state])
            out.append(state)
        return out[::-1]

    def decode(self, e: np.ndarray, starts: np.ndarray) -> np.ndarray:
        """Best states of every sequence (token scores ``e`` of all, cut at ``starts``); exact.

        Tokens that are outside for certain cut a sequence into short stretches,
        and Viterbi runs on each of these.
        """
        states = np.zeros(len(e), np.int64)
        open_ = np.flatnonzero(e[:, 1:].max(1) - e[:, 0] + self.slack() >= 0) if len(e) else np.zeros(0, np.int64)
        if not len(open_):
            return states
        owner = np.searchsorted(starts, open_, side="right")
        cut = np.flatnonzero((np.diff(open_) > 1) | (np.diff(owner) > 0)) + 1
        for part in np.split(open_, cut):
            states[part] = self.viterbi(e[part])
        return states
