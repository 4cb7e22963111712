"""A generative label model: how far to believe each of many voters, without believing any label outright.

A document has an unseen class y (0 or 1) and voters that fire or don't. The model is
p(y) * prod_j p(v_j | y, v_parent(j)): a tree over the voters that depend on each other beyond what the class
explains, each other voter on the class alone. The conditional mutual information of each two voters given
the anchor (below) gives the maximum spanning forest; expectation maximization then fits
the tables. Dependent voters so count once: words of one language fire together, and that they all keep silent
in another says little.

The last voter is the anchor, the label a row was given. Its error rates are stated, not estimated: a model
free to doubt it may find another split of the rows into two classes (one language against the others, say).
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np

#: Counts added to each cell of a conditional table, so that nothing seen once is certain.
SMOOTHING = 0.5
ROUNDS = 25
#: p(anchor fires | y = 0) and p(anchor fires | y = 1).
ANCHOR = (0.01, 0.98)
#: Voters depend on each other where 2 * rows * information exceeds this (a G test at about 1e-5, two tables).
DEPENDENT = 24.0


@dataclass
class LabelModel:
    """`prior` is p(y = 1); `tables[j][y, parent's vote]` is p(v_j = 1 | y, parent's vote)."""

    prior: float
    tables: np.ndarray
    parents: list[int]

    def posterior(self, votes: np.ndarray) -> np.ndarray:
        """p(y = 1 | votes) of each row."""
        odds = np.full(len(votes), np.log(self.prior) - np.log1p(-self.prior))
        for j, parent in enumerate(self.parents):
            given = votes[:, parent] if parent >= 0 else np.zeros(len(votes), np.int64)
            fires = votes[:, j] == 1
            p = self.tables[j][:, given]
            likely = np.log(np.where(fires, p, 1 - p))
            odds += likely[1] - likely[0]
        return 1 / (1 + np.exp(-np.clip(odds, -35, 35)))

    def accuracies(self, votes: np.ndarray, weights: np.ndarray) -> np.ndarray:
        """p(y = 1 | voter j fires), by posterior mass."""
        q = self.posterior(votes)
        fired = votes * weights[:, None]
        return (fired * q[:, None]).sum(0) / np.maximum(fired.sum(0), 1e-12)


def _fit(votes: np.ndarray, weights: np.ndarray, q: np.ndarray, parents: list[int]) -> LabelModel:
    """The tables that the posteriors `q` imply."""
    tables = np.empty((votes.shape[1], 2, 2))
    for y, mass in ((0, weights * (1 - q)), (1, weights * q)):
        for j, parent in enumerate(parents):
            for given in (0, 1):
                rows = mass if parent < 0 else mass * (votes[:, parent] == given)
                tables[j, y, given] = ((rows * votes[:, j]).sum() + SMOOTHING) / (rows.sum() + 2 * SMOOTHING)
    tables[-1] = np.array(ANCHOR)[:, None]
    prior = ((weights * q).sum() + SMOOTHING) / (weights.sum() + 2 * SMOOTHING)
    return LabelModel(float(prior), tables, parents)


def dependence(votes: np.ndarray, weights: np.ndarray, q: np.ndarray) -> np.ndarray:
    """Conditional mutual information given the class, of each two voters, in nats, times the rows."""
    total = np.zeros((votes.shape[1],) * 2)
    for mass in (weights * (1 - q), weights * q):
        n = mass.sum()
        if n <= 0:
            continue
        one = (votes * mass[:, None]).sum(0)
        both = (votes * mass[:, None]).T @ votes
        cells = {(1, 1): both, (1, 0): one[:, None] - both, (0, 1): one[None, :] - both,
                 (0, 0): n - one[:, None] - one[None, :] + both}
        for (a, b), joint in cells.items():
            expected = (one if a else n - one)[:, None] * (one if b else n - one)[None, :] / n
            seen = (joint > 1e-9) & (expected > 1e-9)
            total[seen] += joint[seen] * np.log(joint[seen] / expected[seen])
    np.fill_diagonal(total, 0)
    return total


def spanning_forest(strength: np.ndarray, least: float) -> list[int]:
    """Parent of each voter in the maximum spanning forest over pairs of at least `least`; -1 for roots."""
    k = len(strength)
    parents, best, towards, done = [-1] * k, np.full(k, -1.0), [-1] * k, [False] * k
    for _ in range(k):
        at = max((j for j in range(k) if not done[j]), key=lambda j: best[j])
        done[at], parents[at] = True, towards[at] if best[at] >= least else -1
        for j in range(k):
            if not done[j] and strength[at, j] > best[j]:
                best[j], towards[j] = strength[at, j], at
    return parents


def fit(votes: np.ndarray, weights: np.ndarray) -> LabelModel:
    """A model of 0/1 votes (rows x voters); the last voter is the anchor, from which fitting starts."""
    anchored = votes[:, -1].astype(float)
    parents = spanning_forest(2 * dependence(votes, weights, anchored), DEPENDENT)
    q = 0.05 + 0.9 * anchored
    for _ in range(ROUNDS):
        model = _fit(votes, weights, q, parents)
        q = model.posterior(votes)
    return model
