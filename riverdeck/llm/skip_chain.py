"""A skip-chain conditional random field over the candidate spans of one document.

Nodes are candidates, labels the four kinds or none. Neighbouring candidates share a transition
potential; distant candidates with a common key (the same address, the same digits) share an agreement
potential, wherever they stand. Labels come from loopy sum-product message passing. Occurrences of a
key are linked one after the other, so edges are linear in the candidates, and messages run in text
order and back, so one sweep carries evidence from any occurrence to all others.

Weights are fitted by penalised pseudo-likelihood: each label given its features and its neighbours'
labels. The penalty pulls towards `PRIOR`, which is also the model where nothing can be learned.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np

KINDS = ("email", "ip", "card", "phone")
LABELS = ("none", *KINDS)
FEATURES = ("bias", "at", "plus", "three_dots", "luhn", "under_9", "from_9_to_11", "from_12_to_15", "from_16_to_19",
            "over_19", "letters", "cue_email", "cue_ip", "cue_card", "cue_phone")
AGREEMENT = 5.0
SWEEPS = 20
TOLERANCE = 1e-4


@dataclass(frozen=True)
class Weights:
    node: np.ndarray  # features x labels
    chain: np.ndarray  # label x next label
    skip: np.ndarray  # agreement, by label


def _prior() -> Weights:
    node = np.zeros((len(FEATURES), len(LABELS)))
    node[0] = [3.0, 0.0, 0.0, 0.0, 0.0]
    for feature, label in (("at", "email"), ("plus", "phone"), ("three_dots", "ip"), ("luhn", "card"),
                           ("cue_email", "email"), ("cue_ip", "ip"), ("cue_card", "card"), ("cue_phone", "phone")):
        node[FEATURES.index(feature), LABELS.index(label)] = 1.0
    return Weights(node, np.zeros((5, 5)), np.array([0.0, *[AGREEMENT] * 4]))


PRIOR = _prior()


def fit(features: np.ndarray, labels: np.ndarray, before: np.ndarray, after: np.ndarray, linked: np.ndarray,
        steps: int = 300, penalty: float = 20.0) -> Weights:
    """`before` and `after` are neighbours' labels (-1: none), `linked` counts linked labels per row."""
    node, chain, skip = PRIOR.node.copy(), PRIOR.chain.copy(), PRIOR.skip.copy()
    n = len(labels)
    if not n:
        return PRIOR
    truth = np.eye(5)[labels]
    has_before, has_after = before >= 0, after >= 0
    rate = 1.0 / (n + penalty)
    for _ in range(steps):
        score = features @ node + linked * skip
        score[has_before] += chain[before[has_before]]
        score[has_after] += chain[:, after[has_after]].T
        p = np.exp(score - score.max(1, keepdims=True))
        miss = truth - p / p.sum(1, keepdims=True)
        moved = np.zeros((5, 5))
        np.add.at(moved, before[has_before], miss[has_before])
        np.add.at(moved.T, after[has_after], miss[has_after])
        node += rate * (features.T @ miss - penalty * (node - PRIOR.node))
        chain += rate * (moved - penalty * (chain - PRIOR.chain))
        skip += rate * ((linked * miss).sum(0) - penalty * (skip - PRIOR.skip))
    return Weights(node, chain, skip)


def skip_edges(keys: list[tuple[str, ...]]) -> list[tuple[int, int]]:
    """Each candidate with the previous one that has one of its keys."""
    last: dict[str, int] = {}
    edges = set()
    for at, own in enumerate(keys):
        for key in own:
            if key in last:
                edges.add((last[key], at))
            last[key] = at
    return sorted(edges)


def marginals(features: np.ndarray, known: list[int], edges: list[tuple[int, int]], w: Weights) -> np.ndarray:
    """Label probabilities per node. `known` has the label of a node that is certain, else -1."""
    n = len(known)
    node = np.exp(np.clip(features @ w.node, -30, 30))
    for at, label in enumerate(known):
        if label >= 0:
            node[at] = np.eye(5)[label]
    chain, agree = np.exp(np.clip(w.chain, -30, 30)), np.exp(np.diag(np.clip(w.skip, -30, 30)))
    links = {(a, a + 1): chain for a in range(n - 1)}
    for edge in edges:
        links[edge] = links[edge] * agree if edge in links else agree
    around: list[list[tuple[int, np.ndarray]]] = [[] for _ in range(n)]
    for (a, b), potential in links.items():
        around[a].append((b, potential.T))  # from b to a
        around[b].append((a, potential))
    ones = np.full(5, 0.2)
    message = {(b, a): ones for a in range(n) for b, _ in around[a]}
    for _ in range(SWEEPS):
        change = 0.0
        for order in (range(n), range(n - 1, -1, -1)):
            for a in order:
                incoming = [message[b, a] for b, _ in around[a]]
                for at, (b, to_a) in enumerate(around[a]):
                    if (b > a) != (order.step > 0):
                        continue
                    belief = node[a].copy()
                    for k, m in enumerate(incoming):
                        if k != at:
                            belief *= m
                    sent = belief @ to_a.T
                    sent /= sent.sum()
                    change = max(change, float(np.abs(sent - message[a, b]).max()))
                    message[a, b] = sent
        if change < TOLERANCE:
            break
    belief = node.copy()
    for a in range(n):
        for b, _ in around[a]:
            belief[a] *= message[b, a]
            belief[a] /= belief[a].sum()
    return belief / belief.sum(1, keepdims=True)
