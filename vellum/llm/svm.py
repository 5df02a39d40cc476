"""Linear support vector machines and text features, on numpy."""

from __future__ import annotations

import numpy as np

#: Hash buckets for letter pairs and for letter triples.
BUCKETS = 4096
WIDTH = 2 * BUCKETS
#: Unicode letters by code point; built once in each Python worker.
_LETTERS: list[np.ndarray] = []
#: Code points that are looked at together.
SLICE = 1 << 21


def _letters() -> np.ndarray:
    if not _LETTERS:
        _LETTERS.append(np.fromiter((chr(c).isalpha() for c in range(0x110000)), bool, 0x110000))
    return _LETTERS[0]


def has_letter(text: str) -> bool:
    return any(map(str.isalpha, text))


def counts(text: str) -> np.ndarray:
    """Counts of hashed pairs and triples of letters of a whole text, word edges included."""
    total = np.zeros(WIDTH, np.float64)
    text = text.lower()
    for start in range(0, len(text), SLICE):
        codes = np.frombuffer(text[max(0, start - 2) : start + SLICE].encode("utf-32-le", "surrogatepass"), np.uint32)
        codes = np.where(_letters()[codes], codes, np.uint32(0))
        if not start:
            codes = np.concatenate([np.zeros(1, np.uint32), codes])
        if start + SLICE >= len(text):
            codes = np.concatenate([codes, np.zeros(1, np.uint32)])
        two = codes[:-1] * np.uint32(0x9E3779B1) + codes[1:] * np.uint32(0x85EBCA77)
        three = (two[:-1] ^ two[:-1] >> np.uint32(15)) * np.uint32(0xC2B2AE3D) + codes[2:] * np.uint32(0x27D4EB2F)
        real2 = (codes[:-1] | codes[1:]) > 0
        if start:  # pairs before the overlap's last were counted with the slice before
            real2[0] = False
        real3 = codes[1:-1] > 0
        for at, (h, real) in enumerate(((two, real2), (three, real3))):
            h = h ^ h >> np.uint32(13)
            total[at * BUCKETS : (at + 1) * BUCKETS] += np.bincount((h[real] % np.uint32(BUCKETS)).astype(np.intp), minlength=BUCKETS)
    return total


def features(text: str) -> np.ndarray:
    """Square-rooted counts at unit length, pairs and triples weighing the same."""
    x = np.sqrt(counts(text))
    for half in (x[:BUCKETS], x[BUCKETS:]):
        if (n := np.sqrt(half @ half)) > 0:
            half /= n
    return (x / np.sqrt(2)).astype(np.float32)


def train_svm(x: np.ndarray, y: np.ndarray, cost: float = 10.0, epochs: int = 40, seed: int = 7) -> np.ndarray:
    """Weights (last: bias) of an L2-loss linear SVM for y in {-1, 1}, by dual coordinate descent.

    Costs are balanced between the two classes.  The weights are kept up to date, so that no matrix of all pairs of rows is needed.
    """
    share = np.where(y > 0, np.mean(y > 0), np.mean(y < 0))
    slack = 0.5 / (cost * 0.5 / share)
    diag = np.einsum("ij,ij->i", x, x).astype(np.float64) + 1 + slack  # the bias is one more component of 1
    alpha, w, bias = np.zeros(len(y)), np.zeros(x.shape[1], np.float32), 0.0
    rng = np.random.default_rng(seed)
    for _ in range(epochs):
        moved = 0.0
        for i in rng.permutation(len(y)):
            step = max(-alpha[i], (1 - y[i] * (float(x[i] @ w) + bias) - slack[i] * alpha[i]) / diag[i])
            if abs(step) > 1e-9:
                alpha[i] += step
                w += np.float32(step * y[i]) * x[i]
                bias += step * y[i]
                moved = max(moved, abs(step))
        if moved < 1e-4:
            break
    return np.append(w, np.float32(bias))


def decide(x: np.ndarray, weights: np.ndarray) -> np.ndarray:
    return x @ weights[:-1] + weights[-1]
