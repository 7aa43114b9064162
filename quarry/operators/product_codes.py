"""Product codes of residuals, after a learned rotation (the codes of SRCH-4).

A row's residual (its vector less its cell's centroid) is rotated, cut into
``m`` sub-vectors, and each is replaced by the number of its nearest codeword.
Rotation and codewords are learned together on a bounded sample: with the
rotation fixed, codewords move to the means of what they stand for; with the
codewords fixed, the best rotation is the orthogonal Procrustes solution, one
singular value decomposition of a ``d x d`` matrix.  The rotation spreads what
the sub-spaces have to say evenly, which cutting raw vectors does not.

Everything here works on the matrix of one task or of the sample.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np


def nearest(x: np.ndarray, centers: np.ndarray) -> np.ndarray:
    """The nearest center of every row."""
    return np.argmin((centers * centers).sum(1)[None, :] - 2.0 * (x @ centers.T), axis=1)


@dataclass
class ProductCodes:
    rotation: np.ndarray  # (d, d), orthogonal; rows are rotated as ``x @ rotation``
    books: np.ndarray  # (m, codewords, d / m)

    def encode(self, residuals: np.ndarray) -> np.ndarray:
        turned = residuals @ self.rotation
        m, _, ds = self.books.shape
        return np.stack([nearest(turned[:, j * ds:(j + 1) * ds], self.books[j]) for j in range(m)],
                        axis=1).astype(np.int32) if len(turned) else np.zeros((0, m), np.int32)

    def decode(self, codes: np.ndarray) -> np.ndarray:
        turned = np.concatenate([self.books[j][codes[:, j]] for j in range(len(self.books))], axis=1)
        return turned @ self.rotation.T


def update(x: np.ndarray, centers: np.ndarray, code: np.ndarray, rng) -> np.ndarray:
    """Centers moved to the means of their rows; one without rows goes to a random row."""
    count = np.bincount(code, minlength=len(centers))
    order = np.argsort(code, kind="stable")
    filled = np.flatnonzero(count)
    out = x[rng.integers(0, len(x), len(centers))].copy()
    out[filled] = np.add.reduceat(x[order], np.concatenate(([0], np.cumsum(count[filled])[:-1]))) / count[filled][:, None]
    return out


def learn(residuals: np.ndarray, m: int, nbits: int, rounds: int = 20, seed: int = 42) -> ProductCodes:
    """Codes for rows like ``residuals``.  Each round moves the codewords once
    and then solves for the rotation; the first rounds start from a rotation
    along the principal axes, dealt to the sub-spaces in turns."""
    n, d = residuals.shape
    if d % m:
        raise ValueError(f"dimension {d} is not divisible by m={m}")
    rng = np.random.default_rng(seed)
    ds, k = d // m, 2 ** nbits
    if not n:
        return ProductCodes(np.eye(d), np.zeros((m, k, ds)))
    _, axes = np.linalg.eigh(residuals.T @ residuals)
    dealt = [axis for j in range(m) for axis in range(j, d, m)]
    rotation = axes[:, ::-1][:, dealt]
    turned = residuals @ rotation
    start = rng.permutation(n)[np.arange(k) % n]
    books = np.stack([turned[start, j * ds:(j + 1) * ds] for j in range(m)])
    for turn in range(rounds):
        turned = residuals @ rotation
        made = np.empty_like(turned)
        for j in range(m):
            own = slice(j * ds, (j + 1) * ds)
            books[j] = update(turned[:, own], books[j], nearest(turned[:, own], books[j]), rng)
            made[:, own] = books[j][nearest(turned[:, own], books[j])]
        if turn + 1 < rounds:
            u, _, v = np.linalg.svd(residuals.T @ made)
            rotation = u @ v
    return ProductCodes(rotation, books)
