"""Exact Shapley contributions of tree leaves, many leaves and rows at a time.

Along a path the conditions on one feature join to one interval. A row pays a leaf's value
when it lies in all intervals; with a feature left out, its interval counts by the share of
training rows that passed. The Shapley value of a feature in such a product game is the integral over t from 0 to 1 of the
product, over the other features of the path, of ``share * (1 - t) + inside * t``. That is a polynomial of a degree
below the path length, which Gauss-Legendre nodes integrate exactly, so work per leaf grows with the square of
the path length, not with the number of subsets.
"""

from __future__ import annotations

import numpy as np

#: Pairs of a row and a leaf that are worked on at once.
PAIRS = 50_000


def _of_length(x: np.ndarray, value, feature, low, high, passed, result: np.ndarray) -> None:
    """Add the contributions of leaves (first axis) whose paths have equally many features (second axis)."""
    m = feature.shape[1]
    seen = x[:, feature]  # rows, leaves, features of the path
    inside = ((seen > low) & (seen <= high)).astype(float)
    nodes, weights = np.polynomial.legendre.leggauss((m + 1) // 2)  # exact up to degree m
    others = np.zeros(inside.shape)
    for t, w in zip((nodes + 1) / 2, weights / 2):
        factor = np.maximum(passed * (1 - t) + inside * t, 1e-300)
        others += w * factor.prod(axis=2)[:, :, None] / factor
    paid = ((inside - passed) * others * np.asarray(value)[:, None]).reshape(len(x), -1)
    of = feature.ravel()
    for f in np.unique(of):
        result[:, f] += paid[:, of == f].sum(axis=1)


def contributions(x: np.ndarray, value, features, low, high, passed) -> np.ndarray:
    """One contribution per row of ``x`` and feature.

    The leaves come as sequences: their value and, per feature on the path, its number, the bounds of its interval
    (above ``low``, up to ``high``) and the share of training rows that passed.
    """
    result = np.zeros(x.shape)
    lengths = np.array([len(f) for f in features], dtype=int)
    for m in np.unique(lengths[lengths > 0]):
        of = np.flatnonzero(lengths == m)
        table = [np.array([list(column[k]) for k in of], dtype=float) for column in (features, low, high, passed)]
        paid, number = np.asarray(value, float)[of], table[0].astype(int)
        rows = max(1, min(len(x), 512))
        step = max(1, PAIRS // rows)
        for first in range(0, len(x), rows):
            some = slice(first, first + rows)
            for at in range(0, len(of), step):
                leaves = slice(at, at + step)
                _of_length(x[some], paid[leaves], number[leaves], *[t[leaves] for t in table[1:]], result[some])
    return result
