"""A linear-chain conditional random field over words, in numpy, for use inside tasks.

Emissions come from hashed features of the word (the word itself, affixes, character n-grams), so a
batch computes them once per distinct word. ``marginals`` runs forward-backward over all sequences of
a batch at once: sequences are cut into blocks, the product of each block's matrices links the blocks,
and the messages inside all blocks are then stepped together. The cut changes no result.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pandas as pd

BLOCK = 48
_MULT = np.uint64(0x9E3779B97F4A7C15)
_STRIP = ".,;:!?\"'()[]{}«»¡¿…“”„*#"


@dataclass(frozen=True)
class Features:
    """Which features of a word are hashed, and into how many slots."""

    bits: int = 17
    prefixes: tuple[int, ...] = (3, 4, 5)
    suffixes: tuple[int, ...] = (3, 4)
    grams: tuple[int, ...] = ()

    def slot(self, h: np.ndarray, kind: int) -> np.ndarray:
        """Slot 0 is kept for "no feature"."""
        mixed = (h + np.uint64(kind)) * _MULT
        mixed ^= mixed >> np.uint64(29)
        mixed *= _MULT
        return ((mixed >> np.uint64(64 - self.bits)) | np.uint64(1)).astype(np.int32)

    def of(self, words: list[str]) -> list[tuple[np.ndarray, np.ndarray]]:
        """For groups of words of similar length: their indices and a matrix of slots."""
        low = [w.lower().strip(_STRIP) or w for w in words]
        lengths = np.fromiter(map(len, low), np.int64, len(low))
        out = []
        width = 8
        todo = lengths <= width
        done = np.zeros(len(low), bool)
        while not done.all():
            for at in np.array_split(idx := np.nonzero(todo & ~done)[0], max(1, len(idx) * width // 400_000 + 1)):
                if len(at):
                    out.append((at, self._matrix([low[i] for i in at], lengths[at], width)))
            done |= todo
            width *= 2
            todo = lengths <= width
        return out

    def _matrix(self, low: list[str], n: np.ndarray, width: int) -> np.ndarray:
        chars = np.array(low, dtype=f"<U{width}").view(np.uint32).reshape(len(low), width).astype(np.uint64)
        chars += (chars > 0)  # an inner NUL differs from padding only by position; the length tells them apart
        place = np.arange(width)
        powers = np.cumprod(np.full(width, 1_000_003, np.uint64))
        columns = [self.slot((chars * powers).sum(1) + n.astype(np.uint64), 1)]
        for k in self.prefixes:
            head = (chars[:, :k] * powers[:k]).sum(1)
            columns.append(np.where(n >= k, self.slot(head, 10 + k), 0))
        for k in self.suffixes:
            take = np.clip(n[:, None] - k + place[:k], 0, width - 1)
            tail = (np.take_along_axis(chars, take, 1) * powers[:k]).sum(1)
            columns.append(np.where(n >= k, self.slot(tail, 30 + k), 0))
        for k in self.grams:
            if width >= k:
                h = sum(chars[:, i : width - k + 1 + i] * powers[i] for i in range(k))
                ids = np.where(place[: width - k + 1] <= (n - k)[:, None], self.slot(h, 50 + k), 0)
                columns.extend(ids.T)
        return np.stack(columns, 1)


@dataclass
class Model:
    features: Features
    weights: np.ndarray  # slots x labels; slot 0 is zero
    moves: np.ndarray  # labels x labels

    def emissions(self, words: list[str]) -> np.ndarray:
        out = np.zeros((len(words), self.weights.shape[1]), np.float32)
        for at, slots in self.features.of(words):
            for lo in range(0, len(at), 8192):
                out[at[lo : lo + 8192]] = self.weights[slots[lo : lo + 8192]].sum(1)
        return out


def coded(texts_words: list[list[str]]) -> tuple[np.ndarray, list[str], np.ndarray]:
    """Codes of all words in order, the distinct words, and the number of words of each text."""
    counts = np.fromiter(map(len, texts_words), np.int64, len(texts_words))
    flat = np.empty(int(counts.sum()), object)
    at = 0
    for words in texts_words:
        flat[at : at + len(words)] = words
        at += len(words)
    codes, distinct = pd.factorize(flat)
    return codes, list(distinct), counts


def _blocks(counts: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Of each block: its first token, its length, its place within its sequence."""
    per = -(-counts // BLOCK)
    starts = np.concatenate(([0], np.cumsum(counts)[:-1])) if len(counts) else np.zeros(0, np.int64)
    seq = np.repeat(np.arange(len(counts)), per)
    place = np.arange(len(seq)) - np.repeat(np.cumsum(per) - per, per)
    first = starts[seq] + place * BLOCK
    return first, np.minimum(BLOCK, counts[seq] - place * BLOCK), place


def _unit(x: np.ndarray) -> np.ndarray:
    """Scale each row (all but the first axis) to a largest entry of one."""
    top = x.reshape(len(x), -1).max(1)
    return x / np.maximum(top, 1e-300).reshape((-1,) + (1,) * (x.ndim - 1))


def marginals(emissions: np.ndarray, counts: np.ndarray, moves: np.ndarray, edges: bool = False):
    """Label probabilities of every token; with ``edges`` also the expected moves between labels.

    A sequence starts from an even mixture of labels.
    """
    n, k = emissions.shape
    if not n:
        return (np.zeros((0, k)), np.zeros((k, k))) if edges else np.zeros((0, k))
    step = np.exp(moves - moves.max()).astype(np.float64)
    e = np.exp(emissions - emissions.max(1, keepdims=True)).astype(np.float64)
    first, size, place = _blocks(counts)
    order = np.argsort(-size, kind="stable")  # longer blocks first: those still running are a prefix
    first, size, place = first[order], size[order], place[order]
    running = [int((size > t).sum()) for t in range(int(size.max()))]
    product = np.tile(np.eye(k), (len(first), 1, 1))
    for t, m in enumerate(running):
        product[:m] = (product[:m].reshape(-1, k) @ step).reshape(m, k, k) * e[first[:m] + t][:, None, :]
        if t % 8 == 7:
            product[:m] = _unit(product[:m])
    product = _unit(product)
    # link the blocks of each sequence
    back = np.empty(len(first), np.int64)  # block in sequence order -> block in this order
    back[order] = np.arange(len(first))
    enter = np.full((len(first), k), 1.0 / k)
    leave = np.ones((len(first), k))
    by_place = np.argsort(place, kind="stable")
    bounds = np.searchsorted(place[by_place], np.arange(int(place.max()) + 2))
    ordered = np.empty(len(first), np.int64)
    ordered[:] = order  # place of each block in sequence order
    for p in range(1, int(place.max()) + 1):
        at = by_place[bounds[p] : bounds[p + 1]]
        before = back[ordered[at] - 1]
        enter[at] = _unit(np.einsum("ni,nij->nj", enter[before], product[before]))
    for p in range(int(place.max()), 0, -1):
        at = by_place[bounds[p] : bounds[p + 1]]
        before = back[ordered[at] - 1]
        leave[before] = _unit(np.einsum("nij,nj->ni", product[at], leave[at]))
    # messages inside the blocks
    alpha = np.empty((n, k))
    previous = np.empty((n, k)) if edges else None
    now = enter.copy()
    for t, m in enumerate(running):
        if edges:
            previous[first[:m] + t] = now[:m]
        now[:m] = _unit((now[:m] @ step) * e[first[:m] + t])
        alpha[first[:m] + t] = now[:m]
    beta = np.empty((n, k))
    now = leave.copy()
    for t in range(len(running) - 1, -1, -1):
        m = running[t]
        beta[first[:m] + t] = now[:m]
        now[:m] = _unit((now[:m] * e[first[:m] + t]) @ step.T)
    joint = alpha * beta
    total = joint.sum(1, keepdims=True)
    gamma = joint / np.maximum(total, 1e-300)
    if not edges:
        return gamma
    after = e * beta
    norm = ((previous @ step) * after).sum(1, keepdims=True)
    return gamma, step * ((previous / np.maximum(norm, 1e-300)).T @ after)


def train(features: Features, distinct: list[str], codes: np.ndarray, counts: np.ndarray, labels: np.ndarray, n_labels: int,
          rounds: int = 40, ridge: float = 1e-5, rate: float = 0.15, weight: np.ndarray | None = None) -> Model:
    """Fit by gradient ascent on the likelihood (Adam), all sequences in every round."""
    parts = features.of(distinct)
    slots = 1 << features.bits
    w, a = np.zeros((slots, n_labels), np.float32), np.zeros((n_labels, n_labels))
    m, v, ma, va = np.zeros_like(w), np.zeros_like(w), np.zeros_like(a), np.zeros_like(a)
    inner = np.ones(len(codes), bool)
    inner[(np.cumsum(counts) - counts)[counts > 0]] = False
    seen = np.zeros((n_labels, n_labels))
    pairs = np.nonzero(inner)[0]
    np.add.at(seen, (labels[pairs - 1], labels[pairs]), 1)
    starts = np.bincount(labels[~inner], minlength=n_labels)
    scale = 1.0 / max(1, len(codes))
    for r in range(1, rounds + 1):
        model = Model(features, w, a)
        gamma, moved = marginals(model.emissions(distinct)[codes], counts, a, edges=True)
        gap = -gamma
        gap[np.arange(len(codes)), labels] += 1
        by_word = np.stack([np.bincount(codes, gap[:, k], len(distinct)) for k in range(n_labels)], 1)
        g = np.zeros((slots, n_labels), np.float32)
        for at, ids in parts:
            for k in range(n_labels):
                g[:, k] += np.bincount(ids.ravel(), np.repeat(by_word[at, k], ids.shape[1]), slots)
        g = g * scale - ridge * w
        g[0] = 0
        ga = (seen + starts[None, :] / n_labels - moved) * scale - ridge * a
        for x, gx, mx, vx in ((w, g, m, v), (a, ga, ma, va)):
            mx += 0.1 * (gx - mx)
            vx += 0.01 * (gx * gx - vx)
            x += rate * (mx / (1 - 0.9**r)) / (np.sqrt(vx / (1 - 0.99**r)) + 1e-7)
    return Model(features, w, a)
