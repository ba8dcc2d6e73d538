"""Toxic spans by a linear-chain conditional random field.

``labels`` marks documents, not tokens, so tokens are labelled first: word and affix features that the
toxic documents of the sample have far more often than the clean ones (by log-likelihood ratio, copies
counted once) are looked up, and a token of a toxic document that has such a feature is a toxic token. On these labelled
tokens the field is trained; its forward-backward marginals say how likely each word of a text is
toxic in its context. The score of a document is a logistic function of its largest marginal and its
expected number of toxic words, fitted on the same sample and weighted to the share of toxic documents
among all labelled ones. Offending offsets are those of words with a marginal of one half or more.

The sample is bounded (``SAMPLE`` documents of each label, ``TRAIN_WORDS`` words for the field);
scoring covers every text as a whole, in tasks, without a shuffle.

Null and empty texts, and texts without words, get the score of a text without any toxic word. Without
labelled rows of both labels every score is the share of toxic rows, or zero. Repeated rows and ids are
scored each on their own; null ids are kept (held_out null). Only ``doc_id`` and ``text`` are read.
"""

from __future__ import annotations

import re
from dataclasses import dataclass

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import crf
from .common import fold, keep_columns, map_texts, unused
from .samples import labelled_ids, texts_of

#: Most documents of each label in the sample, and most words the field is trained on.
SAMPLE, TRAIN_WORDS = 1500, 250_000
#: Word Jaccard from which a toxic row counts as a copy of an earlier one.
COPY = 0.8
#: Characters of text handled at once in a task.
BATCH_CHARS = 1_500_000
FEATURES = crf.Features(bits=18, prefixes=(4, 5, 6, 7), suffixes=(3, 4))
#: Columns of the feature matrix that may mark a token: the word and its first four to seven characters.
MARKING = (0, 1, 2, 3, 4)
FIELDS = [("score", "double"), ("n_toxic_words", "long"), ("spans", "array<struct<start:int,end:int,p:double>>")]


@dataclass
class Scorer:
    model: crf.Model | None
    coef: np.ndarray

    def score(self, summary: np.ndarray) -> np.ndarray:
        z = np.clip(summary @ self.coef, -30, 30)
        return 1 / (1 + np.exp(-z))


def summaries(model: crf.Model, texts: list[str]):
    """Of each text: one, the logit of the largest marginal, log of one plus the expected toxic words. And the marginals."""
    words = [t.split() for t in texts]
    codes, distinct, counts = crf.coded(words)
    p = crf.marginals(model.emissions(distinct)[codes], counts, model.moves)[:, 1]
    top, total = np.zeros(len(texts)), np.zeros(len(texts))
    full = counts > 0
    if full.any():
        starts = (np.cumsum(counts) - counts)[full]
        top[full], total[full] = np.maximum.reduceat(p, starts), np.add.reduceat(p, starts)
    top = np.clip(top, 1e-4, 1 - 1e-4)
    return np.stack([np.ones(len(texts)), np.log(top / (1 - top)), np.log1p(total)], 1), p, counts


def not_copies(codes: np.ndarray, counts: np.ndarray, rows: np.ndarray) -> np.ndarray:
    """Which of ``rows`` are no copies: their word Jaccard with each earlier one that is none is under ``COPY``.

    Words of a document that is copied many times would pass for words of toxic documents.
    """
    place = np.full(len(counts), -1)
    place[rows] = np.arange(len(rows))
    n, doc = len(rows), place[np.repeat(np.arange(len(counts)), counts)]
    width = int(codes.max(initial=0)) + 1
    pairs = np.unique((doc * np.int64(width) + codes)[doc >= 0])
    doc, word = pairs // width, pairs % width
    sizes = np.bincount(doc, minlength=n)
    # words of two or more rows only, in blocks: the others are in no intersection
    often = np.bincount(word, minlength=width)[word] > 1
    doc, (distinct, word) = doc[often], np.unique(word[often], return_inverse=True)
    order = np.argsort(word, kind="stable")
    doc, word = doc[order], word[order]
    both = np.zeros((n, n), np.float32)
    for lo in range(0, len(distinct), 4096):
        a, b = np.searchsorted(word, (lo, lo + 4096))
        held = np.zeros((n, min(4096, len(distinct) - lo)), np.float32)
        held[doc[a:b], word[a:b] - lo] = 1
        both += held @ held.T
    kept = np.ones(n, bool)
    for i in range(1, n):
        total = sizes[:i] + sizes[i] - both[i, :i]
        kept[i] = not (kept[:i] & (total > 0) & (both[i, :i] >= COPY * total)).any()
    return kept


def marking_features(slots: np.ndarray, codes: np.ndarray, counts: np.ndarray, toxic: np.ndarray,
                     least_g: float = 14.0, least_ratio: float = 20.0) -> np.ndarray:
    """Features that toxic documents have far more often than clean ones (log-likelihood ratio and ratio of shares)."""
    use = ~toxic
    rows = np.nonzero(toxic)[0]
    use[rows[not_copies(codes, counts, rows)]] = True
    doc = np.repeat(np.arange(len(counts)), counts)
    width = int(slots.max(initial=0)) + 1
    pairs = np.unique(np.concatenate([doc * np.int64(width) + slots[codes, c] for c in range(slots.shape[1])]))
    d, f = pairs // width, pairs % width
    d, f = d[(f > 0) & use[d]], f[(f > 0) & use[d]]
    n1, n0 = int((toxic & use).sum()), int((~toxic & use).sum())
    a, b = np.bincount(f[toxic[d]], minlength=width), np.bincount(f[~toxic[d]], minlength=width)
    both = a + b
    with np.errstate(divide="ignore", invalid="ignore"):
        g = 2 * (np.where(a, a * np.log(a * (n1 + n0) / (both * n1)), 0) + np.where(b, b * np.log(b * (n1 + n0) / (both * n0)), 0))
    ratio = ((a + 0.5) / (n1 + 1)) / ((b + 0.5) / (n0 + 1))
    return np.nonzero((a >= 2) & (g >= least_g) & (ratio >= least_ratio))[0]


def fit(docs: DataFrame, labels: DataFrame, folds: int = 3, held_out: int = 1) -> Scorer:
    """Learn from labelled rows whose ``crc32(doc_id) mod folds`` is not ``held_out``."""
    allowed = fold(F.col("doc_id"), folds) != held_out
    known = labels.where(F.col("toxic").isin(0, 1) & F.col("doc_id").isNotNull() & allowed)
    share = known.agg(F.avg("toxic")).first()[0] or 0.0
    sample = texts_of(docs, labelled_ids(labels, "toxic", allowed, SAMPLE), 4 * SAMPLE)
    toxic = sample["label"].to_numpy() == 1
    if not toxic.any() or toxic.all():
        p = float(np.clip(share, 1e-6, 1 - 1e-6))
        return Scorer(None, np.array([np.log(p / (1 - p)), 0.0, 0.0]))
    words = [t.split() for t in sample["text"]]
    codes, distinct, counts = crf.coded(words)
    slots = np.zeros((len(distinct), len(MARKING)), np.int32)
    for at, ids in FEATURES.of(distinct):
        slots[at] = ids[:, MARKING]
    marks = np.isin(slots, marking_features(slots, codes, counts, toxic)).any(1)
    tokens = (marks[codes] & np.repeat(toxic, counts)).astype(np.int64)
    # whole documents, toxic and clean in turn, up to the bound
    turn = np.argsort(np.where(toxic, np.cumsum(toxic), np.cumsum(~toxic)), kind="stable")
    used = turn[np.cumsum(counts[turn]) <= TRAIN_WORDS]
    ends = np.cumsum(counts)
    at = np.concatenate([np.arange(ends[i] - counts[i], ends[i]) for i in used]) if len(used) else np.zeros(0, np.int64)
    part, back = np.unique(codes[at], return_inverse=True)
    model = crf.train(FEATURES, [distinct[i] for i in part], back, counts[used], tokens[at], 2, rounds=30)
    x = np.concatenate([summaries(model, list(sample["text"][lo : lo + 200]))[0] for lo in range(0, len(sample), 200)])
    weight = np.where(toxic, share / toxic.mean(), (1 - share) / (1 - toxic.mean()))
    return Scorer(model, _logistic(x, toxic.astype(float), weight))


def _logistic(x: np.ndarray, y: np.ndarray, weight: np.ndarray, ridge: float = 1e-2) -> np.ndarray:
    """Ridge-penalised logistic regression by Newton's method."""
    coef = np.zeros(x.shape[1])
    hold = ridge * len(y) * np.diag([1e-6] + [1.0] * (x.shape[1] - 1)) / 10
    for _ in range(25):
        p = 1 / (1 + np.exp(-np.clip(x @ coef, -30, 30)))
        h = (x * (weight * p * (1 - p))[:, None]).T @ x + hold + 1e-9 * np.eye(len(coef))
        coef = coef + np.clip(np.linalg.solve(h, x.T @ (weight * (y - p)) - hold @ coef), -5, 5)
    return coef


def score_documents(docs: DataFrame, scorer: Scorer) -> DataFrame:
    """doc_id, score, n_toxic_words, spans (code points, end exclusive) of every row."""
    return map_texts(docs, "text", ["doc_id"], FIELDS, lambda texts: _scored([t or "" for t in texts], scorer), BATCH_CHARS)


def _scored(texts: list[str], scorer: Scorer) -> list:
    spans: list[list[dict]] = [[] for _ in texts]
    if scorer.model is None:
        x = np.tile([1.0, 0.0, 0.0], (len(texts), 1))
    else:
        x, p, counts = summaries(scorer.model, texts)
        ends = np.cumsum(counts)
        for i in np.unique(np.searchsorted(ends, np.nonzero(p >= 0.5)[0], side="right")):
            own = p[ends[i] - counts[i] : ends[i]]
            spans[i] = [{"start": m.start(), "end": m.end(), "p": float(q)} for m, q in zip(_words(texts[i]), own) if q >= 0.5]
    return [scorer.score(x), [len(s) for s in spans], spans]


def _words(text: str):
    """Matches of the words that ``str.split()`` gives."""
    return re.finditer(r"[^\s\x1c-\x1f\x85]+", text)


def toxicity(docs: DataFrame, labels: DataFrame, threshold: float = 0.7) -> DataFrame:
    """doc_id, held_out, score, predicted, n_toxic_words, spans."""
    scored = score_documents(docs, fit(docs, labels))
    return scored.select(
        "doc_id", (fold(F.col("doc_id"), 3) == 1).alias("held_out"), "score",
        F.when(F.col("score") >= threshold, 1).otherwise(0).alias("predicted"), "n_toxic_words", "spans")


def reject(docs: DataFrame, labels: DataFrame, threshold: float = 0.7) -> DataFrame:
    """The rows of ``docs`` with a score under the threshold, with all their columns."""
    scorer, name = fit(docs, labels), unused(docs, "score")
    scored = map_texts(docs, "text", docs.columns, [(name, "double")], lambda texts: _scored([t or "" for t in texts], scorer)[:1], BATCH_CHARS)
    return keep_columns(scored.where(F.col(name) < threshold), docs.columns)
