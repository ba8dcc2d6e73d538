"""Periodic runs of words, caught online.

A *run* is a stretch of words with smallest period ``q`` (words ``q`` apart are equal) that is at least two
periods long and that no neighbouring word extends. ``Catcher`` reads a text by appending words. A square
(a stretch of two equal halves) of period ``q >= 2c - 1`` holds, in its first half, a whole block of ``c`` words that
starts at a multiple of ``c``. So for every power of two ``c`` each completed block keeps a catcher, awake for
the periods from ``2c - 1`` to ``4c - 2``: after an appended word, the last ``c`` words are compared with
the two blocks awake at such distances. Where they are equal, both are extended to both sides; it is a square once the
whole is two periods long, and squares of one period and start are one run. A stretch that reaches
the end of the text stays open, and each appended word advances its comparison. Comparisons are by
fingerprints modulo 2**64, which equal stretches always share; every run is compared word by word before it is
reported, and cut to its longest stretch that agrees should a fingerprint have been wrong.

Words may be appended one by one or many at a time, with the same runs. A text takes O(n log n) fingerprint
comparisons, in slices of ``SLICE`` words, so what a task holds at once is one text and its runs.

Documents are read in tasks without a shuffle, each whole. Null, empty and blank texts have no words and no runs.
Repeated rows and ids are read each on their own, null ids are kept. Only ``doc_id`` and ``text`` are read,
so other columns cannot clash. Ties of the greatest length go to the smallest start, then the smallest period.
"""

from __future__ import annotations

import re

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import map_texts

WORD = re.compile(r"[^\x20\x09-\x0D]+")
#: A run counts from so many words and so many periods on.
LEAST, PERIODS = 6, 4
#: Appended words whose comparisons are made at once.
SLICE = 1 << 16

_BASE = 0x9E3779B97F4A7C15 | 1
_BACK = pow(_BASE, -1, 1 << 64)
_U = np.uint64


_POWERS = {base: np.ones(1, _U) for base in (_BASE, _BACK)}


def _powers(base: int, n: int) -> np.ndarray:
    """base**0 .. base**(n - 1) modulo 2**64, kept for the next text of the task."""
    known = _POWERS[base]
    if len(known) < n:
        known = np.full(max(n, 2 * len(known)), base, _U)
        known[0] = 1
        np.multiply.accumulate(known, out=known)
        _POWERS[base] = known
    return known


def _mixed(x: np.ndarray) -> np.ndarray:
    """A well mixed 64-bit number for each word number."""
    x = (x.astype(_U) + _U(1)) * _U(0x9E3779B97F4A7C15)
    x = (x ^ (x >> _U(30))) * _U(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> _U(27))) * _U(0x94D049BB133111EB)
    return x ^ (x >> _U(31))


class Catcher:
    """Reads word numbers and knows the runs of the words so far that are ``periods`` (2 or more) periods long."""

    def __init__(self, periods: int = 2, room: int = 64):
        self.periods, self.n = periods, 0
        self.words = np.zeros(room, np.int64)
        self.sums = np.zeros(room + 1, _U)  # sums[i]: of mixed(word j) * BACK**j over j < i
        self.caught: dict[tuple[int, int], int] = {}  # (start, period): end
        self.open: list[tuple[int, int]] = []  # those that reach the end of the text

    def append(self, words) -> None:
        """Append word numbers: one, or many at a time."""
        words = np.asarray(words, np.int64)
        for at in range(0, len(words), SLICE):
            self._advance(words[at: at + SLICE])

    def _advance(self, new: np.ndarray) -> None:
        first, n = self.n, self.n + len(new)
        if n > len(self.words):
            room = max(n, 2 * len(self.words)) - len(self.words)
            self.words, self.sums = np.pad(self.words, (0, room)), np.pad(self.sums, (0, room))
        self.words[first:n] = new
        self.sums[first + 1: n + 1] = self.sums[first] + np.cumsum(_mixed(new) * _powers(_BACK, n + 1)[first:n], dtype=_U)
        self.up, self.n = _powers(_BASE, n + 1), n
        self._extend_open()
        blocks, begins, sizes = [], [], []
        c = 1
        while (2 * c - 1) * (self.periods - 1) <= n:
            begin = np.arange(max(first - c + 1, 2 * c - 1), n - c + 1)  # of the last c words, after each appended one
            near = (begin - (2 * c - 1)) // c * c
            blocks += [near, near - c]
            begins += [begin, begin]
            sizes.append(np.full(2 * len(begin), c))
            c *= 2
        if blocks:
            self._compare(np.concatenate(blocks), np.concatenate(begins), np.concatenate(sizes))

    def _same(self, a: np.ndarray, b: np.ndarray, length) -> np.ndarray:
        """For a <= b: where the ``length`` words from ``a`` and from ``b`` on have equal fingerprints."""
        return self.sums[a + length] - self.sums[a] == (self.sums[b + length] - self.sums[b]) * self.up[b - a]

    def _agree(self, a: np.ndarray, b: np.ndarray, back: bool) -> np.ndarray:
        """For a < b: how many words from them on (or before them) agree, by doubling and halving of the step."""
        got = np.zeros(len(a), np.int64)
        most = a if back else self.n - b
        step = 1 << max(0, int(most.max(initial=0)).bit_length() - 1)
        while step:
            s = np.where(got + step <= most, step, 0)
            at = -got - s if back else got
            got += np.where(self._same(a + at, b + at, s), s, 0)
            step >>= 1
        return got

    def _extend_open(self) -> None:
        """Runs that reached the end go on as long as the new words agree."""
        if not self.open:
            return
        q = np.array([q for _, q in self.open], np.int64)
        end = np.array([self.caught[k] for k in self.open], np.int64)
        end += self._agree(end - q, end, back=False)
        still = []
        for k, e in zip(self.open, end.tolist()):
            self.caught[k] = e
            if e == self.n:
                still.append(k)
            elif e - k[0] < 2 * k[1]:  # no square
                del self.caught[k]
        self.open = still

    def _compare(self, block: np.ndarray, begin: np.ndarray, c: np.ndarray) -> None:
        """Catch squares where the ``c`` words of a block return at ``begin``."""
        awake = np.flatnonzero((block >= 0) & ((begin - block) * (self.periods - 1) <= begin + c))
        awake = awake[self.words[block[awake]] == self.words[begin[awake]]]
        a, b, c = block[awake], begin[awake], c[awake]
        hit = self._same(a, b, c)
        if not hit.any():
            return
        a, b, c = a[hit], b[hit], c[hit]
        start, end = a - self._agree(a, b, back=True), b + c + self._agree(a + c, b + c, back=False)
        keep = (end - start >= 2 * (b - a)) | (end == self.n)
        for s, q, e in set(zip(start[keep].tolist(), (b - a)[keep].tolist(), end[keep].tolist())):
            if (s, q) not in self.caught:
                self.caught[(s, q)] = e
                if e == self.n:
                    self.open.append((s, q))

    def runs(self, least: int = 2, periods: int | None = None) -> list[tuple[int, int, int]]:
        """(start, length, period) of the runs of ``least`` words and ``periods`` periods, by start and period."""
        periods = self.periods if periods is None else periods
        by_bounds: dict[tuple[int, int], int] = {}
        for (s, q), e in self.caught.items():
            if e - s >= max(least, periods * q):
                s, e = self._checked(s, e, q)
                if e - s >= max(least, periods * q):
                    by_bounds[(s, e)] = min(q, by_bounds.get((s, e), q))  # multiples of a period share its bounds
        return sorted((s, e - s, q) for (s, e), q in by_bounds.items())

    def _checked(self, s: int, e: int, q: int) -> tuple[int, int]:
        """The bounds, if words q apart are equal; else those of the longest such stretch inside."""
        same = self.words[s: e - q] == self.words[s + q: e]
        if same.all():
            return s, e
        breaks = np.flatnonzero(~same)
        edges = np.concatenate([[-1], breaks, [len(same)]])
        k = int(np.argmax(np.diff(edges)))
        return s + int(edges[k]) + 1, s + int(edges[k + 1]) + q


def numbered(words: list[str]) -> list[int]:
    """Equal words to equal numbers."""
    known: dict[str, int] = {}
    return [known.setdefault(w, len(known)) for w in words]


def runs_of(words: list[str], least: int = LEAST, periods: int = PERIODS) -> list[tuple[int, int, int]]:
    """(start, length, period) of the runs of a list of words."""
    if len(words) < max(least, periods):
        return []
    catcher = Catcher(periods, len(words))
    catcher.append(numbered(words))
    return catcher.runs(least)


def collapsed(words: list[str], runs: list[tuple[int, int, int]]) -> list[str]:
    """The words without those that a run repeats after its first period."""
    if not runs:
        return words
    edge = np.zeros(len(words) + 1, np.int64)
    for start, length, period in runs:
        edge[start + period] += 1
        edge[start + length] -= 1
    return [w for w, n in zip(words, np.cumsum(edge).tolist()) if not n]


def _rows(texts: list[str | None], least: int, periods: int) -> list:
    out: list[tuple] = []
    for text in texts:
        words = WORD.findall(text or "")
        runs = runs_of(words, least, periods)
        out.append((len(words), [{"start": s, "length": n, "period": q} for s, n, q in runs], " ".join(collapsed(words, runs))))
    return [list(c) for c in zip(*out)] if out else [[], [], []]


def periodic_runs(docs: DataFrame, least: int = LEAST, periods: int = PERIODS) -> DataFrame:
    """doc_id, n_words, runs (structs start, length, period, by start and period) and collapsed, the text without repeats, of every row."""
    if periods < 2:
        raise ValueError("a run has two periods at least")
    fields = [("n_words", "long"), ("runs", "array<struct<start:long,length:long,period:long>>"), ("collapsed", "string")]
    return map_texts(docs, "text", ["doc_id"], fields, lambda texts: _rows(texts, least, periods))


def digests(found: DataFrame) -> DataFrame:
    """doc_id, n_runs, the longest run (start, length, period, exponent_milli; null without one) and digests of all runs and of the kept words."""
    first = F.array_min(F.transform("runs", lambda r: F.struct((-r["length"]).alias("back"), r["start"].alias("start"), r["period"].alias("period"))))
    told = F.transform("runs", lambda r: F.concat(F.concat_ws(",", r["start"], r["length"], r["period"]), F.lit("\n")))
    rows = found.select("doc_id", "runs", "collapsed", first.alias("x"), F.array_join(told, "").alias("told"))
    return rows.select(
        "doc_id",
        F.size("runs").cast("long").alias("n_runs"),
        F.col("x.start").alias("start"),
        (-F.col("x.back")).alias("length"),
        F.col("x.period").alias("period"),
        F.expr("(1000 * -x.back) div x.period").alias("exponent_milli"),
        F.sha2("told", 256).alias("runs_sha256"),
        F.sha2("collapsed", 256).alias("collapsed_sha256"),
    )
