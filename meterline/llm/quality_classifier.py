"""Quality scores: random Fourier features, ridge regression, isotonic calibration.

Each text is described by a fixed number of statistics. A Gaussian kernel over the standardised statistics is
approximated by random Fourier features cos(w.x + b); the ridge weights come from the normal equations,
whose sums are added up by partition, so only one matrix of the size of the features reaches the
driver. A last step maps ridge scores to probabilities by isotonic regression (pool adjacent
violators) on scores of labelled rows that the ridge has not seen, counted in bins.

The statistics of all documents are written once; labels join them, not the texts. All labelled rows
allowed take part, none is sampled.

Null and empty texts have the statistics of a text without words and are scored like any other. Without
labelled rows of both labels all scores are the share of label 1, or zero. Repeated rows and ids are scored each on
their own; null ids are kept (held_out null). A repeated id in ``labels`` counts with its largest
label. Only ``doc_id`` and ``text`` are read.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import fold, map_texts, stored

STATISTICS = (
    "log_words", "word_length", "distinct", "most_common", "equal_neighbours", "symbols", "upper", "digits",
    "stops", "bars", "marked", "exclaimed", "log_lines", "repeated_lines", "words_per_line", "unlettered",
)
#: Number of Fourier features, width of the kernel in standard deviations, ridge, seed of the draw, bins of the calibration.
WIDTH, GAMMA, RIDGE, SEED, BINS = 160, 0.08, 1e-3, 17, 400
_SYMBOL, _UPPER, _DIGIT, _STOP = (re.compile(p) for p in (r"[#*$%&|<>@~^_=+{}\\\[\]]", r"[A-Z]", r"[0-9]", r"[.!?]"))


def statistics(text: str | None) -> list[float]:
    text = text or ""
    words = text.split()
    n, chars = len(words), len(text)
    if not n:
        return [0.0] * len(STATISTICS)
    letters = len("".join(words))
    counts = Counter(words)
    lines = [x for x in text.split("\n") if x.strip()]
    return [
        np.log1p(n), min(letters / n, 50.0), len(counts) / n, max(counts.values()) / n,
        sum(map(str.__eq__, words, words[1:])) / n,
        len(_SYMBOL.findall(text)) / n, len(_UPPER.findall(text)) / letters, len(_DIGIT.findall(text)) / letters,
        len(_STOP.findall(text)) / n, text.count("|") / n,
        sum(1 for w in counts if not w[-1].isalnum() and len(w) > 3 and w[-1] == w[-2] == w[-3]) / len(counts),
        text.count("!") / n, np.log1p(len(lines)), 1 - len(set(lines)) / max(1, len(lines)), min(n / max(1, len(lines)), 1000.0) / 100,
        sum(1 for w in counts if not any(map(str.isalpha, w))) / len(counts),
    ]


def describe(docs: DataFrame) -> DataFrame:
    """doc_id and x, the statistics, of every row."""
    return map_texts(docs, "text", ["doc_id"], [("x", "array<double>")], lambda texts: [[statistics(t) for t in texts]])


@dataclass
class Scorer:
    mean: np.ndarray
    spread: np.ndarray
    freq: np.ndarray
    phase: np.ndarray
    weights: np.ndarray
    knots: np.ndarray  # ridge scores and their probabilities, both rising
    values: np.ndarray

    def features(self, x: np.ndarray) -> np.ndarray:
        z = np.clip((x - self.mean) / self.spread, -6, 6)
        return np.c_[np.cos(z @ self.freq + self.phase) * np.sqrt(2 / WIDTH), np.ones(len(x))]

    def raw(self, x: np.ndarray) -> np.ndarray:
        return self.features(x) @ self.weights

    def score(self, x: np.ndarray) -> np.ndarray:
        return np.clip(np.interp(self.raw(x), self.knots, self.values), 0, 1)


def _matrix(column) -> np.ndarray:
    return np.array(column.to_pylist() if isinstance(column, pa.Array) else list(column), np.float64).reshape(-1, len(STATISTICS))


def _moments(rows: DataFrame) -> tuple[np.ndarray, np.ndarray]:
    """Mean and spread of the statistics, from sums."""
    cells = rows.select(F.posexplode("x").alias("k", "v")).groupBy("k").agg(F.avg("v").alias("m"), F.stddev_pop("v").alias("s")).collect()
    mean, spread = np.zeros(len(STATISTICS)), np.ones(len(STATISTICS))
    for r in cells:
        mean[r["k"]], spread[r["k"]] = r["m"], max(r["s"] or 0, 1e-6)
    return mean, spread


def _normal_equations(rows: DataFrame, scorer: Scorer) -> tuple[np.ndarray, np.ndarray]:
    """Sums of z z' and z y over rows (x, label): each task adds up its own, the rows of the matrix are then added by key."""

    def sums(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        total = np.zeros((WIDTH + 1, WIDTH + 2))
        for frame in frames:
            z = scorer.features(_matrix(frame["x"]))
            total += z.T @ np.c_[z, frame["label"].to_numpy(np.float64)]
        yield pd.DataFrame({"i": np.arange(WIDTH + 1), "v": list(total)})

    def add(key: tuple, frame: pd.DataFrame) -> pd.DataFrame:
        return pd.DataFrame({"i": [key[0]], "v": [np.sum(np.stack(frame["v"]), 0)]})

    parts = rows.mapInPandas(sums, "i int, v array<double>")
    got = parts.groupBy("i").applyInPandas(add, "i int, v array<double>").collect()
    whole = np.zeros((WIDTH + 1, WIDTH + 2))
    for r in got:
        whole[r["i"]] = r["v"]
    return whole[:, :-1], whole[:, -1]


def isotonic(x: np.ndarray, ones: np.ndarray, n: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Pool adjacent violators over bins sorted by x: the places and rising shares of the pools."""
    pools: list[list[float]] = []  # sum of x*n, ones, n
    for a, b, c in zip(x, ones, n):
        pools.append([a * c, b, c])
        while len(pools) > 1 and pools[-2][1] * pools[-1][2] >= pools[-1][1] * pools[-2][2]:
            last = pools.pop()
            pools[-1] = [p + q for p, q in zip(pools[-1], last)]
    return np.array([p[0] / p[2] for p in pools]), np.array([p[1] / p[2] for p in pools])


def fit(described: DataFrame, labels: DataFrame, folds: int = 5, held_out: int = 0) -> Scorer:
    """Learn from labelled rows whose ``crc32(doc_id) mod folds`` is not ``held_out``.

    Half of them (by a hash of the id) fit the ridge, the others the calibration.
    """
    known = labels.where(F.col("doc_id").isNotNull() & F.col("quality").isin(0, 1) & (fold(F.col("doc_id"), folds) != held_out))
    known = known.groupBy("doc_id").agg(F.max("quality").alias("label"))
    rows = stored(described.join(known, "doc_id").select("x", "label", (F.pmod(F.xxhash64("doc_id"), F.lit(2)) == 0).alias("first")))
    told = {r["first"]: (r["n"], r["ones"]) for r in rows.groupBy("first").agg(F.count("*").alias("n"), F.sum("label").alias("ones")).collect()}
    n, ones = (sum(t[i] for t in told.values()) for i in (0, 1))
    rng = np.random.default_rng(SEED)
    k = len(STATISTICS)
    mean, spread = _moments(rows)
    scorer = Scorer(mean, spread, rng.normal(0, np.sqrt(2 * GAMMA), (k, WIDTH)), rng.uniform(0, 2 * np.pi, WIDTH),
                    np.zeros(WIDTH + 1), np.array([0.0]), np.array([ones / n if n else 0.0]))
    if not n or ones in (0, n):
        return scorer
    fitted = rows.where("first") if told.get(True, (0, 0))[0] >= 2 else rows
    left, right = _normal_equations(fitted, scorer)
    scorer.weights = np.linalg.solve(left + RIDGE * max(1.0, left[-1, -1]) * np.eye(len(left)) / 10, right)
    others = rows.where("not first") if told.get(False, (0, 0))[0] >= 2 else rows

    def binned(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            s = scorer.raw(_matrix(frame["x"]))
            yield pd.DataFrame({"bin": np.floor(np.clip(s, -1, 2) * BINS).astype(np.int64), "s": s, "label": frame["label"].to_numpy()})

    bins = others.mapInPandas(binned, "bin long, s double, label double").groupBy("bin").agg(
        F.avg("s").alias("s"), F.sum("label").alias("ones"), F.count("*").alias("n")).orderBy("bin").toPandas()
    knots, values = isotonic(bins["s"].to_numpy(), bins["ones"].to_numpy(), bins["n"].to_numpy(np.float64))
    # ties within a pool keep the order of the ridge scores by a slope too small to move a share
    scorer.knots, scorer.values = knots, np.clip(values, 0, 1)
    return scorer


def quality(docs: DataFrame, labels: DataFrame, threshold: float = 0.3) -> DataFrame:
    """doc_id, held_out, score, predicted."""
    described = stored(describe(docs))
    scorer = fit(described, labels)

    def scored(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if len(batch):
                yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(scorer.score(_matrix(batch.column(1))), pa.float64())], names=["doc_id", "score"])

    out = described.select("doc_id", "x").mapInArrow(scored, f"doc_id {described.schema['doc_id'].dataType.simpleString()}, score double")
    return out.select(
        "doc_id", (fold(F.col("doc_id"), 5) == 0).alias("held_out"), "score",
        F.when(F.col("score") >= threshold, 1).otherwise(0).alias("predicted"))
