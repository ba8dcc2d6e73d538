"""Toxicity, language, quality, mixing: brute force, held-out accuracy, awkward rows."""

import itertools
import os
import zlib
from collections import Counter

import numpy as np
import pytest
from helpers import AWKWARD, docs, labels
from pyspark.sql import functions as F

from meterline.llm import crf, language_id, mixing, toxicity
from meterline.llm import quality_classifier as quality
from meterline.llm.queries import QUERIES

#: Accuracy needs more rows than the other tests.
WIDE = os.environ.get("TEST_LLM_SF_DIR", "/root/testdata/sf0.01")


def brute_marginals(e, moves):
    n, k = e.shape
    out, total, pairs = np.zeros((n, k)), 0.0, np.zeros((k, k))
    for path in itertools.product(range(k), repeat=n):
        for first in range(k):
            w = np.exp(sum(e[t, y] for t, y in enumerate(path)) + moves[first, path[0]] + sum(moves[a, b] for a, b in zip(path, path[1:]))) / k
            total += w
            for t, y in enumerate(path):
                out[t, y] += w
            for a, b in zip((first, *path), path):
                pairs[a, b] += w
    return out / total, pairs / total


@pytest.mark.parametrize("block", [1, 2, 3, 48])
def test_marginals_against_all_paths(monkeypatch, block):
    monkeypatch.setattr(crf, "BLOCK", block)
    rng = np.random.default_rng(block)
    counts = np.array([3, 0, 6, 1, 5])
    e, moves = rng.normal(0, 2, (15, 3)), rng.normal(0, 1, (3, 3))
    got, edges = crf.marginals(e, counts, moves, edges=True)
    want_edges, at = np.zeros((3, 3)), 0
    for n in counts:
        if n:
            p, q = brute_marginals(e[at:at + n], moves)
            assert np.allclose(got[at:at + n], p)
            want_edges += q
        at += n
    assert np.allclose(edges, want_edges)


def test_marginals_of_a_long_sequence_are_stable():
    e = np.random.default_rng(0).normal(0, 30, (50_000, 4))
    p = crf.marginals(e, np.array([50_000]), np.zeros((4, 4)))
    assert np.isfinite(p).all() and np.allclose(p, np.exp(e - e.max(1, keepdims=True)) / np.exp(e - e.max(1, keepdims=True)).sum(1, keepdims=True))


def test_features_of_awkward_words():
    words = ["", "a", "...", "é" * 5000, "x\x00y", "\x00", "Word", "word"]
    f = toxicity.FEATURES
    seen = {}
    for at, slots in f.of(words):
        for i, row in zip(at, slots):
            seen[i] = row
    assert sorted(seen) == list(range(len(words)))
    assert (seen[6] == seen[7]).all()


def test_training_learns_labels_and_moves():
    words = ["red", "blue", "and"] * 200
    truth = np.array([0, 1, 1] * 200)
    codes, distinct, counts = crf.coded([words[i:i + 6] for i in range(0, 600, 6)])
    model = crf.train(crf.Features(bits=10), distinct, codes, counts, truth, 2)
    assert (crf.marginals(model.emissions(distinct)[codes], counts, model.moves).argmax(1) == truth).all()


def crc(doc_id, of):
    return None if doc_id is None else zlib.crc32(str(doc_id).encode()) % of


@pytest.fixture(scope="module")
def truth(spark):
    rows = spark.read.parquet(f"{WIDE}/documents.parquet").join(spark.read.parquet(f"{WIDE}/labels.parquet"), "doc_id", "left").collect()
    return {r["doc_id"]: r for r in rows}


def test_toxicity_held_out(spark, truth):
    rows = QUERIES["op4_toxicity"](spark, WIDE).collect()
    assert len(rows) == spark.read.parquet(f"{WIDE}/documents.parquet").count()
    right = []
    for r in rows:
        assert r["held_out"] == (crc(r["doc_id"], 3) == 1) and 0 <= r["score"] <= 1 and r["predicted"] == int(r["score"] >= 0.7)
        assert r["n_toxic_words"] == len(r["spans"])
        text = truth[r["doc_id"]]["text"]
        words = text.split()
        assert all(text[s["start"]:s["end"]] in words for s in r["spans"])
        if r["held_out"] and truth[r["doc_id"]]["toxic"] is not None:
            right.append((truth[r["doc_id"]]["toxic"], r["predicted"]))
    clean = [p for y, p in right if y == 0]
    assert sum(clean) <= 0.03 * len(clean)
    assert sum(p for y, p in right if y == 1) >= 0.5 * sum(y for y, _ in right)


def test_language_held_out(spark, truth):
    rows = [r for r in QUERIES["op8_language_id"](spark, WIDE).collect()]
    assert all(r["held_out"] == (crc(r["doc_id"], 5) == 0) for r in rows)
    held = [r for r in rows if r["held_out"]]
    assert np.mean([r["lang_pred"] == truth[r["doc_id"]]["lang"] for r in held]) >= 0.98


def test_quality_held_out(spark, truth):
    rows = QUERIES["op9_quality_classifier"](spark, WIDE).collect()
    held = [(truth[r["doc_id"]]["quality"], r["predicted"]) for r in rows if r["held_out"] and truth[r["doc_id"]]["quality"] is not None]
    assert all(r["held_out"] == (crc(r["doc_id"], 5) == 0) and 0 <= r["score"] <= 1 and r["predicted"] == int(r["score"] >= 0.3) for r in rows)
    assert np.mean([y == p for y, p in held]) >= 0.9


LABELS = [(1, 1, 0, "t", "l"), (1, None, 1, "t", "l"), (None, 1, 1, "t", "l"), (5, 0, 1, "t", "l"), (6, 0, 0, "t", "l"), (7, 1, 0, "t", "l"),
          (-8, 1, None, "t", "l"), (77, 1, 1, "t", "l"), (3, 1, 1, "t", "l"), (2, 0, 1, "t", "l")]


@pytest.mark.parametrize("some", [LABELS, []])
def test_awkward_rows(spark, some):
    frame, known = docs(spark, AWKWARD), labels(spark, some)
    for got, of, out in (
        (toxicity.toxicity(frame, known), 3, 1), (quality.quality(frame, known), 5, 0),
        (language_id.language_id(frame if some else frame.withColumn("lang", F.lit(None).cast("string"))), 5, 0),
    ):
        rows = got.collect()
        assert len(rows) == len(AWKWARD)
        assert Counter(r["doc_id"] for r in rows) == Counter(a[0] for a in AWKWARD)
        scores = {}
        for r in rows:
            assert 0 <= r["score"] <= 1
            assert r["held_out"] == (None if r["doc_id"] is None else crc(r["doc_id"], of) == out)
            scores.setdefault(r["doc_id"], set()).add(r["score"])
        assert scores[2] == scores[3] == scores[4] and len(scores[1]) == 1  # no words; repeated rows
    lang = language_id.language_id(frame).collect()
    assert [r["lang_pred"] for r in lang if r["doc_id"] in (2, 3, 4)] == ["und"] * 3
    empty = frame.limit(0)
    assert toxicity.toxicity(empty, known).count() == quality.quality(empty, known).count() == language_id.language_id(empty).count() == 0
    kept = toxicity.reject(frame, known, threshold=2.0)
    assert kept.schema == frame.schema and kept.count() == len(AWKWARD)


def test_isotonic_against_all_pools():
    rng = np.random.default_rng(2)
    for _ in range(30):
        n = rng.integers(1, 5, 7).astype(float)
        ones = np.minimum(n, rng.integers(0, 5, 7))
        x = np.arange(7.0)
        _, values = quality.isotonic(x, ones, n)
        assert (np.diff(values) > 0).all()
        best = min((sum(np.sum(n[a:b] * (ones[a:b] / n[a:b] - ones[a:b].sum() / n[a:b].sum()) ** 2) for a, b in zip((0, *cut), (*cut, 7)))
                    for k in range(7) for cut in itertools.combinations(range(1, 7), k)
                    if (np.diff([ones[a:b].sum() / n[a:b].sum() for a, b in zip((0, *cut), (*cut, 7))]) >= 0).all()))
        assert np.sum(n * (ones / n - _steps(x, ones, n)) ** 2) == pytest.approx(best, abs=1e-9)


def _steps(x, ones, n):
    """Fitted value of each bin, from the pools of ``isotonic``."""
    pools = []
    for i in range(len(x)):
        pools.append([i, i + 1])
        share = lambda p: ones[p[0]:p[1]].sum() / n[p[0]:p[1]].sum()
        while len(pools) > 1 and share(pools[-2]) >= share(pools[-1]):
            pools[-2:] = [[pools[-2][0], pools[-1][1]]]
    out = np.empty(len(x))
    for a, b in pools:
        out[a:b] = ones[a:b].sum() / n[a:b].sum()
    assert sorted(set(out)) == pytest.approx(list(quality.isotonic(x, ones, n)[1]))
    return out


def test_normal_equations_add_up(spark):
    rng = np.random.default_rng(0)
    x = rng.normal(0, 1, (200, len(quality.STATISTICS)))
    y = (x[:, 0] > 0).astype(int)
    rows = spark.createDataFrame([(list(map(float, a)), int(b)) for a, b in zip(x, y)], "x array<double>, label int").repartition(7)
    k = len(quality.STATISTICS)
    s = quality.Scorer(np.zeros(k), np.ones(k), rng.normal(0, 0.3, (k, quality.WIDTH)), rng.uniform(0, 6, quality.WIDTH), None, None, None)
    left, right = quality._normal_equations(rows, s)
    z = s.features(x)
    assert np.allclose(left, z.T @ z) and np.allclose(right, z.T @ y)


def test_mixing_meets_targets(spark):
    got = QUERIES["op3_mixing"](spark, WIDE).toPandas()
    assert len(got) == spark.read.parquet(f"{WIDE}/documents.parquet").count()
    p = got[[f"p_{d}" for d in mixing.DOMAINS]].to_numpy()
    assert np.allclose(p.sum(1), 1) and (got["rate"] >= 0).all()
    tokens = got["n_tokens"].to_numpy()
    total = (got["rate"].to_numpy() * tokens) @ p
    goal = np.array([mixing.TARGETS[d] for d in mixing.DOMAINS]) * tokens.sum()
    assert np.abs(total - goal).sum() <= 1e-6 * tokens.sum()


def test_mixing_fit_against_numpy(spark):
    rng = np.random.default_rng(4)
    p = rng.dirichlet([0.3, 0.5, 1.0], 150)
    n = rng.integers(0, 900, 150)
    state = spark.createDataFrame([(int(a), list(map(float, b))) for a, b in zip(n, p)], "n_tokens long, p array<double>")
    steps, total, goal = mixing.fit_steps(state, [0.2, 0.2, 0.6])
    rate = np.ones(150)
    for s in steps:
        rate = np.maximum(0, rate + p @ np.array(s))
    got = np.array([r[0] for r in state.select(mixing._rate(steps, 3)).collect()])
    assert np.allclose(got, rate) and np.allclose((rate * n) @ p, total) and np.allclose(total, goal, rtol=1e-5)


def test_mixing_out_of_reach_stays_non_negative(spark):
    state = spark.createDataFrame([(10, [0.5, 0.5]), (20, [0.5, 0.5]), (0, [1.0, 0.0])], "n_tokens long, p array<double>")
    steps, total, goal = mixing.fit_steps(state, [0.9, 0.1])
    assert len(steps) <= mixing.STEPS and np.isfinite(total).all() and sum(abs(a - b) for a, b in zip(total, goal)) > 1


@pytest.mark.parametrize("some", [LABELS, []])
def test_mixing_awkward_rows(spark, some):
    frame = docs(spark, AWKWARD)
    got = mixing.mix(frame, mixing.domain_of(labels(spark, some)), mixing.TARGETS, frame.columns)
    rows = got.collect()
    assert len(rows) == len(AWKWARD) and len(set(map(str.lower, got.columns))) == len(got.columns)
    assert all(r["rate"] >= 0 and abs(r["p_good"] + r["p_low"] + r["p_toxic"] - 1) < 1e-9 for r in rows)
    tokens = {r["doc_id"]: r["n_tokens"] for r in rows}
    assert tokens[2] == tokens[3] == tokens[4] == 0 and tokens[1] == 13
    assert mixing.mix(frame.limit(0), mixing.domain_of(labels(spark, some)), mixing.TARGETS, ["doc_id"]).count() == 0


def test_mixing_keeps_columns_with_the_names_of_its_work(spark):
    frame = spark.createDataFrame([(1, "some words", "s", "f", "p", 7), (2, None, "s", "f", "p", 8)], "doc_id long, text string, s string, f string, p string, c0 int")
    got = mixing.mix(frame, mixing.domain_of(labels(spark, [])), mixing.TARGETS, frame.columns)
    assert got.columns[:6] == frame.columns
    assert sorted(map(tuple, got.select(*frame.columns).collect())) == sorted(map(tuple, frame.collect()))


def test_every_language_is_learned_whatever_its_size_and_lengths(spark, monkeypatch):
    """A share far below one row in a million, one much repeated id, and a language that only occurs in long texts."""
    monkeypatch.setattr(language_id, "SAMPLE", 2)
    monkeypatch.setattr(language_id, "MAX_CHARS", 100)
    rows = spark.range(3000).selectExpr(
        "if(id % 2 = 0, 5, id) AS doc_id", "if(id % 3 = 0, 'aa', 'bb') AS lang", "concat('word ', id) AS text").unionByName(
        spark.range(3).selectExpr("id AS doc_id", "'long' AS lang", "repeat('slow words ', 500) AS text"))
    got = language_id.training_rows(rows, F.lit(True))
    assert set(got["lang"]) == {"aa", "bb", "long"} and got["text"].str.len().max() <= 100
    assert (got["lang"] == "aa").sum() <= 20
    assert len(language_id.training_rows(rows.limit(0), F.lit(True))) == 0


def test_only_copies_of_toxic_rows_are_weighted_down():
    """Toxic rows that share some words still count; copies with few changes count once."""
    rng = np.random.default_rng(3)
    words = lambda n: [f"ordinary{i}" for i in rng.choice(400, n)]
    toxic = [[*words(60), "venomous"] for _ in range(40)]
    copied = [f"passage{i}" for i in range(60)]
    copies = [[*copied, f"change{k}"] for k in range(30)]
    clean = [words(60) for _ in range(60)]
    texts = clean[:30] + toxic + copies + clean[30:]
    label = np.array([0] * 30 + [1] * 70 + [0] * 30, bool)
    codes, distinct, counts = crf.coded(texts)
    kept = toxicity.not_copies(codes, counts, np.nonzero(label)[0])
    assert kept[:41].all() and not kept[41:].any()
    slots = np.arange(1, len(distinct) + 1, dtype=np.int32)[:, None]
    marks = {distinct[i - 1] for i in toxicity.marking_features(slots, codes, counts, label)}
    assert marks == {"venomous"}
    assert len(toxicity.not_copies(codes, counts, np.zeros(0, np.int64))) == 0
