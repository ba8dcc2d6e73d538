"""License scan against brute force over all places and spans; awkward rows."""

import random
import re
from collections import Counter

from helpers import AWKWARD, docs

from meterline.llm import license_scan as licenses
from meterline.llm.queries import QUERIES

PHRASES = {"mit": "mit license", "apache": "apache license", "gpl": "general public license"}


def lower(text):
    return re.sub("[A-Z]", lambda m: m[0].lower(), text or "")


def brute_base(text):
    words = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", lower(text))
    at = [(i, label) for label, phrase in PHRASES.items() for i in range(len(words)) if words[i: i + len(phrase.split())] == phrase.split()]
    places = [i for i, _ in at]
    return len(words), len(at), min(places, default=None), max(places, default=None), ",".join(sorted({x for _, x in at}))


def dp(a, b):
    table = [[0] * (len(b) + 1) for _ in range(len(a) + 1)]
    for i, x in enumerate(a):
        for j, y in enumerate(b):
            table[i + 1][j + 1] = table[i][j] + 1 if x == y else max(table[i][j + 1], table[i + 1][j])
    return table[-1][-1]


def test_common_subsequence():
    rng = random.Random(5)
    for _ in range(200):
        a, b = ([rng.choice("abcd") for _ in range(rng.randint(0, 12))] for _ in range(2))
        assert licenses.common_subsequence(a, b) == dp(a, b)


def test_given_documents(spark, sf_dir):
    rows = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text").collect()
    got = {r["doc_id"]: r for r in QUERIES["op11_license_scan"](spark, sf_dir).collect()}
    assert len(got) == len(rows)
    for r in rows:
        g = got[r["doc_id"]]
        assert (g["n_words"], g["n_base"], g["first_word"], g["last_word"], g["base_labels"]) == brute_base(r["text"])
        want = set(filter(None, g["base_labels"].split(",")))
        text = " ".join(licenses.words(r["text"]))
        want |= {label for label, notice in licenses.NOTICES if f" {' '.join(licenses.words(notice))} " in f" {text} "}
        assert set(filter(None, g["labels"].split(","))) == want
        assert 0 <= g["score"] <= 1 and (g["score"] >= licenses.SIMILARITY) == bool(want)


def changed(rng, notice, edits):
    words = notice.split()
    for _ in range(edits):
        at = rng.randrange(len(words))
        words[at: at + rng.randint(0, 1)] = ["other"] * rng.randint(0, 1)
    return " ".join(words)


def test_changed_notices(spark):
    """Long notices with a few words changed are found on neighbouring diagonals; the span covers them."""
    rng = random.Random(11)
    long = [(label, notice) for label, notice in licenses.NOTICES if len(licenses.words(notice)) >= 15]
    texts, kinds = [], []
    for k in range(60):
        label, notice = rng.choice(long)
        filler = [f"w{rng.randrange(500)}" for _ in range(rng.randrange(60))]
        texts.append((k, " ".join([*filler, changed(rng, notice, 2).upper(), *filler])))
        kinds.append((label, len(filler), dp(licenses.words(notice), licenses.words(texts[-1][1])) / len(licenses.words(notice))))
    got = {r["doc_id"]: r for r in licenses.scan(docs(spark, texts)).collect()}
    for k, (label, at, share) in enumerate(kinds):
        spans = [s for s in got[k]["spans"] if s["label"] == label and s["stop"] - s["start"] > 5]
        assert share >= 0.8 and spans and abs(spans[0]["start"] - at) <= 4
        assert got[k]["score"] <= 1


def test_places_phrases_and_copies(spark):
    hot = "The MIT-License, mit license; MIT\nLicense. apache license"
    rows = [(k % 3, hot) for k in range(90)] + [(7, "mit license " * 20_000), (8, "Mit Lıcense"), (9, "general public\x00license"), (10, "gnu general public licenses"), (11, "mit licenſe K")]
    frame = docs(spark, rows)
    got = Counter((r["doc_id"], r["n_words"], r["n_base"], r["first_word"], r["last_word"], r["base_labels"]) for r in licenses.scan(frame).collect())
    assert got == Counter((d, *brute_base(t)) for d, t in rows)


def test_awkward_rows(spark, monkeypatch):
    frame = docs(spark, AWKWARD)
    want = licenses.scan(frame).collect()
    assert licenses.scan(frame).columns[:8] == ["doc_id", "n_words", "n_base", "first_word", "last_word", "base_labels", "labels", "score"]
    assert Counter((r["doc_id"], *tuple(r)[1:6]) for r in want) == Counter((t[0], *brute_base(t[1])) for t in AWKWARD)
    assert licenses.scan(frame.limit(0)).count() == 0
    monkeypatch.setattr(licenses, "BROADCAST_GRAMS", 0)
    assert Counter(map(repr, licenses.scan(frame).collect())) == Counter(map(repr, want))


def test_own_notices(spark):
    got = licenses.scan(docs(spark, [(1, "you may copy this freely, friend"), (2, "nothing")]), (("free", "may copy this freely"),), ()).collect()
    assert {r["doc_id"]: (r["labels"], r["score"]) for r in got} == {1: ("free", 1.0), 2: ("", 0.0)}
