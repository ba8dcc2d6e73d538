"""Periodic runs and conversation tries against brute force; awkward rows."""

import hashlib
import random

import pytest
from helpers import AWKWARD, LONG, docs
from hypothesis import given, settings
from hypothesis import strategies as st

from meterline.llm import periodic_runs as runs
from meterline.llm import prefix_trie as tries


def brute_runs(words, least, periods):
    """All bounds by comparing words q apart, for every q; multiples of a period have its bounds."""
    found = {}
    for q in range(1, len(words) // periods + 1):
        start = 0
        for i in range(len(words) - q + 1):
            if i == len(words) - q or words[i] != words[i + q]:
                if i + q - start >= max(least, periods * q):
                    found.setdefault((start, i + q), q)
                start = i + 1
    return sorted((s, e - s, q) for (s, e), q in found.items())


@settings(max_examples=60, deadline=None)
@given(st.lists(st.integers(0, 2), max_size=60), st.integers(1, 9), st.lists(st.integers(1, 7), min_size=1, max_size=60), st.sampled_from([(6, 4), (2, 2), (1, 3)]))
def test_runs_do_not_depend_on_how_words_arrive(words, times, steps, bounds):
    least, periods = bounds
    words = words[:8] * times + words
    want = brute_runs(words, least, periods)
    whole, pieces = runs.Catcher(periods), runs.Catcher(periods, 1)
    whole.append(words)
    at = 0
    for k in range(len(words)):
        pieces.append(words[at: at + steps[k % len(steps)]])
        at += steps[k % len(steps)]
    assert whole.runs(least) == want == pieces.runs(least)


def test_runs_word_by_word_are_known_at_once():
    catcher = runs.Catcher(2, 1)
    for n, word in enumerate([1, 2, 1, 2, 1, 3, 3], 1):
        catcher.append([word])
        assert catcher.runs() == brute_runs([1, 2, 1, 2, 1, 3, 3][:n], 2, 2)


def test_wrong_fingerprints_do_not_show(monkeypatch):
    monkeypatch.setattr(runs, "_mixed", lambda x: (x % 2).astype("uint64"))  # different words with equal fingerprints
    words = [0, 2, 0, 0, 0, 0, 0, 0, 1, 3, 1, 1, 1, 1, 1, 1]
    got = set(runs.runs_of([str(w) for w in words]))
    assert got <= set(brute_runs(words, 6, 4)) and got


@pytest.mark.parametrize("n", [5, 300, 5000])
def test_loops_in_long_texts(n, monkeypatch):
    monkeypatch.setattr(runs, "SLICE", 700)
    rng = random.Random(n)
    words = [str(rng.randrange(40)) for _ in range(n)]
    for at, period, length in ((n // 5, 3, n // 10), (n // 2, 1 + n // 40, n // 4)):
        for i in range(at + period, min(n, at + period + length)):
            words[i] = words[i - period]
    assert runs.runs_of(words) == brute_runs(words, 6, 4)


def test_runs_awkward_rows(spark):
    frame = docs(spark, [*AWKWARD, (12, "a b " * 9 + "c"), (12, "a b " * 9 + "c"), (13, "x " * 200_000), (14, LONG + " ha" * 7)])
    got = runs.periodic_runs(frame)
    assert got.columns == ["doc_id", "n_words", "runs", "collapsed"]
    rows = got.collect()
    assert len(rows) == frame.count()
    by_id = {r["doc_id"]: r for r in rows}
    assert [tuple(x) for x in by_id[12]["runs"]] == [(0, 18, 2)] and by_id[12]["collapsed"] == "a b c"
    assert [tuple(x) for x in by_id[13]["runs"]] == [(0, 200_000, 1)] and by_id[13]["collapsed"] == "x"
    assert by_id[14]["runs"][-1]["length"] == 7 and by_id[2]["runs"] == [] and by_id[2]["collapsed"] == "" and by_id[4]["n_words"] == 0
    told = {r["doc_id"]: r for r in runs.digests(got).collect()}
    assert (told[12]["n_runs"], told[12]["start"], told[12]["length"], told[12]["period"], told[12]["exponent_milli"]) == (1, 0, 18, 2, 9000)
    assert told[2]["start"] is None and told[2]["exponent_milli"] is None and told[2]["runs_sha256"] == told[3]["collapsed_sha256"]
    assert runs.digests(runs.periodic_runs(frame.limit(0))).count() == 0
    tie = runs.digests(runs.periodic_runs(docs(spark, [(1, "a " * 8 + "z " + "a b " * 4)]))).first()
    assert (tie["n_runs"], tie["start"], tie["period"]) == (2, 0, 1)
    with pytest.raises(ValueError):
        runs.periodic_runs(frame, periods=1)


COLUMNS = ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"]


def brute_trie(rows, convs=()):
    """Nodes of rows (conv_id, turn, role, text) by their whole prefixes."""
    talks = {c: [] for c in convs}
    for c, turn, role, text in rows:
        if c is not None:
            talks.setdefault(c, []).append((turn is not None, turn or 0, role or "", text or ""))
    paths = {c: [t[2:] for t in sorted(ts)] for c, ts in talks.items()}
    members, ends = {}, {}
    for c, path in paths.items():
        for d in range(len(path) + 1):
            members.setdefault(tuple(path[:d]), []).append(c)
        ends.setdefault(tuple(path), []).append(c)
    out = []
    for node, held in members.items():
        below = [x for x in members if x[: len(node)] == node]
        childless = [x for x in below if not any(len(y) == len(x) + 1 and y[:-1] == x for y in below)]
        out.append((
            min(held), len(node), min(members[node[:-1]]) if node else None, len(held), sum(len(x) == len(node) + 1 for x in below), len(childless),
            sum((len(members[x]) - 1) * len(x[-1][1].encode()) for x in below if x),
            hashlib.sha256(",".join(map(str, sorted(ends.get(node, [])))).encode()).hexdigest()))
    return sorted(out)


def talk_rows(seed):
    """Conversations that copy, extend and leave each other at all depths, some long, some with awkward rows."""
    rng = random.Random(seed)
    talks = [[]]
    for _ in range(60):
        base = rng.choice(talks)
        talks.append([*base[: rng.randint(0, len(base))], *[(rng.choice(["user", "assistant", None]), rng.choice(["a", "b", "", None, "ü" * 5, "a\n"])) for _ in range(rng.randint(0, 3))]])
    talks += [talks[7]] * 5 + [[("user", str(i % 3)) for i in range(70)], [("user", str(i % 3)) for i in range(64)], [("user", str(i % 3)) for i in range(65)] + [("x", "y")]]
    ids = rng.sample(range(-50, 5000), len(talks))
    rows = [(c, k, *t) for c, talk in zip(ids, talks) for k, t in enumerate(talk)]
    rows += [(ids[9], None, "user", "first"), (ids[9], None, "user", "first"), (ids[9], 0, "user", "tie"), (None, 1, "user", "nobody")]
    rng.shuffle(rows)
    return rows, ids


@pytest.mark.parametrize(("block", "segment", "run"), [(4, 1024, 12), (3, 2, 1)])
def test_trie_against_brute_force(spark, monkeypatch, block, segment, run):
    monkeypatch.setattr(tries, "BLOCK", block)
    monkeypatch.setattr(tries, "SEGMENT", segment)
    monkeypatch.setattr(tries, "RUN", run)
    rows, ids = talk_rows(block)
    frame = spark.createDataFrame([(*r, "x", 1, "k") for r in rows], "conv_id long, turn long, role string, text string, node string, depth long, `a.key` string")
    got = tries.prefix_trie(frame)
    assert got.columns == COLUMNS
    assert sorted(map(tuple, got.collect())) == brute_trie(rows)
    # conversations without turns are members of the root
    placed = tries.positions(frame)
    every = spark.createDataFrame([(c,) for c in ids], "conv_id long")
    assert sorted(map(tuple, tries.trie(placed, every).collect())) == brute_trie(rows, ids)


def test_trie_without_rows(spark):
    none = spark.createDataFrame([], "conv_id long, turn long, role string, text string")
    assert tries.prefix_trie(none).count() == 0
    alone = tries.trie(tries.positions(none), spark.createDataFrame([(3,), (10,)], "conv_id long"))
    assert [tuple(r) for r in alone.collect()] == [(3, 0, None, 2, 0, 1, 0, hashlib.sha256(b"3,10").hexdigest())]


def test_long_conversation_is_numbered_across_tasks(spark):
    rows = spark.range(20_000).selectExpr("if(id % 3 = 0, id % 50, 777) AS conv_id", "id AS turn", "'user' AS role", f"if(id = 9000, '{'y' * 300_000}', 'x') AS text")
    got = {(r["conv_id"], r["pos"]) for r in tries.positions(rows).select("conv_id", "pos").collect()}
    sizes = {r["conv_id"]: r["n"] for r in rows.groupBy("conv_id").agg({"*": "count"}).toDF("conv_id", "n").collect()}
    assert len(got) == 20_000 and got == {(c, k) for c, n in sizes.items() for k in range(n)}
    deep = tries.prefix_trie(rows.where("conv_id = 777")).agg({"depth": "max", "*": "count"}).first()
    assert deep["max(depth)"] == sizes[777] and deep["count(1)"] == sizes[777] + 1
