"""Near-duplicates and decontamination against brute force; awkward rows."""

import random
import re
from collections import Counter

import numpy as np
import pytest
import xxhash
from helpers import AWKWARD, docs
from pyspark.sql import functions as F

from meterline.llm import components, decontamination, simhash
from meterline.llm.queries import QUERIES


def brute_fingerprint(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    shingles = [" ".join(words[i:i + 4]) for i in range(max(1, len(words) - 3))] if words else []
    h = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


def brute_groups(rows):
    """Rows (id, fingerprint) to the smallest id reachable of each row."""
    parent = list(range(len(rows)))

    def find(a):
        while parent[a] != a:
            a = parent[a]
        return a

    fps = np.array([fp for _, fp in rows], np.uint64)
    for i in range(len(rows)):
        for j in np.nonzero(np.bitwise_count(fps[i + 1:] ^ fps[i]) <= 4)[0] + i + 1:
            parent[max(find(i), find(int(j)))] = min(find(i), find(int(j)))
    groups = {}
    for i, (doc_id, _) in enumerate(rows):
        groups.setdefault(find(i), []).append(doc_id)
    low = {g: min((d for d in ids if d is not None), default=None) for g, ids in groups.items()}
    return [low[find(i)] for i in range(len(rows))]


def test_simhash_against_brute_force(spark, sf_dir):
    rows = [(r["doc_id"], brute_fingerprint(r["text"])) for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()]
    want = {d: (f"{fp:016x}", c) for (d, fp), c in zip(rows, brute_groups(rows))}
    got = {r["doc_id"]: (r["fingerprint"], r["component_id"]) for r in QUERIES["op2_simhash"](spark, sf_dir).collect()}
    assert got == want


def test_simhash_awkward_rows(spark):
    frame = docs(spark, [t for t in AWKWARD if t[0] != 5] + [(9, "ONE"), (10, "one"), (5, "w " * 5000)])
    got = [(r["doc_id"], r["fingerprint"], r["component_id"]) for r in simhash.simhash(frame).collect()]
    rows = [(r["doc_id"], brute_fingerprint(r["text"])) for r in frame.collect()]
    assert Counter(got) == Counter((d, f"{fp:016x}", c) for (d, fp), c in zip(rows, brute_groups(rows)))
    kept = simhash.keep_one(frame)
    assert kept.schema == frame.schema
    assert kept.count() == len({c if c is not None else ("none", fp) for _, fp, c in got})
    assert simhash.simhash(frame.limit(0)).count() == 0


@pytest.fixture
def small_blocks(monkeypatch):
    monkeypatch.setattr(simhash, "BLOCK", 16)


def test_search_in_a_dense_group(spark, small_blocks):
    """Many fingerprints close to each other, chains, and values that are cut into blocks."""
    rng = random.Random(3)
    fps = set()
    centre = rng.getrandbits(64)
    for _ in range(300):
        fps.add(centre ^ sum(1 << b for b in rng.sample(range(64), rng.randint(0, 5))))
    far = rng.getrandbits(64)
    for k in range(12):
        far ^= 0b1111 << (5 * k)
        fps.add(far)
    fps |= {rng.getrandbits(64) for _ in range(300)}
    fps = sorted(fps)
    signed = [int(np.uint64(f).view(np.int64)) for f in fps]
    frame = spark.createDataFrame([(f, i) for i, f in enumerate(signed)], "fp long, low long").repartition(5)
    root = {r["fp"]: r["root"] for r in simhash.roots(frame).collect()}
    want = brute_groups(list(enumerate(fps)))
    assert len(set(root.values())) == len(set(want))
    assert {(a, b) for a, b in zip((root[f] for f in signed), want)}.__len__() == len(set(want))


def test_thresholds_add_up(spark):
    frame = spark.createDataFrame([(int(x),) for x in np.random.default_rng(1).integers(-2**62, 2**62, 500)], "fp long")
    near = simhash.correlations(frame)
    for parts in simhash.PARTS:
        groups = simhash.bit_groups(near, parts)
        assert sorted(b for g in groups for b in g) == list(range(64))
        cost, found = simhash.thresholds(frame, groups)
        assert sum(t + 1 for t in found) == simhash.RADIUS + 1 and cost < float("inf")


def test_components_of_chains_stars_and_loops(spark):
    links = [(i, i + 1) for i in range(100, 140)] + [(1, i) for i in range(50, 90)] + [(5, 5), (7, 8), (8, 7), (7, 8)]
    got = {r["a"]: r["b"] for r in components.components(spark.createDataFrame(links, "a long, b long")).collect()}
    assert got == {i: 100 for i in range(101, 141)} | {i: 1 for i in range(50, 90)} | {8: 7}
    assert components.components(spark.createDataFrame([], "a long, b long")).count() == 0


def brute_findings(texts, items):
    """Best window of each text and item over ALL windows."""
    def words(t):
        return [w for w in re.split(r"[^\w]+|_", (t or "").lower()) if w]

    found = {}
    for d, text in set(texts):
        w = words(text)
        for i, item in items:
            v = words(item)
            if not v:
                continue
            k = min(5, len(v))
            g, h = [tuple(w[a:a + k]) for a in range(len(w) - k + 1)], Counter(tuple(v[a:a + k]) for a in range(len(v) - k + 1))
            m = sum(h.values())
            best = None
            for s in range(max(1, len(g) - m + 1)):
                c = Counter(g[s:s + m])
                shared = sum((c & h).values())
                sim = shared / (m + sum(c.values()) - shared)
                if sim >= 0.8 and (best is None or sim > best):
                    best = sim
            if best is not None:
                found[d, text, i] = best
    return found


def test_decontamination_against_all_windows(spark):
    rng = random.Random(5)
    vocabulary = [f"w{i}" for i in range(400)]
    item = [" ".join(rng.choice(vocabulary) for _ in range(n)) for n in (40, 25, 60, 3, 5)] + ["", "a a a a a a a b", "x " * 30]
    items = [(i, t) for i, t in enumerate(item)] + [(99, None), (0, item[0])]

    def around(t, before=30, after=30):
        return " ".join([*(rng.choice(vocabulary) for _ in range(before)), t, *(rng.choice(vocabulary) for _ in range(after))])

    texts = [(1, around(item[0])), (2, around(item[1].upper().replace(" ", ", "))), (3, around(item[3])), (4, item[4]), (5, None), (6, ""),
             (7, around("")), (7, around(item[2])), (None, around(item[0])), (8, "x " * 500), (9, "a a a a a a a b b"), (1, around(item[0], 0, 0))]
    for k in range(30):
        t = item[k % 3].split()
        for _ in range(k % 5):
            t[rng.randrange(len(t))] = "changed"
        if k % 4 == 0:
            t.insert(rng.randrange(len(t)), "added")
        texts.append((100 + k, around(" ".join(t), rng.randrange(40), rng.randrange(40))))
    texts.append(texts[0])
    frame = docs(spark, texts)
    bench = spark.createDataFrame([(i, t, "x", 1) for i, t in items], "item_id long, text string, doc_id string, start int")
    want = brute_findings(texts, [x for x in items if x[1]])
    hashes = {(r["doc_id"], r["text"]): r["h"] for r in frame.select("doc_id", "text", F.xxhash64("text").alias("h")).collect()}
    rows = decontamination.findings(frame, bench).collect()
    got = {(r["doc_id"], r["text_hash"], r["item_id"]): r["similarity"] for r in rows}
    assert len(rows) == len(got)
    assert got == {(d, hashes[d, t], i): s for (d, t, i), s in want.items()}
    left = decontamination.clean(frame, bench)
    assert left.schema == frame.schema
    bad = {(d, t) for d, t, _ in want}
    assert Counter((r["doc_id"], r["text"]) for r in left.collect()) == Counter(x for x in texts if x not in bad)
    assert decontamination.findings(frame.limit(0), bench).count() == 0
    assert decontamination.clean(frame, bench.limit(0)).count() == len(texts)


def test_decontamination_without_broadcast(spark, sf_dir, monkeypatch):
    """The way beyond the bound of the broadcasts gives the same."""
    read = lambda n: spark.read.parquet(f"{sf_dir}/{n}.parquet")
    one = {tuple(r) for r in decontamination.findings(read("documents"), read("benchmark")).collect()}
    monkeypatch.setattr(decontamination, "BROADCAST_ROWS", -1)
    assert {tuple(r) for r in decontamination.findings(read("documents"), read("benchmark")).collect()} == one


def test_decontamination_of_an_id_with_two_texts(spark):
    """Each text of a repeated item id is looked for at its own length, null ids included."""
    long = " ".join(f"s{i}" for i in range(40))
    short = "s0 s1 s2 s3 s4 t0 t1 t2 t3 t4"  # begins as the long one does, so windows of both start at the same word
    rest = " ".join(f"r{i}" for i in range(60))
    texts = [(1, f"before it {short} {rest}"), (2, f"before it {long} {rest}")]
    items = [(i, t) for i in (7, None) for t in (short, long)]
    for order in (items, items[::-1]):
        bench = spark.createDataFrame(order, "item_id long, text string")
        got = {(r["doc_id"], r["item_id"]): (r["start_word"], r["similarity"]) for r in decontamination.findings(docs(spark, texts), bench).collect()}
        assert got == {(d, i): (2, 1.0) for d in (1, 2) for i in (7, None)}
        assert decontamination.clean(docs(spark, texts), bench).count() == 0
