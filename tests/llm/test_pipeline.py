"""The corpus pipeline: each stage on its own input against a brute-force version of its decision."""

import re

import numpy as np
import pytest
from helpers import AWKWARD, docs

import corpus_pipeline as pipeline
from meterline.llm import mixing, secret_scan, toxicity
from test_pair_operators import brute_findings, brute_fingerprint, brute_groups


@pytest.fixture(scope="module")
def kept(spark, sf_dir, tmp_path_factory):
    """Rows before the first stage and after each."""
    folder = tmp_path_factory.mktemp("stages")
    frame = spark.read.parquet(f"{sf_dir}/documents.parquet")
    out = [frame]
    for k, (_, stage) in enumerate(pipeline.STAGES):
        stage(spark, out[-1], sf_dir).write.parquet(f"{folder}/{k}")
        out.append(spark.read.parquet(f"{folder}/{k}"))
    return out


def ids(frame):
    return {r["doc_id"] for r in frame.select("doc_id").collect()}


def test_columns(kept):
    assert all(f.schema == kept[0].schema for f in kept[1:5])


def test_toxicity_stage(spark, sf_dir, kept):
    scorer = toxicity.fit(kept[0], spark.read.parquet(f"{sf_dir}/labels.parquet"))
    rows = kept[0].collect()
    scores = toxicity._scored([r["text"] for r in rows], scorer)[0]
    assert ids(kept[1]) == {r["doc_id"] for r, s in zip(rows, scores) if s < 0.7}


def test_near_duplicate_stage(kept):
    rows = [(r["doc_id"], brute_fingerprint(r["text"])) for r in kept[1].collect()]
    assert ids(kept[2]) == set(brute_groups(rows)) and kept[2].count() == len(set(brute_groups(rows)))


def test_decontamination_stage(spark, sf_dir, kept):
    items = [tuple(r) for r in spark.read.parquet(f"{sf_dir}/benchmark.parquet").select("item_id", "text").collect()]
    rows = [(r["doc_id"], r["text"]) for r in kept[2].collect()]
    bad = {d for d, _, _ in brute_findings(rows, items)}
    assert ids(kept[3]) == {d for d, _ in rows} - bad


def test_secret_stage(kept):
    vocabulary = open(secret_scan.VOCABULARY, "rb").read()
    before = {r["doc_id"]: r["text"] for r in kept[3].collect()}
    for r in kept[4].collect():
        text = list(before.pop(r["doc_id"]))
        for _, s, e in reversed(secret_scan.spans_of("".join(text), vocabulary)):
            text[s:e] = ["\0"] * (e - s)
        want = re.sub("\0+", "[secret]", "".join(text))
        assert r["text"] == want and r["n_chars"] == len(want)
    assert not before


def test_mixing_stage(kept):
    got = kept[5].toPandas()
    assert set(got["doc_id"]) == ids(kept[4])
    p, n = got[[f"p_{d}" for d in mixing.DOMAINS]].to_numpy(), got["n_tokens"].to_numpy()
    goal = np.array(list(mixing.TARGETS.values())) * n.sum()
    assert np.abs((got["rate"].to_numpy() * n) @ p - goal).sum() <= 1e-6 * n.sum()


def test_stages_take_awkward_rows(spark, sf_dir):
    frame = docs(spark, [t for t in AWKWARD if t[0] != 5])
    for some in (frame, frame.limit(0)):
        for name, stage in pipeline.STAGES[:-1]:
            got = stage(spark, some, sf_dir)
            assert got.schema == some.schema, name
            assert got.count() <= some.count()
    assert pipeline.mix_sources(spark, frame, sf_dir).count() == frame.count()
