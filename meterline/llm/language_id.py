"""Language of texts by a linear-chain conditional random field over words.

Each word of a text gets a label, one of the languages seen in training. Features of a word are the word
itself (the lexicon), its affixes and its character n-grams; moves between labels are learned as well,
so that a text may switch between languages. Training sequences are made of lines of different
documents set one after the other, each word labelled with the language of its document. The language of a
text is the one with the largest sum of forward-backward marginals over its words that hold a letter;
the score is its share of that sum. The second-best language and its share are returned as well.

The sample is bounded: about ``SAMPLE`` documents a language by a hash of the id, ``TRAIN_WORDS`` words. Scoring
covers every text as a whole, in tasks, without a shuffle.

Null text or text without a letter: ``und`` with score 0. No training rows: ``und`` everywhere. Repeated
rows and ids are labelled each on their own; null ids are kept (held_out null). Of a row only ``doc_id``
and ``text`` are read, in training ``lang`` too.
"""

from __future__ import annotations

import re
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import crf
from .common import fold, map_texts
from .samples import MAX_CHARS

SAMPLE, TRAIN_WORDS = 400, 160_000
BATCH_CHARS = 1_500_000
FEATURES = crf.Features(bits=16, prefixes=(1, 3), suffixes=(1, 2, 3), grams=(2, 3))
FIELDS = [("lang_pred", "string"), ("score", "double"), ("second", "string"), ("second_share", "double")]
_LETTER = re.compile(r"[^\W\d_]")


@dataclass
class Identifier:
    model: crf.Model | None
    langs: list[str]


def training_rows(docs: DataFrame, allowed) -> pd.DataFrame:
    """lang and text of the sample: about ``SAMPLE`` different rows per language, by a hash of id and text.

    A row is taken where its 64-bit hash falls under the language's share, and where it is the
    smallest of its language, so every language is learned whatever its size. Of a text the
    first ``MAX_CHARS`` characters are learned from.
    """
    rows = docs.where(allowed & F.col("lang").isNotNull() & F.col("text").isNotNull())
    place = F.xxhash64("doc_id", "text")
    sizes = rows.groupBy("lang").agg(F.count("*").alias("n"), F.min(place).alias("low")).collect()  # a row per language
    if not sizes:
        return pd.DataFrame({"lang": [], "text": []})
    edge = {r["lang"]: max(r["low"], min(2**63 - 1, -(2**63) + int(2**64 * min(1.0, SAMPLE / r["n"])))) for r in sizes}
    share = F.element_at(F.create_map(*[F.lit(x) for k, e in edge.items() for x in (k, F.lit(e).cast("long"))]), F.col("lang"))
    chosen = rows.where(place <= share).select("lang", F.left("text", F.lit(MAX_CHARS)).alias("text"), place.alias("place")).distinct()
    return chosen.orderBy("place", "lang", "text").drop("place").toPandas()


def fit(docs: DataFrame, folds: int = 5, held_out: int = 0) -> Identifier:
    """Learn from rows with a language whose ``crc32(doc_id) mod folds`` is not ``held_out``."""
    sample = training_rows(docs, fold(F.col("doc_id"), folds) != held_out)
    langs = sorted(sample["lang"].unique())
    if not langs:
        return Identifier(None, [])
    code = {x: i for i, x in enumerate(langs)}
    rng = np.random.default_rng(5)
    pieces: list[tuple[list[str], int]] = []
    for lang in langs:
        left = TRAIN_WORDS // len(langs)
        for text in sample["text"][sample["lang"] == lang]:
            for line in text.split("\n"):
                words = [w for w in line.split() if _LETTER.search(w)]
                if words and left > 0:
                    pieces.append((words, code[lang]))
                    left -= len(words)
    if not pieces:
        return Identifier(None, [])
    # three lines to a sequence, in random order: moves between languages occur, but seldom
    order = rng.permutation(len(pieces))
    sequences = [[pieces[i] for i in order[lo : lo + 3]] for lo in range(0, len(order), 3)]
    words = [[w for part, _ in s for w in part] for s in sequences]
    labels = np.concatenate([np.full(len(part), k) for s in sequences for part, k in s])
    codes, distinct, counts = crf.coded(words)
    model = crf.train(FEATURES, distinct, codes, counts, labels, len(langs), rounds=25)
    return Identifier(model, langs)


def identify(docs: DataFrame, known: Identifier) -> DataFrame:
    """doc_id, lang_pred, score, second and second_share of every row."""
    return map_texts(docs, "text", ["doc_id"], FIELDS, lambda texts: _identified([t or "" for t in texts], known), BATCH_CHARS)


def _identified(texts: list[str], known: Identifier) -> list:
    k = len(known.langs)
    share = np.zeros((len(texts), max(1, k)))
    if known.model is not None:
        codes, distinct, counts = crf.coded([t.split() for t in texts])
        lettered = np.fromiter((_LETTER.search(w) is not None for w in distinct), bool, len(distinct))
        scores = known.model.emissions(distinct)
        scores[~lettered] = 0  # carries the state on, says nothing itself
        p = crf.marginals(scores[codes], counts, known.model.moves) * lettered[codes][:, None]
        doc = np.repeat(np.arange(len(texts)), counts)
        share = np.stack([np.bincount(doc, p[:, j], len(texts)) for j in range(k)], 1)
    total = share.sum(1)
    share = share / np.maximum(total, 1e-300)[:, None]
    names = np.array([*known.langs, None], object)
    best = np.argsort(-share, 1, kind="stable")
    said = total > 0
    first = best[:, 0]
    other = best[:, 1] if k > 1 else np.full(len(texts), k)
    rows = np.arange(len(texts))
    return [
        np.where(said, names[np.minimum(first, k)], "und"),
        np.where(said, np.clip(share[rows, first], 0, 1), 0.0),
        np.where(said, names[other], None),
        np.where(said & (k > 1), share[rows, np.minimum(other, share.shape[1] - 1)], 0.0),
    ]


def language_id(docs: DataFrame) -> DataFrame:
    """doc_id, held_out, lang_pred, score, second, second_share."""
    return identify(docs, fit(docs)).select(
        "doc_id", (fold(F.col("doc_id"), 5) == 0).alias("held_out"), "lang_pred", "score", "second", "second_share")
