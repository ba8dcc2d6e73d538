"""License scan by diagonal voting.

Every rolling word k-gram of every text is hashed and joined with the positions of equal k-grams in license notices.
A meeting of text position ``p`` with position ``q`` of a notice votes for the diagonal ``p - q``: text that
follows a notice puts all its votes on one diagonal, words put in or left out move it to a neighbour. Votes are
aggregated by diagonal, neighbouring diagonals of a notice are merged to a span, and spans with a share of the votes are verified on
the words themselves: the longest common subsequence of span and notice, over the longer of both. Of spans that
overlap only those with the most words in common count.

Base phrases are notices too; theirs is a span only where all votes fall on one diagonal and the words are equal.
``K`` is the length of a k-gram; a shorter notice is one k-gram of its own length. A notice with so many changes that none
of its k-grams is left is not found.

Words are letters and digits of ASCII and all other characters beyond ASCII; capitals A-Z count as small ones.
The notices are a parameter (a list on the driver); their positions are broadcast as long as there are at most
``BROADCAST_GRAMS``. Texts are known by 128 bits of hash, so copies of one text vote once, and only texts with a span to verify
are read again with their words. Places within one text are the largest group there is.

Null text: empty. Repeated rows and ids get a row each, null ids are kept, an empty table gives no rows. Only ``doc_id`` and
``text`` are read, so other columns cannot clash.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_type

from .common import stored

# The phrases of the base, and the usual wording of license notices.
PHRASES = (("mit", "mit license"), ("apache", "apache license"), ("gpl", "general public license"))
NOTICES = (
    ("agpl", "under the terms of the GNU Affero General Public License as published by the Free Software Foundation"),
    ("apache", "Licensed under the Apache License, Version 2.0"),
    ("apache", "you may not use this file except in compliance with the License. You may obtain a copy of the License at"),
    ("bsd", "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met"),
    ("cc-by", "This work is licensed under a Creative Commons Attribution 4.0 International License"),
    ("cc-by", "Licensed under CC BY 4.0"),
    ("cc-by-nc", "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License"),
    ("cc-by-nc", "Licensed under CC BY-NC 4.0"),
    ("cc-by-sa", "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License"),
    ("cc-by-sa", "Licensed under CC BY-SA 4.0"),
    ("cc0", "To the extent possible under law, the author has waived all copyright and related or neighboring rights to this work"),
    ("gpl", "This work is licensed under the GNU General Public License, version 3"),
    ("gpl", "you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation"),
    ("isc", "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted"),
    ("lgpl", "under the terms of the GNU Lesser General Public License as published by the Free Software Foundation"),
    ("mit", "Released under the MIT License"),
    ("mit", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files"),
    ("mpl", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0"),
    ("unlicense", "This is free and unencumbered software released into the public domain"),
)
WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
_SMALL = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")

#: Words of a k-gram; diagonals that differ by so much are neighbours; share of a notice's k-grams that must vote;
#: similarity from which a span gets the label of its notice.
K, NEAR, SHARE, SIMILARITY = 3, 2, 0.3, 0.75
BROADCAST_GRAMS = 1_000_000

Span = tuple[int, int, int, int, int]  # number of the notice, first and last diagonal, first word, word after the last


def words(text: str | None) -> list[str]:
    return WORD.findall((text or "").translate(_SMALL))


def _grams(w: str, k: int) -> Column:
    """Hashes of the ``k``-grams of the words; none for fewer words."""
    at = F.sequence(F.lit(0), F.size(w) - k)
    hashes = F.transform(at, lambda i: F.xxhash64(*[F.get(F.col(w), i + j) for j in range(k)]))
    return F.when(F.size(w) >= k, hashes).otherwise(F.array().cast("array<bigint>"))


def _told(text: Column) -> Column:
    # ``lower`` also changes letters beyond ASCII; that can only add candidates, which are verified on the words
    return F.filter(F.split(F.lower(text), r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"), lambda x: x != "")


def _keyed(docs: DataFrame) -> DataFrame:
    text = F.coalesce("text", F.lit(""))
    return docs.select("doc_id", text.alias("text"), F.xxhash64(text).alias("key_a"), F.xxhash64(F.lit(1), text).alias("key_b"))


def candidates(docs: DataFrame, notices: list[tuple[str, str, bool]]) -> DataFrame:
    """key_a, key_b, spans: the spans of each text that has some to verify. ``notices`` are label, text, whether a phrase."""
    spark = docs.sparkSession
    sizes = {i: min(K if not phrase else len(words(text)), len(words(text))) for i, (_, text, phrase) in enumerate(notices)}
    if not all(sizes.values()):
        raise ValueError("a notice has no words")
    given = [(i, sizes[i], len(words(text)) - sizes[i] + 1, words(text)) for i, (_, text, _) in enumerate(notices)]
    known = spark.createDataFrame(given, "notice int, size int, n_grams int, w array<string>")
    each = F.lit(None).cast("array<bigint>")
    kinds = sorted(set(sizes.values()))
    for k in kinds:
        each = F.when(F.col("size") == k, _grams("w", k)).otherwise(each)
    known = known.select("notice", "size", "n_grams", F.posexplode(each).alias("q", "h"))
    if sum(n for _, _, n, _ in given) <= BROADCAST_GRAMS:
        known = F.broadcast(known)

    texts = _keyed(docs).select("key_a", "key_b", _told(F.col("text")).alias("w"))
    texts = texts.select("key_a", "key_b", F.size("w").alias("n"), F.concat(*[_grams("w", k) for k in kinds]).alias("g"))
    # outer: else the optimiser filters by the size of the array under it, which computes the words once more
    places = texts.select("key_a", "key_b", "n", F.posexplode_outer("g").alias("i", "h"))
    met = places.join(known, "h")
    first = F.lit(0)  # hashes of the k-grams of each length follow each other in ``g``
    start = F.lit(0)
    for k in kinds:
        start = F.when(F.col("size") == k, first).otherwise(start)
        first = first + F.greatest(F.lit(0), F.col("n") - (k - 1))
    met = met.select("key_a", "key_b", "notice", "size", "n_grams", "q", (F.col("i") - start - F.col("q")).alias("diagonal"))
    # copies of a text vote once; the first step of both counts runs before the shuffle
    votes = met.distinct().groupBy("key_a", "key_b", "notice", "size", "n_grams", "diagonal").agg(
        F.count("*").alias("votes"), F.min("q").alias("low"), F.max("q").alias("high"))

    along = Window.partitionBy("key_a", "key_b", "notice").orderBy("diagonal")
    phrase = F.col("notice").isin([i for i, (*_, p) in enumerate(notices) if p])
    far = F.coalesce(F.col("diagonal") - F.lag("diagonal").over(along) > NEAR, F.lit(True)) | phrase
    merged = votes.withColumn("far", far.cast("int")).withColumn("group", F.sum("far").over(along))
    spans = merged.groupBy("key_a", "key_b", "notice", "n_grams", "group").agg(
        F.sum("votes").alias("votes"), F.min("diagonal").alias("d0"), F.max("diagonal").alias("d1"),
        F.min(F.col("diagonal") + F.col("low")).alias("start"), F.max(F.col("diagonal") + F.col("high") + F.col("size")).alias("stop"))
    spans = spans.where(F.when(phrase, F.col("votes") >= F.col("n_grams")).otherwise(F.col("votes") >= SHARE * F.col("n_grams")))
    return spans.groupBy("key_a", "key_b").agg(F.collect_list(F.struct("notice", "d0", "d1", "start", "stop")).alias("spans"))


def common_subsequence(a: list[str], b: list[str]) -> int:
    """Length of the longest common subsequence, a bit per word of ``a``."""
    where: dict[str, int] = {}
    for i, w in enumerate(a):
        where[w] = where.get(w, 0) | 1 << i
    full = (1 << len(a)) - 1
    free = full
    for w in b:
        here = free & where.get(w, 0)
        free = (free + here | free - here) & full
    return len(a) - free.bit_count()


def _best(spans: list[tuple]) -> list[tuple]:
    """The spans, by start, without those that overlap one with more words in common: notices share much of their wording."""
    beaten, active = set(), []
    for i, (_, start, _, _, common) in enumerate(spans):
        active = [k for k in active if spans[k][2] > start]
        for k in active:
            if common != spans[k][4]:
                beaten.add(k if spans[k][4] < common else i)
        active.append(i)
    return [s for i, s in enumerate(spans) if i not in beaten]


def verified(text: str, spans: list[Span], notices: list[tuple[str, list[str], bool]]) -> tuple:
    """n_words, n_base, first_word, last_word, base_labels, labels, score, spans of a text."""
    told = words(text)
    base, base_labels, found, near, score = [], set(), [], [], 0.0
    for number, d0, d1, start, stop in sorted(spans, key=lambda s: (s[3], s[4], s[0])):
        label, notice, phrase = notices[number]
        if phrase:
            if told[d0: d0 + len(notice)] == notice:
                base.append(d0)
                base_labels.add(label)
                found.append((label, d0, d0 + len(notice), 1.0))
                score = 1.0
            continue
        there = told[max(0, d0): d1 + len(notice)]
        common = common_subsequence(notice, there)
        alike = common / max(len(notice), stop - start)
        score = max(score, alike)
        if alike >= SIMILARITY:
            near.append((label, start, stop, round(alike, 6), common))
    found = sorted([*found, *(s[:4] for s in _best(near))], key=lambda s: (s[1], s[2], s[0]))
    return (len(told), len(base), min(base, default=None), max(base, default=None), ",".join(sorted(base_labels)),
            ",".join(sorted({f[0] for f in found})), round(score, 6), [dict(zip(("label", "start", "stop", "similarity"), f)) for f in found])


FIELDS = T.StructType([
    *[T.StructField(n, T.LongType()) for n in ("n_words", "n_base", "first_word", "last_word")],
    *[T.StructField(n, T.StringType()) for n in ("base_labels", "labels")],
    T.StructField("score", T.DoubleType()),
    T.StructField("spans", T.ArrayType(T.StructType([
        T.StructField("label", T.StringType()), T.StructField("start", T.LongType()), T.StructField("stop", T.LongType()), T.StructField("similarity", T.DoubleType())]))),
])


def scan(docs: DataFrame, notices: tuple[tuple[str, str], ...] = NOTICES, phrases: tuple[tuple[str, str], ...] = PHRASES) -> DataFrame:
    """doc_id, n_words, n_base, first_word, last_word, base_labels, labels, score and spans (label, start, stop, similarity) of every row."""
    given = [*[(label, text, True) for label, text in phrases], *[(label, text, False) for label, text in notices]]
    split = [(label, words(text), phrase) for label, text, phrase in given]
    spans = stored(candidates(docs, given))
    keyed = _keyed(docs)
    types = [to_arrow_type(f.dataType) for f in FIELDS]

    def check(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = [verified(t.as_py(), [tuple(s.values()) for s in x.as_py()], split) for t, x in zip(batch.column(1), batch.column(2))]
            made = [pa.array([r[i] for r in rows], type=kind) for i, kind in enumerate(types)]
            yield pa.RecordBatch.from_arrays([batch.column(0), *made], names=["doc_id", *FIELDS.names])

    schema = T.StructType([keyed.schema["doc_id"], *FIELDS])
    some = keyed.join(spans, ["key_a", "key_b"]).select("doc_id", "text", "spans").mapInArrow(check, schema)
    # texts without a span are not shuffled with their words
    none = keyed.select("doc_id", "key_a", "key_b", F.regexp_count(F.lower("text"), F.lit(WORD.pattern)).cast("long").alias("n_words"))
    none = none.join(spans.select("key_a", "key_b"), ["key_a", "key_b"], "left_anti")
    empty = {"n_words": F.col("n_words"), "n_base": F.lit(0), "base_labels": F.lit(""), "labels": F.lit(""), "score": F.lit(0.0), "spans": F.array()}
    return some.unionByName(none.select("doc_id", *[empty.get(f.name, F.lit(None)).cast(f.dataType).alias(f.name) for f in FIELDS]))
