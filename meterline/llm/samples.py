"""Bounded samples of labelled rows for the classifiers.

A sample is chosen by a hash of the id, so it does not depend on the order or number of partitions.
Its bound is the parameter ``limit``; only rows with a text of at most ``max_chars`` characters are
taken, which bounds its size as well.
"""

from __future__ import annotations

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

MAX_CHARS = 20_000


def labelled_ids(labels: DataFrame, label: str, allowed: Column, limit: int) -> DataFrame:
    """At most ``limit`` ids of each of the values 0 and 1 of ``label``, those with the smallest hashes.

    A repeated id counts once, with its largest label.
    """
    known = labels.where(F.col("doc_id").isNotNull() & F.col(label).isin(0, 1) & allowed)
    known = known.groupBy("doc_id").agg(F.max(label).alias("label"))
    order = F.xxhash64("doc_id"), F.col("doc_id")
    return known.where("label = 1").orderBy(*order).limit(limit).unionAll(known.where("label = 0").orderBy(*order).limit(limit))


def texts_of(docs: DataFrame, ids: DataFrame, limit: int, max_chars: int = MAX_CHARS) -> pd.DataFrame:
    """label and text of the sampled ids (at most ``limit`` rows), one row for each different text."""
    rows = docs.where(F.col("text").isNotNull() & (F.length("text") <= max_chars)).select("doc_id", "text")
    got = rows.join(F.broadcast(ids), "doc_id").groupBy("text").agg(F.max("label").alias("label"), F.min("doc_id").alias("doc_id"))
    out = got.orderBy(F.xxhash64("doc_id"), "doc_id", "text").limit(limit).toPandas()
    return out[["text", "label"]]
