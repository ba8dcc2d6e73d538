"""A training corpus from ``documents``: five stages, each an operator of ``meterline.llm``.

1. toxicity: documents with a toxicity score of 0.7 or more go.
2. near_duplicates: one document of each SimHash group stays, the one with the smallest id.
3. decontamination: documents with a passage of ``benchmark`` go.
4. secret_scan: secrets are replaced by a mark; every document stays.
5. mixing: every document gets the rate at which it is used for the target weights.

Each stage gets what its predecessor kept, written as Parquet and read again. All but the last return
the columns of ``documents``, extra ones included.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from meterline.llm import decontamination, mixing, secret_scan, simhash, toxicity
from meterline.llm.common import shared_folder, table
from meterline.session import prepare


def remove_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return toxicity.reject(docs, table(prepare(spark), sf_dir, "labels"))


def remove_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    prepare(spark)
    return simhash.keep_one(docs)


def remove_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return decontamination.clean(docs, table(prepare(spark), sf_dir, "benchmark"))


def redact_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    prepare(spark)
    return secret_scan.redact(docs)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    known = mixing.domain_of(table(prepare(spark), sf_dir, "labels"))
    return mixing.mix(docs, known, mixing.TARGETS, docs.columns)


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("toxicity", remove_toxic),
    ("near_duplicates", remove_near_duplicates),
    ("decontamination", remove_contaminated),
    ("secret_scan", redact_secrets),
    ("mixing", mix_sources),
]

#: The stages contain a trained field, a graph search and a fit, which SQL cannot express; tests hold them against brute force.
ORACLE_SQL: str | None = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Apply the stages to ``documents``, each written to the shared folder and read again."""
    docs = table(prepare(spark), sf_dir, "documents")
    folder = f"{shared_folder(spark)}/corpus-{uuid.uuid4().hex}"
    for k, (name, stage) in enumerate(STAGES):
        out = stage(spark, docs, sf_dir)
        out.write.parquet(f"{folder}/{k}-{name}")
        docs = spark.read.schema(out.schema).parquet(f"{folder}/{k}-{name}")
    return docs
