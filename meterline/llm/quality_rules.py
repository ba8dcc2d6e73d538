"""Quality rules as a bitmask ledger.

``ledger`` measures every document once and evaluates every rule once: it stores the measurements and
one bit per failed rule. A policy is a version with a set of rules; applying it is one ``&`` with
the stored bits, so a new version reads no text. ``ablations`` counts, from the bits alone, what each
rule of each policy removes and what it removes alone.

All measurements are SQL functions within the row; nothing is shuffled. Windows of three words are
compared by 64-bit hashes.

Null text: no words, all measurements zero. Empty text: the same. Repeated rows and ids are measured
each on their own, null ids are kept. Only ``doc_id`` and ``text`` are read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import stored, words_of

#: Rules in the order of their bits. Each gets the measurements and is true where a document fails.
RULES: dict[str, object] = {
    "short": lambda m: m("n_words") < 50,
    "repeated_words": lambda m: 100 * m("n_repeat_words") > 50 * m("n_words"),
    "symbols": lambda m: 2 * m("n_symbols") > m("n_words"),
    "repeated_lines": lambda m: (m("n_lines") >= 4) & (2 * m("n_dup_lines") > m("n_lines")),
    "word_length": lambda m: (m("word_chars") < 2 * m("n_words")) | (m("word_chars") > 25 * m("n_words")),
    "capitals": lambda m: 2 * m("n_upper") > m("word_chars"),
}
#: The rules every verdict includes.
BASE = ("short", "repeated_words")
#: Versions of the policy; the last is the one in force.
POLICIES: dict[str, tuple[str, ...]] = {
    "v1": BASE,
    "v2": (*BASE, "symbols"),
    "v3": tuple(RULES),
}
MEASURES = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_lines", "n_upper")


def mask(rules) -> int:
    """Bits of the named rules."""
    order = list(RULES)
    return sum(1 << order.index(r) for r in rules)


def _covered(positions: Column) -> Column:
    """Words in windows of three that start at these sorted positions."""
    return F.aggregate(
        F.transform(positions, lambda p, i: F.when(i == 0, F.lit(3)).otherwise(F.least(F.lit(3), p - F.get(positions, i - 1)))),
        F.lit(0), lambda n, x: n + x)


def measured(docs: DataFrame) -> DataFrame:
    """doc_id and the measurements of every row."""
    text = F.coalesce("text", F.lit(""))
    rows = docs.select("doc_id", text.alias("text"), words_of(F.col("text")).alias("w"))
    rows = rows.select(
        "doc_id", "w",
        F.length(F.regexp_replace("text", r"[^#*$%&|<>]+", "")).alias("n_symbols"),
        F.length(F.regexp_replace("text", r"[^A-Z]+", "")).alias("n_upper"),
        F.filter(F.split("text", "\n"), lambda x: F.rlike(x, F.lit(r"[^\x20\x09-\x0D]"))).alias("lines"),
        F.size("w").alias("n_words"),
    )
    rows = rows.select(
        "doc_id", "n_words", "n_symbols", "n_upper",
        F.length(F.array_join("w", "")).alias("word_chars"),
        F.size("lines").alias("n_lines"),
        (F.size("lines") - F.size(F.array_distinct("lines"))).alias("n_dup_lines"),
        F.when(F.col("n_words") >= 3, F.transform(
            F.sequence(F.lit(1), F.col("n_words") - 2),
            lambda i: F.xxhash64(F.element_at("w", i), F.element_at("w", i + 1), F.element_at("w", i + 2)))).alias("grams"),
    )
    # only a text with an equal pair of windows needs their places
    rows = rows.withColumn("s", F.when(
        F.size(F.array_distinct("grams")) < F.size("grams"),
        F.sort_array(F.transform("grams", lambda h, i: F.struct(h.alias("h"), i.alias("i"))))))
    again = F.filter("s", lambda x, k: F.get("s", k - 1)["h"].eqNullSafe(x["h"]) | F.get("s", k + 1)["h"].eqNullSafe(x["h"]))
    rows = rows.withColumn("p", F.sort_array(F.transform(again, lambda x: x["i"])))
    return rows.select("doc_id", *[
        (F.coalesce(_covered(F.col("p")), F.lit(0)) if m == "n_repeat_words" else F.col(m)).cast("long").alias(m) for m in MEASURES])


def ledger(docs: DataFrame) -> DataFrame:
    """doc_id, measurements, fail_bits (bit k: rule k of ``RULES`` failed)."""
    rows = measured(docs)
    bits = F.lit(0).cast("long")
    for k, rule in enumerate(RULES.values()):
        bits = bits + F.when(rule(F.col), F.lit(1 << k)).otherwise(0).cast("long")
    # written once: policies and filters on it read the table and never evaluate a rule again
    return stored(rows.withColumn("fail_bits", bits))


def with_verdict(rows: DataFrame, version: str | None = None) -> DataFrame:
    """Add base_failed and kept by a policy's version; base rules count in each."""
    version = version or list(POLICIES)[-1]
    base = F.col("fail_bits").bitwiseAND(F.lit(mask(BASE))) != 0
    failed = F.col("fail_bits").bitwiseAND(F.lit(mask(BASE) | mask(POLICIES[version]))) != 0
    return rows.select("*", base.alias("base_failed"), (~failed).alias("kept"), F.lit(version).alias("policy"))


def ablations(rows: DataFrame) -> DataFrame:
    """For each policy and rule: documents that fail the rule, fail only that rule, and the policy.

    Works on the counts per set of bits, of which there are at most 2 to the number of rules.
    """
    sets = rows.groupBy("fail_bits").agg(F.count("*").alias("n"))
    cases = F.array(*[
        F.struct(F.lit(v).alias("policy"), F.lit(r).alias("rule"), F.lit(mask(rules)).cast("long").alias("all"), F.lit(mask([r])).cast("long").alias("one"))
        for v, rules in POLICIES.items() for r in rules])
    told = sets.select("fail_bits", "n", F.explode(cases).alias("c")).select("fail_bits", "n", "c.*")
    of = F.col("fail_bits").bitwiseAND(F.col("all"))
    return told.groupBy("policy", "rule").agg(
        F.sum(F.when(F.col("fail_bits").bitwiseAND(F.col("one")) != 0, F.col("n")).otherwise(0)).alias("n_failed"),
        F.sum(F.when(of == F.col("one"), F.col("n")).otherwise(0)).alias("n_failed_alone"),
        F.sum(F.when(of != 0, F.col("n")).otherwise(0)).alias("n_policy_failed"),
    )
