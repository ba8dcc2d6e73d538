"""Benchmark decontamination by SimHash windows, Hamming blocks and weighted-shingle similarity.

A document is contaminated by an item if some window of the item's size has a weighted-shingle similarity of
``SIMILARITY`` or more with it: shingles of five words (lower case, letters and digits only), each weighted
by how often it occurs, minima over maxima. A benchmark item shorter than that is one shingle of its own length.

1. Windows. A window that shares no shingle with an item has similarity zero, and moving a window on to its first
   shared shingle loses none. So the windows looked at are those of the item's size that start at a shared
   shingle (at the end of a text: the last window).
2. Fingerprints. Each window and item gets the SimHash of its shingles.
3. Blocks. The bits are cut into RADIUS + 1 blocks; fingerprints within ``RADIUS`` agree in one block at least, so
   the join on (item, block, value) finds all of them. A pair counts at the first block it agrees in.
4. Verification. Pairs within the radius are compared exactly.

Two texts at the similarity of 0.8 share 8/9 of their shingles, and their fingerprints then differ in about 10
bits of 64 with a deviation of 3; a radius of 21 is four deviations away.

All of it is SQL functions. Texts are never shuffled for the search: shingles meet those of the benchmark in a
broadcast join while these are at most ``BROADCAST_ROWS``, beyond that in a shuffled join, which adaptive
execution splits at hot shingles; the same holds for the ids of rows with a shared shingle.

Null or empty texts have no shingles and are never found; so are null or empty items. Repeated ids with
different texts are looked at as rows of their own, repeated rows give one finding. An ``item_id`` (null included) with
different texts stands for all of them: each is looked for on its own, and the best window of any is its finding. Null ids are kept.
Only ``doc_id`` and ``text``, ``item_id`` and ``text`` are read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import stored

WORDS, SIMILARITY, RADIUS, BITS = 5, 0.8, 21, 64
#: Most rows of a side that is broadcast.
BROADCAST_ROWS = 300_000
#: First bit and width of each block.
BLOCKS = [(BITS * k // (RADIUS + 1), BITS * (k + 1) // (RADIUS + 1) - BITS * k // (RADIUS + 1)) for k in range(RADIUS + 1)]


def _words(text: Column) -> Column:
    return F.filter(F.split(F.lower(F.coalesce(text, F.lit(""))), r"[^\p{L}\p{N}]+"), lambda w: w != "")


def _shingles(words: str, size: int) -> Column:
    """Hashes of all runs of ``size`` words, in order."""
    return F.when(F.size(words) >= size, F.transform(
        F.sequence(F.lit(1), F.size(words) - (size - 1)),
        lambda i: F.xxhash64(F.lit(size), *[F.element_at(words, i + k) for k in range(size)]),
    )).otherwise(F.array().cast("array<bigint>"))


def simhash(shingles: str) -> Column:
    """Bit b is set if it is set in over half of the hashes."""
    ones = F.transform(F.sequence(F.lit(0), F.lit(BITS - 1)), lambda b: F.when(
        2 * F.size(F.filter(shingles, lambda h: F.getbit(h, b) == 1)) > F.size(shingles), F.lit(1)).otherwise(0).cast("long"))
    return F.aggregate(ones, F.lit(0).cast("long"), lambda acc, x: F.shiftrightunsigned(acc, 1).bitwiseOR(F.shiftleft(x, BITS - 1)))


def _block(fp: str, k: int) -> Column:
    start, width = BLOCKS[k]
    return F.shiftrightunsigned(F.col(fp), start).bitwiseAND(F.lit((1 << width) - 1))


def similarity(a: str, b: str) -> Column:
    """Sum of the smaller counts of each shingle over the sum of the larger ones."""
    plain = (F.size(F.array_distinct(a)) == F.size(a)) & (F.size(F.array_distinct(b)) == F.size(b))
    count = lambda of, x: F.size(F.filter(of, lambda y: y == x))
    both = F.when(plain, F.size(F.array_intersect(a, b))).otherwise(
        F.aggregate(F.array_intersect(a, b), F.lit(0), lambda n, x: n + F.least(count(a, x), count(b, x))))
    return both / (F.size(a) + F.size(b) - both)


def _small(df: DataFrame, rows: int) -> DataFrame:
    """With a broadcast hint if ``rows``, its size, allows it."""
    return F.broadcast(df) if rows <= BROADCAST_ROWS else df


def items_of(benchmark: DataFrame) -> DataFrame:
    """item_id, item_hash (of its words), size (words of a shingle), g (hashes) and fp of the items that have a word."""
    rows = benchmark.select("item_id", _words(F.col("text")).alias("w")).where(F.size("w") > 0).distinct()
    size = F.least(F.size("w"), F.lit(WORDS))
    g = F.lit(None).cast("array<bigint>")
    for k in range(1, WORDS + 1):
        g = F.when(size == k, _shingles("w", k)).otherwise(g)
    return rows.select("item_id", F.xxhash64("w").alias("item_hash"), size.alias("size"), g.alias("g")).withColumn("fp", simhash("g"))


def findings(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """doc_id, text_hash, item_id, start_word (from 0), n_words, similarity: the best window of each contaminated row and item."""
    items = stored(items_of(benchmark))
    known = items.select("item_id", "item_hash", "size", F.explode(F.array_distinct("g")).alias("h"))
    n_known = known.count()
    sizes = sorted(r["size"] for r in items.select("size").distinct().collect()) or [WORDS]
    rows = docs.select("doc_id", "text", F.xxhash64("text").alias("text_hash"))
    grams = [F.struct(F.lit(k).alias("size"), _shingles("w", k).alias("g")) for k in sizes]

    def shingled(some: DataFrame) -> DataFrame:
        """doc_id, text_hash, size, g: all shingles of each row, by their size."""
        some = some.select("doc_id", "text_hash", _words(F.col("text")).alias("w"))
        if len(grams) == 1:
            return some.select("doc_id", "text_hash", F.lit(sizes[0]).alias("size"), _shingles("w", sizes[0]).alias("g"))
        return some.select("doc_id", "text_hash", F.explode_outer(F.array(*grams)).alias("x")).select("doc_id", "text_hash", "x.size", "x.g")

    # outer: else the optimiser puts a filter on the size of the array under it, which computes the words again for each shingle
    places = shingled(rows).select("doc_id", "text_hash", "size", F.posexplode_outer("g").alias("at", "h"))
    shared = stored(places.join(_small(known, n_known), ["size", "h"]).select("doc_id", "text_hash", "size", "item_id", "item_hash", "at").distinct())
    ids = stored(shared.select("doc_id", "text_hash").distinct())
    n_ids = ids.count()
    a, b = rows.alias("a"), _small(ids, n_ids).alias("b")
    held = stored(shingled(a.join(b, F.col("a.doc_id").eqNullSafe(F.col("b.doc_id")) & (F.col("a.text_hash") == F.col("b.text_hash")), "left_semi"))
                  .dropDuplicates(["doc_id", "text_hash", "size"]))
    # windows of the item's size from each shared shingle
    s, h, i = shared.alias("s"), held.alias("h"), _small(items, n_known).alias("i")
    met = s.join(i, F.col("s.item_id").eqNullSafe(F.col("i.item_id")) & (F.col("s.item_hash") == F.col("i.item_hash")) & (F.col("s.size") == F.col("i.size"))).select(
        "s.doc_id", "s.text_hash", "s.size", "s.item_id", "s.item_hash", "s.at", F.col("i.g").alias("item_g"), F.col("i.fp").alias("item_fp"))
    met = met.alias("m").join(h, F.col("m.doc_id").eqNullSafe(F.col("h.doc_id")) & (F.col("m.text_hash") == F.col("h.text_hash")) & (F.col("m.size") == F.col("h.size")))
    start = F.least(F.col("at"), F.greatest(F.lit(0), F.size("h.g") - F.size("item_g")))
    windows = met.select("m.doc_id", "m.text_hash", "m.size", "m.item_id", "m.item_hash", start.alias("start"), F.slice("h.g", start + 1, F.size("item_g")).alias("g"))
    windows = windows.dropDuplicates(["doc_id", "text_hash", "size", "item_id", "item_hash", "start"])
    windows = stored(windows.withColumn("fp", simhash("g")))  # computed once, not in each of the blocks
    # blocks: the pairs that agree in one
    blocks = lambda fp: F.explode(F.array(*[F.struct(F.lit(k).alias("block"), _block(fp, k).alias("value")) for k in range(len(BLOCKS))]))
    left = windows.select("*", blocks("fp").alias("x")).select("doc_id", "text_hash", "size", "item_id", "item_hash", "start", "g", "fp", "x.block", "x.value")
    right = items.select(F.col("item_id").alias("i_id"), F.col("item_hash").alias("i_hash"), F.col("g").alias("item_g"), F.col("fp").alias("item_fp"), blocks("fp").alias("x")).select(
        "i_id", "i_hash", "item_g", "item_fp", F.col("x.block").alias("i_block"), F.col("x.value").alias("i_value"))
    pairs = left.join(_small(right, n_known), F.col("item_id").eqNullSafe(F.col("i_id")) & (F.col("item_hash") == F.col("i_hash")) & (F.col("block") == F.col("i_block")) & (F.col("value") == F.col("i_value")))
    first = F.lit(len(BLOCKS))
    for k in reversed(range(len(BLOCKS))):
        first = F.when(_block("fp", k) == _block("item_fp", k), F.lit(k)).otherwise(first)
    near = pairs.where((F.col("block") == first) & (F.bit_count(F.col("fp").bitwiseXOR(F.col("item_fp"))) <= RADIUS))
    found = near.select("doc_id", "text_hash", "item_id", "start", (F.size("g") + F.col("size") - 1).alias("n_words"), similarity("g", "item_g").alias("similarity"))
    best = found.where(F.col("similarity") >= SIMILARITY).groupBy("doc_id", "text_hash", "item_id").agg(
        F.max(F.struct("similarity", (-F.col("start")).alias("back"), "n_words")).alias("x"))
    return best.select("doc_id", "text_hash", "item_id", (-F.col("x.back")).cast("long").alias("start_word"), F.col("x.n_words").cast("long").alias("n_words"), "x.similarity")


def clean(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """The rows of ``docs`` that no item contaminates, with all their columns."""
    bad = stored(findings(docs, benchmark).select("doc_id", "text_hash").distinct())
    a, b = docs.alias("a"), _small(bad, bad.count()).alias("b")
    return a.join(b, F.col("a.doc_id").eqNullSafe(F.col("b.doc_id")) & (F.xxhash64("a.text") == F.col("b.text_hash")), "left_anti")
