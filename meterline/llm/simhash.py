"""SimHash near-duplicates by generalised pigeonhole search in Hamming space.

A document's fingerprint is the bitwise majority of the 64-bit hashes of its 4-word shingles. Two
fingerprints link at ``RADIUS`` or fewer differing bits; groups are the connected components.

Search runs on the distinct fingerprints. Their bits are grouped into partitions, correlated bits
together, so that the other partitions stay selective. Partition p gets its own threshold t_p; by the generalised
pigeonhole principle no link is lost as long as the t_p + 1 add up to RADIUS + 1 (t_p = -1 leaves
partition p out). Dynamic programming picks the thresholds with the fewest estimated candidates, from the
counts of all values of each partition; the same estimate decides how many partitions there are. Each fingerprint is then sent to the values of partition p within
t_p bits of its own, and verified against those that have the value.

Fingerprints that meet at a value are compared in a task in numpy; only links that join parts not yet
joined leave it, at most one for each fingerprint. A value met by more than ``BLOCK`` fingerprints is
cut into blocks, and every pair of blocks is a unit of work of its own, so no task holds more than two blocks
of it and none is left out.

Null text, empty text and text without words: fingerprint zero, linked like any other. Repeated rows and
ids are rows of their own; null ids are members of groups but never give the id (a group of null ids only
has a null component). Only ``doc_id`` and ``text`` are read.
"""

from __future__ import annotations

import itertools
from collections.abc import Iterator

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import col, keep_columns, map_texts, stored, unused
from .components import components

SHINGLE, SEED, RADIUS = 4, 42, 4
BITS = 64
#: Numbers of partitions among which the estimated cost decides, and the cost of a sent row in comparisons.
PARTS, ROW_COST = (2, 3, 4), 40
#: Most fingerprints of one value that are compared in one go.
BLOCK = 2048


def fingerprint(text: str | None) -> int:
    """Fingerprint as a signed 64-bit number."""
    words = (text or "").encode("utf-8", "surrogatepass").lower().split()
    if not words:
        return 0
    joined = b" ".join(words)
    k = min(SHINGLE, len(words))
    lengths = np.fromiter(map(len, words), np.int64, len(words))
    starts = np.cumsum(lengths + 1) - lengths - 1
    ends = starts + lengths
    digest = xxhash.xxh64_intdigest
    h = np.array([digest(joined[s:e], SEED) for s, e in zip(starts[: len(words) - k + 1].tolist(), ends[k - 1 :].tolist())], np.uint64)
    ones = np.zeros(BITS, np.int64)
    for lo in range(0, len(h), 65536):
        ones += np.unpackbits(h[lo : lo + 65536].astype("<u8").view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(0, dtype=np.int64)
    bits = (2 * ones > len(h)).astype(np.uint8)
    return int(np.packbits(bits, bitorder="little").view("<i8")[0])


def fingerprints(docs: DataFrame, keep: list[str] | None = None) -> DataFrame:
    """``keep`` (doc_id) and fp of every row."""
    return map_texts(docs, "text", keep or ["doc_id"], [("fp", "long")], lambda texts: [[fingerprint(t) for t in texts]])


def correlations(distinct: DataFrame) -> np.ndarray:
    """Size of the correlation of each pair of bits, from sums over all distinct fingerprints, added up by partition."""

    def sums(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        both, n = np.zeros((BITS, BITS)), 0
        for frame in frames:
            x = ((frame["fp"].to_numpy().view(np.uint64)[:, None] >> np.arange(BITS, dtype=np.uint64)) & np.uint64(1)).astype(np.float32)
            both += x.T @ x
            n += len(x)
        yield pd.DataFrame({"bit": np.arange(BITS), "n": n, "both": list(both)})

    cells = distinct.select("fp").mapInPandas(sums, "bit int, n long, both array<double>")
    total = cells.select("bit", "n", F.posexplode("both")).groupBy("bit", "pos").agg(F.sum("col").alias("s"), F.sum("n").alias("n")).collect()
    both, n = np.zeros((BITS, BITS)), 1
    for r in total:
        both[r["bit"], r["pos"]], n = r["s"], max(1, r["n"])
    mean = np.diag(both) / n
    spread = np.sqrt(np.maximum(mean * (1 - mean), 1e-9))
    near = np.abs((both / n - np.outer(mean, mean)) / np.outer(spread, spread))
    np.fill_diagonal(near, 0)
    return near


def bit_groups(near: np.ndarray, parts: int) -> list[list[int]]:
    """Bits in groups of equal size, each grown by the bit that correlates most with it."""
    left, groups = set(range(BITS)), []
    while left:
        order = sorted(left)
        group = [max(order, key=lambda b: near[b, order].max())]
        left.discard(group[0])
        while left and len(group) < -(-BITS // parts):
            best = max(sorted(left), key=lambda b: near[b, group].sum())
            group.append(best)
            left.discard(best)
        groups.append(sorted(group))
    return groups


def _masks(bits: list[int], threshold: int) -> list[int]:
    """Masks over the bits of a partition with at most ``threshold`` ones, as signed numbers."""
    out = []
    for k in range(threshold + 1):
        for some in itertools.combinations(bits, k):
            x = sum(1 << b for b in some)
            out.append(x - (1 << 64) if x >> 63 else x)
    return out


def _signed(x: int) -> int:
    return x - (1 << 64) if x >> 63 else x


def thresholds(distinct: DataFrame, groups: list[list[int]]) -> tuple[float, list[int]]:
    """Estimated cost and thresholds, by dynamic programming on the estimated candidates of each partition.

    For threshold t a partition is estimated at the pairs that share a value (from the counts of all
    values) times the values within t bits, plus the rows sent.
    """
    whole = [_signed(sum(1 << b for b in g)) for g in groups]
    values = F.explode(F.array(*[F.struct(F.lit(p).alias("p"), F.col("fp").bitwiseAND(F.lit(m)).alias("v")) for p, m in enumerate(whole)]))
    counts = distinct.select(values.alias("x")).select("x.p", "x.v").groupBy("p", "v").agg(F.count("*").alias("n"))
    told = {r["p"]: (float(r["pairs"]), float(r["n"])) for r in counts.groupBy("p").agg(
        F.sum(F.col("n").cast("double") * F.col("n")).alias("pairs"), F.sum("n").alias("n")).collect()}
    cost = []
    for p, g in enumerate(groups):
        pairs, n = told.get(p, (0.0, 1.0))  # an empty table: the fewest rows sent
        cost.append([0.0] + [len(_masks(g, t)) * (pairs / 2 + ROW_COST * n) for t in range(RADIUS + 1)])
    # best[s]: cheapest way for the first partitions to have thresholds + 1 adding up to s
    best: list[tuple[float, list[int]]] = [(0.0, [])] + [(float("inf"), [])] * (RADIUS + 1)
    for c in cost:
        best = [min(((best[s - u][0] + c[u], [*best[s - u][1], u - 1]) for u in range(s + 1) if best[s - u][0] < float("inf")), default=(float("inf"), []))
                for s in range(RADIUS + 2)]
    return best[RADIUS + 1]


def _joined(members: np.ndarray, of: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Links inside equal runs of ``of`` (sorted), as a forest: pairs of indices."""
    n = len(members)
    start = np.nonzero(np.r_[True, of[1:] != of[:-1]])[0]
    place = np.arange(n) - np.repeat(start, np.diff(np.r_[start, n]))
    root = np.arange(n)
    pairs_a, pairs_b, held = [], [], 0

    def settle() -> None:
        nonlocal pairs_a, pairs_b, held
        if pairs_a:
            a, b = np.concatenate(pairs_a), np.concatenate(pairs_b)
            while True:
                x, y = root[a], root[b]
                low = np.minimum(x, y)
                if (x == y).all():
                    break
                np.minimum.at(root, x, low)
                np.minimum.at(root, y, low)
                while not (root[root] == root).all():
                    root[:] = root[root]
        pairs_a, pairs_b, held = [], [], 0

    for d in range(1, int(place.max(initial=0)) + 1):
        at = np.nonzero(place >= d)[0]
        other = at - d
        near = (np.bitwise_count(members[at] ^ members[other]) <= RADIUS)
        near &= root[at] != root[other]
        if near.any():
            pairs_a.append(at[near])
            pairs_b.append(other[near])
            held += int(near.sum())
            if held > 500_000:
                settle()
    settle()
    linked = np.nonzero(root != np.arange(n))[0]
    return linked, root[linked]


def links(distinct: DataFrame) -> DataFrame:
    """Links (a, b) between distinct fingerprints that join the same groups as all links do."""
    near = correlations(distinct)
    _, found, groups = min((*thresholds(distinct, g), g) for g in (bit_groups(near, parts) for parts in PARTS))
    sent = []
    for p, (g, t) in enumerate(zip(groups, found)):
        if t >= 0:
            whole = _signed(sum(1 << b for b in g))
            sent += [F.struct(F.lit(p).alias("p"), F.col("fp").bitwiseAND(F.lit(whole)).bitwiseXOR(F.lit(m)).alias("v"), F.lit(m != 0).alias("probe"))
                     for m in _masks(g, t)]
    met = distinct.select("fp", F.explode(F.array(*sent)).alias("x")).select("fp", "x.p", "x.v", "x.probe")
    # a value that only one fingerprint meets, or only probes meet, has no pair to verify
    counts = met.groupBy("p", "v").agg(F.count("*").alias("n"), F.max((~F.col("probe")).cast("int")).alias("own"))
    counts = counts.where("n > 1 and own = 1").select("p", "v", F.ceil(F.col("n") / BLOCK).cast("int").alias("cuts"))
    met = met.join(counts, ["p", "v"])
    # one unit for each pair of blocks of a value; a small value has one block and one unit
    block = F.pmod(F.xxhash64("fp", "p"), F.col("cuts")).cast("int")
    units = met.select("fp", "p", "v", block.alias("k"), F.explode(F.sequence(F.lit(0), F.col("cuts") - 1)).alias("o"))
    units = units.select("fp", F.xxhash64("p", "v", F.least("k", "o"), F.greatest("k", "o")).alias("unit"))

    def verify(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held = None
        for frame in itertools.chain(frames, [None]):
            if frame is not None:
                held = frame if held is None else pd.concat([held, frame], ignore_index=True)
            if held is None or not len(held):
                continue
            unit, fp = held["unit"].to_numpy(), held["fp"].to_numpy()
            # the last unit may go on in the next batch
            end = len(unit) if frame is None else int(np.searchsorted(unit, unit[-1], side="left"))
            if end:
                a, b = _joined(fp[:end].view(np.uint64), unit[:end])
                yield pd.DataFrame({"a": fp[a], "b": fp[b]})
            held = held.iloc[end:].reset_index(drop=True)

    return units.repartition("unit").sortWithinPartitions("unit").mapInPandas(verify, "a long, b long").where("a <> b").distinct()


def roots(distinct: DataFrame) -> DataFrame:
    """fp and root (the smallest fingerprint of its group as a number) of every distinct fingerprint."""
    labels = components(links(distinct)).select(F.col("a").alias("fp"), F.col("b").alias("root"))
    return distinct.select("fp").join(labels, "fp", "left").select("fp", F.coalesce("root", "fp").alias("root"))


def near_duplicates(docs: DataFrame) -> DataFrame:
    """doc_id, fp and component_id (smallest doc_id reachable) of every row."""
    fps = stored(fingerprints(docs))
    distinct = stored(fps.groupBy("fp").agg(F.min("doc_id").alias("low")))
    member = distinct.join(roots(distinct), "fp")
    lowest = member.groupBy("root").agg(F.min("low").alias("component_id"))
    of = member.select("fp", "root").join(lowest, "root").select("fp", "component_id")
    return fps.join(of, "fp").select("doc_id", "fp", "component_id")


def keep_one(docs: DataFrame) -> DataFrame:
    """One row of each group, with all columns: the one with the smallest doc_id (null last; of repeated ids any one)."""
    fp, row = unused(docs, "fp"), unused(docs, "row")
    base = stored(map_texts(docs, "text", docs.columns, [(fp, "long")], lambda texts: [[fingerprint(t) for t in texts]])
                  .withColumn(row, F.monotonically_increasing_id()))
    first = F.min(F.struct(F.isnull(col("doc_id")).alias("none"), col("doc_id").alias("doc_id"), col(row).alias("row"))).alias("first")
    lows = stored(base.groupBy(col(fp).alias("fp")).agg(first))
    kept = lows.join(roots(lows), "fp").groupBy("root").agg(F.min("first").alias("first")).select(F.col("first.row").alias(row))
    return keep_columns(base.join(kept, row, "left_semi"), docs.columns)


def simhash(docs: DataFrame) -> DataFrame:
    """doc_id, fingerprint (16 hexadecimal digits), component_id."""
    return near_duplicates(docs).select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")
