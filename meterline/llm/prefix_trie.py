"""Prefix trie of conversations by fixed-length block hashing.

Every conversation is cut into blocks of ``BLOCK`` turns. A block gets a digest of its number and its turns, a
prefix of whole blocks the sum of its blocks' digests (four 32-bit parts), so prefixes come from running sums
and no conversation is ever read as a whole: sums run within segments of ``SEGMENT`` blocks, and a table of a row per
further segment adds what lies before. Conversations are then grouped by the prefixes before and after each block;
a group is an *edge* of the trie. Only where an edge has siblings are the turn boundaries inside its block
compared: the first 1, 2, ... turns of each different edge are grouped. An edge without siblings is a
chain of nodes with its members.

Subtree totals need no walk over the tree. The nodes that a conversation owns (being their smallest member) are the
end of its path. So the sum of bytes over the different nodes of a subtree is the sum of owned bytes over its members, less what the
owner of the top owns above it; and leaves are counted in the same way, by members that own a leaf.

All groups that may be hot (the first turns of a third of all conversations, a conversation with a third of all
turns) are aggregated before the shuffle or dealt by (conversation, segment). The digest of the members that end at a node is
taken by a task that streams their ids, joined by runs of neighbouring ids beforehand.

Turns are ordered by ``turn`` (null first), ties by role and text; null role or text is empty; repeated rows are
turns of their own. Rows without ``conv_id`` belong to no conversation and are left out. No conversation: no nodes, not even
the root. Only the four columns below are read, so other columns cannot clash.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import stored

#: Turns of a block, blocks of a segment.
BLOCK, SEGMENT = 4, 1024
#: Conversation ids are joined by runs of 2**RUN neighbouring numbers before they are digested.
RUN = 12

PARTS = tuple(f"p{i}" for i in range(4))


def _short(text: Column) -> Column:
    """The first 128 bits of a SHA-256, as hexadecimal digits."""
    return F.substring(F.sha2(text, 256), 1, 32)


def segment(pos: Column) -> Column:
    return F.floor(pos / (BLOCK * SEGMENT)).cast("long")


def _numbered(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Adds the number of each row within the stretch of its conversation, in the order given."""
    last, seen = None, 0
    for batch in batches:
        ids = batch.column(0).to_numpy(zero_copy_only=False)
        if not len(ids):
            continue
        at = np.arange(len(ids))
        new = np.concatenate([[ids[0] != last], ids[1:] != ids[:-1]])
        k = at - np.maximum.accumulate(np.where(new, at, 0))
        if not new[0]:
            k[: int(np.argmax(new)) if new.any() else len(k)] += seen
        last, seen = ids[-1], int(k[-1]) + 1
        yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(k, pa.int64())], names=["conv_id", "part", "t", "n_bytes", "k"])


def positions(turns: DataFrame) -> DataFrame:
    """conv_id, pos (from 0), t (digest of role and text), n_bytes (of the text) of every turn.

    Turns are dealt by ranges of (conversation, turn), so a long conversation lies in many tasks. A task numbers its rows;
    what a conversation has in tasks before is added from a table with a row for at most the first conversation of each task.
    """
    role, text = F.coalesce("role", F.lit("")), F.coalesce("text", F.lit(""))
    rows = turns.where(F.col("conv_id").isNotNull()).select(F.col("conv_id").cast("long").alias("conv_id"), "turn", role.alias("role"), text.alias("text"))
    order = F.col("conv_id"), F.asc_nulls_first("turn")
    rows = rows.repartitionByRange(*order).sortWithinPartitions(*order, "role", "text")
    told = _short(F.concat(F.length("role").cast("string"), F.lit(":"), F.col("role"), F.col("text")))
    rows = rows.select("conv_id", F.spark_partition_id().cast("long").alias("part"), told.alias("t"), F.octet_length("text").cast("long").alias("n_bytes"))
    rows = stored(rows.mapInArrow(_numbered, "conv_id long, part long, t string, n_bytes long, k long"))
    held = rows.groupBy("conv_id", "part").agg(F.count("*").alias("n"))
    before = F.sum("n").over(Window.partitionBy("conv_id").orderBy("part").rowsBetween(Window.unboundedPreceding, -1))
    before = held.select("conv_id", "part", before.alias("before")).where(F.col("before") > 0)
    rows = rows.join(F.broadcast(before), ["conv_id", "part"], "left")  # a row per task of the sort at most
    return rows.select("conv_id", (F.col("k") + F.coalesce("before", F.lit(0))).alias("pos"), "t", "n_bytes")


def _key(number: Column, parts: list[Column]) -> Column:
    return _short(F.concat_ws(",", number, *parts))


def blocks_of(rows: DataFrame) -> DataFrame:
    """conv_id, seg, number, turns (array of t, n_bytes), parent_key and key (of the prefixes before and after), before (bytes of the prefix)."""
    number = F.floor(F.col("pos") / BLOCK).cast("long")
    dealt = rows.select("conv_id", segment(F.col("pos")).alias("seg"), number.alias("number"), F.struct("pos", "t", "n_bytes").alias("x")).repartition("conv_id", "seg")
    blocks = dealt.groupBy("conv_id", "seg", "number").agg(F.sort_array(F.collect_list("x")).alias("x"))
    blocks = blocks.select(
        "conv_id", "seg", "number",
        F.transform("x", lambda x: F.struct(x["t"].alias("t"), x["n_bytes"].alias("n_bytes"))).alias("turns"),
        F.sha2(F.concat_ws(":", "number", F.array_join(F.transform("x", lambda x: x["t"]), "")), 256).alias("digest"),
        F.aggregate("x", F.lit(0).cast("long"), lambda n, x: n + x["n_bytes"]).alias("n_bytes"))
    own = [F.conv(F.substring("digest", 1 + 8 * i, 8), 16, 10).cast("long").alias(p) for i, p in enumerate(PARTS)]
    blocks = blocks.select("conv_id", "seg", "number", "turns", "n_bytes", *own)
    upto = Window.partitionBy("conv_id", "seg").orderBy("number").rowsBetween(Window.unboundedPreceding, 0)
    sums = [F.sum(c).over(upto).alias(f"{c}_sum") for c in (*PARTS, "n_bytes")]
    blocks = stored(blocks.select("*", *sums))
    # what lies in earlier segments: no row for conversations of one segment
    whole = blocks.groupBy("conv_id", "seg").agg(*[F.max(f"{c}_sum").alias(c) for c in (*PARTS, "n_bytes")])
    earlier = Window.partitionBy("conv_id").orderBy("seg").rowsBetween(Window.unboundedPreceding, -1)
    whole = whole.select("conv_id", "seg", *[F.sum(c).over(earlier).alias(f"{c}_0") for c in (*PARTS, "n_bytes")]).where("seg > 0 and n_bytes_0 is not null")
    blocks = blocks.join(whole, ["conv_id", "seg"], "left")
    after = {c: F.col(f"{c}_sum") + F.coalesce(f"{c}_0", F.lit(0)) for c in (*PARTS, "n_bytes")}
    return blocks.select(
        "conv_id", "seg", "number", "turns",
        _key(F.col("number") - 1, [after[p] - F.col(p) for p in PARTS]).alias("parent_key"),
        _key(F.col("number"), [after[p] for p in PARTS]).alias("key"),
        (after["n_bytes"] - F.col("n_bytes")).alias("before"))


def _inner_key(turns: str, n: Column) -> Column:
    """Key of the node after the first ``n`` turns of a block that follows ``parent_key``."""
    head = F.array_join(F.transform(F.slice(turns, 1, n), lambda x: x["t"]), "")
    return F.when(n == BLOCK, F.col("key")).when(n == 0, F.col("parent_key")).otherwise(_short(F.concat(F.col("parent_key"), F.lit("/"), head)))


def _nodes(edges: DataFrame, sums: dict[str, Column]) -> DataFrame:
    """node, parent, depth, n_bytes, before and the sums of each node: grouped where edges have siblings, a chain where not."""
    each = F.transform("turns", lambda x, i: F.struct(
        _inner_key("turns", i + 1).alias("node"),
        _inner_key("turns", i).alias("parent"),
        (F.col("number") * BLOCK + i + 1).alias("depth"),
        x["n_bytes"].alias("n_bytes"),
        (F.col("before") + F.aggregate(F.slice("turns", 1, i), F.lit(0).cast("long"), lambda n, y: n + y["n_bytes"])).alias("before")))
    rows = edges.select("sole", *sums, F.explode(each).alias("x")).select("sole", "x.*", *sums)
    same = [F.any_value(c).alias(c) for c in ("parent", "depth", "n_bytes", "before")]
    split = rows.where("sole is null").groupBy("node").agg(*same, *[s.alias(name) for name, s in sums.items()])
    names = ["node", "parent", "depth", "n_bytes", "before", *sums]
    return rows.where("sole is not null").select(*names).unionByName(split.select(*names))


def _digests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """SHA-256 of the joined ids of each node; rows come by node and run."""
    node, digest = None, None
    for batch in batches:
        done: list[tuple[str, str]] = []
        for key, ids in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
            if key == node:
                digest.update(b",")
            else:
                if node is not None:
                    done.append((node, digest.hexdigest()))
                node, digest = key, hashlib.sha256()
            digest.update(ids.encode())
        yield pa.RecordBatch.from_arrays([pa.array([d[i] for d in done], pa.string()) for i in (0, 1)], names=["node", "ends_sha256"])
    if node is not None:
        yield pa.RecordBatch.from_arrays([pa.array([x], pa.string()) for x in (node, digest.hexdigest())], names=["node", "ends_sha256"])


def trie(rows: DataFrame, convs: DataFrame) -> DataFrame:
    """Nodes of the trie of ``rows`` (conv_id, pos, t, n_bytes) over the conversations ``convs`` (conv_id), also those without turns.

    Returns per node conv_id (its smallest member; with depth it names the node), depth, parent_conv_id, n_convs, n_children,
    n_leaves, saved_tokens and ends_sha256.
    """
    root = _key(F.lit(-1).cast("long"), [F.lit(0).cast("long")] * 4)
    blocks = blocks_of(rows)
    same = [F.any_value(c).alias(c) for c in ("number", "turns", "before")]
    edges = stored(blocks.groupBy("key", "parent_key").agg(F.count("*").alias("n_convs"), F.min("conv_id").alias("conv_id"), *same))
    sole = edges.groupBy("parent_key").agg(F.count("*").alias("n"), F.min("key").alias("key")).where("n = 1").select("key", F.lit(True).alias("sole"))
    edges = edges.join(sole, "key", "left")
    top = convs.agg(F.min("conv_id").alias("conv_id"), F.count("*").alias("n_convs")).where("n_convs > 0").select(
        root.alias("node"), F.lit(None).cast("string").alias("parent"), *[F.lit(0).cast("long").alias(c) for c in ("depth", "n_bytes", "before")], "n_convs", "conv_id")
    nodes = stored(_nodes(edges, {"n_convs": F.sum("n_convs"), "conv_id": F.min("conv_id")}).unionByName(top))
    children = nodes.where("parent is not null").groupBy(F.col("parent").alias("node")).agg(F.count("*").alias("n_children"))
    nodes = stored(nodes.join(children, "node", "left").withColumn("n_children", F.coalesce("n_children", F.lit(0))))

    # what each conversation owns, and its length
    owned = nodes.groupBy("conv_id").agg(
        F.sum("n_bytes").alias("own_bytes"), F.count_if(F.col("n_children") == 0).alias("leaves"), F.min("before").alias("own_from"))
    lengths = blocks.groupBy("conv_id").agg(
        F.sum(F.size("turns")).alias("n_turns"), F.sum(F.aggregate("turns", F.lit(0).cast("long"), lambda n, x: n + x["n_bytes"])).alias("all_bytes"))
    each = convs.join(lengths, "conv_id", "left").join(owned, "conv_id", "left").select(
        "conv_id", F.coalesce("n_turns", F.lit(0)).alias("n_turns"),
        (F.coalesce("all_bytes", F.lit(0)) - F.coalesce("own_bytes", F.lit(0))).alias("spare"), F.coalesce("leaves", F.lit(0)).alias("leaves"))
    each = stored(each)
    by_segment = blocks.select("conv_id", "seg").distinct().join(each, "conv_id")  # a long conversation joins by segments
    members = blocks.join(by_segment, ["conv_id", "seg"])
    totals = members.groupBy("key").agg(F.sum("spare").alias("spare"), F.sum("leaves").alias("n_leaves"))
    totals = _nodes(edges.join(totals, "key"), {"spare": F.sum("spare"), "n_leaves": F.sum("n_leaves")}).select("node", "spare", "n_leaves")
    totals = totals.unionByName(each.agg(F.sum("spare").alias("spare"), F.sum("leaves").alias("n_leaves")).select(root.alias("node"), "spare", "n_leaves"))

    # digests of the conversations that end at a node
    last = F.col("n_turns") - F.col("number") * BLOCK
    ends = members.where(last.between(1, BLOCK)).select(_inner_key("turns", F.size("turns")).alias("node"), "conv_id")
    ends = ends.unionByName(each.where("n_turns = 0").select(root.alias("node"), "conv_id"))
    ends = ends.groupBy("node", F.shiftright("conv_id", RUN).alias("run")).agg(F.array_join(F.transform(
        F.sort_array(F.collect_list("conv_id")), lambda c: c.cast("string")), ",").alias("ids"))
    ends = ends.repartition("node").sortWithinPartitions("node", "run").select("node", "ids").mapInArrow(_digests, "node string, ends_sha256 string")

    above = nodes.select(F.col("node").alias("parent"), F.col("conv_id").alias("parent_conv_id"))
    out = nodes.join(totals, "node").join(ends, "node", "left").join(above, "parent", "left").join(owned.select("conv_id", "own_from"), "conv_id")
    saved = F.col("spare") - F.col("n_convs") * F.col("before") + F.col("before") - F.col("own_from")
    return out.select(
        "conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", saved.alias("saved_tokens"),
        F.coalesce("ends_sha256", F.sha2(F.lit(""), 256)).alias("ends_sha256"))


def prefix_trie(turns: DataFrame) -> DataFrame:
    """Nodes (see ``trie``) of the conversations in rows (conv_id, turn, role, text)."""
    rows = positions(turns)
    return trie(rows, rows.select("conv_id").distinct())
