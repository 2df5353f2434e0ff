"""A trie of conversations by their first turns, with sums over subtrees.

Turns are sorted over ranges of (conversation, turn, role, text), so a conversation with most of the turns is spread over tasks; a
turn's place is its place in its range plus the turns in the ranges before. A prefix is known by
the sums of four 32-bit pieces of its turns' hashes, each salted with the place: sums run in blocks of
places, and the parent's sums are the node's less its last turn, so prefixes are built without lists. Nodes are grouped sums of
prefixes, which combine before the shuffle; a node's name is its smallest member. Subtree sums
come from ``forest.rollup``, which splits by the weight of members: a node's subtree weighs the turns that its
members have from that node on, which the same grouping counts.

The conversations that end at a node are hashed in order: ranges of sorted ids are packed into texts of
``PACK`` ids at most by many tasks, and the texts of one node pass one after another through one hash.

Defined cases: rows with equal turns are ordered by role and text (a null turn comes first, a null role or text is
empty), so repeated rows are repeated turns; a row without conversation id belongs to none; a very long text
counts and is hashed where it lies; an empty table has no nodes, not even a root; other columns, whatever
their names, pass unread.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tableloom.llm import forest
from tableloom.llm.common import text_or_empty, written

GROUP = 100
HEADS = 6
#: Places whose hashes are summed in one window.
PLACES = 4_096
PACK = 4_096
#: Bits of a row's position in its partition, in ``monotonically_increasing_id``.
POSITION = 33
SUMS = ["s0", "s1", "s2", "s3"]


def placed_turns(conversations: DataFrame, conv: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text") -> DataFrame:
    """``conv``, the place ``at`` of the turn from 0, its ``chars`` and two hashes ``a`` and ``b`` of role and text."""
    rows = conversations.select(
        F.col(conv).cast("bigint").alias("conv"), F.col(turn).alias("turn"), text_or_empty(role).alias("role"), text_or_empty(text).alias("text"),
    ).where(F.col("conv").isNotNull())
    order = ["conv", "turn", "role", "text"]
    turns = written(rows.repartitionByRange(*order).sortWithinPartitions(*order).select(
        "conv", F.monotonically_increasing_id().alias("seq"), F.char_length("text").cast("bigint").alias("chars"),
        F.xxhash64("role", "text").alias("a"), F.xxhash64(F.lit(1), "role", "text").alias("b"),
    ).withColumn("part", F.shiftrightunsigned("seq", POSITION)), "turns")
    stretches = turns.groupBy(F.col("conv").alias("_conv"), F.col("part").alias("_part")).agg(F.min("seq").alias("first"), F.count(F.lit(1)).alias("n"))
    before = F.sum("n").over(Window.partitionBy("_conv").orderBy("_part").rowsBetween(Window.unboundedPreceding, -1))
    shifts = written(stretches.select("_conv", "_part", (F.coalesce(before, F.lit(0)) - F.col("first")).alias("shift")), "stretches")
    joined = turns.join(shifts, (F.col("conv") == F.col("_conv")) & (F.col("part") == F.col("_part")))
    return written(joined.select("conv", (F.col("seq") + F.col("shift")).alias("at"), "chars", "a", "b"), "placed")


def lengths(placed: DataFrame) -> DataFrame:
    """``conv`` and its ``length`` in turns."""
    return placed.groupBy("conv").agg(F.count(F.lit(1)).alias("length"))


def share_heads(placed: DataFrame, group: int = GROUP, heads: int = HEADS) -> tuple[DataFrame, DataFrame]:
    """Conversations whose first turns are those of the first conversation of their group.

    Conversation c takes h = crc32(c) % ``heads`` turns (or all there are) from c - c % ``group``, then its own after its first h.
    Returns the turns as ``trie`` takes them, and the conversations with their lengths, which may be 0.
    """
    known = written(lengths(placed), "lengths")
    wanted = known.select(
        "conv", F.col("length").alias("own"), (F.crc32(F.col("conv").cast("string")) % heads).alias("h"), (F.col("conv") - F.col("conv") % group).alias("base"))
    bases = known.select(F.col("conv").alias("_base"), F.col("length").alias("n"))
    taken = F.least("h", F.coalesce("n", F.lit(0)))
    conversations = written(wanted.join(bases, F.col("base") == F.col("_base"), "left").select(
        "conv", "base", "h", taken.alias("taken"), (taken + F.greatest(F.col("own") - F.col("h"), F.lit(0))).alias("length")), "rebuilt")
    turn = placed.withColumnRenamed("conv", "_conv")
    own = turn.join(conversations, F.col("_conv") == F.col("conv")).where(F.col("at") >= F.col("h"))
    head = turn.where(F.col("at") < heads - 1).join(conversations, F.col("_conv") == F.col("base")).where(F.col("at") < F.col("taken"))
    columns = ["chars", "a", "b", "length"]
    rebuilt = own.select("conv", (F.col("at") - F.col("h") + F.col("taken")).alias("at"), *columns).unionByName(head.select("conv", "at", *columns))
    return rebuilt, conversations.select("conv", "length")


def _prefixes(turns: DataFrame) -> DataFrame:
    """Per conversation and depth: the hash of the prefix and of its parent, and how many turns are ``left`` from there."""
    salted = [F.xxhash64("a", "b", "at"), F.xxhash64(F.lit(1), "a", "b", "at")]
    halves = [half for h in salted for half in (h.bitwiseAND(F.lit(0xFFFFFFFF)), F.shiftrightunsigned(h, 32))]
    pieces = [f"p{i}" for i in range(4)]
    rows = turns.select("conv", "at", "chars", "length", F.floor(F.col("at") / PLACES).alias("block"), *[h.alias(p) for h, p in zip(halves, pieces)])
    running = Window.partitionBy("conv", "block").orderBy("at").rowsBetween(Window.unboundedPreceding, 0)
    summed = rows.select("*", *[F.sum(p).over(running).alias(s) for p, s in zip(pieces, SUMS)])
    earlier = Window.partitionBy("_conv").orderBy("_block").rowsBetween(Window.unboundedPreceding, -1)
    blocks = rows.groupBy(F.col("conv").alias("_conv"), F.col("block").alias("_block")).agg(*[F.sum(p).alias(p) for p in pieces])
    shifts = blocks.select("_conv", "_block", *[F.sum(p).over(earlier).alias(f"_{s}") for p, s in zip(pieces, SUMS)]).where(F.col("_block") > 0)
    later = summed.where(F.col("block") > 0).join(shifts, (F.col("conv") == F.col("_conv")) & (F.col("block") == F.col("_block")))
    later = later.select(*rows.columns, *[(F.col(s) + F.col(f"_{s}")).alias(s) for s in SUMS])
    whole = summed.where(F.col("block") == 0).unionByName(later)
    before = [F.col(s) - F.col(p) for s, p in zip(SUMS, pieces)]

    def named(sums: list[Column], depth: Column) -> list[Column]:
        return [F.xxhash64(*sums, depth), F.xxhash64(F.lit(1), *sums, depth)]

    own = named([F.col(s) for s in SUMS], F.col("at") + 1)
    return whole.select(
        "conv", (F.col("at") + 1).alias("depth"), "chars", (F.col("length") - F.col("at")).alias("left"),
        *[c.alias(n) for c, n in zip([*own, *named(before, F.col("at"))], ("high", "low", "p_high", "p_low"))],
    )


def trie(turns: DataFrame, conversations: DataFrame, block: int = forest.BLOCK) -> DataFrame:
    """Nodes of the trie.

    ``turns`` has ``conv``, ``at``, ``chars``, ``a``, ``b`` and ``length``; ``conversations`` has every ``conv`` and its ``length``.
    A node has ``conv_id`` (smallest member), ``depth``, ``parent_conv_id``, ``n_convs``, ``n_children``, ``n_leaves``, ``saved`` and ``ends_sha256``.
    """
    spark = turns.sparkSession
    prefixes = written(_prefixes(turns), "prefixes")
    nodes = written(prefixes.groupBy("high", "low").agg(
        F.min("conv").alias("owner"), F.min("depth").alias("depth"), F.count(F.lit(1)).alias("n_convs"), F.max("chars").alias("chars"),
        F.sum("left").alias("size"), F.min("p_high").alias("p_high"), F.min("p_low").alias("p_low"),
    ), "nodes")
    root = conversations.agg(F.min("conv").alias("owner"), F.count(F.lit(1)).alias("n_convs"), F.sum(F.col("length") + 1).alias("size")).first()
    linked = written(_linked(nodes, root), "linked")
    same = (F.col("high") == F.col("_high")) & (F.col("low") == F.col("_low"))
    named = linked.where(F.col("depth") > 0).select(F.col("high").alias("_high"), F.col("low").alias("_low"), "owner", "parent")
    paths = written(prefixes.select("conv", "depth", "left", "high", "low").join(named, same).select(
        F.col("conv").alias("owner"), "depth", F.col("owner").alias("ancestor"), F.col("parent").alias("above"), "left"), "paths")
    state = linked.select(
        "owner", "depth", "parent", F.lit(root["owner"]).cast("bigint").alias("top_owner"), F.lit(0).cast("bigint").alias("top_depth"),
        F.lit(root["size"]).cast("bigint").alias("weight"), "size",
        (F.col("n_children") == 0).cast("bigint").alias("n_leaves"), ((F.col("n_convs") - 1) * F.col("chars")).alias("saved"),
    )
    sums = forest.rollup(state, paths, ["n_leaves", "saved"], block)
    ends = paths.where(F.col("left") == 1).select(F.col("ancestor").alias("node"), "depth", F.col("owner").alias("conv"))
    at_root = conversations.where(F.col("length") == 0).select(
        F.lit(root["owner"]).cast("bigint").alias("node"), F.lit(0).cast("bigint").alias("depth"), "conv")
    hashed = _hash_ends(ends.unionByName(at_root))
    key = (F.col("owner") == F.col("_owner")) & (F.col("depth") == F.col("_depth"))
    other = lambda df: df.withColumnsRenamed({"owner": "_owner", "depth": "_depth"})
    joined = linked.select("owner", "depth", "parent", "n_convs", "n_children").join(other(sums), key).drop("_owner", "_depth")
    return joined.join(other(hashed), key, "left").select(
        F.col("owner").alias("conv_id"), "depth", F.col("parent").alias("parent_conv_id"), "n_convs", "n_children", "n_leaves", "saved",
        F.coalesce("ends_sha256", F.lit(hashlib.sha256(b"").hexdigest())).alias("ends_sha256"),
    )


def _linked(nodes: DataFrame, root) -> DataFrame:
    """Nodes and the root with their parent's owner and number of children. The root's many children need no join."""
    names = ["owner", "depth", "parent", "n_convs", "chars", "size", "high", "low"]
    parents = nodes.select(F.col("high").alias("_high"), F.col("low").alias("_low"), F.col("owner").alias("parent"))
    deep = nodes.where(F.col("depth") > 1).join(parents, (F.col("p_high") == F.col("_high")) & (F.col("p_low") == F.col("_low")))
    first = nodes.where(F.col("depth") == 1).withColumn("parent", F.lit(root["owner"]).cast("bigint"))
    children = nodes.where(F.col("depth") > 1).groupBy(F.col("p_high").alias("_high"), F.col("p_low").alias("_low")).agg(F.count(F.lit(1)).alias("n_children"))
    counted = first.select(names).unionByName(deep.select(names)).join(
        children, (F.col("high") == F.col("_high")) & (F.col("low") == F.col("_low")), "left")
    below = counted.select(*names, F.coalesce("n_children", F.lit(0)).alias("n_children"))
    top = nodes.where(F.col("depth") == 1).agg(F.count(F.lit(1)).alias("n_children")).where(F.lit(root["owner"] is not None)).select(
        F.lit(root["owner"]).cast("bigint").alias("owner"), F.lit(0).cast("bigint").alias("depth"), F.lit(None).cast("bigint").alias("parent"),
        F.lit(root["n_convs"]).cast("bigint").alias("n_convs"), F.lit(0).cast("bigint").alias("chars"), F.lit(root["size"]).cast("bigint").alias("size"),
        F.lit(0).cast("bigint").alias("high"), F.lit(0).cast("bigint").alias("low"), "n_children",
    )
    return below.unionByName(top)


def _hash_ends(ends: DataFrame) -> DataFrame:
    """The SHA-256 of each node's comma-joined ids in ascending order."""
    order = ["node", "depth", "conv"]
    packed = ends.repartitionByRange(*order).sortWithinPartitions(*order).mapInArrow(_pack, "owner bigint, depth bigint, seq bigint, ids string")
    return packed.repartition("owner", "depth").sortWithinPartitions("owner", "depth", "seq").mapInArrow(
        _hash, "owner bigint, depth bigint, ends_sha256 string")


def _pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    seq = TaskContext.get().partitionId() << POSITION
    for batch in batches:
        node, depth, ids = (c.to_numpy() for c in batch.columns)
        if not len(ids):
            continue
        changes = np.flatnonzero((node[1:] != node[:-1]) | (depth[1:] != depth[:-1])) + 1
        starts = np.unique(np.concatenate([[0], changes, np.arange(0, len(ids), PACK)]))
        ends = np.append(starts[1:], len(ids))
        texts = [",".join(map(str, ids[a:b].tolist())) for a, b in zip(starts, ends)]
        yield pa.RecordBatch.from_arrays([
            pa.array(node[starts]), pa.array(depth[starts]), pa.array(np.arange(seq, seq + len(starts))), pa.array(texts),
        ], ["owner", "depth", "seq", "ids"])
        seq += len(starts)


def _hash(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    key, digest = None, None
    names = ["owner", "depth", "ends_sha256"]
    for batch in batches:
        done = []
        for owner, depth, ids in zip(*(batch.column(c).to_pylist() for c in ("owner", "depth", "ids"))):
            if (owner, depth) == key:
                digest.update(b",")
            else:
                if key is not None:
                    done.append((*key, digest.hexdigest()))
                key, digest = (owner, depth), hashlib.sha256()
            digest.update(ids.encode())
        if done:
            yield pa.RecordBatch.from_arrays([pa.array(c) for c in zip(*done)], names)
    if key is not None:
        yield pa.RecordBatch.from_arrays([pa.array([v]) for v in (*key, digest.hexdigest())], names)
