"""The trie of conversations and the sums of its subtrees against brute force."""

import hashlib
import random
import zlib
from collections import defaultdict

import pytest

from tableloom.llm import forest, prefix_trie, queries

COLUMNS = ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved", "ends_sha256"]
NAMES = ["conv", "at", "seq", "part", "owner", "node", "block", "left", "high", "low", "a", "b", "h", "base", "length", "saved", "depth"]


def ordered(rows):
    """Conversations as lists of (role, text)."""
    out = defaultdict(list)
    for conv, turn, role, text in rows:
        if conv is not None:
            out[conv].append((turn is not None, turn or 0, role or "", text or ""))
    return {c: [t[2:] for t in sorted(turns)] for c, turns in out.items()}


def with_heads(conversations, group=100, heads=6):
    out = {}
    for c, turns in conversations.items():
        h = zlib.crc32(str(c).encode()) % heads
        base = c - (abs(c) % group) * (1 if c >= 0 else -1)
        out[c] = conversations.get(base, [])[:h] + turns[h:]
    return out


def brute(conversations):
    members = defaultdict(list)
    for c in sorted(conversations):
        for d in range(len(conversations[c]) + 1):
            members[tuple(conversations[c][:d])].append(c)
    out = []
    for path, inside in members.items():
        below = [p for p in members if p[:len(path)] == path]
        ends = ",".join(str(c) for c in inside if len(conversations[c]) == len(path))
        leaves = [p for p in below if not any(len(q) == len(p) + 1 and q[:-1] == p for q in members)]
        out.append((
            inside[0], len(path), members[path[:-1]][0] if path else None, len(inside),
            sum(len(p) == len(path) + 1 for p in below), len(leaves),
            sum((len(members[p]) - 1) * len(p[-1][1]) for p in below if p), hashlib.sha256(ends.encode()).hexdigest(),
        ))
    return sorted(out, key=repr)


def frame(spark, rows):
    more = ", ".join(f"`{n}` string" for n in NAMES)
    return spark.createDataFrame([(*r, *NAMES) for r in rows], f"conv_id bigint, turn bigint, role string, text string, {more}")


def found(df):
    return sorted(map(tuple, df.select(*COLUMNS).collect()), key=repr)


EDGES = [
    (0, 1, "user", "hi"), (0, 2, "bot", "hello"), (0, None, None, None), (0, 2, "bot", "again"), (0, 2, "bot", "again"),
    (7, 0, "user", ""), (7, 1, "", "user"), (107, 5, "user", "only own"), (100, 1, "user", "hi"), (100, 2, "bot", "hello"),
    (-3, 1, "user", "hi"), (-3, 2, "bot", "日本語"), (-150, 9, "user", "minus"), (None, 1, "user", "nobody"), (250, 1, "u", "x" * 50_000),
    (251, 1, "u", "x" * 50_000), (300, 1, "u", "x" * 50_000), (10**12, 1, None, "far"), (42, None, None, "a"), (42, None, None, "b"),
]


def test_rebuilt_conversations_with_edges(spark):
    placed = prefix_trie.placed_turns(frame(spark, EDGES).repartition(3))
    nodes = prefix_trie.trie(*prefix_trie.share_heads(placed))
    assert found(nodes) == brute(with_heads(ordered(EDGES)))


def test_empty_table(spark):
    placed = prefix_trie.placed_turns(frame(spark, EDGES[:1]).limit(0))
    nodes = prefix_trie.trie(*prefix_trie.share_heads(placed))
    assert nodes.count() == 0 and nodes.columns == COLUMNS
    lonely = prefix_trie.placed_turns(frame(spark, [(None, 1, "user", "nobody")]))
    assert prefix_trie.trie(*prefix_trie.share_heads(lonely)).count() == 0


def random_rows(seed, convs=60, longest=9):
    draw = random.Random(seed)
    return [(c, i, draw.choice("ub"), draw.choice(["x", "yy", "x"])) for c in range(convs) for i in range(draw.randint(1, longest))]


@pytest.mark.parametrize(("block", "places"), [(1, 2), (25, 4_096)])
def test_any_block_gives_the_same_sums(spark, monkeypatch, block, places):
    """A block of one splits every component by Spark; places of two sum the hashes over many blocks."""
    monkeypatch.setattr(prefix_trie, "PLACES", places)
    rows = [*random_rows(block), *((500, i, "u", "x") for i in range(20))]
    placed = prefix_trie.placed_turns(frame(spark, rows).repartition(3))
    turns, conversations = prefix_trie.share_heads(placed)
    assert found(prefix_trie.trie(turns, conversations, block=block)) == brute(with_heads(ordered(rows)))


def test_many_copies_and_one_long_conversation(spark):
    copies = spark.range(9_000).selectExpr("1000 + id AS conv_id", "0L AS turn", "'u' AS role", "'same' AS text")
    long = spark.range(9_500).selectExpr("1L AS conv_id", "id AS turn", "'u' AS role", "string(id % 3) AS text")
    placed = prefix_trie.placed_turns(copies.unionByName(long))
    conversations = prefix_trie.lengths(placed)
    turns = placed.join(conversations, "conv")
    nodes = {(r["conv_id"], r["depth"]): r for r in prefix_trie.trie(turns, conversations, block=2_000).collect()}
    assert len(nodes) == 2 + 9_500
    root, hot = nodes[1, 0], nodes[1000, 1]
    assert (root["n_convs"], root["n_children"], root["n_leaves"], root["saved"]) == (9_001, 2, 2, 8_999 * 4)
    assert hot["ends_sha256"] == hashlib.sha256(",".join(map(str, range(1000, 10_000))).encode()).hexdigest()
    assert all(nodes[1, d]["n_children"] == (d < 9_500) and nodes[1, d]["n_leaves"] == 1 and nodes[1, d]["saved"] == 0 for d in range(1, 9_501))


def test_decompose_adds_every_subtree_once():
    draw = random.Random(7)
    for n in [1, 2, 3, 10, 200]:
        parent = [-1] + [draw.randrange(max(0, i - draw.choice([1, 5, i])), i) for i in range(1, n)]
        depth = [0] * n
        for i in range(1, n):
            depth[i] = depth[parent[i]] + 1
        order = sorted(range(n), key=depth.__getitem__)
        at = {v: i for i, v in enumerate(order)}
        parent = [at.get(parent[v], -1) for v in order]
        values = [[draw.randint(-5, 9) for _ in range(n)] for _ in range(2)]
        size, wanted = [draw.randint(1, 4) for _ in range(n)], [list(v) for v in values]
        for v in range(n - 1, 0, -1):
            size[parent[v]] += size[v]
            for w in wanted:
                w[parent[v]] += w[v]
        sums = [[0] * n, [0] * n]
        forest.decompose(parent, size, values, sums)
        assert sums == wanted


def test_query_on_the_small_table(spark, small):
    rows = [tuple(r) for r in spark.read.parquet(f"{small}/conversations.parquet").select("conv_id", "turn", "role", "text").collect()]
    nodes = queries.op13_conversation_trie(spark, small).withColumnRenamed("saved_tokens", "saved")
    assert found(nodes) == brute(with_heads(ordered(rows)))
