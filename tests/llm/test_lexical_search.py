"""Ranked search against brute force in whole numbers."""

import math
import random
import re
from collections import Counter, defaultdict

import numpy as np
import pytest

from tableloom.llm import lexical_search
from tests.llm.conftest import EDGE_TEXTS

NAMES = ["key", "body", "n", "m", "terms", "counts", "place", "salt", "score", "rank", "bucket", "part", "item", "_place", "term"]


def terms(text):
    lowered = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
    return re.findall(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+", lowered)


def brute(docs, items, top=10):
    counts = [Counter(terms(t)) for _, t in docs]
    n_docs, n_terms = sum(1 for c in counts if c), sum(sum(c.values()) for c in counts)
    df = Counter(t for c in counts for t in c)
    asked = defaultdict(set)
    for item, text in items:
        asked[item] |= set(terms(text))
    out = []
    for item, wanted in asked.items():
        scored = []
        for (doc, _), count in zip(docs, counts):
            n, score = sum(count.values()), 0
            for t in wanted & set(count):
                w = math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[t] + 1)))
                score += w * (10**9 * count[t] // (1000 * count[t] + 8 * (10 + 90 * n * n_docs // n_terms)))
            if score > 0:
                scored.append((-score, doc is None, doc, score))
        scored.sort(key=lambda s: (s[0], s[1], s[2] or 0))
        out += [(item, rank, doc, score) for rank, (_, _, doc, score) in enumerate(scored[:top], 1)]
    return sorted(out, key=repr)


def found(df):
    return sorted(map(tuple, df.select("item_id", "rank", "doc_id", "score").collect()), key=repr)


def frames(spark, docs, items):
    """Both tables with columns named like everything inside the operator."""
    more = ", ".join(f"`{n}` string" for n in NAMES)
    return (
        spark.createDataFrame([(*r, *NAMES) for r in docs], f"doc_id bigint, text string, {more}"),
        spark.createDataFrame([(*r, *NAMES) for r in items], f"item_id bigint, text string, {more}"),
    )


ITEMS = [
    (1, "the CAT sat"), (2, "élèves, ÉLÈVES à l'école"), (3, None), (4, ""), (5, "nowhere_found"), (6, "a b c a b c"), (None, "no item id"),
    (7, "cat"), (7, "mat"), (7, "cat"), (8, "日本語テキスト 123"), (9, "x" * 70_000), (10, "--- ..."), (11, " ".join(f"w{i}" for i in range(3_000)) + " cat"),
]


def test_edges_and_clashing_columns(spark):
    docs, items = frames(spark, EDGE_TEXTS, ITEMS)
    assert found(lexical_search.search(docs.repartition(3), items)) == brute(EDGE_TEXTS, ITEMS)


def test_empty_tables(spark):
    docs, items = frames(spark, EDGE_TEXTS, ITEMS)
    assert lexical_search.search(docs.limit(0), items).count() == 0
    empty = lexical_search.search(docs, items.limit(0))
    assert empty.columns == ["item_id", "rank", "doc_id", "score"] and empty.count() == 0
    assert lexical_search.search(docs, items.where("item_id in (3, 4, 10)")).count() == 0


@pytest.mark.parametrize(("group_terms", "items_a_tile", "cells"), [(10_000, 256, 4_000_000), (7, 2, 40), (1, 1, 1)])
def test_groups_tiles_and_ties(spark, monkeypatch, group_terms, items_a_tile, cells):
    """Many equal documents in several tasks: ties are decided by the key, whatever the tiles."""
    monkeypatch.setattr(lexical_search, "CELLS", cells)
    draw = random.Random(group_terms)
    words = "ash birch cedar elm fir oak pine yew Ölbaum".split()
    texts = [" ".join(draw.choices(words, k=draw.randint(1, 6))) for _ in range(12)]
    docs = [(i, draw.choice(texts)) for i in range(150)] + [(149, texts[0]), (None, texts[0])]
    items = [(i, " ".join(draw.sample(words, 3))) for i in range(8)]
    rows, asked = frames(spark, docs, items)
    assert found(lexical_search.search(rows.repartition(4), asked, top=5, group_terms=group_terms, items_a_tile=items_a_tile)) == brute(docs, items, 5)


def test_products_stay_exact_below_the_bound():
    draw = np.random.default_rng(1)
    weights = draw.integers(20_000, 42_000, 900)
    width = lexical_search.block_terms(weights)
    assert 1 <= width < 900 and width * int(weights.max()) * lexical_search.IMPACT_BOUND < 2**53
    impacts = draw.integers(lexical_search.IMPACT_BOUND - 9, lexical_search.IMPACT_BOUND, (3, 900))
    exact = [[sum(int(a) * int(b) for a, b in zip(row, weights))] for row in impacts]
    assert lexical_search.product(impacts.astype(float), weights[:, None].astype(float), width).tolist() == exact
    assert lexical_search.block_terms(np.array([10**12])) == 1 and lexical_search.block_terms(np.zeros(3, np.int64)) == lexical_search.TERMS_A_BLOCK


def test_groups_keep_the_bound(spark):
    _, items = frames(spark, EDGE_TEXTS, [(i, " ".join(f"t{i}x{j}" for j in range(i % 7))) for i in range(60)])
    groups = lexical_search.item_groups(items, "item_id", "text", 20).selectExpr("bucket", "part", "place", "size(terms) AS n").collect()
    sums = Counter()
    for r in groups:
        sums[r["bucket"], r["part"]] += r["n"]
    assert len(sums) >= sum(sums.values()) // 26 and max(sums.values()) < 20 + 6
    for g in sums:
        places = sorted(r["place"] for r in groups if (r["bucket"], r["part"]) == g)
        assert places == list(range(len(places)))
