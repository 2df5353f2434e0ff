"""Line deduplication against brute force."""

import random
import re
from collections import defaultdict

import pytest

from tableloom.llm import line_dedup
from tests.llm.conftest import EDGE_TEXTS

SPACE = " \t\n\x0b\x0c\r"
#: Every column name the operator uses inside.
NAMES = ["owner", "mark", "body", "at", "line", "high", "low", "last", "docs", "places", "_high", "_low", "_owner", "_mark", "kept", "n_lines"]


def brute_key(line):
    return re.sub("[A-Z]", lambda m: m[0].lower(), line.strip(SPACE))


def brute(rows, least=3, chars=20):
    """(id, lines, dropped, kept) of each row; a null id is one document, before all others."""
    rank = lambda i: (i is not None, i or 0)
    owners = defaultdict(set)
    for i, text in rows:
        for line in (text or "").split("\n"):
            owners[brute_key(line)].add(i)
    last = {k: max(o, key=rank) for k, o in owners.items() if len(k) >= chars and len(o) >= least}
    out = []
    for i, text in rows:
        lines = (text or "").split("\n")
        kept = [x for x in lines if last.get(brute_key(x), i) == i]
        out.append((i, len(lines), len(lines) - len(kept), "\n".join(kept)))
    return sorted(out, key=repr)


def found(df):
    return sorted(map(tuple, df.select("doc_id", "n_lines", "n_dropped", "kept").collect()), key=repr)


def frame(spark, rows):
    """The rows with columns named like everything inside the operator."""
    schema = "doc_id bigint, text string, " + ", ".join(f"`{n}` string" for n in NAMES)
    return spark.createDataFrame([(*r, *NAMES) for r in rows], schema)


SHARED = "A line that many documents share"
CASES = [
    (1, SHARED), (2, f"{SHARED}\nown line of the second document"), (3, f"  {SHARED.upper()}\t\r\nx\n{SHARED}\n"),
    (4, "only in two documents, so it stays"), (5, "only in two documents, so it stays"), (5, "only in two documents, so it stays"),
    (6, "Éin Anfang, der überall gleich ist"), (7, "éin Anfang, der überall gleich ist"), (8, "éin anfang, der überall gleich ist"),
    (9, "ÉIN Anfang, der überall gleich ist"), (10, "Éin anfang, der überall gleich ist\n"), (11, "ÉIN anfang, der überall gleich ist"),
    (12, "\n\n\n"), (13, "short"), (14, "short"), (15, "short"), (None, SHARED), (None, f"{SHARED}\nno id"), (16, None), (17, ""),
    (18, "x" * 20 + " "), (19, "x" * 20 + " "), (20, "x" * 20 + " \n" + "x" * 19), (21, "x" * 19), (22, "x" * 19),
    (23, "İstanbul'da bir günı daha"), (24, "i̇stanbul'da bir günı daha"), (25, "İstanbul'da bir GÜNı daha"),
    (26, "first\n" + "the same line again and again\n" * 4_000 + "last"), (27, "the same line again and again"), (28, "the same line again and again"),
]


def test_cases_and_clashing_columns(spark):
    assert found(line_dedup.drop_repeated_lines(frame(spark, CASES))) == brute(CASES)


def test_edge_documents(spark, edge_docs, no_docs):
    rows = [(i, t) for i, t in EDGE_TEXTS]
    assert found(line_dedup.drop_repeated_lines(edge_docs)) == brute(rows)
    assert line_dedup.drop_repeated_lines(no_docs).count() == 0


@pytest.mark.parametrize("least", [1, 2, 4])
def test_random_documents(spark, least):
    draw = random.Random(least)
    pool = ["alpha beta", "Alpha Beta ", "gamma delta", "\tgamma delta", "", "é é é", "É é é", "eps", "z" * 30]
    rows = [(draw.randint(0, 25), "\n".join(draw.choice(pool) + draw.choice(["", "", "1", "2"]) for _ in range(draw.randint(0, 12)))) for _ in range(60)]
    docs = frame(spark, rows).repartition(5)
    assert found(line_dedup.drop_repeated_lines(docs, min_docs=least, min_chars=5)) == brute(rows, least, 5)


def test_no_python_and_no_unshuffled_hot_key(spark, edge_docs):
    plan = line_dedup.drop_repeated_lines(edge_docs)._jdf.queryExecution().toString()
    assert "Python" not in plan and "ArrowEval" not in plan and "Cartesian" not in plan and "Window" not in plan
