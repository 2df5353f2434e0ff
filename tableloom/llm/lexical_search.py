"""Ranked lexical search of documents by dense matrix products.

Items (the queries) are dealt to groups of a bounded number of terms, and a group's items to tiles with a
compact vocabulary each: a dense matrix of term weights, terms by items. One pass over the texts counts
the group's terms in every document and writes them as a sparse table. A second pass reads that table, spreads the
impacts of a tile of documents over a tile's vocabulary as a dense float64 matrix, and multiplies block by
block of terms. Weights and impacts are whole numbers, and a block has so few terms that no partial sum can reach
2^53, so every product is exact in any order of summation; blocks are added up as 64-bit integers. Each tile's
scores go against the lowest score that can still enter an item's top: equal scores stay in until the document
keys have decided, so ties are safe, and a task holds no more than the top of each item.

A term's weight is ``floor(1000 ln((2 N + 2) / (2 df + 1)))``; its impact on a document is
``(10^9 tf) div (1000 tf + 8 m)`` with ``m = 10 + (90 n N) div L``. N counts the documents with a term, L all terms, n
those of the document.

Texts are read where they lie, without a shuffle. Shuffled are only the top rows of each task, ranked in
salted parts first. Broadcast are the terms of one group (at most ``group_terms`` and one item more); a larger
set of items takes more passes.

Defined cases: a null or empty text has no terms; rows of one item id (also of a null one) are one item with all
their terms; an item without terms, or without a document above 0, has no rows; every row of the documents is a document, so
repeated rows are ranked beside each other; a null document key comes last among equal scores; a very long text is
read in blocks, its term numbers held as one array; empty tables on either side give no rows; other columns,
whatever their names, pass unread.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass
from functools import reduce
from itertools import repeat

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tableloom.llm.common import text_or_empty, written
from tableloom.llm.decontaminate import words_of

TOP = 10
#: Terms of the items that are searched in one pass over the documents.
GROUP_TERMS = 300_000
ITEMS_A_TILE = 256
#: Terms of one block product, fewer where the weights ask for it; cells of a dense tile of documents.
TERMS_A_BLOCK = 256
CELLS = 4_000_000
ROWS_A_TILE = 1_024
ROWS_AT_ONCE = 512
#: Whole numbers below this are exact in float64. An impact is below its bound, as 8 m is above 0.
EXACT = 1 << 53
IMPACT_BOUND = 1_000_000
SALTS = 32

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
TERM = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"


def terms_of(text: Column) -> Column:
    return F.regexp_extract_all(F.translate(text, UPPER, LOWER), F.lit(TERM), F.lit(0))


def item_groups(items: DataFrame, item: str, text: str, group_terms: int) -> DataFrame:
    """``item``, its ``terms``, the group (``bucket`` and ``part``) and the ``place`` in the group.

    Buckets are drawn by hash; inside one a running sum starts a new part whenever the terms reach the bound.
    """
    rows = items.select(F.col(item).alias("item"), F.explode(terms_of(text_or_empty(text))).alias("term")).distinct()
    gathered = written(rows.groupBy("item").agg(F.sort_array(F.collect_set("term")).alias("terms")), "item-terms")
    total = gathered.agg(F.sum(F.size("terms"))).first()[0] or 0
    bucketed = gathered.withColumn("bucket", F.pmod(F.xxhash64("item"), F.lit(max(1, math.ceil(total / group_terms)))))
    order = Window.partitionBy("bucket").orderBy("item")
    before = F.coalesce(F.sum(F.size("terms")).over(order.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    parted = bucketed.withColumn("part", F.floor(before / group_terms))
    return parted.withColumn("place", F.row_number().over(Window.partitionBy("bucket", "part").orderBy("item")) - 1)


def _count_terms(vocabulary):
    """Per document: key, its terms in all, and numbers and counts of those in the vocabulary."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number = vocabulary.value.get
        for whole in batches:
            for at in range(0, whole.num_rows, ROWS_AT_ONCE):
                batch = whole.slice(at, ROWS_AT_ONCE)
                sizes, ends, terms, counts = [], [0], [], []
                for text in batch.column(0).cast(pa.binary()):
                    n, known = 0, []
                    for block in words_of(text.as_py() or b""):
                        found = np.fromiter(map(number, block, repeat(-1)), np.int32, len(block))
                        n += len(found)
                        known.append(found[found >= 0])
                    values, times = np.unique(np.concatenate(known), return_counts=True)
                    sizes.append(n)
                    ends.append(ends[-1] + len(values))
                    terms.append(values)
                    counts.append(times)
                ends = pa.array(ends, pa.int32())
                yield pa.RecordBatch.from_arrays([
                    batch.column(1), pa.array(sizes, pa.int64()),
                    pa.ListArray.from_arrays(ends, pa.array(_joined(terms, np.int32))),
                    pa.ListArray.from_arrays(ends, pa.array(_joined(counts, np.int64))),
                ], ["key", "n", "terms", "counts"])

    return run


def _joined(parts: list[np.ndarray], kind) -> np.ndarray:
    return np.concatenate(parts).astype(kind) if parts else np.zeros(0, kind)


@dataclass
class ItemTile:
    """Items with their compact vocabulary: entries of the weight matrix, terms by items."""

    first: int
    items: int
    terms: np.ndarray
    row: np.ndarray
    column: np.ndarray
    weight: np.ndarray

    @classmethod
    def of(cls, first: int, items: list[np.ndarray], weights: np.ndarray) -> ItemTile:
        numbers = _joined(items, np.int64)
        terms, row = np.unique(numbers, return_inverse=True)
        column = np.repeat(np.arange(len(items)), [len(i) for i in items])
        return cls(first, len(items), terms, row, column, weights[numbers])

    def dense(self) -> np.ndarray:
        matrix = np.zeros((len(self.terms), self.items))
        matrix[self.row, self.column] = self.weight
        return matrix


def block_terms(weights: np.ndarray) -> int:
    """How many terms a block may have, so that no sum of weights times impacts reaches 2^53."""
    largest = int(weights.max(initial=0))
    return TERMS_A_BLOCK if not largest else max(1, min(TERMS_A_BLOCK, (EXACT - 1) // (largest * IMPACT_BOUND)))


def product(documents: np.ndarray, items: np.ndarray, width: int) -> np.ndarray:
    """Exact scores, documents by items, from products of ``width`` terms each."""
    scores = np.zeros((len(documents), items.shape[1]), np.int64)
    for at in range(0, len(items), width):
        scores += (documents[:, at:at + width] @ items[at:at + width]).astype(np.int64)
    return scores


class Top:
    """The best documents of each item so far, and the least score that can still enter."""

    def __init__(self, items: int, top: int, kind: pa.DataType):
        self.top, self.least = top, np.ones(items, np.int64)
        self.held = pa.table({"place": pa.array([], pa.int32()), "score": pa.array([], pa.int64()), "key": pa.array([], kind)})

    def add(self, first: int, scores: np.ndarray, keys: pa.Array) -> None:
        row, column = np.nonzero(scores >= self.least[first:first + scores.shape[1]])
        if not len(row):
            return
        new = pa.table({
            "place": pa.array((column + first).astype(np.int32)), "score": pa.array(scores[row, column]), "key": keys.take(pa.array(row)),
        })
        both = pa.concat_tables([self.held, new])
        order = pc.sort_indices(both, [("place", "ascending"), ("score", "descending"), ("key", "ascending")], null_placement="at_end")
        place = both["place"].to_numpy()[order.to_numpy()]
        rank = np.arange(len(place)) - np.searchsorted(place, place)
        self.held = both.take(order.filter(pa.array(rank < self.top))).combine_chunks()
        last = place[rank == self.top - 1]
        self.least[last] = self.held["score"].to_numpy()[np.searchsorted(self.held["place"].to_numpy(), last, "right") - 1]


def _rank(study, top: int):
    """The best documents of a task for every item."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tiles, n_terms, width = study.value
        column_of = np.full(n_terms, -1, np.int32)
        best, dense = None, {}
        for batch in batches:
            if best is None:
                best = Top(sum(t.items for t in tiles), top, batch.schema.field("key").type)
            for tile in tiles:
                if tile.first not in dense:
                    dense = {tile.first: tile.dense()}
                column_of[tile.terms] = np.arange(len(tile.terms))
                rows = max(1, min(ROWS_A_TILE, CELLS // max(1, len(tile.terms))))
                for at in range(0, batch.num_rows, rows):
                    part = batch.slice(at, rows)
                    best.add(tile.first, product(_impacts(part, column_of, len(tile.terms)), dense[tile.first], width), part.column("key"))
                column_of[tile.terms] = -1
        if best is not None:
            yield from best.held.to_batches()

    return run


def _impacts(part: pa.RecordBatch, column_of: np.ndarray, width: int) -> np.ndarray:
    terms, counts = part.column("terms"), part.column("counts").flatten().to_numpy()
    row = np.repeat(np.arange(part.num_rows), terms.value_lengths().to_numpy())
    column = column_of[terms.flatten().to_numpy()]
    length = part.column("m").to_numpy()[row]
    known = column >= 0
    matrix = np.zeros((part.num_rows, width))
    tf = counts[known]
    matrix[row[known], column[known]] = (1_000_000_000 * tf) // (1_000 * tf + 8 * length[known])
    return matrix


def _search_group(rows: DataFrame, group: DataFrame, top: int, items_a_tile: int) -> DataFrame:
    """``place``, ``rank``, ``key`` and ``score`` for the items of one group."""
    context, kind = rows.sparkSession.sparkContext, dict(rows.dtypes)["key"]
    asked = [r["terms"] for r in group.orderBy("place").collect()]
    number = {t: i for i, t in enumerate(sorted({t for terms in asked for t in terms}))}
    vocabulary = context.broadcast({t.encode(): i for t, i in number.items()})
    counted = written(rows.mapInArrow(
        _count_terms(vocabulary), f"key {kind}, n bigint, terms array<int>, counts array<bigint>"), "term-counts")
    n_docs, n_terms = counted.agg(F.count_if(F.col("n") > 0), F.sum("n")).first()
    holding = np.zeros(len(number), np.int64)
    for r in counted.select(F.explode("terms").alias("term")).groupBy("term").agg(F.count(F.lit(1)).alias("df")).collect():
        holding[r["term"]] = r["df"]
    weights = np.array([math.floor(1000 * math.log((2 * n_docs + 2) / (2 * int(df) + 1))) for df in holding], np.int64)
    numbered = [np.array([number[t] for t in terms], np.int64) for terms in asked]
    tiles = [ItemTile.of(at, numbered[at:at + items_a_tile], weights) for at in range(0, len(numbered), items_a_tile)]
    study = context.broadcast((tiles, len(number), block_terms(weights)))
    share = F.expr(f"(CAST(90 * n AS DECIMAL(19, 0)) * CAST({n_docs} AS DECIMAL(19, 0))) div CAST({max(1, n_terms or 0)} AS DECIMAL(19, 0))")
    ready = counted.where("size(terms) > 0").select("key", (F.lit(10) + share).cast("bigint").alias("m"), "terms", "counts")
    tops = ready.mapInArrow(_rank(study, top), f"place int, score bigint, key {kind}")
    salted = tops.withColumn("salt", F.pmod(F.xxhash64("key"), F.lit(SALTS)))
    first = [F.col("score").desc(), F.col("key").asc_nulls_last()]
    for keys in (["place", "salt"], ["place"]):
        salted = salted.withColumn("rank", F.row_number().over(Window.partitionBy(*keys).orderBy(*first))).where(F.col("rank") <= top)
    return salted.select("place", "rank", "key", "score")


def search(docs: DataFrame, items: DataFrame, key: str = "doc_id", text: str = "text", item: str = "item_id", item_text: str = "text",
           top: int = TOP, group_terms: int = GROUP_TERMS, items_a_tile: int = ITEMS_A_TILE) -> DataFrame:
    """Item, ``rank`` (from 1), document key and ``score`` of the best documents of every item."""
    rows = docs.select(F.col(text).alias("body"), F.col(key).alias("key"))
    groups = written(item_groups(items, item, item_text, group_terms), "item-groups")
    names = [F.col("item").alias(item), "rank", F.col("key").alias(key), "score"]
    found = []
    for r in groups.select("bucket", "part").distinct().orderBy("bucket", "part").collect():
        group = groups.where((F.col("bucket") == r["bucket"]) & (F.col("part") == r["part"]))
        placed = group.select("item", F.col("place").alias("_place"))
        ranked = _search_group(rows, group.select("place", "terms"), top, items_a_tile)
        found.append(ranked.join(placed, F.col("place") == F.col("_place")).select(*names))
    if not found:
        unknown = [F.lit(None).cast(t) for t in ("int", dict(rows.dtypes)["key"], "bigint")]
        return groups.limit(0).select(F.col("item").alias(item), *[c.alias(n) for c, n in zip(unknown, ("rank", key, "score"))])
    return reduce(DataFrame.unionByName, found)
