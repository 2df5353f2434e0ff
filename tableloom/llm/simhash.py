"""SimHash near-duplicates by multi-index hashing.

A text's fingerprint takes each bit by majority over the XXH64 hashes of its word shingles. Equal
fingerprints are one class. A class's fingerprint is cut into segments with a small radius each,
chosen so that two fingerprints within the distance must agree in some segment up to its radius
(the radii plus one sum to more than the distance). Every segment is entered in a table; the other
side enumerates the Hamming ball of the segment's radius, fetches the table's matches, and complete
distances are verified inside the join. Links lead to components by star rounds.

Nothing grows with the pairs of a group: copies share a class, and classes that agree on all but a
few bits are only compared inside the segments they share.

Defined cases: null and empty texts have fingerprint zero and link like any other; texts shorter
than a shingle are one shingle; repeated rows share a class; rows without a key take their class's
component; an empty table gives an empty table.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tableloom.llm.common import word_blocks, written
from tableloom.llm.components import connected_components

SHINGLE_WORDS = 4
MAX_DISTANCE = 4
SEED = 42
#: (first bit, bits, radius) of each segment. Wide segments enumerate more and fetch less.
FEW_SEGMENTS = ((0, 22, 1), (22, 22, 1), (44, 20, 0))
MANY_SEGMENTS = ((0, 32, 2), (32, 32, 1))
#: From this many classes on the wider segments compare fewer fingerprints. The links are the same.
MANY_CLASSES = 20_000_000


def fingerprint(data: bytes, shingle: int = SHINGLE_WORDS) -> int:
    """The 64-bit SimHash of a text's lower-cased word shingles, repeats included."""
    ones, n, tail = np.zeros(64, np.int64), 0, []
    for block in word_blocks(data.lower()):
        words = tail + block
        if len(words) >= shingle:
            joined = b" ".join(words)
            ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1) - 1
            starts = np.concatenate(([0], ends[:-1] + 1))[: len(words) - shingle + 1].tolist()
            hashes = np.array(
                [xxhash.xxh64_intdigest(joined[a:b], SEED) for a, b in zip(starts, ends[shingle - 1:].tolist())], np.uint64
            )
            n += len(hashes)
            for i in range(0, len(hashes), 1 << 15):
                part = hashes[i:i + (1 << 15)]
                ones += np.unpackbits(part.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
            tail = words[len(words) - shingle + 1:]
        else:
            tail = words
    if n == 0:
        return xxhash.xxh64_intdigest(b" ".join(tail), SEED) if tail else 0
    return int(np.packbits(2 * ones > n, bitorder="little").view(np.uint64)[0])


def _fingerprints(shingle: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column(1).cast(pa.binary())
            found = np.fromiter((fingerprint(t.as_py() or b"", shingle) for t in texts), np.uint64, len(texts))
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(found.view(np.int64))], ["key", "print"])

    return run


def fingerprints(docs: DataFrame, key: str, text: str, shingle: int = SHINGLE_WORDS) -> DataFrame:
    """``key`` and ``print`` (the fingerprint's bits as a signed bigint) of each row."""
    narrow = docs.select(F.col(key).alias("key"), F.col(text).alias("text"))
    kind = dict(narrow.dtypes)["key"]
    return narrow.mapInArrow(_fingerprints(shingle), f"key {kind}, print bigint")


def ball(bits: int, radius: int) -> list[int]:
    """The masks that flip at most ``radius`` (0 to 2) of the lowest ``bits`` bits."""
    masks = [0]
    if radius >= 1:
        masks += [1 << i for i in range(bits)]
    if radius >= 2:
        masks += [1 << i | 1 << j for i in range(bits) for j in range(i)]
    return masks


def link_prints(prints: DataFrame, distance: int = MAX_DISTANCE, segments=FEW_SEGMENTS) -> DataFrame:
    """Pairs ``a`` < ``b`` of distinct fingerprints at most ``distance`` bits apart (repeats possible)."""
    covered = sum(bits for _, bits, _ in segments)
    if covered != 64 or sum(radius + 1 for *_, radius in segments) <= distance:
        raise ValueError("the segments do not cover this distance")

    def entry(i: int, first: int, bits: int):
        return F.shiftrightunsigned("print", first).bitwiseAND(F.lit((1 << bits) - 1)).bitwiseOR(F.lit(i << 40))

    def around(start, bits: int, radius: int):
        return F.transform(F.lit(ball(bits, radius)).cast("array<bigint>"), lambda mask: start.bitwiseXOR(mask))

    table = prints.select(
        F.col("print").alias("b"),
        F.explode(F.array(*[entry(i, first, bits) for i, (first, bits, _) in enumerate(segments)])).alias("entry"),
    )
    probes = prints.select(
        F.col("print").alias("a"),
        F.explode(F.flatten(F.array(*[
            around(entry(i, first, bits), bits, radius) for i, (first, bits, radius) in enumerate(segments)
        ]))).alias("probe"),
    )
    near = F.bit_count(F.col("a").bitwiseXOR(F.col("b"))) <= distance
    return probes.join(table, (F.col("probe") == F.col("entry")) & (F.col("a") < F.col("b")) & near).select("a", "b")


def near_duplicates(docs: DataFrame, key: str = "doc_id", text: str = "text",
                    shingle: int = SHINGLE_WORDS, distance: int = MAX_DISTANCE) -> DataFrame:
    """Per row: key, ``fingerprint`` (16 hex digits), ``component_id`` (smallest key reachable)."""
    rows = written(fingerprints(docs, key, text, shingle), "prints")
    classes = written(rows.groupBy("print").agg(F.min("key").alias("first")), "classes")
    many = classes.count() > MANY_CLASSES
    links = link_prints(classes.select("print"), distance, MANY_SEGMENTS if many else FEW_SEGMENTS)
    parts = written(connected_components(links, "a", "b"), "parts")
    lowest = parts.join(classes, F.col("node") == F.col("print")).groupBy("component").agg(F.min("first").alias("low"))
    linked = parts.join(written(lowest, "lowest").withColumnRenamed("component", "_c"), F.col("component") == F.col("_c"))
    labels = written(
        classes.join(linked.select("node", "low"), F.col("print") == F.col("node"), "left")
        .select(F.col("print").alias("_print"), F.coalesce("low", "first").alias("component_id")), "labels")
    return rows.join(labels, F.col("print") == F.col("_print")).select(
        F.col("key").alias(key), F.lower(F.lpad(F.hex("print"), 16, "0")).alias("fingerprint"), "component_id"
    )
