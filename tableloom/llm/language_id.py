"""Language identification by compression.

For each language a zstandard raw-content dictionary is filled with sampled training texts. A text is
compressed with every dictionary, block by block over its whole length, and goes to the language whose
dictionary leaves the fewest bytes; the score is the share by which the second needs more. A text whose
margin is too narrow is rejected.

The dictionaries are a fitted model of bounded size: SAMPLE_TEXTS distinct texts a language, chosen by
hash, and DICTIONARY_BYTES in all, shared evenly over these texts (so 426 bytes of each of 150 long texts). Of a text up
to EXCERPT_CHARS are read, at a place chosen by hash in each of PIECES equal stretches of it. Every language is learned. Dictionaries are made in
tasks and broadcast in blocks of about BLOCK_LANGUAGES; a task holds the compressors of one block at a time and
keeps the two smallest sizes of each text across the blocks. Prediction covers every row and whole texts, row
by row, without a shuffle.

Defined cases: a text that is null or has no letter is ``und`` with score 0 and rejected; without any
training row every text is; with one language the score is 1; ties go to the language with more
training rows, then the smaller name; copies train once; repeated rows are predicted one by one.
"""

from __future__ import annotations

import heapq
import re
import zlib
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import pyarrow as pa
import zstandard
from pyspark import Broadcast
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tableloom.llm.common import written

SAMPLE_TEXTS = 150
#: Texts of a language to expect below its threshold.
CANDIDATES = 8 * SAMPLE_TEXTS
EXCERPT_CHARS = 3_000
PIECES = 4
DICTIONARY_BYTES = 64_000
#: Languages whose compressors a task holds at once (measured: 0.8 MB each).
BLOCK_LANGUAGES = 100
LEVEL = 6
BLOCK_BYTES = 8_192
MIN_MARGIN = 0.01
UNKNOWN = "und"
BUCKETS = 1 << 30

LETTERS = re.compile(r"[^\W\d_]+")
#: Characters normalised at once, which bounds the memory for very long texts.
TEXT_STEP = 1 << 20


@dataclass(frozen=True)
class Profiles:
    """Blocks of (language, training rows, dictionary)."""

    blocks: tuple[Broadcast, ...]


def normal_blocks(text: str) -> Iterator[bytes]:
    """The lower-cased letter runs of a text, spaced, in blocks for the compressor."""
    for at in range(0, len(text), TEXT_STEP):
        data = f" {' '.join(LETTERS.findall(text[at:at + TEXT_STEP].lower()))} ".encode()
        for start in range(0, len(data), BLOCK_BYTES):
            yield data[start:start + BLOCK_BYTES]


def fit(docs: DataFrame, lang: str = "lang", text: str = "text", where: Column | None = None) -> Profiles:
    """Learn from the rows with language and text (and ``where``).

    Texts are chosen by the hash of the text, so copies count once. A first threshold on the hash, from the
    number of distinct texts, leaves a bounded number of candidates a language before they are ranked.
    """
    rows = docs.where(F.lit(True) if where is None else where).select(F.col(lang).alias("lang"), F.col(text).alias("text"))
    hashed = rows.where(F.col("lang").isNotNull() & F.col("text").isNotNull()).select("lang", F.xxhash64("text").alias("h"), "text")
    spark, distinct = docs.sparkSession, F.greatest(F.approx_count_distinct("h"), F.lit(1))
    limit = F.least(F.lit(BUCKETS), F.floor(F.lit(BUCKETS * CANDIDATES) / distinct) + 1)
    counted = written(hashed.groupBy("lang").agg(F.count(F.lit(1)).alias("n"), limit.alias("limit")), "languages")
    n_blocks = -(-counted.count() // BLOCK_LANGUAGES)
    if not n_blocks:
        return Profiles(())
    # Lists of one block of languages are small; the sizes of larger ones decide how they are joined.
    listed = F.broadcast if n_blocks == 1 else lambda table: table
    chosen = choose(hashed, counted.select("lang", "limit"), listed)
    excerpts = (
        hashed.select("lang", "h", pieces(F.col("text"), F.col("h")).alias("excerpt"))
        .join(listed(chosen), ["lang", "h"]).groupBy("lang", "_rank").agg(F.min("excerpt").alias("excerpt"))
    )
    gathered = excerpts.groupBy("lang").agg(F.sort_array(F.collect_list(F.struct("_rank", "excerpt")))["excerpt"].alias("excerpts"))
    made = gathered.join(counted, "lang").select("lang", "n", "excerpts").mapInArrow(train, "lang string, n bigint, data binary")
    dictionaries = written(made.withColumn("block", F.pmod(F.xxhash64("lang"), F.lit(n_blocks))), "dictionaries")
    blocks = []
    for block in range(n_blocks):
        rows = dictionaries.where(F.col("block") == block).collect()
        blocks.append(spark.sparkContext.broadcast([(r["lang"], r["n"], bytes(r["data"])) for r in rows]))
    return Profiles(tuple(blocks))


def choose(hashed: DataFrame, limits: DataFrame, listed: Callable[[DataFrame], DataFrame]) -> DataFrame:
    """The SAMPLE_TEXTS smallest distinct hashes of each language with their rank, or all where it has fewer.

    A language that has fewer below its limit (the distinct count is an estimate) is read again with a higher one.
    """
    chosen = None
    while True:
        few = hashed.drop("text").join(listed(limits), "lang").where(F.pmod("h", F.lit(BUCKETS)) < F.col("limit"))
        rank = F.row_number().over(Window.partitionBy("lang").orderBy(F.pmod("h", F.lit(BUCKETS)), "h"))
        ranked = few.select("lang", "h").distinct().withColumn("_rank", rank)
        found = written(ranked.where(F.col("_rank") <= SAMPLE_TEXTS), "training-texts")
        numbers = found.groupBy("lang").agg(F.count(F.lit(1)).alias("found"))
        short = (F.coalesce("found", F.lit(0)) < SAMPLE_TEXTS) & (F.col("limit") < BUCKETS)
        raised = F.least(F.lit(BUCKETS), F.col("limit") * 8).alias("limit")
        again = written(limits.join(listed(numbers), "lang", "left").where(short).select("lang", raised), "languages-again")
        whole = found.join(listed(again), "lang", "left_anti")
        chosen = whole if chosen is None else chosen.unionByName(whole)
        if again.isEmpty():
            return chosen
        limits = again


def pieces(text: Column, h: Column) -> Column:
    """A piece of each of PIECES equal stretches of a text, at a place chosen by hash."""
    chars, found = F.length(text).cast("bigint"), []
    for k in range(PIECES):
        start, end = F.floor(chars * k / PIECES), F.floor(chars * (k + 1) / PIECES)
        width = F.least(end - start, F.lit(EXCERPT_CHARS // PIECES))
        at = start + F.pmod(F.xxhash64(h, F.lit(k)), end - start - width + 1)
        found.append(F.substring(text, (at + 1).cast("int"), width.cast("int")))
    return F.array(*found)


def shares(sizes: list[int], total: int) -> list[int]:
    """Parts of a total: even ones, and what a small size leaves goes to the others."""
    given = [0] * len(sizes)
    for done, i in enumerate(sorted(range(len(sizes)), key=sizes.__getitem__)):
        given[i] = min(sizes[i], total // (len(sizes) - done))
        total -= given[i]
    return given


def dictionary(texts: list[list[str]]) -> bytes:
    """Even parts of the texts, of each even parts of its pieces, cut from places chosen by hash."""
    data = [[b"".join(normal_blocks(piece)) for piece in text] for text in texts]
    made = []
    for text, size in zip(data, shares([sum(map(len, text)) for text in data], DICTIONARY_BYTES)):
        for piece, part in zip(text, shares([len(piece) for piece in text], size)):
            start = zlib.crc32(piece) % (len(piece) - part + 1)
            made.append(piece[start:start + part])
    return b"".join(made)


def train(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Dictionaries from the ranked excerpts of languages."""
    for batch in batches:
        data = [dictionary(excerpts.as_py()) for excerpts in batch.column(2)]
        yield pa.RecordBatch.from_arrays([*batch.columns[:2], pa.array(data, pa.binary())], ["lang", "n", "data"])


#: The compressors of the block in use.
_loaded: dict[Broadcast, list[tuple[tuple[int, bytes, str], zstandard.ZstdCompressor]]] = {}


def compressors(block: Broadcast) -> list[tuple[tuple[int, bytes, str], zstandard.ZstdCompressor]]:
    """Order among ties, and compressor, of each language of a block. One block is held at a time."""
    if block not in _loaded:
        _loaded.clear()
        made = []
        for name, n, data in block.value:
            plain = {"level": LEVEL, "write_content_size": False, "write_checksum": False, "write_dict_id": False}
            if len(data) >= 8:
                plain["dict_data"] = zstandard.ZstdCompressionDict(data, dict_type=zstandard.DICT_TYPE_RAWCONTENT)
                plain["dict_data"].precompute_compress(level=LEVEL)
            made.append(((-n, name.encode(), name), zstandard.ZstdCompressor(**plain)))
        if hasattr(block, "_path"):
            vars(block).pop("_value", None)  # it is read again from the file when needed
        _loaded[block] = made
    return _loaded[block]


def classify(texts: pa.Array, profiles: Profiles) -> list[tuple[str, float]]:
    """Of each text the language whose dictionary leaves the fewest bytes, and the margin to the second."""
    least: list[list] = [[] for _ in texts]
    for block in profiles.blocks:
        made = compressors(block)
        for i, text in enumerate(texts):
            if not text.is_valid:
                continue
            sizes = [0] * len(made)
            for data in normal_blocks(text.as_py()):
                for k, (_, compressor) in enumerate(made):
                    sizes[k] += len(compressor.compress(data))
            least[i] = heapq.nsmallest(2, [*least[i], *((size, order) for size, (order, _) in zip(sizes, made))])
    return [
        (found[0][1][2], 1 - found[0][0] / found[1][0] if len(found) > 1 else 1.0) if found else (UNKNOWN, 0.0) for found in least
    ]


def predict(docs: DataFrame, profiles: Profiles, key: str = "doc_id", text: str = "text",
            min_margin: float = MIN_MARGIN) -> DataFrame:
    """Per row: key, ``lang_pred``, ``score`` and ``rejected``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = classify(batch.column(1), profiles)
            yield pa.RecordBatch.from_arrays([
                batch.column(0), pa.array([f[0] for f in found], pa.string()), pa.array([f[1] for f in found], pa.float64()),
            ], ["key", "lang_pred", "score"])

    lettered = F.when(F.col(text).rlike(r"\p{L}"), F.col(text))
    narrow = docs.select(F.col(key).alias("key"), lettered.alias("text"))
    found = narrow.mapInArrow(run, f"key {dict(narrow.dtypes)['key']}, lang_pred string, score double")
    rejected = (F.col("lang_pred") == UNKNOWN) | (F.col("score") < min_margin)
    return found.select(F.col("key").alias(key), "lang_pred", "score", rejected.alias("rejected"))


def keep_identified(docs: DataFrame, profiles: Profiles, text: str = "text", min_margin: float = MIN_MARGIN) -> DataFrame:
    """The documents that are not rejected, with all their columns."""
    names = docs.columns
    flat = docs.toDF(*[f"c{i}" for i in range(len(names))])
    body = f"c{names.index(text)}"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = classify(batch.column(body), profiles)
            yield batch.filter(pa.array([name != UNKNOWN and score >= min_margin for name, score in found], pa.bool_()))

    lettered = flat.where(F.col(body).rlike(r"\p{L}"))
    return lettered.mapInArrow(run, lettered.schema).toDF(*names)
