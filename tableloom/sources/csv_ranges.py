"""Delimited files whose quoted texts hold line breaks, read by many tasks.

Spark's text reader cuts a file into byte ranges and gives each range its chunks, the text between separators, in order. Whether a chunk
begins inside quotes depends on all that comes before it, but a range only maps one of two states (outside, inside) to one of two: a
first pass finds that map for every range, and composing the maps along a file gives the state each range starts in. With it a
range cuts its text into records. Only a record that goes over the end of a range, at most one a range, is put
together from pieces elsewhere.

A quote opens a text only where a field begins; elsewhere in a bare field it is a character like others, and a
doubled one inside quotes stands for itself.

Scale: rows are what costs, and a text may break after every word. Fields begin after a comma as after a line break, so either can separate the
chunks; commas do where they are the rarer ones and no range is without one. The records do not depend on that. Python sees the bytes of an Arrow batch at once;
the first pass hands it only chunks with quotes, as the others change no state.
"""

from __future__ import annotations

from bisect import bisect_left
from collections.abc import Callable, Iterator
from itertools import pairwise

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tableloom.session import materialize

OPTIONS = {
    "quote": '"', "escape": '"', "multiLine": "true", "ignoreLeadingWhiteSpace": "false", "ignoreTrailingWhiteSpace": "false",
}
#: Where a piece of text stands: a record by itself, or its end, middle or start with the rest in other ranges.
WHOLE, END, MIDDLE, START = range(4)
#: Commas separate the chunks from so many line breaks a comma on, as seen in the first lines.
BREAKS_A_COMMA, HEAD_LINES = 4, 10_000


def ends_inside(line: str, inside: bool) -> bool:
    """Is the reader inside quotes after the line?"""
    at = 0
    while True:
        if inside:
            at = line.find('"', at)
            if at < 0:
                return True
            if line.startswith('"', at + 1):
                at += 2
                continue
            inside = False
        elif line.startswith('"', at):
            inside, at = True, at + 1
            continue
        at = line.find(",", at) + 1
        if not at:
            return False


def file_lines(spark: SparkSession, path: str, separator: str = "\n") -> DataFrame:
    """The lines of the files, or chunks between other separators, in order within each range, with the range's file (a hash of its path) and start."""
    return spark.read.option("lineSep", separator).text(path).select(
        "value", F.xxhash64("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("range"))


def best_separator(lines: DataFrame, columns: int) -> str:
    """Commas, where they make fewer chunks than line breaks. A range without one would be a part of a very long chunk."""
    commas = F.length("value") - F.length(F.replace("value", F.lit(","), F.lit("")))
    head = lines.limit(HEAD_LINES).agg(F.count(F.lit(1)).alias("lines"), F.sum(commas).alias("commas")).first()
    if columns < 2 or not head["commas"] or head["lines"] < BREAKS_A_COMMA * head["commas"]:
        return "\n"
    without = lines.groupBy("file", "range").agg(F.bool_or(F.contains("value", F.lit(","))).alias("any")).where("NOT any")
    return "," if without.isEmpty() else "\n"


def _runs(batch: pa.RecordBatch) -> Iterator[tuple[int, int, pa.Array]]:
    """The chunks of a batch that lie in one range each."""
    files, ranges = batch.column("file").to_numpy(), batch.column("range").to_numpy()
    if len(files):
        cuts = np.flatnonzero((files[1:] != files[:-1]) | (ranges[1:] != ranges[:-1])) + 1
        for start, end in pairwise([0, *cuts.tolist(), len(files)]):
            yield int(files[start]), int(ranges[start]), batch.column("value").slice(start, end - start)


def _bytes(chunks: pa.Array) -> np.ndarray:
    """The text of chunks that end in their separator."""
    _, offsets, data = chunks.buffers()
    size = 8 if pa.types.is_large_string(chunks.type) else 4
    bounds = np.frombuffer(offsets, np.int64 if size == 8 else np.int32)[chunks.offset:chunks.offset + len(chunks) + 1]
    return np.frombuffer(data, np.uint8)[bounds[0]:bounds[-1]]


def _state_after_lines(text: bytes, inside: bool) -> list[bool]:
    """For every line of a text that begins like a field or inside quotes: is the reader inside quotes after it?"""
    after = []
    for line in text.decode("latin-1").split("\n"):  # one character a byte, which finds the same quotes and commas in any text
        if '"' in line:
            inside = ends_inside(line, inside)
        after.append(inside)
    return after


def _maps(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Per range with quotes: the state after it when it starts outside and when it starts inside."""
    held: dict[tuple[int, int], tuple[bool, bool]] = {}
    for batch in batches:
        for file, start, chunks in _runs(batch):
            outside, inside = held.get((file, start), (False, True))
            for chunk in chunks.cast(pa.binary()).to_pylist():
                same = outside == inside
                outside = _state_after_lines(chunk, outside)[-1]
                inside = outside if same else _state_after_lines(chunk, inside)[-1]
            held[file, start] = (outside, inside)
    if held:
        yield pa.RecordBatch.from_arrays([
            pa.array([f for f, _ in held], pa.int64()), pa.array([r for _, r in held], pa.int64()), *map(pa.array, zip(*held.values())),
        ], ["file", "range", "outside", "inside"])


def _turns(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The ranges that end in another state than they start in; the ranges of a file come in order."""
    current, state = None, False
    for batch in batches:
        found = []
        for file, start, outside, inside in zip(*(c.to_pylist() for c in batch.columns)):
            if file != current:
                current, state = file, False
            before, state = state, inside if state else outside
            if state != before:
                found.append((file, start))
        yield pa.RecordBatch.from_arrays([pa.array([f for f, _ in found], pa.int64()), pa.array([r for _, r in found], pa.int64())], ["file", "range"])


def turns(chunks: DataFrame) -> dict[int, list[int]]:
    """Per file the starts of the ranges that turn the state, in order; a range is as long as spark.sql.files.maxPartitionBytes."""
    maps = chunks.where(F.contains("value", F.lit('"'))).mapInArrow(_maps, "file bigint, range bigint, outside boolean, inside boolean")
    found: dict[int, list[int]] = {}
    for file, start in maps.repartition("file").sortWithinPartitions("file", "range").mapInArrow(_turns, "file bigint, range bigint").collect():
        found.setdefault(file, []).append(start)
    return {file: sorted(starts) for file, starts in found.items()}


def _record_ends(data: np.ndarray, inside: bool) -> tuple[np.ndarray, bool]:
    """The line breaks that end a record, and the state after the text, which begins like a field or inside quotes."""
    breaks, quotes = np.flatnonzero(data == ord("\n")), np.flatnonzero(data == ord('"'))
    opening = quotes[int(inside)::2]
    before = data[opening[opening > 0] - 1]
    if not ((before == ord(",")) | (before == ord("\n")) | (before == ord('"'))).all():  # a quote in a bare field
        after = _state_after_lines(data.tobytes(), inside)
        return breaks[~np.array(after[:-1], bool)], after[-1]
    return breaks[(np.searchsorted(quotes, breaks) + inside) % 2 == 0], bool((len(quotes) + inside) % 2)


def _cut(
    batches: Iterator[pa.RecordBatch], turned: dict[int, list[int]], separator: str
) -> Iterator[tuple[tuple[int, int], int, bool, np.ndarray, np.ndarray]]:
    """Texts and the bytes after their records, with the kind of the first record, all others being whole, and whether it begins a file."""
    current, held, begun, inside, first = None, [], False, False, False

    def left_over() -> Iterator:
        if held:
            data = np.concatenate(held)
            yield current, START if begun else MIDDLE, first and begun, data, np.array([len(data) - 1])

    for batch in batches:
        for file, start, chunks in _runs(batch):
            if (file, start) != current:
                yield from left_over()
                current, held, first = (file, start), [], start == 0
                inside = bisect_left(turned.get(file, []), start) % 2 == 1
                begun = first or separator == "\n" and not inside
            data = _bytes(chunks)
            ends, inside = _record_ends(data, inside)
            if not len(ends):
                held.append(data)
                continue
            rest = data[ends[-1] + 1:]
            if held:
                ends = ends + sum(map(len, held))
                data = np.concatenate([*held, data])
            yield current, WHOLE if begun else END, first and begun, data, ends
            held, begun, first = [rest] if len(rest) else [], True, False
    yield from left_over()


def _texts(data: np.ndarray, ends: np.ndarray) -> pa.Array:
    """The text up to each end as one value, without the byte there."""
    bounds = np.concatenate([[0], ends - np.arange(len(ends))]).astype(np.int32)
    return pa.StringArray.from_buffers(len(ends), pa.py_buffer(bounds), pa.py_buffer(np.delete(data[:ends[-1]], ends[:-1])))


def _whole(turned: dict[int, list[int]], separator: str) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """The records that lie in one range, without the one that begins a file."""

    def records(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for _, kind, first, data, ends in _cut(batches, turned, separator):
            if kind in (WHOLE, END):
                yield pa.RecordBatch.from_arrays([_texts(data, ends).slice(int(first or kind == END))], ["record"])

    return records


def _broken(turned: dict[int, list[int]], separator: str) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """The parts of records that go over the end of a range; ``first`` marks the start of one that begins a file."""

    def parts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for (file, start), kind, first, data, ends in _cut(batches, turned, separator):
            if kind != WHOLE:
                columns = [pa.array([file], pa.int64()), pa.array([start], pa.int64()), pa.array([kind], pa.int32()), pa.array([bool(first)])]
                yield pa.RecordBatch.from_arrays([*columns, _texts(data, ends[:1])], ["file", "range", "kind", "first", "record"])

    return parts


def records(spark: SparkSession, path: str, columns: int) -> DataFrame:
    """The records of the files as texts, without each file's first one, the header, and without empty ones."""
    separator = best_separator(file_lines(spark, path), columns)
    chunks = file_lines(spark, path, separator)
    turned = turns(chunks)
    ended = chunks.withColumn("value", F.concat("value", F.lit(separator)))
    broken = materialize(ended.mapInArrow(_broken(turned, separator), "file bigint, range bigint, kind int, first boolean, record string"))
    order = [F.col("range"), F.col("kind")]
    chain = F.sum((F.col("kind") == START).cast("int")).over(Window.partitionBy("file").orderBy(*order))
    # The end of a record begun before comes ahead of the start of the next one in the same range.
    mended = broken.withColumn("chain", chain).groupBy("file", "chain").agg(
        F.max("first").alias("first"), F.sort_array(F.collect_list(F.struct("range", "kind", "record"))).alias("parts"))
    joined = mended.where(~F.col("first")).select(F.array_join(F.col("parts.record"), separator).alias("record"))
    found = ended.mapInArrow(_whole(turned, separator), "record string").unionByName(joined)
    without_return = F.left("record", F.char_length("record") - 1)
    return found.select(F.when(F.endswith("record", F.lit("\r")), without_return).otherwise(F.col("record")).alias("record")).where("record <> ''")


def read_csv_ranges(spark: SparkSession, path: str) -> DataFrame:
    """All columns of delimited files with a header, as texts; a file is read by as many tasks as it has ranges."""
    named = spark.read.csv(path, header=True, **{k: v for k, v in OPTIONS.items()})
    if not named.columns:
        return named
    places = [f"c{i}" for i in range(len(named.columns))]
    fields = F.from_csv("record", ", ".join(f"{p} string" for p in places), OPTIONS)
    return records(spark, path, len(places)).select(fields.alias("fields")).select(*[F.col(f"fields.{p}").alias(n) for p, n in zip(places, named.columns)])
