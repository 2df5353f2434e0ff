"""Benchmark decontamination with a generalised suffix automaton of the test items.

The automaton holds every run of words of every item. A document's words are streamed through it,
which keeps the length of the longest run that ends at each word and occurs in some item. A run of
at least a window's length marks its last window, and the window's state knows the items it comes
from. Spans of marked words that reach the length limit are cut; a document whose marked share reaches
the coverage limit is contaminated.

Documents are scanned where they lie, without a shuffle. An automaton is built from items of a checked
size; a larger benchmark is cut into blocks that scan one after another, adding to the rows' hits.

Defined cases: a null or empty text has no words and no hits; null or wordless items are no windows;
a null item id is the empty string; rows of one item id are one item; repeated documents are scanned one
by one; empty tables on either side give no hits; other columns, whatever their names, pass unread.
"""

from __future__ import annotations

import math
import re
from collections.abc import Callable, Iterator
from dataclasses import dataclass, field
from itertools import repeat

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tableloom.llm.common import word_blocks, written

WINDOW = 13
#: A document is contaminated when this many times its hit words reach all its words.
COVERAGE = 20
#: Spans of this many hit words are cut.
SPAN_WORDS = 13
#: Item text of one automaton, which bounds what is collected and broadcast (about 200 MB as objects).
BLOCK_BYTES = 2_000_000
ROWS_AT_ONCE = 512

WORD = re.compile(rb"[0-9a-z\x80-\xff]+")
#: A-Z to lower case, every other ASCII character that is no letter or digit to a space.
NORMAL = bytes(
    b + 32 if 65 <= b <= 90 else b if b >= 128 or 48 <= b <= 57 or 97 <= b <= 122 else 32 for b in range(256)
)


def words_of(data: bytes) -> Iterator[list[bytes]]:
    return word_blocks(data.translate(NORMAL))


@dataclass
class Automaton:
    """States of a generalised suffix automaton over word numbers."""

    window: int = WINDOW
    step: list[dict] = field(default_factory=lambda: [{}])
    link: list[int] = field(default_factory=lambda: [-1])
    size: list[int] = field(default_factory=lambda: [0])
    words: dict[bytes, int] = field(default_factory=dict)

    def _new(self, size: int, step: dict, link: int) -> int:
        self.step.append(step)
        self.link.append(link)
        self.size.append(size)
        return len(self.size) - 1

    def _split(self, state: int, word: int, target: int) -> int:
        """Part the runs of ``target`` that end a run of ``state`` by ``word`` from the longer ones."""
        copy = self._new(self.size[state] + 1, dict(self.step[target]), self.link[target])
        self.link[target] = copy
        while state >= 0 and self.step[state].get(word) == target:
            self.step[state][word] = copy
            state = self.link[state]
        return copy

    def _extend(self, last: int, word: int) -> int:
        target = self.step[last].get(word)
        if target is not None:
            return target if self.size[target] == self.size[last] + 1 else self._split(last, word, target)
        new, state = self._new(self.size[last] + 1, {}, 0), last
        while state >= 0 and word not in self.step[state]:
            self.step[state][word] = new
            state = self.link[state]
        if state >= 0:
            target = self.step[state][word]
            self.link[new] = target if self.size[target] == self.size[state] + 1 else self._split(state, word, target)
        return new

    @classmethod
    def of(cls, items: list[tuple[str, bytes]], window: int = WINDOW) -> Automaton:
        self = cls(window)
        texts = []
        for name, data in items:
            numbers = [self.words.setdefault(w, len(self.words)) for block in words_of(data) for w in block]
            if numbers:
                texts.append((name, numbers))
        for _, numbers in texts:
            last = 0
            for word in numbers:
                last = self._extend(last, word)
        order = sorted(range(len(self.size)), key=self.size.__getitem__)
        # The state of each run's last `window` words, and the nearest shorter or equal run that is a whole item.
        self.window_state = list(range(len(self.size)))
        for state in order[1:]:
            if self.size[self.link[state]] >= window:
                self.window_state[state] = self.window_state[self.link[state]]
        self.items_at: dict[int, set[str]] = {}
        self.short_at: dict[int, list[tuple[int, str]]] = {}
        for name, numbers in texts:
            state = 0
            for n, word in enumerate(numbers, 1):
                state = self.step[state][word]
                if n >= window:
                    self.items_at.setdefault(self.window_state[state], set()).add(name)
            if len(numbers) < window:
                self.short_at.setdefault(state, []).append((len(numbers), name))
        self.short_state = [-1] * len(self.size)
        for state in order:
            above = self.link[state]
            self.short_state[state] = state if state in self.short_at else self.short_state[above] if above >= 0 else -1
        self.shortest = min([window, *(n for marks in self.short_at.values() for n, _ in marks)])
        pairs = {a * len(self.words) + b for _, numbers in texts for a, b in zip(numbers, numbers[1:])}
        self.pairs = np.array(sorted(pairs), np.int64)
        return self

    def numbers(self, data: bytes) -> np.ndarray:
        blocks = [np.fromiter(map(self.words.get, block, repeat(-1)), np.int64, len(block)) for block in words_of(data)]
        return np.concatenate(blocks) if blocks else np.zeros(0, np.int64)

    def scan(self, numbers: np.ndarray) -> tuple[list[tuple[int, int]], set[str]]:
        """Hit spans (first word, after the last word) in order, not merged, and the items hit."""
        spans: list[tuple[int, int]] = []
        found: set[str] = set()
        for start, end in self._candidates(numbers):
            self._stream(numbers[start:end].tolist(), start, spans, found)
        return spans, found

    def _candidates(self, numbers: np.ndarray) -> Iterator[tuple[int, int]]:
        """Runs of words whose neighbours all stand together in some item; matches cannot leave them."""
        for start, end in runs(numbers >= 0, self.shortest):
            part = numbers[start:end]
            codes = part[:-1] * len(self.words) + part[1:]
            known = np.zeros(len(codes), bool)
            if len(self.pairs):
                at = np.minimum(np.searchsorted(self.pairs, codes), len(self.pairs) - 1)
                known = self.pairs[at] == codes
            if self.shortest < 2:
                yield start, end
            else:
                for a, b in runs(known, self.shortest - 1):
                    yield start + a, start + b + 1

    def _stream(self, words: list[int], offset: int, spans: list, found: set) -> None:
        step, link, size, window = self.step, self.link, self.size, self.window
        state = length = 0
        for at, word in enumerate(words, offset + 1):
            while state and word not in step[state]:
                state = link[state]
                length = size[state]
            if word in step[state]:
                state, length = step[state][word], length + 1
            if length >= window:
                spans.append((at - window, at))
                found |= self.items_at[self.window_state[state]]
            mark = self.short_state[state]
            while mark >= 0:
                for n, name in self.short_at[mark]:
                    if n <= length:
                        spans.append((at - n, at))
                        found.add(name)
                mark = self.short_state[link[mark]] if link[mark] >= 0 else -1


def runs(flags: np.ndarray, least: int) -> Iterator[tuple[int, int]]:
    """Start and end of the runs of at least that many true flags."""
    if not len(flags):
        return
    edges = np.flatnonzero(np.diff(np.concatenate(([False], flags, [False])).astype(np.int8)))
    starts, ends = edges[::2], edges[1::2]
    long = ends - starts >= least
    yield from zip(starts[long].tolist(), ends[long].tolist())


def merged(spans: list) -> list[tuple[int, int]]:
    """Overlapping or touching spans as one."""
    out: list[list[int]] = []
    for start, end in sorted(map(tuple, spans)):
        if out and start <= out[-1][1]:
            out[-1][1] = max(out[-1][1], end)
        else:
            out.append([start, end])
    return [tuple(s) for s in out]


def cut_spans(data: bytes, spans: list[tuple[int, int]], least: int) -> bytes:
    """The text without the words of the spans that have at least that many words."""
    long = [s for s in spans if s[1] - s[0] >= least]
    if not long:
        return data
    wanted = {i for start, end in long for i in (start, end - 1)}
    at = {i: m.span() for i, m in enumerate(WORD.finditer(data.translate(NORMAL))) if i in wanted}
    kept, last = [], 0
    for start, end in long:
        kept.append(data[last:at[start][0]])
        last = at[end - 1][1]
    return b"".join([*kept, data[last:]])


def _scanner(automaton, first: bool):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found = automaton.value
        for whole in batches:
            for at in range(0, whole.num_rows, ROWS_AT_ONCE):
                batch = whole.slice(at, ROWS_AT_ONCE)
                width = batch.num_columns if first else batch.num_columns - 3
                sizes, spans, items = [], [], []
                for row, text in enumerate(batch.column(0).cast(pa.binary())):
                    numbers = found.numbers(text.as_py() or b"")
                    new, names = found.scan(numbers)
                    if not first:
                        new += [(s["start"], s["end"]) for s in batch.column(width + 1)[row].as_py()]
                        names |= set(batch.column(width + 2)[row].as_py())
                    sizes.append(len(numbers))
                    spans.append([{"start": a, "end": b} for a, b in merged(new)])
                    items.append(sorted(names))
                yield pa.RecordBatch.from_arrays([
                    *batch.columns[:width], pa.array(sizes, pa.int64()),
                    pa.array(spans, pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))),
                    pa.array(items, pa.list_(pa.string())),
                ], [*batch.schema.names[:width], "words", "spans", "items"])

    return run


HITS = "words bigint, spans array<struct<start:bigint,end:bigint>>, items array<string>"


def _with_hits(
    rows: DataFrame, benchmark: DataFrame, item: str, item_text: str, window: int, block_bytes: int,
    finish: Callable[[pa.RecordBatch], pa.RecordBatch], schema: str,
) -> DataFrame:
    """Scan rows whose first column is the text; ``finish`` gets them with HITS added, in the same task."""
    spark = rows.sparkSession
    items = benchmark.select(
        F.coalesce(F.col(item).cast("string"), F.lit("")).alias("name"), F.col(item_text).alias("text")
    ).where(F.col("text").isNotNull())
    total = items.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    blocks = max(1, math.ceil(total / block_bytes))
    part = F.pmod(F.xxhash64("name", "text"), F.lit(blocks))
    plain = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in rows.schema.fields)
    for block in range(blocks):
        texts = [(r["name"], r["text"].encode()) for r in items.where(part == block).collect()]
        run = _scanner(spark.sparkContext.broadcast(Automaton.of(texts, window)), block == 0)
        if block < blocks - 1:
            rows = written(rows.mapInArrow(run, f"{plain}, {HITS}"), f"hits-{block}")
    return rows.mapInArrow(lambda batches: map(finish, run(batches)), schema)


def is_contaminated(n_hit: int, n_words: int, coverage: int) -> bool:
    return n_hit > 0 and coverage * n_hit >= n_words


def scan(docs: DataFrame, benchmark: DataFrame, key: str = "doc_id", text: str = "text",
         item: str = "item_id", item_text: str = "text", window: int = WINDOW, coverage: int = COVERAGE,
         block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """Per row: key, ``n_words``, ``n_hit``, ``items`` (sorted as strings), ``spans`` and ``contaminated``."""
    rows = docs.select(F.col(text).alias("body"), F.col(key).alias("key"))

    def finish(batch: pa.RecordBatch) -> pa.RecordBatch:
        hits = [sum(x["end"] - x["start"] for x in s) for s in batch.column(3).to_pylist()]
        contaminated = [is_contaminated(h, n, coverage) for h, n in zip(hits, batch.column(2).to_pylist())]
        return pa.RecordBatch.from_arrays([
            batch.column(1), batch.column(2), pa.array(hits, pa.int64()), batch.column(4), batch.column(3), pa.array(contaminated, pa.bool_()),
        ], ["key", "n_words", "n_hit", "items", "spans", "contaminated"])

    schema = (
        f"key {dict(rows.dtypes)['key']}, n_words bigint, n_hit bigint, items array<string>, "
        "spans array<struct<start:bigint,end:bigint>>, contaminated boolean"
    )
    return _with_hits(rows, benchmark, item, item_text, window, block_bytes, finish, schema).withColumnRenamed("key", key)


def clean(docs: DataFrame, benchmark: DataFrame, text: str = "text", length: str | None = "n_chars",
          item: str = "item_id", item_text: str = "text", window: int = WINDOW, coverage: int = COVERAGE,
          span_words: int = SPAN_WORDS, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """The documents without contaminated ones, and with long hit spans cut from the others.

    Columns, names and order stay; ``length`` (if there) is counted anew where a text was cut.
    """
    names = docs.columns
    places = {n: f"c{i}" for i, n in enumerate(names)}
    body = places[text]
    flat = docs.toDF(*places.values())
    rows = flat.select(body, *[c for c in flat.columns if c != body])
    sizes = rows.columns.index(places[length]) if length in places else None

    def finish(batch: pa.RecordBatch) -> pa.RecordBatch:
        width = batch.num_columns - 3
        spans = [[(x["start"], x["end"]) for x in s] for s in batch.column(width + 1).to_pylist()]
        clean_rows = [
            not is_contaminated(sum(b - a for a, b in s), n, coverage) for s, n in zip(spans, batch.column(width).to_pylist())
        ]
        columns = list(batch.columns[:width])
        cut = [i for i, s in enumerate(spans) if clean_rows[i] and any(b - a >= span_words for a, b in s)]
        if cut:
            texts = columns[0].to_pylist()
            for i in cut:
                texts[i] = cut_spans(texts[i].encode(), spans[i], span_words).decode()
            columns[0] = pa.array(texts, pa.string())
            if sizes is not None:
                kind, known = columns[sizes].type, columns[sizes].to_pylist()
                for i in cut:
                    known[i] = len(texts[i])
                columns[sizes] = pa.array(known, kind)
        return pa.RecordBatch.from_arrays(columns, batch.schema.names[:width]).filter(pa.array(clean_rows, pa.bool_()))

    done = _with_hits(rows, benchmark, item, item_text, window, block_bytes, finish, rows.schema)
    return done.select(*[F.col(p).alias(n) for n, p in places.items()])
