"""Byte-level BPE by monoid tree reduction.

Every text is halved until its parts are a few words, the parts are encoded, and neighbours are joined up the
tree. A join re-encodes only a window around the seam. The window grows on either side to the next
place where a character that is no white space is followed by an ASCII space, tab or line break: no
alternative of the splitting pattern matches across such a place and none looks back, so it is a
match boundary in every context, merges do not cross it, and the tokens outside the window stay. This is proven
for the one pattern in use, and any other is refused. A text without such a place has nothing to gain from halves and is one window.
Decoding joins the bytes of halves up the same kind of tree.

Inside a window each match of the pattern is merged by itself: its bytes, pair by pair, the pair of the lowest rank first and
of equal ones the first. Words are merged by the library and remembered; a long match is merged from a heap, in time proportional
to its length times its logarithm.

Every row is encoded where it lies: no shuffle, and memory bounded by one text. Token ids are kept
as little-endian unsigned 32-bit integers in a binary column.

Defined cases: a null or empty text has no tokens; a text without any such place (one endless word
or run of spaces) is one window; texts of special tokens are ordinary text; repeated rows are encoded
one by one; an empty table gives an empty table.
"""

from __future__ import annotations

import base64
import functools
import heapq
import re
from collections.abc import Iterable, Iterator, Sequence

import numpy as np
import pyarrow as pa
import regex
import tiktoken
from public_tokenizers import PATTERN
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

LEAF_CHARS = 512
LEAF_TOKENS = 512
#: Matches of at most that many characters are remembered, so many of them.
SHORT_MATCH, REMEMBERED = 32, 1 << 16
#: Bytes of a match up to which the library merges it.
FEW_BYTES = 64
FIRST_LOOK = 64
ROWS_AT_ONCE = 256

SEAM = re.compile(r"\S(?=[ \t\n\r])")
LAST_SEAM = re.compile(r"(?s:.*)\S(?=[ \t\n\r])")


class ByteBpe:
    """Encoder and decoder of one rank file."""

    def __init__(self, path: str, pattern: str):
        if pattern != PATTERN:
            raise ValueError("the seams between parts are proven for public_tokenizers.PATTERN only")
        with open(path, "rb") as lines:
            self.ranks = {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, lines)}
        self.merger = tiktoken.Encoding("ranks", pat_str=pattern, mergeable_ranks=self.ranks, special_tokens={})
        self.matches = regex.compile(pattern).findall
        self.bytes_of = [b""] * (max(self.ranks.values()) + 1)
        for token, rank in self.ranks.items():
            self.bytes_of[rank] = token
        self.sizes = list(map(len, self.bytes_of))
        self.known = functools.lru_cache(maxsize=REMEMBERED)(self.merge)

    def merge(self, match: str) -> list[int]:
        """The tokens of one match of the pattern."""
        data = match.encode()
        whole = self.ranks.get(data)
        if whole is not None:
            return [whole]
        # A match of this pattern is one match by itself too.
        return self.merger.encode_ordinary(match) if len(data) <= FEW_BYTES else self._merge_many(data)

    def _merge_many(self, data: bytes) -> list[int]:
        """The merges of a long match, from a heap of pairs by rank and place."""
        ranks, n = self.ranks, len(data)
        after, before = list(range(1, n + 1)), list(range(-1, n - 1))
        heap = [(rank, i, i + 2) for i in range(n - 1) if (rank := ranks.get(data[i:i + 2])) is not None]
        heapq.heapify(heap)
        while heap:
            _, start, end = heapq.heappop(heap)
            middle = after[start]
            if middle >= end or after[middle] != end:
                continue  # one of the two has been merged with another since
            after[start], after[middle] = end, n + 1
            if end < n:
                before[end] = start
                if (rank := ranks.get(data[start:after[end]])) is not None:
                    heapq.heappush(heap, (rank, start, after[end]))
            first = before[start]
            if first >= 0 and (rank := ranks.get(data[first:end])) is not None:
                heapq.heappush(heap, (rank, first, end))
        ids, at = [], 0
        while at < n:
            ids.append(ranks[data[at:after[at]]])
            at = after[at]
        return ids

    def window(self, text: str) -> list[int]:
        """The tokens of a text seen at once."""
        ids: list[int] = []
        for match in self.matches(text):
            ids += self.known(match) if len(match) <= SHORT_MATCH else self.merge(match)
        return ids

    def encode(self, text: str, leaf: int = LEAF_CHARS) -> np.ndarray:
        return np.array(self.tokens(text, leaf), np.uint32)

    def tokens(self, text: str, leaf: int) -> list[int]:
        if len(text) <= leaf or not SEAM.search(text):
            return self.window(text)
        middle = len(text) // 2
        left, right = text[:middle], text[middle:]
        return self.join(left, self.tokens(left, leaf), right, self.tokens(right, leaf))

    def join(self, left: str, left_ids: list[int], right: str, right_ids: list[int]) -> list[int]:
        """The tokens of ``left + right`` from the tokens of both."""
        start, end = last_seam(left), first_seam(right)
        before = self.count_within(reversed(left_ids), len(left[start:].encode()))
        after = self.count_within(right_ids, len(right[:end].encode()))
        return left_ids[:len(left_ids) - before] + self.window(left[start:] + right[:end]) + right_ids[after:]

    def count_within(self, ids: Iterable[int], size: int) -> int:
        """How many of the first tokens make up that many bytes."""
        count = 0
        for token in ids if size else ():
            count += 1
            size -= self.sizes[token]
            if size <= 0:
                break
        if size:
            raise ValueError("a seam is not a token boundary")
        return count

    def decode(self, ids: Sequence[int], leaf: int = LEAF_TOKENS) -> bytes:
        if len(ids) <= leaf:
            return b"".join(map(self.bytes_of.__getitem__, ids))
        middle = len(ids) // 2
        return self.decode(ids[:middle], leaf) + self.decode(ids[middle:], leaf)


def last_seam(text: str) -> int:
    """The last place of the text that is a match boundary in every context, or its start."""
    look = FIRST_LOOK
    while True:
        at = max(0, len(text) - look)
        found = LAST_SEAM.match(text, at)
        if found or at == 0:
            return found.end() if found else 0
        look *= 4


def first_seam(text: str) -> int:
    """The first such place, or its end."""
    found = SEAM.search(text)
    return found.end() if found else len(text)


@functools.lru_cache(maxsize=2)
def coder(path: str, pattern: str) -> ByteBpe:
    return ByteBpe(path, pattern)


def _slices(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for at in range(0, batch.num_rows, ROWS_AT_ONCE):
            yield batch.slice(at, ROWS_AT_ONCE)


def encode(docs: DataFrame, path: str, pattern: str, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Per row: key, ``n_tokens`` and ``ids`` (little-endian unsigned 32-bit integers)."""
    def run(batches):
        bpe = coder(path, pattern)
        for batch in _slices(batches):
            found = [bpe.encode(t.as_py() or "").astype("<u4") for t in batch.column(1)]
            yield pa.RecordBatch.from_arrays([
                batch.column(0), pa.array([len(f) for f in found], pa.int64()),
                pa.array([f.tobytes() for f in found], pa.binary()),
            ], ["key", "n_tokens", "ids"])

    narrow = docs.select(F.col(key).alias("key"), F.col(text).alias("text"))
    return narrow.mapInArrow(run, f"key {dict(narrow.dtypes)['key']}, n_tokens bigint, ids binary").withColumnRenamed("key", key)


def decode(tokens: DataFrame, path: str, pattern: str, key: str = "doc_id") -> DataFrame:
    """The rows of ``encode`` with ``decoded``, the bytes their ids stand for."""
    def run(batches):
        bpe = coder(path, pattern)
        for batch in _slices(batches):
            decoded = [bpe.decode(np.frombuffer(ids.as_py() or b"", "<u4").tolist()) for ids in batch.column(2)]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(decoded, pa.binary())], [*batch.schema.names, "decoded"])

    narrow = tokens.select(F.col(key).alias("key"), "n_tokens", "ids")
    kind = dict(narrow.dtypes)["key"]
    return narrow.mapInArrow(run, f"key {kind}, n_tokens bigint, ids binary, decoded binary").withColumnRenamed("key", key)


def round_trip(docs: DataFrame, path: str, pattern: str, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``encode`` and ``decode`` in one task: key, ``n_tokens``, ``ids`` and the bytes they stand for."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = coder(path, pattern)
        for batch in _slices(batches):
            found = [bpe.encode(t.as_py() or "").astype("<u4") for t in batch.column(1)]
            yield pa.RecordBatch.from_arrays([
                batch.column(0), pa.array([len(f) for f in found], pa.int64()),
                pa.array([f.tobytes() for f in found], pa.binary()),
                pa.array([bpe.decode(f.tolist()) for f in found], pa.binary()),
            ], ["key", "n_tokens", "ids", "decoded"])

    narrow = docs.select(F.col(key).alias("key"), F.col(text).alias("text"))
    kind = dict(narrow.dtypes)["key"]
    return narrow.mapInArrow(run, f"key {kind}, n_tokens bigint, ids binary, decoded binary").withColumnRenamed("key", key)
