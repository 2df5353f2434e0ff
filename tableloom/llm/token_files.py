"""Token ids in compressed binary files: a static range asymmetric numeral system.

Documents are dealt by ranges of their key and sorted, encoded, and packed into chunks of whole documents.
One count per token over the whole corpus becomes the shared frequency table. A chunk's ids are cut into
blocks that decode on their own: a block's ids go round robin to interleaved states (lanes), which emit
32-bit words into one stream. A block carries checkpoints (all states and the place in the
stream every CHECKPOINT_STEPS steps), from each of which decoding can start, and a checksum of its ids. The files' index
names each chunk's place and order, so chunks are read back in parallel.

Nothing whole passes the driver: it sees one count per token of the vocabulary and one sum per range. A
lost task writes its file anew under another name; the index names only the files of successful ones.

Defined cases: a null or empty text has only the end id; equal or null keys (sorted first) keep the order in
which they are read; a document longer than a block spans several; an empty table gives no rows.
"""

from __future__ import annotations

import functools
import io
import os
import re
import struct
import zlib
from collections.abc import Iterator
from uuid import uuid4

import numpy as np
import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from tokenizers import Tokenizer, pre_tokenizers

from tableloom.llm.common import text_blocks, written
from tableloom.llm.warc import dealt_by_bytes, opened
from tableloom.session import scratch_path

END_ID = 2
PRECISION = 20
LOW = 1 << 31
LANES = 512
BLOCK_IDS = 1 << 19
CHECKPOINT_STEPS = 256
CHUNK_IDS = 1 << 19
FILE_BYTES = 512 << 20
CACHED_WORDS = 800_000

#: Characters that lower-case and split alike here and in the tokenizer: ASCII, Latin-1 letters, line breaks, tabs.
PLAIN = re.compile("[ -~À-ÖØ-öø-ÿ\t-\r]*")
#: The tokenizer's split, on lower-cased text of such characters.
PIECES = re.compile("[a-zß-öø-ÿ]+|[0-9]|'(?:s|t|re|ve|m|ll|d)|[^a-z0-9ß-öø-ÿ \t-\r]+")

MAGIC = b"TLRA"
CHUNK = "<4sQII"
BLOCK = "<IIIII"


class WordEncoder:
    """Ids of whole texts as bytes.

    The tokenizer drops white space, and neither its normaliser nor its splits reach across it, so a
    text's ids are those of its pieces in turn. Text of ASCII and Latin letters is lower-cased and split
    here as the tokenizer would, and unseen pieces go through the library's merges; a word of other
    characters goes through the whole tokenizer. Pieces and words seen before come from bounded caches.
    """

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        self.tokenizer = Tokenizer.from_file(path)
        self.model = self.tokenizer.model
        self.kind, self.code = ("<u2", "H") if self.tokenizer.get_vocab_size() <= 1 << 16 else ("<u4", "I")
        self.known: dict[bytes, bytes] = {}
        self.pieces: dict[str, bytes] = {}
        to_bytes = pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=False)
        self.letters = {ord(c): to_bytes.pre_tokenize_str(c)[0][0] for c in map(chr, range(0xC0, 0x100))}

    def packed(self, ids: list[int]) -> bytes:
        return struct.pack(f"<{len(ids)}{self.code}", *ids)

    def merged(self, piece: str) -> bytes:
        return self.packed([t.id for t in self.model.tokenize(piece if piece.isascii() else piece.translate(self.letters))])

    def plain(self, text: str) -> bytes:
        """Ids of a text of plain characters."""
        if len(self.pieces) > CACHED_WORDS:
            self.pieces.clear()
        pieces, known = PIECES.findall(text.lower()), self.pieces
        for piece in set(pieces).difference(known):
            known[piece] = self.merged(piece)
        return b"".join(map(known.__getitem__, pieces))

    def word(self, word: bytes) -> bytes:
        text = word.decode()
        if is_plain(text):
            return self.plain(text)
        return self.packed(self.tokenizer.encode(text, add_special_tokens=False).ids)

    def encode(self, data: bytes) -> list[bytes]:
        parts, known = [], self.known
        for block in text_blocks(data):
            text = block.decode()
            if is_plain(text):
                parts.append(self.plain(text))
                continue
            if len(known) > CACHED_WORDS:
                known.clear()
            words = block.split()
            for word in set(words).difference(known):
                known[word] = self.word(word)
            parts.append(b"".join(map(known.__getitem__, words)))
        return parts


def is_plain(text: str) -> bool:
    return PLAIN.fullmatch(text) is not None and "<|" not in text


@functools.lru_cache(maxsize=2)
def word_encoder(path: str) -> WordEncoder:
    return WordEncoder(path)


class Frequencies:
    """Frequencies of the ids, summing to 2**PRECISION, at least 1 for each id that occurs."""

    def __init__(self, frequencies: np.ndarray):
        self.frequencies = frequencies.astype(np.uint64)
        self.starts = np.concatenate(([0], np.cumsum(self.frequencies)[:-1])).astype(np.uint64)
        self.ids = np.repeat(np.arange(len(frequencies), dtype=np.uint32), frequencies.astype(np.int64))

    @classmethod
    def of(cls, counts: np.ndarray) -> Frequencies:
        whole, present = 1 << PRECISION, np.flatnonzero(counts)
        if len(present) > whole // 2:
            raise ValueError("too many different ids for the precision")
        scaled = np.zeros(len(counts), np.int64)
        total = int(counts.sum())
        scaled[present] = [max(1, int(c) * whole // total) for c in counts[present]]
        order = present[np.argsort(-scaled[present], kind="stable")]
        rest = whole - int(scaled.sum())
        if rest > 0 and len(order):
            scaled[order[0]] += rest
        for i in order if rest < 0 else ():
            taken = min(-rest, int(scaled[i]) - 1, max(1, int(scaled[i]) // 2))
            scaled[i] -= taken
            rest += taken
            if rest == 0:
                break
        return cls(scaled)


def encode_block(ids: np.ndarray, table: Frequencies, lanes: int = LANES, every: int = CHECKPOINT_STEPS) -> bytes:
    """One block: header, checkpoint places, checkpoint states, words."""
    lanes = max(1, min(lanes, len(ids)))
    steps = -(-len(ids) // lanes)
    states = np.full(lanes, LOW, np.uint64)
    emitted: list[np.ndarray] = [None] * steps
    saved: dict[int, np.ndarray] = {}
    precision, word = np.uint64(PRECISION), np.uint64(32)
    limit = np.uint64(LOW >> PRECISION << 32)
    for step in range(steps - 1, -1, -1):
        part = ids[step * lanes:(step + 1) * lanes]
        n = len(part)
        frequency, x = table.frequencies[part], states[:n]
        full = x >= frequency * limit
        emitted[step] = x[full].astype(np.uint32)
        x = np.where(full, x >> word, x)
        high = x // frequency
        states[:n] = (high << precision) + (x - high * frequency) + table.starts[part]
        if step % every == 0:
            saved[step] = states.copy()
    words = np.concatenate(emitted) if steps else np.zeros(0, np.uint32)
    places = np.concatenate(([0], np.cumsum([len(e) for e in emitted]))).astype(np.uint32)
    marks = sorted(saved)
    header = struct.pack(BLOCK, len(ids), lanes, len(words), len(marks), zlib.crc32(ids.astype("<u4").tobytes()))
    return b"".join([
        header, places[marks].astype("<u4").tobytes(), *[saved[m].astype("<u8").tobytes() for m in marks], words.astype("<u4").tobytes(),
    ])


def decode_block(data: memoryview, table: Frequencies, every: int = CHECKPOINT_STEPS) -> tuple[np.ndarray, int]:
    """The ids of the block at the start of the data, checked, and the block's size in bytes."""
    n, lanes, n_words, marks, checksum = struct.unpack_from(BLOCK, data)
    at = struct.calcsize(BLOCK)
    places = np.frombuffer(data, "<u4", marks, at)
    at += 4 * marks
    states = np.frombuffer(data, "<u8", marks * lanes, at).reshape(marks, lanes)
    at += 8 * marks * lanes
    words = np.frombuffer(data, "<u4", n_words, at)
    parts = [
        decode_from(states[i], words[places[i]:], table, min(n - i * every * lanes, every * lanes)) for i in range(marks)
    ]
    ids = np.concatenate(parts) if parts else np.zeros(0, np.uint32)
    if zlib.crc32(ids.astype("<u4").tobytes()) != checksum:
        raise ValueError("damaged block")
    return ids, at + 4 * n_words


def decode_from(states: np.ndarray, words: np.ndarray, table: Frequencies, n: int) -> np.ndarray:
    """The next ``n`` ids from a checkpoint's states."""
    x, lanes, at = states.astype(np.uint64), len(states), 0
    out = np.empty(n, np.uint32)
    mask, precision, word, low = np.uint64((1 << PRECISION) - 1), np.uint64(PRECISION), np.uint64(32), np.uint64(LOW)
    for start in range(0, n, lanes):
        m = min(lanes, n - start)
        slot = x[:m] & mask
        ids = table.ids[slot]
        out[start:start + m] = ids
        now = table.frequencies[ids] * (x[:m] >> precision) + slot - table.starts[ids]
        few = np.flatnonzero(now < low)
        now[few] = (now[few] << word) | words[at:at + len(few)]
        at += len(few)
        x[:m] = now
    return out


def ids_bytes(packed: bytes) -> bytes:
    return zstandard.ZstdDecompressor().decompress(packed)


CHUNKS = "part int, chunk int, n_ids bigint, documents binary, ids binary"


def _pack_documents(keys: list, sizes: list[int], kind: pa.DataType) -> bytes:
    batch = pa.RecordBatch.from_arrays([pa.array(keys, kind), pa.array(sizes, pa.int64())], ["key", "n"])
    out = io.BytesIO()
    with pa.ipc.new_stream(out, batch.schema, options=pa.ipc.IpcWriteOptions(compression="zstd")) as stream:
        stream.write_batch(batch)
    return out.getvalue()


def token_chunks(docs: DataFrame, path: str, key: str, text: str, end_id: int = END_ID) -> DataFrame:
    """The corpus in key order as chunks of whole documents, written: one row per chunk."""
    placed = docs.select(F.col(key).alias("key"), F.col(text).alias("text")).withColumn("at", F.monotonically_increasing_id())
    ordered = placed.repartitionByRange("key", "at").sortWithinPartitions("key", "at").select("key", "text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder, packer = word_encoder(path), zstandard.ZstdCompressor(level=1)
        part, chunk = TaskContext.get().partitionId(), 0
        width, end = np.dtype(encoder.kind).itemsize, np.array([end_id], encoder.kind).tobytes()
        keys, sizes, held, total = [], [], [], 0

        def packed() -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([
                pa.array([part], pa.int32()), pa.array([chunk], pa.int32()), pa.array([total], pa.int64()),
                pa.array([_pack_documents(keys, sizes, kind)], pa.binary()),
                pa.array([packer.compress(b"".join(held))], pa.binary()),
            ], ["part", "chunk", "n_ids", "documents", "ids"])

        for batch in batches:
            kind = batch.column(0).type
            for name, body in zip(batch.column(0).to_pylist(), batch.column(1).cast(pa.binary())):
                found = [*encoder.encode(body.as_py() or b""), end]
                size = sum(map(len, found)) // width
                keys.append(name)
                sizes.append(size)
                held.extend(found)
                total += size
                if total >= CHUNK_IDS:
                    yield packed()
                    keys, sizes, held, total, chunk = [], [], [], 0, chunk + 1
        if keys:
            yield packed()

    return written(ordered.mapInArrow(run, CHUNKS), "token-chunks")


def count_ids(chunks: DataFrame, vocabulary: int, kind: str) -> np.ndarray:
    """How often each id occurs: summed per task, then over all."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = np.zeros(vocabulary, np.int64)
        for batch in batches:
            for packed in batch.column(0):
                counts += np.bincount(np.frombuffer(ids_bytes(packed.as_py()), kind), minlength=vocabulary)
        ids = np.flatnonzero(counts)
        yield pa.RecordBatch.from_arrays([pa.array(ids, pa.int32()), pa.array(counts[ids], pa.int64())], ["id", "n"])

    summed = chunks.select("ids").mapInArrow(run, "id int, n bigint").groupBy("id").agg(F.sum("n").alias("n"))
    counts = np.zeros(vocabulary, np.int64)
    for r in summed.collect():
        counts[r["id"]] = r["n"]
    return counts


INDEX = "part int, chunk int, n_ids bigint, file string, offset bigint, length bigint"


def write_files(docs: DataFrame, folder: str, path: str, key: str = "doc_id", text: str = "text", end_id: int = END_ID) -> DataFrame:
    """Write the corpus below the folder; the index is returned as a written table."""
    encoder = word_encoder(path)
    kind, vocabulary = encoder.kind, max(encoder.tokenizer.get_vocab_size(), end_id + 1)
    chunks = token_chunks(docs, path, key, text, end_id)
    table = Frequencies.of(count_ids(chunks, vocabulary, kind))
    store, base = opened(folder)
    store.create_dir(base, recursive=True)
    with store.open_output_stream(f"{base}/frequencies") as out:
        out.write(table.frequencies.astype("<u4").tobytes())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shared = read_table(folder)
        target, root = opened(folder)
        out, name, offset = None, "", 0
        for batch in batches:
            rows = []
            for i in range(batch.num_rows):
                part, chunk, n, documents, packed = (batch.column(k)[i].as_py() for k in range(5))
                ids = np.frombuffer(ids_bytes(packed), kind).astype(np.uint32)
                blocks = [encode_block(ids[a:a + BLOCK_IDS], shared) for a in range(0, len(ids), BLOCK_IDS)]
                data = b"".join([struct.pack(CHUNK, MAGIC, n, len(blocks), len(documents)), documents, *blocks])
                if out is None or offset >= FILE_BYTES:
                    if out is not None:
                        out.close()
                    name, offset = f"{uuid4().hex}.rans", 0
                    out = target.open_output_stream(f"{root}/{name}")
                out.write(data)
                rows.append((part, chunk, n, name, offset, len(data)))
                offset += len(data)
            kinds = (pa.int32(), pa.int32(), pa.int64(), pa.string(), pa.int64(), pa.int64())
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, k) for c, k in zip(zip(*rows) if rows else [[]] * 6, kinds)],
                ["part", "chunk", "n_ids", "file", "offset", "length"],
            )
        if out is not None:
            out.close()

    return written(chunks.mapInArrow(run, INDEX), "token-index")


@functools.lru_cache(maxsize=2)
def read_table(folder: str) -> Frequencies:
    store, base = opened(folder)
    with store.open_input_file(f"{base}/frequencies") as source:
        return Frequencies(np.frombuffer(source.read(), "<u4"))


def chunk_starts(index: DataFrame) -> DataFrame:
    """The index with ``start``, the ids of all chunks before: sums per range first, then inside each."""
    sums = index.groupBy("part").agg(F.sum("n_ids").alias("n")).orderBy("part").collect()
    starts, total = [], 0
    for r in sums:
        starts.append((r["part"], total))
        total += r["n"]
    ranges = index.sparkSession.createDataFrame(starts, "_part int, _first bigint")
    before = Window.partitionBy("part").orderBy("chunk").rowsBetween(Window.unboundedPreceding, -1)
    inside = index.withColumn("_before", F.coalesce(F.sum("n_ids").over(before), F.lit(0)))
    return inside.join(F.broadcast(ranges), F.col("part") == F.col("_part")).withColumn("start", F.col("_first") + F.col("_before"))


def read_documents(index: DataFrame, folder: str, key: str, kind: str) -> DataFrame:
    """Per document, from the files: key, ``start``, ``n_tokens`` and ``ids`` (unsigned 32-bit integers)."""
    placed = dealt_by_bytes(chunk_starts(index).select("file", "offset", "length", "start"), "file")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, base = opened(folder)
        table = read_table(folder)
        for batch in batches:
            for name, offset, length, start in zip(*[c.to_pylist() for c in batch.columns]):
                with store.open_input_file(f"{base}/{name}") as source:
                    data = memoryview(source.read_at(length, offset))
                yield from _chunk_documents(data, start, table)

    return placed.mapInArrow(run, f"{key} {kind}, start bigint, n_tokens bigint, ids binary")


def _chunk_documents(data: memoryview, start: int, table: Frequencies) -> Iterator[pa.RecordBatch]:
    magic, n, n_blocks, size = struct.unpack_from(CHUNK, data)
    if magic != MAGIC:
        raise ValueError("not a chunk of token ids")
    at = struct.calcsize(CHUNK)
    documents = pa.ipc.open_stream(pa.py_buffer(data[at:at + size])).read_next_batch()
    at += size
    parts = []
    for _ in range(n_blocks):
        ids, used = decode_block(data[at:], table)
        parts.append(ids)
        at += used
    raw = memoryview(np.concatenate(parts).astype("<u4").tobytes())
    sizes = documents.column(1).to_numpy()
    ends = np.cumsum(sizes)
    if int(ends[-1]) != n or 4 * n != len(raw):
        raise ValueError("a chunk's documents do not match its ids")
    firsts = ends - sizes
    for a in range(0, len(sizes), 512):
        b = min(a + 512, len(sizes))
        ids = [bytes(raw[4 * f:4 * e]) for f, e in zip(firsts[a:b].tolist(), ends[a:b].tolist())]
        yield pa.RecordBatch.from_arrays([
            documents.column(0).slice(a, b - a), pa.array(firsts[a:b] + start), pa.array(sizes[a:b]), pa.array(ids, pa.binary()),
        ], ["key", "start", "n_tokens", "ids"])


def stored_documents(docs: DataFrame, path: str, key: str = "doc_id", text: str = "text", end_id: int = END_ID) -> DataFrame:
    """Write the corpus to files below the shared folder and read every document back."""
    folder = scratch_path(docs.sparkSession, "tokens")
    kind = dict(docs.select(F.col(key).alias("key")).dtypes)["key"]
    index = write_files(docs, folder, path, key, text, end_id)
    read = read_documents(index, folder, "_key", kind)
    return read.withColumnRenamed("_key", key)
