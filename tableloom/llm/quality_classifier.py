"""Quality classifier: a second-order factorisation machine.

A text's features are its distinct words hashed into buckets (scaled to unit length), its structure
statistics and its metadata, each cut into steps of their own. Every feature has a weight and a short
factor; pairs interact by the product of their factors, which the identity
``sum over pairs = (square of the sum - sum of the squares) / 2`` sums in time linear in the features.

The model is fitted in one task on a sample of labelled rows bounded by SAMPLE_ROWS, chosen by the
hash of the key, and has a fixed size (FEATURES rows of FACTORS + 1 numbers), so it is broadcast. Scoring
covers every row and whole texts, row by row, without a shuffle.

Defined cases: a null or empty text has no words and is scored by its structure and metadata; null
metadata has a step of its own; labels that are null or have no document are not used, and of several
labels of one key the lowest is; without labels the score is 0.5; repeated rows are scored one by one.
"""

from __future__ import annotations

import io
import math
import zlib
from collections import Counter
from collections.abc import Iterator
from itertools import pairwise

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tableloom.llm.common import word_blocks, written

WORD_BUCKETS = 1 << 16
STEPS = 24
STATISTICS = 11
FEATURES = WORD_BUCKETS + STEPS * STATISTICS
FACTORS = 8
SAMPLE_ROWS = 10_000
EPOCHS = 12
BATCH_ROWS = 256
RATE = 0.02
DECAY = 1e-5
HASHES = 1 << 30

SYMBOLS = b"#*$%&|<>!{}[]=~^_\\@"
TERMINALS = (b".", b"!", b"?", b'"', b":")


def _step(share: float) -> int:
    return min(STEPS - 1, max(0, int(share * STEPS)))


def _size_step(n: float) -> int:
    return min(STEPS - 1, int(1.5 * math.log2(1 + n)))


def features(data: bytes, n_chars: int | None) -> tuple[np.ndarray, np.ndarray]:
    """Feature numbers (not necessarily distinct) and values of one text."""
    counts: Counter = Counter()
    n_words = word_bytes = repeats = titled = 0
    seen_pairs: set = set()
    for words in word_blocks(data):
        counts.update(words)
        n_words += len(words)
        word_bytes += sum(map(len, words))
        neighbours = [hash(p) for p in pairwise(words)]
        repeats += len(neighbours)
        seen_pairs.update(neighbours)
    n, size = max(1, n_words), max(1, len(data))
    lines = [line for line in data.split(b"\n") if line.strip()]
    letters = len(data) - len(data.translate(None, b"ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz"))
    titled = len(data) - len(data.translate(None, b"ABCDEFGHIJKLMNOPQRSTUVWXYZ"))
    symbols = len(data) - len(data.translate(None, SYMBOLS))
    steps = [
        _size_step(n_words),
        _step(word_bytes / n / 24),
        _step(len(counts) / n),
        _step(max(counts.values(), default=0) / n),
        _step(4 * symbols / size),
        _step(8 * (len(data) - len(data.translate(None, b"0123456789"))) / size),
        _step(titled / max(1, letters)),
        _step(1 - len(set(lines)) / max(1, len(lines))),
        _step(sum(line.rstrip().endswith(TERMINALS) for line in lines) / max(1, len(lines))),
        _step(1 - len(seen_pairs) / max(1, repeats)),
        STEPS - 1 if n_chars is None else min(STEPS - 2, _size_step(max(0, n_chars))),
    ]
    words = np.fromiter((zlib.crc32(w) for w in map(bytes.lower, counts)), np.int64, len(counts)) % WORD_BUCKETS
    marks = WORD_BUCKETS + np.arange(STATISTICS) * STEPS + np.array(steps)
    scale = 1 / math.sqrt(len(counts)) if counts else 0.0
    return np.concatenate([words, marks]), np.concatenate([np.full(len(words), scale), np.full(STATISTICS, 0.5)])


class Machine:
    """Bias, weights and factors."""

    def __init__(self, bias: float, weights: np.ndarray, factors: np.ndarray):
        self.bias, self.weights, self.factors = bias, weights, factors

    def score(self, numbers: np.ndarray, values: np.ndarray) -> float:
        used = self.factors[numbers] * values[:, None]
        pairs = 0.5 * float((used.sum(axis=0) ** 2 - (used**2).sum(axis=0)).sum())
        raw = self.bias + float(self.weights[numbers] @ values) + pairs
        return 1 / (1 + math.exp(-min(30.0, max(-30.0, raw))))

    def to_bytes(self) -> bytes:
        out = io.BytesIO()
        np.savez(out, bias=self.bias, weights=self.weights.astype(np.float32), factors=self.factors.astype(np.float32))
        return out.getvalue()

    @classmethod
    def from_bytes(cls, data: bytes) -> Machine:
        kept = np.load(io.BytesIO(data))
        return cls(float(kept["bias"]), kept["weights"], kept["factors"])


def train(rows: list[tuple[int, np.ndarray, np.ndarray]], epochs: int = EPOCHS) -> Machine:
    """Logistic loss by Adam over small batches; only the features a batch uses are moved."""
    draw = np.random.default_rng(7)
    weights, factors = np.zeros(FEATURES), draw.normal(0, 0.05, (FEATURES, FACTORS))
    share = min(0.99, max(0.01, sum(y for y, *_ in rows) / max(1, len(rows))))
    bias = math.log(share / (1 - share)) if rows else 0.0
    moments = [np.zeros(FEATURES), np.zeros(FEATURES), np.zeros((FEATURES, FACTORS)), np.zeros((FEATURES, FACTORS))]
    turn = 0
    for _ in range(epochs if rows else 0):
        order = draw.permutation(len(rows))
        for at in range(0, len(order), BATCH_ROWS):
            batch = [rows[i] for i in order[at:at + BATCH_ROWS]]
            turn += 1
            starts = np.cumsum([0] + [len(b[1]) for b in batch[:-1]])
            owner = np.repeat(np.arange(len(batch)), [len(b[1]) for b in batch])
            numbers, values = np.concatenate([b[1] for b in batch]), np.concatenate([b[2] for b in batch])
            used = factors[numbers] * values[:, None]
            sums = np.add.reduceat(used, starts)
            pairs = 0.5 * (sums**2 - np.add.reduceat(used**2, starts)).sum(axis=1)
            raw = bias + np.add.reduceat(weights[numbers] * values, starts) + pairs
            error = (1 / (1 + np.exp(-np.clip(raw, -30, 30))) - np.array([b[0] for b in batch])) / len(batch)
            bias -= RATE * error.sum()
            each, places = np.unique(numbers, return_inverse=True)
            slope = error[owner] * values
            slope_w = np.bincount(places, slope, len(each)) + DECAY * weights[each]
            parts = slope[:, None] * (sums[owner] - used)
            slope_f = np.stack([np.bincount(places, parts[:, f], len(each)) for f in range(FACTORS)], axis=1) + DECAY * factors[each]
            for kept, slopes, first, second in ((weights, slope_w, 0, 1), (factors, slope_f, 2, 3)):
                moments[first][each] = 0.9 * moments[first][each] + 0.1 * slopes
                moments[second][each] = 0.999 * moments[second][each] + 0.001 * slopes**2
                mean, square = moments[first][each] / (1 - 0.9**turn), moments[second][each] / (1 - 0.999**turn)
                kept[each] -= RATE * mean / (np.sqrt(square) + 1e-8)
    return Machine(bias, weights, factors)


def _extract(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        texts = batch.column(2).cast(pa.binary())
        found = [features(t.as_py() or b"", n) for t, n in zip(texts, batch.column(3).to_pylist())]
        yield pa.RecordBatch.from_arrays([
            batch.column(0), batch.column(1),
            pa.array([f[0] for f in found], pa.list_(pa.int64())), pa.array([f[1] for f in found], pa.list_(pa.float64())),
        ], ["order", "label", "numbers", "values"])


def _train_task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    rows = []
    for batch in batches:
        for order, label, x in zip(*[c.to_pylist() for c in batch.columns]):
            rows.append((order, label, np.array(x["numbers"], np.int64), np.array(x["values"])))
    rows.sort(key=lambda r: r[:2])
    model = train([r[1:] for r in rows]).to_bytes()
    yield pa.RecordBatch.from_arrays([pa.array([model], pa.binary())], ["model"])


def fit(docs: DataFrame, labels: DataFrame, label: str, where: Column, key: str = "doc_id", text: str = "text",
        length: str = "n_chars", sample_rows: int = SAMPLE_ROWS) -> Machine:
    """Fit on at most about ``sample_rows`` labelled documents; ``where`` is over the labels' columns."""
    marked = labels.where(where).select(F.col(key).alias("_key"), F.col(label).cast("int").alias("label"))
    marked = marked.where(F.col("_key").isNotNull() & F.col("label").isNotNull()).groupBy("_key").agg(F.min("label").alias("label"))
    marked = marked.withColumn("order", F.xxhash64("_key"))
    n = marked.count()
    if n > sample_rows:
        marked = marked.where(F.pmod("order", F.lit(HASHES)) < HASHES * sample_rows // n)
    chosen = written(marked, "labelled")
    # The documents' other columns may be named like the ones here.
    narrow = docs.select(F.col(key).alias("owner"), F.col(text).alias("text"), F.col(length).cast("bigint").alias("n"))
    rows = narrow.join(F.broadcast(chosen), F.col("owner") == F.col("_key")).select("order", "label", "text", "n")
    extracted = rows.mapInArrow(_extract, "order bigint, label int, numbers array<bigint>, values array<double>")
    # Several documents of one key would all be training rows: one is enough.
    rows = extracted.groupBy("order", "label").agg(F.min(F.struct("numbers", "values")).alias("x"))
    return Machine.from_bytes(rows.repartition(1).mapInArrow(_train_task, "model binary").first()["model"])


def predict(docs: DataFrame, model: Machine, key: str = "doc_id", text: str = "text", length: str = "n_chars") -> DataFrame:
    """Per row: key and ``score``, the probability of label 1."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        machine = shared.value
        for batch in batches:
            texts = batch.column(1).cast(pa.binary())
            scores = [machine.score(*features(t.as_py() or b"", n)) for t, n in zip(texts, batch.column(2).to_pylist())]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(scores, pa.float64())], ["key", "score"])

    narrow = docs.select(F.col(key).alias("key"), F.col(text).alias("text"), F.col(length).cast("bigint").alias("n"))
    return narrow.mapInArrow(run, f"key {dict(narrow.dtypes)['key']}, score double").withColumnRenamed("key", key)
