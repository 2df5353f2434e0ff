"""URL filters: rules first, then naive Bayes over the words of host and path.

A rule names a host (its subdomains included) and the start of a path; the longest fitting rule decides. All
other URLs are judged by a multinomial naive Bayes classifier over tokens: host labels, whose
concatenated names are split into words by unigram Viterbi, and path tokens. It learns from the URLs that
rules decide.

The word model counts all words of all page titles, as a written table; other stretches cost more with each
letter. Each distinct host is joined with the words it contains, split once, and its words are joined to its
pages. Token counts go to BUCKETS hash buckets per class, summed per task before the shuffle; that model has a
fixed size and is broadcast.

Defined cases: a null URL or one without ``://`` has empty host and path, fits no rule and is judged by
the classes' shares; without ruled URLs of both classes such shares are even and ties allow; null titles
have no words; a very long host is cut into windows for its pieces, and its text is held by one row; repeated rows
count and are judged one by one; an empty table gives an empty table; other columns, whatever their names, pass unread.
"""

from __future__ import annotations

import functools
import math
import re
import string
import zlib
from collections import Counter
from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tableloom.llm.common import written

ALLOW, BLOCK = "allow", "block"
BUCKETS = 1 << 16
#: Letters in which pieces of a name may start together.
WINDOW = 1_024
#: Scores closer than this are ties.
TIE = 1e-9

CHUNKS = re.compile(r"[a-z]+|[0-9]+|[^\x00-\x7f]+")


@dataclass(frozen=True)
class Rule:
    verdict: str
    host: str
    path: str

    @property
    def text(self) -> str:
        return self.host + self.path


def host_of(url: Column) -> Column:
    """What follows the first ``://`` up to a slash, question mark or hash, A-Z lower-cased; else empty."""
    host = F.regexp_extract(_after_scheme(url), r"^[^/?#]*", 0)
    return F.translate(host, string.ascii_uppercase, string.ascii_lowercase)


def path_of(url: Column) -> Column:
    """What follows the host up to a question mark or hash; else empty."""
    return F.regexp_extract(_after_scheme(url), r"^[^/?#]*([^?#]*)", 1)


def _after_scheme(url: Column) -> Column:
    at = F.instr(url, "://")
    return F.when(at > 0, F.substring(url, at + 3, F.length(url))).otherwise(F.lit(""))


def fitting_rule(host: Column, path: Column, rules: Sequence[Rule], name: str) -> Column:
    """Text or verdict of the longest rule that fits, else NULL."""
    chosen = F.lit(None).cast("string")
    for rule in sorted(rules, key=lambda r: (len(r.text), r.text)):
        fits = ((host == rule.host) | F.endswith(host, F.lit(f".{rule.host}"))) & F.startswith(path, F.lit(rule.path))
        chosen = F.when(fits, F.lit(getattr(rule, name))).otherwise(chosen)
    return chosen


@dataclass(frozen=True)
class WordModel:
    """Log-probabilities of known words, among ``all_words`` (by default those known); unknown ones cost a tenth more per letter."""

    counts: tuple[tuple[str, int], ...]
    all_words: int | None = None

    @functools.cached_property
    def costs(self) -> dict[str, float]:
        return {w: math.log(n / self.total) for w, n in self.counts}

    @functools.cached_property
    def lengths(self) -> list[int]:
        return sorted({len(w) for w, _ in self.counts}, reverse=True)

    @functools.cached_property
    def total(self) -> int:
        return max(10, sum(n for _, n in self.counts) if self.all_words is None else self.all_words)

    def split(self, name: str) -> list[str]:
        """The most probable words that make up the name (Viterbi); ties take the longer last word.

        A known word never costs more than an unknown one, so the best start of an unknown last word is
        kept along the way, and only lengths of known words are tried.
        """
        letter, unknown = math.log(10), math.log(10 / self.total)
        best, last, start = [0.0], [0], 0
        for end in range(1, len(name) + 1):
            found = [(s, best[s] + self.costs[name[s:end]]) for s in (end - n for n in self.lengths) if s >= 0 and name[s:end] in self.costs]
            found.append((start, best[start] + unknown - (end - start) * letter))
            at, score = min(found)[0], -math.inf
            for s, value in sorted(found):
                if value > score + TIE:
                    at, score = s, value
            best.append(score)
            last.append(at)
            if score + end * letter > best[start] + start * letter + TIE:
                start = end
        words, end = [], len(name)
        while end:
            words.append(name[last[end]:end])
            end = last[end]
        return words[::-1]


def count_words(pages: DataFrame, html: str = "html") -> DataFrame:
    """Count the words of all titles: rows (w, n)."""
    title = F.regexp_extract(F.col(html), r"(?is)<title[^>]*>(.*?)</title>", 1)
    words = pages.select(F.explode(F.split(F.lower(title), "[^a-z]+")).alias("w"))
    return written(words.where(F.col("w") != "").groupBy("w").agg(F.count(F.lit(1)).alias("n")), "words")


def host_parts(names: DataFrame, sizes: list[int]) -> DataFrame:
    """The distinct pieces of the given sizes in each ``name``, beside its ``number`` and nothing else.

    Long names go through windows that overlap by the largest size, so no row holds more than a window's pieces.
    """
    windows = names.select("number", "name", F.explode(F.sequence(F.lit(0), F.floor((F.length("name") - 1) / WINDOW))).alias("at"))
    window = F.col("name").substr(F.col("at") * WINDOW + 1, F.lit(WINDOW + max(sizes) - 1))
    fitting = F.filter(F.array(*[F.lit(n) for n in sorted(sizes)]), lambda n: n <= F.length("window"))
    sized = windows.select("number", window.alias("window")).select("number", "window", F.explode(fitting).alias("size"))
    starts = F.sequence(F.lit(1), F.least(F.lit(WINDOW), F.length("window") - F.col("size") + 1))
    parts = F.explode(F.transform(starts, lambda s: F.col("window").substr(s, F.col("size"))))
    return sized.select("number", parts.alias("w")).distinct()


def split_hosts(hosts: DataFrame, counts: DataFrame) -> DataFrame:
    """Distinct hosts with their words. Each brings the counts of the words it contains to the split.

    Hosts travel once; their pieces carry a hash of them. Hosts of one hash would share their known words, which
    changes nothing, as a word that is not in a name cannot split it.
    """
    summed = counts.agg(F.sum("n").alias("n"), F.collect_set(F.length("w")).alias("lengths")).first()
    total, lengths = summed["n"] or 0, summed["lengths"] or [1]
    numbered = hosts.select("host", F.xxhash64("host").alias("number"))
    names = numbered.select("number", F.explode(F.array_distinct(F.regexp_extract_all("host", F.lit("[a-z]+"), F.lit(0)))).alias("name"))
    known = host_parts(names, lengths).join(counts, "w").groupBy("number").agg(F.collect_set(F.struct("w", "n")).alias("known"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = []
            for host, own in zip(batch.column(0), batch.column(1)):
                model = WordModel(tuple((k["w"], k["n"]) for k in own.as_py() or ()), total)
                chunks = CHUNKS.findall(host.as_py())
                found.append([w for c in chunks for w in (model.split(c) if c.isalpha() and c.isascii() else [c])])
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(found, pa.list_(pa.string()))], ["host", "host_words"])

    met = numbered.join(known, "number", "left").select("host", "known")
    return written(met.mapInArrow(run, "host string, host_words array<string>"), "hosts")


def buckets_of(host_words: list[str], path: str) -> list[int]:
    """Hash buckets of the words of a host and the tokens of a path."""
    tokens = [f"h:{w}" for w in host_words]
    tokens += [f"p:{'0' if t[0].isdigit() else t}" for t in CHUNKS.findall(path.lower())]
    return [zlib.crc32(t.encode()) % BUCKETS for t in tokens]


@dataclass(frozen=True)
class Bayes:
    """Log-odds of block: the classes' shares and a weight per bucket."""

    prior: float
    weights: np.ndarray

    def score(self, buckets: list[int]) -> float:
        return self.prior + float(self.weights[buckets].sum()) if buckets else self.prior


def learn(urls: DataFrame) -> Bayes:
    """Learn from rows (host_words, path, verdict); counts are summed per task and bucket."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts, rows = np.zeros((2, BUCKETS), np.int64), Counter()
        for batch in batches:
            for words, path, verdict in zip(*[c.to_pylist() for c in batch.columns]):
                side = int(verdict == BLOCK)
                rows[side] += 1
                np.add.at(counts[side], buckets_of(words, path), 1)
        side, bucket = np.nonzero(counts)
        sides, buckets = [*side.tolist(), 0, 1], [*bucket.tolist(), -1, -1]
        numbers = [*counts[side, bucket].tolist(), rows[0], rows[1]]
        yield pa.RecordBatch.from_arrays(
            [pa.array(sides, pa.int32()), pa.array(buckets, pa.int32()), pa.array(numbers, pa.int64())], ["side", "bucket", "n"])

    summed = urls.mapInArrow(run, "side int, bucket int, n bigint").groupBy("side", "bucket").agg(F.sum("n").alias("n"))
    counts, rows = np.ones((2, BUCKETS)), [1, 1]
    for r in summed.collect():
        if r["bucket"] < 0:
            rows[r["side"]] += r["n"]
        else:
            counts[r["side"], r["bucket"]] += r["n"]
    logs = np.log(counts / counts.sum(axis=1, keepdims=True))
    return Bayes(math.log(rows[1] / rows[0]), (logs[1] - logs[0]).astype(np.float32))


def judge(pages: DataFrame, rules: Sequence[Rule], page: str = "page_id", url: str = "url", html: str = "html") -> DataFrame:
    """Per row: page, ``host``, ``path``, ``rule``, ``verdict`` and ``host_words``."""
    narrow = pages.select(F.col(page).alias("page"), F.coalesce(F.col(url), F.lit("")).alias("url"))
    parted = narrow.select("page", host_of(F.col("url")).alias("host"), path_of(F.col("url")).alias("path"))
    host, path = F.col("host"), F.col("path")
    ruled = parted.select(
        "page", "host", "path", fitting_rule(host, path, rules, "text").alias("rule"),
        fitting_rule(host, path, rules, "verdict").alias("decided"),
    )
    hosts = written(parted.select("host").distinct(), "distinct-hosts")
    worded = ruled.join(split_hosts(hosts, count_words(pages, html)), "host").select(*ruled.columns, "host_words")
    model = learn(worded.where(F.col("decided").isNotNull()).select("host_words", "path", "decided"))
    shared = pages.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bayes = shared.value
        for batch in batches:
            paths, decided, words = (batch.column(i).to_pylist() for i in (2, 4, 5))
            verdicts = [d or (BLOCK if bayes.score(buckets_of(w, p)) > 0 else ALLOW) for p, d, w in zip(paths, decided, words)]
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[:4], pa.array(verdicts, pa.string()), batch.column(5)],
                ["page", "host", "path", "rule", "verdict", "host_words"])

    kind = dict(ruled.dtypes)["page"]
    judged = worded.mapInArrow(run, f"page {kind}, host string, path string, rule string, verdict string, host_words array<string>")
    return judged.withColumnRenamed("page", page)
