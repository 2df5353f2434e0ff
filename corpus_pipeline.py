"""The corpus pipeline: documents in, token digests of the kept documents out.

Scale: every stage reads the documents its predecessor has written. Verdicts are found on ids and hashes of rows;
the documents meet the distinct keys of a stage by one shuffle.

Defined cases: a null or empty text, or one without letters, goes in the first stage, as its language is not known;
rows without doc_id are told apart by their texts and sources; a null source has no host verdict; equal rows
share every verdict, and of equal rows that stay as a group's first one is kept; ties in a group go to the
smallest doc_id, no id before all; very long texts pass whole; empty tables pass empty through every stage; other columns, whatever
their names, stay as they are in all stages but the last.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tableloom.llm import decontaminate, language_id, quality_rules, simhash
from tableloom.llm.common import written
from tableloom.llm.queries import bpe_digests, fold, table


#: What tells documents apart, since ids may be missing or repeated. A row is known by its id and a hash of these.
IDENTITY = ("doc_id", "text", "source")


def mark() -> Column:
    return F.xxhash64(*IDENTITY)


def named(docs: DataFrame, *columns: str) -> DataFrame:
    """A ``key`` (id and mark) beside some columns."""
    return docs.select(F.struct("doc_id", mark().alias("mark")).alias("key"), *columns)


def same_row(doc_id: str = "doc_id", text: str = "text", source: str = "source") -> Column:
    return F.col(doc_id).eqNullSafe(F.col("_doc_id")) & (F.xxhash64(doc_id, text, source) == F.col("_mark"))


def with_keys(docs: DataFrame, keys: DataFrame, how: str) -> DataFrame:
    """The documents in (semi) or not in (anti) a key table; around the join their columns are named by position."""
    places = {name: f"c{at}" for at, name in enumerate(docs.columns)}
    found = docs.toDF(*places.values()).join(keys, same_row(*[places[n] for n in IDENTITY]), how)
    return found.toDF(*places)


def listed(keys: DataFrame, label: str) -> DataFrame:
    """The distinct ``key`` values as a written table: ids and marks, joined by the same shuffle of the rows at every size.

    The keys of a partition are hashed, so the texts are not sorted.
    """
    table = written(keys.select(F.col("key.doc_id").alias("_doc_id"), F.col("key.mark").alias("_mark")).distinct(), label)
    return table.hint("shuffle_hash")


def identify_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keep the documents whose language is clear."""
    return language_id.keep_identified(docs, language_id.fit(docs, where=fold(4) != 2))


def apply_quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keep the documents that pass the base rules and whose host does. Equal rows have equal verdicts."""
    judged = quality_rules.judge(named(docs, "text", "source"), "key")
    return with_keys(docs, listed(judged.where(~F.col("kept")), "failed"), "left_anti")


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keep one document of each group: the one with the smallest doc_id (no id comes first).

    Where the kept document is there several times, with the same id and text, one row stays.
    """
    found = written(simhash.near_duplicates(named(docs, "text"), "key"), "near-duplicates")
    first = F.col("key") == F.col("component_id")
    single = with_keys(docs, listed(found.where(~first), "duplicates"), "left_anti")
    several = found.where(first).groupBy("key").agg(F.count(F.lit(1)).alias("n")).where("n > 1")
    repeated = listed(several, "repeated")
    if repeated.isEmpty():
        return single
    copies = with_keys(single, repeated, "left_semi")
    return with_keys(single, repeated, "left_anti").unionByName(copies.dropDuplicates(list(IDENTITY)))


def decontaminate_benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drop contaminated documents and cut benchmark passages from the rest."""
    return decontaminate.clean(docs, table(spark, sf_dir, "benchmark"))


def encode_tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Encode the documents, decode them again, and return the digests of both."""
    return bpe_digests(docs)


STAGES = [
    ("language_id", identify_language),
    ("quality_rules", apply_quality_rules),
    ("simhash_dedup", drop_near_duplicates),
    ("decontamination", decontaminate_benchmark),
    ("byte_bpe", encode_tokens),
]

#: Compression with fitted dictionaries and byte-pair merges have no SQL; the tests compare with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Apply the stages to ``documents``, each written and read again by the next."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
