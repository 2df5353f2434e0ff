"""Line deduplication over a corpus: lines found in many documents stay in one of them only.

Every text is exploded to its lines. A line's key (white space stripped at both ends, A-Z lower-cased)
is hashed to 128 bits; documents are counted per hash, and the hashes over the threshold are joined
back to the places of their lines. The places to drop are gathered per document, and the texts are put together
again by position from the lines between them.

Only hashes, ids and positions are shuffled until the end, where the texts meet their positions once.
Counting first makes (hash, document) pairs unique, so a line that most documents hold is spread over
the tasks by document and arrives as one partial row from each. Both joins have written tables at their small
side, so that adaptive execution knows their sizes and splits a hot hash or a repeated row. Everything is a
DataFrame function; no Python runs on the executors.

Defined cases: a null text is empty, and an empty text is one empty line; rows with one key are one
document (as are all rows with a null key, which comes before every other), but each row has its own positions;
repeated rows have equal results; ties cannot be, as the largest key holds the lines that stay; the lines of one text
and its positions are arrays of one row, so a very long text needs memory for itself; an empty table gives
an empty table; other columns, whatever their names, pass unread.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tableloom.llm.common import text_or_empty, written

MIN_DOCS = 3
MIN_CHARS = 20
SPACE = " \t\n\x0b\x0c\r"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def line_key(line: Column) -> Column:
    """The line stripped, A-Z lower-cased; pure ASCII takes the fast way, to which no other letter is known."""
    bare = F.btrim(line, F.lit(SPACE))
    return F.when(F.octet_length(bare) == F.char_length(bare), F.lower(bare)).otherwise(F.translate(bare, UPPER, LOWER))


def lines_of(text: Column) -> Column:
    return F.split(text, "\n")


def hashed_lines(rows: DataFrame, min_chars: int) -> DataFrame:
    """``owner``, ``mark``, ``at`` and the two halves of the hash of every line long enough to be compared."""
    lines = rows.select("owner", "mark", F.posexplode(lines_of(F.col("body"))).alias("at", "line"))
    keyed = lines.select("owner", "mark", "at", line_key(F.col("line")).alias("line")).where(F.char_length("line") >= min_chars)
    return keyed.select("owner", "mark", "at", F.xxhash64("line").alias("high"), F.xxhash64(F.lit(1), "line").alias("low"))


def repeated_lines(lines: DataFrame, min_docs: int) -> DataFrame:
    """The hashes found in enough documents, with the largest ``last`` document of each."""
    pairs = lines.select("high", "low", "owner").distinct()
    counted = pairs.groupBy("high", "low").agg(F.count(F.lit(1)).alias("docs"), F.max("owner").alias("last"))
    return counted.where(F.col("docs") >= min_docs).select(F.col("high").alias("_high"), F.col("low").alias("_low"), "last")


def without(text: Column, dropped: Column) -> Column:
    """The text from the lines between the sorted positions, in time linear in both.

    The one-element array binds both lists once; inside a lambda they would be made again for every part.
    """
    lines = lines_of(text)
    whole = F.struct(lines.alias("lines"), F.concat(F.array(F.lit(-1)), dropped, F.array(F.size(lines))).alias("cuts"))

    def kept(bound: Column) -> Column:
        cuts = bound.getField("cuts")
        return F.flatten(F.transform(
            F.sequence(F.lit(1), F.size(cuts) - 1),
            lambda n: F.slice(
                bound.getField("lines"), F.get(cuts, n - 1) + 2, F.get(cuts, n) - F.get(cuts, n - 1) - 1),
        ))

    return F.array_join(F.get(F.transform(F.array(whole), kept), F.lit(0)), "\n")


def drop_repeated_lines(docs: DataFrame, key: str = "doc_id", text: str = "text",
                        min_docs: int = MIN_DOCS, min_chars: int = MIN_CHARS) -> DataFrame:
    """Per row: key, ``n_lines``, ``n_dropped`` and the ``kept`` text."""
    named = docs.select(F.col(key).alias("owner"), text_or_empty(text).alias("body"))
    rows = named.select("owner", "body", F.xxhash64("body").alias("mark"))
    lines = hashed_lines(rows, min_chars)
    repeated = written(repeated_lines(lines, min_docs), "repeated-lines")
    found = lines.join(repeated, (F.col("high") == F.col("_high")) & (F.col("low") == F.col("_low")))
    places = found.where(~F.col("owner").eqNullSafe(F.col("last"))).groupBy(
        F.col("owner").alias("_owner"), F.col("mark").alias("_mark")
    ).agg(F.sort_array(F.collect_set("at")).alias("places"))
    same_row = F.col("owner").eqNullSafe(F.col("_owner")) & (F.col("mark") == F.col("_mark"))
    joined = rows.join(written(places, "dropped-lines"), same_row, "left")
    return joined.select(
        F.col("owner").alias(key),
        F.size(lines_of(F.col("body"))).cast("long").alias("n_lines"),
        F.coalesce(F.size("places"), F.lit(0)).cast("long").alias("n_dropped"),
        F.when(F.col("places").isNull(), F.col("body")).otherwise(without(F.col("body"), F.col("places"))).alias("kept"),
    )
