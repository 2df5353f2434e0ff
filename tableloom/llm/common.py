"""Helpers shared by the operators on documents and pages."""

from __future__ import annotations

from collections.abc import Iterator

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tableloom.session import write_kept

ASCII_SPACE = b" \t\n\x0b\x0c\r"


def written(df: DataFrame, label: str) -> DataFrame:
    """Write a table to the folder in ``spark.checkpoint.dir`` and read it back.

    Lineage is cut, a lost executor costs a re-read, and joins on the table get both sides
    shuffled, which lets adaptive execution split a hot key or broadcast a small side.
    ``tableloom.session.clear_kept`` deletes it.
    """
    return write_kept(df, label)


def text_or_empty(name: str) -> Column:
    return F.coalesce(F.col(name), F.lit(""))


def text_blocks(data: bytes, size: int = 1 << 20) -> Iterator[bytes]:
    """A text in blocks cut at white space, so that long texts need bounded memory."""
    start = 0
    while len(data) - start > size:
        end = start + size
        while end < len(data) and data[end] not in ASCII_SPACE:
            end += 1
        yield data[start:end]
        start = end
    yield data[start:] if start else data


def word_blocks(data: bytes, size: int = 1 << 20) -> Iterator[list[bytes]]:
    """The words of a text, block by block."""
    return map(bytes.split, text_blocks(data, size))
