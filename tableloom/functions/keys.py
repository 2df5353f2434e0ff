"""Reproducible pseudo-random order: an md5 of the seed and the row key."""

from __future__ import annotations

from collections.abc import Iterable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tableloom.functions.columns import col

NULL_MARK = "\x00"


def row_keys(df: DataFrame, keys: Sequence[str] = (), exclude: Iterable[str] = ()) -> list[str]:
    """The given keys; without any, all columns but the excluded ones tell rows apart."""
    skip = set(exclude)
    return list(keys) or [c for c in df.columns if c not in skip] or list(df.columns)


def hash_key(keys: Sequence[str], seed: int = 42) -> Column:
    """32 hex digits, uniform over the keys and the same at every partitioning."""
    if not keys:
        raise ValueError("a row hash needs a column; see row_keys for tables without a key")
    return F.md5(F.concat_ws("|", F.lit(str(seed)), *[F.coalesce(_text(k), F.lit(NULL_MARK)) for k in keys]))


def row_name(keys: Sequence[str], all_columns: Sequence[str]) -> Column:
    """A row's key as text, or a hash of all its columns where the table has no key."""
    return F.concat_ws("|", *[_text(k) for k in keys]) if keys else hash_key(all_columns)


def _text(name: str) -> Column:
    return col(name).cast("string")
