"""Duplicate removal on a stream: keyed state that survives restarts and, with an event time, expires."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame


def first_rows(stream: DataFrame, columns: Sequence[str], time: str | None = None, expiry: str | None = None) -> DataFrame:
    """Keep the first row that arrives for each combination of the columns, missing values being equal.

    State is kept by key over micro-batches and in the checkpoint of the query. With an event ``time`` and an
    ``expiry`` a key is forgotten once the watermark, the latest time less the expiry, has passed its first row by
    the expiry: a later row with that key counts as new, and rows older than the watermark are dropped. Without
    them every key is kept for good.
    """
    missing = [c for c in [*columns, *([time] if time else [])] if c not in stream.columns]
    if missing:
        raise ValueError(f"no columns {missing} in the stream; available: {', '.join(stream.columns)}")
    if (time is None) != (expiry is None):
        raise ValueError("an expiry needs an event time, and an event time an expiry")
    if time is None:
        return stream.dropDuplicates(list(columns))
    return stream.withWatermark(time, expiry).dropDuplicatesWithinWatermark(list(columns))
