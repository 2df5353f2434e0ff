"""Connected components of a link table by alternating large-star and small-star rounds.

Every round is a grouped minimum and a join; nothing is gathered per node or on the driver. The
minima are written before they are joined, so that both sides of the join are shuffled and a hub's
links can be split over tasks.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tableloom.llm.common import written


def _fingerprint(links: DataFrame) -> tuple:
    return tuple(links.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first())


def connected_components(links: DataFrame, a: str, b: str) -> DataFrame:
    """``node`` and ``component``, its smallest reachable node, for each node with a link.

    Self-links and repeated links are allowed; a link with a null end is none.
    """
    u, v = F.greatest(a, b), F.least(a, b)
    current = written(
        links.where(F.col(a).isNotNull() & F.col(b).isNotNull() & (F.col(a) != F.col(b)))
        .select(u.alias("u"), v.alias("v")).distinct(), "links")
    state = _fingerprint(current)
    while state[0]:
        current = written(_small_star(written(_large_star(current), "large")), "small")
        after = _fingerprint(current)
        if after == state:
            break
        state = after
    roots = current.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct()
    return current.select(F.col("u").alias("node"), F.col("v").alias("component")).unionByName(roots)


def _large_star(links: DataFrame) -> DataFrame:
    """Link each larger neighbour of a node to the smallest of its neighbours and itself."""
    both = links.unionByName(links.select(F.col("v").alias("u"), F.col("u").alias("v")))
    lowest = written(both.groupBy(F.col("u").alias("x")).agg(F.least(F.col("x"), F.min("v")).alias("low")), "low")
    larger = both.where(F.col("v") > F.col("u"))
    return larger.join(lowest, F.col("u") == F.col("x")).select(F.col("v").alias("u"), F.col("low").alias("v")).distinct()


def _small_star(links: DataFrame) -> DataFrame:
    """Link a node and its smaller neighbours to the smallest of them."""
    lowest = written(links.groupBy(F.col("u").alias("x")).agg(F.min("v").alias("low")), "low")
    moved = links.join(lowest, F.col("u") == F.col("x")).where(F.col("v") != F.col("low"))
    kept = lowest.select(F.col("x").alias("u"), F.col("low").alias("v"))
    return moved.select(F.col("v").alias("u"), F.col("low").alias("v")).unionByName(kept).distinct()
