"""Sharding on a consistent-hash ring with virtual nodes and bounded loads.

Every shard stands at many places of the ring; the arc before a place belongs to its shard. A row's
point on the ring comes from its key, size and checksum. Shards have capacities that sum to the rows
(with slack 0, so counts differ by at most one) and the rows of an arc that overflow its full shard go on
clockwise to the next shards with room.

Only counts per arc, a number fixed by the ring, reach the driver. There each arc's rows, in the order of
their hashes, become stretches of ranks with a shard and a first slot. A row's rank in its arc is
its rank in a small bucket of the arc plus the rows of the buckets before, so no task orders a whole
shard or arc, and slots are gapless. Repeated rows are counted, ranked as one and made again.

Defined cases: a null text has no bytes; a null key is a key of its own; repeated rows share a point and
take neighbouring ranks; fewer rows than shards leave shards empty; an empty table gives an empty table.
"""

from __future__ import annotations

import hashlib
import math

import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tableloom.llm.common import written
from tableloom.session import local_table

SHARDS = 24
PLACES = 64
ROW_OVERHEAD = 8
BUCKET_ROWS = 50_000
COPIES_AT_ONCE = 10_000
#: Points of the ring, and how many equal parts of it are looked up before the places inside one.
RING = 1 << 32
PARTS_LOG = 12
PARTS = 1 << PARTS_LOG


def ring(shards: int, places: int = PLACES) -> list[tuple[int, int]]:
    """Sorted (point, shard) of every virtual node; the arc that ends at a node is the node's."""
    points: dict[int, int] = {}
    for shard in range(shards):
        for place in range(places):
            point = int.from_bytes(hashlib.sha256(f"{shard}/{place}".encode()).digest()[:4])
            while point in points:
                point = (point + 1) % RING
            points[point] = shard
    return sorted(points.items())


def capacities(rows: int, shards: int, slack: float = 0.0) -> list[int]:
    """At slack 0 the capacities are the rows dealt evenly; else each is the mean plus that share."""
    if slack <= 0:
        return [rows // shards + (s < rows % shards) for s in range(shards)]
    return [math.ceil(rows / shards * (1 + slack))] * shards


def deal(counts: list[int], nodes: list[tuple[int, int]], room: list[int]) -> list[tuple[int, int, int, int, int]]:
    """(arc, first rank, end rank, shard, first slot) of every stretch.

    Every arc first fills its own shard; then the rows left over go on clockwise, one place a turn.
    """
    free, used = list(room), [0] * len(room)
    left, taken = list(counts), [0] * len(counts)
    stretches = []
    for turn in range(len(nodes)):
        if not any(left):
            break
        for arc in range(len(nodes)):
            shard = nodes[(arc + turn) % len(nodes)][1]
            n = min(left[arc], free[shard])
            if n:
                stretches.append((arc, taken[arc], taken[arc] + n, shard, used[shard]))
                free[shard] -= n
                used[shard] += n
                taken[arc] += n
                left[arc] -= n
    return stretches


def shard_rows(docs: DataFrame, shards: int = SHARDS, key: str = "doc_id", text: str = "text", slack: float = 0.0,
               places: int = PLACES, bucket_rows: int = BUCKET_ROWS) -> DataFrame:
    """Per row: key, ``size``, ``text_crc32``, ``shard`` and ``slot``."""
    spark, nodes = docs.sparkSession, ring(shards, places)
    body = F.coalesce(F.col(text), F.lit(""))
    sized = docs.select(
        F.col(key).alias("key"), (F.octet_length(body) + ROW_OVERHEAD).cast("long").alias("size"), F.crc32(body).alias("crc"),
    )
    hashed = sized.withColumn("order", F.xxhash64("key", "size", "crc"))
    starts = local_table(
        spark, _prefix=pa.array(range(PARTS), pa.int64()),
        _first=pa.array(_first_places(nodes, PARTS), pa.list_(pa.int64())),
    )
    point = F.pmod("order", F.lit(RING))
    placed = (
        hashed.withColumn("point", point)
        .join(F.broadcast(starts), F.shiftrightunsigned("point", 32 - PARTS_LOG) == F.col("_prefix"))
        .withColumn("arc", (F.get("_first", F.lit(0)) + F.size(F.filter(
            F.slice("_first", F.lit(2), F.size("_first") - 1), lambda p: p < F.col("point")))) % len(nodes))
    )
    rows = written(placed.select("key", "size", "crc", "order", "arc"), "placed")
    counted = {r["arc"]: r["n"] for r in rows.groupBy("arc").agg(F.count(F.lit(1)).alias("n")).collect()}
    counts = [counted.get(arc, 0) for arc in range(len(nodes))]
    total = sum(counts)
    parts = max(1, math.ceil(total / len(nodes) / bucket_rows))
    height = F.shiftrightunsigned("order", 32)
    copies = rows.groupBy("key", "size", "crc", "order", "arc").agg(F.count(F.lit(1)).alias("copies"))
    bucketed = copies.withColumn("bucket", F.floor(height * parts / RING).cast("int"))
    sizes = rows.groupBy(F.col("arc").alias("_arc"), F.floor(height * parts / RING).cast("int").alias("_bucket")).agg(F.count(F.lit(1)).alias("n"))
    earlier = Window.partitionBy("_arc").orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)
    shifts = written(sizes.select("_arc", "_bucket", F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("shift")), "shifts")
    ahead = Window.partitionBy("arc", "bucket").orderBy(height, "order", "key", "size", "crc").rowsBetween(Window.unboundedPreceding, -1)
    ordered = written(
        bucketed.withColumn("within", F.coalesce(F.sum("copies").over(ahead), F.lit(0)))
        .join(shifts, (F.col("arc") == F.col("_arc")) & (F.col("bucket") == F.col("_bucket")))
        .select("key", "size", "crc", "arc", "copies", (F.col("within") + F.col("shift")).alias("rank")), "ranked")
    ranked = ordered.where(F.col("copies") == 1).drop("copies").unionByName(_each_copy(ordered.where(F.col("copies") > 1)))
    by_arc: dict[int, list[dict]] = {}
    for arc, first, end, shard, slot in deal(counts, nodes, capacities(total, shards, slack)):
        by_arc.setdefault(arc, []).append({"first": first, "end": end, "shard": shard, "slot": slot})
    kind = pa.list_(pa.struct([("first", pa.int64()), ("end", pa.int64()), ("shard", pa.int32()), ("slot", pa.int64())]))
    stretches = local_table(spark, _ring=pa.array(list(by_arc), pa.int32()), _stretches=pa.array(list(by_arc.values()), kind))
    own = F.get(F.filter("_stretches", lambda s: (s.getField("first") <= F.col("rank")) & (F.col("rank") < s.getField("end"))), F.lit(0))
    return (
        ranked.join(F.broadcast(stretches), F.col("arc") == F.col("_ring"))
        .withColumn("_own", own)
        .select(
            F.col("key").alias(key), "size", F.col("crc").alias("text_crc32"), F.col("_own.shard").alias("shard"),
            (F.col("_own.slot") + F.col("rank") - F.col("_own.first")).alias("slot"),
        )
    )


def _each_copy(ordered: DataFrame) -> DataFrame:
    """One row per copy, with its own rank; many copies are spread over tasks before they are made."""
    part = F.explode(F.sequence(F.lit(0).cast("long"), F.floor((F.col("copies") - 1) / COPIES_AT_ONCE)))
    spread = ordered.withColumn("part", part).repartition("key", "part")
    first = F.col("part") * COPIES_AT_ONCE
    copy = F.explode(F.sequence(first, F.least(first + COPIES_AT_ONCE, F.col("copies")) - 1))
    return spread.withColumn("copy", copy).select("key", "size", "crc", "arc", (F.col("rank") + F.col("copy")).alias("rank"))


def _first_places(nodes: list[tuple[int, int]], prefixes: int) -> list[list[int]]:
    """Per prefix of the ring: the first place in or after it, then the points of the places inside."""
    width, out, at = RING // prefixes, [], 0
    for prefix in range(prefixes):
        inside = []
        first = at
        while at < len(nodes) and nodes[at][0] < (prefix + 1) * width:
            inside.append(nodes[at][0])
            at += 1
        out.append([first, *inside])
    return out
