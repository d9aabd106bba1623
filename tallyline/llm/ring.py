"""Shards by a consistent-hash ring with virtual nodes and bounded loads.

The ring is cut into ``CELLS`` equal cells. Each shard has ``VIRTUAL`` places on it; a key
belongs to the first place clockwise from its cell. A shard takes no more rows than its share,
so keys that find a full shard continue clockwise to the next that has room. Shares add up to
the number of rows, hence counts differ by one at most, and a further shard moves only the keys
of its arcs and what these displace.

Only the counts per cell reach the driver (``CELLS`` numbers, whatever the input). They decide
which ranks of a cell go to which shard and slot. Rows are ranked within their cell, so no
shard is gathered in a task. Rows with equal ids share a cell and are ranked by text and size.

A null id is a key like any other. Null texts have the size 16 and the checksum of no bytes.
"""

from __future__ import annotations

from bisect import bisect_left

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window
from xxhash import xxh3_64_intdigest

BITS = 16
CELLS, VIRTUAL = 1 << BITS, 64


def places(shards: int, virtual: int = VIRTUAL) -> list[tuple[int, int]]:
    """``(cell, shard)`` of all virtual nodes, in the order of the ring; ties by shard."""
    return sorted((xxh3_64_intdigest(f"{s}/{v}".encode()) % CELLS, s) for s in range(shards) for v in range(virtual))


def plan(counts: dict[int, int], shards: int, virtual: int = VIRTUAL) -> list[tuple[int, int, int, int, int]]:
    """``(cell, first rank, rank after, shard, slot of the first)`` for the rows of each cell."""
    total = sum(counts.values())
    room = [total // shards + (s < total % shards) for s in range(shards)]
    used = [0] * shards
    ring = places(shards, virtual)
    cells = [c for c, _ in ring]
    out = []
    for cell in sorted(counts):
        rank, left = 0, counts[cell]
        at = bisect_left(cells, cell)
        while left:
            s = ring[at % len(ring)][1]
            if take := min(left, room[s] - used[s]):
                out.append((cell, rank, rank + take, s, used[s]))
                used[s] += take
                rank, left = rank + take, left - take
            at += 1
    return out


def assign(spark: SparkSession, docs: DataFrame, shards: int, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``id, size, text_crc32, shard, slot`` of every row."""
    data = F.coalesce(F.col(text_col), F.lit("")).cast("binary")
    name = F.coalesce(F.col(id_col).cast("string"), F.lit("\x00"))
    cell = F.shiftrightunsigned(F.xxhash64(name), 64 - BITS)
    counts = docs.select(cell.alias("cell")).groupBy("cell").agg(F.count("*").alias("n"))
    steps = plan({r.cell: r.n for r in counts.collect()}, shards)
    steps = spark.createDataFrame(steps or [(0, 0, 0, 0, 0)], "cell long, low long, high long, shard int, start long")
    rows = docs.select(
        F.col(id_col).alias("id"),
        (F.octet_length(data) + 16).cast("long").alias("size"),
        F.crc32(data).alias("text_crc32"),
        cell.alias("cell"),
        F.xxhash64(name).alias("place"),
    )
    rank = F.row_number().over(Window.partitionBy("cell").orderBy("place", "id", "text_crc32", "size")) - 1
    rows = rows.withColumn("rank", rank)
    # The plan has at most a row per cell and per shard that fills up: it is small at any size.
    return rows.join(F.broadcast(steps), "cell").where("rank >= low and rank < high").select(
        "id", "size", "text_crc32", "shard", (F.col("start") + F.col("rank") - F.col("low")).cast("long").alias("slot")
    )
