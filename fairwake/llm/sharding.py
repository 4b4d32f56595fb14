"""Consistent-hash ring with virtual nodes and bounded loads.

Each shard owns many virtual nodes on a ring of slots; the arc that ends at a virtual node
belongs to it. A row's id hashes to a slot, so to an arc, so to its home shard. A shard
takes home rows up to its capacity; rows that find their home full continue clockwise to
the next virtual node whose shard has room. With no slack the capacities add up to the
number of rows, so counts are at most one apart, and only rows beyond a shard's capacity
are away from home.

What happens to a row depends only on its rank within its arc, and on the number of rows of
each arc. So the walk is done on the counts (as many as virtual nodes, whatever the size of
the table) and gives ranges of ranks; rows then look up the range they are in. Rows are
shuffled once, without their texts, by range of (arc, hash, row number). Row numbers make
all keys different, so a range never has to hold all copies of a repeated id.

NULL ids share one place on the ring, NULL texts have no bytes, an empty table gives an
empty result. Repeated rows are placed one by one. Other columns are ignored.
"""

from __future__ import annotations

import hashlib
from typing import NamedTuple

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fairwake.llm.common import text_of, written

RING = 1 << 16
REPLICAS = 64
IN_PARTITION = (1 << 33) - 1  # monotonically_increasing_id: partition << 33 | number


def virtual_nodes(shards: int, replicas: int = REPLICAS, ring: int = RING) -> list[tuple[int, int]]:
    """(slot, shard) of all virtual nodes around the ring.

    A node's slot depends on its shard and number alone; should it be taken, the node with
    the higher shard tries again, so nodes stay where they were when a shard is added.
    """
    taken: dict[int, int] = {}
    for shard in range(shards):
        for replica in range(replicas):
            attempt = 0
            while True:
                name = f"{shard}/{replica}/{attempt}".encode()
                slot = int.from_bytes(hashlib.blake2b(name, digest_size=8).digest(), "big") % ring
                if slot not in taken:
                    break
                attempt += 1
            taken[slot] = shard
    return sorted(taken.items())


class Span(NamedTuple):
    """Rows of an arc with ranks from `first` to before `end` are in `shard`, from `slot` on."""

    arc: int
    first: int
    end: int
    shard: int
    slot: int


def capacities(rows: int, shards: int, slack: float = 0.0) -> list[int]:
    if slack:
        return [-int(-(1 + slack) * rows // shards)] * shards
    return [rows // shards + (s < rows % shards) for s in range(shards)]


def walk(counts: list[int], owners: list[int], limits: list[int]) -> list[Span]:
    """Place all arcs' rows: home shards first, then clockwise to those with room."""
    used, spans, waiting = [0] * len(limits), [], []

    def take(arc: int, first: int, rows: int, shard: int) -> int:
        taken = min(rows, limits[shard] - used[shard])
        if taken > 0:
            spans.append(Span(arc, first, first + taken, shard, used[shard]))
            used[shard] += taken
        return max(taken, 0)

    for arc, rows in enumerate(counts):
        taken = take(arc, 0, rows, owners[arc])
        if taken < rows:
            waiting.append((arc, taken))
    for arc, first in waiting:
        node = arc
        while first < counts[arc]:
            node = (node + 1) % len(owners)
            first += take(arc, first, counts[arc] - first, owners[node])
    return spans


def shard_rows(
    docs: DataFrame,
    shards: int,
    id_column: str = "doc_id",
    text_column: str = "text",
    replicas: int = REPLICAS,
    slack: float = 0.0,
) -> DataFrame:
    """One row per document: doc_id, size, text_crc32, home_shard, shard, slot.

    `slot` numbers the rows of a shard from 0 without gaps.
    """
    spark = docs.sparkSession
    nodes = virtual_nodes(shards, replicas)
    owners = [shard for _, shard in nodes]

    # slot of the ring -> arc; as many rows as the ring has slots
    arcs, arc = [], 0
    for slot in range(RING):
        while arc < len(nodes) and nodes[arc][0] < slot:
            arc += 1
        arcs.append((slot, arc % len(nodes)))
    ring = spark.createDataFrame(arcs, "ring_slot int, arc int")

    hashed = F.xxhash64(F.lit("ring"), F.col(id_column))
    rows = written(
        docs.select(
            F.col(id_column).alias("doc_id"),
            (F.octet_length(text_of(text_column)) + F.lit(1)).cast("long").alias("size"),
            F.crc32(text_of(text_column).cast("binary")).alias("text_crc32"),
            hashed.alias("hash"),
            F.pmod(hashed, F.lit(RING)).cast("int").alias("ring_slot"),
            F.monotonically_increasing_id().alias("row"),
        )
        .join(F.broadcast(ring), "ring_slot")
        .drop("ring_slot"),
        "ring-rows",
    )
    ordered = written(
        rows.repartitionByRange("arc", "hash", "row")
        .sortWithinPartitions("arc", "hash", "row")
        .withColumn("place", F.monotonically_increasing_id())
        .select(
            "doc_id",
            "size",
            "text_crc32",
            "arc",
            F.shiftrightunsigned("place", 33).alias("part"),
            F.col("place").bitwiseAND(F.lit(IN_PARTITION)).alias("number"),
        ),
        "ring-order",
    )
    # an arc lies in consecutive partitions: partitions + arcs rows
    pieces = written(
        ordered.groupBy("arc", "part").agg(F.count(F.lit(1)).alias("rows"), F.min("number").alias("lowest")),
        "ring-pieces",
    )
    counts = [0] * len(nodes)
    for found in pieces.groupBy("arc").agg(F.sum("rows").alias("rows")).collect():
        counts[found["arc"]] = found["rows"]
    spans = walk(counts, owners, capacities(sum(counts), shards, slack))

    by_arc: dict[int, list[Span]] = {}
    for span in spans:
        by_arc.setdefault(span.arc, []).append(span)
    ranges = spark.createDataFrame(
        [(a, owners[a], [tuple(s)[1:] for s in found]) for a, found in by_arc.items()],
        "arc int, home_shard int, spans array<struct<first:bigint,end:bigint,shard:int,slot:bigint>>",
    )
    starts = pieces.selectExpr(
        "arc",
        "part",
        "coalesce(sum(rows) OVER (PARTITION BY arc ORDER BY part"
        " ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) - lowest AS base",
    )
    rank = F.col("number") + F.col("base")
    return (
        ordered.join(F.broadcast(starts), ["arc", "part"])
        .join(F.broadcast(ranges), "arc")
        .withColumn("rank", rank)
        .withColumn(
            "span", F.get(F.filter("spans", lambda s: (F.col("rank") >= s["first"]) & (F.col("rank") < s["end"])), F.lit(0))
        )
        .select(
            "doc_id",
            "size",
            "text_crc32",
            "home_shard",
            F.col("span.shard").alias("shard"),
            (F.col("span.slot") + F.col("rank") - F.col("span.first")).alias("slot"),
        )
    )
