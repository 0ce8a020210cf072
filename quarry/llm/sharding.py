"""Sharding by a consistent-hash ring with virtual nodes and bounded loads.

Every shard owns ``vnodes`` points of a ring; a document belongs to the first point at or
after its hash.  A shard takes no more than its share of the rows: keys that overflow a full
shard continue clockwise to the next point whose shard has room.  That walk is planned on the
counts per arc (at most shards x vnodes numbers, whatever the input), and documents take the
planned places by joining on their rank within the arc.
"""

from __future__ import annotations

import hashlib
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quarry.llm.shared import rank_within, text_of

#: Positions on the ring; a power of two, and the bound on the broadcast lookup table.
POSITIONS = 1 << 16


@dataclass(frozen=True)
class Ring:
    """Points in ring order: (position, shard)."""

    points: tuple[tuple[int, int], ...]

    @staticmethod
    def of(shards: int, vnodes: int = 128) -> Ring:
        """Points are distinct: one that falls on a taken position moves to the next free one."""
        if shards * vnodes > POSITIONS:
            raise ValueError(f"at most {POSITIONS} points fit on the ring")
        taken: dict[int, int] = {}
        for shard in range(shards):
            for v in range(vnodes):
                at = int.from_bytes(hashlib.sha256(f"{shard}/{v}".encode()).digest()[:4], "little") % POSITIONS
                while at in taken:
                    at = (at + 1) % POSITIONS
                taken[at] = shard
        return Ring(tuple(sorted(taken.items())))

    def arcs(self) -> list[int]:
        """For each position, the index of the first point at or after it (clockwise)."""
        out, k = [], 0
        for at in range(POSITIONS):
            while k < len(self.points) and self.points[k][0] < at:
                k += 1
            out.append(k % len(self.points))
        return out


def place(ring: Ring, counts: dict[int, int], room: list[int]) -> list[tuple[int, int, int, int, int]]:
    """Runs (arc, first rank, end rank, shard, first slot) that place ``counts`` keys of each
    arc: a point's shard takes them while it has room, and the rest goes on clockwise.
    Every run ends an arc or fills a shard, so there are at most arcs + shards of them."""
    room, slot = list(room), [0] * len(room)
    n, runs, left = len(ring.points), [], {}

    def take(arc: int, begin: int, want: int, shard: int) -> int:
        got = min(want, room[shard])
        if got:
            runs.append((arc, begin, begin + got, shard, slot[shard]))
            room[shard] -= got
            slot[shard] += got
        return got

    for arc in range(n):  # first every shard serves its own arcs
        want = counts.get(arc, 0)
        got = take(arc, 0, want, ring.points[arc][1])
        if got < want:
            left[arc] = got
    for arc, begin in left.items():  # then overflowing keys continue clockwise
        at = arc
        while begin < counts[arc]:
            at = (at + 1) % n
            begin += take(arc, begin, counts[arc] - begin, ring.points[at][1])
    return runs


def shard_documents(docs: DataFrame, shards: int = 24, vnodes: int = 128) -> DataFrame:
    """One row per row of ``docs`` (doc_id, text): doc_id, size, text_crc32, law, shard, slot,
    grown_shard, home_shard (the owner of the document's arc, before bounds).

    Law ``rows``: with loads bounded by the exact share of each shard, counts differ by at
    most one; ``grown_shard`` is null then.  Size is the UTF-8 bytes of the text (null: none)
    plus 8.  A null doc_id hashes like any key; rows that repeat a doc_id are placed one by
    one; equal texts have no say.  Slots count from 0 in each shard without gaps.  An empty
    table gives no rows.  Building the frame counts the rows of each arc."""
    spark = docs.sparkSession
    ring = Ring.of(shards, vnodes)
    lookup = spark.createDataFrame(list(enumerate(ring.arcs())), "at int, arc int")
    keyed = docs.select(
        "doc_id",
        (F.octet_length(text_of()) + F.lit(8)).cast("long").alias("size"),
        F.crc32(text_of().cast("binary")).alias("text_crc32"),
        F.pmod(F.xxhash64("doc_id"), F.lit(POSITIONS)).cast("int").alias("at"),
    )
    on_ring = keyed.join(F.broadcast(lookup), "at")  # POSITIONS rows at most
    counts = {r.arc: r.n for r in on_ring.groupBy("arc").agg(F.count(F.lit(1)).alias("n")).collect()}  # one row per arc
    total = sum(counts.values())
    room = [total // shards + (s < total % shards) for s in range(shards)]
    runs = spark.createDataFrame(place(ring, counts, room), "run_arc int, begin long, end long, shard int, first_slot long")
    ranked = rank_within(on_ring, "arc", ["at", "doc_id", "size", "text_crc32"])
    homes = F.array(*[F.lit(s) for _, s in ring.points])
    placed = ranked.join(
        F.broadcast(runs),  # arcs + shards rows at most
        (F.col("arc") == F.col("run_arc")) & (F.col("rank") >= F.col("begin")) & (F.col("rank") < F.col("end")),
    )
    return placed.select(
        "doc_id",
        "size",
        "text_crc32",
        F.lit("rows").alias("law"),
        "shard",
        (F.col("first_slot") + F.col("rank") - F.col("begin")).alias("slot"),
        F.lit(None).cast("int").alias("grown_shard"),
        F.element_at(homes, F.col("arc") + 1).alias("home_shard"),
    )
