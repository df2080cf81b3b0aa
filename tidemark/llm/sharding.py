"""Sharding on a consistent-hash ring with virtual nodes and bounded loads."""

from __future__ import annotations

import hashlib
from collections import deque
from fractions import Fraction

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm.common import materialise, running_total, table

SHARDS = 16
#: Virtual nodes of a shard.
NODES = 128
#: What a shard may hold above an equal share.
SLACK = Fraction(1, 1000)
#: The ring has two to this power places; a key's place is the top of its hash.
RING = 16


def ring(shards: int, nodes: int = NODES, seed: int = 1) -> list[tuple[int, int]]:
    """(place, shard) of every virtual node in clockwise order. Nodes of other shards stay where they are if one comes."""
    name = lambda s, v: hashlib.md5(f"{seed}:{s}:{v}".encode()).hexdigest()
    found = sorted((int(name(s, v)[:8], 16) >> (32 - RING), name(s, v), s) for s in range(shards) for v in range(nodes))
    return [(place, shard) for place, _, shard in found]


def arcs(nodes: list[tuple[int, int]]) -> list[int]:
    """For each place of the ring the node that follows it clockwise, itself included."""
    out, at = [], 0
    for place in range(1 << RING):
        while at < len(nodes) and nodes[at][0] < place:
            at += 1
        out.append(at % len(nodes))
    return out


def flow(owners: list[int], spans: dict[int, list[tuple[int, int]]], shards: int, most: int) -> list[tuple[int, int, int]]:
    """(from, to, shard) for every stretch of the ring's running total.

    Clockwise, each node takes the stretch that ends at it and then what has come from before, until its shard holds
    ``most``; the rest continues. Where all shards can hold everything two rounds are enough.
    """
    load, carried, out = [0] * shards, deque(), []
    for lap in range(2):
        for node, shard in enumerate(owners):
            if lap == 0:
                carried.extendleft(reversed(spans.get(node, [])))
            while carried and load[shard] < most:
                a, b = carried.popleft()
                cut = min(b, a + most - load[shard])
                out.append((a, cut, shard))
                load[shard] += cut - a
                if cut < b:
                    carried.appendleft((cut, b))
    return sorted(out)


def sharded(
    docs: DataFrame,
    shards: int = SHARDS,
    nodes: int = NODES,
    slack: Fraction = SLACK,
    seed: int = 1,
    doc_id: str = "doc_id",
    text: str = "text",
) -> DataFrame:
    """One row for each row of ``docs``: id, size, text_crc32, shard, slot.

    A key is a text: its hash is a place on the ring, so equal texts stand together and go to one shard while that has
    room. Size is the UTF-8 length plus one. A shard holds at most an equal share of all bytes and ``slack``; where
    it is full, the keys of its arcs continue clockwise to the next shard with room, row by row. Only the row that
    crosses the border may pass it. Bytes before each row on the ring come from a distributed running total, those of
    arcs (``shards * nodes`` of them) are all that reaches the driver, and the plan has at most three times as many
    stretches. Slots count a shard's rows from zero in ring order.

    Null texts are as long as empty ones, with the same checksum, but are another key. Rows that repeat stand next to
    each other; null ids come first among equal texts. An empty table gives an empty result. Other columns aren't read.
    """
    spark = docs.sparkSession
    raw = F.coalesce(F.col(text).cast("binary"), F.lit(b""))
    rows = docs.select(
        F.col(doc_id).alias("id"),
        (F.length(raw) + 1).cast("long").alias("size"),
        F.crc32(raw).alias("text_crc32"),
        F.xxhash64(F.col(text).isNull(), F.col(text)).alias("hash"),
    )
    # The hash as an unsigned number: its top places the key.
    rows = rows.withColumn("place", F.shiftrightunsigned("hash", 64 - RING).cast("int"))
    placed = materialise(running_total(rows, ["place", "hash", "id", "text_crc32"], "size", "ring-order"), "ring")

    circle = ring(shards, nodes, seed)
    owners = [shard for _, shard in circle]
    # As many rows as the ring has places.
    of_place = spark.createDataFrame(list(enumerate(arcs(circle))), "place int, node int")
    sums = placed.groupBy("place").agg(F.min("before").alias("a"), F.sum("size").alias("n")).join(F.broadcast(of_place), "place")
    # The first node's arc has a part on either side of zero.
    sums = sums.groupBy("node", (F.col("place") > circle[-1][0]).alias("wrapped")).agg(F.min("a").alias("a"), F.sum("n").alias("n"))
    spans: dict[int, list[tuple[int, int]]] = {}
    for r in sorted(sums.collect(), key=lambda r: (r["node"], not r["wrapped"])):
        spans.setdefault(r["node"], []).append((r["a"], r["a"] + r["n"]))
    total = sum(b - a for parts in spans.values() for a, b in parts)
    most = -(-total * (1 + slack) // shards)
    stretches = flow(owners, spans, shards, int(most))

    # Stretches are looked up by the piece of the running total that a row begins in: one sorted list, bounded as above.
    starts = [a for a, _, _ in stretches] or [0]
    index = _index(starts, max(1, total))
    plan = spark.createDataFrame(
        [(i, [list(stretches[k]) for k in found if stretches]) for i, found in index.items()], "part int, found array<array<long>>"
    )
    width = -(-max(1, total) // PARTS)
    mine = F.filter("found", lambda s: (s[0] <= F.col("before")) & (F.col("before") < s[1]))
    given = placed.join(F.broadcast(plan), F.floor(F.col("before") / width).cast("int") == F.col("part"))
    given = given.select("id", "size", "text_crc32", "before", F.get(F.get(mine, F.lit(0)), F.lit(2)).cast("int").alias("shard"), F.lit(1).alias("one"))
    numbered = running_total(given, ["shard", "before"], "one", "shard-order", "rank")
    firsts = F.broadcast(numbered.groupBy("shard").agg(F.min("rank").alias("first")))
    return numbered.join(firsts, "shard").select("id", "size", "text_crc32", "shard", (F.col("rank") - F.col("first")).alias("slot"))


#: Equal pieces of the running total, for looking stretches up.
PARTS = 4096


def _index(starts: list[int], total: int) -> dict[int, list[int]]:
    """Which stretches touch each of the pieces."""
    width, out, at = -(-total // PARTS), {}, 0
    for part in range(-(-total // width)):
        low, high = part * width, (part + 1) * width
        while at + 1 < len(starts) and starts[at + 1] <= low:
            at += 1
        k = at
        out[part] = [k]
        while k + 1 < len(starts) and starts[k + 1] < high:
            k += 1
            out[part].append(k)
    return out


def op5_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return sharded(docs).select(
        F.col("id").alias("doc_id"), "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot",
        F.lit(None).cast("int").alias("grown_shard"),
    )
