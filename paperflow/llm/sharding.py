"""Sharding on a consistent-hash ring with virtual nodes and bounded loads.

The ring has ``CELLS`` cells. Every shard owns arcs of cells that start at its virtual nodes.
A document's key hashes to a cell and so to an arc. A shard takes the keys of its own arcs, in
ring order, until it is full; what overflows continues clockwise to the next shard with room.
With ``slack=0`` the capacities add up to the number of rows, so counts are at most one apart.

Only row counts per arc (at most shards x virtual nodes numbers, whatever the input) reach the
driver; ranks inside an arc are counted per cell, so no window holds a whole shard.
"""

from __future__ import annotations

import hashlib
import math

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window

from paperflow.llm.common import staged

CELLS = 1 << 16
VNODES = 64


def ring(shards: int, vnodes: int = VNODES) -> list[tuple[int, int]]:
    """(first cell, shard) of every arc in ring order, from cell 0. Depends on its arguments only."""
    at: dict[int, int] = {}
    for s in range(shards):
        for v in range(vnodes):
            at.setdefault(int(hashlib.sha256(f"{s}/{v}".encode()).hexdigest()[:8], 16) % CELLS, s)
    arcs = sorted(at.items())
    return arcs if arcs[0][0] == 0 else [(0, arcs[-1][1]), *arcs]


def capacities(rows: int, shards: int, slack: float) -> list[int]:
    if slack > 0:
        return [math.ceil((1 + slack) * rows / shards)] * shards
    return [rows // shards + (s < rows % shards) for s in range(shards)]


def spill_clockwise(arcs: list[tuple[int, int]], rows: list[int], caps: list[int]) -> list[list[tuple[int, int]]]:
    """For every arc, (shard, how many of its rows) in rank order. First each shard takes its own
    arcs' rows up to its capacity, then the rest walk clockwise from their arc."""
    room, taken, rest = list(caps), [[] for _ in arcs], []
    for k, (_, s) in enumerate(arcs):
        n = min(rows[k], room[s])
        room[s] -= n
        if n:
            taken[k].append((s, n))
        if rows[k] > n:
            rest.append((k, rows[k] - n))
    for k, left in rest:
        for step in range(1, len(arcs) + 1):
            s = arcs[(k + step) % len(arcs)][1]
            if room[s]:
                n = min(left, room[s])
                room[s] -= n
                left -= n
                taken[k].append((s, n))
            if not left:
                break
    return taken


def shard_rows(docs: DataFrame, shards: int = 16, slack: float = 0.0, vnodes: int = VNODES) -> DataFrame:
    """Place every row: doc_id, size, text_crc32, law, shard, slot, grown_shard, home_shard.

    The key is doc_id with the text's hash, so repeated doc_ids with other texts spread out.
    ``size``: UTF-8 bytes of the text plus 1 (null: 1, checksum 0). Fully equal rows are
    counted together before any window and unfolded after it, so a row repeated a third of the
    time does not load one task; which copy gets which slot makes no difference. ``law`` is
    ``rows``; ``home_shard`` is the shard before any overflow. Null doc_ids are keys like any
    other; an empty table gives no rows; other columns are not read.
    """
    spark = docs.sparkSession
    arcs = ring(shards, vnodes)
    raw = F.coalesce(F.col("text"), F.lit("")).cast("binary")
    keyed = docs.select(
        "doc_id", (F.length(raw) + 1).cast("long").alias("size"), F.crc32(raw).alias("text_crc32"),
        F.xxhash64("doc_id", raw).alias("_key"))
    keyed = keyed.groupBy("doc_id", "size", "text_crc32", "_key").agg(F.count(F.lit(1)).alias("_copies"))
    keyed = staged(keyed.withColumn("_cell", F.pmod("_key", F.lit(CELLS)).cast("int")), "shard-keys")
    starts = F.array(*[F.lit(c) for c, _ in arcs])
    # The number of arcs that start at or before the cell is found once per cell, not per row.
    cells = keyed.groupBy("_cell").agg(F.sum("_copies").alias("_n")).withColumn(
        "_arc", F.size(F.filter(starts, lambda x: x <= F.col("_cell"))) - 1)
    cells = staged(cells.withColumn(
        "_before", F.sum("_n").over(Window.partitionBy("_arc").orderBy("_cell")) - F.col("_n")), "shard-cells")
    counts = {r["_arc"]: r["n"] for r in cells.groupBy("_arc").agg(F.sum("_n").alias("n")).collect()}
    rows = [counts.get(k, 0) for k in range(len(arcs))]
    taken = spill_clockwise(arcs, rows, capacities(sum(rows), shards, slack))
    used, plan = [0] * shards, []
    for k, parts in enumerate(taken):
        upto, segments = 0, []
        for s, n in parts:
            segments.append((upto, upto + n, s, used[s]))
            used[s] += n
            upto += n
        plan.append((k, arcs[k][1], segments))
    plan = spark.createDataFrame(
        plan, "_arc int, _home int, _segments array<struct<first: long, upto: long, shard: int, slot: long>>")
    by_cell = cells.join(plan, "_arc").select("_cell", "_before", "_home", "_segments")
    in_cell = Window.partitionBy("_cell").orderBy("_key", "doc_id", "text_crc32", "size")
    ranked = keyed.withColumn("_rank", F.sum("_copies").over(in_cell) - F.col("_copies")).join(by_cell, "_cell")
    each = ranked.withColumn("_rank", F.explode(F.sequence(
        F.col("_before") + F.col("_rank"), F.col("_before") + F.col("_rank") + F.col("_copies") - 1)))
    mine = F.element_at(F.filter("_segments", lambda x: (x["first"] <= F.col("_rank")) & (F.col("_rank") < x["upto"])), 1)
    return each.withColumn("_to", mine).select(
        "doc_id", "size", "text_crc32", F.lit("rows").alias("law"), F.col("_to.shard").alias("shard"),
        (F.col("_to.slot") + F.col("_rank") - F.col("_to.first")).alias("slot"),
        F.lit(None).cast("int").alias("grown_shard"), F.col("_home").alias("home_shard"))
