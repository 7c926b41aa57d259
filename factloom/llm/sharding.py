"""Sharding by a consistent-hash ring with virtual nodes and bounded loads.

Every shard owns ``virtual_nodes`` points on a ring; a key starts at the first
point clockwise of its hash and, where that shard is full, continues clockwise
to the next one.  Loads are bounded by floor or ceil of rows / shards, so row
counts are at most one apart (law ``rows``) and only the overflow moves.

All keys between two neighbouring points (an arc) meet the shards in the same
order, so the placing needs counts per arc, not rows.  Equal hash cells are cut
at the points, so a cell lies in one arc; the driver sees at most ``cells`` counts
and one a point (a bounded number), runs the
clockwise rounds on them and returns, per cell, rank ranges for each shard.
Rows are then ranked inside their (cell, salt) only, after the rows of the cell's
smaller salts; salts come from the row's hash and grow in number with the rows, so
neither one cell nor one id that a third of all rows share meets in one task.

Defined cases: a null text has size 1 and crc 0; a null key hashes like the
empty string; repeated rows are separate rows and are ordered by their columns
(identical rows are interchangeable); a text of any length counts whole; an empty
table gives an empty result; other columns of the input are not read.
"""

from __future__ import annotations

import bisect
import hashlib

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

CELLS = 4096
HASH_BITS = 32
NODES = 1 << 10  # more points than that never fall into one cell
GROUP_ROWS = 1 << 20


def ring(shards: int, virtual_nodes: int) -> list[tuple[int, int]]:
    points = {}
    for shard in range(shards):
        for node in range(virtual_nodes):
            at = int.from_bytes(hashlib.md5(f"shard-{shard}/{node}".encode()).digest()[:4], "big")
            points.setdefault(at, shard)
    return sorted(points.items())


def clockwise(points: list[tuple[int, int]], position: int, shards: int) -> list[int]:
    """Distinct shards in the order a key at ``position`` meets them."""
    at, order = bisect.bisect_left(points, (position, -1)), []
    for k in range(len(points)):
        shard = points[(at + k) % len(points)][1]
        if shard not in order:
            order.append(shard)
            if len(order) == shards:
                break
    return order


def nodes_by_cell(points: list[tuple[int, int]], cells: int) -> dict[int, list[int]]:
    """The ring's points inside each hash cell that has any."""
    width, out = (1 << HASH_BITS) // cells, {}
    for at, _ in points:
        out.setdefault(at // width, []).append(at)
    return out


def place(counts: dict[int, int], shards: int, virtual_nodes: int, cells: int = CELLS) -> list[tuple[int, int, int, int, int]]:
    """(cell, first rank, count, shard, first slot): bounded-load rounds on cell counts.

    A cell is a hash cell times ``NODES`` plus the number of points before it there.
    In round r every unplaced key of a cell asks the r-th shard on its way; a
    shard takes keys in clockwise order of the cells until it is full.
    """
    total = sum(counts.values())
    room = [total // shards + (s < total % shards) for s in range(shards)]
    used = [0] * shards
    points = ring(shards, virtual_nodes)
    width, nodes = (1 << HASH_BITS) // cells, nodes_by_cell(points, cells)
    first = {c: c // NODES * width if c % NODES == 0 else nodes[c // NODES][c % NODES - 1] + 1 for c in counts}
    way = {c: clockwise(points, at, shards) for c, at in first.items()}
    placed = {c: 0 for c in counts}
    out = []
    for turn in range(shards):
        for cell in sorted(counts):
            left = counts[cell] - placed[cell]
            shard = way[cell][turn] if turn < len(way[cell]) else turn
            take = min(left, room[shard] - used[shard])
            if take > 0:
                out.append((cell, placed[cell], take, shard, used[shard]))
                placed[cell] += take
                used[shard] += take
    for cell in sorted(counts):  # only where shards own no point of the ring
        for shard in range(shards):
            take = min(counts[cell] - placed[cell], room[shard] - used[shard])
            if take > 0:
                out.append((cell, placed[cell], take, shard, used[shard]))
                placed[cell] += take
                used[shard] += take
    return out


def shard_rows(
    docs: DataFrame, key: str = "doc_id", text: str = "text", shards: int = 8, virtual_nodes: int = 64, cells: int = CELLS, group_rows: int = GROUP_ROWS
) -> DataFrame:
    """(key, size, text_crc32, shard, slot) for every row of ``docs``."""
    spark = docs.sparkSession
    width = (1 << HASH_BITS) // cells
    body = F.encode(F.coalesce(docs[text], F.lit("")), "UTF-8")
    position = F.conv(F.substring(F.md5(F.coalesce(docs[key].cast("string"), F.lit(""))), 1, 8), 16, 10).cast("long")
    nodes = nodes_by_cell(ring(shards, virtual_nodes), cells)
    rows = docs.select(docs[key].alias(key), (F.length(body) + 1).cast("long").alias("size"), F.crc32(body).alias("text_crc32"), position.alias("position"))
    cut = spark.createDataFrame(sorted(nodes.items()), "node_cell int, nodes array<long>")  # the ring's points: a fixed number
    hashed = F.floor(F.col("position") / width).cast("int")
    rows = rows.join(F.broadcast(cut), hashed == F.col("node_cell"), "left")
    passed = F.coalesce(F.size(F.filter("nodes", lambda p: p < F.col("position"))), F.lit(0))
    rows = rows.withColumn("cell", hashed * NODES + F.when(F.col("nodes").isNull(), 0).otherwise(passed)).drop("nodes", "node_cell")
    counts = {r["cell"]: r["n"] for r in rows.groupBy("cell").agg(F.count("*").alias("n")).collect()}  # a bounded number
    # large cells are ranked in salts; the number of groups is rows / group_rows and one a cell
    large = [(c, -(-n // group_rows)) for c, n in counts.items() if n > group_rows]
    salts = F.broadcast(spark.createDataFrame(large, "salt_cell int, salts int"))
    rows = rows.join(salts, F.col("cell") == F.col("salt_cell"), "left").withColumn("salt", F.when(F.col("salts").isNull(), 0).otherwise(F.pmod(F.xxhash64(key, "text_crc32"), F.col("salts"))).cast("int"))
    before, ahead = {}, []
    if large:
        for r in sorted(rows.where("salts IS NOT NULL").groupBy("cell", "salt").count().collect()):
            ahead.append((r["cell"], r["salt"], before.get(r["cell"], 0)))
            before[r["cell"]] = before.get(r["cell"], 0) + r["count"]
    offsets = F.broadcast(spark.createDataFrame(ahead, "before_cell int, before_salt int, before long"))
    segments = spark.createDataFrame(place(counts, shards, virtual_nodes, cells), "seg_cell int, first_rank long, n long, shard int, first_slot long")
    order = Window.partitionBy("cell", "salt").orderBy("position", key, "text_crc32", "size")
    ranked = rows.withColumn("in_salt", F.row_number().over(order) - 1).join(offsets, (F.col("cell") == F.col("before_cell")) & (F.col("salt") == F.col("before_salt")), "left")
    ranked = ranked.withColumn("rank", F.col("in_salt") + F.coalesce("before", F.lit(0)))
    # at most cells * shards segments: a fixed bound
    hit = (F.col("cell") == F.col("seg_cell")) & (F.col("rank") >= F.col("first_rank")) & (F.col("rank") < F.col("first_rank") + F.col("n"))
    return ranked.join(F.broadcast(segments), hit).select(
        key, "size", "text_crc32", "shard", (F.col("first_slot") + F.col("rank") - F.col("first_rank")).alias("slot")
    )


def op2_sharding(spark, sf_dir: str) -> DataFrame:
    out = shard_rows(spark.read.parquet(f"{sf_dir}/documents.parquet"))
    return out.select("doc_id", "size", "text_crc32", F.lit("rows").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard"))
