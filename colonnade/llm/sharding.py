"""Sharding by a consistent-hash ring with virtual nodes and bounded loads.

A row's position on the ring is the 64-bit hash of its id and text; the ring is cut into a fixed number of cells (its leading bits) and
every shard owns virtual nodes that start at cells. A row goes to the shard of the first virtual node at or after its cell; where that
shard is full it continues clockwise to the next one that is not. Only the row count of each cell reaches the driver - at most
``cells`` numbers, whatever the input - which walks the ring once and writes down, for each cell, which ranks go to which shard.
Rows then need one shuffle (by cell, a few narrow columns) to learn their rank in the cell; no task holds a whole shard. Rows alike in every respect, of
which there may be very many, are counted first, ranked as one, and written out again in pieces of ``chunk``; rows that share only an id, or only a text, lie
in different cells.

With ``epsilon`` 0 the capacities are n/shards rounded down or up, so counts are at most one apart (the law ``rows``); a larger
epsilon leaves slack and moves fewer rows when the table or the shard count changes.

Defined results: a null text has size 1 and the CRC of no bytes; a null id is one more id;
rows alike in every respect are interchangeable and each get a slot of their own, and equal texts need not share a shard - counts that are one apart
at most leave no room for a large group of them; an empty table gives an empty result. Columns
other than the id and the text are ignored, whatever their names.
"""

from __future__ import annotations

import hashlib
from bisect import bisect_left

import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def virtual_nodes(shards: int, per_shard: int, cells: int, seed: int = 0) -> list[tuple[int, int]]:
    """(cell, shard) of every virtual node in ring order."""

    def cell(shard: int, replica: int) -> int:
        digest = hashlib.sha256(f"{seed}/{shard}/{replica}".encode()).digest()
        return int.from_bytes(digest[:8], "big") * cells >> 64

    return sorted((cell(s, r), s) for s in range(shards) for r in range(per_shard))


def walk_ring(counts: dict[int, int], nodes: list[tuple[int, int]], capacity: list[int]) -> list[tuple[int, int, int, int, int]]:
    """(cell, first rank, shard, first slot, home shard) of each run of rows, cells in ring order.

    counts: rows of each cell. The capacities must hold all rows together.
    """
    used = [0] * len(capacity)
    open_nodes = [x for x in nodes if capacity[x[1]] > 0]
    runs = []
    for cell in sorted(counts):
        left, rank = counts[cell], 0
        home = nodes[bisect_left(nodes, (cell, -1)) % len(nodes)][1]
        while left:
            shard = open_nodes[bisect_left(open_nodes, (cell, -1)) % len(open_nodes)][1]
            taken = min(left, capacity[shard] - used[shard])
            runs.append((cell, rank, shard, used[shard], home))
            used[shard] += taken
            rank += taken
            left -= taken
            if used[shard] == capacity[shard]:
                open_nodes = [x for x in open_nodes if x[1] != shard]
    return runs


def capacities(rows: int, shards: int, epsilon: float) -> list[int]:
    """How many rows each shard may take: (1 + epsilon) times its even part, and at least that part."""
    even = [rows // shards + (s < rows % shards) for s in range(shards)]
    return [max(e, int(rows / shards * (1 + epsilon))) for e in even]


def bounded_ring(docs: DataFrame, shards: int = 16, per_shard: int = 64, epsilon: float = 0.0, cells: int = 65536, id_col: str = "doc_id", text_col: str = "text", seed: int = 0, chunk: int = 100_000) -> DataFrame:
    """Each row's shard and slot: doc_id, size, text_crc32, law, shard, slot, grown_shard, home_shard.

    grown_shard is null: bounds make a row's shard depend on the other rows, so the law is ``rows`` (``bounded`` if
    epsilon leaves slack), never ``key``. home_shard is where the ring without bounds would put the row.
    """
    spark = docs.sparkSession
    text = F.col(text_col)
    place = F.xxhash64(F.lit(seed), F.col(id_col), F.coalesce(text, F.lit("")))
    bits = cells.bit_length() - 1
    if cells != 1 << bits:
        raise ValueError("cells must be a power of two")
    cell = F.shiftrightunsigned(place, 64 - bits).cast("int") if bits else F.lit(0)
    counts = {r["cell"]: r["n"] for r in docs.select(cell.alias("cell")).groupBy("cell").agg(F.count("*").alias("n")).collect()}
    runs = walk_ring(counts, virtual_nodes(shards, per_shard, cells, seed), capacities(sum(counts.values()), shards, epsilon))
    frame = pd.DataFrame(runs, columns=["cell", "rank", "shard", "slot", "home"])
    plan = spark.createDataFrame(frame, "cell int, rank long, shard int, slot long, home int")
    plan = plan.groupBy("cell").agg(F.sort_array(F.collect_list(F.struct("rank", "shard", "slot", "home"))).alias("runs"))

    rows = docs.select(
        F.col(id_col).alias("doc_id"),
        (F.coalesce(F.octet_length(text), F.lit(0)) + 1).cast("long").alias("size"),
        F.crc32(F.coalesce(text, F.lit("")).cast("binary")).alias("text_crc32"),
        place.alias("place"),
        cell.alias("cell"),
    )
    kinds = rows.groupBy(*rows.columns).agg(F.count("*").alias("n"))
    order = Window.partitionBy("cell").orderBy("place", "doc_id", "size", "text_crc32").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    ranked = kinds.withColumn("first", (F.sum("n").over(order) - F.col("n")).cast("long"))
    # Most kinds are one row; what is more goes out in pieces, dealt to all tasks.
    one = ranked.where("n = 1").select("*", F.col("first").alias("at"))
    pieces = ranked.where("n > 1").withColumn("from", F.explode(F.sequence(F.lit(0).cast("long"), F.col("n") - 1, F.lit(chunk).cast("long")))).repartition("place", "from")
    many = pieces.select(*ranked.columns, F.explode(F.sequence(F.col("first") + F.col("from"), F.col("first") + F.least("n", F.col("from") + chunk) - 1)).alias("at"))
    # The plan has at most ``cells`` rows and as many runs more as there are shards, so it is safe to broadcast.
    run = F.element_at(F.filter("runs", lambda x: x["rank"] <= F.col("at")), -1)
    placed = one.unionByName(many).join(F.broadcast(plan), "cell").withColumn("run", run)
    law = "rows" if epsilon == 0 else "bounded"
    return placed.select(
        "doc_id",
        "size",
        "text_crc32",
        F.lit(law).alias("law"),
        F.col("run.shard").alias("shard"),
        (F.col("run.slot") + F.col("at") - F.col("run.rank")).alias("slot"),
        F.lit(None).cast("int").alias("grown_shard"),
        F.col("run.home").alias("home_shard"),
    )
