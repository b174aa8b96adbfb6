"""Resharding by minimum-cost flow: what has to move, in whole blocks where it can, and the rewriting of those alone."""

from __future__ import annotations

import heapq

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from deslinde.llm.common import ready, saved, scratch_path

OVERHEAD = 16  # bytes counted for a row beside its text
BLOCK_ROWS = 1000  # rows planned for one block of an old shard


def flow(sizes: list[int], capacities: list[int], costs: list[list[int]] | None = None) -> list[list[int]]:
    """Units to send from each old shard to each new one so that all are placed within the capacities at least cost.

    Costs are per unit; left out, staying (old i in new i) costs nothing and moving 1. Successive
    shortest paths with potentials: every path fills a capacity or empties a shard, or both.
    """
    n, m = len(sizes), len(capacities)
    if sum(sizes) > sum(capacities):
        raise ValueError("the capacities don't hold the sizes")
    cost = costs or [[int(i != j) for j in range(m)] for i in range(n)]
    sent, left, room = [[0] * m for _ in range(n)], list(sizes), list(capacities)
    up, down = [0] * n, [min((cost[i][j] for i in range(n)), default=0) for j in range(m)]  # potentials: reduced costs stay >= 0
    while any(left):
        far = {("o", i): 0 for i in range(n) if left[i]}
        back: dict = {}
        heap = [(0, x) for x in far]
        heapq.heapify(heap)
        done, goal = set(), None
        while heap:
            d, x = heapq.heappop(heap)
            if x in done:
                continue
            done.add(x)
            side, k = x
            if side == "n" and room[k]:
                goal = x
                break
            if side == "o":
                steps = [(("n", j), cost[k][j] + up[k] - down[j]) for j in range(m)]
            else:
                steps = [(("o", i), -(cost[i][k] + up[i] - down[k])) for i in range(n) if sent[i][k]]
            for y, c in steps:
                if y not in done and d + c < far.get(y, float("inf")):
                    far[y] = d + c
                    back[y] = x
                    heapq.heappush(heap, (d + c, y))
        reach = far[goal]
        for side, pot in (("o", up), ("n", down)):
            for k in range(len(pot)):
                pot[k] += min(far.get((side, k), reach), reach) if (side, k) in done else reach
        path, x = [goal], goal
        while x in back:
            x = back[x]
            path.append(x)
        path.reverse()
        units = min(left[path[0][1]], room[goal[1]], *(sent[b[1]][a[1]] for a, b in zip(path, path[1:]) if a[0] == "n"))
        for a, b in zip(path, path[1:]):
            if a[0] == "o":
                sent[a[1]][b[1]] += units
            else:
                sent[b[1]][a[1]] -= units
        left[path[0][1]] -= units
        room[goal[1]] -= units
    return sent


def stretches(sent: list[list[int]]) -> list[tuple[int, int, int, int]]:
    """(old, new, low, high): the bytes of each old shard's line that go to each new one, those that stay first."""
    out = []
    for i, row in enumerate(sent):
        low = 0
        for j in sorted(range(len(row)), key=lambda j: (j != i, j)):
            if row[j]:
                out.append((i, j, low, low + row[j]))
                low += row[j]
    return out


def _sized(docs: DataFrame, old_shard) -> DataFrame:
    """Rows with size and old shard; the block of a row follows from its id, a row without id from its text."""
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text", old_shard.cast("int").alias("old")).withColumn(
        "size", F.coalesce(F.octet_length("text"), F.lit(0)).cast("long") + OVERHEAD
    )


def reshard(docs: DataFrame, old_shard, old_shards: int, new_shards: int, path: str | None = None) -> DataFrame:
    """Move ``docs`` (doc_id, text) from shards 0..old_shards-1, given by the column ``old_shard``, to new_shards shards of equal bytes.

    (doc_id, size, text_crc32, law, shard, slot, grown_shard, old_shard, rewritten). Sizes of the old
    shards go through `flow`; the rows of an old shard lie on a line, block after block, and each new
    shard takes a stretch of it, so that all but the blocks at a border move or stay whole. Shards
    differ from the mean by about a row per border. Blocks that stay are left alone; the others are
    written anew under ``path``, by shard, and their rows are answered from the files read back.

    A null text counts no bytes (its crc32 is that of the empty text). Rows without doc_id are dealt
    by their text. Repeated rows each have a slot. An empty table gives no row; other columns are not read.
    """
    spark = ready(docs.sparkSession)
    rows = _sized(docs, old_shard)
    narrow = rows.withColumn("crc", F.crc32(F.coalesce("text", F.lit("")).cast("binary"))).drop("text")
    totals = rows.groupBy("old").agg(F.sum("size").alias("bytes"), F.count("*").alias("rows")).collect()  # old_shards rows
    sizes = [0] * old_shards
    for r in totals:
        sizes[r["old"]] = r["bytes"]
    whole = sum(sizes)
    capacities = [whole * (j + 1) // new_shards - whole * j // new_shards for j in range(new_shards)]
    plan = spark.createDataFrame(stretches(flow(sizes, capacities)), "old int, shard int, low long, high long")
    blocks = max(1, -(-sum(r["rows"] for r in totals) // BLOCK_ROWS))

    block = F.pmod(F.xxhash64(F.coalesce("doc_id", "crc")), F.lit(blocks)).alias("block")
    narrow = saved(narrow.select("*", block), "narrow")
    line = Window.partitionBy("old").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    starts = narrow.groupBy("old", "block").agg(F.sum("size").alias("block_bytes")).withColumn(  # a row per thousand rows
        "start", F.coalesce(F.sum("block_bytes").over(line), F.lit(0))
    )
    spots = F.broadcast(plan)  # old_shards + new_shards rows at most
    inside = starts.join(spots, "old").where("low <= start and start + block_bytes <= high and old = shard").select("old", "block")
    starts = saved(starts.join(inside.withColumn("stays", F.lit(True)), ["old", "block"], "left").select("old", "block", "start", F.coalesce("stays", F.lit(False)).alias("stays")), "starts")

    order = Window.partitionBy("old", "block").orderBy(*ORDER)

    def placed(some: DataFrame) -> DataFrame:
        """With its number in its block, and the new shard whose stretch holds its middle byte."""
        end = F.col("start") + F.sum("size").over(order.rowsBetween(Window.unboundedPreceding, 0))
        lined = some.withColumn("row_no", F.row_number().over(order)).withColumn("at", end - F.expr("(size + 1) div 2"))
        return lined.join(spots, "old").where("low <= at and at < high").drop("low", "high", "at", "start")

    stay = placed(narrow.join(starts.where("stays"), ["old", "block"])).withColumn("rewritten", F.lit(False))
    path = path or scratch_path(spark, "shards")
    crc = F.crc32(F.coalesce("text", F.lit("")).cast("binary")).alias("crc")
    moving = rows.select("*", crc).select("*", block).join(starts.where("not stays"), ["old", "block"])
    placed(moving).drop("stays", "crc").repartitionByRange("shard", "old", "block").write.partitionBy("shard").parquet(path)
    back = spark.read.schema("doc_id long, text string, size long, old int, block long, row_no int, shard int").parquet(path)
    moved = back.select("doc_id", "size", crc, "old", "block", "row_no", "shard", F.lit(True).alias("rewritten"))

    names = ["doc_id", "size", "crc", "old", "block", "row_no", "shard", "rewritten"]
    every = stay.select(names).unionByName(moved.select(names))
    parts = every.groupBy("shard", "old", "block").agg(F.count("*").alias("part_rows"), F.min("row_no").alias("first_no"))
    before = Window.partitionBy("shard").orderBy("old", "block").rowsBetween(Window.unboundedPreceding, -1)
    parts = parts.withColumn("first_slot", F.coalesce(F.sum("part_rows").over(before), F.lit(0)))
    return every.join(parts, ["shard", "old", "block"]).select(
        "doc_id", "size", F.col("crc").alias("text_crc32"), F.lit("bytes").alias("law"), "shard",
        (F.col("first_slot") + F.col("row_no") - F.col("first_no")).cast("long").alias("slot"), F.lit(None).cast("int").alias("grown_shard"),
        F.col("old").alias("old_shard"), "rewritten",
    )


# The order of rows in a block; rows equal in all of these are the same row.
ORDER = ("doc_id", "size", "crc")
