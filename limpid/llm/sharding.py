"""Resharding by minimum-cost flow: new shards of near equal size from old ones, moving the fewest bytes.

Rows belong to blocks by a hash; only block sizes (a bounded table) reach the driver.  The flow network runs
from old shards through new shards to their capacities, a byte that changes its shard costs one.  The flow
says how many bytes go from each old to each new shard, and whole blocks are chosen to make them up.  Only
shards that lose or get rows are rewritten.
"""

from __future__ import annotations

from collections import deque

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

#: Blocks of an old shard.  The plan has at most shards x blocks rows, at most about 2 MB.
BLOCKS = 2048


def min_cost_flow(supply: list[int], demand: list[int], cost: list[list[int]]) -> list[list[int]]:
    """Amounts from each source to each sink that meet supply and demand (equal sums) at the least cost.

    Successive shortest paths on the residual network; the network has a node per shard, not per block.
    """
    sources, sinks = len(supply), len(demand)
    flow = [[0] * sinks for _ in supply]
    left, open_ = list(supply), list(demand)
    while any(left):
        # shortest residual path from any source with supply to any sink with demand (Bellman-Ford by queue)
        far = 1 << 60
        distance = [0 if left[i] else far for i in range(sources)] + [far] * sinks
        came: list[int | None] = [None] * (sources + sinks)
        queue = deque(i for i in range(sources) if left[i])
        while queue:
            node = queue.popleft()
            if node < sources:
                steps = [(sources + j, cost[node][j]) for j in range(sinks)]
            else:
                steps = [(i, -cost[i][node - sources]) for i in range(sources) if flow[i][node - sources]]
            for to, price in steps:
                if distance[node] + price < distance[to]:
                    distance[to], came[to] = distance[node] + price, node
                    if to not in queue:
                        queue.append(to)
        end = min((sources + j for j in range(sinks) if open_[j]), key=lambda n: distance[n])
        path = [end]
        while came[path[-1]] is not None:
            path.append(came[path[-1]])
        path.reverse()
        amount = min(left[path[0]], open_[end - sources])
        for a, b in zip(path, path[1:]):
            if a >= sources:
                amount = min(amount, flow[b][a - sources])
        for a, b in zip(path, path[1:]):
            if a < sources:
                flow[a][b - sources] += amount
            else:
                flow[b][a - sources] -= amount
        left[path[0]] -= amount
        open_[end - sources] -= amount
    return flow


def capacities(total: int, shards: int) -> list[int]:
    return [total // shards + (n < total % shards) for n in range(shards)]


def choose_blocks(blocks: dict[tuple[int, int], int], shards: int) -> dict[tuple[int, int], int]:
    """New shard of each (old shard, block) from the blocks' sizes.

    Old shard n is new shard n if n < shards.  Large blocks are placed first, each where the flow from its old
    shard has most left to fill, staying at home on ties; that leaves every shard within about one small block
    of its capacity.
    """
    olds = sorted({old for old, _ in blocks})
    supply = [sum(s for (o, _), s in blocks.items() if o == old) for old in olds]
    if not sum(supply):
        return {}
    flow = min_cost_flow(supply, capacities(sum(supply), shards),
                         [[int(old != new) for new in range(shards)] for old in olds])
    need = {old: dict(enumerate(f)) for old, f in zip(olds, flow)}
    room = dict(enumerate(capacities(sum(supply), shards)))
    plan = {}
    for (old, block), size in sorted(blocks.items(), key=lambda b: (-b[1], b[0])):
        wanted = [new for new, left in need[old].items() if left >= size] or \
            [new for new, left in need[old].items() if left > 0 and room[new] >= size]
        if old in wanted:
            new = old
        elif wanted:
            new = max(wanted, key=lambda n: (need[old][n], -n))
        else:
            new = max(room, key=lambda n: (room[n], n == old, -n))
        plan[old, block] = new
        if new in need[old]:
            need[old][new] -= size
        room[new] -= size
    return plan


def block_of(*columns: Column, blocks: int = BLOCKS) -> Column:
    return F.pmod(F.xxhash64(*columns), F.lit(blocks)).cast("int")


def plan_blocks(rows: DataFrame, size_column: str, old_column: str, block_column: str, shards: int) -> DataFrame:
    """``_old``, ``_block``, ``shard`` and ``_before`` (the rows of the shard's blocks before) of every block.

    A missing size counts as 0; a missing old shard or block raises.  At most shards x blocks rows of 20 bytes.
    """
    found = rows.groupBy(old_column, block_column).agg(F.sum(F.coalesce(F.col(size_column), F.lit(0))).alias("size"),
                                                       F.count(F.lit(1)).alias("rows")).collect()
    if any(r[0] is None or r[1] is None for r in found):
        raise ValueError("a row has no old shard or no block")
    plan = choose_blocks({(r[0], r[1]): int(r["size"]) for r in found}, shards)
    counts = {(r[0], r[1]): r["rows"] for r in found}
    before, next_slot = [], [0] * shards
    for (old, block), new in sorted(plan.items()):
        before.append((old, block, new, next_slot[new]))
        next_slot[new] += counts[old, block]
    return rows.sparkSession.createDataFrame(before, "_old int, _block int, shard int, _before long")


def _planned(rows: DataFrame, plan: DataFrame, old_column: str, block_column: str) -> DataFrame:
    """Every row with the plan of its block, which is all that says where the row goes."""
    return rows.join(F.broadcast(plan), (F.col(old_column) == F.col("_old")) & (F.col(block_column) == F.col("_block")))


def number_slots(rows: DataFrame, plan: DataFrame, old_column: str, block_column: str) -> DataFrame:
    """Add ``slot`` (long, gapless from 0 in each shard); rows of a block are numbered by all their columns."""
    order = [F.col(c) for c in rows.columns]
    place = F.row_number().over(Window.partitionBy(old_column, block_column).orderBy(*order))
    return (_planned(rows.withColumn("_place", place), plan, old_column, block_column)
            .withColumn("slot", F.col("_before") + F.col("_place") - 1).drop("_old", "_block", "_before", "_place"))


def reshard(rows: DataFrame, size_column: str, old_column: str, block_column: str, shards: int) -> DataFrame:
    """Add ``shard`` (int) and ``slot`` (long, gapless from 0 in each shard) to rows with an old shard and a block.

    Slots follow the block and then all other columns, numbered inside the blocks and shifted by the rows of the
    blocks before, so no task sorts a shard.  Rows that repeat get slots of their own.  An empty table stays
    empty; a missing size counts as 0, a missing old shard or block is not allowed and raises.
    """
    taken = {"shard", "slot"} & set(rows.columns)
    if taken:
        raise ValueError(f"columns are there already: {sorted(taken)}")
    return number_slots(rows, plan_blocks(rows, size_column, old_column, block_column, shards), old_column, block_column)


def write_shards(rows: DataFrame, path: str) -> None:
    """The first layout: one folder per shard."""
    rows.write.partitionBy("shard").parquet(path)


def read_shards(spark: SparkSession, path: str, schema: StructType, blocks: int = BLOCKS) -> DataFrame:
    """A written layout with ``_own``, the block of every row by its file and its place there.

    Rows that repeat, even in a third of the table, so lie in all blocks of their shard.
    """
    rows = spark.read.schema(schema).parquet(path)
    return rows.select(*schema.names, block_of(F.col("_metadata.file_name"), F.col("_metadata.row_index"), blocks=blocks).alias("_own"))


def rewrite_affected(old: DataFrame, plan: DataFrame, out: str) -> DataFrame:
    """Write the new layout beside the old one and read it; a shard whose rows all stay is not written.

    ``old`` is from :func:`read_shards`, ``plan`` that of its blocks.  A row goes where its block goes, so rows with
    missing or repeated keys stay as they are.  New folders are ``out/shard=n``; unaffected shards keep their old
    ones.  The result has the rows of both, with ``old_shard`` and, for :func:`slots_by_files`, ``_file`` and ``_row``.
    """
    moved = plan.where("_old <> shard").select(F.explode(F.array("_old", "shard"))).distinct().collect()
    touched = F.col("shard").isin([r[0] for r in moved])
    place = [F.col("_metadata.file_name").alias("_file"), F.col("_metadata.row_index").alias("_row")]
    was = old.withColumn("old_shard", F.col("shard").cast("int"))
    placed = was.where(~touched).drop("_own").select("*", *place)
    if moved:
        rows = was.where(touched).drop("shard")
        new = _planned(rows, plan, "old_shard", "_own").drop("_own", "_old", "_block", "_before")
        new.write.partitionBy("shard").parquet(out)
        placed = placed.unionByName(old.sparkSession.read.schema(new.schema).parquet(out).select("*", *place))
    return placed


def slots_by_files(rows: DataFrame) -> DataFrame:
    """Turn ``_file`` and ``_row`` into ``slot`` (long, gapless from 0 in each shard).

    Rows are numbered by their files and their places there, so no task sorts or numbers a shard.  They are joined with
    one row per file, so hand over only the columns that are wanted.
    """
    files = rows.groupBy("shard", "_file").agg(F.count(F.lit(1)).alias("_rows"))
    before = F.sum("_rows").over(Window.partitionBy("shard").orderBy("_file")) - F.col("_rows")
    files = files.select("shard", "_file", before.alias("_before"))
    return rows.join(files, ["shard", "_file"]).withColumn("slot", F.col("_before") + F.col("_row")).drop(
        "_file", "_row", "_before")
