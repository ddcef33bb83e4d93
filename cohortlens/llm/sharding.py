"""Resharding by minimum-cost flow.

The rows of each old shard are hashed into a fixed number of blocks. From
the block sizes (a table bounded by shards x blocks) a minimum-cost flow
decides how many bytes each old shard sends to each new one so that the new
capacities hold and the fewest bytes move; blocks then realise the flow and
only the files of shards that gain or lose a block are written again.
"""

from __future__ import annotations

import heapq
import math
import uuid
from collections import deque
from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cohortlens.llm.common import text_of

BLOCKS_PER_SHARD = 2048


def cheapest_flow(nodes: int, edges: Sequence[tuple], src: int, dst: int) -> list[int]:
    """The flow on each edge (from, to, room, cost) of a cheapest largest flow
    from ``src`` to ``dst``. No cycle may have a negative cost.

    Primal-dual: distances once per level of path cost, then all flow that
    fits along edges on shortest paths. There are as many levels as different
    path costs, so with costs of 0 and 1 a network is solved in a few passes."""
    to, room, cost, at = [], [], [], [[] for _ in range(nodes)]
    for a, b, r, c in edges:  # the reverse of edge k is k ^ 1
        at[a].append(len(to))
        at[b].append(len(to) + 1)
        to += [b, a]
        room += [r, 0]
        cost += [c, -c]
    while True:
        dist, queue, waiting = [math.inf] * nodes, deque([src]), [False] * nodes
        dist[src] = 0
        while queue:
            u = queue.popleft()
            waiting[u] = False
            for k in at[u]:
                v = to[k]
                if room[k] > 0 and dist[u] + cost[k] < dist[v]:
                    dist[v] = dist[u] + cost[k]
                    if not waiting[v]:
                        waiting[v] = True
                        queue.append(v)
        if dist[dst] == math.inf:
            return room[1::2]
        arc, path, on = [0] * nodes, [], [False] * nodes  # walk forward on tight edges, step back at dead ends
        u, on[src] = src, True
        while True:
            if u == dst:
                push = min(room[k] for k in path)
                for k in path:
                    room[k] -= push
                    room[k ^ 1] += push
                cut = next(i for i, k in enumerate(path) if not room[k])
                for k in path[cut:]:
                    on[to[k]] = False
                u = to[path[cut] ^ 1]
                del path[cut:]
            while arc[u] < len(at[u]):
                k = at[u][arc[u]]
                if room[k] > 0 and not on[to[k]] and dist[u] + cost[k] == dist[to[k]]:
                    break
                arc[u] += 1
            if arc[u] < len(at[u]):
                path.append(k)
                u = to[k]
                on[u] = True
            elif u == src:
                break
            else:
                on[u] = False
                k = path.pop()
                u = to[k ^ 1]
                arc[u] += 1


def min_cost_flow(supply: Sequence[int], capacity: Sequence[int], cost) -> list[list[int]]:
    """Cheapest flow of ``supply`` into ``capacity``; ``cost(i, j)`` is the cost
    of one byte from old shard i to new shard j (one edge for each pair)."""
    n, m = len(supply), len(capacity)
    src, dst = n + m, n + m + 1
    pairs = [(i, n + j, supply[i], cost(i, j)) for i in range(n) for j in range(m)]
    flow = cheapest_flow(n + m + 2, [*pairs, *((src, i, s, 0) for i, s in enumerate(supply)),
                                     *((n + j, dst, c, 0) for j, c in enumerate(capacity))], src, dst)
    return [flow[i * m:(i + 1) * m] for i in range(n)]


def stay_or_move(supply: Sequence[int], capacity: Sequence[int]) -> dict[tuple[int, int], int]:
    """(old, new) -> bytes, when staying costs nothing and any move one a byte.
    Moves go through one node, so the network has as many edges as shards."""
    n, m = len(supply), len(capacity)
    hub, src, dst = n + m, n + m + 1, n + m + 2
    stay = [(i, n + i, supply[i], 0) for i in range(min(n, m))]
    out = [(i, hub, s, 1) for i, s in enumerate(supply)]
    into = [(hub, n + j, c, 0) for j, c in enumerate(capacity)]
    flow = cheapest_flow(n + m + 3, [*stay, *out, *into, *((src, i, s, 0) for i, s in enumerate(supply)),
                                     *((n + j, dst, c, 0) for j, c in enumerate(capacity))], src, dst)
    got = {(i, i): f for i, f in enumerate(flow[:len(stay)]) if f}
    gives = [[i, f] for i, f in enumerate(flow[len(stay):len(stay) + n]) if f]
    takes = [[j, f] for j, f in enumerate(flow[len(stay) + n:len(stay) + n + m]) if f]
    while gives and takes:  # what leaves the shards, laid beside what enters them
        f = min(gives[-1][1], takes[-1][1])
        key = (gives[-1][0], takes[-1][0])
        got[key] = got.get(key, 0) + f
        for side in (gives, takes):
            side[-1][1] -= f
            if not side[-1][1]:
                side.pop()
    return got


def plan_transfers(blocks: Sequence[tuple], n_new: int) -> tuple[list[tuple], dict[tuple[int, int], int]]:
    """Assign blocks to new shards.

    ``blocks``: (old, block, bytes, rows). A new shard's capacity is an equal
    part of all bytes; staying costs nothing, moving one per byte. Large
    blocks are placed first, each along the flow with the most room left; one
    that fits none goes to the emptiest new shard. Returns (old, block, shard,
    first slot) per block and the flow. Without blocks both are empty."""
    n_old = max([n_new, *(b[0] + 1 for b in blocks)])
    supply = [0] * n_old
    for o, _, size, _ in blocks:
        supply[o] += size
    total = sum(supply)
    capacity = [total * (j + 1) // n_new - total * j // n_new for j in range(n_new)]
    flow = stay_or_move(supply, capacity)
    room: list[dict[int, int]] = [{} for _ in range(n_old)]
    for (i, j), f in flow.items():
        room[i][j] = f
    free = [(-c, j) for j, c in enumerate(capacity)]  # by most capacity left; stale entries are skipped
    heapq.heapify(free)
    filled, placed = [0] * n_new, []
    for old, block, size, rows in sorted(blocks, key=lambda b: (-b[2], b[0], b[1])):
        own = room[old]
        if own.get(old, 0) >= size and old < n_new:
            j = old
        else:
            j = max(own, key=lambda k: (own[k] >= size, capacity[k] - filled[k], -k), default=-1)
            if j < 0:
                while -free[0][0] != capacity[free[0][1]] - filled[free[0][1]]:
                    heapq.heapreplace(free, (filled[free[0][1]] - capacity[free[0][1]], free[0][1]))
                j = free[0][1]
        if j in own:
            own[j] -= size
            if own[j] <= 0:
                del own[j]
        filled[j] += size
        placed.append((old, block, j, rows))
    placed.sort(key=lambda p: (p[2], p[0], p[1]))
    out, at = [], [0] * n_new
    for old, block, j, rows in placed:
        out.append((old, block, j, at[j]))
        at[j] += rows
    return out, flow


PLAN = T.StructType([T.StructField("_old", T.IntegerType()), T.StructField("_block", T.IntegerType()),
                     T.StructField("shard", T.IntegerType()), T.StructField("_first", T.LongType())])


def sizes_and_blocks(docs: DataFrame, old_shard, blocks_per_shard: int) -> DataFrame:
    text = text_of()
    d = docs.select("doc_id", (F.octet_length(text) + 1).cast("long").alias("size"),
                    F.crc32(text.cast("binary")).alias("text_crc32"), old_shard.cast("int").alias("_old"))
    return d.withColumn("_block", F.pmod(F.xxhash64("doc_id", "text_crc32", "size"), F.lit(blocks_per_shard)).cast("int"))


def reshard(docs: DataFrame, old_shard, n_new: int = 8, blocks_per_shard: int = BLOCKS_PER_SHARD) -> DataFrame:
    """Place every row of ``docs`` into shards 0 .. n_new - 1 of near-equal bytes.

    ``old_shard`` is a column with the shard a row is in now (0, 1, ...; at
    most a few thousand shards). Returns doc_id, size (UTF-8 bytes of the
    text plus 1; null: none), text_crc32, old_shard, shard and slot (position
    in the shard, gapless from 0). Rows with equal values take the slots of
    their block in any order, which gives the same rows. Empty input gives
    no rows.
    """
    spark = docs.sparkSession
    rows = sizes_and_blocks(docs, old_shard, blocks_per_shard)
    # Bounded by shards x blocks_per_shard rows, whatever the number of documents.
    blocks = [tuple(r) for r in rows.groupBy("_old", "_block")
              .agg(F.sum("size"), F.count(F.lit(1))).collect()]
    plan = spark.createDataFrame(plan_transfers(blocks, n_new)[0] if blocks else [], PLAN)
    placed = rows.join(F.broadcast(plan), ["_old", "_block"])
    w = Window.partitionBy("_old", "_block").orderBy("doc_id", "text_crc32", "size")
    return placed.select("doc_id", "size", "text_crc32", F.col("_old").alias("old_shard"), "shard",
                         (F.col("_first") + F.row_number().over(w) - 1).alias("slot"))


def rewrite_affected(docs: DataFrame, old_shard, path: str, n_new: int = 8,
                     blocks_per_shard: int = BLOCKS_PER_SHARD) -> list[int]:
    """Bring the files under ``path/shard=<n>`` from the old layout to the new.

    Shards that neither gain nor lose a block keep their files. The others are
    written beside them first; only when all are written do the old folders go
    and the new ones take their names, emptied shards and those beyond
    ``n_new`` without a new one. If that last step is interrupted, what was
    taken away and what is still to come lie whole in ``path/_old-*`` and
    ``path/_new-*``. Returns the shards that changed (a list no longer than
    the old and new shards). An empty table changes nothing."""
    spark = docs.sparkSession
    rows = sizes_and_blocks(docs, old_shard, blocks_per_shard)
    blocks = [tuple(r) for r in rows.groupBy("_old", "_block").agg(F.sum("size"), F.count(F.lit(1))).collect()]
    if not blocks:
        return []
    moves, _ = plan_transfers(blocks, n_new)
    touched = sorted({x for o, _, j, _ in moves if o != j for x in (o, j)})
    if not touched:
        return []
    plan = spark.createDataFrame(moves, PLAN).select("_old", "_block", "shard").where(F.col("shard").isin(touched))
    text = text_of()
    full = docs.withColumn("_old", old_shard.cast("int")).withColumn(
        "_block", F.pmod(F.xxhash64("doc_id", F.crc32(text.cast("binary")), (F.octet_length(text) + 1).cast("long")),
                         F.lit(blocks_per_shard)).cast("int"))
    run, root = uuid.uuid4().hex, path.rstrip("/")
    fresh, away = f"{root}/_new-{run}", f"{root}/_old-{run}"  # names that readers skip
    (full.drop("shard").join(F.broadcast(plan), ["_old", "_block"]).drop("_old", "_block")
     .write.partitionBy("shard").parquet(fresh))
    at = spark.sparkContext._jvm.org.apache.hadoop.fs.Path
    fs = at(root).getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    fs.mkdirs(at(away))
    for k in touched:
        if fs.exists(at(f"{root}/shard={k}")):
            fs.rename(at(f"{root}/shard={k}"), at(f"{away}/shard={k}"))
        if fs.exists(at(f"{fresh}/shard={k}")):
            fs.rename(at(f"{fresh}/shard={k}"), at(f"{root}/shard={k}"))
    for folder in (fresh, away):
        fs.delete(at(folder), True)
    return touched
