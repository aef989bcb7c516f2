"""Resharding by minimum-cost flow: new shard sizes by moving the fewest bytes.

A layout is a table of files by shard and block (a block has a 256th of the table's bytes, 256 MB at most). To go to other
shards of other capacities:

1. Rows larger than 1 / LARGE of the level (the shards' mean size) are planned one by one: there are at most LARGE times as many
   of them as shards, whatever the table's size. They stay where they fit, largest first; others go where most room is left.
2. All other bytes are a flow: old shards supply them, new shards have room for what is left of their capacity. A unit of flow
   from a shard to itself costs nothing, and to another one the bytes moved; successive shortest paths solve it on the driver, on
   a network of a few arcs for each shard. Capacities are the level, but for shards that single rows fill beyond it.
3. Each old shard's small rows lie on a line, block after block. The flow cuts it: the part that stays first, then a part for each
   other shard. A block is cut by the sums of the blocks before it, which Spark adds up; a row goes by its middle.
4. Blocks of which all rows stay are not touched. Only the others are read, and their rows written to new files by shard.

A row's slot is its place in its shard: rows that stayed, in their old order, then those that came, by old shard and block. It is
not in the files: a segment (shard, old shard, block) has a base in the manifest and rows have their place in the segment.

Sizes are near equal (law `bytes`): a shard differs from the level by at most the half of a small row for each flow that meets in
it, unless single rows are larger than what is left of the level. Groups of equal texts are not kept together: a group may hold a
third of all rows, more than a shard does.

Null texts have 8 bytes and the CRC of the empty text. Rows without doc_id, repeated rows, empty texts and further columns of any
name (kept in one struct) are rows like others. An empty table gives no rows; there may be empty shards if there are few rows.
"""

from __future__ import annotations

import heapq
from collections import defaultdict, deque
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import new_path, small, table, written

SHARDS, OLD_SHARDS = 24, 16
#: A layout has about so many blocks, of a size within these bounds (bytes).
BLOCKS, LEAST_BLOCK, MOST_BLOCK = 256, 64 << 10, 256 << 20
#: Rows larger than the level divided by this are planned one by one.
LARGE = 128


# ---- the plan


def min_cost_flow(supply: dict[str, int], room: dict[str, int], cost: Callable[[str, str], int] | None = None) -> dict[tuple[str, str], int]:
    """Units from each supply to each room, of least total cost; by default a unit that stays is free and one that moves costs 1.
    All supplies are placed, so rooms must hold them. Successive shortest augmenting paths. Moves of one cost go through a
    common node, so that arcs grow with the shards and not with their pairs; it is dissolved again at the end."""
    arcs: list[list[int]] = []  # [to, capacity left, cost]; an arc and its reverse are next to each other
    out: dict[object, list[int]] = defaultdict(list)
    ends: list[object] = []

    def arc(a: object, b: object, capacity: int, price: int) -> None:
        for x, y, c, p in ((a, b, capacity, price), (b, a, 0, -price)):
            out[x].append(len(arcs))
            arcs.append([c, p])
            ends.append(y)

    total = sum(supply.values())
    if total > sum(room.values()):
        raise ValueError("the rooms do not hold the supplies")
    for i in sorted(supply):
        arc("source", ("from", i), supply[i], 0)
        if cost is None:
            if i in room:
                arc(("from", i), ("to", i), total, 0)
            arc(("from", i), "moves", total, 1)
        else:
            for j in sorted(room):
                arc(("from", i), ("to", j), total, cost(i, j))
    for j in sorted(room):
        if cost is None:
            arc("moves", ("to", j), total, 0)
        arc(("to", j), "sink", room[j], 0)

    sent = 0
    while sent < total:
        far, via, queue, waiting = {"source": 0}, {}, deque(["source"]), {"source"}
        while queue:
            x = queue.popleft()
            waiting.discard(x)
            for e in out[x]:
                y = ends[e]
                if arcs[e][0] and far[x] + arcs[e][1] < far.get(y, 1 << 62):
                    far[y], via[y] = far[x] + arcs[e][1], e
                    if y not in waiting:
                        waiting.add(y)
                        queue.append(y)
        path, x = [], "sink"
        while x != "source":
            path.append(via[x])
            x = ends[via[x] ^ 1]
        most = min(arcs[e][0] for e in path)
        for e in path:
            arcs[e][0] -= most
            arcs[e ^ 1][0] += most
        sent += most

    flow: dict[tuple[str, str], int] = defaultdict(int)
    giving, taking = deque(), deque()
    for e in range(0, len(arcs), 2):
        a, b, units = ends[e ^ 1], ends[e], arcs[e ^ 1][0]
        if units and b == "moves":
            giving.append([a[1], units])
        elif units and a == "moves":
            taking.append([b[1], units])
        elif units and a != "source" and b != "sink":
            flow[a[1], b[1]] += units
    while giving:
        n = min(giving[0][1], taking[0][1])
        flow[giving[0][0], taking[0][0]] += n
        for side in (giving, taking):
            side[0][1] -= n
            if not side[0][1]:
                side.popleft()
    return dict(flow)


def levels(loads: dict[int, int], total: int) -> dict[int, int]:
    """Capacities that hold `total` and are equal but for shards whose load alone is larger."""
    fixed: dict[int, int] = {}
    while True:
        rest = [j for j in sorted(loads) if j not in fixed]
        left = total - sum(fixed.values())
        over = {j: loads[j] for j in rest if loads[j] * len(rest) > left}
        if not over or len(over) == len(rest):
            share, more = divmod(max(left, 0), len(rest))
            return fixed | {j: share + (k < more) for k, j in enumerate(rest)}
        fixed |= over


def placed(large: list[tuple[int, int, int]], supply: dict[int, int], shards: int) -> tuple[dict[int, int], dict[int, int]]:
    """Shards of the large rows (old shard, size, key), by key, and the bytes that they have there. Rows stay, largest first,
    while the level holds them; others go where most is left of the level beside what stays."""
    total = sum(supply.values()) + sum(size for _, size, _ in large)
    level = total // shards
    load, where, leave = dict.fromkeys(range(shards), 0), {}, []
    for old, size, key in sorted(large, key=lambda x: (-x[1], x[0], x[2])):
        if old < shards and (load[old] + size <= level or not load[old]):
            where[key] = old
            load[old] += size
        else:
            leave.append((size, key))
    free = [(-(level - load[j] - min(supply.get(j, 0), max(level - load[j], 0))), j) for j in range(shards)]
    heapq.heapify(free)
    for size, key in leave:
        room, j = heapq.heappop(free)
        where[key] = j
        load[j] += size
        heapq.heappush(free, (room + size, j))
    return where, load


# ---- layouts


def layout(rows: DataFrame, shard: Column, size: Column, path: str) -> DataFrame:
    """Writes rows by shard and block; returns them as old, block, place (in the block), size and row (a struct of all columns).
    Blocks are dealt by the rows' places in the table, so that no key makes one larger than others."""
    lined = rows.select(F.struct("*").alias("row"), shard.cast("int").alias("old"), size.cast("long").alias("size"), F.monotonically_increasing_id().alias("at"))
    sizes = {r["old"]: r["bytes"] for r in rows.groupBy(shard.cast("int").alias("old")).agg(F.sum(size.cast("long")).alias("bytes")).collect()}  # a row for each shard
    each = min(MOST_BLOCK, max(LEAST_BLOCK, sum(sizes.values()) // BLOCKS))
    blocks = F.lit(1)
    for old, total in sorted(sizes.items()):
        blocks = F.when(F.col("old") == old, 1 + total // each).otherwise(blocks)
    block = F.pmod(F.xxhash64("at"), blocks).cast("int")
    place = F.row_number().over(Window.partitionBy("old", "block").orderBy("at")).cast("long") - 1
    out = lined.withColumn("block", block).withColumn("place", place).drop("at")
    out.write.partitionBy("old", "block").parquet(path)
    return rows.sparkSession.read.schema(out.schema).parquet(path)


def reshard(old: DataFrame, shards: int, path: str) -> tuple[DataFrame, dict[str, int]]:
    """Rows of a layout (old, block, place, size, row) in new shards: shard, slot, size, row, read from the files that did not
    change and those written under `path`; and the bytes in all, moved and rewritten."""
    total, n = old.agg(F.sum("size"), F.count(F.lit(1))).first()
    if not n:
        return old.select(F.lit(0).alias("shard"), F.lit(0).cast("long").alias("slot"), "size", "row"), {"bytes": 0, "moved": 0, "rewritten": 0}
    bound = total // shards // LARGE
    is_large = F.col("size") > bound
    key = F.struct("old", "block", "place")

    # The driver has a row for each old shard and each large row: at most LARGE * (shards + 1) of them, since they have the bytes.
    supply = {r["old"]: r["bytes"] for r in old.groupBy("old").agg(F.coalesce(F.sum(F.when(~is_large, F.col("size"))), F.lit(0)).alias("bytes")).collect()}
    big = old.where(is_large).select(key.alias("key"), "size").collect()
    large = [(r["key"]["old"], r["size"], tuple(r["key"])) for r in big]
    where, load = placed(large, supply, shards)
    caps = levels(load, total)
    names = lambda d: {f"{k:09d}": v for k, v in d.items()}
    flow = {(int(i), int(j)): f for (i, j), f in min_cost_flow(names(supply), names({j: max(caps[j] - load[j], 0) for j in caps})).items()}
    lines = {i: sorted(((j != i, j, f) for (a, j), f in flow.items() if a == i)) for i in supply}

    # Blocks: where each begins on its shard's line, and whether all of its rows stay.
    spark = old.sparkSession
    left = spark.createDataFrame([(*k, j) for k, j in where.items()] or [], "old int, block int, place long, target int")
    gone = F.broadcast(left.where("target <> old").groupBy("old", "block").agg(F.lit(True).alias("leaves")))  # at most as many as large rows
    line = Window.partitionBy("old").orderBy("block")
    blocks = old.groupBy("old", "block").agg(F.coalesce(F.sum(F.when(~is_large, F.col("size"))), F.lit(0)).alias("bytes"), F.count(F.lit(1)).alias("rows"))
    blocks = blocks.withColumn("base", F.sum("bytes").over(line) - F.col("bytes")).join(gone, ["old", "block"], "left")
    stays = {i: next((f for away, _, f in line if not away), 0) for i, line in lines.items()}
    kept = F.lit(0)
    for i, f in sorted(stays.items()):
        kept = F.when(F.col("old") == i, f).otherwise(kept)
    home = (F.col("old") < shards) & F.col("leaves").isNull() & (F.col("base") + F.col("bytes") <= kept)
    blocks = written(blocks.select("old", "block", "bytes", "rows", "base", home.alias("home")), "blocks")

    # Rows of the other blocks: large ones by the plan, small ones by the cuts of their line.
    cut = F.lit(None).cast("int")
    for i, parts in sorted(lines.items()):
        end, target = sum(f for _, _, f in parts), F.lit(parts[-1][1] if parts else min(i, shards - 1))
        for (_, j, _), (_, _, after) in reversed(list(zip(parts, parts[1:], strict=False))):
            end -= after
            target = F.when(F.col("middle") < end, j).otherwise(target)
        cut = F.when(F.col("old") == i, target).otherwise(cut)
    away = small(blocks.where("not home").select("old", "block", "base"))
    in_block = Window.partitionBy("old", "block").orderBy("place")
    some = old.join(away, ["old", "block"])
    some = some.withColumn("middle", F.col("base") + F.coalesce(F.sum(F.when(~is_large, F.col("size"))).over(in_block), F.lit(0)) - F.expr("size div 2"))
    some = some.join(F.broadcast(left), ["old", "block", "place"], "left")
    some = some.withColumn("shard", F.coalesce("target", cut))
    segment = Window.partitionBy("old", "block", "shard").orderBy("place")
    some = some.select("shard", "old", "block", (F.row_number().over(segment) - 1).cast("long").alias("place"), "size", "row")
    some.write.partitionBy("shard").parquet(path)
    moved = spark.read.schema(some.schema).parquet(path)

    # The manifest: the first slot of each segment.
    whole = blocks.where("home").select(F.col("old").alias("shard"), "old", "block", "rows", F.lit(0).cast("long").alias("moved"), F.lit(0).cast("long").alias("rewritten"))
    new = moved.groupBy("shard", "old", "block").agg(F.count(F.lit(1)).alias("rows"), F.sum(F.when(F.col("shard") != F.col("old"), F.col("size")).otherwise(0)).alias("moved"), F.sum("size").alias("rewritten"))
    in_shard = Window.partitionBy("shard").orderBy(F.col("shard") != F.col("old"), "old", "block")
    manifest = written(whole.unionByName(new).withColumn("first", F.sum("rows").over(in_shard) - F.col("rows")), "manifest")
    counts = manifest.agg(F.sum("moved"), F.sum("rewritten")).first()
    firsts = small(manifest.select("shard", "old", "block", "first"))
    untouched = old.join(small(blocks.where("home").select("old", "block")), ["old", "block"]).select(F.col("old").alias("shard"), "old", "block", "place", "size", "row")
    out = untouched.unionByName(moved.select("shard", "old", "block", "place", "size", "row")).join(firsts, ["shard", "old", "block"])
    return out.select("shard", (F.col("first") + F.col("place")).alias("slot"), "size", "row"), {"bytes": total, "moved": counts[0], "rewritten": counts[1]}


def text_size() -> Column:
    return F.coalesce(F.octet_length("text"), F.lit(0)) + 8


def by_source() -> Column:
    """The old shard: that of the row's source, as a crawl by source leaves it."""
    return F.coalesce(F.crc32(F.col("source").cast("string").cast("binary")) % OLD_SHARDS, F.lit(0))


def op12_flow_reshard(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents lie in 16 shards by source, and go to 24."""
    old = layout(table(spark, sf_dir, "documents"), by_source(), text_size(), new_path(spark, "shards-old"))
    rows, _ = reshard(old, SHARDS, new_path(spark, "shards-new"))
    text = F.coalesce("row.text", F.lit("")).cast("binary")
    return rows.select("row.doc_id", "size", F.crc32(text).alias("text_crc32"), F.lit("bytes").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard"))
