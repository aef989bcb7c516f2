"""Order books from the event log, as window functions.

An epoch of a market begins with each snapshot, and with each reset from outside, which leaves the book empty until the next
snapshot. Within an epoch a delta counts unless both sequences are known and its own does not exceed the largest before. A
level's size is a running sum clamped at zero, which is the sum minus its running minimum below zero. Everything is integer.
Windows over the log stand on prefixes of one sort order. `accepted` is what the other operators read; where several do, write
it first.

A market of more than `hot_events` events is cut into blocks by time, so that no task sorts it whole. All that a row needs from
the rows before its block composes: epochs add up, the last begin and the largest sequence carry over, and with S the sum of the
blocks before, M the least sum reached in them, s and m those within the block, the clamped size is
S + s - min(0, M, S + m). So the windows run within blocks, and once over a row for each block.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.scalars import dollars, in_band, open_status, strong_status, tick_before, tick_time, to_micro
from ..params import DEFAULT, MICRO, Params
from ..sources.stage import bounded, staged

_TIME = ("received_ts", "ingest_seq")
_BEFORE = (Window.unboundedPreceding, -1)
_SO_FAR = (Window.unboundedPreceding, Window.currentRow)
#: Quantiles of a hot market's times from which its cuts are taken, and ticks that a node of `book_cells` has below it.
_QUANTILES, _RADIX, _HEIGHT = 4096, 16, 7


def with_resets(events: DataFrame, resets: DataFrame) -> DataFrame:
    """Decoded events with a reset for each row of `resets` (market_id, received_ts), after the events received until then."""
    rows = resets.select("market_id", "received_ts", F.lit((1 << 63) - 1).alias("ingest_seq"), F.lit("book_reset").alias("event_type"))
    return events.unionByName(rows, allowMissingColumns=True)


def of_active(events: DataFrame, active: DataFrame) -> DataFrame:
    """The events of the active markets."""
    return events.join(active.select("market_id").distinct(), "market_id", "left_semi")


def cuts(events: DataFrame, p: Params = DEFAULT) -> DataFrame | None:
    """market_id, cuts of the markets with more than `hot_events` events: times that cut each into blocks of about `block_events`,
    in groups for a search of two steps. None if there is no such market. There is a cut for each `block_events` events of the
    log at most, so the table may be broadcast. Events of one time stay in one block."""
    counts = staged(events.groupBy("market_id").count().where(F.col("count") > p.hot_events), "hot")
    if not counts.limit(1).count():
        return None
    hot = events.join(F.broadcast(counts), "market_id")
    all_cuts = F.percentile_approx(F.unix_micros(F.col("received_ts").cast("timestamp")), [k / _QUANTILES for k in range(1, _QUANTILES)], 20_000)
    found = hot.groupBy("market_id").agg(all_cuts.alias("q"), F.max("count").alias("n"))
    step = F.greatest(F.lit(1), F.floor(p.block_events * F.lit(float(_QUANTILES)) / F.col("n"))).cast("int")
    kept = F.array_distinct(F.filter("q", lambda x, i: (i + 1) % step == 0))
    width = F.greatest(F.lit(1), F.ceil(F.sqrt(F.size("kept")))).cast("int")
    rows = found.withColumn("step", step).withColumn("kept", kept).where(F.size("kept") > 0).withColumn("width", width)
    groups = F.transform(F.sequence(F.lit(0), F.floor((F.size("kept") - 1) / F.col("width")).cast("int")), lambda g: F.slice("kept", g * F.col("width") + 1, F.col("width")))
    return staged(rows.select("market_id", groups.alias("cuts")), "cuts")


def blocked(events: DataFrame, found: DataFrame | None) -> DataFrame:
    """Events with block: null but for hot markets, whose blocks are numbered by time."""
    if found is None:
        return events.withColumn("block", F.lit(None).cast("int"))
    at = F.unix_micros(F.col("received_ts").cast("timestamp"))
    rows = events.join(F.broadcast(found), "market_id", "left")
    group = F.size(F.filter(F.transform("cuts", lambda x: x[0]), lambda c: c <= at)) - 1
    rows = rows.withColumn("_g", F.when(F.col("cuts").isNotNull(), F.coalesce(group, F.lit(-1))))
    within = F.size(F.filter(F.get("cuts", F.col("_g")), lambda c: c <= at))
    block = F.when(F.col("_g") < 0, 0).otherwise(F.col("_g") * F.size(F.get("cuts", F.lit(0))) + within)
    return rows.withColumn("block", F.when(F.col("cuts").isNotNull(), block).cast("int")).drop("cuts", "_g")


def _sequenced() -> Column:
    return F.when(F.col("event_type").isin("orderbook_snapshot", "orderbook_delta"), F.col("sequence"))


def _begins() -> Column:
    return F.col("event_type").isin("orderbook_snapshot", "book_reset")


def _before_blocks(rows: DataFrame) -> DataFrame:
    """market_id, block and what a block's rows need from the others: epochs before it, whether the last of them is anchored, its
    largest sequence, and when the next begins after the block. rows have the epochs within their block."""
    epochs = rows.where("block is not null").groupBy("market_id", "block", "epoch").agg(
        F.max(_sequenced()).alias("top"), F.max(F.when(_begins(), F.col("event_type") == "orderbook_snapshot")).alias("snap"), F.min(F.when(_begins(), F.col("received_ts"))).alias("began")
    )
    each = epochs.groupBy("market_id", "block").agg(
        F.max("epoch").alias("n"), F.max_by("top", "epoch").alias("top"), F.max_by("snap", "epoch").alias("snap"), F.min_by("began", F.when(F.col("epoch") > 0, F.col("epoch"))).alias("began")
    )
    line = Window.partitionBy("market_id").orderBy("block")
    each = each.withColumn("part", F.sum(F.col("n").cast("boolean").cast("int")).over(line.rowsBetween(*_SO_FAR)))
    each = each.withColumn("open", F.max("top").over(Window.partitionBy("market_id", "part").orderBy("block").rowsBetween(*_SO_FAR)))
    return each.select(
        "market_id", "block", F.coalesce(F.sum("n").over(line.rowsBetween(*_BEFORE)), F.lit(0)).alias("_epochs"), F.last("snap", ignorenulls=True).over(line.rowsBetween(*_BEFORE)).alias("_anchored"),
        F.lag("open").over(line).alias("_floor"), F.last("began", ignorenulls=True).over(Window.partitionBy("market_id").orderBy(F.desc("block")).rowsBetween(*_BEFORE)).alias("_ended"),
    )


def accepted(events: DataFrame, p: Params = DEFAULT) -> DataFrame:
    """Decoded events with block (null but for hot markets), epoch, anchored, ended (when the next epoch begins), accepted (a delta
    that counts for the sequence), applied (it changes a level) and floor (the largest sequence of the epoch before the row)."""
    found = cuts(events, p)
    part = ["market_id"] if found is None else ["market_id", "block"]
    market = Window.partitionBy(*part).orderBy(*_TIME)
    in_epoch = Window.partitionBy(*part, "epoch").orderBy(*_TIME)
    is_snapshot, is_delta, begins = F.col("event_type") == "orderbook_snapshot", F.col("event_type") == "orderbook_delta", _begins()
    rows = blocked(events, found).withColumn("epoch", F.sum(begins.cast("int")).over(market.rowsBetween(*_SO_FAR)))
    local = rows
    rows = rows.withColumn("anchored", F.last(F.when(begins, is_snapshot), ignorenulls=True).over(market.rowsBetween(*_SO_FAR)))
    # From the end on, since a frame of all following rows is read anew for each row.
    backwards = Window.partitionBy(*part).orderBy(*(F.desc(c) for c in _TIME))
    rows = rows.withColumn("ended", F.last(F.when(begins, F.col("received_ts")), ignorenulls=True).over(backwards.rowsBetween(*_BEFORE)))
    rows = rows.withColumn("floor", F.max(_sequenced()).over(in_epoch.rowsBetween(*_BEFORE)))
    if found is not None:
        rows = rows.join(_before_blocks(local), part, "left")
        first = F.col("epoch") == 0
        rows = rows.withColumns({
            "anchored": F.coalesce("anchored", "_anchored"), "ended": F.coalesce("ended", "_ended"),
            "floor": F.when(first & F.col("_floor").isNotNull(), F.greatest("floor", "_floor")).otherwise(F.col("floor")),
        }).withColumn("epoch", F.col("epoch") + F.coalesce("_epochs", F.lit(0))).drop("_epochs", "_anchored", "_floor", "_ended")
    rows = rows.withColumn("anchored", F.coalesce("anchored", F.lit(False)))
    fits = F.col("sequence").isNull() | F.col("floor").isNull() | (F.col("sequence") > F.col("floor"))
    rows = rows.withColumn("accepted", is_delta & F.col("anchored") & fits)
    well = F.col("side").isin("yes", "no") & F.col("delta").isNotNull() & in_band(F.col("price"), p)
    return rows.withColumn("applied", F.col("accepted") & F.coalesce(well, F.lit(False)))


def _explode_changes(rows: DataFrame, p: Params) -> DataFrame:
    # Of several entries for a price in one snapshot the last counts: sorted by price and place, that before another price.
    kept = lambda side: F.array_sort(F.filter(F.transform(side, lambda x, i: F.struct(x["price"].alias("price"), i.alias("at"), x["size"].alias("size"))), lambda x: in_band(x["price"], p) & (x["size"] > 0)))
    last = lambda x: F.filter(F.zip_with(x, F.slice(x, 2, F.size(x)), lambda a, b: F.when(~a["price"].eqNullSafe(b["price"]), a)), lambda a: a.isNotNull())
    sides = rows.withColumns({"_yes": kept("yes"), "_no": kept("no")})
    tagged = lambda side: F.transform(last(F.col(f"_{side}")), lambda x: F.struct(F.lit(side).alias("side"), x["price"].alias("price"), x["size"].alias("qty")))
    one = F.array(F.struct(F.col("side").alias("side"), F.col("price").alias("price"), F.col("delta").alias("qty")))
    changes = F.when(F.col("event_type") == "orderbook_snapshot", F.concat(tagged("yes"), tagged("no"))).when(F.col("applied"), one)
    return sides.select("market_id", "block", "epoch", "ended", *_TIME, F.explode(changes).alias("c")).select("market_id", "block", "epoch", "ended", *_TIME, "c.*")


def level_changes(rows: DataFrame, p: Params = DEFAULT, split: bool | None = None) -> DataFrame:
    """market_id, epoch, ended, side, price, received_ts, ingest_seq, size of each change of a level; size 0 is no level. split:
    whether there are blocks (by default this is looked up)."""
    if split is None:
        split = rows.where("block is not null").limit(1).count() > 0
    keys = ["market_id", "epoch", "side", "price"]
    part = ["block", *keys] if split else keys
    each = _explode_changes(rows, p)
    level = Window.partitionBy(*part).orderBy(*_TIME)
    each = each.withColumn("s", F.sum("qty").over(level.rowsBetween(*_SO_FAR)))
    each = each.withColumn("m", F.min("s").over(level.rowsBetween(*_SO_FAR))).withColumn("next_ts", F.lead("received_ts").over(level))
    size = F.col("s") - F.least(F.lit(0), "m")
    if split:
        # A row for each level and block of the hot markets; sums and least sums of the blocks before.
        blocks = each.where("block is not null").groupBy(*part).agg(F.sum("qty").alias("a"), F.min("s").alias("low"), F.min("received_ts").alias("began"))
        line = Window.partitionBy(*keys).orderBy("block")
        blocks = blocks.withColumn("_s", F.coalesce(F.sum("a").over(line.rowsBetween(*_BEFORE)), F.lit(0)))
        blocks = blocks.withColumn("_m", F.min(F.col("_s") + F.col("low")).over(line.rowsBetween(*_BEFORE))).withColumn("_next", F.lead("began").over(line))
        each = each.join(blocks.select(*part, "_s", "_m", "_next"), part, "left").withColumn("next_ts", F.coalesce("next_ts", "_next"))
        base = F.coalesce("_s", F.lit(0))
        size = base + F.col("s") - F.least(F.lit(0), "_m", base + F.col("m"))
    return each.select("market_id", "epoch", "ended", "side", "price", *_TIME, size.alias("size"), "next_ts")


def last_levels(changes: DataFrame) -> DataFrame:
    """The levels of each market's newest epoch: market_id, side, price, size."""
    return changes.where("ended is null and next_ts is null and size > 0").select("market_id", "side", "price", "size")


# ---- checkpoints


def checkpoint(rows: DataFrame, p: Params = DEFAULT) -> DataFrame:
    """The book_state table of accepted events: market_id, last_sequence, last_ts, serialized_book (JSON of price to size in
    dollars and contracts for each side, and whether the book is anchored, which an empty one may be)."""
    books = last_levels(level_changes(rows, p)).groupBy("market_id")
    side = lambda s: F.map_from_entries(F.array_sort(F.collect_list(F.when(F.col("side") == s, F.struct(dollars(F.col("price")).cast("string").alias("p"), dollars(F.col("size")).alias("n"))))))
    levels = books.agg(side("yes").alias("yes"), side("no").alias("no"))
    new = F.col("ended").isNull()
    facts = rows.groupBy("market_id").agg(F.max("received_ts").alias("last_ts"), F.bool_or(new & F.col("anchored")).alias("anchored"), F.max(F.when(new & F.col("anchored") & F.col("event_type").isin("orderbook_snapshot", "orderbook_delta"), F.col("sequence"))).alias("last_sequence"))
    none = F.create_map().cast("map<string,double>")
    book = F.to_json(F.struct(F.coalesce("yes", none).alias("yes"), F.coalesce("no", none).alias("no"), "anchored"))
    return facts.join(levels, "market_id", "left").select("market_id", "last_sequence", "last_ts", book.alias("serialized_book"))


def seeds(state: DataFrame, at: Column) -> DataFrame:
    """A snapshot event at a time for each anchored book of a checkpoint, before the other events of that time."""
    kind = "struct<yes:map<string,double>,no:map<string,double>,anchored:boolean>"
    entry = lambda e: F.struct(to_micro(e["key"]).alias("price"), to_micro(e["value"].cast("decimal(30,9)").cast("string")).alias("size"))
    side = lambda s: F.transform(F.map_entries(F.col(f"b.{s}")), entry).cast("array<struct<price bigint, size bigint>>").alias(s)
    books = state.withColumn("b", F.from_json("serialized_book", kind)).where("b.anchored")
    return books.select("market_id", at.alias("received_ts"), F.lit(-1).cast("long").alias("ingest_seq"), F.lit("orderbook_snapshot").alias("event_type"), F.col("last_sequence").alias("sequence"), side("yes"), side("no"))


def resumed(state: DataFrame, events: DataFrame) -> DataFrame:
    """Decoded events that continue a checkpoint: for each anchored book of it a snapshot at its time, and the events received
    after that. Markets without a checkpoint have all their events."""
    books = seeds(state, F.col("last_ts"))
    floors = state.select("market_id", F.col("last_ts").alias("_floor"))
    later = events.join(floors, "market_id", "left").where("_floor is null or received_ts > _floor").drop("_floor")
    return later.unionByName(books, allowMissingColumns=True)


def tops(levels: DataFrame, keys: list[str], p: Params = DEFAULT) -> DataFrame:
    """Top of book and depth within the band, for each group of levels: bid, ask, mid2 (twice the mid), depths in
    micro-dollar micro-contracts, level counts."""
    side = lambda s: F.when(F.col("side") == s, F.col("price"))
    group = Window.partitionBy(*keys)
    rows = levels.withColumn("best_yes", F.max(side("yes")).over(group)).withColumn("best_no", F.max(side("no")).over(group))
    near = F.col("price") >= F.when(F.col("side") == "yes", F.col("best_yes")).otherwise(F.col("best_no")) - p.depth_band
    value = F.when(F.col("side") == "yes", F.col("price")).otherwise(MICRO - F.col("price")).cast("decimal(20,0)") * F.col("size")
    within = lambda s, x: F.when(near & (F.col("side") == s), x)
    return rows.groupBy(*keys).agg(
        F.first("best_yes").alias("bid"),
        (MICRO - F.first("best_no")).alias("ask"),
        F.coalesce(F.sum(within("yes", value)), F.lit(0)).cast("decimal(38,0)").alias("bid_value"),
        F.coalesce(F.sum(within("no", value)), F.lit(0)).cast("decimal(38,0)").alias("ask_value"),
        F.count(within("yes", F.lit(1))).cast("int").alias("bid_levels"),
        F.count(within("no", F.lit(1))).cast("int").alias("ask_levels"),
    )


def book_cells(rows: DataFrame, end: Column, p: Params = DEFAULT) -> DataFrame:
    """Books of accepted events at the ticks at which they change: market_id, epoch, tick, until (the last tick that sees the
    same book), the columns of `tops`, and crossed. An epoch ends with its first crossed tick. A tick sees what was received
    strictly before it.

    The ticks at which an epoch's levels change are numbered. A level's span of ticks becomes nodes of a tree over them (a tick, 16
    ticks, 256 and so on: the fewest that make it up), and each node keeps what may be near the top of a book. A tick's book is
    what its node and the nodes above it have; so an epoch of n changes takes n log n rows and not n times n."""
    step = p.interval_seconds
    key = ["market_id", "epoch"]
    tick = lambda c: tick_before(F.col(c), step) + 1
    changes = level_changes(rows, p).withColumn("final", tick_before(F.coalesce("ended", end), step))
    changes = changes.select(*key, "final", "side", "price", "size", tick("received_ts").alias("tick"), tick("next_ts").alias("next")).where("tick <= final")
    in_epoch = Window.partitionBy(*key).orderBy("tick")
    numbered = staged(changes.withColumn("n", (F.dense_rank().over(in_epoch) - 1).cast("long")), "changes")
    ticks = numbered.select(*key, "final", "tick", "n").distinct()
    ticks = ticks.select(*key, "tick", F.coalesce(F.lead("tick").over(in_epoch) - 1, "final").alias("until"), "n", (F.max("n").over(Window.partitionBy(*key)) + 1).alias("of"))
    ticks = staged(ticks, "ticks")
    # Of a level's changes before one tick the last is seen; it is seen until the level's next, or to the epoch's last tick.
    spans = numbered.withColumn("of", F.max("n").over(Window.partitionBy(*key)) + 1).where("next is null or next > tick")
    spans = spans.withColumn("z", F.lead("n").over(Window.partitionBy(*key, "side", "price").orderBy("tick"))).where("size > 0").withColumn("a", F.col("n"))
    pieces = spans.select(*key, "side", "price", "size", F.explode(_nodes(F.col("a"), F.coalesce(F.col("z"), F.col("of")) - 1)).alias("node")).select(*key, "side", "price", "size", "node.*")
    cells = pieces.where("k = 0").select(*key, F.col("i").alias("n"), "side", "price", "size")
    cells = cells.union(_from_above(pieces.where("k > 0"), ticks, p))
    books = tops(cells, [*key, "n"], p).withColumn("crossed", F.coalesce(F.col("bid") > F.col("ask"), F.lit(False)))
    # Hinted, since a staged table's files are small for its rows: it would be broadcast by the size of its files.
    books = books.join(ticks.drop("of").hint("merge"), [*key, "n"]).drop("n")
    books = books.withColumn("reset", F.min(F.when(F.col("crossed"), F.col("tick"))).over(Window.partitionBy(*key))).where("reset is null or tick <= reset")
    return books.withColumn("until", F.when(F.col("crossed"), F.col("tick")).otherwise(F.col("until"))).drop("reset")


def _nodes(a: Column, b: Column) -> Column:
    """The nodes (k, i) of which the ticks a..b are made: node i of height k has the ticks from i * 16**k on."""
    named = lambda height: lambda i: F.struct(F.lit(height).alias("k"), i.alias("i"))
    out = []
    for k in range(_HEIGHT):
        low, high = (F.ceil(a / _RADIX**k), F.floor((b + 1) / _RADIX**k) - 1)
        up, down = (F.ceil(a / _RADIX ** (k + 1)), F.floor((b + 1) / _RADIX ** (k + 1)) - 1)
        above = (up <= down) if k + 1 < _HEIGHT else F.lit(False)
        run = lambda x, y: F.when(x <= y, F.sequence(x.cast("long"), y.cast("long"))).otherwise(F.array().cast("array<bigint>"))
        both = F.when(above, F.concat(run(low, up * _RADIX - 1), run((down + 1) * _RADIX, high))).otherwise(run(low, high))
        out.append(F.transform(both, named(k)))
    return F.concat(out[0], F.when(b - a + 1 >= _RADIX, F.concat(*out[1:])).otherwise(F.array().cast("array<struct<k:int,i:bigint>>")))


def _from_above(pieces: DataFrame, ticks: DataFrame, p: Params) -> DataFrame:
    """For each tick the levels near the top of the nodes above it. A node has a level once, so a node's list is no longer than a
    book, and what it keeps no longer than the band."""
    key = ["market_id", "epoch"]
    best = lambda side: F.max(F.when(F.col("side") == side, F.col("price"))).alias(side)
    nodes = pieces.groupBy(*key, "k", "i").agg(best("yes"), best("no"), F.collect_list(F.struct("side", "price", "size")).alias("levels"))
    near = F.filter("levels", lambda x: x["price"] >= F.when(x["side"] == "yes", F.col("yes")).otherwise(F.col("no")) - p.depth_band)
    heights = sum((F.col("of") >= _RADIX**k).cast("int") for k in range(1, _HEIGHT))
    above = ticks.where(F.col("of") >= _RADIX).withColumn("height", heights)
    above = above.select(*key, "n", F.explode(F.expr("transform(sequence(1, height), k -> struct(k as k, shiftright(n, 4 * k) as i))")).alias("node")).select(*key, "n", "node.*")
    return above.join(nodes.select(*key, "k", "i", near.alias("near")).hint("merge"), [*key, "k", "i"]).select(*key, "n", F.explode("near").alias("c")).select(*key, "n", "c.*")


def _starts(rows: DataFrame, end: Column, active: DataFrame | None, begin: Column | None, p: Params) -> DataFrame:
    step = p.interval_seconds
    final = tick_before(end, step)
    if active is None:
        starts = rows.groupBy("market_id").agg(F.min(tick_before(F.col("received_ts"), step) + 1).alias("first")).withColumn("seed", F.lit(None).cast("string"))
    else:
        starts = active.groupBy("market_id").agg(F.max("status").alias("seed")).withColumn("first", tick_before(begin, step))
    return starts.withColumn("final", final)


def grid(rows: DataFrame, end: Column, active: DataFrame | None = None, begin: Column | None = None, p: Params = DEFAULT) -> DataFrame:
    """A row for each market and tick to `end`: top of book, depths, volume of the interval, last trade price, status. `rows` are
    accepted events, of which several parts of the plan read. Markets begin with their first event; with `active` (market_id,
    status) only its markets have rows, each of them from `begin` on, with the catalog's status until the log tells one."""
    return _grid_from(rows, _starts(rows, end, active, begin, p), end, p)


def _runs(rows: DataFrame, starts: DataFrame, end: Column, p: Params) -> DataFrame:
    """The grid by runs of ticks, for the ticks first..final of each market of starts (market_id, seed, first, final): market_id,
    tick, last (of the run), seed, volume (of its first tick; there is none in the others), book (of the ticks to book.until),
    traded, status, seen. Runs follow the events, so ticks are neither joined nor sorted."""
    step = p.interval_seconds
    by_tick = rows.withColumn("tick", tick_before(F.col("received_ts"), step) + 1)
    strong = strong_status(F.col("lifecycle"), F.col("deactivated"))
    order = F.struct("received_ts", "ingest_seq")
    # Books that were seeded or reset from outside are no events of the market.
    own = (F.col("ingest_seq") >= 0) & (F.col("event_type") != "book_reset")
    facts = by_tick.groupBy("market_id", "tick").agg(
        F.sum("trade_count").alias("volume"),
        F.max_by(F.when(F.col("trade_price").isNotNull(), F.col("trade_price")), F.when(F.col("trade_price").isNotNull(), order)).alias("traded"),
        F.max_by(strong, F.when(strong.isNotNull(), order)).alias("strong"),
        F.bool_or(F.col("lifecycle") == "created").alias("created"),
        F.max(F.when(own, F.col("received_ts"))).alias("seen"),
    )
    book = book_cells(rows, end, p)
    book = book.select("market_id", "tick", F.struct("until", "bid", "ask", "bid_value", "ask_value", "bid_levels", "ask_levels", "crossed").alias("book"))
    starts = starts.where("first <= final")
    points = facts.unionByName(book, allowMissingColumns=True).join(starts.hint("merge"), "market_id")
    # A book from before the first tick may be seen there.
    points = points.withColumn("tick", F.when(F.col("book.until") >= F.col("first"), F.greatest("tick", "first")).otherwise(F.col("tick"))).where("tick between first and final")
    points = points.unionByName(starts.withColumn("tick", F.col("first")), allowMissingColumns=True)
    found = points.groupBy("market_id", "tick").agg(*(F.max(c).alias(c) for c in ("seed", "final", "volume", "traded", "strong", "created", "seen")), F.first("book", ignorenulls=True).alias("book"))
    line = Window.partitionBy("market_id").orderBy("tick")
    so_far = line.rowsBetween(*_SO_FAR)
    made = F.when(F.coalesce(F.max("created").over(so_far), F.lit(False)), "active")
    runs = found.select(
        "market_id", "tick", F.coalesce(F.lead("tick").over(line) - 1, "final").alias("last"), F.coalesce("volume", F.lit(0)).cast("bigint").alias("volume"), F.last("book", ignorenulls=True).over(so_far).alias("book"),
        F.last("traded", ignorenulls=True).over(so_far).alias("traded"), F.coalesce(F.last("strong", ignorenulls=True).over(so_far), F.max("seed").over(so_far), made).alias("status"), F.max("seen").over(so_far).alias("seen"),
    )
    return runs.withColumn("book", F.when(F.col("book.until") >= F.col("tick"), F.col("book")))


def _grid_from(rows: DataFrame, starts: DataFrame, end: Column, p: Params) -> DataFrame:
    """The grid of accepted events, for the ticks first..final of each market of starts (market_id, seed, first, final)."""
    each = _runs(rows, starts, end, p).withColumn("at", F.explode(F.sequence("tick", "last")))
    book = lambda c: F.when(F.col("book.until") >= F.col("at"), F.col(f"book.{c}"))
    return each.select(
        tick_time(F.col("at"), p.interval_seconds).alias("ts"),
        "market_id",
        book("bid").cast("bigint").alias("bid_micro"),
        book("ask").cast("bigint").alias("ask_micro"),
        F.coalesce(book("bid_value"), F.lit(0)).cast("decimal(38,0)").alias("bid_value"),
        F.coalesce(book("ask_value"), F.lit(0)).cast("decimal(38,0)").alias("ask_value"),
        F.coalesce(book("bid_levels"), F.lit(0)).alias("bid_levels"),
        F.coalesce(book("ask_levels"), F.lit(0)).alias("ask_levels"),
        F.when(F.col("at") == F.col("tick"), F.col("volume")).otherwise(F.lit(0)).cast("bigint").alias("volume_micro"),
        F.col("traded").alias("last_trade_micro"),
        "status",
        F.coalesce(book("crossed"), F.lit(False)).alias("crossed"),
        F.col("seen").alias("seen_ts"),
    )


def grid_sums(rows: DataFrame, end: Column, active: DataFrame | None = None, begin: Column | None = None, p: Params = DEFAULT) -> DataFrame:
    """Sums over all ticks of the grid by market, of runs times their length: market_id, ticks, with_bid, with_ask, bids, asks,
    bid_levels, bid_value, volume_micro, crossed. The ticks themselves are not made."""
    runs = _runs(rows, _starts(rows, end, active, begin, p), end, p).withColumn("n", F.least("book.until", "last") - F.col("tick") + 1).withColumn("n", F.when(F.col("book").isNotNull(), F.col("n")))
    count = lambda held: F.coalesce(F.sum(F.when(held, F.col("n"))), F.lit(0))
    return runs.groupBy("market_id").agg(
        F.sum(F.col("last") - F.col("tick") + 1).alias("ticks"), count(F.col("book.bid").isNotNull()).alias("with_bid"), count(F.col("book.ask").isNotNull()).alias("with_ask"),
        F.sum(F.col("book.bid").cast("bigint") * F.col("n")).alias("bids"), F.sum(F.col("book.ask").cast("bigint") * F.col("n")).alias("asks"), F.coalesce(F.sum(F.col("book.bid_levels") * F.col("n")), F.lit(0)).alias("bid_levels"),
        F.coalesce(F.sum((F.col("book.bid_value") * F.col("n").cast("decimal(20,0)")).cast("decimal(38,0)")), F.lit(0)).cast("decimal(38,0)").alias("bid_value"), F.sum("volume").alias("volume_micro"), count(F.col("book.crossed")).alias("crossed"),
    )


# ---- markets that come and go


def stays(members: DataFrame) -> DataFrame:
    """members (market_id, status, enters, leaves; null: still in) with stay, a name for each stay of a market in the active set."""
    return members.withColumn("stay", F.concat_ws("@", "market_id", F.unix_micros(F.col("enters").cast("timestamp")).cast("string")))


def of_stays(events: DataFrame, members: DataFrame, state: DataFrame | None = None) -> DataFrame:
    """The events of each stay, with the stay as market_id. A stay has the events from its entry to its exit, which closes the
    epoch. It begins with the newest checkpoint of its market (state: rows of book_state, several for a market if it was written
    several times) that was written before it and that no stay before it took; else with no book."""
    own = stays(members)
    names = own.select(F.col("market_id").alias("_m"), "stay", "enters", "leaves")
    hits = (F.col("market_id") == F.col("_m")) & (F.col("received_ts") >= F.col("enters")) & (F.col("leaves").isNull() | (F.col("received_ts") < F.col("leaves")))
    rows = events.join(bounded(names), hits).withColumn("market_id", F.col("stay")).select(*events.columns)
    exits = own.where("leaves is not null").select(F.col("stay").alias("market_id"), F.col("leaves").alias("received_ts"), F.lit((1 << 63) - 1).alias("ingest_seq"), F.lit("book_reset").alias("event_type"))
    rows = rows.unionByName(exits, allowMissingColumns=True)
    if state is None:
        return rows
    met = state.join(bounded(own.select("market_id", "stay", "enters")), "market_id").where("enters >= last_ts")
    first = met.withColumn("_n", F.row_number().over(Window.partitionBy("market_id", "last_ts").orderBy("enters"))).where("_n = 1")
    newest = first.withColumn("_n", F.row_number().over(Window.partitionBy("stay").orderBy(F.desc("last_ts")))).where("_n = 1")
    books = newest.withColumn("market_id", F.col("stay"))
    return rows.unionByName(seeds(books, F.col("enters")), allowMissingColumns=True)


def grid_of_stays(events: DataFrame, members: DataFrame, end: Column, state: DataFrame | None = None, p: Params = DEFAULT) -> DataFrame:
    """The grid of an active set that changes: a row for each tick from a market's entry on and before its exit. The last trade
    price is at first that of the newest trade before the entry, and the status the catalog's at the entry. Volumes are of all
    trades of an interval, also of those before the entry."""
    step = p.interval_seconds
    own = staged(stays(members).withColumn("last", F.coalesce("leaves", end)), "stays")
    rows = staged(accepted(of_stays(events, members, state), p), "accepted")
    first = F.ceil(F.unix_micros(F.col("enters").cast("timestamp")) / (step * 1_000_000)).cast("bigint")
    final = F.when(F.col("leaves").isNull(), tick_before(end, step)).otherwise(tick_before(F.timestamp_micros(F.unix_micros(F.col("last").cast("timestamp")) - 1), step))
    starts = own.select(F.col("stay").alias("market_id"), F.col("status").alias("seed"), first.alias("first"), final.alias("final"))
    cells = _grid_from(rows, starts, end, p)
    trades = events.where("event_type = 'trade'")
    volumes = trades.groupBy("market_id", tick_time(tick_before(F.col("received_ts"), step) + 1, step).alias("ts")).agg(F.sum("trade_count").alias("_volume"))
    # The newest trade before each entry; a market has few entries.
    priced = trades.where("trade_price is not null").select("market_id", "received_ts", "ingest_seq", "trade_price")
    entries = own.select(F.col("market_id").alias("_m"), "stay", "enters")
    before = priced.join(bounded(entries), (F.col("market_id") == F.col("_m")) & (F.col("received_ts") < F.col("enters")))
    before = before.groupBy("stay").agg(F.max_by("trade_price", F.struct("received_ts", "ingest_seq")).alias("_price"))
    cells = cells.withColumnRenamed("market_id", "stay").join(bounded(own.select("stay", "market_id")), "stay").join(before, "stay", "left").join(volumes, ["market_id", "ts"], "left")
    cells = cells.withColumn("volume_micro", F.coalesce("_volume", F.lit(0)).cast("bigint")).withColumn("last_trade_micro", F.coalesce("last_trade_micro", "_price"))
    return cells.select("ts", "market_id", *[c for c in cells.columns if c not in ("ts", "market_id", "stay", "_volume", "_price")])


def stale_counts(cells: DataFrame, p: Params = DEFAULT) -> DataFrame:
    """ts, stale: how many open markets of the grid had no event for the stale limit at each tick."""
    idle = (F.unix_micros(F.col("ts").cast("timestamp")) - F.unix_micros(F.col("seen_ts").cast("timestamp"))) > p.stale_seconds * 1_000_000
    return cells.groupBy("ts").agg(F.count_if(idle & open_status(F.col("status"), F.lit(None).cast("string"))).alias("stale"))


def snapshots(cells: DataFrame, platform: str = DEFAULT.platform) -> DataFrame:
    """Grid rows in dollars and contracts, as the snapshots table has them."""
    mid = F.when(F.col("bid_micro").isNotNull() & F.col("ask_micro").isNotNull(), F.round((F.col("bid_micro") + F.col("ask_micro")) / 2 / MICRO, 6))
    money = lambda c: F.round(F.col(c).cast("double") / (MICRO * MICRO), 6)
    return cells.select(
        "ts", F.lit(platform).alias("platform"), "market_id", dollars(F.col("bid_micro")).alias("yes_bid"), dollars(F.col("ask_micro")).alias("yes_ask"), mid.alias("yes_mid"),
        money("bid_value").alias("bid_depth"), money("ask_value").alias("ask_depth"), "bid_levels", "ask_levels", dollars(F.col("volume_micro")).alias("volume"),
        dollars(F.col("last_trade_micro")).alias("last_trade_price"), "status", F.lit(None).cast("timestamp_ntz").alias("built_ts"),
    )


def stale(events: DataFrame, now: Column, p: Params = DEFAULT) -> DataFrame:
    """market_id, idle_seconds of markets without an event for the stale limit; of a status that counts as open."""
    strong = strong_status(F.col("lifecycle"), F.col("deactivated"))
    order = F.struct("received_ts", "ingest_seq")
    last = events.groupBy("market_id").agg(F.max("received_ts").alias("seen"), F.max_by(strong, F.when(strong.isNotNull(), order)).alias("status"))
    idle = F.floor((F.unix_micros(now.cast("timestamp")) - F.unix_micros(F.col("seen").cast("timestamp"))) / 1_000_000)
    return last.where(F.coalesce(F.col("status") == "active", F.lit(True))).select("market_id", idle.alias("idle_seconds")).where(F.col("idle_seconds") > p.stale_seconds)


def page(events: DataFrame, after_ts, after_seq: int, limit: int = 5000) -> DataFrame:
    """The events next after a place in the log, in order."""
    here = (F.col("received_ts") > F.lit(after_ts)) | ((F.col("received_ts") == F.lit(after_ts)) & (F.col("ingest_seq") > after_seq))
    return events.where(here).orderBy(*_TIME).limit(limit)
