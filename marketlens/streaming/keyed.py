"""The grid of a stream with typed state: a map of levels, a list of waiting events, a timer for each market.

The rows are those of `live.grid` and of `replay.grid`. A trigger writes the levels that it has changed, not the book, and the
state can be read as a table while the query runs, as audits do. The session needs the RocksDB state store:

    spark.conf.set("spark.sql.streaming.stateStore.providerClass", keyed.STORE)
"""

from __future__ import annotations

from collections.abc import Iterator
from decimal import Decimal

from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming.stateful_processor import StatefulProcessor, StatefulProcessorHandle

from ..functions.scalars import strong_status, tick_time
from ..operators.normalize import decoded
from ..params import DEFAULT, MICRO, Params

STORE = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"

_EVENT = (
    "at bigint, n bigint, event_type string, sequence bigint, side string, price bigint, delta bigint, yes_prices array<bigint>, yes_sizes array<bigint>, "
    "no_prices array<bigint>, no_sizes array<bigint>, trade_price bigint, trade_count bigint, strong string, created boolean"
)
_NAMES = [x.split()[0] for x in _EVENT.split(", ")]
_HEAD = "tick bigint, anchored boolean, seq bigint, traded bigint, strong string, created boolean, seen bigint"
_CELL = "market_id string, tick bigint, bid_micro bigint, ask_micro bigint, bid_value decimal(38,0), ask_value decimal(38,0), bid_levels int, ask_levels int, volume_micro bigint, last_trade_micro bigint, status string, crossed boolean, seen bigint"


_row = Row(*[x.split()[0] for x in _CELL.split(", ")])


class Book:
    """A market's levels as they are in the state, and which of them have changed since."""

    def __init__(self, levels, head: tuple | None):
        self.stored = levels
        self.sizes = {(k[0], k[1]): v[0] for k, v in levels.iterator()}
        self.changed: set[tuple[str, int]] = set()
        self.emptied = False
        self.tick, self.anchored, self.seq, self.traded, self.strong, self.created, self.seen = head or (None, False, None, None, None, False, None)

    def empty(self, anchored: bool, seq: int | None) -> None:
        self.sizes, self.emptied, self.anchored, self.seq = {}, True, anchored, seq

    def put(self, side: str, price: int, size: int) -> None:
        self.changed.add((side, price))
        if size > 0:
            self.sizes[side, price] = size
        else:
            self.sizes.pop((side, price), None)

    def apply(self, e: dict, p: Params) -> None:
        """An event, by the rules of `replay`."""
        if e["event_type"] == "orderbook_snapshot":
            self.empty(True, e["sequence"])
            for side in ("yes", "no"):
                for price, size in zip(e[f"{side}_prices"] or [], e[f"{side}_sizes"] or [], strict=True):
                    if p.price_low <= price <= p.price_high and size > 0:
                        self.put(side, price, size)
        elif e["event_type"] == "orderbook_delta" and self.anchored and (e["sequence"] is None or self.seq is None or e["sequence"] > self.seq):
            self.seq = self.seq if e["sequence"] is None else e["sequence"]
            if e["side"] in ("yes", "no") and None not in (e["price"], e["delta"]) and p.price_low <= e["price"] <= p.price_high:
                self.put(e["side"], e["price"], self.sizes.get((e["side"], e["price"]), 0) + e["delta"])
        self.traded = self.traded if e["trade_price"] is None else e["trade_price"]
        self.strong, self.created, self.seen = e["strong"] or self.strong, self.created or bool(e["created"]), e["at"]

    def top(self, p: Params) -> tuple:
        sides = {s: {price: size for (side, price), size in self.sizes.items() if side == s} for s in ("yes", "no")}
        bid, best_no = max(sides["yes"], default=None), max(sides["no"], default=None)
        near = {s: [x for x in sides[s] if x >= best - p.depth_band] for s, best in (("yes", bid), ("no", best_no)) if best is not None}
        yes, no = near.get("yes", []), near.get("no", [])
        values = Decimal(sum(x * sides["yes"][x] for x in yes)), Decimal(sum((MICRO - x) * sides["no"][x] for x in no))
        return bid, None if best_no is None else MICRO - best_no, *values, len(yes), len(no)

    def store(self) -> None:
        if self.emptied:
            self.stored.clear()
        for key in self.sizes if self.emptied else self.changed:
            if key in self.sizes:
                self.stored.updateValue(key, (self.sizes[key],))
            elif self.stored.containsKey(key):
                self.stored.removeKey(key)

    @property
    def head(self) -> tuple:
        return self.tick, self.anchored, self.seq, self.traded, self.strong, self.created, self.seen


class Grid(StatefulProcessor):
    def __init__(self, idle_seconds: int | None, p: Params):
        self.idle, self.p, self.step = idle_seconds, p, p.interval_seconds * 1_000_000

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.levels = handle.getMapState("levels", "side string, price bigint", "size bigint")
        self.waiting = handle.getListState("waiting", _EVENT)
        self.head = handle.getValueState("head", _HEAD)

    def handleInputRows(self, key, rows: Iterator[Row], timerValues) -> Iterator[Row]:
        """Events wait until their tick is complete."""
        new = [tuple(r[n] for n in _NAMES) for r in rows]
        self.waiting.appendList(new)
        head = self.head.get()
        if head is None or head[0] is None:  # its first tick is still open
            self._wake(min(e[0] for e in self.waiting.get()) // self.step + 1)
        return iter([])

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[Row]:
        final = timerValues.getCurrentWatermarkInMs() * 1000 // self.step  # the last complete tick
        rows = sorted((dict(zip(_NAMES, e, strict=True)) for e in self.waiting.get()), key=lambda e: (e["at"], e["n"]))
        book, done = Book(self.levels, self.head.get()), 0
        first = lambda: rows[done]["at"] // self.step + 1 if done < len(rows) else None
        tick = book.tick if book.tick is not None else first()
        while tick is not None and tick <= final:
            due = done < len(rows) and rows[done]["at"] < tick * self.step
            if self.idle is not None and not due and tick * self.step - book.seen > self.idle * 1_000_000:
                book.empty(False, None)
                book.tick = book.traded = book.strong = book.seen = None
                book.created, tick = False, first()
                continue
            volume = 0
            while done < len(rows) and rows[done]["at"] < tick * self.step:
                book.apply(rows[done], self.p)
                volume += rows[done]["trade_count"] or 0
                done += 1
            top = book.top(self.p)
            crossed = None not in top[:2] and top[0] > top[1]
            yield _row(key[0], tick, *top, volume, book.traded, book.strong or ("active" if book.created else None), crossed, book.seen)
            if crossed:
                book.empty(False, None)
            tick = book.tick = tick + 1
        book.store()
        left = [tuple(e[n] for n in _NAMES) for e in rows[done:]]
        self.waiting.put(left) if left else self.waiting.clear()
        self.head.update(book.head) if tick is not None else self.head.clear()
        if tick is not None:
            self._wake(tick)

    def _wake(self, tick: int) -> None:
        at = tick * self.p.interval_seconds * 1000
        for other in list(self.handle.listTimers()):
            if other != at:
                self.handle.deleteTimer(other)
        self.handle.registerTimer(at)

    def close(self) -> None:
        pass


def events_of(log: DataFrame) -> DataFrame:
    """market_id, time and what the state keeps of each event that has a time."""
    rows = decoded(log).where("received_ts is not null").withColumn("time", F.col("received_ts").cast("timestamp"))
    part = lambda side, field: F.transform(side, lambda x: x[field])
    made = {
        "at": F.unix_micros("time"), "n": F.coalesce("ingest_seq", F.lit(0)), "yes_prices": part("yes", "price"), "yes_sizes": part("yes", "size"), "no_prices": part("no", "price"), "no_sizes": part("no", "size"),
        "strong": strong_status(F.col("lifecycle"), F.col("deactivated")), "created": F.col("lifecycle") == "created",
    }
    return rows.select("market_id", "time", *(made.get(n, F.col(n)).alias(n) for n in _NAMES))


def grid(log: DataFrame, delay: str = "1 minute", idle_seconds: int | None = None, p: Params = DEFAULT) -> DataFrame:
    """The rows of `live.grid`, each once the watermark has passed its tick."""
    rows = events_of(log).withWatermark("time", delay).groupBy("market_id")
    cells = rows.transformWithState(Grid(idle_seconds, p), _CELL, "append", "eventTime")
    names = [x.split()[0] for x in _CELL.split(", ")]
    return cells.select(tick_time(F.col("tick"), p.interval_seconds).alias("ts"), *[n for n in names if n not in ("tick", "seen")], F.timestamp_micros("seen").cast("timestamp_ntz").alias("seen_ts"))


def stored_levels(spark: SparkSession, checkpoint: str) -> DataFrame:
    """market_id, side, price, size of the books in the state of a query, as of its last complete trigger: the side of an audit
    that is the engine's own."""
    rows = spark.read.format("statestore").option("path", checkpoint).option("stateVarName", "levels").load()
    return rows.select("key.market_id", "user_map_key.side", "user_map_key.price", "user_map_value.size")
