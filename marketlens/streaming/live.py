"""Structured Streaming forms: the event log, windowed volumes, and books and their grid as keyed state."""

from __future__ import annotations

import json
from collections.abc import Iterator
from decimal import Decimal

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from ..functions.scalars import strong_status, tick_time
from ..operators.normalize import decoded, from_wire
from ..params import DEFAULT, MICRO, Params

#: Rows of the grid that a market's task holds before it hands them on.
ROWS = 10_000

_GRID = "market_id string, tick long, bid_micro long, ask_micro long, bid_value decimal(38,0), ask_value decimal(38,0), bid_levels int, ask_levels int, volume_micro long, last_trade_micro long, status string, crossed boolean, seen long"


def append_log(frames: DataFrame, path: str, checkpoint: str, seconds: int = 1) -> StreamingQuery:
    """Frames to the event log, by day of receipt; exactly once by the file sink's log."""
    rows = from_wire(frames).withColumn("day", F.to_date("received_ts"))
    return rows.writeStream.format("parquet").partitionBy("day").option("path", path).option("checkpointLocation", checkpoint).trigger(processingTime=f"{seconds} seconds").start()


def volumes(events: DataFrame, delay: str = "1 minute", p: Params = DEFAULT) -> DataFrame:
    """market_id, ts, volume of each interval, once the watermark has passed it. Receipt times are ours, so they come in order."""
    trades = decoded(events).where("event_type = 'trade'").withColumn("at", F.col("received_ts").cast("timestamp"))
    each = trades.withWatermark("at", delay).groupBy("market_id", F.window("at", f"{p.interval_seconds} seconds").alias("w"))
    return each.agg(F.sum("trade_count").alias("volume")).select("market_id", F.col("w.start").cast("timestamp_ntz").alias("ts"), "volume")


def _docs(events: DataFrame) -> DataFrame:
    """market_id, at, doc: each event with a time as JSON text of what the state needs of it."""
    rows = decoded(events).where("received_ts is not null").withColumn("at", F.col("received_ts").cast("timestamp"))
    strong = strong_status(F.col("lifecycle"), F.col("deactivated")).alias("strong")
    facts = F.struct(F.unix_micros("at").alias("at"), F.coalesce("ingest_seq", F.lit(0)).alias("n"), "event_type", "sequence", "yes", "no", "side", "price", "delta", "trade_price", "trade_count", strong, (F.col("lifecycle") == "created").alias("created"))
    return rows.select("market_id", "at", F.to_json(facts).alias("doc"))


def _in_order(docs: list[dict]) -> list[dict]:
    return sorted(docs, key=lambda r: (r["at"], r["n"]))


def _no_book() -> dict:
    return {"yes": {}, "no": {}, "anchored": False, "seq": None}


def _apply(book: dict, r: dict, p: Params) -> None:
    """An event on a book, by the rules of `replay`."""
    seq = r.get("sequence")
    if r["event_type"] == "orderbook_snapshot":
        for side in ("yes", "no"):
            levels = [(x["price"], x["size"]) for x in r.get(side) or []]
            book[side] = {str(price): size for price, size in levels if p.price_low <= price <= p.price_high and size > 0}
        book["anchored"], book["seq"] = True, seq
    elif r["event_type"] == "orderbook_delta" and book["anchored"] and (seq is None or book["seq"] is None or seq > book["seq"]):
        book["seq"] = seq if seq is not None else book["seq"]
        if r.get("side") in ("yes", "no") and "price" in r and "delta" in r and p.price_low <= r["price"] <= p.price_high:
            side, price = book[r["side"]], str(r["price"])
            if (size := side.pop(price, 0) + r["delta"]) > 0:
                side[price] = size


def _top(book: dict, p: Params) -> tuple:
    """bid, ask, values and numbers of levels within the depth band, as `replay.tops` has them."""
    yes, no = ({int(price): size for price, size in book[s].items()} for s in ("yes", "no"))
    bid, best_no = max(yes, default=None), max(no, default=None)
    near_yes = [x for x in yes if x >= bid - p.depth_band]
    near_no = [x for x in no if x >= best_no - p.depth_band]
    values = Decimal(sum(x * yes[x] for x in near_yes)), Decimal(sum((MICRO - x) * no[x] for x in near_no))
    return bid, None if best_no is None else MICRO - best_no, *values, len(near_yes), len(near_no)


def books(events: DataFrame, p: Params = DEFAULT) -> DataFrame:
    """market_id, ingest_seq, bid, ask (micro-dollars), levels, last_sequence of each market that a trigger has touched.

    State is one book for each market: its levels, whether it is anchored, its sequence. Rows of a trigger are put in order of
    receipt; the log's order across triggers is that of the source."""

    def step(key: tuple, batches: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        book = json.loads(state.get[0]) if state.exists else _no_book()
        last = 0
        for r in _in_order([json.loads(d) for b in batches for d in b["doc"]]):
            last = r["n"]
            _apply(book, r, p)
        state.update((json.dumps(book),))
        bid, ask = _top(book, p)[:2]
        yield pd.DataFrame({"market_id": [key[0]], "ingest_seq": [last], "bid": pd.array([bid], "Int64"), "ask": pd.array([ask], "Int64"), "levels": [len(book["yes"]) + len(book["no"])], "last_sequence": pd.array([book["seq"]], "Int64")})

    return _docs(events).groupBy("market_id").applyInPandasWithState(step, "market_id string, ingest_seq long, bid long, ask long, levels long, last_sequence long", "book string", "update", GroupStateTimeout.NoTimeout)


def grid(events: DataFrame, delay: str = "1 minute", idle_seconds: int | None = None, p: Params = DEFAULT) -> DataFrame:
    """The rows of `replay.grid` from a stream, each once the watermark has passed its tick: silent markets get theirs by timers.

    Events wait in the state until their tick is complete, so their order within the delay is of no matter; later ones are
    dropped. After `idle_seconds` without an event a market's state is dropped and its rows end; its next event begins it anew,
    without a book until a snapshot. Without `idle_seconds` rows go on as long as the stream does."""
    step = p.interval_seconds * 1_000_000
    names = [x.split()[0] for x in _GRID.split(", ")]
    whole = dict.fromkeys(["bid_micro", "ask_micro", "last_trade_micro"], "Int64")

    def begun(rows: list[dict]) -> dict:
        return {"book": _no_book(), "rows": rows, "next": None, "traded": None, "strong": None, "created": False, "seen": None}

    def fill(key: tuple, batches: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        m = json.loads(state.get[0]) if state.exists else begun([])
        new = [] if state.hasTimedOut else [json.loads(d) for b in batches for d in b["doc"]]
        rows, done, out = _in_order(m["rows"] + new), 0, []
        final = state.getCurrentWatermarkMs() * 1000 // step  # the last complete tick
        first = lambda: rows[done]["at"] // step + 1
        tick = m["next"] if m["next"] is not None else first()
        while tick is not None and tick <= final:
            due = done < len(rows) and rows[done]["at"] < tick * step
            if idle_seconds is not None and not due and tick * step - m["seen"] > idle_seconds * 1_000_000:
                m = begun([])
                tick = first() if done < len(rows) else None
                continue
            volume = 0
            while done < len(rows) and rows[done]["at"] < tick * step:
                r = rows[done]
                _apply(m["book"], r, p)
                volume += r.get("trade_count", 0)
                m["traded"], m["strong"] = r.get("trade_price", m["traded"]), r.get("strong", m["strong"])
                m["created"], m["seen"] = m["created"] or r.get("created", False), r["at"]
                done += 1
            top = _top(m["book"], p)
            crossed = top[0] is not None and top[1] is not None and top[0] > top[1]
            out.append((key[0], tick, *top, volume, m["traded"], m["strong"] or ("active" if m["created"] else None), crossed, m["seen"]))
            if crossed:
                m["book"] = _no_book()
            tick = m["next"] = tick + 1
            if len(out) == ROWS:
                yield pd.DataFrame(out, columns=names).astype(whole)
                out = []
        if tick is None:
            state.remove()
        else:
            m["rows"] = rows[done:]
            state.update((json.dumps(m),))
            state.setTimeoutTimestamp(tick * p.interval_seconds * 1000)
        if out:
            yield pd.DataFrame(out, columns=names).astype(whole)

    rows = _docs(events).withWatermark("at", delay).groupBy("market_id")
    cells = rows.applyInPandasWithState(fill, _GRID, "market string", "append", GroupStateTimeout.EventTimeTimeout)
    return cells.select(tick_time(F.col("tick"), p.interval_seconds).alias("ts"), *[n for n in names if n not in ("tick", "seen")], F.timestamp_micros("seen").cast("timestamp_ntz").alias("seen_ts"))
