"""Books against a sequential simulator, and the scenarios of a venue's log."""

from __future__ import annotations

import datetime as dt
import json
import random

from pyspark.sql import functions as F

from marketlens.operators import normalize, replay
from marketlens.params import Params

from tests.conftest import same_rows

T0 = dt.datetime(2024, 1, 1)
SCHEMA = "received_ts timestamp_ntz, ingest_seq long, market_id string, event_type string, sequence long, payload string"


def event(k, kind, seq=None, market="A", **payload):
    return (T0 + dt.timedelta(seconds=k), k, market, kind, seq, json.dumps(payload))


def snapshot(k, yes, no, seq=None, market="A"):
    return event(k, "orderbook_snapshot", seq, market, yes_dollars_fp=yes, no_dollars_fp=no)


def delta(k, side, price, qty, seq=None, market="A"):
    return event(k, "orderbook_delta", seq, market, side=side, price_dollars=price, delta_fp=qty)


def books(spark, rows):
    changes = replay.level_changes(replay.accepted(normalize.decoded(spark.createDataFrame(rows, SCHEMA))))
    return {(r.market_id, r.side, r.price // 10_000): r["size"] / 1e6 for r in replay.last_levels(changes).collect()}


def test_snapshot_and_delta(spark):
    rows = [snapshot(1, [["0.23", "7"], ["0.19", "12"]], [["0.66", "9"]], 31), delta(2, "yes", "0.27", "4", 32)]
    found = books(spark, rows)
    assert found == {("A", "yes", 23): 7, ("A", "yes", 19): 12, ("A", "yes", 27): 4, ("A", "no", 66): 9}
    end = F.lit(T0 + dt.timedelta(seconds=120)).cast("timestamp_ntz")
    last = replay.grid(replay.accepted(normalize.decoded(spark.createDataFrame(rows, SCHEMA))), end).orderBy("ts").collect()[-1]
    assert (last.bid_micro, last.ask_micro) == (270_000, 340_000)


def test_guards(spark):
    base = snapshot(1, [["0.33", "20"]], [], 70)
    assert books(spark, [base, delta(2, "yes", "0.35", "2", 77)])["A", "yes", 35] == 2  # a gap is tolerated
    assert books(spark, [base, delta(2, "yes", "0.33", "3", 71), delta(3, "yes", "0.33", "3", 71)])["A", "yes", 33] == 23
    assert books(spark, [delta(1, "yes", "0.33", "3", 71)]) == {}  # nothing before a snapshot
    assert books(spark, [base, delta(2, "yes", "0.33", "-21", 71)]) == {}
    # Out-of-band and malformed deltas count for the sequence.
    assert books(spark, [base, delta(2, "yes", "0.995", "8", 90), delta(3, "yes", "0.33", "3", 90)]) == {("A", "yes", 33): 20}
    assert books(spark, [base, delta(2, "yes", "a price", "8", 90), delta(3, "yes", "0.33", "3", 90)]) == {("A", "yes", 33): 20}


def test_malformed_levels_and_repeated_prices(spark):
    found = books(spark, [snapshot(1, [["0.62", "4"], {"p": 1}, 17, ["0.61"], "0.6", ["0.005", "2"], ["0.62", "6"], ["0.62", "0"], ["0.5", "x"]], [])])
    assert found == {("A", "yes", 62): 6}


def decoded(spark, rows):
    return normalize.decoded(spark.createDataFrame(rows, SCHEMA))


def ends(seconds):
    return F.lit(T0 + dt.timedelta(seconds=seconds)).cast("timestamp_ntz")


def test_a_reset_from_outside_empties_the_book_until_the_next_snapshot(spark):
    rows = [snapshot(1, [["0.3", "5"]], [], 1), delta(130, "yes", "0.31", "5", 2), snapshot(190, [["0.2", "1"]], [], 1)]
    resets = spark.createDataFrame([("A", T0 + dt.timedelta(seconds=70))], "market_id string, received_ts timestamp_ntz")
    cells = replay.grid(replay.accepted(replay.with_resets(decoded(spark, rows), resets)), ends(240)).orderBy("ts").collect()
    assert [c.bid_micro for c in cells] == [300_000, None, None, 200_000]
    assert replay.last_levels(replay.level_changes(replay.accepted(replay.with_resets(decoded(spark, rows[:2]), resets)))).count() == 0


def test_every_active_market_has_a_row_and_no_other(spark):
    rows = [snapshot(1, [["0.3", "5"]], [], 1, "A"), snapshot(1, [["0.3", "5"]], [], 1, "B")]
    active = spark.createDataFrame([("A", "active"), ("C", "paused")], "market_id string, status string")
    cells = replay.grid(replay.accepted(replay.of_active(decoded(spark, rows), active)), ends(120), active, ends(0)).orderBy("market_id", "ts").collect()
    assert [(c.market_id, c.bid_micro, c.status) for c in cells] == [("A", None, "active"), ("A", 300_000, "active"), ("A", 300_000, "active")] + [("C", None, "paused")] * 3


def test_resume_from_any_checkpoint_equals_all_events(spark):
    r = random.Random(12)
    rows = [snapshot(k, [["0.44", "3"]], [["0.21", "2"]], r.choice([None, k]), r.choice("ABCD")) if r.random() < 0.15 else delta(k, r.choice(["yes", "no"]), r.choice(["0.44", "0.43", "0.21"]), str(r.randint(-5, 4)), r.choice([None, k, k - 3]), r.choice("ABCD")) for k in range(400)]
    want = books(spark, rows)
    for cut in (3, 90, 250, 399):
        state = replay.checkpoint(replay.accepted(decoded(spark, rows[:cut])))
        left = replay.level_changes(replay.accepted(replay.resumed(state, decoded(spark, rows[max(0, cut - 5) :]))))
        assert {(x.market_id, x.side, x.price // 10_000): x["size"] / 1e6 for x in replay.last_levels(left).collect()} == want


def test_crossed_book_is_emitted_once_and_reset(spark):
    rows = [snapshot(1, [["0.73", "4"]], [["0.28", "17"]], 1), delta(70, "yes", "0.74", "1", 2)]
    end = F.lit(T0 + dt.timedelta(seconds=240)).cast("timestamp_ntz")
    cells = replay.grid(replay.accepted(normalize.decoded(spark.createDataFrame(rows, SCHEMA))), end).orderBy("ts").collect()
    assert [(c.crossed, c.bid_micro) for c in cells] == [(True, 730_000), (False, None), (False, None), (False, None)]


def simulate(rows):
    """The same rules, one event after another."""
    out, state = {}, {}
    for _, _, m, kind, seq, payload in rows:
        p, s = json.loads(payload), state.setdefault(m, {"on": False, "seq": None, "b": {}})
        if kind == "orderbook_snapshot":
            s.update(on=True, seq=seq, b={})
            for side in ("yes", "no"):
                for price, size in p[f"{side}_dollars_fp"]:
                    c = round(float(price) * 100)
                    if 1 <= c <= 99 and float(size) > 0:
                        s["b"][side, c] = float(size)
        elif kind == "orderbook_delta" and s["on"]:
            if seq is not None and s["seq"] is not None and seq <= s["seq"]:
                continue
            s["seq"] = seq if seq is not None else s["seq"]
            c = round(float(p["price_dollars"]) * 100)
            if 1 <= c <= 99:
                n = s["b"].pop((p["side"], c), 0) + float(p["delta_fp"])
                if n > 0:
                    s["b"][p["side"], c] = n
    for m, s in state.items():
        out |= {(m, side, c): n for (side, c), n in s["b"].items()}
    return out


def test_random_logs_equal_the_simulator(spark):
    r = random.Random(7)
    rows = []
    for k in range(3000):
        m, seq = r.choice("ABCDEFGHIJKLMNOPQRSTUVWXYZ"), r.choice([None, k, k, max(0, k - 60)])
        side = r.choice(["yes", "no"])
        price = lambda: f"{r.randint(0, 100) / 100:.2f}"
        if r.random() < 0.1:
            rows.append(snapshot(k, [[price(), str(r.randint(-1, 9))] for _ in range(4)], [[price(), str(r.randint(-1, 9))] for _ in range(4)], seq, m))
        else:
            rows.append(delta(k, side, r.choice(["0.40", "0.41", "0.42", price()]), str(r.randint(-9, 9)), seq, m))
    assert books(spark, rows) == simulate(rows)


def test_stream_equals_batch(spark, tmp_path):
    from marketlens.streaming import live

    r = random.Random(3)
    rows = [snapshot(k, [["0.40", "5"]], [["0.30", "5"]], k, r.choice("AB")) if k % 25 == 0 else delta(k, r.choice(["yes", "no"]), r.choice(["0.40", "0.35", "0.20"]), str(r.randint(-4, 6)), k - r.choice([0, 0, 3]), r.choice("AB")) for k in range(200)]
    spark.createDataFrame(rows[:90], SCHEMA).coalesce(1).write.parquet(str(tmp_path / "in/1"))
    spark.createDataFrame(rows[90:], SCHEMA).coalesce(1).write.parquet(str(tmp_path / "in/2"))
    stream = spark.readStream.schema(SCHEMA).option("maxFilesPerTrigger", 1).option("latestFirst", "false").parquet(str(tmp_path / "in/*"))
    q = live.books(stream).writeStream.outputMode("update").format("memory").queryName("books").option("checkpointLocation", str(tmp_path / "c")).trigger(availableNow=True).start()
    q.awaitTermination(120)
    newest = {r.market_id: r for r in spark.table("books").orderBy("ingest_seq").collect()}
    want = simulate(rows)
    for m in "AB":
        yes = [c for (k, s, c) in want if k == m and s == "yes"]
        no = [c for (k, s, c) in want if k == m and s == "no"]
        assert newest[m].levels == len(yes) + len(no)
        assert newest[m].bid == (max(yes) * 10_000 if yes else None)
        assert newest[m].ask == (1_000_000 - max(no) * 10_000 if no else None)
    assert live.volumes(stream, p=Params(interval_seconds=3600)).isStreaming


def test_grid_of_a_stream_equals_batch(spark, tmp_path):
    from marketlens.streaming import live

    r, rows = random.Random(5), []
    for k in range(200):
        m, kind = r.choice("AB"), r.random()
        if kind < 0.08:
            rows.append(snapshot(k, [["0.41", "5"], ["0.37", "2"]], [["0.33", "5"]], k, m))
        elif kind < 0.2:
            rows.append(event(k, "trade", None, m, yes_price_dollars=r.choice(["0.41", "0.52"]), count_fp=str(r.randint(1, 9))))
        elif kind < 0.26:
            rows.append(event(k, "lifecycle", None, m, event_type=r.choice(["created", "activated", "deactivated", "settled"])))
        else:
            rows.append(delta(k, r.choice(["yes", "no"]), r.choice(["0.41", "0.37", "0.33", "0.66"]), str(r.randint(-4, 6)), k - r.choice([0, 0, 3]), m))
    early, late = rows[:100] + rows[105:112], rows[100:105] + rows[112:]  # out of order within the delay
    r.shuffle(late)
    for i, part in enumerate((early, late, [delta(400, "yes", "0.41", "1", 1, "Z")], [delta(401, "yes", "0.41", "1", 2, "Z")])):
        spark.createDataFrame(part, SCHEMA).coalesce(1).write.parquet(str(tmp_path / f"in/{i}"))
    p = Params(interval_seconds=10)
    want = replay.grid(replay.accepted(decoded(spark, rows), p), ends(370), p=p).toPandas()
    assert want["crossed"].any()
    for name, idle in (("grid", None), ("grid_idle", 60)):
        stream = spark.readStream.schema(SCHEMA).option("maxFilesPerTrigger", 1).parquet(str(tmp_path / "in/*"))
        q = live.grid(stream, "30 seconds", idle, p).writeStream.outputMode("append").format("memory").queryName(name).option("checkpointLocation", str(tmp_path / name)).trigger(availableNow=True).start()
        q.awaitTermination(120)
        kept = want if idle is None else want[want["ts"] - want["seen_ts"] <= dt.timedelta(seconds=idle)]
        assert same_rows(spark.table(name).toPandas(), kept)
        assert idle is None or len(kept) < len(want)


def test_grid_with_typed_state_equals_batch(spark, tmp_path):
    from marketlens.operators import audit
    from marketlens.streaming import keyed

    r, rows = random.Random(15), []
    for k in range(200):
        m, kind = r.choice("AB"), r.random()
        if kind < 0.08:
            rows.append(snapshot(k, [["0.42", "5"], ["0.36", "2"], ["0.995", "4"]], [["0.31", "5"]], k, m))
        elif kind < 0.2:
            rows.append(event(k, "trade", None, m, yes_price_dollars=r.choice(["0.42", "0.57"]), count_fp=str(r.randint(1, 9))))
        elif kind < 0.26:
            rows.append(event(k, "lifecycle", None, m, event_type=r.choice(["created", "activated", "deactivated", "settled"])))
        else:
            rows.append(delta(k, r.choice(["yes", "no", "maybe"]), r.choice(["0.42", "0.36", "0.31", "0.66", "?"]), str(r.randint(-4, 6)), k - r.choice([0, 0, 3]), m))
    early, late = rows[:100] + rows[105:112], rows[100:105] + rows[112:]
    r.shuffle(late)
    for i, part in enumerate((early, late, [delta(400, "yes", "0.42", "1", 1, "Z")], [delta(401, "yes", "0.42", "1", 2, "Z")])):
        spark.createDataFrame(part, SCHEMA).coalesce(1).write.parquet(str(tmp_path / f"in/{i}"))
    p = Params(interval_seconds=10)
    accepted = replay.accepted(decoded(spark, rows), p)
    want = replay.grid(accepted, ends(370), p=p).toPandas()
    assert want["crossed"].any()
    spark.conf.set("spark.sql.streaming.stateStore.providerClass", keyed.STORE)
    try:
        for name, idle in (("typed", None), ("typed_idle", 60)):
            stream = spark.readStream.schema(SCHEMA).option("maxFilesPerTrigger", 1).parquet(str(tmp_path / "in/*"))
            q = keyed.grid(stream, "30 seconds", idle, p).writeStream.outputMode("append").format("memory").queryName(name).option("checkpointLocation", str(tmp_path / name)).trigger(availableNow=True).start()
            q.awaitTermination(240)
            kept = want if idle is None else want[want["ts"] - want["seen_ts"] <= dt.timedelta(seconds=idle)]
            assert same_rows(spark.table(name).toPandas(), kept)
            assert idle is None or len(kept) < len(want)
        books = keyed.stored_levels(spark, str(tmp_path / "typed")).where("market_id <> 'Z'")
        resets = replay.book_cells(accepted, ends(370), p).where("crossed").select("market_id", (F.col("tick") * 10).alias("s"))
        reset = replay.with_resets(decoded(spark, rows), resets.select("market_id", F.timestamp_micros(F.col("s") * 1_000_000 - 1).cast("timestamp_ntz").alias("received_ts")))
        own = replay.last_levels(replay.level_changes(replay.accepted(reset, p), p))
        assert books.count() > 0 and {v.status for v in audit.audit(own.select("market_id").union(books.select("market_id")), books, own).collect()} == {"no_diff"}
    finally:
        spark.conf.unset("spark.sql.streaming.stateStore.providerClass")


def _odd_log(spark):
    """Events of several markets, some at one time or tick, with books that cross and are reset."""
    r = random.Random(5)
    rows = []
    for k in range(240):
        at, market = r.randrange(60) * 7, r.choice("ABC")
        kind = r.choice(["snapshot", "delta", "delta", "trade", "life"])
        if kind == "snapshot":
            rows.append((at, snapshot, [[["0.4", "3"], ["0.39", "2"]], [["0.55", "4"]]]))
        elif kind == "delta":
            rows.append((at, delta, [r.choice(["yes", "no"]), r.choice(["0.38", "0.41", "0.5", "0.58"]), r.choice(["2", "-2", "5"])]))
        elif kind == "trade":
            rows.append((at, lambda k, market: event(k, "trade", None, market, yes_price_dollars="0.4", count_fp="2"), []))
        else:
            rows.append((at, lambda k, market: event(k, "lifecycle", None, market, event_type="created"), []))
        rows[-1] = rows[-1] + (market,)
    made = [f(at, *args, market=market) for at, f, args, market in rows]
    unique = [(*row[:1], n, *row[2:]) for n, row in enumerate(made)]
    return normalize.decoded(spark.createDataFrame(unique, SCHEMA))


def test_sums_of_runs_are_sums_of_ticks(spark):
    p, end = Params(interval_seconds=10), F.lit(T0 + dt.timedelta(seconds=500)).cast("timestamp_ntz")
    rows = replay.accepted(_odd_log(spark))
    rows.cache()
    cells = replay.grid(rows, end, p=p)
    want = cells.groupBy("market_id").agg(
        F.count(F.lit(1)).alias("ticks"), F.count("bid_micro").alias("with_bid"), F.count("ask_micro").alias("with_ask"), F.sum("bid_micro").alias("bids"), F.sum("ask_micro").alias("asks"),
        F.sum("bid_levels").alias("bid_levels"), F.sum("bid_value").alias("bid_value"), F.sum("volume_micro").alias("volume_micro"), F.count_if("crossed").alias("crossed"),
    )
    sums = replay.grid_sums(rows, end, p=p)
    assert same_rows(sums.toPandas(), want.toPandas())
    assert sum(r.crossed for r in want.collect()) > 0
    assert "sequence(tick" not in sums._jdf.queryExecution().optimizedPlan().toString()


def test_ticks_of_the_grid_are_not_shuffled_nor_broadcast(spark):
    end = F.lit(T0 + dt.timedelta(seconds=500)).cast("timestamp_ntz")
    plan = replay.grid(replay.accepted(_odd_log(spark)), end)._jdf.queryExecution().toString().split("== Physical Plan ==")[1]
    assert "BroadcastExchange" not in plan
    assert "Exchange" not in plan[: plan.index("Generate explode(sequence(tick")]


def test_a_book_from_before_the_first_tick_is_seen_there(spark):
    rows = normalize.decoded(spark.createDataFrame([snapshot(5, [["0.4", "3"]], [["0.5", "4"]])], SCHEMA))
    active = spark.createDataFrame([("A", "active")], "market_id string, status string")
    at = lambda s: F.lit(T0 + dt.timedelta(seconds=s)).cast("timestamp_ntz")
    cells = replay.grid(replay.accepted(rows), at(300), active, at(180)).orderBy("ts").collect()
    assert [c.bid_micro for c in cells] == [400_000] * 3
