"""Hot markets in blocks, long epochs, markets that come and go, audits that reset books."""

from __future__ import annotations

import datetime as dt
import itertools
import json
import random

import pytest
from pyspark.sql import functions as F

from marketlens.operators import audit, pairs, replay
from marketlens.params import Params

from tests.test_replay import T0, decoded, delta, ends, event, simulate, snapshot


def at(seconds):
    return T0 + dt.timedelta(seconds=seconds)


def random_log(r, n, markets="ABBBBBBBBB"):
    """Mostly one market, with ties in time, resets of the sequence and runs without a snapshot."""
    rows = []
    for k in range(n):
        m, seq, side = r.choice(markets), r.choice([None, k, k, max(0, k - 40)]), r.choice(["yes", "no"])
        if r.random() < 0.01:
            row = snapshot(k, [["0.47", "6"], ["0.46", "0"], ["0.44", "2"]], [["0.39", "3"]], seq, m)
        else:
            row = delta(k, side, r.choice(["0.47", "0.46", "0.43", "0.39", "0.02"]), str(r.randint(-7, 7)), seq, m)
        rows.append((at(k // 3), *row[1:]))
    return rows


@pytest.mark.parametrize("block", [1, 7, 60])
def test_blocks_of_a_hot_market_change_nothing(spark, block):
    rows = decoded(spark, random_log(random.Random(block), 1500)).cache()
    p = Params(hot_events=100, block_events=block)
    split, whole = replay.accepted(rows, p), replay.accepted(rows)
    assert split.where("block is not null").select("block").distinct().count() > (10 if block < 60 else 5) and whole.where("block is not null").count() == 0
    columns = ("market_id", "ingest_seq", "epoch", "ended", "anchored", "accepted", "applied", "floor")
    assert sorted(map(str, split.select(*columns).collect())) == sorted(map(str, whole.select(*columns).collect()))
    a, b = (sorted(map(str, replay.level_changes(x).collect())) for x in (split, whole))
    assert a == b and len(a) > 500
    got = {(r.market_id, r.side, r.price // 10_000): r["size"] / 1e6 for r in replay.last_levels(replay.level_changes(split)).collect()}
    assert got == simulate(random_log(random.Random(block), 1500))


def plain_grid(rows, step, n, band=3):
    """Top of book and depth of one market at ticks 1..n, event by event."""
    out, done, crossed = [], 0, False
    seen = []
    for tick in range(1, n + 1):
        while done < len(rows) and rows[done][0] < at(tick * step):
            seen.append(rows[done])
            done += 1
        book = simulate(seen)
        yes = {c: x for (_, s, c), x in book.items() if s == "yes"}
        no = {c: x for (_, s, c), x in book.items() if s == "no"}
        y, o = max(yes, default=None), max(no, default=None)
        out.append((y, None if o is None else 100 - o, sum(c >= y - band for c in yes), sum(c >= o - band for c in no), sum(c * x for c, x in yes.items() if c >= y - band), sum((100 - c) * x for c, x in no.items() if c >= o - band)))
        crossed = y is not None and o is not None and y + o > 100
        assert not crossed
    return out


@pytest.mark.parametrize("n", [1, 15, 16, 17, 255, 300, 700])
def test_books_of_a_long_epoch(spark, n):
    r = random.Random(n)
    rows = [snapshot(0, [[f"{c / 100:.2f}", "50"] for c in range(20, 40)], [[f"{c / 100:.2f}", "50"] for c in range(20, 45)], 0)]
    rows += [delta(10 * k + 1, side := r.choice(["yes", "no"]), f"{r.randint(15, 48) / 100:.2f}", str(r.choice([-60, -20, 5, 80])), None) for k in range(n - 1)]
    p = Params(interval_seconds=10)
    got = replay.grid(replay.accepted(decoded(spark, rows), p), ends(10 * n), p=p).orderBy("ts").collect()
    cents = lambda x: None if x is None else x // 10_000
    assert [(cents(x.bid_micro), cents(x.ask_micro), x.bid_levels, x.ask_levels, float(x.bid_value) / 1e10, float(x.ask_value) / 1e10) for x in got] == plain_grid(rows, 10, n)
    assert side in ("yes", "no") if n > 1 else True


def test_nodes_make_up_a_span(spark):
    r = random.Random(2)
    spans = [tuple(sorted((r.randrange(5000), r.randrange(5000)))) for _ in range(200)] + [(0, 0), (0, 4095), (15, 16), (16, 31), (1, 70_000)]
    rows = spark.createDataFrame(spans, "a long, b long").withColumn("nodes", replay._nodes(F.col("a"), F.col("b")))
    for a, b, nodes in rows.collect():
        ticks = list(itertools.chain.from_iterable(range(x.i * 16**x.k, (x.i + 1) * 16**x.k) for x in nodes))
        assert sorted(ticks) == list(range(a, b + 1)) and len(nodes) <= 2 * 15 * 5


def members(spark, *rows):
    return spark.createDataFrame(rows, "market_id string, status string, enters timestamp_ntz, leaves timestamp_ntz")


def test_a_market_that_leaves_has_no_rows_and_comes_back_with_its_checkpoint(spark):
    rows = decoded(spark, [
        event(1, "trade", None, yes_price_dollars="0.77", count_fp="5"), snapshot(70, [["0.31", "5"]], [], 1), delta(80, "yes", "0.33", "2", 2),
        delta(310, "yes", "0.34", "1", 3), event(330, "trade", None, yes_price_dollars="0.36", count_fp="3"),  # while it is away
        delta(500, "yes", "0.32", "4", 4),
    ])
    state = replay.checkpoint(replay.accepted(rows.where(F.col("received_ts") < ends(75))))
    who = members(spark, ("A", "open", at(60), at(250)), ("A", "back", at(420), None))
    of = lambda s: [(int((c.ts - T0).total_seconds()), c.bid_micro, c.last_trade_micro, c.status, c.volume_micro) for c in replay.grid_of_stays(rows, who, ends(600), s).orderBy("ts").collect()]
    stay = [(60, None, 770_000, "open", 5_000_000), (120, 330_000, 770_000, "open", 0), (180, 330_000, 770_000, "open", 0), (240, 330_000, 770_000, "open", 0)]
    back = lambda bid, later: [(420, None, 360_000, "back", 0), (480, bid, 360_000, "back", 0), (540, later, 360_000, "back", 0), (600, later, 360_000, "back", 0)]
    assert of(state) == stay + back(310_000, 320_000)  # the checkpoint was written before the second level came
    assert of(None) == stay + back(None, None)
    # A checkpoint is taken once, by the first stay after it, and none that is newer than the entry.
    third = members(spark, ("A", "open", at(60), at(250)), ("A", "back", at(420), at(430)), ("A", "third", at(480), None))
    assert [c.bid_micro for c in replay.grid_of_stays(rows, third, ends(600), state).where("status = 'third'").orderBy("ts").collect()] == [None, None, None]
    late = state.withColumn("last_ts", ends(490))
    assert [c.bid_micro for c in replay.grid_of_stays(rows, third, ends(600), late).where("status = 'third'").orderBy("ts").collect()] == [None, None, None]


def test_stays_end_and_begin_on_ticks(spark):
    rows = decoded(spark, [snapshot(60, [["0.31", "5"]], [], 1), delta(119, "yes", "0.35", "1", 2)])
    who = members(spark, ("A", None, at(60), at(180)), ("B", "quiet", at(61), at(119)))
    cells = replay.grid_of_stays(rows, who, ends(600)).orderBy("ts").collect()
    assert [(int((c.ts - T0).total_seconds()), c.market_id, c.bid_micro, c.status) for c in cells] == [(60, "A", None, None), (120, "A", 350_000, None)]


def test_audits_reset_what_the_replay_then_lacks(spark):
    rows = decoded(spark, [snapshot(1, [["0.31", "5"]], [], 1, "A"), snapshot(1, [["0.31", "5"]], [], 1, "B"), snapshot(400, [["0.22", "8"]], [], 1, "A")])
    calls = []

    def second_source(when):
        calls.append(when)
        return spark.createDataFrame([("A", "yes", 310_000, 50_000_000), ("B", "yes", 310_000, 5_000_000)] if len(calls) < 3 else [("A", "yes", 220_000, 8_000_000)], "market_id string, side string, price long, size long")

    verdicts, events = audit.feedback(rows, second_source, [ends(100), ends(250), ends(500)])
    said = {(int((v.ts - T0).total_seconds()), v.market_id): (v.status, v.levels_diff_count, v.action_taken, v.mem_yes, v.rest_yes) for v in verdicts.collect()}
    assert said == {
        (100, "A"): ("large_diff", 0, "book_reset", 1, 1), (100, "B"): ("no_diff", 0, "none", 1, 1),
        (250, "A"): ("small_diff", 1, "none", 0, 1), (250, "B"): ("no_diff", 0, "none", 1, 1),
        (500, "A"): ("no_diff", 0, "none", 1, 1), (500, "B"): ("small_diff", 1, "none", 1, 0),
    }
    cells = replay.grid(replay.accepted(events), ends(540)).where("market_id = 'A'").orderBy("ts").collect()
    assert [c.bid_micro for c in cells] == [310_000] + [None] * 5 + [220_000] * 3
    log = audit.audit_rows(verdicts.where("market_id = 'A'").limit(1), ends(9), spark.createDataFrame([("C", None), ("B", "timeout")], "market_id string, err string")).collect()
    assert [(x.market_id, x.status, x.action_taken) for x in log] == [("A", "large_diff", "book_reset"), ("B", "error", "none"), ("C", "error", "none")]
    assert [json.loads(x.details_json) for x in log][1:] == [{"err": "timeout"}, {"err": ""}] and json.loads(log[0].details_json)["mem_yes"] == 1


@pytest.mark.parametrize("most_keys", [1, 10, 64])
def test_overlap_of_large_sets_equals_all_pairs(spark, most_keys):
    r = random.Random(most_keys)
    sets = {f"m{k:03}": {f"e{min(r.randrange(60), r.randrange(60))}" for _ in range(r.choice([0, 2, 3, 4, 6, 12, 50]))} for k in range(120)}
    rows = spark.createDataFrame([(m, sorted(e)) for m, e in sets.items()], "market_id string, entities array<string>")
    got = {(x.a, x.b) for x in pairs.entity_pairs(rows, 3, most_keys).collect()}
    assert got == {(a, b) for a in sets for b in sets if a < b and len(sets[a] & sets[b]) >= 3}


def test_many_rows_are_not_broadcast_by_the_size_of_their_files(spark, monkeypatch):
    from marketlens.sources import stage

    few = stage.staged(spark.range(40), "few")
    plan = lambda: spark.range(50).join(stage.bounded(few), "id")._jdf.queryExecution().toString()
    assert "BroadcastHashJoin" in plan()
    monkeypatch.setattr(stage, "BROADCAST_ROWS", 10)
    assert "Broadcast" not in plan()
