"""Queries of what changes while books are kept: hot markets, audits that reset books, an active set that comes and goes."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import audit, replay
from ..params import Params
from ..sources.adapters import raw_events
from ..sources.stage import staged
from .catalogue import _ACC, _CELL, _EV, _LV, _TS, END, HOURLY, _grid, _lv, _second_source, _t, _whole, end, log, query

#: So small that many of the given markets are cut into blocks.
SPLIT = Params(hot_events=60, block_events=20)


@query(f"""WITH {_ACC} SELECT market_id, ingest_seq, CAST(epoch AS BIGINT) AS epoch, accepted, accepted AND dprice BETWEEN 1 AND 99 AS applied FROM ok WHERE event_type = 'orderbook_delta'""")
def seq_guard_by_blocks(spark, sf_dir):
    """As seq_guard_accepted, with hot markets cut into blocks."""
    return replay.accepted(log(spark, sf_dir), SPLIT).where("event_type = 'orderbook_delta'").select("market_id", "ingest_seq", "epoch", "accepted", "applied")


@query(f"""WITH {_LV} SELECT market_id, side, price * 10000 AS price, CAST(size * 10000 AS BIGINT) AS size FROM fi""")
def level_sizes_by_blocks(spark, sf_dir):
    """As level_sizes_final, with hot markets cut into blocks."""
    return replay.last_levels(replay.level_changes(staged(replay.accepted(log(spark, sf_dir), SPLIT), "accepted"), SPLIT))


# ---- audits that reset books

_PASSES = ("2024-01-12 00:00:00", "2024-01-20 00:00:00")


def _asked(book: str, plain: str) -> str:
    """Markets that a pass resets, by its books and the plain ones of its time, of which the second source is made."""
    return f"""SELECT market_id FROM (SELECT market_id, side, price, size, osize FROM {book} FULL JOIN (SELECT market_id, side, price, CASE WHEN (CAST(substr(market_id, 2) AS BIGINT) + price) % 7 = 0 THEN size * 3 ELSE size END AS osize FROM {plain} WHERE (CAST(substr(market_id, 2) AS BIGINT) + price) % 5 <> 0) USING (market_id, side, price))
  GROUP BY 1 HAVING count(*) FILTER ((size IS NULL) <> (osize IS NULL)) > 4 OR max(CASE WHEN size <> osize THEN abs(size - osize) / 100 / greatest(size / 100, osize / 100, 1.0) * 100.0 END) > 50"""


def _until(t: str) -> str:
    return _EV.replace("FROM e0)", f"FROM e0 WHERE ts <= TIMESTAMP '{t}')")


def _with_asked(ev: str, *passes: int) -> str:
    rows = "".join(f" UNION ALL BY NAME SELECT TIMESTAMP '{_PASSES[k]}' AS received_ts, 9223372036854775807 AS ingest_seq, market_id, 'book_reset' AS event_type FROM r{k}" for k in passes)
    return ev.replace("ev AS (", "ev1 AS (") + f", ev AS (SELECT * FROM ev1{rows})"


_LOOP = f"""b0 AS (WITH {_lv(_until(_PASSES[0]))} SELECT * FROM fi), r0 AS ({_asked("b0", "b0")}),
p1 AS (WITH {_lv(_until(_PASSES[1]))} SELECT * FROM fi), b1 AS (WITH {_lv(_with_asked(_until(_PASSES[1]), 0))} SELECT * FROM fi), r1 AS ({_asked("b1", "p1")})"""


def _loop(spark, sf_dir):
    """Two audit passes, the second over books that the first has reset; the second source follows the venue's own books."""
    events = log(spark, sf_dir)
    times = [F.lit(t).cast("timestamp_ntz") for t in _PASSES]

    def second_source(at):
        return _second_source(replay.last_levels(replay.level_changes(replay.accepted(events.where(F.col("received_ts") <= at)))))

    return audit.feedback(events, second_source, times)


@query(f"WITH {_LOOP}, {_grid(_with_asked(_EV, 0, 1))} SELECT {_TS} AS ts, {_CELL} FROM gr")
def grid_with_audit_feedback(spark, sf_dir):
    _, events = _loop(spark, sf_dir)
    return _whole(replay.grid(staged(replay.accepted(events), "accepted"), end(), p=HOURLY))


_CRC_TABLE = "ct AS (SELECT list_transform(range(256), lambda i: list_reduce(list_prepend(i, [1, 2, 3, 4, 5, 6, 7, 8]), lambda s, k: CASE WHEN s % 2 = 1 THEN xor(s // 2, 3988292384) ELSE s // 2 END)) AS tab)"


@query(f"""WITH {_LOOP}, {_CRC_TABLE},
  rr AS (SELECT DISTINCT market_id, 'S' || lpad(CAST(CAST(substr(market_id, 2) AS BIGINT) % 25 AS VARCHAR), 2, '0') AS s FROM (SELECT * FROM r0 UNION ALL SELECT * FROM r1) WHERE CAST(substr(market_id, 2) AS BIGINT) % 6 <> 0)
  SELECT CAST(xor(4294967295, list_reduce(list_prepend(CAST(4294967295 AS BIGINT), [CAST(ord(s[1]) AS BIGINT), ord(s[2]), ord(s[3])]), lambda c, b: xor(c >> 8, tab[(xor(c, b) & 255) + 1]))) % 4 AS INTEGER) AS shard, market_id FROM rr CROSS JOIN ct""")
def reset_routes(spark, sf_dir):
    """Where the markets that the passes reset are subscribed anew; every sixth market is not in the catalog."""
    verdicts, _ = _loop(spark, sf_dir)
    number = F.substring("market_id", 2, 6).cast("bigint")
    known = raw_events(spark, sf_dir).select("market_id").distinct().where(number % 6 != 0).withColumn("series_ticker", F.concat(F.lit("S"), F.lpad((number % 25).cast("string"), 2, "0")))
    return audit.routed_resets(audit.resets(verdicts), known)


# ---- an active set that changes

_STAYS = """SELECT market_id, 'open' AS status, TIMESTAMP '2024-01-05 00:00:00' AS enters, CASE WHEN n % 3 = 1 THEN TIMESTAMP '2024-01-12 06:30:00' END AS leaves FROM m WHERE n % 3 <> 2
  UNION ALL SELECT market_id, 'again', TIMESTAMP '2024-01-20 00:30:00', NULL FROM m WHERE n % 3 = 1
  UNION ALL SELECT market_id, NULL, TIMESTAMP '2024-01-08 00:00:00', TIMESTAMP '2024-01-18 00:00:00' FROM m WHERE n % 3 = 2"""
#: The events of each stay, whose name takes the place of the market_id.
_OWN = _EV.replace("ev AS (", "ev1 AS (") + ", ev AS (SELECT ev1.* REPLACE (stay AS market_id) FROM ev1 JOIN sy ON sy.market_id = ev1.market_id AND received_ts >= enters AND (leaves IS NULL OR received_ts < leaves)"
_SEEDED = _OWN + """ UNION ALL BY NAME SELECT stay AS market_id, enters AS received_ts, -1 AS ingest_seq, 'orderbook_snapshot' AS event_type, last_sequence AS sequence FROM st
  UNION ALL BY NAME SELECT stay AS market_id, leaves AS received_ts, 9223372036854775807 AS ingest_seq, 'book_reset' AS event_type FROM sy WHERE leaves IS NOT NULL)"""
_STAY_TICKS = f"""SELECT stay AS market_id, status AS seed, unnest(range(CAST(ceil(epoch_us(enters) / 3600000000) AS BIGINT), CASE WHEN leaves IS NULL THEN {_t(END, 3600)} ELSE (epoch_us(leaves) - 1) // 3600000000 END + 1)) AS tick FROM sy"""
_SEED_LEVELS = "SELECT market_id, epoch, received_ts, ingest_seq, c.side, c.price, c.size FROM (SELECT ok.market_id, epoch, received_ts, ingest_seq, unnest(lv) AS c FROM ok JOIN st ON st.stay = ok.market_id WHERE ingest_seq = -1)"
_CHANGING = f"""m AS (SELECT DISTINCT 'M' || lpad(CAST(user_id AS VARCHAR), 6, '0') AS market_id, user_id AS n FROM events),
sy AS (SELECT *, market_id || '@' || epoch_us(enters) AS stay FROM ({_STAYS})),
cb AS (WITH {_lv(_OWN + " WHERE received_ts < TIMESTAMP '2024-01-10 00:00:00')")}
  SELECT ok.market_id AS old, max(sequence) FILTER (event_type IN ('orderbook_snapshot', 'orderbook_delta')) AS last_sequence, any_value(lv) AS lv FROM ok JOIN mx ON ok.market_id = mx.market_id AND ok.epoch = mx.epoch
  LEFT JOIN (SELECT market_id, list({{'side': side, 'price': price, 'size': size}}) AS lv FROM fi GROUP BY 1) f ON f.market_id = ok.market_id WHERE anchored GROUP BY 1),
st AS (SELECT sy.stay, enters, last_sequence, lv FROM cb JOIN sy ON split_part(old, '@', 1) = sy.market_id AND enters = TIMESTAMP '2024-01-20 00:30:00'),
{_grid(_SEEDED, 3600, _STAY_TICKS, _SEED_LEVELS)},
vl AS (SELECT market_id, {_t("received_ts", 3600)} + 1 AS tick, sum(q) AS volume FROM ev1 WHERE event_type = 'trade' GROUP BY ALL),
pp AS (SELECT stay, arg_max(k, (received_ts, ingest_seq)) AS price FROM ev1 JOIN sy ON sy.market_id = ev1.market_id AND received_ts < enters WHERE event_type = 'trade' GROUP BY 1)"""


@query(f"""WITH {_CHANGING} SELECT {_TS.replace("tick", "gr.tick")} AS ts, sy.market_id, y * 10000 AS bid_micro, (100 - n) * 10000 AS ask_micro, CAST(coalesce(bl, 0) AS INTEGER) AS bid_levels, CAST(coalesce(al, 0) AS INTEGER) AS ask_levels, CAST(coalesce(bv, 0) * 100000000 AS BIGINT) AS bid_value, CAST(coalesce(av, 0) * 100000000 AS BIGINT) AS ask_value,
  CAST(coalesce(volume, 0) * 10000 AS BIGINT) AS volume_micro, coalesce(lastpx, price) * 10000 AS last_trade_micro, gr.status, coalesce(y > 100 - n, false) AS crossed FROM gr JOIN sy ON sy.stay = gr.market_id LEFT JOIN vl ON vl.market_id = sy.market_id AND vl.tick = gr.tick LEFT JOIN pp ON pp.stay = gr.market_id""")
def grid_of_changing_set(spark, sf_dir):
    """A third of the markets stays, a third leaves and comes back with the book of its checkpoint, a third comes and leaves."""
    events = log(spark, sf_dir)
    t = lambda text: F.lit(text).cast("timestamp_ntz")
    m = raw_events(spark, sf_dir).select("market_id").distinct().withColumn("n", F.substring("market_id", 2, 6).cast("bigint") % 3)
    stay = lambda where, status, enters, leaves: m.where(where).select("market_id", status.cast("string").alias("status"), enters.alias("enters"), leaves.alias("leaves"))
    first = stay("n <> 2", F.lit("open"), t("2024-01-05 00:00:00"), F.when(F.col("n") == 1, t("2024-01-12 06:30:00")))
    again = stay("n = 1", F.lit("again"), t("2024-01-20 00:30:00"), t(None))
    short = stay("n = 2", F.lit(None), t("2024-01-08 00:00:00"), t("2024-01-18 00:00:00"))
    members = staged(first.union(again).union(short), "members")
    written = t("2024-01-10 00:00:00")
    early = replay.of_stays(events.where(F.col("received_ts") < written), members.where(F.col("enters") < written).withColumn("leaves", t(None)))
    state = replay.checkpoint(staged(replay.accepted(early), "accepted")).withColumn("market_id", F.substring_index("market_id", "@", 1))
    return _whole(replay.grid_of_stays(events, members, end(), staged(state, "state"), HOURLY))
