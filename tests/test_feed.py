from __future__ import annotations

import datetime as dt
import json
import time
import zlib

import pytest
from pyspark.sql import functions as F

from marketlens.operators import normalize
from marketlens.sources.feed import FeedReader, FeedSource
from marketlens.sources.paged import Temporary
from marketlens.streaming import metrics

SERIES, SHARDS = ["RAIN", "SNOW", "WIND", "FROST", "HAIL"], 3


class Broker:
    """Frames of each shard from a file; every other call fails once."""

    def __init__(self, options):
        with open(options["file"]) as f:
            self.kept = json.load(f)
        self.calls = 0

    def end(self, shard):
        return len(self.kept.get(str(shard), []))

    def frames(self, shard, series, start, end):
        self.calls += 1
        if self.calls % 2:
            raise Temporary
        assert all(zlib.crc32(s.encode()) % SHARDS == shard for s in series)
        return [(dt.datetime.fromisoformat(at), body) for at, body in self.kept[str(shard)][start : min(end, start + 4)]]


def feed(n):
    """Frames 0..n-1 by shard: a delta of a market, or something that is none."""
    out = {}
    for k in range(n):
        series = SERIES[k % len(SERIES)]
        body = json.dumps({"type": "orderbook_delta", "seq": k, "msg": {"market_ticker": f"{series}-1", "price_dollars": "0.41", "delta_fp": "2", "side": "yes"}}) if k % 7 else "no frame"
        out.setdefault(str(zlib.crc32(series.encode()) % SHARDS), []).append([f"2024-03-01T00:{k // 60:02}:{k % 60:02}", body])
    return out


def until(f, seconds=30):
    end = time.time() + seconds
    while not f() and time.time() < end:
        time.sleep(0.2)
    assert f()


def test_feed_is_read_once_over_restarts(spark, tmp_path):
    spark.dataSource.register(FeedSource)
    progress = metrics.Progress()
    spark.streams.addListener(progress)
    path = tmp_path / "feed.json"
    frames = lambda: spark.readStream.format("feed").option("client", "tests.test_feed:Broker").option("file", str(path)).option("series", ",".join(SERIES)).option("shards", SHARDS).load()
    try:
        for n in (40, 40, 103):  # the second run finds nothing new
            path.write_text(json.dumps(feed(n)))
            q = frames().writeStream.format("parquet").option("path", str(tmp_path / "out")).option("checkpointLocation", str(tmp_path / "c")).queryName("feed").trigger(availableNow=True).start()
            assert q.awaitTermination(120)
        until(lambda: sum(r[3] for r in progress.rows) == 103)
    finally:
        spark.streams.removeListener(progress)
    rows = spark.read.parquet(str(tmp_path / "out"))
    got = {}
    for r in rows.orderBy("ingest_seq").collect():
        got.setdefault(str(r.ingest_seq % SHARDS), []).append([r.received_ts.isoformat(), r.body])
    assert got == feed(103)
    assert rows.select("ingest_seq").distinct().count() == 103
    assert normalize.from_wire(rows).count() == sum(k % 7 != 0 for k in range(103))
    told = metrics.rates(progress.table(spark)).first()
    assert (told["query"], told["rows"], told["dropped_late"]) == ("feed", 103, 0) and told["rows_per_second"] > 0 and told["mean_batch_ms"] > 0


def test_offsets_of_shards():
    reader = FeedReader({"client": "tests.test_feed:Broker", "series": "RAIN,SNOW,,RAIN", "shards": "4"})
    shards = {zlib.crc32(s.encode()) % 4 for s in ("RAIN", "SNOW")}
    assert reader.initialOffset() == {str(k): 0 for k in reader.series} and set(reader.series) == shards
    some = str(min(shards))
    assert [(x.start, x.end) for x in reader.partitions({some: 3}, {some: 9})] == [(3, 9)]
    assert [(x.start, x.end) for x in reader.partitions({}, {some: 9})] == [(0, 9)]  # a shard that is new
    assert reader.partitions({some: 9}, {some: 9}) == []
    assert FeedReader({"client": "x:y"}).initialOffset() == {}


def test_lost_frames_are_an_error(tmp_path):
    path = tmp_path / "feed.json"
    path.write_text(json.dumps(feed(10)))
    reader = FeedReader({"client": "tests.test_feed:Broker", "file": str(path), "series": ",".join(SERIES), "shards": str(SHARDS)})
    end = reader.latestOffset()
    k = next(iter(end))
    (part,) = reader.partitions({k: end[k]}, {k: end[k] + 2})
    with pytest.raises(ValueError, match="has no frame"):
        list(reader.read(part))


def test_rates_and_liveness(spark):
    progress = metrics.Progress(keep=2)
    assert metrics.rates(progress.table(spark)).count() == 0
    for k, ms in enumerate((5, 0, 0)):
        progress.rows.append(("q", k, f"2024-03-01T00:0{k}:00.000Z", 10, ms, 1, 100, k, None))
    table = progress.table(spark)
    assert {r.batch_id for r in table.collect()} == {1, 2}
    r = metrics.rates(table).first()
    assert (r.batches, r.rows, r.rows_per_second, r.mean_batch_ms, r.dropped_late) == (2, 20, None, 0.0, 3)
    for at, alive in (("00:03:30", True), ("00:03:31", False)):
        assert metrics.liveness(table, F.lit(f"2024-03-01 {at}").cast("timestamp")).first()["alive"] == alive


def bounded_options(path, tmp_path, **more):
    return {"client": "tests.test_feed:Broker", "file": str(path), "series": ",".join(SERIES), "shards": str(SHARDS), "maxframes": "7", "position": str(tmp_path / "position.json")} | more


def test_a_backlog_drains_in_bounded_triggers_over_restarts(spark, tmp_path):
    spark.dataSource.register(FeedSource)
    path = tmp_path / "feed.json"
    for n in (60, 95):
        path.write_text(json.dumps(feed(n)))
        source = spark.readStream.format("feed").options(**bounded_options(path, tmp_path)).load()
        q = source.writeStream.format("parquet").option("path", str(tmp_path / "out")).option("checkpointLocation", str(tmp_path / "c")).trigger(processingTime="100 milliseconds").start()
        try:
            until(lambda n=n: q.exception() is not None or sum(p["numInputRows"] for p in q.recentProgress) >= n - (60 if n == 95 else 0), 90)
            sizes = [p["numInputRows"] for p in q.recentProgress if p["numInputRows"]]
            assert len(sizes) > 1 and max(sizes) <= 7 * SHARDS
        finally:
            q.stop()
    rows = spark.read.parquet(str(tmp_path / "out"))
    assert rows.count() == rows.select("ingest_seq").distinct().count() == 95


def test_a_new_query_may_begin_at_the_tail(tmp_path):
    path = tmp_path / "feed.json"
    path.write_text(json.dumps(feed(20)))
    options = bounded_options(path, tmp_path, start="tail", tries="3")
    reader = FeedReader(options)
    first = reader.initialOffset()
    assert first == reader.ends() and sum(first.values()) == 20 and reader.latestOffset() == first
    path.write_text(json.dumps(feed(60)))
    again = FeedReader(options)  # restarted: it goes on from what was planned
    assert again.latestOffset() == {k: min(again.ends()[k], first[k] + 7) for k in first}
    planned = again.noted["planned"]
    assert again.initialOffset() == first and sum(x.end - x.start for x in again.partitions(first, planned)) == sum(planned.values()) - 20 > 0
    with pytest.raises(ValueError, match="position"):
        FeedReader({"client": "x:y", "maxframes": "3"})
    lost = FeedReader(options | {"position": str(tmp_path / "other"), "start": "0"})
    with pytest.raises(ValueError, match="is behind"):
        lost.partitions(first, lost.latestOffset())
