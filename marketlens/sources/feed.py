"""Reading a live feed as a stream of frames: one connection for each shard of the tracked series.

    spark.dataSource.register(FeedSource)
    spark.readStream.format("feed").option("client", "package.module:factory").option("series", "A,B").option("shards", "4").load()

The factory makes a client of the options. Its end(shard) is the number of frames that the shard's connection has had so far, and
frames(shard, series, start, end) gives (received_ts, body) of the next ones from `start` on, at least one and at most up to
`end`. Frames must stay readable until their trigger is committed, as those of a broker or a recorded log do; so a lost executor
or a restarted query reads them again, and none is lost or read twice. Calls are retried like those of paged services.

A trigger takes all frames since the last one, or with the option `maxframes` at most so many of each shard, so that a backlog
drains in bounded triggers. For that the reader notes, in the file of the option `position` (in a folder that outlives the
driver), where it began and how far it has planned, before Spark hears of it; a restarted query goes on from there, and one whose
position is gone fails. With `start` = `tail` a new query
reads only frames that come after it began, else all from the first on.

A series always has the same shard (by its hash), so the frames of a market are in order: ingest_seq grows along each shard and
is unique over all of them, for one number of shards.
"""

from __future__ import annotations

import importlib
import json
import zlib
from collections.abc import Iterator

from pyspark.sql.datasource import DataSource, DataSourceStreamReader, InputPartition

from pyarrow import fs

from .paged import retried


class Shard(InputPartition):
    def __init__(self, shard: int, series: list[str], start: int, end: int):
        super().__init__(shard)
        self.shard, self.series, self.start, self.end = shard, series, start, end


class FeedReader(DataSourceStreamReader):
    def __init__(self, options: dict):
        self.options = dict(options)
        self.shards, self.tries = int(self.options.get("shards", 4)), int(self.options.get("tries", 5))
        self.series: dict[int, list[str]] = {}
        for s in sorted({x for x in self.options.get("series", "").split(",") if x}):
            self.series.setdefault(zlib.crc32(s.encode()) % self.shards, []).append(s)
        self.most = int(self.options.get("maxframes", 0))
        if self.most and "position" not in self.options:
            raise ValueError("maxframes needs the option position")
        self.noted: dict[str, dict[str, int]] | None = None

    def client(self):
        module, _, name = self.options["client"].partition(":")
        return getattr(importlib.import_module(module), name)(self.options)

    def ends(self) -> dict[str, int]:
        client = self.client()
        return {str(k): retried(lambda k=k: client.end(k), self.tries) for k in self.series}

    def _first(self) -> dict[str, int]:
        return self.ends() if self.options.get("start") == "tail" else {str(k): 0 for k in self.series}

    def initialOffset(self) -> dict:
        return self._begun()["first"] if self.most else self._first()

    def latestOffset(self) -> dict:
        """All there is, or a bounded step on from what was planned last, which is never behind what Spark has begun. Spark asks a
        new query for it before it asks where the query begins."""
        if not self.most:
            return self.ends()
        first, planned = self._begun()["first"], self._begun()["planned"]
        step = {k: max(planned.get(k, 0), min(end, planned.get(k, 0) + self.most)) for k, end in self.ends().items()}
        self._note({"first": first, "planned": step})
        return step

    def _begun(self) -> dict[str, dict[str, int]]:
        if self.noted is None:
            system, path = self._position()
            if system.get_file_info(path).type == fs.FileType.NotFound:
                first = self._first()
                self._note({"first": first, "planned": first})
            else:
                with system.open_input_stream(path) as source:
                    self.noted = json.loads(source.read())
        return self.noted

    def _note(self, position: dict[str, dict[str, int]]) -> None:
        system, path = self._position()
        with system.open_output_stream(path + ".new") as out:
            out.write(json.dumps(position).encode())
        system.move(path + ".new", path)
        self.noted = position

    def _position(self) -> tuple[fs.FileSystem, str]:
        where = self.options["position"]
        return fs.FileSystem.from_uri(where if ":" in where else "file://" + where)

    def partitions(self, start: dict, end: dict) -> list[Shard]:
        behind = [k for k, upto in end.items() if upto < start.get(k, 0)]
        if behind:
            raise ValueError(f"the position of shards {', '.join(behind)} is behind the query's: it is not that of its earlier runs")
        new = ((int(k), start.get(k, 0), upto) for k, upto in end.items())
        return [Shard(k, self.series.get(k, []), done, upto) for k, done, upto in new if done < upto]

    def read(self, partition: Shard) -> Iterator[tuple]:
        client, at = self.client(), partition.start
        while at < partition.end:
            frames = retried(lambda at=at: client.frames(partition.shard, partition.series, at, partition.end), self.tries)
            if not frames:
                raise ValueError(f"the feed has no frame {at} of shard {partition.shard}")
            for received_ts, body in frames:
                yield (received_ts, at * self.shards + partition.shard, body)
                at += 1


class FeedSource(DataSource):
    @classmethod
    def name(cls) -> str:
        return "feed"

    def schema(self) -> str:
        return "received_ts timestamp_ntz, ingest_seq long, body string"

    def streamReader(self, schema) -> FeedReader:
        return FeedReader(self.options)
