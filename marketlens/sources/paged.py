"""Reading paged services as a data source: keys are dealt to a few connections, pages followed by their cursor.

    spark.dataSource.register(PagedSource)
    spark.read.format("paged").schema("doc string").option("client", "package.module:factory").option("keys", "A,B").load()

The factory makes, on the executor, a client whose page(key, cursor) returns (documents, next cursor or None). Calls are
retried with a jittered, growing delay and paced: `persecond` is the rate of all `connections` together, each of which has its
share of it. A client raises Missing for a key that does not exist, which gives no rows, or a null document with the option
`misses`.

For a table of keys there is `lookup`: keys stay in their partitions and never pass the driver.
"""

from __future__ import annotations

import importlib
import json
import random
import time
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition


class Missing(Exception):
    """The service has no such key."""


class Temporary(Exception):
    """The call may succeed if it is repeated."""


class TokenBucket:
    def __init__(self, per_second: float, burst: float, clock: Callable[[], float] = time.monotonic, sleep: Callable[[float], None] = time.sleep):
        self.rate, self.burst, self.clock, self.sleep = per_second, burst, clock, sleep
        self.tokens, self.at = float(burst), clock()

    def take(self) -> None:
        while True:
            now = self.clock()
            self.tokens, self.at = min(self.burst, self.tokens + (now - self.at) * self.rate), now
            if self.tokens >= 1:
                self.tokens -= 1
                return
            self.sleep((1 - self.tokens) / self.rate)


def retried(call: Callable, tries: int = 5, first: float = 0.5, most: float = 30.0, sleep: Callable[[float], None] = time.sleep):
    """The call's result; a temporary failure is repeated after a random part of a doubling delay."""
    for k in range(tries):
        try:
            return call()
        except Temporary:
            if k + 1 == tries:
                raise
            sleep(random.random() * min(most, first * 2**k))


class Connection(InputPartition):
    def __init__(self, keys: list[str], share: float):
        super().__init__(keys)
        self.keys, self.share = keys, share


def _client(options: dict):
    module, _, name = options["client"].partition(":")
    return getattr(importlib.import_module(module), name)()


def fetched(options: dict, share: float) -> Callable[[str], Iterator[str | None]]:
    """A function that gives a key's documents as JSON, page after page; at a share of the options' rate."""
    client, tries, misses = _client(options), int(options.get("tries", 5)), options.get("misses", "false") == "true"
    bucket = TokenBucket(float(options.get("persecond", 8)) * share, max(1, float(options.get("burst", 8)) * share))

    def documents(key: str) -> Iterator[str | None]:
        cursor = None
        while True:

            def page(cursor=cursor):
                bucket.take()
                return client.page(key, cursor)

            try:
                found, cursor = retried(page, tries)
            except Missing:
                found, cursor = [None] if misses else [], None
            for d in found:
                yield None if d is None else json.dumps(d)
            if not cursor:
                return

    return documents


class PagedReader(DataSourceReader):
    def __init__(self, options: dict):
        self.options = dict(options)
        given = self.options.get("keys")
        self.keys = None if given is None else [k for k in given.split(",") if k]

    def partitions(self) -> list[Connection]:
        if self.keys is None:
            raise ValueError("give the option keys, or use lookup for a table of keys")
        n = min(len(self.keys), int(self.options.get("connections", 4)))
        return [Connection(self.keys[k::n], 1 / n) for k in range(n)]

    def read(self, partition: Connection) -> Iterator[tuple]:
        documents = fetched(self.options, partition.share)
        for key in partition.keys:
            for d in documents(key):
                yield (key, d)


def lookup(keys: DataFrame, client: str, column: str = "key", **options) -> DataFrame:
    """key, doc of each distinct key of a table: the service is asked from as many tasks as there are connections, which share
    its rate. A key that does not exist gives a null document. Options as those of the source."""
    n = int(options.get("connections", 4))
    settings = {k: str(v) for k, v in options.items()} | {"client": client, "misses": "true"}

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        documents = fetched(settings, 1 / n)
        for batch in batches:
            for key in batch.column("key").to_pylist():
                docs = list(documents(key))
                yield pa.RecordBatch.from_arrays([pa.array([key] * len(docs), pa.string()), pa.array(docs, pa.string())], ["key", "doc"])

    rows = keys.select(F.col(column).cast("string").alias("key")).where("key is not null").distinct()
    return rows.repartition(n, "key").mapInArrow(run, "key string, doc string")


class PagedSource(DataSource):
    @classmethod
    def name(cls) -> str:
        return "paged"

    def schema(self) -> str:
        return "key string, doc string"

    def reader(self, schema) -> PagedReader:
        return PagedReader(self.options)
