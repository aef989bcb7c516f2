"""Shared helpers: the cluster's shared folder, written tables, size-checked joins, connected groups, word hashing."""

from __future__ import annotations

import re
import sys
import tempfile
import uuid
from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyarrow import fs
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: A side of a join is broadcast up to this many bytes, and shuffled beyond; and so are sorted arrays of so many hashes.
BROADCAST_BYTES, BROADCAST_ROWS = 8 << 20, 500_000

#: Bound of one of a worker's caches, in bytes.
CACHE_BYTES = 40 << 20

#: Rows and bytes of texts that a task works on together, unless a single text is larger.
BATCH_ROWS, BATCH_BYTES = 1000, 4 << 20

#: Bytes that are hashed together.
SLICE_BYTES = 1 << 18


def shared_dir(spark: SparkSession) -> str:
    """The folder that driver and executors share. Where none is set, as in tests, a new temporary one, in local mode only:
    executors elsewhere would not see it."""
    base = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not base:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        base = "file://" + tempfile.mkdtemp(prefix="spark-shared-")
        spark.sparkContext.setCheckpointDir(base)
    return base.rstrip("/")


def new_path(spark: SparkSession, label: str) -> str:
    return f"{shared_dir(spark)}/{label}-{uuid.uuid4().hex}"


#: Tables that `written` has made in this process, for `dropped`.
_made: list[str] = []


def written(df: DataFrame, label: str) -> DataFrame:
    """The rows of df from a table in the shared folder: cuts lineage and survives lost executors."""
    spark = df.sparkSession
    path = new_path(spark, label)
    df.write.parquet(path)
    _made.append(path)
    return spark.read.schema(df.schema).parquet(path)


def opened(uri: str) -> tuple[fs.FileSystem, str]:
    """File system and path of a URI; a path without a scheme is a file of the shared folder."""
    return fs.FileSystem.from_uri(re.sub("^s3[an]:", "s3:", uri) if ":" in uri else "file://" + uri)


def dropped(since: int, *more: str) -> None:
    """Deletes the tables that `written` has made since it had made so many, and others: for a caller whose output is complete."""
    for table_path in [*_made[since:], *more]:
        system, path = opened(table_path)
        system.delete_dir(path)
    del _made[since:]


def n_made() -> int:
    return len(_made)


def free_name(df: DataFrame, name: str) -> str:
    """The name, lengthened until no column of df has it."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name += "_"
    return name


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def small(df: DataFrame, limit: int | None = None) -> DataFrame:
    """A written table of narrow rows, hinted for broadcast only if it is counted and its rows fit into the bound of bytes:
    16 a row, 8 a number and 32 a digest."""
    row = 16 + sum(32 if f.dataType.typeName() in ("string", "binary") else 8 for f in df.schema)
    rows = (BROADCAST_BYTES if limit is None else limit) // row
    return F.broadcast(df) if df.limit(rows + 1).count() <= rows else df


def components(links: DataFrame) -> DataFrame:
    """doc, component (the smallest doc reachable) of every end of the links (a, b): large-star and small-star in turn,
    each a grouped minimum over written tables, until the links are stars."""
    both = lambda x: x.select("a", "b").union(x.select(F.col("b").alias("a"), F.col("a").alias("b")))
    links = written(links.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).where("a <> b").distinct(), "links")
    while True:
        lowest = both(links).groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
        large = both(links).where("b > a").join(lowest, "a").select(F.col("b").alias("a"), F.col("m").alias("b")).distinct()
        least = large.groupBy("a").agg(F.min("b").alias("m"))
        small = large.join(least, "a")
        small = small.where("b <> m").select(F.col("b").alias("a"), F.col("m").alias("b")).union(least.select("a", F.col("m").alias("b"))).distinct()
        after = written(small, "links")
        if not after.exceptAll(links).limit(1).count() and after.count() == links.count():
            break
        links = after
    return links.groupBy("a").agg(F.min("b").alias("b")).select(F.col("a").alias("doc"), F.col("b").alias("component"))


def summed(vectors: DataFrame) -> DataFrame:
    """slice, counts of the vectors (slice int, counts binary of float64), added up slice by slice. In two steps, so that a task
    adds up those of a part of the tasks."""

    def add(parts: pd.DataFrame) -> pd.DataFrame:
        return pd.DataFrame({"slice": parts["slice"][:1], "counts": [np.add.reduce([np.frombuffer(x, np.float64) for x in parts["counts"]]).tobytes()]})

    parts = vectors.withColumn("part", (F.rand(1) * 64).cast("int")).groupBy("slice", "part").applyInPandas(lambda x: add(x), "slice int, counts binary")
    return parts.groupBy("slice").applyInPandas(lambda x: add(x), "slice int, counts binary")


def text_of(column: str = "text") -> Column:
    return F.coalesce(F.col(column), F.lit(""))


def slices(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The batches in parts of BATCH_ROWS and BATCH_BYTES at most, or of one row, so that texts of any length stay within a
    worker's memory whatever the session's batch size. Spark itself ends a batch at 64 MB."""
    for batch in batches:
        waiting = [batch]
        while waiting:
            part = waiting.pop()
            n = part.num_rows
            if n > 1 and (n > BATCH_ROWS or part.nbytes > BATCH_BYTES):
                cut = min(n // 2, BATCH_ROWS) if part.nbytes <= BATCH_BYTES else n // 2
                waiting += [part.slice(cut), part.slice(0, cut)]
            else:
                yield part


class Bounded(dict):
    """A dictionary of texts that fills itself by `make` and whose bytes stay within a bound: when half the bound is reached
    its entries become the old ones, and those of the old ones that are asked for again come back."""

    def __init__(self, limit: int = CACHE_BYTES):
        super().__init__()
        self.limit, self.held, self.old = limit, 0, {}

    def make(self, key: str):
        raise NotImplementedError

    def __missing__(self, key: str):
        value = self.old.get(key)
        if value is None:
            value = self.make(key)
        if len(key) < 100:
            self.held += sys.getsizeof(key) + sys.getsizeof(value) + 100  # and its place
            if 2 * self.held > self.limit:
                self.old, self.held = dict(self), 0
                self.clear()
            self[key] = value
        return value


def of_letters(pattern: str, letters: str, digits: str = "0-9") -> re.Pattern:
    """A pattern of \\p{L} and \\p{N} for texts whose letters and digits are those given."""

    def known(m: re.Match) -> str:
        plain = m[0].replace(r"\p{L}", letters).replace(r"\p{N}", digits)
        return plain if m[0].startswith("[") else f"[{plain}]"

    return re.compile(re.sub(r"\[[^\]]*\]|\\p\{[LN]\}", known, pattern))


_resident: dict[tuple, object] = {}


def resident(key: tuple, make: Callable[[], object]):
    """An object that a worker keeps from task to task: one at a time, so that what one operator holds does not outlast it in
    workers that serve another."""
    if key not in _resident:
        _resident.clear()
        _resident[key] = make()
    return _resident[key]


_tables: dict[str, np.ndarray] = {}


def mix(h: np.ndarray) -> np.ndarray:
    """A bijective scrambling of 64-bit values (the finaliser of splitmix64)."""
    h = (h ^ (h >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    h = (h ^ (h >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(31))


def _byte_tables(letters: bool) -> tuple[np.ndarray, np.ndarray]:
    """Whether a byte is part of a word (anything but space and \\x09-\\x0D; or ASCII letters, digits and all beyond ASCII), and a 64-bit value for it; A-Z count as a-z."""
    if "solid" not in _tables:
        byte = np.arange(256)
        lower = np.where((byte >= 65) & (byte <= 90), byte + 32, byte).astype(np.uint64)
        _tables["value"] = mix(mix(lower + np.uint64(0x9E3779B97F4A7C15)))
        _tables["solid"] = ~((byte == 32) | ((byte >= 9) & (byte <= 13)))
        _tables["letters"] = (byte >= 128) | ((lower >= 97) & (lower <= 122)) | ((byte >= 48) & (byte <= 57))
    return _tables["letters" if letters else "solid"], _tables["value"]


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of an odd base and of its inverse, modulo 2**64."""
    if len(_tables.get("power", ())) < n:
        for name, base in (("power", 0x9FB21C651E98DF25), ("inverse", pow(0x9FB21C651E98DF25, -1, 1 << 64))):
            steps = np.full(max(n, SLICE_BYTES + 1), base, np.uint64)
            steps[0] = 1
            _tables[name] = np.cumprod(steps, dtype=np.uint64)
    return _tables["power"], _tables["inverse"]


def batch_words(column: pa.Array, letters: bool = False, places: bool = False) -> tuple[np.ndarray, ...]:
    """64-bit hashes of the lower-cased words of a column of texts, in order, and where each text's words start (one place
    more than texts). All at once over the column's bytes, with a polynomial hash of each word; nulls count as empty.
    places: also the first byte of each word and the one after its last, from the first text on."""
    if column.null_count:
        column = column.fill_null("")
    at = np.frombuffer(column.buffers()[1], np.int32)[column.offset : column.offset + len(column) + 1].astype(np.int64)
    if at[0] == at[-1]:
        none = np.zeros(0, np.int64)
        return (np.zeros(0, np.uint64), np.zeros(len(at), np.int64), none, none)[: 4 if places else 2]
    raw = np.frombuffer(column.buffers()[2], np.uint8)[at[0] : at[-1]]
    at = at - at[0]
    is_solid, values = _byte_tables(letters)
    solid = is_solid[raw]
    first, last = solid.copy(), solid.copy()
    first[1:] &= ~solid[:-1]
    last[:-1] &= ~solid[1:]
    edge = at[(at > 0) & (at < len(raw))]
    first[edge] = solid[edge]
    last[edge - 1] = solid[edge - 1]
    starts, ends = np.flatnonzero(first), np.flatnonzero(last) + 1
    out, a = np.empty(len(starts), np.uint64), 0
    while a < len(starts):
        b = max(a + 1, int(np.searchsorted(ends, starts[a] + SLICE_BYTES, "right")))
        low, high = int(starts[a]), int(ends[b - 1])
        power, inverse = _powers(high - low + 1)
        sums = np.zeros(high - low + 1, np.uint64)
        np.cumsum(values[raw[low:high]] * power[: high - low], out=sums[1:])
        out[a:b] = (sums[ends[a:b] - low] - sums[starts[a:b] - low]) * inverse[starts[a:b] - low]
        a = b
    return (mix(out), np.searchsorted(starts, at), starts, ends)[: 4 if places else 2]


def word_hashes(text: str | None) -> np.ndarray:
    """64-bit hashes of the lower-cased words of one text, in order."""
    return batch_words(pa.array([text or ""]))[0]


def shingle_hashes(words: np.ndarray, n: int) -> np.ndarray:
    """Hashes of the n-word shingles in order, with repeats; fewer words make one shingle, none make none."""
    if not len(words):
        return words
    n = min(n, len(words))
    out = np.zeros(len(words) - n + 1, np.uint64)
    for k in range(n):
        out = mix(out + words[k : len(words) - n + 1 + k]) + np.uint64(k + 1)
    return mix(out ^ np.uint64(n))
