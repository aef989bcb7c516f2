"""Importance resampling towards a target distribution, by hashed n-gram features.

Features are all runs of one to three consecutive words (lower-cased A-Z; ASCII letters and digits and all beyond ASCII),
joined by a space, with repeats. A task holds the features of up to BATCH_WORDS words as a word trie of three levels: a node is
a run of words, its parent the run without the last one. A node has its count and the CRC state of its text, which continues
the parent's by the word's bytes; so a text is hashed once for each node and not for each place. Nodes are told apart by 64-bit
hashes of words, exact but for chance. Counts of a task's nodes go into one vector of buckets (the CRC modulo BUCKETS), and the
vectors of all tasks are added up. For scores the same walk is done with each node's gain in place of its count.

With S and T features of the corpus and the target, s and t of them in a bucket, the bucket's gain is
floor(1000 ln((t + 1)(S + BUCKETS) / ((s + 1)(T + BUCKETS)))) and a text's weight the sum of its features' gains. Score adds
Gumbel noise that depends on the doc_id, so that the k largest scores are a sample without replacement in proportion to
exp(weight / 1000). Of the texts with at least MIN_WORDS words, PERCENT in a hundred are drawn.

Null texts count as empty ones: no features, weight 0, never drawn. All rows count into S, repeated ones and those without
doc_id too; a row without doc_id has a weight but no noise, so score and rank are null and it is none of the N that may be
drawn. Rows of one doc_id have the same noise; equal ones get ranks next to each other. An empty corpus gives no rows, and an
empty target gains from its empty buckets alone. Other columns are ignored. A text is held whole by the task that reads it.
"""

from __future__ import annotations

import hashlib
import math
import zlib
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import batch_words, slices, summed, table, text_of, written

BUCKETS, LONGEST, MIN_WORDS, PERCENT, SEED = 10_000, 3, 20, 5, 42
#: Words whose runs a task holds as one trie (or one text's, if it has more).
BATCH_WORDS = 1 << 20
#: Rows of a part of the ranking.
PART_ROWS = 100_000


# ---- CRC states


@lru_cache(maxsize=64)
def _zeros(power: int) -> np.ndarray:
    """What 2**power zero bytes make of each byte of a CRC state, [place, byte]: appending zeros is linear."""
    if power:
        return _after(_zeros(power - 1), power - 1)
    byte = np.arange(256, dtype=np.uint32)
    for _ in range(8):
        byte = np.where(byte & 1, (byte >> 1) ^ np.uint32(0xEDB88320), byte >> 1)
    state = np.arange(256, dtype=np.uint32) << (8 * np.arange(4, dtype=np.uint32))[:, None]
    return (state >> np.uint32(8)) ^ byte[state & np.uint32(255)]


def _after(state: np.ndarray, power: int) -> np.ndarray:
    t = _zeros(power)
    return t[0, state & 255] ^ t[1, (state >> 8) & 255] ^ t[2, (state >> 16) & 255] ^ t[3, state >> 24]


def continued(state: np.ndarray, own: np.ndarray, length: np.ndarray) -> np.ndarray:
    """CRCs of texts of given CRC to which others, of CRC `own` and so many bytes, are appended."""
    out = state.copy()
    for power in range(int(length.max(initial=0)).bit_length()):
        some = np.flatnonzero((length >> power) & 1)
        out[some] = _after(out[some], power)
    return out ^ own


# ---- the trie of a batch


class Trie:
    """The runs of words of a batch of texts. levels: for each length of a run, the places where such runs begin, the node
    of each, and the nodes' counts and CRCs; begin: where each text's words begin."""

    def __init__(self, column: pa.Array):
        hashes, self.begin, starts, ends = batch_words(column, letters=True, places=True)
        self.levels: list[tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]] = []
        if not len(hashes):
            return
        raw = memoryview(column.buffers()[2])
        base = int(np.frombuffer(column.buffers()[1], np.int32)[column.offset])
        words, seen, node, count = np.unique(hashes, return_index=True, return_inverse=True, return_counts=True)
        texts = [bytes(raw[base + a : base + b]).lower() for a, b in zip(starts[seen].tolist(), ends[seen].tolist(), strict=True)]  # of bytes: A-Z only
        crc = np.array([zlib.crc32(x) for x in texts], np.uint32)
        step = np.array([zlib.crc32(b" " + x) for x in texts], np.uint32)
        length = np.array([len(x) + 1 for x in texts], np.int64)
        at, word = np.arange(len(hashes)), node
        self.levels.append((at, node, count, crc))
        last = np.zeros(len(hashes) + 1, np.int64)  # words of a text from each place on
        last[:-1] = np.repeat(self.begin[1:], np.diff(self.begin)) - at
        for n in range(2, LONGEST + 1):
            more = last[at] >= n
            at = at[more]
            if not len(at):
                break
            keys, node, count = np.unique(node[more] * len(words) + word[at + n - 1], return_inverse=True, return_counts=True)
            parent, added = np.divmod(keys, len(words))
            crc = continued(crc[parent], step[added], length[added])
            self.levels.append((at, node, count, crc))

    def buckets(self) -> np.ndarray:
        """The counts of the nodes, by bucket."""
        return sum((np.bincount(crc % BUCKETS, count, BUCKETS) for _, _, count, crc in self.levels), np.zeros(BUCKETS))

    def weights(self, gains: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Words, features and the sum of their gains of each text."""
        n = np.diff(self.begin)
        total = np.zeros(int(self.begin[-1]) + 1, np.int64)
        for at, node, _, crc in self.levels:
            total[at] += gains[crc % BUCKETS][node]
        sums = np.r_[0, np.cumsum(total)]
        features = sum((np.maximum(n - k, 0) for k in range(LONGEST)), np.zeros(len(n), np.int64))
        return n, features, sums[self.begin[1:]] - sums[self.begin[:-1]]


def gathered(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Batches together, until their texts have about BATCH_WORDS words."""
    held, size = [], 0
    for batch in slices(batches):
        held.append(batch)
        size += batch.column("text").nbytes
        if size >= 6 * BATCH_WORDS:
            yield from pa.Table.from_batches(held).combine_chunks().to_batches()
            held, size = [], 0
    if held:
        yield from pa.Table.from_batches(held).combine_chunks().to_batches()


# ---- the model


def bucket_counts(docs: DataFrame) -> np.ndarray:
    """The features of all texts, by bucket."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(BUCKETS)
        for batch in gathered(batches):
            total += Trie(batch.column("text")).buckets()
        yield pa.RecordBatch.from_arrays([pa.array([0], pa.int32()), pa.array([total.tobytes()])], ["slice", "counts"])

    rows = summed(docs.select(text_of().alias("text")).mapInArrow(count, "slice int, counts binary")).collect()  # one row
    return np.frombuffer(rows[0]["counts"]) if rows else np.zeros(BUCKETS)


def gains_of(corpus: np.ndarray, target: np.ndarray) -> np.ndarray:
    """The gain of each bucket, in thousandths."""
    S, T = float(corpus.sum()), float(target.sum())
    return np.array([math.floor(1000 * math.log((t + 1) * (S + BUCKETS) / ((s + 1) * (T + BUCKETS)))) for s, t in zip(corpus.tolist(), target.tolist(), strict=True)], np.int64)


def noise(doc_id: int | None, seed: int = SEED) -> int | None:
    if doc_id is None:
        return None
    h = int(hashlib.sha256(f"{seed}:{doc_id}".encode()).hexdigest()[:8], 16)
    return math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296)))


def scored(docs: DataFrame, gains: np.ndarray, seed: int = SEED) -> DataFrame:
    """doc_id, n_words, n_features, weight, score of each row."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in gathered(batches):
            words, features, weight = Trie(batch.column("text")).weights(gains)
            ids = batch.column("doc_id")
            score = [None if e is None else w + e for w, e in zip(weight.tolist(), (noise(k, seed) for k in ids.to_pylist()), strict=True)]
            yield pa.RecordBatch.from_arrays([ids, *(pa.array(x, pa.int64()) for x in (words, features, weight, score))], ["doc_id", "n_words", "n_features", "weight", "score"])

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), text_of().alias("text")).mapInArrow(run, "doc_id long, n_words long, n_features long, weight long, score long")


def drawn(rows: DataFrame, percent: int = PERCENT, min_words: int = MIN_WORDS) -> DataFrame:
    """Rows of `scored`, a written table, with rank: places are counted within ranges of scores, and the ranges' sizes added
    up; so no task sorts all rows."""
    fit = (F.col("n_words") >= min_words) & F.col("doc_id").isNotNull()
    n = rows.where(fit).count()
    parts = min(4096, 1 + n // PART_ROWS)
    order = [F.desc("score"), F.asc("doc_id")]
    lined = rows.where(fit).repartitionByRange(max(parts, rows.sparkSession.sparkContext.defaultParallelism), *order).sortWithinPartitions(*order)
    lined = written(lined.withColumn("_at", F.monotonically_increasing_id()), "lined")
    part, place = F.shiftright("_at", 33), F.col("_at").bitwiseAND((1 << 33) - 1)
    before, starts = 0, {}
    for r in lined.groupBy(part.alias("part")).count().orderBy("part").collect():  # a row for each part, at most 4096
        starts[r["part"]] = before
        before += r["count"]
    base = F.get(F.array(*map(F.lit, [starts.get(k, 0) for k in range(max(starts, default=0) + 1)])), part.cast("int"))
    rank = base.cast("long") + place + 1
    return lined.withColumn("rank", F.when(rank <= percent * n // 100, rank)).drop("_at").unionByName(rows.where(~fit).withColumn("rank", F.lit(None).cast("long")))


def resample(docs: DataFrame, target: DataFrame, percent: int = PERCENT, min_words: int = MIN_WORDS, seed: int = SEED) -> DataFrame:
    """doc_id, n_words, n_features, weight, score, rank (null: not drawn) of each row of docs (doc_id, text); target has texts."""
    gains = gains_of(bucket_counts(docs), bucket_counts(target))
    return drawn(written(scored(docs, gains, seed), "scored"), percent, min_words)


def op11_trie_resample(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = resample(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return rows.select("doc_id", "n_features", "weight", "score", "rank")
