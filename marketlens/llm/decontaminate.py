"""Benchmark decontamination by size-partitioned MinHash containment search.

A test item is contained in a document if the document holds at least 80 % of the item's distinct five-word shingles. Items
are short and documents long, so the sketch is the item's: the smallest of its shingle hashes, a uniform sample of them
whatever the document's length. Items are partitioned by the size of their sets, in powers of two. As a document that contains
an item lacks a fifth of its shingles at most, the sketches of a partition have as many hashes as its largest item may lack and
HITS more: such a document then holds at least HITS hashes of the sketch, or, of items whose sets the sketch holds whole, the
share itself. No pair is missed, and pairs with fewer hits are no candidates. Documents that are too small for an item are
dropped by size, and the other candidates are verified by exact containment of the whole sets.

Items with fewer than five words are searched as one shingle of their own length. Nulls and texts without words contain
nothing and are contained in nothing. Each row of the documents is searched by itself, with or without a doc_id; of rows with
equal doc_id the largest containment counts. Items with equal item_id are one item with all their shingles; items without
item_id are left out. An empty table on either side gives no pairs. Other columns are ignored, and kept by `without_items`.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import BROADCAST_ROWS, batch_words, shingle_hashes, slices, small, table, written

#: Hashes of a sketch that a document with the share holds at least.
HITS = 32


def digest_of(text: Column) -> Column:
    return F.xxhash64(F.coalesce(text, F.lit("")))


def item_shingles(items: DataFrame, n: int) -> DataFrame:
    """item_id, width (words of its shingles), size (of its set), shingle, rank (by hash)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            words, at = batch_words(batch.column("text"))
            sets = [np.unique(shingle_hashes(words[a:b], n)) for a, b in zip(at, at[1:], strict=False)]
            widths = np.minimum(np.diff(at), n)
            sizes = [len(s) for s in sets]
            ids = np.repeat(batch.column("item_id").to_numpy(zero_copy_only=False), sizes)
            yield pa.RecordBatch.from_arrays([pa.array(ids, pa.int64()), pa.array(np.repeat(widths, sizes)), pa.array((np.concatenate(sets) if sets else np.zeros(0, np.uint64)).view(np.int64))], ["item_id", "width", "shingle"])

    texts = items.where("item_id is not null").select(F.col("item_id").cast("long").alias("item_id"), F.coalesce("text", F.lit("")).alias("text"))
    rows = texts.mapInArrow(run, "item_id long, width long, shingle long").distinct()
    sizes = rows.groupBy("item_id").agg(F.count(F.lit(1)).alias("size"))
    ranked = rows.withColumn("rank", F.row_number().over(Window.partitionBy("item_id").orderBy("shingle")))
    return written(ranked.join(sizes, "item_id"), "items")


def sketched(known: DataFrame, share: int, of: int) -> DataFrame:
    """item_id, width, size, shingle of the sketches, and `enough`, the hits of a candidate."""
    top = F.pow(F.lit(2), F.floor(F.log2("size")) + 1)  # above the sizes of the item's partition
    length = F.ceil(top * (of - share) / of) + HITS
    need = F.ceil(F.col("size") * share / of)
    return known.where(F.col("rank") <= length).select("item_id", "width", "size", "shingle", (F.least("size", length) - F.col("size") + need).alias("enough"))


def doc_shingles(docs: DataFrame, wanted: DataFrame, n: int) -> DataFrame:
    """doc_id, digest (of the row's text), words, shingle: the distinct shingles of each row that are wanted. Where those are
    few, a row's task drops the others at once; the join, which decides, is the same."""
    widths = sorted({n} | {r[0] for r in wanted.select("width").distinct().collect()})  # at most n values
    hashes = wanted.select("shingle").distinct().limit(BROADCAST_ROWS + 1).toPandas()["shingle"].to_numpy()
    keep = docs.sparkSession.sparkContext.broadcast(np.sort(hashes)) if len(hashes) <= BROADCAST_ROWS else None

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        if keep is not None:
            bits = np.zeros(1 << 22, bool)
            bits[keep.value & ((1 << 22) - 1)] = True
        for batch in slices(batches):
            words, at = batch_words(batch.column("text"))
            rows, found = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
            of_word = np.repeat(np.arange(len(at) - 1), np.diff(at))
            for width in widths:
                if len(words) < width:
                    continue
                # Over all texts of the batch at once; shingles that cross into the next text are dropped.
                s = shingle_hashes(words, width).view(np.int64)
                inside = of_word[: len(s)] == of_word[width - 1 :]
                if keep is not None:
                    inside &= bits[s & ((1 << 22) - 1)]
                at_word = np.flatnonzero(inside)
                if keep is not None:
                    at_word = at_word[np.isin(s[at_word], keep.value)]
                found.append(s[at_word])
                rows.append(of_word[at_word])
            each = np.unique(np.stack([np.concatenate(rows), np.concatenate(found)]), axis=1)
            named = [batch.column(k).take(pa.array(each[0])) for k in ("doc_id", "digest")]
            yield pa.RecordBatch.from_arrays([*named, pa.array(np.diff(at)[each[0]]), pa.array(each[1])], ["doc_id", "digest", "words", "shingle"])

    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), digest_of(F.col("text")).alias("digest"), F.coalesce("text", F.lit("")).alias("text"))
    return texts.mapInArrow(run, "doc_id long, digest long, words long, shingle long")


def found_in(docs: DataFrame, items: DataFrame, n: int, share: int, of: int) -> DataFrame:
    """doc_id, digest (of the row's text), item_id, containment: every pair of row and item at or above the share."""
    known = item_shingles(items, n)
    sketches = sketched(known, share, of)
    row = ["doc_id", "digest", "item_id", "size"]
    # A text of w words has at most w - width + 1 shingles.
    fits = (F.col("words") - F.col("width") + 1) * of >= F.col("size") * share
    hits = doc_shingles(docs, sketches, n).join(small(sketches.select("item_id", "width", "shingle", "size", "enough")), "shingle").where(fits)
    candidates = written(hits.groupBy(*row, "enough").agg(F.countDistinct("shingle").alias("hits")).where(F.col("hits") >= F.col("enough")), "hits")
    # Sets that the sketch holds whole are verified by it; the others by all their shingles.
    whole = F.col("enough") == F.ceil(F.col("size") * share / of)
    verified, larger = candidates.where(whole).select(*row, "hits"), candidates.where(~whole)
    if larger.limit(1).count():
        some = larger.select(F.col("doc_id").alias("d"), F.col("digest").alias("x")).distinct()
        texts = docs.join(small(some), docs["doc_id"].cast("long").eqNullSafe(some["d"]) & (digest_of(docs["text"]) == some["x"]), "left_semi")
        rest = known.join(small(larger.select("item_id").distinct()), "item_id", "left_semi")
        pairs = larger.select(F.col("doc_id").alias("d"), F.col("digest").alias("x"), F.col("item_id").alias("i"))
        both = doc_shingles(texts, rest, n).join(small(rest.select("item_id", "shingle", "size")), "shingle")
        both = both.join(pairs, both["doc_id"].eqNullSafe(pairs["d"]) & (both["digest"] == pairs["x"]) & (both["item_id"] == pairs["i"]), "left_semi")
        verified = verified.union(both.groupBy(*row).agg(F.countDistinct("shingle").alias("hits")))
    return verified.where(F.col("hits") * of >= F.col("size") * share).select("doc_id", "digest", "item_id", (F.col("hits") / F.col("size")).alias("containment"))


def contained(docs: DataFrame, items: DataFrame, n: int = 5, share: int = 80, of: int = 100) -> DataFrame:
    """doc_id, item_id, containment: every pair at or above the share."""
    return found_in(docs.select("doc_id", "text"), items, n, share, of).groupBy("doc_id", "item_id").agg(F.max("containment").alias("containment"))


def without_items(docs: DataFrame, items: DataFrame) -> DataFrame:
    """The rows that contain no item; of rows with equal doc_id each by its own text."""
    leaks = written(found_in(docs.select("doc_id", "text"), items, 5, 80, 100).select(F.col("doc_id").alias("d"), F.col("digest").alias("x")).distinct(), "leaks")
    return docs.join(small(leaks), docs["doc_id"].cast("long").eqNullSafe(leaks["d"]) & (digest_of(docs["text"]) == leaks["x"]), "left_anti")


def op7_decontaminate(spark, sf_dir: str) -> DataFrame:
    return contained(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
