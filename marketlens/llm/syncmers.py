"""Document fingerprints of closed syncmers, in DataFrame functions only.

A k-mer of K words is chosen if the smallest hash among its S-word substrings stands first or last in it. Whether a k-mer
is chosen depends on its own words alone, so equal passages give equal anchors wherever they stand. One of any K - S + 1
k-mers in a row is chosen, about one in two of all. A text of K words or more in which none is chosen (it has fewer than
2K - S) has its k-mer of smallest hash; a text with fewer words than K is one anchor as a whole; one without words has
none. The fingerprint lists the anchors' hashes in order of place, in hexadecimal, so that two fingerprints can also be
aligned; likeness is the Jaccard similarity of their sets (1 for two without words).

Nulls count as empty texts. Texts are split at spaces and \\x09-\\x0D and compared as they are. The document next to each is
the one with the next smaller doc_id (after the smallest, the largest); of rows with equal doc_id, the larger text comes
first, and equal rows follow each other. Rows without doc_id come last. An empty table gives no rows; of a single row, the
next document is itself. Other columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import table

K, S = 5, 2

#: Bytes of texts in a range of documents that a task works on, and the most ranges.
RANGE_BYTES, RANGES = 64 << 20, 10_000


def bound(value: Column, body) -> Column:
    """body(value), with the value computed once: a one-element array binds it to a name."""
    return F.transform(F.array(value), body)[0]


def pairs_at(x: Column, step: int, f) -> Column:
    """f of each element and the one `step` places after it (null beyond the end)."""
    return F.zip_with(x, F.slice(x, step + 1, F.size(x)), lambda a, b: f(a, b))


def window_least(x: Column, width: int, have: int = 1) -> Column:
    """The least of each `width` elements in a row, by doubling: x has the least of each `have`."""
    if have == width:
        return x
    step = min(have, width - have)
    return bound(pairs_at(x, step, F.least), lambda y: window_least(y, width, have + step))


def anchors(text: Column) -> Column:
    """Hashes of a text's anchors in order of place, as array<bigint>."""
    words = F.filter(F.split(text, r"[\x20\x09-\x0D]+"), lambda w: w != "")

    def chosen(h: Column) -> Column:
        inner = pairs_at(h, 1, lambda a, b: F.xxhash64(a, b))  # of S words
        ends = lambda s: pairs_at(s, K - S, F.least)
        places = F.sequence(F.lit(0), F.size(h) - K)
        return bound(inner, lambda s: bound(ends(s), lambda e: bound(window_least(s, K - S + 1), lambda m: F.filter(places, lambda i: F.get(e, i) == F.get(m, i)))))

    def mers(h: Column) -> Column:
        some = F.transform(chosen(h), lambda i: F.xxhash64(F.slice(h, i + 1, K)))
        every = F.transform(F.sequence(F.lit(1), F.size(h) - K + 1), lambda i: F.xxhash64(F.slice(h, i, K)))
        return bound(some, lambda x: F.when(F.size(x) > 0, x).otherwise(F.array(F.array_min(every))))

    def hashes(h: Column) -> Column:
        return F.when(F.size(h) >= K, mers(h)).when(F.size(h) > 0, F.array(F.xxhash64(h))).otherwise(F.array().cast("array<bigint>"))

    return bound(F.transform(words, lambda w: F.xxhash64(w)), hashes)


def printed(found: Column) -> Column:
    return F.lower(F.array_join(F.transform(found, lambda x: F.lpad(F.hex(x), 16, "0")), ""))


def likeness(a: Column, b: Column) -> Column:
    shared = F.size(F.array_intersect(a, b))
    union = F.size(F.array_distinct(a)) + F.size(F.array_distinct(b)) - shared
    return F.when(union == 0, 1.0).otherwise(shared / union)


def bucket_of(key: Column, bounds: list[int]) -> Column:
    """How many of the sorted bounds are below the key: first among every so many of them, then among those between."""
    step = max(1, round(len(bounds) ** 0.5))
    array = lambda some: F.array(*map(F.lit, some)).cast("array<bigint>")
    below = lambda some: F.size(F.filter(some, lambda b: b < key))
    parts = [bounds[k : k + step] for k in range(0, len(bounds), step)]
    coarse = below(array([p[-1] for p in parts]))
    return F.least(F.lit(len(bounds)), coarse * step + F.coalesce(below(F.get(F.array(*map(array, parts)), coarse)), F.lit(0))) if bounds else F.lit(0)


def with_next(docs: DataFrame) -> DataFrame:
    """doc_id, text, found (its anchors), next_text, next_found. Rows are dealt into ranges of doc_id, each with the first row of
    the range after it, so that one shuffle of the texts is enough and no task sees more than its range. There are as many
    ranges as shuffle partitions, and more, up to RANGES, where the texts are larger."""
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text"))
    fields = F.struct("text", anchors(F.col("text")).alias("found"))
    key = F.coalesce("doc_id", F.lit(-(1 << 63)))
    size = rows.agg(F.sum(F.octet_length("text").cast("long"))).first()[0] or 0
    parts = min(RANGES, max(int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions")), size // RANGE_BYTES))
    bounds = rows.agg(F.percentile_approx(key, [i / parts for i in range(1, parts)] or [0.5], 4 * RANGES).alias("b")).first()["b"] or []
    bounds = sorted(set(bounds))  # as many as ranges
    rows = rows.withColumn("bucket", bucket_of(key, bounds))
    # The first row of each range: as many as ranges.
    firsts = rows.groupBy("bucket").agg(F.max(key).alias("top"))
    tops = [(r["bucket"], r["top"]) for r in firsts.collect()]
    tops.sort(reverse=True)
    before = {top: tops[k - 1][0] for k, (_, top) in enumerate(tops)}
    if not before:
        return rows.select("doc_id", "text", fields["found"].alias("found"), F.col("text").alias("next_text"), fields["found"].alias("next_found"))
    marks = docs.sparkSession.range(1).select(F.inline(F.array(*(F.struct(F.lit(top).cast("long").alias("top"), F.lit(bucket).alias("bucket")) for top, bucket in before.items()))))
    heads = rows.drop("bucket").join(F.broadcast(marks), key == F.col("top")).groupBy("doc_id", "bucket").agg(F.max("text").alias("text"))
    heads = heads.select("doc_id", "text", "bucket", F.lit(1).alias("tail"))
    # Anchors are found after the shuffle, which so carries the texts alone.
    dealt = rows.withColumn("tail", F.lit(0)).unionByName(heads).repartition(parts, "bucket").withColumn("fields", fields).drop("text")
    order = Window.partitionBy("bucket").orderBy("tail", F.desc_nulls_last("doc_id"), F.desc("fields.text"))
    led = dealt.withColumn("next", F.lead("fields").over(order)).where("tail = 0")
    return led.select("doc_id", "fields.text", "fields.found", F.col("next.text").alias("next_text"), F.col("next.found").alias("next_found"))


def fingerprints(docs: DataFrame) -> DataFrame:
    """doc_id, n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited, near_next."""
    rows = with_next(docs).withColumn("n_chars", F.char_length("text").cast("long"))
    half = F.floor(F.col("n_chars") / 2).cast("int")
    rows = rows.withColumn("edited", F.concat(F.substring(F.col("text"), F.lit(1), F.col("n_chars").cast("int") - half), F.substring(F.col("next_text"), F.lit(1), half)))
    rows = rows.select("doc_id", "n_chars", F.sha2("edited", 256).alias("edited_sha256"), "found", "next_found", anchors(F.col("edited")).alias("edited_found"))
    a, b, c = F.col("found"), F.col("edited_found"), F.col("next_found")
    return rows.select("doc_id", "n_chars", "edited_sha256", printed(a).alias("fingerprint"), printed(b).alias("edited_fingerprint"), likeness(a, b).alias("near_edited"), likeness(a, c).alias("near_next"))


def op10_syncmers(spark, sf_dir: str) -> DataFrame:
    return fingerprints(table(spark, sf_dir, "documents"))
