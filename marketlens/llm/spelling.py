"""Spelling variants: words that differ by one letter, grouped without pairs.

Words get an id in order of their count (largest first, ties in code-point order), so that the best of several words is that
with the smallest id. Each word then goes to groups:

- for each place, to the group of the words with the same letters before and after it (place, prefix, suffix); a group keeps
  its size and its two smallest ids, of which a word's best partner there is the one that it is not itself;
- for each place, to the group of the text that is left without the letter there (once for equal texts), and to the group of its
  own text. A group whose text is a word links it with all those that have one letter more; it keeps that word's id, the number
  of the others and their smallest id.

So a word's near words are counted, and the best one is found, from its groups alone. Groups are told apart by two 64-bit hashes
of their texts, exact but for chance; a word of any length has rows of a fixed size for each of its letters. A group of places
has at most one word for each letter of the alphabet (90), so no group grows with the input.

A word's form is its best near word if that occurs at least RATIO times as often; counts grow by RATIO along forms, so few
doublings of steps lead to the root. Null texts have no words. Rows without doc_id and repeated rows count like others (the
doc_id is empty in the text from which h is made). Empty tables give no rows; other columns are ignored. A text is held whole by
the task that reads it; counts of words are added up within a task before they are shuffled.
"""

from __future__ import annotations

import math
import re
import zlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import mix, slices, table, text_of, written

RUN = re.compile("[A-Za-zÀ-ÿ]+")
LOWER = {c: c + 32 for c in range(ord("A"), ord("Z") + 1)}
#: One run of so many of a document loses a letter.
ODD = 199
LEAST_LETTERS, LEAST_COUNT, RATIO = 6, 5, 5
#: Bytes of words that a task counts before it hands the counts on, and letters of words that it makes groups of together.
COUNTED_BYTES, BATCH_LETTERS = 32 << 20, 1 << 18
#: Two bases, and a value for each.
BASES = (0x9FB21C651E98DF25, 0xD6E8FEB86659FD93)
PLACE, TEXT, OWN = 0, 1, 2


def counted(docs: DataFrame, odd: int = ODD) -> DataFrame:
    """word, n: how often each word of any length occurs, after the letters are left out."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total, size = Counter(), 0
        rows = lambda: pa.RecordBatch.from_arrays([pa.array(list(total)), pa.array(list(total.values()), pa.int64())], ["word", "n"])
        for batch in slices(batches):
            for key, text in zip(batch.column("doc_id").to_pylist(), batch.column("text").to_pylist(), strict=True):
                at = zlib.crc32(f"{'' if key is None else key}:".encode())
                for word, n in Counter(RUN.findall(text.translate(LOWER))).items():
                    h = zlib.crc32(word.encode(), at)
                    if h % odd == 0:
                        k = h % len(word)
                        word = word[:k] + word[k + 1 :]
                    if word not in total:
                        size += len(word) + 150
                    total[word] += n
                if size > COUNTED_BYTES:
                    yield rows()
                    total, size = Counter(), 0
        yield rows()

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text_of().alias("text")).mapInArrow(count, "word string, n long")
    return rows.groupBy("word").agg(F.sum("n").alias("n"))


def vocabulary(words: DataFrame, letters: int = LEAST_LETTERS, least: int = LEAST_COUNT) -> DataFrame:
    """id, word, n of the words that are long and frequent enough; ids grow from the most frequent word on. A written table."""
    order = [F.desc("n"), F.asc("word")]
    kept = words.where((F.char_length("word") >= letters) & (F.col("n") >= least))
    return written(kept.repartitionByRange(*order).sortWithinPartitions(*order).select(F.monotonically_increasing_id().alias("id"), "word", "n"), "words")


# ---- groups


def groups_of(words: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """The groups of words: two hashes, kind, and which word."""
    lengths = np.array([len(w) for w in words], np.int64)
    letters = np.frombuffer("".join(words).encode("utf-32-le"), "<u4").astype(np.uint64)
    word = np.repeat(np.arange(len(words)), lengths)
    begin = np.cumsum(lengths) - lengths
    place = np.arange(len(letters)) - begin[word]
    last = place == lengths[word] - 1
    # Without a letter or without its equal neighbour is the same text.
    left_out = np.flatnonzero(last | (letters != np.r_[letters[1:], np.uint64(0)]))
    hashes = []
    for base in BASES:
        with np.errstate(over="ignore"):
            power = np.cumprod(np.r_[np.uint64(1), np.full(max(int(lengths.max(initial=0)), 1), base, np.uint64)], dtype=np.uint64)
            inverse = np.uint64(pow(base, -1, 1 << 64))
            terms = mix(letters + np.uint64(base)) * power[place]
            sums = np.r_[np.uint64(0), np.cumsum(terms, dtype=np.uint64)]
            whole = sums[begin + lengths] - sums[begin]
            before = sums[:-1] - sums[begin[word]]
            holes = mix(whole[word] - terms) ^ mix(place.astype(np.uint64) * np.uint64(2) + np.uint64(1))
            without = before + (whole[word] - before - terms) * inverse
            hashes.append(np.r_[holes, mix(without[left_out]), mix(whole)].view(np.int64))
    kind = np.repeat(np.array([PLACE, TEXT, OWN], np.int32), [len(letters), len(left_out), len(words)])
    return hashes[0], hashes[1], kind, np.r_[word, word[left_out], np.arange(len(words))]


def grouped(vocab: DataFrame) -> DataFrame:
    """a, b (the hashes of a group), kind, id: the groups of each word."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, words = np.asarray(batch.column("id").to_numpy(zero_copy_only=False)), batch.column("word").to_pylist()
            ends = np.cumsum([len(w) for w in words])
            i = 0
            while i < len(words):
                j = max(i + 1, int(np.searchsorted(ends, (ends[i - 1] if i else 0) + BATCH_LETTERS, "right")))
                a, b, kind, which = groups_of(words[i:j])
                yield pa.RecordBatch.from_arrays([pa.array(a), pa.array(b), pa.array(kind), pa.array(ids[i:j][which])], ["a", "b", "kind", "id"])
                i = j

    return vocab.select("id", "word").mapInArrow(run, "a long, b long, kind int, id long")


def near(vocab: DataFrame) -> DataFrame:
    """id, n_near, best (the smallest id of a near word) of each word that has a near word."""
    rows = written(grouped(vocab), "groups")
    of = lambda kind: F.when(F.col("kind") == kind, F.col("id"))
    two = F.slice(F.array_sort(F.collect_list(of(PLACE))), 1, 2)  # of at most one word a letter of the alphabet
    groups = rows.groupBy("a", "b").agg(
        F.count(of(PLACE)).alias("size"), two.alias("top"), F.max(of(OWN)).alias("own"), F.count(of(TEXT)).alias("longer"), F.min(of(TEXT)).alias("first")
    )
    groups = groups.where("size > 1 or (own is not null and longer > 0)")
    other = F.when(F.get("top", F.lit(0)) != F.col("id"), F.get("top", F.lit(0))).otherwise(F.get("top", F.lit(1)))
    here = rows.join(groups, ["a", "b"])
    n = F.when(F.col("kind") == PLACE, F.col("size") - 1).when(F.col("kind") == OWN, F.col("longer")).otherwise(1)
    best = F.when(F.col("kind") == PLACE, other).when(F.col("kind") == OWN, F.col("first")).otherwise(F.col("own"))
    return here.where("kind = 0 or own is not null").groupBy("id").agg(F.sum(n).alias("n_near"), F.min(best).alias("best"))


def variants(vocab: DataFrame, ratio: int = RATIO) -> DataFrame:
    """word, n, n_near, form, form_n, root of a vocabulary (id, word, n), a written table."""
    best = vocab.select(F.col("id").alias("best"), F.col("word").alias("_word"), F.col("n").alias("_n"))
    rows = vocab.join(near(vocab), "id", "left").join(best, "best", "left")
    fits = F.col("_n") >= ratio * F.col("n")
    n_near = F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near")
    rows = written(rows.select("id", "word", "n", n_near, F.when(fits, F.col("best")).alias("to"), F.when(fits, F.col("_word")).alias("form"), F.when(fits, F.col("_n")).alias("form_n")), "forms")
    # Steps double: after k rounds a word's end is 2**k forms on, and there are at most log_ratio(n) of them.
    most = rows.agg(F.max("form_n")).first()[0] or 1
    steps = written(rows.where("to is not null").select("id", "to"), "steps")
    for _ in range(math.ceil(math.log2(1 + math.log(most, ratio))) if most > 1 else 0):
        on = steps.select(F.col("id").alias("to"), F.col("to").alias("_on"))
        steps = written(steps.join(on, "to", "left").select("id", F.coalesce("_on", "to").alias("to")), "steps")
    ends = steps.join(vocab.select(F.col("id").alias("to"), F.col("word").alias("root")), "to").select("id", "root")
    return rows.join(ends, "id", "left").select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")


def op13_wildcard_groups(spark: SparkSession, sf_dir: str) -> DataFrame:
    return variants(vocabulary(counted(table(spark, sf_dir, "documents"))))
