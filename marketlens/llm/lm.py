"""Scoring by an n-gram model in an Elias-Fano trie.

The model has three levels. Level 1 is the vocabulary, as an Elias-Fano sequence of word hashes; a word's id is its place.
Level 2 holds the bigrams, as the monotone sequence of context id * V + word id, with monotone pointers from each word to
its first successor. Level 3 holds the trigrams: the last word is written as its place among the successors of the middle
word (context-relative, and so small), added to the monotone pointer of the bigram before it. Sequences are cut into blocks
of 32 values: a block has its first value, its high bits in unary in one 64-bit word, and its low bits. Probabilities and
backoffs are quantised to bytes by the quantiles of each shard. Levels are written in shards of ranges of contexts with
about equal numbers of tokens, as many as the training texts' bytes ask for, so that a merging task holds as much at every
size. Tasks map the files into memory (from a store without local paths they read a shard at a time); a search reads one
block. Queries come sorted, so a batch goes through the shards once.

Counts are of all training texts, without cutoffs. Smoothing is the hierarchical Dirichlet model of MacKay and Peto: with
c the count of a word after a context and p' the probability in the next shorter context, p = (c + m p') / (c(context) + m);
the lowest is add-one, (c + 1) / (N + V + 1). Contexts begin with the end token of the text before.

Nulls count as empty texts, which are the end token alone. Each row is scored, repeated ones and those without doc_id (not held
out) too, and each training row counts; other columns are ignored. An empty table gives no rows; with no training texts N and V
are 0 and every probability is 1.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import batch_words, new_path, opened, resident, slices, table, written

#: Weights of the shorter context, for bigrams and trigrams.
WEIGHTS = (4.0, 2.0)
#: The end token's hash (words have other hashes but for chance).
END = np.uint64(0x9D39247E33776D41)
#: Tokens that are counted or scored together in a task.
BATCH_TOKENS = 1 << 20
#: Bytes of training text for each shard of a level, and of shards that a task holds from a store without local paths.
SHARD_BYTES, HELD_BYTES = 8 << 20, 64 << 20
#: Queries that are decoded together.
STEP = 1 << 14
#: Words that a model may have: a key of two is id * V + id, in a signed 64-bit column.
MOST_WORDS = 3_000_000_000
FOLD = np.arange(32)


# ---- Elias-Fano sequences


def ef_encode(values: np.ndarray) -> dict[str, np.ndarray]:
    """The arrays of a sequence of increasing uint64 values."""
    n = len(values)
    blocks = np.concatenate([values, np.full(-n % 32, values[-1] if n else 0, np.uint64)]).reshape(-1, 32)
    first = blocks[:, 0].copy()
    rest = blocks - first[:, None]
    span = rest[:, -1]
    bits = np.zeros(len(span), np.int64)
    for k in (32, 16, 8, 4, 2, 1):
        more = (span >> (bits + k).astype(np.uint64)) > 0
        bits[more] += k
    width = np.maximum(bits + (span > 0) - 5, 0)
    high = np.bitwise_or.reduce(np.uint64(1) << ((rest >> width.astype(np.uint64)[:, None]) + FOLD.astype(np.uint64)), axis=1)
    at = np.r_[0, np.cumsum(width)]
    low = np.zeros(int(at[-1]) + 3, "<u4")
    for w in np.unique(width[width > 0]).tolist():
        own = np.flatnonzero(width == w)
        for some in np.array_split(own, max(1, len(own) // 4096)):
            if w <= 32:  # a value at a time, into the words that hold it
                part = rest[some] & np.uint64((1 << w) - 1)
                out = np.zeros((len(some), w + 2), np.uint64)
                for k in range(32):
                    word, shift = divmod(k * w, 32)
                    v = part[:, k] << np.uint64(shift)
                    out[:, word] |= v & np.uint64(0xFFFFFFFF)
                    out[:, word + 1] |= v >> np.uint64(32)
                packed = out[:, :w].astype("<u4")
            else:
                each = ((rest[some][:, :, None] >> np.arange(w, dtype=np.uint64)) & np.uint64(1)).astype(np.uint8)
                packed = np.packbits(each.reshape(len(some), -1), axis=1, bitorder="little").view("<u4")
            low[at[some][:, None] + np.arange(w)] = packed
    return {"n": np.array([n], np.int64), "first": first, "high": high, "at": at[:-1].astype(np.uint32 if at[-1] < 1 << 32 else np.uint64), "width": width.astype(np.uint8), "low": low}


class Sequence:
    """A sequence read from its arrays, which may be maps of a file."""

    def __init__(self, arrays: dict[str, np.ndarray]):
        self.n = int(arrays["n"][0])
        self.first, self.high, self.at, self.width, self.low = (arrays[k] for k in ("first", "high", "at", "width", "low"))

    def _highs(self, block: np.ndarray) -> np.ndarray:
        ones = np.unpackbits(np.ascontiguousarray(self.high[block]).view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        return (np.flatnonzero(ones).reshape(-1, 32) & 63) - FOLD

    def _lows(self, block: np.ndarray, k: np.ndarray) -> np.ndarray:
        width = self.width[block].astype(np.int64)
        place = self.at[block].astype(np.int64) * 32 + k * width
        word, shift = place >> 5, (place & 31).astype(np.uint64)
        raw = (self.low[word].astype(np.uint64) | (self.low[word + 1].astype(np.uint64) << np.uint64(32))) >> shift
        if len(width) and width.max() > 33:
            raw |= np.where(shift > 0, self.low[word + 2].astype(np.uint64) << (np.uint64(64) - np.maximum(shift, np.uint64(1))), np.uint64(0))
        return raw & ((np.uint64(1) << width.astype(np.uint64)) - np.uint64(1))

    def get(self, places: np.ndarray) -> np.ndarray:
        out = np.empty(len(places), np.uint64)
        for a in range(0, len(places), STEP):
            p = places[a : a + STEP]
            block, k = p >> 5, p & 31
            high = np.take_along_axis(self._highs(block), k[:, None], 1)[:, 0].astype(np.uint64)
            out[a : a + STEP] = self.first[block] + (high << self.width[block].astype(np.uint64)) + self._lows(block, k)
        return out

    def find(self, values: np.ndarray) -> np.ndarray:
        """Places of the values, -1 where the sequence lacks one."""
        out = np.full(len(values), -1, np.int64)
        if not self.n:
            return out
        for a in range(0, len(values), STEP):
            v = values[a : a + STEP]
            block = np.searchsorted(self.first, v, "right") - 1
            rows = np.flatnonzero(block >= 0)
            block, left = block[rows], v[rows] - self.first[block[rows]]
            width = self.width[block].astype(np.uint64)
            high = left >> width
            near = high < 32
            rows, block, left, width, high = rows[near], block[near], left[near], width[near], high[near].astype(np.int64)
            hit = np.flatnonzero(self._highs(block) == high[:, None])
            row, k = hit >> 5, hit & 31
            same = self._lows(block[row], k) == (left[row] & ((np.uint64(1) << width[row]) - np.uint64(1)))
            row, k = row[same][::-1], k[same][::-1]  # of equal values, which only pad the end, the first one stays
            out[a + rows[row]] = block[row] * 32 + k
        return out


# ---- shards of arrays in files


def put(system, path: str, arrays: dict[str, np.ndarray]) -> None:
    at, index, parts = 0, {}, []
    for name, x in arrays.items():
        raw = np.ascontiguousarray(x)
        index[name] = (raw.dtype.str, at, len(raw))
        parts.append(raw.tobytes() + bytes(-raw.nbytes % 8))
        at += len(parts[-1])
    head = json.dumps(index).encode()
    head += b" " * (-len(head) % 8)
    with system.open_output_stream(path) as out:
        out.write(len(head).to_bytes(8, "little") + head)
        for p in parts:
            out.write(p)


def mapped(folder: str, name: str) -> dict[str, np.ndarray]:
    """The arrays of a file: memory maps where it has a local path, else read."""
    system, top = opened(folder)
    if system.type_name == "local":
        raw = np.memmap(f"{top}/{name}", np.uint8, "r")
    else:
        with system.open_input_stream(f"{top}/{name}") as source:
            raw = np.frombuffer(source.read(), np.uint8)
    n = int(raw[:8].view("<u8")[0])
    index = json.loads(bytes(raw[8 : 8 + n]))
    return {k: raw[8 + n + at : 8 + n + at + length * np.dtype(kind).itemsize].view(kind) for k, (kind, at, length) in index.items()}


def below(arrays: dict[str, np.ndarray], prefix: str) -> dict[str, np.ndarray]:
    return {k[len(prefix) :]: v for k, v in arrays.items() if k.startswith(prefix)}


def named(arrays: dict[str, np.ndarray], prefix: str) -> dict[str, np.ndarray]:
    return {prefix + k: v for k, v in arrays.items()}


def quantised(x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Bytes and the 256 values that they stand for."""
    if not len(x):
        return np.zeros(0, np.uint8), np.zeros(256)
    some = np.sort(x)
    book = some[np.linspace(0, len(some) - 1, 256).round().astype(int)]
    return np.searchsorted((book[1:] + book[:-1]) / 2, x).astype(np.uint8), book


def packed(*columns: np.ndarray) -> bytes:
    """Columns of integers, as byte planes under zstandard."""
    parts = []
    for x in columns:
        raw = zstandard.ZstdCompressor(level=1).compress(np.ascontiguousarray(x.view(np.uint8).reshape(-1, x.itemsize).T).tobytes())
        parts.append(np.array([x.itemsize, len(x), len(raw)], "<i8").tobytes() + raw)
    return b"".join(parts)


def unpacked(raw: bytes) -> list[np.ndarray]:
    out, at = [], 0
    while at < len(raw):
        size, n, length = np.frombuffer(raw, "<i8", 3, at)
        planes = zstandard.ZstdDecompressor().decompress(raw[at + 24 : at + 24 + length], max_output_size=int(size * n) or 1)
        out.append(np.ascontiguousarray(np.frombuffer(planes, np.uint8).reshape(size, n).T).view(f"<u{size}").reshape(-1))
        at += 24 + int(length)
    return out


# ---- the model, as tasks see it


class Trie:
    """The shards of a model: `about` has N, V, the files and lengths of each level's shards, and the bounds of bigram keys."""

    def __init__(self, folder: str, about: dict):
        self.folder, self.about = folder, about
        self.V, self.N = about["V"], about["N"]
        self.local = opened(folder)[0].type_name == "local"
        self.open, self.held = {}, 0
        sums = lambda name: np.r_[0, np.cumsum(about.get(name, []))].astype(np.int64)
        self.word_base, self.pair_base = sums("n_words"), sums("n_pairs")
        self.bounds = np.array(about.get("bounds", []), np.uint64)
        self.start_word = np.array([-(-k // self.V) for k in about.get("bounds", [])], np.int64)

    def shard(self, level: str, s: int) -> tuple[dict[str, np.ndarray], dict[str, Sequence]]:
        """A shard's arrays and sequences. Maps stay open; arrays that had to be read go again at a bound of bytes."""
        if (level, s) not in self.open:
            arrays = mapped(self.folder, self.about[level][s])
            size = 0 if self.local else sum(x.nbytes for x in arrays.values())
            if self.held + size > HELD_BYTES:
                self.open, self.held = {}, 0
            self.held += size
            self.open[level, s] = arrays, {k: Sequence(below(arrays, k + ".")) for k in "hksp" if k + ".n" in arrays}
        return self.open[level, s]

    def ids(self, hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Ids (-1: unknown) and counts of sorted hashes."""
        ids, counts, n = np.full(len(hashes), -1, np.int64), np.zeros(len(hashes), np.int64), len(self.about["words"])
        for s, a, b in cuts_of(np.searchsorted(shard_of(hashes, n), np.arange(n + 1)) if n else []):
            arrays, found = self.shard("words", s)
            at = found["h"].find(hashes[a:b])
            ok = at >= 0
            ids[a:b][ok], counts[a:b][ok] = at[ok] + self.word_base[s], arrays["count"][at[ok]]
        return ids, counts

    def count_of(self, ids: np.ndarray) -> np.ndarray:
        """Counts of sorted ids."""
        out = np.zeros(len(ids), np.int64)
        for s, a, b in cuts_of(np.searchsorted(ids, self.word_base)):
            out[a:b] = self.shard("words", s)[0]["count"][ids[a:b] - self.word_base[s]]
        return out

    def find_pairs(self, keys: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Places, probabilities and backoffs (log10) of sorted bigram keys; place -1 where there is none."""
        at, p, bow = np.full(len(keys), -1, np.int64), np.zeros(len(keys)), np.zeros(len(keys))
        for s, a, b in cuts_of(np.r_[np.searchsorted(keys, self.bounds), len(keys)]):
            m, found = self.shard("pairs", s)
            place = found["k"].find(keys[a:b])
            ok = place >= 0
            at[a:b][ok] = place[ok] + self.pair_base[s]
            p[a:b][ok], bow[a:b][ok] = m["p_book"][m["p"][place[ok]]], m["b_book"][m["b"][place[ok]]]
        return at, p, bow

    def start_of(self, ids: np.ndarray) -> np.ndarray:
        """The place of the first bigram of each word, of sorted ids."""
        out = np.zeros(len(ids), np.int64)
        for s, a, b in cuts_of(np.r_[np.searchsorted(ids, self.start_word), len(ids)]):
            out[a:b] = self.shard("pairs", s)[1]["s"].get(ids[a:b] - self.start_word[s]).astype(np.int64) + self.pair_base[s]
        return out

    def find_triples(self, nodes: np.ndarray, rel: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Whether a sorted bigram place has the context-relative successor, and its probability (log10)."""
        ok, p = np.zeros(len(nodes), bool), np.zeros(len(nodes))
        for s, a, b in cuts_of(np.searchsorted(nodes, self.pair_base)):
            m, found = self.shard("triples", s)
            own, at = np.unique(nodes[a:b] - self.pair_base[s], return_inverse=True)
            low, high = found["p"].get(own), found["p"].get(own + 1)
            key = low[at] + rel[a:b].astype(np.uint64)
            inside = np.flatnonzero(key < high[at])
            place = found["k"].find(key[inside])
            hit = inside[place >= 0]
            ok[a:b][hit] = True
            p[a:b][hit] = m["p_book"][m["p"][place[place >= 0]]]
        return ok, p


def cuts_of(cuts) -> Iterator[tuple[int, int, int]]:
    """Number, begin and end of each part between the cuts that is not empty."""
    for s, (a, b) in enumerate(zip(cuts, cuts[1:], strict=False)):
        if b > a:
            yield s, int(a), int(b)


def trie_of(folder: str, about: dict) -> Trie:
    """The model in this worker; one at a time is kept. Each description has an id of its own, so that a worker which holds
    another model of the folder, or this one half built, does not take it for this."""
    return resident(("trie", folder, about["id"]), lambda: Trie(folder, about))


def described(about: dict) -> dict:
    """The description as it is now, with a new id."""
    return about | {"id": uuid.uuid4().hex}


def shard_of(hashes: np.ndarray, shards: int) -> np.ndarray:
    return ((hashes >> np.uint64(32)) * np.uint64(shards) >> np.uint64(32)).astype(np.int64)


def streams(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the end token, the words and the end token of each text in turn, and where each text's begin."""
    words, at = batch_words(column)
    begin = at + 2 * np.arange(len(at))
    out = np.full(begin[-1], END, np.uint64)
    inner = np.ones(len(out), bool)
    inner[begin[:-1]] = False
    inner[begin[1:] - 1] = False
    out[inner] = words
    return out, begin


def gathered(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[list[pa.RecordBatch], np.ndarray, np.ndarray]]:
    """Batches together, until they have BATCH_TOKENS."""
    held, n = [], 0
    for batch in slices(batches):
        h, at = streams(batch.column("text"))
        held.append((batch, h, at))
        n += len(h)
        if n >= BATCH_TOKENS:
            yield _joined(held)
            held, n = [], 0
    if held:
        yield _joined(held)


def _joined(held) -> tuple[list[pa.RecordBatch], np.ndarray, np.ndarray]:
    base = np.r_[0, np.cumsum([len(h) for _, h, _ in held])]
    begin = np.concatenate([at[:-1] + b for (_, _, at), b in zip(held, base, strict=False)] + [base[-1:]])
    return [b for b, _, _ in held], np.concatenate([h for _, h, _ in held]), begin.astype(np.int64)


# ---- learning


def _rows(docs: DataFrame, *more: Column) -> DataFrame:
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text"), *more)


def held_out() -> Column:
    return F.coalesce(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 7 == 2, F.lit(False))


def _file(folder: str, arrays: dict[str, np.ndarray]) -> str:
    system, top = opened(folder)
    name = f"{uuid.uuid4().hex}.trie"
    put(system, f"{top}/{name}", arrays)
    return name


def learn(training: DataFrame, folder: str, weights: tuple[float, float] = WEIGHTS) -> dict:
    """Writes the levels; returns the description of the model (its id, names of the shards' files, N, V, bounds of the shards).
    A folder may hold several models: files have names of their own, and a description names those of its model."""
    spark = training.sparkSession
    size = training.agg(F.sum(F.octet_length("text").cast("long"))).first()[0] or 0
    shards = 1 + size // SHARD_BYTES
    system, top = opened(folder)
    system.create_dir(top, recursive=True)
    rows = _rows(training)

    # Level 1: counts of words, in shards of the hash.
    def count_words(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for _, h, begin in gathered(batches):
            keep = np.ones(len(h), bool)
            keep[begin[:-1]] = False  # the end token of the text before only is context
            words, times = np.unique(h[keep], return_counts=True)
            cuts = np.searchsorted(shard_of(words, shards), np.arange(shards + 1))
            out = [(s, packed(np.diff(words[a:b], prepend=np.uint64(0)), times[a:b].astype("<u4"))) for s, (a, b) in enumerate(zip(cuts, cuts[1:], strict=False)) if b > a]
            yield pa.RecordBatch.from_arrays([pa.array([s for s, _ in out], pa.int32()), pa.array([x for _, x in out], pa.binary())], ["shard", "part"])

    def merge_words(key: tuple[pa.Scalar, ...], parts: pa.Table) -> pa.Table:
        hashes, counts = [], []
        for raw in parts.column("part").to_pylist():
            d, c = unpacked(raw)
            hashes.append(np.cumsum(d, dtype=np.uint64))
            counts.append(c)
        words, at = np.unique(np.concatenate(hashes), return_inverse=True)
        total = np.bincount(at, np.concatenate(counts), len(words)).astype("<u8")
        name = _file(folder, named(ef_encode(words), "h.") | {"count": total})
        return pa.table({"shard": pa.array([key[0].as_py()], pa.int32()), "file": [name], "n": pa.array([len(words)], pa.int64()), "tokens": pa.array([int(total.sum())], pa.int64())})

    found = written(rows.mapInArrow(count_words, "shard int, part binary").groupBy("shard").applyInArrow(merge_words, "shard int, file string, n long, tokens long"), "words")
    level1 = sorted(found.collect())  # a row for each shard
    if not level1:
        return described({"N": 0, "V": 0, "words": []})
    by_shard = {r["shard"]: r for r in level1}
    empty = _file(folder, named(ef_encode(np.zeros(0, np.uint64)), "h.") | {"count": np.zeros(0, "<u8")})
    names = [by_shard[s]["file"] if s in by_shard else empty for s in range(shards)]
    n_words = np.array([by_shard[s]["n"] if s in by_shard else 0 for s in range(shards)])
    n_tokens = np.array([by_shard[s]["tokens"] if s in by_shard else 0 for s in range(shards)])
    about = {"N": int(n_tokens.sum()), "V": int(n_words.sum()), "words": names, "n_words": n_words.tolist()}
    V, N = about["V"], about["N"]
    if V > MOST_WORDS:
        raise ValueError(f"{V} words: keys of two words need at most {MOST_WORDS}")

    # Bounds: bigram keys at equal shares of the tokens; a frequent word's share is cut by the next word's id.
    token_base, word_base = np.r_[0, np.cumsum(n_tokens)], np.r_[0, np.cumsum(n_words)]

    def bounds_in(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                s = row["shard"]
                ends = np.cumsum(mapped(folder, names[s])["count"]) + token_base[s]
                marks = np.arange(1, shards) * N // shards
                k = np.flatnonzero((marks >= token_base[s]) & (marks < token_base[s + 1]))
                word = np.searchsorted(ends, marks[k], "right")
                start = np.r_[token_base[s], ends][word]
                share = (marks[k] - start) / (ends[word] - start)
                keys = (word + word_base[s]) * V + (share * V).astype(np.int64)
                yield pa.RecordBatch.from_arrays([pa.array(k + 1, pa.int32()), pa.array(keys, pa.int64())], ["k", "key"])

    marks = {r["k"]: r["key"] for r in found.select("shard").mapInArrow(bounds_in, "k int, key long").collect()}  # a row for each shard
    bounds = np.maximum.accumulate(np.array([0] + [marks[k] for k in range(1, shards)], np.int64)).astype(np.uint64)
    about["bounds"] = bounds.tolist()
    begin_about = described(about)

    # Level 2: each pair of tokens with the token after it (V: none), counted; in shards of the pair.
    def count_pairs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        trie = trie_of(folder, begin_about)
        for _, h, begin in gathered(batches):
            own, at = np.unique(h, return_inverse=True)
            ids = trie.ids(own)[0][at].astype(np.uint64)
            last = np.zeros(len(h), bool)
            last[begin[1:] - 1] = True
            first = np.flatnonzero(~last)
            third = np.full(len(first), V, np.uint64)
            more = ~last[first + 1]
            third[more] = ids[first[more] + 2]
            pairs, at = np.unique(ids[first] * np.uint64(V) + ids[first + 1], return_inverse=True)
            keys, times = np.unique(at.astype(np.uint64) * np.uint64(V + 1) + third, return_counts=True)
            of_pair = (keys // np.uint64(V + 1)).astype(np.int64)
            third = (keys % np.uint64(V + 1)).astype("<u4" if V < (1 << 32) - 1 else "<u8")
            cuts = np.r_[np.searchsorted(pairs, bounds), len(pairs)]
            at_pair = np.searchsorted(of_pair, cuts)
            children = np.bincount(of_pair, minlength=len(pairs)).astype("<u4")
            out = []
            for s in range(shards):
                a, b = cuts[s], cuts[s + 1]
                if b > a:
                    c, d = at_pair[s], at_pair[s + 1]
                    out.append((s, packed(np.diff(pairs[a:b], prepend=np.uint64(0)), children[a:b], third[c:d], times[c:d].astype("<u4"))))
            yield pa.RecordBatch.from_arrays([pa.array([s for s, _ in out], pa.int32()), pa.array([x for _, x in out], pa.binary())], ["shard", "part"])

    def merge_pairs(key: tuple[pa.Scalar, ...], parts: pa.Table) -> pa.Table:
        s = key[0].as_py()
        pairs, thirds, times = [], [], []
        for raw in parts.column("part").to_pylist():
            d, children, third, c = unpacked(raw)
            pairs.append(np.repeat(np.cumsum(d, dtype=np.uint64), children))
            thirds.append(third)
            times.append(c)
        keys, at = np.unique(np.concatenate(pairs), return_inverse=True)
        del pairs
        times = np.concatenate(times)
        count = np.bincount(at, times, len(keys))
        full, back = np.unique(at.astype(np.uint64) * np.uint64(V + 1) + np.concatenate(thirds).astype(np.uint64), return_inverse=True)
        times = np.bincount(back, times, len(full)).astype("<u8")
        third = full % np.uint64(V + 1)
        keep = third < V
        node, third, times = (full // np.uint64(V + 1))[keep].astype(np.int64), third[keep], times[keep]
        trie = trie_of(folder, begin_about)
        a, b = (keys // np.uint64(V)).astype(np.int64), (keys % np.uint64(V)).astype(np.int64)
        own, where = np.unique(b, return_inverse=True)
        lower = ((trie.count_of(own) + 1) / (N + V + 1))[where]
        p = (count + weights[0] * lower) / (trie.count_of(a) + weights[0])
        # Words whose bigrams begin in this shard, and where; the first bound at or after a word's first key is its shard.
        first_word = int(-(-int(bounds[s]) // V))
        next_word = int(-(-int(bounds[s + 1]) // V)) if s + 1 < shards else V
        starts = np.searchsorted(keys, np.arange(first_word, next_word, dtype=np.uint64) * np.uint64(V)).astype(np.uint64)
        pq, pb = quantised(np.log10(p))
        bq, bb = quantised(np.log10(weights[1] / (count + weights[1])))
        name = _file(folder, named(ef_encode(keys), "k.") | named(ef_encode(starts), "s.") | {"p": pq, "p_book": pb, "b": bq, "b_book": bb})
        raw = packed(np.diff(node, prepend=0).astype("<u4"), third.astype("<u8"), times, count.astype("<u8"), keys % np.uint64(V))
        system, top = opened(folder)
        with system.open_output_stream(f"{top}/{name}.next") as out:
            out.write(raw)
        return pa.table({"shard": pa.array([s], pa.int32()), "file": [name], "n": pa.array([len(keys)], pa.int64())})

    counted = rows.mapInArrow(count_pairs, "shard int, part binary").groupBy("shard").applyInArrow(merge_pairs, "shard int, file string, n long")
    level2 = {r["shard"]: (r["file"], r["n"]) for r in written(counted, "pairs").collect()}  # a row for each shard
    for s in range(shards):
        if s not in level2:
            first_word = int(-(-int(bounds[s]) // V))
            next_word = int(-(-int(bounds[s + 1]) // V)) if s + 1 < shards else V
            none = ef_encode(np.zeros(0, np.uint64))
            level2[s] = _file(folder, named(none, "k.") | named(ef_encode(np.zeros(next_word - first_word, np.uint64)), "s.") | {"p": np.zeros(0, np.uint8), "p_book": np.zeros(256), "b": np.zeros(0, np.uint8), "b_book": np.zeros(256)}), 0
            with system.open_output_stream(f"{top}/{level2[s][0]}.next") as out:
                out.write(packed(*(np.zeros(0, t) for t in ("<u4", "<u8", "<u8", "<u8", "<u8"))))
    about["pairs"], about["n_pairs"] = [level2[s][0] for s in range(shards)], [level2[s][1] for s in range(shards)]
    middle = described(about)

    # Level 3: the third word of each becomes its place among the successors of the second.
    def build_triples(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        trie = trie_of(folder, middle)
        for batch in batches:
            for row in batch.to_pylist():
                s = row["shard"]
                system, top = opened(folder)
                with system.open_input_stream(f"{top}/{middle['pairs'][s]}.next") as source:
                    step, third, times, count, second = unpacked(source.read())
                node = np.cumsum(step, dtype=np.int64)
                words = second[node]
                keys, at = np.unique(words * np.uint64(V) + third, return_inverse=True)
                place, p, _ = trie.find_pairs(keys)
                start = trie.start_of((keys // np.uint64(V)).astype(np.int64))
                rel, lower = (place - start)[at].astype(np.uint64), 10 ** p[at]
                probability = (times + weights[1] * lower) / (count[node] + weights[1])
                largest = np.zeros(len(count), np.uint64)
                if len(node):
                    ends = np.flatnonzero(np.r_[node[1:] != node[:-1], True])
                    largest[node[ends]] = rel[ends] + np.uint64(1)
                pointers = np.r_[np.uint64(0), np.cumsum(largest, dtype=np.uint64)]
                pq, pb = quantised(np.log10(probability))
                name = _file(folder, named(ef_encode(pointers[node] + rel), "k.") | named(ef_encode(pointers), "p.") | {"p": pq, "p_book": pb})
                yield pa.RecordBatch.from_arrays([pa.array([s], pa.int32()), pa.array([name])], ["shard", "file"])

    tasks = spark.range(shards, numPartitions=shards).select(F.col("id").cast("int").alias("shard"))
    level3 = {r["shard"]: r["file"] for r in written(tasks.mapInArrow(build_triples, "shard int, file string"), "triples").collect()}
    about["triples"] = [level3[s] for s in range(shards)]
    for f in about["pairs"]:
        system.delete_file(f"{top}/{f}.next")
    return described(about)


# ---- scoring


def score(docs: DataFrame, folder: str, about: dict, weights: tuple[float, float] = WEIGHTS) -> DataFrame:
    """doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        trie = trie_of(folder, about)
        V, N = trie.V, trie.N
        for held, h, begin in gathered(batches):
            own, at = np.unique(h, return_inverse=True)
            ids, counts = trie.ids(own)
            ids, counts = ids[at], counts[at]
            token = np.ones(len(h), bool)
            token[begin[:-1]] = False
            lowest = np.log10((counts + 1) / (N + V + 1))
            p = lowest.copy()
            place = np.full(len(h), -1, np.int64)  # of the pair that ends here
            bow = np.zeros(len(h))
            if V:
                end = np.flatnonzero(token)
                # A known context without this successor backs off by its weight.
                context = ids[end - 1] >= 0
                p[end[context]] += np.log10(weights[0] / (counts[end[context] - 1] + weights[0]))
                both = end[context & (ids[end] >= 0)]
                keys, at = np.unique(ids[both - 1].astype(np.uint64) * np.uint64(V) + ids[both].astype(np.uint64), return_inverse=True)
                found, pair_p, pair_bow = trie.find_pairs(keys)
                start = trie.start_of((keys // np.uint64(V)).astype(np.int64))
                place[both], bow[both] = found[at], pair_bow[at]
                relative = np.zeros(len(h), np.int64)
                relative[both] = (found - start)[at]
                hit = both[found[at] >= 0]
                p[hit] = pair_p[at[found[at] >= 0]]
                # Trigrams: a context is a pair that ends in the token before, in the same text.
                third = end[1:][place[end[1:] - 1] >= 0] if len(end) else end
                third = third[token[third - 1]]
                p[third] += bow[third - 1]
                full = third[place[third] >= 0]
                order = np.argsort(place[full - 1], kind="stable")
                full = full[order]
                ok, triple_p = trie.find_triples(place[full - 1], relative[full])
                p[full[ok]] = triple_p[ok]
            text = np.repeat(np.arange(len(begin) - 1), np.diff(begin))[token]
            total = lambda x: np.bincount(text, x[token], len(begin) - 1)
            n = np.diff(begin) - 1
            columns = [pa.array(n, pa.int64()), pa.array(total(counts > 0).astype(np.int64)), pa.array(np.full(len(n), N, np.int64)), pa.array(total(lowest)), pa.array(total(p))]
            cuts = np.cumsum([0] + [b.num_rows for b in held])
            for b, a, z in zip(held, cuts, cuts[1:], strict=False):
                yield pa.RecordBatch.from_arrays([b.column("doc_id"), b.column("held_out"), *(c.slice(a, z - a) for c in columns)], ["doc_id", "held_out", "n_tokens", "n_known", "train_tokens", "base_score", "score"])

    return _rows(docs, held_out().alias("held_out")).mapInArrow(run, "doc_id long, held_out boolean, n_tokens long, n_known long, train_tokens long, base_score double, score double")


def op2_ef_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    folder = new_path(spark, "trie")
    return score(docs, folder, learn(docs.where(~held_out()), folder))
