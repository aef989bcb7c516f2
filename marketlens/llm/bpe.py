"""Byte-level BPE encoding and decoding with the tokenizers library, over Arrow batches.

Each match of the pattern is mapped from its bytes to the characters of the byte alphabet and merged by rank, by the library,
a few hundred texts at a time. As the ids of a text stand for all its bytes in order, their places follow from the lengths of
the ids' bytes, for a whole batch at once; an id may begin or end within a character. Decoding looks the bytes of all ids up in
the reversed byte table and joins them before they are read as characters, so that characters which ids split are whole again.

Nulls count as empty texts; an empty text has no ids. Rows are independent: each gives a row, also repeated ones and those
without doc_id. An empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

import base64
import hashlib
import os
from collections.abc import Iterator

import numpy as np
import public_tokenizers
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from tokenizers import Regex, Tokenizer, models, pre_tokenizers

from .common import resident, slices, table, text_of

#: Texts that the library is given together.
TEXTS = 100


def byte_alphabet() -> dict[int, str]:
    """The character that stands for each byte in a byte-level vocabulary: printable Latin-1 stands for itself."""
    own = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in set(own)]
    return {b: chr(b) for b in own} | {b: chr(256 + k) for k, b in enumerate(rest)}


def read_ranks(path: str) -> dict[bytes, int]:
    with open(path, "rb") as f:
        return {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}


def merge_pair(token: bytes, ranks: dict[bytes, int]) -> tuple[bytes, bytes]:
    """The two parts whose merge makes the token: merge its bytes by the ranks below its own."""
    parts = [token[i : i + 1] for i in range(len(token))]
    limit = ranks[token]
    while len(parts) > 2:
        rank, at = min((ranks.get(parts[i] + parts[i + 1], limit), i) for i in range(len(parts) - 1))
        if rank >= limit:
            break
        parts[at : at + 2] = [parts[at] + parts[at + 1]]
    return (parts[0], parts[1]) if len(parts) == 2 else (b"", b"")


def tokenizer_from_ranks(path: str, pattern: str) -> Tokenizer:
    """A tokenizers object that gives a rank file's ids: a pre-token in the vocabulary is one id, the rest is merged by rank."""
    ranks, letter = read_ranks(path), byte_alphabet()
    name = lambda b: "".join(letter[x] for x in b)
    merges = [pair for token in sorted((t for t in ranks if len(t) > 1), key=ranks.get) if (pair := merge_pair(token, ranks))[0]]
    model = models.BPE(vocab={name(t): r for t, r in ranks.items()}, merges=[(name(a), name(b)) for a, b in merges], ignore_merges=True)
    out = Tokenizer(model)
    out.pre_tokenizer = pre_tokenizers.Sequence([pre_tokenizers.Split(Regex(pattern), "isolated"), pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=False)])
    return out


class Coder:
    """The tokenizer of a rank file and its table of bytes."""

    def __init__(self, path: str, pattern: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # Spark has a task for each core
        self.tokenizer = tokenizer_from_ranks(path, pattern)
        ranks = read_ranks(path)
        known = [b""] * (max(ranks.values()) + 2)  # the last stands for ids that the vocabulary lacks, which have no bytes
        for token, rank in ranks.items():
            known[rank] = token
        self.bytes, self.lengths = pa.array(known, pa.binary()), np.fromiter(map(len, known), np.int64)

    def encode(self, texts: pa.Array) -> pa.ListArray:
        ends, parts = [np.zeros(1, np.int64)], []
        for a in range(0, len(texts), TEXTS):
            found = self.tokenizer.encode_batch_fast(texts.slice(a, TEXTS).to_pylist(), add_special_tokens=False)
            ids = [e.ids for e in found]
            ends.append(np.cumsum([len(x) for x in ids]) + ends[-1][-1])
            parts.append(np.fromiter((i for x in ids for i in x), np.int32))
        return pa.ListArray.from_arrays(pa.array(np.concatenate(ends), pa.int32()), pa.array(np.concatenate([np.zeros(0, np.int32), *parts])))

    def places(self, texts: pa.Array, ids: pa.ListArray) -> tuple[pa.ListArray, pa.ListArray, np.ndarray]:
        """Start and end of each id in code points of its text, where a character counts for each id that has a part of it; and
        how many of a text's ids end within a character."""
        at = np.frombuffer(texts.buffers()[1], np.int32)[texts.offset : texts.offset + len(texts) + 1].astype(np.int64)
        raw = np.frombuffer(texts.buffers()[2] or b"", np.uint8)[at[0] : at[-1]]
        lead = np.r_[(raw & 0xC0) != 0x80, True]
        number = np.cumsum(lead) - 1  # of the character that each byte belongs to
        cuts = ids.offsets.to_numpy()
        ends = np.cumsum(self.lengths[ids.values.to_numpy()])
        first = np.repeat(number[at[:-1] - at[0]], np.diff(cuts))  # of the id's text
        starts = np.r_[np.zeros(min(1, len(ends)), np.int64), ends[:-1]]
        split = np.r_[0, np.cumsum(~lead[ends])][cuts]
        lists = lambda x: pa.ListArray.from_arrays(ids.offsets, pa.array((x - first).astype(np.int32)))
        return lists(number[starts]), lists(number[ends - 1] + 1), np.diff(split)

    def decode(self, ids: pa.ListArray) -> pa.Array:
        """The bytes of each row: those of all ids one after the other, cut where rows end."""
        values, none = ids.flatten().to_numpy(zero_copy_only=False), len(self.bytes) - 1
        raw = self.bytes.take(pa.array(np.where((values >= 0) & (values < none), values, none).astype(np.int64)))
        ends = np.frombuffer(raw.buffers()[1], np.int32)[: len(raw) + 1] if len(raw) else np.zeros(1, np.int32)
        offsets = ids.offsets.to_numpy()
        cuts = np.ascontiguousarray(ends[offsets - offsets[0]], np.int32)
        return pa.Array.from_buffers(pa.binary(), len(ids), [None, pa.py_buffer(cuts), raw.buffers()[2] or pa.py_buffer(b"")])


def as_text(raw: pa.Array) -> pa.Array:
    """Bytes as characters; those that make none become U+FFFD."""
    try:
        return raw.cast(pa.string())
    except pa.ArrowInvalid:
        return pa.array([x.as_py().decode(errors="replace") for x in raw], pa.string())


def coder_of(path: str, pattern: str = public_tokenizers.PATTERN) -> Coder:
    return resident(("bpe", path, pattern), lambda: Coder(path, pattern))


def _path(vocabulary: str | None) -> str:
    return vocabulary or public_tokenizers.path("byte_bpe_50k.tiktoken")


def _texts(docs: DataFrame) -> DataFrame:
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), text_of().alias("text"))


def encode(docs: DataFrame, vocabulary: str | None = None, pattern: str = public_tokenizers.PATTERN, offsets: bool = False) -> DataFrame:
    """doc_id, ids array<int>; with offsets also starts and ends array<int> in code points of the text."""
    path = _path(vocabulary)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = coder_of(path, pattern)
        for batch in slices(batches):
            ids = coder.encode(batch.column("text"))
            columns = [batch.column("doc_id"), ids, *(coder.places(batch.column("text"), ids)[:2] if offsets else [])]
            yield pa.RecordBatch.from_arrays(columns, ["doc_id", "ids", "starts", "ends"][: len(columns)])

    return _texts(docs).mapInArrow(run, "doc_id long, ids array<int>" + ", starts array<int>, ends array<int>" * offsets)


def decode(encoded: DataFrame, vocabulary: str | None = None) -> DataFrame:
    """doc_id and ids with `decoded` (bytes) and `text`. Null ids count as none."""
    path = _path(vocabulary)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = coder_of(path)
        for batch in slices(batches):
            raw = coder.decode(batch.column("ids"))
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), batch.column("ids"), raw, as_text(raw)], ["doc_id", "ids", "decoded", "text"])

    some = F.coalesce("ids", F.array().cast("array<int>")).alias("ids")
    return encoded.select("doc_id", some).mapInArrow(run, "doc_id long, ids array<int>, decoded binary, text string")


def digests(docs: DataFrame, vocabulary: str | None = None, keep_ids: bool = False) -> DataFrame:
    """Per document: doc_id, n_tokens, ids_sha256, decoded_sha256 (of the bytes decoded from the ids), n_split (ids that end
    within a character); and ids if kept. Encoding and decoding a batch in one task needs one worker for each core."""
    path = _path(vocabulary)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = coder_of(path)
        sha = lambda column: pa.array([hashlib.sha256(x.as_buffer() or b"").hexdigest() for x in column])
        for batch in slices(batches):
            ids = coder.encode(batch.column("text"))
            *_, split = coder.places(batch.column("text"), ids)
            said = pc.binary_join(pa.ListArray.from_arrays(ids.offsets, pc.cast(ids.values, pa.string())), " ")
            columns = {"doc_id": batch.column("doc_id"), "n_tokens": pc.list_value_length(ids).cast(pa.int64()), "ids_sha256": sha(said), "decoded_sha256": sha(coder.decode(ids)), "n_split": pa.array(split, pa.int64())}
            columns |= {"ids": ids} if keep_ids else {}
            yield pa.RecordBatch.from_arrays(list(columns.values()), list(columns))

    return _texts(docs).mapInArrow(run, "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string, n_split long" + ", ids array<int>" * keep_ids)


def op5_byte_bpe(spark, sf_dir: str) -> DataFrame:
    return digests(table(spark, sf_dir, "documents"))
