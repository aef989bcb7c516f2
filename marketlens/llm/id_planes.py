"""Token-id files by bit-plane shuffling.

A file holds the ids of whole documents, in blocks of a fixed number of ids. Each block is transposed into byte planes
(or bit planes) and each plane is compressed with zstandard; a chunk index at the end gives the place, the number of ids
and the plane sizes of each block, and a document table the id and length of each document.

    magic | planes of block 0 | planes of block 1 | ... | zstd(chunk index) | zstd(document table) | footer

Documents are dealt out by ranges of doc_id, so file order is document order. A task writes its files under names of its
own and reports them in a manifest row; a repeated task leaves only unlisted files. Rows of equal doc_id stay together,
by text; rows without doc_id come first and are marked so in the document table. Nulls count as empty texts, which hold
just the end id. An empty table makes no files. Other columns are ignored.
"""

from __future__ import annotations

import itertools
import json
import re
import uuid
import zlib
from array import array
from collections.abc import Iterator

import numpy as np
import public_tokenizers
import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from .bpe import byte_alphabet
from .common import CACHE_BYTES, Bounded, new_path, of_letters, opened, resident, slices, table, text_of, written

MAGIC = b"IDPLANE1"
BLOCK_IDS = 1 << 16
FILE_IDS = 1 << 26
#: and so many documents, whose names and lengths a task holds; and documents that it hands on together when it reads.
FILE_DOCS, READ_DOCS = 1 << 20, 1 << 16
CHUNK = np.dtype([("offset", "<u8"), ("n_ids", "<u4"), ("sizes", "<u4", (32,))])
DOC = np.dtype([("doc_id", "<i8"), ("named", "u1"), ("n_tokens", "<u4")])
FOOTER = np.dtype([("chunks", "<u8"), ("docs", "<u8"), ("planes", "<u4"), ("block_ids", "<u4"), ("magic", "S8")])


def planes_of(ids: np.ndarray, bits: bool) -> list[bytes]:
    """The byte planes (4) or bit planes (32) of uint32 ids."""
    by_byte = np.ascontiguousarray(ids.astype("<u4").view(np.uint8).reshape(-1, 4).T)
    if not bits:
        return [p.tobytes() for p in by_byte]
    return [np.packbits((p >> k) & 1).tobytes() for p in by_byte for k in range(8)]


def ids_of(planes: list[bytes], n: int) -> np.ndarray:
    if len(planes) == 4:
        return np.ascontiguousarray(np.stack([np.frombuffer(p, np.uint8) for p in planes]).T).view("<u4").reshape(-1)
    out = np.zeros((4, n), np.uint8)
    for k, p in enumerate(planes):
        out[k // 8] |= np.unpackbits(np.frombuffer(p, np.uint8), count=n) << (k % 8)
    return np.ascontiguousarray(out.T).view("<u4").reshape(-1)


class Writer:
    def __init__(self, stream, block_ids: int = BLOCK_IDS, bits: bool = False, level: int = 1):
        self.out, self.block_ids, self.bits, self.zip = stream, block_ids, bits, zstandard.ZstdCompressor(level=level)
        self.chunks, self.docs, self.waiting, self.n_waiting, self.n_ids = [], [], [], 0, 0
        self.out.write(MAGIC)
        self.at = len(MAGIC)

    def add(self, doc_id: int | None, ids: np.ndarray) -> None:
        self.docs.append((doc_id or 0, doc_id is not None, len(ids)))
        self.waiting.append(ids)
        self.n_waiting += len(ids)
        self.n_ids += len(ids)
        if self.n_waiting >= self.block_ids:
            self.flush()

    def flush(self, last: bool = False) -> None:
        ids = np.concatenate([*self.waiting, np.zeros(0, "<u4")]).astype("<u4")
        whole = len(ids) if last else len(ids) - len(ids) % self.block_ids
        for a in range(0, whole, self.block_ids):
            block = ids[a : min(a + self.block_ids, whole)]
            packed = [self.zip.compress(p) for p in planes_of(block, self.bits)]
            self.chunks.append((self.at, len(block), [len(p) for p in packed] + [0] * (32 - len(packed))))
            self.out.write(b"".join(packed))
            self.at += sum(map(len, packed))
        self.waiting, self.n_waiting = [ids[whole:]], len(ids) - whole

    def close(self) -> None:
        self.flush(last=True)
        parts = [self.zip.compress(np.array(rows, kind).tobytes()) for rows, kind in ((self.chunks, CHUNK), (self.docs, DOC))]
        self.out.write(b"".join(parts) + np.array([(len(parts[0]), len(parts[1]), 32 if self.bits else 4, self.block_ids, MAGIC)], FOOTER).tobytes())
        self.out.close()


class Reader:
    """Reads the index first, then any block by itself."""

    def __init__(self, source):
        self.source, n = source, source.size()
        source.seek(n - FOOTER.itemsize)
        foot = np.frombuffer(source.read(FOOTER.itemsize), FOOTER)[0]
        if foot["magic"] != MAGIC:
            raise ValueError("not a file of id planes")
        self.n_planes = int(foot["planes"])
        source.seek(n - FOOTER.itemsize - int(foot["chunks"]) - int(foot["docs"]))
        unzip = zstandard.ZstdDecompressor().decompress
        self.chunks = np.frombuffer(unzip(source.read(int(foot["chunks"]))), CHUNK) if foot["chunks"] else np.zeros(0, CHUNK)
        self.docs = np.frombuffer(unzip(source.read(int(foot["docs"]))), DOC)

    def block(self, k: int) -> np.ndarray:
        c = self.chunks[k]
        sizes = c["sizes"][: self.n_planes].astype(np.int64)
        self.source.seek(int(c["offset"]))
        raw, ends = self.source.read(int(sizes.sum())), np.cumsum(sizes)
        unzip = zstandard.ZstdDecompressor().decompress
        return ids_of([unzip(raw[b - a : b]) for a, b in zip(sizes, ends, strict=True)], int(c["n_ids"]))

    def documents(self) -> Iterator[tuple[int | None, int, np.ndarray]]:
        """doc_id, place of its first id in the file, its ids; a few blocks are held at a time."""
        held, at, k = np.zeros(0, "<u4"), 0, 0
        for doc_id, named, n in self.docs.tolist():
            if len(held) < n:
                more = [held]
                while sum(map(len, more)) < n:
                    more.append(self.block(k))
                    k += 1
                held = np.concatenate(more)
            yield doc_id if named else None, at, held[:n]
            held, at = held[n:], at + n


#: A text of these characters is in normal form, and its letters are letters in every version of Unicode.
LETTERS = "A-Za-z" + chr(0xC0) + "-" + chr(0xD6) + chr(0xD8) + "-" + chr(0xF6) + chr(0xF8) + "-" + chr(0xFF)
LATIN = re.compile(f"[ -~\\n{LETTERS}]*")


class Cores(Bounded):
    """Pre-token in lower case -> its ids as bytes of little-endian uint32."""

    def __init__(self, model):
        super().__init__()
        self.model, self.letters = model, byte_alphabet()

    def make(self, token: str) -> bytes:
        name = token if token.isascii() else "".join(map(self.letters.__getitem__, token.encode()))
        return array("I", [t.id for t in self.model.tokenize(name)]).tobytes()


class Words(Bounded):
    """Piece of Latin text without space or newline -> its ids as bytes of little-endian uint32. White space only divides, so
    pieces are encoded alone, a pre-token at a time; texts with other characters or special strings go to the library whole."""

    def __init__(self, path: str):
        super().__init__(2 * CACHE_BYTES)
        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.no_truncation()
        self.tokenizer.no_padding()
        self.cores = Cores(self.tokenizer.model)
        split = json.loads(self.tokenizer.to_str())["pre_tokenizer"]["pretokenizers"][0]
        self.pre_tokens = of_letters(split["pattern"]["Regex"], LETTERS).findall
        self.special = [t.content for t in self.tokenizer.get_added_tokens_decoder().values()]

    def make(self, piece: str) -> bytes:
        piece = piece.lower()
        return self.cores[piece] if piece.isalpha() else b"".join(map(self.cores.__getitem__, self.pre_tokens(piece)))

    def encode(self, text: str) -> bytes:
        if LATIN.fullmatch(text) and not any(s in text for s in self.special):
            return b"".join(map(self.__getitem__, filter(None, text.replace("\n", " ").split(" "))))
        return array("I", self.tokenizer.encode(text, add_special_tokens=False).ids).tobytes()


def write_ids(docs: DataFrame, folder: str, vocabulary: str | None = None, end_id: int = 2, n_files: int | None = None, bits: bool = False) -> DataFrame:
    """Writes the files; returns the manifest: part, file, path, n_docs, n_ids, in document order by (part, file).

    The vocabulary is taken to lower case and split on white space, as word_bpe_49k.json does."""
    path, spark = vocabulary or public_tokenizers.path("word_bpe_49k.json"), docs.sparkSession

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cache = resident(("id_planes", path), lambda: Words(path))
        part, k, writer, name, rows = TaskContext.get().partitionId(), 0, None, "", []
        system, top = opened(folder)
        end = np.array([end_id], "<u4").tobytes()

        def close() -> None:
            writer.close()
            rows.append((part, k, name, len(writer.docs), writer.n_ids))

        for batch in slices(batches):
            for doc_id, text in zip(batch.column("doc_id").to_pylist(), batch.column("text").to_pylist(), strict=True):
                if writer is None:
                    name = f"part-{part:06d}-{k:04d}-{uuid.uuid4().hex}.idp"
                    writer = Writer(system.open_output_stream(f"{top}/{name}"), bits=bits)
                writer.add(doc_id, np.frombuffer(cache.encode(text) + end, "<u4"))
                if writer.n_ids >= FILE_IDS or len(writer.docs) >= FILE_DOCS:
                    close()
                    writer, k = None, k + 1
        if writer is not None:
            close()
        if rows:
            yield pa.RecordBatch.from_arrays([pa.array(x) for x in zip(*rows, strict=True)], ["part", "file", "path", "n_docs", "n_ids"])

    system, top = opened(folder)
    system.create_dir(top, recursive=True)
    n = n_files or int(spark.conf.get("spark.sql.shuffle.partitions"))
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text_of().alias("text"))
    dealt = rows.repartitionByRange(n, "doc_id").sortWithinPartitions("doc_id", "text")
    return written(dealt.mapInArrow(run, "part long, file long, path string, n_docs long, n_ids long"), "id-manifest")


def read_ids(manifest: DataFrame, folder: str) -> DataFrame:
    """doc_id, start (ids of all documents before it), n_tokens, ids_crc32, from the files of a manifest, one task for a file.

    The manifest has a row for each file, so numbering it is small."""
    spark = manifest.sparkSession

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        system, top = opened(folder)
        for batch in batches:
            for row in batch.to_pylist():
                with system.open_input_file(f"{top}/{row['path']}") as source:
                    found = ((d, row["base"] + at, len(ids), zlib.crc32(np.ascontiguousarray(ids, "<u4").tobytes())) for d, at, ids in Reader(source).documents())
                    while some := list(itertools.islice(found, READ_DOCS)):
                        yield pa.RecordBatch.from_arrays([pa.array(x, pa.int64()) for x in zip(*some, strict=True)], ["doc_id", "start", "n_tokens", "ids_crc32"])

    order = Window.orderBy("part", "file").rowsBetween(Window.unboundedPreceding, -1)
    based = manifest.withColumn("base", F.coalesce(F.sum("n_ids").over(order), F.lit(0)))
    n = max(1, int(spark.conf.get("spark.sql.shuffle.partitions")))
    return based.repartition(n, "part", "file").mapInArrow(run, "doc_id long, start long, n_tokens long, ids_crc32 long")


def encode_and_read(docs: DataFrame, **options) -> DataFrame:
    spark: SparkSession = docs.sparkSession
    folder = new_path(spark, "id-planes")
    return read_ids(write_ids(docs, folder, **options), folder)


def op4_id_planes(spark, sf_dir: str) -> DataFrame:
    return encode_and_read(table(spark, sf_dir, "documents"))
