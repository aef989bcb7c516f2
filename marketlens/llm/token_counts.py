"""Token counts by the whole-token shortcut.

On the driver, each string of the vocabulary is encoded alone; those that come back as their own single id are
proven whole tokens. Over the corpus, a pre-token among them counts one without any merging; the library merges only
the rest. Counts of pieces are kept in a bounded cache for each Python worker.

Nulls count as empty texts, with no bytes and no tokens. Rows are independent: each gives a row, also repeated ones and those
without doc_id. An empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import public_tokenizers
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from .bpe import byte_alphabet
from .common import Bounded, of_letters, resident, slices, table, text_of


CUT = re.compile(r"[ \t\r\n]*[^ \t\r\n]+|[ \t\r\n]+")
ODD_SPACE = re.compile("[" + "".join(map(chr, [11, 12, *range(28, 32), 0x85, 0xA0, 0x1680, 0x180E, *range(0x2000, 0x200C), 0x2028, 0x2029, 0x202F, 0x205F, 0x3000, 0xFEFF])) + "]")
#: Texts of these characters only have the same letters and spaces in every version of Unicode.
LETTERS = "A-Za-z" + chr(0xC0) + "-" + chr(0xD6) + chr(0xD8) + "-" + chr(0xF6) + chr(0xF8) + "-" + chr(0x24F)
COMMON = re.compile(f"[\\t\\n\\r -~{LETTERS}]*")


def pieces(text: str) -> list[str]:
    """Parts of a text that can be encoded independently: a pre-token never crosses from a non-space into white space. Texts
    with white space other than space, tab, CR and LF stay whole, since classes of white space differ there."""
    if not text:
        return []
    return [text] if ODD_SPACE.search(text) else CUT.findall(text)


def whole_tokens(path: str) -> frozenset[str]:
    """Vocabulary strings, in the byte alphabet, that the library's model encodes alone as one token: theirs."""
    tokenizer = Tokenizer.from_file(path)
    model, special = tokenizer.model, {t.content for t in tokenizer.get_added_tokens_decoder().values()}
    out = set()
    for string, i in tokenizer.get_vocab(with_added_tokens=False).items():
        if string not in special and [t.id for t in model.tokenize(string)] == [i]:
            out.add(string)
    return frozenset(out)


class Rest(Bounded):
    """Pre-token, in the byte alphabet -> number of its tokens: one if it is proven whole, else as merged by the library."""

    def __init__(self, model, whole: frozenset[str]):
        super().__init__()
        self.model, self.whole = model, whole

    def __missing__(self, name: str) -> int:
        return 1 if name in self.whole else super().__missing__(name)

    def make(self, name: str) -> int:
        return len(self.model.tokenize(name))


class Counts(Bounded):
    """Piece -> number of its tokens."""

    def __init__(self, path: str, whole: frozenset[str]):
        super().__init__()
        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.no_truncation()
        self.tokenizer.no_padding()
        self.rest, self.letters = Rest(self.tokenizer.model, whole), byte_alphabet()
        self.library_cut, self.pre_tokens = self.tokenizer.pre_tokenizer.pre_tokenize_str, of_letters(public_tokenizers.PATTERN, LETTERS).findall
        self.special = [t.content for t in self.tokenizer.get_added_tokens_decoder().values()]

    def name(self, token: str) -> str:
        return token.replace(" ", "\u0120") if token.isascii() and token.isprintable() else "".join(map(self.letters.__getitem__, token.encode()))

    def make(self, piece: str) -> int:
        if any(s in piece for s in self.special):
            return len(self.tokenizer.encode(piece, add_special_tokens=False).ids)
        if COMMON.fullmatch(piece):
            return sum(self.rest[self.name(t)] for t in self.pre_tokens(piece))
        return sum(self.rest[t] for t, _ in self.library_cut(piece))


def count_tokens(docs: DataFrame, vocabulary: str | None = None, limit: int = 1024) -> DataFrame:
    """Per document: doc_id, n_bytes, n_tokens, over_limit (n_tokens > limit)."""
    path = vocabulary or public_tokenizers.path("byte_bpe_50k.json")
    whole = docs.sparkSession.sparkContext.broadcast(whole_tokens(path))  # of the vocabulary's size

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cache = resident(("token_counts", path), lambda: Counts(path, whole.value))
        for batch in slices(batches):
            n = [sum(map(cache.__getitem__, pieces(x))) for x in batch.column("text").to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), batch.column("n_bytes"), pa.array(n, pa.int64())], ["doc_id", "n_bytes", "n_tokens"])

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text_of().alias("text"), F.octet_length(text_of()).cast("long").alias("n_bytes"))
    counted = rows.mapInArrow(run, "doc_id long, n_bytes long, n_tokens long")
    return counted.withColumn("over_limit", F.col("n_tokens") > limit)


def op8_token_counts(spark, sf_dir: str) -> DataFrame:
    return count_tokens(table(spark, sf_dir, "documents"))
