"""Quality classifier: a generalised additive model with pairwise interactions.

Each feature of a text is cut into bins at quantiles. Cyclic boosting goes round the features, one shallow tree on one
feature at a time, so that the trees of a feature add up to one lookup table; then the pairs of features that explain most
of what is left get tables of their own, of shallow trees on two features, in the same way. A score is the sum of table
entries: a vectorised lookup and addition for each table. The tables can be read as they are (`Model.tables`).

The model is fitted on the driver on a bounded sample: of the distinct labels (doc_id, quality) that are not held out, the SAMPLE of
smallest hashed doc_id, each with one text (of several rows of a doc_id, the text that sorts first). Features are of whole
texts. Nulls count as empty texts. Labels that are null or neither 0 nor 1 are not learnt from, nor are labels without doc_id;
a doc_id with both labels is learnt from with each. With no labels every score is 0.5, with one class it is near that class.
Every row is scored, repeated ones and those without doc_id too; empty tables give no rows. Other columns are kept; columns
named score or predicted are replaced by the model's, in `score`, and kept in `accepted`.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import batch_words, shingle_hashes, slices, table, written

SAMPLE = 20_000
BINS, PAIR_BINS, PAIRS = 64, 16, 8
ROUNDS, PAIR_ROUNDS, RATE, SMOOTH = 150, 60, 0.1, 5.0
THRESHOLD = 0.7

FEATURES = (
    "bytes", "words", "word_bytes", "lower", "upper", "digits", "spaces", "lines", "beyond_ascii", "stops", "marks", "odd_marks",
    "bars", "bangs", "brackets", "entropy", "distinct_words", "distinct_triples", "top_word", "distinct_lines", "odd_mark_words",
)


def features(column: pa.Array) -> np.ndarray:
    """A row of FEATURES for each text."""
    words, at = batch_words(column)
    out = np.zeros((len(column), len(FEATURES)), np.float64)
    for k, text in enumerate(column.to_pylist()):
        raw = (text or "").encode()
        n = max(1, len(raw))
        c = np.bincount(np.frombuffer(raw, np.uint8), minlength=256).astype(np.float64)
        own = words[at[k] : at[k + 1]]
        n_words = max(1, len(own))
        _, times = np.unique(own, return_counts=True)
        share = c[c > 0] / n
        lines = raw.split(b"\n")
        odd = c[[35, 36, 37, 38, 42, 43, 60, 61, 62, 94, 95, 96, 126]].sum()
        out[k] = (
            np.log1p(len(raw)), np.log1p(len(own)), len(raw) / n_words, c[97:123].sum() / n, c[65:91].sum() / n, c[48:58].sum() / n, (c[32] + c[9]) / n, np.log1p(c[10]), c[128:].sum() / n,
            c[[46, 44, 59, 58, 63]].sum() / n, (c[33:48].sum() + c[58:65].sum() + c[91:97].sum() + c[123:127].sum()) / n, odd / n,
            c[124] / n, c[33] / n, c[[40, 41, 91, 93, 123, 125]].sum() / n, -(share * np.log2(share)).sum(), len(times) / n_words,
            len(np.unique(shingle_hashes(own, 3))) / n_words, times.max(initial=0) / n_words, len(set(lines)) / len(lines), odd / n_words,
        )
    return out


@dataclass
class Model:
    edges: list[np.ndarray]
    coarse: list[np.ndarray]
    base: float
    tables: dict[tuple[int, ...], np.ndarray]

    def scores(self, x: np.ndarray) -> np.ndarray:
        total = np.full(len(x), self.base)
        fine = [np.searchsorted(e, x[:, j], "right") for j, e in enumerate(self.edges)]
        coarse = [np.searchsorted(e, x[:, j], "right") for j, e in enumerate(self.coarse)]
        for key, t in self.tables.items():
            total += t[fine[key[0]]] if len(key) == 1 else t[coarse[key[0]], coarse[key[1]]]
        return 1 / (1 + np.exp(-np.clip(total, -30, 30)))


def _gain(g: np.ndarray, h: np.ndarray) -> np.ndarray:
    return g * g / (h + SMOOTH)


def _cut(g: np.ndarray, h: np.ndarray) -> int | None:
    """Where to split a row of bins, or None."""
    left_g, left_h = np.cumsum(g)[:-1], np.cumsum(h)[:-1]
    gains = _gain(left_g, left_h) + _gain(g.sum() - left_g, h.sum() - left_h)
    if not len(gains) or gains.max() <= _gain(g.sum(), h.sum()) + 1e-9:
        return None
    return int(gains.argmax()) + 1


def tree_on_one(g: np.ndarray, h: np.ndarray, depth: int = 2) -> np.ndarray:
    """The values that a shallow tree gives each bin."""
    cut = _cut(g, h) if depth else None
    if cut is None:
        return np.full(len(g), -g.sum() / (h.sum() + SMOOTH))
    return np.r_[tree_on_one(g[:cut], h[:cut], depth - 1), tree_on_one(g[cut:], h[cut:], depth - 1)]


def tree_on_two(g: np.ndarray, h: np.ndarray) -> tuple[np.ndarray, float]:
    """The values that the best cross of one split on each feature gives each pair of bins, and its gain."""
    corner_g, corner_h = g.cumsum(0).cumsum(1), h.cumsum(0).cumsum(1)

    def quarters(c: np.ndarray) -> list[np.ndarray]:
        a, top, side = c[:-1, :-1], c[-1:, :-1], c[:-1, -1:]
        return [a, side - a, top - a, c[-1, -1] - top - side + a]

    qg, qh = quarters(corner_g), quarters(corner_h)
    gains = sum(_gain(a, b) for a, b in zip(qg, qh, strict=True))
    if not gains.size:
        return np.zeros_like(g), 0.0
    i, j = np.unravel_index(gains.argmax(), gains.shape)
    value = [-a[i, j] / (b[i, j] + SMOOTH) for a, b in zip(qg, qh, strict=True)]
    out = np.empty_like(g)
    out[: i + 1, : j + 1], out[: i + 1, j + 1 :], out[i + 1 :, : j + 1], out[i + 1 :, j + 1 :] = value
    return out, float(gains[i, j] - _gain(g.sum(), h.sum()))


def fit(x: np.ndarray, y: np.ndarray) -> Model:
    """Cyclic boosting of the logistic loss: single features first, then the best pairs on what they leave."""
    quantiles = lambda bins: [np.unique(np.quantile(c, np.arange(1, bins) / bins)) for c in x.T] if len(x) else [np.zeros(0)] * x.shape[1]
    model = Model(quantiles(BINS), quantiles(PAIR_BINS), float(np.log((y.sum() + 1) / (len(y) - y.sum() + 1))), {})
    if not len(x):
        return model
    fine = [np.searchsorted(e, x[:, j], "right") for j, e in enumerate(model.edges)]
    coarse = [np.searchsorted(e, x[:, j], "right") for j, e in enumerate(model.coarse)]
    f = np.full(len(y), model.base)

    def slopes() -> tuple[np.ndarray, np.ndarray]:
        p = 1 / (1 + np.exp(-f))
        return p - y, p * (1 - p)

    tables = {(j,): np.zeros(len(e) + 1) for j, e in enumerate(model.edges)}
    for _ in range(ROUNDS):
        for j, bins in enumerate(fine):
            g, h = slopes()
            size = len(tables[j,])
            step = RATE * tree_on_one(np.bincount(bins, g, size), np.bincount(bins, h, size))
            tables[j,] += step
            f += step[bins]

    def on_two(i: int, j: int, g: np.ndarray, h: np.ndarray) -> tuple[np.ndarray, float]:
        shape = (len(model.coarse[i]) + 1, len(model.coarse[j]) + 1)
        at = coarse[i] * shape[1] + coarse[j]
        return tree_on_two(*(np.bincount(at, v, shape[0] * shape[1]).reshape(shape) for v in (g, h)))

    g, h = slopes()
    ranked = sorted(((on_two(i, j, g, h)[1], i, j) for i in range(x.shape[1]) for j in range(i)), reverse=True)
    for _, i, j in ranked[:PAIRS]:
        tables[i, j] = np.zeros((len(model.coarse[i]) + 1, len(model.coarse[j]) + 1))
    for _ in range(PAIR_ROUNDS):
        for _, i, j in ranked[:PAIRS]:
            step = RATE * on_two(i, j, *slopes())[0]
            tables[i, j] += step
            f += step[coarse[i], coarse[j]]
    model.tables = tables
    return model


def held_out() -> Column:
    return F.coalesce(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 4 == 2, F.lit(False))


def train(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE) -> Model:
    """A model of labels.quality from the labelled rows that are not held out, at most `sample` of them."""
    rows = labels.where(F.col("quality").isin(0, 1) & ~held_out() & F.col("doc_id").isNotNull()).select(F.col("doc_id").cast("long").alias("doc_id"), F.col("quality").cast("int").alias("quality")).distinct()
    chosen = written(rows.orderBy(F.xxhash64("doc_id"), "doc_id", "quality").limit(sample), "sample")  # bounded, so it may be broadcast

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), batch.column("quality"), pa.array(list(features(batch.column("text"))), pa.list_(pa.float64()))], ["doc_id", "quality", "x"])

    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text")).join(F.broadcast(chosen), "doc_id")
    one = texts.groupBy("doc_id", "quality").agg(F.min("text").alias("text"))  # at most `sample` rows
    # In one order, so that the same rows always give the same model.
    found = sorted((r["doc_id"], r["quality"], r["x"]) for r in one.mapInArrow(run, "doc_id long, quality int, x array<double>").collect())
    return fit(np.array([r[2] for r in found]).reshape(-1, len(FEATURES)), np.array([r[1] for r in found], np.float64))


def score(docs: DataFrame, model: Model, threshold: float = THRESHOLD) -> DataFrame:
    """The documents' columns with score and predicted."""
    known = docs.sparkSession.sparkContext.broadcast(model)  # tables of fixed size
    names = [c for c in docs.columns if c.lower() not in ("score", "predicted")]
    schema = docs.select(*names, F.lit(0.0).alias("score"), F.lit(0).alias("predicted")).schema

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            p = known.value.scores(features(batch.column("text")))
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(p), pa.array((p >= threshold).astype(np.int32))], [*names, "score", "predicted"])

    return docs.select(*names).mapInArrow(run, schema)


def accepted(docs: DataFrame, model: Model, threshold: float = THRESHOLD) -> DataFrame:
    """The rows, with all their columns, whose score reaches the threshold."""
    known = docs.sparkSession.sparkContext.broadcast(model)  # tables of fixed size

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            yield batch.filter(pa.array(known.value.scores(features(batch.column("text"))) >= threshold))

    return docs.mapInArrow(run, docs.schema)


def op3_quality(spark, sf_dir: str) -> DataFrame:
    docs, labels = table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text"))
    return score(rows, train(docs, labels)).select("doc_id", held_out().alias("held_out"), "score", "predicted")
