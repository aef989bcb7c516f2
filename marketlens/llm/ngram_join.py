"""N-gram Jaccard join by a blocked sparse matrix product of document by n-gram incidence.

A document's set holds its distinct n-word shingles; two documents link when |A & B| / |A | B| reaches a similarity.
Documents of equal sets are one row of the matrix. The columns are put in one order for all, approximately rarest
first; a pair that links must meet in the first |A| - ceil(similarity * |A|) + 1 shingles of each (a size-derived bound),
so only these make candidates. Within such a column, documents sorted by set size fall into chains whose sizes are close
enough to link; the first of a chain is its hub. All pairs of a column's chain have that hub in common, so the pairs to
test are those within the members of each hub. Members are taken in blocks: the product of two blocks' incidence rows
adds up overlap counts, column block by column block, and counts below the bound that the two sizes give are dropped.

Each block of a hub is multiplied with itself and with every other block of it, so that all links between different sets are
found, inside large groups too; a pair that meets at several hubs is given by the smallest. Equal sets are one class and
no pair of copies is listed: a document's number of links adds up the sizes of the classes that its own class links with, in
the block where they are found, so that links themselves are listed by `links` only.

Nulls and texts without words have empty sets and link with nothing. Rows may repeat; of rows with the same doc_id each is
returned. A row without doc_id has no name by which it could be linked: `join` returns it with the size of its set, no links and
no component, and it takes no part in other rows' links; `links` leaves it out. Empty tables give empty results. Other columns are ignored.
"""

from __future__ import annotations

import itertools
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import batch_words, components, mix, shingle_hashes, slices, small, summed, table, written

#: Members of a block, and columns of a block of the product.
BLOCK, COLUMNS = 256, 4096

#: A column of at most so many members is multiplied entry by entry, and so many products at a time.
THIN, PRODUCTS = 16, 1 << 20

#: Counters for the approximate frequency of shingles, by their hash; in how many slices they are summed.
COUNTERS, SLICES = 1 << 21, 8


def doc_sets(batch: pa.RecordBatch, n: int) -> Iterator[tuple[int, np.ndarray]]:
    """doc_id and sorted distinct shingle hashes of each row."""
    words, at = batch_words(batch.column("text"))
    for k, doc_id in enumerate(batch.column("doc_id").to_pylist()):
        yield doc_id, np.unique(shingle_hashes(words[at[k] : at[k + 1]], n))


def _texts(docs: DataFrame) -> DataFrame:
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text"))


def signatures(docs: DataFrame, n: int) -> DataFrame:
    """A row (doc_id, n_shingles, sig) for each document, where equal sets have equal sig; and, without sig, for each task the
    counters of its shingles in slices (slice, counts)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = ["doc_id", "n_shingles", "sig", "slice", "counts"]
        kinds = [pa.int64(), pa.int64(), pa.binary(), pa.int32(), pa.binary()]
        counts = np.zeros(COUNTERS, np.float64)
        for batch in slices(batches):
            rows, seen = [], []
            for doc_id, s in doc_sets(batch, n):
                seen.append(s)
                h = np.stack([s, mix(s)])
                sig = np.r_[np.uint64(len(s)), h.sum(1, dtype=np.uint64), np.bitwise_xor.reduce(mix(h + np.uint64(7)), axis=1)] if len(s) else np.zeros(1, np.uint64)
                rows.append((doc_id, len(s), sig.tobytes(), None, None))
            if seen:
                counts += np.bincount((np.concatenate(seen) % np.uint64(COUNTERS)).astype(np.int64), minlength=COUNTERS)
            yield pa.RecordBatch.from_arrays([pa.array(x, k) for x, k in zip(zip(*rows, strict=True), kinds, strict=True)] if rows else [pa.array([], k) for k in kinds], names)
        step = COUNTERS // SLICES
        rows = [(None, None, None, k, counts[k * step : (k + 1) * step].tobytes()) for k in range(SLICES) if counts.any()]
        if rows:
            yield pa.RecordBatch.from_arrays([pa.array(x, k) for x, k in zip(zip(*rows, strict=True), kinds, strict=True)], names)

    return written(_texts(docs).mapInArrow(run, "doc_id long, n_shingles long, sig binary, slice int, counts binary"), "sets")


def frequencies(sets: DataFrame) -> np.ndarray:
    """The counters, as one byte each (a logarithm); of fixed size whatever the input."""
    out, step = np.zeros(COUNTERS, np.uint8), COUNTERS // SLICES
    for row in summed(sets.where("sig is null").select("slice", "counts")).collect():  # SLICES rows
        out[row["slice"] * step : (row["slice"] + 1) * step] = np.round(4 * np.log2(1 + np.frombuffer(row["counts"], np.float64)))
    return out


def needed(a: np.ndarray, b: np.ndarray, share: int, of: int) -> np.ndarray:
    """The least overlap of sets of a and b members that link: share / of is the similarity."""
    return -(-share * (a + b) // (of + share))


def overlaps(left: list[np.ndarray], right: list[np.ndarray]) -> np.ndarray:
    """Overlap counts of all pairs of sets: the sparse product of their incidence rows, block by block of columns. Entries of
    thin columns are multiplied one by one; the others, which many rows share, are multiplied as full blocks. The diagonal, which
    no link needs, counts shared columns only."""
    own = left is right
    every = left if own else left + right
    sizes = np.fromiter(map(len, every), np.int64, len(every))
    first = 0 if own else len(left)  # of the right rows
    out = np.zeros((len(left), len(every) - first), np.int64)
    if not sizes.sum():
        return out
    _, at, times = np.unique(np.concatenate(every), return_inverse=True, return_counts=True)
    order = np.argsort(at, kind="stable")
    rows, begin = np.repeat(np.arange(len(every)), sizes)[order], np.r_[0, np.cumsum(times)]

    thin = np.flatnonzero((times > 1) & (times <= THIN))
    for some in np.array_split(thin, 1 + int((times[thin] ** 2).sum()) // PRODUCTS):
        t = times[some]
        entry = np.repeat(begin[some], t) + np.arange(t.sum()) - np.repeat(np.cumsum(t) - t, t)
        each = np.repeat(t, t)  # partners of each entry
        a = np.repeat(rows[entry], each)
        b = rows[np.repeat(np.repeat(begin[some], t), each) + np.arange(len(a)) - np.repeat(np.cumsum(each) - each, each)]
        use = (a < len(left)) & (b >= first)
        out += np.bincount(a[use] * out.shape[1] + b[use] - first, minlength=out.size).reshape(out.shape)

    full = np.flatnonzero(times > THIN)
    for k in range(0, len(full), COLUMNS):
        some = full[k : k + COLUMNS]
        t = times[some]
        entry = np.repeat(begin[some], t) + np.arange(t.sum()) - np.repeat(np.cumsum(t) - t, t)
        part = np.zeros((len(every), len(some)), np.float32)
        part[rows[entry], np.repeat(np.arange(len(some)), t)] = 1
        out += (part[: len(left)] @ part[first:].T).astype(np.int64)
    return out


def tree(n: int, a: np.ndarray, b: np.ndarray) -> list[int]:
    """Places of links that join groups of 0..n-1 which no earlier link has joined."""
    top, out = list(range(n)), []
    for k, (x, y) in enumerate(zip(a.tolist(), b.tolist(), strict=True)):
        while top[x] != x:
            top[x] = top[top[x]]
            x = top[x]
        while top[y] != y:
            top[y] = top[top[y]]
            y = top[y]
        if x != y:
            top[x] = y
            out.append(k)
    return out


def candidates(docs: DataFrame, levels: np.ndarray, n: int, share: int, of: int) -> DataFrame:
    """hub, doc: the members of each hub, itself included."""
    known = docs.sparkSession.sparkContext.broadcast(levels)  # COUNTERS bytes

    def chains(shingle: np.ndarray, size: np.ndarray) -> np.ndarray:
        """Whether each row begins a chain; rows are sorted by shingle and size."""
        new = np.ones(len(shingle), bool)
        new[1:] = (shingle[1:] != shingle[:-1]) | (of * size[:-1] < share * size[1:])
        return new

    def shared(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """doc, n, times: columns that a document shares. The last row of a batch waits for the next one."""
        held, alone = [np.zeros(0, np.int64)] * 3, True
        for last, batch in itertools.chain(((False, b) for b in batches), [(True, None)]):
            shingle, size, doc = held if last else (np.r_[h, batch.column(k).to_numpy()] for k, h in enumerate(held))
            if not len(shingle):
                continue
            new = chains(shingle, size)
            new[0] &= alone
            joined = ~new
            joined[:-1] |= ~new[1:]
            done = len(shingle) if last else len(shingle) - 1
            held, alone = [x[done:] for x in (shingle, size, doc)], bool(new[-1])
            docs_, at, times = np.unique(doc[:done][joined[:done]], return_index=True, return_counts=True)
            yield pa.RecordBatch.from_arrays([pa.array(docs_), pa.array(size[:done][joined[:done]][at]), pa.array(times)], ["doc", "n", "times"])

    def prefixes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            ids, sizes, out = [], [], []
            for doc_id, s in doc_sets(batch, n):
                if k := len(s):
                    first = k - -(-share * k // of) + 1 + k // 10
                    level = known.value[(s % np.uint64(COUNTERS)).astype(np.int64)]
                    out.append(s[np.lexsort((s, level))[:first]])
                    ids.append(doc_id)
                    sizes.append(k)
            times = [len(x) for x in out]
            yield pa.RecordBatch.from_arrays([pa.array((np.concatenate(out) if out else np.zeros(0, np.uint64)).view(np.int64)), pa.array(np.repeat(np.array(sizes, np.int64), times)), pa.array(np.repeat(np.array(ids, np.int64), times))], ["shingle", "n", "doc"])

    def hubs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Rows come sorted by shingle, n, doc. Only the last row and its hub are carried from batch to batch."""
        last = hub = None
        for batch in batches:
            shingle, size, doc = (batch.column(k).to_numpy() for k in range(3))
            if not len(shingle):
                continue
            new = chains(shingle, size)
            if last is not None:
                new[0] = last[0] != shingle[0] or of * last[1] < share * size[0]
            chain = np.cumsum(new)
            firsts = np.r_[-1 if hub is None else hub, doc[new]]
            of_hub = firsts[chain]
            pairs = np.unique(np.stack([of_hub, doc])[:, of_hub != doc], axis=1)
            last, hub = (shingle[-1], size[-1]), of_hub[-1]
            yield pa.RecordBatch.from_arrays([pa.array(pairs[0]), pa.array(pairs[1])], ["hub", "doc"])

    parts = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))

    def columns(some: DataFrame) -> DataFrame:
        rows = _texts(some).mapInArrow(prefixes, "shingle long, n long, doc long")
        return rows.repartition(parts, "shingle").sortWithinPartitions("shingle", "n", "doc")

    # A partner has share / of as many shingles at least, and so its own k is this at least.
    enough = 1 + F.floor(F.col("n") * share / (of * 10))
    times = columns(docs).mapInArrow(shared, "doc long, n long, times long").groupBy("doc").agg(F.min("n").alias("n"), F.sum("times").alias("times"))
    kept = written(times.where(F.col("times") >= enough).select(F.col("doc").alias("doc_id")), "kept")
    pairs = written(columns(docs.join(small(kept), "doc_id", "left_semi")).mapInArrow(hubs, "hub long, doc long").distinct(), "members")
    return written(pairs.union(pairs.select("hub", F.col("hub").alias("doc")).distinct()), "hubs")


def _links_of(ids: np.ndarray, sets: list[np.ndarray], hubs: list[np.ndarray], other: slice, rest: slice, share: int, of: int) -> tuple[np.ndarray, ...]:
    """Links (as places) between the sets at `other` and those at `rest`, and their overlaps, from the product; only those
    of pairs that share none of the `hubs` given with them."""
    size = np.fromiter(map(len, sets), np.int64, len(sets))
    over = overlaps(sets[other], sets[other] if other == rest else sets[rest])
    a, b = np.nonzero(over >= needed(size[other][:, None], size[rest][None, :], share, of))
    if len(a):
        new = overlaps(hubs[other], hubs[other] if other == rest else hubs[rest])[a, b] == 0
        a, b = a[new], b[new]
    c = over[a, b]
    a, b = a + (other.start or 0), b + (rest.start or 0)
    keep = ids[a] < ids[b] if other == rest else ids[a] != ids[b]
    return a[keep], b[keep], c[keep]


def products(docs: DataFrame, n: int, share: int, of: int, levels: np.ndarray, report, schema: str, weights: DataFrame | None = None) -> DataFrame:
    """What `report` makes of the links of each two blocks: of places a, b of the linked documents, their overlaps, and the ids,
    set sizes and weights of all. Documents that `weights` (doc, weight) lacks weigh 1."""
    members = candidates(docs, levels, n, share, of)
    sizes = members.groupBy("hub").agg(F.ceil(F.count(F.lit(1)) / BLOCK).cast("int").alias("blocks"))
    others = members.groupBy("doc").agg(F.collect_set("hub").alias("hubs"))
    others = others.join(small(weights), "doc", "left") if weights is not None else others.withColumn("weight", F.lit(1).cast("long"))
    blocks = written(members.join(small(written(sizes, "sizes")), "hub").join(others, "doc"), "blocks")

    def set_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            rows = [(d, s.tobytes()) for d, s in doc_sets(batch, n)]
            yield pa.RecordBatch.from_arrays([pa.array(x, k) for x, k in zip(zip(*rows, strict=True), (pa.int64(), pa.binary()), strict=True)] if rows else [pa.array([], pa.int64()), pa.array([], pa.binary())], ["doc", "items"])

    def with_sets(wanted: DataFrame) -> DataFrame:
        """The rows with their documents' sets."""
        ids = small(written(wanted.select(F.col("doc").alias("doc_id")).distinct(), "ids"))
        return wanted.join(_texts(docs.join(ids, "doc_id", "left_semi")).mapInArrow(set_rows, "doc long, items binary"), "doc")

    def product(rows: pd.DataFrame) -> pd.DataFrame:
        rows = rows.sort_values(["side", "doc"])
        ids, sets, cut = rows["doc"].to_numpy(), [np.frombuffer(x, np.uint64) for x in rows["items"]], int((rows["side"] == 0).sum())
        # A pair belongs to the smallest hub that both stand in.
        hub = rows["hub"].iloc[0]
        before = [np.array([h for h in x if h < hub], np.int64) for x in rows["hubs"]]
        own = rows["i"].iloc[0] == rows["j"].iloc[0]
        a, b, c = _links_of(ids, sets, before, *([slice(None)] * 2 if own else [slice(0, cut), slice(cut, None)]), share, of)
        size = np.fromiter(map(len, sets), np.int64, len(sets))
        if len(set(ids.tolist())) < len(ids):  # rows of one doc_id may have several texts; their largest overlap counts
            order = np.argsort(-c, kind="stable")
            pair = np.stack([np.minimum(ids[a], ids[b]), np.maximum(ids[a], ids[b])])[:, order]
            order = order[np.unique(pair, axis=1, return_index=True)[1]]
            a, b, c = a[order], b[order], c[order]
        return report(a, b, c, ids, size, rows["weight"].fillna(1).to_numpy(np.int64))

    # Each block with itself and with each later one: a member goes once to each block of its hub.
    k = F.pmod(F.xxhash64("doc"), F.col("blocks")).cast("int")
    pairs = blocks.withColumn("k", k).withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    dealt = pairs.select("hub", "doc", "hubs", "weight", F.least("k", "other").alias("i"), F.greatest("k", "other").alias("j"), (F.col("k") > F.col("other")).cast("int").alias("side"))
    return written(with_sets(dealt).groupBy("hub", "i", "j").applyInPandas(product, schema), "links")


def links(docs: DataFrame, n: int = 5, share: int = 80, of: int = 100, levels: np.ndarray | None = None) -> DataFrame:
    """a, b, overlap, similarity of all links between documents of different sets, each pair once with a < b."""

    def report(a, b, c, ids, size, _):
        return pd.DataFrame({"a": np.minimum(ids[a], ids[b]), "b": np.maximum(ids[a], ids[b]), "overlap": c, "similarity": c / (size[a] + size[b] - c)})

    docs = docs.where("doc_id is not null")
    levels = frequencies(signatures(docs, n)) if levels is None else levels
    return products(docs, n, share, of, levels, report, "a long, b long, overlap long, similarity double")


def summary(docs: DataFrame, weights: DataFrame, n: int, share: int, of: int, levels: np.ndarray) -> DataFrame:
    """What components and numbers of links need of the links, in a row or two for a member of a block, not one for a link: a, b
    of links that hold the groups of each two blocks together; and a, near: the weight that a document of a block links with."""

    def report(a, b, _, ids, __, weight):
        own, number = np.unique(ids, return_inverse=True)
        kept = tree(len(own), number[a], number[b])
        near = np.bincount(number[a], weight[b], len(own)) + np.bincount(number[b], weight[a], len(own))
        some = np.flatnonzero(near)
        ends = pd.DataFrame({"a": ids[a[kept]], "b": pd.array(ids[b[kept]], "Int64"), "near": 0})
        return pd.concat([ends, pd.DataFrame({"a": own[some], "b": pd.array([None] * len(some), "Int64"), "near": near[some].astype(np.int64)})])

    return products(docs, n, share, of, levels, report, "a long, b long, near long", weights)


def join(docs: DataFrame, n: int = 5, share: int = 80, of: int = 100) -> DataFrame:
    """Per row: doc_id, n_shingles, n_links (other doc_ids that it links with, copies included), component_id (the smallest
    doc_id reachable by links, itself included)."""
    sets = signatures(docs, n)
    rows = sets.where("sig is not null and doc_id is not null").select("doc_id", "n_shingles", "sig")
    nameless = sets.where("sig is not null and doc_id is null")
    # Rows without words have the empty set, but do not equal each other.
    classes = written(rows.where("n_shingles > 0").groupBy("sig").agg(F.min("doc_id").alias("class"), F.count_distinct("doc_id").alias("members"), F.count(F.lit(1)).alias("rows")), "classes")
    own = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").join(small(classes.select(F.col("class").alias("doc_id"))), "doc_id", "left_semi")
    copied = written(classes.where("members > 1").groupBy(F.col("class").alias("doc")).agg(F.max("members").alias("weight")), "copied")
    found = summary(own, copied, n, share, of, frequencies(sets))
    groups = components(found.where("b is not null").select("a", "b"))
    times = found.where("b is null").groupBy("a").agg(F.sum("near").alias("near"))
    # A single row without links is all of its component. The others' classes are few, or are joined by sig, where a class of
    # very many rows meets one row, so that Spark's adaptive join may split it.
    named = classes.join(small(written(groups, "groups")), classes["class"] == F.col("doc"), "left").join(small(written(times, "times")), classes["class"] == F.col("a"), "left")
    named = named.where("rows > 1 or component is not null").select("sig", F.coalesce("component", "class").alias("component"), (F.col("members") + F.coalesce("near", F.lit(0))).alias("reached"))
    n_links = F.coalesce(F.col("reached") - 1, F.lit(0))
    with_words = rows.where("n_shingles > 0").join(small(written(named, "named")), "sig", "left").select("doc_id", "n_shingles", n_links.alias("n_links"), F.coalesce("component", "doc_id").alias("component_id"))
    alone = rows.where("n_shingles = 0").select("doc_id", "n_shingles", F.lit(0).cast("long"), "doc_id")
    return with_words.union(alone).union(nameless.select("doc_id", "n_shingles", F.lit(0).cast("long"), F.lit(None).cast("long")))


def op6_ngram_join(spark, sf_dir: str) -> DataFrame:
    """The columns of the query's SQL, which has no n_links."""
    return join(table(spark, sf_dir, "documents"), 3, 90, 100).select("doc_id", "n_shingles", "component_id")
