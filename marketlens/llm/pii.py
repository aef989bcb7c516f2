"""Information-theoretic sanitisation of personal data.

Patterns find the protected entities: e-mail and IP addresses, card and phone numbers. Co-occurrence over the whole corpus
then estimates how strongly other terms reveal them. A term t (a run of letters and digits outside entities) co-occurs with
an entity e in each document that has both, wherever they stand; over documents (equal texts are one), its disclosure of e is

    PMI(t; e) / IC(e) = 1 + log(n(t, e) / n(t)) / log(N / n(e)),

the share of e's information content that t gives away (1: t occurs only with e). Pairs seen in fewer than SUPPORT different
contexts are no evidence; a context is a document's terms without its entities, so that copies of a document are one
context, and an entity of fewer contexts flags no term. Single entities seldom have as many contexts, so the same is estimated for
their classes: the domain of an e-mail address, the first half of an IP address, the first six digits of a card, the first four of
a phone number. A class is common enough that rare terms meet it by chance, so its pairs need CLASS_SUPPORT contexts, and
evidence: with r = n(t, c) / n(t) and p = n(c) / N, n(t) times the divergence of r from p must reach EVIDENCE nats, a bound of the
probability that chance alone does it (e to the minus 25th). Terms whose
disclosure reaches GENERALISE are replaced by their kind ([NUMBER], [NAME] or [WORD]) wherever they occur, and from REMOVE
on they are taken out. Entities are always replaced by their kind.

Nulls count as empty texts; an empty text has no spans. Each row gives a row, repeated ones and those without doc_id too:
its spans follow from its text alone. An empty table gives no rows. Other columns, whatever their names, are ignored by the
search and kept by the sanitiser.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import BROADCAST_ROWS, batch_words, free_name, mix, slices, small, summed, table, written

SUPPORT = 3
CLASS_SUPPORT, EVIDENCE = 8, 25.0
GENERALISE, REMOVE = 0.7, 0.9
KINDS = ("email", "ip", "card", "phone")

DOMAIN = re.compile(r"@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+")
#: A match always ends with its run of digits, so none begins within a run.
IP = re.compile(r"(?<![0-9])[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)")
CARD = re.compile(r"[0-9]([\x20-]?[0-9])+")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
LOCAL_CHARS = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")


def emails(text: str) -> Iterator[tuple[int, int]]:
    """Matches of [A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\\.[A-Za-z0-9-]+)+, found from each @ so that long runs are read once."""
    free = at = 0
    while (at := text.find("@", at)) >= 0:
        start = at
        while start > free and text[start - 1] in LOCAL_CHARS:
            start -= 1
        m = DOMAIN.match(text, at) if start < at else None
        if m:
            yield start, m.end()
            free = at = m.end()
        else:
            at += 1
            free = at  # a local part holds no @


def luhn(digits: str) -> bool:
    total = sum(map(int, digits[-1::-2])) + sum(d * 2 - 9 * (d > 4) for d in map(int, digits[-2::-2]))
    return total % 10 == 0


def base_spans(text: str) -> list[tuple[int, int, int]]:
    """(start, end, kind as a place in KINDS), by start and then kind."""
    out = [(a, b, 0) for a, b in emails(text)]
    for m in IP.finditer(text):
        if all(len(p.lstrip("0")) <= 3 and int(p.lstrip("0") or 0) <= 255 for p in m[0].split(".")):
            out.append((*m.span(), 1))
    for m in CARD.finditer(text):
        if m.end() - m.start() >= 14:
            digits = m[0].replace(" ", "").replace("-", "")
            if 14 <= len(digits) <= 19 and luhn(digits):
                out.append((*m.span(), 2))
    if "+" in text:
        for m in PHONE.finditer(text):
            if 10 <= sum(c.isdigit() for c in m[0]) <= 15:
                out.append((*m.span(), 3))
    return sorted(out, key=lambda s: (s[0], s[2]))


def _value(text: str, span: tuple[int, int, int]) -> int:
    """Hash of the entity: its kind and its value without case, or its digits."""
    raw = text[span[0] : span[1]]
    value = raw.lower() if span[2] == 0 else raw if span[2] == 1 else re.sub("[^0-9]", "", raw)
    return xxhash.xxh3_64_intdigest(f"{KINDS[span[2]]}:{value}".encode())


def _class(text: str, span: tuple[int, int, int]) -> int:
    """Hash of the entity's class."""
    raw = text[span[0] : span[1]].lower()
    digits = re.sub("[^0-9]", "", raw)
    part = raw.rpartition("@")[2] if span[2] == 0 else ".".join(p.lstrip("0") for p in raw.split(".")[:2]) if span[2] == 1 else digits[: 6 if span[2] == 2 else 4]
    return xxhash.xxh3_64_intdigest(f"class of {KINDS[span[2]]}:{part}".encode())


def _texts(docs: DataFrame, *more: Column) -> DataFrame:
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text"), *more)


def _char_places(text: str, places: np.ndarray) -> np.ndarray:
    """Code points before each of the byte places."""
    if text.isascii():
        return places
    return np.r_[0, np.cumsum((np.frombuffer(text.encode(), np.uint8) & 0xC0) != 0x80)][places]


def mentions(docs: DataFrame) -> DataFrame:
    """row (of the text), context, entities, classes and terms (each once) of the documents with an entity. Equal contexts have equal
    terms."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            column = batch.column("text")
            words, at, starts, ends = batch_words(column, letters=True, places=True)
            base = np.frombuffer(column.buffers()[1], np.int32)[column.offset : column.offset + len(column) + 1].astype(np.int64)
            rows = []
            for k, text in enumerate(column.to_pylist()):
                spans = base_spans(text)
                if not spans:
                    continue
                own = words[at[k] : at[k + 1]]
                first = _char_places(text, starts[at[k] : at[k + 1]] - (base[k] - base[0]))
                last = _char_places(text, ends[at[k] : at[k + 1]] - (base[k] - base[0]))
                taken = np.zeros(len(own), bool)
                for a, b, _ in spans:
                    taken[np.searchsorted(last, a, "right") : np.searchsorted(first, b, "left")] = True
                free = own[~taken]
                entities, classes = (np.unique(np.array([f(text, s) for s in spans], np.uint64)) for f in (_value, _class))
                ids = np.array([xxhash.xxh3_64_intdigest(text.encode()), mix(free + np.uint64(1)).sum(dtype=np.uint64)], np.uint64).view(np.int64)
                rows.append((int(ids[0]), int(ids[1]), entities.view(np.int64), classes.view(np.int64), np.unique(free).view(np.int64)))
            kinds = (pa.int64(), pa.int64(), *[pa.list_(pa.int64())] * 3)
            yield pa.RecordBatch.from_arrays([pa.array(x, t) for x, t in zip(zip(*rows, strict=True), kinds, strict=True)] if rows else [pa.array([], t) for t in kinds], ["row", "context", "entities", "classes", "terms"])

    return _texts(docs).mapInArrow(run, "row long, context long, entities array<long>, classes array<long>, terms array<long>")


def term_counts(docs: DataFrame, terms: DataFrame) -> DataFrame:
    """term, n_term: in how many different texts each of the terms stands. Each of the c rows of a text counts 1 / c, so that
    counts add up in each task before the shuffle: in one vector over the terms where these are few."""
    keep = _kept(terms.select("term"))
    digest = F.xxhash64(F.coalesce("text", F.lit("")))
    copies = written(docs.groupBy(digest.alias("digest")).count().where("count > 1"), "copies")
    rows = docs.select("text", digest.alias("digest")).join(small(copies), "digest", "left").select(F.coalesce("text", F.lit("")).alias("text"), (1 / F.coalesce("count", F.lit(1))).alias("share"))

    def distinct_words(batch: pa.RecordBatch) -> tuple[np.ndarray, np.ndarray]:
        """The distinct words of each text, and the text's share beside each."""
        words, at = batch_words(batch.column("text"), letters=True)
        own = [np.unique(words[a:b]).view(np.int64) for a, b in zip(at, at[1:], strict=False)]
        return np.concatenate([np.zeros(0, np.int64), *own]), np.repeat(batch.column("share").to_numpy(), [len(x) for x in own])

    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            words, shares = distinct_words(batch)
            own, at = np.unique(words, return_inverse=True)
            yield pa.RecordBatch.from_arrays([pa.array(own), pa.array(np.bincount(at, shares, len(own)))], ["term", "share"])

    def vectors(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = keep.value[0]
        total = np.zeros(len(known), np.float64)
        for batch in slices(batches):
            words, shares = distinct_words(batch)
            at = np.minimum(np.searchsorted(known, words), max(0, len(known) - 1))
            hit = known[at] == words if len(known) else np.zeros(len(words), bool)
            total += np.bincount(at[hit], shares[hit], len(known))
        yield pa.RecordBatch.from_arrays([pa.array([0], pa.int32()), pa.array([total.tobytes()], pa.binary())], ["slice", "counts"])

    def unpacked(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for raw in batch.column("counts").to_pylist():
                yield pa.RecordBatch.from_arrays([pa.array(keep.value[0]), pa.array(np.frombuffer(raw, np.float64))], ["term", "share"])

    if keep is None:
        found = rows.mapInArrow(each, "term long, share double").groupBy("term").agg(F.sum("share").alias("share"))
    else:
        found = summed(rows.mapInArrow(vectors, "slice int, counts binary")).mapInArrow(unpacked, "term long, share double")
    return found.select("term", F.round("share").cast("long").alias("n_term")).where("n_term > 0")


def _kept(terms: DataFrame):
    """The terms in a sorted array for the tasks, if they are within the bound; else None, and a join decides alone."""
    found = terms.limit(BROADCAST_ROWS + 1).toPandas()
    if len(found) > BROADCAST_ROWS:
        return None
    found = found.sort_values("term")
    return terms.sparkSession.sparkContext.broadcast((found["term"].to_numpy(), found["action"].to_numpy() if "action" in found else None))


def occurrences(docs: DataFrame, terms: DataFrame) -> DataFrame:
    """doc_id, digest (of the text), term, spans (start:end of each, comma-joined) of every document and each of the terms in it."""
    keep = _kept(terms.select("term"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            column = batch.column("text")
            words, at, starts, ends = batch_words(column, letters=True, places=True)
            base = np.frombuffer(column.buffers()[1], np.int32)[column.offset : column.offset + len(column) + 1].astype(np.int64)
            wanted = np.arange(len(words)) if keep is None else np.flatnonzero(np.isin(words.view(np.int64), keep.value[0]))
            cut = np.searchsorted(wanted, at)
            rows = []
            for k in np.flatnonzero(np.diff(cut)).tolist():
                text, here = column[k].as_py(), wanted[cut[k] : cut[k + 1]]
                first = _char_places(text, starts[here] - (base[k] - base[0])).tolist()
                last = _char_places(text, ends[here] - (base[k] - base[0])).tolist()
                places: dict[int, list[str]] = {}
                for t, a, b in zip(words[here].view(np.int64).tolist(), first, last, strict=True):
                    places.setdefault(t, []).append(f"{a}:{b}")
                rows += [(batch.column("doc_id")[k].as_py(), batch.column("digest")[k].as_py(), t, ",".join(x)) for t, x in places.items()]
            kinds = (pa.int64(), pa.int64(), pa.int64(), pa.string())
            yield pa.RecordBatch.from_arrays([pa.array(x, k) for x, k in zip(zip(*rows, strict=True), kinds, strict=True)] if rows else [pa.array([], k) for k in kinds], ["doc_id", "digest", "term", "spans"])

    return _texts(docs, F.xxhash64(F.coalesce("text", F.lit(""))).alias("digest")).mapInArrow(run, "doc_id long, digest long, term long, spans string")


def disclosing_terms(docs: DataFrame, classes: bool = False) -> DataFrame:
    """term (hash), disclosure (the largest over entities, and over their classes), action (1 generalise, 2 remove) of the terms over
    the threshold."""
    seen = written(mentions(docs), "mentions")
    whose = lambda names, of_class: F.transform(names, lambda e: F.struct(e.alias("entity"), F.lit(of_class).alias("of_class")))
    named = whose("entities", False)
    each = seen.select("row", "context", F.explode(F.concat(named, whose("classes", True)) if classes else named).alias("e")).select("row", "context", "e.*")
    of_context = written(each.groupBy("context", "entity", "of_class").agg(F.count_distinct("row").alias("n")), "contexts")
    enough = F.col("contexts") >= F.when(F.col("of_class"), CLASS_SUPPORT).otherwise(SUPPORT)
    of_entity = written(of_context.groupBy("entity", "of_class").agg(F.count(F.lit(1)).alias("contexts"), F.sum("n").alias("n_entity")).where(enough), "entities")
    # An entity of fewer contexts has no pair of enough.
    kept = written(of_context.join(small(of_entity.select("entity")), "entity", "left_semi"), "kept")
    words = seen.join(small(kept.select("context").distinct()), "context", "left_semi").groupBy("context").agg(F.first("terms").alias("terms"))
    pairs = kept.join(words, "context").select("entity", "of_class", "n", F.explode("terms").alias("term"))
    strong = written(pairs.groupBy("entity", "of_class", "term").agg(F.count(F.lit(1)).alias("contexts"), F.sum("n").alias("n_both")).where(enough), "pairs")
    terms = written(strong.select("term").distinct(), "terms")
    of_term = term_counts(docs, terms).join(small(terms), "term", "left_semi")
    total = float(docs.select(F.xxhash64(F.coalesce("text", F.lit(""))).alias("digest")).distinct().count())
    share = 1 + F.log(F.col("n_both") / F.col("n_term")) / F.log(F.lit(total) / F.col("n_entity"))
    with_it, among_all = F.least(F.lit(1.0), F.col("n_both") / F.col("n_term")), F.col("n_entity") / F.lit(total)
    without = F.when(with_it < 1, (1 - with_it) * F.log((1 - with_it) / (1 - among_all))).otherwise(0.0)
    certain = ~F.col("of_class") | (F.col("n_term") * (with_it * F.log(with_it / among_all) + without) >= EVIDENCE)
    scored = strong.join(of_entity.select("entity", "n_entity"), "entity").join(of_term, "term").where((F.col("n_entity") < total) & certain).select("term", share.alias("disclosure"))
    best = scored.groupBy("term").agg(F.max("disclosure").alias("disclosure")).where(F.col("disclosure") >= GENERALISE)
    return written(best.withColumn("action", F.when(F.col("disclosure") >= REMOVE, 2).otherwise(1)), "disclosing")


def with_term_spans(docs: DataFrame, flagged: DataFrame) -> tuple[DataFrame, str, object]:
    """The documents' columns and one of term spans, its name, and a broadcast of the flagged terms that serves instead where
    they are few (the column is null then)."""
    keep = _kept(flagged.select("term", "action"))
    name = free_name(docs, "term_spans")
    if keep is not None:
        return docs.withColumn(name, F.lit(None).cast("string")), name, keep
    found = occurrences(docs, flagged.select("term")).join(flagged, "term")
    each = F.array_join(F.transform(F.split("spans", ","), lambda x: F.concat(x, F.lit(":"), F.col("action").cast("string"))), ",")
    # Rows of one doc_id with different texts are told apart by the text's digest; rows without doc_id have it alone.
    spans = found.select(F.col("doc_id").alias("d"), F.col("digest").alias("x"), "term", each.alias("s")).distinct().groupBy("d", "x").agg(F.array_join(F.array_sort(F.collect_list("s")), ",").alias(name))
    digest = F.xxhash64(F.coalesce(docs["text"], F.lit("")))
    joined = docs.join(spans, docs["doc_id"].cast("long").eqNullSafe(spans["d"]) & (digest == spans["x"]), "left")
    return joined.select(*(docs[c] for c in docs.columns), spans[name]), name, None


def _all_spans(batch: pa.RecordBatch, name: str, keep) -> Iterator[tuple[str, list[tuple[int, int, int]], list[tuple[int, int, int]]]]:
    """Each text with its base spans and its spans of flagged terms (start, end, action)."""
    column = batch.column("text")
    base, here = None, None
    if keep is not None and len(keep.value[0]):
        words, at, starts, ends = batch_words(column, letters=True, places=True)
        base = np.frombuffer(column.buffers()[1], np.int32)[column.offset : column.offset + len(column) + 1].astype(np.int64)
        here = np.flatnonzero(np.isin(words.view(np.int64), keep.value[0]))
        cut = np.searchsorted(here, at)
    for k, text in enumerate(column.to_pylist()):
        own = base_spans(text)
        if here is not None and cut[k + 1] > cut[k]:
            w = here[cut[k] : cut[k + 1]]
            actions = keep.value[1][np.searchsorted(keep.value[0], words[w].view(np.int64))].tolist()
            first, last = (_char_places(text, x[w] - (base[k] - base[0])).tolist() for x in (starts, ends))
            terms = list(zip(first, last, actions, strict=True))
        else:
            terms = [tuple(map(int, s.split(":"))) for s in (batch.column(name)[k].as_py() or "").split(",") if s]
        yield text, own, sorted(t for t in terms if not any(a < t[1] and t[0] < b for a, b, _ in own))


def find(docs: DataFrame, flagged: DataFrame | None = None) -> DataFrame:
    """doc_id, n_email, n_ip, n_card, n_phone, n_term, n_spans (all of these), base_sha256, spans of each document."""
    flagged = disclosing_terms(docs, classes=True) if flagged is None else flagged
    rows, name, keep = with_term_spans(docs.select("doc_id", "text"), flagged)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            out = []
            for _, own, terms in _all_spans(batch, name, keep):
                said = ",".join(f"{KINDS[k]}:{a}:{b}" for a, b, k in own)
                every = sorted([(a, k, f"{KINDS[k]}:{a}:{b}") for a, b, k in own] + [(a, len(KINDS), f"term:{a}:{b}") for a, b, _ in terms])
                kinds = [k for *_, k in own]
                out.append((*(kinds.count(k) for k in range(4)), len(terms), len(every), hashlib.sha256(said.encode()).hexdigest(), ",".join(x for *_, x in every)))
            types = [pa.int64()] * 6 + [pa.string()] * 2
            names = ["doc_id", *(f"n_{k}" for k in KINDS), "n_term", "n_spans", "base_sha256", "spans"]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), *([pa.array(x, t) for x, t in zip(zip(*out, strict=True), types, strict=True)] if out else [pa.array([], t) for t in types])], names)

    return _texts(rows, F.col(name)).mapInArrow(run, "doc_id long, n_email long, n_ip long, n_card long, n_phone long, n_term long, n_spans long, base_sha256 string, spans string")


def sanitise(docs: DataFrame) -> DataFrame:
    """The documents with entities replaced by their kind and disclosing terms generalised or removed; n_chars, where the
    table has it, follows the text. Null texts stay null."""
    rows, name, keep = with_term_spans(docs, disclosing_terms(docs.select("doc_id", "text"), classes=True))
    schema = docs.schema
    names = docs.columns

    def kind(word: str) -> str:
        return "[NUMBER]" if word.isdigit() else "[NAME]" if word[:1].isupper() else "[WORD]"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            nulls = batch.column("text").is_null().to_pylist()
            full = batch.set_column(batch.schema.get_field_index("text"), "text", batch.column("text").fill_null(""))
            texts = []
            for text, own, terms in _all_spans(full, name, keep):
                parts, done = [], 0
                changes = sorted([(a, b, f"[{KINDS[k].upper()}]") for a, b, k in own] + [(a, b, "" if act == 2 else kind(text[a:b])) for a, b, act in terms])
                for a, b, new in changes:
                    if b <= done:
                        continue
                    parts += [text[done : max(a, done)], new if a >= done else ""]
                    done = b
                texts.append("".join([*parts, text[done:]]))
            new = pa.array([None if n else t for n, t in zip(nulls, texts, strict=True)], pa.string())
            columns = {n: batch.column(n) for n in names} | {"text": new}
            if "n_chars" in columns:
                columns["n_chars"] = pa.array([None if n else len(t) for n, t in zip(nulls, texts, strict=True)], pa.int64()).cast(columns["n_chars"].type)
            yield pa.RecordBatch.from_arrays(list(columns.values()), names)

    return rows.mapInArrow(run, schema)


def op1_pii(spark, sf_dir: str) -> DataFrame:
    return find(table(spark, sf_dir, "documents"))
