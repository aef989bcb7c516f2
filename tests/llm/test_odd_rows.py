"""Rows without ids, clashing columns, very long texts and empty tables; and plain versions of what SQL cannot say."""

from __future__ import annotations

import math
import random
import re
import struct

import numpy as np
import pyarrow as pa
import pytest
import xxhash
from pyspark.sql import functions as F

from marketlens.llm import bpe, common, decontaminate, id_planes, ngram_join, pii, quality, syncmers, warc
from marketlens.llm.common import batch_words, new_path, word_hashes

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, score double, predicted int, digest long, term_spans string, words long, size long"


def table(spark, rows):
    return spark.createDataFrame([(k, t, "en", "s", len(t or ""), 0.5, 7, 8, "1:2:1", 9, 10) for k, t in rows], SCHEMA)


def prose(r, n):
    return " ".join(r.choice(["river", "Stone", "of", "the", "quiet", "light", "and", "bread", "seven", "hills"]) + str(r.randrange(50)) for _ in range(n))


def test_files_of_rows_without_ids(spark):
    rows = [(5, "five"), (None, "b"), (None, "a a"), (1, None)]
    got = [(r.doc_id, r.start, r.n_tokens) for r in id_planes.encode_and_read(table(spark, rows), n_files=2).orderBy("start").collect()]
    assert [k for k, *_ in got] == [None, None, 1, 5] and got[0][1] == 0 and all(a[1] + a[2] == b[1] for a, b in zip(got, got[1:], strict=False))
    pages = spark.createDataFrame([(None, "u", "same"), (3, "u", "same"), (4, "u", "same"), (None, "u", "alone"), (None, None, "alone")], "page_id long, url string, html string")
    found = sorted(((r.page_id, r.record_type, r.refers_to) for r in warc.write_and_read(pages).collect()), key=str)
    assert found == sorted([(None, "revisit", 4), (3, "revisit", 4), (4, "response", None), (None, "response", None), (None, "response", None)], key=str)


def test_benchmark_texts_without_ids_are_removed(spark):
    r = random.Random(1)
    items = [(k, prose(r, n)) for k, n in enumerate((3, 8, 40, 300, 1500))]
    rows = [(None, f"a {t} b") for _, t in items] + [(None, prose(r, 100)), (7, prose(r, 50)), (7, f"x {items[1][1]} y"), (8, None)]
    kept = decontaminate.without_items(table(spark, rows), spark.createDataFrame(items, "item_id long, text string"))
    assert sorted((x.doc_id or -1, x.text or "") for x in kept.collect()) == sorted((k or -1, t or "") for k, t in [rows[5], rows[6], rows[8]]) and kept.columns == SCHEMA.replace(",", "").split()[::2]


@pytest.mark.parametrize("n", [30, 45, 64, 200, 700])
def test_no_containment_is_missed_at_any_size(spark, n):
    r = random.Random(n)
    words = [f"w{k}" for k in range(n + 4)]
    texts = []
    for k in range(60):
        own = list(words)
        for _ in range(r.randint(0, max(2, n // 22))):
            own[r.randrange(len(own))] = f"v{r.randrange(10**6)}"
        texts.append((k, " ".join(own)))
    want = {}
    item = {tuple(words[i : i + 5]) for i in range(n)}
    for k, t in texts:
        w = t.split()
        share = len(item & {tuple(w[i : i + 5]) for i in range(len(w) - 4)}) / n
        if share >= 0.8:
            want[k] = share
    found = decontaminate.contained(spark.createDataFrame(texts, "doc_id long, text string"), spark.createDataFrame([(1, " ".join(words))], "item_id long, text string"))
    assert {x.doc_id: x.containment for x in found.collect()} == pytest.approx(want) and 0 < len(want) <= 60


def test_columns_of_the_classifier_may_clash(spark):
    rows = [(0, "good text of some words."), (1, "@@@@ ####"), (None, None), (0, "again")]
    docs, labels = table(spark, rows), spark.createDataFrame([(0, 1), (1, 0), (0, 1), (None, 1)], "doc_id long, quality int")
    model = quality.train(docs, labels)
    assert [c for c in quality.score(docs, model).columns if c in ("score", "predicted")] == ["score", "predicted"] and quality.score(docs, model).where("predicted = 7").count() == 0
    kept = quality.accepted(docs, model, 0.0)
    assert kept.columns == docs.columns and {x.predicted for x in kept.collect()} == {7} and kept.count() == 4
    # A score is a plain sum of table entries.
    x = np.random.default_rng(0).random((50, len(quality.FEATURES)))
    m = quality.fit(x, (x[:, 0] + x[:, 1] * x[:, 2] > 0.8).astype(float))
    for row, got in zip(x, m.scores(x), strict=True):
        total = m.base
        for key, t in m.tables.items():
            at = [sum(e <= row[j] for e in (m.edges if len(key) == 1 else m.coarse)[j]) for j in key]
            total += t[tuple(at)]
        assert got == pytest.approx(1 / (1 + math.exp(-total)))


def test_columns_of_the_sanitiser_may_clash(spark, monkeypatch):
    r = random.Random(3)
    rows = [(None if k % 2 else k, f"Zorro {prose(r, 30)} zed@example.com") for k in range(6)] + [(k, prose(r, 30)) for k in range(10, 60)]
    docs = table(spark, rows)
    clean = sorted(tuple(x) for x in pii.sanitise(docs).select("text", "term_spans", "digest", "n_chars").collect())
    assert not any("Zorro" in t or "@" in t for t, *_ in clean) and {x[1:3] for x in clean} == {("1:2:1", 8)} and all(len(t) == n for t, _, _, n in clean)
    monkeypatch.setattr(pii, "BROADCAST_ROWS", 0)
    joined = pii.sanitise(docs)
    assert joined.columns == docs.columns and sorted(tuple(x) for x in joined.select("text", "term_spans", "digest", "n_chars").collect()) == clean


def test_disclosure_equals_plain_counts(spark):
    r = random.Random(5)
    names, mails = ["Ada", "Bo", "Cy", "Di"], ["a@x.org", "b@x.org"]
    texts = []
    for _ in range(150):
        words = prose(r, 8).split()
        if r.random() < 0.4:
            k = r.randrange(2)
            words += [mails[k]] + ([names[k]] if r.random() < 0.9 else [r.choice(names)])
        texts.append(" ".join(words))
    texts += texts[:9]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    terms = [set(re.findall("[a-z0-9]+", re.sub(r"\S+@\S+", " ", t).lower())) for t in dict.fromkeys(texts)]
    has = [set(re.findall(r"\S+@\S+", t)) for t in dict.fromkeys(texts)]
    want = {}
    for e in mails:
        n_e = sum(e in h for h in has)
        for t in set().union(*terms):
            own = {frozenset(x) for x, h in zip(terms, has, strict=True) if t in x and e in h}
            both, n_t = sum(t in x and e in h for x, h in zip(terms, has, strict=True)), sum(t in x for x in terms)
            if len(own) >= pii.SUPPORT:
                share = 1 + math.log(both / n_t) / math.log(len(has) / n_e)
                if share >= pii.GENERALISE:
                    h = int(batch_words(pa.array([t]), letters=True)[0].view(np.int64)[0])
                    want[h] = max(share, want.get(h, 0))
    got = {x.term: x.disclosure for x in pii.disclosing_terms(docs).collect()}
    assert got == pytest.approx(want) and want


def test_disclosure_of_classes_equals_plain_counts(spark):
    """Names of one company stand with its addresses, no two of which are equal; other words stand with them by chance."""
    r, texts = random.Random(9), []
    company = lambda k: r.choices([f"ann{k}@corp.example", f"10.20.{k % 250}.{k % 99}", f"+1 (555) 01{k % 90 + 10}-{1000 + k}"], [8, 1, 1])[0]
    for k in range(900):
        words = prose(r, 8).split()
        if k % 6 == 0:
            words += [company(k)] + (["Zorbium"] if r.random() < 0.9 else ["Plain"]) + (["Half"] if k % 12 else [])
        elif k % 7 == 0:
            words += ["Half"]
        texts.append(" ".join(words))
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")

    def of_text(t):
        spans = pii.base_spans(t)
        free = "".join(" " if any(a <= i < b for a, b, _ in spans) else c for i, c in enumerate(t))
        raw = [(t[a:b], k) for a, b, k in spans]
        part = {0: lambda x: x.split("@")[1], 1: lambda x: ".".join(x.split(".")[:2]), 2: lambda x: re.sub("[^0-9]", "", x)[:6], 3: lambda x: re.sub("[^0-9]", "", x)[:4]}
        return re.findall("[a-z0-9]+", free.lower()), {(k, part[k](x)) for x, k in raw}

    rows = [(set(w), h) for w, h in map(of_text, dict.fromkeys(texts))]
    want, N = {}, len(rows)
    for c in set().union(*(h for _, h in rows)):
        p = sum(c in h for _, h in rows) / N
        for t in set().union(*(w for w, _ in rows)):
            contexts = {frozenset(w) for w, h in rows if t in w and c in h}
            n = sum(t in w for w, _ in rows)
            share = sum(t in w and c in h for w, h in rows) / n
            if len(contexts) < pii.CLASS_SUPPORT or p == 1:
                continue
            divergence = share * math.log(share / p) + ((1 - share) * math.log((1 - share) / (1 - p)) if share < 1 else 0)
            given = 1 + math.log(share) / math.log(1 / p)
            if n * divergence >= pii.EVIDENCE and given >= pii.GENERALISE:
                h = int(batch_words(pa.array([t]), letters=True)[0].view(np.int64)[0])
                want[h] = max(given, want.get(h, 0))
    got = {x.term: x.disclosure for x in pii.disclosing_terms(docs, classes=True).collect()}
    hash_of = lambda word: int(batch_words(pa.array([word]), letters=True)[0].view(np.int64)[0])
    assert got == pytest.approx(want) and hash_of("zorbium") in got and hash_of("half") not in got
    flagged = {w for words, _ in rows for w in words if hash_of(w) in got}
    found = {x.doc_id: x for x in pii.find(docs).collect()}
    assert all(found[k].n_term == sum(w in flagged for w in of_text(t)[0]) == found[k].spans.count("term:") for k, t in enumerate(texts))
    clean = {x.doc_id: x.text for x in pii.sanitise(docs).collect()}
    assert not any("Zorbium" in t for t in clean.values()) and sum("Half" in t for t in clean.values()) == sum("Half" in t for t in texts)


def hashed(*values):
    """Spark's xxhash64 of long values one after the other."""
    h = 42
    for v in values:
        h = xxhash.xxh64_intdigest(struct.pack("<q", v), seed=h)
    return h - (1 << 64) * (h >= 1 << 63)


def plain_anchors(text):
    w = [x - (1 << 64) * (x >= 1 << 63) for x in (xxhash.xxh64_intdigest(t.encode(), seed=42) for t in re.split(r"[\x20\x09-\x0D]+", text) if t)]
    if len(w) < syncmers.K:
        return [hashed(*w)] if w else []
    out, every = [], []
    for i in range(len(w) - syncmers.K + 1):
        inner = [hashed(*w[k : k + syncmers.S]) for k in range(i, i + syncmers.K - syncmers.S + 1)]
        every.append(hashed(*w[i : i + syncmers.K]))
        if min(inner) in (inner[0], inner[-1]):
            out.append(every[-1])
    return out or [min(every)]


def test_syncmers_equal_plain_ones(spark):
    r = random.Random(7)
    texts = ["", "a", "a b c d"] + [prose(r, r.randint(1, 60)) for _ in range(60)] + ["x " * 30]
    got = {x.doc_id: x for x in syncmers.fingerprints(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")).collect()}
    said = lambda a: "".join(f"{x & (1 << 64) - 1:016x}" for x in a)
    like = lambda a, b: len(set(a) & set(b)) / len(set(a) | set(b)) if a or b else 1.0
    for k, t in enumerate(texts):
        below = texts[k - 1]  # in descending order the next; after the first the last
        half = len(t) // 2
        own, edited, other = (plain_anchors(x) for x in (t, t[: len(t) - half] + below[:half], below))
        assert (got[k].fingerprint, got[k].edited_fingerprint) == (said(own), said(edited))
        assert (got[k].near_edited, got[k].near_next) == pytest.approx((like(own, edited), like(own, other)))
    bounds = sorted(r.sample(range(1000), 37))
    keys = spark.range(-5, 1005).select("id", syncmers.bucket_of(F.col("id"), bounds).alias("b")).collect()
    assert all(x.b == sum(b < x.id for b in bounds) for x in keys)


def test_decoded_texts(spark):
    docs = spark.createDataFrame([(1, "日本 é"), (2, None), (None, "")], "doc_id long, text string")
    ids = bpe.encode(docs, offsets=True)
    assert {(x.doc_id, x.text) for x in bpe.decode(ids).collect()} == {(1, "日本 é"), (2, ""), (None, "")}
    cut = ids.where("doc_id = 1").select("doc_id", F.slice("ids", 1, 1).alias("ids")).union(spark.createDataFrame([(9, [-1, 999999]), (8, None)], "doc_id long, ids array<int>"))
    got = {x.doc_id: (bytes(x.decoded), x.text) for x in bpe.decode(cut).collect()}
    assert got[9] == (b"", "") and got[8] == (b"", "") and "日本 é".encode().startswith(got[1][0]) and got[1][1] == got[1][0].decode(errors="replace")
    split = {x.doc_id: x.n_split for x in bpe.digests(docs).collect()}
    row = ids.where("doc_id = 1").first()
    assert split[1] == sum(b > c for b, c in zip(row.ends, [*row.starts[1:], 99], strict=True)) and split[2] == 0


def test_batches_are_cut_by_rows_and_bytes():
    batch = pa.RecordBatch.from_arrays([pa.array(["x" * (5 << 20) if k == 1500 else "yy" for k in range(4000)])], ["text"])
    parts = list(common.slices(iter([batch])))
    assert pa.Table.from_batches(parts).column(0).combine_chunks().equals(batch.column(0)) and all(p.num_rows == 1 or (p.num_rows <= common.BATCH_ROWS and p.nbytes <= common.BATCH_BYTES) for p in parts)

    class Twice(common.Bounded):
        def make(self, key):
            return key * 2

    d = Twice(20_000)
    assert all(d[str(k % 300)] == str(k % 300) * 2 for k in range(3000)) and len(d) + len(d.old) < 150


def test_pipeline_of_odd_rows(spark, tmp_path):
    import corpus_pipeline
    from tests.conftest import SF

    r = random.Random(9)
    good = [x.text for x in spark.read.parquet(f"{SF}/documents.parquet").join(spark.read.parquet(f"{SF}/labels.parquet").where("quality = 1"), "doc_id").limit(20).collect()]
    long = " ".join(good * 1 + [prose(r, 200_000)])  # more than a megabyte
    rows = [(k, t) for k, t in enumerate(good)] + [(None, good[0]), (None, "a new " + good[1]), (3, good[3]), (50, None), (51, ""), (None, None), (52, long)]
    for name in ("labels", "benchmark"):
        spark.read.parquet(f"{SF}/{name}.parquet").write.parquet(str(tmp_path / f"{name}.parquet"))
    for some in (rows, []):
        docs = table(spark, some)
        for name, stage in corpus_pipeline.STAGES:
            path = new_path(spark, name)
            stage(spark, docs, str(tmp_path)).write.parquet(path)
            after = spark.read.parquet(path)
            assert after.count() <= docs.count() and (name == corpus_pipeline.STAGES[-1][0] or after.columns == docs.columns)
            if name == "near_duplicates" and some:
                left = [x.doc_id for x in after.where(F.col("text") == good[0]).collect()]
                assert left in ([0], [])
            docs = after
    documents = table(spark, rows)
    documents.write.parquet(str(tmp_path / "documents.parquet"))
    assert corpus_pipeline.run(spark, str(tmp_path)).columns[0] == "doc_id"
    assert len(word_hashes(long)) > 200_000


def test_rows_without_ids_link_with_nothing(spark):
    r = random.Random(4)
    text = prose(r, 40)
    rows = [(None, text), (1, text), (None, text), (2, text), (3, text + " more"), (None, None), (4, "")]
    got = sorted(((x.doc_id, x.n_shingles, x.n_links, x.component_id) for x in ngram_join.join(table(spark, rows)).collect()), key=str)
    assert got == sorted([(None, 36, 0, None), (1, 36, 2, 1), (None, 36, 0, None), (2, 36, 2, 1), (3, 37, 2, 1), (None, 0, 0, None), (4, 0, 0, 4)], key=str)
    assert all(x.a is not None and x.b is not None for x in ngram_join.links(table(spark, rows)).collect())


def test_id_files_end_by_documents_too(spark, monkeypatch):
    monkeypatch.setattr(id_planes, "FILE_DOCS", 2)
    monkeypatch.setattr(id_planes, "READ_DOCS", 3)
    rows = [(k, "of the quiet" if k % 3 else "") for k in range(11)]
    folder = new_path(spark, "t")
    files = id_planes.write_ids(table(spark, rows).coalesce(1), folder, n_files=1)
    assert sorted(x.n_docs for x in files.collect()) == [1, 2, 2, 2, 2, 2]
    got = id_planes.read_ids(files, folder).orderBy("doc_id").collect()
    assert [x.doc_id for x in got] == list(range(11)) and all(a.start + a.n_tokens == b.start for a, b in zip(got, got[1:], strict=False))
