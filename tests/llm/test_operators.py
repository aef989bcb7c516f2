"""Each operator against brute force or a round trip, on odd rows: nulls, empty and long texts, ties, repeated rows, empty
tables and further columns with clashing names."""

from __future__ import annotations

import base64
import collections
import hashlib
import math
import random
import re
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from marketlens.llm import bpe, decontaminate, id_planes, lm, ngram_join, pii, quality, syncmers, token_counts, warc
from marketlens.llm.common import components, new_path, shingle_hashes, word_hashes

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, score double, ids string, n_tokens long, row long, shingle long"
WORDS = "Alpha beta Gamma delta don't 12 3.5 élan straße naïve x y z the of and 東京 😀 it's a_b --- Ünder".split()


def prose(r: random.Random, n: int) -> str:
    return "".join(r.choice(WORDS) + r.choice([" ", " ", " ", "\n", "  ", "\t"]) for _ in range(n))


def odd_texts() -> list[str | None]:
    r = random.Random(11)
    base = [prose(r, 200) for _ in range(4)]
    near = [" ".join(b.split(" ")[:-1] + ["changed"]) for b in base]
    return [None, "", " ", "\n\t", "a", "b", "one two", *base, *near, base[0], base[0], prose(r, 3000), "x" * 5000, "é" * 300 + " ab " * 40, "0\x0b1\x0c2\x85 3", "<|endoftext|> a <|endoftext|>", "write ann@example.com or +1 (234) 555-0100 from 10.1.2.3 now, card 4111 1111 1111 1111."]


@pytest.fixture(scope="module")
def rows():
    return list(enumerate(odd_texts()))


@pytest.fixture(scope="module")
def docs(spark, rows):
    return spark.createDataFrame([(k, t, "en", "s", len(t or ""), 1.0, "i", 1, 2, 3) for k, t in rows], SCHEMA).repartition(3)


@pytest.fixture(scope="module")
def none(spark):
    return spark.createDataFrame([], SCHEMA)


def groups(texts: dict[int, str | None], n: int, share: int, of: int) -> dict[int, int]:
    sets = {k: set(shingle_hashes(word_hashes(t), n).tolist()) for k, t in texts.items()}
    top = {k: k for k in texts}

    def root(k):
        while top[k] != k:
            k = top[k]
        return k

    for a in texts:
        for b in texts:
            both = len(sets[a] & sets[b])
            if a < b and both and of * both >= share * len(sets[a] | sets[b]):
                x, y = root(a), root(b)
                top[max(x, y)] = min(x, y)
    return {k: root(k) for k in texts}


def test_words_are_hashed_as_the_pattern_cuts_them():
    assert word_hashes("Ab  cD\x0bé")[0] == word_hashes("aB")[0]
    for t in odd_texts():
        assert len(word_hashes(t)) == len(re.findall(r"[^\x20\x09-\x0D]+", t or ""))
    assert len({int(h) for w in WORDS for h in word_hashes(w)}) == len({w.lower() if w.isascii() else w for w in WORDS})


def test_components(spark):
    r = random.Random(2)
    edges = [(r.randint(0, 300), r.randint(0, 300)) for _ in range(200)] + [(k, k + 1) for k in range(400, 460)]
    top = {}

    def root(k):
        while top.setdefault(k, k) != k:
            k = top[k]
        return k

    for a, b in edges:
        x, y = root(a), root(b)
        top[max(x, y)] = min(x, y)
    got = {x.doc: x.component for x in components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert all(got.get(k, k) == root(k) for k in top)


@pytest.mark.parametrize(("n", "share"), [(3, 90), (5, 80)])
def test_join(spark, docs, rows, none, n, share):
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in ngram_join.join(docs, n, share, 100).collect()}
    want = groups(dict(rows), n, share, 100)
    assert got == {k: (len(set(shingle_hashes(word_hashes(t), n).tolist())), want[k]) for k, t in rows}
    assert ngram_join.join(none, n, share, 100).count() == 0


@pytest.mark.parametrize("block", [8, 512])
def test_join_of_a_large_group_with_borderline_pairs(spark, monkeypatch, block):
    r = random.Random(4)
    base = [f"w{k}" for k in range(120)]
    texts = {}
    for k in range(90):
        words = list(base)
        for _ in range(r.randint(0, 6)):
            words[r.randrange(120)] = f"v{r.randrange(10**6)}"
        texts[k] = " ".join(words[r.randint(0, 4) :])
    for k in range(90, 140):  # a shared passage is no link
        texts[k] = " ".join([f"u{k}x{j}" for j in range(100)] + base[:60])
    monkeypatch.setattr(ngram_join, "BLOCK", block)
    got = {x.doc_id: x.component_id for x in ngram_join.join(spark.createDataFrame(list(texts.items()), "doc_id long, text string"), 3, 90, 100).collect()}
    assert got == groups(texts, 3, 90, 100)


@pytest.mark.parametrize("block", [8, 512])
def test_join_gives_every_link(spark, monkeypatch, block):
    r = random.Random(9)
    base = [f"w{k}" for k in range(120)]
    texts = {}
    for k in range(60):
        words = list(base)
        for _ in range(r.randint(0, 5)):
            words[r.randrange(120)] = f"v{r.randrange(10**6)}"
        texts[k] = " ".join(words)
    texts |= {k: texts[k - 60] for k in range(60, 75)} | {75: "", 76: None, 77: "a b c d", 78: "a b c d"}
    sets = {k: set(shingle_hashes(word_hashes(t), 3).tolist()) for k, t in texts.items()}
    both = {(a, b): len(sets[a] & sets[b]) for a in texts for b in texts if a < b}
    linked = {p: c for p, c in both.items() if c and 100 * c >= 90 * len(sets[p[0]] | sets[p[1]])}
    d = spark.createDataFrame(list(texts.items()), "doc_id long, text string")
    monkeypatch.setattr(ngram_join, "BLOCK", block)
    got = {x.doc_id: x.n_links for x in ngram_join.join(d, 3, 90, 100).collect()}
    assert got == {k: sum(k in p for p in linked) for k in texts}
    classes = {min(k for k in texts if sets[k] == s) for s in sets.values() if s}
    levels = ngram_join.frequencies(ngram_join.signatures(d, 3))
    found = [tuple(x) for x in ngram_join.links(d.where(F.col("doc_id").isin(list(classes))), 3, 90, 100, levels).select("a", "b", "overlap", "similarity").collect()]
    want = {(*p, c, c / len(sets[p[0]] | sets[p[1]])) for p, c in linked.items() if set(p) <= classes}
    assert len(found) == len(set(found)) == len(want) > 40 and set(found) == want
    assert ngram_join.links(d.where(F.col("doc_id").isin(list(classes))), 3, 90, 100).count() == len(want)


def test_decontamination(spark, docs, rows, none):
    r = random.Random(8)
    long = " ".join(prose(r, 150).split())
    items = [(1, rows[7][1][:300]), (2, None), (3, ""), (4, "one two"), (5, "nothing of the kind is in any of the documents"), (6, rows[17][1]), (6, rows[17][1]), (7, long)]
    texts = dict(rows) | {100: "before " + long + " after", 101: long[: len(long) * 9 // 10], 102: long[: len(long) // 2]}
    found = decontaminate.contained(spark.createDataFrame(list(texts.items()), "doc_id long, text string"), spark.createDataFrame(items, "item_id long, text string"))
    got = {(x.doc_id, x.item_id): x.containment for x in found.collect()}
    want = {}
    for i, t in dict(items).items():
        words = word_hashes(t)
        own = set(shingle_hashes(words, 5).tolist())
        for d, x in texts.items():
            has = word_hashes(x)
            width = min(5, len(words))
            s = set(shingle_hashes(has, width).tolist()) if own and len(has) >= width else set()
            if own and 100 * len(own & s) >= 80 * len(own):
                want[d, i] = len(own & s) / len(own)
    assert (100, 7) in want and (102, 7) not in want
    assert got == pytest.approx(want)
    assert decontaminate.contained(none, spark.createDataFrame(items, "item_id long, text string")).count() == 0
    assert decontaminate.contained(docs, spark.createDataFrame([], "item_id long, text string")).count() == 0


EMAIL = re.compile(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+")
IP = re.compile(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)")


def plain_spans(t: str) -> list[tuple[int, int, int]]:
    out = [(m.start(), 0, m.end()) for m in EMAIL.finditer(t)]
    out += [(m.start(), 1, m.end()) for m in IP.finditer(t) if all(int(p) <= 255 for p in m[0].split("."))]
    for m in pii.CARD.finditer(t):
        d = [int(c) for c in m[0] if c.isdigit()]
        doubled = [x if k % 2 == 0 else 2 * x - 9 * (x > 4) for k, x in enumerate(reversed(d))]
        if 14 <= len(d) <= 19 and sum(doubled) % 10 == 0:
            out.append((m.start(), 2, m.end()))
    out += [(m.start(), 3, m.end()) for m in pii.PHONE.finditer(t) if 10 <= sum(c.isdigit() for c in m[0]) <= 15]
    return sorted(out)


def test_base_spans_equal_the_patterns():
    r = random.Random(3)
    for _ in range(20_000):
        t = "".join(r.choice("a1.@+-% (9é") for _ in range(r.randint(0, 40)))
        assert [(a, k, b) for a, b, k in pii.base_spans(t)] == plain_spans(t)
    assert pii.base_spans("1" * 200_000 + "a" * 200_000 + "@") == []


def test_personal_data(spark, docs, rows, none):
    got = {r.doc_id: r for r in pii.find(docs).collect()}
    assert set(got) == {k for k, _ in rows}
    for k, t in rows:
        said = ",".join(f"{pii.KINDS[x]}:{a}:{b}" for a, x, b in plain_spans(t or ""))
        assert got[k].base_sha256 == hashlib.sha256(said.encode()).hexdigest() and got[k].spans == said
    clean = {r.doc_id: r.text for r in pii.sanitise(docs).collect()}
    assert clean[rows[-1][0]] == "write [EMAIL] or [PHONE] from [IP] now, card [CARD]." and clean[0] is None
    assert pii.find(none).count() == 0 and pii.sanitise(none).columns == none.columns


def test_disclosing_terms(spark, monkeypatch):
    r = random.Random(1)
    filler = lambda: " ".join(r.choice(["red", "green", "blue", "one", "two", "three"]) + str(r.randint(0, 9)) for _ in range(12))
    texts = [f"{filler()} Zorro known as zed@example.com {filler()}" for _ in range(5)] + [f"{filler()} Zorro {filler()}"] + [filler() for _ in range(60)] + [f"as {filler()}" for _ in range(40)]
    texts += [f"copied unique phrase bob@example.com {'same ' * 5}"] * 9  # copies are one context
    d = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    flagged = pii.disclosing_terms(d)
    found = pii.find(d, flagged).orderBy("doc_id").collect()
    assert all("term:" in x.spans for x in found[:6]) and not any(x.n_term for x in found[6:])
    monkeypatch.setattr(pii, "BROADCAST_ROWS", 0)
    assert pii.find(d, flagged).orderBy("doc_id").collect() == found
    assert "Zorro" not in "".join(x.text for x in pii.sanitise(d).collect())


def test_disclosing_terms_far_from_the_entity(spark):
    r = random.Random(2)
    filler = lambda n: " ".join(r.choice(["red", "green", "blue", "one", "two"]) + str(r.randint(0, 9)) for _ in range(n))
    texts = [f"Zorro {filler(60)} zed@example.com" for _ in range(4)] + [filler(60) for _ in range(60)]
    texts += [texts[0], texts[-1]]  # equal texts are one
    d = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    flagged = {x.term: x for x in pii.disclosing_terms(d).collect()}
    zorro = int(word_hashes("zorro").view(np.int64)[0])
    assert flagged[zorro].disclosure == pytest.approx(1) and flagged[zorro].action == 2
    assert [x.text.startswith("Zorro") for x in pii.sanitise(d).orderBy("doc_id").collect()[:4]] == [False] * 4


def test_elias_fano():
    r = np.random.default_rng(0)
    for n in (0, 1, 31, 32, 33, 2000):
        for top in (3000, 2**40, 2**63):
            v = np.unique(r.integers(0, top, n, dtype=np.uint64))
            s = lm.Sequence(lm.ef_encode(v))
            assert np.array_equal(s.get(np.arange(len(v))), v) and np.array_equal(s.find(v), np.arange(len(v)))
            place = {int(x): k for k, x in enumerate(v)}
            q = r.integers(0, top, 500, dtype=np.uint64)
            assert s.find(q).tolist() == [place.get(int(x), -1) for x in q]


def test_language_model(spark, docs, rows, none):
    folder = new_path(spark, "t")
    got = {r.doc_id: r for r in lm.score(docs, folder, lm.learn(docs.where(~lm.held_out()), folder)).collect()}
    tokens = {k: [*word_hashes(t).tolist(), "end"] for k, t in rows}
    train = [k for k in tokens if zlib.crc32(str(k).encode()) % 7 != 2]
    c1 = collections.Counter(x for k in train for x in tokens[k])
    c2, c3 = collections.Counter(), collections.Counter()
    for k in train:
        s = ["end", *tokens[k]]
        c2.update(zip(s, s[1:], strict=False))
        c3.update(zip(s, s[1:], s[2:], strict=False))
    N, V = sum(c1.values()), len(c1)
    for k, t in tokens.items():
        base = sum(math.log10((c1[x] + 1) / (N + V + 1)) for x in t)
        s, total = ["end", *t], 0.0
        for i in range(1, len(s)):
            p = (c1[s[i]] + 1) / (N + V + 1)
            if c1[s[i - 1]]:
                p = (c2[s[i - 1], s[i]] + lm.WEIGHTS[0] * p) / (c1[s[i - 1]] + lm.WEIGHTS[0])
            if i > 1 and c2[s[i - 2], s[i - 1]]:
                p = (c3[s[i - 2], s[i - 1], s[i]] + lm.WEIGHTS[1] * p) / (c2[s[i - 2], s[i - 1]] + lm.WEIGHTS[1])
            total += math.log10(p)
        r = got[k]
        assert (r.held_out, r.n_tokens, r.n_known, r.train_tokens) == (k not in train, len(t), sum(c1[x] > 0 for x in t), N)
        assert r.base_score == pytest.approx(base) and abs(r.score - total) < 0.06 * len(t) + 1e-9  # quantised
    about = lm.learn(none, new_path(spark, "t"))
    assert lm.score(none, folder, about).count() == 0
    assert {r.score for r in lm.score(docs, folder, about).collect()} == {0.0}


def test_two_language_models_of_one_folder(spark, docs):
    """Each model scores every row as it does in a folder of its own, though workers hold the other when they begin."""
    folder, spread = new_path(spark, "t"), docs.repartition(16)
    scores = lambda where, about: {(r.doc_id, r.train_tokens, r.n_known, r.score) for r in lm.score(spread, where, about).collect()}
    first, second = docs.where("doc_id % 2 = 0"), docs
    a = lm.learn(first, folder)
    of_a = scores(folder, a)
    b = lm.learn(second, folder)
    of_b = scores(folder, b)
    assert scores(folder, a) == of_a != of_b == scores(folder, b)
    alone = new_path(spark, "t")
    assert scores(alone, lm.learn(second, alone)) == of_b


def test_language_model_of_too_many_words(spark, docs, monkeypatch):
    monkeypatch.setattr(lm, "MOST_WORDS", 3)
    with pytest.raises(ValueError, match="words"):
        lm.learn(docs, new_path(spark, "t"))


def test_quality_learns_what_is_held_out(spark, none):
    from tests.conftest import SF

    sf = SF.replace("0.001", "0.01")
    docs, labels = spark.read.parquet(f"{sf}/documents.parquet"), spark.read.parquet(f"{sf}/labels.parquet")
    scored = {r.doc_id: r for r in quality.op3_quality(spark, sf).collect()}
    assert all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.7) for r in scored.values()) and len(scored) == docs.count()
    held = [(r.quality, scored[r.doc_id].predicted) for r in labels.collect() if scored[r.doc_id].held_out]
    assert sum(a == b for a, b in held) >= 0.95 * len(held)
    model = quality.train(docs, labels)
    kinds = {len(k) for k in model.tables}
    assert kinds == {1, 2}


def test_quality_of_odd_rows(spark, docs, rows, none):
    labels = spark.createDataFrame([(0, 1), (1, 0), (2, None), (3, 5), (4, 1), (4, 0)], "doc_id long, quality int")
    for lab in (labels, labels.limit(0)):
        got = quality.score(docs, quality.train(docs, lab)).collect()
        assert len(got) == len(rows) and all(0 <= r.score <= 1 for r in got)
    assert {r.score for r in quality.score(docs, quality.train(docs, labels.limit(0))).collect()} == {0.5}
    assert quality.score(none, quality.train(none, labels)).count() == 0


def test_id_files(spark, docs, rows, none):
    import public_tokenizers
    from tokenizers import Tokenizer

    t = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    at = 0
    for bits in (False, True):
        got = {r.doc_id: (r.start, r.n_tokens, r.ids_crc32) for r in id_planes.encode_and_read(docs, bits=bits, n_files=3).collect()}
        at, want = 0, {}
        for k, text in rows:
            ids = np.array([*t.encode(text or "", add_special_tokens=False).ids, 2], "<u4")
            want[k] = (at, len(ids), zlib.crc32(ids.tobytes()))
            at += len(ids)
        assert got == want
    assert id_planes.encode_and_read(none).count() == 0


def test_byte_bpe(spark, docs, rows, none):
    import public_tokenizers as P
    import tiktoken

    e = tiktoken.Encoding("own", pat_str=P.PATTERN, mergeable_ranks=bpe.read_ranks(P.path("byte_bpe_50k.tiktoken")), special_tokens={})
    got = {r.doc_id: r for r in bpe.digests(docs, keep_ids=True).collect()}
    for k, t in rows:
        ids = e.encode_ordinary(t or "")
        assert got[k].ids == ids and got[k].n_tokens == len(ids) and got[k].decoded_sha256 == hashlib.sha256((t or "").encode()).hexdigest()
    for r in bpe.encode(docs, offsets=True).collect():
        text = dict(rows)[r.doc_id] or ""
        assert all(0 <= a < b <= len(text) for a, b in zip(r.starts, r.ends, strict=True)) and (not r.ids or (r.starts[0] == 0 and r.ends[-1] == len(text)))
    assert bpe.digests(none).count() == 0


def test_token_counts(spark, docs, rows, none):
    import public_tokenizers as P
    from tokenizers import Tokenizer

    t = Tokenizer.from_file(P.path("byte_bpe_50k.json"))
    got = {r.doc_id: (r.n_bytes, r.n_tokens, r.over_limit) for r in token_counts.count_tokens(docs).collect()}
    want = {k: (len((x or "").encode()), n := len(t.encode(x or "", add_special_tokens=False).ids), n > 1024) for k, x in rows}
    assert got == want and token_counts.count_tokens(none).count() == 0


@pytest.mark.parametrize("size", [300, 1 << 23])
def test_warc(spark, monkeypatch, size):
    trap = "a WARC/1.0\r\nWARC-Type: response\r\nContent-Length: 7\r\n\r\nWARC/1.0\r\n\r\n\r\nWARC/1.0\r\nWARC-Type: x\r\nContent-Length: 99999\r\n\r\n"
    pages = [(1, "u", trap), (2, None, None), (3, "v\r\nw", ""), (4, "u", "same"), (9, "u", "same"), (9, "u", "same"), (7, "u", "same"), (5, "u" * 3000, "é" * 5000), (6, "u", trap * 9)]
    monkeypatch.setattr(warc, "RANGE_BYTES", size)
    df = spark.createDataFrame([(*p, "x", 1) for p in pages], "page_id long, url string, html string, sha string, size long").coalesce(1)
    got = warc.write_and_read(df).collect()
    last = {}
    for k, _, h in pages:
        last[h or ""] = max(last.get(h or "", -1), k)
    want = collections.Counter((k, len((h or "").encode()), base64.b32encode(hashlib.sha1((h or "").encode()).digest()).decode(), "response" if last[h or ""] == k else "revisit", None if last[h or ""] == k else last[h or ""]) for k, _, h in pages)
    assert collections.Counter(tuple(r)[:5] for r in got) == want and all(r.payload_ok in (True, None) for r in got)
    assert warc.write_and_read(df.limit(0)).count() == 0
    few = warc.write_and_read(df, least_bytes=5).where("page_id in (4, 7, 9)").collect()
    assert {r.record_type for r in few} == {"response"}


def test_syncmers(spark, docs, rows, none):
    got = {r.doc_id: r for r in syncmers.fingerprints(docs).collect()}
    ids = sorted((k for k, _ in rows), reverse=True)
    text = {k: t or "" for k, t in rows}
    prints = {}
    for k, below in zip(ids, ids[1:] + ids[:1], strict=True):
        n, half, r = len(text[k]), len(text[k]) // 2, got[k]
        edited = text[k][: n - half] + text[below][:half]
        assert r.n_chars == n and r.edited_sha256 == hashlib.sha256(edited.encode()).hexdigest()
        assert prints.setdefault(text[k], r.fingerprint) == r.fingerprint
        assert 0 <= r.near_edited <= 1 and (r.near_next == 1 if text[k] == text[below] else True)
    # Whether a place is chosen depends on its own words only: one passage has one run of anchors wherever it stands.
    words = [f"w{k * k % 97}" for k in range(80)]
    both = spark.createDataFrame([(1, " ".join(words)), (2, " ".join(["a", "b", "c", *words, "d"]))], "doc_id long, text string")
    a, b = (r.f for r in both.orderBy("doc_id").select(syncmers.printed(syncmers.anchors(F.col("text"))).alias("f")).collect())
    assert len(a) >= 32 and a in b
    assert syncmers.fingerprints(none).count() == 0
    twice = spark.createDataFrame([(1, "a"), (1, "a"), (None, "b"), (None, None)], "doc_id long, text string")
    assert syncmers.fingerprints(twice).count() == 4
    assert "Python" not in syncmers.fingerprints(docs)._jdf.queryExecution().toString()


def test_syncmers_of_short_and_edited_texts(spark):
    r = random.Random(6)
    word = lambda: f"w{r.randrange(10**9)}"
    texts = [" ".join(word() for _ in range(n)) for n in range(1, 41) for _ in range(5)]
    d = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = {x.doc_id: x for x in syncmers.fingerprints(d).collect()}
    assert all(len(x.fingerprint) >= 16 and x.near_next == 0 for x in got.values())  # none is empty, strangers share nothing
    assert all(x.near_edited > 0 for k, x in got.items() if len(texts[k].split()) >= 20)  # the kept half is found


def test_pipeline(spark):
    import corpus_pipeline
    from tests.conftest import SF

    docs = spark.read.parquet(f"{SF}/documents.parquet")
    kept = docs
    for name, stage in corpus_pipeline.STAGES:
        kept_before = {r.doc_id for r in kept.select("doc_id").collect()}
        path = new_path(spark, name)
        stage(spark, kept, SF).write.parquet(path)
        kept = spark.read.parquet(path)
        assert {r.doc_id for r in kept.select("doc_id").collect()} <= kept_before
        if name != corpus_pipeline.STAGES[-1][0]:
            assert kept.columns == docs.columns
        if name == "near_duplicates":
            g = {r.doc_id: r.component_id for r in ngram_join.join(kept).collect()}
            assert len(set(g.values())) == len(g)
    assert 0 < kept.count() < docs.count()
