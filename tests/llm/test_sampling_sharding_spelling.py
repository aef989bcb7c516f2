"""Importance resampling, resharding and spelling variants against plain versions, on odd rows too."""

from __future__ import annotations

import collections
import hashlib
import itertools
import math
import random
import re
import zlib

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from marketlens.llm import resample, reshard, spelling
from marketlens.llm.common import new_path

SCHEMA = "doc_id long, text string, source string, n long, rank long, weight long, shard int, slot int, old int, block int, size long, row string, word string"


def table(spark, rows):
    return spark.createDataFrame([(k, t, s, 1, 2, 3, 4, 5, 6, 7, 8, "r", "w") for k, t, s in rows], SCHEMA)


def odd_rows():
    r = random.Random(5)
    words = "Straße naïve don't x1 東京 the of and über ÀÉ co-op 12 a_b ×÷ q".split()
    text = lambda n: "".join(r.choice(words) + r.choice([" ", ", ", "\n", "", "-"]) for _ in range(n))
    rows = [(k, text(n), f"s{k % 3}") for k, n in enumerate([0, 1, 2, 3, 19, 20, 21, 50, 400, 3000])]
    rows += [(20, None, None), (21, "", "s1"), (22, "\x00 \x7f", "s2"), (None, text(60), "s1"), (None, None, None), (23, rows[8][1], "s0"), (24, rows[8][1], "s0"), (24, rows[8][1], "s0"), (25, "y" * 200_000, "s0"), (26, "One two " * 30_000, "s4")]
    return rows


# ---- resampling


def features(text):
    w = re.findall("[^\x00-\x2f\x3a-\x60\x7b-\x7f]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    return len(w), [" ".join(w[i : i + n]) for n in (1, 2, 3) for i in range(len(w) - n + 1)]


def test_resampling(spark):
    rows, target = odd_rows(), ["the of and 東京", None, "", "x1 x1 x1 naïve", "zzz"]
    got = resample.resample(table(spark, rows).repartition(3), spark.createDataFrame([(t,) for t in target], "text string"), percent=40).collect()
    bucket = lambda x: zlib.crc32(x.encode()) % 10_000
    s = collections.Counter(bucket(x) for _, t, _ in rows for x in features(t)[1])
    t = collections.Counter(bucket(x) for y in target for x in features(y)[1])
    S, T = sum(s.values()), sum(t.values())
    gain = lambda b: math.floor(1000 * math.log((t[b] + 1.0) * (S + 10_000.0) / ((s[b] + 1.0) * (T + 10_000.0))))
    want = []
    for k, text, _ in rows:
        n, x = features(text)
        weight = sum(gain(bucket(y)) for y in x)
        h = None if k is None else int(hashlib.sha256(f"42:{k}".encode()).hexdigest()[:8], 16)
        want.append((k, n, len(x), weight, None if k is None else weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 2**32)))))
    fit = sorted((x for x in want if x[0] is not None and x[1] >= 20), key=lambda x: (-x[4], x[0]))
    rank = collections.defaultdict(list)
    for i, x in enumerate(fit):
        rank[x].append(i + 1 if i < 40 * len(fit) // 100 else None)
    full = sorted(((*x, rank[x].pop(0) if rank.get(x) else None) for x in want), key=str)
    assert sorted((tuple(r) for r in got), key=str) == full and any(x[5] for x in full)


def test_resampling_of_nothing(spark):
    none, some = table(spark, []), table(spark, odd_rows())
    assert resample.resample(none, some).count() == 0
    assert {(r.rank is None, r.n_features > 0) for r in resample.resample(some, none, min_words=10**9).collect()} == {(True, True), (True, False)}


def test_crc_states_and_tries():
    r = random.Random(3)
    a, b = ([r.randbytes(r.choice([0, 1, 7, 300, 70_000])) for _ in range(40)] for _ in range(2))
    got = resample.continued(*(np.array([zlib.crc32(x) for x in y], np.uint32) for y in (a, b)), np.array([len(x) for x in b]))
    assert got.tolist() == [zlib.crc32(x + y) for x, y in zip(a, b, strict=True)]
    texts = ["a b a b a", "", "B", "x y"]
    trie = resample.Trie(pa.array(["before", *texts]).slice(1))
    want = collections.Counter(zlib.crc32(x.encode()) % 10_000 for t in texts for x in features(t)[1])
    assert {k: int(v) for k, v in enumerate(trie.buckets()) if v} == dict(want)
    assert trie.weights(np.ones(10_000, np.int64))[2].tolist() == [12, 0, 1, 3]


# ---- resharding


def cheapest(supply, room, cost):
    """All ways to send unit by unit."""
    units = [i for i, n in supply.items() for _ in range(n)]
    best = None
    for way in itertools.product(room, repeat=len(units)):
        if all(n <= room[j] for j, n in collections.Counter(way).items()):
            price = sum(cost(i, j) for i, j in zip(units, way, strict=True))
            best = price if best is None else min(best, price)
    return best


@pytest.mark.parametrize("seed", range(6))
def test_flow_is_cheapest(seed):
    r = random.Random(seed)
    supply = {x: r.randint(0, 3) for x in "abc"}
    room = {x: r.randint(0, 4) for x in "bcd"} | {"e": sum(supply.values()) // 2}
    room["d"] += max(0, sum(supply.values()) - sum(room.values()))
    price = {(i, j): r.randint(0, 5) for i in supply for j in room}
    for cost in (None, lambda i, j: price[i, j]):
        flow = reshard.min_cost_flow(supply, room, cost)
        of = cost or (lambda i, j: int(i != j))
        assert all(sum(f for (i, _), f in flow.items() if i == k) == n for k, n in supply.items())
        assert all(sum(f for (_, j), f in flow.items() if j == k) <= n for k, n in room.items())
        assert sum(of(i, j) * f for (i, j), f in flow.items()) == cheapest(supply, room, of)
    with pytest.raises(ValueError):
        reshard.min_cost_flow({"a": 2}, {"b": 1})


def laws(rows, got, n):
    """Every row once, gapless slots; sizes by shard."""
    assert sorted(str((r["row"]["doc_id"], r["row"]["text"])) for r in got) == sorted(str((k, t)) for k, t, _ in rows)
    slots = collections.defaultdict(list)
    for r in got:
        slots[r["shard"]].append(r["slot"])
    assert all(0 <= j < n and sorted(s) == list(range(len(s))) for j, s in slots.items())
    return [sum(r["size"] for r in got if r["shard"] == j) for j in range(n)]


@pytest.mark.parametrize("n_old,n_new,hot", [(4, 6, False), (6, 4, False), (5, 5, True), (1, 7, False)])
def test_resharding(spark, monkeypatch, n_old, n_new, hot):
    monkeypatch.setattr(reshard, "LEAST_BLOCK", 2000)
    r = random.Random(n_old)
    rows = [(k, "x" * r.randint(0, 60), "s0" if hot and k % 3 else f"s{k % n_old}") for k in range(2500)] + [(9000 + k, "y" * 4000, "s0") for k in range(6)]
    shard = F.expr(f"cast(substr(source, 2) as int) % {n_old}")
    old = reshard.layout(table(spark, rows).repartition(4), shard, reshard.text_size(), new_path(spark, "old"))
    before = {k: f["bytes"] for k, f in ((x["old"], x.asDict()) for x in old.groupBy("old").agg(F.sum("size").alias("bytes")).collect())}
    out, counts = reshard.reshard(old, n_new, new_path(spark, "new"))
    sizes = laws(rows, out.collect(), n_new)
    level = sum(sizes) / n_new
    assert counts["bytes"] == sum(sizes) and max(abs(x - level) for x in sizes) <= 70 * n_old + 4008 * (level < 4008)
    least = sum(max(0, b - level) if k < n_new else b for k, b in before.items())
    assert least - 200 * n_old <= counts["moved"] <= least + 200 * n_old + 4008
    assert counts["rewritten"] <= counts["bytes"] - (0 if n_old == 1 else level / 4)  # files that stay are not read


def test_resharding_of_odd_rows(spark):
    rows = odd_rows()
    old = reshard.layout(table(spark, rows), reshard.by_source(), reshard.text_size(), new_path(spark, "old"))
    got = reshard.reshard(old, 24, new_path(spark, "new"))[0].collect()
    laws(rows, got, 24)
    assert all(r["row"]["shard"] == 4 and r["row"]["row"] == "r" for r in got)
    none = reshard.layout(table(spark, []), reshard.by_source(), reshard.text_size(), new_path(spark, "old"))
    assert reshard.reshard(none, 24, new_path(spark, "new"))[0].count() == 0


def test_levels_of_shards_that_one_row_fills():
    assert reshard.levels({0: 100, 1: 0, 2: 3}, 130) == {0: 100, 1: 15, 2: 15}
    where, load = reshard.placed([(0, 50, 1), (0, 40, 2), (0, 9, 3), (7, 5, 4)], {1: 30}, 3)
    assert where[1] == 0 and where[2] == 2 and sum(load.values()) == 104


# ---- spelling


def plain_words(rows):
    n = collections.Counter()
    for k, t, _ in rows:
        for x in re.findall("[A-Za-zÀ-ÿ]+", t or ""):
            x = re.sub("[A-Z]", lambda m: m[0].lower(), x)
            h = zlib.crc32(f"{'' if k is None else k}:{x}".encode())
            n[x[: h % len(x)] + x[h % len(x) + 1 :] if h % 199 == 0 else x] += 1
    return n


def is_near(a, b):
    if abs(len(a) - len(b)) > 1 or a == b:
        return False
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b, strict=True)) == 1
    a, b = sorted((a, b), key=len)
    return any(b[:i] + b[i + 1 :] == a for i in range(len(b)))


def plain_variants(n):
    near = {a: [b for b in n if is_near(a, b)] for a in n}
    form = {a: min(bs, key=lambda b: (-n[b], b)) for a, bs in near.items() if bs}
    form = {a: b for a, b in form.items() if n[b] >= 5 * n[a]}
    root = {}
    for a in n:
        b = a
        while b in form:
            b = form[b]
        root[a] = b
    return sorted(((a, form.get(a), root[a], n[a], len(near[a]), n[form[a]] if a in form else None) for a in n), key=str)


def test_words_and_omissions(spark):
    rows = odd_rows() + [(k, " ".join(f"Wörter{chr(97 + i)}{chr(97 + j)}" for i in range(26) for j in range(26)), "s") for k in range(30, 40)]
    got = {r.word: r.n for r in spelling.counted(table(spark, rows).repartition(3)).collect()}
    assert got == dict(plain_words(rows)) and any(len(w) == 7 for w in got)
    assert spelling.counted(table(spark, [])).count() == 0


def test_variants(spark):
    r = random.Random(8)
    words = collections.Counter()
    for base in ("banana", "bananas", "aaaaaa", "éclairs", "letters", "zebraß"):
        for _ in range(60):
            w = list(base)
            for _ in range(r.randint(0, 3)):
                k, c = r.randrange(len(w)), r.choice("abnséÿ")
                w = r.choice([w[:k] + w[k + 1 :], w[:k] + [c] + w[k:], w[:k] + [c] + w[k + 1 :]])
            words["".join(w)] += r.choice([1, 2, 8, 40, 300])
    words["m" * 30_000] = words["m" * 29_999] = 40
    words["m" * 30_001] = 5
    rows = [(w, n) for w, n in words.items()]
    vocab = spelling.vocabulary(spark.createDataFrame(rows, "word string, n long").repartition(3), least=1)
    want = plain_variants({w: n for w, n in words.items() if len(w) >= 6})
    got = sorted((tuple(x) for x in spelling.variants(vocab).select("word", "form", "root", "n", "n_near", "form_n").collect()), key=str)
    assert got == want and any(x[2] != x[1] and x[1] for x in want)
    assert spelling.variants(spelling.vocabulary(spark.createDataFrame([], "word string, n long"))).count() == 0
