"""Prices against edges, pairs by vectors, and places in an order, against plain versions."""

from __future__ import annotations

import datetime as dt
import itertools
import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from marketlens.operators import coherence, similar, tables

EDGE = "market_id_a string, market_id_b string, relationship_type string, direction string, trust_tier string"


def test_constraints_and_gaps(spark):
    rows = [
        ("A", "B", "implies", "a_implies_b", "trusted"), ("A", "C", "implies", "b_implies_a", "trusted"), ("B", "C", "implies", "symmetric", "trusted"), ("A", "D", "mutually_exclusive", "none", "trusted"),
        ("B", "D", "partition_member", "symmetric", "soft"), ("C", "D", "correlated", "symmetric", "trusted"), ("C", "E", "same_event", "none", "trusted"), ("D", "E", "implies", "none", "trusted"), ("A", "Z", "implies", "a_implies_b", "trusted"),
    ]
    prices = spark.createDataFrame([("A", 600_000), ("B", 450_000), ("C", 700_000), ("D", 500_000), ("E", None)], "market_id string, mid long")
    bound = coherence.constraints(spark.createDataFrame(rows, EDGE))
    got = {(r.kind, r.a, r.b): r.gap for r in coherence.gaps(bound, prices.where("mid is not null")).collect()}
    assert got == {("implies", "A", "B"): 150_000, ("implies", "C", "A"): 100_000, ("equal", "B", "C"): 250_000, ("exclusive", "A", "D"): 100_000}


def test_structural_edges_are_of_whole_partitions(spark):
    m = spark.createDataFrame([(f"m{k}", "E", True, "active") for k in range(3)] + [("m3", "E", True, "closed"), ("x", "F", True, "active"), ("y", "F", True, "active"), ("u", "G", False, "active"), ("v", "G", False, "active"), ("w", "G", False, "active")], "market_id string, event_ticker string, mutually_exclusive boolean, status string")
    pairs = spark.createDataFrame([("m0", "m1"), ("m0", "m3"), ("x", "y"), ("u", "v"), ("m2", "x"), ("m0", "m1")], "a string, b string")
    got = coherence.structural_edges(pairs, m, F.lit(dt.datetime(2024, 1, 1))).collect()
    assert [(r.market_id_a, r.market_id_b, r.relationship_type, r.trust_tier) for r in got] == [("m0", "m1", "partition_member", "trusted")]
    prices = m.select("market_id", F.lit(400_000).alias("mid"))
    assert [(r.event_ticker, r.n, r.gap) for r in coherence.partition_gaps(m, prices).collect()] == [("E", 3, 200_000)]
    assert coherence.partition_gaps(m, prices.where("market_id <> 'm1'")).count() == 0


def test_components(spark):
    chain = [(f"n{k:03}", f"n{k + 1:03}") for k in range(60)] + [("a", "b"), ("b", "a"), ("c", "c"), ("z", "y")]
    random.Random(1).shuffle(chain)
    got = {r.market_id: r.component for r in coherence.components(spark.createDataFrame(chain, "a string, b string")).collect()}
    assert got == {f"n{k:03}": "n000" for k in range(61)} | {"a": "a", "b": "a", "y": "y", "z": "y"}


def plain_fit(prices, bound):
    """Fitting outcome by outcome."""
    states = [s for s in itertools.product([False, True], repeat=len(prices)) if all({"implies": not s[a] or s[b], "equal": s[a] == s[b], "exclusive": not (s[a] and s[b])}[k] for k, a, b in bound)]
    q = {s: 1 / len(states) for s in states}
    for _ in range(coherence.ROUNDS):
        for i, p in enumerate(prices):
            mass = sum(x for s, x in q.items() if s[i])
            if 0 < mass < 1:
                q = {s: x * (p / mass if s[i] else (1 - p) / (1 - mass)) for s, x in q.items()}
    return [sum(x for s, x in q.items() if s[i]) for i in range(len(prices))], -sum(x * math.log(x) for x in q.values() if x > 0)


def test_joint_fit(spark):
    r, names = random.Random(6), [f"m{k}" for k in range(9)]
    prices = {m: r.randrange(50_000, 950_000) for m in names} | {f"big{k:02}": 300_000 for k in range(14)} | {"lone": 1}
    bound = [("implies", "m0", "m1"), ("exclusive", "m1", "m2"), ("implies", "m3", "m1"), ("equal", "m4", "m5"), ("exclusive", "m6", "m7"), ("implies", "m8", "m7"), ("implies", "m0", "gone")]
    bound += [("exclusive", f"big{k:02}", f"big{k + 1:02}") for k in range(13)]
    got = {x.market_id: x for x in coherence.joint(spark.createDataFrame(bound, "kind string, a string, b string"), spark.createDataFrame(list(prices.items()), "market_id string, mid long")).collect()}
    assert set(got) == set(names) | {f"big{k:02}" for k in range(14)}
    assert {(x.markets, x.fitted, x.deviation) for m, x in got.items() if m.startswith("big")} == {(14, None, None)}
    for group in (["m0", "m1", "m2", "m3"], ["m4", "m5"], ["m6", "m7", "m8"]):
        place = {m: i for i, m in enumerate(group)}
        want, entropy = plain_fit([prices[m] / 1e6 for m in group], [(k, place[a], place[b]) for k, a, b in bound if a in place and b in place])
        for m, x in zip(group, want, strict=True):
            assert got[m].fitted == pytest.approx(x * 1e6, abs=1) and got[m].entropy == pytest.approx(entropy, abs=1e-6) and got[m].component == group[0]
        assert got[group[0]].deviation == pytest.approx(max(abs(x * 1e6 - prices[m]) for m, x in zip(group, want, strict=True)), abs=1)


@pytest.mark.parametrize("block,threshold", [(2, 0.7), (16, 0.95), (512, 0.3)])
def test_pairs_by_vectors_equal_all_pairs(spark, block, threshold):
    r = np.random.default_rng(block)
    centres = r.normal(size=(6, 8))
    vectors = [[float(x) for x in centres[k % 6] + r.normal(size=8) * 0.4] for k in range(160)]
    rows = [(k, b, vectors[k]) for k in range(160) for b in ({0, k % 3} if k % 5 else {0})]
    rows += [(900, 0, [0.0] * 8), (901, 0, None), (None, 0, [1.0] * 8), (902, None, [1.0] * 8), (0, 0, rows[0][2])]
    got = {(x.a, x.b): x.similarity for x in similar.pairs(spark.createDataFrame(rows, "id long, bucket int, vector array<double>"), threshold, block).collect()}
    want = {}
    for (a, p, v), (b, q, w) in itertools.combinations([x for x in rows if None not in x and any(x[2])], 2):
        if p == q and a != b and (cos := float(np.dot(v, w) / np.linalg.norm(v) / np.linalg.norm(w))) >= threshold:
            want[min(a, b), max(a, b)] = cos
    assert set(got) == set(want) and all(got[k] == pytest.approx(want[k]) for k in want) and want
    assert similar.pairs(spark.createDataFrame([], "id long, bucket int, vector array<double>"), 0.5).count() == 0


def test_places(spark):
    rows = [(k % 7, f"k{k}") for k in range(200)]
    got = tables.placed(spark.createDataFrame(rows, "a int, b string").repartition(5), F.desc("a"), "b").collect()
    want = sorted(rows, key=lambda x: (-x[0], x[1]))
    assert [(r.a, r.b) for r in sorted(got, key=lambda r: r.position)] == want and sorted(r.position for r in got) == list(range(1, 201))
    assert tables.placed(spark.createDataFrame([], "a int"), "a").count() == 0


def test_declared_tables_are_made_once(spark, tmp_path):
    made = tables.created(spark, str(tmp_path))
    assert made["markets"].count() == 0 and made["llm_batches"].columns[0] == "batch_id"
    made["llm_batches"].unionByName(spark.createDataFrame([("x",)], "batch_id string"), allowMissingColumns=True).write.mode("append").parquet(str(tmp_path / "llm_batches"))
    assert tables.created(spark, str(tmp_path))["llm_batches"].count() == 1
