from __future__ import annotations

import datetime as dt
import itertools
import random

import pytest
from pyspark.sql import functions as F

from marketlens.functions import scalars
from marketlens.operators import audit, discovery, edges, pairs, retention, tables
from marketlens.params import Params
from marketlens.sources.paged import Missing, PagedSource, Temporary, TokenBucket, lookup, retried


def one(spark, value, schema, f):
    return spark.createDataFrame([(value,)], f"x {schema}").select(f(F.col("x"))).first()[0]


def test_times(spark):
    t = lambda x: one(spark, x, "string", scalars.parse_time)
    assert t("2024-01-01T00:00:00Z") == t("1704067200") == t("1704067200000") == t("2024-01-01T01:00:00+01:00") == dt.datetime(2024, 1, 1)
    assert t("0") is t("") is t("soon") is t(None) is None


def test_scalars(spark):
    assert one(spark, [" A", "a", "", None, "b "], "array<string>", scalars.entities) == ["a", "b"]
    assert one(spark, float("nan"), "double", scalars.clamp_unit) == 1.0
    assert one(spark, -3.0, "double", scalars.clamp_unit) == 0.0
    assert one(spark, "```json\n{}\n```", "string", scalars.strip_fence) == "{}"
    assert one(spark, "x", "string", lambda c: scalars.best_volume(c, F.lit("5"))) == 5.0
    assert one(spark, "Cup", "string", lambda c: scalars.title(c, F.lit("T"), F.lit("Final"))) == "Cup — Final"
    assert one(spark, "", "string", lambda c: scalars.label(c, F.lit(None), cap_strike=F.lit(5))) == "cap_strike=5"


@pytest.mark.parametrize(("a", "b", "want"), [(5, 90, "skip"), (23.99, None, "skip"), (30, 31, "sync"), (24, 48, "sync"), (47.99, 500, "sync"), (48, 48, "batch"), (None, 75, "batch"), (None, None, "sync")])
def test_routes(spark, a, b, want):
    row = spark.createDataFrame([(a and a * 3600.0, b and b * 3600.0)], "a double, b double")
    assert row.select(scalars.route(F.col("a"), F.col("b"))).first()[0] == want


@pytest.mark.parametrize(("p", "h", "v"), list(itertools.product((0, 1), (0, 1), (999.0, 1000.0))))
def test_admission(spark, p, h, v):
    row = discovery.verdicts(spark.createDataFrame([("S", p, h, v)], "series_ticker string, n_partition_events int, n_hierarchy_events int, volume_24h double")).first()
    assert row.admit == (bool(p or h) and v >= 1000)
    failed = [n for n, ok in (("P1", p), ("P2", h), ("P3", v >= 1000)) if not ok]
    assert row.reason == ("admit" if row.admit else "reject") + (f" (failed: {','.join(failed)})" if failed else "")


def test_audit_classes(spark):
    level = "market_id string, side string, price long, size long"
    book = [("small", "yes", p * 10_000, 7_000_000) for p in range(41, 58)] + [("same", "yes", 270_000, 9)] + [("gross", "no", 330_000, 12_000_000)]
    book += [("large", "no", p * 10_000, 7_000_000) for p in range(41, 58)]
    # Four levels fewer are still a small difference and seven are not; more than half of the larger size is a large one.
    gone = {"small": 450_000, "large": 480_000}
    other = [r for r in book if r[0] != "gross" and r[2] >= gone.get(r[0], 0)] + [("gross", "no", 330_000, 5_900_000)]
    names = spark.createDataFrame([(m,) for m in ("small", "same", "gross", "large", "empty")], "market_id string")
    got = {r.market_id: (r.status, r.action_taken) for r in audit.audit(names, spark.createDataFrame(book, level), spark.createDataFrame(other, level)).collect()}
    assert got == {"small": ("small_diff", "none"), "same": ("no_diff", "none"), "gross": ("large_diff", "book_reset"), "large": ("large_diff", "book_reset"), "empty": ("no_diff", "none")}


def test_pairs_equal_brute_force(spark):
    r = random.Random(5)
    rows = [(f"M{k}", r.choice(["e1", "e2", None]), r.choice(["s1", "s2"]), [r.choice("abcdefgh") for _ in range(r.randint(0, 6))]) for k in range(40)]
    m = spark.createDataFrame(rows, "market_id string, event_ticker string, series_ticker string, entities array<string>")
    for same_series in (False, True):
        got = {(x.a, x.b) for x in pairs.todo(pairs.candidates(m, Params(same_series=same_series))).collect()}
        want = set()
        for x, y in itertools.combinations(rows, 2):
            if (x[1] and x[1] == y[1]) or len(set(x[3]) & set(y[3])) >= 3 or (same_series and x[2] == y[2]):
                want.add(tuple(sorted((x[0], y[0]))))
        assert got == want


def test_tiers(spark):
    first = spark.createDataFrame([(f"a{k}", "b", "implies", "none", c, None) for k, c in enumerate((0.91, 0.88, 0.85, 0.61, 0.59, 0.97))], "a string, b string, relationship_type string, direction string, confidence double, error string")
    second = spark.createDataFrame([("a0", "b", "implies", "m", None), ("a1", "b", "unrelated", "m", None), ("a5", "b", "implies", "m", None)], "a string, b string, relationship_type string, model string, error string")
    live = spark.createDataFrame([(x,) for x in ("a0", "a1", "a2", "a3", "a4", "b")], "market_id string")
    got = {r.a: (r.trust_tier, r.agreement_status) for r in edges.trust(first, second, live).collect()}
    assert got == {"a0": ("trusted", "agreed"), "a1": ("review", "disagreed"), "a2": ("soft", "single"), "a3": ("soft", "single"), "a4": ("review", "single"), "a5": ("soft", "single")}


def test_batch_results_and_queue(spark):
    lines = ['{"custom_id":"r0","result":{"type":"succeeded","message":{"content":[{"type":"x"},{"type":"text","text":"hi"}]}}}', '{"custom_id":"r1","result":{"type":"errored"}}', "nonsense", '{"custom_id":"r2","result":{"type":"succeeded","message":{"content":[]}}}']
    got = {r.custom_id: (r.content, r.error) for r in edges.batch_results(spark.createDataFrame([(x,) for x in lines], "value string")).collect()}
    assert got == {"r0": ("hi", None), "r1": (None, "errored"), "r2": (None, "no text")}
    batches = spark.createDataFrame([("b", "semantics", '{"r0":"M1","r1":"M2"}', dt.datetime(2024, 1, 1))], "batch_id string, purpose string, payload string, submitted_at timestamp_ntz")
    assert {r.context for r in edges.in_flight(batches, "semantics").collect()} == {"M1", "M2"}
    assert edges.stale_batches(batches, F.lit("2024-01-03 00:00:01").cast("timestamp_ntz")).count() == 1
    assert edges.stale_batches(batches, F.lit("2024-01-02 00:00:00").cast("timestamp_ntz")).count() == 0


class Echo:
    def complete(self, prompt):
        if prompt == "bad":
            raise ValueError("no")
        return prompt.upper()


def test_provider_failures_are_rows(spark):
    got = {r.custom_id: (r.content, r.error) for r in edges.complete(spark.createDataFrame([("1", "x"), ("2", "bad")], "custom_id string, prompt string"), Echo()).collect()}
    assert got == {"1": ("X", None), "2": (None, "ValueError: no")}


def test_swap_and_upsert(spark):
    from marketlens.schemas import SCHEMAS

    row = lambda k, when, rank: (k, when, when, True, True, True, 1, 1, 5.0, rank)
    make = lambda *rows: spark.createDataFrame(list(rows), SCHEMAS["tracked_series"])
    one_, two = dt.datetime(2024, 3, 1), dt.datetime(2024, 3, 2)
    old, new = make(row("Q", one_, 1), row("R", one_, 2)), make(row("R", two, 1), row("S", two, 2))
    after = tables.swap(old, new)
    assert {r.series_ticker: r.admitted_at for r in after.collect()} == {"R": one_, "S": two}
    assert {r.series_ticker for r in tables.swap(old, make()).collect()} == {"Q", "R"}
    with pytest.raises(Exception, match="without key"):
        tables.swap(old, make(row(None, two, 1))).collect()
    twice = make(row("S", one_, 9), row("S", one_, 7), row("T", two, 3))
    assert {r.series_ticker: r.rank_position for r in tables.upsert(after, twice, ["series_ticker"], ("admitted_at",), order="rank_position").collect()} == {"R": 1, "S": 9, "T": 3}
    with pytest.raises(Exception, match="already there"):
        tables.insert(old, make(row("R", two, 1)), "series_ticker").collect()
    assert tables.insert(old, make(row("U", two, 1)), "series_ticker").count() == 3


def completion(spark, *texts):
    return edges.parse_classification(spark.createDataFrame([(k, t) for k, t in enumerate(texts)], "k int, content string")).orderBy("k").collect()


def test_completions_are_taken_as_they_are(spark):
    good = '{"relationship_type":" implies ","direction":"","confidence":"1.7","rationale":"{x}"}'
    rows = completion(spark, good, good + " and {so} on", good + good, good + "]} {", f"```json\n{good}\n```", f"```{good}```", f"[{good}]", good.replace("implies", "Implies"), good.replace('""', '"None"'), good.replace('""', "null"), good.replace('"1.7"', "true"), good.replace('"1.7"', '"x"'), None)
    assert [r.error for r in rows] == [None, "not an object", "not an object", "not an object", None, "not an object", "not an object", "relation", "direction", "direction", None, "confidence", "not an object"]
    assert (rows[0].relationship_type, rows[0].direction, rows[0].confidence, rows[0].rationale) == ("implies", "none", 1.0, "{x}") and rows[10].confidence == 1.0


def test_semantics_need_their_keys(spark):
    text = '{"underlying_event":" e ","resolves_yes_when":"y","resolves_no_when":7,"resolution_timing":null,"entities":[" a ","",3],"dependencies":null}'
    rows = edges.parse_semantics(spark.createDataFrame([(0, text), (1, text.replace("underlying", "under")), (2, text.replace('[" a ","",3]', '"a"')), (3, text.replace('"entities":[" a ","",3],', ""))], "k int, content string")).orderBy("k").collect()
    assert [r.error for r in rows] == [None, "underlying_event", "entities", None]
    assert (rows[0].underlying_event, rows[0].resolves_no_when, rows[0].resolution_timing, rows[0].entities, rows[0].dependencies, rows[3].entities) == (" e ", "7", "None", ["a", "3"], [], [])


def test_wire_messages_of_both_names_and_zeros(spark):
    import json

    from marketlens.operators import normalize

    said = lambda kind, **msg: json.dumps({"type": kind, "seq": 3, "msg": msg})
    bodies = [
        said("market_lifecycle", market_id="L", ts=86400, ts_ms=5, event_type="created"), said("orderbook_delta", market_ticker="", market_id="D", price_dollars=0, price="0.20", delta_fp=0, delta=4, side="yes", ts=86400),
        said("trade", market_ticker="T", ts_ms=0, ts=86400, yes_price_dollars="0.3", no_price_dollars="0.7", taker_side="no", trade_id="x"), said("ok", market_ticker="C"), said("trade"), "[]", "no",
    ]
    frames = spark.createDataFrame([(dt.datetime(2024, 3, 1), k, b) for k, b in enumerate(bodies)], "received_ts timestamp_ntz, ingest_seq long, body string")
    rows = normalize.from_wire(frames)
    day = dt.datetime(1970, 1, 2)
    assert {(r.market_id, r.event_type, r.ts) for r in rows.collect()} == {("L", "lifecycle", day), ("D", "orderbook_delta", None), ("T", "trade", day)}
    got = {r.market_id: r for r in normalize.decoded(rows).collect()}
    assert (got["D"].price, got["D"].delta) == (200_000, 0) and (got["T"].trade_price, got["T"].no_price, got["T"].taker_side, got["T"].trade_id) == (300_000, 700_000, "no", "x")
    docs = spark.createDataFrame([("A", '{"orderbook_fp":{"yes_dollars":[["0.3","5"],["x"]],"no":[[0.6,1]]}}'), ("B", '{"orderbook":{"yes":[]}}'), ("C", None)], "key string, doc string")
    assert {tuple(r) for r in normalize.fetched_book(docs).collect()} == {("A", "yes", 300_000, 5_000_000), ("A", "no", 600_000, 1_000_000)}


def test_ranks_of_equal_series_keep_the_order_they_were_seen_in(spark):
    rows = spark.createDataFrame([("Z", True, 1, 1, 5.0, 1), ("A", True, 1, 1, 5.0, 2), ("B", False, 9, 9, 9.0, 0)], "series_ticker string, passes_p1 boolean, n_partition_events int, n_hierarchy_events int, volume_24h double, first_seen long")
    assert [r.series_ticker for r in discovery.ranked(rows).orderBy("rank_position").collect()] == ["Z", "A", "B"]


@pytest.mark.parametrize("values", [[], [0.0], [-1.0, 0.0, 0.0, 2.0], [float(k * k % 97) for k in range(1, 500)], [1e-9, 1e12, 3.0] * 7])
def test_volume_distribution(spark, values):
    r = discovery.volume_distribution(spark.createDataFrame([(v,) for v in values], "volume double").repartition(3)).first()
    order, n = sorted(values), len(values)
    assert (r.n, r.max) == (n, order[-1] if n else None) and r.below_100 == sum(v < 100 for v in values)
    assert [r.p50, r.p90, r.p99] == [order[min(n - 1, int(q * n))] if n else None for q in (0.5, 0.9, 0.99)]


def test_few_markets_are_extracted_one_by_one(spark):
    from marketlens.operators import extraction

    m = spark.createDataFrame([(f"m{k}", True) for k in range(9)], "market_id string, subscribed boolean")
    none = spark.createDataFrame([], "market_id string, extraction_version int")
    open_ = spark.createDataFrame([("b", "semantics", '{"r0":"m1"}')], "batch_id string, purpose string, payload string")
    p = Params(sync_cap=3, batch_cap=5, bulk_threshold=8)
    work = lambda batches, p=p: [(r.market_id, r.route) for r in extraction.semantics_work(m, none, batches, 1, p).orderBy("market_id").collect()]
    assert work(open_) == [(f"m{k}", "batch") for k in (0, 2, 3, 4, 5)]
    assert work(open_, Params(sync_cap=3, batch_cap=5, bulk_threshold=9)) == [(f"m{k}", "sync") for k in (0, 2, 3)]
    assert work(None) == [(f"m{k}", "sync") for k in (0, 1, 2)]


def test_prune_keeps_rows_without_time(spark):
    now = dt.datetime(2024, 1, 1, 12)
    rows = spark.createDataFrame([(now - dt.timedelta(minutes=101),), (now - dt.timedelta(minutes=99),), (None,)], "ts timestamp_ntz")
    cutoff = F.lit(now - dt.timedelta(minutes=100)).cast("timestamp_ntz")
    assert retention.prune(rows, "ts", cutoff).count() == 2
    assert tuple(retention.prune_counts(rows, "ts", cutoff).first()) == (1, 2)


class Service:
    def page(self, key, cursor):
        if key == "gone":
            raise Missing
        n = int(cursor or 0)
        return [{"key": key, "n": n}], str(n + 1) if n < 2 else None


def test_paged_source(spark):
    spark.dataSource.register(PagedSource)
    rows = spark.read.format("paged").option("client", "tests.test_operators:Service").option("keys", "A,gone,B").option("perSecond", "1000").load()
    assert rows.groupBy("key").count().orderBy("key").collect() == [("A", 3), ("B", 3)]
    misses = spark.read.format("paged").option("client", "tests.test_operators:Service").option("keys", "A,gone,B").option("perSecond", "1000").option("misses", "true").option("connections", "2").load()
    assert {(r.key, r.doc is None) for r in misses.collect()} == {("A", False), ("B", False), ("gone", True)}


def test_lookups_by_a_table_of_keys(spark):
    keys = spark.createDataFrame([("A",), ("gone",), (None,), ("A",), ("D",)], "market string")
    got = lookup(keys, "tests.test_operators:Service", "market", connections=2, persecond=1000)
    assert sorted((r.key, r.doc is None) for r in got.collect()) == [("A", False)] * 3 + [("D", False)] * 3 + [("gone", True)]
    assert got.rdd.getNumPartitions() <= 2 and lookup(keys.limit(0), "tests.test_operators:Service", "market").count() == 0


def test_pacing_and_retries():
    clock = [0.0]
    bucket = TokenBucket(2, 1, lambda: clock[0], lambda s: clock.__setitem__(0, clock[0] + s))
    for _ in range(5):
        bucket.take()
    assert abs(clock[0] - 2.0) < 1e-6
    calls = []

    def flaky():
        calls.append(1)
        if len(calls) < 3:
            raise Temporary
        return "done"

    assert retried(flaky, sleep=lambda s: None) == "done"
    with pytest.raises(Temporary):
        retried(lambda: (_ for _ in ()).throw(Temporary()), 2, sleep=lambda s: None)


def _copies(spark):
    """Markets of which many have equal entities, some several events or rows, with closing times."""
    rows = [(f"M{i}", f"E{i % 3}" if i % 4 else None, ["x", "y", "z" if i % 5 else f"w{i}", "q"][: 4 if i % 7 else 2], NOW_SECONDS + i * 3600 if i % 6 else None) for i in range(60)]
    rows += [("M1", "E2", ["more"], None), ("M2", "", None, None)]
    m = spark.createDataFrame(rows, "market_id string, event_ticker string, entities array<string>, at long")
    return m.withColumn("closes_at", F.timestamp_seconds("at").cast("timestamp_ntz")).withColumn("series_ticker", F.lit(None).cast("string"))


NOW_SECONDS = 1_700_000_000


@pytest.mark.parametrize("block", [2, 256])
def test_pairs_by_classes(spark, monkeypatch, block):
    from marketlens.operators import pairs

    monkeypatch.setattr(pairs, "BLOCK", block)
    m = _copies(spark)
    sets, events, closes = {}, {}, {}
    for r in m.collect():
        sets.setdefault(r.market_id, set()).update(r.entities or ())
        events.setdefault(r.market_id, set()).update({r.event_ticker} - {None, ""})
        if r["at"] is not None:
            closes[r.market_id] = r["at"] - NOW_SECONDS
    ids = sorted(sets)
    both = [(a, b) for a in ids for b in ids if a < b]
    event = {x for x in both if events[x[0]] & events[x[1]]}
    entity = {x for x in both if len(sets[x[0]] & sets[x[1]]) >= 3}
    assert sorted(map(tuple, pairs.candidates(m).collect())) == sorted([(*x, "event") for x in event] + [(*x, "entity") for x in entity])
    life = lambda x: min((closes[i] for i in x if i in closes), default=None)
    got = pairs.distinct_candidates(m, now=F.timestamp_seconds(F.lit(NOW_SECONDS))).collect()
    assert sorted(((r.a, r.b), r.life) for r in got) == sorted((x, life(x)) for x in event | entity)
    assert pairs.candidate_counts(m).collect() == [(len(event), 0, len(entity), len(event | entity))]


def test_pairs_are_not_broadcast_nor_shuffled(spark):
    from marketlens.operators import pairs

    plan = pairs.distinct_candidates(_copies(spark))._jdf.queryExecution().toString().split("== Physical Plan ==")[1]
    assert "BroadcastExchange" not in plan
    assert "Exchange" not in plan[: plan.index("Generate explode(ys")]


def test_classes_that_meet_are_not_shuffled(spark, monkeypatch):
    """Markets that all differ are as many classes, so links between classes would be as many as pairs."""
    from marketlens.operators import pairs

    monkeypatch.setattr(pairs, "BLOCK", 3)
    names = [["a", "b", "c", f"x{i}"] + ["d"] * (i % 2) + ["0"] * (i % 3 == 0) for i in range(20)]
    rows = [(f"M{i:02}", None, f"E{i % 2}", e, None) for i, e in enumerate(names)] + [("N1", None, "E1", ["a"], None), ("N2", None, "E1", [], None)]
    m = spark.createDataFrame(rows, "market_id string, series_ticker string, event_ticker string, entities array<string>, closes_at timestamp_ntz")
    found = pairs.distinct_candidates(m)
    plan = found._jdf.queryExecution().toString().split("== Physical Plan ==")[1]
    assert plan.count("Exchange ") == 2  # blocks of one side and of the other
    ids = [r[0] for r in rows]
    want = [(a, b) for i, a in enumerate(ids) for b in ids[i + 1 :] if b < "N" or (rows[i][2] == "E1")]
    assert sorted(map(tuple, found.collect())) == want
    assert pairs.candidate_counts(m).collect()[0].total == len(want)


def test_tables_of_the_same_pairs_are_joined_where_they_are_made(spark, monkeypatch):
    from marketlens.operators import pairs

    monkeypatch.setattr(pairs, "BLOCK", 2)
    monkeypatch.setattr(pairs, "MADE", 16)
    found = pairs.distinct_candidates(_copies(spark), at=True)
    last = F.right("b", F.lit(1))
    rows = pairs.todo(found, found.where(last < "3"), found.where(last == "3"))
    plan = rows._jdf.queryExecution().toString().split("== Physical Plan ==")[1]
    assert plan.count("LeftAnti") == 2
    assert plan.count("Exchange ") == 6 and "Exchange" not in plan[: plan.index("Generate explode(ys")]  # blocks of two sides, three times
    want = sorted((r.a, r.b) for r in pairs.distinct_candidates(_copies(spark)).collect() if r.b[-1] > "3")
    assert want and sorted(map(tuple, rows.collect())) == want


def test_second_opinions_are_joined_where_pairs_are_made(spark):
    from marketlens.operators import pairs

    found = pairs.distinct_candidates(_copies(spark), at=True)
    said = found.withColumns({"relationship_type": F.lit("implies"), "direction": F.lit("symmetric"), "confidence": F.lit(0.9), "error": F.lit(None).cast("string"), "model": F.lit("m")})
    rows = edges.trust(said, said.where("b like '%3'").withColumn("model", F.lit("second")))
    plan = rows._jdf.queryExecution().toString().split("== Physical Plan ==")[1]
    assert "Exchange" not in plan[: plan.index("Generate explode(ys")]
    want = sorted((r.a, r.b, "second" if r.b.endswith("3") else None) for r in pairs.distinct_candidates(_copies(spark)).collect())
    assert sorted((r.a, r.b, r.verify_model) for r in rows.collect()) == want


def test_pairs_in_order_are_not_sorted(spark, monkeypatch):
    from marketlens.operators import pairs

    monkeypatch.setattr(pairs, "BLOCK", 2)
    m = _copies(spark)
    want = [(*x, i + 1) for i, x in enumerate(sorted((r.a, r.b) for r in pairs.distinct_candidates(m).collect()))]
    for size in (3, 1 << 18):
        rows = pairs.in_order(m, size=size)
        assert want and sorted(map(tuple, rows.collect())) == want
        plan = rows._jdf.queryExecution().toString().split("== Physical Plan ==")[1]
        assert "Exchange" not in plan[: plan.index("Generate posexplode")]


def _plan_of(rows) -> str:
    return rows._jdf.queryExecution().optimizedPlan().toString()


def test_completions_are_parsed_once(spark):
    texts = ['{"relationship_type":"implies","confidence":0.7,"rationale":"[]"}', '{"relationship_type":"implies","confidence":0.7}] x', '{"relationship_type":"implies","confidence":0.7},"end":1}', '{"relationship_type":"implies","confidence":0.7}}', '{"relationship_type":"implies","confidence":0.7},{}', '[{"relationship_type":"implies","confidence":0.7}]']
    rows = edges.parse_classification(spark.createDataFrame([(x,) for x in texts], "content string"))
    assert [r.error for r in rows.collect()] == [None] + ["not an object"] * 5
    assert _plan_of(rows).count("```json") + _plan_of(rows).count("^json") == 1  # the fence is taken off once


def test_equal_completions_are_parsed_once(spark, monkeypatch):
    texts = ['{"relationship_type":"implies","confidence":0.7,"rationale":"r"}', '```json\n{"relationship_type":"implies","confidence":"NaN"}\n```', "no object", "", None]
    rows = spark.createDataFrame([(k, texts[k % 5]) for k in range(40)], "k int, content string")
    few = edges.parse_classification(rows)
    monkeypatch.setattr(edges, "BROADCAST_BYTES", 0)
    each = edges.parse_classification(rows)
    assert few.columns == each.columns and sorted(map(str, few.collect())) == sorted(map(str, each.collect())) and few.count() == 40
    assert [r.error for r in few.orderBy("k").limit(5).collect()] == [None, None] + ["not an object"] * 3
    assert "Join" in _plan_of(few) and "Join" not in _plan_of(each)


def test_structural_edges_of_all_pairs(spark, monkeypatch):
    from marketlens.operators import coherence

    monkeypatch.setattr(coherence, "BLOCK", 2)
    rows = [(f"M{i}", f"E{i % 3}" if i != 5 else None, i % 3 != 1, "active" if i % 4 else "closed") for i in range(20)] + [("Z1", "two", True, "active"), ("Z2", "two", True, "active")]
    m = spark.createDataFrame(rows, "market_id string, event_ticker string, mutually_exclusive boolean, status string")
    now = F.lit("2024-01-31 00:00:00")
    got = coherence.structural_edges(None, m, now)
    want = coherence.structural_edges(pairs.same(m, "event_ticker", "event"), m, now)
    assert got.count() and sorted(map(tuple, got.collect())) == sorted(map(tuple, want.collect()))


def test_large_rows_are_staged_in_small_groups(spark):
    import pyarrow.dataset as ds
    from marketlens.sources.stage import LARGE_ROWS, staged

    rows = staged(spark.range(0, 200, 1, 1).select("id", F.repeat(F.sha2(F.col("id").cast("string"), 256), 800).alias("payload")), "large", LARGE_ROWS)
    groups = [g for f in ds.dataset([x.removeprefix("file://") for x in rows.inputFiles()]).get_fragments() for g in f.row_groups]
    assert max(g.num_rows for g in groups) <= LARGE_ROWS and rows.count() == 200


def test_semantics_of_a_version_are_not_broadcast(spark):
    m = spark.createDataFrame([("A", True), ("B", True), ("C", False)], "market_id string, subscribed boolean")
    s = spark.createDataFrame([("A", 1), ("B", 2)], "market_id string, extraction_version int")
    missing = edges.missing_semantics(m, s, 1)
    assert [r.market_id for r in missing.collect()] == ["B"]
    assert "BroadcastExchange" not in missing._jdf.queryExecution().toString()
