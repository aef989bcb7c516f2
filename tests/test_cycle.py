"""The cycle of batches: written once whatever fails, and submitted once."""

from __future__ import annotations

import datetime as dt
import json
import os

import pytest
from pyspark.sql import functions as F

from marketlens.operators import cycle
from marketlens.params import Params
from marketlens.sources.paged import Temporary
from marketlens.sources.versions import Tables

NOW = dt.datetime(2024, 5, 2, 9, 30)


class Service:
    """Batches in a folder; the first call of each kind in a task fails."""

    def __init__(self, folder):
        self.folder, self.failed = folder, set()

    def fails_once(self, name):
        if name not in self.failed:
            self.failed.add(name)
            raise Temporary

    def submit(self, token, requests):
        path = f"{self.folder}/sent-{token}"
        with open(path, "w") as f:
            json.dump(requests, f)
        with open(f"{self.folder}/calls", "a") as f:
            f.write(token + "\n")
        return f"id-of-{token}"

    def status(self, batch_id):
        self.fails_once(batch_id)
        if batch_id == "lost":
            raise RuntimeError("no such batch")
        return "ended" if batch_id.startswith("done") else "in_progress"

    def results(self, batch_id):
        with open(f"{self.folder}/{batch_id}") as f:
            return iter(f.read().splitlines())


def answer(custom_id, tokens=7, **body):
    said = {"content": [{"type": "text", "text": json.dumps(body)}], "usage": {"input_tokens": tokens, "output_tokens": 2}}
    return json.dumps({"custom_id": custom_id, "result": {"type": "succeeded", "message": said}})


def classified(kind, confidence):
    return {"relationship_type": kind, "direction": "symmetric", "confidence": confidence, "rationale": "why"}


@pytest.fixture
def service(tmp_path):
    folder = str(tmp_path / "service")
    os.makedirs(folder)
    semantics = {"underlying_event": "e", "resolves_yes_when": "y", "resolves_no_when": "n", "resolution_timing": "t", "entities": [" Rain ", None, True, ""], "dependencies": None}
    files = {
        "done-s": [answer("s1", **semantics), answer("s2", entities=[]), answer("unknown", **semantics), "no json", json.dumps({"custom_id": "s3", "result": {"type": "errored"}})],
        "done-p": [answer("p1", **classified("implies", 0.95)), answer("p2", **classified("implies", 0.5)), answer("p3", **classified("implies", 0.99)), answer("p4", **classified("nonsense", 0.9))],
        "done-v": [answer("v1", **classified("correlated", 0.9))],
    }
    for name, lines in files.items():
        with open(f"{folder}/{name}", "w") as f:
            f.write("\n".join(lines))
    return f"tests.test_cycle:Service:{folder}", folder


def tables(spark, root):
    have = Tables(spark, str(root))
    first = {"relationship_type": "implies", "direction": "symmetric", "confidence": 0.9, "rationale": "r"}
    rows = [
        ("done-s", "semantics", {"s1": "A", "s2": "B", "s3": "C"}, 1), ("done-p", "primary", {f"p{k}": json.dumps(x) for k, x in enumerate((["A", "B"], ["A", "C"], ["B", "GONE"], ["B", "C"]), 1)}, 1),
        ("done-v", "verify", {"v1": json.dumps({"pair": ["C", "D"], "primary": first, "primary_model": "m1"})}, 1), ("open", "primary", {"o1": json.dumps(["X", "Y"])}, 1), ("lost", "primary", {"l1": json.dumps(["X", "Z"])}, 72),
    ]
    batches = [(i, "provider", purpose, "m1", 1, len(c), NOW - dt.timedelta(hours=h), json.dumps(c)) for i, purpose, c, h in rows]
    have.replace("llm_batches", spark.createDataFrame(batches, have.read("llm_batches").schema))
    old = ("venue", "A", "C", "unrelated", "none", 0.2, "review", "single", "r", "m0", None, 1, NOW, "{}", "approved", NOW, "someone")
    have.replace("market_edges", spark.createDataFrame([old], have.read("market_edges").schema))
    return have


def run(spark, have, service, step=lambda name: None, minutes=0):
    live = spark.createDataFrame([("A",), ("B",), ("C",)], "market_id string")
    about = spark.createDataFrame([("A", "about a")], "market_id string, description string")
    now = F.lit(NOW + dt.timedelta(minutes=minutes)).cast("timestamp_ntz")
    return cycle.reconcile(have, service, live, about, "m2", now, Params(), step)


def state(have):
    drop = {"market_semantics": ["extracted_at"], "market_edges": ["classified_at"], "llm_batches": ["submitted_at"]}
    return {n: sorted(map(str, have.read(n).drop(*c).collect())) for n, c in drop.items()}


def test_a_cycle(spark, service, tmp_path):
    name, folder = service
    have = tables(spark, tmp_path / "t")
    used = {r.purpose: (r.calls, r.tokens_in, r.tokens_out) for r in run(spark, have, name).collect()}
    assert used == {"semantics": (3, 21, 6), "primary": (4, 28, 8), "verify": (1, 7, 2)}
    (s,) = have.read("market_semantics").collect()
    assert (s.market_id, s.underlying_event, json.loads(s.entities), json.loads(s.dependencies)) == ("A", "e", ["Rain", "None", "True"], [])
    edges = {(r.market_id_a, r.market_id_b): (r.relationship_type, r.trust_tier, r.agreement_status, r.verify_model, r.review_status) for r in have.read("market_edges").collect()}
    assert edges == {
        ("A", "C"): ("implies", "review", "single", None, "approved"), ("B", "GONE"): ("implies", "soft", "single", None, "pending"), ("C", "D"): ("implies", "review", "disagreed", "m1", "pending"),
    }
    left = {r.batch_id: (r.purpose, r.request_count) for r in have.read("llm_batches").collect()}
    assert left == {"open": ("primary", 1), "id-of-verify-of-done-p": ("verify", 1)}  # the lost batch is past its age
    with open(f"{folder}/sent-verify-of-done-p") as f:
        (sent,) = json.load(f)
    assert sent["model"] == "m2" and "about a" in sent["prompt"] and "\nB\n" in sent["prompt"]


def test_a_cycle_that_dies_is_run_again(spark, service, tmp_path):
    name, folder = service
    whole = tables(spark, tmp_path / "whole")
    run(spark, whole, name)
    have, places = tables(spark, tmp_path / "t"), ["semantics", "edges", "submit", "batches", "delete"]
    for k, where in enumerate(places):  # it dies once at each place, later each time

        def dies(step, where=where):
            if step == where:
                raise KeyboardInterrupt

        with pytest.raises(KeyboardInterrupt):
            run(spark, have, name, dies, minutes=k)
        assert {"done-s", "done-p", "done-v"} <= {r.batch_id for r in have.read("llm_batches").collect()}  # nothing is lost
    run(spark, have, name, minutes=9)
    assert state(have) == state(whole)
    with open(f"{folder}/calls") as f:
        assert set(f) == {"verify-of-done-p\n"}  # one token, so one batch


def test_too_large_a_batch_and_half_a_version(spark, service, tmp_path):
    asked = spark.createDataFrame([("t", "primary", f"r{k}", "c", "m", "p") for k in range(4)], "token string, purpose string, custom_id string, context string, model string, prompt string")
    at = F.lit(NOW).cast("timestamp_ntz")
    with pytest.raises(Exception, match="at most 3"):
        cycle.submitted(asked, service[0], at, Params(batch_cap=3)).collect()
    (row,) = cycle.submitted(asked, service[0], at).collect()
    assert (row.batch_id, row.request_count, json.loads(row.payload)) == ("id-of-t", 4, {f"r{k}": "c" for k in range(4)})
    have = tables(spark, tmp_path / "t")
    before = have.versions("llm_batches")
    half = tmp_path / f"t/llm_batches/v{before[-1] + 1}"
    half.mkdir()
    (half / "part-0.parquet").write_text("not complete")
    assert have.versions("llm_batches") == before and have.read("llm_batches").count() == 5
    for _ in range(3):
        have.replace("llm_batches", have.read("llm_batches").where("batch_id <> 'open'"))
    assert len(have.versions("llm_batches")) == 2 and have.read("llm_batches").count() == 4 and have.read("market_semantics").count() == 0
