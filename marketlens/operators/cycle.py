"""The cycle of model calls by batch: submit, poll, take over results, all so that a cycle that dies half way can be run again.

Every write is an upsert by key, and a batch leaves llm_batches only after all that follows from it is written; so a cycle that is
run again after a failure at any place gives the same tables. A batch is submitted under a token that follows from what it is
about; the service gives one batch for one token, so a submission that was sent but not noted is found again and not paid twice.
"""

from __future__ import annotations

import importlib
import json
from collections.abc import Callable, Iterator
from typing import Protocol

import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..params import DEFAULT, Params
from ..schemas import KEYS
from ..sources.paged import TokenBucket, retried
from ..sources.stage import staged
from ..sources.versions import Tables
from . import edges, extraction, tables


class BatchService(Protocol):
    """A provider's batches. A factory, module:name or module:name:argument, makes it in the tasks; it raises paged.Temporary for
    what may be repeated."""

    def submit(self, token: str, requests: list[dict]) -> str:
        """The id of the batch of custom_id, model and prompt of each request; the same for the same token."""

    def status(self, batch_id: str) -> str: ...

    def results(self, batch_id: str) -> Iterator[str]:
        """The result lines of an ended batch."""


def service_of(name: str) -> BatchService:
    module, factory, *argument = name.split(":", 2)
    return getattr(importlib.import_module(module), factory)(*argument)


def submitted(asked: DataFrame, service: str, now: Column, p: Params = DEFAULT, tries: int = 5) -> DataFrame:
    """llm_batches rows of the requests (token, purpose, custom_id, context, model, prompt), one batch for each token. A batch has at
    most `batch_cap` requests; more are an error."""

    def send(key: tuple, rows: pd.DataFrame) -> pd.DataFrame:
        if len(rows) > p.batch_cap:
            raise ValueError(f"{len(rows)} requests of {key[0]}: a batch has at most {p.batch_cap}")
        rows = rows.sort_values("custom_id")
        requests = rows[["custom_id", "model", "prompt"]].to_dict("records")
        batch_id = retried(lambda: service_of(service).submit(key[0], requests), tries)
        context = json.dumps(dict(zip(rows["custom_id"], rows["context"], strict=True)))
        return pd.DataFrame({"batch_id": [batch_id], "purpose": rows["purpose"][:1].tolist(), "model": rows["model"][:1].tolist(), "request_count": [len(rows)], "payload": [context]})

    sent = asked.groupBy("token").applyInPandas(send, "batch_id string, purpose string, model string, request_count int, payload string")
    return sent.select("batch_id", F.lit("provider").alias("provider"), "purpose", "model", F.lit(p.prompt_version).alias("extraction_version"), "request_count", now.cast("timestamp_ntz").alias("submitted_at"), "payload")


def polled(batches: DataFrame, service: str, per_second: float = 2.0, tries: int = 5) -> DataFrame:
    """batch_id, status of open batches (few, so one task asks for all, at a rate); null where the call fails."""

    def ask(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        client, bucket = service_of(service), TokenBucket(per_second, 1)
        for part in parts:
            said = []
            for batch_id in part["batch_id"]:
                bucket.take()
                try:
                    said.append(retried(lambda batch_id=batch_id: client.status(batch_id), tries))
                except Exception:  # noqa: BLE001 - asked again in the next cycle
                    said.append(None)
            yield pd.DataFrame({"batch_id": part["batch_id"], "status": said})

    return batches.select("batch_id").repartition(1).mapInPandas(ask, "batch_id string, status string")


def result_lines(ended: DataFrame, service: str, tries: int = 5) -> DataFrame:
    """batch_id, value of the result lines of ended batches; a task for each batch at most. Lines are handed on as they come, so a
    batch is read again from the start only if its task is."""

    def fetch(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        client = service_of(service)
        for part in parts:
            for batch_id in part.column("batch_id").to_pylist():
                lines = retried(lambda batch_id=batch_id: list(client.results(batch_id)), tries)  # within the cap
                yield pa.RecordBatch.from_arrays([pa.array([batch_id] * len(lines), pa.string()), pa.array(lines, pa.string())], ["batch_id", "value"])

    return ended.select("batch_id").repartition(F.col("batch_id")).mapInArrow(fetch, "batch_id string, value string")


def usage_rows(lines: DataFrame, batches: DataFrame) -> DataFrame:
    """mode, purpose, model, input_tokens, output_tokens of each result line that says them."""
    v = F.try_parse_json("value")
    n = lambda name: F.try_variant_get(v, f"$.result.message.usage.{name}", "bigint").alias(name)
    rows = lines.select("batch_id", n("input_tokens"), n("output_tokens")).where("input_tokens is not null or output_tokens is not null")
    return rows.join(batches.select("batch_id", "purpose", "model"), "batch_id").select(F.lit("batch").alias("mode"), "purpose", "model", "input_tokens", "output_tokens")


def classification_prompt(a: Column, b: Column) -> Column:
    """The question about a pair, of two descriptions."""
    return F.concat(F.lit("Market A\n"), a, F.lit("\n\nMarket B\n"), b, F.lit("\n\nHow do the outcomes of A (first) and B (second) relate?"))


def verify_requests(second: DataFrame, about: DataFrame, model: str, p: Params = DEFAULT) -> DataFrame:
    """Requests for a second opinion on first answers (batch_id, a, b, the classification, model), a batch for each batch that they
    come from; about has market_id and description."""
    said = lambda end: about.select(F.col("market_id").alias(end), F.col("description").alias(f"about_{end}"))
    rows = second.join(said("a"), "a", "left").join(said("b"), "b", "left")
    ask = classification_prompt(F.coalesce("about_a", "a"), F.coalesce("about_b", "b"))
    return rows.select(
        F.concat(F.lit("verify-of-"), "batch_id").alias("token"), F.lit("verify").alias("purpose"), F.concat(F.lit("v"), F.sha2(F.concat_ws("\x1f", "a", "b"), 256).substr(1, 24)).alias("custom_id"),
        extraction.verify_context().alias("context"), F.lit(model).alias("model"), ask.alias("prompt"),
    )


def reconcile(have: Tables, service: str, live: DataFrame, about: DataFrame, verify_model: str, now: Column, p: Params = DEFAULT, step: Callable[[str], None] = lambda name: None) -> DataFrame:
    """One cycle over the open batches. Results of ended ones become rows of market_semantics and market_edges; confident first
    answers on live markets (market_id) are sent for a second opinion; then ended batches, and abandoned ones, leave llm_batches.
    Returns the tokens used. `step` is told the name of each write before it is made."""
    batches = staged(have.read("llm_batches"), "batches")
    outcomes = staged(extraction.settled(batches, polled(batches, service), now, p), "outcomes")
    ended = batches.join(outcomes.where("outcome = 'written'"), "batch_id", "left_semi")
    lines = staged(result_lines(ended, service), "lines")
    parsed = edges.batch_results(lines, "batch_id")
    answers = {purpose: staged(extraction.answered(batches, parsed, outcomes, purpose), purpose) for purpose in ("semantics", "primary", "verify")}
    at = now.cast("timestamp_ntz")
    stamped = lambda rows: rows.withColumns({"platform": F.lit(p.platform), "extraction_version": F.lit(p.prompt_version)})

    texts = ("entities", "dependencies")
    found = stamped(extraction.semantics_rows(answers["semantics"])).withColumns({t: F.to_json(t) for t in texts} | {"extracted_at": at})
    step("semantics")
    have.replace("market_semantics", tables.upsert(have.read("market_semantics"), found, KEYS["market_semantics"]))

    single, second = extraction.primary_rows(answers["primary"], live, p)
    second = staged(second, "second")
    new = stamped(single.unionByName(extraction.verify_rows(answers["verify"]))).withColumn("classified_at", at)
    step("edges")
    have.replace("market_edges", tables.upsert(have.read("market_edges"), new, KEYS["market_edges"], ("review_status", "reviewed_at", "reviewed_by"), {"review_status": "pending"}))

    step("submit")
    sent = staged(submitted(verify_requests(second, about, verify_model, p), service, now, p), "sent")
    step("batches")
    noted = have.read("llm_batches")
    have.replace("llm_batches", noted.unionByName(sent.join(noted.select("batch_id"), "batch_id", "left_anti").select(*noted.columns)))
    step("delete")
    have.replace("llm_batches", have.read("llm_batches").join(outcomes.where("outcome <> 'open'"), "batch_id", "left_anti"))
    return edges.usage(usage_rows(lines, batches).withColumns({n: F.lit(None).cast("bigint") for n in ("prompt_tokens", "completion_tokens")}))
