"""Completions to typed edges with a trust tier; work queues and batches."""

from __future__ import annotations

from collections.abc import Iterator
from typing import Protocol

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.scalars import clamp_unit, once, one_object, python_text, strip, strip_fence, tier
from ..params import DEFAULT, DIRECTIONS, RELATIONS, Params
from ..sources.stage import BROADCAST_BYTES, BROADCAST_ROWS, staged
from .pairs import same_pair


def _parsed(rows: DataFrame) -> DataFrame:
    return rows.withColumn("_t", strip_fence(F.col("content"))).withColumn("_v", one_object(F.col("_t")))


def _said(path: str) -> Column:
    """A value as text; a missing one is null."""
    return once(F.try_variant_get(F.col("_v"), path, "variant"), lambda value: F.when(value.isNotNull(), python_text(value)))


def _few_texts(rows: DataFrame) -> DataFrame | None:
    """The distinct contents of the rows, if they are few enough to be broadcast. To find them costs little beside parsing."""
    if rows.isStreaming:
        return None
    texts = staged(rows.select("content").distinct(), "texts")
    n, size = texts.agg(F.count(F.lit(1)), F.coalesce(F.sum(F.octet_length("content")), F.lit(0))).first()
    return texts if n <= BROADCAST_ROWS and size <= BROADCAST_BYTES else None


def parse_classification(rows: DataFrame) -> DataFrame:
    """The columns with relationship_type, direction, confidence, rationale and error (null where the completion is valid).
    Names must be exact but for white space around them. Equal completions are parsed once, as long as the different ones are few."""
    texts = _few_texts(rows)
    if texts is None:
        return _classifications(rows)
    said = F.broadcast(_classifications(texts).withColumnRenamed("content", "_content"))
    return rows.join(said, F.col("content").eqNullSafe(F.col("_content")), "left").drop("_content")


def _classifications(rows: DataFrame) -> DataFrame:
    v = F.col("_v")
    sure = F.col("_sure")
    said = _parsed(rows).withColumns({"_kind": strip(_said("$.relationship_type")), "_way": strip(_said("$.direction")), "_sure": F.try_variant_get(v, "$.confidence", "string"), "_why": _said("$.rationale")})
    way = F.coalesce(F.nullif(F.col("_way"), F.lit("")), F.lit("none"))
    confidence = clamp_unit(F.when(sure == "true", 1.0).when(sure == "false", 0.0).otherwise(sure.try_cast("double")))
    read = said.select(*rows.columns, v.isNull().alias("_none"), "_kind", way.alias("_way"), confidence.alias("_confidence"), F.coalesce("_why", F.lit("")).alias("_why"))
    kind, way, confidence = F.col("_kind"), F.col("_way"), F.col("_confidence")
    error = F.when(F.col("_none"), "not an object").when(~F.coalesce(kind.isin(*RELATIONS), F.lit(False)), "relation").when(~way.isin(*DIRECTIONS), "direction").when(confidence.isNull(), "confidence")
    out = read.withColumn("error", error)
    ok = F.col("error").isNull()
    return out.select(*rows.columns, F.when(ok, kind).alias("relationship_type"), F.when(ok, way).alias("direction"), F.when(ok, confidence).alias("confidence"), F.when(ok, F.col("_why")).alias("rationale"), "error")


def parse_semantics(rows: DataFrame) -> DataFrame:
    """The columns with the four texts, which must be there, entities, dependencies (arrays of trimmed non-empty strings, other
    items as text; a missing one is empty, one that is no array an error) and error."""
    texts, arrays = ("underlying_event", "resolves_yes_when", "resolves_no_when", "resolution_timing"), ("entities", "dependencies")
    none = F.array().cast("array<string>")
    items = lambda value: F.when(value.isNull() | F.is_variant_null(value), none).otherwise(F.transform(F.try_variant_get(value, "$", "array<variant>"), lambda x: python_text(x)))
    said = _parsed(rows).withColumns({f"_{n}": _said(f"$.{n}") for n in texts} | {f"_{n}": once(F.try_variant_get(F.col("_v"), f"$.{n}", "variant"), items) for n in arrays})
    error = F.when(F.col("_v").isNull(), "not an object")
    for n in (*texts, *arrays):
        error = F.coalesce(error, F.when(F.col(f"_{n}").isNull(), n))
    out = said.withColumn("error", error)
    ok = F.col("error").isNull()
    clean = lambda a: F.filter(F.transform(a, lambda x: strip(x)), lambda x: x != "")
    return out.select(*rows.columns, *(F.when(ok, F.col(f"_{n}")).alias(n) for n in texts), *(F.when(ok, clean(F.col(f"_{n}"))).alias(n) for n in arrays), "error")


def trust(primary: DataFrame, verify: DataFrame, live: DataFrame | None = None, p: Params = DEFAULT) -> DataFrame:
    """Edges a, b with trust_tier, agreement_status and verify_model. A confident primary result is trusted if the second
    model's agrees on the type; a disagreement is for review; without a second result it is soft. With `live` (market_id), a
    pair with an end that is no longer active is soft without verification."""
    on, second = same_pair(primary, verify.where("error is null"))
    second = second.select(*on, F.col("relationship_type").alias("v_type"), F.col("model").alias("v_model"))
    rows = primary.where("error is null").join(second, on, "left")
    checked = F.col("v_type").isNotNull()
    if live is not None:
        ends = live.select("market_id").distinct()
        rows = rows.join(ends.select(F.col("market_id").alias("a"), F.lit(True).alias("la")), "a", "left").join(ends.select(F.col("market_id").alias("b"), F.lit(True).alias("lb")), "b", "left")
        checked = checked & F.col("la").isNotNull() & F.col("lb").isNotNull()
    sure = F.col("confidence") >= p.trusted
    agrees = F.col("relationship_type") == F.col("v_type")
    way = F.when(F.col("direction") == "first_implies_second", "a_implies_b").when(F.col("direction") == "second_implies_first", "b_implies_a").otherwise(F.col("direction"))
    return rows.select(
        *on, "relationship_type", way.alias("direction"), "confidence",
        F.when(sure & checked & agrees, "trusted").when(sure & checked, "review").when(sure, "soft").otherwise(tier(F.col("confidence"), p)).alias("trust_tier"),
        F.when(sure & checked & agrees, "agreed").when(sure & checked, "disagreed").otherwise("single").alias("agreement_status"),
        F.when(sure & checked, F.col("v_model")).alias("verify_model"),
    )


def missing_semantics(markets: DataFrame, semantics: DataFrame, version: int) -> DataFrame:
    """Active markets without semantics of this version. Both are as large as the catalog, so neither is broadcast."""
    known = semantics.where(F.col("extraction_version") == version).select("market_id")
    return markets.where("subscribed").join(known.hint("merge"), "market_id", "left_anti")


def with_semantics(markets: DataFrame, semantics: DataFrame) -> DataFrame:
    return markets.where("subscribed").join(semantics.select("market_id", "entities", "extraction_version"), "market_id")


def review_queue(edges: DataFrame) -> DataFrame:
    return edges.where("trust_tier = 'review' and review_status = 'pending'").orderBy(F.desc_nulls_last("confidence"), "market_id_a", "market_id_b")


def batch_results(lines: DataFrame, *keep: str) -> DataFrame:
    """custom_id, content, error of the JSON lines (column value) of a batch, and the columns to keep; bad lines are dropped."""
    v = F.try_parse_json("value")
    block = F.get(F.filter(F.try_variant_get(v, "$.result.message.content", "array<variant>"), lambda b: F.try_variant_get(b, "$.type", "string") == "text"), F.lit(0))
    text = F.when(F.try_variant_get(v, "$.result.type", "string") == "succeeded", F.try_variant_get(block, "$.text", "string"))
    rows = lines.select(*keep, F.try_variant_get(v, "$.custom_id", "string").alias("custom_id"), text.alias("content"), F.coalesce(F.try_variant_get(v, "$.result.type", "string"), F.lit("unknown")).alias("kind"))
    return rows.where("custom_id is not null").select(*keep, "custom_id", "content", F.when(F.col("content").isNull(), F.when(F.col("kind") == "succeeded", "no text").otherwise(F.col("kind"))).alias("error"))


def in_flight(batches: DataFrame, purpose: str) -> DataFrame:
    """custom_id, context of every request of the open batches of a purpose."""
    rows = batches.where(F.col("purpose") == purpose).select("batch_id", F.explode(F.from_json("payload", "map<string,string>")))
    return rows.select("batch_id", F.col("key").alias("custom_id"), F.col("value").alias("context"))


def stale_batches(batches: DataFrame, now: Column, p: Params = DEFAULT) -> DataFrame:
    age = F.unix_micros(now.cast("timestamp")) - F.unix_micros(F.col("submitted_at").cast("timestamp"))
    return batches.where(age > p.batch_max_age_seconds * 1_000_000)


def usage(rows: DataFrame) -> DataFrame:
    """Tokens by mode, purpose and model, whatever the provider calls them."""
    n = lambda *names: F.coalesce(*(F.col(x) for x in names), F.lit(0))
    return rows.groupBy("mode", "purpose", "model").agg(F.count(F.lit(1)).alias("calls"), F.sum(n("prompt_tokens", "input_tokens")).alias("tokens_in"), F.sum(n("completion_tokens", "output_tokens")).alias("tokens_out"))


class CompletionProvider(Protocol):
    """A model service: prompts to texts. It may be pickled; it raises for a failed item."""

    def complete(self, prompt: str) -> str: ...


def complete(requests: DataFrame, provider: CompletionProvider) -> DataFrame:
    """custom_id, content, error of the requests (custom_id, prompt); a failed item gives an error row."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            rows = []
            for custom_id, prompt in zip(batch["custom_id"], batch["prompt"], strict=True):
                try:
                    rows.append((custom_id, provider.complete(prompt), None))
                except Exception as e:  # noqa: BLE001 - a provider's failures are data
                    rows.append((custom_id, None, f"{type(e).__name__}: {e}"))
            yield pd.DataFrame(rows, columns=["custom_id", "content", "error"])

    return requests.select("custom_id", "prompt").mapInPandas(run, "custom_id string, content string, error string")
