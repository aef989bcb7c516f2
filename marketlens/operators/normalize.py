"""Wire messages and payloads to typed events."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.scalars import parse_time, to_micro, truthy

_LEVELS = "array<struct<price bigint, size bigint>>"


def level_list(doc: Column, *paths: str) -> Column:
    """The pairs (price, size) of the first non-empty list at the paths of a variant; bad elements are skipped one by one."""
    lists = [F.try_variant_get(doc, p, "array<variant>") for p in paths]
    first = F.coalesce(*(F.when(F.size(x) > 0, x) for x in lists), F.array().cast("array<variant>"))
    item = lambda v, k: to_micro(F.try_variant_get(v, f"$[{k}]", "string"))
    pairs = F.transform(first, lambda v: F.struct(item(v, 0).alias("price"), item(v, 1).alias("size")))
    return F.filter(pairs, lambda x: x["price"].isNotNull() & x["size"].isNotNull()).cast(_LEVELS)


def decoded(events: DataFrame) -> DataFrame:
    """The log's rows with typed columns instead of the payload: yes, no (levels), side, price, delta, trade_price,
    no_price, trade_count, taker_side, trade_id, lifecycle, deactivated, result, opens_at, closes_at. What does not parse is null."""
    # The payload is parsed once, in a projection of its own.
    v = F.col("_v")
    get = lambda path: F.try_variant_get(v, path, "string")
    kind = F.col("event_type")
    rows = events.withColumn("_v", F.try_parse_json("payload")).select(
        "market_id", "received_ts", "ingest_seq", "event_type", "sequence",
        F.when(kind == "orderbook_snapshot", level_list(v, "$.yes_dollars_fp", "$.yes")).alias("yes"),
        F.when(kind == "orderbook_snapshot", level_list(v, "$.no_dollars_fp", "$.no")).alias("no"),
        F.when(kind == "orderbook_delta", get("$.side")).alias("side"),
        F.when(kind == "orderbook_delta", to_micro(truthy(v, "$.price_dollars", "$.price"))).alias("price"),
        F.when(kind == "orderbook_delta", to_micro(F.coalesce(get("$.delta_fp"), get("$.delta")))).alias("delta"),
        F.when(kind == "trade", to_micro(get("$.yes_price_dollars"))).alias("trade_price"),
        F.when(kind == "trade", to_micro(get("$.no_price_dollars"))).alias("no_price"),
        F.when(kind == "trade", to_micro(get("$.count_fp"))).alias("trade_count"),
        F.when(kind == "trade", get("$.taker_side")).alias("taker_side"),
        F.when(kind == "trade", get("$.trade_id")).alias("trade_id"),
        F.when(kind == "lifecycle", get("$.event_type")).alias("lifecycle"),
        F.when(kind == "lifecycle", F.try_variant_get(v, "$.is_deactivated", "boolean")).alias("deactivated"),
        F.when(kind == "lifecycle", get("$.result")).alias("result"),
        F.when(kind == "lifecycle", parse_time(get("$.open_ts"))).cast("timestamp_ntz").alias("opens_at"),
        F.when(kind == "lifecycle", parse_time(get("$.close_ts"))).cast("timestamp_ntz").alias("closes_at"),
    )
    return rows


def from_wire(frames: DataFrame) -> DataFrame:
    """raw_events rows of the frames (received_ts, ingest_seq, body) that carry market data. Frames that are no JSON object,
    control frames, unknown types and messages without a ticker give none."""
    v = F.try_parse_json("body")
    get = lambda path: F.try_variant_get(F.col("v"), path, "string")
    kind = F.col("type")
    event_type = F.when(kind.isin("orderbook_snapshot", "orderbook_delta", "trade"), kind).when(kind.isin("market_lifecycle_v2", "market_lifecycle"), "lifecycle")
    # Books have milliseconds, lifecycle events seconds, trades either; 0 is no time.
    at = lambda path, unit: F.timestamp_micros(F.round(F.nullif(get(path).try_cast("double"), F.lit(0.0)) * unit).cast("bigint"))
    millis, seconds = at("$.msg.ts_ms", 1000), at("$.msg.ts", 1_000_000)
    ts = F.when(F.col("event_type") == "lifecycle", seconds).when(F.col("event_type") == "trade", F.coalesce(millis, seconds)).otherwise(millis)
    rows = frames.withColumn("v", v).withColumn("type", get("$.type")).withColumn("event_type", event_type).select(
        ts.cast("timestamp_ntz").alias("ts"), "received_ts", F.lit("venue").alias("platform"), truthy(F.col("v"), "$.msg.market_ticker", "$.msg.market_id").alias("market_id"),
        "event_type", F.try_variant_get(F.col("v"), "$.seq", "bigint").alias("sequence"), F.to_json(F.try_variant_get(F.col("v"), "$.msg", "variant")).alias("payload"), "ingest_seq",
    )
    return rows.where("event_type is not null and market_id is not null and payload is not null")


def fetched_book(docs: DataFrame) -> DataFrame:
    """market_id, side, price, size of order books fetched by key (key, doc): the wrapped book of either name. Missing keys and
    malformed levels give no rows."""
    v = F.try_parse_json("doc")
    sides = [(s, level_list(F.col("v"), f"$.orderbook_fp.{s}_dollars", f"$.orderbook_fp.{s}", f"$.orderbook.{s}_dollars", f"$.orderbook.{s}")) for s in ("yes", "no")]
    named = lambda side: lambda x: F.struct(F.lit(side).alias("side"), x["price"].alias("price"), x["size"].alias("size"))
    tagged = F.concat(*(F.transform(levels, named(side)) for side, levels in sides))
    return docs.withColumn("v", v).select(F.col("key").alias("market_id"), F.explode(tagged).alias("c")).select("market_id", "c.*")
