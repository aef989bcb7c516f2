"""The given tables read as a market venue's: an event log with JSON payloads, and a catalog."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

NOW = "2024-01-31 00:00:00"


def read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def raw_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """received_ts, ingest_seq, market_id, event_type, sequence, payload (JSON text in dollars and contracts)."""
    e = read(spark, sf_dir, "events").select("event_id", "ts", "user_id", "event_type", F.round(F.col("value") * 100).cast("bigint").alias("q"), F.get_json_object("props", "$.k").cast("bigint").alias("k"))
    by_user = Window.partitionBy("user_id").orderBy("ts", "event_id")
    seq = F.when(F.col("event_id") % 11 == 0, None).when(F.col("event_id") % 7 == 0, F.coalesce(F.lag("event_id", 2).over(by_user), "event_id")).otherwise(F.col("event_id"))
    b = 40 + F.col("k") % 30
    text = lambda n: (n / F.lit(100).cast("decimal(20,0)")).cast("decimal(20,2)").cast("string")
    level = lambda c, n: F.array(text(c), text(n))
    q = F.col("q")
    book = F.to_json(F.struct(
        F.array(level(b, q), level(b - 1, q + 100), level(b - 2, q + 200), level(b - 5, q + 300), level(F.lit(0).cast("bigint"), q)).alias("yes_dollars_fp"),
        F.array(level(98 - b, q), level(97 - b, q + 50), level(95 - b, q + 75), level(F.lit(100).cast("bigint"), q)).alias("no_dollars_fp"),
    ))
    view = F.col("event_type") == "view"
    delta = F.to_json(F.struct(F.when(view, "yes").otherwise("no").alias("side"), text(F.when(view, F.col("k") % 50).otherwise((99 - F.col("k")) % 50)).alias("price_dollars"), text(F.when(F.col("event_id") % 3 == 0, -q).otherwise(q)).alias("delta_fp")))
    trade = F.to_json(F.struct(text(F.col("k")).alias("yes_price_dollars"), text(q).alias("count_fp")))
    kinds = F.array(*map(F.lit, ("activated", "created", "deactivated", "determined", "settled", "close_date_updated")))
    life = F.to_json(F.struct(F.get(kinds, (F.col("k") % 6).cast("int")).alias("event_type")))
    return e.select(
        F.col("ts").cast("timestamp_ntz").alias("received_ts"),
        F.col("event_id").alias("ingest_seq"),
        F.concat(F.lit("M"), F.lpad(F.col("user_id").cast("string"), 6, "0")).alias("market_id"),
        F.when(F.col("event_type") == "signup", "orderbook_snapshot").when(F.col("event_type").isin("view", "click"), "orderbook_delta").when(F.col("event_type") == "purchase", "trade").otherwise("lifecycle").alias("event_type"),
        seq.alias("sequence"),
        F.when(F.col("event_type") == "signup", book).when(F.col("event_type").isin("view", "click"), delta).when(F.col("event_type") == "purchase", trade).otherwise(life).alias("payload"),
    )


def catalog(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Nested events of the catalog: series_ticker, event_ticker, mutually_exclusive, ordinal, markets array<struct>."""
    strike = F.when(F.col("yes_sub_title").isNull(), F.col("size")).alias("cap_strike")
    none = lambda name: F.lit(None).cast("string").alias(name)
    market = F.struct("ordinal", "market_id", "status", "yes_sub_title", "subtitle", strike, none("floor_strike"), none("strike"), none("expiration_value"), "volume_fp", F.col("volume_text").alias("volume"), "volume_24h_fp", "closes_at")
    rows = markets(spark, sf_dir).withColumn("yes_sub_title", F.when(F.col("ordinal") % 7 != 0, F.col("yes_sub_title")))
    return rows.groupBy("series_ticker", "event_ticker", "mutually_exclusive").agg(F.min("ordinal").alias("ordinal"), F.sort_array(F.collect_list(market)).alias("markets"))


def catalog_docs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The catalog as JSON documents of events (column doc). Some markets lack a title, rules or a time, or have an odd one."""
    n, at = F.col("ordinal"), F.date_format("closes_at", "yyyy-MM-dd'T'HH:mm:ss'Z'")
    text = F.when(n % 5 == 0, F.unix_seconds(F.col("closes_at").cast("timestamp")).cast("string")).when(n % 5 == 1, "soon").otherwise(at)
    market = F.struct(
        F.col("market_id").alias("ticker"), F.when(n % 3 != 0, F.concat(F.lit("Will "), "yes_sub_title", F.lit("?"))).alias("title"), F.when(n % 4 != 0, F.col("yes_sub_title")).otherwise(F.lit("")).alias("yes_sub_title"),
        F.when(n % 4 == 0, F.concat(F.lit("No. "), n.cast("string"))).alias("subtitle"), F.when(n % 2 == 0, F.lit("primary")).alias("rules_primary"), F.when(n % 6 == 0, F.lit("secondary")).otherwise(F.lit("")).alias("rules_secondary"), text.alias("close_time"), "status",
    )
    events = markets(spark, sf_dir).groupBy("series_ticker", "event_ticker").agg(F.collect_list(market).alias("markets"))
    return events.select(F.to_json(F.struct("series_ticker", "event_ticker", F.concat(F.lit("Event "), "event_ticker").alias("title"), "markets")).alias("doc"))


def markets(spark: SparkSession, sf_dir: str) -> DataFrame:
    part = read(spark, sf_dir, "part")
    volume = read(spark, sf_dir, "lineitem").groupBy("l_partkey").agg(F.sum(F.col("l_quantity").cast("double")).alias("v"))
    closes = F.timestamp_micros(F.unix_micros(F.to_timestamp(F.lit(NOW))) + (F.col("p_partkey") % 97) * 3_600_000_000).cast("timestamp_ntz")
    words = F.split("p_name", " ")
    return part.join(volume, part.p_partkey == volume.l_partkey, "left").select(
        F.concat(F.lit("P"), F.col("p_partkey").cast("string")).alias("market_id"),
        F.col("p_partkey").alias("ordinal"),
        F.col("p_brand").alias("series_ticker"),
        F.concat_ws("|", "p_brand", "p_type", F.col("p_size").cast("string")).alias("event_ticker"),
        (F.col("p_size") % 2 == 0).alias("mutually_exclusive"),
        F.when(F.col("p_size") % 10 != 0, "active").otherwise("closed").alias("status"),
        F.col("p_name").alias("yes_sub_title"),
        F.lit(None).cast("string").alias("subtitle"),
        F.col("p_size").alias("size"),
        F.when(F.col("p_partkey") % 11 == 0, "n/a").otherwise(F.col("v").cast("string")).alias("volume_fp"),
        F.col("v").cast("string").alias("volume_text"),
        F.lit(None).cast("string").alias("volume_24h_fp"),
        F.when(F.col("p_partkey") % 13 != 0, closes).alias("closes_at"),
        F.array(F.get(words, F.lit(0)), F.get(words, F.lit(1)), F.col("p_brand"), F.col("p_type"), F.concat(F.lit("size"), F.col("p_size").cast("string"))).alias("entities"),
    )
