"""Series to track from nested catalog documents, and the active markets of the tracked series."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.scalars import best_volume, falsy_coalesce, label, parse_time, title, truthy
from ..params import DEFAULT, Params


#: What may tell a market from the others of its event, in this order.
STRIKES = ("cap_strike", "floor_strike", "strike", "expiration_value")


def series_stats(events: DataFrame, p: Params = DEFAULT) -> DataFrame:
    """Per series: n_events, n_partition_events, n_hierarchy_events, volume_24h, of tradeable markets only, and first_seen, the
    least ordinal of its events."""
    live = F.filter("markets", lambda m: m["status"] == "active")
    labels = F.filter(F.transform(live, lambda m: label(m["yes_sub_title"], m["subtitle"], **{k: m[k] for k in STRIKES})), lambda x: x.isNotNull())
    volume = F.aggregate(F.transform(live, lambda m: best_volume(m["volume_fp"], m["volume"], m["volume_24h_fp"])), F.lit(0.0), lambda a, x: a + x)
    per_event = events.where("series_ticker is not null and series_ticker <> ''").select("series_ticker", "ordinal", F.coalesce("mutually_exclusive", F.lit(False)).alias("mutex"), F.size(F.coalesce(live, F.array())).alias("n"), F.size(F.array_distinct(labels)).alias("n_distinct"), volume.alias("volume"))
    return per_event.groupBy("series_ticker").agg(
        F.count(F.lit(1)).alias("n_events"),
        F.count_if(F.col("mutex") & (F.col("n") >= p.partition_min_markets)).cast("int").alias("n_partition_events"),
        F.count_if(F.col("n_distinct") >= p.hierarchy_min_markets).cast("int").alias("n_hierarchy_events"),
        F.coalesce(F.sum("volume"), F.lit(0.0)).alias("volume_24h"),
        F.min("ordinal").alias("first_seen"),
    )


def verdicts(stats: DataFrame, p: Params = DEFAULT) -> DataFrame:
    """stats with passes_p1..p3, admit and the reason."""
    p1, p2, p3 = F.col("n_partition_events") >= 1, F.col("n_hierarchy_events") >= 1, F.col("volume_24h") >= p.min_series_volume
    failed = F.filter(F.array(*(F.when(~c, n) for c, n in ((p1, "P1"), (p2, "P2"), (p3, "P3")))), lambda x: x.isNotNull())
    admit = (p1 | p2) & p3
    reason = F.concat(F.when(admit, "admit").otherwise("reject"), F.when(F.size(failed) > 0, F.concat(F.lit(" (failed: "), F.array_join(failed, ","), F.lit(")"))).otherwise(""))
    return stats.select("*", p1.alias("passes_p1"), p2.alias("passes_p2"), p3.alias("passes_p3"), admit.alias("admit"), reason.alias("reason"))


def admitted(judged: DataFrame, p: Params = DEFAULT) -> DataFrame:
    """Series to track. A list of prefixes, where given, takes the place of the rules and of the cap."""
    if p.allowlist:
        allowed: Column = F.lit(False)
        for prefix in p.allowlist:
            allowed = allowed | F.startswith("series_ticker", F.lit(prefix))
        return ranked(judged.where(allowed))
    return ranked(judged.where("admit")).where(F.col("rank_position") <= p.max_tracked)


def ranked(series: DataFrame) -> DataFrame:
    """rank_position by the ordinal rules; ties by the order in which series were seen. Series are few (a catalog's)."""
    order = Window.orderBy(F.desc("passes_p1"), F.desc("n_partition_events"), F.desc("n_hierarchy_events"), F.desc("volume_24h"), F.asc("first_seen"))
    return series.withColumn("rank_position", F.row_number().over(order))


def active_markets(markets: DataFrame, tracked: DataFrame, p: Params = DEFAULT) -> DataFrame:
    """market_id, volume of the active markets of tracked series above the floor, the largest up to the cap."""
    rows = markets.join(F.broadcast(tracked.select("series_ticker")) if p.max_tracked <= 10_000 and not p.allowlist else tracked.select("series_ticker"), "series_ticker", "left_semi")
    rows = rows.where("status = 'active'").withColumn("volume", best_volume(F.col("volume_fp"), F.col("volume_text"), F.col("volume_24h_fp"))).where(F.col("volume") >= p.min_market_volume).where("market_id is not null")
    return rows.orderBy(F.desc("volume"), "ordinal").limit(p.max_active).select("market_id", "series_ticker", "volume")


def rejected(judged: DataFrame, n: int = 15) -> DataFrame:
    """The n rejected series of most volume, for inspection."""
    return judged.where("not admit").orderBy(F.desc("volume_24h"), "first_seen").limit(n)


def catalog_rows(events: DataFrame, now: Column, platform: str = DEFAULT.platform) -> DataFrame:
    """Rows of the markets table from JSON documents of events (column doc) with nested markets."""
    m, e = (lambda k: F.try_variant_get("m", f"$.{k}", "string")), (lambda k: F.try_variant_get("e", f"$.{k}", "string"))
    time = lambda *keys: parse_time(truthy(F.col("m"), *(f"$.{k}" for k in keys))).cast("timestamp_ntz")
    rows = events.select(F.try_parse_json("doc").alias("e")).select("e", F.explode(F.try_variant_get("e", "$.markets", "array<variant>")).alias("m"))
    either = lambda first, second: falsy_coalesce(first, second)
    return rows.select(
        m("ticker").alias("market_id"), F.lit(platform).alias("platform"), title(either(m("title"), e("title")), m("ticker"), either(m("yes_sub_title"), m("subtitle"))).alias("title"),
        m("rules_primary").alias("description"), either(m("rules_secondary"), m("rules_primary")).alias("resolution_criteria"),
        either(e("series_ticker"), m("series_ticker")).alias("series_ticker"), either(m("event_ticker"), e("event_ticker")).alias("event_ticker"),
        time("open_time", "created_time").alias("created_at"), time("close_time").alias("closes_at"), time("settlement_ts", "expiration_time").alias("resolved_at"),
        m("status").alias("status"), F.to_json("m").alias("raw_metadata"), now.alias("last_seen_ts"),
    )


def volume_distribution(volumes: DataFrame, bins: int = 4096) -> DataFrame:
    """n, p50, p90, p99 (at the 0-based place floor(p * n), at most n - 1), max and counts below 1, 10, 100, 1000. Rows are
    counted by bin of value first; only the bins that hold a place are looked into, so no task sorts the rest."""
    volume = F.col("volume")
    # Bins of equal ratio keep the order of values, whatever their range.
    bin_of = F.when(volume <= 0, F.lit(-1)).otherwise(F.least(F.lit(bins), F.greatest(F.lit(0), F.floor((F.log2(volume) + 20) * (bins // 64)))))
    counted = volumes.withColumn("bin", bin_of).groupBy("bin").agg(F.count(F.lit(1)).alias("c"), F.max("volume").alias("max"), *(F.count_if(volume < b).alias(f"below_{b}") for b in (1, 10, 100, 1000)))
    total = counted.agg(F.coalesce(F.sum("c"), F.lit(0)).alias("n"), F.max("max").alias("max"), *(F.coalesce(F.sum(f"below_{b}"), F.lit(0)).alias(f"below_{b}") for b in (1, 10, 100, 1000)))
    upto = counted.select("bin", "c", F.sum("c").over(Window.orderBy("bin")).alias("upto"))  # of `bins` rows at most
    places = total.select(F.explode(F.array(*(F.struct(F.lit(name).alias("p"), F.least(F.col("n") - 1, F.floor(F.lit(q) * F.col("n"))).alias("at")) for name, q in (("p50", 0.5), ("p90", 0.9), ("p99", 0.99))))).alias("x")).select("x.*")
    held = places.crossJoin(upto).where((F.col("at") < F.col("upto")) & (F.col("at") >= F.col("upto") - F.col("c"))).select("p", "bin", (F.col("at") - F.col("upto") + F.col("c")).alias("at"))
    inside = volumes.withColumn("bin", bin_of).join(F.broadcast(held), "bin").groupBy("p", "at", "volume").agg(F.count(F.lit(1)).alias("c"))
    so_far = inside.withColumn("upto", F.sum("c").over(Window.partitionBy("p").orderBy("volume")))
    picks = so_far.where("upto > at").agg(*(F.min(F.when(F.col("p") == name, F.col("volume"))).alias(name) for name in ("p50", "p90", "p99")))
    return total.crossJoin(picks)  # of one row each
