"""Books against a second source."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.scalars import audit_verdict, shard
from ..params import DEFAULT, MICRO, Params
from ..sources.stage import staged
from . import replay


def differences(book: DataFrame, other: DataFrame) -> DataFrame:
    """market_id, side, price, size, other_size of all levels of either (market_id, side, price, size)."""
    return book.join(other.withColumnRenamed("size", "other_size"), ["market_id", "side", "price"], "full_outer")


#: Fixed names of the fields of details_json, in order.
DETAILS = ("yes_structural_diff", "no_structural_diff", "max_size_pct", "mem_yes", "rest_yes", "mem_no", "rest_no")


def audit(markets: DataFrame, book: DataFrame, other: DataFrame, p: Params = DEFAULT) -> DataFrame:
    """market_id, status, levels_diff_count, max_size_delta_pct, action_taken for each market to audit, and the levels by side:
    those that only one of both has, and how many each has."""
    m, o = F.col("size") / float(MICRO), F.col("other_size") / float(MICRO)
    gap = F.abs(m - o)
    pct = F.when(gap > 1e-9, gap / F.greatest(m, o, F.lit(1.0)) * 100.0)
    on = lambda side: F.col("side") == side
    alone = F.col("size").isNull() != F.col("other_size").isNull()
    seen = differences(book, other).groupBy("market_id").agg(
        F.max(pct).alias("pct"), *(F.count_if(alone & on(s)).alias(f"{s}_structural_diff") for s in ("yes", "no")),
        *(F.count_if(F.col(c).isNotNull() & on(s)).alias(f"{n}_{s}") for s in ("yes", "no") for n, c in (("mem", "size"), ("rest", "other_size"))),
    )
    rows = markets.select("market_id").distinct().join(seen, "market_id", "left").fillna(0)
    count = F.col("yes_structural_diff") + F.col("no_structural_diff")
    status = audit_verdict(count, F.col("pct"), p)
    return rows.select(
        "market_id", status.alias("status"), count.cast("int").alias("levels_diff_count"), F.round("pct", 4).alias("max_size_delta_pct"), F.when(status == "large_diff", "book_reset").otherwise("none").alias("action_taken"),
        *(F.round("pct", 4).alias(d) if d == "max_size_pct" else F.col(d) for d in DETAILS),
    )


def resets(audited: DataFrame) -> DataFrame:
    return audited.where("action_taken = 'book_reset'").select("market_id")


def audit_rows(audited: DataFrame, at, failed: DataFrame | None = None) -> DataFrame:
    """Rows to append to audit_results, in order of the markets. failed: market_id and err of markets whose second source gave no
    book."""
    time = at.cast("timestamp_ntz").alias("ts")
    rows = audited.select(time, "market_id", "status", "levels_diff_count", "max_size_delta_pct", "action_taken", F.to_json(F.struct(*DETAILS)).alias("details_json"))
    if failed is not None:
        none = lambda kind: F.lit(None).cast(kind)
        said = F.to_json(F.struct(F.coalesce("err", F.lit("")).alias("err")))
        rows = rows.join(failed.select("market_id").distinct(), "market_id", "left_anti").select(*rows.columns).union(failed.select(time, "market_id", F.lit("error"), none("int"), none("double"), F.lit("none"), said))
    return rows.orderBy("market_id")


def feedback(events: DataFrame, second_source: Callable[[Column], DataFrame], times: list[Column], p: Params = DEFAULT) -> tuple[DataFrame, DataFrame]:
    """Audit passes at the times, in order: each compares the books of the events received until then, with the resets that the
    passes before it asked for, with the second source's (market_id, side, price, size) of that time. Returns the verdicts of all
    passes (with ts) and the events with all resets, for the replay."""
    verdicts = None
    for at in times:
        here = events.where(F.col("received_ts") <= at)
        markets = here.select("market_id").distinct()
        if verdicts is not None:
            here = replay.with_resets(here, _reset_events(verdicts))
        book = replay.last_levels(replay.level_changes(replay.accepted(here, p), p))
        found = staged(audit(markets, book, second_source(at), p).withColumn("ts", at.cast("timestamp_ntz")), "verdicts")
        verdicts = found if verdicts is None else verdicts.unionByName(found)
    return verdicts, replay.with_resets(events, _reset_events(verdicts))


def _reset_events(verdicts: DataFrame) -> DataFrame:
    return verdicts.where("action_taken = 'book_reset'").select("market_id", F.col("ts").alias("received_ts"))


def routed_resets(reset: DataFrame, markets: DataFrame, p: Params = DEFAULT) -> DataFrame:
    """shard, market_id of the markets to subscribe anew, by their series; unknown markets are dropped."""
    return reset.select("market_id").distinct().join(markets.select("market_id", shard(F.col("series_ticker"), p).alias("shard")), "market_id").select("shard", "market_id")
