"""Rolling windows of time series, and the life of the graph."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.scalars import parse_time, resolved_at


def prune(rows: DataFrame, ts: str, cutoff: Column) -> DataFrame:
    """Without rows before the cutoff; rows without a time stay."""
    return rows.where(F.col(ts).isNull() | (F.col(ts) >= cutoff))


def prune_counts(rows: DataFrame, ts: str, cutoff: Column) -> DataFrame:
    gone = F.coalesce(F.col(ts) < cutoff, F.lit(False))
    return rows.agg(F.count_if(gone).alias("deleted"), F.count_if(~gone).alias("kept"))


def pending_resolution(markets: DataFrame, semantics: DataFrame, edges: DataFrame, limit: int) -> DataFrame:
    """Unresolved, unsubscribed markets of the graph, in order of id."""
    ids = semantics.select("market_id").union(edges.select("market_id_a")).union(edges.select("market_id_b")).distinct()
    return markets.where("not subscribed and resolved_at is null").join(ids, "market_id", "left_semi").select("market_id").orderBy("market_id").limit(limit)


def mark_resolved(markets: DataFrame, found: DataFrame) -> DataFrame:
    """resolved_at of the markets found (market_id, resolved_at, ordinal), where they have none; of several the first."""
    first = found.groupBy("market_id").agg(F.min_by("resolved_at", "ordinal").alias("_new"))
    return markets.join(first, "market_id", "left").withColumn("resolved_at", F.coalesce("resolved_at", "_new")).select(*markets.columns)


def prune_graph(semantics: DataFrame, edges: DataFrame, markets: DataFrame, cutoff: Column) -> tuple[DataFrame, DataFrame]:
    """Semantics and edges without those of markets resolved before the cutoff; an edge goes with either end."""
    done = markets.where(F.col("resolved_at") < cutoff).select("market_id")
    ends = lambda name: done.select(F.col("market_id").alias(name))
    return semantics.join(done, "market_id", "left_anti"), edges.join(ends("market_id_a"), "market_id_a", "left_anti").join(ends("market_id_b"), "market_id_b", "left_anti").select(*edges.columns)


def resolution_times(docs: DataFrame, now: Column) -> DataFrame:
    """market_id, resolved_at of the looked-up markets (key, doc as JSON) that are resolved; misses and open ones give none."""
    v = lambda name: F.get_json_object("doc", f"$.{name}")
    at = resolved_at(v("result"), v("status"), parse_time(v("settlement_ts")), parse_time(v("close_time")), now.cast("timestamp")).cast("timestamp_ntz")
    return docs.select(F.col("key").alias("market_id"), at.alias("resolved_at")).where("resolved_at is not null")


def reconcile_resolutions(markets: DataFrame, semantics: DataFrame, edges: DataFrame, lookup: DataFrame, now: Column, limit: int) -> DataFrame:
    """markets with resolved_at of the pending ones of the graph, as many as the limit, that the lookup (key, doc) finds resolved."""
    pending = pending_resolution(markets, semantics, edges, limit)
    found = resolution_times(lookup, now).join(pending, "market_id", "left_semi")
    return mark_resolved(markets, found.withColumn("ordinal", F.lit(0)))


def graph_counts(before: tuple[DataFrame, DataFrame], after: tuple[DataFrame, DataFrame]) -> DataFrame:
    """kind, deleted, kept of semantics and edges."""
    n = lambda x, c: x.agg(F.count(F.lit(1)).alias(c))
    each = [n(b, "had").crossJoin(n(a, "kept")).select(F.lit(k).alias("kind"), (F.col("had") - F.col("kept")).alias("deleted"), "kept") for k, b, a in zip(("semantics", "edges"), before, after, strict=True)]
    return each[0].union(each[1])  # of one row each
