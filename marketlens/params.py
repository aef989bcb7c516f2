"""Thresholds and intervals of all dataflows."""

from __future__ import annotations

from dataclasses import dataclass

MICRO = 1_000_000


@dataclass(frozen=True)
class Params:
    platform: str = "venue"
    # Grid
    interval_seconds: int = 60
    depth_band: int = 30_000  # micro-dollars
    price_low: int = 10_000
    price_high: int = 990_000
    stale_seconds: int = 3600
    hot_events: int = 20_000_000  # of a market that is cut into blocks
    block_events: int = 5_000_000
    # Audit
    audit_max_levels: int = 4
    audit_max_pct: float = 50.0
    # Discovery and catalog
    partition_min_markets: int = 3
    hierarchy_min_markets: int = 2
    min_series_volume: float = 1000.0
    max_tracked: int = 30
    allowlist: tuple[str, ...] = ()
    min_market_volume: float = 100.0
    max_active: int = 6000
    shards: int = 4
    # Pairs and edges
    entity_overlap_min: int = 3
    same_series: bool = False
    life_floor_seconds: int = 86_400
    batch_threshold_seconds: int = 172_800
    daily_budget: int = 2000
    trusted: float = 0.85
    soft: float = 0.6
    prompt_version: int = 1
    sync_cap: int = 50
    batch_cap: int = 1000
    bulk_threshold: int = 100
    batch_max_age_seconds: int = 172_800
    # Retention
    retention_seconds: int = 3 * 3600
    graph_prune_seconds: int = 3600
    resolution_batch: int = 200


DEFAULT = Params()

#: Fixed values of the data model.
RELATIONS = ("same_event", "implies", "mutually_exclusive", "partition_member", "conditional", "correlated", "unrelated")
DIRECTIONS = ("first_implies_second", "second_implies_first", "symmetric", "none")
TERMINAL = ("determined", "disputed", "amended", "finalized", "settled")
EVENT_TYPES = ("orderbook_snapshot", "orderbook_delta", "trade", "lifecycle")
