"""Declared schemas of the tables, in column order."""

from __future__ import annotations

SCHEMAS = {
    "markets": "market_id string, platform string, title string, description string, resolution_criteria string, series_ticker string, event_ticker string, created_at timestamp_ntz, closes_at timestamp_ntz, resolved_at timestamp_ntz, status string, subscribed boolean, raw_metadata string, last_seen_ts timestamp_ntz",
    "raw_events": "ts timestamp_ntz, received_ts timestamp_ntz, platform string, market_id string, event_type string, sequence bigint, payload string, ingest_seq bigint",
    "book_state": "market_id string, last_sequence bigint, last_ts timestamp_ntz, serialized_book string",
    "snapshots": "ts timestamp_ntz, platform string, market_id string, yes_bid double, yes_ask double, yes_mid double, bid_depth double, ask_depth double, bid_levels int, ask_levels int, volume double, last_trade_price double, status string, built_ts timestamp_ntz",
    "audit_results": "ts timestamp_ntz, market_id string, status string, levels_diff_count int, max_size_delta_pct double, action_taken string, details_json string",
    "tracked_series": "series_ticker string, admitted_at timestamp_ntz, last_check_at timestamp_ntz, passes_p1 boolean, passes_p2 boolean, passes_p3 boolean, n_partition_events int, n_hierarchy_events int, volume_24h double, rank_position int",
    "market_semantics": "market_id string, platform string, underlying_event string, resolves_yes_when string, resolves_no_when string, resolution_timing string, entities string, dependencies string, model string, extraction_version int, extracted_at timestamp_ntz, raw_response string",
    "market_edges": "platform string, market_id_a string, market_id_b string, relationship_type string, direction string, confidence double, trust_tier string, agreement_status string, rationale string, model string, verify_model string, extraction_version int, classified_at timestamp_ntz, raw_response string, review_status string, reviewed_at timestamp_ntz, reviewed_by string",
    "llm_batches": "batch_id string, provider string, purpose string, model string, extraction_version int, request_count int, submitted_at timestamp_ntz, payload string",
}

KEYS = {
    "markets": ["market_id"],
    "book_state": ["market_id"],
    "snapshots": ["ts", "platform", "market_id"],
    "tracked_series": ["series_ticker"],
    "market_semantics": ["market_id"],
    "market_edges": ["platform", "market_id_a", "market_id_b"],
    "llm_batches": ["batch_id"],
}
