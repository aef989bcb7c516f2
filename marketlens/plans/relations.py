"""Queries of what edges say about prices, of pairs by vectors, and of tables that a cycle writes."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions.scalars import in_hours, retention_cutoff
from ..operators import coherence, edges, extraction, pairs, retention, similar, tables
from ..schemas import SCHEMAS
from ..sources.adapters import markets, raw_events, read
from ..sources.stage import LARGE_ROWS, staged
from .catalogue import (
    _CP, _ED, _EV, _LM, _MK, _PR, _S, _SM, _SS, _TR, END, _answers, _asked, _descriptions, _edge_ids, _edges, _keyed, _lifecycle_markets, _open_batches, _pair_text, _pairable, _polled, _semantics, _tracked, _trusted, end, query
)

_MID = "CAST((ordinal * 37 % 99 + 1) * 10000 AS BIGINT)"


def _prices(spark, sf_dir):
    return markets(spark, sf_dir).where("status = 'active'").select("market_id", ((F.col("ordinal") * 37 % 99 + 1) * 10_000).alias("mid"))


def _bound(spark, sf_dir):
    rows = _trusted(spark, sf_dir).withColumnsRenamed({"a": "market_id_a", "b": "market_id_b"})
    return coherence.constraints(rows)


@query(f"""WITH {_TR}, pm AS (SELECT market_id, {_MID} AS mid FROM mk WHERE status = 'active'),
 k AS (SELECT CASE WHEN relationship_type = 'same_event' OR relationship_type = 'implies' AND direction = 'symmetric' THEN 'equal' WHEN relationship_type = 'implies' AND direction <> 'none' THEN 'implies' WHEN relationship_type IN ('mutually_exclusive', 'partition_member') THEN 'exclusive' END AS kind, a, b FROM tt WHERE trust_tier = 'trusted')
 SELECT kind, a, b, CASE kind WHEN 'implies' THEN x.mid - y.mid WHEN 'equal' THEN abs(x.mid - y.mid) ELSE x.mid + y.mid - 1000000 END AS gap FROM k JOIN pm x ON x.market_id = a JOIN pm y ON y.market_id = b WHERE kind IS NOT NULL""")
def coherence_gaps(spark, sf_dir):
    return coherence.gaps(_bound(spark, sf_dir), _prices(spark, sf_dir))


def _by_size(spark, sf_dir):
    """Markets of one series and size as one event, so that events have several markets."""
    return markets(spark, sf_dir).withColumn("event_ticker", F.concat_ws("|", "series_ticker", F.col("size").cast("string")))


_BY_SIZE = f"{_MK}, ms AS (SELECT market_id, ordinal, status, mutex, series_ticker || '|' || size AS event_ticker FROM mk), wh AS (SELECT event_ticker FROM ms WHERE mutex AND status = 'active' GROUP BY 1 HAVING count(*) >= 3)"


@query(f"""WITH {_BY_SIZE} SELECT event_ticker, count(*) AS n, CAST(sum({_MID}) - 1000000 AS BIGINT) AS gap FROM ms WHERE mutex AND status = 'active' AND event_ticker IN (SELECT * FROM wh) GROUP BY 1""")
def partition_gaps(spark, sf_dir):
    return coherence.partition_gaps(_by_size(spark, sf_dir), _prices(spark, sf_dir))


@query(f"""WITH {_BY_SIZE} SELECT x.market_id AS market_id_a, y.market_id AS market_id_b, 'partition_member' AS relationship_type, 'symmetric' AS direction, 1.0::DOUBLE AS confidence, 'trusted' AS trust_tier, 'members of ' || x.event_ticker AS rationale
  FROM ms x JOIN ms y ON x.event_ticker = y.event_ticker AND x.market_id < y.market_id WHERE x.mutex AND x.status = 'active' AND y.status = 'active' AND x.event_ticker IN (SELECT * FROM wh)""")
def structural_edges(spark, sf_dir):
    m = staged(_by_size(spark, sf_dir), "markets")
    rows = coherence.structural_edges(None, m, end())
    return rows.select("market_id_a", "market_id_b", "relationship_type", "direction", "confidence", "trust_tier", "rationale")


@query()
def joint_fit(spark, sf_dir):
    """Tested against a plain loop: SQL cannot say the fit."""
    return coherence.joint(_bound(spark, sf_dir), _prices(spark, sf_dir))


@query("""WITH e AS (SELECT vec_id, label, CAST(embedding AS DOUBLE[]) AS v FROM embeddings)
  SELECT x.vec_id AS a, y.vec_id AS b, round(list_cosine_similarity(x.v, y.v), 6) AS similarity FROM e x JOIN e y ON x.label = y.label AND x.vec_id < y.vec_id WHERE list_cosine_similarity(x.v, y.v) >= 0.3""")
def pairs_by_embedding(spark, sf_dir):
    rows = read(spark, sf_dir, "embeddings").select(F.col("vec_id").alias("id"), F.col("label").alias("bucket"), F.col("embedding").alias("vector"))
    return similar.pairs(rows, 0.3).select("a", "b", F.round("similarity", 6).alias("similarity"))


@query(f"""WITH {_SM}, new AS (SELECT market_id, underlying_event, ' y ' AS resolves_yes_when, '5' AS resolves_no_when, 'None' AS resolution_timing, CASE WHEN n % 7 = 1 THEN '[]' ELSE '["' || trim(label) || '","None","True","x"]' END AS entities, 'model' AS model, CAST(1 AS INTEGER) AS extraction_version FROM sm WHERE error IS NULL AND n % 5 IN (0, 3)),
  old AS (SELECT market_id, 'before' AS underlying_event, CAST(1 + ordinal % 2 AS INTEGER) AS extraction_version FROM mk WHERE ordinal % 4 <> 1)
  SELECT market_id, CASE WHEN new.market_id IS NULL THEN old.underlying_event ELSE new.underlying_event END AS underlying_event, new.resolves_yes_when, new.resolves_no_when, new.resolution_timing, new.entities, new.model, CASE WHEN new.market_id IS NULL THEN old.extraction_version ELSE new.extraction_version END AS extraction_version
  FROM old FULL JOIN new USING (market_id)""")
def semantics_upsert(spark, sf_dir):
    """market_semantics after the results of the ended batches."""
    empty = spark.createDataFrame([], SCHEMAS["market_semantics"])
    old = empty.unionByName(_semantics(spark, sf_dir).select("market_id", "extraction_version", F.lit("before").alias("underlying_event")), allowMissingColumns=True).select(*empty.columns)
    rows = _descriptions(spark, sf_dir).withColumn("key", F.col("market_id"))
    new = extraction.semantics_rows(_answers(spark, sf_dir, rows, "semantics", F.col("market_id"))).withColumns({"extraction_version": F.lit(1), "entities": F.to_json("entities"), "dependencies": F.to_json("dependencies")})
    after = tables.upsert(old, new, ["market_id"])
    return after.select("market_id", "underlying_event", "resolves_yes_when", "resolves_no_when", "resolution_timing", "entities", "model", "extraction_version")


@query(f"""WITH {_CP}, o AS (SELECT 'primary-' || n % 5 || '-' || CAST(substr(a, 2) AS BIGINT) // 10 AS batch_id, count(*) AS requests FROM cp WHERE n % 5 = 1 GROUP BY 1)
  SELECT batch_id, CAST(requests AS INTEGER) AS requests, row_number() OVER (ORDER BY batch_id) AS position FROM o""")
def open_batches(spark, sf_dir):
    """llm_batches once the ended and the abandoned batches have left it, in order of submission."""
    batches = staged(_open_batches(_asked(_keyed(spark, sf_dir), "primary", _pair_text()), "primary"), "batches", LARGE_ROWS)
    left = extraction.still_open(batches, extraction.settled(batches, _polled(batches), end()))
    n = F.size(F.from_json("payload", "map<string,string>"))
    return tables.placed(left.select("batch_id", n.alias("requests"), "submitted_at"), "submitted_at", "batch_id").drop("submitted_at")


# ---- reads in order


@query(f"WITH {_ED} SELECT market_id_a, market_id_b, confidence, row_number() OVER (ORDER BY confidence DESC NULLS LAST, market_id_a, market_id_b) AS position FROM ed WHERE trust_tier = 'review' AND review_status = 'pending'")
def review_in_order(spark, sf_dir):
    rows = edges.review_queue(_edges(spark, sf_dir)).select("market_id_a", "market_id_b", "confidence")
    return tables.placed(rows, F.desc_nulls_last("confidence"), "market_id_a", "market_id_b")


@query(f"WITH {_PR} SELECT a, b, row_number() OVER (ORDER BY a, b) AS position FROM pr")
def pairs_in_order(spark, sf_dir):
    return pairs.in_order(_pairable(spark, sf_dir))


@query(f"WITH {_SS} SELECT series_ticker, row_number() OVER (ORDER BY rank_position) AS position FROM rk WHERE rank_position <= 10")
def tracked_in_order(spark, sf_dir):
    return tables.placed(_tracked(spark, sf_dir), "rank_position").select("series_ticker", "position")


# ---- windows of time and the graph


@query(f"WITH {_EV} SELECT event_type, count(*) AS n FROM ev WHERE hour(received_ts) >= 9 AND hour(received_ts) < 17 GROUP BY 1")
def events_in_hours(spark, sf_dir):
    return raw_events(spark, sf_dir).where(in_hours(F.col("received_ts"), 9, 17)).groupBy("event_type").agg(F.count(F.lit(1)).alias("n"))


@query(f"WITH {_EV} SELECT market_id, count(*) AS n FROM ev WHERE received_ts >= {END} - INTERVAL 217 HOUR GROUP BY 1")
def rolling_retention(spark, sf_dir):
    """Events of the last 216 hours and one more."""
    kept = retention.prune(raw_events(spark, sf_dir), "received_ts", retention_cutoff(end(), 3600, 216))
    return kept.groupBy("market_id").agg(F.count(F.lit(1)).alias("n"))


@query(f"""WITH {_LM}, dn AS (SELECT market_id FROM lm WHERE resolved_at < TIMESTAMP '2024-02-02 00:00:00') SELECT 'semantics' AS kind, count(*) FILTER (market_id IN (SELECT market_id FROM dn)) AS deleted, count(*) FILTER (market_id NOT IN (SELECT market_id FROM dn)) AS kept FROM sem
  UNION ALL SELECT 'edges', count(*) FILTER (a IN (SELECT market_id FROM dn) OR b IN (SELECT market_id FROM dn)), count(*) FILTER (a NOT IN (SELECT market_id FROM dn) AND b NOT IN (SELECT market_id FROM dn)) FROM evp""")
def prune_graph_counts(spark, sf_dir):
    before = _semantics(spark, sf_dir), _edge_ids(spark, sf_dir)
    return retention.graph_counts(before, retention.prune_graph(*before, _lifecycle_markets(spark, sf_dir), F.lit("2024-02-02 00:00:00").cast("timestamp_ntz")))


@query(f"WITH {_ED} SELECT market_id_a, market_id_b, relationship_type, trust_tier FROM ed WHERE {_S.replace('a,', 'market_id_a,').replace('b,', 'market_id_b,')} % 4 = 0")
def edges_for_pairs(spark, sf_dir):
    """The edges of a list of pairs, of which many have none."""
    number = F.substring("a", 2, 9).cast("bigint") + F.substring("b", 2, 9).cast("bigint")
    wanted = pairs.distinct_candidates(_pairable(spark, sf_dir)).where(number % 4 == 0)
    found = extraction.edges_of(_edges(spark, sf_dir), wanted.union(wanted))
    return found.select("market_id_a", "market_id_b", "relationship_type", "trust_tier")
