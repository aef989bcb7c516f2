"""A cycle of extraction: what to ask a model for, how, and what its answers become."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.scalars import day_start, tier
from ..params import DEFAULT, Params
from . import edges, pairs

_PAIR = "struct<pair:array<string>,primary:struct<relationship_type:string,direction:string,confidence:double,rationale:string>,primary_model:string>"


def in_flight_markets(batches: DataFrame) -> DataFrame:
    return edges.in_flight(batches, "semantics").select(F.col("context").alias("market_id")).distinct()


def in_flight_pairs(batches: DataFrame) -> DataFrame:
    """a, b of every pair of an open batch, asked for the first time or for a second opinion."""
    first = edges.in_flight(batches, "primary").select(F.from_json("context", "array<string>").alias("pair"))
    second = edges.in_flight(batches, "verify").select(F.from_json("context", _PAIR)["pair"].alias("pair"))
    return first.union(second).select(F.col("pair")[0].alias("a"), F.col("pair")[1].alias("b")).distinct()


def _numbered(rows: DataFrame, *order: Column | str) -> DataFrame:
    """rows with n, their number in the order. Rows are a cycle's work, which its caps bound."""
    return rows.withColumn("n", F.row_number().over(Window.orderBy(*order)))


def semantics_work(markets: DataFrame, semantics: DataFrame, batches: DataFrame | None, version: int, p: Params = DEFAULT) -> DataFrame:
    """market_id, route of the markets to extract this cycle: active ones without semantics of the version that are not in
    flight; all by batch from the bulk threshold on, else one by one, each up to its cap. Without `batches` there is no batch
    service and nothing is in flight."""
    backlog = edges.missing_semantics(markets, semantics, version).select("market_id").distinct()
    if batches is None:
        return backlog.orderBy("market_id").limit(p.sync_cap).withColumn("route", F.lit("sync"))
    backlog = backlog.join(in_flight_markets(batches), "market_id", "left_anti")
    first = backlog.orderBy("market_id").limit(max(p.batch_cap, p.bulk_threshold, p.sync_cap))
    rows = _numbered(first, "market_id").withColumn("bulk", F.count(F.lit(1)).over(Window.partitionBy()) >= p.bulk_threshold)
    return rows.where((F.col("bulk") & (F.col("n") <= p.batch_cap)) | (~F.col("bulk") & (F.col("n") <= p.sync_cap))).select("market_id", F.when(F.col("bulk"), "batch").otherwise("sync").alias("route"))


def pair_backlog(candidates: DataFrame, known: DataFrame, batches: DataFrame | None, version: int) -> DataFrame:
    """a, b of the candidates without an edge of this version and not in flight."""
    done = known.where(F.col("extraction_version") == version).select(F.col("market_id_a").alias("a"), F.col("market_id_b").alias("b"))
    return pairs.todo(candidates, done, *([in_flight_pairs(batches)] if batches is not None else []))


def classified_since(known: DataFrame, start: Column) -> DataFrame:
    """n: the edges classified since a time, such as the start of the UTC day."""
    return known.where(F.col("classified_at") >= start).agg(F.count(F.lit(1)).alias("n"))


def day_plan(backlog: DataFrame, markets: DataFrame, known: DataFrame, batches: DataFrame | None, now: Column, p: Params = DEFAULT) -> DataFrame:
    """a, b, life, route (skip, sync, batch or deferred) of the backlog. What the day's budget leaves is spent on pairs of longest
    remaining life, unknown first; pairs to skip consume it too, and the others are deferred."""
    flying = in_flight_pairs(batches).agg(F.count(F.lit(1)).alias("m")) if batches is not None else backlog.agg(F.lit(0).alias("m"))
    left = classified_since(known, day_start(now)).crossJoin(flying).select(F.greatest(F.lit(0), F.lit(p.daily_budget) - F.col("n") - F.col("m")).alias("left"))  # of one row
    routed = pairs.with_route(backlog, markets, now, p)
    chosen = _numbered(routed.orderBy(F.desc_nulls_first("life"), "a", "b").limit(p.daily_budget), F.desc_nulls_first("life"), "a", "b")
    chosen = chosen.crossJoin(F.broadcast(left)).where("n <= left").select("a", "b", F.lit(True).alias("chosen"))
    return routed.join(chosen, ["a", "b"], "left").select("a", "b", "life", F.when(F.col("chosen"), F.col("route")).otherwise("deferred").alias("route"))


def dispatch(plan: DataFrame, batch_service: bool = True, p: Params = DEFAULT) -> DataFrame:
    """a, b, mode of the pairs to send this cycle, up to the caps. Without a batch service all go one by one, those of short life
    first."""
    chosen = plan.where(F.col("route").isin("sync", "batch"))
    order = (F.desc_nulls_first("life"), "a", "b")
    if not batch_service:
        return chosen.orderBy((F.col("route") == "batch").cast("int"), *order).limit(p.sync_cap).select("a", "b", F.lit("sync").alias("mode"))
    part = lambda route, cap: chosen.where(F.col("route") == route).orderBy(*order).limit(cap).select("a", "b", F.lit(route).alias("mode"))
    return part("sync", p.sync_cap).union(part("batch", p.batch_cap))


def report(plan: DataFrame) -> DataFrame:
    """route, n: how many pairs of the backlog go which way."""
    return plan.groupBy("route").agg(F.count(F.lit(1)).alias("n"))


def semantics_prompt(title: Column, description: Column, criteria: Column) -> Column:
    """The question about one market; what is missing is a dash."""
    said = lambda c: F.coalesce(F.nullif(c, F.lit("")), F.lit("—"))
    return F.concat(F.lit("Title: "), said(title), F.lit("\nDescription: "), said(description), F.lit("\nResolution: "), said(criteria))


def requests(work: DataFrame, order: list[str], context: Column, prompt: Column, model: str) -> DataFrame:
    """custom_id (r0, r1, ... in the order), context, model, prompt of each row of the work."""
    rows = work.select(*order, context.alias("context"), prompt.alias("prompt"))
    return _numbered(rows, *order).select(F.concat(F.lit("r"), (F.col("n") - 1).cast("string")).alias("custom_id"), "context", F.lit(model).alias("model"), "prompt")


def settled(batches: DataFrame, polled: DataFrame, now: Column, p: Params = DEFAULT) -> DataFrame:
    """batch_id, outcome of the open batches, given polled (batch_id, status, with null for a failed call): `written` if it has
    ended, `abandoned` if it is past its age and has not, else `open`. What is written or abandoned leaves the table."""
    old = F.coalesce((F.unix_micros(now.cast("timestamp")) - F.unix_micros(F.col("submitted_at").cast("timestamp"))) > p.batch_max_age_seconds * 1_000_000, F.lit(False))
    rows = batches.join(polled, "batch_id", "left")
    return rows.select("batch_id", F.when(F.coalesce(F.col("status") == "ended", F.lit(False)), "written").when(old, "abandoned").otherwise("open").alias("outcome"))


def still_open(batches: DataFrame, outcomes: DataFrame) -> DataFrame:
    return batches.join(outcomes.where("outcome = 'open'"), "batch_id", "left_semi").orderBy("submitted_at", "batch_id")


def answered(batches: DataFrame, results: DataFrame, outcomes: DataFrame, purpose: str) -> DataFrame:
    """batch_id, custom_id, context, batch_model, content, error of the results (batch_id, custom_id, content, error) of ended
    batches of a purpose. Results of unknown ids are dropped."""
    ended = batches.join(outcomes.where("outcome = 'written'"), "batch_id", "left_semi")
    asked = edges.in_flight(ended, purpose).join(ended.select("batch_id", F.col("model").alias("batch_model")), "batch_id")
    return asked.join(results, ["batch_id", "custom_id"])


def semantics_rows(answers: DataFrame) -> DataFrame:
    """Rows of valid answers for market_semantics: market_id, the texts, entities, dependencies, model, raw_response."""
    rows = edges.parse_semantics(answers.drop("error")).where("error is null and content is not null")
    texts = ("underlying_event", "resolves_yes_when", "resolves_no_when", "resolution_timing", "entities", "dependencies")
    return rows.select(F.col("context").alias("market_id"), *texts, F.col("batch_model").alias("model"), F.to_json(F.struct(*texts)).alias("raw_response"))


def _edge(rows: DataFrame, trust: Column, agreement: Column, verify: Column) -> DataFrame:
    """Edge rows of a, b, the classification and model."""
    way = F.when(F.col("direction") == "first_implies_second", "a_implies_b").when(F.col("direction") == "second_implies_first", "b_implies_a").otherwise(F.col("direction"))
    said = F.to_json(F.struct("relationship_type", "direction", "confidence", "rationale"))
    return rows.select(F.col("a").alias("market_id_a"), F.col("b").alias("market_id_b"), "relationship_type", way.alias("direction"), "confidence", trust.alias("trust_tier"), agreement.alias("agreement_status"), "rationale", "model", verify.alias("verify_model"), said.alias("raw_response"))


def primary_rows(answers: DataFrame, live: DataFrame, p: Params = DEFAULT) -> tuple[DataFrame, DataFrame]:
    """Edges of the valid first answers that need no second opinion, and those that do (batch_id, a, b, the classification, model). A
    confident answer about a market that is no longer live (market_id) stays soft."""
    pair = F.from_json("context", "array<string>")
    rows = edges.parse_classification(answers.drop("error")).where("error is null and content is not null").select("*", pair[0].alias("a"), pair[1].alias("b"), F.col("batch_model").alias("model"))
    ends = live.select("market_id").distinct()
    for end in ("a", "b"):
        rows = rows.join(ends.select(F.col("market_id").alias(end), F.lit(True).alias(f"live_{end}")), end, "left")
    sure = F.col("confidence") >= p.trusted
    both = F.col("live_a").isNotNull() & F.col("live_b").isNotNull()
    single, none = F.lit("single"), F.lit(None).cast("string")
    written = _edge(rows.where(~(sure & both)), F.when(sure, "soft").otherwise(tier(F.col("confidence"), p)), single, none)
    return written, rows.where(sure & both).select("batch_id", "a", "b", "relationship_type", "direction", "confidence", "rationale", "model")


def verify_context() -> Column:
    """The context of a request for a second opinion: the pair, its first classification and the model of that."""
    return F.to_json(F.struct(F.array("a", "b").alias("pair"), F.struct("relationship_type", "direction", "confidence", "rationale").alias("primary"), F.col("model").alias("primary_model")))


def verify_rows(answers: DataFrame) -> DataFrame:
    """Edges of the first classifications by their second opinions: trusted if the types agree, for review if not, soft without
    a valid one."""
    parsed = edges.parse_classification(answers.drop("error")).select("context", "batch_model", F.when(F.col("error").isNull(), F.col("relationship_type")).alias("second"))
    c = F.col("c")
    rows = parsed.withColumn("c", F.from_json("context", _PAIR)).select(c["pair"][0].alias("a"), c["pair"][1].alias("b"), "c.primary.*", c["primary_model"].alias("model"), "second", "batch_model")
    has, agrees = F.col("second").isNotNull(), F.col("second") == F.col("relationship_type")
    return _edge(rows, F.when(has & agrees, "trusted").when(has, "review").otherwise("soft"), F.when(has & agrees, "agreed").when(has, "disagreed").otherwise("single"), F.when(has, F.col("batch_model")))


def edges_of(known: DataFrame, wanted: DataFrame) -> DataFrame:
    """The edges of the wanted pairs (a, b), whatever their platform."""
    return known.join(wanted.select(F.col("a").alias("market_id_a"), F.col("b").alias("market_id_b")).distinct(), ["market_id_a", "market_id_b"], "left_semi")
