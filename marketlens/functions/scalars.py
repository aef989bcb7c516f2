"""Scalar column expressions of the data model. Prices and sizes are integers: micro-dollars and micro-contracts."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

from ..params import DEFAULT, MICRO, TERMINAL, Params


def falsy_coalesce(*columns: Column) -> Column:
    """The first column that is neither null nor empty."""
    return F.coalesce(*(F.nullif(c, F.lit("")) for c in columns))


def to_micro(text: Column) -> Column:
    """Micro-units of a decimal text; null where it is no number."""
    return F.round(text.try_cast("decimal(30,9)") * MICRO).cast("bigint")


def to_double(text: Column) -> Column:
    return text.try_cast("double")


def dollars(micro: Column) -> Column:
    return micro / F.lit(float(MICRO))


def in_band(price: Column, p: Params = DEFAULT) -> Column:
    return price.between(p.price_low, p.price_high)


def best_volume(*texts: Column) -> Column:
    """The first text that parses, else 0."""
    return F.coalesce(*(to_double(t) for t in texts), F.lit(0.0))


def parse_time(text: Column) -> Column:
    """A UTC time from ISO text with or without a zone, or from seconds (or, above 1e12, milliseconds); else null."""
    number = text.try_cast("double")
    micros = F.when(F.abs(number) > 1e12, number * 1000).otherwise(number * 1_000_000)
    by_number = F.when(number != 0, F.timestamp_micros(micros.cast("bigint")))
    return F.coalesce(by_number, F.when(number.isNull(), F.try_to_timestamp(F.nullif(strip(text), F.lit("")))))


def floor_to(ts: Column, seconds: int) -> Column:
    step = seconds * 1_000_000
    micros = F.unix_micros(ts.cast("timestamp"))
    return F.timestamp_micros(micros - F.pmod(micros, F.lit(step)))


def tick_before(ts: Column, seconds: int) -> Column:
    """The ordinal of the last grid tick at or before a time; the first tick that sees it strictly is one more."""
    return F.floor(F.unix_micros(ts.cast("timestamp")) / (seconds * 1_000_000)).cast("bigint")


def tick_time(tick: Column, seconds: int) -> Column:
    return F.timestamp_seconds(tick * seconds).cast("timestamp_ntz")


def open_status(status: Column, seed: Column) -> Column:
    """Whether a market counts as open: no status of the log or the catalog says otherwise."""
    known = falsy_coalesce(status, seed)
    return known.isNull() | (known == "active")


def day_start(now: Column) -> Column:
    return F.date_trunc("day", now).cast("timestamp_ntz")


def in_hours(ts: Column, first: int, last: int) -> Column:
    """first <= hour of day < last."""
    return (F.hour(ts) >= first) & (F.hour(ts) < last)


def retention_cutoff(now: Column, interval_seconds: int, cycles: int) -> Column:
    """A window of `cycles` intervals and one more."""
    return F.timestamp_micros(F.unix_micros(now.cast("timestamp")) - (cycles + 1) * interval_seconds * 1_000_000).cast("timestamp_ntz")


def pair(a: Column, b: Column) -> tuple[Column, Column]:
    return F.least(a, b), F.greatest(a, b)


def entities(names: Column) -> Column:
    """Trimmed, lower-cased, distinct, without empty ones."""
    clean = F.transform(names, lambda x: F.lower(strip(x)))
    return F.array_sort(F.array_distinct(F.filter(clean, lambda x: x.isNotNull() & (x != ""))))


def label(yes_sub_title: Column, subtitle: Column, **strikes: Column) -> Column:
    """What tells a market from others of its event: its subtitle, else the first strike given."""
    return F.coalesce(F.nullif(yes_sub_title, F.lit("")), F.nullif(subtitle, F.lit("")), *(F.concat(F.lit(f"{k}="), v.cast("string")) for k, v in strikes.items()))


def title(name: Column, ticker: Column, subtitle: Column) -> Column:
    base = falsy_coalesce(name, ticker)
    extra = F.nullif(subtitle, F.lit(""))
    return F.when(extra.isNotNull() & ~F.contains(base, extra), F.concat(base, F.lit(" — "), extra)).otherwise(base)


def strong_status(event: Column, deactivated: Column) -> Column:
    """The status that a lifecycle event sets whatever came before; null where it keeps the current one."""
    named = F.when(event == "activated", "active").when(event == "deactivated", "inactive").when(event.isin("determined", "settled"), event)
    return F.when(F.coalesce(deactivated, F.lit(False)), "inactive").otherwise(named)


def resolved_at(result: Column, status: Column, settled: Column, closed: Column, now: Column) -> Column:
    done = (F.coalesce(strip(result), F.lit("")) != "") | F.coalesce(F.lower(strip(status)).isin(*TERMINAL), F.lit(False))
    return F.when(done, F.coalesce(settled, closed, now))


def clamp_unit(x: Column) -> Column:
    return F.when(F.isnan(x), 1.0).when(x.isNotNull(), F.greatest(F.lit(0.0), F.least(F.lit(1.0), x)))


def strip(text: Column) -> Column:
    """Without white space of any kind at its ends."""
    return F.btrim(text, F.lit(" \t\n\r\x0b\x0c"))


def strip_fence(text: Column) -> Column:
    """Without a Markdown code fence around it: its first line, and its end if the text ends with it."""
    plain = strip(text)
    inner = strip(F.regexp_replace(F.regexp_replace(plain, r"^[^\n]*\n", ""), r"^json", ""))
    return F.when(F.startswith(plain, F.lit("```")), strip(F.regexp_replace(inner, "```$", ""))).otherwise(plain)


def once(value: Column, f: Callable[[Column], Column]) -> Column:
    """f of a value that is computed once."""
    return F.get(F.transform(F.array(value), f), F.lit(0))


def _ended(text: Column, field_end: Column) -> Column:
    """Whether nothing follows the object that a text begins with, if the text parses as items of a list. The parser ignores what
    follows a complete value; without a bracket in it a text cannot end that list, else what follows the object would have to be right
    as a field before another one as well."""
    return F.startswith(text, F.lit("{")) & (~F.contains(text, F.lit("]")) | (field_end == 1))


def _object(text: Column) -> Column:
    """A variant of a text that is one JSON object and nothing else; null otherwise. It is parsed as the only item of a list."""
    item = lambda p, n: F.try_variant_get(p, f"$[{n}]", "variant")
    field = F.try_parse_json(F.concat(F.lit('{"v":'), text, F.lit(',"end":1}')))
    only = once(F.try_parse_json(F.concat(F.lit("["), text, F.lit("]"))), lambda p: F.when(item(p, 1).isNull(), item(p, 0)))
    return F.when(_ended(text, F.try_variant_get(field, "$.end", "int")), only)


def _last_of_repeated(text: Column) -> Column:
    """The same of an object that has a name twice, of which the last counts."""
    field = F.from_json(F.concat(F.lit('{"v":'), text, F.lit(',"end":1}')), "struct<v:map<string,variant>,end:int>")
    later = lambda all_, e, i: F.exists(F.slice(all_, i + 2, F.size(all_)), lambda x: x["key"] == e["key"])
    last = lambda m: F.map_from_entries(F.filter(F.map_entries(m), lambda e, i: ~later(F.map_entries(m), e, i)))
    listed = F.from_json(F.concat(F.lit("["), text, F.lit("]")), "array<map<string,variant>>")
    only = once(listed, lambda p: F.when((F.size(p) == 1) & F.get(p, F.lit(0)).isNotNull(), F.to_variant_object(last(F.get(p, F.lit(0))))))
    return F.when(_ended(text, field["end"]), only)


def one_object(text: Column) -> Column:
    """A variant of a text that is one JSON object and nothing else; null otherwise. Of a repeated name the last value counts, and
    numbers that JSON does not have (NaN, Infinity, -Infinity) are taken as text."""
    said = F.regexp_replace(text, r"(?<=[:\[,])(\s*)(NaN|-?Infinity)(?=\s*[,}\]])", r'$1"$2"')
    return F.coalesce(_object(text), _last_of_repeated(text), F.when(said != text, F.coalesce(_object(said), _last_of_repeated(said))))


def python_text(value: Column) -> Column:
    """A variant value as str() writes it: None, True, False, texts as they are; other values as JSON."""
    kind, text = F.schema_of_variant(value), F.try_variant_get(value, "$", "string")
    return F.when(F.is_variant_null(value), "None").when(kind == "BOOLEAN", F.initcap(text)).otherwise(F.coalesce(text, F.to_json(value)))


def truthy(doc: Column, *paths: str) -> Column:
    """The text of the first path of a variant whose value is neither null nor empty nor the number 0 nor false."""

    def one(path: str) -> Column:
        value, text = F.try_variant_get(doc, path, "variant"), F.try_variant_get(doc, path, "string")
        number = F.schema_of_variant(value) != "STRING"
        empty = (text == "") | (number & ((text == "false") | F.coalesce(text.try_cast("double") == 0, F.lit(False))))
        return F.when(~empty, text)

    return F.coalesce(*map(one, paths))


def remaining_life(closes: Column, now: Column) -> Column:
    micros = lambda t: F.unix_micros(t.cast("timestamp"))
    return (micros(closes) - micros(now)) / 1e6


def route(life_a: Column, life_b: Column, p: Params = DEFAULT) -> Column:
    life = F.least(life_a, life_b)
    return F.when(life.isNull(), "sync").when(life < p.life_floor_seconds, "skip").when(life < p.batch_threshold_seconds, "sync").otherwise("batch")


def tier(confidence: Column, p: Params = DEFAULT) -> Column:
    return F.when(confidence >= p.soft, "soft").otherwise("review")


def shard(series: Column, p: Params = DEFAULT) -> Column:
    return (F.crc32(series.cast("binary")) % p.shards).cast("int")


def audit_verdict(structural: Column, pct: Column, p: Params = DEFAULT) -> Column:
    return F.when((structural == 0) & (pct == 0), "no_diff").when((structural <= p.audit_max_levels) & (pct <= p.audit_max_pct), "small_diff").otherwise("large_diff")
