"""Pairs of markets to classify: candidates, routes and the daily budget."""

from __future__ import annotations

from functools import reduce
from math import comb

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.scalars import entities, remaining_life, route
from ..params import DEFAULT, Params
from ..sources.stage import bounded, staged
from .tables import placed


def same(markets: DataFrame, key: str, name: str) -> DataFrame:
    rows = markets.where(f"{key} is not null and {key} <> ''").select("market_id", key).distinct()
    left, right = rows.withColumnRenamed("market_id", "a"), rows.withColumnRenamed("market_id", "b")
    return left.join(right.hint("merge"), key).where("a < b").select("a", "b", F.lit(name).alias("bucket"))


def _with_sets(rows: DataFrame, least: int) -> DataFrame:
    """A row for each set of `least` entities of e: k1, k2, ..., the places of its members in e in order."""
    rows = rows.withColumn("k0", F.lit(-1))
    for n in range(1, least + 1):
        rows = rows.withColumn(f"k{n}", F.explode(F.expr(f"filter(sequence(0, size(e)), i -> i > k{n - 1} and i < size(e))")))
    return rows


def _members_of_set(least: int) -> list[Column]:
    return [F.get(F.col("e"), F.col(f"k{n}")) for n in range(1, least + 1)]


def _sets_of(rows: DataFrame, least: int) -> DataFrame:
    """Pairs that meet on a set of `least` entities: only pairs of the result do, whatever the size of an entity's bucket."""
    keyed = _with_sets(rows, least).select("market_id", F.array(*_members_of_set(least)).alias("key"))
    left, right = keyed.withColumnRenamed("market_id", "a"), keyed.withColumnRenamed("market_id", "b")
    return left.join(right.hint("merge"), "key").where("a < b").select("a", "b").distinct()


def _by_prefix(rows: DataFrame, least: int, most: int) -> DataFrame:
    """Pairs of which one market has more than `most` entities. Of m entities in order of rarity, the first m - least + 1 are
    enough: two sets that share `least` share one of those. Each pair is then checked once, by its sets."""
    each = rows.where(F.size("e") >= least).select("market_id", F.size("e").alias("m"), F.explode("e").alias("x"))
    counts = each.groupBy("x").count()
    order = Window.partitionBy("market_id").orderBy("count", "x")
    first = each.join(counts, "x").withColumn("n", F.row_number().over(order)).where(F.col("n") <= F.col("m") - least + 1)
    left = first.where(F.col("m") > most).select(F.col("market_id").alias("l"), "x")
    met = left.join(first.select(F.col("market_id").alias("r"), "x"), "x").where("l <> r").select(F.least("l", "r").alias("a"), F.greatest("l", "r").alias("b")).distinct()
    sets = lambda end: rows.select(F.col("market_id").alias(end), F.col("e").alias(f"e{end}"))
    return met.join(sets("a"), "a").join(sets("b"), "b").where(F.size(F.array_intersect("ea", "eb")) >= least).select("a", "b")


#: Sets of entities that a market may have as keys; with more, its pairs are found by prefixes.
MOST_KEYS = 64


#: About as many markets of a class are in one row.
BLOCK = 256


def _classes(markets: DataFrame, keys: tuple[str, ...], carry: tuple[str, ...] = ()) -> tuple[DataFrame, DataFrame]:
    """Markets of equal entities and equal keys are a class, since they meet the same others. classes: cls, e (entities), the keys
    (arrays, as a market may have several), n (markets), blocks; members: cls, block, ids (array of market_id and what to carry)."""
    texts = [F.array_sort(F.collect_set(F.nullif(F.col(k), F.lit("")))).alias(k) for k in keys]
    values = [F.min(c).alias(c) for c in carry]
    each = markets.where("market_id is not null").groupBy("market_id").agg(entities(F.flatten(F.collect_list("entities"))).alias("e"), *texts, *values)
    each = staged(each, "entities")
    sized = each.groupBy("e", *keys).agg(F.count(F.lit(1)).alias("n")).withColumn("blocks", F.ceil(F.col("n") / BLOCK))
    classes = staged(sized.withColumn("cls", F.monotonically_increasing_id()), "classes")
    of = each.join(classes.hint("merge"), ["e", *keys]).withColumn("block", F.pmod(F.xxhash64("market_id"), F.col("blocks")))
    return classes, staged(of.groupBy("cls", "block").agg(F.collect_list(F.struct("market_id", *carry)).alias("ids")), "members")


def _most_entities(least: int, most_keys: int) -> int:
    """Of how many entities a class may be to have at most `most_keys` sets of `least` of them."""
    most = least
    while comb(most + 1, least) <= most_keys:
        most += 1
    return most


def _by_entities(classes: DataFrame, least: int, most_keys: int) -> DataFrame:
    """a, b (classes, a <= b) of which each two markets share at least `least` entities. Classes of few entities meet on sets of
    `least` of them, which are exactly the pairs of the result; a class of m entities has C(m, least) such sets, so beyond
    `most_keys` of them it meets the others on its rarest entities instead, of which it has m - least + 1."""
    most = _most_entities(least, most_keys)
    rows = classes.select(F.col("cls").alias("market_id"), "e")
    found = _sets_of(rows.where(F.size("e") <= most), least)
    if rows.where(F.size("e") > most).limit(1).count():
        found = found.union(_by_prefix(rows, least, most))
    return found.union(classes.where((F.size("e") >= least) & (F.col("n") > 1)).select("cls", "cls"))


def _by_key(classes: DataFrame, key: str) -> DataFrame:
    """a, b (classes, a <= b) that have a value of the key in common."""
    rows = classes.select("cls", "n", F.explode(key).alias("x"))
    left, right = rows.select(F.col("cls").alias("a"), "n", "x"), rows.select(F.col("cls").alias("b"), "x")
    return left.join(right.hint("merge"), "x").where("a < b or a = b and n > 1").select("a", "b").distinct()


def _expanded(linked: DataFrame, classes: DataFrame, members: DataFrame) -> DataFrame:
    """a, b (market structs, x.market_id < y.market_id) of linked classes, each pair once for each row of `linked`. Blocks of members
    meet, so rows that are shuffled are fewer than pairs by up to BLOCK ^ 2, and a large class is many rows. Tasks are as many as cores need,
    since a few bytes of blocks give many pairs and would be coalesced."""
    blocks = lambda end: classes.select(F.col("cls").alias(end), F.col("blocks").alias(f"n{end}"))
    rows = linked.join(blocks("a").hint("shuffle_hash"), "a").join(blocks("b").hint("shuffle_hash"), "b")
    rows = rows.withColumn("ka", F.explode(F.expr("sequence(0L, na - 1)"))).withColumn("kb", F.explode(F.expr("sequence(0L, nb - 1)")))
    ids = lambda end, name: members.select(F.col("cls").alias(end), F.col("block").alias(f"k{end}"), F.col("ids").alias(name))
    context = rows.sparkSession.sparkContext
    tasks = max(int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions")), 4 * context.defaultParallelism)
    rows = rows.join(ids("a", "xs").hint("shuffle_hash"), ["a", "ka"]).repartition(tasks, "b", "kb").join(ids("b", "ys").hint("shuffle_hash"), ["b", "kb"])
    kept = [c for c in linked.columns if c not in ("a", "b")]
    pair = rows.select("a", "b", *kept, F.explode("xs").alias("x"), "ys").select("a", "b", *kept, "x", F.explode("ys").alias("y"))
    return pair.where("a < b or x.market_id < y.market_id").select("x", "y", *kept)


#: Where two blocks of rows of members meet. Tables made of the same candidates are joined on it too, so that no pair is shuffled.
AT = ("key_id", "j", "k")
#: About as many pairs are made by a task, where they are joined there.
MADE = 1 << 21


def _meetings(classes: DataFrame, members: DataFrame, keys: dict[str, str], least: int, most_keys: int = MOST_KEYS, joined: bool = False) -> DataFrame:
    """bucket, x, y (structs m, s, f, e, ids of rows of `members`, each two rows once in a bucket, a row also with itself), first (not in
    an earlier bucket), AT. With `joined` tasks are so many that what each makes can be joined in its memory. Rows meet in blocks of those that have a key in common: a set of `least` entities, or a value. Those that have
    several in common meet where the key is the first of them: if both have an entity before the last of the key's (or a lesser
    value) that the key lacks, in s, they meet there instead. So pairs of classes need not be shuffled to be made distinct, however few
    markets a class has. f has the values of earlier buckets. Classes of too many entities are left to `_far`."""
    rows = members.withColumn("m", F.monotonically_increasing_id()).join(classes.select("cls", "e", *keys.values()).hint("merge"), "cls")
    none = F.array().cast("array<string>")
    sets = _with_sets(rows.where(F.size("e").between(least, _most_entities(least, most_keys))), least)
    picked = _members_of_set(least)
    found = [sets.select(F.lit("entity").alias("bucket"), F.array(*picked).alias("key"), "m", F.array_except(F.slice("e", F.lit(1), F.col(f"k{least}")), F.array(*picked)).alias("s"), none.alias("f"), none.alias("e"), "ids")]
    before, tagged = none, lambda name: lambda v: F.concat(F.lit(name + ":"), v)
    for name, key in keys.items():
        each = rows.withColumn("v", F.explode(key))
        found.append(each.select(F.lit(name), F.array("v"), "m", F.filter(key, lambda w: w < F.col("v")), before, "e", "ids"))
        before = F.concat(before, F.transform(key, tagged(name)))
    keyed = staged(reduce(DataFrame.union, found), "keyed")
    sized = keyed.groupBy("bucket", "key").agg(F.sum(F.size("ids")).alias("of"))
    sized = staged(sized.withColumns({"key_id": F.monotonically_increasing_id(), "blocks": F.ceil(F.col("of") / (2 * BLOCK))}), "keys")
    made = sized.agg(F.sum(F.col("of").cast("double") * F.col("of") / 2)).first()[0] if joined else 0
    tasks = int((made or 0) / MADE) + 1
    sized = sized.drop("of")
    placed_in = keyed.join(bounded(sized), ["bucket", "key"]).withColumn("k", F.pmod(F.xxhash64("m"), F.col("blocks")))
    block = staged(placed_in.groupBy("bucket", "key_id", "blocks", "k").agg(F.collect_list(F.struct("m", "s", "f", "e", "ids")).alias("ys")), "meetings")
    left = block.select("bucket", "key_id", F.col("k").alias("j"), F.col("ys").alias("xs"), F.explode(F.expr("sequence(k, blocks - 1)")).alias("k"))
    right = block.select("key_id", "k", "ys", F.explode(F.expr("sequence(0L, k)")).alias("j"))
    met = _spread(left, *AT, least=tasks).join(_spread(right, *AT, least=tasks).hint("shuffle_hash"), list(AT))
    pair = met.select("bucket", *AT, F.explode("xs").alias("x"), "ys").select("bucket", *AT, "x", F.explode("ys").alias("y"))
    pair = pair.where((F.col("j") < F.col("k")) | (F.col("x.m") <= F.col("y.m"))).where(~F.arrays_overlap("x.s", "y.s"))
    shared = F.when(F.col("bucket") != "entity", F.size(F.array_intersect("x.e", "y.e"))).otherwise(0)
    return pair.select("bucket", *AT, "x", "y", (~F.arrays_overlap("x.f", "y.f") & (shared < least)).alias("first"))


def _of_meetings(met: DataFrame, *kept: str) -> DataFrame:
    """x, y (market structs) of all markets of two rows that meet, each pair once."""
    pair = met.select(*kept, "x", F.explode("y.ids").alias("y1"), F.col("y.m").alias("n")).select(*kept, F.col("x.m").alias("m"), "n", F.explode("x.ids").alias("x"), F.col("y1").alias("y"))
    return pair.where("m <> n or x.market_id < y.market_id").select("x", "y", *kept)


def _far(classes: DataFrame, least: int, most_keys: int = MOST_KEYS) -> DataFrame | None:
    """a, b (classes, a <= b) that share at least `least` entities, of which one has too many of them to meet on sets; None if none has."""
    most = _most_entities(least, most_keys)
    large = classes.where(F.size("e") > most)
    if not large.limit(1).count():
        return None
    return _by_prefix(classes.select(F.col("cls").alias("market_id"), "e"), least, most).union(large.where("n > 1").select("cls", "cls"))


def _ends(pair: DataFrame, *more: Column | str) -> DataFrame:
    return pair.select(F.least("x.market_id", "y.market_id").alias("a"), F.greatest("x.market_id", "y.market_id").alias("b"), *more)


def entity_pairs(markets: DataFrame, least: int, most_keys: int = MOST_KEYS) -> DataFrame:
    """Pairs that share at least `least` entities, by classes of markets of equal entities."""
    classes, members = _classes(markets, ())
    found, far = _of_meetings(_meetings(classes, members, {}, least, most_keys)), _far(classes, least, most_keys)
    found = found if far is None else found.union(_expanded(far, classes, members))
    return _ends(found, F.lit("entity").alias("bucket"))


def _keys(p: Params) -> dict[str, str]:
    return {"event": "event_ticker"} | ({"series": "series_ticker"} if p.same_series else {})


def _linked(classes: DataFrame, p: Params) -> DataFrame:
    """a, b, bucket of classes; a pair may be in several buckets."""
    found = [_by_key(classes, key).withColumn("bucket", F.lit(name)) for name, key in _keys(p).items()]
    return reduce(DataFrame.union, [*found, _by_entities(classes, p.entity_overlap_min, MOST_KEYS).withColumn("bucket", F.lit("entity"))])


def candidates(markets: DataFrame, p: Params = DEFAULT) -> DataFrame:
    """a < b, bucket (event, series, entity); a pair may be in several buckets."""
    classes, members = _classes(markets, tuple(_keys(p).values()))
    found, far = _of_meetings(_meetings(classes, members, _keys(p), p.entity_overlap_min), "bucket"), _far(classes, p.entity_overlap_min)
    found = found if far is None else found.union(_expanded(far.withColumn("bucket", F.lit("entity")), classes, members))
    return _ends(found, "bucket")


def distinct_candidates(markets: DataFrame, p: Params = DEFAULT, now: Column | None = None, at: bool = False) -> DataFrame:
    """a < b of the candidates, each once, without a shuffle of pairs; with `now` also life, the lesser known remaining life of its
    markets in seconds; with `at` also AT. That allows joins of the session to stay where one side's keys in common are dealt out."""
    if at:
        markets.sparkSession.conf.set("spark.sql.requireAllClusterKeysForCoPartition", "false")
    if now is not None:
        markets = markets.withColumn("_life", remaining_life(F.col("closes_at"), now))
    classes, members = _classes(markets, tuple(_keys(p).values()), ("_life",) if now is not None else ())
    more = AT if at else ()
    found, far = _of_meetings(_meetings(classes, members, _keys(p), p.entity_overlap_min, joined=at).where("first"), *more), _far(classes, p.entity_overlap_min)
    found = found if far is None else found.union(_expanded(far, classes, members).select("x", "y", *(F.lit(-1).cast("bigint") for _ in more)))
    return _ends(found, *([F.least("x._life", "y._life").alias("life")] if now is not None else []), *more)


#: Markets in a row of `sheets` at most: as many as a range of the order has.
RANGE = 1 << 18


def _ranged(markets: DataFrame, size: int = RANGE) -> DataFrame:
    """markets with _part, the number of their range of `size` markets in the order of market_id."""
    names = staged(markets.where("market_id is not null").select("market_id").distinct(), "names")
    if names.count() <= size:
        return markets.withColumn("_part", F.lit(0))
    return markets.join(placed(names, "market_id").select("market_id", F.floor((F.col("position") - 1) / size).cast("int").alias("_part")).hint("merge"), "market_id")


def sheets(markets: DataFrame, p: Params = DEFAULT, now: Column | None = None, size: int = RANGE) -> DataFrame:
    """The distinct candidates by classes, as no pair is: cls, block, part, xs (structs market_id, _part and, with `now`, _life of a
    block of a class), ys (the same of all markets of range `part` that each of xs pairs with, in order), own (xs pair with one
    another). A class's members have the same ys, so rows hold fewer markets than there are pairs by up to BLOCK. A pair is twice
    among them, as x, y and as y, x."""
    carry = ("_part",)
    if now is not None:
        markets, carry = markets.withColumn("_life", remaining_life(F.col("closes_at"), now)), ("_part", "_life")
    classes, members = _classes(_ranged(markets, size), tuple(_keys(p).values()), carry)
    linked = staged(_linked(classes, p).select("a", "b").distinct(), "linked")
    both = linked.union(linked.where("a <> b").select(F.col("b").alias("a"), F.col("a").alias("b")))
    each = members.select(F.col("cls").alias("b"), F.explode("ids").alias("y")).groupBy("b", F.col("y._part").alias("part")).agg(F.collect_list("y").alias("ys"))
    near = both.join(each.hint("shuffle_hash"), "b").groupBy(F.col("a").alias("cls"), "part")
    near = near.agg(F.sort_array(F.flatten(F.collect_list("ys"))).alias("ys"))
    own = linked.where("a = b").select(F.col("a").alias("cls"), F.lit(True).alias("own"))
    xs = members.withColumnRenamed("ids", "xs").join(own.hint("merge"), "cls", "left").withColumn("own", F.coalesce("own", F.lit(False)))
    return staged(_spread(near.join(xs.hint("merge"), "cls"), "cls", "part", "block"), "sheets")


def _spread(rows: DataFrame, *by: str, least: int = 1) -> DataFrame:
    """Over as many tasks as cores need, since a few bytes of blocks give many pairs and would be coalesced."""
    tasks = max(int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions")), 4 * rows.sparkSession.sparkContext.defaultParallelism)
    return rows.repartition(max(tasks, least), *by)


def same_pair(left: DataFrame, right: DataFrame, a: str = "a", b: str = "b") -> tuple[list[str], DataFrame]:
    """The columns to join two tables of pairs on, and the right one hinted: on AT too if both have it."""
    if {*AT} <= {*left.columns} & {*right.columns}:
        return [a, b, *AT], right.hint("shuffle_hash")
    return [a, b], right


def _after(x: str, ys: str = "ys") -> Column:
    """How many of a sheet's ys do not follow a market of its xs. Without a lambda, for which Spark would copy ys for each of xs."""
    others = F.array_position(F.sort_array(F.array_append(ys, F.col(x))), F.col(x)) - 1
    at = F.when(F.col("own"), F.array_position(ys, F.col(x))).otherwise(others)
    return F.when(F.col(f"{x}._part") == F.col("part"), at.cast("int")).otherwise(0)


def in_order(markets: DataFrame, p: Params = DEFAULT, size: int = RANGE) -> DataFrame:
    """a, b, position of the distinct candidates, 1 and on in the order of a, b. Those of a market x are what follows it in its
    sheets, so places are sums of sizes: pairs are neither shuffled nor sorted."""
    each = sheets(markets, p, size=size)
    of = each.select("cls", "block", "part", "own", "ys", F.explode("xs").alias("x")).where("x._part <= part")
    counts = of.select("cls", "block", "part", "x", F.size("ys").alias("size"), _after("x").alias("after"))
    counts = staged(counts.select("cls", "block", "part", "x", "after", (F.col("size") - F.col("after")).cast("bigint").alias("n")).where("n > 0"), "counts")
    line = Window.partitionBy("x._part").orderBy("x.market_id", "part").rowsBetween(Window.unboundedPreceding, -1)
    ranges = counts.groupBy(F.col("x._part").alias("_r")).agg(F.sum("n").alias("_n"))  # a row for each range
    ranges = ranges.select("_r", F.coalesce(F.sum("_n").over(Window.orderBy("_r").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("_before"))
    starts = counts.withColumn("_within", F.coalesce(F.sum("n").over(line), F.lit(0))).join(bounded(ranges), F.col("x._part") == F.col("_r"))
    starts = starts.groupBy("cls", "block", "part").agg(F.collect_list(F.struct(F.col("x.market_id").alias("a"), "after", (F.col("_before") + F.col("_within")).alias("before"))).alias("starts"))
    rows = _spread(each.drop("xs").join(starts.hint("merge"), ["cls", "block", "part"]), "cls", "part", "block")
    of = rows.select("ys", F.explode("starts").alias("s"))
    pair = of.select("s", F.posexplode(F.slice("ys", F.col("s.after") + 1, F.size("ys"))).alias("i", "y"))
    return pair.select("s.a", F.col("y.market_id").alias("b"), (F.col("s.before") + F.col("i") + 1).alias("position"))


def candidate_counts(markets: DataFrame, p: Params = DEFAULT) -> DataFrame:
    """The breakdown of the candidates, counted by the rows of members that meet: pairs are not made."""
    keys, least = _keys(p), p.entity_overlap_min
    classes, members = _classes(markets, tuple(keys.values()))
    of, far, zero = F.size("x.ids").cast("bigint"), _far(classes, least), F.lit(0).cast("bigint")
    n = F.when(F.col("x.m") == F.col("y.m"), F.floor(of * (of - 1) / 2)).otherwise(of * F.size("y.ids"))
    each = _meetings(classes, members, keys, least).select("bucket", n.alias("n"), "first")
    if far is not None:
        size = lambda end: classes.select(F.col("cls").alias(end), F.col("n").alias(f"n{end}")).hint("shuffle_hash")
        n = F.when(F.col("a") == F.col("b"), F.expr("na * (na - 1) div 2")).otherwise(F.col("na") * F.col("nb"))
        each = each.union(far.join(size("a"), "a").join(size("b"), "b").select(F.lit("entity"), n, F.lit(True)))
    total = lambda rows, name: F.coalesce(F.sum(F.when(rows, F.col("n"))), zero).alias(name)
    return each.agg(*(total(F.col("bucket") == k, k) for k in BUCKETS), total(F.col("first"), "total"))


BUCKETS = ("event", "series", "entity")


def _by_bucket(found: DataFrame) -> DataFrame:
    return found.groupBy("a", "b").agg(*(F.max((F.col("bucket") == k).cast("int")).alias(k) for k in BUCKETS))


def breakdown(found: DataFrame) -> DataFrame:
    """event, series, entity: pairs in each bucket; total: distinct pairs."""
    return _by_bucket(found).agg(*(F.coalesce(F.sum(k), F.lit(0)).alias(k) for k in BUCKETS), F.count(F.lit(1)).alias("total"))


def todo(pairs: DataFrame, *done: DataFrame) -> DataFrame:
    """Distinct pairs, with their life if they have it, that none of the given sets has. Pairs with AT are distinct already."""
    each = pairs if {*AT} <= {*pairs.columns} else pairs.dropDuplicates(["a", "b"])
    for other in done:
        on, right = same_pair(each, other)
        each = each.join(right.select(*on), on, "left_anti")
    return each.select("a", "b", *(c for c in ("life",) if c in pairs.columns))


def with_route(pairs: DataFrame, markets: DataFrame, now: Column, p: Params = DEFAULT) -> DataFrame:
    """a, b, life (the lesser known remaining life in seconds), route. Pairs that have their life already need no join."""
    if "life" in pairs.columns:
        return pairs.select("a", "b", "life", route(F.col("life"), F.col("life"), p).alias("route"))
    life = markets.select("market_id", remaining_life(F.col("closes_at"), now).alias("life"))
    rows = pairs.select("a", "b").join(life.select(F.col("market_id").alias("a"), F.col("life").alias("la")), "a").join(life.select(F.col("market_id").alias("b"), F.col("life").alias("lb")), "b")
    return rows.select("a", "b", F.least("la", "lb").alias("life"), route(F.col("la"), F.col("lb"), p).alias("route"))


def within_budget(routed: DataFrame, done_today: int, in_flight: int, p: Params = DEFAULT) -> DataFrame:
    """The pairs of longest remaining life (unknown first) that the day's budget still allows. Pairs to skip count too."""
    budget = max(0, p.daily_budget - done_today - in_flight)
    return routed.orderBy(F.desc_nulls_first("life"), "a", "b").limit(budget)
