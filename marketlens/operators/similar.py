"""Candidate pairs by similar vectors within a shared bucket, such as an entity: products of blocks of vectors.

Vectors of a bucket are dealt to rings by their angle to one common direction. Two vectors whose cosine reaches the threshold differ in
that angle by no more than the threshold's own angle, which is a ring's width; so only vectors of one ring or of neighbouring
rings are compared. A ring of many vectors is cut into blocks by hash, and each two blocks that may hold a pair are one matrix
product in one task; no block is larger than about BLOCK vectors, whatever a bucket's size.
"""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..sources.stage import staged

BLOCK = 512


def _direction(vectors: DataFrame, size: int) -> list[float]:
    """The mean of the unit vectors: one row of `size` sums."""
    sums = vectors.agg(*(F.sum(F.get("v", F.lit(i))).alias(f"s{i}") for i in range(size))).first()
    total = math.sqrt(sum((x or 0.0) ** 2 for x in sums))
    return [(x or 0.0) / total for x in sums] if total else [1.0] + [0.0] * (size - 1)


def pairs(vectors: DataFrame, threshold: float, block: int = BLOCK) -> DataFrame:
    """a < b, similarity of the pairs of ids that share a bucket and whose cosine is at least the threshold (above 0), each once.
    vectors: id, bucket, vector (array of numbers, all of one length); an id may be in several buckets. Vectors that are null or
    zero are in no pair."""
    norm = F.sqrt(F.aggregate("v", F.lit(0.0), lambda s, x: s + x * x))
    rows = vectors.select("id", "bucket", F.col("vector").cast("array<double>").alias("v")).where("id is not null and bucket is not null and v is not null").withColumn("norm", norm)
    rows = staged(rows.where("norm > 0").select("id", "bucket", F.transform("v", lambda x: x / F.col("norm")).alias("v")).dropDuplicates(["id", "bucket"]), "vectors")
    first = rows.select(F.size("v").alias("n")).first()
    if first is None:
        return rows.select(F.col("id").alias("a"), F.col("id").alias("b"), F.lit(0.0).alias("similarity"))
    towards = F.array(*map(F.lit, _direction(rows, first["n"])))
    width = math.acos(min(1.0, threshold)) + 1e-6
    along = F.aggregate(F.zip_with("v", towards, lambda x, y: x * y), F.lit(0.0), lambda s, x: s + x)
    rows = rows.withColumn("ring", F.floor(F.acos(F.greatest(F.lit(-1.0), F.least(F.lit(1.0), along))) / width).cast("int"))
    counts = staged(rows.groupBy("bucket", "ring").agg(F.ceil(F.count(F.lit(1)) / block).cast("int").alias("blocks")), "rings")
    after = counts.select("bucket", (F.col("ring") - 1).alias("ring"), F.col("blocks").alias("next"))
    before = counts.select("bucket", (F.col("ring") + 1).alias("ring"), F.col("blocks").alias("last"))
    rows = rows.join(counts.join(after, ["bucket", "ring"], "left").join(before, ["bucket", "ring"], "left"), ["bucket", "ring"])
    own = F.pmod(F.xxhash64("id"), "blocks").cast("int")
    # A row goes to the products of its block with those of its ring and the next one; and as the other side of those of the ring before.
    run = lambda c: F.when(F.coalesce(c, F.lit(0)) > 0, F.sequence(F.lit(0), c - 1)).otherwise(F.array().cast("array<int>"))
    here = F.transform(run(F.col("blocks")), lambda k: F.struct(F.col("ring").alias("ring"), F.lit(0).alias("step"), F.least(F.col("own"), k).alias("i"), F.greatest(F.col("own"), k).alias("j"), (F.col("own") > k).cast("int").alias("side")))
    onward = F.transform(run(F.col("next")), lambda k: F.struct(F.col("ring").alias("ring"), F.lit(1).alias("step"), F.col("own").alias("i"), k.alias("j"), F.lit(0).alias("side")))
    back = F.transform(run(F.col("last")), lambda k: F.struct((F.col("ring") - 1).alias("ring"), F.lit(1).alias("step"), k.alias("i"), F.col("own").alias("j"), F.lit(1).alias("side")))
    dealt = rows.withColumn("own", own).select("bucket", "id", "v", F.explode(F.concat(here, onward, back)).alias("t")).select("bucket", "id", "v", "t.*")

    def product(part: pd.DataFrame) -> pd.DataFrame:
        same = bool(part["step"].iloc[0] == 0 and part["i"].iloc[0] == part["j"].iloc[0])
        left = part if same else part[part["side"] == 0]
        right = part if same else part[part["side"] == 1]
        found = []
        if len(left) and len(right):
            cos = np.stack(left["v"]) @ np.stack(right["v"]).T
            x, y = np.nonzero(cos >= threshold)
            a, b = left["id"].to_numpy()[x], right["id"].to_numpy()[y]
            keep = (a < b) if same else (a != b)
            found = zip(np.minimum(a, b)[keep], np.maximum(a, b)[keep], cos[x, y][keep], strict=True)
        return pd.DataFrame(list(found), columns=["a", "b", "similarity"])

    kind = dict(rows.dtypes)["id"]
    out = dealt.groupBy("bucket", "ring", "step", "i", "j").applyInPandas(product, f"a {kind}, b {kind}, similarity double")
    return out.dropDuplicates(["a", "b"])
