from __future__ import annotations

import duckdb
import pytest

from marketlens.plans import catalogue
from tests.conftest import SF, same_rows


@pytest.fixture(scope="module")
def duck():
    c = duckdb.connect()
    for t in ("part", "lineitem", "events", "embeddings"):
        c.sql(f"create view {t} as select * from '{SF}/{t}.parquet'")
    return c


@pytest.mark.parametrize("name", sorted(catalogue.ORACLE_SQL))
def test_query_equals_sql(spark, duck, name):
    got = catalogue.QUERIES[name](spark, SF).toPandas()
    assert same_rows(got, duck.sql(catalogue.ORACLE_SQL[name]).df())


def test_shards_are_crc32(spark):
    import zlib

    rows = catalogue.QUERIES["shard_assignment"](spark, SF).collect()
    assert rows and all(r["shard"] == zlib.crc32(r["series_ticker"].encode()) % 4 for r in rows)


def test_entry(spark):
    import __spark_entry__

    assert __spark_entry__.entry(spark).limit(5).count() == 5
    assert set(__spark_entry__.oracle_sql()) <= set(__spark_entry__.queries())


@pytest.mark.parametrize("name", ["edges_upsert_preserve_review"])
def test_edges_are_not_shuffled(spark, name):
    plan = catalogue.QUERIES[name](spark, SF)._jdf.queryExecution().toString().split("== Physical Plan ==")[1]
    assert "Exchange" not in plan[: plan.index("Generate explode(ys")]
