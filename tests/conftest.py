from __future__ import annotations

import os
import sys
import tempfile

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)
os.environ["PYTHONPATH"] = os.pathsep.join(filter(None, [ROOT, os.environ.get("PYTHONPATH")]))
SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    from pyspark.sql import SparkSession

    s = (
        SparkSession.builder.master("local[4]")
        .config("spark.sql.shuffle.partitions", "4")
        .config("spark.ui.enabled", "false")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", "4g")
        .config("spark.checkpoint.dir", "file://" + tempfile.mkdtemp(prefix="spark-test-"))
        .getOrCreate()
    )
    s.sparkContext.setLogLevel("ERROR")
    yield s
    s.stop()


def same_rows(a, b) -> bool:
    """Equal columns and rows of two pandas frames, in any order."""
    import pandas as pd

    def rows(x):
        def value(v):
            if v is None or (not isinstance(v, (list, tuple)) and pd.isna(v)):
                return ""
            return repr(round(float(v), 9)) if isinstance(v, (int, float)) and not isinstance(v, bool) else str(v)

        return sorted(tuple(value(v) for v in r) for r in x[sorted(x.columns)].astype(object).itertuples(index=False))

    return sorted(a.columns) == sorted(b.columns) and rows(a) == rows(b)
