"""Tables in the shared folder, for rows that several parts of a plan read."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


#: Rows in a row group of a table whose rows are large: readers hold 4,096 rows at once, but none across row groups.
LARGE_ROWS = 64


def staged(rows: DataFrame, label: str, group_rows: int | None = None) -> DataFrame:
    """The rows from a table written to the folder that driver and executors share (spark.checkpoint.dir), so that what made
    them runs once. In local mode a temporary folder serves where none is set."""
    spark = rows.sparkSession
    base = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not base:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        base = "file://" + tempfile.mkdtemp(prefix="spark-staged-")
        spark.sparkContext.setCheckpointDir(base)
    path = f"{base.rstrip('/')}/{label}-{uuid.uuid4().hex}"
    options = {"parquet.block.row.count.limit": group_rows} if group_rows else {}
    rows.write.options(**options).parquet(path)
    return spark.read.schema(rows.schema).parquet(path)


#: Rows up to which `bounded` broadcasts a table of a few narrow columns: about 8 MB.
BROADCAST_ROWS = 100_000
#: Bytes of text in a table up to which it is broadcast, where its texts may be long.
BROADCAST_BYTES = 8 << 20


def bounded(rows: DataFrame) -> DataFrame:
    """The rows, hinted for broadcast only if they are counted and few enough; else joins shuffle them, whatever the size of their
    files, by which Spark would broadcast many rows."""
    return F.broadcast(rows) if rows.limit(BROADCAST_ROWS + 1).count() <= BROADCAST_ROWS else rows.hint("merge")
