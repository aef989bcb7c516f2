"""Progress of streaming queries as a table.

    progress = Progress()
    spark.streams.addListener(progress)
    rates(progress.table(spark)), liveness(progress.table(spark), F.current_timestamp())
"""

from __future__ import annotations

from collections import deque

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming.listener import StreamingQueryListener

_SCHEMA = "query string, batch_id long, ts string, rows long, batch_ms long, state_rows long, state_bytes long, dropped_late long, watermark string"


class Progress(StreamingQueryListener):
    """The newest `keep` triggers of the session's queries. Reports are a few numbers of a trigger, whatever its rows."""

    def __init__(self, keep: int = 10_000):
        self.rows: deque[tuple] = deque(maxlen=keep)

    def onQueryStarted(self, event) -> None:
        pass

    def onQueryProgress(self, event) -> None:
        p = event.progress
        state = p.stateOperators
        self.rows.append((
            p.name or str(p.id), p.batchId, p.timestamp, p.numInputRows, p.batchDuration,
            sum(s.numRowsTotal for s in state), sum(s.memoryUsedBytes for s in state), sum(s.numRowsDroppedByWatermark for s in state), p.eventTime.get("watermark"),
        ))

    def onQueryIdle(self, event) -> None:
        pass

    def onQueryTerminated(self, event) -> None:
        pass

    def table(self, spark: SparkSession) -> DataFrame:
        """query, batch_id, ts, rows, batch_ms, state_rows, state_bytes, dropped_late, watermark of each trigger kept."""
        rows = spark.createDataFrame(list(self.rows), _SCHEMA)
        return rows.withColumns({c: F.try_to_timestamp(c) for c in ("ts", "watermark")})


def rates(triggers: DataFrame) -> DataFrame:
    """query, batches, rows, rows_per_second (of the time spent on triggers; null where that is none), mean_batch_ms,
    last_batch_ts, dropped_late."""
    each = triggers.groupBy("query").agg(
        F.count(F.lit(1)).alias("batches"), F.sum("rows").alias("rows"), F.sum("batch_ms").alias("_ms"), F.avg("batch_ms").alias("mean_batch_ms"),
        F.max("ts").alias("last_batch_ts"), F.sum("dropped_late").alias("dropped_late"),
    )
    return each.select("query", "batches", "rows", (F.col("rows") * 1000 / F.nullif("_ms", F.lit(0))).alias("rows_per_second"), "mean_batch_ms", "last_batch_ts", "dropped_late")


def liveness(triggers: DataFrame, now: Column, seconds: int = 90) -> DataFrame:
    """query, age_seconds of its last trigger, alive (not older than the limit)."""
    age = (F.unix_micros(now.cast("timestamp")) - F.unix_micros(F.max("ts"))) / 1e6
    return triggers.groupBy("query").agg(age.alias("age_seconds")).withColumn("alive", F.col("age_seconds") <= seconds)
