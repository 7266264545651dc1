"""Liveness of sources from a stream of heartbeats. A lease is a session: it is
renewed by each beat and ends when none comes for its length, which the
watermark decides, so late beats and restarts do not matter."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

KEY = ["agent_id", "scope", "source"]


def leases(beats: DataFrame, lease: str = "30 minutes", late: str = "1 minute") -> DataFrame:
    """(key, since, expired_at, beats) of leases that ended. beats: (agent_id, scope, source, ts timestamp)."""
    s = beats.withWatermark("ts", late).groupBy(*KEY, F.session_window("ts", lease).alias("w")).agg(F.count("*").alias("beats"))
    return s.select(*KEY, F.col("w.start").alias("since"), F.col("w.end").alias("expired_at"), "beats")


def not_ready(waits: DataFrame, budget: float, gap: str = "10 minutes", late: str = "1 minute") -> DataFrame:
    """(key, phase, since, attempts, over_budget): spells during which a phase
    answered that it is not ready. The clock starts anew with the next phase or
    after a gap. waits: (agent_id, scope, source, phase, ts timestamp)."""
    s = waits.withWatermark("ts", late).groupBy(*KEY, "phase", F.session_window("ts", gap).alias("w")).agg(F.count("*").alias("attempts"), F.min("ts").alias("since"), F.max("ts").alias("until"))
    return s.select(*KEY, "phase", "since", "attempts", (F.col("until").cast("double") - F.col("since").cast("double") >= budget).alias("over_budget"))


def activity(events: DataFrame, width: str = "5 minutes", late: str = "1 minute") -> DataFrame:
    """(start, status, n): status events by kind in windows of time."""
    w = events.withWatermark("ts", late).groupBy(F.window("ts", width).alias("w"), "status").agg(F.count("*").alias("n"))
    return w.select(F.col("w.start").alias("start"), "status", "n")


def drain(stream: DataFrame, path: str, checkpoint: str) -> StreamingQuery:
    """Append all that the stream has now to a Parquet folder, once, and stop."""
    q = stream.writeStream.format("parquet").option("path", path).option("checkpointLocation", checkpoint).outputMode("append").trigger(availableNow=True).start()
    q.awaitTermination()
    return q
