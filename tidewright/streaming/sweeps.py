"""Passes that come again and again: one at the start, then one every so many
seconds, as a stream of ticks whose batches run the pass."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import SparkSession
from pyspark.sql.streaming import StreamingQuery


def every(spark: SparkSession, seconds: float | None, run: Callable[[], object], checkpoint: str, name: str = "sweep") -> StreamingQuery | None:
    """Call run() every so many seconds; None, and no stream, if that is null or
    not above zero. A pass that fails ends the stream, so that it is seen."""
    if seconds is None or seconds <= 0:
        return None
    ticks = spark.readStream.format("rate").option("rowsPerSecond", 1).load()
    return ticks.writeStream.queryName(name).option("checkpointLocation", checkpoint).trigger(processingTime=f"{int(seconds * 1000)} milliseconds").foreachBatch(lambda _, __: run() and None).start()


def start(spark: SparkSession, seconds: float | None, run: Callable[[], object], checkpoint: str) -> StreamingQuery | None:
    """The pass at the start, then the stream of further ones."""
    run()
    return every(spark, seconds, run, checkpoint)
