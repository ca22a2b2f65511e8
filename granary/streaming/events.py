"""Event streams: hourly totals, and an idempotent keyed ingest."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery


def hourly_windows(events: DataFrame, late: str = "2 hours") -> DataFrame:
    """(hour, event_type, n, total), of a table or of a stream with rows up to ``late`` out of order."""
    by = events.withWatermark("ts", late).groupBy(F.window("ts", "1 hour").alias("w"), "event_type")
    out = by.agg(F.count("*").alias("n"), F.sum("value").alias("total"))
    return out.select(F.col("w.start").alias("hour"), "event_type", "n", "total")


def ingest(
    stream: DataFrame, keys: list[str], time: str, write: Callable[[DataFrame, int], None], checkpoint: str, late: str = "2 hours"
) -> StreamingQuery:
    """Hands each micro-batch, without repeated keys, to write; repeats within ``late`` are dropped across batches."""
    unique = stream.withWatermark(time, late).dropDuplicatesWithinWatermark(keys)
    return unique.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
