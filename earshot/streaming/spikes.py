"""Weekly counts of negative contacts as they arrive.

State is one row for each open week and intent.  A week is written once, when the
watermark has passed its end: contacts up to ``delay`` late still count, later
ones are dropped by Spark and show in the query's progress.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from earshot.operators.spikes import find_spikes, weekly_counts


def stream_counts(
    scored: DataFrame, target: str, checkpoint: str, time_col: str = "event_time", by: str = "intent", delay: str = "7 days"
) -> StreamingQuery:
    """Count what has arrived since the last run and stop.  Finished weeks are
    appended to ``target``; the checkpoint makes each count exactly once."""
    counts = weekly_counts(scored.withWatermark(time_col, delay), time_col, by)
    return (
        counts.writeStream.format("parquet").outputMode("append").option("path", target)
        .option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    )


def finished_spikes(spark: SparkSession, target: str, by: str = "intent", **how) -> DataFrame:
    """``find_spikes`` over the weeks that a stream has finished."""
    return find_spikes(spark.read.parquet(target), by, **how)
