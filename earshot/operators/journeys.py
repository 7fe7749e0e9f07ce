"""What a customer does over time: sessions, repeat contacts, deflection.

Rows are a customer's events with a time.  Nothing gathers a customer's whole
history in one task: events are handled by customer and block of time, and only
a row for each block says what the blocks before or behind hold.  A customer
with very many events is thus as many tasks as they have blocks; a window over a
customer sees blocks, not events.

Rows without customer or time take no part.  Events of equal time are ordered by
id.  Times are compared in microseconds.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

BLOCK_SECONDS = 86_400
_MICROS = 1_000_000


def _blocked(events: DataFrame, key: str, time: str, block_seconds: int) -> DataFrame:
    if block_seconds < 1:
        raise ValueError("a block has at least one second")
    at = F.unix_micros(F.col(time).cast("timestamp"))
    rows = events.where(F.col(key).isNotNull() & F.col(time).isNotNull()).withColumn("_t", at)
    return rows.withColumn("_block", F.floor(F.col("_t") / (block_seconds * _MICROS)).cast("long"))


def sessionise(
    events: DataFrame, gap_seconds: int, key: str = "user_id", time: str = "ts", order: str = "event_id",
    block_seconds: int = BLOCK_SECONDS,
) -> DataFrame:
    """Add ``session``, from 1 for each customer: a new one begins where more
    than ``gap_seconds`` have passed since the event before."""
    gap = gap_seconds * _MICROS
    rows = _blocked(events, key, time, block_seconds)
    inside = Window.partitionBy(key, "_block").orderBy("_t", order)
    begins = F.coalesce(F.col("_t") - F.lag("_t").over(inside) > gap, F.lit(True))
    rows = rows.withColumn("_begins", begins.cast("long")).withColumn("_local", F.sum("_begins").over(inside))
    blocks = rows.groupBy(key, "_block").agg(
        F.max("_local").alias("_n"), F.min("_t").alias("_first"), F.max("_t").alias("_last")
    )
    by_block = Window.partitionBy(key).orderBy("_block")
    # A block's first session may go on from the block before.
    goes_on = F.coalesce(F.col("_first") - F.lag("_last").over(by_block) <= gap, F.lit(False)).cast("long")
    blocks = blocks.withColumn("_goes_on", goes_on)
    before = F.sum(F.col("_n") - F.col("_goes_on")).over(by_block.rowsBetween(Window.unboundedPreceding, -1))
    blocks = blocks.select(key, "_block", (F.coalesce(before, F.lit(0)) - F.col("_goes_on")).alias("_shift"))
    numbered = rows.join(blocks, [key, "_block"]).withColumn("session", F.col("_local") + F.col("_shift"))
    return numbered.select(*events.columns, "session")


def sessions(
    events: DataFrame, gap_seconds: int, key: str = "user_id", time: str = "ts", order: str = "event_id",
    block_seconds: int = BLOCK_SECONDS,
) -> DataFrame:
    """(customer, session, started, ended, n) of every session."""
    numbered = sessionise(events, gap_seconds, key, time, order, block_seconds)
    return numbered.groupBy(key, "session").agg(
        F.min(time).alias("started"), F.max(time).alias("ended"), F.count("*").alias("n")
    )


def next_event(
    events: DataFrame, wanted: Column, within_seconds: int | None = None, key: str = "user_id", time: str = "ts",
    order: str = "event_id", block_seconds: int = BLOCK_SECONDS,
) -> DataFrame:
    """Add ``next_id`` and ``next_time``: the customer's first later event that
    is ``wanted``, if it comes within the given time; else null."""
    rows = _blocked(events, key, time, block_seconds)
    rows = rows.withColumn("_hit", F.when(wanted, F.struct("_t", F.col(order).alias("id"), F.col(time).alias("at"))))
    # From the last event to the first, so that the frame only grows.
    later = Window.partitionBy(key, "_block").orderBy(F.desc("_t"), F.desc(order)).rowsBetween(Window.unboundedPreceding, -1)
    rows = rows.withColumn("_own", F.last("_hit", ignorenulls=True).over(later))
    blocks = rows.groupBy(key, "_block").agg(F.min("_hit").alias("_first"))
    behind = Window.partitionBy(key).orderBy(F.desc("_block")).rowsBetween(Window.unboundedPreceding, -1)
    blocks = blocks.select(key, "_block", F.last("_first", ignorenulls=True).over(behind).alias("_behind"))
    found = rows.join(blocks, [key, "_block"]).withColumn("_next", F.coalesce("_own", "_behind"))
    if within_seconds is not None:
        near = F.col("_next._t") - F.col("_t") <= within_seconds * _MICROS
        found = found.withColumn("_next", F.when(near, F.col("_next")))
    return found.select(*events.columns, F.col("_next.id").alias("next_id"), F.col("_next.at").alias("next_time"))


def repeat_contacts(
    events: DataFrame, contact: Column, within_seconds: int, by: str = "event_type", key: str = "user_id",
    time: str = "ts", order: str = "event_id", block_seconds: int = BLOCK_SECONDS,
) -> DataFrame:
    """(by, contacts, repeated, rate): contacts that the same customer followed
    by another one within the given time."""
    found = next_event(events, contact, within_seconds, key, time, order, block_seconds).where(contact)
    counted = found.groupBy(by).agg(F.count("*").alias("contacts"), F.count("next_id").alias("repeated"))
    return counted.withColumn("rate", F.col("repeated") / F.col("contacts"))


def deflection(
    events: DataFrame, self_service: Column, contact: Column, within_seconds: int, by: str = "event_type",
    key: str = "user_id", time: str = "ts", order: str = "event_id", block_seconds: int = BLOCK_SECONDS,
) -> DataFrame:
    """(by, visits, deflected, rate): visits to self-service after which the
    customer made no contact within the given time."""
    found = next_event(events, contact, within_seconds, key, time, order, block_seconds).where(self_service)
    counted = found.groupBy(by).agg(
        F.count("*").alias("visits"), F.count_if(F.col("next_id").isNull()).alias("deflected")
    )
    return counted.withColumn("rate", F.col("deflected") / F.col("visits"))
