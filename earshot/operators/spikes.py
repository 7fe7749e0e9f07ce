"""Weeks in which contacts of an intent turn unusually negative.

A week's share of negative contacts is held against the weeks before: median and
median absolute deviation, which a spike among them does not move.  The counts
are one partial aggregation, which also runs on a stream (``streaming.spikes``);
everything after it works on a row for each week and intent.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from earshot import constants as C

# Weeks begin on Monday, UTC; day 0 of Unix time is a Thursday.
WEEK, MONDAY = "7 days", "4 days"
# What makes a median absolute deviation comparable with a standard deviation.
MAD_SCALE = 1.4826
LEAST_SPREAD = 0.01


def weekly_counts(scored: DataFrame, time_col: str = "event_time", by: str = "intent") -> DataFrame:
    """(week, by, n, negative) of contacts with a ``sentiment_label``; contacts
    without intent count as unknown, those without time nowhere."""
    known = F.coalesce(F.col(by), F.lit(C.UNKNOWN_INTENT)).alias(by)
    negative = (F.col("sentiment_label") == C.SENTIMENT_LABELS[0]).cast("long")
    rows = scored.where(F.col(time_col).isNotNull())
    counted = rows.groupBy(F.window(time_col, WEEK, startTime=MONDAY), known).agg(
        F.count("*").alias("n"), F.sum(F.coalesce(negative, F.lit(0))).alias("negative")
    )
    return counted.select(F.col("window.start").alias("week"), by, "n", "negative")


def _median(values: Column) -> Column:
    ordered, n = F.array_sort(values), F.size(values)
    middle = lambda at: F.get(ordered, F.floor(at / 2).cast("int"))
    return (middle(n - 1) + middle(n)) / 2


def find_spikes(
    counts: DataFrame, by: str = "intent", history: int = 8, least_weeks: int = 3, least_contacts: int = 5, limit: float = 3.0
) -> DataFrame:
    """(week, by, n, negative, share, usual, z, spike) of every week.

    ``usual`` is the median share of up to ``history`` earlier weeks that had
    contacts, ``z`` how many deviations the week's share lies above it; both are
    null with fewer than ``least_weeks`` of them.  The deviation is the larger of
    that of the weeks before and that of chance in n contacts.
    """
    share = F.col("negative") / F.col("n")
    earlier = Window.partitionBy(by).orderBy("week").rowsBetween(-history, -1)
    rows = counts.withColumn("share", share).withColumn("_before", F.collect_list("share").over(earlier))
    enough = F.size("_before") >= least_weeks
    rows = rows.withColumn("usual", F.when(enough, _median(F.col("_before"))))
    apart = _median(F.transform("_before", lambda s: F.abs(s - F.col("usual"))))
    chance = F.sqrt(F.col("usual") * (1 - F.col("usual")) / F.col("n"))
    spread = F.greatest(MAD_SCALE * apart, chance, F.lit(LEAST_SPREAD))
    rows = rows.withColumn("z", F.when(enough, (F.col("share") - F.col("usual")) / spread))
    spike = F.coalesce((F.col("z") >= limit) & (F.col("n") >= least_contacts), F.lit(False))
    return rows.withColumn("spike", spike).drop("_before")
