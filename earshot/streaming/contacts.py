"""Contacts as they arrive.

Cleaning, rule classification and sentiment look at one row at a time, so the
batch operators run on a stream unchanged: there is no state to keep and no
watermark to set.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from earshot.operators import classify, clean, sentiment
from earshot.sources.contacts import RAW_CONTACT, drop_headers, with_header_field


def stream_contacts(
    spark: SparkSession, folder: str, schema: T.StructType = RAW_CONTACT
) -> DataFrame:
    """New JSON-lines files in a folder, as contacts."""
    reader = spark.readStream.schema(with_header_field(schema)).option("mode", "FAILFAST")
    return drop_headers(reader.json(folder))


def enrich(contacts: DataFrame, on_unknown: str = "error") -> DataFrame:
    """Clean, classify and score sentiment."""
    cleaned = clean.preprocess(contacts, on_unknown=on_unknown)
    return sentiment.score_sentiment(classify.classify_with_confidence(cleaned))


def run_stream(
    spark: SparkSession, folder: str, target: str, checkpoint: str, on_unknown: str = "null"
) -> StreamingQuery:
    """Enrich everything that has arrived since the last run and stop.

    The checkpoint folder makes each file count exactly once.  A contact of an
    unknown channel gets a null text here by default: it should not hold up
    the stream.
    """
    return (
        enrich(stream_contacts(spark, folder), on_unknown)
        .writeStream.format("parquet")
        .option("path", target)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
