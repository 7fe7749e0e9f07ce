"""Channel-aware cleaning."""

from __future__ import annotations

from pyspark.sql import DataFrame

from earshot.functions.channels import clean_by_channel


def preprocess(
    contacts: DataFrame,
    channel_col: str = "channel",
    text_col: str = "text",
    output_col: str = "cleaned_text",
    on_unknown: str = "error",
) -> DataFrame:
    """Add ``cleaned_text``; all other columns pass through.

    One projection, so it runs on batch and streaming DataFrames alike.
    """
    return contacts.withColumn(
        output_col, clean_by_channel(channel_col, text_col, on_unknown)
    )
