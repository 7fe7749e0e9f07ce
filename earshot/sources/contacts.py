"""Contacts as JSON lines or parquet."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

RAW_CONTACT = T.StructType(
    [
        T.StructField("contact_id", T.StringType()),
        T.StructField("channel", T.StringType()),
        T.StructField("intent", T.StringType()),
        T.StructField("vulnerability_flag", T.BooleanType()),
        T.StructField("urgency_flag", T.BooleanType()),
        T.StructField("customer_placeholder", T.StringType()),
        T.StructField("text", T.StringType()),
    ]
)

CLEANED_CONTACT = T.StructType([*RAW_CONTACT.fields, T.StructField("cleaned_text", T.StringType())])

SCORED_CONTACT = T.StructType(
    [
        *CLEANED_CONTACT.fields,
        T.StructField("sentiment_label", T.StringType()),
        T.StructField("sentiment_confidence", T.DoubleType()),
        T.StructField(
            "sentiment_scores",
            T.StructType(
                [T.StructField(n, T.DoubleType()) for n in ("negative", "neutral", "positive")]
            ),
        ),
    ]
)

# Fixed value: an object with this key is a notice, not a contact.
HEADER_KEY = "_HEADER"


def with_header_field(schema: T.StructType) -> T.StructType:
    return T.StructType([*schema.fields, T.StructField(HEADER_KEY, T.StringType())])


def drop_headers(rows: DataFrame) -> DataFrame:
    return rows.where(F.col(HEADER_KEY).isNull()).drop(HEADER_KEY)


# Column that holds the keys a schema does not name, as JSON values.
EXTRA = "extra"


def read_contacts(
    spark: SparkSession, path: str, schema: T.StructType = RAW_CONTACT, keep_extra: bool = False
) -> DataFrame:
    """Contacts from JSON lines.  The schema is given, so there is no
    inference pass; notice objects are skipped; a malformed line fails.

    With ``keep_extra``, keys outside the schema come as the column ``extra``,
    map<string, variant>, which ``write_contacts`` writes back as keys."""
    if keep_extra:
        lines = spark.read.text(path).where(F.trim("value") != "")
        known = F.from_json("value", with_header_field(schema), {"mode": "FAILFAST"})
        other = F.map_filter(
            F.from_json("value", "map<string, variant>"), lambda k, _: ~k.isin([*schema.fieldNames(), HEADER_KEY])
        )
        return drop_headers(lines.select(known.alias("row"), other.alias(EXTRA)).select("row.*", EXTRA))
    reader = spark.read.schema(with_header_field(schema)).option("mode", "FAILFAST")
    return drop_headers(reader.json(path))


def write_contacts(
    contacts: DataFrame, path: str, notice: str | None = None, compression: str = "none"
) -> None:
    """Write JSON lines, replacing what is there; null fields are kept.

    The notice, if any, goes into its own part file as a header object, which
    ``read_contacts`` skips; it is not repeated in every part.
    """
    options = {"ignoreNullFields": "false", "compression": compression}
    if EXTRA in contacts.columns:
        known = F.to_json(F.struct(*(c for c in contacts.columns if c != EXTRA)), {"ignoreNullFields": "false"})
        other = F.coalesce(F.to_json(EXTRA), F.lit("{}"))
        without_end = F.substring(known, F.lit(1), F.length(known) - 1)
        joined = F.concat(without_end, F.lit(","), F.substring(other, F.lit(2), F.length(other)))
        line = F.when(other == "{}", known).otherwise(joined)
        contacts.select(line.alias("value")).write.mode("overwrite").option("compression", compression).text(path)
    else:
        contacts.write.mode("overwrite").options(**options).json(path)
    if notice is not None:
        header = contacts.sparkSession.range(1).select(F.lit(notice).alias(HEADER_KEY))
        header.write.mode("append").json(path)


def write_parquet(contacts: DataFrame, path: str) -> None:
    """Columnar hand-off between stages: later stages read only the columns
    they use."""
    contacts.write.mode("overwrite").parquet(path)
