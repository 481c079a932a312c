"""Logical tables and the check that a DataFrame carries them."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import types as T

from tidemark.functions.dates import DAY_COLUMN

USERS = T.StructType(
    [
        T.StructField("id", T.LongType()),
        T.StructField("created_at", T.TimestampNTZType()),
        T.StructField("country", T.StringType()),
    ]
)

EVENTS = T.StructType(
    [
        T.StructField("user_id", T.LongType()),
        T.StructField("session_id", T.StringType()),
        T.StructField("event_type", T.StringType()),
        T.StructField("created_at", T.TimestampNTZType()),
        T.StructField("browser", T.StringType()),
    ]
)

SUMMARIES = T.StructType(
    [
        T.StructField("run_id", T.StringType()),
        T.StructField("run_ts", T.TimestampNTZType()),
        T.StructField("data_end_date", T.DateType()),
        T.StructField("text", T.StringType()),
        T.StructField("facts_json", T.StringType()),
        T.StructField("sent_slack_ts", T.StringType()),
        T.StructField("sent_email_id", T.StringType()),
    ]
)

_TIMESTAMPS = (T.TimestampType, T.TimestampNTZType)


def conform(df: DataFrame, schema: T.StructType) -> DataFrame:
    """Pick the schema's columns, failing at plan time if one is missing or of another type.

    Zoned and zone-free timestamps are both accepted. The day column of tables stored by day stays.
    """
    for field in schema:
        if field.name not in df.columns:
            raise ValueError(f"column {field.name} is missing; found {df.columns}")
        found = df.schema[field.name].dataType
        both_timestamps = isinstance(found, _TIMESTAMPS) and isinstance(field.dataType, _TIMESTAMPS)
        if found != field.dataType and not both_timestamps:
            raise ValueError(
                f"column {field.name} is {found.simpleString()}, expected {field.dataType.simpleString()}"
            )
    days = [DAY_COLUMN] if DAY_COLUMN in df.columns else []
    return df.select(*schema.names, *days)
