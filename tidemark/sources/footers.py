"""Counts and days of stored tables from what is known about their files; no column is read."""

from __future__ import annotations

from datetime import date
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.sources import versions
from tidemark.sources.tables import UNDATED, day_marks

#: Read Parquet by the source that answers counts from the files' footers.
FOOTER_SETTINGS = {
    "spark.sql.sources.useV1SourceList": "avro,csv,json,kafka,orc,text",
    "spark.sql.parquet.aggregatePushdown": "true",
}


def footer_session(spark: SparkSession) -> SparkSession:
    """A session of the same application with these settings; the caller's own keeps its settings."""
    other = spark.newSession()
    for key in ("spark.sql.session.timeZone", "spark.sql.shuffle.partitions", "spark.sql.ansi.enabled"):
        other.conf.set(key, spark.conf.get(key))
    for key, value in FOOTER_SETTINGS.items():
        other.conf.set(key, value)
    return other


def stored_row_counts(spark: SparkSession, folder: str, names: list[str]) -> DataFrame:
    """As `quality.table_row_counts` of stored tables: table_name, rows.

    Where the source does not answer from footers the rows are counted; the figures are the same.
    """
    version, counting = versions.latest(spark, folder), footer_session(spark)
    counts = [
        versions.read_table_version(version, counting, name).agg(F.count("*").alias("rows")).select(F.lit(name).alias("table_name"), "rows")
        for name in names
    ]
    return reduce(DataFrame.unionByName, counts)


def newest_day(events: DataFrame, as_of: date | None = None) -> date | None:
    """As `events.data_end_date` of a table stored by day, from the names of its folders."""
    days = [date.fromisoformat(day) for day in day_marks(events) if day != UNDATED]
    return max((day for day in days if as_of is None or day <= as_of), default=None)
