"""Reading tables, cutting them to a day, and writing tables."""

from __future__ import annotations

import hashlib
import re
from datetime import date, timedelta

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.functions.dates import DAY_COLUMN, cut_days
from tidemark.sources import versions


def read_table(spark: SparkSession, folder: str, name: str, schema: str | None = None) -> DataFrame:
    """A source table; with its schema given, Spark need not open a file to plan a query."""
    reader = spark.read if schema is None else spark.read.schema(schema)
    return reader.parquet(f"{folder}/{name}.parquet")


def read_mart(spark: SparkSession, folder: str, name: str, /, **equals: object) -> DataFrame:
    """A written result table, optionally only the rows whose columns equal the given values.

    None finds the rows without a value; a value that cannot be of the column's type finds no row.
    """
    mart = versions.read_table_version(versions.latest(spark, folder), spark, name)
    for column, value in equals.items():
        wanted = F.lit(value).try_cast(mart.schema[column].dataType)
        mart = mart.where(F.col(column).isNull() if value is None else F.col(column) == wanted)
    return mart


def query_mart(spark: SparkSession, folder: str, name: str, text: str, /, **args: object) -> DataFrame:
    """SQL over a written result table, `{table}` in the text, with values for its `:name` markers.

    Values are bound, never put into the text, so a quote in one is a character like any other. As in any
    SQL, `= :name` with a NULL finds nothing; `<=>` compares NULLs.
    """
    return spark.sql(text, args=args, table=read_mart(spark, folder, name))


def write_mart(df: DataFrame, folder: str, name: str) -> None:
    """Replace the stored table as a whole: readers see the old one until the new one is there."""
    versions.write_tables(df.sparkSession, folder, {name: df})


def store_by_day(df: DataFrame, folder: str, name: str, ts_col: str = "created_at") -> None:
    """Replace a source table by a copy in one folder per day, for reads that want few days.

    Rebalancing gathers each day's rows into files of a sensible size and splits a day that is too
    big for one task.
    """
    by_day = df.withColumn(DAY_COLUMN, F.to_date(ts_col)).hint("rebalance", DAY_COLUMN)
    by_day.write.mode("overwrite").partitionBy(DAY_COLUMN).parquet(f"{folder}/{name}.parquet")


def replace_days(df: DataFrame, folder: str, name: str, ts_col: str = "created_at") -> None:
    """Replace the days that `df` has rows of in a source table stored by day; its other days stay untouched."""
    by_day = df.withColumn(DAY_COLUMN, F.to_date(ts_col)).hint("rebalance", DAY_COLUMN)
    writer = by_day.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(DAY_COLUMN)
    writer.parquet(f"{folder}/{name}.parquet")


#: The folder of rows without a time.
UNDATED = "__HIVE_DEFAULT_PARTITION__"


def mark_of(parts: list[str]) -> str:
    return hashlib.md5("\n".join(sorted(parts)).encode()).hexdigest()


def day_marks(table: DataFrame) -> dict[str, str]:
    """A mark for each stored day that changes with the names of its files. No file is opened."""
    files: dict[str, list[str]] = {}
    for file in table.inputFiles():
        day = re.search(rf"/{DAY_COLUMN}=([^/]+)/", file)
        if day is None:
            raise ValueError(f"{file} is not in the folder of a day: store the table by day")
        files.setdefault(day[1], []).append(file)
    return {day: mark_of(names) for day, names in files.items()}


def as_of_snapshot(df: DataFrame, as_of: date | None, ts_col: str = "created_at") -> DataFrame:
    """Rows up to and including the `as_of` day, and those without a time; `None` keeps all rows."""
    if as_of is None:
        return df
    return cut_days(df, end=as_of + timedelta(days=1), ts_col=ts_col, undated=True)
