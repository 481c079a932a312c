"""A log by day, for the newest record of it: the days' folders are bounds, newest first.

The newest record lies in the newest day, ties and all, so that one day's files answer for the whole log; rows
without a time count only where no row has one.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.functions.columns import column
from tidemark.functions.dates import DAY_COLUMN
from tidemark.operators.tables import latest_record
from tidemark.sources import versions
from tidemark.sources.tables import UNDATED
from tidemark.sources.versions import Version

def _by_day(rows: DataFrame, order_col: str) -> DataFrame:
    return rows.withColumn(DAY_COLUMN, F.to_date(column(order_col)))


def append_log(rows: DataFrame, folder: str, name: str, order_col: str) -> Version:
    """Add rows to a log, which is made if it is not there. Only days that get rows are written."""
    spark = rows.sparkSession
    base = versions.latest(spark, folder)
    stored = base.tables.get(name)
    new = versions.write_table_version(_by_day(rows, order_col), folder, name, DAY_COLUMN)
    grown = [] if stored is None else [part for part in new.parts if part in stored.parts]
    if grown:
        # Days that have rows already are put together with the new ones.
        draft = Version(folder, tables={name: new})
        both = versions.read_table_version(base, spark, name, grown).unionByName(
            versions.read_table_version(draft, spark, name, grown)
        )
        new = versions.replaced(new, versions.write_table_version(both, folder, name, DAY_COLUMN))
    return versions.commit(spark, base, {name: versions.replaced(stored, new)})


def read_log(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return versions.read_table_version(versions.latest(spark, folder), spark, name).drop(DAY_COLUMN)


def latest_in_log(spark: SparkSession, folder: str, name: str, order_col: str, tie_break: str) -> DataFrame:
    """As `latest_record` of the whole log; only the files of its newest day are read."""
    version = versions.latest(spark, folder)
    parts = version.tables[name].parts
    newest = max((part for part in parts if part != UNDATED), default=UNDATED)
    day = versions.read_table_version(version, spark, name, [newest]).drop(DAY_COLUMN)
    return latest_record(day, order_col, tie_break)
