"""Tables bucketed and sorted by user: joins and groupings by user need no shuffle.

What is stored is reduced first, so that a user with a third of all events has a few rows for each day, and the
bucket that holds such a user is like any other. Users and events get the same number of buckets; the
operators stay as they are, the planner sees the layout.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.functions.dates import day_of
from tidemark.functions.names import SHOPPING_STEPS


def step_days(events: DataFrame) -> DataFrame:
    """The first event of each user, day and kind of funnel step, as events: all that registration funnels look at.

    Dated rows of known users only; combined on the map side.
    """
    return (
        events.where(F.col("event_type").isin(list(SHOPPING_STEPS)) & F.col("user_id").isNotNull())
        .groupBy("user_id", "event_type", day_of(events).alias("day"))
        .agg(F.min("created_at").alias("created_at"))
        .where(F.col("day").isNotNull())
        .select(
            "user_id",
            F.lit(None).cast("string").alias("session_id"),
            "event_type",
            "created_at",
            F.lit(None).cast("string").alias("browser"),
        )
    )


def store_by_user(df: DataFrame, table: str, path: str, user_col: str, buckets: int) -> None:
    """Replace a catalog table by one in so many buckets of `user_col`, each sorted, one file for each bucket."""
    dealt = df.repartition(buckets, F.col(user_col))
    dealt.write.mode("overwrite").bucketBy(buckets, user_col).sortBy(user_col).option("path", path).saveAsTable(table)


def read_by_user(spark: SparkSession, table: str) -> DataFrame:
    return spark.table(table)
