"""Exact sets of users as bitmaps, kept by day and put together without looking at events again.

A set has a row for each day and bucket of 32,768 neighbouring ids, 4 KB where any of them occurs. Sets of several
days are joined bit by bit, so that distinct users of months, trailing days and cohorts follow from stored days.
Negative ids have buckets of their own; ids far apart have a bucket each, which is right but larger than a list
of them. A missing id is in no set; its bucket is NULL, so that a day with nothing else is still there.
"""

from __future__ import annotations

from datetime import date

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.functions.dates import DAY_COLUMN, cut_days, cut_since, day_of, days_before, first_of_month, months_apart
from tidemark.sources.tables import as_of_snapshot


def _sets(rows: DataFrame, user: str, *extra: Column) -> DataFrame:
    return rows.groupBy(DAY_COLUMN, F.bitmap_bucket_number(user).alias("bucket")).agg(
        F.bitmap_construct_agg(F.bitmap_bit_position(user)).alias("users"), *extra
    )


def user_sets(events: DataFrame) -> DataFrame:
    """created_day, bucket, users: who had an event on which day. Each user and day is one row before the sort."""
    seen = events.select("user_id", day_of(events).alias(DAY_COLUMN)).distinct()
    return _sets(seen, "user_id").select("bucket", "users", DAY_COLUMN)


def signup_sets(users: DataFrame) -> DataFrame:
    """created_day, bucket, users, signups: who signed up on which day, and how many rows said so."""
    signed = users.groupBy("id", day_of(users).alias(DAY_COLUMN)).agg(F.count("*").alias("signups"))
    return _sets(signed, "id", F.sum("signups").alias("signups")).select("bucket", "users", "signups", DAY_COLUMN)


def _joined(sets: DataFrame, *keys: Column | str) -> DataFrame:
    return sets.groupBy(*keys, "bucket").agg(F.bitmap_or_agg("users").alias("users"))


def _month() -> Column:
    return F.trunc(DAY_COLUMN, "MM")


def mau_monthly(sets: DataFrame, as_of: date) -> DataFrame:
    """As `events.mau_monthly`."""
    months = _joined(cut_days(sets, end=first_of_month(as_of)), _month().alias("month"))
    return months.groupBy("month").agg(F.sum(F.bitmap_count("users")).alias("mau")).orderBy("month")


def active_users_trailing(sets: DataFrame, as_of: date, days: int = 30) -> DataFrame:
    """As `events.active_users_trailing`."""
    seen = _joined(cut_days(sets, days_before(as_of, days), as_of))
    return seen.agg(F.coalesce(F.sum(F.bitmap_count("users")), F.lit(0)).alias(f"mau_{days}_days"))


def retention_cohorts(
    signups: DataFrame,
    sets: DataFrame,
    as_of: date,
    max_cohorts: int = 4,
    min_size: int = 50,
    max_age: int = 4,
) -> DataFrame:
    """As `users.retention_cohorts`: a cohort's bitmap and a month's are laid on each other bucket by bucket."""
    monthly = cut_days(signups, end=first_of_month(as_of)).withColumn("cohort_month", _month())
    cohorts = (
        monthly.groupBy("cohort_month")
        .agg(F.sum("signups").alias("cohort_size"))
        .orderBy(F.desc("cohort_month"))
        .limit(max_cohorts)
        .where(F.col("cohort_size") >= min_size)
    )
    oldest = cohorts.agg(F.min("cohort_month").alias("oldest"))
    members = _joined(cut_since(monthly, oldest), "cohort_month").join(cohorts, "cohort_month")
    active = _joined(cut_since(as_of_snapshot(sets, as_of), oldest), _month().alias("active_month"))
    age = months_apart(F.col("active_month"), F.col("cohort_month"))
    both = (
        members.join(active.withColumnRenamed("users", "active"), "bucket")
        .withColumn("age_month", age)
        .where(F.col("age_month").between(1, max_age))
        .select("cohort_month", "cohort_size", "age_month", "bucket", F.explode(F.array("users", "active")).alias("users"))
        .groupBy("cohort_month", "cohort_size", "age_month", "bucket")
        .agg(F.bitmap_and_agg("users").alias("users"))
    )
    later = (
        both.groupBy("cohort_month", "cohort_size", "age_month")
        .agg(F.sum(F.bitmap_count("users")).alias("active_users"))
        .where(F.col("active_users") > 0)
    )
    start = cohorts.select("cohort_month", "cohort_size", F.lit(0).alias("age_month"), F.col("cohort_size").alias("active_users"))
    return (
        start.unionByName(later)
        .select(
            "cohort_month",
            F.date_format("cohort_month", "yyyy-MM").alias("cohort_label"),
            "age_month",
            F.try_divide("active_users", "cohort_size").alias("retention_rate"),
        )
        .orderBy("cohort_month", "age_month")
    )
