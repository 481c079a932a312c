"""Metrics over the users table, and retention over users and events."""

from __future__ import annotations

from datetime import date

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.functions.dates import (
    cut_days,
    cut_since,
    day_of,
    days_before,
    first_of_month,
    month_of,
    months_apart,
)
from tidemark.functions.names import COUNTRY_NAMES
from tidemark.sources.tables import as_of_snapshot


def standard_countries(users: DataFrame, names: dict[str, str] = COUNTRY_NAMES) -> DataFrame:
    """Users with a country, under the country's standard name."""
    return users.where(F.col("country").isNotNull()).replace(names, subset=["country"])


#: Column of tables that hold a row for each country and day instead of each user.
SIGNUPS = "signups"


def _users(users: DataFrame) -> Column:
    """How many users a row stands for."""
    return F.col(SIGNUPS) if SIGNUPS in users.columns else F.lit(1)


def country_days(users: DataFrame, as_of: date | None) -> DataFrame:
    """Signups for each country and day, as a users table without ids; users without a country too."""
    return (
        as_of_snapshot(users, as_of)
        .groupBy("country", day_of(users).alias("day"))
        .agg(F.count("*").alias(SIGNUPS))
        .select(
            F.lit(None).cast("long").alias("id"), F.col("day").cast("timestamp_ntz").alias("created_at"), "country", SIGNUPS
        )
    )


def users_by_country(
    users: DataFrame, as_of: date | None = None, names: dict[str, str] = COUNTRY_NAMES
) -> DataFrame:
    return (
        standard_countries(as_of_snapshot(users, as_of), names)
        .groupBy("country")
        .agg(F.sum(_users(users)).alias("users"))
        .orderBy(F.desc("users"), "country")
    )


def _country_periods(users: DataFrame, as_of: date, days: int, names: dict[str, str]) -> DataFrame:
    """Per country: all users so far, signups of the current and of the previous period, in one pass.

    The current period runs up to the end of the `as_of` day, the previous one lies just before it.
    """
    current_start, previous_start = days_before(as_of, days), days_before(as_of, 2 * days)
    day, count = day_of(users), _users(users)

    def counted(when: Column) -> Column:
        return F.sum(F.when(when, count).otherwise(0))

    return (
        standard_countries(as_of_snapshot(users, as_of), names)
        .groupBy("country")
        .agg(
            F.sum(count).alias("base"),
            counted(day >= current_start).alias("current_users"),
            counted((day >= previous_start) & (day < current_start)).alias("previous_users"),
        )
        .where(F.col("previous_users") > 0)
    )


def country_trends(
    users: DataFrame,
    as_of: date,
    days: int = 30,
    min_previous: int = 10,
    k: int = 5,
    names: dict[str, str] = COUNTRY_NAMES,
) -> DataFrame:
    """The `k` fastest growing and the `k` fastest shrinking countries against the previous period.

    A country in both lists counts as growing. Equal changes are settled by country name.
    """
    recent = cut_days(users, start=days_before(as_of, 2 * days))
    change = F.try_divide(F.col("current_users") - F.col("previous_users"), "previous_users")
    changes = (
        _country_periods(recent, as_of, days, names)
        .where(F.col("previous_users") >= min_previous)
        .select("country", "current_users", "previous_users", change.alias("pct_change"))
    )
    # Two top-k lists instead of ranks over all countries: each task keeps k rows.
    growth = changes.orderBy(F.desc("pct_change"), "country").limit(k)
    decline = changes.orderBy(F.asc("pct_change"), "country").limit(k)
    listed = growth.withColumn("grows", F.lit(True)).unionByName(decline.withColumn("grows", F.lit(False)))
    return (
        listed.groupBy(*changes.columns)
        .agg(F.bool_or("grows").alias("grows"))
        .withColumn("trend_type", F.when(F.col("grows"), "Top Growth").otherwise("Top Decline"))
        .drop("grows")
        .orderBy(F.desc("pct_change"), "country")
    )


def country_increases(
    users: DataFrame,
    as_of: date,
    min_base: int = 50,
    k: int = 3,
    days: int = 30,
    names: dict[str, str] = COUNTRY_NAMES,
) -> DataFrame:
    """Countries by current signups in percent of all their users."""
    return (
        _country_periods(users, as_of, days, names)
        .where((F.col("current_users") > 0) & (F.col("base") >= min_base))
        .select(
            "country",
            F.col("current_users").alias("increase_number"),
            (F.try_divide("current_users", "base") * 100).alias("increase_percentage"),
        )
        .orderBy(F.desc("increase_percentage"), "country")
        .limit(k)
    )


def country_decreases(
    users: DataFrame,
    as_of: date,
    min_base: int = 50,
    min_previous: int = 10,
    k: int = 3,
    days: int = 30,
    names: dict[str, str] = COUNTRY_NAMES,
) -> DataFrame:
    """Countries by the fall in signups since the previous period, in percent of all their users."""
    lost = F.col("previous_users") - F.col("current_users")
    return (
        _country_periods(users, as_of, days, names)
        .where((lost > 0) & (F.col("base") >= min_base) & (F.col("previous_users") >= min_previous))
        .select(
            "country",
            lost.alias("decrease_number"),
            (F.try_divide(lost, "base") * 100).alias("decrease_percentage"),
        )
        .orderBy(F.desc("decrease_percentage"), "country")
        .limit(k)
    )


def retention_cohorts(
    users: DataFrame,
    events: DataFrame,
    as_of: date,
    max_cohorts: int = 4,
    min_size: int = 50,
    max_age: int = 4,
) -> DataFrame:
    """Share of each monthly signup cohort that was active 0 to `max_age` months later.

    The newest `max_cohorts` cohorts are picked first and only then checked for `min_size`. Month 0
    is the whole cohort. Activity includes the running month, cohorts do not.
    """
    signups = cut_days(users, end=first_of_month(as_of)).withColumn("cohort_month", month_of(users))
    cohorts = (
        signups.groupBy("cohort_month")
        .agg(F.count("*").alias("cohort_size"))
        .orderBy(F.desc("cohort_month"))
        .limit(max_cohorts)
        .where(F.col("cohort_size") >= min_size)
    )
    # Neither older signups nor earlier events can matter. The bound is known once the few cohorts are.
    oldest = cohorts.agg(F.min("cohort_month").alias("oldest"))
    members = (
        cut_since(signups, oldest)
        .select(F.col("id").alias("user_id"), "cohort_month")
        .join(cohorts, "cohort_month")
    )

    # One row per user and month: a busy user cannot skew the join.
    activity = (
        cut_since(as_of_snapshot(events, as_of), oldest)
        .where(F.col("user_id").isNotNull())
        .select("user_id", month_of(events).alias("active_month"))
        .distinct()
    )
    later = (
        members.join(activity, "user_id")
        .withColumn("age_month", months_apart(F.col("active_month"), F.col("cohort_month")))
        .where(F.col("age_month").between(1, max_age))
        .groupBy("cohort_month", "cohort_size", "age_month")
        .agg(F.count_distinct("user_id").alias("active_users"))
    )
    start = cohorts.select(
        "cohort_month",
        "cohort_size",
        F.lit(0).alias("age_month"),
        F.col("cohort_size").alias("active_users"),
    )
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
