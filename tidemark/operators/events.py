"""Metrics over the events table."""

from __future__ import annotations

from datetime import date

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.functions.dates import cut_days, day_of, days_before, first_of_month, month_of
from tidemark.functions.names import PLATFORMS, SHOPPING_STEPS, platform_browser, platform_code, platform_name
from tidemark.sources.tables import as_of_snapshot


def data_end_date(events: DataFrame, as_of: date | None = None) -> DataFrame:
    """The latest day with an event."""
    return as_of_snapshot(events, as_of).agg(F.max(day_of(events)).alias("data_end_date"))


def mau_monthly(events: DataFrame, as_of: date) -> DataFrame:
    """Distinct users per calendar month, for the months before the one `as_of` lies in."""
    return (
        cut_days(events, end=first_of_month(as_of))
        .groupBy(month_of(events).alias("month"))
        .agg(F.count_distinct("user_id").alias("mau"))
        .orderBy("month")
    )


def mau_recent(mau: DataFrame, months: int = 18) -> DataFrame:
    """The newest `months` rows of `mau_monthly`, newest first."""
    return mau.orderBy(F.desc("month")).limit(months)


def _trailing(events: DataFrame, as_of: date, days: int) -> DataFrame:
    return cut_days(events, days_before(as_of, days), as_of)


def active_users_trailing(events: DataFrame, as_of: date, days: int = 30) -> DataFrame:
    """Distinct users in the `days` days before `as_of`; the `as_of` day itself does not count."""
    return _trailing(events, as_of, days).agg(F.count_distinct("user_id").alias(f"mau_{days}_days"))


def session_steps(events: DataFrame, steps: list[str]) -> DataFrame:
    """One boolean per step and session: did the session have such an event?

    Events of other types cannot set a flag, so they are dropped before the shuffle. The flags are
    combined on the map side: a session of any size reaches the reducer as one row per map task.
    """
    flags: list[Column] = [F.bool_or(F.col("event_type") == step).alias(step) for step in steps]
    return events.where(F.col("event_type").isin(steps)).groupBy("session_id").agg(*flags)


def session_conversion_trailing(events: DataFrame, as_of: date, days: int = 30) -> DataFrame:
    """Sessions that saw a product, those of them that also bought, and the ratio (NULL without any)."""
    sessions = session_steps(_trailing(events, as_of, days), ["product", "purchase"])
    counts = sessions.agg(
        F.count_if("product").alias("product_sessions"),
        F.count_if(F.col("product") & F.col("purchase")).alias("purchase_sessions"),
    )
    return counts.withColumn(
        "purchase_conversion_rate", F.try_divide("purchase_sessions", "product_sessions")
    )


def session_days(events: DataFrame, as_of: date) -> DataFrame:
    """Which sessions had which kind of shopping event on which day of the last month and a half, as events.

    The days are those any session metric as of that day looks at.
    """
    start = min(first_of_month(as_of, -1), days_before(as_of, 30))
    return all_session_days(cut_days(events, start, as_of))


def all_session_days(events: DataFrame) -> DataFrame:
    """Which sessions had which kind of shopping event on which day, as events."""
    return (
        events.where(F.col("event_type").isin(list(SHOPPING_STEPS)))
        .groupBy("session_id", "event_type", day_of(events).alias("day"))
        .agg(F.count("*").alias("events"))
        .select(
            F.lit(None).cast("long").alias("user_id"),
            "session_id",
            "event_type",
            F.col("day").cast("timestamp_ntz").alias("created_at"),
            F.lit(None).cast("string").alias("browser"),
        )
    )


def _placed(events: DataFrame) -> Column:
    """Time and platform as one number, later and then greater by name being greater."""
    instant = F.coalesce(F.unix_micros(F.col("created_at").cast("timestamp")), F.lit(-(2**60)))
    return instant * len(PLATFORMS) + platform_code(F.col("browser"))


def user_days(events: DataFrame, as_of: date | None) -> DataFrame:
    """One event for each user and day, the day's latest by time and platform, as events.

    A user with a third of all events is combined on the map side to one row for each day and task.
    """
    return latest_in(as_of_snapshot(events, as_of), day_of(events))


def latest_in(events: DataFrame, period: Column) -> DataFrame:
    """One event for each user and period, the latest by time and platform, as events."""
    return (
        events.groupBy("user_id", period.alias("period"))
        .agg(F.max("created_at").alias("created_at"), F.max(_placed(events)).alias("latest"))
        .select(
            "user_id",
            F.lit(None).cast("string").alias("session_id"),
            F.lit(None).cast("string").alias("event_type"),
            "created_at",
            platform_browser(F.pmod("latest", F.lit(len(PLATFORMS))).cast("int")).alias("browser"),
        )
    )


def kpi_metrics(
    events: DataFrame | None, as_of: date, sessions: DataFrame | None = None, active_users: DataFrame | None = None
) -> DataFrame:
    """One row: the `as_of` day, active users and purchase conversion of the 30 days before it.

    The sessions and the count of active users can come from tables of their own.
    """
    if active_users is None:
        active_users = active_users_trailing(events, as_of)
    return session_conversion_trailing(events if sessions is None else sessions, as_of).select(
        F.lit(as_of.isoformat()).alias("last_updated_date"),
        active_users.scalar().alias("mau_30_days"),
        "purchase_conversion_rate",
    )


def platform_share(events: DataFrame, as_of: date | None = None) -> DataFrame:
    """Users per platform of their latest event, and each platform's share of all users.

    Time and platform travel as one number, so that "latest" is a plain `max`: a hash aggregate with
    map-side combine instead of a sort per user. Events of one user at the same instant are settled
    by platform name, events without a time are the earliest. Events without a user count as one user
    together.
    """
    per_instant = len(PLATFORMS)
    latest = as_of_snapshot(events, as_of).groupBy("user_id").agg(F.max(_placed(events)).alias("latest"))
    users = latest.groupBy(F.pmod("latest", F.lit(per_instant)).cast("int").alias("code")).agg(
        F.count("*").alias("users")
    )
    # The global window below sees one row per platform.
    return users.select(
        platform_name(F.col("code")).alias("platform"),
        "users",
        F.try_divide("users", F.expr("sum(users) OVER ()")).alias("share"),
    ).orderBy(F.desc("users"), "platform")
