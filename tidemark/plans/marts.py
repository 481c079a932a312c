"""The result tables: build, store, publish."""

from __future__ import annotations

from datetime import date

from pyspark.sql import DataFrame, Observation, SparkSession

from tidemark.functions.names import COUNTRY_NAMES
from tidemark.operators import events as ev
from tidemark.operators import funnels, users
from tidemark.operators.quality import NULLS, REQUIRED_COLUMNS, measures
from tidemark.operators.tables import export_stringify
from tidemark.sources import versions

# The tables readers get, besides the summaries.
MARTS = [
    "mau",
    "retention",
    "users_by_country",
    "platform_share",
    "funnel",
    "data_end_date",
    "country_trends",
    "country_increases",
    "country_decreases",
    "kpi_metrics",
]


# Tables that the marts share, each one pass over a raw table, kept beside the marts.
SHARED = ["shared_user_days", "shared_session_days", "shared_country_days"]


def shared_tables(user_table: DataFrame, event_table: DataFrame, as_of: date) -> dict[str, DataFrame]:
    """The raw tables, reduced to what the marts can tell apart, not yet computed.

    Users and their days, with the browser of the day's latest event; session and day and kind of event;
    country and signup day with a count. They have the raw tables' columns, so that every mart is the
    same operator on a smaller table.
    """
    return {
        "shared_user_days": ev.user_days(event_table, as_of),
        "shared_session_days": ev.session_days(event_table, as_of),
        "shared_country_days": users.country_days(user_table, as_of),
    }


def build_marts(
    user_table: DataFrame,
    event_table: DataFrame,
    as_of: date,
    names: dict[str, str] = COUNTRY_NAMES,
    shared: dict[str, DataFrame] | None = None,
) -> dict[str, DataFrame]:
    """All result tables as of one day, not yet computed; from the shared tables where they are given.

    Retention then needs the ids of the few newest cohorts, and so reads the users once more.
    """
    if shared is not None:
        days, sessions, countries = (shared[name] for name in SHARED)
        return _build(user_table, days, sessions, countries, as_of, names)
    return _build(user_table, event_table, event_table, user_table, as_of, names)


def _build(
    user_table: DataFrame,
    event_table: DataFrame,
    sessions: DataFrame,
    countries: DataFrame,
    as_of: date,
    names: dict[str, str],
) -> dict[str, DataFrame]:
    return {
        "mau": ev.mau_monthly(event_table, as_of),
        "retention": users.retention_cohorts(user_table, event_table, as_of),
        "users_by_country": users.users_by_country(countries, as_of, names),
        "platform_share": ev.platform_share(event_table, as_of),
        "funnel": funnels.session_funnel(sessions, as_of),
        "data_end_date": ev.data_end_date(event_table, as_of),
        "country_trends": users.country_trends(countries, as_of, names=names),
        "country_increases": users.country_increases(countries, as_of, names=names),
        "country_decreases": users.country_decreases(countries, as_of, names=names),
        "kpi_metrics": ev.kpi_metrics(event_table, as_of, sessions),
    }


def refresh_marts(
    user_table: DataFrame,
    event_table: DataFrame,
    as_of: date,
    folder: str,
    names: dict[str, str] = COUNTRY_NAMES,
) -> None:
    """Build and store all result tables with one pass over the raw events for each shared table.

    The shared tables are written to the folder of the marts first; that folder is on storage that all
    executors share, so a lost executor costs its tasks only. Readers see all new tables at once.
    """
    spark = event_table.sparkSession
    base = versions.latest(spark, folder)
    tables = {
        name: versions.write_table_version(df, folder, name)
        for name, df in shared_tables(user_table, event_table, as_of).items()
    }
    drafts = versions.Version(folder, tables=tables)
    shared = {name: versions.read_table_version(drafts, spark, name) for name in SHARED}
    for name, mart in build_marts(user_table, event_table, as_of, names, shared).items():
        tables[name] = versions.write_table_version(mart, folder, name)
    versions.commit(spark, base, tables)


def store_marts(marts: dict[str, DataFrame], folder: str) -> None:
    """Compute each table once and replace its stored form; readers see all new tables at once."""
    spark = next(iter(marts.values())).sparkSession
    versions.write_tables(spark, folder, marts)


def stored_marts(spark: SparkSession, folder: str, names: list[str] = MARTS) -> dict[str, DataFrame]:
    """Stored tables, all of one version."""
    version = versions.latest(spark, folder)
    return {name: versions.read_table_version(version, spark, name) for name in names}


class FailedCheck(RuntimeError):
    """A table broke a rule; nothing was published."""


def publish(
    marts: dict[str, DataFrame], folder: str, required: dict[str, list[str]] = REQUIRED_COLUMNS
) -> dict[str, dict[str, object]]:
    """Replace the published form of all tables at once, dates as text, if they pass their checks.

    Row counts, the NULLs of required columns and the key figures are observed while the tables are
    written, without a pass of their own, and returned. A NULL in a required column fails the publication:
    readers keep all they had.
    """
    spark = next(iter(marts.values())).sparkSession
    base = versions.latest(spark, folder)
    tables, observed = {}, {}
    for name, mart in marts.items():
        watch = Observation()
        watched = mart.observe(watch, *measures(name, required.get(name, [])))
        tables[name] = versions.write_table_version(export_stringify(watched), folder, name)
        observed[name] = watch.get
    failed = [
        f"{name}.{measure.removeprefix(NULLS)}: {value} NULLs"
        for name, values in observed.items()
        for measure, value in values.items()
        if measure.startswith(NULLS) and value
    ]
    if failed:
        raise FailedCheck("; ".join(failed))
    versions.commit(spark, base, tables)
    return observed
