"""Incremental refresh: state kept by closed day, result tables from the state, all of it switched at once.

The raw tables are stored by day (`sources.tables.store_by_day`). Which days have changed since the last refresh
follows from the names of their files, which Spark never writes twice; only these days are read, and their state
replaces what was kept of them. Late rows, replaced days and days that have gone are all the same case.

State, a folder for each day and none of them rewritten in place:

* users and days, sessions and days, countries and days: the tables that `marts.shared_tables` makes,
* users and months, for the months before that of `as_of`: only months with a changed day are made again,
* sets of active and of new users as bitmaps (`operators.user_sets`).

Months of `mau` without a changed day are taken from the table that is there. State and result tables become
visible with one new version (`sources.versions`); a refresh that dies changes nothing and can be run again.
"""

from __future__ import annotations

from datetime import date
from typing import NamedTuple

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.functions.dates import DAY_COLUMN, first_of_month, month_of
from tidemark.functions.names import COUNTRY_NAMES
from tidemark.operators import events as ev
from tidemark.operators import funnels, user_sets, users
from tidemark.sources import versions
from tidemark.sources.tables import UNDATED, day_marks, mark_of
from tidemark.sources.versions import Table, Version

#: State that a raw table's day gives, by raw table.
BY_DAY = {"events": ["user_days", "session_days", "user_sets"], "users": ["country_days", "signup_sets"]}


class Refresh(NamedTuple):
    """What a refresh read: the days of each raw table, and the months that were made again."""

    version: Version
    days: dict[str, list[str]]
    months: list[str]


def _on(days: list[str]) -> Column:
    """Rows of these days; reaches the scan as a filter on folders."""
    dated = F.col(DAY_COLUMN).isin([date.fromisoformat(day) for day in days if day != UNDATED])
    return dated | F.col(DAY_COLUMN).isNull() if UNDATED in days else dated


def _with_day(df: DataFrame) -> DataFrame:
    return df.withColumn(DAY_COLUMN, F.to_date("created_at"))


def state_of(raw: DataFrame, source: str, days: list[str]) -> dict[str, DataFrame]:
    """The state that some days of a raw table give, not yet computed."""
    rows = raw.where(_on(days))
    if source == "users":
        return {"country_days": _with_day(users.country_days(rows, None)), "signup_sets": user_sets.signup_sets(rows)}
    by_user = _with_day(ev.user_days(rows, None))
    return {"user_days": by_user, "session_days": _with_day(ev.all_session_days(rows)), "user_sets": user_sets.user_sets(rows)}


def _closed(marks: dict[str, str], as_of: date) -> dict[str, str]:
    return {day: mark for day, mark in marks.items() if day == UNDATED or day <= as_of.isoformat()}


def _month_of(day: str) -> str:
    return day[:7] + "-01"


def _months(marks: dict[str, str], before: date) -> dict[str, str]:
    """A mark for each month before that of a day, made of the marks of its days."""
    found: dict[str, list[str]] = {}
    for day, mark in marks.items():
        if day != UNDATED and day < before.isoformat():
            found.setdefault(_month_of(day), []).append(day + mark)
    return {month: mark_of(parts) for month, parts in found.items()}


def refresh(
    user_table: DataFrame,
    event_table: DataFrame,
    as_of: date,
    folder: str,
    names: dict[str, str] = COUNTRY_NAMES,
) -> Refresh:
    """Bring state and result tables up to the raw tables and a day; both tables are stored by day.

    Days after `as_of` are left for later. `as_of` may lie before that of the last refresh.
    """
    spark = event_table.sparkSession
    base = versions.latest(spark, folder)
    tables, notes, days = {}, {}, {}
    for source, raw in (("events", event_table), ("users", user_table)):
        marks, known = day_marks(raw), base.notes.get(source, {})
        days[source] = sorted(day for day, mark in _closed(marks, as_of).items() if known.get(day) != mark)
        gone = {*days[source], *(day for day in known if day not in marks)}
        notes[source] = {day: mark for day, mark in {**known, **_closed(marks, as_of)}.items() if day in marks}
        for name in BY_DAY[source]:
            tables[name] = base.tables.get(name)
        if gone or None in [tables[name] for name in BY_DAY[source]]:
            for name, df in state_of(raw, source, days[source]).items():
                new = versions.write_table_version(df, folder, name, DAY_COLUMN)
                tables[name] = versions.replaced(tables[name], new, gone)

    wanted = _months(notes["events"], first_of_month(as_of))
    made, known = base.tables.get("user_months"), base.notes.get("months", {})
    months = sorted(month for month, mark in wanted.items() if known.get(month) != mark)
    lost = set(made.parts if made else []) - {_month_of(day) for day in notes["events"]}
    draft = Version(folder, tables=tables)
    if months or lost or made is None:
        user_days = versions.read_table_version(draft, spark, "user_days", _days_of(tables["user_days"], months))
        new = versions.write_table_version(month_state(user_days), folder, "user_months", DAY_COLUMN)
        made = versions.replaced(made, new, {*months, *lost})
    tables["user_months"] = made
    # Months after that of `as_of` keep their state and marks for when it moves on again.
    notes["months"] = {**{m: k for m, k in known.items() if m in made.parts}, **wanted}

    known = base.notes.get("mau", {})
    stale = [month for month, mark in wanted.items() if known.get(month) != mark]
    kept = None
    if len(stale) < len(wanted):
        same = [date.fromisoformat(month) for month in wanted if month not in set(stale)]
        kept = versions.read_table_version(base, spark, "mau").where(F.col("month").isin(same))
    notes["mau"] = wanted
    draft = Version(folder, tables=tables)
    for name, mart in marts_from_state(spark, draft, as_of, names, stale, kept).items():
        tables[name] = versions.write_table_version(mart, folder, name)
    return Refresh(versions.commit(spark, base, tables, notes), days, months)


def month_state(user_days: DataFrame) -> DataFrame:
    """One event for each user and month, the latest, under the month's first day."""
    return ev.latest_in(user_days, month_of(user_days)).withColumn(DAY_COLUMN, F.trunc("created_at", "MM"))


def _days_of(table: Table, months: list[str]) -> list[str]:
    wanted = set(months)
    return [day for day in table.parts if _month_of(day) in wanted]


def marts_from_state(
    spark: SparkSession,
    state: Version,
    as_of: date,
    names: dict[str, str],
    months: list[str],
    kept: DataFrame | None,
) -> dict[str, DataFrame]:
    """All result tables, not yet computed; `mau` of some months, beside rows that are kept."""

    def read(name: str, parts: list[str] | None = None) -> DataFrame:
        return versions.read_table_version(state, spark, name, parts)

    this_month, day = first_of_month(as_of).isoformat(), as_of.isoformat()
    user_days = state.tables["user_days"].parts
    recent = read("user_days", [part for part in user_days if part == UNDATED or this_month <= part <= day])
    earlier = read("user_months", [month for month in state.tables["user_months"].parts if month < this_month])
    seen, signed, sessions, countries = (read(name) for name in ("user_sets", "signup_sets", "session_days", "country_days"))
    mau = user_sets.mau_monthly(read("user_sets", _days_of(state.tables["user_sets"], months)), as_of)
    ends = [part for part in user_days if part != UNDATED and part <= day]
    return {
        "mau": mau if kept is None else mau.unionByName(kept).orderBy("month"),
        "retention": user_sets.retention_cohorts(signed, seen, as_of),
        "users_by_country": users.users_by_country(countries, as_of, names),
        "platform_share": ev.platform_share(earlier.unionByName(recent), as_of),
        "funnel": funnels.session_funnel(sessions, as_of),
        "data_end_date": spark.createDataFrame([(date.fromisoformat(max(ends)) if ends else None,)], "data_end_date date"),
        "country_trends": users.country_trends(countries, as_of, names=names),
        "country_increases": users.country_increases(countries, as_of, names=names),
        "country_decreases": users.country_decreases(countries, as_of, names=names),
        "kpi_metrics": ev.kpi_metrics(None, as_of, sessions, user_sets.active_users_trailing(seen, as_of)),
    }
