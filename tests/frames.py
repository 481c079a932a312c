"""Small logical tables from Python rows."""

from __future__ import annotations

from datetime import datetime, timedelta

from tidemark.schemas import EVENTS, USERS


def at(day: str, time: str = "12:00:00") -> datetime:
    return datetime.fromisoformat(f"{day} {time}")


def users(spark, *rows):
    """Rows (id, created_at, country)."""
    return spark.createDataFrame(list(rows), USERS)


def events(spark, *rows):
    """Rows (user_id, session_id, event_type, created_at[, browser])."""
    return spark.createDataFrame([(*row, None)[:5] for row in rows], EVENTS)


def signups(country: str | None, day: str, count: int, first_id: int = 0):
    return [(first_id + i, at(day) + timedelta(seconds=i), country) for i in range(count)]


def rows(df) -> list[tuple]:
    return [tuple(row) for row in df.collect()]
