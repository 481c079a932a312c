from __future__ import annotations

from datetime import date

import pytest

from frames import at, events, rows
from tidemark.operators import events as ev

AS_OF = date(2024, 3, 31)


def test_data_end_date_stops_at_the_as_of_day(spark):
    df = events(
        spark,
        (1, "a", "home", at("2024-03-30")),
        (1, "a", "home", at("2024-03-31", "23:59:59")),
        (1, "a", "home", at("2024-04-01", "00:00:00")),
    )
    assert rows(ev.data_end_date(df, AS_OF)) == [(AS_OF,)]
    assert rows(ev.data_end_date(df)) == [(date(2024, 4, 1),)]
    assert rows(ev.data_end_date(df.limit(0))) == [(None,)]


def test_mau_leaves_out_the_running_month_and_null_users(spark):
    df = events(
        spark,
        (1, "a", "home", at("2024-01-01", "00:00:00")),
        (1, "b", "home", at("2024-01-31", "23:59:59")),
        (2, "c", "home", at("2024-01-15")),
        (None, "d", "home", at("2024-01-15")),
        (None, "d", "home", at("2023-12-15")),
        (3, "e", "home", at("2024-02-29")),
        (4, "f", "home", at("2024-03-01", "00:00:00")),
    )
    mau = ev.mau_monthly(df, AS_OF)
    assert rows(mau) == [(date(2023, 12, 1), 0), (date(2024, 1, 1), 2), (date(2024, 2, 1), 1)]
    assert rows(ev.mau_recent(mau, 2)) == [(date(2024, 2, 1), 1), (date(2024, 1, 1), 2)]


@pytest.mark.parametrize(
    ("day", "counts"),
    [("2024-03-31", 0), ("2024-03-30", 1), ("2024-03-01", 1), ("2024-02-29", 0)],
)
def test_trailing_window_ends(spark, day, counts):
    df = events(
        spark, (1, "a", "product", at(day, "00:00:00")), (1, "a", "purchase", at(day, "23:59:59"))
    )
    assert rows(ev.active_users_trailing(df, AS_OF)) == [(counts,)]
    rate = 1.0 if counts else None
    assert rows(ev.session_conversion_trailing(df, AS_OF)) == [(counts, counts, rate)]
    assert rows(ev.kpi_metrics(df, AS_OF)) == [("2024-03-31", counts, rate)]


def test_conversion_counts_purchases_of_product_sessions_only(spark):
    df = events(
        spark,
        (1, "a", "product", at("2024-03-10")),
        (1, "b", "product", at("2024-03-10")),
        (1, "b", "purchase", at("2024-03-09")),
        (2, "c", "purchase", at("2024-03-10")),
        (2, "d", "home", at("2024-03-10")),
        (3, None, "product", at("2024-03-10")),
        (4, None, "product", at("2024-03-11")),
    )
    assert rows(ev.session_conversion_trailing(df, AS_OF)) == [(3, 1, 1 / 3)]


def test_platform_of_the_latest_event(spark):
    df = events(
        spark,
        (1, "a", "home", at("2024-03-01"), "Chrome"),
        (1, "a", "home", at("2024-03-02"), "SAFARI"),
        (2, "b", "home", at("2024-03-01"), "Firefox"),
        (3, "c", "home", at("1969-03-01"), "ie"),
        (4, "d", "home", at("2024-03-01"), None),
        (5, "e", "home", at("2024-03-01"), "Opera"),
        (5, "e", "home", at("2024-04-01"), "Chrome"),
    )
    assert rows(ev.platform_share(df, AS_OF)) == [
        ("Desktop", 2, 0.4),
        ("Web", 2, 0.4),
        ("iOS", 1, 0.2),
    ]


def test_events_without_user_are_one_user(spark):
    df = events(
        spark,
        (None, "a", "home", at("2024-03-01"), "Chrome"),
        (None, "b", "home", at("2024-03-02"), "Safari"),
        (1, "c", "home", at("2024-03-02"), "Safari"),
    )
    assert rows(ev.platform_share(df)) == [("iOS", 2, 1.0)]


def test_same_instant_is_settled_whatever_the_row_order(spark):
    tied = [(1, "a", "home", at("2024-03-01"), browser) for browser in ("Chrome", "Opera", "ie")]
    results = {
        str(rows(ev.platform_share(events(spark, *order))))
        for order in (tied, tied[::-1], [tied[1], tied[0], tied[2]])
    }
    assert results == {"[('Web', 1, 1.0)]"}
