from __future__ import annotations

from datetime import date

from frames import at, events, rows, users
from tidemark.operators import funnels as fu

AS_OF = date(2024, 3, 31)


def test_session_funnel_is_of_the_last_full_month(spark):
    df = events(
        spark,
        (1, "before", "product", at("2024-01-31", "23:59:59")),
        (1, "first", "product", at("2024-02-01", "00:00:00")),
        (1, "last", "product", at("2024-02-29", "23:59:59")),
        (1, "after", "product", at("2024-03-01", "00:00:00")),
    )
    assert [row[2] for row in rows(fu.session_funnel(df, AS_OF))] == [2, 0, 0]


def test_session_funnel_ignores_order_but_needs_earlier_steps(spark):
    df = events(
        spark,
        (1, "a", "cart", at("2024-02-01")),
        (1, "a", "product", at("2024-02-02")),
        (1, "a", "purchase", at("2024-02-01")),
        (2, "b", "product", at("2024-02-01")),
        (2, "b", "purchase", at("2024-02-01")),
        (3, "c", "cart", at("2024-02-01")),
        (3, "c", "purchase", at("2024-02-01")),
        (4, "d", "product", at("2024-02-01")),
    )
    funnel = fu.session_funnel(df, AS_OF)
    assert rows(funnel) == [
        (1, "Product View", 3, 100.0),
        (2, "Add to Cart", 1, 33.3),
        (3, "Purchase", 1, 33.3),
    ]
    assert [row[3:] for row in rows(fu.funnel_pct_of_first(funnel))] == [
        (100.0, 1.0),
        (33.3, 0.333),
        (33.3, 0.333),
    ]
    assert rows(fu.funnel_step_conversion(funnel)) == [(1, 3, None), (2, 1, 1 / 3), (3, 1, 1.0)]


def test_empty_funnel(spark):
    funnel = fu.session_funnel(events(spark, (1, "a", "home", at("2024-02-01"))), AS_OF)
    assert [row[2:] for row in rows(funnel)] == [(0, 100.0), (0, None), (0, None)]
    assert [row[3:] for row in rows(fu.funnel_pct_of_first(funnel))] == [
        (100.0, 1.0),
        (None, None),
        (None, None),
    ]
    assert [row[2] for row in rows(fu.funnel_step_conversion(funnel))] == [None, 0.0, 0.0]


def _users_reaching(df) -> list:
    return [row[2] for row in rows(df)]


def test_registration_window_has_31_days(spark):
    days = ["2024-01-30", "2024-01-31", "2024-03-01", "2024-03-02"]
    signed = users(spark, *[(n, at(day, "00:00:00"), None) for n, day in enumerate(days)])
    seen = events(spark, *[(n, "s", "product", at("2024-03-20")) for n in range(4)])
    assert _users_reaching(fu.registration_funnel_unordered(signed, seen, AS_OF)) == [2, 2, 0, 0]
    assert _users_reaching(fu.registration_funnel_ordered(signed, seen, AS_OF)) == [2, 2, 0, 0]
    assert sorted(row[0] for row in rows(fu.first_event_pivot(signed, seen, AS_OF))) == [1, 2]


def test_registration_funnels(spark):
    signed = users(spark, *[(n, at("2024-02-10"), None) for n in range(1, 7)])
    done = events(
        spark,
        # on the signup day, though earlier than the signup itself
        (1, "s", "product", at("2024-02-10", "08:00:00")),
        (1, "s", "cart", at("2024-02-10", "09:00:00")),
        (1, "s", "purchase", at("2024-02-10", "09:00:00")),
        # the day before the signup does not count
        (2, "s", "product", at("2024-02-09")),
        (2, "s", "purchase", at("2024-02-11")),
        # cart first
        (3, "s", "cart", at("2024-02-11")),
        (3, "s", "product", at("2024-02-12")),
        (3, "s", "cart", at("2024-02-13")),
        # purchase before cart
        (4, "s", "product", at("2024-02-11")),
        (4, "s", "purchase", at("2024-02-12")),
        (4, "s", "cart", at("2024-02-13")),
        (5, "s", "home", at("2024-02-13")),
        # beyond the as-of day
        (6, "s", "product", at("2024-04-01")),
        (99, "s", "product", at("2024-02-13")),
        (None, "s", "product", at("2024-02-13")),
    )
    unordered = fu.registration_funnel_unordered(signed, done, AS_OF)
    assert rows(unordered) == [
        (1, "New User Registration", 6),
        (2, "Product View", 3),
        (3, "Add to Cart", 3),
        (4, "Purchase", 3),
    ]
    assert _users_reaching(fu.registration_funnel_ordered(signed, done, AS_OF)) == [6, 3, 2, 1]
    assert rows(fu.funnel_step_conversion(unordered, "users")) == [
        (1, 6, None),
        (2, 3, 0.5),
        (3, 3, 1.0),
        (4, 3, 1.0),
    ]
    pivot = {row[0]: row[1:] for row in rows(fu.first_event_pivot(signed, done, AS_OF))}
    assert sorted(pivot) == [1, 2, 3, 4]
    assert pivot[2] == (at("2024-02-10"), None, None, at("2024-02-11"))
    assert pivot[3] == (at("2024-02-10"), at("2024-02-12"), at("2024-02-11"), None)


def test_nobody_did_anything(spark):
    signed = users(spark, (1, at("2024-02-10"), None))
    nothing = events(spark, (1, "s", "home", at("2024-02-11")))
    assert _users_reaching(fu.registration_funnel_ordered(signed, nothing, AS_OF)) == [1, None, None, None]
    assert _users_reaching(fu.registration_funnel_unordered(signed, nothing, AS_OF)) == [1, 0, 0, 0]


def test_nobody_signed_up(spark):
    signed = users(spark, (1, at("2023-02-10"), None))
    seen = events(spark, (1, "s", "product", at("2024-02-11")))
    assert _users_reaching(fu.registration_funnel_ordered(signed, seen, AS_OF)) == [0, None, None, None]
    assert _users_reaching(fu.registration_funnel_unordered(signed, seen, AS_OF)) == [0, 0, 0, 0]
