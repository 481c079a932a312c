"""Relations that hold for any data, on the stored tables; and independence from row order."""

from __future__ import annotations

import pytest

from frames import rows
from oracle_check import TESTDATA, spark_rows
from tidemark.operators import events as ev
from tidemark.operators import funnels, users
from tidemark.plans import catalog as c
from tidemark.sources import bindings as b

FOLDER = f"{TESTDATA}/sf0.01"


def test_month_zero_is_whole_and_rates_are_shares(spark):
    retention = c.QUERIES["retention_cohorts"](spark, FOLDER).collect()
    assert {row.retention_rate for row in retention if row.age_month == 0} == {1.0}
    assert all(0 < row.retention_rate <= 1 for row in retention)


def test_shares_add_up(spark):
    shares = c.QUERIES["platform_share"](spark, FOLDER).collect()
    assert sum(row.share for row in shares) == pytest.approx(1)


def test_funnels_fall(spark):
    session = [row.sessions for row in c.QUERIES["session_funnel"](spark, FOLDER).collect()]
    ordered = [row.users for row in c.QUERIES["registration_funnel_ordered"](spark, FOLDER).collect()]
    unordered = [row.users for row in c.QUERIES["registration_funnel_unordered"](spark, FOLDER).collect()]
    assert session == sorted(session, reverse=True)
    assert ordered == sorted(ordered, reverse=True)
    assert all(some <= all_ for some, all_ in zip(ordered, unordered))


def test_known_counts(spark):
    """FIXTURES.md section 4."""
    counts = {key: [row[2] for row in rows(c.QUERIES[key](spark, FOLDER))] for key in (
        "session_funnel", "registration_funnel_unordered", "registration_funnel_ordered")}
    assert counts == {
        "session_funnel": [1617, 599, 207],
        "registration_funnel_unordered": [96, 77, 71, 69],
        "registration_funnel_ordered": [96, 77, 29, 6],
    }
    assert c.QUERIES["mau_monthly"](spark, FOLDER).count() == 79
    assert c.QUERIES["retention_cohorts"](spark, FOLDER).count() == 14
    assert [row[:2] for row in rows(c.QUERIES["country_increases"](spark, FOLDER))] == [
        ("NATION_10", 21),
        ("NATION_23", 19),
        ("NATION_13", 19),
    ]
    assert [row[:2] for row in rows(c.QUERIES["country_decreases"](spark, FOLDER))] == [
        ("NATION_17", 13),
        ("NATION_24", 4),
        ("NATION_22", 7),
    ]


def test_row_order_does_not_matter(spark):
    web, orders = b.load_events(spark, FOLDER, b.events_web), b.load_events(spark, FOLDER, b.events_orders)
    people, ships = b.load_users(spark, FOLDER, b.users_cust), b.load_users(spark, FOLDER, b.users_ship)
    signed = b.load_users(spark, FOLDER, b.users_signup)
    operators = [
        lambda shuffle: ev.platform_share(shuffle(web)),
        lambda shuffle: users.country_trends(shuffle(ships), c.SHIP_DAY),
        lambda shuffle: users.country_increases(shuffle(ships), c.SHIP_DAY),
        lambda shuffle: users.retention_cohorts(shuffle(people), shuffle(orders), c.COHORT_DAY),
        lambda shuffle: funnels.first_event_pivot(shuffle(signed), shuffle(web), c.SIGNUP_DAY),
    ]
    for operator in operators:
        plain = spark_rows(operator(lambda df: df))
        assert spark_rows(operator(lambda df: df.repartition(7).sortWithinPartitions(df.created_at.desc()))) == plain
