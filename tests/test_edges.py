"""Registered queries and their SQL on hand-made stored tables with rows the generated ones lack."""

from __future__ import annotations

import pyarrow as pa
import pyarrow.parquet as pq
import pytest

from frames import at
from oracle_check import connect, difference
from tidemark.plans.catalog import registered
from tidemark.plans.oracle import ORACLE_SQL

ROWS = [
    # A user who signed up twice, the second time after the day the funnels look from.
    (1, "signup", at("2024-01-05"), '{"k": 0}'),
    (1, "signup", at("2024-03-05"), '{"k": 1}'),
    (1, "view", at("2024-01-06"), '{"k": 2}'),
    (1, "click", at("2024-01-07"), '{"k": 3}'),
    (1, "purchase", at("2024-01-07"), '{"k": 4}'),
    (2, "signup", at("2024-01-10", "23:59:59"), "{}"),
    (2, "click", at("2024-01-10", "00:00:00"), '{"k": -1}'),
    (2, "view", at("2024-01-11"), '{"k": -5}'),
    (3, "signup", at("2024-01-10"), '{"k": null}'),
    # Events without a user: one session together.
    (None, "view", at("2024-01-20"), '{"k": 1}'),
    (None, "view", at("2024-01-21"), '{"k": 1}'),
    (None, "purchase", at("2024-01-22"), '{"k": 1}'),
    # Without a time, without a browser, with one that is no number.
    (4, "view", None, '{"k": 2}'),
    (4, "signup", None, '{"k": 2}'),
    (5, "view", at("2024-01-15"), None),
    (6, "view", at("2024-01-15"), '{"k": "x"}'),
    (6, None, at("2024-01-15"), '{"k": -7}'),
]
KEYS = [
    "data_end_date", "active_users_trailing", "session_conversion_trailing", "kpi_metrics", "platform_share",
    "session_funnel", "funnel_pct_of_first", "funnel_step_conversion", "registration_funnel_unordered",
    "first_event_pivot", "registration_funnel_ordered",
]


@pytest.fixture(scope="module", params=["rows", "no rows"])
def folder(request, tmp_path_factory):
    path = tmp_path_factory.mktemp("edges")
    rows = ROWS if request.param == "rows" else []
    users, types, times, props = zip(*rows) if rows else ((),) * 4
    table = pa.table(
        {
            "event_id": pa.array(range(len(rows)), pa.int64()),
            "ts": pa.array(times, pa.timestamp("us")),
            "user_id": pa.array(users, pa.int64()),
            "event_type": pa.array(types, pa.string()),
            "value": pa.array([1.0] * len(rows), pa.float64()),
            "props": pa.array(props, pa.string()),
        }
    )
    pq.write_table(table, path / "events.parquet")
    return str(path)


@pytest.mark.parametrize("key", KEYS)
def test_matches_sql(spark, folder, key):
    with connect(folder) as con:
        assert difference(registered()[key](spark, folder), con, ORACLE_SQL[key]) is None


def test_the_first_signup_counts_as_of_the_day(spark, folder):
    steps = {row.step: row.users for row in registered()["registration_funnel_unordered"](spark, folder).collect()}
    if any(steps.values()):
        assert steps == {1: 3, 2: 2, 3: 2, 4: 1}
