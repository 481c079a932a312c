"""What the physical plans must and must not do, whatever the size of the tables."""

from __future__ import annotations

from datetime import date, timedelta

import pytest

import plan_nodes
from frames import rows
from oracle_check import TESTDATA
from tidemark.operators import events as ev
from tidemark.operators import funnels, tables, users
from tidemark.plans.catalog import QUERIES
from tidemark.plans.marts import SHARED, build_marts, shared_tables, store_marts, stored_marts
from tidemark.session import configure
from tidemark.sources import bindings as b
from tidemark.sources.tables import store_by_day

FOLDER = f"{TESTDATA}/sf0.001"
AS_OF = date(2024, 1, 25)

# Queries whose windows see a handful of rows, or one candidate per key and task.
WINDOWS = {
    "platform_share",
    "funnel_pct_of_first",
    "funnel_step_conversion",
    "latest_record",
    "headline_facts",
    "mart_rows_json",
    "chat_rows_json",
    "table_row_counts",
    "dq_mart_profile",
}


@pytest.mark.parametrize("key", sorted(QUERIES))
def test_no_all_pairs_join_no_python_no_sort_aggregate(spark, key):
    found = set(plan_nodes.names(QUERIES[key](configure(spark), FOLDER)))
    assert not found & {"CartesianProductExec", "BroadcastNestedLoopJoinExec"}
    assert not any("Python" in name or "Pandas" in name for name in found)
    if key not in WINDOWS:
        assert "WindowExec" not in found
    if key not in ("headline_facts", "mau_monthly_from_sets", "active_users_from_sets", "retention_from_sets"):
        # There the sort is over the few rows of the result tables, or one row for each user and day.
        assert "SortAggregateExec" not in found


def test_latest_record_drops_losers_before_the_shuffle(spark):
    walked = [
        (name, depth)
        for name, depth, _ in plan_nodes.nodes(QUERIES["latest_record"](spark, FOLDER))
        if name in ("WindowGroupLimitExec", "ShuffleExchangeExec")
    ]
    assert [name for name, _ in walked] == [
        "WindowGroupLimitExec",
        "ShuffleExchangeExec",
        "WindowGroupLimitExec",
    ]


@pytest.mark.parametrize(("key", "count"), [("country_trends", 3), ("country_increases", 3), ("session_funnel", 1)])
def test_each_table_is_read_once(spark, key, count):
    assert len(plan_nodes.scans(QUERIES[key](spark, FOLDER))) == count


def test_upsert_computes_its_source_once(spark):
    full_reads = [
        scan for scan in plan_nodes.scans(QUERIES["upsert_by_key"](spark, FOLDER)) if "text" in scan.split("[")[1]
    ]
    assert len(full_reads) == 2  # the target, and the source made from the same table


def test_time_bounds_and_columns_reach_the_scan(spark):
    (scan,) = plan_nodes.scans(QUERIES["session_funnel"](spark, FOLDER))
    assert "GreaterThanOrEqual(ts," in scan and "LessThan(ts," in scan
    assert "ReadSchema: struct<ts:timestamp_ntz,user_id:bigint,event_type:string>" in scan


@pytest.fixture(scope="module")
def by_day(spark, tmp_path_factory):
    """The web events and signups, stored by day."""
    folder = str(tmp_path_factory.mktemp("by_day"))
    store_by_day(b.events_web(spark, FOLDER), folder, "events")
    store_by_day(b.users_signup(spark, FOLDER), folder, "users")
    return folder


OPERATORS = {
    "mau": lambda us, es: ev.mau_monthly(es, date(2024, 2, 3)),
    "countries": lambda us, es: users.country_trends(us.fillna("A"), date(2024, 2, 10), 15, 1),
    "pivot": lambda us, es: funnels.first_event_pivot(us, es, date(2024, 2, 25)).orderBy("user_id"),
    "active_users": lambda us, es: ev.active_users_trailing(es, AS_OF, 7),
    "conversion": lambda us, es: ev.session_conversion_trailing(es, AS_OF, 7),
    "funnel": lambda us, es: funnels.session_funnel(es, date(2024, 2, 3)),
    "registration": lambda us, es: funnels.registration_funnel_unordered(us, es, date(2024, 2, 25)),
    "ordered": lambda us, es: funnels.registration_funnel_ordered(us, es, date(2024, 2, 25)),
    "retention": lambda us, es: users.retention_cohorts(us, es, date(2024, 2, 25), min_size=1),
    "data_end_date": lambda us, es: ev.data_end_date(es, AS_OF),
    "platform_share": lambda us, es: ev.platform_share(es, AS_OF),
}


@pytest.mark.parametrize("name", sorted(OPERATORS))
def test_tables_stored_by_day_give_the_same_rows(spark, by_day, name):
    plain = OPERATORS[name](
        b.load_users(spark, FOLDER, b.users_signup), b.load_events(spark, FOLDER, b.events_web)
    )
    stored = OPERATORS[name](b.load_users(spark, by_day), b.load_events(spark, by_day))
    assert rows(stored) == rows(plain)


def _files_read(df) -> list[int]:
    return [
        node.metrics().apply("numFiles").value()
        for name, _, node in plan_nodes.nodes(df)
        if name == "FileSourceScanExec"
    ]


def test_only_the_days_asked_for_are_read(spark, by_day):
    events = b.load_events(spark, by_day)
    days = events.select("created_day").distinct().count()
    assert days == 30
    assert _files_read(ev.active_users_trailing(events, AS_OF, 7)) == [7]


@pytest.mark.parametrize("name", ["active_users", "conversion", "data_end_date", "funnel", "mau", "registration"])
def test_timestamps_stay_unread_where_the_day_is_enough(spark, by_day, name):
    result = OPERATORS[name](b.load_users(spark, by_day), b.load_events(spark, by_day))
    for scan in plan_nodes.scans(result):
        assert "created_at" not in scan.split("ReadSchema")[1]


def test_retention_reads_from_the_oldest_kept_cohort_on(spark, by_day, tmp_path):
    """The bound is the outcome of a subquery and still skips folders."""
    folder = str(tmp_path)
    recent = b.load_events(spark, by_day).drop("created_day")
    old = recent.withColumn("created_at", recent.created_at - timedelta(days=3650))
    store_by_day(recent.unionByName(old), folder, "events")
    signed = b.load_users(spark, FOLDER, b.users_signup)
    earlier = signed.withColumn("created_at", signed.created_at - timedelta(days=31))
    events = b.load_events(spark, folder)
    assert events.select("created_day").distinct().count() == 60
    result = users.retention_cohorts(earlier, events, date(2024, 2, 25), min_size=1)
    assert sorted(_files_read(result))[-1] == 30
    assert [row.age_month for row in result.collect()] == [0, 1]


HOT_OPERATORS = {
    "mau": lambda us, es: ev.mau_monthly(es, date(2024, 5, 1)),
    "kpi": lambda us, es: ev.kpi_metrics(es, date(2024, 4, 1)),
    "platform_share": lambda us, es: ev.platform_share(es),
    "session_funnel": lambda us, es: funnels.session_funnel(es, date(2024, 4, 1)),
    "unordered": lambda us, es: funnels.registration_funnel_unordered(us, es, date(2024, 4, 1)),
    "ordered": lambda us, es: funnels.registration_funnel_ordered(us, es, date(2024, 4, 1)),
    "retention": lambda us, es: users.retention_cohorts(us, es, date(2024, 4, 1), min_size=1),
    "latest": lambda us, es: tables.latest_record(es, "created_at", tie_break="session_id", key="user_id"),
}


@pytest.mark.parametrize("name", sorted(HOT_OPERATORS))
def test_a_hot_user_is_reduced_before_the_shuffle(spark, name):
    """60,000 events of one user and session, in 8 tasks over 30 days."""
    hot = spark.range(0, 60_000, 1, 8).selectExpr(
        "if(id < 0, 1L, 7L) AS user_id",
        "if(id < 0, 'r', 's') AS session_id",
        "element_at(array('product', 'cart', 'purchase', 'home'), int(id % 4) + 1) AS event_type",
        "timestampadd(MINUTE, int(id * 37 % 43000), timestamp_ntz'2024-03-01') AS created_at",
        "'Chrome' AS browser",
    )
    signed = spark.sql("SELECT 7L AS id, timestamp_ntz'2024-02-15' AS created_at, 'A' AS country")
    written = [
        node.metrics().apply("shuffleRecordsWritten").value()
        for found, _, node in plan_nodes.nodes(HOT_OPERATORS[name](signed, hot))
        if found == "ShuffleExchangeExec"
    ]
    assert 0 < sum(written) <= 8 * 31 * 2


def _raw_scans(df, folder: str) -> list[str]:
    return [
        name
        for name, _, node in plan_nodes.nodes(df)
        if name == "FileSourceScanExec" and folder in node.relation().location().rootPaths().toString()
    ]


def test_shared_tables_take_one_pass_each_and_marts_none(spark, tmp_path):
    raw, folder = str(tmp_path / "raw"), str(tmp_path / "marts")
    b.load_events(spark, FOLDER, b.events_web).write.parquet(f"{raw}/events.parquet")
    b.load_users(spark, FOLDER, b.users_signup).write.parquet(f"{raw}/users.parquet")
    events, people = b.load_events(spark, raw), b.load_users(spark, raw)
    shared = shared_tables(people, events, AS_OF)
    assert {name: len(_raw_scans(df, f"{raw}/events")) for name, df in shared.items()} == {
        "shared_user_days": 1, "shared_session_days": 1, "shared_country_days": 0
    }
    assert len(_raw_scans(shared["shared_country_days"], f"{raw}/users")) == 1
    store_marts(shared, folder)
    built = build_marts(people, events, AS_OF, shared=stored_marts(spark, folder, SHARED))
    assert not any(_raw_scans(df, f"{raw}/events") for df in built.values())
    assert {name for name, df in built.items() if _raw_scans(df, f"{raw}/users")} <= {"retention"}


@pytest.mark.parametrize("name", ["unordered", "ordered"])
def test_events_of_others_are_dropped_before_the_shuffle(spark, name):
    """10 registrants among 5,000 users, without any broadcast by size."""
    events = spark.range(0, 100_000, 1, 8).selectExpr(
        "id % 5000 AS user_id", "'s' AS session_id", "element_at(array('product', 'cart'), int(id % 2) + 1) AS event_type",
        "timestampadd(MINUTE, int(id * 37 % 43000), timestamp_ntz'2024-03-01') AS created_at", "'Chrome' AS browser",
    )
    signed = spark.range(10).selectExpr("id * 500 AS id", "timestamp_ntz'2024-02-15' AS created_at", "'A' AS country")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", -1)
    try:
        written = [
            node.metrics().apply("shuffleRecordsWritten").value()
            for found, _, node in plan_nodes.nodes(HOT_OPERATORS[name](signed, events))
            if found == "ShuffleExchangeExec"
        ]
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert 0 < sum(written) < 100_000 * 0.02
