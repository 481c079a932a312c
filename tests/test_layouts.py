"""Stored layouts: by user without shuffles, counts from footers, the newest record of a log."""

from __future__ import annotations

import random
from datetime import date, datetime, timedelta

import pytest
from pyspark.sql import functions as F

import plan_nodes
from frames import at, events, rows, users
from tidemark.operators import events as ev
from tidemark.operators import funnels
from tidemark.operators import users as us
from tidemark.operators.quality import table_row_counts
from tidemark.operators.tables import latest_record
from tidemark.plans.marts import store_marts, stored_marts
from tidemark.sources import bindings as b
from tidemark.sources import by_user, footers, logs, versions
from tidemark.sources.tables import store_by_day

AS_OF = date(2024, 3, 20)
BUCKETS = 5


def made(seed: int = 3):
    chance = random.Random(seed)
    start = datetime(2024, 1, 15)
    people = [(n, start + timedelta(minutes=chance.randrange(60 * 24 * 60)), "A") for n in range(150)] + [(None, start, "B")]
    kinds = ["product", "cart", "purchase", "home"]
    seen = [
        (chance.choice([7, chance.randrange(200)]), "s", chance.choice(kinds), start + timedelta(minutes=chance.randrange(90_000)), "ie")
        for _ in range(3000)
    ]
    return people, [*seen, (None, "s", "cart", start, "ie"), (7, "s", "cart", None, "ie")]


@pytest.fixture(scope="module")
def bucketed(spark, tmp_path_factory):
    folder = tmp_path_factory.mktemp("by_user")
    people, seen = made()
    raw_users, raw_events = users(spark, *people), events(spark, *seen)
    stored = {
        "people_by_user": (raw_users, "id"),
        "steps_by_user": (by_user.step_days(raw_events), "user_id"),
        "days_by_user": (ev.user_days(raw_events, None), "user_id"),
    }
    for name, (df, key) in stored.items():
        by_user.store_by_user(df, name, str(folder / name), key, BUCKETS)
    yield raw_users, raw_events, *(by_user.read_by_user(spark, name) for name in stored)
    for name in stored:
        spark.sql(f"DROP TABLE {name}")


def _funnels(people, seen, days):
    return {
        "unordered": funnels.registration_funnel_unordered(people, seen, AS_OF, drop_others=False),
        "ordered": funnels.registration_funnel_ordered(people, seen, AS_OF, drop_others=False),
        "pivot": funnels.first_event_pivot(people, seen, AS_OF, drop_others=False).orderBy("user_id"),
        "retention": us.retention_cohorts(people, days, AS_OF, min_size=1),
    }


def test_the_same_rows_without_a_shuffle_by_user(spark, bucketed):
    people, seen, stored_people, steps, days = bucketed
    wanted = {
        "unordered": funnels.registration_funnel_unordered(people, seen, AS_OF),
        "ordered": funnels.registration_funnel_ordered(people, seen, AS_OF),
        "pivot": funnels.first_event_pivot(people, seen, AS_OF).orderBy("user_id"),
        "retention": us.retention_cohorts(people, seen, AS_OF, min_size=1),
    }
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", -1)
    try:
        for name, df in _funnels(stored_people, steps, days).items():
            moved = [
                (node.outputPartitioning().toString(), node.output().toString())
                for found, _, node in plan_nodes.nodes(df)
                if found == "ShuffleExchangeExec"
            ]
            # Retention may move the few members of its cohorts, whom it looks up by month; never the events.
            by_key = [out for how, out in moved if "hashpartitioning(user_id" in how or "hashpartitioning(id" in how]
            assert not [out for out in by_key if name != "retention" or "active_month" in out], (name, moved)
            assert rows(df) == rows(wanted[name]), name
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_a_hot_user_has_few_rows_in_its_bucket(bucketed):
    _, seen, _, steps, days = bucketed
    assert seen.where("user_id = 7").count() > 1400
    assert steps.where("user_id = 7").count() <= 63 * 3
    per_bucket = [row["count"] for row in days.groupBy(F.spark_partition_id()).count().collect()]
    assert len(per_bucket) == BUCKETS and max(per_bucket) < 1.7 * min(per_bucket)


def test_counts_from_footers(spark, tmp_path):
    folder = str(tmp_path)
    tables = {"a": spark.range(1000).toDF("n"), "b": spark.range(0).toDF("n"), "c": spark.range(7).selectExpr("id AS `a b`", "'x' AS t")}
    store_marts(tables, folder)
    counts = footers.stored_row_counts(spark, folder, ["a", "b", "c"])
    assert sorted(rows(counts)) == sorted(rows(table_row_counts(stored_marts(spark, folder, ["a", "b", "c"]))))
    plan = counts._jdf.queryExecution().toString()
    assert "PushedAggregation: [COUNT(*)]" in plan
    scanned = [node.toString() for name, _, node in plan_nodes.nodes(counts) if name == "BatchScanExec"]
    assert len(scanned) == 2 and all("ReadSchema: struct<count(*):bigint>" in scan for scan in scanned)
    # The caller's session is as it was.
    assert spark.conf.get("spark.sql.parquet.aggregatePushdown") == "false"


def test_counts_where_footers_are_not_asked(spark, tmp_path, monkeypatch):
    store_marts({"a": spark.range(10).toDF("n")}, str(tmp_path))
    monkeypatch.setattr(footers, "FOOTER_SETTINGS", {})
    assert rows(footers.stored_row_counts(spark, str(tmp_path), ["a"])) == [("a", 10)]


def test_the_newest_day_from_folder_names(spark, tmp_path):
    folder = str(tmp_path)
    store_by_day(events(spark, *[(1, "s", "cart", at(f"2024-01-{n:02d}"), "ie") for n in (3, 9, 20)], (1, "s", "cart", None, "ie")), folder, "events")
    stored = b.load_events(spark, folder)
    for as_of in (None, date(2024, 1, 20), date(2024, 1, 19), date(2023, 1, 1)):
        assert [(footers.newest_day(stored, as_of),)] == rows(ev.data_end_date(stored, as_of))


def test_a_log_of_many_days_reads_the_newest(spark, tmp_path):
    folder = str(tmp_path)
    log = spark.range(400).selectExpr(
        "concat('r', id) AS run", "timestampadd(HOUR, int(id * 6), timestamp_ntz'2023-01-01') AS ts", "id AS n"
    )
    odd = spark.createDataFrame([("none", None, 9), ("tie", at("2023-04-10", "18:00:00"), 1000), ("tie2", at("2023-04-10", "18:00:00"), 999)], "run string, ts timestamp_ntz, n long")
    logs.append_log(log, folder, "log", "ts")
    logs.append_log(odd, folder, "log", "ts")
    assert len(versions.latest(spark, folder).tables["log"].parts) == 101
    whole = log.unionByName(odd)
    newest = logs.latest_in_log(spark, folder, "log", "ts", "n")
    files = [n.metrics().apply("numFiles").value() for name, _, n in plan_nodes.nodes(newest) if name == "FileSourceScanExec"]
    assert sum(files) <= 2
    assert rows(newest) == rows(latest_record(whole, "ts", "n")) == [("tie", at("2023-04-10", "18:00:00"), 1000)]
    assert sorted(rows(logs.read_log(spark, folder, "log")), key=str) == sorted(rows(whole), key=str)


def test_a_log_without_times(spark, tmp_path):
    folder = str(tmp_path)
    log = spark.createDataFrame([("a", None, 1), ("b", None, 2)], "run string, ts timestamp_ntz, n int")
    logs.append_log(log, folder, "log", "ts")
    assert rows(logs.latest_in_log(spark, folder, "log", "ts", "n")) == [("b", None, 2)]
    logs.append_log(spark.createDataFrame([("c", at("2000-01-01"), 0)], log.schema), folder, "log", "ts")
    assert rows(logs.latest_in_log(spark, folder, "log", "ts", "n")) == [("c", at("2000-01-01"), 0)]
