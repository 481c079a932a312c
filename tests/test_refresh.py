"""Incremental refresh: reads what has changed, gives what a full rebuild gives."""

from __future__ import annotations

import random
import shutil
from datetime import date, datetime, timedelta

import pytest
from py4j.protocol import Py4JJavaError
from pyspark.errors import PySparkException

import plan_nodes
from frames import events, rows, users
from tidemark.operators import user_sets
from tidemark.plans import refresh as r
from tidemark.plans.marts import MARTS, build_marts, stored_marts
from tidemark.sources import bindings as b
from tidemark.sources import versions
from tidemark.sources.tables import replace_days, store_by_day

START = datetime(2023, 11, 20)

#: Days with rows, in four months.
DAYS = [0, 8, 15, 16, 30, 40, 56, 70, 80, 82]


def made_events(seed: int, days: list[int], count: int):
    chance = random.Random(seed)
    kinds, browsers = ["product", "cart", "purchase", "home", None], ["Chrome", "Safari", "ie", "Opera", None]
    ids = [*range(80), -1, -40_000, 10**14, 32_768, 32_769, None]
    return [
        (chance.choice(ids), chance.choice(["s%d" % chance.randrange(60), None]), chance.choice(kinds),
         START + timedelta(days=chance.choice(days), seconds=chance.randrange(86_400)), chance.choice(browsers))
        for _ in range(count)
    ]


def made_users(seed: int, days: list[int], count: int, first: int = 0):
    chance = random.Random(seed)
    ids = [-1, -40_000, 10**14, 32_768, None, *range(first, first + count)]
    return [
        (n, START + timedelta(days=chance.choice(days), seconds=chance.randrange(86_400)), chance.choice(["Brasil", "Brazil", "France", None]))
        for n in ids
    ]


@pytest.fixture()
def raw(spark, tmp_path):
    folder = str(tmp_path / "raw")
    undated = [(3, "s1", "product", None, "Firefox"), (None, None, None, None, None), (999, None, "cart", None, "Safari")]
    store_by_day(events(spark, *made_events(1, DAYS, 700), *undated), folder, "events")
    store_by_day(users(spark, *made_users(1, DAYS, 300), (5000, None, "Chile")), folder, "users")
    return folder


def tables(spark, raw):
    return b.load_users(spark, raw), b.load_events(spark, raw)


def check(spark, raw, folder, as_of):
    """Refresh, and compare every table with a full rebuild."""
    people, seen = tables(spark, raw)
    done = r.refresh(people, seen, as_of, folder)
    plain = build_marts(people, seen, as_of)
    for name, mart in stored_marts(spark, folder).items():
        assert mart.dtypes == plain[name].dtypes, name
        assert sorted(rows(mart), key=str) == sorted(rows(plain[name]), key=str), (name, as_of)
    return done


DAY = date(2024, 2, 10)


def test_refreshes_equal_full_rebuilds(spark, raw, tmp_path):
    folder = str(tmp_path / "marts")
    assert len(check(spark, raw, folder, DAY).days["events"]) == len(DAYS) + 1
    # One new day in both tables, and a late row of an old month: that month is made again, no other.
    day = date(2024, 2, 12)
    replace_days(events(spark, *made_events(2, [84], 40)), raw, "events")
    replace_days(users(spark, *made_users(2, [84], 9, 7000)), raw, "users")
    (day_rows,) = [rows(b.load_events(spark, raw).where("created_day = '2023-12-05'").drop("created_day"))]
    late = (70_000, "late", "purchase", datetime(2023, 12, 5, 23), "Safari")
    replace_days(events(spark, *day_rows, late), raw, "events")
    done = check(spark, raw, folder, day)
    assert done.days == {"events": ["2023-12-05", "2024-02-12"], "users": ["2024-02-12"]}
    assert done.months == ["2023-12-01"]
    # Nothing new.
    done = r.refresh(*tables(spark, raw), day, folder)
    assert done.days == {"events": [], "users": []} and done.months == []
    # Rows, days and a whole month that go, more rows without a time, and a day of reckoning months later.
    replace_days(events(spark, late, (4444, None, "cart", None, "Safari"), (3, None, None, None, None)), raw, "events")
    for gone in ("events.parquet/created_day=2023-12-06", "events.parquet/created_day=2023-11-20", "events.parquet/created_day=2023-11-28", "users.parquet/created_day=2024-01-15"):
        shutil.rmtree(f"{raw}/{gone}")
    done = check(spark, raw, folder, date(2024, 5, 1))
    assert done.days == {"events": ["2023-12-05", r.UNDATED], "users": []}
    assert done.months == ["2023-12-01", "2024-02-01"]
    # The day of reckoning moves back.
    assert check(spark, raw, folder, date(2024, 1, 20)).months == []


def test_no_rows_before_the_day(spark, tmp_path):
    raw, folder = str(tmp_path / "raw"), str(tmp_path / "marts")
    old = datetime(2020, 1, 1)
    store_by_day(events(spark, (1, "s", "product", old, "ie")), raw, "events")
    store_by_day(users(spark, (1, old, "A")), raw, "users")
    check(spark, raw, folder, date(2019, 1, 1))


def _files(df, part):
    return sum(
        node.metrics().apply("numFiles").value()
        for name, _, node in plan_nodes.nodes(df)
        if name == "FileSourceScanExec" and part in node.relation().location().rootPaths().toString()
    )


def test_one_day_reads_its_folder_alone(spark, raw, tmp_path):
    people, seen = tables(spark, raw)
    for source, table in (("events", seen), ("users", people)):
        for name, df in r.state_of(table, source, ["2023-12-05"]).items():
            assert _files(df, "raw") == 1, name
    both = r.state_of(seen, "events", ["2023-12-05", r.UNDATED])["user_days"]
    assert _files(both, "raw") == 2
    done = r.refresh(people, seen, DAY, str(tmp_path / "marts"))
    for name, mart in r.marts_from_state(spark, done.version, DAY, {}, [], None).items():
        assert _files(mart, "raw") == 0, name
        assert name not in ("funnel", "kpi_metrics") or _files(mart, "marts") <= 31 * 2, name


def test_a_refresh_that_dies_changes_nothing_and_unchanged_days_stay(spark, raw, tmp_path, monkeypatch):
    folder = str(tmp_path / "marts")
    before = r.refresh(*tables(spark, raw), DAY, folder).version
    replace_days(events(spark, *made_events(6, [40], 20)), raw, "events")

    def dies(*args):
        marts = build(*args)
        return {**marts, "funnel": marts["funnel"].selectExpr("raise_error('lost') AS step", "step_name", "sessions", "percentage")}

    build = r.marts_from_state
    monkeypatch.setattr(r, "marts_from_state", dies)
    with pytest.raises((PySparkException, Py4JJavaError)):
        r.refresh(*tables(spark, raw), DAY, folder)
    assert versions.latest(spark, folder) == before
    monkeypatch.undo()
    versions.forget(spark, folder, keep=1)
    done = r.refresh(*tables(spark, raw), DAY, folder)
    assert done.days["events"] == ["2023-12-30"]
    assert set(MARTS) <= set(done.version.tables)
    parts = before.tables["user_days"].parts
    assert [d for d, where in done.version.tables["user_days"].parts.items() if parts.get(d) != where] == ["2023-12-30"]
    assert before.tables["country_days"] == done.version.tables["country_days"]


def test_tables_have_to_be_stored_by_day(spark, raw, tmp_path):
    plain = str(tmp_path / "plain")
    events(spark, (1, "s", "product", START, "ie")).write.parquet(f"{plain}/events.parquet")
    with pytest.raises(ValueError, match="store the table by day"):
        r.refresh(b.load_users(spark, raw), b.load_events(spark, plain), DAY, str(tmp_path / "marts"))


def test_sets_of_users(spark, raw, tmp_path):
    """Counts from stored sets, with ids of all kinds; no event is looked at again."""
    from tidemark.operators import events as ev
    from tidemark.operators import users as us

    people, seen = tables(spark, raw)
    user_sets.user_sets(seen).write.parquet(str(tmp_path / "seen"))
    user_sets.signup_sets(people).write.parquet(str(tmp_path / "signed"))
    sets, signed = spark.read.parquet(str(tmp_path / "seen")), spark.read.parquet(str(tmp_path / "signed"))
    for as_of in (DAY, date(2000, 1, 1)):
        pairs = [
            (user_sets.mau_monthly(sets, as_of), ev.mau_monthly(seen, as_of)),
            (user_sets.active_users_trailing(sets, as_of), ev.active_users_trailing(seen, as_of)),
            (user_sets.active_users_trailing(sets, as_of, 7), ev.active_users_trailing(seen, as_of, 7)),
            (user_sets.retention_cohorts(signed, sets, as_of, min_size=3), us.retention_cohorts(people, seen, as_of, min_size=3)),
        ]
        for found, wanted in pairs:
            assert found.dtypes == wanted.dtypes and rows(found) == rows(wanted)
            assert _files(found, "raw") == 0


def test_sets_of_nobody(spark):
    nobody = events(spark, (None, "s", "product", datetime(2024, 1, 5), None))
    sets = user_sets.user_sets(nobody)
    assert rows(user_sets.mau_monthly(sets, DAY)) == [(date(2024, 1, 1), 0)]
    assert rows(user_sets.active_users_trailing(user_sets.user_sets(nobody.limit(0)), DAY)) == [(0,)]
