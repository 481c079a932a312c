"""Whole jobs: build, store and publish the result tables; keep the summaries table."""

from __future__ import annotations

import json
from datetime import date

import pytest

from frames import at, events, rows, signups, users
from tidemark.operators.quality import dq_mart_profile, dq_not_null, table_row_counts
from tidemark.operators.reporting import VIEWS, latest_summary, mart_rows_json, read_view
from tidemark.plans.marts import MARTS, build_marts, publish, refresh_marts, store_marts, stored_marts
from tidemark.plans.summaries import mark_sent, refresh_summaries, sync_latest
from tidemark.schemas import SUMMARIES
from tidemark.sources.tables import read_mart

AS_OF = date(2024, 3, 31)


@pytest.fixture(scope="module")
def stored(spark, tmp_path_factory):
    folder = str(tmp_path_factory.mktemp("marts"))
    people = users(
        spark,
        *signups("Brasil", "2024-01-10", 60),
        *signups("Brazil", "2024-02-10", 20, 100),
        *signups("France", "2024-03-10", 5, 200),
    )
    seen = events(
        spark,
        (0, "a", "product", at("2024-02-03"), "Chrome"),
        (0, "a", "cart", at("2024-02-03"), "Chrome"),
        (1, "b", "product", at("2024-02-04"), "Safari"),
        (1, "c", "product", at("2024-03-20"), "Safari"),
        (1, "c", "purchase", at("2024-03-20"), "Safari"),
    )
    store_marts(build_marts(people, seen, AS_OF), folder)
    return stored_marts(spark, folder)


def test_every_mart_is_built_with_its_view(stored):
    assert sorted(stored) == sorted(MARTS) == sorted(VIEWS)
    assert rows(read_view(stored, "mau")) == [(date(2024, 2, 1), 2)]
    assert rows(read_view(stored, "users_by_country")) == [("Brazil", 80), ("France", 5)]
    assert rows(read_view(stored, "country_decreases")) == [("Brazil", 20, 25.0)]
    assert rows(read_view(stored, "country_increases")) == []
    assert rows(read_view(stored, "kpi_metrics")) == [("2024-03-31", 1, 1.0)]
    assert rows(read_view(stored, "retention"))[:2] == [
        (date(2024, 1, 1), "2024-01", 0, 1.0),
        (date(2024, 1, 1), "2024-01", 1, 2 / 60),
    ]


def test_reports_on_stored_marts(stored):
    assert sum(row.rows for row in table_row_counts(stored).collect()) > 10
    assert {row.failures for row in dq_not_null(stored).collect()} == {0}
    assert dq_mart_profile(stored).where("value IS NULL").count() == 0
    assert all(json.loads(row.row_json) for row in mart_rows_json(stored, AS_OF).collect())


def test_published_marts_have_no_dates(spark, stored, tmp_path):
    publish(stored, str(tmp_path))
    published = stored_marts(spark, str(tmp_path))
    for name, mart in published.items():
        assert "date" not in dict(mart.dtypes).values()
        assert mart.count() == stored[name].count()
    assert rows(published["data_end_date"]) == [("2024-03-20",)]


def test_summaries_job(spark, tmp_path):
    log = spark.createDataFrame(
        [
            ("r1", at("2024-03-01"), date(2024, 3, 1), "old", "{}", "s1", None),
            ("r2", at("2024-03-02"), date(2024, 3, 2), "older text", "{}", "s2", "e2"),
        ],
        SUMMARIES,
    )
    texts = spark.createDataFrame(
        [("r2", 'New\\n\\ntext\n\nfacts_json:\n{"current_mau": 5}'), ("r3", "Only text")], "run_id string, text string"
    )
    now = at("2024-04-01")
    merged = refresh_summaries(log, texts, AS_OF, now)
    assert rows(merged.orderBy("run_id")) == [
        ("r1", at("2024-03-01"), date(2024, 3, 1), "old", "{}", "s1", None),
        ("r2", now, AS_OF, "New\n\ntext", '{"current_mau": 5}', "s2", "e2"),
        ("r3", now, AS_OF, "Only text", "{}", None, None),
    ]
    sent = spark.createDataFrame(
        [("r1", None, None), ("r3", "s3", None)], "run_id string, sent_slack_ts string, sent_email_id string"
    )
    marked = mark_sent(merged, sent)
    assert [row[5:] for row in rows(marked.orderBy("run_id"))] == [("s1", None), ("s2", "e2"), ("s3", None)]
    assert rows(latest_summary(marked))[0][0] == "r3"
    sync_latest(marked, str(tmp_path))
    assert [row[0] for row in rows(read_mart(spark, str(tmp_path), "summaries"))] == ["r3"]
    sync_latest(marked, str(tmp_path), run_id="r1")
    with pytest.raises(ValueError, match="no summary of run r9"):
        sync_latest(marked, str(tmp_path), run_id="r9")
    with pytest.raises(ValueError, match="no summary"):
        sync_latest(marked.limit(0), str(tmp_path))
    assert [row[0] for row in rows(read_mart(spark, str(tmp_path), "summaries"))] == ["r1"]


def test_published_summaries_give_the_latest(spark, tmp_path):
    log = spark.createDataFrame(
        [(run, at("2024-03-01", time), date(2024, 3, 1), run, "{}", None, None)
         for run, time in (("r1", "09:59:59"), ("r2", "10:00:00"), ("r3", "09:00:00"))],
        SUMMARIES,
    )
    publish({"summaries": log}, str(tmp_path))
    published = read_mart(spark, str(tmp_path), "summaries")
    assert dict(published.dtypes)["run_ts"] == "string"
    latest = latest_summary(published)
    assert latest.columns == SUMMARIES.names and rows(latest)[0][:2] == ("r2", "2024-03-01 10:00:00.000000")


def test_shared_tables_give_the_same_marts(spark, tmp_path):
    people = users(
        spark, *signups("Brasil", "2024-01-10", 60), *signups(None, "2024-01-11", 5, 70),
        *signups("Brazil", "2024-02-10", 20, 100), (300, None, "Chile"),
    )
    seen = events(
        spark,
        *[(n % 70, f"s{n % 90}", kind, at(f"2024-0{1 + n % 3}-{1 + n % 28:02d}", f"{n % 24:02d}:00:00"), browser)
          for n in range(400) for kind, browser in [(("product", "cart", "purchase", "home")[n % 4], ("Chrome", "ie")[n % 2])]],
        (None, None, "product", at("2024-02-03"), "Safari"), (5, "s", "cart", None, "Firefox"),
        (900, None, "product", None, "Safari"), (6, "x", None, at("2024-03-31"), "ie"), (6, "y", None, at("2024-03-31"), "Safari"),
    )
    refresh_marts(people, seen, AS_OF, str(tmp_path))
    plain = build_marts(people, seen, AS_OF)
    for name, mart in stored_marts(spark, str(tmp_path)).items():
        assert sorted(rows(mart), key=str) == sorted(rows(plain[name]), key=str), name
