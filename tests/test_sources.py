from __future__ import annotations

from datetime import date

import pytest

from frames import at, events, rows
from oracle_check import TESTDATA
from tidemark.functions.dates import days_before, first_of_month, months_apart
from tidemark.schemas import EVENTS, USERS, conform
from tidemark.sources import bindings as b
from tidemark.sources.tables import as_of_snapshot, read_mart, read_table, store_by_day, write_mart

FOLDER = f"{TESTDATA}/sf0.001"


def test_month_arithmetic():
    assert first_of_month(date(2024, 1, 31), -1) == date(2023, 12, 1)
    assert first_of_month(date(2024, 12, 5), 1) == date(2025, 1, 1)
    assert days_before(date(2024, 3, 1), 1) == date(2024, 2, 29)


def test_months_apart_counts_boundaries(spark):
    df = spark.createDataFrame(
        [(date(2024, 2, 1), date(2024, 1, 31)), (date(2025, 1, 1), date(2023, 11, 1))], "a date, b date"
    )
    assert [row[0] for row in df.select(months_apart(df.a, df.b)).collect()] == [1, 14]


@pytest.mark.parametrize(
    "binding", [b.events_web, b.events_orders], ids=lambda binding: binding.__name__
)
def test_event_bindings_fit_the_schema(spark, binding):
    assert b.load_events(spark, FOLDER, binding).schema.names == EVENTS.names


@pytest.mark.parametrize(
    "binding", [b.users_cust, b.users_ship, b.users_signup], ids=lambda binding: binding.__name__
)
def test_user_bindings_fit_the_schema(spark, binding):
    assert b.load_users(spark, FOLDER, binding).schema.names == USERS.names


def test_conform_reports_missing_and_wrong_columns(spark):
    df = spark.createDataFrame([(1, at("2024-01-01"))], "id long, created_at timestamp")
    with pytest.raises(ValueError, match="country is missing"):
        conform(df, USERS)
    wrong = df.selectExpr("CAST(id AS int) AS id", "created_at", "'x' AS country")
    with pytest.raises(ValueError, match="id is int, expected bigint"):
        conform(wrong, USERS)
    assert conform(df.selectExpr("*", "'x' AS country", "1 AS more"), USERS).columns == USERS.names


def test_zoned_timestamps_work_too(spark):
    df = events(spark, (1, "a", "home", at("2024-01-01", "23:59:59")), (1, "a", "home", at("2024-01-02", "00:00:00")))
    zoned = df.withColumn("created_at", df.created_at.cast("timestamp"))
    assert as_of_snapshot(zoned, date(2024, 1, 1)).count() == 1
    assert as_of_snapshot(zoned, None).count() == 2


def test_marts_are_replaced_and_read_by_value(spark, tmp_path):
    folder = str(tmp_path)
    write_mart(spark.range(5).selectExpr("id", "id % 2 AS odd"), folder, "numbers")
    write_mart(spark.range(3).selectExpr("id", "id % 2 AS odd"), folder, "numbers")
    assert read_mart(spark, folder, "numbers").count() == 3
    assert rows(read_mart(spark, folder, "numbers", odd=1)) == [(1, 1)]
    assert rows(read_mart(spark, folder, "numbers", odd=0, id=2)) == [(2, 0)]


def test_a_heavy_day_is_stored_as_several_files(spark, tmp_path):
    settings = {
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "200KB",
        "spark.sql.adaptive.coalescePartitions.minPartitionSize": "50KB",
    }
    for key, value in settings.items():
        spark.conf.set(key, value)
    try:
        heavy = spark.range(0, 200_000, 1, 8).selectExpr(
            "id",
            "if(id % 3 = 0, timestamp_ntz'2024-01-01',"
            " timestampadd(DAY, int(id % 50), timestamp_ntz'2024-02-01')) AS created_at",
        )
        store_by_day(heavy, str(tmp_path), "heavy")
    finally:
        for key in settings:
            spark.conf.unset(key)
    assert len(list((tmp_path / "heavy.parquet" / "created_day=2024-01-01").glob("*.parquet"))) > 1
    stored = spark.read.parquet(f"{tmp_path}/heavy.parquet")
    assert stored.count() == 200_000
    assert stored.where("created_day = date'2024-01-01'").count() == 66_667


@pytest.mark.parametrize("name", sorted(b.STORED))
def test_stored_schemas_are_those_of_the_files(spark, name):
    assert b.stored(spark, FOLDER, name).dtypes == read_table(spark, FOLDER, name).dtypes
