"""Versions of a folder: all tables at once or none, parts that stay where they are, one writer wins."""

from __future__ import annotations

import os
from datetime import date

import pytest
from py4j.protocol import Py4JJavaError
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from frames import rows
from tidemark.operators.quality import dq_mart_profile, dq_not_null, observed_profile, table_row_counts
from tidemark.plans.marts import FailedCheck, publish, store_marts, stored_marts
from tidemark.sources import versions as v
from tidemark.sources.tables import query_mart, read_mart, write_mart

FAILURES = (PySparkException, Py4JJavaError)


def numbers(spark, *values):
    return spark.createDataFrame([(n,) for n in values], "n int")


def broken(spark):
    return numbers(spark, 1, 2).select(F.when(F.col("n") == 2, F.raise_error(F.lit("lost"))).otherwise(F.col("n")).cast("int").alias("n"))


def test_a_folder_without_versions(spark, tmp_path):
    assert v.latest(spark, str(tmp_path)) == v.Version(str(tmp_path))
    with pytest.raises(ValueError, match="no table a in .*; it has none"):
        read_mart(spark, str(tmp_path), "a")


@pytest.mark.parametrize("store", [store_marts, publish])
def test_a_failure_between_two_tables_leaves_all_old_ones(spark, tmp_path, store):
    folder = str(tmp_path)
    store({"a": numbers(spark, 1), "b": numbers(spark, 1), "c": numbers(spark, 1)}, folder)
    before = stored_marts(spark, folder, ["a", "b", "c"])
    with pytest.raises(FAILURES):
        store({"a": numbers(spark, 2), "b": broken(spark), "c": numbers(spark, 2)}, folder)
    for tables in (before, stored_marts(spark, folder, ["a", "b", "c"])):
        assert [rows(table) for table in tables.values()] == [[(1,)]] * 3
    store({"a": numbers(spark, 3), "b": numbers(spark, 3)}, folder)
    assert [rows(table) for table in stored_marts(spark, folder, ["a", "b", "c"]).values()] == [[(3,)], [(3,)], [(1,)]]
    # Readers that began with the old version go on with it.
    assert [rows(table) for table in before.values()] == [[(1,)]] * 3


def test_a_newest_row_that_cannot_be_written_leaves_the_old_one(spark, tmp_path):
    write_mart(numbers(spark, 1), str(tmp_path), "summaries")
    with pytest.raises(FAILURES):
        write_mart(broken(spark), str(tmp_path), "summaries")
    assert rows(read_mart(spark, str(tmp_path), "summaries")) == [(1,)]


def test_a_table_can_be_made_from_itself(spark, tmp_path):
    folder = str(tmp_path)
    write_mart(numbers(spark, 1, 2), folder, "a")
    write_mart(read_mart(spark, folder, "a").select((F.col("n") * 10).alias("n")), folder, "a")
    assert sorted(rows(read_mart(spark, folder, "a"))) == [(10,), (20,)]


def test_of_two_writers_the_later_fails(spark, tmp_path):
    folder = str(tmp_path)
    base = v.latest(spark, folder)
    table = v.write_table_version(numbers(spark, 1), folder, "a")
    v.commit(spark, base, {"a": table})
    with pytest.raises(v.StaleVersion):
        v.commit(spark, base, {"a": v.write_table_version(numbers(spark, 2), folder, "a")})
    assert rows(read_mart(spark, folder, "a")) == [(1,)]
    assert sorted(name for name in os.listdir(f"{folder}/versions") if not name.startswith(".")) == ["00000001.json"]


def test_the_moment_between_check_and_move(spark, tmp_path, monkeypatch):
    """Even a version that comes in after the check is not overwritten."""
    folder = str(tmp_path)
    base = v.latest(spark, folder)
    table = v.write_table_version(numbers(spark, 1), folder, "a")
    v.commit(spark, base, {"a": table})
    monkeypatch.setattr(v, "_numbers", lambda *_: [])
    with pytest.raises(v.StaleVersion):
        v.commit(spark, base, {})
    monkeypatch.undo()
    assert rows(read_mart(spark, folder, "a")) == [(1,)]


def test_parts_are_replaced_one_by_one(spark, tmp_path):
    folder = str(tmp_path)
    table = spark.createDataFrame(
        [(1, date(2024, 1, 1), "a b"), (2, date(2024, 1, 2), "x/y"), (3, None, None)], "n int, day date, `odd name` string"
    )
    first = v.commit(spark, v.latest(spark, folder), {"t": v.write_table_version(table, folder, "t", "day")})
    assert sorted(first.tables["t"].parts) == ["2024-01-01", "2024-01-02", "__HIVE_DEFAULT_PARTITION__"]
    new = spark.createDataFrame([(9, date(2024, 1, 2), "z")], table.schema)
    changed = v.replaced(first.tables["t"], v.write_table_version(new, folder, "t", "day"), ["2024-01-01"])
    second = v.commit(spark, first, {"t": changed})
    assert second.tables["t"].parts["__HIVE_DEFAULT_PARTITION__"] == first.tables["t"].parts["__HIVE_DEFAULT_PARTITION__"]
    read = v.read_table_version(second, spark, "t")
    assert read.columns == ["n", "odd name", "day"]
    assert sorted(rows(read), key=str) == [(3, None, None), (9, "z", date(2024, 1, 2))]
    assert sorted(rows(v.read_table_version(first, spark, "t")), key=str)[0] == (1, "a b", date(2024, 1, 1))
    assert rows(v.read_table_version(second, spark, "t", ["2024-01-01"])) == []
    assert rows(v.read_table_version(second, spark, "t", ["2024-01-02", "2030-01-01"])) == [(9, "z", date(2024, 1, 2))]


def test_empty_tables_keep_their_columns(spark, tmp_path):
    folder = str(tmp_path)
    write_mart(numbers(spark), folder, "none")
    read = read_mart(spark, folder, "none")
    assert read.dtypes == [("n", "int")] and rows(read) == []
    with pytest.raises(ValueError, match="version is the column"):
        v.write_table_version(numbers(spark, 1).withColumnRenamed("n", "version"), folder, "x")


def test_old_versions_can_be_forgotten(spark, tmp_path):
    folder = str(tmp_path)
    for n in range(4):
        write_mart(numbers(spark, n), folder, "a")
    write_mart(numbers(spark, 7), folder, "b")
    v.write_table_version(numbers(spark, 8), folder, "b")  # of a job that died
    assert v.forget(spark, folder, keep=1) == 4
    assert rows(read_mart(spark, folder, "a")) == [(3,)] and rows(read_mart(spark, folder, "b")) == [(7,)]
    assert v.latest(spark, folder).number == 5 and v.forget(spark, folder, keep=1) == 0


MARTS = {
    "mau": ("month date, mau long", [(date(2024, 1, 1), 5), (date(2024, 2, 1), 7)]),
    "retention": ("cohort_month date, retention_rate double", [(date(2024, 1, 1), 1.0), (date(2024, 1, 1), 0.0), (date(2024, 2, 1), 1e-9)]),
    "users_by_country": ("country string, users long", [("A", 3), ("B", 9)]),
    "platform_share": ("platform string, users long, share double", [("iOS", 3, 0.75), ("Web", 1, 0.25)]),
    "data_end_date": ("data_end_date date", [(date(2024, 2, 3),)]),
}


@pytest.fixture()
def marts(spark):
    return {name: spark.createDataFrame(data, schema) for name, (schema, data) in MARTS.items()}


def test_checks_and_figures_are_observed_while_writing(spark, tmp_path, marts):
    observed = publish(marts, str(tmp_path))
    assert sorted(rows(observed_profile(spark, observed))) == sorted(rows(dq_mart_profile(marts)))
    assert {name: values["rows"] for name, values in observed.items()} == dict(rows(table_row_counts(marts)))
    nulls = {(t, c): observed[t][f"nulls of {c}"] for t, c, _ in rows(dq_not_null(marts))}
    assert nulls == {(t, c): n for t, c, n in rows(dq_not_null(marts))}


def test_a_failing_check_publishes_nothing(spark, tmp_path, marts):
    publish(marts, str(tmp_path))
    bad = spark.createDataFrame([(None, 1), ("C", 1)], "country string, users long")
    later = spark.createDataFrame([(date(2025, 1, 1), 1)], "month date, mau long")
    with pytest.raises(FailedCheck, match="users_by_country.country: 1 NULLs"):
        publish({**marts, "mau": later, "users_by_country": bad}, str(tmp_path))
    assert len(rows(read_mart(spark, str(tmp_path), "mau"))) == 2
    assert sorted(rows(read_mart(spark, str(tmp_path), "users_by_country"))) == [("A", 3), ("B", 9)]


def test_each_table_is_computed_once_when_it_is_published(spark, tmp_path):
    seen = spark.sparkContext.accumulator(0)

    def counted(batches):
        for batch in batches:
            seen.add(batch.num_rows)
            yield batch

    mart = spark.createDataFrame(*reversed(MARTS["users_by_country"])).mapInArrow(counted, "country string, users long")
    publish({"users_by_country": mart}, str(tmp_path))
    assert seen.value == 2


def test_parameters_of_reads(spark, tmp_path):
    folder = str(tmp_path)
    data = [("O'Brien", 1, date(2024, 1, 1)), (None, 2, None), ("x", None, date(2024, 1, 2))]
    write_mart(spark.createDataFrame(data, "name string, n int, day date"), folder, "t")

    def names(**equals):
        return sorted((row.name for row in read_mart(spark, folder, "t", **equals).collect()), key=str)

    assert names(name="O'Brien") == ["O'Brien"] and names(name="' OR 1=1 --") == []
    assert names(name=None) == [None] and names(n=None) == ["x"] and names(name=None, n=2) == [None]
    assert names(n="1") == ["O'Brien"] and names(n="one") == [] and names(day="2024-01-02") == ["x"] and names(day="soon") == []
    asked = query_mart(spark, folder, "t", "SELECT n FROM {table} WHERE name = :who OR day = :day", who="O'Brien", day=date(2024, 1, 2))
    assert sorted(rows(asked), key=str) == [(1,), (None,)]
    assert rows(query_mart(spark, folder, "t", "SELECT n FROM {table} WHERE name = :who", who=None)) == []
    assert rows(query_mart(spark, folder, "t", "SELECT n FROM {table} WHERE name <=> :who", who=None)) == [(2,)]
    assert rows(query_mart(spark, folder, "t", "SELECT n FROM {table} WHERE name = :who", who="x'; DROP TABLE t")) == []
