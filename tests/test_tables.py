from __future__ import annotations

from datetime import date, datetime

import pytest
from py4j.protocol import Py4JJavaError
from pyspark.errors import PySparkException

from frames import at, rows
from tidemark.operators import tables as tb

# Spark wraps the failure differently when several stages run into it at once.
FAILURES = (PySparkException, Py4JJavaError)


def _sorted(df):
    return sorted(rows(df), key=str)


@pytest.fixture()
def target(spark):
    return spark.createDataFrame(
        [(1, "a", 10, "keep"), (2, "b", None, None), (2, "bb", 21, "x"), (None, "n", 0, "n")],
        "id long, text string, n int, note string",
    )


def test_upsert_updates_keeps_and_adds(spark, target):
    source = spark.createDataFrame([(2, None, 5), (3, "c", None)], "id long, text string, n int")
    assert _sorted(tb.upsert_by_key(target, source, "id")) == sorted(
        [(1, "a", 10, "keep"), (2, None, 5, None), (2, None, 5, "x"), (3, "c", None, None), (None, "n", 0, "n")],
        key=str,
    )


def test_upsert_into_an_empty_table_and_from_one(spark, target):
    source = spark.createDataFrame([(3, "c")], "id long, text string")
    assert rows(tb.upsert_by_key(target.limit(0), source, "id")) == [(3, "c", None, None)]
    assert _sorted(tb.upsert_by_key(target, source.limit(0), "id")) == _sorted(target)


@pytest.mark.parametrize("bad", [[(3, "c"), (3, "d")], [(2, "c"), (2, "c")], [(None, "c")]])
def test_upsert_rejects_missing_and_repeated_keys(spark, target, bad):
    source = spark.createDataFrame(bad, "id long, text string")
    with pytest.raises(FAILURES, match="missing or given several times"):
        tb.upsert_by_key(target, source, "id").collect()


def test_upsert_of_many_rows_against_a_plain_merge(spark):
    target = spark.range(0, 4000).selectExpr("id % 1500 AS id", "id AS a", "id * 2 AS b")
    source = spark.range(1000, 2500).selectExpr("id", "-id AS a")
    expected = [(row.id, -row.id if row.id >= 1000 else row.a, row.b) for row in target.collect()]
    expected += [(n, -n, None) for n in range(1500, 2500)]
    assert sorted(rows(tb.upsert_by_key(target, source, "id")), key=str) == sorted(expected, key=str)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", -1)
    try:
        shuffled = tb.upsert_by_key(target, source, "id")
        assert sorted(rows(shuffled), key=str) == sorted(expected, key=str)
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_update_sets_nulls_but_skips_empty_changes(spark, target):
    changes = spark.createDataFrame(
        [(1, None, "new"), (2, "", None), (7, "z", "z"), (None, "y", "y")], "id long, text string, note string"
    )
    assert _sorted(tb.update_by_key(target, changes, "id")) == sorted(
        [(1, None, 10, "new"), (2, "b", None, None), (2, "bb", 21, "x"), (None, "n", 0, "n")], key=str
    )


def test_unknown_columns_are_an_error(spark, target):
    with pytest.raises(ValueError, match="no column extra"):
        tb.upsert_by_key(target, spark.createDataFrame([(3, "c")], "id long, extra string"), "id")
    with pytest.raises(ValueError, match="no column typo"):
        tb.update_by_key(target, spark.createDataFrame([(3, "c")], "id long, typo string"), "id")


def test_update_rejects_repeated_keys(spark, target):
    changes = spark.createDataFrame([(1, "p"), (1, "q")], "id long, text string")
    with pytest.raises(FAILURES, match="several times"):
        tb.update_by_key(target, changes, "id").collect()


def test_latest_record(spark):
    log = spark.createDataFrame(
        [
            ("a", at("2024-01-02"), 1),
            ("a", at("2024-01-02"), 2),
            ("a", None, 9),
            ("b", at("2024-01-01"), 3),
            ("c", None, 4),
            (None, at("2024-01-01"), 5),
        ],
        "run string, ts timestamp_ntz, n int",
    )
    for df in (log, log.orderBy("n"), log.repartition(5)):
        assert rows(tb.latest_record(df, "ts", tie_break="n")) == [("a", at("2024-01-02"), 2)]
        assert _sorted(tb.latest_record(df, "ts", tie_break="n", key="run")) == sorted(
            [
                ("a", at("2024-01-02"), 2),
                ("b", at("2024-01-01"), 3),
                ("c", None, 4),
                (None, at("2024-01-01"), 5),
            ],
            key=str,
        )


def test_export_stringify(spark):
    df = spark.createDataFrame(
        [(1, date(2024, 1, 5), datetime(2024, 1, 5, 1, 2, 3, 500000), datetime(2024, 1, 5), "x"), (None,) * 5],
        "n long, d date, ntz timestamp_ntz, ltz timestamp, s string",
    ).withColumn("ltz", tb.F.lit("2024-01-05 00:00:00").cast("timestamp"))
    text = tb.export_stringify(df)
    assert [kind for _, kind in text.dtypes] == ["bigint", "string", "string", "string", "string"]
    assert rows(text) == [
        (1, "2024-01-05", "2024-01-05 01:02:03.500000", "2024-01-05 00:00:00.000000", "x"),
        (None, None, None, "2024-01-05 00:00:00.000000", None),
    ]


CLASHES = ["given_key", "new_values", "known_key", "is_known", "rows", "position", "a.b", "_key", "_new"]


def test_columns_may_have_any_name(spark):
    names = ", ".join(f"`{name}` int" for name in CLASHES)
    target = spark.createDataFrame([(1, *range(9)), (2, *range(9))], f"id long, {names}")
    source = spark.createDataFrame([(2, 70, 71), (3, 72, 73)], "ID long, `A.B` int, Known_Key int")
    merged = sorted(rows(tb.upsert_by_key(target, source, "Id")), key=str)
    assert merged == [(1, *range(9)), (2, 0, 1, 71, 3, 4, 5, 70, 7, 8), (3, None, None, 73, None, None, None, 72, None, None)]
    changed = sorted(rows(tb.update_by_key(target, source, "id")))
    assert changed == [(1, *range(9)), (2, 0, 1, 71, 3, 4, 5, 70, 7, 8)]
    newest = tb.latest_record(target, "position", tie_break="id", key="rows")
    assert newest.columns == target.columns and rows(newest) == [(2, *range(9))]


def test_names_are_matched_as_the_session_does(spark, target):
    source = spark.createDataFrame([(2, "c")], "id long, TEXT string")
    assert {row.text for row in tb.upsert_by_key(target, source, "id").where("id = 2").collect()} == {"c"}
    spark.conf.set("spark.sql.caseSensitive", "true")
    try:
        with pytest.raises(ValueError, match="no column TEXT"):
            tb.upsert_by_key(target, source, "id")
    finally:
        spark.conf.unset("spark.sql.caseSensitive")
