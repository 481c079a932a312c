"""Text rules on hand-made cases and, against a plain character-by-character reading, on random texts."""

from __future__ import annotations

import json
import random

import pytest
from pyspark.sql import functions as F

from frames import rows
from tidemark.functions import text
from tidemark.functions.text import WHITESPACE
from tidemark.operators.text import clean_text, extract_facts, facts_by_path, facts_schema, facts_variant


def texts(spark, *values):
    return spark.createDataFrame(list(enumerate(values)), "id long, text string").repartition(8)


def facts_of(spark, *values):
    found = extract_facts(texts(spark, *values), fields={})
    return [row.facts_json for row in sorted(found.collect(), key=lambda row: row.id)]


def cleaned(spark, *values):
    return [row.text for row in sorted(clean_text(texts(spark, *values)).collect(), key=lambda row: row.id)]


def plain_facts(text: str) -> dict:
    marker = text.find("facts_json")
    start = text.find("{", marker) if marker >= 0 else -1
    end = text.rfind("}")
    if start < 0 or end < start:
        return {}
    try:
        return json.loads(text[start : end + 1], parse_constant=lambda _: 1 / 0)
    except (ValueError, ZeroDivisionError):
        return {}


def plain_clean(text: str) -> str:
    at = text.lower().find("facts_json")
    text = text[:at] if at >= 0 else text
    for opening in ("```json", "```"):
        done, rest = "", text
        while True:
            start = rest.lower().find(opening)
            end = rest.find("```", start + len(opening)) if start >= 0 else -1
            if end < 0:
                break
            done, rest = done + rest[:start], rest[end + 3 :]
        text = done + rest
    lines = text.replace("\\n", "\n").split("\n")
    kept = []
    for number, line in enumerate(lines):
        inner = 0 < number < len(lines) - 1
        if inner and not line.strip():
            if kept[-1] is not None:
                kept.append(None)
        else:
            kept.append(line)
    return "\n".join(line or "" for line in kept).strip()


def test_whitespace_is_what_python_strips():
    assert set(WHITESPACE) == {chr(code) for code in range(0x110000) if chr(code).isspace()}


def test_facts(spark):
    found = facts_of(
        spark,
        'Text\n\nfacts_json:\n{"b": 1,\n "a": {"c": [1, 2.5, null, "x}"]}}\nbye',
        "no marker {}",
        "facts_json without braces",
        "facts_json } {",
        "facts_json {broken}",
        'FACTS_JSON {"a": 1}',
        '{"x": 0} facts_json {"a": 1} {"b": 2}',
        'facts_json facts_json {"a": 1}',
        'facts_json {"a": 1, "a": 2}',
        None,
        "facts_json {}",
        'facts_json {"é": "ü"}',
    )
    assert [json.loads(text) for text in found] == [
        {"b": 1, "a": {"c": [1, 2.5, None, "x}"]}},
        {},
        {},
        {},
        {},
        {},
        {},
        {"a": 1},
        {"a": 2},
        {},
        {},
        {"é": "ü"},
    ]


def test_facts_are_kept_as_written(spark):
    big, number = "x" * 20_000_100, "1234567890123456789012345678901234567890123"
    blocks = [
        '{"a": 1.0, "b": %s, "c": 1e400, "A" : "\\u00e9"}' % number,
        '{"a": "%s", "b": [%s]}' % (big, ", ".join(["1"] * 100_000)),
        '{"a": %s.5}' % ("9" * 5_000),
    ]
    assert facts_of(spark, *[f"facts_json {block}" for block in blocks]) == blocks


def test_broken_facts_are_told_from_none(spark):
    broken = [
        '{"a": 1,}', "{'a': 1}", '{"a": "tab\there"}', '{"a": \\"b"}', '{"a": 01}', '{"a": 1},{"b": 2}', '{"a": 1}]}',
        '{"a": NaN}', '{"a": "\\x"}', '{"a": "\\u12"}', '{"a" "b"}', '{"a": 1} {"b": 2}', '{"a": "x" "y"}', "{a: 1}",
        '{"a": 0%s}' % ("1" * 40), '{"a": tru\\u0065}',
    ]
    df = texts(spark, *[f"facts_json {block}" for block in broken], "nothing", "facts_json", None, "facts_json {}")
    found = sorted(extract_facts(df, fields={}).collect(), key=lambda row: row.id)
    assert [row.facts_state for row in found] == ["unreadable"] * len(broken) + ["none", "none", "none", "read"]
    assert {row.facts_json for row in found} == {"{}"}


def test_repeated_fields_do_not_depend_on_settings(spark):
    df = texts(spark, 'facts_json {"current_mau": 1, "current_mau": 2}')
    for setting in ("true", "false"):
        spark.conf.set("spark.sql.variant.allowDuplicateKeys", setting)
        assert extract_facts(df).first().current_mau == "2"
    spark.conf.unset("spark.sql.variant.allowDuplicateKeys")


def test_fact_fields(spark):
    df = texts(spark, 'facts_json {"current_mau": 1200, "platform_share": "49.8%"}', "nothing")
    found = sorted(extract_facts(df).collect(), key=lambda row: row.id)
    assert [(row.current_mau, row.platform_share, row.growth_trend) for row in found] == [
        ("1200", "49.8%", None),
        (None, None, None),
    ]
    typed = extract_facts(df, fields={"current_mau": "bigint", "platform_share": "double"})
    assert rows(typed.orderBy("id").select("current_mau", "platform_share")) == [(1200, None), (None, None)]


def test_clean(spark):
    assert cleaned(
        spark,
        "keep\n\nfacts_json:\n{}",
        "keep Facts_JSON drop\nall",
        'a ```JSON\n{"x": 1}\n``` b ```sql\nselect``` c',
        "open ``` fence",
        "one\\n\\ntwo\\nthree",
        "a\n \t\n\r\n\n\nb\nc",
        " 　 edge  \n",
        "",
        None,
        "``` a ```json b ```",
    ) == [
        "keep",
        "keep",
        "a  b  c",
        "open ``` fence",
        "one\n\ntwo\nthree",
        "a\n\nb\nc",
        "edge",
        "",
        None,
        "``` a",
    ]


PIECES = [
    "facts_json", "FACTS_json", "{", "}", '{"a": 1}', '"b": [2]', "```", "```json", "```JSON", "\\n", "\\n\\n",
    "\\", "n", "\n", "\n\n", "\r\n", " ", "\t", "\x0b", "\x1c", " ", " ", "word", "é", "😀", ",", ":",
]


def test_random_texts(spark):
    rng = random.Random(7)
    values = ["".join(rng.choices(PIECES, k=rng.randrange(1, 25))) for _ in range(6000)]
    assert cleaned(spark, *values) == [plain_clean(value) for value in values]
    found = facts_of(spark, *values)
    assert [json.loads(text) for text in found] == [plain_facts(value) for value in values]
    assert sum(text != "{}" for text in found) > 50


def test_hostile_texts_stay_linear(spark):
    size = 300_000
    values = [
        "facts_json" * (size // 10),
        "facts_json" + "{" * size,
        "facts_json {" + "facts_json" * (size // 10),
        " " * size + "x",
        "\n" + " " * size + "x",
        "```json" * (size // 7),
        "x" + " " * size,
    ]
    assert cleaned(spark, *values) == [plain_clean(value) for value in values]
    assert facts_of(spark, *values) == ["{}"] * len(values)


FRACTIONS = {
    0.0: "0", -0.0: "0", 1.0: "1", -1.0: "-1", 0.0004: "0.0004", 1e-7: "0.0000001", -2.5e-9: "-0.0000000025", 1e-21: "0." + "0" * 20 + "1",
    1e19: "1" + "0" * 19, 1.5e19: "15" + "0" * 18, 1234567.5: "1234567.5", 12345678.25: "12345678.25", 1.0e7: "10000000", 123456789.0: "123456789",
    1.7976931348623157e308: "17976931348623157" + "0" * 292, 5e-324: "0." + "0" * 323 + "49", 0.1: "0.1", 100.0: "100", 0.75: "0.75",
    float("nan"): None, float("inf"): None, float("-inf"): None,
}


@pytest.mark.parametrize("ansi", ["true", "false"])
def test_plain_decimals_of_any_size(spark, ansi):
    kept = spark.conf.get("spark.sql.ansi.enabled")
    spark.conf.set("spark.sql.ansi.enabled", ansi)
    try:
        table = spark.createDataFrame([(x,) for x in [*FRACTIONS, None]], "x double")
        found = [row[0] for row in table.select(text.plain_decimal(F.col("x"))).collect()]
        assert found == [*FRACTIONS.values(), None]
        assert all(float(f) == x for f, x in zip(found, FRACTIONS) if f is not None)
        narrow = spark.createDataFrame([(0.25,), (1e10,)], "x float").select(text.plain_decimal(F.col("x")))
        assert [row[0] for row in narrow.collect()] == ["0.25", "10000000000"]
    finally:
        spark.conf.set("spark.sql.ansi.enabled", kept)


def test_fact_columns_do_not_clash(spark):
    table = spark.createDataFrame([('facts_json: {"a.b": "x", "current_mau": 1.50}', 1, 2, 3)], "text string, block int, facts int, fields int")
    found = extract_facts(table, fields={"a.b": "string", "current_mau": "string"})
    assert found.columns == ["text", "block", "facts", "fields", "facts_json", "facts_state", "a.b", "current_mau"]
    assert tuple(found.collect()[0])[1:] == (1, 2, 3, '{"a.b": "x", "current_mau": 1.50}', "read", "x", "1.5")
    with pytest.raises(ValueError, match="current_mau already"):
        extract_facts(table.withColumn("Current_MAU", F.lit(1)))


def test_facts_stored_as_variants(spark, tmp_path):
    records = [
        '{"current_mau": 5, "platform_share": "12.5%", "more": {"x": [1, null]}}', '{"current_mau": 0.125}', "{}", '{"current_mau": null}',
        '{"current_mau": 1, "current_mau": 2}', '{"retention_rate": true, "growth_trend": "a\\"b"}', '{"current_mau": 12345678901234567890}',
    ]
    table = spark.createDataFrame([(f"facts_json: {record}",) for record in records] + [("none",), ("facts_json: {,}",), (None,)], "text string")
    plain = extract_facts(table)
    facts_variant(extract_facts(table, fields={})).write.parquet(str(tmp_path / "facts"))
    stored = spark.read.parquet(str(tmp_path / "facts"))
    assert dict(stored.dtypes)["facts"] == "variant"
    found = facts_by_path(stored).drop("facts")
    assert found.columns == plain.columns and sorted(rows(found), key=str) == sorted(rows(plain), key=str)
    assert {row.facts_json for row in stored.collect()} == {*records, "{}"}
    (schema,) = rows(facts_schema(stored))
    assert "current_mau" in schema[0] and "platform_share: STRING" in schema[0]
    odd = spark.createDataFrame([('{"a.b": 1, "it\'s": 2, "\'x\\"": 3}',)], "facts_json string")
    names = {"a.b": "int", "it's": "int", "'x\"": "int"}
    assert rows(facts_by_path(facts_variant(odd), names).drop("facts", "facts_json")) == [(1, 2, 3)]
    with pytest.raises(ValueError, match="facts already"):
        facts_variant(stored)
