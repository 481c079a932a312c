"""Marks of keys: whatever they let through is compared, and they let few others through."""

from __future__ import annotations

from tidemark.llm import shared


def test_marks_find_every_key_and_few_others(spark, monkeypatch):
    """Four times as many keys as words of marks."""
    monkeypatch.setattr(shared, "MARK_BITS", 1 << 16)
    table = spark.range(100_000).selectExpr("id AS k", "id AS word_of_marks", "'x' AS `a.b`")
    keys = table.where("k % 25 = 0").select("k")
    marked = shared.marks(keys, keys["k"])
    assert marked.count() <= 1024
    several, rest = shared.parted(table, marked, table["k"])
    assert several.columns == rest.columns == table.columns
    assert several.where("k % 25 = 0").count() == 4_000
    passed = several.count() - 4_000
    assert passed < 0.08 * 96_000 and passed + rest.count() == 96_000


def test_without(spark, monkeypatch):
    monkeypatch.setattr(shared, "MARK_BITS", 128)
    table = spark.createDataFrame([(n % 50 or None, n) for n in range(500)], "k long, n long")
    for gone in ([3, 7, 49], list(range(1, 50)), []):
        dropped = spark.createDataFrame([(k,) for k in gone], "k long")
        left = shared.without(table, dropped, "k")
        assert sorted(r.n for r in left.collect()) == [n for n in range(500) if n % 50 not in gone]
