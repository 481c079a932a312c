"""Exact search against a score of every pair."""

from __future__ import annotations

import math
import random

import pytest
from pyspark.sql import functions as F

from tidemark.llm import top_k
from tidemark.llm.queries import op12_top_k


def slow(rows, every, k):
    rows = [(vec_id, w, place) for place, (vec_id, w) in enumerate(rows) if w is not None and None not in w]
    found = []
    for query_id, query, own in rows:
        if query_id is None or query_id % every:
            continue
        scored = [(-min(max(sum(a * b for a, b in zip(query, w)), -(2**63)), 2**63 - 1), vec_id is None, vec_id or 0, place) for vec_id, w, place in rows if place != own]
        for rank, (score, missing, vec_id, _) in enumerate(sorted(scored)[:k], 1):
            found.append((query_id, rank, None if missing else vec_id, -score))
    return sorted(found, key=str)


def fast(spark, rows, every, k):
    schema = "vec_id long, weights array<long>, row string, `a.b` int, score int, asks int, query_row long"
    table = spark.createDataFrame([(*row, "r", 1, 2, 3, 4) for row in rows], schema)
    return sorted(map(tuple, top_k.top_k(table, F.col("vec_id") % every == 0, k).collect()), key=str)


ODD = [
    (0, [1, 2, 3]), (1, [1, 2, 3]), (2, [0, 0, 0]), (3, []), (4, None), (5, [1, None, 2]), (6, [-1, -2, -3]), (7, [4]),
    (8, [0, 0, 0, 9]), (None, [1, 2, 3]), (None, [5, 5, 5]), (0, [1, 2, 3]), (0, [7, 7]), (-10, [1, 0, 1]), (10, []),
]


@pytest.mark.parametrize("k", [1, 3, 50])
def test_odd_rows(spark, k):
    assert fast(spark, ODD, 5, k) == slow(ODD, 5, k)


def test_many_groups_and_ties(spark, monkeypatch):
    monkeypatch.setattr(top_k, "GROUP_WEIGHTS", 200)
    monkeypatch.setattr(top_k, "CELLS", 70)
    chance = random.Random(4)
    rows = [(i, [chance.randrange(-3, 4) for _ in range(chance.randrange(9))]) for i in range(300)]
    rows += [(1000 + i, [3, 3, 3, 3]) for i in range(150)]
    assert fast(spark, rows, 7, 5) == slow(rows, 7, 5)


def test_sparse_queries(spark):
    chance = random.Random(8)
    rows = [(i, [chance.choice([0] * 12 + [5, -2]) for _ in range(40)]) for i in range(200)]
    assert fast(spark, rows, 3, 4) == slow(rows, 3, 4)


@pytest.mark.parametrize("size", [1 << 20, 1 << 40, 1 << 62])
def test_great_weights(spark, size):
    rows = [(i, [size + i, -size, size // 2 + i]) for i in range(12)]
    assert fast(spark, rows, 4, 5) == slow(rows, 4, 5)


def test_empty_and_single(spark):
    assert fast(spark, [], 1, 5) == [] and fast(spark, [(0, [1])], 1, 5) == []


def test_query(spark, tmp_path):
    chance = random.Random(3)
    rows = [(i, [chance.uniform(-1, 1) for _ in range(8)]) for i in range(230)]
    rows += [(230, None), (231, [0.5, None]), (232, [math.nan] * 8), (250, [math.inf] * 8), (300, [0.25, -0.001])]
    table = spark.createDataFrame([(*row, 1) for row in rows], "vec_id long, embedding array<float>, label int")
    table.write.parquet(f"{tmp_path}/embeddings.parquet")
    stored = [(r.vec_id, r.embedding) for r in table.collect()]
    good = [(i, x and all(c is not None and math.isfinite(c) for c in x) and [math.floor(256 * c) for c in x] or None) for i, x in stored]
    found = op12_top_k(spark, str(tmp_path))
    assert sorted(map(tuple, found.collect()), key=str) == slow(good, 50, 5)
    assert found.dtypes == [("query_id", "bigint"), ("rank", "int"), ("vec_id", "bigint"), ("score", "bigint")]
