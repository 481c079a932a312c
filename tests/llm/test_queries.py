"""The registered queries against their SQL, and the pipeline against the operators' own results."""

from __future__ import annotations

import pytest

import __spark_entry__ as entry_points
import corpus_pipeline
from oracle_check import TESTDATA, connect, difference
from tidemark.llm import queries
from tidemark.llm.shared import stage as stored

FOLDER = f"{TESTDATA}/sf0.001"


def test_every_operator_is_registered_once():
    numbers = sorted(int(name[2:].split("_")[0]) for name in queries.QUERIES)
    assert numbers == list(range(1, 14))
    assert {*queries.QUERIES, "pipeline"} <= set(entry_points.queries())


@pytest.mark.parametrize("key", sorted(queries.ORACLE_SQL))
def test_matches_sql(spark, key):
    with connect(FOLDER) as con:
        assert difference(queries.QUERIES[key](spark, FOLDER), con, queries.ORACLE_SQL[key]) is None


def test_pipeline(spark):
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet")
    count = docs.count()
    for name, stage in corpus_pipeline.STAGES:
        left = stored(stage(spark, docs, FOLDER))
        if name != "byte_bpe":
            assert left.columns == docs.columns and 0 < left.count() <= count
        count, docs = left.count(), left
    assert docs.columns == ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"]
    whole = corpus_pipeline.run(spark, FOLDER)
    assert sorted(map(tuple, whole.collect())) == sorted(map(tuple, docs.collect()))


ROWS = [
    (1, "one two three four five six seven"), (1, "one two three four five six seven"), (2, "one two  three four five six seven"),
    (3, None), (4, ""), (None, "nobody knows this text at all"), (5, "a benchmark passage of ten words or more stands here now ok"),
    (6, "word " * 30_000), (7, "word " * 30_000 + "x"),
]


@pytest.fixture
def hand_made(spark, tmp_path, documents):
    def folder(rows):
        columns = "doc_id long, text string"
        documents(*rows, columns=columns).write.parquet(f"{tmp_path}/documents.parquet")
        spark.createDataFrame([(1, 1, 0), (2, None, None), (None, 1, 1)], "doc_id long, quality int, toxic int").write.parquet(
            f"{tmp_path}/labels.parquet"
        )
        item = "benchmark passage of ten words or more stands here now"
        spark.createDataFrame([(1, item), (2, None)], "item_id int, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
        return str(tmp_path)

    return folder


def test_pipeline_on_odd_rows(spark, hand_made):
    found = corpus_pipeline.run(spark, hand_made(ROWS)).collect()
    assert sorted((r.doc_id is None, r.doc_id) for r in found) == [(False, 1), (False, 3), (False, 6), (True, None)]


def test_pipeline_on_an_empty_table(spark, hand_made):
    assert corpus_pipeline.run(spark, hand_made([])).collect() == []
