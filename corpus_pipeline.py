"""A corpus pipeline from raw documents to token ids, one stage per training-data operator.

Every stage reads the table the one before it wrote, works on all of its rows, and returns the columns
of `documents` (the last returns the token counts and digests). Nulls, empty and long texts, repeated
rows, empty tables and further columns are treated as the operators' docstrings say; a row with a null
text is a document with an empty one and keeps its null.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm import bpe, decontamination, exact_dedup, simhash, toxicity
from tidemark.llm.queries import SIMHASH
from tidemark.llm.shared import columns_of, fresh, shared_folder

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the toxicity operator, trained on the labels of the folder, does not reject."""
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    score = fresh(docs, "toxicity_score")
    scored = docs.withColumn(score, toxicity.scores(F.col("text"), toxicity.train(docs, labels)))
    return scored.where(F.col(score) < toxicity.THRESHOLD).select(*columns_of(docs))


def drop_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of documents with the same text the one with the smallest id."""
    return exact_dedup.without_duplicates(docs)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of documents linked by their fingerprints the one with the smallest id."""
    return simhash.one_of_each(docs, **SIMHASH)


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in which no window of a benchmark item occurs."""
    return decontamination.clean(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def encode_bytes(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, n_tokens, ids_sha256, decoded_sha256 of every document that is left."""
    path = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
    return bpe.digests(bpe.encode_documents(docs, path, public_tokenizers.PATTERN))


STAGES: list[tuple[str, Stage]] = [
    ("toxicity", drop_toxic),
    ("exact_dedup", drop_copies),
    ("simhash", drop_near_copies),
    ("decontamination", drop_contaminated),
    ("byte_bpe", encode_bytes),
]

#: Training a classifier, fingerprints and byte-pair merges have no SQL form.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents of a folder, each written to the shared folder and read again."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    folder = f"{shared_folder(spark)}/pipeline-{uuid.uuid4().hex}"
    for place, (name, function) in enumerate(STAGES):
        path = f"{folder}/{place}-{name}"
        function(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
