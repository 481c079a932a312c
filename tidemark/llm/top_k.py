"""Exact top-k search: exhaustive term-at-a-time accumulation.

A vector is a row of integer weights; its places are the terms. Candidates are dealt out by a hash of their row
number to groups of a bounded number of weights, and every query goes to every group. A task indexes the
candidates of a group: for each term the candidates that have it, with their weights. Query rows then stream past,
a block at a time: for each of its terms a query scatters the weighted postings into a dense array of scores, one
cell for each candidate of the group. The best of a group are found by partition selection, the best of all by
merging the groups' lists.

Nothing is broadcast or collected. What a task holds is bounded by the weights of its group and by CELLS scores, and a
vector that a third of all rows repeat is dealt out like any other. Reading every pair of query and candidate
is the operator's definition, so that its work is the number of queries times the number of rows.

Defined results: a null vector, or one with a null weight, takes no part. Vectors may differ in length; a place that
one of them lacks counts as zero, and an empty vector scores zero with all. Rows that repeat an id are different
rows: each is a candidate, each is a query of its own, and only the row itself is left out of its list. A missing id
is a candidate that comes after all others of the same score. Scores beyond 64 bits are cut to their
range, and equal then. An empty table gives an empty result; other columns are not looked at.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tidemark.llm.shared import stage

#: Most weights of a group of candidates, and the rows below which a group is not split further.
GROUP_WEIGHTS, GROUP_ROWS = 8_000_000, 4_096

#: Scores that are held at once.
CELLS = 2_000_000

FOUND = "query_row long, query_id long, vec_id long, row long, score long"
LONG = np.iinfo(np.int64)


def _entries(lists: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Owner, term and weight of every weight that is not zero."""
    sizes = pc.list_value_length(lists).to_numpy(zero_copy_only=False).astype(np.int64)
    weights = lists.flatten().to_numpy(zero_copy_only=False).astype(np.int64)
    owners = np.repeat(np.arange(len(sizes)), sizes)
    terms = np.arange(len(weights)) - np.repeat(np.cumsum(sizes) - sizes, sizes)
    kept = weights != 0
    return owners[kept], terms[kept], weights[kept]


def _greatest(weights: np.ndarray) -> int:
    return max(int(weights.max()), -int(weights.min())) if len(weights) else 0


class Postings:
    """The inverted index of one group; candidates come in the order in which ties are settled."""

    def __init__(self, ids: pa.Array, rows: np.ndarray, lists: pa.Array):
        self.ids, self.rows = ids, rows
        self.by_row = np.argsort(rows)
        owners, terms, weights = _entries(lists)
        by_term = np.argsort(terms, kind="stable")
        self.owners, self.weights, terms = owners[by_term], weights[by_term], terms[by_term]
        self.starts = np.searchsorted(terms, np.arange(int(terms[-1]) + 2 if len(terms) else 1))
        self.greatest = _greatest(weights)

    def scores(self, queries: int, owners: np.ndarray, terms: np.ndarray, weights: np.ndarray) -> np.ndarray:
        """A row of scores for each query, a term at a time; in the narrowest numbers that hold them for sure."""
        limit = self.greatest * _greatest(weights) * (len(self.starts) - 1)
        kind = np.int32 if limit < 1 << 31 else np.int64 if limit < 1 << 63 else object
        dense = np.zeros((len(self.rows), queries), kind)
        by_term = np.argsort(terms, kind="stable")
        owners, terms, weights = owners[by_term], terms[by_term], weights[by_term].astype(kind)
        ends = np.flatnonzero(np.diff(terms, append=-1)) + 1
        for start, end in zip(np.concatenate([[0], ends[:-1]]), ends):
            term = terms[start]
            if term + 1 >= len(self.starts):
                break
            posted = slice(self.starts[term], self.starts[term + 1])
            candidates, values = self.owners[posted], self.weights[posted].astype(kind)
            asking = owners[start:end]
            if 2 * len(asking) >= queries:
                row = np.zeros(queries, kind)
                row[asking] = weights[start:end]
                dense[candidates] += values[:, None] * row
            else:
                dense[candidates[:, None], asking] += values[:, None] * weights[start:end]
        return np.ascontiguousarray((dense.clip(LONG.min, LONG.max) if kind is object else dense).T)

    def best(self, scores: np.ndarray, row: int, k: int) -> list[int]:
        """Places of the k best candidates, the query's own row left out, earlier ones first of equals."""
        wanted = k + 1
        if len(scores) > wanted:
            least = np.partition(scores, len(scores) - wanted)[len(scores) - wanted]
            above = np.flatnonzero(scores > least)
            places = np.concatenate([above, np.flatnonzero(scores == least)[: wanted - len(above)]])
        else:
            places = np.arange(len(scores))
        ranked = sorted(map(int, places), key=lambda place: (-int(scores[place]), place))
        return [place for place in ranked if self.rows[place] != row][:k]

    def search(self, ids: pa.Array, rows: np.ndarray, lists: pa.Array, k: int) -> Iterator[pa.RecordBatch]:
        step = max(1, CELLS // max(1, len(self.rows)))
        for first in range(0, len(rows), step):
            block = rows[first : first + step]
            scores = self.scores(len(block), *_entries(lists.slice(first, step)))
            found = [self.best(line, row, k) for line, row in zip(scores, block)]
            counts = [len(places) for places in found]
            places = np.array([place for places in found for place in places], np.int64)
            asked = np.repeat(np.arange(len(block)), counts)
            columns = [
                pa.array(block[asked], pa.int64()),
                ids.slice(first, step).take(pa.array(asked)),
                self.ids.take(pa.array(places)),
                pa.array(self.rows[places], pa.int64()),
                pa.array(scores[asked, places].astype(np.int64)),
            ]
            yield pa.RecordBatch.from_arrays(columns, ["query_row", "query_id", "vec_id", "row", "score"])


def _searched(k: int):
    """Over rows sorted by group, candidates before queries: the best of its group for each query."""

    def tasks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        group, parts, postings = None, [], None
        for batch in batches:
            groups, asks = (batch.column(name).to_numpy(zero_copy_only=False) for name in ("group", "asks"))
            borders = np.flatnonzero(np.diff(groups) | np.diff(asks.astype(np.int8))) + 1
            for start, end in zip([0, *borders], [*borders, batch.num_rows]):
                part = batch.slice(start, end - start)
                if start == end:
                    continue
                if groups[start] != group:
                    group, parts, postings = groups[start], [], None
                if not asks[start]:
                    parts.append(part)
                    continue
                if postings is None:
                    table = pa.Table.from_batches(parts, batch.schema).combine_chunks()
                    postings, parts = Postings(*_columns(table)), []
                yield from postings.search(*_columns(pa.table(part)), k)

    return tasks


def _columns(table: pa.Table) -> tuple[pa.Array, np.ndarray, pa.Array]:
    ids, rows, lists = (_joined(table.column(name)) for name in ("vec_id", "row", "weights"))
    return ids, rows.to_numpy(zero_copy_only=False), lists


def _joined(column: pa.ChunkedArray) -> pa.Array:
    return column.chunk(0) if column.num_chunks == 1 else pa.concat_arrays(column.chunks or [pa.array([], column.type)])


def top_k(vectors: DataFrame, asks: Column, k: int, id_col: str = "vec_id", weights_col: str = "weights") -> DataFrame:
    """query_id, rank, vec_id, score: for each row for which `asks` holds, the k other rows of the greatest inner product.

    `weights_col` is an array of longs. Equal scores are settled by the smaller id, then by the row.
    """
    weights = F.col(weights_col)
    whole = weights.isNotNull() & F.forall(weights, lambda weight: weight.isNotNull())
    rows = stage(
        vectors.where(whole).select(
            F.col(id_col).cast("long").alias("vec_id"),
            weights.cast("array<long>").alias("weights"),
            F.coalesce(asks, F.lit(False)).alias("asks"),
            F.monotonically_increasing_id().alias("row"),
        )
    )
    total = rows.agg(F.count("*").alias("rows"), F.sum(F.size("weights")).alias("weights")).first()
    spread = min(int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions")), total.rows // GROUP_ROWS)
    groups = max(1, spread, -(-(total.weights or 0) // GROUP_WEIGHTS))
    own = F.struct(F.pmod(F.xxhash64("row"), F.lit(groups)).cast("int").alias("group"), F.lit(False).alias("asks"))
    every = F.transform(F.sequence(F.lit(0), F.lit(groups - 1)), lambda g: F.struct(g.alias("group"), F.lit(True).alias("asks")))
    dealt = rows.select(
        "vec_id", "row", "weights", F.explode(F.concat(F.array(own), F.when(F.col("asks"), every).otherwise(F.array()))).alias("to")
    ).select("vec_id", "row", "weights", "to.group", "to.asks")
    found = (
        dealt.repartitionById(groups, F.col("group"))
        .sortWithinPartitions("group", "asks", F.asc_nulls_last("vec_id"), "row")
        .mapInArrow(_searched(k), FOUND)
    )
    best = Window.partitionBy("query_row").orderBy(F.desc("score"), F.asc_nulls_last("vec_id"), "row")
    ranked = found.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= k)
    return ranked.select("query_id", "rank", "vec_id", "score")


def scaled(vector: Column, by: int) -> Column:
    """Each component times `by`, rounded down; null for a vector with a component that is null or not finite."""
    finite = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return F.when(finite, F.transform(vector, lambda x: F.floor(F.lit(float(by)) * x.cast("double"))))
