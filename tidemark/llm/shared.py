"""Folds, stored intermediate tables, checked broadcasts and column names that cannot clash."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# ASCII white space, which separates words and is folded to one space.
ASCII_SPACE = r"[\x20\x09-\x0D]+"

#: Bits that tell every task which keys to look at, 64 to a row: never more than 262,144 rows of two numbers.
MARK_BITS = 1 << 24

#: Rows up to which a table may be sent to every task.
BROADCAST_ROWS = 200_000


def shared_folder(spark: SparkSession) -> str:
    """The folder all executors share, as named by `spark.checkpoint.dir`; a local one only if unset."""
    folder = spark.sparkContext.getConf().get("spark.checkpoint.dir") or spark.sparkContext.getCheckpointDir()
    if not folder:
        folder = tempfile.mkdtemp(prefix="tidemark-")
        spark.sparkContext.setCheckpointDir(folder)
    return folder.rstrip("/")


def stage(df: DataFrame, compression: str = "snappy") -> DataFrame:
    """Write a table to the shared folder and read it back: it is computed once, its lineage ends there.

    Unlike a local checkpoint it outlives the executors that made it. The files stay until the folder
    is cleared, as plans built on them are still to run when the operator returns.
    """
    spark = df.sparkSession
    path = f"{shared_folder(spark)}/table-{uuid.uuid4().hex}"
    df.write.parquet(path, compression=compression)
    return spark.read.schema(df.schema).parquet(path)


def small(df: DataFrame, rows: int = BROADCAST_ROWS) -> DataFrame:
    """Marked for broadcast if it has at most so many rows; else Spark joins it by a shuffle."""
    return F.broadcast(df) if df.limit(rows + 1).count() <= rows else df


def fold(doc_id: Column, folds: int) -> Column:
    """crc32 of the id as text modulo `folds`; a missing id counts as empty text."""
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")) % folds


def _spot(*columns: Column) -> Column:
    return F.pmod(F.xxhash64(*columns), F.lit(MARK_BITS))


def _bit(spot: Column) -> Column:
    return F.call_function("shiftleft", F.lit(1).cast("long"), (spot % 64).cast("int"))


def marks(keys: DataFrame, *columns: Column) -> DataFrame:
    """One bit for each hash of the columns, 64 to a row (word, bits); stored.

    A key that is not among them has its bit set in as great a share of cases as bits are set: 6 % with a
    million keys, 45 % with ten million. Whoever uses the marks compares the keys themselves afterwards.
    """
    spot = _spot(*columns)
    words = keys.select((spot / 64).cast("int").alias("word"), _bit(spot).alias("bit"))
    return stage(words.groupBy("word").agg(F.bit_or("bit").alias("bits")))


def parted(table: DataFrame, marked: DataFrame, *columns: Column) -> tuple[DataFrame, DataFrame]:
    """The rows whose columns may be among the marked ones, and those whose columns are not."""
    word, bits = fresh(table, "word_of_marks"), fresh(table, "bits_of_marks")
    spot = _spot(*columns)
    known = F.broadcast(marked.select(F.col("word").alias(word), F.col("bits").alias(bits)))
    placed = table.withColumn(word, (spot / 64).cast("int")).join(known, word, "left")
    hit = F.coalesce(F.col(bits).bitwiseAND(_bit(spot)) != 0, F.lit(False))
    return placed.where(hit).select(*columns_of(table)), placed.where(~hit).select(*columns_of(table))


def without(table: DataFrame, dropped: DataFrame, key: str) -> DataFrame:
    """The rows whose key is not in `dropped` (one column, that key).

    Which rows may have to go is told to all tasks as marks; of the rows marked only the keys move to be
    compared when they are many, and Spark keeps them in place when `dropped` is small enough to be sent out.
    """
    compared, passed = parted(table, marks(dropped, F.col(key)), F.col(key))
    return passed.unionByName(compared.join(dropped, key, "left_anti").select(*columns_of(table)))


def thinned(key: Column, rows: int, of: Column | int) -> Column:
    """Whether a row may belong to a sample of `rows` by the smallest hashes of its key, out of `of` rows.

    It lets about eight times as many through, so that picking the smallest, which is done by one task,
    does not get a share of every task of a large table.
    """
    span = 1 << 24
    return F.pmod(F.xxhash64(F.lit("sample"), key), F.lit(span)) * of <= F.lit(8 * rows * span)


def fresh(df: DataFrame, name: str) -> str:
    """A column name that `df` does not have."""
    taken = {column.lower() for column in df.columns}
    while name.lower() in taken:
        name += "_"
    return name


def columns_of(df: DataFrame) -> list[Column]:
    """All columns, whatever characters their names have."""
    return [F.col("`" + name.replace("`", "``") + "`") for name in df.columns]


def text_of(column: Column) -> Column:
    """Null counts as empty."""
    return F.coalesce(column, F.lit(""))
