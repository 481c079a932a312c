"""Tables in hash buckets of a key: a merge reads and rewrites only the buckets that its changes fall into.

The buckets are parts of a versioned table (`sources.versions`), so that a merge is seen as a whole or not at all, and
buckets without changes keep their folders. Number of buckets and key are noted with the table.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.functions.columns import column, fresh, spelled
from tidemark.operators.tables import fitted, given_changes, update_by_key, upsert_by_key
from tidemark.sources import versions
from tidemark.sources.versions import Version

BUCKET = "bucket"


class RepeatedKey(ValueError):
    """Changes have a key several times or not at all; nothing was written to the table."""


def _bucket(key: Column, buckets: int) -> Column:
    return F.pmod(F.xxhash64(key), F.lit(buckets)).cast("int")


def store_buckets(df: DataFrame, folder: str, name: str, key: str, buckets: int) -> Version:
    """Replace a table by one in so many buckets. Rows without a key share a bucket.

    A bucket is the unit of a merge: choose their number so that one is a task's worth of rows.
    """
    if spelled(df, BUCKET):
        raise ValueError(f"{BUCKET} is the column of the store itself")
    spark, key = df.sparkSession, spelled(df, key) or key
    base = versions.latest(spark, folder)
    table = versions.write_table_version(df.withColumn(BUCKET, _bucket(column(key), buckets)), folder, name, BUCKET)
    notes = {**base.notes.get("buckets", {}), name: {"key": key, "buckets": buckets}}
    return versions.commit(spark, base, {name: table}, {"buckets": notes})


def read_buckets(spark: SparkSession, folder: str, name: str, keys: list[object] | None = None) -> DataFrame:
    """The table, or its rows with the given keys, for which only their buckets are read."""
    version = versions.latest(spark, folder)
    table = versions.read_table_version(version, spark, name)
    if keys is None:
        return table.drop(BUCKET)
    layout = version.notes["buckets"][name]
    kind = table.schema[layout["key"]].dataType
    asked = spark.createDataFrame([(key,) for key in keys], f"k {kind.simpleString()}")
    parts = [str(row[0]) for row in asked.select(_bucket(F.col("k"), layout["buckets"])).distinct().collect()]
    return versions.read_table_version(version, spark, name, parts).drop(BUCKET).where(column(layout["key"]).isin(keys))


Merge = Callable[[DataFrame, DataFrame, str], DataFrame]


def _merge(spark: SparkSession, folder: str, name: str, changes: DataFrame, merge: Merge, idle: bool) -> Version:
    """Write the changes by bucket, check their keys, and rewrite the buckets they are in."""
    base = versions.latest(spark, folder)
    layout, stored = base.notes["buckets"][name], base.tables[name]
    key, whole = layout["key"], versions.read_table_version(base, spark, name).drop(BUCKET)
    changes = fitted(changes, whole)
    changes = changes.withColumn(key, column(key).cast(whole.schema[key].dataType))
    if idle:
        changes = given_changes(changes, key)
    staged = versions.write_table_version(
        changes.withColumn(BUCKET, _bucket(column(key), layout["buckets"])), folder, f"{name}-changes", BUCKET
    )
    draft = Version(folder, tables={f"{name}-changes": staged})
    touched = sorted(staged.parts)
    change = versions.read_table_version(draft, spark, f"{name}-changes").drop(BUCKET)
    count = fresh(change, "rows")
    unfit = change.groupBy(column(key)).agg(F.count("*").alias(count)).where((F.col(count) > 1) | column(key).isNull())
    if not unfit.isEmpty():
        raise RepeatedKey(f"{key} is missing or given several times")
    if not touched:
        return base
    before = versions.read_table_version(base, spark, name, touched).drop(BUCKET)
    after = merge(before, change, key).withColumn(BUCKET, _bucket(column(key), layout["buckets"]))
    new = versions.write_table_version(after, folder, name, BUCKET)
    return versions.commit(spark, base, {name: versions.replaced(stored, new, touched)})


def upsert_buckets(spark: SparkSession, folder: str, name: str, source: DataFrame) -> Version:
    """`upsert_by_key` into a stored table; of a table of 1,000 buckets a change of 50 rows rewrites 50 at most."""
    return _merge(spark, folder, name, source, upsert_by_key, idle=False)


def update_buckets(spark: SparkSession, folder: str, name: str, changes: DataFrame) -> Version:
    """`update_by_key` of a stored table. Changes that do nothing touch no bucket."""
    return _merge(spark, folder, name, changes, update_by_key, idle=True)
