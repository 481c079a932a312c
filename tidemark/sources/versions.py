"""Tables of a folder in versions: written beside each other, switched by one file that is written last.

    data/<table>/<part column>=<part>/version=<id>/*.parquet     never changed once written
    versions/00000012.json                                       the folders of each table, and notes

Readers take the newest version file and the folders it names; until that file is there, nothing that a
job has written can be seen, and a job that dies leaves folders that no version names. A part that did not
change keeps its folder from version to version, so that one day or bucket can be replaced by
writing it alone. A writer starts from a version and fails when another one has been added since.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Iterable
from dataclasses import dataclass, field
from typing import Any

from py4j.protocol import Py4JJavaError
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: Column that tells apart the folders of one part; its only part, for a table without part column.
VERSION_COLUMN, WHOLE = "version", ""


class StaleVersion(RuntimeError):
    """Another version has been added since the one that a change starts from."""


@dataclass(frozen=True)
class Table:
    """Where a table's parts are: folders under `data/<table>`, by part."""

    schema: str
    parts: dict[str, str]
    part_column: str | None = None


@dataclass(frozen=True)
class Version:
    """The tables of a folder at one time, and what jobs noted about them."""

    folder: str
    number: int = 0
    tables: dict[str, Table] = field(default_factory=dict)
    notes: dict[str, Any] = field(default_factory=dict)


def _path(spark: SparkSession, name: str):
    """A path and its file system; Spark's own readers and writers use the same."""
    path = spark._jvm.org.apache.hadoop.fs.Path(name)
    return path, path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())


def _list(spark: SparkSession, pattern: str) -> list[str]:
    """The paths that a pattern matches."""
    path, files = _path(spark, pattern)
    return sorted(status.getPath().toString() for status in files.globStatus(path) or [])


def _numbers(spark: SparkSession, folder: str) -> list[int]:
    names = [path.rsplit("/", 1)[1] for path in _list(spark, f"{folder}/versions/*.json")]
    return sorted(int(name.removesuffix(".json")) for name in names)


def _file(folder: str, number: int) -> str:
    return f"{folder}/versions/{number:08d}.json"


def latest(spark: SparkSession, folder: str) -> Version:
    """The newest version; one without tables, numbered 0, if there is none."""
    numbers = _numbers(spark, folder)
    return _read_version(spark, folder, numbers[-1]) if numbers else Version(folder)


def _read_version(spark: SparkSession, folder: str, number: int) -> Version:
    path, files = _path(spark, _file(folder, number))
    stream = files.open(path)
    try:
        found = json.loads(spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8"))
    finally:
        stream.close()
    tables = {name: Table(**table) for name, table in found["tables"].items()}
    return Version(folder, number, tables, found["notes"])


def read_table_version(version: Version, spark: SparkSession, name: str, parts: Iterable[str] | None = None) -> DataFrame:
    """A table of a version, or some of its parts; parts it does not have are left out.

    Filters on the part column skip folders, as for any partitioned table.
    """
    if name not in version.tables:
        raise ValueError(f"there is no table {name} in {version.folder}; it has {', '.join(sorted(version.tables)) or 'none'}")
    table = version.tables[name]
    schema = T.StructType.fromJson(json.loads(table.schema))
    wanted = table.parts if parts is None else {part: table.parts[part] for part in parts if part in table.parts}
    if not wanted:
        return spark.createDataFrame([], schema)
    base = f"{version.folder}/data/{name}"
    stored = T.StructType([*schema.fields, T.StructField(VERSION_COLUMN, T.StringType())])
    paths = [f"{base}/{where}" for where in wanted.values()]
    return spark.read.schema(stored).option("basePath", base).parquet(*paths).select(*_names(schema))


def _names(schema: T.StructType) -> list[str]:
    return ["`" + name.replace("`", "``") + "`" for name in schema.names]


def write_table_version(df: DataFrame, folder: str, name: str, part_column: str | None = None) -> Table:
    """Write a table, or the parts that the rows of `df` have, where no version names them yet.

    A rebalance gathers the rows of a part in files of a sensible size and splits a part too big for one task.
    """
    spark = df.sparkSession
    if VERSION_COLUMN in df.columns:
        raise ValueError(f"{VERSION_COLUMN} is the column of the store itself")
    unique = uuid.uuid4().hex
    columns = [VERSION_COLUMN] if part_column is None else [part_column, VERSION_COLUMN]
    dealt = df if part_column is None else df.hint("rebalance", part_column)
    base = f"{folder}/data/{name}"
    dealt.withColumn(VERSION_COLUMN, F.lit(unique)).write.mode("append").partitionBy(*columns).parquet(base)
    # Partition columns come last when a table is read.
    fields = [f for f in df.schema if f.name != part_column] + [f for f in df.schema if f.name == part_column]
    schema = T.StructType([T.StructField(f.name, f.dataType) for f in fields]).json()
    leaf = f"{VERSION_COLUMN}={unique}"
    if part_column is None:
        found = _list(spark, f"{base}/{leaf}")
        return Table(schema, {WHOLE: leaf} if found else {})
    found = [path.rsplit("/", 2)[1] for path in _list(spark, f"{base}/{part_column}=*/{leaf}")]
    return Table(schema, {path.split("=", 1)[1]: f"{path}/{leaf}" for path in found}, part_column)


def replaced(table: Table | None, new: Table, gone: Iterable[str] = ()) -> Table:
    """A table with the parts of `new` in place of its own, and without the parts `gone`."""
    kept = {} if table is None else {part: where for part, where in table.parts.items() if part not in set(gone)}
    return Table(new.schema, {**kept, **new.parts}, new.part_column)


def commit(spark: SparkSession, base: Version, tables: dict[str, Table], notes: dict[str, Any] | None = None) -> Version:
    """The version after `base`, with some tables and notes replaced: all of them can be seen now, or none."""
    made = Version(base.folder, base.number + 1, {**base.tables, **tables}, {**base.notes, **(notes or {})})
    content = {
        "tables": {name: {"schema": t.schema, "parts": t.parts, "part_column": t.part_column} for name, t in made.tables.items()},
        "notes": made.notes,
    }
    target, files = _path(spark, _file(base.folder, made.number))
    draft, _ = _path(spark, f"{base.folder}/versions/draft-{uuid.uuid4().hex}")
    stream = files.create(draft, False)
    try:
        stream.write(bytearray(json.dumps(content).encode()))
    finally:
        stream.close()
    if _numbers(spark, base.folder)[-1:] not in ([], [base.number]):
        files.delete(draft, False)
        raise StaleVersion(f"{base.folder} has a newer version than {base.number}")
    # Moving fails when the name is taken: of two writers one wins.
    kinds = spark.sparkContext._gateway.new_array(spark._jvm.org.apache.hadoop.fs.Options.Rename, 1)
    kinds[0] = spark._jvm.org.apache.hadoop.fs.Options.Rename.NONE
    context = spark._jvm.org.apache.hadoop.fs.FileContext.getFileContext(files.getUri(), files.getConf())
    try:
        context.rename(draft, target, kinds)
    except Py4JJavaError as error:
        files.delete(draft, False)
        if "FileAlreadyExistsException" in str(error.java_exception):
            raise StaleVersion(f"{base.folder} has a newer version than {base.number}") from error
        raise
    return made


def write_tables(spark: SparkSession, folder: str, tables: dict[str, DataFrame]) -> Version:
    """Replace whole tables of a folder, all of them at once; its other tables stay."""
    base = latest(spark, folder)
    return commit(spark, base, {name: write_table_version(df, folder, name) for name, df in tables.items()})


def forget(spark: SparkSession, folder: str, keep: int = 2) -> int:
    """Delete all but the newest versions and every folder that none of these names; how many folders went.

    Not to be run while a job writes to the folder, as its folders have no version yet, nor while readers
    of an older version are at work.
    """
    numbers = _numbers(spark, folder)
    kept = [_read_version(spark, folder, number) for number in numbers[-keep:]]
    named = {f"{name}/{where}" for v in kept for name, table in v.tables.items() for where in table.parts.values()}
    for number in numbers[:-keep]:
        path, files = _path(spark, _file(folder, number))
        files.delete(path, False)
    gone = 0
    for path in [*_list(spark, f"{folder}/data/*/{VERSION_COLUMN}=*"), *_list(spark, f"{folder}/data/*/*/{VERSION_COLUMN}=*")]:
        if not any(path.endswith(f"/data/{name}") for name in named):
            place, files = _path(spark, path)
            gone += files.delete(place, True)
    return gone
