"""Table maintenance: upsert, update, latest record, publishing form."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from tidemark.functions.columns import column, fresh, spelled


def require_unique_key(df: DataFrame, key: str) -> DataFrame:
    """The same rows; the query fails when two of them share a key or one has none."""
    count = fresh(df, "rows")
    unfit = (
        df.groupBy(column(key).alias(key))
        .agg(F.count("*").alias(count))
        .where((F.col(count) > 1) | column(key).isNull())
        .agg(F.count("*"))
        .scalar()
    )
    message = F.lit(f"{key} is missing or given several times")
    return df.where(F.assert_true(unfit == 0, message).isNull())


def fitted(incoming: DataFrame, target: DataFrame) -> DataFrame:
    """`incoming` with its columns spelled as in the target.

    A column that the target lacks would be lost: fail while the query is planned.
    """
    names = {name: spelled(target, name) for name in incoming.columns}
    unknown = [name for name, known in names.items() if known is None]
    if unknown:
        raise ValueError(f"the target has no column {', '.join(unknown)}; it has {', '.join(target.columns)}")
    return incoming.select(*[column(name).alias(known) for name, known in names.items()])


def _overwrite(target: DataFrame, changes: DataFrame, key: str, columns: list[str]) -> DataFrame:
    """`target` with `columns` taken from the row of `changes` with the same key, where there is one.

    A left join: Spark sends out `changes` whole when it is small, so the target stays in place, and
    can otherwise split a hot key of the target.
    """
    given, new = fresh(target, "given_key"), fresh(target, "new_values")
    # Numbered fields: a column's name may have any characters.
    values = F.struct(*[column(name).alias(f"v{place}") for place, name in enumerate(columns)])
    changes = changes.select(column(key).alias(given), values.alias(new))

    def value(name: str) -> Column:
        if name not in columns:
            return column(name)
        taken = F.col(new).getField(f"v{columns.index(name)}").cast(target.schema[name].dataType)
        return F.when(F.col(given).isNotNull(), taken).otherwise(column(name)).alias(name)

    joined = target.join(changes, column(key) == F.col(given), "left")
    return joined.select(*[value(name) for name in target.columns])


def upsert_by_key(target: DataFrame, source: DataFrame, key: str) -> DataFrame:
    """Merge `source`, which has each key once, into `target`.

    Rows with a matching key get the source's other columns and keep the rest; source rows without a
    match are added, with NULL in columns the source does not have. A source column that the target
    does not have is an error; names are matched as the session matches them.

    The additions are found through the target's key column alone. Both joins with the target have it
    on the left, so a small source never makes it move. The two full uses of the source share one
    shuffle, behind which it is computed once; an anti join would be moved before the shuffle and end
    that, hence the mark.
    """
    key = spelled(target, key) or key
    source = fitted(source, target)
    source = require_unique_key(source, key).where(column(key).isNotNull()).repartition(column(key))
    updated = _overwrite(target, source, key, [name for name in source.columns if name != key])
    known, mark = fresh(target, "known_key"), fresh(target, "is_known")
    found = target.select(column(key).alias(known)).join(
        source.select(column(key).alias(mark)), F.col(known) == F.col(mark), "left_semi"
    )
    marked = found.distinct().withColumn(mark, F.lit(True))
    added = source.join(marked, column(key) == F.col(known), "left").where(F.col(mark).isNull())
    rows = added.select(
        *[
            (column(field.name) if field.name in source.columns else F.lit(None)).cast(field.dataType).alias(field.name)
            for field in target.schema
        ]
    )
    return updated.unionByName(rows)


def given_changes(changes: DataFrame, key: str) -> DataFrame:
    """The changes that do something: those with a key and with any value that is not NULL or empty."""
    given = F.lit(False)
    for name in changes.columns:
        if name != key:
            given = given | F.coalesce(column(name).cast("string") != "", F.lit(False))
    return changes.where(given & column(key).isNotNull())


def update_by_key(target: DataFrame, changes: DataFrame, key: str) -> DataFrame:
    """Set the columns of `changes` in the target rows with the same key.

    A change whose values are all missing (NULL or empty) does nothing. Otherwise every value is set,
    a NULL too. Changes for no key, or for one the target does not have, are ignored; a column that
    the target does not have is an error.
    """
    key = spelled(target, key) or key
    changes = given_changes(fitted(changes, target), key)
    columns = [name for name in changes.columns if name != key]
    return _overwrite(target, require_unique_key(changes, key), key, columns)


def latest_record(df: DataFrame, order_col: str, tie_break: str, key: str | None = None) -> DataFrame:
    """The newest row by `order_col`, of the whole table or of each key.

    Rows without a time are the oldest; `tie_break` (larger wins) settles equal times. Either form
    keeps only candidates on the map side: `limit 1`, or one row per key and task before the shuffle.
    """
    newest_first = [F.desc_nulls_last(order_col), F.desc_nulls_last(tie_break)]
    if key is None:
        return df.orderBy(*newest_first).limit(1)
    place = fresh(df, "position")
    position = F.row_number().over(Window.partitionBy(key).orderBy(*newest_first))
    return df.withColumn(place, position).where(F.col(place) == 1).select(*map(column, df.columns))


def export_stringify(df: DataFrame) -> DataFrame:
    """Dates and timestamps as text: `2024-01-05` and `2024-01-05 01:02:03.500000`."""
    patterns = {
        T.DateType: "yyyy-MM-dd",
        T.TimestampType: "yyyy-MM-dd HH:mm:ss.SSSSSS",
        T.TimestampNTZType: "yyyy-MM-dd HH:mm:ss.SSSSSS",
    }
    columns = []
    for field in df.schema:
        pattern = patterns.get(type(field.dataType))
        value = column(field.name)
        columns.append(F.date_format(value, pattern).alias(field.name) if pattern else value)
    return df.select(*columns)
