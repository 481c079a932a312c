"""Days, months and windows of days.

Bounds are worked out once from `as_of` and compared with a bare column as half-open ranges, so that
they reach the scan; wrapping the column in `trunc` would stop that.

Tables stored by day (`sources.tables.store_by_day`) carry `created_day`. Where a metric only needs the
day it is taken from there: whole folders are skipped and the timestamps themselves are not read. For
other tables the bounds go to the timestamp; note that the parquet reader then skips row groups only
for zoned microsecond timestamps, not for zone-free or INT96 ones.
"""

from __future__ import annotations

from datetime import date, timedelta

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

DAY_COLUMN = "created_day"


def days_before(as_of: date, days: int) -> date:
    return as_of - timedelta(days=days)


def first_of_month(day: date, shift: int = 0) -> date:
    """First day of the month `shift` months away from the month of `day`."""
    months = day.year * 12 + day.month - 1 + shift
    return date(months // 12, months % 12 + 1, 1)


def _stored_by_day(df: DataFrame) -> bool:
    return DAY_COLUMN in df.columns


def day_of(df: DataFrame) -> Column:
    """The day of each row."""
    return F.col(DAY_COLUMN) if _stored_by_day(df) else F.to_date("created_at")


def month_of(df: DataFrame) -> Column:
    """The first day of the month of each row."""
    return F.trunc(day_of(df), "MM")


def months_apart(later: Column, earlier: Column) -> Column:
    """Number of month boundaries between two dates (31 January to 1 February is 1)."""
    return (F.year(later) - F.year(earlier)) * 12 + F.month(later) - F.month(earlier)


def cut_days(
    df: DataFrame,
    start: date | None = None,
    end: date | None = None,
    ts_col: str = "created_at",
    undated: bool = False,
) -> DataFrame:
    """Rows with `start <= day < end`; a bound may be left out. `undated` keeps rows without a time too."""
    time = F.col(DAY_COLUMN if _stored_by_day(df) else ts_col)
    bounds = [time >= F.lit(start)] if start is not None else []
    bounds += [time < F.lit(end)] if end is not None else []
    for bound in bounds:
        df = df.where(bound | time.isNull() if undated else bound)
    return df


def cut_since(df: DataFrame, start: DataFrame) -> DataFrame:
    """Rows on or after the date in the one cell of `start`, known only when the query runs.

    The bound gets the type of the column it is compared with; a cast around it would keep it from
    the scan.
    """
    time = DAY_COLUMN if _stored_by_day(df) else "created_at"
    bound = start.select(F.col(start.columns[0]).cast(df.schema[time].dataType)).scalar()
    return df.where(F.col(time) >= bound)
