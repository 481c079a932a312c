"""Column names that cannot clash, and names matched as the session matches them."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def fresh(df: DataFrame, name: str) -> str:
    """A column name that `df` does not have in any spelling."""
    taken = {column.lower() for column in df.columns}
    while name.lower() in taken:
        name += "_"
    return name


def quoted(name: str) -> str:
    return "`" + name.replace("`", "``") + "`"


def column(name: str) -> Column:
    """A column by its name, whatever characters it has."""
    return F.col(quoted(name))


def spelled(df: DataFrame, name: str) -> str | None:
    """The name under which `df` has a column that the session takes `name` for, if any."""
    if name in df.columns:
        return name
    if df.sparkSession.conf.get("spark.sql.caseSensitive") == "true":
        return None
    return next((known for known in df.columns if known.lower() == name.lower()), None)
