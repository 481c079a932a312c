"""Data-quality checks and profiles."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.functions.text import plain_decimal

# The columns that must never be NULL.
REQUIRED_COLUMNS = {"mau": ["month", "mau"], "users_by_country": ["country"]}


def _union(parts: list[DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, parts)


def table_row_counts(tables: dict[str, DataFrame]) -> DataFrame:
    return _union(
        [
            df.agg(F.count("*").alias("rows")).select(F.lit(name).alias("table_name"), "rows")
            for name, df in tables.items()
        ]
    )


def dq_not_null(
    tables: dict[str, DataFrame], required: dict[str, list[str]] = REQUIRED_COLUMNS
) -> DataFrame:
    """NULLs per required column, one pass per table."""
    checks = []
    for name, columns in required.items():
        nulls = tables[name].agg(*[F.count_if(F.col(column).isNull()).alias(column) for column in columns])
        cells = ", ".join(f"'{column}', `{column}`" for column in columns)
        checks.append(
            nulls.selectExpr(
                f"'{name}' AS table_name", f"stack({len(columns)}, {cells}) AS (column_name, failures)"
            )
        )
    return _union(checks)


def _long_form(profile: DataFrame, mart: str) -> DataFrame:
    """The columns of a profile as rows (mart, metric, value), values as text."""
    texts = profile.select(
        *[
            (plain_decimal(F.col(field.name)) if isinstance(field.dataType, T.DoubleType) else F.col(field.name))
            .cast("string")
            .alias(field.name)
            for field in profile.schema
        ]
    )
    cells = ", ".join(f"'{column}', `{column}`" for column in texts.columns)
    return texts.selectExpr(f"'{mart}' AS mart", f"stack({len(texts.columns)}, {cells}) AS (metric, value)")


def dq_mart_profile(marts: dict[str, DataFrame]) -> DataFrame:
    """Key figures of the result tables, one row per figure; each table is read once."""
    mau = marts["mau"].agg(
        F.count("*").alias("months"),
        F.min("month").alias("first_month"),
        F.max("month").alias("last_month"),
        F.max("mau").alias("peak_mau"),
    )
    retention = marts["retention"].agg(
        F.count_distinct("cohort_month").alias("cohorts"),
        F.min("retention_rate").alias("min_rate"),
        F.max("retention_rate").alias("max_rate"),
    )
    countries = marts["users_by_country"].agg(
        F.count("*").alias("countries"),
        F.sum("users").alias("total_users"),
        F.max("users").alias("largest_country"),
    )
    # The rollup gives the listing and the totals together.
    platforms = (
        marts["platform_share"]
        .rollup("platform")
        .agg(F.grouping("platform").alias("total"), F.count("*").alias("n"), F.sum("users").alias("users"),
             plain_decimal(F.max("share")).alias("share"))
        .selectExpr(
            "'platform_share' AS mart",
            "stack(2,"
            " if(total = 1, 'platforms', concat('users ', platform)), CAST(if(total = 1, n, users) AS STRING),"
            " if(total = 1, 'total_users', concat('share ', platform)),"
            " if(total = 1, CAST(users AS STRING), share)) AS (metric, value)",
        )
    )
    end_date = marts["data_end_date"].select("data_end_date")
    return _union(
        [
            _long_form(mau, "mau"),
            _long_form(retention, "retention"),
            _long_form(countries, "users_by_country"),
            platforms,
            _long_form(end_date, "data_end_date"),
        ]
    )


#: Prefixes of the measures that count NULLs, and of those that are key figures.
NULLS, FIGURE = "nulls of ", "figure "


def _figures(name: str) -> dict[str, Column]:
    """The figures of `dq_mart_profile`, each as one aggregate."""
    share = F.struct("platform", "users", plain_decimal(F.col("share")).alias("share"))
    figures = {
        "mau": lambda: {
            "months": F.count("*"), "first_month": F.min("month"), "last_month": F.max("month"), "peak_mau": F.max("mau")
        },
        "retention": lambda: {
            "cohorts": F.size(F.collect_set("cohort_month")),
            "min_rate": plain_decimal(F.min("retention_rate")),
            "max_rate": plain_decimal(F.max("retention_rate")),
        },
        "users_by_country": lambda: {
            "countries": F.count("*"), "total_users": F.sum("users"), "largest_country": F.max("users")
        },
        # A row for each of the few platforms.
        "platform_share": lambda: {"platforms": F.count("*"), "total_users": F.sum("users"), "shares": F.collect_list(share)},
        "data_end_date": lambda: {"data_end_date": F.max("data_end_date")},
    }
    return figures.get(name, dict)()


def measures(name: str, required: list[str]) -> list[Column]:
    """What is to be observed while a table is written: rows, NULLs of required columns, key figures."""
    nulls = [F.count_if(F.col(column).isNull()).alias(f"{NULLS}{column}") for column in required]
    figures = [column.alias(f"{FIGURE}{figure}") for figure, column in _figures(name).items()]
    return [F.count("*").alias("rows"), *nulls, *figures]


def observed_profile(spark: SparkSession, observed: dict[str, dict[str, object]]) -> DataFrame:
    """The rows of `dq_mart_profile` from what was observed while the tables were written."""
    rows = []
    for mart, values in observed.items():
        for measure, value in values.items():
            if not measure.startswith(FIGURE):
                continue
            if measure == f"{FIGURE}shares":
                for platform, users, share in value:
                    rows += [(mart, f"users {platform}", str(users)), (mart, f"share {platform}", share)]
            else:
                rows.append((mart, measure.removeprefix(FIGURE), None if value is None else str(value)))
    return spark.createDataFrame(rows, "mart string, metric string, value string")
