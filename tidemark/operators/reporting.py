"""Result tables as ordered views, JSON rows and headline figures."""

from __future__ import annotations

from datetime import date
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from tidemark.functions.columns import fresh
from tidemark.functions.text import plain_decimal
from tidemark.operators.events import mau_recent
from tidemark.operators.tables import latest_record

# The columns and the order each result table is read in.
VIEWS = {
    "mau": (["month", "mau"], ["month"]),
    "retention": (
        ["cohort_month", "cohort_label", "age_month", "retention_rate"],
        ["cohort_month", "age_month"],
    ),
    "users_by_country": (["country", "users"], ["-users", "country"]),
    "country_increases": (
        ["country", "increase_number", "increase_percentage"],
        ["-increase_percentage", "country"],
    ),
    "country_decreases": (
        ["country", "decrease_number", "decrease_percentage"],
        ["-decrease_percentage", "country"],
    ),
    "country_trends": (
        ["country", "current_users", "previous_users", "pct_change", "trend_type"],
        ["-pct_change", "country"],
    ),
    "platform_share": (["platform", "users", "share"], ["-users", "platform"]),
    "funnel": (["step", "step_name", "sessions", "percentage"], ["step"]),
    "kpi_metrics": (["last_updated_date", "mau_30_days", "purchase_conversion_rate"], []),
    "data_end_date": (["data_end_date"], []),
}


def _order(keys: list[str]) -> list[Column]:
    return [F.desc_nulls_last(key[1:]) if key.startswith("-") else F.asc_nulls_last(key) for key in keys]


def read_view(marts: dict[str, DataFrame], name: str) -> DataFrame:
    """A result table with its columns and rows in the order readers expect."""
    columns, order = VIEWS[name]
    keys = _order(order)
    view = marts[name].select(*columns)
    return view.orderBy(*keys) if keys else view


def latest_summary(summaries: DataFrame) -> DataFrame:
    """The newest summary, of the table itself or of its published form with times as text."""
    if isinstance(summaries.schema["run_ts"].dataType, T.StringType):
        time = fresh(summaries, "run_time")
        timed = summaries.withColumn(time, F.col("run_ts").cast("timestamp_ntz"))
        return latest_record(timed, time, tie_break="run_id").drop(time)
    return latest_record(summaries, "run_ts", tie_break="run_id")


def _json_cell(field: T.StructField) -> Column:
    """A column as `"name":value`; dates become ISO text, fractions plain decimals, NULLs stay."""
    column = F.col(field.name)
    if isinstance(field.dataType, (T.DoubleType, T.FloatType)):
        return F.concat(F.lit(f'"{field.name}":'), F.coalesce(plain_decimal(column), F.lit("null")))
    if isinstance(field.dataType, T.DateType):
        column = F.date_format(column, "yyyy-MM-dd")
    elif isinstance(field.dataType, (T.TimestampType, T.TimestampNTZType)):
        column = F.date_format(column, "yyyy-MM-dd'T'HH:mm:ss.SSSSSS")
    row = F.to_json(F.struct(column.alias(field.name)), {"ignoreNullFields": "false"})
    return F.substr(row, F.lit(2), F.length(row) - 2)


def _json_rows(section: str, df: DataFrame, order: list[Column]) -> DataFrame:
    """Each row as one JSON object with its place in the section, counted from 1."""
    cells = F.concat_ws(",", *[_json_cell(field) for field in df.schema])
    # A section is a small result table: its numbering may take one task.
    position = F.row_number().over(Window.orderBy(*order)) if order else F.lit(1)
    return df.select(
        F.lit(section).alias("section"),
        position.cast("int").alias("position"),
        F.concat(F.lit("{"), cells, F.lit("}")).alias("row_json"),
    )


# The order of the rows inside each section.
SECTION_ORDER = {
    "mau": ["-month"],
    "retention": ["cohort_month", "age_month"],
    "platform": ["-users", "platform"],
    "funnel": ["step"],
}


def _sections(sections: dict[str, DataFrame]) -> DataFrame:
    parts = [_json_rows(name, df, _order(SECTION_ORDER.get(name, []))) for name, df in sections.items()]
    if not parts:
        return SparkSession.active().createDataFrame([], "section string, position int, row_json string")
    return reduce(DataFrame.unionByName, parts)


def mart_rows_json(marts: dict[str, DataFrame], as_of: date) -> DataFrame:
    """The summary payload, one line per row of each section; its end date is the `as_of` day."""
    end_date = marts["data_end_date"].select(F.lit(as_of).alias("data_end_date"))
    return _sections(
        {
            "mau": mau_recent(marts["mau"], 18),
            "retention": marts["retention"],
            "platform": marts["platform_share"],
            "funnel": marts["funnel"].select("step", "step_name", "sessions"),
            "kpi_metrics": marts["kpi_metrics"],
            "data_end_date": end_date,
        }
    )


def chat_rows_json(marts: dict[str, DataFrame], summaries: DataFrame | None = None) -> DataFrame:
    """The chat payload: six months, the real end date and the latest summary.

    A section whose table is not there has no rows.
    """
    sections = {
        "mau": lambda: mau_recent(marts["mau"], 6),
        "retention": lambda: marts["retention"],
        "platform": lambda: marts["platform_share"],
        "funnel": lambda: marts["funnel"].select("step", "step_name", "sessions"),
        "kpi_metrics": lambda: marts["kpi_metrics"],
        "data_end_date": lambda: marts["data_end_date"],
    }
    source = {"platform": "platform_share"}
    present = {
        name: build() for name, build in sections.items() if source.get(name, name) in marts
    }
    if summaries is not None:
        present["latest_summary"] = latest_summary(summaries).select("text", "facts_json")
    return _sections(present)


def headline_facts(
    mau: DataFrame, platform_share: DataFrame, kpi_metrics: DataFrame, retention: DataFrame
) -> DataFrame:
    """One row of headline figures.

    Retention is that of the newest cohort at its greatest age. The growth trend compares the last
    month-on-month change with the one before: greater is `accelerating`, equal `stable`, less
    `declining`. Without three calendar months in a row it is NULL: a month without events has no row,
    and a change over a gap is none from month to month.
    """
    by_month = Window.orderBy("month")
    follows = F.add_months(F.lag("month").over(by_month), 1) == F.col("month")
    change = F.when(follows, F.col("mau") - F.lag("mau").over(by_month))
    recent = mau_recent(mau, 3).withColumn("change", change)
    recent = recent.withColumn("step", F.col("change") - F.lag("change").over(by_month))
    current = recent.agg(F.max_by(F.struct("mau", "step"), "month")).scalar()
    top = (
        platform_share.orderBy(F.desc("users"), "platform")
        .limit(1)
        .select(F.struct("platform", "share"))
        .scalar()
    )
    newest = retention.agg(F.max_by("retention_rate", F.struct("cohort_month", "age_month"))).scalar()
    step = current.getField("step")
    trend = F.when(step > 0, "accelerating").when(step == 0, "stable").when(step < 0, "declining")
    return kpi_metrics.select(
        current.getField("mau").alias("current_mau"),
        top.getField("platform").alias("dominant_platform"),
        top.getField("share").alias("platform_share"),
        F.col("purchase_conversion_rate").alias("conversion_rate"),
        newest.alias("retention_rate"),
        trend.alias("growth_trend"),
    )
