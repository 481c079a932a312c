"""Registered queries: each operator on the stored tables, with the inputs of FIXTURES.md section 4."""

from __future__ import annotations

from collections.abc import Callable
from datetime import date, datetime
from functools import cached_property

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.operators import events as ev
from tidemark.operators import funnels, quality, reporting, tables, text, user_sets, users
from tidemark.plans import summaries
from tidemark.schemas import SUMMARIES, conform
from tidemark.session import configure
from tidemark.sources import bindings as b

Query = Callable[[SparkSession, str], DataFrame]

WEB_DAY = date(2024, 2, 15)
KPI_DAY = date(2024, 1, 31)
SIGNUP_DAY = date(2024, 2, 28)
ORDERS_DAY = date(2001, 8, 15)
COHORT_DAY = date(1995, 10, 15)
CUSTOMERS_DAY = date(2001, 12, 31)
SHIP_DAY = date(1998, 6, 30)
SUMMARY_START = datetime(2024, 1, 1)
REFRESH_TIME = datetime(2030, 1, 1)


class Inputs:
    """The logical tables of one folder, each bound once however many queries use it."""

    def __init__(self, spark: SparkSession, folder: str):
        self._at = (spark, folder)

    @cached_property
    def web(self) -> DataFrame:
        return b.load_events(*self._at, b.events_web)

    @cached_property
    def orders(self) -> DataFrame:
        return b.load_events(*self._at, b.events_orders)

    @cached_property
    def customers(self) -> DataFrame:
        return b.load_users(*self._at, b.users_cust)

    @cached_property
    def shipments(self) -> DataFrame:
        return b.load_users(*self._at, b.users_ship)

    @cached_property
    def signups(self) -> DataFrame:
        return b.load_users(*self._at, lambda spark, folder: b.users_signup(spark, folder, SIGNUP_DAY))


# The result tables, each on the tables and day of its own key.
MART_QUERIES: dict[str, Callable[[Inputs], DataFrame]] = {
    "mau": lambda t: ev.mau_monthly(t.orders, ORDERS_DAY),
    "retention": lambda t: users.retention_cohorts(t.customers, t.orders, COHORT_DAY),
    "users_by_country": lambda t: users.users_by_country(t.customers, CUSTOMERS_DAY, b.NATION_NAMES),
    "platform_share": lambda t: ev.platform_share(t.web, WEB_DAY),
    "funnel": lambda t: funnels.session_funnel(t.web, WEB_DAY),
    "data_end_date": lambda t: ev.data_end_date(t.web, WEB_DAY),
    "country_trends": lambda t: users.country_trends(t.shipments, SHIP_DAY, names=b.NATION_NAMES),
    "country_increases": lambda t: users.country_increases(t.shipments, SHIP_DAY, names=b.NATION_NAMES),
    "country_decreases": lambda t: users.country_decreases(t.shipments, SHIP_DAY, names=b.NATION_NAMES),
    "kpi_metrics": lambda t: ev.kpi_metrics(t.web, KPI_DAY),
}


def marts(spark: SparkSession, folder: str, names: list[str] | None = None) -> dict[str, DataFrame]:
    tables = Inputs(spark, folder)
    return {name: MART_QUERIES[name](tables) for name in names or MART_QUERIES}


def _mart(name: str) -> Query:
    return lambda spark, folder: MART_QUERIES[name](Inputs(spark, folder))


def _on(operator: Callable[[Inputs], DataFrame]) -> Query:
    return lambda spark, folder: operator(Inputs(spark, folder))


def texts_with_tails(spark: SparkSession, folder: str) -> DataFrame:
    """Every document with a fact section behind it: some broken, some after a fenced block, some
    after a line break that was written out as a backslash and an n. The records have decimals, text,
    nested values, fields out of order, missing ones, and some repeat a field."""
    doc = F.col("doc_id")
    line_break = F.when(doc % 4 == 0, F.lit("\\n\\nnext\\nline")).otherwise("")
    fence = F.when(doc % 5 == 0, F.lit('\n```json\n{"a": 1}\n```\n')).otherwise("")
    again = F.when(doc % 11 == 0, F.lit('"current_mau": -1, ')).otherwise("")
    whole = F.format_string(
        '{"retention_rate": 0.%d5, %s"extra": {"list": [1.0, null, "}"]}, "current_mau": %d,'
        ' "platform_share": "12.%d%%", "dominant_platform": "i\\"OS"}',
        doc % 89 + 1, again, F.col("n_chars"), doc % 10,
    )
    facts = F.when(doc % 7 == 0, F.format_string('{"current_mau": %d, "retention_rate": ,}', doc)).otherwise(whole)
    return b.stored(spark, folder, "documents").select(
        "doc_id", F.concat("text", line_break, fence, F.lit("\n\nfacts_json:\n"), facts).alias("text")
    )


def document_summaries(spark: SparkSession, folder: str) -> DataFrame:
    """A summaries table with one run per document, a minute apart."""
    empty = F.lit(None).cast("string")
    run_ts = F.timestamp_add("MINUTE", F.col("doc_id"), F.lit(SUMMARY_START).cast("timestamp_ntz"))
    return conform(
        b.stored(spark, folder, "documents").select(
            F.col("doc_id").cast("string").alias("run_id"),
            run_ts.alias("run_ts"),
            F.to_date(run_ts).alias("data_end_date"),
            "text",
            F.format_string('{"n":%d}', F.col("n_chars")).alias("facts_json"),
            empty.alias("sent_slack_ts"),
            empty.alias("sent_email_id"),
        ),
        SUMMARIES,
    )


def upsert_by_key(spark: SparkSession, folder: str) -> DataFrame:
    """All documents, merged with a changed copy of all of them under twice their id: half the ids
    match, half are new, and half of the old rows stay as they are."""
    documents = b.stored(spark, folder, "documents")
    changed = documents.select(
        (F.col("doc_id") * 2).alias("doc_id"),
        F.concat(F.lit("changed: "), "text").alias("text"),
        (F.col("n_chars") + 9).alias("n_chars"),
    )
    return tables.upsert_by_key(documents, changed, "doc_id")


def update_by_key(spark: SparkSession, folder: str) -> DataFrame:
    """Documents, updated from their labels; a label row with neither mark changes nothing."""
    changes = b.stored(spark, folder, "labels").select(
        "doc_id",
        F.when(F.col("quality") == 1, "good").alias("source"),
        F.when(F.col("toxic") == 1, "unsafe").alias("lang"),
    )
    return tables.update_by_key(b.stored(spark, folder, "documents"), changes, "doc_id")


def refresh_summaries(spark: SparkSession, folder: str) -> DataFrame:
    """The document summaries, merged with new texts under twice their id."""
    texts = texts_with_tails(spark, folder).select(
        (F.col("doc_id") * 2).cast("string").alias("run_id"), "text"
    )
    return summaries.refresh_summaries(document_summaries(spark, folder), texts, WEB_DAY, REFRESH_TIME)


def facts_by_path(spark: SparkSession, folder: str) -> DataFrame:
    """`extract_facts` of the same texts by way of a VARIANT column."""
    stored = text.facts_variant(text.extract_facts(texts_with_tails(spark, folder), fields={}).drop("text"))
    return text.facts_by_path(stored).drop("facts")


def headline_facts(spark: SparkSession, folder: str) -> DataFrame:
    return reporting.headline_facts(
        *marts(spark, folder, ["mau", "platform_share", "kpi_metrics", "retention"]).values()
    )


# The same figures from sets of users, as an incremental refresh keeps them by day.
def retention_from_sets(tables: Inputs) -> DataFrame:
    signed, seen = user_sets.signup_sets(tables.customers), user_sets.user_sets(tables.orders)
    return user_sets.retention_cohorts(signed, seen, COHORT_DAY)


QUERIES: dict[str, Query] = {
    "data_end_date": _mart("data_end_date"),
    "mau_monthly": _mart("mau"),
    "mau_recent": _on(lambda t: ev.mau_recent(ev.mau_monthly(t.orders, ORDERS_DAY), 18)),
    "active_users_trailing": _on(lambda t: ev.active_users_trailing(t.web, KPI_DAY)),
    "session_conversion_trailing": _on(lambda t: ev.session_conversion_trailing(t.web, KPI_DAY)),
    "kpi_metrics": _mart("kpi_metrics"),
    "retention_cohorts": _mart("retention"),
    "platform_share": _mart("platform_share"),
    "users_by_country": _mart("users_by_country"),
    "country_trends": _mart("country_trends"),
    "country_increases": _mart("country_increases"),
    "country_decreases": _mart("country_decreases"),
    "session_funnel": _mart("funnel"),
    "funnel_pct_of_first": _on(lambda t: funnels.funnel_pct_of_first(funnels.session_funnel(t.web, WEB_DAY))),
    "funnel_step_conversion": _on(
        lambda t: funnels.funnel_step_conversion(funnels.session_funnel(t.web, WEB_DAY))
    ),
    "registration_funnel_unordered": _on(
        lambda t: funnels.registration_funnel_unordered(t.signups, t.web, SIGNUP_DAY)
    ),
    "first_event_pivot": _on(lambda t: funnels.first_event_pivot(t.signups, t.web, SIGNUP_DAY)),
    "registration_funnel_ordered": _on(
        lambda t: funnels.registration_funnel_ordered(t.signups, t.web, SIGNUP_DAY)
    ),
    "export_stringify": lambda spark, folder: tables.export_stringify(b.stored(spark, folder, "events")),
    "export_stringify_orders": lambda spark, folder: tables.export_stringify(
        b.stored(spark, folder, "orders")
    ),
    "upsert_by_key": upsert_by_key,
    "update_by_key": update_by_key,
    "latest_record": lambda spark, folder: tables.latest_record(
        b.stored(spark, folder, "conversations"), "turn", tie_break="role", key="conv_id"
    ),
    "latest_summary": lambda spark, folder: reporting.latest_summary(document_summaries(spark, folder)),
    "refresh_summaries": refresh_summaries,
    "extract_facts": lambda spark, folder: text.extract_facts(texts_with_tails(spark, folder)).drop("text"),
    "facts_by_path": facts_by_path,
    "clean_text": lambda spark, folder: text.clean_text(texts_with_tails(spark, folder)),
    "mart_rows_json": lambda spark, folder: reporting.mart_rows_json(marts(spark, folder), WEB_DAY),
    "chat_rows_json": lambda spark, folder: reporting.chat_rows_json(
        marts(spark, folder), document_summaries(spark, folder)
    ),
    "table_row_counts": lambda spark, folder: quality.table_row_counts(marts(spark, folder)),
    "dq_not_null": lambda spark, folder: quality.dq_not_null(
        marts(spark, folder, list(quality.REQUIRED_COLUMNS))
    ),
    "dq_mart_profile": lambda spark, folder: quality.dq_mart_profile(marts(spark, folder)),
    "headline_facts": headline_facts,
    "mau_monthly_from_sets": _on(lambda t: user_sets.mau_monthly(user_sets.user_sets(t.orders), ORDERS_DAY)),
    "active_users_from_sets": _on(lambda t: user_sets.active_users_trailing(user_sets.user_sets(t.web), KPI_DAY)),
    "retention_from_sets": _on(retention_from_sets),
}


def _configured(query: Query) -> Query:
    return lambda spark, folder: query(configure(spark), folder)


def registered() -> dict[str, Query]:
    return {name: _configured(query) for name, query in QUERIES.items()}
