"""The summaries table: texts in, facts out, upsert, sent marks, latest record."""

from __future__ import annotations

from datetime import date, datetime

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.operators.reporting import latest_summary
from tidemark.operators.tables import update_by_key, upsert_by_key
from tidemark.operators.text import clean_text, extract_facts
from tidemark.sources.tables import write_mart


def summary_rows(texts: DataFrame, as_of: date, run_ts: datetime) -> DataFrame:
    """(run_id, text) as summary rows of one run time; facts are taken before the text is cleaned."""
    facts = extract_facts(texts.select("run_id", "text"), fields={})
    return clean_text(facts).select(
        "run_id",
        F.lit(run_ts).cast("timestamp_ntz").alias("run_ts"),
        F.lit(as_of).alias("data_end_date"),
        "text",
        "facts_json",
    )


def refresh_summaries(summaries: DataFrame, texts: DataFrame, as_of: date, run_ts: datetime) -> DataFrame:
    """Merge new texts; `run_ts` is set on new and on changed rows, so the refreshed run is the latest."""
    return upsert_by_key(summaries, summary_rows(texts, as_of, run_ts), "run_id")


def mark_sent(summaries: DataFrame, sent: DataFrame) -> DataFrame:
    """Set the message ids (run_id, sent_slack_ts, sent_email_id) of summaries that were sent."""
    return update_by_key(summaries, sent, "run_id")


def sync_latest(summaries: DataFrame, folder: str, run_id: str | None = None) -> None:
    """Replace the readers' summaries table with the newest summary, optionally of one run.

    Without such a summary nothing is written and the readers keep what they have.
    """
    if run_id is not None:
        summaries = summaries.where(F.col("run_id") == run_id)
    latest = latest_summary(summaries)
    if latest.isEmpty():
        raise ValueError("there is no summary" + (f" of run {run_id}" if run_id is not None else ""))
    write_mart(latest, folder, "summaries")
