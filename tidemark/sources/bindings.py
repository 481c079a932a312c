"""Logical `users` and `events` tables over stored ones (FIXTURES.md section 3)."""

from __future__ import annotations

from collections.abc import Callable
from datetime import date

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.schemas import EVENTS, USERS, conform
from tidemark.sources.tables import as_of_snapshot, read_table

# Stored event types and browsers, and the names they are read as.
EVENT_TYPES = {
    "view": "product",
    "click": "cart",
    "purchase": "purchase",
    "signup": "home",
    "error": "department",
}
BROWSERS = ["Chrome", "Safari", "Firefox", "IE", "Other"]

# Stand-in for the country spellings, so that groups really merge.
NATION_NAMES = {"NATION_5": "NATION_0", "NATION_7": "NATION_2"}


# Schemas of the stored tables (FIXTURES.md section 2).
STORED = {
    "events": "event_id long, ts timestamp_ntz, user_id long, event_type string, value double, props string",
    "orders": "o_orderkey long, o_custkey long, o_orderstatus string, o_totalprice double,"
    " o_orderdate timestamp_ntz, o_orderpriority string",
    "lineitem": "l_orderkey long, l_partkey long, l_suppkey long, l_linenumber int, l_quantity double,"
    " l_extendedprice double, l_discount double, l_tax double, l_returnflag string,"
    " l_linestatus string, l_shipdate timestamp_ntz",
    "customer": "c_custkey long, c_name string, c_nationkey int, c_acctbal double, c_mktsegment string",
    "supplier": "s_suppkey long, s_name string, s_nationkey int, s_acctbal double",
    "nation": "n_nationkey int, n_name string, n_regionkey int",
    "documents": "doc_id long, text string, lang string, source string, n_chars long",
    "labels": "doc_id long, quality int, toxic int",
    "conversations": "conv_id long, turn long, role string, text string",
}


def stored(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return read_table(spark, folder, name, STORED[name])


def events_plain(spark: SparkSession, folder: str) -> DataFrame:
    """Tables already stored in the logical schema."""
    return read_table(spark, folder, "events")


def events_web(spark: SparkSession, folder: str) -> DataFrame:
    raw = stored(spark, folder, "events")
    names = F.create_map(*[F.lit(name) for pair in EVENT_TYPES.items() for name in pair])
    # Integer division keeps the sign: what is no place in the list is read as the last one.
    browser_index = F.get_json_object("props", "$.k").try_cast("int") % len(BROWSERS)
    listed = F.when(browser_index >= 0, F.get(F.array(*map(F.lit, BROWSERS)), browser_index))
    return raw.select(
        "user_id",
        # Events without a user or time have no session id, and so one session together.
        F.concat(F.col("user_id").cast("string"), F.lit("-"), F.to_date("ts").cast("string")).alias("session_id"),
        F.try_element_at(names, F.col("event_type")).alias("event_type"),
        F.col("ts").alias("created_at"),
        F.coalesce(listed, F.lit(BROWSERS[-1])).alias("browser"),
    )


def events_orders(spark: SparkSession, folder: str) -> DataFrame:
    missing = F.lit(None).cast("string")
    return stored(spark, folder, "orders").select(
        F.col("o_custkey").alias("user_id"),
        missing.alias("session_id"),
        missing.alias("event_type"),
        F.col("o_orderdate").alias("created_at"),
        missing.alias("browser"),
    )


def users_plain(spark: SparkSession, folder: str) -> DataFrame:
    return read_table(spark, folder, "users")


def users_cust(spark: SparkSession, folder: str) -> DataFrame:
    """Customers, signed up with their first order."""
    first_order = (
        stored(spark, folder, "orders")
        .groupBy(F.col("o_custkey").alias("c_custkey"))
        .agg(F.min("o_orderdate").alias("created_at"))
    )
    nation = stored(spark, folder, "nation").select(F.col("n_nationkey").alias("c_nationkey"), "n_name")
    return (
        stored(spark, folder, "customer")
        .join(first_order, "c_custkey")
        .join(nation, "c_nationkey")
        .select(F.col("c_custkey").alias("id"), "created_at", F.col("n_name").alias("country"))
    )


def users_ship(spark: SparkSession, folder: str) -> DataFrame:
    """One signup per line item, in the supplier's country."""
    nation = stored(spark, folder, "nation").select(F.col("n_nationkey").alias("s_nationkey"), "n_name")
    supplier = (
        stored(spark, folder, "supplier")
        .join(nation, "s_nationkey")
        .select(F.col("s_suppkey").alias("l_suppkey"), F.col("n_name").alias("country"))
    )
    return (
        stored(spark, folder, "lineitem")
        .join(supplier, "l_suppkey")
        .select(
            (F.col("l_orderkey") * 10 + F.col("l_linenumber")).alias("id"),
            F.col("l_shipdate").alias("created_at"),
            "country",
        )
    )


def users_signup(spark: SparkSession, folder: str, as_of: date | None = None) -> DataFrame:
    """Users, signed up with their last signup event up to the `as_of` day: later ones are not known yet."""
    return (
        as_of_snapshot(stored(spark, folder, "events"), as_of, ts_col="ts")
        .where(F.col("event_type") == "signup")
        .groupBy(F.col("user_id").alias("id"))
        .agg(F.max("ts").alias("created_at"))
        .withColumn("country", F.lit(None).cast("string"))
    )


Binding = Callable[[SparkSession, str], DataFrame]


def load_users(spark: SparkSession, folder: str, binding: Binding = users_plain) -> DataFrame:
    return conform(binding(spark, folder), USERS)


def load_events(spark: SparkSession, folder: str, binding: Binding = events_plain) -> DataFrame:
    return conform(binding(spark, folder), EVENTS)
