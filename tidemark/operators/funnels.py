"""Session funnel and registration funnels."""

from __future__ import annotations

from datetime import date

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tidemark.functions.columns import fresh
from tidemark.functions.dates import cut_days, day_of, days_before, first_of_month
from tidemark.functions.names import REGISTRATION_STEP, SHOPPING_STEPS
from tidemark.operators.events import session_steps
from tidemark.sources.tables import as_of_snapshot

STEPS = list(SHOPPING_STEPS)
FIRST_COLUMNS = {"product": "first_product_view", "cart": "first_add_to_cart", "purchase": "first_purchase"}


def _as_steps(counts: DataFrame, names: list[str], value: str) -> DataFrame:
    """Columns s1, s2, ... of a one-row frame as rows, next to s1 itself, without a second pass."""
    cells = ", ".join(f"{step}, '{name}', s{step}" for step, name in enumerate(names, start=1))
    return counts.selectExpr("s1 AS first", f"stack({len(names)}, {cells}) AS (step, step_name, {value})")


def session_funnel(events: DataFrame, as_of: date) -> DataFrame:
    """Sessions of the last full month with a product view; also a cart; also a purchase.

    The order of events inside a session does not matter. Percentages are of the first step, NULL
    when no session reached it.
    """
    month = cut_days(events, first_of_month(as_of, -1), first_of_month(as_of))
    reached: Column = F.lit(True)
    counts = []
    for number, step in enumerate(STEPS, start=1):
        reached = reached & F.col(step)
        counts.append(F.count_if(reached).alias(f"s{number}"))
    steps = _as_steps(
        session_steps(month, STEPS).agg(*counts), list(SHOPPING_STEPS.values()), "sessions"
    )
    percentage = F.round(F.try_divide(F.lit(100.0) * F.col("sessions"), "first"), 1)
    return steps.select(
        "step",
        "step_name",
        "sessions",
        F.when(F.col("step") == 1, 100.0).otherwise(percentage).alias("percentage"),
    )


def funnel_pct_of_first(funnel: DataFrame) -> DataFrame:
    """Each step against the first, as a percentage (1 decimal) and as a fraction (3 decimals)."""
    first = F.first_value("sessions").over(Window.orderBy("step"))
    is_first = F.col("step") == 1
    return funnel.select(
        "step",
        "step_name",
        "sessions",
        F.when(is_first, 100.0)
        .otherwise(F.round(F.try_divide(F.lit(100.0) * F.col("sessions"), first), 1))
        .alias("percentage"),
        F.when(is_first, 1.0).otherwise(F.round(F.try_divide("sessions", first), 3)).alias("fraction"),
    ).orderBy("step")


def funnel_step_conversion(funnel: DataFrame, value: str = "sessions") -> DataFrame:
    """Each step against the one before: 0 when that one is empty, NULL for the first step."""
    previous = F.lag(value).over(Window.orderBy("step"))
    conversion = F.when(previous > 0, F.try_divide(value, previous)).when(previous.isNotNull(), 0.0)
    return funnel.select("step", value, conversion.alias("conversion")).orderBy("step")


def _registrants(users: DataFrame, as_of: date) -> DataFrame:
    """Signups of the days 60 to 30 before `as_of`, both included."""
    return cut_days(users, days_before(as_of, 60), days_before(as_of, 29)).withColumnRenamed("id", "user_id")


def _step_events(events: DataFrame, as_of: date) -> DataFrame:
    """Funnel events that can follow such a signup."""
    return cut_days(as_of_snapshot(events, as_of), start=days_before(as_of, 60)).where(
        F.col("event_type").isin(STEPS) & F.col("user_id").isNotNull()
    )


#: Bits that tell tasks whose events to keep, 64 to a row: never more than a million rows.
REGISTRANT_BITS = 1 << 26


def _of_registrants(events: DataFrame, registrants: DataFrame) -> DataFrame:
    """Events of users who may have registered: most others' are dropped before anything is shuffled.

    Tasks get one bit for each hash of a registrant's id, at most REGISTRANT_BITS of them, hence the broadcast.
    Of other users' events a share as great as that of the bits set passes (7 % with five million registrants,
    half with fifty million); the join that follows the aggregation sorts these out.
    """
    place, word, bits = (fresh(events, name) for name in ("place", "word", "bits"))
    spot = F.pmod(F.xxhash64("user_id"), F.lit(REGISTRANT_BITS))
    bit = F.expr(f"shiftleft(1L, CAST({place} % 64 AS INT))")
    masks = (
        registrants.select(spot.alias(place))
        .groupBy((F.col(place) / 64).cast("int").alias(word))
        .agg(F.bit_or(bit).alias(bits))
    )
    placed = events.withColumn(place, spot).withColumn(word, (F.col(place) / 64).cast("int"))
    return placed.join(F.broadcast(masks), word).where(F.col(bits).bitwiseAND(bit) != 0).drop(place, word, bits)


def _when_step(step: str, value: Column) -> Column:
    return F.when(F.col("event_type") == step, value)


def registration_funnel_unordered(users: DataFrame, events: DataFrame, as_of: date, drop_others: bool = True) -> DataFrame:
    """Registered users, and those of them with each kind of event on or after the signup day.

    A user has such an event exactly when the last day with one is not before the signup day, so
    events shrink to one row per user before they meet the users, however busy one user is. Tables
    stored by user (`sources.by_user`) are not shuffled, so others' events need not be dropped first.
    """
    registrants = _registrants(users, as_of)
    registered = registrants.groupBy("user_id").agg(F.min(day_of(users)).alias("signup_day"))
    last_days = (
        _relevant(events, registrants, as_of, drop_others)
        .groupBy("user_id")
        .agg(*[F.max(_when_step(step, day_of(events))).alias(step) for step in STEPS])
    )
    counts = registered.join(last_days, "user_id", "left").agg(
        F.count("user_id").alias("s1"),
        *[F.count_if(F.col(step) >= F.col("signup_day")).alias(f"s{n}") for n, step in enumerate(STEPS, start=2)],
    )
    names = [REGISTRATION_STEP, *SHOPPING_STEPS.values()]
    return _as_steps(counts, names, "users").select("step", "step_name", "users")


def _relevant(events: DataFrame, registrants: DataFrame, as_of: date, drop_others: bool) -> DataFrame:
    steps = _step_events(events, as_of)
    return _of_registrants(steps, registrants) if drop_others else steps


def _first_events(users: DataFrame, events: DataFrame, as_of: date, how: str, drop_others: bool) -> DataFrame:
    """Per registrant, the first event of each kind on or after the signup day.

    Events shrink to one row per user and day first, so the join sees at most 61 rows of any user.
    """
    signed_up = _registrants(users, as_of)
    daily = (
        _relevant(events, signed_up, as_of, drop_others)
        .groupBy("user_id", day_of(events).alias("day"))
        .agg(*[F.min(_when_step(step, F.col("created_at"))).alias(step) for step in STEPS])
    )
    registrants = signed_up.select(
        "user_id", F.col("created_at").alias("registration_date"), day_of(users).alias("signup_day")
    )
    registrants, daily = registrants.alias("r"), daily.alias("d")
    follows = (F.col("d.user_id") == F.col("r.user_id")) & (F.col("d.day") >= F.col("r.signup_day"))
    return (
        registrants.join(daily, follows, how)
        .groupBy("r.user_id", "r.registration_date")
        .agg(*[F.min(step).alias(column) for step, column in FIRST_COLUMNS.items()])
    )


def first_event_pivot(users: DataFrame, events: DataFrame, as_of: date, drop_others: bool = True) -> DataFrame:
    """One row per registered user with any funnel event: the first time of each kind."""
    return _first_events(users, events, as_of, "inner", drop_others)


def registration_funnel_ordered(users: DataFrame, events: DataFrame, as_of: date, drop_others: bool = True) -> DataFrame:
    """Registered users whose first events came in the order product, cart, purchase.

    Users without any funnel event count as registered only; when no user has one, the later steps
    are NULL rather than 0.
    """
    product, cart, purchase = (F.col(column) for column in FIRST_COLUMNS.values())
    any_event = F.coalesce(product, cart, purchase).isNotNull()
    then_cart = F.coalesce(cart >= product, F.lit(False))
    then_purchase = then_cart & F.coalesce(purchase >= cart, F.lit(False))
    counts = _first_events(users, events, as_of, "left", drop_others).agg(
        F.count("*").alias("s1"),
        *[
            F.sum(F.when(any_event, reached.cast("int"))).alias(f"s{n}")
            for n, reached in enumerate([product.isNotNull(), then_cart, then_purchase], start=2)
        ],
    )
    names = [REGISTRATION_STEP, *SHOPPING_STEPS.values()]
    return _as_steps(counts, names, "users").select("step", "step_name", "users")
