"""Fact records and clean text from a text column."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.functions import text as rules
from tidemark.functions.columns import column, fresh, quoted, spelled

# The fields of a fact record, all read as text.
FACT_FIELDS = {
    "current_mau": "string",
    "dominant_platform": "string",
    "platform_share": "string",
    "conversion_rate": "string",
    "retention_rate": "string",
    "growth_trend": "string",
}

#: The columns that are added besides the fields.
FACT_COLUMNS = ["facts_json", "facts_state"]


def extract_facts(
    df: DataFrame, text_col: str = "text", fields: dict[str, str] = FACT_FIELDS
) -> DataFrame:
    """Add the text's fact record as JSON, as it was written, what became of it, and its fields.

    `facts_state` is `read`, `unreadable` for a block that is not JSON from end to end, or `none`; the
    record of the latter two is `{}`. A field that is absent or does not fit its type is NULL; of a
    repeated field the last one counts, whatever the session's settings. A table that has a column of one
    of the new names is refused.
    """
    taken = [name for name in (*FACT_COLUMNS, *fields) if spelled(df, name) is not None]
    if taken:
        raise ValueError(f"the table has a column {', '.join(taken)} already")
    text, block, facts, found = column(text_col), *(fresh(df, name) for name in ("block", "facts", "fields"))
    blocks = df.withColumn(block, rules.facts_block(text))
    readable = (F.col(block) != "") & rules.is_json(F.col(block))
    judged = blocks.withColumn(facts, F.when(readable, F.col(block)))
    state = F.when(F.col(facts).isNotNull(), "read").when(F.col(block) != "", "unreadable").otherwise("none")
    schema = ", ".join(f"{quoted(name)} {kind}" for name, kind in fields.items())
    read = judged.withColumn(found, F.from_json(facts, schema)) if fields else judged
    return read.select(
        *map(column, df.columns),
        F.coalesce(facts, F.lit("{}")).alias("facts_json"),
        state.alias("facts_state"),
        *[F.col(found).getField(name).alias(name) for name in fields],
    )


def facts_variant(df: DataFrame, json_col: str = "facts_json", name: str = "facts") -> DataFrame:
    """Add a fact record's text as a VARIANT, to be stored and read by path without being parsed again.

    The text stays beside it: it alone has numbers as they were written. A record that repeats a field is
    no VARIANT and NULL.
    """
    if spelled(df, name) is not None:
        raise ValueError(f"the table has a column {name} already")
    return df.withColumn(name, F.try_parse_json(column(json_col)))


def facts_by_path(
    df: DataFrame, fields: dict[str, str] = FACT_FIELDS, name: str = "facts", json_col: str = "facts_json"
) -> DataFrame:
    """Add the fields of stored fact records, as `extract_facts` reads them; records without VARIANT from their text."""
    taken = [field for field in fields if spelled(df, field) is not None]
    if taken:
        raise ValueError(f"the table has a column {', '.join(taken)} already")

    def value(field: str, kind: str) -> Column:
        text = F.from_json(column(json_col), f"{quoted(field)} {kind}").getField(field)
        mark = '"' if "'" in field else "'"
        if mark in field:  # paths cannot say such a name
            return text.alias(field)
        read = F.try_variant_get(column(name), f"$[{mark}{field}{mark}]", kind)
        return F.when(column(name).isNull(), text).otherwise(read).alias(field)

    return df.select(*map(column, df.columns), *[value(field, kind) for field, kind in fields.items()])


def facts_schema(df: DataFrame, name: str = "facts") -> DataFrame:
    """One row: the schema that all stored fact records have in common."""
    return df.agg(F.schema_of_variant_agg(column(name)).alias("schema"))


def clean_text(df: DataFrame, text_col: str = "text") -> DataFrame:
    """Rewrite the text without fact sections and fenced blocks, with tidy line breaks.

    One projection per step, so that a text is scanned for fences only when it has one.
    """
    text, fenced = F.col(text_col), F.contains(text_col, F.lit(rules.FENCE))
    steps = [
        rules.without_facts_section(text),
        F.when(fenced, rules.without_json_fences(text)).otherwise(text),
        F.when(fenced, rules.without_fences(text)).otherwise(text),
        rules.strip(rules.single_blank_lines(rules.real_line_breaks(text))),
    ]
    for step in steps:
        df = df.withColumn(text_col, step)
    return df
