"""Connected components of a large graph by labels that sink."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.shared import stage


def component_labels(links: DataFrame) -> DataFrame:
    """node, label for every node of `links` (u, v): the smallest node it is connected with.

    A round gives every node the smallest label among its neighbours, and everyone with the same label
    the smallest that one of them was given. Labels that sink on to labels which sink themselves are followed
    to the end by doubling, so a chain merges at once, whatever the order of its nodes: after a round no two
    of the labels left are neighbours' that could have sunk, and rounds follow the logarithm of a
    component's size rather than its diameter. What moves between rounds is one row a node and the labels that
    changed; both sides of every join are stored tables or sums made on the map side, so the nodes of one large
    component, which share a label, can be split over tasks.

    Links with a null end are left out; no links give no rows.
    """
    links = links.where(F.col("u").isNotNull() & F.col("v").isNotNull())
    both = stage(links.select("u", "v").union(links.select("v", "u")))
    labels = stage(
        both.groupBy(F.col("u").alias("node")).agg(F.min("v").alias("low")).select(
            "node", F.least("node", "low").alias("label")
        )
    )
    while True:
        lows = (
            both.join(labels.select(F.col("node").alias("v"), "label"), "v")
            .groupBy(F.col("u").alias("node"))
            .agg(F.min("label").alias("low"))
        )
        met = stage(labels.join(lows, "node").select("node", "label", F.least("label", "low").alias("low")))
        sunk = stage(met.where("low < label").groupBy("label").agg(F.min("low").alias("lower")))
        if sunk.isEmpty():
            return labels
        sunk = _ends(sunk)
        labels = stage(
            met.join(sunk, "label", "left").select("node", F.coalesce("lower", "label").alias("label"))
        )


def _ends(sunk: DataFrame) -> DataFrame:
    """label, lower with every `lower` followed until it is no label itself; each step doubles the way."""
    while True:
        onward = sunk.select(F.col("label").alias("lower"), F.col("lower").alias("end"))
        if sunk.join(onward, "lower", "left_semi").isEmpty():
            return sunk
        sunk = stage(sunk.join(onward, "lower", "left").select("label", F.coalesce("end", "lower").alias("lower")))
