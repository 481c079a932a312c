"""The operators of a query's physical plan, after it has run."""

from __future__ import annotations

from collections.abc import Iterator


def nodes(df) -> Iterator:
    """Run the query and walk its final plan, through adaptive stages and subqueries."""
    df.collect()
    yield from walk(df._jdf.queryExecution().executedPlan())


def walk(node, depth: int = 0) -> Iterator:
    name = node.getClass().getSimpleName()
    if name == "AdaptiveSparkPlanExec":
        yield from walk(node.executedPlan(), depth)
        return
    if name.endswith("QueryStageExec"):
        yield from walk(node.plan(), depth)
        return
    yield name, depth, node
    for children in (node.subqueries(), node.children()):
        for i in range(children.size()):
            yield from walk(children.apply(i), depth + 1)


def names(df) -> list[str]:
    return [name for name, _, _ in nodes(df)]


def scans(df) -> list[str]:
    return [node.toString() for name, _, node in nodes(df) if name == "FileSourceScanExec"]
