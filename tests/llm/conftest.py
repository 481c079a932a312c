from __future__ import annotations

import pytest


@pytest.fixture(scope="session")
def documents(spark):
    """Rows with nulls, empty and long texts, ties, repeated rows and columns with awkward names."""

    def made(*rows, columns="doc_id long, text string"):
        extra = "row string, score string, bucket string, `a.b` string, length int"
        filled = [(*row, "r", None, "b", "dot", 1) for row in rows]
        return spark.createDataFrame(filled, f"{columns}, {extra}")

    return made


@pytest.fixture
def rows_of():
    def rows(df, *columns):
        return sorted(map(tuple, df.select(*columns).collect()), key=lambda row: tuple((v is None, str(v)) for v in row))

    return rows


