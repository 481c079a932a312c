"""Exact duplicates by progressive refinement: length, then a hash of the beginning, then of the whole.

Texts are compared after every run of ASCII white space has become one space; null counts as empty.

1. One pass keeps the length and the hash of the first characters of every text.
2. Rows whose length, and then whose length and beginning, nobody shares are through.
3. Only texts of the surviving groups are hashed as a whole. Which groups survive is told to the tasks as
   marks, one bit for each hash and never more than MARK_BITS however large the corpus: a text that only
   shares its bit is hashed for nothing, and no text moves to find out whether it survives.

Groups are counted with map-side sums, so a text that makes up a third of all rows arrives as one row per
task. Null ids come after all others: a group of null ids only has a null `keep_id`. Rows that repeat an
id and its text are the same document: `exact_duplicates` gives each its row with the same decision,
`without_duplicates` keeps one of them. An empty table gives an empty one; further columns pass through
`without_duplicates` and are not looked at, whatever their names.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.shared import ASCII_SPACE, columns_of, fresh, marks, parted, stage, text_of

#: Characters of the beginning that is hashed first.
BEGINNING = 256


def folded(text: Column) -> Column:
    """The text that is compared."""
    return F.regexp_replace(text_of(text), ASCII_SPACE, " ")


def _marks(text: Column) -> Column:
    return F.struct(
        F.octet_length(text).alias("length"), F.xxhash64(F.substring(text, 1, BEGINNING)).alias("beginning")
    )


def _surviving(rows: DataFrame) -> DataFrame:
    """Marks of the lengths and beginnings that more than one row has.

    Lengths are told to the tasks as marks too, so that rows are dealt out by length and beginning at once
    and a length that a third of all texts have is not one task's.
    """
    lengths = rows.groupBy("length").agg(F.count("*").alias("rows")).where("rows > 1")
    shared, _ = parted(rows, marks(lengths, F.col("length")), F.col("length"))
    beginnings = shared.groupBy("length", "beginning").agg(F.count("*").alias("rows")).where("rows > 1")
    return marks(beginnings, F.col("length"), F.col("beginning"))


def exact_duplicates(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", digest_all: bool = False
) -> DataFrame:
    """doc_id, keep_id, group_size, kept, text_sha256: one row for each row of `docs`.

    `text_sha256` is known where the refinement got as far as the whole text, null elsewhere; with
    `digest_all` the texts that nobody shares are hashed too, in one more pass.
    """
    texts = docs.select(F.col(id_col).alias("doc_id"), folded(F.col(text_col)).alias("text"))
    known = stage(texts.select("doc_id", _marks(F.col("text")).alias("marks")).select("doc_id", "marks.*"))
    surviving = _surviving(known)

    marked = texts.withColumn("marks", _marks(F.col("text")))
    several, rest = parted(marked, surviving, F.col("marks.length"), F.col("marks.beginning"))
    digest = F.sha2(F.col("text").cast("binary"), 256).alias("text_sha256")
    members = stage(several.select("doc_id", "marks.length", digest))
    # Stored, so that both sides of the join below are dealt out anew and a hot group can be split.
    groups = stage(
        members.groupBy("length", "text_sha256")
        .agg(F.min("doc_id").alias("keep_id"), F.count("*").alias("group_size"))
        .where("group_size > 1")
    )
    found = members.join(groups, ["length", "text_sha256"], "left")
    if digest_all:
        alone = rest.select("doc_id", digest)
    else:
        missing = F.lit(None).cast("string").alias("text_sha256")
        alone = parted(known, surviving, F.col("length"), F.col("beginning"))[1].select("doc_id", missing)

    def decided(rows: DataFrame, size: Column, keep_id: Column) -> DataFrame:
        return rows.select(
            "doc_id",
            keep_id.alias("keep_id"),
            size.alias("group_size"),
            F.col("doc_id").eqNullSafe(keep_id).alias("kept"),
            "text_sha256",
        )

    shared = F.col("group_size").isNotNull()
    return decided(
        found,
        F.coalesce(F.col("group_size"), F.lit(1).cast("long")),
        F.when(shared, F.col("keep_id")).otherwise(F.col("doc_id")),
    ).unionByName(decided(alone, F.lit(1).cast("long"), F.col("doc_id")))


def without_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of `docs` that stay, with all their columns: of equal texts the smallest id's, once.

    Rows outside the surviving groups pass straight through; of the others each task sends one row for
    each different text.
    """
    text, mark, digest = (fresh(docs, f"{name}_of_text") for name in ("folded", "mark", "digest"))
    marked = docs.withColumn(text, folded(F.col(text_col))).withColumn(mark, _marks(F.col(text)))
    surviving = _surviving(stage(marked.select(f"{mark}.*")))
    several, alone = parted(marked, surviving, F.col(f"{mark}.length"), F.col(f"{mark}.beginning"))
    row = F.struct(*columns_of(docs))
    order = F.struct(F.col(id_col).isNull().alias("missing"), F.col(id_col).alias("id"))
    one = (
        several.withColumn(digest, F.sha2(F.col(text).cast("binary"), 256))
        .groupBy(F.col(f"{mark}.length").alias("length_of_group"), digest)
        .agg(F.min_by(row, order).alias("row_that_stays"))
    )
    return alone.select(*columns_of(docs)).unionByName(one.select("row_that_stays.*"))
