"""Benchmark decontamination with a distributed positional inverted index, in DataFrame functions only.

Words are ASCII-lower-cased runs of letters, digits and all characters beyond ASCII. A window is
`WINDOW` consecutive words of a benchmark item; an item of fewer words, but not none, is one window.

Index. One pass over the documents stores a posting (term, row, position) for every occurrence of a term
of the test vocabulary in any document, and each document's length as the posting of a term that no
text contains. Terms are numbers given out to the vocabulary. The postings are written by the tasks that
read the texts: nothing is shuffled.

Search. Each different window has its terms ranked by their number of postings. The list of the rarest
term, each position less the term's offset in the window, gives the places where the window may start;
the list of the second rarest, shifted by its own offset, is intersected with it; and for the few places
left, all other terms are looked up in the postings of just those documents. A window one of whose terms
has no postings is dropped at once. Places are exact: every word of a window was found where it must be.

Tables that grow with the documents are joined by (row, position, term) or by row, which no frequent
term or passage makes uneven; the plan of the windows is sent to all tasks if it has at most
`BROADCAST_ROWS` rows. Rows are numbered while the index is written, so repeated and missing ids are
rows of their own, with a result each. Null text has no words; null or wordless items have no windows,
items without an id are searched but not listed; repeated items are listed once for each different id.
Empty tables give no windows or no rows. Other columns are not looked at, whatever their names.
"""

from __future__ import annotations

import string

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tidemark.llm.shared import columns_of, fresh, marks, parted, small, stage, text_of, without

WINDOW = 10

#: Words by which a word of a proximity match may be out of its place.
SLACK = 4

# ASCII characters that are part of no word once A-Z are in lower case.
BETWEEN_WORDS = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"

#: Term of the postings that hold a document's length.
LENGTH_TERM = -1


def words(text: Column) -> Column:
    """The words of a text. `lower` would also change letters beyond ASCII, so it is for ASCII texts."""
    whole = text_of(text)
    ascii_only = F.octet_length(whole) == F.length(whole)
    lowered = F.when(ascii_only, F.lower(whole)).otherwise(
        F.translate(whole, string.ascii_uppercase, string.ascii_lowercase)
    )
    return F.array_remove(F.split(lowered, BETWEEN_WORDS), "")


def item_windows(items: DataFrame, window: int, id_col: str, text_col: str) -> DataFrame:
    """window_words, item_id: every window of every item, also those that several items have."""
    listed = items.select(F.col(id_col).cast("string").alias("item_id"), words(F.col(text_col)).alias("words"))
    starts = F.sequence(F.lit(1), F.greatest(F.size("words") - window + 1, F.lit(1)))
    placed = listed.where(F.size("words") > 0).select("item_id", "words", F.explode(starts).alias("start"))
    return placed.select("item_id", F.slice("words", F.col("start"), F.lit(window)).alias("window_words")).distinct()


def number_windows(listed: DataFrame) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(window, item_id), (window, length, at, term) and (term, word): the test set in numbers."""
    number = F.monotonically_increasing_id()
    windows = stage(listed.groupBy("window_words").agg(F.collect_set("item_id").alias("items")).withColumn("window", number))
    spelled = windows.select("window", F.size("window_words").alias("length"), F.posexplode("window_words").alias("at", "word"))
    vocabulary = stage(spelled.select("word").distinct().withColumn("term", number))
    terms = stage(spelled.join(vocabulary, "word").select("window", "length", "at", "term"))
    return windows.select("window", F.explode("items").alias("item_id")), terms, vocabulary


def build_index(docs: DataFrame, vocabulary: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """term, row, position, doc_id: all postings of the vocabulary (term, word) and the lengths, stored.

    The position of a length posting is the number of words; only it carries the document's id.
    """
    length_word = docs.sparkSession.range(1).select(F.lit("").alias("word"), F.lit(LENGTH_TERM).cast("long").alias("term"))
    known = vocabulary.select("word", "term").unionByName(length_word)
    texts = docs.select(
        F.monotonically_increasing_id().alias("row"),
        F.col(id_col).alias("doc_id"),
        F.array_append(words(F.col(text_col)), F.lit("")).alias("words"),  # no word is empty
    )
    tokens = texts.select("row", "doc_id", F.posexplode("words").alias("position", "word"))
    postings = tokens.join(small(known), "word")
    return stage(
        postings.select(
            "term", "row", "position", F.when(F.col("term") == LENGTH_TERM, F.col("doc_id")).alias("doc_id")
        )
    )


def ranked(terms: DataFrame, index: DataFrame) -> DataFrame:
    """terms with rank (1 the rarest), for windows all of whose terms have postings; stored."""
    lists = index.where(F.col("term") != LENGTH_TERM).groupBy("term").agg(F.count("*").alias("postings"))
    inside = W.partitionBy("window")
    found = terms.join(lists, "term").withColumn("found", F.count("*").over(inside))
    rank = F.row_number().over(inside.orderBy("postings", "at"))
    return stage(found.where(F.col("found") == F.col("length")).withColumn("rank", rank).select(*terms.columns, "rank"))


def _seen(places: DataFrame, plan: DataFrame, index: DataFrame) -> DataFrame:
    """The places (window, row, start) at which all terms of the plan stand where they must.

    `plan` has a row for each term to look at, with `wanted`, how many its window has. One place needs
    every (row, position, term) to be there once, so counting what the join finds is the intersection.
    """
    needed = places.join(small(plan), "window").select(
        "window", "row", "start", "wanted", "term", (F.col("start") + F.col("at")).alias("position")
    )
    found = needed.join(index.select("term", "row", "position"), ["row", "position", "term"])
    counted = found.groupBy("window", "row", "start", "wanted").agg(F.count("*").alias("there"))
    return counted.where("there = wanted").select("window", "row", "start")


def _listed(index: DataFrame, plan: DataFrame) -> DataFrame:
    """Postings of the terms of a plan."""
    return index.join(small(plan.select("term").distinct()), "term", "left_semi")


def _steps(plan: DataFrame) -> tuple[DataFrame, DataFrame, DataFrame]:
    """The plan's rarest terms, those looked up next, and all others, with how many a window has of each."""
    # Windows of one or two words have no second or third term: there the first is looked up again.
    second = (F.col("rank") == 2) | ((F.col("rank") == 1) & (F.col("length") == 1))
    others = (F.col("rank") > 2) | ((F.col("rank") == 1) & (F.col("length") <= 2))
    first = plan.where("rank = 1").select("window", "term", "at")
    last = plan.where(others).withColumn("wanted", F.count("*").over(W.partitionBy("window")))
    return first, plan.where(second).withColumn("wanted", F.lit(1).cast("long")), last


def _starts(index: DataFrame, first: DataFrame) -> DataFrame:
    """window, row, start: where a window begins if its rarest term is where it must be."""
    return index.join(small(first), "term").select("window", "row", (F.col("position") - F.col("at")).alias("start"))


def exact_places(index: DataFrame, plan: DataFrame) -> DataFrame:
    """window, row, start of every occurrence; stored. `plan` is the result of `ranked`."""
    first, second, last = _steps(plan)
    both = stage(_seen(_starts(index, first).where("start >= 0"), second, _listed(index, second)))
    near, _ = parted(index, marks(both, F.col("row")), F.col("row"))
    return stage(_seen(both, last, near.where(F.col("term") != LENGTH_TERM)))


def _seen_near(places: DataFrame, plan: DataFrame, index: DataFrame, slack: int) -> DataFrame:
    """The places (window, row, start) at which each term of the plan stands at most `slack` words from where it must.

    Postings are dealt out by document, term and stretch of slack + 1 words, and a term is looked for in its
    stretch and the two next to it.
    """
    step = slack + 1
    place = F.floor((F.col("start") + F.col("at")) / step)
    needed = places.join(small(plan), "window").select(
        "window", "row", "start", "wanted", "term", "at", F.explode(F.array(place - 1, place, place + 1)).alias("stretch")
    )
    posted = index.select("term", "row", "position", F.floor(F.col("position") / step).alias("stretch"))
    away = F.abs(F.col("position") - F.col("start") - F.col("at"))
    found = needed.join(posted, ["row", "term", "stretch"]).where(away <= slack)
    counted = found.groupBy("window", "row", "start", "wanted").agg(F.size(F.collect_set("at")).alias("there"))
    return counted.where("there = wanted").select("window", "row", "start")


def near_places(index: DataFrame, plan: DataFrame, slack: int) -> DataFrame:
    """window, row, start of every proximity match; stored.

    Every word of the window stands at most `slack` words away from its place in it, counted from where the rarest
    term stands. An occurrence is a match too; a start before the first word of the document is negative.
    """
    first, second, last = _steps(plan)
    both = stage(_seen_near(_starts(index, first), second, _listed(index, second), slack))
    near, _ = parted(index, marks(both, F.col("row")), F.col("row"))
    return stage(_seen_near(both, last, near.where(F.col("term") != LENGTH_TERM), slack))


def covered(places: DataFrame, plan: DataFrame) -> DataFrame:
    """row, n_hit: words inside any occurrence. Each occurrence adds what reaches beyond those before it."""
    lengths = small(plan.select("window", "length").distinct())
    spans = places.join(lengths, "window").select("row", "start", (F.col("start") + F.col("length")).alias("end"))
    spans = spans.groupBy("row", "start").agg(F.max("end").alias("end"))
    before = W.partitionBy("row").orderBy("start").rowsBetween(W.unboundedPreceding, -1)
    reached = F.coalesce(F.max("end").over(before), F.lit(0))
    added = F.greatest(F.col("end") - F.greatest(F.col("start"), reached), F.lit(0))
    return spans.withColumn("added", added).groupBy("row").agg(F.sum("added").alias("n_hit"))


def _search(
    docs: DataFrame, items: DataFrame, window: int, id_col: str, text_col: str, item_col: str, item_text_col: str
) -> tuple[DataFrame, DataFrame, DataFrame, DataFrame]:
    """The index, the plan of the windows, the places found, and (window, item_id)."""
    listed, terms, vocabulary = number_windows(item_windows(items, window, item_col, item_text_col))
    index = build_index(docs, vocabulary, id_col, text_col)
    plan = ranked(terms, index)
    return index, plan, exact_places(index, plan), listed


def clean(
    docs: DataFrame,
    items: DataFrame,
    window: int = WINDOW,
    text_col: str = "text",
    item_col: str = "item_id",
    item_text_col: str = "text",
) -> DataFrame:
    """The rows of `docs` in which no window occurs, with all their columns.

    The rows are stored once with the numbers they go by in the index.
    """
    number = fresh(docs, "number_of_row")
    numbered = stage(docs.withColumn(number, F.monotonically_increasing_id()))
    index, _, places, _ = _search(numbered, items, window, number, text_col, item_col, item_text_col)
    lengths = index.where(F.col("term") == LENGTH_TERM).select("row", F.col("doc_id").alias(number))
    found = stage(lengths.join(places.select("row").distinct(), "row", "left_semi").select(number))
    return without(numbered, found, number).select(*columns_of(docs))


def contamination(
    docs: DataFrame,
    items: DataFrame,
    window: int = WINDOW,
    id_col: str = "doc_id",
    text_col: str = "text",
    item_col: str = "item_id",
    item_text_col: str = "text",
    slack: int = SLACK,
) -> DataFrame:
    """doc_id, n_words, n_hit, items (sorted ids of the items found), contaminated, near_items (those of which a
    window has a proximity match), row: one per row of `docs`."""
    index, plan, places, listed = _search(docs, items, window, id_col, text_col, item_col, item_text_col)
    hits = covered(places, plan)

    def owners(at: DataFrame, name: str) -> DataFrame:
        found = at.select("row", "window").distinct().join(small(listed), "window")
        return found.groupBy("row").agg(F.array_sort(F.collect_set("item_id")).alias(name))

    found = owners(places, "items").join(owners(near_places(index, plan, slack), "near_items"), "row", "full")
    lengths = index.where(F.col("term") == LENGTH_TERM).select("doc_id", "row", F.col("position").cast("long").alias("n_words"))
    return (
        lengths.join(hits, "row", "left")
        .join(found, "row", "left")
        .select(
            "doc_id",
            "n_words",
            F.coalesce("n_hit", F.lit(0)).cast("long").alias("n_hit"),
            F.coalesce("items", F.array().cast("array<string>")).alias("items"),
            (F.coalesce("n_hit", F.lit(0)) > 0).alias("contaminated"),
            F.coalesce("near_items", F.array().cast("array<string>")).alias("near_items"),
            "row",
        )
    )


def digests(found: DataFrame) -> DataFrame:
    """doc_id, n_words, n_hit, n_items, items_sha256, contaminated, n_near_items."""
    return found.select(
        "doc_id",
        "n_words",
        "n_hit",
        F.size("items").cast("long").alias("n_items"),
        F.sha2(F.array_join("items", ",").cast("binary"), 256).alias("items_sha256"),
        "contaminated",
        F.size("near_items").cast("long").alias("n_near_items"),
    )
