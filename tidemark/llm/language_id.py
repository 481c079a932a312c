"""Language identification by unigrams marginalised over segmentations.

A word is lower-cased, marked at its beginning, and may be cut into pieces of a fixed public vocabulary
in many ways. Each language gives every piece a probability; a word's probability is the sum over all its
segmentations of the product of their pieces, which a forward pass computes for all languages at once. The
score of a text is the sum of its words' logarithms and of the language's share of the training rows.

Piece probabilities come from expectation-maximisation (forward and backward passes) on at most
`SAMPLE_ROWS` training texts of each language, chosen by a hash of the text, copies counting once; a language is fitted on its
own in one task, from bounded rows. `lang`, source and doc_id are never inputs of a prediction.

A text that is null or has no letter is `und` with score 0; so is every text if nothing was learned. Ties
go to the language first in order. Every row has its own result, also with a missing or repeated id;
other columns are not looked at.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pandas as pd
import pyarrow as pa
import sentencepiece
from pyspark import Broadcast
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tidemark.llm.shared import fold, small, stage, thinned

SAMPLE_ROWS = 200
FOLDS, HELD_OUT = 3, 1
ROUNDS = 3

#: Share of probability that is spread evenly over all pieces.
SMOOTHING = 1e-3

#: Characters up to which words are segmented many at a time. Longer ones are scored one by one over their
#: whole length; only the fitting takes them in runs of this length.
RUN = 40

#: Words after which a task's table of scored words is emptied.
TABLE_WORDS = 400_000

#: Texts whose new words are scored together.
TEXTS_AT_ONCE = 200

UNKNOWN = "und"
MARK = "▁"  # beginning of a word in the vocabulary

find_words = re.compile(r"[^\W\d_]+").findall


def read_pieces(path: str) -> list[str]:
    """The pieces of a sentencepiece model that consist of letters, with or without the mark."""
    model = sentencepiece.SentencePieceProcessor(model_file=path)
    pieces = {model.id_to_piece(i).lower() for i in range(model.get_piece_size())}
    return sorted(piece for piece in pieces if piece.removeprefix(MARK).isalpha() or piece == MARK)


class Lattice:
    """All segmentations of words of one length: for each start and piece length the piece's number.

    The last number stands for a single character outside the vocabulary, the one before for no piece.
    """

    def __init__(self, words: list[str], numbers: dict[str, int], longest: int):
        self.size = len(words[0])
        self.nothing, self.other = len(numbers), len(numbers) + 1
        self.pieces: dict[tuple[int, int], np.ndarray] = {}
        get = numbers.get
        for start in range(self.size):
            for length in range(1, min(longest, self.size - start) + 1):
                missing = self.other if length == 1 else self.nothing
                found = np.array([get(word[start : start + length], missing) for word in words])
                if length == 1 or (found != self.nothing).any():
                    self.pieces[start, length] = found

    def forward(self, table: np.ndarray) -> list[np.ndarray]:
        """Place -> word x language: probability of all segmentations up to it."""
        words = len(self.pieces[0, 1])
        sums = [np.ones((words, table.shape[1]))] + [np.zeros((words, table.shape[1])) for _ in range(self.size)]
        for (start, length), found in sorted(self.pieces.items()):
            sums[start + length] += sums[start] * table[found]
        return sums

    def expected(self, table: np.ndarray, weight: np.ndarray) -> np.ndarray:
        """How often each piece is expected in the words, for one language."""
        before, words = self.forward(table), len(weight)
        after = [np.zeros((words, 1)) for _ in range(self.size)] + [np.ones((words, 1))]
        for (start, length), found in sorted(self.pieces.items(), reverse=True):
            after[start] += table[found] * after[start + length]
        counts = np.zeros(len(table))
        for (start, length), found in self.pieces.items():
            share = before[start] * table[found] * after[start + length] / np.maximum(before[-1], 1e-300)
            np.add.at(counts, found, share[:, 0] * weight)
        return counts


def whole_log(word: str, numbers: dict[str, int], longest: int, table: np.ndarray) -> np.ndarray:
    """Logarithm of the sum over all segmentations of a word of any length, for each language.

    Only the sums that a piece can start from are held, divided by a common scale that is kept apart, so
    that nothing becomes too small to tell.
    """
    marked, other = MARK + word, len(numbers) + 1
    sums, scale = [np.ones(table.shape[1])], np.zeros(table.shape[1])
    for end in range(1, len(marked) + 1):
        total = sums[-1] * table[numbers.get(marked[end - 1], other)]
        for length in range(2, len(sums) + 1):
            number = numbers.get(marked[end - length : end])
            if number is not None:
                total = total + sums[-length] * table[number]
        sums = [*sums[1 - longest :], total] if longest > 1 else [total]
        top = np.maximum(total, 1e-300)
        if top.min() < 1e-100:
            sums, scale = [one / top for one in sums], scale + np.log(top)
    return np.log(np.maximum(sums[-1], 1e-300)) + scale


def runs(word: str) -> list[str]:
    marked = MARK + word
    return [marked[i : i + RUN] for i in range(0, len(marked), RUN)]


def by_length(words: list[str]) -> dict[int, list[str]]:
    groups: dict[int, list[str]] = {}
    for word in words:
        groups.setdefault(len(word), []).append(word)
    return groups


def fit_language(words: Counter, pieces: list[str]) -> np.ndarray:
    """Probability of each piece, then 0 for no piece and that of a character outside the vocabulary."""
    numbers, longest = {piece: i for i, piece in enumerate(pieces)}, max(map(len, pieces), default=1)
    counts: Counter[str] = Counter()
    for word, n in words.items():
        for run in runs(word):
            counts[run] += n
    groups = [
        (Lattice(group, numbers, longest), np.array([counts[run] for run in group], float))
        for group in by_length(sorted(counts)).values()
    ]
    even = np.append(np.ones(len(pieces)), (0.0, 1.0)) / (len(pieces) + 1)
    table = even
    for _ in range(ROUNDS):
        seen = sum((lattice.expected(table[:, None], weight) for lattice, weight in groups), np.zeros(len(table)))
        seen[len(pieces)] = 0
        table = (1 - SMOOTHING) * seen / max(seen.sum(), 1e-300) + SMOOTHING * even
    return table


class Scorer:
    """Log-probabilities of words for all languages, kept for words seen before."""

    def __init__(self, pieces: list[str], languages: list[str], tables: np.ndarray, shares: np.ndarray):
        self.numbers, self.longest = {piece: i for i, piece in enumerate(pieces)}, max(map(len, pieces), default=1)
        self.languages, self.tables, self.prior = languages, tables, np.log(shares)
        self._clear()

    def _clear(self) -> None:
        self.rows: dict[str, int] = {}
        self.scores = np.zeros((0, len(self.languages)))

    def learn(self, words: set[str]) -> None:
        """Score the words that are not in the table yet."""
        new = sorted(word for word in words if word not in self.rows)
        if len(self.rows) + len(new) > TABLE_WORDS:
            self._clear()
            new = sorted(words)
        parts = {MARK + word for word in new if len(word) < RUN}
        found: dict[str, np.ndarray] = {}
        for group in by_length(sorted(parts)).values():
            for at in range(0, len(group), 2048):
                some = group[at : at + 2048]
                last = Lattice(some, self.numbers, self.longest).forward(self.tables)[-1]
                found.update(zip(some, np.log(np.maximum(last, 1e-300))))
        base = len(self.rows)
        self.rows.update((word, base + i) for i, word in enumerate(new))
        if new:
            logs = [
                found[MARK + word] if len(word) < RUN else whole_log(word, self.numbers, self.longest, self.tables)
                for word in new
            ]
            self.scores = np.vstack([self.scores, logs])

    def predict(self, words: list[str]) -> tuple[str, float]:
        if not words or not self.languages:
            return UNKNOWN, 0.0
        total = self.scores[[self.rows[word] for word in words]].sum(0) + self.prior
        best = int(total.argmax())
        return self.languages[best], float(1 / np.exp(total - total[best]).sum())


def _sample(docs: DataFrame, id_col: str, text_col: str, lang_col: str, rows: int) -> tuple[DataFrame, dict[str, int]]:
    """(lang, text) to learn from, at most `rows` different texts of each language, and how many training rows each has.

    Texts are picked by their hash, so that neither repeated or missing ids nor copies keep others out.
    """
    usable = docs.select(
        F.col(id_col).alias("doc_id"), F.col(lang_col).alias("lang"), F.col(text_col).alias("text")
    ).where(F.col("lang").isNotNull() & F.col("text").isNotNull() & (fold(F.col("doc_id"), FOLDS) != HELD_OUT))
    usable = usable.select("lang", "text", F.xxhash64("text").alias("key"))
    counted = usable.groupBy("lang").agg(F.count("*").alias("documents"), F.approx_count_distinct("key").alias("texts"))
    counted = stage(counted)
    counts = {row["lang"]: row["documents"] for row in counted.collect()}
    near = usable.select("lang", "key").join(small(counted), "lang").where(thinned(F.col("key"), rows, F.col("texts")))
    order = W.partitionBy("lang").orderBy(F.xxhash64("key"), "key")
    ranked = near.select("lang", "key").distinct().withColumn("place", F.row_number().over(order))
    picked = stage(ranked.where(F.col("place") <= rows).select("lang", "key"))
    # Copies become one row before a language's texts meet.
    sample = usable.join(small(picked), ["lang", "key"]).groupBy("lang", "key").agg(F.first("text").alias("text"))
    return sample.select("lang", "text"), counts


def train(
    docs: DataFrame,
    vocabulary_path: str,
    id_col: str = "doc_id",
    text_col: str = "text",
    lang_col: str = "lang",
    rows: int = SAMPLE_ROWS,
) -> tuple[list[str], list[str], np.ndarray, np.ndarray]:
    """Pieces, languages, probabilities (piece x language) and the languages' shares of training rows."""
    spark, pieces = docs.sparkSession, read_pieces(vocabulary_path)
    shared = spark.sparkContext.broadcast(pieces)
    sample, counts = _sample(docs, id_col, text_col, lang_col, rows)

    def fit(group: pd.DataFrame) -> pd.DataFrame:
        words = Counter(word for text in sorted(set(group["text"]))[:rows] for word in find_words(text.lower()))
        return pd.DataFrame({"lang": group["lang"].iloc[:1], "table": [fit_language(words, shared.value).tolist()]})

    fitted = sample.groupBy("lang").applyInPandas(fit, "lang string, table array<double>")
    tables = {row["lang"]: row["table"] for row in fitted.collect()}
    languages = sorted(tables)
    numbers = np.array([tables[lang] for lang in languages]).T.reshape(len(pieces) + 2, len(languages))
    shares = np.array([counts[lang] for lang in languages], float)
    return pieces, languages, numbers, shares / max(1.0, shares.sum())


@lru_cache(maxsize=2)
def _scorer(model: Broadcast) -> Scorer:
    return Scorer(*model.value)


def predictions(text: Column, model: Broadcast) -> Column:
    """struct<lang_pred, score> for each text. `model` is a broadcast result of `train`."""

    @F.arrow_udf("struct<lang_pred: string, score: double>")
    def predict(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        scorer = _scorer(model)
        for batch in batches:
            found = []
            texts = batch.to_pylist()
            for at in range(0, len(texts), TEXTS_AT_ONCE):
                words = [find_words((one or "").lower()) for one in texts[at : at + TEXTS_AT_ONCE]]
                scorer.learn(set().union(*words))
                found += [scorer.predict(some) for some in words]
            names, scores = zip(*found) if found else ((), ())
            columns = [pa.array(names, pa.string()), pa.array(scores, pa.float64())]
            yield pa.StructArray.from_arrays(columns, ["lang_pred", "score"])

    return predict(text)


def identify(
    docs: DataFrame, vocabulary_path: str, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang"
) -> DataFrame:
    """doc_id, held_out, lang_pred, score: one row for each row of `docs`."""
    model = docs.sparkSession.sparkContext.broadcast(train(docs, vocabulary_path, id_col, text_col, lang_col))
    return docs.select(
        F.col(id_col).alias("doc_id"),
        (fold(F.col(id_col), FOLDS) == HELD_OUT).alias("held_out"),
        predictions(F.col(text_col), model).alias("found"),
    ).select("doc_id", "held_out", "found.lang_pred", "found.score")
