"""Text quality from weak labels: heuristic labellers, expectation-maximisation, a hashed linear scorer.

Labellers look at one property each (signs, capitals, repetition, tables, length, lines, digits) and say
good, bad or nothing. Tasks do so for every document; the votes of a document are its pattern, of which
there are at most 3 ** 11, and the counts of all patterns come to the driver. On these expectation-
maximisation estimates, for good and bad texts, how often each labeller says what, and so its accuracy; no
label table is read. The posterior of a pattern is the label of its texts. At most `SAMPLE_ROWS` texts train
a logistic regression on hashed features, which then scores every whole text: shares of word shapes and of
pairs of neighbouring shapes, a shape being a word with runs of letters, digits or other signs written
once. Half of them are dealt out to the patterns by their size, half so that small patterns come first;
which ones is chosen by a hash of the text, and only their features come to the driver.

Null text counts as empty. An empty table gives a score of one half to every text. Every row has its own
score, also with a missing or repeated id; other columns are not looked at.
"""

from __future__ import annotations

import re
import zlib
from collections.abc import Callable, Iterator
from functools import lru_cache
from operator import eq

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.llm.shared import stage, text_of, thinned

SAMPLE_ROWS = 3_000
FEATURES = 1 << 14
THRESHOLD = 0.5
TABLE_WORDS = 200_000

GOOD, NOTHING, BAD = 1, 0, -1


def share(part: int, whole: int) -> float:
    return part / whole if whole else 0.0


def between(value: float, good_to: float, bad_from: float) -> int:
    """Good up to the one bound, bad from the other, nothing between."""
    return GOOD if value <= good_to else BAD if value >= bad_from else NOTHING


def properties(text: str) -> dict[str, float]:
    words, lines = text.split(), [line for line in text.splitlines() if line.strip()]
    letters = sum(map(str.isalpha, text))
    return {
        "signs": share(sum(map(text.count, "*#$%&^~_=<>{}\\")), len(text)),
        "capitals": share(sum(map(str.isupper, text)), letters),
        "repetition": share(sum(map(eq, words, words[1:])), len(words) - 1),
        "variety": share(len(set(words)), min(len(words), 200)),
        "table": share(sum(map(text.count, "|\t")), len(words)),
        "words": len(words),
        "same lines": 1 - share(len(set(lines)), len(lines)) if lines else 0.0,
        "exclamation": share(text.count("!"), len(words)),
        "digits": share(sum(map(str.isdigit, text)), len(text)),
        "letters": share(letters, len(text)),
        "word length": share(sum(map(len, words)), len(words)),
    }


LABELLERS: dict[str, Callable[[dict[str, float]], int]] = {
    "signs": lambda p: between(p["signs"], 0.002, 0.02),
    "capitals": lambda p: between(p["capitals"], 0.15, 0.4),
    "repetition": lambda p: between(p["repetition"], 0.02, 0.15),
    "variety": lambda p: BAD if p["words"] >= 50 and p["variety"] < 0.25 else NOTHING,
    "table": lambda p: between(p["table"], 0.02, 0.2),
    "short": lambda p: BAD if p["words"] < 5 else NOTHING,
    "same lines": lambda p: between(p["same lines"], 0.1, 0.4),
    "exclamation": lambda p: between(p["exclamation"], 0.02, 0.2),
    "digits": lambda p: between(p["digits"], 0.05, 0.3),
    "letters": lambda p: between(1 - p["letters"], 0.22, 0.35),
    "word length": lambda p: GOOD if 3 <= p["word length"] <= 10 else BAD,
}


def votes_of(text: str) -> list[int]:
    found = properties(text)
    return [labeller(found) for labeller in LABELLERS.values()]


def pattern_of(votes: list[int]) -> int:
    number = 0
    for vote in votes:
        number = number * 3 + vote + 1
    return number


def votes_in(patterns: np.ndarray) -> np.ndarray:
    """Rows of votes from the numbers of their patterns."""
    return patterns[:, None] // 3 ** np.arange(len(LABELLERS))[::-1] % 3 - 1


def label_model(votes: np.ndarray, rounds: int = 100, counts: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
    """Posterior of a good text for each row of votes, and class x labeller x said (bad, nothing, good).

    `counts` says how many documents each row stands for, one if not given.

    It starts from the opinion that one "bad" outweighs "good", which only says which class is which.
    """
    said = np.stack([votes == value for value in (BAD, NOTHING, GOOD)], axis=2).astype(float)
    posterior = np.where((votes == BAD).any(1), 0.1, 0.9)
    for _ in range(rounds):
        weight = np.stack([1 - posterior, posterior]) * (1 if counts is None else counts)
        table = np.einsum("cn,nls->cls", weight, said) + 0.5
        table /= table.sum(2, keepdims=True)
        odds = np.log(weight[1].sum() + 1) - np.log(weight[0].sum() + 1)
        odds = odds + np.einsum("nls,ls->n", said, np.log(table[1]) - np.log(table[0]))
        new = 1 / (1 + np.exp(-np.clip(odds, -30, 30)))
        if np.abs(new - posterior).max() < 1e-6:
            break
        posterior = new
    return posterior, table


def accuracies(table: np.ndarray) -> dict[str, float]:
    """How often each labeller is right when it says something, both classes alike."""
    right = table[1, :, 2] + table[0, :, 0]
    spoken = right + table[1, :, 0] + table[0, :, 2]
    return dict(zip(LABELLERS, (right / spoken).tolist()))


class Shapes:
    """Words to numbers of their shapes; the table of words is emptied at its bound."""

    def __init__(self) -> None:
        self.table: dict[str, int] = {}

    def __call__(self, words: list[str]) -> np.ndarray:
        if len(self.table) > TABLE_WORDS:
            self.table.clear()
        get = self.table.get
        found = [get(word) for word in words]
        if None in found:
            for word in set(words):
                if word not in self.table:
                    self.table[word] = shape_number(word)
            found = [self.table[word] for word in words]
        return np.array(found, np.int64)


def letters_shape(letters: str) -> str:
    return "A" if len(letters) > 1 and letters.isupper() else "a"


def shape_number(word: str) -> int:
    bare = word.rstrip(".,")
    if bare.isalpha():  # most words; the same shape as below
        shape = letters_shape(bare) + word[len(bare) :]
    else:
        shape = re.sub(r"[^\W\d_]+", lambda m: letters_shape(m.group()), word)
        shape = re.sub(r"\d+", "9", shape)
    return zlib.crc32(re.sub(r"([^\w\s])\1+", r"\1\1", shape).encode() if len(shape) > 2 else shape.encode())


def features(text: str, shapes: Shapes) -> tuple[np.ndarray, np.ndarray]:
    """Hashed features and their values: shares of shapes, of pairs, and of words said twice running."""
    words = text.split()
    if not words:
        return np.zeros(1, np.int64), np.ones(1)
    numbers = shapes(words)
    pairs = (numbers[:-1] * 0x9E3779B1 + numbers[1:]) >> 7
    again = sum(map(eq, words, words[1:]))
    places = np.concatenate([numbers % (FEATURES - 2), pairs % (FEATURES - 2)]) + 2
    counts = np.bincount(places, minlength=FEATURES) / len(words)
    counts[1] = again / len(words)
    held = np.flatnonzero(counts)
    return held, counts[held]


def fit(texts: list[str]) -> tuple[np.ndarray, float]:
    """Weights and bias from the texts alone."""
    if not texts:
        return np.zeros(FEATURES), 0.0
    posterior, _ = label_model(np.array([votes_of(text) for text in texts]))
    shapes = Shapes()
    return fit_scorer([features(text, shapes) for text in texts], posterior)


def fit_scorer(
    rows: list[tuple[np.ndarray, np.ndarray]], posterior: np.ndarray, rounds: int = 400, rate: float = 0.5, penalty: float = 1e-4
) -> tuple[np.ndarray, float]:
    """Weights and bias from the posterior labels, by gradient steps of adapted length."""
    weights, bias = np.zeros(FEATURES), 0.0
    places, values = (np.concatenate(parts) for parts in zip(*rows))
    row = np.repeat(np.arange(len(rows)), [len(held) for held, _ in rows])
    mass = np.where(posterior > 0.5, 0.5 / max(1, (posterior > 0.5).sum()), 0.5 / max(1, (posterior <= 0.5).sum()))
    squares, bias_square = np.full(FEATURES, 1e-8), 1e-8
    for _ in range(rounds):
        margin = np.bincount(row, values * weights[places], len(rows)) + bias
        error = mass * (1 / (1 + np.exp(-np.clip(margin, -30, 30))) - posterior)
        slope = np.bincount(places, values * error[row], FEATURES) + penalty * weights
        squares, bias_square = squares + slope**2, bias_square + error.sum() ** 2
        weights, bias = weights - rate * slope / np.sqrt(squares), bias - rate * error.sum() / np.sqrt(bias_square)
    return weights, float(bias)


class Scorer:
    def __init__(self, weights: np.ndarray, bias: float):
        self.weights, self.bias, self.shapes = weights, bias, Shapes()

    def __call__(self, text: str | None) -> float:
        places, values = features(text or "", self.shapes)
        return float(1 / (1 + np.exp(-np.clip(self.weights[places] @ values + self.bias, -30, 30))))


def vote_patterns(texts: DataFrame) -> DataFrame:
    """pattern, key of each row of a table with the column text; key is a hash of the text; stored."""

    @F.arrow_udf("int")
    def pattern(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for batch in batches:
            yield pa.array([pattern_of(votes_of(one)) for one in batch.to_pylist()], pa.int32())

    return stage(texts.select(pattern(F.col("text")).alias("pattern"), F.xxhash64("text").alias("key")))


def quotas(counts: np.ndarray, rows: int) -> np.ndarray:
    """How many texts each pattern gives: half of the rows by size, half from the smallest patterns on."""
    found = np.minimum(counts, counts * (rows // 2) // max(1, counts.sum()))
    left = rows - found.sum()
    order = np.argsort(counts - found, kind="stable")
    for place, number in enumerate(order):
        more = min(counts[number] - found[number], left // (len(order) - place))
        found[number] += more
        left -= more
    return found


def picked_texts(voted: DataFrame, patterns: np.ndarray, texts: np.ndarray, rows: int) -> DataFrame:
    """pattern, key of the texts to learn from; `texts` says how many different ones a pattern has.

    Copies are one text, in what a pattern gives, in how far it is thinned and where its smallest hashes are picked.
    """
    listed = [(p, n, w) for p, n, w in zip(patterns.tolist(), texts.tolist(), quotas(texts, rows).tolist()) if w]
    quota = voted.sparkSession.createDataFrame(listed, "pattern int, n long, wanted long")
    near = voted.join(F.broadcast(quota), "pattern").where(thinned(F.col("key"), F.col("wanted"), F.col("n")))
    ranked = near.groupBy("pattern", "key").agg(F.first("wanted").alias("wanted")).withColumn(
        "rank", F.row_number().over(Window.partitionBy("pattern").orderBy(F.xxhash64("key"), "key"))
    )
    return ranked.where(F.col("rank") <= F.col("wanted")).select("pattern", "key")


def train(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> tuple[np.ndarray, float]:
    """The driver gets the counts of the patterns and the features of the bounded sample, nothing else."""
    texts = docs.select(text_of(F.col(text_col)).alias("text"))
    voted = vote_patterns(texts)
    rows = voted.groupBy("pattern").agg(F.count("*").alias("n"), F.approx_count_distinct("key").alias("texts")).collect()
    if not rows:
        return np.zeros(FEATURES), 0.0
    rows.sort(key=lambda row: row["pattern"])
    patterns, counts, texts_of = (np.array([row[name] for row in rows], np.int64) for name in ("pattern", "n", "texts"))
    posterior, _ = label_model(votes_in(patterns), counts=counts)
    picked = picked_texts(voted, patterns, texts_of, SAMPLE_ROWS)

    def featured(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shapes, seen = Shapes(), set()
        for batch in batches:
            for pattern, key, text in zip(*(column.to_pylist() for column in batch.columns)):
                if key in seen:
                    continue
                seen.add(key)  # one of SAMPLE_ROWS at most
                places, values = features(text, shapes)
                columns = [[pattern], [key], [places.astype(np.int32).tobytes()], [values.tobytes()]]
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types)], ["pattern", "key", "places", "values"])

    types = [pa.int32(), pa.int64(), pa.binary(), pa.binary()]
    sampled = texts.withColumn("key", F.xxhash64("text")).join(F.broadcast(picked), "key").select("pattern", "key", "text")
    found = sampled.mapInArrow(featured, "pattern int, key long, places binary, values binary")
    one = found.groupBy("pattern", "key").agg(F.min(F.struct("places", "values")).alias("held")).collect()
    one.sort(key=lambda row: (row["pattern"], row["key"]))
    labels = posterior[np.searchsorted(patterns, [row["pattern"] for row in one])]
    held = [row["held"] for row in one]
    return fit_scorer([(np.frombuffer(h["places"], np.int32), np.frombuffer(h["values"])) for h in held], labels)


@lru_cache(maxsize=2)
def _scorer(model: Broadcast) -> Scorer:
    return Scorer(*model.value)


def scores(text: Column, model: Broadcast) -> Column:
    """How likely a text is good, 0 to 1. `model` is a broadcast result of `train`."""

    @F.arrow_udf("double")
    def score(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        scorer = _scorer(model)
        for batch in batches:
            yield pa.array([scorer(one) for one in batch.to_pylist()], pa.float64())

    return score(text)


def quality(docs: DataFrame, threshold: float = THRESHOLD, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, score, kept: one row for each row of `docs`."""
    model = docs.sparkSession.sparkContext.broadcast(train(docs, id_col, text_col))
    scored = docs.select(F.col(id_col).alias("doc_id"), scores(F.col(text_col), model).alias("score"))
    return scored.withColumn("kept", F.col("score") >= threshold)
