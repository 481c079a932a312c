"""Toxicity by weak supervision: voters, a generative label model, and a linear classifier.

A bounded sample of labelled training rows (at most `SAMPLE_ROWS` of each label, chosen by a hash of the
id) is the only thing the model learns from.

* Lexicon voters: for whole words and for word beginnings of several lengths, and for either half of the
  sample, the few entries that cover the toxic texts: greedily the one that most texts still lack, until
  each text is covered several times. Pattern voters look at how a text is written.
* Label model: two classes, within which votes have a mean each (a voter's accuracy) and a common
  covariance (their correlations); expectation-maximisation fits both, without the labels. Voters that
  always agree thus count as little more than one.
* Classifier: logistic regression on the presence of words and word beginnings, trained on the
  posterior labels with an L1 penalty, so that few entries have a weight.

Labels, lang, source and doc_id are never inputs of a score. A doc_id that is labelled more than once is
toxic if one label says so; null labels and labels of missing documents are not used. With labels of
one kind only every score is (all but) that label, without labels zero. Null text counts as empty. Every row has
its own score, also with a missing or repeated id; further columns are not looked at.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterable, Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.shared import fold, text_of, thinned

#: Labelled rows of either label that the model is fitted on, at most.
SAMPLE_ROWS = 2_000

#: Remainder of crc32(doc_id) modulo FOLDS of the rows that are not learned from.
FOLDS, HELD_OUT = 3, 1

THRESHOLD = 0.7

#: Lengths of the word beginnings that are looked at beside whole words.
BEGINNINGS = (4, 5, 6, 7)

#: How often a lexicon is to cover each text, and how much more frequent (as a logarithm) an entry must
#: be in toxic texts.
COVER, LOG_ODDS = 6, 2.5

#: Share that the toxic texts have in the fit of the classifier, whatever their share in the sample.
TOXIC_MASS = 0.3

#: Entries with the widest cover that a lexicon is chosen from.
CANDIDATES = 300

#: Entries the classifier chooses from, and its penalty, which is higher the more words an entry fits.
ENTRIES, PENALTY = 1_000, 2e-5

#: Words after which a task's table of known words is emptied.
TABLE_WORDS = 300_000

find_words = re.compile(r"[^\W\d_]+").findall

PATTERNS = {
    "shouting": lambda text: sum(map(str.isupper, text)) > 0.5 * sum(map(str.isalpha, text)),
    "exclaiming": lambda text: "!!" in text,
    "masked": lambda text: re.search(r"[^\W\d_][*#@$]+[^\W\d_]", text) is not None,
    "drawn out": lambda text: re.search(r"([^\W\d_])\1\1\1", text) is not None,
}


def support(texts: int) -> int:
    """In how many of so many toxic texts an entry must be."""
    return max(4, min(8, texts // 50))


def entries(word: str) -> list[str]:
    """A word as `=word` and its beginnings, up to the whole of it, as they are."""
    return ["=" + word, *(word[:n] for n in BEGINNINGS if n <= len(word))]


def entries_of(text: str) -> set[str]:
    """The entries of all words, and `beginning+` for beginnings of at least two different words."""
    counts = Counter(entry for word in set(find_words(text.lower())) for entry in entries(word))
    return set(counts) | {entry + "+" for entry, n in counts.items() if n > 1}


def kind_of(entry: str) -> str:
    return "words" if entry[0] == "=" else "repeated beginnings" if entry[-1] == "+" else f"beginnings of {len(entry)}"


KINDS = ["words", "repeated beginnings", *(f"beginnings of {n}" for n in BEGINNINGS)]

#: Times the penalty of a whole word.
BREADTH = dict(zip(KINDS, (1, 4, 8, 4, 3, 2)))


@dataclass
class Model:
    weights: dict[str, float] = field(default_factory=dict)
    bias: float = -50.0
    voters: list[str] = field(default_factory=list)
    accuracy: np.ndarray | None = None  # voter -> share of right votes on toxic, and on other texts
    correlation: np.ndarray | None = None  # of the votes within a class

    def __post_init__(self) -> None:
        self.wanted = {entry.rstrip("+") for entry in self.weights}
        self.table: dict[str, tuple[str, ...]] = {}

    def score(self, text: str | None) -> float:
        found: dict[str, int] = {}
        for word in set(find_words((text or "").lower())):
            hits = self.table.get(word)
            if hits is None:
                if len(self.table) > TABLE_WORDS:
                    self.table.clear()
                hits = self.table[word] = tuple(entry for entry in entries(word) if entry in self.wanted)
            for entry in hits:
                found[entry] = found.get(entry, 0) + 1
        weight = self.weights.get
        parts = [weight(entry, 0.0) + (weight(entry + "+", 0.0) if n > 1 else 0.0) for entry, n in sorted(found.items())]
        return float(sigmoid(self.bias + sum(parts)))


def sigmoid(x):
    return 1 / (1 + np.exp(-np.clip(x, -50, 50)))


class Sample:
    """Texts as the numbers of their entries, of those entries only that enough texts have."""

    def __init__(self, texts: list[str]):
        self.texts = texts
        number: dict[str, int] = {}
        held = [np.array([number.setdefault(e, len(number)) for e in entries_of(text)], np.int64) for text in texts]
        counts = np.bincount(np.concatenate(held), minlength=len(number))
        kept = [(e, i) for e, i in number.items() if support(0) <= counts[i] < len(texts)]
        self.entries = sorted(e for e, _ in kept)
        place = {entry: at for at, entry in enumerate(self.entries)}
        places = np.full(len(number), -1)
        for entry, i in kept:
            places[i] = place[entry]
        self.held = [np.sort(some[some >= 0]) for some in (places[numbers] for numbers in held)]
        self.kinds = np.array([KINDS.index(kind_of(entry)) for entry in self.entries], np.int64)

    def counts(self, rows: np.ndarray) -> np.ndarray:
        """How many of the texts have each entry."""
        some = [self.held[row] for row in rows]
        return np.bincount(np.concatenate(some) if some else [], minlength=len(self.entries)).astype(float)

    def lexicon(self, positive: np.ndarray, negative: np.ndarray, kind: int) -> list[int]:
        """Entries of a kind that together cover the positive texts, the one that most still lack first."""
        here, there = self.counts(positive), self.counts(negative)
        odds = np.log(here + 0.5) - np.log(there + 0.5) + np.log(len(negative) + 1) - np.log(len(positive) + 1)
        strong = np.flatnonzero((self.kinds == kind) & (here >= support(len(positive))) & (odds > LOG_ODDS))
        widest = sorted(strong, key=lambda e: (-here[e], -len(self.entries[e]), self.entries[e]))[:CANDIDATES]
        place = {entry: i for i, entry in enumerate(widest)}
        inside = np.zeros((len(positive), len(widest)), bool)
        for i, row in enumerate(positive):
            inside[i, [place[e] for e in self.held[row] if e in place]] = True
        lacking, chosen, least = np.full(len(positive), COVER), [], max(support(len(positive)), len(positive) // 200)
        while widest:
            gain = inside[lacking > 0].sum(0)
            best = int(gain.argmax())
            if gain[best] < least:
                break
            chosen.append(int(widest[best]))
            lacking[inside[:, best]] -= 1
            inside[:, best] = False
        return chosen


def voters(sample: Sample, toxic: np.ndarray) -> tuple[list[str], np.ndarray]:
    """Names, and a row of votes (1 toxic, 0 not) for each text; lexicon voters come first."""
    names, votes = [], []
    for half in (0, 1):
        rows = np.arange(half, len(toxic), 2)
        for kind, name in enumerate(KINDS):
            listed = sample.lexicon(rows[toxic[rows] == 1], rows[toxic[rows] == 0], kind)
            names.append(f"{name}, half {half}")
            votes.append([np.isin(held, listed).any() for held in sample.held])
    for name, pattern in PATTERNS.items():
        names.append(name)
        votes.append([pattern(text) for text in sample.texts])
    return names, np.array(votes, float).T


def label_model(votes: np.ndarray, start: np.ndarray, rounds: int = 60) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Posterior of class 1 for each row of votes, the votes' means by class, and their correlations.

    Expectation-maximisation from the posterior `start`. Means are drawn a little towards one half and
    the covariance towards independence, so that voters who never or always vote do no harm.
    """
    posterior = np.clip(start, 0.02, 0.98)
    for _ in range(rounds):
        weight = np.stack([1 - posterior, posterior])
        means = (weight @ votes + 0.5) / (weight.sum(1, keepdims=True) + 1)
        spread = sum((w[:, None] * (votes - m)).T @ (votes - m) for w, m in zip(weight, means)) / len(votes)
        shrunk = 0.9 * spread + 0.1 * np.diag(np.diag(spread)) + 0.01 * np.eye(len(spread))
        slope = np.linalg.solve(shrunk, means[1] - means[0])
        prior = np.log(weight[1].sum() + 1) - np.log(weight[0].sum() + 1)
        new = sigmoid((votes - means.mean(0)) @ slope + prior)
        if np.abs(new - posterior).max() < 1e-6:
            break
        posterior = new
    scale = np.sqrt(np.diag(shrunk))
    return posterior, means, shrunk / np.outer(scale, scale)


def sparse_logistic(x: np.ndarray, y: np.ndarray, mass: np.ndarray, penalty: np.ndarray, rounds: int = 400) -> tuple[np.ndarray, float]:
    """Weights and bias by accelerated proximal gradient steps; `y` are probabilities, `mass` adds up to 1."""
    x = np.hstack([x, np.ones((len(x), 1), x.dtype)])
    mass = mass.astype(x.dtype)
    vector = np.ones(x.shape[1], x.dtype)
    for _ in range(20):  # the largest curvature, by the power method
        vector = x.T @ (mass * (x @ vector))
        size = np.linalg.norm(vector)
        vector /= size
    step = 4 / size
    w = ahead = np.zeros(x.shape[1], x.dtype)
    momentum = 1.0
    for _ in range(rounds):
        moved = ahead - step * (x.T @ (mass * (sigmoid(x @ ahead) - y)))
        moved[:-1] = np.sign(moved[:-1]) * np.maximum(np.abs(moved[:-1]) - step * penalty, 0)
        further = (1 + np.sqrt(1 + 4 * momentum**2)) / 2
        ahead = moved + (momentum - 1) / further * (moved - w)
        w, momentum = moved, further
    return w[:-1], float(w[-1])


def fit(texts: Iterable[str | None], toxic: Iterable[int]) -> Model:
    """A model from labelled texts."""
    pairs = sorted({(text or "", int(label)) for text, label in zip(texts, toxic)})
    texts, toxic = [text for text, _ in pairs], np.array([label for _, label in pairs])
    if len(set(toxic.tolist())) < 2:
        return Model(bias=50.0 if toxic.any() else -50.0)
    sample = Sample(texts)
    names, votes = voters(sample, toxic)
    known = votes[:, : -len(PATTERNS)].mean(1)
    posterior, means, correlation = label_model(votes, known > 0.25)

    likely, others = np.flatnonzero(posterior > 0.5), np.flatnonzero(posterior <= 0.5)
    here, there = sample.counts(likely), sample.counts(others)
    both = (here + there) / len(texts)
    apart = np.abs(here / max(1, len(likely)) - there / max(1, len(others))) / np.sqrt(both * (1 - both) + 1e-9)
    chosen = np.sort(np.argsort(-apart, kind="stable")[:ENTRIES])
    x = np.zeros((len(texts), len(chosen)), np.float32)
    for row, held in enumerate(sample.held):
        x[row, np.isin(chosen, held)] = 1
    mass = np.where(toxic == 1, TOXIC_MASS / toxic.sum(), (1 - TOXIC_MASS) / (1 - toxic).sum())
    penalty = PENALTY * np.array([BREADTH[KINDS[kind]] for kind in sample.kinds[chosen]], np.float32)
    weights, bias = sparse_logistic(x, posterior, mass, penalty)
    kept = {sample.entries[entry]: float(w) for entry, w in zip(chosen, weights) if abs(w) > 1e-4}
    return Model(kept, bias, names, np.stack([means[1], 1 - means[0]]), correlation)


def training_labels(labels: DataFrame) -> DataFrame:
    """doc_id, toxic (0 or 1) of the rows that may be learned from."""
    known = labels.where(F.col("doc_id").isNotNull() & F.col("toxic").isNotNull())
    usable = known.where(fold(F.col("doc_id"), FOLDS) != HELD_OUT)
    return usable.groupBy("doc_id").agg((F.max("toxic") > 0).cast("int").alias("toxic"))


def train(
    docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", rows: int = SAMPLE_ROWS
) -> Model:
    """Fit on at most `rows` texts of each label, those with the smallest hashes of their ids.

    The driver gets this bounded sample and the number of labels of either kind, nothing else.
    """
    usable = training_labels(labels)
    order = [F.xxhash64(F.col("doc_id")), F.col("doc_id")]
    counts = {row["toxic"]: row["count"] for row in usable.groupBy("toxic").count().collect()}
    picked = [
        usable.where((F.col("toxic") == label) & thinned(F.col("doc_id"), rows, counts.get(label, 0)))
        .orderBy(*order)
        .limit(rows)
        for label in (0, 1)
    ]
    texts = docs.select(F.col(id_col).alias("doc_id"), text_of(F.col(text_col)).alias("text"))
    sample = texts.join(F.broadcast(picked[0].unionByName(picked[1])), "doc_id").select("text", "toxic").distinct()
    found = sample.limit(2 * rows).collect()
    return fit([row["text"] for row in found], [row["toxic"] for row in found])


def scores(text: Column, model: Model) -> Column:
    """How likely a text is toxic, 0 to 1."""

    @F.arrow_udf("double")
    def score(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for batch in batches:
            yield pa.array([model.score(one) for one in batch.to_pylist()], pa.float64())

    return score(text)


def toxicity(
    docs: DataFrame, labels: DataFrame, threshold: float = THRESHOLD, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """doc_id, held_out, score, predicted: one row for each row of `docs`."""
    model = train(docs, labels, id_col, text_col)
    scored = docs.select(
        F.col(id_col).alias("doc_id"),
        (fold(F.col(id_col), FOLDS) == HELD_OUT).alias("held_out"),
        scores(F.col(text_col), model).alias("score"),
    )
    return scored.withColumn("predicted", (F.col("score") >= threshold).cast("int"))
