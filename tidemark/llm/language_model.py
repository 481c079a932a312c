"""Language-model scores: a log-bilinear neural model beside add-one unigrams.

Tokens are ASCII-lower-cased runs of anything but ASCII white space, and one end for each text.

* Ids. Texts are split into words twice: to count them, and to store every text as the ids of its tokens with
  the words that have none. Runs, training and scores read the ids.
* Counts. Every task counts the words of its training texts in tables of bounded size; the sums over all
  of them are stored. Neither the words nor their counts ever come together in one place, but for the
  `HOT_WORDS` most frequent ones, which are sent to all tasks.
* Classes. The most frequent words are classes of their own; other words belong to the class of their
  ending (its last letters and sign), if that is among the most frequent endings, or to the rest. All
  training texts are counted as runs of three classes, of which there are CLASSES ** 3 at most.
* Classes' model. The two classes before a token are embedded, each through a matrix for its place; the sum
  is compared with an embedding of every class. It is trained in numpy by noise-contrastive estimation on
  those counts and gives the table of log-probabilities that the words' model starts from.
* Words' model. Every frequent word has embeddings of its own, as a word before and as a word that follows;
  the other words of a class share one. The words of a class are dealt out in blocks of at most BLOCK. A
  token's probability is its class's, times its block's in the class, times its own in the block, each
  normalised by a matrix product over all classes, blocks or words there are; a word that is not frequent
  has its share of the others of its class, with one count added to every word, and one for all never
  seen. It is trained by noise-contrastive estimation on every training token: tasks train on their texts,
  and the mean of their moves, weighted by how often each row moved, is the start of the next round. Means
  are taken of at most GROUP tasks first and then of these means.

Scores of a text need the count of each of its words: frequent words are known to the task, the others
are joined with the stored counts, by word and then by text. A word of these is never a frequent one and
a text has only its own, so no task gets more than its share.

Null text counts as empty, which is one end. Every row has its own result, also with a missing or
repeated id; other columns are not looked at. Without training texts every token has the base score 0.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass
from functools import cached_property, lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import Broadcast
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.shared import fold, stage

FOLDS, HELD_OUT = 7, 2

#: Words whose counts are sent to all tasks, and words a task counts before it hands its counts on.
HOT_WORDS, TABLE_WORDS = 100_000, 200_000

#: Words and endings with a class of their own; there is one more class for all other words.
WORD_CLASSES, ENDING_CLASSES = 48, 48

#: Embedding, noise words for each batch, batch, steps and step length of the training.
WIDTH, NOISE, BATCH, STEPS, RATE = 24, 64, 1024, 1500, 0.05

#: Words that are normalised together; rounds of the words' training, each on its part of the texts; noise of
#: each of its batches; tokens taken at a time; rows of a matrix that tasks hand on together; tasks whose
#: moves are averaged first. Training draws every token once, and small inputs several times, until there are
#: STEPS batches.
BLOCK, ROUNDS, WORD_NOISE, PIECE, ROWS, GROUP = 128, 2, 32, 1 << 18, 512, 64

#: Rows of scores that are normalised at a time, so that they stay in a core's cache.
STRIP = 2048

END = b""  # no word is empty
LN10 = np.log(10)

find_ending = re.compile(rb"([^\x00-\x2f\x3a-\x40\x5b-\x60\x7b-\x7f]{0,2})([\x21-\x2f\x3a-\x40\x5b-\x60\x7b-\x7e]?)[\x21-\x2f\x3a-\x40\x5b-\x60\x7b-\x7e]*\Z")


def words_of(texts: pa.Array) -> tuple[np.ndarray, pa.Array, np.ndarray]:
    """The words of some texts one after the other, as places in a list of different words, and where each text's begin.

    The bounds have the end of the last text as well.
    """
    split = pc.ascii_split_whitespace(pc.ascii_lower(pc.fill_null(texts, "")))
    flat = pc.list_flatten(split).dictionary_encode()
    places = flat.indices.to_numpy()
    lengths = pc.list_value_length(split).to_numpy()
    bounds = np.concatenate([[0], np.cumsum(lengths, dtype=np.int64)])
    nothing = pc.index(flat.dictionary, pa.scalar("", flat.dictionary.type)).as_py()
    if nothing >= 0:  # white space at the ends of a text leaves an empty string there
        real = places != nothing
        bounds = np.concatenate([[0], np.cumsum(real, dtype=np.int64)])[bounds]
        places = places[real]
    return places, flat.dictionary.cast(pa.binary()), bounds


def ending(word: bytes) -> bytes:
    found = find_ending.search(word[-16:])
    return found[1] + b" " + found[2] if found else b" "


LETTER, SIGN = (
    np.array([bool(re.match(kind, bytes([byte]))) for byte in range(256)])
    for kind in (rb"[^\x00-\x2f\x3a-\x40\x5b-\x60\x7b-\x7f]", rb"[\x21-\x2f\x3a-\x40\x5b-\x60\x7b-\x7e]")
)


def endings_of(words: pa.Array) -> np.ndarray:
    """What `ending` finds, as a number for each word: two letters and a sign, zero for each that is missing."""
    words = pc.binary_slice(words, -16)
    bounds = np.frombuffer(words.buffers()[1], np.int32, len(words) + 1, 4 * words.offset).astype(np.int64)
    held = np.concatenate([np.zeros(2, np.uint8), np.frombuffer(words.buffers()[2] or b"", np.uint8), np.zeros(1, np.uint8)])
    begins, ends = bounds[:-1] + 2, bounds[1:] + 2  # of words in `held`, in which bytes stand before the first and after the last
    last, some = ends.copy(), np.arange(len(ends))
    while len(some := some[(last[some] > begins[some]) & SIGN[held[last[some] - 1]]]):
        last[some] -= 1
    sign = np.where(last < ends, held[last], 0).astype(np.int64)
    one = np.where((last > begins) & LETTER[held[last - 1]], held[last - 1], 0).astype(np.int64)
    two = np.where((one > 0) & (last - 1 > begins) & LETTER[held[last - 2]], held[last - 2], 0).astype(np.int64)
    return two << 16 | one << 8 | sign


def count_words(texts: DataFrame) -> DataFrame:
    """word, count of a table with the one column text; stored."""

    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        schema = pa.schema([("word", pa.binary()), ("n", pa.int64())])
        held, ends = [], 0

        def handed_on() -> Iterator[pa.RecordBatch]:
            table = pa.Table.from_batches(held, schema)
            if len(held) > 1:
                table = table.group_by("word", use_threads=False).aggregate([("n", "sum")]).select(["word", "n_sum"])
            held.clear()
            return iter(table.rename_columns(["word", "n"]).to_batches())

        for batch in batches:
            places, words, _ = words_of(batch.column(0))
            times = np.bincount(places, minlength=len(words))
            ends += len(batch)
            some = np.flatnonzero(times)
            held.append(pa.RecordBatch.from_arrays([words.take(pa.array(some)), pa.array(times[some])], schema=schema))
            if sum(map(len, held)) > TABLE_WORDS:
                yield from handed_on()
        if ends:
            held.append(pa.RecordBatch.from_arrays([pa.array([END], pa.binary()), pa.array([ends])], schema=schema))
        yield from handed_on()

    parts = texts.mapInArrow(counted, "word binary, n long")
    return stage(parts.groupBy("word").agg(F.sum("n").alias("count")))


@dataclass
class Words:
    """What tasks know of words: ids and counts of the frequent ones, and everybody's class."""

    ids: dict[bytes, int]
    counts: np.ndarray
    own: int  # the first words have a class each, in order
    endings: dict[bytes, int]

    def __post_init__(self) -> None:
        self.classes = self.own + len(self.endings) + 1
        later = [self.by_ending(word) for word in list(self.ids)[self.own :]]
        self.class_of_hot = np.array([*range(self.own), *later], np.int64)
        self.class_of_symbol = np.concatenate([self.class_of_hot, np.arange(self.classes)])
        self.logs = np.log10(self.counts + 1.0)

    def by_ending(self, word: bytes) -> int:
        return self.endings.get(ending(word), self.classes - 1)

    def class_of(self, word: bytes) -> int:
        number = self.ids.get(word)
        return self.by_ending(word) if number is None else int(self.class_of_hot[number])

    @cached_property
    def lists(self) -> tuple[pa.Array, np.ndarray, np.ndarray]:
        """The frequent words; the endings with a class of their own as numbers in order, and their classes."""
        # A word made of an ending's letters and sign has that ending.
        numbers = endings_of(pa.array([letters + sign for letters, sign in (e.rsplit(b" ", 1) for e in self.endings)], pa.binary()))
        order = np.argsort(numbers)
        return pa.array(list(self.ids), pa.binary()), numbers[order], np.array(list(self.endings.values()), np.int64)[order]

    def classify(self, words: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Numbers of the words, -1 for those that are not frequent, and classes."""
        hot, endings, of_endings = self.lists
        numbers = pc.fill_null(pc.index_in(words, hot), -1).to_numpy().astype(np.int64)
        classes = self.class_of_hot[numbers] if len(hot) else np.zeros(len(words), np.int64)
        rare = np.flatnonzero(numbers < 0)
        found = endings_of(words.take(pa.array(rare)))
        classes[rare] = self.classes - 1
        if len(endings):
            at = np.minimum(np.searchsorted(endings, found), len(endings) - 1)
            known = endings[at] == found
            classes[rare[known]] = of_endings[at[known]]
        return numbers, classes


def know_words(counts: DataFrame) -> Words:
    """The bounded list of frequent words comes to the driver, the end first.

    How many words have which count, in steps of a twelfth, says from which count on there are at most
    HOT_WORDS; only these words leave their tasks.
    """
    words = counts.where(F.octet_length("word") > 0)
    steps = words.groupBy(F.floor(F.log2("count") * 8).alias("step")).agg(
        F.count("*").alias("words"), F.min("count").alias("least")
    )
    least, found = None, 0
    for row in sorted(steps.collect(), key=lambda row: -row["step"]):
        found += row["words"]
        if found > HOT_WORDS:
            break
        least = row["least"]
    frequent = words.where(F.col("count") >= least).select("word", "count").toArrow() if least is not None else None
    listed = zip(*(column.to_pylist() for column in frequent.columns)) if frequent else []
    ends = [row["count"] for row in counts.where(F.octet_length("word") == 0).collect()]
    found = [(END, count) for count in ends] + sorted(listed, key=lambda pair: (-pair[1], pair[0]))
    own = min(len(found), WORD_CLASSES)
    endings: Counter[bytes] = Counter()
    for word, count in found[own:]:
        endings[ending(word)] += count
    chosen = sorted(endings, key=lambda e: (-endings[e], e))[:ENDING_CLASSES]
    numbers = np.array([count for _, count in found], np.int64)
    return Words({word: i for i, (word, _) in enumerate(found)}, numbers, own, {e: own + i for i, e in enumerate(chosen)})


@lru_cache(maxsize=2)
def _known(shared: Broadcast):
    return shared.value


def class_sizes(counts: DataFrame, words: Broadcast, classes: int) -> np.ndarray:
    """class x (tokens, words) over all counts."""

    def summed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known, total = _known(words), np.zeros((classes, 2), np.int64)
        for batch in batches:
            _, found = known.classify(batch.column(0))
            n = batch.column(1).to_numpy()
            total[:, 0] += np.bincount(found, n, classes).astype(np.int64)
            total[:, 1] += np.bincount(found, minlength=classes)
        columns = [pa.array(np.arange(classes)), pa.array(total[:, 0]), pa.array(total[:, 1])]
        yield pa.RecordBatch.from_arrays(columns, ["class", "n", "words"])

    parts = counts.select("word", "count").mapInArrow(summed, "class long, n long, words long")
    sizes = np.zeros((classes, 2), np.int64)
    for row in parts.groupBy("class").agg(F.sum("n").alias("n"), F.sum("words").alias("words")).collect():
        sizes[row["class"]] = row["n"], row["words"]
    return sizes


def two_before(values: np.ndarray, firsts: np.ndarray, start: int) -> tuple[np.ndarray, np.ndarray]:
    """The two values before each token of texts one after the other; `start` stands before every text."""
    one, two = np.roll(values, 2), np.roll(values, 1)
    two[firsts] = start
    one[firsts] = start
    one[firsts[firsts + 1 < len(values)] + 1] = start
    return one, two


def contexts(classes: np.ndarray, start: int, firsts: np.ndarray | None = None) -> np.ndarray:
    """Two classes before each token, as places in a square table; one text, unless the texts' firsts are given."""
    one, two = two_before(classes, np.zeros(1, np.int64) if firsts is None else firsts, start)
    return one * (start + 1) + two


#: Texts as ids: symbols are four bytes a token, rare words those without an id of their own.
ENCODED = "row long, doc_id long, learnt boolean, symbols binary, rare array<binary>, times array<long>"


def encode_documents(docs: DataFrame, words: Broadcast, id_col: str, text_col: str) -> DataFrame:
    """ENCODED of every row; stored."""

    def encoded(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = _known(words)
        hot = len(known.ids)
        end = known.ids.get(END, hot + known.by_ending(END))
        for batch in batches:
            places, different, bounds = words_of(batch.column(3))
            numbers, classes = known.classify(different)
            symbol_of = np.where(numbers < 0, hot + classes, numbers).astype(np.int32)
            # An end after each text's last word.
            symbols = np.insert(symbol_of[places], bounds[1:], np.int32(end))
            bytes_at = pa.py_buffer((4 * (bounds + np.arange(len(bounds)))).astype(np.int32))
            # The rare words of each text, and how often it has them.
            at = np.flatnonzero(numbers[places] < 0)
            row = np.searchsorted(bounds, at, side="right") - 1
            pairs, times = np.unique(row * len(different) + places[at], return_counts=True)
            rows, rare = np.divmod(pairs, max(1, len(different)))
            ends = pa.array(np.searchsorted(rows, np.arange(len(bounds))).astype(np.int32))
            lists = [pa.ListArray.from_arrays(ends, values) for values in (different.take(pa.array(rare)), pa.array(times))]
            stored = pa.Array.from_buffers(pa.binary(), len(batch), [None, bytes_at, pa.py_buffer(symbols)])
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[:3], stored, *lists], ["row", "doc_id", "learnt", "symbols", "rare", "times"]
            )

    numbered = docs.select(
        F.monotonically_increasing_id().alias("row"),
        F.col(id_col).cast("long").alias("doc_id"),
        (fold(F.col(id_col), FOLDS) != HELD_OUT).alias("learnt"),
        F.col(text_col).alias("text"),
    )
    return stage(numbered.mapInArrow(encoded, ENCODED), "zstd")


def portions(batches: Iterator[pa.RecordBatch], size: int) -> Iterator[tuple[list[tuple], np.ndarray, np.ndarray]]:
    """Other columns of some texts, their symbols (the last column) one after the other, and where each text begins."""
    held, rows, found = [], [], 0
    for batch in batches:
        columns = [column.to_pylist() for column in batch.columns]
        for *row, symbols in zip(*columns):
            rows.append(tuple(row))
            held.append(np.frombuffer(symbols, np.int32))
            found += len(held[-1])
            if found > size:
                yield rows, np.concatenate(held), np.cumsum([0, *map(len, held[:-1])])
                held, rows, found = [], [], 0
    if held:
        yield rows, np.concatenate(held), np.cumsum([0, *map(len, held[:-1])])


def count_runs(encoded: DataFrame, words: Broadcast, classes: int) -> DataFrame:
    """context, class, n: runs of three classes in a table with the one column symbols."""
    side = classes + 1

    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        of_symbol = _known(words).class_of_symbol
        total = np.zeros(side * side * classes, np.int64)
        for _, symbols, firsts in portions(batches, 1 << 20):
            found = of_symbol[symbols]
            total += np.bincount(contexts(found, classes, firsts) * classes + found, minlength=len(total))
        held = np.flatnonzero(total)
        for at in range(0, len(held), 1 << 16):
            some = held[at : at + (1 << 16)]
            columns = [pa.array(some // classes), pa.array(some % classes), pa.array(total[some])]
            yield pa.RecordBatch.from_arrays(columns, ["context", "class", "n"])

    parts = encoded.mapInArrow(counted, "context long, class long, n long")
    return parts.groupBy("context", "class").agg(F.sum("n").alias("n"))


class LogBilinear:
    """Classes from the two classes before."""

    def __init__(self, classes: int, seed: int = 7):
        draw = np.random.default_rng(seed)
        self.classes = classes
        self.before = draw.normal(0, 0.1, (classes + 1, WIDTH))  # one more for the start of a text
        self.places = np.stack([np.eye(WIDTH) * 0.5, np.eye(WIDTH)]) + draw.normal(0, 0.01, (2, WIDTH, WIDTH))
        self.after = draw.normal(0, 0.1, (classes, WIDTH))
        self.bias = np.zeros(classes)

    def predicted(self, one: np.ndarray, two: np.ndarray) -> np.ndarray:
        return self.before[one] @ self.places[0] + self.before[two] @ self.places[1]

    def fit(self, context: np.ndarray, following: np.ndarray, counts: np.ndarray, seed: int = 7) -> None:
        """Noise-contrastive estimation: tell a following class from classes drawn by their frequency."""
        draw = np.random.default_rng(seed)
        noise = (np.bincount(following, counts, self.classes) + 1) / (counts.sum() + self.classes)
        self.bias = np.log(noise)
        usual = np.log(NOISE * noise)
        ends = np.cumsum(counts)
        names = ("before", "places", "after", "bias")
        squares = {name: np.full_like(getattr(self, name), 1e-6) for name in names}
        for _ in range(STEPS):
            picked = np.searchsorted(ends, draw.integers(0, ends[-1], BATCH), side="right")
            one, two = np.divmod(context[picked], self.classes + 1)
            right, wrong = following[picked], draw.choice(self.classes, NOISE, p=noise)
            hidden = self.predicted(one, two)
            true = 1 / (1 + np.exp(self.bias[right] + (hidden * self.after[right]).sum(1) - usual[right]))
            false = -1 / (1 + np.exp(-(hidden @ self.after[wrong].T + self.bias[wrong] - usual[wrong])))
            slope = true[:, None] * self.after[right] + false @ self.after[wrong]
            moves = {name: np.zeros_like(getattr(self, name)) for name in names}
            np.add.at(moves["after"], right, true[:, None] * hidden)
            np.add.at(moves["after"], wrong, false.T @ hidden)
            np.add.at(moves["bias"], right, true)
            np.add.at(moves["bias"], wrong, false.sum(0))
            for place, classes in enumerate((one, two)):
                moves["places"][place] = self.before[classes].T @ slope
                np.add.at(moves["before"], classes, slope @ self.places[place].T)
            for name in names:
                move = moves[name] / BATCH
                squares[name] += move**2
                getattr(self, name)[...] += RATE * move / np.sqrt(squares[name])

    def table(self) -> np.ndarray:
        """context x class: log10 probabilities that add up to one in every context."""
        side = self.classes + 1
        one, two = np.divmod(np.arange(side * side), side)
        scores = self.predicted(one, two) @ self.after.T + self.bias
        top = scores.max(1, keepdims=True)
        return ((scores - top - np.log(np.exp(scores - top).sum(1, keepdims=True))) / LN10).astype(np.float32)


def class_table(counted: DataFrame, classes: int) -> np.ndarray:
    """Log-probabilities of classes in their contexts, of a network fitted to the counted runs."""
    runs = counted.toArrow()  # at most (classes + 1) ** 2 * classes rows
    network = LogBilinear(classes)
    if runs.num_rows:
        order = np.lexsort((runs["class"].to_numpy(), runs["context"].to_numpy()))
        network.fit(*(runs[name].to_numpy()[order] for name in ("context", "class", "n")))
    return network.table()


class Symbols:
    """Frequent words, and for each class its other words as one: by class, in blocks of at most BLOCK.

    Classes of one word have no blocks.
    """

    def __init__(self, words: Words, sizes: np.ndarray):
        self.classes, self.hot = words.classes, len(words.ids)
        of_class = np.concatenate([words.class_of_hot, np.arange(words.classes)])
        counted = np.bincount(words.class_of_hot, words.counts + 1.0, words.classes)
        self.others = np.maximum(sizes.sum(1) + 1.0 - counted, 1.0)
        mass = np.concatenate([words.counts + 1.0, self.others])
        blocked = np.flatnonzero(of_class >= words.own)
        order = blocked[np.lexsort((-mass[blocked], of_class[blocked]))]
        first = np.searchsorted(of_class[order], of_class[order])
        starts = (np.arange(len(order)) - first) % BLOCK == 0
        self.row = len(order) + of_class  # of symbols without a row: after all rows, by class
        self.row[order] = np.arange(len(order))
        self.block = np.cumsum(starts) - 1  # of a row
        self.rows = np.append(np.flatnonzero(starts), len(order))  # bounds of the blocks
        self.mass = mass[order]
        self.block_mass = np.add.reduceat(self.mass, self.rows[:-1])
        self.blocks = np.searchsorted(of_class[order][starts], np.arange(words.classes + 1))  # bounds of the classes
        self.class_mass = np.bincount(of_class, mass, words.classes)

    def of(self, numbers: np.ndarray, classes: np.ndarray) -> np.ndarray:
        return np.where(numbers >= 0, numbers, self.hot + classes)


def added(rows: np.ndarray, values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Different rows, and the sum of the values of each; rows that come once are not summed."""
    bits = len(rows).bit_length()
    keys = rows << bits | np.arange(len(rows))
    keys.sort()
    sorted_rows, order = keys >> bits, keys & ((1 << bits) - 1)
    first = np.append(True, sorted_rows[1:] != sorted_rows[:-1])
    starts = np.flatnonzero(first)
    sums = values.take(order[starts], 0)
    inside = ~(first & np.append(first[1:], True))
    if inside.any():
        summed = values.take(order[inside], 0)
        if not summed.shape[1] % 2:
            summed = summed.view(np.complex64)  # two columns are added at a time
        sums[inside[starts]] = np.add.reduceat(summed, np.flatnonzero(first[inside])).view(np.float32)
    return sorted_rows[starts], sums


def log_softmax_of(scores: np.ndarray, picked: np.ndarray) -> np.ndarray:
    """Log-probability of one column of each row."""
    chosen = scores[np.arange(len(scores)), picked]
    with np.errstate(over="ignore"):
        total = np.exp(scores) @ np.ones(scores.shape[1], np.float32)
    if not 1e-25 < total.min() <= total.max() < 1e25:  # else the sum is far from the ends of float32
        top = scores.max(1, keepdims=True)
        total = np.exp(scores - top) @ np.ones(scores.shape[1], np.float32)
        chosen -= top[:, 0]
    return chosen - np.log(total)


class WordNetwork:
    """Words from the two words before, beside the table of classes."""

    def __init__(self, symbols: Symbols, table: np.ndarray, seed: int = 7):
        draw = np.random.default_rng(seed)
        self.symbols, self.table = symbols, table * np.float32(LN10)
        start = symbols.hot + symbols.classes
        self.at_block = symbols.classes
        self.at_row = self.at_block + len(symbols.block_mass)
        self.weights = {
            "before": draw.normal(0, 0.3, (start + 1, WIDTH)).astype(np.float32),
            "places": np.concatenate([np.eye(WIDTH) * 0.5, np.eye(WIDTH)]).astype(np.float32),
            "after": np.zeros((self.at_row + len(symbols.mass), WIDTH + 1), np.float32),  # the last is the bias
        }

    def before(self, symbols: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The two symbols before each token of a text."""
        return two_before(symbols, np.zeros(1, np.int64), self.symbols.hot + self.symbols.classes)

    def placed(self, symbols: np.ndarray, firsts: np.ndarray, of_symbol: np.ndarray) -> tuple[np.ndarray, ...]:
        """one, two, context, class and symbol of each token of texts one after the other."""
        known, classes = self.symbols, of_symbol[symbols]
        before = two_before(symbols, firsts, known.hot + known.classes)
        return *before, contexts(classes, known.classes, firsts), classes, symbols

    def hidden(self, one: np.ndarray, two: np.ndarray) -> np.ndarray:
        """With a last column of ones."""
        before, places = self.weights["before"], self.weights["places"]
        found = np.ones((len(one), WIDTH + 1), np.float32)
        found[:, :-1] = np.concatenate([before.take(one, 0), before.take(two, 0)], 1) @ places
        return found

    def logs(self, one, two, context, classes, symbols) -> np.ndarray:
        """Natural log-probabilities of classes in their contexts plus those of symbols in their classes.

        Tokens are taken by symbol, so that those of a class and of a block come one after the other.
        """
        known, after = self.symbols, self.weights["after"].copy()
        after[self.at_block : self.at_row, -1] += np.log(known.block_mass)
        after[self.at_row :, -1] += np.log(known.mass)
        row = known.row[symbols]
        order = np.argsort(row)
        one, two, context, classes, row = (values[order] for values in (one, two, context, classes, row))
        hidden, found = np.empty((len(one), WIDTH + 1), np.float32), np.empty(len(one), np.float32)
        for at in range(0, len(one), STRIP):
            some = slice(at, at + STRIP)
            hidden[some] = self.hidden(one[some], two[some])
            scores = hidden[some] @ after[: known.classes].T
            scores += self.table.take(context[some], 0)
            found[some] = log_softmax_of(scores, classes[some])
        inside = np.searchsorted(row, len(known.mass))  # classes of one word have neither blocks nor rows
        classes, row = classes[:inside], row[:inside]
        block = known.block[row]
        for of_tokens, bounds, at, of in ((classes, known.blocks, self.at_block, block), (block, known.rows, self.at_row, row)):
            ends = np.flatnonzero(np.append(of_tokens[1:] != of_tokens[:-1], True)) + 1 if inside else []
            begin = 0
            for end in ends:
                low, high = bounds[of_tokens[begin]], bounds[of_tokens[begin] + 1]
                for first in range(begin, end, STRIP) if high - low > 1 else ():
                    some = slice(first, min(end, first + STRIP))
                    found[some] += log_softmax_of(hidden[some] @ after[at + low : at + high].T, of[some] - low)
                begin = end
        logs = np.empty(len(one))
        logs[order] = found
        return logs

    def learn(self, pieces: Iterator[tuple[np.ndarray, ...]], passes: int, seed: int = 7) -> Iterator[tuple[int, int, bytes, bytes]]:
        """Train on (one, two, context, class, symbol) of tokens; matrix, first row, how often rows moved, moves."""
        draw = np.random.default_rng(seed)
        known, begun = self.symbols, self.weights
        self.weights = {name: matrix.copy() for name, matrix in begun.items()}
        self.squares = {name: np.full(len(matrix), 0.1, np.float32) for name, matrix in begun.items()}
        moved = {name: np.zeros(len(matrix), np.float32) for name, matrix in begun.items()}
        heads = (0, known.class_mass), (self.at_block, known.block_mass), (self.at_row, known.mass)
        noises = [(at, np.cumsum(mass / mass.sum())) for at, mass in heads]
        usual = np.full(len(begun["after"]), np.log(WORD_NOISE), np.float32)
        usual[: known.classes] += np.log(known.class_mass / known.class_mass.sum())
        for one, two, context, classes, symbols in pieces:
            rows_of = known.row[symbols]
            for _ in range(passes):
                mixed = draw.permutation(len(symbols))
                drawn = draw.random((-(-len(mixed) // BATCH), len(noises), WORD_NOISE))
                wrong = np.empty(drawn.shape, np.int64)
                for number, (at, noise) in enumerate(noises):
                    wrong[:, number] = at + np.minimum(np.searchsorted(noise, drawn[:, number]), len(noise) - 1)
                moves_of: dict[str, list[np.ndarray]] = {name: [] for name in begun}
                for number, noise in enumerate(wrong):
                    batch = mixed[number * BATCH : (number + 1) * BATCH]
                    outside = rows_of[batch] >= len(known.mass)  # classes of one word have neither blocks nor rows
                    inside = batch[~outside]
                    batch = np.concatenate([inside, batch[outside]])
                    row = rows_of[inside]
                    right = np.concatenate([classes[batch], self.at_block + known.block[row], self.at_row + row])
                    changed = self.step(one[batch], two[batch], context[batch], right, noise.ravel(), usual)
                    for name, rows in changed.items():
                        moves_of[name].append(rows)
                for name, rows in moves_of.items():
                    moved[name] += np.bincount(np.concatenate(rows), minlength=len(moved[name]))
        for number, name in enumerate(begun):
            change = self.weights[name] - begun[name]
            for at in range(0, len(change), ROWS):
                times = moved[name][at : at + ROWS]
                if times.any():
                    yield number, at, times.tobytes(), change[at : at + ROWS].astype(np.float16).tobytes()
        self.weights = begun

    def step(self, one, two, context, right, wrong, usual) -> dict[str, np.ndarray]:
        """Rows that one batch moves: the rows that are right, of all classes, then of the first tokens' blocks and words; noise of each."""
        weights, after, places = self.weights, self.weights["after"], self.weights["places"]
        size, inside = len(one), (len(right) - len(one)) // 2
        heads = (slice(size), slice(size)), (slice(inside), slice(size, size + inside)), (slice(inside), slice(size + inside, None))
        both = np.stack([one, two], 1).ravel()
        before = weights["before"].take(both, 0).reshape(size, -1)
        hidden = np.ones((size, WIDTH + 1), np.float32)
        hidden[:, :-1] = before @ places
        of_context = self.table.take(context, 0)

        # Noise is drawn by how frequent classes are; blocks and words start from just that.
        bad = after.take(wrong, 0)
        against = -bad
        against[:, -1] += usual[wrong]
        false = against @ hidden.T  # noise x token
        false[:WORD_NOISE] -= of_context[:, wrong[:WORD_NOISE]].T
        false = chance_against(false)
        false[WORD_NOISE:, inside:] = 0

        good = after.take(right, 0)
        true = -usual[right]
        for here, of in heads:
            true[of] += np.einsum("ij,ij->i", hidden[here], good[of])
        true[:size] += of_context[np.arange(size), right[:size]]
        true = chance_against(true)[:, None]
        good *= true
        slope = good[:size] - false.T @ bad
        rows, moves = np.concatenate([right, wrong]), np.empty((len(right) + len(wrong), WIDTH + 1), np.float32)
        for here, of in heads:
            np.multiply(true[of], hidden[here], out=moves[of.start or 0 : of.stop or len(right)])
            if of.start:
                slope[here] += good[of]
        np.negative(false @ hidden, out=moves[len(right) :])
        slope = np.ascontiguousarray(slope[:, :-1])
        gradients = {
            "after": added(rows, moves),
            "before": added(both, (slope @ places.T).reshape(len(both), WIDTH)),
            "places": (np.arange(2 * WIDTH), before.T @ slope),
        }
        for name, (changed, move) in gradients.items():
            squares = np.einsum("ij,ij->i", move, move)
            squares /= np.float32(move.shape[1])
            squares += self.squares[name].take(changed)
            self.squares[name][changed] = squares
            move *= (np.float32(RATE) / np.sqrt(squares))[:, None]
            move += weights[name].take(changed, 0)
            weights[name][changed] = move
        return {name: changed for name, (changed, _) in gradients.items()}


def chance_against(scores: np.ndarray) -> np.ndarray:
    """1 / (1 + exp(score)); `scores` are overwritten."""
    with np.errstate(over="ignore"):  # the chance is zero then
        np.exp(scores, out=scores)
    scores += 1
    return np.reciprocal(scores, out=scores)


def averaged(halves: bool):
    """Sums up moves, weighted by how often rows moved: (matrix, at, times, moves) to the same, the moves in float32."""

    def summed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[tuple[int, int], list[np.ndarray]] = {}
        for batch in batches:
            for number, at, times, moves in zip(*(column.to_pylist() for column in batch.columns[:4])):
                often = np.frombuffer(times, np.float32).astype(np.float64)
                move = np.frombuffer(moves, np.float16 if halves else np.float32).reshape(len(often), -1) * often[:, None]
                if (number, at) in sums:
                    sums[number, at][0] += often
                    sums[number, at][1] += move
                else:
                    sums[number, at] = [often, move]
        for (number, at), (often, move) in sums.items():
            mean = (move / np.maximum(often, 1)[:, None]).astype(np.float32).tobytes()
            columns = [[number], [at], [often.astype(np.float32).tobytes()], [mean]]
            yield pa.RecordBatch.from_arrays([pa.array(c) for c in columns], ["matrix", "at", "times", "moves"])

    return summed


def train_words(encoded: DataFrame, network: WordNetwork, words: Broadcast, total: int) -> None:
    """Each round, tasks train on their part of the texts (row, symbols); the blocks of rows are averaged in two steps."""
    session = encoded.sparkSession
    passes = max(1, -(-STEPS * BATCH // max(1, total)))
    schema = "matrix long, at long, times binary, moves binary"

    def rounds(of_round: DataFrame) -> None:
        begun = session.sparkContext.broadcast(network)

        def learned(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            model, of_symbol = begun.value, _known(words).class_of_symbol
            pieces = (model.placed(symbols, firsts, of_symbol) for _, symbols, firsts in portions(batches, PIECE))
            for number, at, times, moves in model.learn(pieces, passes):
                columns = [pa.array([number]), pa.array([at]), pa.array([times]), pa.array([moves])]
                yield pa.RecordBatch.from_arrays(columns, ["matrix", "at", "times", "moves"])

        parts = of_round.select("symbols").mapInArrow(learned, schema)
        group = F.floor(F.spark_partition_id() / GROUP).alias("group")
        some = parts.select("*", group).repartition("matrix", "at", "group").mapInArrow(averaged(True), schema)
        means = some.repartition("matrix", "at").mapInArrow(averaged(False), schema).select("matrix", "at", "moves").collect()
        begun.destroy()
        names = list(network.weights)
        for found in means:
            matrix = network.weights[names[found["matrix"]]]
            move = np.frombuffer(found["moves"], np.float32).reshape(-1, matrix.shape[1])
            matrix[found["at"] : found["at"] + len(move)] += move

    for number in range(ROUNDS):
        rounds(encoded.where(F.pmod(F.xxhash64("row"), F.lit(ROUNDS)) == number))


def placed(found: list[bytes], words: Words, network: WordNetwork) -> tuple[np.ndarray, ...]:
    """one, two, context, class and symbol of each token of a text."""
    symbols = network.symbols.of(*words.classify(pa.array(found, pa.binary())))
    return network.placed(symbols, np.zeros(1, np.int64), words.class_of_symbol)


@dataclass
class Model:
    words: Words
    table: np.ndarray
    sizes: np.ndarray  # class x (tokens, words)
    n: int
    v: int
    network: WordNetwork

    def __post_init__(self) -> None:
        both = self.sizes.sum(1) + 1.0
        own = np.arange(len(both)) < self.words.own
        # A class of one word has no words never seen: the word's share is one.
        self.spread = np.log10(np.where(own, self.sizes[:, 0] + 1.0, both))
        self.others = np.log10(self.network.symbols.others)

    def log10s_of(self, columns: tuple[np.ndarray, ...]) -> np.ndarray:
        """Log-probabilities of placed tokens, those of rare words without log10(count + 1)."""
        logs = []
        for begin in range(0, len(columns[0]), PIECE):
            some = tuple(column[begin : begin + PIECE] for column in columns)
            hot = some[4] < self.network.symbols.hot
            logs.append(self.network.logs(*some) / LN10 - np.where(hot, 0.0, self.others[some[3]]))
        return np.concatenate(logs)

    def log10s(self, found: list[list[bytes]]) -> list[np.ndarray]:
        """For each text, given as its tokens, their log-probabilities as above."""
        return [self.log10s_of(placed(one, self.words, self.network)) for one in found]


def train(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> tuple[Model, DataFrame]:
    """The model, and the stored counts of all training words."""
    return trained(docs, id_col, text_col)[:2]


def trained(docs: DataFrame, id_col: str, text_col: str) -> tuple[Model, DataFrame, DataFrame]:
    """The model, the stored counts of all training words, and the texts as ids."""
    texts = docs.where(fold(F.col(id_col), FOLDS) != HELD_OUT).select(F.col(text_col).alias("text"))
    counts = count_words(texts)
    total = counts.agg(F.sum("count").alias("n"), F.count("*").alias("v")).first()
    words = know_words(counts)
    shared = docs.sparkSession.sparkContext.broadcast(words)
    sizes = class_sizes(counts, shared, words.classes)
    encoded = encode_documents(docs, shared, id_col, text_col)
    learnt = encoded.where("learnt")
    table = class_table(count_runs(learnt.select("symbols"), shared, words.classes), words.classes)
    of_words = WordNetwork(Symbols(words, sizes), table)
    if total["n"]:
        train_words(learnt.select("row", "symbols"), of_words, shared, total["n"])
    return Model(words, table, sizes, total["n"] or 0, total["v"], of_words), counts, encoded


def score_documents(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score: one row for each row of `docs`."""
    model, counts, encoded = trained(docs, id_col, text_col)
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def scored(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = _known(shared)
        words, of_symbol = known.words, known.words.class_of_symbol
        counted = np.append(words.logs, np.zeros(words.classes))  # of symbols
        for rows, symbols, firsts in portions(batches, PIECE):
            fits = np.add.reduceat(known.log10s_of(known.network.placed(symbols, firsts, of_symbol)), firsts)
            logs = np.add.reduceat(counted[symbols], firsts)
            hot = np.add.reduceat((symbols < len(words.ids)).astype(np.int64), firsts)
            lengths = np.diff(np.append(firsts, len(symbols)))
            numbers, doc_ids = (pa.array(column, pa.int64()) for column in zip(*rows))
            columns = [numbers, doc_ids, *map(pa.array, (lengths, hot, logs, fits - logs))]
            yield pa.RecordBatch.from_arrays(columns, ["row", "doc_id", "n_tokens", "known", "logs", "model"])

    whole = encoded.select("row", "doc_id", "symbols").mapInArrow(
        scored, "row long, doc_id long, n_tokens long, known long, logs double, model double"
    )
    pairs = encoded.select("row", F.explode(F.arrays_zip("rare", "times")).alias("rare"))
    found = pairs.select("row", "rare.rare", "rare.times").join(counts, F.col("rare") == F.col("word"))
    rare = found.groupBy("row").agg(
        F.sum("times").alias("rare_known"), F.sum(F.col("times") * F.log10(F.col("count") + 1)).alias("rare_logs")
    )
    logs = F.col("logs") + F.coalesce("rare_logs", F.lit(0.0))
    return whole.join(rare, "row", "left").select(
        "doc_id",
        (fold(F.col("doc_id"), FOLDS) == HELD_OUT).alias("held_out"),
        "n_tokens",
        (F.col("known") + F.coalesce("rare_known", F.lit(0))).alias("n_known"),
        F.lit(model.n).cast("long").alias("train_tokens"),
        (logs - F.col("n_tokens") * float(np.log10(model.n + model.v + 1))).alias("base_score"),
        (logs + F.col("model")).alias("score"),
    )
