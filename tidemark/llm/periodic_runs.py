"""Periodic runs of words, found in a grammar of the text.

A run is a stretch of words with a smallest period q (words q apart are the same), at least 2 q and MIN_LENGTH
words long, that no neighbouring word extends.

1. Words become numbers, and Re-Pair replaces repeated pairs of neighbours by nonterminals: in each round the pairs
   that are more frequent than those they overlap, until no pair occurs twice. What is left of a text is joined two
   by two to one start symbol, so that every text is a tree.
2. A run crosses the boundary between the two halves of the smallest nonterminal that contains it. So the runs that
   cross a nonterminal's boundary are computed once, on one of its occurrences: a period q is possible only where a
   word next to the boundary occurs again q words away, and the stretch of equal words is extended to both
   sides, first word by word, then over ranks of factors of 8, 64, 512, ... words, inside the nonterminal.
3. The runs are translated to all positions at which the nonterminal is derived. Those of one period that
   overlap by it are merged, which leaves the maximal ones.

Each text has its own grammar; texts are worked on some BATCH_WORDS words at a time in numpy, a longer text alone, with
memory in proportion to it. A nonterminal is computed once however often it is derived.

Defined results: words are separated by ASCII white space; null and empty texts have no words, no runs and an
empty collapsed text. Rows that repeat an id are texts of their own, missing ids stay; an empty table gives an
empty one; other columns are not looked at.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import compress, count

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.shared import ASCII_SPACE, text_of

MIN_LENGTH = 12

#: Words that are worked on together, and candidate periods that are extended together.
BATCH_WORDS, BATCH_PERIODS = 200_000, 2_000_000

#: Steps of an extension that go word by word.
STEPS = 16


class Nodes:
    """Nonterminals by one occurrence each, words [low, high) with the boundary before `mid`, and all occurrences."""

    def __init__(self):
        self.low, self.mid, self.high, self.node, self.at = [], [], [], [], []
        self.count = 0

    def add(self, low: np.ndarray, mid: np.ndarray, high: np.ndarray, node: np.ndarray, at: np.ndarray) -> None:
        """New nonterminals, and the places `at` where those numbered `node` among the new ones occur."""
        for kept, given in zip((self.low, self.mid, self.high, self.node, self.at), (low, mid, high, node + self.count, at)):
            kept.append(given)
        self.count += len(low)

    def arrays(self) -> tuple[np.ndarray, ...]:
        """low, mid, high, and per nonterminal the slice [first, last) of its places, and the places."""
        joined = lambda parts: np.concatenate([np.zeros(0, np.int64), *parts])
        node, at = joined(self.node), joined(self.at)
        at = at[np.argsort(node, kind="stable")]
        ends = np.cumsum(np.bincount(node, minlength=self.count))
        return joined(self.low), joined(self.mid), joined(self.high), np.concatenate([[0], ends[:-1]]).astype(np.int64), ends, at


def _even(codes: np.ndarray, touches: np.ndarray) -> np.ndarray:
    """Of pairs that overlap an equal one to their left (a a a), every second is out."""
    continues = np.zeros(len(codes), bool)
    continues[1:] = touches[1:] & (codes[1:] == codes[:-1])
    places = np.arange(len(codes))
    begun = np.maximum.accumulate(np.where(continues, 0, places))
    return (places - begun) % 2 == 0


def re_pair(symbols: np.ndarray, joined: np.ndarray, nodes: Nodes) -> tuple[np.ndarray, np.ndarray]:
    """Replace repeated pairs of neighbours; starts and ends of the symbols that are left, in order.

    `joined` says whether a symbol and the next are of one text. A pair that occurs once can never become part
    of a repeated one, so symbols between two such pairs are final and leave the work.
    """
    start = np.arange(len(symbols))
    end = start + 1
    fresh = int(symbols.max()) + 1 if len(symbols) else 0
    final = []
    while True:
        at = np.flatnonzero(joined)
        codes = symbols[at] * np.int64(fresh) + symbols[np.minimum(at + 1, len(symbols) - 1)]
        even = _even(codes, np.diff(at, prepend=-2) == 1)
        known, which, counts = np.unique(codes[even], return_inverse=True, return_counts=True)
        repeated = counts >= 2
        # Ranks grow with the count; pairs that occur once have none.
        rank = np.zeros(len(known), np.int64)
        rank[np.argsort(counts, kind="stable")] = np.arange(1, len(known) + 1)
        rank[~repeated] = 0
        ranks = np.zeros(len(symbols) + 2, np.int64)
        ranks[at[even] + 1] = rank[which]
        alive = np.zeros(len(symbols), bool)
        alive[at[even]] = repeated[which]
        odd = np.flatnonzero(~even)
        alive[at[odd]] = alive[at[odd - 1]]
        picked = np.flatnonzero((ranks[1:-1] > ranks[:-2]) & (ranks[1:-1] > ranks[2:]))
        number = np.zeros(len(symbols), np.int64)
        number[at[even]] = which
        chosen = number[picked]
        often = np.bincount(chosen, minlength=len(known)) >= 2
        picked, chosen = picked[often[chosen]], chosen[often[chosen]]
        if len(picked):
            rules, first, which = np.unique(chosen, return_index=True, return_inverse=True)
            model = picked[first]
            nodes.add(start[model], start[model + 1], end[model + 1], which, start[picked])
            symbols, end = symbols.copy(), end.copy()
            symbols[picked] = fresh + which
            end[picked] = end[picked + 1]
            fresh += len(rules)
            alive[picked] = alive[picked + 1]
        left = np.ones(len(symbols), bool)
        left[picked + 1] = False
        symbols, start, end, joined = symbols[left], start[left], end[left], alive[left]
        settled = ~joined
        settled[1:] &= ~joined[:-1]
        final.append((start[settled], end[settled]))
        symbols, start, end, joined = symbols[~settled], start[~settled], end[~settled], joined[~settled]
        if not len(symbols):
            break
    start, end = (np.concatenate(part) for part in zip(*final))
    order = np.argsort(start)
    return start[order], end[order]


def join_rest(start: np.ndarray, end: np.ndarray, text: np.ndarray, nodes: Nodes) -> None:
    """Join what is left of each text two by two until one symbol stands for it."""
    while len(start):
        first = np.searchsorted(text, text)
        left = (np.arange(len(start)) - first) % 2 == 0
        paired = np.flatnonzero(left[:-1] & (text[1:] == text[:-1]))
        if not len(paired):
            return
        nodes.add(start[paired], start[paired + 1], end[paired + 1], np.arange(len(paired)), start[paired])
        end = end.copy()
        end[paired] = end[paired + 1]
        start, end, text = start[left], end[left], text[left]


class Factors:
    """Ranks of factors of 8, 64, 512, ... words of some texts: equal numbers mean equal words, exactly."""

    def __init__(self, symbols: np.ndarray, longest: int):
        self.ranks, size = [(1, symbols)], 1
        rank = symbols
        while size * 2 <= longest:
            known = len(rank) - size
            new = np.arange(len(rank)) + (len(rank) + 1)  # beyond the end: numbers of their own
            if known > 0:
                base = np.int64(rank.max()) + 1
                new[:known] = np.unique(rank[:known] * base + rank[size:], return_inverse=True)[1]
            rank, size = new, size * 2
            if size.bit_length() % 3 == 1:
                self.ranks.append((size, rank))

    def extend(self, x: np.ndarray, y: np.ndarray, most: np.ndarray, step: int) -> np.ndarray:
        """How many words from x and from y on are the same, at most `most`, to the right (step 1) or left (-1)."""
        length = np.zeros(len(x), np.int64)
        for size, rank in reversed(self.ranks):
            active = np.flatnonzero(length + size <= most)
            while len(active):
                shift = length[active] if step > 0 else -length[active] - (size - 1)
                same = rank[x[active] + shift] == rank[y[active] + shift]
                active = active[same]
                length[active] += size
                active = active[length[active] + size <= most[active]]
        return length


def _near(symbols: np.ndarray, x: np.ndarray, y: np.ndarray, most: np.ndarray, step: int) -> np.ndarray:
    """As `Factors.extend`, word by word, for at most STEPS words."""
    length = np.zeros(len(x), np.int64)
    active = np.flatnonzero(most > 0)
    for done in range(STEPS):
        active = active[symbols[x[active] + step * done] == symbols[y[active] + step * done]]
        length[active] += 1
        active = active[most[active] > done + 1]
        if not len(active):
            break
    return length


def crossing(symbols: np.ndarray, ends: np.ndarray, low: np.ndarray, mid: np.ndarray, high: np.ndarray) -> tuple[np.ndarray, ...]:
    """Runs that cross the boundaries of nonterminals, inside these: nonterminal, start, end, period.

    `ends` are the ends of the texts; no two texts share a symbol.
    """
    size = len(symbols)
    order = np.argsort(symbols, kind="stable")
    keys = symbols[order] * np.int64(size) + order
    place = np.empty(size, np.int64)
    place[order] = np.arange(size)
    half = (high - low) // 2
    # Occurrences of the word after the boundary before it, and of the word before the boundary after it.
    before = np.searchsorted(keys, symbols[mid] * np.int64(size) + np.maximum(low, mid - half)), place[mid]
    after = place[mid - 1] + 1, np.searchsorted(keys, symbols[mid - 1] * np.int64(size) + np.minimum(high - 1, mid - 1 + half), "right")
    found: list[tuple[np.ndarray, ...]] = []
    for (first, last), backward in ((before, True), (after, False)):
        counts = np.maximum(last - first, 0)
        sums = np.cumsum(counts)
        cuts = [0]
        while cuts[-1] < len(counts):
            done = sums[cuts[-1] - 1] if cuts[-1] else 0
            cuts.append(max(cuts[-1] + 1, int(np.searchsorted(sums, done + BATCH_PERIODS, "right"))))
        for a, b in zip(cuts, cuts[1:]):
            node = np.repeat(np.arange(a, b), counts[a:b])
            if not len(node):
                continue
            offset = np.arange(len(node)) - np.repeat(np.cumsum(counts[a:b]) - counts[a:b], counts[a:b])
            other = order[first[node] + offset]
            x, y = (other, mid[node]) if backward else (mid[node] - 1, other)
            found.append(_extended(symbols, ends, node, x, y, low[node], high[node]))
    if not found:
        return (np.zeros(0, np.int64),) * 4
    node, start, end, period = (np.concatenate(part) for part in zip(*found))
    # The same stretch with a multiple of its period is no run.
    by = np.lexsort((period, end, start, node))
    node, start, end, period = node[by], start[by], end[by], period[by]
    new = np.ones(len(node), bool)
    new[1:] = (np.diff(node) != 0) | (np.diff(start) != 0) | (np.diff(end) != 0)
    return node[new], start[new], end[new], period[new]


def _extended(symbols, ends, node, x, y, low, high) -> tuple[np.ndarray, ...]:
    """Extend equal words x and y to the left and right; those that make runs: nonterminal, start, end, period."""

    def kept(mask: np.ndarray) -> None:
        nonlocal node, x, y, low, high, left, right
        node, x, y, low, high, left, right = (part[mask] for part in (node, x, y, low, high, left, right))

    right = _near(symbols, x + 1, y + 1, high - 1 - y, 1)
    left = _near(symbols, x - 1, y - 1, x - low, -1)
    needed = np.maximum(y - x, MIN_LENGTH - (y - x))
    kept((left + right + 1 >= needed) | (left == STEPS) | (right == STEPS))
    far = np.flatnonzero((left == STEPS) | (right == STEPS))
    if len(far):
        # The texts that have such stretches, closed up.
        text = np.searchsorted(ends, x[far], "right")
        begins = np.concatenate([[0], ends[:-1]])
        texts = np.unique(text)
        lengths = ends[texts] - begins[texts]
        moved = np.cumsum(lengths) - lengths
        words = np.repeat(begins[texts] - moved, lengths) + np.arange(lengths.sum())
        factors = Factors(np.unique(symbols[words], return_inverse=True)[1], int((high - low).max()))
        shift = (moved - begins[texts])[np.searchsorted(texts, text)]
        u, v = x[far] + shift, y[far] + shift
        right[far] = factors.extend(u + 1, v + 1, high[far] - 1 - y[far], 1)
        left[far] = factors.extend(u - 1, v - 1, x[far] - low[far], -1)
    period = y - x
    kept(left + right + 1 >= np.maximum(period, MIN_LENGTH - period))
    return node, x - left, y + right + 1, y - x


def merged(start: np.ndarray, end: np.ndarray, period: np.ndarray) -> tuple[np.ndarray, ...]:
    """Stretches of one period that overlap by at least the period become one; by start, then period."""
    by = np.lexsort((end, start, period))
    start, end, period = start[by], end[by], period[by]
    group = np.cumsum(np.diff(period, prepend=period[:1]) != 0)
    span = np.int64(end.max() + 1) if len(end) else np.int64(1)
    reached = np.maximum.accumulate(end + group * span) - group * span
    new = np.ones(len(start), bool)
    new[1:] = (group[1:] != group[:-1]) | (start[1:] + period[1:] > reached[:-1])
    first = np.flatnonzero(new)
    last = np.append(first[1:], len(start)) - 1
    start, end, period = start[first], reached[last] if len(first) else end[:0], period[first]
    by = np.lexsort((period, start))
    return start[by], end[by], period[by]


def runs(symbols: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Start, end and period of every run of some texts; `ends` are the texts' ends, and no two share a symbol."""
    joined = np.ones(len(symbols), bool)
    joined[ends[(ends > 0)] - 1] = False
    nodes = Nodes()
    if len(symbols):
        start, end = re_pair(symbols, joined, nodes)
        join_rest(start, end, np.searchsorted(ends, start, "right"), nodes)
    low, mid, high, first, last, at = nodes.arrays()
    long = np.flatnonzero(high - low >= MIN_LENGTH)
    node, start, end, period = crossing(symbols, ends, low[long], mid[long], high[long])
    node = long[node]
    times = (last - first)[node]
    which = np.repeat(np.arange(len(node)), times)
    offset = np.arange(len(which)) - np.repeat(np.cumsum(times) - times, times)
    shift = at[first[node][which] + offset] - low[node][which]
    return merged(start[which] + shift, end[which] + shift, period[which])


def _portions(texts: list[bytes | None]) -> Iterator[tuple[list[list[bytes]], np.ndarray, np.ndarray]]:
    """Word lists, their numbers and their ends, a bounded number of words at a time."""
    lists, numbers, ends, done = [], [], [], 0
    for text in texts:
        words = (text or b"").split()
        if lists and done + len(words) > BATCH_WORDS:
            yield lists, np.concatenate(numbers), np.array(ends, np.int64)
            lists, numbers, ends, done = [], [], [], 0
        # A word's number is its first place, so that texts share none.
        first: dict[bytes, int] = {}
        numbers.append(np.fromiter(map(first.setdefault, words, count(done)), np.int64, len(words)))
        done += len(words)
        lists.append(words)
        ends.append(done)
    if lists:
        yield lists, np.concatenate(numbers), np.array(ends, np.int64)


def found_in(texts: list[bytes | None]) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, list[bytes]]]:
    """For portions of the texts: number of runs of each, starts, lengths and periods, and the collapsed texts."""
    for lists, symbols, ends in _portions(texts):
        start, end, period = runs(symbols, ends)
        begins = np.concatenate([[0], ends[:-1]])
        # Empty texts end where the text before them does; a run belongs to the first that ends after it starts.
        text = np.searchsorted(ends, start, "right")
        change = np.zeros(len(symbols) + 1, np.int64)
        np.add.at(change, start + period, 1)
        np.add.at(change, end, -1)
        kept = np.cumsum(change[:-1]) == 0
        whole = np.ones(len(lists), bool)
        whole[text] = False
        collapsed = [
            b" ".join(words if all_kept else compress(words, kept[a:b]))
            for words, all_kept, a, b in zip(lists, whole, begins, ends)
        ]
        yield np.bincount(text, minlength=len(lists)), start - begins[text], end - start, period, collapsed


FOUND = pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())])


def found(text: Column) -> Column:
    """struct<runs, collapsed> of each text."""

    @F.arrow_udf("struct<runs: array<struct<start: long, length: long, period: long>>, collapsed: string>")
    def both(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for batch in batches:
            parts = []
            for counts, start, length, period, collapsed in found_in(batch.cast(pa.binary()).to_pylist()):
                rows = pa.StructArray.from_arrays([pa.array(part) for part in (start, length, period)], fields=list(FOUND))
                offsets = pa.array(np.concatenate([[0], np.cumsum(counts)]).astype(np.int32))
                lists = pa.ListArray.from_arrays(offsets, rows)
                kept = pa.array(collapsed, pa.binary()).cast(pa.string())
                parts.append(pa.StructArray.from_arrays([lists, kept], ["runs", "collapsed"]))
            yield pa.concat_arrays(parts) if parts else pa.nulls(0, pa.struct([("runs", pa.list_(FOUND)), ("collapsed", pa.string())]))

    return both(text)


def periodic_runs(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, runs, collapsed: the runs of each text by start and period, and its words without the repeated ones.

    A word is left out if a run contains it after the run's first period.
    """
    texts = docs.select(F.col(id_col).alias("doc_id"), found(F.col(text_col)).alias("found"))
    return texts.select("doc_id", "found.runs", "found.collapsed")


def digests(texts: DataFrame) -> DataFrame:
    """doc_id, n_runs, the longest run, and digests of all runs and of the collapsed text."""
    longest = F.array_max(F.transform("runs", lambda r: F.struct(r.length, -r.start, -r.period)))
    best = texts.withColumn("best", longest)
    written = F.transform("runs", lambda r: F.concat(F.concat_ws(",", r.start.cast("string"), r.length.cast("string"), r.period.cast("string")), F.lit("\n")))
    length, start, period = (F.col(f"best.{name}") for name in ("length", "col2", "col3"))
    return best.select(
        "doc_id",
        F.size("runs").cast("long").alias("n_runs"),
        (-start).alias("start"),
        length.alias("length"),
        (-period).alias("period"),
        F.floor(1000 * length / -period).alias("exponent_milli"),
        F.sha2(F.array_join(written, ""), 256).alias("runs_sha256"),
        F.sha2("collapsed", 256).alias("collapsed_sha256"),
    )


def repeated_tails(docs: DataFrame) -> DataFrame:
    """doc_id, text: every tenth text, by the crc32 of its id, ends in repetitions of some of its own words.

    With h the crc32, g = h div 10 and n words, those from a = g mod n on repeat the 1 + (n - a) div (3 + g mod 8)
    words there. Texts with other h, without words or without an id stay as they are.
    """
    h = F.crc32(F.col("doc_id").cast("string").cast("binary"))
    words = F.filter(F.split(text_of(F.col("text")), ASCII_SPACE), lambda word: word != "")
    picked = docs.select("doc_id", "text", F.when(h % 10 == 0, words).alias("words"), F.expr("crc32(cast(cast(doc_id AS string) AS binary)) div 10").alias("g"))
    n = F.size("words")
    placed = picked.withColumn("a", F.when(n > 0, F.col("g") % n)).withColumn(
        "p", F.expr("1 + (size(words) - a) div (3 + g % 8)")
    )
    place = lambda i: F.when(i < F.col("a"), i).otherwise(F.col("a") + (i - F.col("a")) % F.col("p"))
    changed = F.transform(F.sequence(F.lit(0).cast("long"), n - F.lit(1).cast("long")), lambda i: F.get("words", place(i).cast("int")))
    return placed.select("doc_id", F.when(n > 0, F.array_join(changed, " ")).otherwise(F.col("text")).alias("text"))
