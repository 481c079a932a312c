"""SimHash near-duplicates: fingerprints, a binary-trie self-join, and connected components.

Fingerprint. Words are ASCII-lower-cased runs of anything but ASCII white space; every run of `shingle`
words (repeats included; the whole text if it has fewer words) is hashed with XXH64, seed 42. A bit is
set if more than half of the hashes have it. A text without words has fingerprint zero.

Self-join. Two fingerprints within d bits agree in at least one of d + 1 blocks of bits. All different
fingerprints are dealt out once for each block, by the value of that block; those that meet form a
binary trie, which is joined with itself: starting from the root with itself, pairs of nodes go down
together, a pair that takes different branches has one more differing bit, and pairs beyond d are cut
off. Nodes with one fingerprint below them are compared whole. The pairs of all groups of a task go down
side by side, in blocks of bounded size. A pair is reported by the first block that it agrees in.

A block value that too many fingerprints share is dealt out again by the blocks of its other bits, and
so on: groups stay bounded with nothing left out, since ever more bits are the same in a group.

A fingerprint has at most 64 + 2,016 others within two bits, so links grow with the number of different
fingerprints and not with its square; copies share a fingerprint and are never paired.

Null text counts as empty. Rows without id take part; the component of rows without any id is null.
Repeated rows and ids give a row each. An empty table gives an empty one; further columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.components import component_labels
from tidemark.llm.shared import columns_of, fresh, small, stage, without

BITS = 64
SEED = 42

#: Fingerprints with the same key that one task takes as a group; more are dealt out again.
GROUP_ROWS = 20_000

#: Node pairs that go down the trie at a time.
PAIRS_AT_ONCE = 1 << 18


def fingerprint(text: str | None, shingle: int) -> int:
    words = (text or "").encode().lower().split()
    if not words:
        return 0
    if len(words) <= shingle:
        return xxhash.xxh64_intdigest(b" ".join(words), SEED)
    digest, joined = xxhash.xxh64_digest, b" ".join(words)
    lengths = np.fromiter(map(len, words), np.int64, len(words))
    ends = np.cumsum(lengths + 1) - 1
    starts = ends - lengths
    spans = zip(starts[: len(words) - shingle + 1].tolist(), ends[shingle - 1 :].tolist())
    hashes = np.frombuffer(b"".join([digest(joined[a:b], SEED) for a, b in spans]), np.uint8).reshape(-1, 8)
    counts = np.zeros(BITS, np.int64)
    for at in range(0, len(hashes), 1 << 16):
        counts += np.unpackbits(hashes[at : at + (1 << 16)], axis=1).sum(0, dtype=np.int64)
    return int.from_bytes(np.packbits(counts * 2 > len(hashes)).tobytes(), "big")


def _fingerprint_column(shingle: int):
    @F.arrow_udf("long")
    def of_text(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for batch in batches:
            found = np.array([fingerprint(one, shingle) for one in batch.to_pylist()], np.uint64)
            yield pa.array(found.view(np.int64))

    return of_text


def fingerprints(docs: DataFrame, shingle: int, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, fingerprint (64 bits as a long) of every row."""
    found = _fingerprint_column(shingle)(F.col(text_col))
    return docs.select(F.col(id_col).alias("doc_id"), found.alias("fingerprint"))


def _signed(bits: int) -> int:
    return bits - (1 << BITS) if bits >> (BITS - 1) else bits


def finer_masks(mask: int, distance: int) -> list[int]:
    """The mask with each of distance + 1 blocks of the other bits added."""
    free = [bit for bit in range(BITS) if not mask >> bit & 1]
    cuts = [round(i * len(free) / (distance + 1)) for i in range(distance + 2)]
    return [mask | sum(1 << bit for bit in free[a:b]) for a, b in zip(cuts, cuts[1:])]


def dealt_out(table: DataFrame, distance: int, group_rows: int = GROUP_ROWS) -> DataFrame:
    """mask, part, fingerprint: groups of at most `group_rows` different fingerprints that agree in the
    bits of the mask. Any two within `distance` bits meet in some group."""
    if group_rows < 2 << distance:
        raise ValueError(f"groups of {group_rows} rows cannot always be split")
    masks, rows, ready = [0], table.select(F.lit(0).cast("long").alias("mask"), "fingerprint"), None
    while True:
        finer = {mask: finer_masks(mask, distance) for mask in masks}
        choices = F.create_map(
            *[
                item
                for mask, some in finer.items()
                for item in (F.lit(_signed(mask)).cast("long"), F.array(*[F.lit(_signed(m)).cast("long") for m in some]))
            ]
        )
        dealt = rows.select(F.explode(F.element_at(choices, F.col("mask"))).alias("mask"), "fingerprint")
        dealt = dealt.select("mask", F.col("fingerprint").bitwiseAND(F.col("mask")).alias("part"), "fingerprint")
        if ready is not None:
            dealt = dealt.distinct()  # two masks can have led to the same one
        sizes = dealt.groupBy("mask", "part").agg(F.count("*").alias("rows"))
        crowded = stage(sizes.where(F.col("rows") > group_rows).select("mask", "part"))
        if crowded.isEmpty():
            return dealt if ready is None else ready.unionByName(dealt)
        some = dealt.join(small(crowded), ["mask", "part"], "left_anti")
        ready = some if ready is None else ready.unionByName(some)
        rows = stage(dealt.join(small(crowded), ["mask", "part"], "left_semi").select("mask", "fingerprint"))
        masks = sorted({mask for some in finer.values() for mask in some})


class Trie:
    """The binary tries of several groups: nodes are runs of the sorted fingerprints, each of them once."""

    def __init__(self, group: np.ndarray, values: np.ndarray):
        order = np.lexsort((values, group))
        group, values = group[order], values[order]
        new = np.append(True, (group[1:] != group[:-1]) | (values[1:] != values[:-1]))
        group, self.values = group[new], values[new]
        self.starts = np.flatnonzero(np.diff(group, prepend=-1))
        self.ends = np.append(self.starts[1:], len(group))
        self.zeros: dict[int, np.ndarray] = {}

    def split(self, depth: int, first: np.ndarray, last: np.ndarray) -> np.ndarray:
        """Where the run first..last goes from branch 0 to branch 1 at this depth."""
        if depth not in self.zeros:
            zero = (self.values >> np.uint64(BITS - 1 - depth) & np.uint64(1)) == 0
            self.zeros[depth] = np.concatenate([[0], np.cumsum(zero)])
        before = self.zeros[depth]
        return first + before[last] - before[first]

    def pairs(self, distance: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """All pairs of different values of a group within `distance` bits."""
        roots = self.ends - self.starts > 1
        a = np.stack([self.starts[roots], self.ends[roots]])
        todo = [(0, np.concatenate([a, a, np.zeros((1, a.shape[1]), np.int64)]))]
        while todo:
            depth, nodes = todo.pop()
            if nodes.shape[1] > PAIRS_AT_ONCE:
                half = nodes.shape[1] // 2
                todo += [(depth, nodes[:, :half]), (depth, nodes[:, half:])]
                continue
            single = (nodes[1] - nodes[0] == 1) & (nodes[3] - nodes[2] == 1)
            one, two = self.values[nodes[0, single]], self.values[nodes[2, single]]
            near = (np.bitwise_count(one ^ two) <= distance) & (one != two)
            if near.any():
                yield one[near], two[near]
            nodes = nodes[:, ~single]
            if nodes.shape[1] and depth < BITS:
                todo.append((depth + 1, self._down(depth, nodes, distance)))

    def _down(self, depth: int, nodes: np.ndarray, distance: int) -> np.ndarray:
        a0, a2, b0, b2, errors = nodes
        a1, b1 = self.split(depth, a0, a2), self.split(depth, b0, b2)
        children = [
            np.stack([a0, a1, b0, b1, errors]),
            np.stack([a1, a2, b1, b2, errors]),
            np.stack([a0, a1, b1, b2, errors + 1]),
            np.stack([a1, a2, b0, b1, errors + 1])[:, a0 != b0],  # of a node with itself, once
        ]
        found = np.concatenate(children, axis=1)
        return found[:, (found[1] > found[0]) & (found[3] > found[2]) & (found[4] <= distance)]


def links(table: DataFrame, distance: int, group_rows: int = GROUP_ROWS) -> DataFrame:
    """u, v: each pair of different fingerprints within `distance` bits, once. `table` has each once."""

    def joined(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def found(rows: np.ndarray) -> Iterator[pa.RecordBatch]:
            new = np.any(rows[:2, 1:] != rows[:2, :-1], axis=0)
            for one, two in Trie(np.concatenate([[0], np.cumsum(new)]), rows[2].view(np.uint64)).pairs(distance):
                one, two = one.view(np.int64), two.view(np.int64)
                ends = [pa.array(np.minimum(one, two)), pa.array(np.maximum(one, two))]
                yield pa.RecordBatch.from_arrays(ends, ["u", "v"])

        held = np.empty((3, 0), np.int64)
        for batch in batches:
            held = np.concatenate([held, np.stack([column.to_numpy() for column in batch.columns])], axis=1)
            if held.shape[1] > group_rows:  # the last group may go on in the next batch
                cut = int(np.flatnonzero(np.any(held[:2] != held[:2, -1:], axis=0)).max(initial=-1)) + 1
                if cut:
                    yield from found(np.ascontiguousarray(held[:, :cut]))
                    held = held[:, cut:]
        if held.shape[1]:
            yield from found(np.ascontiguousarray(held))

    groups = dealt_out(table, distance, group_rows).repartition("mask", "part")
    return groups.sortWithinPartitions("mask", "part").mapInArrow(joined, "u long, v long").distinct()


def _named(prints: DataFrame, distance: int) -> DataFrame:
    """fingerprint, group (the smallest fingerprint of its component), component_id."""
    different = stage(prints.groupBy("fingerprint").agg(F.min("doc_id").alias("first_id")))
    labels = component_labels(links(different.select("fingerprint"), distance))
    labelled = stage(labels.withColumnRenamed("node", "fingerprint").join(different, "fingerprint"))
    # Stored, like the result: both sides of a join are then dealt out anew and a hot key can be split.
    first = stage(labelled.groupBy("label").agg(F.min("first_id").alias("component_id")))
    linked = labelled.join(first, "label").select("fingerprint", "label", "component_id")
    return stage(
        different.join(linked, "fingerprint", "left").select(
            "fingerprint",
            F.coalesce("label", "fingerprint").alias("group"),
            F.coalesce("component_id", "first_id").alias("component_id"),
        )
    )


def near_duplicates(
    docs: DataFrame, shingle: int, distance: int, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """doc_id, fingerprint (long), component_id: one row for each row of `docs`.

    `component_id` is the smallest id that a chain of links reaches, the row's own included.
    """
    prints = stage(fingerprints(docs, shingle, id_col, text_col))
    named = _named(prints, distance).select("fingerprint", "component_id")
    return prints.join(named, "fingerprint").select("doc_id", "fingerprint", "component_id")


def digests(found: DataFrame) -> DataFrame:
    """The fingerprint as 16 hexadecimal digits."""
    return found.withColumn("fingerprint", F.lower(F.lpad(F.hex("fingerprint"), BITS // 4, "0")))


def one_of_each(
    docs: DataFrame, shingle: int, distance: int, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """The rows of `docs` that stay, with all their columns: one of each component, the one with the
    smallest id. Among rows that repeat that id, or if no row has an id, any one of them stays.

    The rows are stored once with their fingerprints and row numbers, so that texts are read by Python
    once and the choice names rows rather than ids.
    """
    row, mark = fresh(docs, "row_of_docs"), fresh(docs, "mark_of_text")
    numbered = stage(
        docs.withColumn(mark, _fingerprint_column(shingle)(F.col(text_col))).withColumn(row, F.monotonically_increasing_id())
    )
    prints = numbered.select(F.col(id_col).alias("doc_id"), F.col(mark).alias("fingerprint"), F.col(row).alias(row))
    placed = prints.join(_named(prints, distance).select("fingerprint", "group"), "fingerprint")
    placed = stage(placed.select("group", row, F.struct(F.col("doc_id").isNull().alias("missing"), "doc_id", row).alias("order")))
    stays = stage(placed.groupBy("group").agg(F.min("order").alias("first"), F.count("*").alias("rows")).where("rows > 1"))
    dropped = stage(placed.join(stays, "group").where(F.col("order") != F.col("first")).select(row))
    return without(numbered, dropped, row).select(*columns_of(docs))
