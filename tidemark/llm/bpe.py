"""Byte-level BPE with a lazily determinised transducer, and streaming decoding.

Encoding. The merge of a byte string is the only sequence of tokens in which every token merges to
itself and every two neighbours stay apart when merged; a prefix of it is the encoding of a prefix of the
bytes. So the last token of the encoding up to some byte is the one token that ends there and may follow
the last token of the encoding up to its own beginning. The transducer reads byte by byte. Its states are
the sets of token beginnings that the bytes so far end with; they are worked out when first met, and a
state says which tokens end here. Beside the state it holds, for each byte, the token that ends there.
A token still to come begins where one of the open beginnings does: the lookahead is never longer than
the longest token, and tokens on which all open places agree are emitted.

Decoding. Tokens may end inside a character. A state machine over bytes (how many continuation bytes
are due and from which range) is lifted to tokens: a table says, for each token and state, the state
behind it. Text of which every token leads from "between characters" to itself needs no more; other text
goes through the machine piece by piece, holding back an unfinished character.
"""

from __future__ import annotations

import base64
from array import array
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import regex
from pyspark import Broadcast
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Entries after which the tables that only save work are emptied.
TABLE_ENTRIES = 150_000

#: Bytes without an emitted token after which the transducer looks for tokens to emit.
SPAN = 4096

#: Characters of texts whose new pieces are encoded together.
CHARS_AT_ONCE = 1 << 21

#: Rows that a task holds at a time.
ROWS_AT_ONCE = 500

#: Above every rank.
END = 1 << 60


def read_ranks(path: str) -> dict[bytes, int]:
    """Token bytes and their rank from a rank file: base64 and number on each line."""
    with open(path, "rb") as lines:
        return {base64.b64decode(token): int(rank) for token, rank in (line.split() for line in lines if line.strip())}


class Transducer:
    """Bytes to token ids, for the merges given by `ranks` (every single byte must be a token)."""

    def __init__(self, ranks: dict[bytes, int], entries: int = TABLE_ENTRIES):
        self.ranks = ranks
        self.entries = entries
        self.begins = {token[:n] for token in ranks for n in range(1, len(token) + 1)}
        self.edges: tuple[dict, dict] = ({}, {})  # at most one entry for each token
        self.states, self.numbers, self.ending = [b""], {b"": 0}, [()]  # at most one for each beginning
        self.moves: dict[int, int] = {}
        self.apart: dict[int, bool] = {}
        self._begin()

    def merge(self, data: bytes, down_to: int = 1) -> list[bytes]:
        """The merges one by one, lowest rank first and leftmost among equals, until so few parts are left."""
        parts = [data[i : i + 1] for i in range(len(data))]
        while len(parts) > down_to:
            ranked = [self.ranks.get(a + b, END) for a, b in zip(parts, parts[1:])]
            best = min(ranked)
            if best == END:
                break
            at = ranked.index(best)
            parts[at : at + 2] = [parts[at] + parts[at + 1]]
        return parts

    def _edge(self, token: bytes, side: int) -> list[tuple[bytes, int]] | None:
        """What stands at one edge of a token (0 left, 1 right) while its merges run, the whole first,
        each with the rank at which it is merged on. None if the merges never make the token."""
        found = self.edges[side].get(token, ())
        if found == ():
            parts, rank = self.merge(token, 2), self.ranks[token]
            if len(token) == 1:
                found = [(token, END)]
            elif len(parts) == 2 and (inner := self._edge(parts[side], side)) and self._edge(parts[1 - side], side):
                found = [(token, END), (inner[0][0], rank), *inner[1:]]
            else:
                found = None
            self.edges[side][token] = found
        return found

    def may_follow(self, last: bytes, token: bytes) -> bool:
        """Whether the merges keep `token` whole and apart from the token before it.

        The two grow side by side, the lower rank first and the left one among equals. They stay apart
        unless what stands at the border could merge before either side goes on.
        """
        right = self._edge(token, 0)
        if not last or right is None:
            return right is not None
        left, ranks = self._edge(last, 1), self.ranks
        i, j = len(left) - 1, len(right) - 1
        while True:
            (a, a_rank), (b, b_rank) = left[i], right[j]
            across = ranks.get(a + b, END)
            if across < a_rank and across <= b_rank and across < END:
                return False
            if i == 0 and j == 0:
                return True
            if a_rank <= b_rank and i:
                i -= 1
            else:
                j -= 1

    def _move(self, state: int, byte: int) -> int:
        """Work out the state behind a byte: the longest beginning that the bytes now end with."""
        if len(self.moves) > self.entries:
            self.moves.clear()
        rest = self.states[state] + bytes((byte,))
        while rest and rest not in self.begins:
            rest = rest[1:]
        if rest not in self.numbers:
            self.numbers[rest] = len(self.states)
            self.states.append(rest)
            ends = [rest[n:] for n in range(len(rest))]
            whole = [(len(end), self.ranks[end]) for end in ends if end in self.ranks and self.may_follow(b"", end)]
            self.ending.append(tuple(whole))
        found = self.moves[state << 8 | byte] = self.numbers[rest]
        return found

    def _apart(self, last: int, token: int, data: bytes, at: int, n: int) -> bool:
        """`may_follow` for the token of the n bytes before `at`, and `last` before it."""
        if len(self.apart) > self.entries:
            self.apart.clear()
        middle = at - n
        found = self.may_follow(data[middle - self.back[middle] : middle], data[middle:at])
        self.apart[last << 32 | token] = found
        return found

    def _read(self, data: bytes, start: int, base: int, emitted: list[int] | None) -> int:
        """Read on from the place `start`; the place up to which tokens were emitted, if they are to be."""
        tokens, back, states = self.tokens, self.back, self.passed
        state, moves, ending, apart = states[-1], self.moves, self.ending, self.apart
        for at in range(start + 1, len(data) + 1):
            byte = data[at - 1]
            next_state = moves.get(state << 8 | byte)
            state = self._move(state, byte) if next_state is None else next_state
            for n, token in ending[state]:
                if n <= at - base:
                    last = tokens[at - n]
                    if last < 0:
                        break
                    fits = apart.get(last << 32 | token)
                    if self._apart(last, token, data, at, n) if fits is None else fits:
                        break
            tokens.append(token)
            back.append(n)
            states.append(state)
            if emitted is not None and at - base > SPAN:
                base = self._emit(emitted, tokens, base, at, state)
        return base

    def _begin(self) -> None:
        # Of the token that ends at each place: its id and its length; and the state there.
        self.tokens, self.back, self.passed = [-1], [0], [0]

    def encode(self, data: bytes) -> list[int]:
        """Emit tokens as soon as they are certain."""
        emitted: list[int] = []
        self._begin()
        base = self._read(data, 0, 0, emitted)
        self._path(emitted, self.tokens, base, len(data))
        return emitted

    def encode_sorted(self, pieces: list[bytes]) -> Iterator[list[int]]:
        """Encode many short pieces; one that begins like the one before it goes on from there."""
        self._begin()
        before = b""
        for data in pieces:
            same = 0
            for one, two in zip(before, data):
                if one != two:
                    break
                same += 1
            del self.tokens[same + 1 :], self.back[same + 1 :], self.passed[same + 1 :]
            self._read(data, same, 0, None)
            found: list[int] = []
            self._path(found, self.tokens, 0, len(data))
            yield found
            before = data

    def _emit(self, emitted: list[int], tokens: list[int], base: int, at: int, state: int) -> int:
        """Emit the tokens on which all open places agree; the place behind them."""
        open_places = {at - n for n in range(len(self.states[state]) + 1) if at - n >= base}
        while len(open_places) > 1:
            last = max(open_places)
            open_places.remove(last)
            open_places.add(last - self.back[last] if last > base else base)
        agreed = open_places.pop()
        self._path(emitted, tokens, base, agreed)
        return agreed

    def _path(self, emitted: list[int], tokens: list[int], base: int, at: int) -> None:
        found = []
        while at > base:
            found.append(tokens[at])
            at -= self.back[at]
        emitted += found[::-1]


class Encoder:
    """Texts to ids: each match of the pattern goes through the transducer on its own.

    Pieces that were met keep their ids in a table, which is emptied when it has grown to its bound.
    """

    def __init__(self, ranks: dict[bytes, int], pattern: str):
        self.pieces = regex.compile(pattern).findall
        self.transducer = Transducer(ranks)
        self.ids: dict[str, bytes] = {}

    def _learn(self, pieces: set[str]) -> None:
        short = {piece.encode(): piece for piece in pieces if len(piece) <= SPAN}
        ordered = sorted(short)
        for data, found in zip(ordered, self.transducer.encode_sorted(ordered)):
            self.ids[short[data]] = array("i", found).tobytes()
        for piece in pieces:
            if len(piece) > SPAN:
                self.ids[piece] = array("i", self.transducer.encode(piece.encode())).tobytes()

    def encode(self, texts: list[str]) -> list[np.ndarray]:
        """The ids of a few texts, whose new pieces are encoded together."""
        cut = list(map(self.pieces, texts))
        met = set().union(*cut)
        new = met.difference(self.ids)
        if len(self.ids) + len(new) > self.transducer.entries:
            self.ids.clear()
            new = met
        self._learn(new)
        return [np.frombuffer(b"".join(map(self.ids.__getitem__, pieces)), np.int32) for pieces in cut]

    def __call__(self, text: str) -> np.ndarray:
        return self.encode([text])[0]

    def batches(self, texts: list[str | None]) -> Iterator[np.ndarray]:
        """The ids of each text, some characters' worth of texts at a time."""
        some, size = [], 0
        for text in texts:
            some.append(text or "")
            size += len(some[-1])
            if size > CHARS_AT_ONCE:
                yield from self.encode(some)
                some, size = [], 0
        yield from self.encode(some)


# Fixed values (UTF-8): first and last lead byte, the range of the byte behind it, and the state that
# waits for the bytes after that one. State 0 is between characters, 1 to 3 wait for so many
# continuation bytes, the others for a second byte from a narrower range; BAD is never left.
BETWEEN, BAD = 0, 8
LEADS = [
    (0xC2, 0xDF, 1), (0xE0, 0xE0, 4), (0xE1, 0xEC, 2), (0xED, 0xED, 5),
    (0xEE, 0xEF, 2), (0xF0, 0xF0, 6), (0xF1, 0xF3, 3), (0xF4, 0xF4, 7),
]
SECONDS = [(1, 0x80, 0xBF, 0), (2, 0x80, 0xBF, 1), (3, 0x80, 0xBF, 2), (4, 0xA0, 0xBF, 1), (5, 0x80, 0x9F, 1),
           (6, 0x90, 0xBF, 2), (7, 0x80, 0x8F, 2)]


def utf8_machine() -> np.ndarray:
    """state, byte -> state."""
    table = np.full((BAD + 1, 256), BAD, np.uint8)
    table[BETWEEN, :0x80] = BETWEEN
    for first, last, state in LEADS:
        table[BETWEEN, first : last + 1] = state
    for state, first, last, then in SECONDS:
        table[state, first : last + 1] = then
    return table


class StreamDecoder:
    """Bytes in any portions to text; an unfinished character waits for the next portion.

    Bytes that are no UTF-8 come out as U+FFFD, as many as the codec's "replace" gives.
    """

    machine = list(map(bytes, utf8_machine()))

    def __init__(self) -> None:
        self.state, self.held = BETWEEN, b""

    def feed(self, data: bytes) -> str:
        state, whole, machine = self.state, -len(self.held), self.machine
        for at, byte in enumerate(data):
            state = machine[state][byte]
            if state == BETWEEN:
                whole = at + 1
            elif state == BAD:
                return self._mend(data)
        joined = self.held + data
        cut = len(self.held) + whole
        self.state, self.held = state, joined[cut:]
        return joined[:cut].decode()

    def _mend(self, data: bytes) -> str:
        """Replace what can no longer become a character, keep an open end."""
        joined = self.held + data
        open_end = next(
            (n for n in range(min(3, len(joined)), 0, -1) if 0 < self._behind(joined[-n:]) < BAD), 0
        )
        cut = len(joined) - open_end
        self.held = joined[cut:]
        self.state = self._behind(self.held)
        return joined[:cut].decode(errors="replace")

    def _behind(self, data: bytes) -> int:
        state = BETWEEN
        for byte in data:
            state = self.machine[state][byte]
        return state

    def end(self) -> str:
        left, self.state, self.held = self.held, BETWEEN, b""
        return left.decode(errors="replace")


class Decoder:
    """Ids to text."""

    def __init__(self, ranks: dict[bytes, int]):
        self.tokens = [b""] * (max(ranks.values(), default=-1) + 1)
        for token, rank in ranks.items():
            self.tokens[rank] = token
        self.moves = self._lift()
        self.closed = self.moves[:, BETWEEN] == BETWEEN
        self.rows = list(map(bytes, self.moves))

    def _lift(self) -> np.ndarray:
        """token, state -> state behind the token."""
        machine = utf8_machine()
        moves = np.tile(np.arange(BAD + 1, dtype=np.uint8), (len(self.tokens), 1))
        lengths = np.fromiter(map(len, self.tokens), np.int64, len(self.tokens))
        for at in range(int(lengths.max(initial=0))):
            rows = np.flatnonzero(lengths > at)
            byte = np.fromiter((self.tokens[row][at] for row in rows), np.int64, len(rows))
            moves[rows] = machine[moves[rows], byte[:, None]]
        return moves

    def __call__(self, ids: np.ndarray) -> bytes:
        """The text as UTF-8. An id without a token is an error."""
        if len(ids) and (ids.min() < 0 or ids.max() >= len(self.tokens)):
            raise ValueError("an id is not in the vocabulary")
        data = b"".join(map(self.tokens.__getitem__, ids.tolist()))
        if self.closed[ids].all() or self._whole(ids):
            return data
        stream = StreamDecoder()
        return (stream.feed(data) + stream.end()).encode()

    def _whole(self, ids: np.ndarray) -> bool:
        """Whether the tokens, some of them ending inside characters, add up to characters."""
        state, moves = BETWEEN, self.rows
        for number in ids.tolist():
            state = moves[number][state]
        return state == BETWEEN


@lru_cache(maxsize=2)
def _encoder(ranks: Broadcast, pattern: str) -> Encoder:
    return Encoder(ranks.value, pattern)


@lru_cache(maxsize=2)
def _decoder(ranks: Broadcast) -> Decoder:
    return Decoder(ranks.value)


def _id_lists(found: list[np.ndarray]) -> pa.Array:
    ends = np.cumsum([0, *map(len, found)], dtype=np.int32)
    return pa.ListArray.from_arrays(pa.array(ends), pa.array(np.concatenate([np.empty(0, np.int32), *found])))


def _portions(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
    """A few rows at a time: what a task holds does not grow with the batches it is handed."""
    for batch in batches:
        for at in range(0, len(batch), ROWS_AT_ONCE):
            yield batch.slice(at, ROWS_AT_ONCE)


def encode(text: Column, ranks: Broadcast, pattern: str) -> Column:
    """The ids of each text as array<int>, without special tokens; none for null and empty text.

    `ranks` is a broadcast `read_ranks`: a vocabulary, whose size does not depend on the data.
    """

    @F.arrow_udf("array<int>")
    def ids(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        run = _encoder(ranks, pattern)
        for batch in _portions(batches):
            yield _id_lists(list(run.batches(batch.to_pylist())))

    return ids(text)


def decode(ids: Column, ranks: Broadcast) -> Column:
    """The text of each array of ids; empty for null. An id that is no token fails the query."""

    @F.arrow_udf("string")
    def text(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        run = _decoder(ranks)
        for batch in _portions(batches):
            flat = batch.flatten().to_numpy(zero_copy_only=False)
            ends = np.cumsum(pc.fill_null(pc.list_value_length(batch), 0).to_numpy(zero_copy_only=False))
            starts = np.concatenate([[0], ends[:-1]]) if len(ends) else []
            yield pa.array([run(flat[a:b]).decode() for a, b in zip(starts, ends)], pa.string())

    return text(ids)


def round_trip(text: Column, ranks: Broadcast, pattern: str) -> Column:
    """struct<ids, decoded>: `encode`, and `decode` of the same ids, in one pass through Python."""

    @F.arrow_udf("struct<ids: array<int>, decoded: string>")
    def both(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        run, back = _encoder(ranks, pattern), _decoder(ranks)
        for batch in _portions(batches):
            found = list(run.batches(batch.to_pylist()))
            texts = pa.array([back(ids).decode() for ids in found], pa.string())
            yield pa.StructArray.from_arrays([_id_lists(found), texts], ["ids", "decoded"])

    return both(text)


def encode_documents(docs: DataFrame, ranks_path: str, pattern: str, id_col: str = "doc_id", text_col: str = "text"):
    """doc_id, ids, decoded: every row encoded, and the ids decoded again.

    Null text counts as empty and has no ids; repeated rows and missing ids give a row each; other
    columns are not looked at, whatever their names. `ranks_path` is read by the driver alone.
    """
    ranks = docs.sparkSession.sparkContext.broadcast(read_ranks(ranks_path))
    coded = docs.select(F.col(id_col).alias("doc_id"), round_trip(F.col(text_col), ranks, pattern).alias("found"))
    return coded.select("doc_id", "found.ids", "found.decoded")


def digests(coded: DataFrame) -> DataFrame:
    """doc_id, n_tokens, ids_sha256, decoded_sha256 of `encode_documents`."""
    return coded.select(
        "doc_id",
        F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(F.array_join(F.col("ids").cast("array<string>"), ","), 256).alias("ids_sha256"),
        F.sha2(F.col("decoded").cast("binary"), 256).alias("decoded_sha256"),
    )
