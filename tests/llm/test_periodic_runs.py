"""Runs against a definition-by-definition search, on made and random texts."""

from __future__ import annotations

import hashlib
import random
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from tidemark.llm import periodic_runs
from tidemark.llm.queries import op11_periodic_runs


def slow_runs(words):
    """Every period, every stretch; a stretch of several periods belongs to the smallest."""
    best = {}
    n = len(words)
    for q in range(1, n // 2 + 1):
        start = 0
        while start < n - q:
            if words[start] != words[start + q]:
                start += 1
                continue
            end = start
            while end < n - q and words[end] == words[end + q]:
                end += 1
            if end + q - start >= max(12, 2 * q):
                best.setdefault((start, end + q), q)
            start = end
    return sorted((s, e - s, q) for (s, e), q in best.items())


def slow_collapsed(words, runs):
    gone = {i for s, length, q in runs for i in range(s + q, s + length)}
    return " ".join(word for i, word in enumerate(words) if i not in gone)


def fast(texts):
    out = []
    for counts, start, length, period, collapsed in periodic_runs.found_in([t if t is None else t.encode() for t in texts]):
        place = 0
        for n, text in zip(counts, collapsed):
            part = slice(place, place + n)
            out.append((list(zip(start[part].tolist(), length[part].tolist(), period[part].tolist())), text.decode()))
            place += n
    return out


def check(texts):
    for text, (runs, collapsed) in zip(texts, fast(texts), strict=True):
        words = [w.decode() for w in (text or "").encode().split()]
        assert runs == slow_runs(words), text
        assert collapsed == slow_collapsed(words, runs), text


MADE = [
    None, "", " \t\n", "a", "a " * 11, "a " * 12, "a " * 13, "a b " * 6, "a b " * 6 + "a", "x " + "a b c " * 4 + "a b y",
    "a b c d e f g " * 2, "a b c d e f " * 2, "a b c d e f " * 2 + "a", "p a b a b a b a b a b a b q a b a b a b a b a b a b",
    "a a a a a b a a a a a b a a a a a b", "a " * 300 + "b " * 300, ("a " * 20 + "b ") * 9, "a b " * 12, "\x0b\x0ca\x0b" * 14,
    " ".join(str(i % 17) for i in range(400)) + " z " + " ".join(str(i % 34) for i in range(200)),
]


def test_made_texts():
    check(MADE)


@pytest.mark.parametrize("letters", [1, 2, 3, 5])
def test_random_texts(letters):
    chance = random.Random(letters)
    texts = []
    for _ in range(300):
        words = [chance.choice("abcde"[:letters]) for _ in range(chance.randrange(60))]
        for _ in range(chance.randrange(3)):
            piece = [chance.choice("abcdefgh") for _ in range(chance.randrange(1, 40))]
            words[chance.randrange(len(words) + 1) : 0] = (piece * 5)[: chance.randrange(1, 5 * len(piece) + 1)]
        texts.append(" ".join(words))
    check(texts)


def test_fibonacci_words_have_many_runs():
    a, b = "a ", "a b "
    while len(b) < 1400:
        a, b = b, b + a
    check([b])


def test_long_stretches_and_portions(monkeypatch):
    chance = np.random.default_rng(5)
    monkeypatch.setattr(periodic_runs, "BATCH_WORDS", 900)
    monkeypatch.setattr(periodic_runs, "BATCH_PERIODS", 50)
    words = [str(w) for w in chance.integers(0, 400, 700)]
    check([" ".join(words), " ".join((words * 3)[:1500]), "q " + " ".join(words[:100] * 4), "", " ".join(words[:90] * 9), "k " * 1200])


def test_many_words():
    """Work stays near proportion for texts of one word, or one passage over and over."""
    ((one, collapsed),) = fast(["w " * 300_000])
    assert one == [(0, 300_000, 1)] and collapsed == "w"
    words = [str(w) for w in np.random.default_rng(2).integers(0, 10**6, 999)]
    ((many, collapsed),) = fast([" ".join(words * 150)])
    assert many == [(0, 149_850, 999)] and collapsed.split() == words


def test_a_nonterminal_is_computed_once():
    words = [str(w) for w in np.random.default_rng(3).integers(0, 10**6, 64)]
    symbols = np.array(list(map(int, words * 64)))
    nodes = periodic_runs.Nodes()
    joined = np.ones(len(symbols), bool)
    joined[-1] = False
    start, end = periodic_runs.re_pair(symbols, joined, nodes)
    low, mid, high, first, last, at = nodes.arrays()
    assert len(low) < 3 * 64 and (last - first).max() >= 32
    for number in range(len(low)):
        for place in at[first[number] : last[number]]:
            assert (symbols[low[number] : high[number]] == symbols[place : place + high[number] - low[number]]).all()
    assert (start[1:] == end[:-1]).all() and (start[0], end[-1]) == (0, len(symbols))


def test_damage_and_digests(spark, documents, rows_of):
    ids = range(400)
    chance = random.Random(1)
    rows = [(i, " \t".join(chance.choice("abcdefghij") for _ in range(chance.randrange(80)))) for i in ids]
    rows += [(None, "x " * 20), (7, None), (7, None), (8, ""), (9, "long " * 30_000)]
    docs = documents(*rows)
    changed = periodic_runs.repeated_tails(docs)
    found = periodic_runs.digests(periodic_runs.periodic_runs(changed)).collect()
    wanted = []
    for doc_id, text in rows:
        words = (text or "").split()
        h = None if doc_id is None else zlib.crc32(str(doc_id).encode())
        if h is not None and h % 10 == 0 and words:
            g, n = h // 10, len(words)
            a = g % n
            p = 1 + (n - a) // (3 + g % 8)
            words = [words[i] if i < a else words[a + (i - a) % p] for i in range(n)]
        runs = slow_runs(words) if len(words) < 1000 else [(0, 30_000, 1)]
        best = max(runs, key=lambda run: (run[1], -run[0], -run[2]), default=(None,) * 3)
        written = "".join(f"{s},{length},{q}\n" for s, length, q in runs)
        exponent = None if not runs else 1000 * best[1] // best[2]
        digests = [hashlib.sha256(t.encode()).hexdigest() for t in (written, slow_collapsed(words, runs))]
        wanted.append((doc_id, len(runs), *best, exponent, *digests))
    key = lambda row: (row[0] is None, row[0] or 0, str(row[1:]))
    assert sorted(map(tuple, found), key=key) == sorted(wanted, key=key)


def test_empty_table(spark, tmp_path):
    spark.createDataFrame([], "doc_id long, text string").write.parquet(f"{tmp_path}/documents.parquet")
    found = op11_periodic_runs(spark, str(tmp_path))
    assert found.collect() == [] and found.columns[:2] == ["doc_id", "n_runs"]


def test_keeps_other_id_types(spark):
    docs = spark.createDataFrame([("k", "a " * 15)], "name string, body string")
    found = periodic_runs.periodic_runs(docs, "name", "body").select("doc_id", F.col("runs")[0].period, "collapsed").collect()
    assert list(map(tuple, found)) == [("k", 1, "a")]
