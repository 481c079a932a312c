from __future__ import annotations

import itertools
import random
import zlib
from collections import Counter

import numpy as np
import public_tokenizers
import pytest

from tidemark.llm import language_id as l

PATH = public_tokenizers.path("piece_bpe_32k.model")
PARTS = {"en": ["the", "ing", "tion", "wh"], "de": ["der", "ung", "keit", "sch"], "fr": ["eau", "eux", "ère", "ou"]}


def text(draw, lang, n=25):
    return " ".join("".join(draw.choices(PARTS[lang], k=draw.randint(1, 3))) for _ in range(n))


def brute(word, probability):
    """Sum over all ways to cut the word."""
    total = 0.0
    for cuts in itertools.product([False, True], repeat=len(word) - 1):
        parts, start = [], 0
        for place, cut in enumerate([*cuts, True], 1):
            if cut:
                parts.append(word[start:place])
                start = place
        product = 1.0
        for part in parts:
            product *= probability(part)
        total += product
    return total


def test_forward_sums_all_segmentations():
    pieces = ["▁", "a", "b", "ab", "ba", "▁a", "aba", "bb"]
    draw = np.random.default_rng(1)
    tables = np.vstack([draw.random((len(pieces), 2)), np.zeros((1, 2)), [[0.01, 0.02]]])
    numbers = {piece: i for i, piece in enumerate(pieces)}

    def probability(lang):
        return lambda part: tables[numbers[part], lang] if part in numbers else (tables[-1, lang] if len(part) == 1 else 0.0)

    for size in range(1, 8):
        words = ["▁" + "".join(w) for w in itertools.islice(itertools.product("abc", repeat=size), 40)]
        found = l.Lattice(words, numbers, 3).forward(tables)[-1]
        for row, word in zip(found, words):
            assert row == pytest.approx([brute(word, probability(0)), brute(word, probability(1))])


def test_expected_counts_are_those_of_all_segmentations():
    pieces = ["a", "b", "ab"]
    table = np.array([0.3, 0.2, 0.4, 0.0, 0.1])
    lattice = l.Lattice(["ab"], {p: i for i, p in enumerate(pieces)}, 2)
    share = 0.4 / (0.4 + 0.06)
    assert lattice.expected(table[:, None], np.array([2.0])) == pytest.approx([2 * (1 - share)] * 2 + [2 * share, 0, 0])


def test_rounds_raise_the_likelihood(monkeypatch):
    draw, pieces = random.Random(2), l.read_pieces(PATH)
    words = Counter(text(draw, "de", 400).split())
    likelihoods = []
    for rounds in (1, 2, 4):
        monkeypatch.setattr(l, "ROUNDS", rounds)
        scorer = l.Scorer(pieces, ["de"], l.fit_language(words, pieces)[:, None], np.ones(1))
        scorer.learn(set(words))
        likelihoods.append(sum(n * scorer.scores[scorer.rows[word], 0] for word, n in words.items()))
    assert likelihoods == sorted(likelihoods)


def test_documents(documents, monkeypatch):
    draw = random.Random(3)
    rows = [(i, text(draw, lang), lang) for i, lang in enumerate(list(PARTS) * 40)]
    rows += [(500, None, "en"), (501, "123 ...", "de"), (None, "the thing", None), (7, text(draw, "fr"), "fr"), (502, "", "en")]
    rows += [(503, "whtion" * 500, "en"), (504, "Straße " * 30_000, None)]
    docs = documents(*rows, columns="doc_id long, text string, lang string")
    found = l.identify(docs, PATH).collect()
    assert len(found) == len(rows)
    by_id = {row.doc_id: row for row in found}
    for row in found:
        name = "" if row.doc_id is None else str(row.doc_id)
        assert row.held_out == (zlib.crc32(name.encode()) % 3 == 1) and 0 <= row.score <= 1
    held = [row for row in found if row.held_out and (row.doc_id or 999) < 120 and row.doc_id != 7]
    assert all(row.lang_pred == list(PARTS)[row.doc_id % 3] for row in held)
    assert [by_id[i].lang_pred for i in (500, 501, 502, 503)] == ["und", "und", "und", "en"] and by_id[500].score == 0


def test_nothing_to_learn_from(documents):
    columns = "doc_id long, text string, lang string"
    assert l.identify(documents(columns=columns), PATH).collect() == []
    found = l.identify(documents((1, "word", None), columns=columns), PATH).collect()
    assert [(row.lang_pred, row.score) for row in found] == [("und", 0.0)]


def test_an_emptied_table_changes_nothing(monkeypatch):
    draw, pieces = random.Random(4), l.read_pieces(PATH)
    tables = np.stack([l.fit_language(Counter(text(draw, lang, 300).split()), pieces) for lang in PARTS], axis=1)
    plain, emptied = (l.Scorer(pieces, list(PARTS), tables, np.ones(3) / 3) for _ in range(2))
    for _ in range(20):
        words = text(draw, draw.choice(list(PARTS))).split()
        plain.learn(set(words))
        with monkeypatch.context() as patch:
            patch.setattr(l, "TABLE_WORDS", 5)
            emptied.learn(set(words))
        assert plain.predict(words) == pytest.approx(emptied.predict(words))


@pytest.mark.parametrize("ids", ["one", "none", "half", "all"])
def test_samples_of_texts_whatever_their_ids(spark, ids):
    """Repeated and missing ids, and copies, keep no text out; at most `rows` different ones of a language."""
    draw = random.Random(4)
    texts = [(text(draw, lang, 6), lang) for lang in PARTS for _ in range(1_000)]
    name = {"one": lambda i: 0, "none": lambda i: None, "half": lambda i: None if i % 2 else i, "all": lambda i: i}[ids]
    rows = [(name(i), one, lang) for i, (one, lang) in enumerate(texts)]
    rows += [(name(0), texts[0][0], "en")] * 3_000
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string").repartition(4)
    sample, counts = l._sample(docs, "doc_id", "text", "lang", 50)
    learned = [r for r in rows if r[0] is None or zlib.crc32(str(r[0]).encode()) % 3 != 1]
    assert counts == dict(Counter(r[2] for r in learned))
    found = sample.collect()
    assert Counter(r.lang for r in found) == {lang: 50 for lang in PARTS}
    assert len({(r.lang, r.text) for r in found}) == len(found)
    assert {(r.lang, r.text) for r in found} <= {(r[2], r[1]) for r in learned}


def test_every_language_is_learned_from_one_repeated_id(spark):
    draw = random.Random(6)
    rows = [(0, text(draw, lang), lang) for lang in PARTS for _ in range(400)]
    found = l.identify(spark.createDataFrame(rows, "doc_id long, text string, lang string"), PATH)
    assert Counter(r.lang_pred for r in found.collect()) == {lang: 400 for lang in PARTS}


def test_long_words_are_segmented_as_a_whole():
    pieces = sorted({"▁", "a", "b", "ab", "ba", "▁a", "aba", "bb", "abab"})
    numbers = {piece: i for i, piece in enumerate(pieces)}
    draw = np.random.default_rng(1)
    tables = np.vstack([draw.random((len(pieces), 2)), np.zeros((1, 2)), [[0.01, 0.02]]])
    chance = random.Random(2)
    for size in (1, 3, 39, 40, 41, 79, 80, 150, 300):
        word = "".join(chance.choices("abc", k=size))
        whole = l.Lattice(["▁" + word], numbers, 4).forward(tables)[-1][0]
        assert l.whole_log(word, numbers, 4, tables) == pytest.approx(np.log(whole)), size
        scorer = l.Scorer(pieces, ["x", "y"], tables, np.array([0.5, 0.5]))
        scorer.learn({word})
        assert scorer.scores[scorer.rows[word]] == pytest.approx(np.log(whole)), size
    # Far beyond the least number, and long.
    logs = l.whole_log("c" * 5_000, numbers, 4, tables)
    assert logs == pytest.approx(np.log(tables[numbers["▁"]]) + 5_000 * np.log([0.01, 0.02]))
