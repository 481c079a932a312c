from __future__ import annotations

import random

import numpy as np

from tidemark.llm import quality as q


def prose(draw):
    words = [draw.choice("abcdefgh") + draw.choice(["an", "ing", "ter", "os"]) * draw.randint(1, 2) for _ in range(60)]
    return " ".join(words).capitalize() + "."


def junk(draw, kind):
    text = prose(draw)
    if kind == 0:
        return text.upper().replace(" ", "!! ")
    if kind == 1:
        return " ".join(word + draw.choice(["***", "&&&", "$$$"]) for word in text.split())
    if kind == 2:
        return " ".join(word for word in text.split()[:4] for _ in range(30))
    return text.replace(" ", " | ")


def test_good_texts_stay_and_junk_goes():
    draw = random.Random(1)
    weights, bias = q.fit([prose(draw) for _ in range(300)] + [junk(draw, i % 4) for i in range(100)])
    score = q.Scorer(weights, bias)
    assert min(score(prose(draw)) for _ in range(100)) > 0.5
    assert max(score(junk(draw, i % 4)) for i in range(100)) < 0.5


def test_label_model_finds_accuracies():
    draw = np.random.default_rng(2)
    good = draw.random(5_000) < 0.7
    votes = []
    for right, spoken in ((0.95, 0.9), (0.85, 0.8), (0.75, 0.6), (0.9, 0.3)):
        said = np.where(draw.random(5_000) < right, np.where(good, 1, -1), np.where(good, -1, 1))
        votes.append(np.where(draw.random(5_000) < spoken, said, 0))
    posterior, table = q.label_model(np.stack(votes, axis=1))
    assert ((posterior > 0.5) == good).mean() > 0.93
    found = table[1, :, 2] / (table[1, :, 2] + table[1, :, 0])
    assert np.abs(found - [0.95, 0.85, 0.75, 0.9]).max() < 0.06


def test_shapes_do_not_depend_on_the_table(monkeypatch):
    words = ["a", "Abc,", "ABC", "x***", "x****", "12.5%", "é!", "_", "a_b", "...", ".,", "X"]
    alone = [q.shape_number(word) for word in words]
    monkeypatch.setattr(q, "TABLE_WORDS", 2)
    shapes = q.Shapes()
    assert shapes(words).tolist() == shapes(words).tolist() == alone


def test_rows(documents):
    draw = random.Random(3)
    rows = [(i, prose(draw) if i % 4 else junk(draw, i // 4 % 4)) for i in range(200)]
    rows += [(None, "x"), (None, None), (5, ""), (5, ""), (300, "word " * 100_000)]
    found = q.quality(documents(*rows)).collect()
    assert len(found) == len(rows) and all(0 <= row.score <= 1 for row in found)
    kept = {row.doc_id: row.kept for row in found}
    assert sum(kept[i] == bool(i % 4) for i in range(6, 200)) >= 185
    assert q.quality(documents()).collect() == []


def test_a_rare_kind_of_bad_text_is_learned_whatever_the_sample(documents, monkeypatch):
    monkeypatch.setattr(q, "SAMPLE_ROWS", 40)
    draw = random.Random(4)
    rows = [(i, prose(draw) if i % 4 else junk(draw, i // 4 % 3)) for i in range(2_000)] + [(2_000 + i, junk(draw, 3)) for i in range(4)]
    found = {row.doc_id: row.score for row in q.quality(documents(*rows)).collect()}
    assert max(found[2_000 + i] for i in range(4)) < 0.5 < min(found[i] for i in range(2_000) if i % 4)


def test_patterns_stand_for_their_documents():
    draw = random.Random(5)
    votes = np.array([q.votes_of(prose(draw) if i % 3 else junk(draw, i % 4)) for i in range(300)])
    numbers = np.array([q.pattern_of(row) for row in votes.tolist()])
    patterns, at, counts = np.unique(numbers, return_inverse=True, return_counts=True)
    assert (q.votes_in(patterns)[at] == votes).all()
    one, two = q.label_model(votes), q.label_model(q.votes_in(patterns), counts=counts)
    assert np.abs(one[0] - two[0][at]).max() < 1e-6 and np.abs(one[1] - two[1]).max() < 1e-6
    for rows in (5, 40, 1_000):
        wanted = q.quotas(counts, rows)
        assert (wanted <= counts).all() and wanted.sum() <= rows and (rows < len(counts) or (wanted > 0).all())


def test_copies_do_not_take_the_places_of_other_texts(spark):
    """301 texts of a pattern, one of them 60,000 times, beside 5,000 of another: as without the copies."""
    bad = spark.range(301).selectExpr("1 AS pattern", "xxhash64(id) AS key")
    good = spark.range(5_000).selectExpr("0 AS pattern", "xxhash64(-id - 1) AS key")
    copies = spark.range(60_000).selectExpr("1 AS pattern", "xxhash64(0L) AS key")
    patterns, texts = np.array([0, 1]), np.array([5_000, 301])
    plain = q.picked_texts(good.union(bad), patterns, texts, 3_000)
    crowded = q.picked_texts(good.union(bad).union(copies), patterns, texts, 3_000)
    assert sorted(map(tuple, crowded.collect())) == sorted(map(tuple, plain.collect()))
    assert crowded.where("pattern = 1").count() == 301
    assert crowded.where("pattern = 0").count() == q.quotas(texts, 3_000)[0]
