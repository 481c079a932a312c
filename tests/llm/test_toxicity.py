from __future__ import annotations

import random
import zlib

import numpy as np
import pytest

from tidemark.llm import toxicity as t
from tidemark.llm.shared import fold


def made(draw, toxic, n):
    words = [f"{a}{b}" for a in ("an", "bel", "cor", "dan", "est") for b in ("o", "ing", "ers", "ta")]
    texts = []
    for _ in range(n):
        some = draw.choices(words, k=draw.randint(5, 40))
        if toxic:
            for _ in range(draw.randint(1, 4)):
                bad = draw.choice(["idiot", "scum", "stemmo" + draw.choice(words), "stemmo" + draw.choice(words)])
                some.insert(draw.randrange(len(some)), bad)
        texts.append(" ".join(some))
    return texts


@pytest.fixture(scope="module")
def model():
    draw = random.Random(1)
    clean, toxic = made(draw, False, 400), made(draw, True, 120)
    return t.fit(clean + toxic, [0] * 400 + [1] * 120)


def test_held_out_texts(model):
    draw = random.Random(2)
    clean = [model.score(text) for text in made(draw, False, 200)]
    toxic = [model.score(text) for text in made(draw, True, 200)]
    assert max(clean) < t.THRESHOLD and sum(score >= t.THRESHOLD for score in toxic) >= 190


def test_weights_name_the_words(model):
    assert {"=idiot", "=scum"} <= set(model.weights) and any(entry.startswith("stem") for entry in model.weights)
    assert model.accuracy.shape == (2, len(model.voters)) and model.correlation.shape == (len(model.voters),) * 2


def test_label_model_finds_accuracies_and_copies():
    draw = np.random.default_rng(3)
    truth = draw.random(4_000) < 0.3
    right = [0.95, 0.9, 0.8, 0.55]
    votes = np.stack([np.where(draw.random(4_000) < r, truth, ~truth) for r in right], axis=1).astype(float)
    votes = np.hstack([votes, votes[:, 2:3]])  # one voter copies another
    posterior, means, correlation = t.label_model(votes, votes[:, :2].mean(1))
    assert ((posterior > 0.5) == truth).mean() > 0.93
    assert np.abs(means[1][:4] - right).max() < 0.12 and correlation[2, 4] > 0.7 and abs(correlation[0, 1]) < 0.3


def test_odd_texts(model):
    assert model.score(None) == model.score("") == model.score("  \n") < 0.1
    assert model.score("word " * 100_000 + "idiot idiot scum") > model.score("word")


def test_labels_of_one_kind_or_none():
    assert t.fit([], []).score("x") < 1e-9 and t.fit(["x"], [0]).score("x") < 1e-9 and t.fit(["x"], [1]).score("x") > 0.99


def test_rows(spark, documents, rows_of):
    draw = random.Random(4)
    texts = made(draw, False, 150) + made(draw, True, 80)
    rows = [(i, text) for i, text in enumerate(texts)] + [(None, "idiot scum"), (7, None), (7, None), (900, "")]
    labels = [(i, 1, int(i >= 150)) for i in range(230)] + [(None, 1, 1), (3, 1, 0), (3, None, None), (5_000, 0, 1)]
    found = t.toxicity(documents(*rows), spark.createDataFrame(labels, "doc_id long, quality int, toxic int")).collect()
    assert len(found) == len(rows)
    for row in found:
        text = "" if row.doc_id is None else str(row.doc_id)
        assert row.held_out == (zlib.crc32(text.encode()) % 3 == 1) and row.predicted == int(row.score >= 0.7)
    held = [row for row in found if row.held_out and row.doc_id is not None and row.doc_id < 230]
    assert sum((row.doc_id >= 150) == row.predicted for row in held) > 0.9 * len(held)


def test_held_out_labels_are_never_learned_from(spark):
    labels = spark.range(300).selectExpr("id AS doc_id", "1 AS quality", "CAST(id % 2 AS INT) AS toxic")
    kept = t.training_labels(labels)
    assert kept.where(fold(kept.doc_id, 3) == 1).count() == 0 and kept.count() > 150


def test_empty_tables(spark, documents):
    none = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    assert t.toxicity(documents(), none).collect() == []
    assert [row.score < 1e-9 for row in t.toxicity(documents((1, "x")), none).collect()] == [True]
