from __future__ import annotations

import random

import numpy as np
import pytest
import xxhash

from tidemark.llm import simhash
from tidemark.llm.components import component_labels


def brute_fingerprint(text, shingle):
    words = (text or "").encode().lower().split()
    if not words:
        return 0
    runs = [b" ".join(words[i : i + shingle]) for i in range(max(1, len(words) - shingle + 1))]
    hashes = [xxhash.xxh64(run, seed=42).intdigest() for run in runs]
    return sum(1 << bit for bit in range(64) if 2 * sum(h >> bit & 1 for h in hashes) > len(hashes))


def brute_components(prints, distance):
    label = list(range(len(prints)))
    for i in range(len(prints)):
        for j in range(i):
            if (prints[i] ^ prints[j]).bit_count() <= distance and label[i] != label[j]:
                label = [label[j] if one == label[i] else one for one in label]
    return label


def texts(draw, n):
    base = [" ".join(f"w{draw.randint(0, 50)}" for _ in range(draw.randint(1, 80))) for _ in range(n // 4)]
    found = []
    for _ in range(n):
        words = draw.choice(base).split()
        if draw.random() < 0.5:
            words[draw.randrange(len(words))] = "Other"
        found.append(" ".join(words))
    return found


def test_fingerprints_are_those_of_the_definition():
    draw = random.Random(1)
    for text in [*texts(draw, 60), None, "", " \n", "One", "one two", "É é É", "a\x0bb\x1cc", "x " * 70_000]:
        assert simhash.fingerprint(text, 3) == brute_fingerprint(text, 3)


def test_components_equal_brute_force(documents):
    draw = random.Random(2)
    rows = [(i, text) for i, text in enumerate(texts(draw, 120))] + [(500, None), (501, ""), (502, "one"), (7, "one")]
    found = simhash.near_duplicates(documents(*rows, (None, "one"), (None, "lonely")), 3, 2).collect()
    prints = [brute_fingerprint(text, 3) for _, text in rows]
    label = brute_components(prints, 2)
    first = {}
    for (doc_id, _), one in zip(rows, label):
        first[one] = min(first.get(one, doc_id), doc_id)
    expected = sorted((doc_id, first[one]) for (doc_id, _), one in zip(rows, label))
    assert sorted((r.doc_id, r.component_id) for r in found if r.doc_id is not None) == expected
    assert {r.component_id for r in found if r.doc_id is None} == {7, None}


@pytest.mark.parametrize("group_rows", [8, 100, 20_000])
def test_links_equal_all_pairs_however_groups_are_split(spark, group_rows):
    draw = np.random.default_rng(3)
    base = draw.integers(0, 1 << 63, 30, dtype=np.uint64)
    near = [base ^ np.uint64(1 << int(a)) ^ np.uint64(1 << int(b)) for a, b in draw.integers(0, 64, (12, 2))]
    values = np.unique(np.concatenate([base, *near])).view(np.int64).tolist()
    table = spark.createDataFrame([(v,) for v in values], "fingerprint long")
    found = sorted(map(tuple, simhash.links(table, 2, group_rows).collect()))
    bits = [v & (1 << 64) - 1 for v in values]
    pairs = [
        tuple(sorted((values[i], values[j])))
        for i in range(len(values))
        for j in range(i)
        if (bits[i] ^ bits[j]).bit_count() <= 2
    ]
    assert found == sorted(pairs)


def test_a_long_chain_is_one_component(spark):
    nodes = list(range(200))
    random.Random(5).shuffle(nodes)
    links = spark.createDataFrame([*zip(nodes, nodes[1:]), (900, 901)], "u long, v long")
    labels = {r.node: r.label for r in component_labels(links).collect()}
    assert {labels[node] for node in nodes} == {0} and labels[901] == 900


def test_one_of_each(documents):
    rows = [(4, "one two"), (3, "One  two"), (3, "one two"), (None, "lonely"), (None, "lonely"), (1, None), (2, ""), (9, "x y z")]
    docs = documents(*rows)
    left = simhash.one_of_each(docs, 3, 2)
    assert left.columns == docs.columns
    assert sorted((r.doc_id is None, r.doc_id) for r in left.collect()) == [(False, 1), (False, 3), (False, 9), (True, None)]


def test_empty_table(documents):
    assert simhash.near_duplicates(documents(), 3, 2).collect() == []
    assert simhash.one_of_each(documents(), 3, 2).collect() == []


def _rounds(spark, monkeypatch, links):
    """Labels, and how many tables were stored on the way."""
    from tidemark.llm import components

    stored, plain = [], components.stage
    monkeypatch.setattr(components, "stage", lambda df: stored.append(df) or plain(df))
    table = spark.createDataFrame(links, "u long, v long").coalesce(1)
    return {r.node: r.label for r in components.component_labels(table).collect()}, len(stored)


@pytest.mark.parametrize("shape", ["ordered", "zigzag", "star"])
def test_rounds_follow_the_logarithm(spark, monkeypatch, shape):
    n = 1_000
    nodes = list(range(n))
    if shape == "zigzag":
        nodes = [node for pair in zip(range(n // 2), range(n - 1, n // 2 - 1, -1)) for node in pair]
    links = [(n - 1, node) for node in range(n - 1)] if shape == "star" else list(zip(nodes, nodes[1:]))
    labels, stored = _rounds(spark, monkeypatch, links)
    assert set(labels) == set(range(n)) and set(labels.values()) == {0}
    assert stored <= 40, stored


def test_links_with_a_null_end(spark, monkeypatch):
    assert _rounds(spark, monkeypatch, [(None, 1), (2, None), (None, None), (4, 3), (3, 3)])[0] == {3: 3, 4: 3}
    assert _rounds(spark, monkeypatch, [])[0] == {}
