from __future__ import annotations

import random
import re
from collections import Counter

import pytest

from tidemark.llm import decontamination as d


def words_of(text):
    lowered = (text or "").translate(str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"))
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", lowered)


def brute(rows, items, size):
    windows = {}
    for item_id, text in items:
        words = words_of(text)
        for i in range(max(1, len(words) - size + 1) if words else 0):
            windows.setdefault(tuple(words[i : i + size]), set()).add(item_id)
    found = []
    for doc_id, text in rows:
        words, hit, owners = words_of(text), set(), set()
        for window, ids in windows.items():
            for i in range(len(words) - len(window) + 1):
                if tuple(words[i : i + len(window)]) == window:
                    hit.update(range(i, i + len(window)))
                    owners |= ids
        listed = sorted(str(i) for i in owners if i is not None)
        found.append((doc_id, len(words), len(hit), listed, bool(hit)))
    return sorted(found, key=str)


def found_rows(df):
    columns = ("doc_id", "n_words", "n_hit", "items", "contaminated")
    return sorted((tuple(row) for row in df.select(*columns).collect()), key=str)


@pytest.mark.parametrize("size", [1, 2, 3, 10])
def test_equals_brute_force(spark, documents, size):
    draw = random.Random(size)

    def text(n):
        return " ".join(draw.choice(["a", "B", "c", "É", "é", "d1", "K"]) for _ in range(draw.randint(0, n)))

    rows = [(i % 30, text(25)) for i in range(40)] + [(None, "a b c"), (77, None), (78, "...")]
    rows += [(79, "a b c " * 2_000)]
    items = [(i % 9, text(14)) for i in range(12)] + [(None, "a b c"), (3, None), (4, "!")]
    table = spark.createDataFrame(items, "item_id int, text string")
    found = found_rows(d.contamination(documents(*rows), table, window=size))
    assert found == brute(rows, items, size)


def test_unicode_letters_keep_their_case(spark, documents):
    table = spark.createDataFrame([(1, "Éa b")], "item_id int, text string")
    found = found_rows(d.contamination(documents((1, "éa b"), (2, "x ÉA B")), table))
    assert [row[2] for row in found] == [0, 2]


def test_clean_drops_contaminated_rows_only(spark, documents):
    docs = documents((1, "x y z one two"), (1, "nothing here"), (None, "one two"), (2, None))
    table = spark.createDataFrame([(1, "one two")], "item_id int, text string")
    left = d.clean(docs, table)
    assert left.columns == docs.columns
    assert sorted((r.doc_id, r.text or "") for r in left.collect()) == [(1, "nothing here"), (2, "")]


def test_near_places(spark, documents):
    table = spark.createDataFrame([(1, "alpha beta gamma")], "item_id int, text string")
    texts = ["alpha beta gamma", "alpha x beta x gamma", "gamma beta alpha", "alpha beta", "alpha " + "x " * 9 + "beta gamma", "beta gamma"]
    found = d.contamination(documents(*enumerate(texts)), table, slack=4).collect()
    assert {r.doc_id for r in found if r.near_items} == {0, 1, 2}
    assert {r.doc_id for r in found if r.contaminated} == {0}


def brute_near(rows, items, size, slack):
    """All words of a window near their places, counted from the rarest one."""
    lists = [words_of(text) for _, text in rows]
    postings = Counter(word for words in lists for word in words)
    windows = {}
    for item_id, text in items:
        words = words_of(text)
        for i in range(max(1, len(words) - size + 1) if words else 0):
            windows.setdefault(tuple(words[i : i + size]), set()).add(item_id)
    found = []
    for (doc_id, _), words in zip(rows, lists):
        places, owners = {}, set()
        for place, word in enumerate(words):
            places.setdefault(word, []).append(place)
        for window, ids in windows.items():
            if all(word in postings for word in window):
                anchor = min(range(len(window)), key=lambda at: (postings[window[at]], at))
                for start in (place - anchor for place in places.get(window[anchor], [])):
                    if all(any(abs(p - start - at) <= slack for p in places.get(word, [])) for at, word in enumerate(window)):
                        owners |= ids
        found.append((doc_id, sorted(str(i) for i in owners if i is not None)))
    return sorted(found, key=str)


@pytest.mark.parametrize(("size", "slack"), [(1, 2), (2, 1), (10, 4)])
def test_proximity_equals_brute_force(spark, documents, size, slack):
    draw = random.Random(size)

    def text(n):
        return " ".join(draw.choice("abcdefghij") for _ in range(draw.randint(0, n)))

    items = [(i % 9, text(16)) for i in range(10)] + [(None, "a b"), (3, None)]
    rows = [(i % 30, text(30)) for i in range(40)] + [(None, "a b c"), (77, None)]
    for i, (_, passage) in enumerate(items[:10]):
        words = passage.split()
        words.insert(draw.randint(0, len(words)), "z")
        at = draw.randrange(len(words))
        words[at : at + 3] = reversed(words[at : at + 3])
        rows.append((100 + i, " ".join(words)))
    table = spark.createDataFrame(items, "item_id int, text string")
    found = d.contamination(documents(*rows), table, window=size, slack=slack).select("doc_id", "near_items").collect()
    assert sorted(map(tuple, found), key=str) == brute_near(rows, items, size, slack)


def test_empty_tables(spark, documents):
    none = spark.createDataFrame([], "item_id int, text string")
    some = spark.createDataFrame([(1, "a b")], "item_id int, text string")
    assert found_rows(d.contamination(documents((1, "a b")), none)) == [(1, 2, 0, [], False)]
    assert found_rows(d.contamination(documents(), some)) == []
    assert d.clean(documents(), some).collect() == []


def test_main_path_is_native(spark, documents):
    table = spark.createDataFrame([(1, "a b")], "item_id int, text string")
    plan = d.contamination(documents((1, "a b")), table)._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan and "CartesianProduct" not in plan
