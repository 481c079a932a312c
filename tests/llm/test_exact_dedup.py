from __future__ import annotations

import hashlib
import random
import re

from tidemark.llm.exact_dedup import exact_duplicates, without_duplicates

LONG = "word " * 60_000


def folded(text):
    return re.sub(r"[\x20\x09-\x0D]+", " ", text or "")


def brute(rows):
    groups = {}
    for doc_id, text in rows:
        groups.setdefault(folded(text), []).append(doc_id)
    found = []
    for doc_id, text in rows:
        ids = groups[folded(text)]
        known = [i for i in ids if i is not None]
        keep = min(known) if known else None
        digest = hashlib.sha256(folded(text).encode()).hexdigest()
        found.append((doc_id, keep, len(ids), doc_id == keep, digest))
    return sorted(found, key=lambda row: tuple((v is None, str(v)) for v in row))


ROWS = [
    (5, "same  text\n"), (3, "same text "), (9, "same text"), (1, None), (2, ""), (7, "  "), (8, " "), (4, LONG),
    (6, LONG), (10, LONG + "x"), (11, "same tëxt"), (11, "same tëxt"), (None, "nobody"), (None, "same text"),
    (12, "a" * 300 + "b"), (13, "a" * 300 + "c"),
]
COLUMNS = ("doc_id", "keep_id", "group_size", "kept", "text_sha256")


def test_equals_brute_force(documents, rows_of):
    assert rows_of(exact_duplicates(documents(*ROWS), digest_all=True), *COLUMNS) == brute(ROWS)


def test_random_texts(documents, rows_of):
    draw = random.Random(4)
    rows = [(i, "".join(draw.choice("ab \n ") for _ in range(draw.randint(0, 4)))) for i in range(300)]
    assert rows_of(exact_duplicates(documents(*rows), digest_all=True), *COLUMNS) == brute(rows)


def test_one_row_of_each_text_stays(documents):
    docs = documents(*ROWS)
    left = without_duplicates(docs)
    assert left.columns == docs.columns
    found = sorted(left.collect(), key=str)
    assert sorted(folded(row.text) for row in found) == sorted({folded(text) for _, text in ROWS})
    ids = {folded(row.text): row.doc_id for row in found}
    assert ids["same text"] == 9 and ids["same text "] == 3 and ids[" "] == 7 and ids[""] == 1
    assert all(row["a.b"] == "dot" for row in found)


def test_empty_table(documents):
    assert exact_duplicates(documents()).collect() == [] and without_duplicates(documents()).collect() == []
