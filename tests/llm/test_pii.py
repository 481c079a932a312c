from __future__ import annotations

import hashlib
import random
import re

import pytest

from tidemark.llm import pii

EMAIL = re.compile(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+")
IP = re.compile(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)")
CARD = re.compile(r"[0-9]([\x20-]?[0-9])+")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")


def brute(text):
    found = [("email", *m.span()) for m in EMAIL.finditer(text)]
    found += [("ip", *m.span()) for m in IP.finditer(text) if all(int(p) <= 255 for p in m.group().split("."))]
    for kind, pattern, least, most in (("card", CARD, 14, 19), ("phone", PHONE, 10, 15)):
        for m in pattern.finditer(text):
            digits = [int(c) for c in m.group() if c in "0123456789"]
            luhn = sum(sum(divmod(d * (1 + i % 2), 10)) for i, d in enumerate(reversed(digits))) % 10 == 0
            if least <= len(digits) <= most and (kind == "phone" or luhn):
                found.append((kind, *m.span()))
    return sorted(found, key=lambda s: (s[1], pii.KINDS.index(s[0])))


def some_texts(n=15_000):
    draw = random.Random(1)
    parts = ["a", "b.", "@", "1", "22", ".", "-", " ", "+", "(", ")", "255", "256", ".3", "4539148803436467", "é", "٣"]
    return ["".join(draw.choice(parts) for _ in range(draw.randint(1, 25))) for _ in range(n)]


def test_base_spans_are_those_of_the_patterns():
    for text in some_texts():
        assert pii.base_spans(text) == brute(text)


def test_base_spans_always_stay():
    for text in some_texts(4_000):
        base, added = pii.all_spans(text)
        assert base == brute(text) and not set(base) & set(added)


@pytest.mark.parametrize(
    ("text", "kind", "found"),
    [
        ("write to john (at) example (dot) com now", "email", "john (at) example (dot) com"),
        ("john dot smith at mail dot example dot org.", "email", "john dot smith at mail dot example dot org"),
        ("jоhn@exаmple.com", "email", "jоhn@exаmple.com"),
        ("mail user[at]host.net", "email", "user[at]host.net"),
        ("a​b@c.de", "email", "a​b@c.de"),
        ("call plus four nine one five one two three four five six seven ok", "phone",
         "plus four nine one five one two three four five six seven"),
        ("vier fünf drei neun eins vier acht acht null drei vier drei sechs vier sechs sieben", "card",
         "vier fünf drei neun eins vier acht acht null drei vier drei sechs vier sechs sieben"),
        ("ip one nine two dot one six eight dot zero dot one end", "ip", "one nine two dot one six eight dot zero dot one"),
        ("pay ４５３９ １４８８ ０３４３ ６４６７", "card", "４５３９ １４８８ ０３４３ ６４６７"),
    ],
)
def test_disguises_map_back_to_the_source(text, kind, found):
    _, added = pii.all_spans(text)
    assert [(k, text[a:b]) for k, a, b in added] == [(kind, found)]


@pytest.mark.parametrize(
    "text", ["look at the dot on it", "one two three four", "meet at noon. dot the i", "a three-point plan", "ΑΒΓ и so", "5 at 6.30"]
)
def test_clean_texts_stay_clean(text):
    assert pii.all_spans(text) == ([], [])


def test_hostile_texts_are_read_once():
    for text in ["9" * 300_000, "a" * 300_000 + "@", "@" * 50_000, "one " * 50_000, "a.b at " * 20_000, "1." * 100_000, "+1" + " " * 200_000]:
        pii.all_spans(text)


def test_documents(documents):
    rows = [(1, "x@y.org 1.2.3.4"), (1, "x@y.org 1.2.3.4"), (2, None), (3, ""), (None, "joe (at) x.com"), (4, "é" * 100_000 + " a@b.c")]
    found = {(r.doc_id, r.spans): r for r in pii.digests(pii.personal_data(documents(*rows))).collect()}
    assert {key[1] for key in found} == {"email:0:7,ip:8:15", "", "email:0:14", "email:100001:100006"}
    row = found[1, "email:0:7,ip:8:15"]
    assert (row.n_email, row.n_ip, row.n_card, row.n_phone, row.n_added) == (1, 1, 0, 0, 0)
    assert row.base_sha256 == hashlib.sha256(b"email:0:7,ip:8:15").hexdigest()
    added = found[None, "email:0:14"]
    assert added.n_email == 0 and added.n_added == 1 and added.base_sha256 == hashlib.sha256(b"").hexdigest()
    texts = sorted(str(r.text)[-20:] for r in pii.masked(documents(*rows)).collect())
    assert texts.count("[email] [ip]") == 2 and "None" in texts and "[email]" in texts
    assert pii.personal_data(documents()).collect() == []


@pytest.mark.parametrize(
    ("text", "kind", "found"),
    [
        *(
            (f"write to {one} now", "email", one)
            for one in (
                "jane@example[.]com", "jane at example.com", "jane@example(punkt)de", "info@firma [punkt] de", "jane @ example.com",
                *(f"jane at example dot {last}" for last in "nl it pl ru se us ca museum".split()),
            )
        ),
        *(
            (f"call {one} ok", "phone", one)
            for one in ("plus 4 9 1 5 1 two 3 4 5 6 7", "plus" + " five" * 11, "plus 49 151 two 345 six 7", "+49 151 two 345 6 seven")
        ),
        ("pay 4539 1488 zero 343 6467.", "card", "4539 1488 zero 343 6467"),
        ("pay 4 5 3 9 1 4 8 8 0 3 4 3 6 4 6 seven.", "card", "4 5 3 9 1 4 8 8 0 3 4 3 6 4 6 seven"),
    ],
)
def test_the_gates_let_every_known_disguise_through(text, kind, found):
    assert (kind, found) in [(k, text[a:b]) for k, a, b in pii.all_spans(text)[1]]


@pytest.mark.parametrize(
    "text",
    ["look at the dot matrix", "we met at noon.Then it rained", "ask us at example.com", "at 5 @ home", "one 12 and 3", "see you at 10.30 in room two"],
)
def test_sentences_stay_clean(text):
    assert pii.all_spans(text) == ([], [])
