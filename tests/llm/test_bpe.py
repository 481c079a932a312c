from __future__ import annotations

import hashlib
import random

import public_tokenizers
import pytest
import tiktoken

from tidemark.llm import bpe

PATH = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
ALPHABET = ["a", "b", "th", "é", "漢", "字", "😀", "и", " ", "\n", "1", "'s", "̀", "\xa0", "Zz", "."]


@pytest.fixture(scope="module")
def ranks():
    return bpe.read_ranks(PATH)


@pytest.fixture(scope="module")
def reference(ranks):
    return tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})


def some_texts():
    draw = random.Random(6)
    texts = ["".join(draw.choice(ALPHABET) for _ in range(draw.randint(0, 60))) for _ in range(800)]
    letters = "".join(draw.choice("aeiountrsl漢字и") for _ in range(20_000))
    return [*texts, "", "<|endoftext|>", letters, "a" * 9_000, " " * 9_000 + "x", "ab" * 5_000]


def test_ids_are_those_of_the_library(ranks, reference):
    encode, decode = bpe.Encoder(ranks, public_tokenizers.PATTERN), bpe.Decoder(ranks)
    for text in some_texts():
        ids = encode(text)
        assert ids.tolist() == reference.encode_ordinary(text)
        assert decode(ids).decode() == text


def test_neighbours_are_judged_as_the_merges_do(ranks):
    machine, draw = bpe.Transducer(ranks), random.Random(7)
    short = [token for token in ranks if len(token) < 6]
    for _ in range(20_000):
        one, two = draw.choice(short), draw.choice(short)
        if machine.may_follow(b"", one):
            assert machine.may_follow(one, two) == (machine.merge(one + two) == [one, two])


def test_emptied_tables_change_nothing(ranks, reference, monkeypatch):
    monkeypatch.setattr(bpe, "TABLE_ENTRIES", 50)
    monkeypatch.setattr(bpe, "SPAN", 30)
    encode = bpe.Encoder(ranks, public_tokenizers.PATTERN)
    encode.transducer.entries = 50
    for text in some_texts()[:200] + ["weiterhin" * 50]:
        assert encode(text).tolist() == reference.encode_ordinary(text)


def test_texts_encoded_together(ranks, reference, monkeypatch):
    monkeypatch.setattr(bpe, "CHARS_AT_ONCE", 500)
    encode, texts = bpe.Encoder(ranks, public_tokenizers.PATTERN), [*some_texts(), None]
    encode.transducer.entries = 2_000
    found = [ids.tolist() for ids in encode.batches(texts)]
    assert found == [reference.encode_ordinary(text or "") for text in texts]


def test_stream_decoder_equals_the_codec():
    draw = random.Random(8)
    for _ in range(3_000):
        data = bytes(draw.choice(b"\x41\xc3\xa9\xe2\x82\xac\xf0\x9f\x98\x80\xff\xed\xa0\xe0\xf4\x90") for _ in range(draw.randint(0, 12)))
        cuts = sorted(draw.randint(0, len(data)) for _ in range(3))
        stream = bpe.StreamDecoder()
        parts = [stream.feed(data[a:b]) for a, b in zip([0, *cuts], [*cuts, len(data)])]
        assert "".join(parts) + stream.end() == data.decode(errors="replace")


def test_unknown_ids_are_an_error(ranks):
    with pytest.raises(ValueError):
        bpe.Decoder(ranks)(bpe.np.array([len(ranks)], bpe.np.int32))


def test_documents(documents, reference):
    rows = [(1, "Ein Wört"), (1, "Ein Wört"), (2, None), (3, ""), (None, "x"), (4, "lang " * 30_000)]
    found = bpe.digests(bpe.encode_documents(documents(*rows), PATH, public_tokenizers.PATTERN)).collect()
    expected = []
    for doc_id, text in rows:
        ids = reference.encode_ordinary(text or "")
        digests = [hashlib.sha256(data.encode()).hexdigest() for data in (",".join(map(str, ids)), text or "")]
        expected.append((doc_id, len(ids), *digests))
    assert sorted(map(tuple, found), key=str) == sorted(expected, key=str)
    assert bpe.encode_documents(documents(), PATH, public_tokenizers.PATTERN).collect() == []


def test_columns_of_ids(spark, documents, ranks, reference, monkeypatch):
    monkeypatch.setattr(bpe, "ROWS_AT_ONCE", 2)
    shared = spark.sparkContext.broadcast(ranks)
    docs = documents(*enumerate(["one é", None, "", "漢字 two", "x"]))
    coded = docs.select("doc_id", bpe.encode(docs.text, shared, public_tokenizers.PATTERN).alias("ids"))
    back = coded.select("doc_id", "ids", bpe.decode(coded.ids, shared).alias("text")).orderBy("doc_id").collect()
    assert [row.ids for row in back] == [reference.encode_ordinary(text) for text in ("one é", "", "", "漢字 two", "x")]
    assert [row.text for row in back] == ["one é", "", "", "漢字 two", "x"]
