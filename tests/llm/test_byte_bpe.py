from __future__ import annotations

import hashlib
import random

import numpy as np
import public_tokenizers
import pytest
import tiktoken

import __spark_entry__ as entry
from strata.llm import byte_bpe as b
from tests.llm.frames import documents

FOLDER = "/root/testdata/sf0.001"
PATH = public_tokenizers.path("byte_bpe_50k.tiktoken")


@pytest.fixture(scope="module")
def ranks():
    return b.read_ranks(PATH)


@pytest.fixture(scope="module")
def library(ranks):
    return tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})


def strings(rng, n):
    """Byte strings in which merges reach far: few letters, runs, words."""
    for _ in range(n):
        alphabet = rng.choice([b"a", b"ab", b"an", b"aeth", b" ", b"0123456789", b"=-", bytes(range(256))])
        yield bytes(rng.choice(alphabet) for _ in range(rng.randrange(1, 200)))


def test_tree_reduction_is_the_plain_merge(ranks, library, monkeypatch):
    rng = random.Random(1)
    v = b.Vocabulary(ranks)
    monkeypatch.setattr(b, "LEAF_BYTES", 1)
    for piece in strings(rng, 1500):
        want = library._encode_single_piece(piece)
        assert v.encode(piece) == want
        assert v._merge_by_heap(piece) == v.merge(piece)
        cut = rng.randrange(len(piece) + 1)
        assert v.join(v.merge(piece[:cut]), v.merge(piece[cut:])) == v.merge(piece)
        assert v.decode(np.array(want)) == piece
    with pytest.raises(ValueError, match="no ranks"):
        v.decode(np.array([5, 60_000]))


def test_joins_of_an_own_vocabulary_with_odd_ranks():
    """Ranks that no training gives: any order of merges over two letters."""
    rng = random.Random(2)
    for _ in range(60):
        words = {bytes([i]) for i in range(256)}
        grown = [b"a", b"b"]
        for _ in range(12):
            grown.append(rng.choice(grown) + rng.choice(grown))
        extra = list(dict.fromkeys(w for w in grown if len(w) > 1))
        rng.shuffle(extra)
        v = b.Vocabulary({w: i for i, w in enumerate([*sorted(words), *extra])})
        for _ in range(40):
            text = bytes(rng.choice(b"ab") for _ in range(rng.randrange(2, 60)))
            cut = rng.randrange(1, len(text))
            assert v.join(v.merge(text[:cut]), v.merge(text[cut:])) == v.merge(text)


def test_missing_bytes_are_named(ranks):
    with pytest.raises(ValueError, match="bytes without a token"):
        b.Vocabulary({b"a": 0})


def rows_of(texts, library):
    out = []
    for doc, text in texts:
        ids = library.encode_ordinary(text or "")
        out.append((doc, len(ids), hashlib.sha256(" ".join(map(str, ids)).encode()).hexdigest(), hashlib.sha256((text or "").encode()).hexdigest()))
    return sorted(out, key=str)


def test_query_equals_the_library(spark, library):
    got = sorted(map(tuple, entry.queries()["op13_byte_bpe"](spark, FOLDER).collect()), key=str)
    texts = [tuple(r) for r in spark.read.parquet(f"{FOLDER}/documents.parquet").select("doc_id", "text").collect()]
    assert got == rows_of(texts, library)


def test_odd_texts(spark, ranks, library, monkeypatch):
    texts = [
        (1, None), (2, ""), (3, " "), (4, " \n\t  \r\n"), (5, "don't we'll 'S ''s it's"), (6, "<|endoftext|> is text"),
        (7, "a" * 30_001), (8, " " * 20_000 + "x"), (9, "äöü é é 你好\U0001f600 ​\x00\x1c\x85"),
        (10, "12345678901234567890 " * 50), (10, "repeated id"), (10, "repeated id"), (None, "no id"),
        (11, "long text of words, " * 60_000),
    ]
    docs = documents(spark, texts, {"ids": 1, "decoded": "x"})
    found = b.decode(b.encode(docs, ranks, public_tokenizers.PATTERN), ranks)
    assert sorted(map(tuple, b.digests(found).collect()), key=str) == rows_of(texts, library)
    assert {(r["doc_id"], bytes(r["decoded"]).decode()) for r in found.collect()} == {(i, t or "") for i, t in texts}


def test_empty_table(spark, ranks):
    found = b.digests(b.decode(b.encode(documents(spark, []), ranks, public_tokenizers.PATTERN), ranks))
    assert found.count() == 0 and found.columns == ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"]
