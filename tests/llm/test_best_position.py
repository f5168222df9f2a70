from __future__ import annotations

import math
import random
import re

import numpy as np

from strata.llm import best_position as b
from tests.llm.frames import documents, words

TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")


def terms_of(text):
    return TERM.findall("".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or ""))


def plain(docs, items, k=10):
    """All scores of all documents, sorted."""
    texts = [(doc, terms_of(text)) for doc, text in docs]
    n_docs, n_terms = sum(bool(t) for _, t in texts), sum(len(t) for _, t in texts)
    wanted = {}
    for item, text in items:
        wanted.setdefault(item, set()).update(terms_of(text))
    out = []
    for item, terms in wanted.items():
        scores = []
        for doc, held in texts:
            s = 0
            for t in terms & set(held):
                df, tf = sum(t in h for _, h in texts), held.count(t)
                m = 100 - 90 + 90 * len(held) * n_docs // n_terms
                s += math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df + 1))) * (10**9 * tf // (1000 * tf + 8 * m))
            if s > 0:
                scores.append((-s, doc is None, doc or 0))
        out += [(item, rank, None if none else doc, -s) for rank, (s, none, doc) in enumerate(sorted(scores)[:k], 1)]
    return sorted(out, key=str)


def items_of(spark, items):
    return spark.createDataFrame(items, "item_id long, text string")


def test_term_counts(monkeypatch):
    text = "Été ÉTÉ x1-X1_x1\x00\x1f\x85nel a\tb\n" + "ab1 " * 50
    for size in (b.SLICE_BYTES, 7):
        monkeypatch.setattr(b, "SLICE_BYTES", size)
        want = {}
        for t in terms_of(text):
            want[t.encode()] = want.get(t.encode(), 0) + 1
        assert b.term_counts(text.encode()) == want


def test_block_search_finds_the_best_and_stops_early():
    rng = np.random.default_rng(5)
    less = 0
    for trial in range(200):
        size, n_terms = int(rng.integers(1, 400)), int(rng.integers(1, 8))
        held = rng.random((size, n_terms)) < rng.random(n_terms)
        if not held.any():
            continue
        impacts = np.where(held, rng.zipf(1.3, (size, n_terms)).clip(1, 1000), 0).astype(np.int64)
        docs, terms = np.nonzero(impacts)
        block = b.Block(size, docs, terms, impacts[docs, terms])
        asked = np.flatnonzero(rng.random(n_terms + 2) < 0.7)  # some terms aren't there
        scores = impacts[:, asked[asked < n_terms]].sum(axis=1)
        names = rng.permutation(size).tolist()
        names[0] = None
        before = [(-900, False, -1), (-3, False, -2)]
        want = sorted(before + [(-int(s), names[d] is None, names[d] or 0) for d, s in enumerate(scores) if s])[:5]
        got, scored = block.search(asked, before, names, 5, first_read=2)
        assert sorted(got)[:5] == want
        less += scored < (scores > 0).sum()
    assert less > 20


def corpus():
    rng = random.Random(6)
    texts = [(i, words(rng, rng.randrange(1, 60), 40)) for i in range(300)]
    texts += [(300 + i, "w1 w2 w3") for i in range(30)]  # ties
    texts += [(500, None), (501, ""), (502, "?! ."), (503, "W1 " * 30_000), (None, "w1 w2 w3"), (7, "w1 w2 w3"), (7, "w1 w2 w3")]
    items = [(1, "w1 w2 w3"), (2, "w4, W5; w4"), (3, words(rng, 30, 40)), (4, "unknown"), (5, None), (6, ""), (None, "w9"), (8, "w1"), (8, "w7")]
    return texts, items


def test_against_all_scores(spark, monkeypatch):
    texts, items = corpus()
    docs = documents(spark, texts, {"n": 1, "ids": 2, "score": 3, "item": 4, "rank": 5})
    want = plain(texts, items)
    for rows, postings in ((b.BLOCK_ROWS, b.BLOCK_POSTINGS), (13, 40)):
        monkeypatch.setattr(b, "BLOCK_ROWS", rows)
        monkeypatch.setattr(b, "BLOCK_POSTINGS", postings)
        for size in (b.QUERY_BYTES, 200):
            found = b.search(docs, items_of(spark, items), query_bytes=size)
            assert sorted(map(tuple, found.collect()), key=str) == want
    assert found.columns == ["item_id", "rank", "doc_id", "score"]


def test_empty_tables(spark):
    texts, items = corpus()
    assert b.search(documents(spark, []), items_of(spark, items)).count() == 0
    assert b.search(documents(spark, texts), items_of(spark, [])).count() == 0
