from __future__ import annotations

import hashlib
import math
from collections import Counter

import pytest

from strata.llm import mixing as m
from tests.llm.frames import documents


def drawn(rate: float, doc_id) -> int:
    parts, total = max(1, math.ceil(rate / m.LARGEST_MEAN)), 0
    for p in range(parts):
        key = f"{m.SEED}:{'' if doc_id is None else doc_id}:{p}"
        u = int(hashlib.md5(key.encode()).hexdigest()[:13], 16) / 2**52
        mean, k = rate / parts, 0
        term = cdf = math.exp(-mean)
        while u >= cdf and k < 1000:
            k += 1
            term = term * mean / k
            cdf += term
        total += k
    return total


def corpus():
    texts = [(k, "x" * (k % 17)) for k in range(400)]
    return [*texts, (5, "repeated id"), (6, "xxxxxx"), (6, "xxxxxx"), (None, "no id"), (1000, None), (1001, "y" * 50_000)]


@pytest.mark.parametrize("sent", [m.SENT_BYTES, 0])
@pytest.mark.parametrize("weights,budget", [(None, None), ({"src0": 3.0, "src2": 0.0}, 40_000), ({"src1": 500.0}, 4_000_000)])
def test_copies_by_brute_force(spark, monkeypatch, weights, budget, sent):
    monkeypatch.setattr(m, "SENT_BYTES", sent)
    texts = corpus()
    docs = documents(spark, texts, {"copy": "clash", "other": 7, "__rate": 5, "__source": "x", "__n": 1, "own__rate": 2})
    rows = [r.asDict() for r in docs.collect()]
    chars = Counter()
    for r in rows:
        chars[r["source"]] += len(r["text"] or "")
    weight = {s: (weights or {}).get(s, 1.0) if c else 0.0 for s, c in chars.items()}
    wanted = sum(chars.values()) if budget is None else budget
    rate = {s: wanted * weight[s] / (sum(weight.values()) * c) if c else 1.0 for s, c in chars.items()}
    want = Counter()
    for r in rows:
        for copy in range(drawn(rate[r["source"]], r["doc_id"])):
            want[(r["doc_id"], r["text"], copy)] += 1
    got = m.mix(docs, weights, budget).collect()
    assert Counter((r["doc_id"], r["text"], r["copy"]) for r in got) == want
    assert {r["other"] for r in got} <= {7}
    for r in got:
        key = f"order:{m.SEED}:{'' if r['doc_id'] is None else r['doc_id']}:{r['copy']}"
        assert r["shuffle_key"] == hashlib.md5(key.encode()).hexdigest()


def test_mixture_meets_the_weights(spark):
    texts = [(k, "word " * 20) for k in range(6000)]
    docs = documents(spark, [(k, t) for k, t in texts if k % 3 == 0 or k % 12 == 1 or k % 6 == 2])
    chars = Counter()
    for r in m.mix(docs, {"src0": 2.0}).collect():
        chars[r["source"]] += r["n_chars"]
    whole = sum(chars.values())
    assert abs(chars["src0"] / whole - 0.5) < 0.05 and abs(chars["src1"] / whole - 0.25) < 0.05


def test_order_is_shuffled_and_repeatable(spark):
    docs = documents(spark, [(k, "some text") for k in range(500)])
    first, again = m.mix(docs).collect(), m.mix(docs.repartition(3)).collect()
    assert sorted(first) == sorted(again)
    ids = [r["doc_id"] for r in first]
    assert sum(a < b for a, b in zip(ids, ids[1:], strict=False)) < 0.6 * len(ids)


def test_empty_table(spark):
    assert m.mix(documents(spark, [])).count() == 0
