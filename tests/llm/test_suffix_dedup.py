from __future__ import annotations

import hashlib
import random
from collections import Counter

import pytest

from strata.llm import suffix_dedup as x
from tests.llm.frames import documents


def test_deep_shallow_sorts():
    rng = random.Random(4)
    for _ in range(200):
        size = rng.choice([2, 2, 3, 20])
        strings = [bytes(rng.randrange(size) for _ in range(rng.randrange(60))) for _ in range(rng.randrange(1, 40))]
        strings += [rng.choice(strings) + b"\0" * rng.randrange(3) for _ in range(5)]
        order = x.deep_shallow(strings, 0, rng.choice([0, 8, 16]))
        assert sorted(order) == list(range(len(strings)))
        assert [strings[i] for i in order] == sorted(strings)


def brute_force(texts):
    data = [(t or "").encode() for _, t in texts]
    counts = Counter(t[i : i + 400] for t in data for i in range(len(t) - 399))
    out = []
    for (doc_id, _), t in zip(texts, data, strict=True):
        gone = bytearray(len(t))
        for i in range(len(t) - 399):
            if counts[t[i : i + 400]] > 1:
                gone[i : i + 400] = b"\1" * 400
        kept = bytes(b for b, g in zip(t, gone, strict=True) if not g)
        runs = sum(1 for i, g in enumerate(gone) if g and (i == 0 or not gone[i - 1]))
        out.append((str(doc_id), len(t), sum(gone), runs, hashlib.sha256(kept).hexdigest()))
    return sorted(out)


def corpus():
    rng = random.Random(9)

    def prose(n):
        return "".join(rng.choice("abcdefgh é") for _ in range(n))

    passages = [prose(n) for n in (398, 399, 400, 401, 450, 900, 1500)]
    texts = [(0, None), (1, ""), (2, "x" * 399), (3, "y" * 400), (4, "z" * 401), (5, "ab" * 3000), (6, "ab" * 250), (7, prose(5000)), (8, "é" * 1000)]
    for k in range(40):
        texts.append((10 + k, "".join(prose(rng.randrange(300)) + rng.choice(passages)[rng.choice([0, 0, 7]) :] for _ in range(rng.randrange(1, 4)))))
    long = prose(60_000)
    return [*texts, (100, long), (101, long[5000:20_000] + prose(10)), (10, texts[9][1]), (10, "another text of the same id"), (None, passages[4]), (None, None)]


@pytest.mark.parametrize("hot_classes", [x.HOT_CLASSES, 1])
def test_documents_by_brute_force(spark, hot_classes):
    texts = corpus()
    found = x.remove_repeats(documents(spark, texts, {"spans": 1, "kept": 2, "start": 3}), hot_classes)
    got = found.select("doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256").collect()
    assert sorted((str(r[0]), *r[1:]) for r in got) == brute_force(texts)


def test_empty_table(spark):
    assert x.remove_repeats(documents(spark, [])).count() == 0
