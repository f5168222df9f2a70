from __future__ import annotations

import random
import zlib

import numpy as np

from strata.llm import quality_classifier as q
from tests.llm.frames import documents, words


def corpus():
    rng = random.Random(1)
    texts, labels = [], []
    for k in range(400):
        bad = k % 4 == 0
        text = words(rng, 60, 300)
        if bad:
            text = " ".join(w.upper() + "!!" for w in text.split()) if k % 8 else " ".join(w + "%%%" for w in text.split())
        texts.append((k, text))
        labels.append((k, 0 if bad else 1, 0))
    return texts, labels


def test_held_out_documents_are_told_apart(spark):
    texts, labels = corpus()
    texts += [(1000, None), (1001, ""), (None, "no id"), (5, texts[5][1]), (1002, "word " * 50_000)]
    docs = documents(spark, texts, {"score": "clash", "quality": 1, "x": 2})
    labelled = spark.createDataFrame([*labels, (7, None, 0), (None, 1, 0), (9, 1, 0)], "doc_id long, quality int, toxic int")
    model = q.fit(docs, labelled)
    rows = q.score(docs, model).collect()
    assert len(rows) == len(texts)
    truth = {k: v for k, v, _ in labels}
    held = [r for r in rows if r["held_out"]]
    assert all(r["held_out"] == (r["doc_id"] is not None and zlib.crc32(str(r["doc_id"]).encode()) % 5 == 0) for r in rows)
    assert all(0 <= r["score"] <= 1 and r["predicted"] == int(r["score"] >= 0.3) for r in rows)
    right = [r["predicted"] == truth[r["doc_id"]] for r in held if r["doc_id"] in truth]
    assert len(right) > 50 and np.mean(right) > 0.95
    kept = q.accepted(docs, model)
    assert kept.columns == docs.columns
    assert sorted(str(r["doc_id"]) for r in kept.collect()) == sorted(str(r["doc_id"]) for r in rows if r["predicted"])


def test_held_out_labels_change_nothing(spark):
    texts, labels = corpus()
    docs = documents(spark, texts)
    other = [(k, 1 - v if zlib.crc32(str(k).encode()) % 5 == 0 else v, 0) for k, v, _ in labels]
    first, second = (q.score(docs, q.fit(docs, spark.createDataFrame(rows, "doc_id long, quality int, toxic int"))).collect() for rows in (labels, other))
    assert sorted(first) == sorted(second)


def test_word_vectors_are_sums_over_neighbours(spark):
    got = q.word_vectors(documents(spark, [(1, "aa bb"), (2, "aa"), (3, None)]).repartition(2))
    index, shapes, codes = q._index_vectors(q.BUCKETS, 1), q._index_vectors(q.SHAPES, 2), q._Codes()
    a, b = (divmod(codes[w], q.SHAPES + 1) for w in ("aa", "bb"))
    for (bucket, _), (near, shape) in ((a, b), (b, a)):
        want = index[near] + shapes[shape]
        assert np.allclose(got[bucket], want / max(np.linalg.norm(want), 1e-9))


def test_temperature_lowers_the_loss():
    rng = np.random.default_rng(3)
    logits = rng.normal(0, 1, 2000)
    y = (rng.random(2000) < 1 / (1 + np.exp(-logits))).astype(float)
    assert 2.5 < q._temperature(3 * logits, y) < 3.6


def test_without_labels(spark):
    docs = documents(spark, [(1, "some text"), (2, None)])
    for rows, want in (([], 0.5), ([(1, 1, 0)], 1.0)):
        model = q.fit(docs, spark.createDataFrame(rows, "doc_id long, quality int, toxic int"))
        assert [r["score"] for r in q.score(docs, model).collect()] == [want, want]
    empty = documents(spark, [])
    model = q.fit(empty, spark.createDataFrame([(1, 1, 0)], "doc_id long, quality int, toxic int"))
    assert q.score(empty, model).count() == 0
