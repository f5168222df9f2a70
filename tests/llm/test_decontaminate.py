from __future__ import annotations

import random

import pytest

from strata.llm import decontaminate as d
from tests.llm.frames import documents, words

QUESTION = "A farmer named Alice sold 12 apples and 30 pears at the market for 5 km of rope then Alice counted 12 coins twice"


def asked(name: str, n: str, m: str, last: str) -> str:
    return f"a farmer named {name} sold {n} apples and {m} pears at the market for 5 km of rope then {name} counted {last} coins twice"


def corpus():
    rng = random.Random(6)
    noise = [words(rng, 60) for _ in range(6)]
    return [
        (1, f"{noise[0]} {QUESTION}. {noise[1]}"),
        (2, f"{noise[1]} {asked('Bob', '7', '8', '7')} {noise[2]}"),  # other values, consistently
        (3, f"{noise[2]} {asked('Bob', '7', '8', '9')} {noise[3]}"),  # 12 stands for 7 and for 9
        (4, f"{noise[3]} {asked('Bob', '7', '7', '7')} {noise[3]}"),  # 12 and 30 both stand for 7
        (5, f"{noise[3]} {asked('Mary Ann Smith', '1,000', '3.5', '1,000')}"),
        (6, f"{noise[4]} {QUESTION.upper()}!! {noise[5]}"),
        (7, noise[5]),
        (8, " ".join(QUESTION.split()[:14])),  # too little of it
        (9, None),
        (10, ""),
        (11, "the " * 50_000),
        (1, "a second row with the id of a leak"),
        (None, QUESTION),
        (12, "what costs 20 USD or 20usd or $20 when a dozen is 5km away from here today"),
    ]


BENCHMARK = [
    (1, QUESTION),
    (2, None),
    (3, "too short"),
    (4, "What costs 30 USD or 30usd or $30 when a dozen is 6km away from here today?"),
    (None, QUESTION),
    (5, "One Two Three Four Five Six Seven"),  # names only
    (1, QUESTION),
]


@pytest.mark.parametrize("sent", [d.SENT_WINDOWS, 0])
def test_leaks(spark, monkeypatch, sent):
    monkeypatch.setattr(d, "SENT_WINDOWS", sent)
    docs = documents(spark, corpus(), {"item_id": 1, "hash": 2, "coverage": "clash"})
    benchmark = spark.createDataFrame(BENCHMARK, "item_id long, text string")
    got = {(r["doc_id"], r["item_id"]): r for r in d.leaks(docs, benchmark).collect()}
    assert set(got) == {(1, 1), (2, 1), (5, 1), (6, 1), (12, 4)}
    assert [got[k]["reworded"] for k in ((1, 1), (2, 1), (12, 4))] == [False, True, True]
    assert all(r["coverage"] >= d.COVERAGE for r in got.values())


def test_every_hidden_item_is_found(spark):
    rng = random.Random(8)
    items = [(k, words(rng, rng.randrange(15, 50)).capitalize() + ".") for k in range(20)]
    texts, want = [], set()
    for k in range(60):
        parts = words(rng, 80).split()
        if k % 3 == 0:
            item = rng.choice(items)
            at = rng.randrange(80)
            parts = [*parts[:at], item[1], *parts[at:]]
            want.add((k, item[0]))
        texts.append((k, " ".join(parts)))
    found = d.leaks(documents(spark, texts), spark.createDataFrame(items, "item_id long, text string"))
    assert {(r["doc_id"], r["item_id"]) for r in found.collect()} == want


def test_names_end_where_items_do(spark):
    items = [(1, "Alice has 3 apples and gives two of them to a friend so how many apples does Alice have now?"), (2, "if one of them runs twice as far as Bob who is faster then Alice or Bob")]
    texts = [
        (1, "Question: Bob has 7 apples and gives two of them to a friend so how many apples does Bob have now?"),
        (2, "Problem : Bob has 7 apples and gives two of them to a friend so how many apples does Bob have now?"),
        (3, "Today Bob has 7 apples and gives two of them to a friend so how many apples does Bob have now?"),
        (4, "if one of them runs twice as far as Tom who is faster then Mary or Tom? Answer: Mary"),
        (5, "if one of them runs twice as far as Tom who is faster then Mary or Tom Answer Mary"),
    ]
    found = d.leaks(documents(spark, texts), spark.createDataFrame(items, "item_id long, text string"))
    assert {(r["doc_id"], r["item_id"]) for r in found.collect()} == {(1, 1), (2, 1), (3, 1), (4, 2), (5, 2)}


def test_changed_words_inside(spark):
    rng = random.Random(9)
    item = words(rng, 24).split()
    texts = [
        (1, [*item[:12], "inserted", *item[12:]]),
        (2, [*item[:12], *item[13:]]),
        (3, [*item[:11], "replaced", *item[12:]]),
        (4, [*item[12:], *item[:12]]),  # out of order
        (5, [*item[:12], *words(rng, 30).split(), *item[12:]]),  # too far apart
    ]
    docs = documents(spark, [(k, " ".join([words(rng, 30), *parts, words(rng, 30)])) for k, parts in texts])
    found = d.leaks(docs, spark.createDataFrame([(1, " ".join(item))], "item_id long, text string")).collect()
    assert {r["doc_id"] for r in found} == {1, 2, 3}


def test_empty_tables(spark):
    docs, items = documents(spark, corpus()), spark.createDataFrame(BENCHMARK, "item_id long, text string")
    assert d.leaks(docs.limit(0), items).count() == 0
    assert d.leaks(docs, items.limit(0)).count() == 0
