from __future__ import annotations

import random
from collections import Counter

import pytest

import __spark_entry__ as entry
import corpus_pipeline as p
from strata.llm import decontaminate, mixing, quality_classifier, registry, sharding, simhash
from tests.compare import connect, difference
from tests.llm.frames import documents, words

FOLDER = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", sorted(registry.oracle_sql()))
def test_query_matches_sql(spark, name):
    assert difference(entry.queries()[name](spark, FOLDER), connect(FOLDER), entry.oracle_sql()[name]) is None


def test_all_are_registered():
    numbers = sorted(int(name[2:].split("_")[0]) for name in registry.queries())
    assert numbers == list(range(1, 14))
    assert "pipeline" in entry.queries()


def test_stages_one_by_one(spark):
    """Each stage against what its operator says about its own input."""
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet")
    columns = docs.columns
    labels, benchmark = (spark.read.parquet(f"{FOLDER}/{t}.parquet") for t in ("labels", "benchmark"))

    def rows(df):
        return sorted((str(r["doc_id"]), r["text"]) for r in df.collect())

    kept = p.quality(spark, docs, FOLDER).cache()
    scores = quality_classifier.score(docs, quality_classifier.fit(docs, labels)).filter("predicted = 1")
    assert kept.columns == columns and rows(kept) == rows(docs.join(scores.select("doc_id"), "doc_id"))
    unique = p.near_duplicates(spark, kept, FOLDER).cache()
    groups = simhash.near_duplicates(kept).collect()
    assert unique.columns == columns and {r["doc_id"] for r in unique.collect()} == {r["component_id"] for r in groups}
    clean = p.decontamination(spark, unique, FOLDER).cache()
    leaks = {r["doc_id"] for r in decontaminate.leaks(unique, benchmark).collect()}
    assert clean.columns == columns and {r["doc_id"] for r in clean.collect()} == {r["doc_id"] for r in unique.collect()} - leaks
    mixed = p.mixture(spark, clean, FOLDER).cache()
    assert mixed.columns == columns and rows(mixed) == rows(mixing.mix(clean))
    sharded = p.shards(spark, mixed, FOLDER)
    assert rows(sharded) == rows(mixed)
    assert {(r["doc_id"], r["shard"]) for r in sharded.collect()} == {(r["doc_id"], r["shard"]) for r in sharding.assign(mixed).collect()}


def test_of_each_group_one_document_stays(spark):
    rng = random.Random(3)
    text = words(rng, 300)
    texts = [(1, text), (2, text), (2, text), (3, "another one " + words(rng, 80)), (3, words(rng, 80)), (None, text), (4, words(rng, 80)), (4, words(rng, 80))]
    got = Counter(r["doc_id"] for r in p.near_duplicates(spark, documents(spark, texts), FOLDER).collect())
    assert got == {1: 1, 3: 1, 4: 1, None: 1}


def test_run_is_the_stages_in_order(spark):
    got = p.run(spark, FOLDER)
    assert [name for name, _ in p.STAGES] == ["quality", "near_duplicates", "decontamination", "mixing", "sharding"]
    assert {"doc_id", "text", "shard"} <= set(got.columns) and got.count() > 50
