"""The corpus pipeline: quality classifier, near-duplicates, decontamination, mixing, sharding.

Each stage takes all rows that its predecessor kept and returns the columns of ``documents``; the last one adds the shard.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from strata.llm import decontaminate, mixing, quality_classifier, sharding, simhash
from strata.llm.common import drop_ids, stash, table


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier does not reject."""
    model = quality_classifier.fit(docs, table(spark, sf_dir, "labels"))
    return quality_classifier.accepted(docs, model)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of texts linked by SimHash the document with the smallest doc_id; of rows that repeat it, the first by
    text. Rows without an id stay, as they can't be told apart from what they repeat."""
    found = stash(simhash.near_duplicates(docs), "near-duplicates")
    leaving = found.filter("doc_id <> component_id").select("doc_id")
    kept = drop_ids(docs, stash(leaving, "leaving"))
    repeated = stash(found.filter("doc_id is not null").groupBy("doc_id").count().filter("count > 1").select("doc_id"), "repeated-ids")
    if repeated.isEmpty():
        return kept
    by_id = Window.partitionBy("doc_id").orderBy(*[F.col(f"`{c}`") for c in docs.columns if c != "doc_id"])
    again = kept.join(repeated, "doc_id", "left_semi").select(docs.columns).withColumn("__n", F.row_number().over(by_id))
    return drop_ids(kept, repeated).union(again.filter("__n = 1").drop("__n"))


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no benchmark item."""
    leaks = decontaminate.leaks(docs, table(spark, sf_dir, "benchmark"))
    return drop_ids(docs, stash(leaks.select("doc_id").distinct(), "leaks"))


def mixture(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents repeated so that all sources weigh the same, in shuffled order."""
    return mixing.mix(docs).select(docs.columns)


def shards(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each row with the shard it belongs to."""
    return sharding.assign(docs)


STAGES = [
    ("quality", quality),
    ("near_duplicates", near_duplicates),
    ("decontamination", decontamination),
    ("mixing", mixture),
    ("sharding", shards),
]

#: A trained classifier and fingerprints are beyond SQL; tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; what a stage returns is written, and read by the next one."""
    docs = table(spark, sf_dir, "documents")
    return reduce(lambda kept, stage: stage[1](spark, stash(kept, stage[0]), sf_dir), STAGES[1:], STAGES[0][1](spark, docs, sf_dir))
