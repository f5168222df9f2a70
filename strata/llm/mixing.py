"""Mixing sources to target weights by Poisson replication.

A source that holds S characters and shall hold T of the mixed corpus gets the mean repetition rate T / S. Each of its
documents is repeated a Poisson number of times with that mean: the inverse of the distribution function at a number
hashed from seed and doc_id. So every document is decided alone, any run gives the same corpus, and only per-source
sums are gathered. Copies are then dealt to partitions by a hash of seed, doc_id and copy, and sorted by it: a global
shuffle in one exchange, in which no source is a key.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from strata.llm.common import shielded, stash, without_columns

SEED = 20
#: Larger rates are drawn as a sum of Poisson numbers with at most this mean, so that exp(-mean) stays exact.
LARGEST_MEAN = 64.0
#: The rates are sent to all tasks up to this size; beyond it they are joined by a shuffle.
SENT_BYTES = 8 << 20


def rates(docs: DataFrame, weights: dict[str, float] | None = None, budget: float | None = None, by: str = "source") -> DataFrame:
    """source, n_docs, n_chars, rate. ``weights`` are relative shares, 1 for sources they don't name; ``budget`` is the
    wanted number of characters, by default as many as there are. Sources without any character keep rate 1."""
    sums = docs.groupBy(F.col(by).cast("string").alias("source")).agg(
        F.count("*").alias("n_docs"), F.coalesce(F.sum(F.length("text")), F.lit(0)).cast("long").alias("n_chars")
    )
    weight: Column = F.lit(1.0)
    for name, value in (weights or {}).items():
        weight = F.when(F.col("source") == name, F.lit(float(value))).otherwise(weight)
    sums = stash(sums.withColumn("weight", F.when(F.col("n_chars") > 0, weight).otherwise(0.0)), "sources")
    whole = sums.agg(F.sum("weight").alias("weight"), F.sum("n_chars").alias("n_chars")).first()
    total, wanted = float(whole["weight"] or 0), float(whole["n_chars"] or 0) if budget is None else float(budget)
    # one division after one product, as SQL computes it
    rate = F.when(F.col("n_chars") > 0, F.lit(wanted) * F.col("weight") / (F.lit(total or 1.0) * F.col("n_chars"))).otherwise(1.0)
    return sums.select("source", "n_docs", "n_chars", rate.alias("rate"))


def _uniform(*parts: Column | str) -> Column:
    """A number in [0, 1) from the first 52 bits of a hash."""
    text = F.concat_ws(":", *[F.coalesce(F.col(p).cast("string"), F.lit("")) if isinstance(p, str) else p.cast("string") for p in parts])
    return F.conv(F.substring(F.md5(text.cast("binary")), 1, 13), 16, 10).cast("double") / F.lit(float(1 << 52))


def _inverse(mean: Column, u: Column) -> Column:
    """The least k at which the distribution function of Poisson(mean) exceeds u."""
    top = F.ceil(mean + 12 * F.sqrt(mean) + 30).cast("int")

    def step(a: Column, j: Column) -> Column:
        term = a["term"] * mean / j
        return F.struct(term.alias("term"), (a["sum"] + term).alias("sum"), (a["k"] + F.when(u >= a["sum"], 1).otherwise(0)).alias("k"))

    start = F.struct(F.exp(-mean).alias("term"), F.exp(-mean).alias("sum"), F.lit(0).alias("k"))
    return F.aggregate(F.sequence(F.lit(1), top), start, step, lambda a: a["k"])


def mix(
    docs: DataFrame,
    weights: dict[str, float] | None = None,
    budget: float | None = None,
    seed: int = SEED,
    by: str = "source",
) -> DataFrame:
    """``docs`` with ``copy`` (0, 1, ...) and ``shuffle_key``, in shuffled order.

    Rows with equal doc_id are repeated equally often; a NULL id counts as empty text. NULL is a source of its own.
    Columns of ``docs`` with the names of the two new ones are replaced, other columns are carried along.
    """
    docs, back = shielded(without_columns(docs, "copy", "shuffle_key"))
    by = next((name for name, c in back.items() if c == by), by)
    found = stash(rates(docs, weights, budget, by).select(F.col("source").alias("__source"), F.col("rate").alias("__rate")), "rates")
    size = found.agg(F.sum(F.coalesce(F.octet_length("__source"), F.lit(0)) + 24)).first()[0] or 0
    joined = docs.join(F.broadcast(found) if size <= SENT_BYTES else found, F.col(by).cast("string").eqNullSafe(F.col("__source")))
    parts = F.greatest(F.ceil(F.col("__rate") / LARGEST_MEAN), F.lit(1)).cast("int")
    counted = joined.withColumn("__parts", parts).withColumn("__mean", F.col("__rate") / F.col("__parts"))
    drawn = F.aggregate(
        F.sequence(F.lit(0), F.col("__parts") - 1),
        F.lit(0),
        lambda n, p: n + _inverse(F.col("__mean"), _uniform(F.lit(seed), "doc_id", p)),
    )
    copies = counted.withColumn("__n", F.when(F.col("__rate") > 0, drawn).otherwise(0)).filter("__n > 0")
    exploded = copies.withColumn("copy", F.explode(F.sequence(F.lit(0), F.col("__n") - 1)))
    id_text = F.coalesce(F.col("doc_id").cast("string"), F.lit(""))
    keyed = exploded.withColumn("shuffle_key", F.md5(F.concat_ws(":", F.lit("order"), F.lit(seed), id_text, "copy").cast("binary")))
    # rows repeated in the input share their key; the position spreads them
    spread = keyed.withColumn("__spread", F.pmod(F.monotonically_increasing_id(), F.lit(61)))
    return spread.repartition("shuffle_key", "__spread").sortWithinPartitions("shuffle_key").select(*docs.columns, "copy", "shuffle_key").withColumnsRenamed(back)


SQL = f"""
WITH RECURSIVE sizes AS (
  SELECT source, sum(length(text)) AS n_chars FROM documents GROUP BY source
),
rate AS (
  SELECT source, (SELECT sum(n_chars) FROM sizes)::DOUBLE * 1.0::DOUBLE
                 / ((SELECT count(*) FROM sizes WHERE n_chars > 0)::DOUBLE * n_chars::DOUBLE) AS mean
  FROM sizes
),
cdf(source, mean, j, term, total) AS (
  SELECT source, mean, 0, exp(-mean), exp(-mean) FROM rate
  UNION ALL
  SELECT source, mean, j + 1, term * mean / (j + 1), total + term * mean / (j + 1) FROM cdf
  WHERE j < ceil(mean + 12 * sqrt(mean) + 30)
),
drawn AS (
  SELECT d.*, (SELECT count(*) FROM cdf WHERE cdf.source IS NOT DISTINCT FROM d.source AND d.u >= cdf.total) AS n
  FROM (SELECT *, ('0x' || substr(md5('{SEED}:' || doc_id || ':0'), 1, 13))::BIGINT / 4503599627370496.0::DOUBLE AS u
        FROM documents) d
)
SELECT doc_id, text, lang, source, n_chars, CAST(copy AS INTEGER) AS copy,
       md5('order:{SEED}:' || doc_id || ':' || copy) AS shuffle_key
FROM drawn, unnest(range(0, n)) AS r(copy)
"""
