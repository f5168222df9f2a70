"""Sharding by extendible hashing.

A directory is indexed by the leading bits of a hash of doc_id. Every bucket that holds more bytes than a shard may is
split on the next bit, others stay, until all fit. The sums of all prefixes come from one histogram per ``STEPS`` entry,
so the texts are measured once and never moved to find their shard; further bits are only counted for the rows of
buckets that still are too large.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strata.llm.common import shielded, stash, without_columns

LIMIT = 64 << 20
BITS = 60
#: The directory is deepened to these depths in turn. The first has at most 2 ** 16 entries and is sent to all tasks.
STEPS = [16, 24, 32, 40, 48, 56, 60]


def _hash(column):
    """The first 60 bits of an md5."""
    return F.conv(F.substring(F.md5(column.cast("string").cast("binary")), 1, 15), 16, 10).cast("long")


def _entries(sizes: DataFrame, low: int, high: int, limit: int) -> DataFrame:
    """(__group, __key, __depth): for each prefix of ``high`` bits the depth of its shard, or none if that lies deeper."""
    by_key = sizes.groupBy("__group", F.shiftright("__hash", BITS - high).alias("__key")).agg(
        F.sum("__bytes").alias("bytes"), F.count("*").alias("n")
    )
    by_key = stash(by_key, "histogram")
    deep = by_key.select("*", F.explode(F.sequence(F.lit(low), F.lit(high))).alias("d")).withColumn(
        "p", F.expr(f"shiftright(__key, {high} - d)")
    )
    fits = deep.groupBy("__group", "d", "p").agg(F.sum("bytes").alias("bytes"), F.sum("n").alias("n")).filter(
        (F.col("bytes") <= limit) | (F.col("n") == 1)
    )
    # sums shrink with every bit, so the first depth that fits is the shard's
    chosen = deep.select("__group", "__key", "d", "p").join(fits.select("__group", "d", "p"), ["__group", "d", "p"])
    least = chosen.groupBy("__group", "__key").agg(F.min("d").alias("__depth"))
    return stash(by_key.select("__group", "__key").join(least, ["__group", "__key"], "left"), "directory")


def _split(rows: DataFrame, limit: int) -> tuple[DataFrame, DataFrame]:
    """Rows with ``__depth``, and the rows of buckets that no bit of the hash can split."""
    done, rest, low = [], rows, 0
    for high in STEPS:
        entries = _entries(rest.select("__group", "__hash", "__bytes"), low, high, limit)
        if low == 0 and "__root" in rows.columns:
            entries = F.broadcast(entries)  # 2 ** 16 rows at most
        keyed = rest.withColumn("__key", F.shiftright("__hash", BITS - high))
        found = keyed.join(entries, ["__group", "__key"]).drop("__key")
        done.append(found.filter("__depth is not null"))
        rest = found.filter("__depth is null").drop("__depth")
        low = high + 1
        if high == BITS or entries.filter("__depth is null").isEmpty():
            break
    whole = done[0]
    for more in done[1:]:
        whole = whole.unionByName(more)
    return whole, rest


def assign(docs: DataFrame, limit: int = LIMIT) -> DataFrame:
    """``docs`` with n_bytes (of the text in UTF-8, NULL: 0), shard ("s" and the bits of its prefix) and depth.

    No shard holds more than ``limit`` bytes, unless it is a single row that is longer. Rows with one doc_id agree in
    all bits; if they don't fit together, their bucket is split once more on a hash of the row's position, and the shard's
    name goes on after a hyphen. NULL ids share the hash of an empty text. An empty table has no shard. Columns of
    ``docs`` with the new names are replaced, others are carried along.
    """
    docs, back = shielded(without_columns(docs, "n_bytes", "shard", "depth"))
    rows = docs.select(
        "*",
        F.lit(0).cast("long").alias("__group"),
        F.lit(True).alias("__root"),
        _hash(F.coalesce(F.col("doc_id").cast("string"), F.lit(""))).alias("__hash"),
        F.coalesce(F.octet_length("text"), F.lit(0)).cast("long").alias("__bytes"),
    )

    def prefix(depth: str):
        return F.expr(f"lpad(bin(shiftright(__hash, {BITS} - {depth})), {depth}, '0')")

    whole, rest = _split(rows, limit)
    out = whole.select(*docs.columns, F.col("__bytes").alias("n_bytes"), F.concat(F.lit("s"), prefix("__depth")).alias("shard"), F.col("__depth").alias("depth"))
    if rest.isEmpty():
        return out.withColumnsRenamed(back)
    # the positions must not change while the rows are read again
    alike = rest.withColumn("__shard", F.concat(F.lit("s"), prefix(str(BITS)), F.lit("-"))).withColumn("__group", F.col("__hash")).drop("__root")
    alike = stash(alike.withColumn("__hash", _hash(F.monotonically_increasing_id())), "alike")
    whole, left = _split(alike, limit)
    named = whole.unionByName(left.withColumn("__depth", F.lit(BITS)))
    split = named.select(*docs.columns, F.col("__bytes").alias("n_bytes"), F.concat("__shard", prefix("__depth")).alias("shard"), (F.col("__depth") + BITS).alias("depth"))
    return out.unionByName(split).withColumnsRenamed(back)


def write_shards(docs: DataFrame, path: str, limit: int = LIMIT) -> None:
    """One folder ``shard=...`` per shard, of one Parquet file: a shard fits a task by its limit."""
    assign(docs, limit).repartition("shard").write.partitionBy("shard").parquet(path)


SQL = f"""
WITH h AS (
  SELECT doc_id, ('0x' || substr(md5(CAST(doc_id AS VARCHAR)), 1, 15))::BIGINT AS h,
         CAST(coalesce(strlen(text), 0) AS BIGINT) AS n_bytes
  FROM documents
),
sums AS (
  SELECT d, h >> ({BITS} - d) AS p, sum(n_bytes) AS bytes, count(*) AS n FROM h, unnest(range(0, {BITS} + 1)) AS r(d) GROUP BY ALL
),
leaf AS (
  SELECT h.doc_id, h.h, min(sums.d) AS depth
  FROM h, unnest(range(0, {BITS} + 1)) AS r(d) JOIN sums ON sums.d = r.d AND sums.p = h.h >> ({BITS} - r.d)
  WHERE bytes <= {LIMIT} OR n = 1 GROUP BY ALL
)
SELECT h.doc_id, n_bytes, 's' || CASE WHEN depth = 0 THEN '' ELSE lpad(bin(h.h >> ({BITS} - depth)), CAST(depth AS INTEGER), '0') END AS shard,
       CAST(depth AS INTEGER) AS depth
FROM h JOIN leaf ON h.doc_id = leaf.doc_id
"""
