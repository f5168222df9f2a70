"""Quality rules as a bitmask ledger.

Every rule is evaluated once per document. The ledger keeps the measurements and one long whose bit ``r`` is set when
rule ``r`` failed. Policies are versioned masks over these bits, so that changing a policy, or asking what a rule
contributes, never reads the texts again.

Only DataFrame functions are used. A document is measured within its own row, so there is no shuffle and no hot key.
NULL and empty texts have no words and fail the first rule. Extra columns of the input are not carried.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from strata.llm.common import SPACE

WINDOW = 8

#: Rules in bit order; each a condition over the measurements under which a document fails. Append, never reorder.
RULES: dict[str, str] = {
    "few_words": "n_words < 20",
    "repeated_windows": "100 * n_repeat_words > 30 * n_words",
    "many_symbols": "100 * n_symbols > 10 * word_chars",
    "repeated_lines": "100 * n_dup_lines > 60 * n_lines",
    "odd_word_length": "word_chars < 2 * n_words or word_chars > 25 * n_words",
}

#: Policies by version: the rules that reject a document.
POLICIES: dict[str, list[str]] = {
    "v1": ["few_words", "repeated_windows"],
    "v2": ["few_words", "repeated_windows", "many_symbols", "repeated_lines", "odd_word_length"],
}
BASE, CURRENT = "v1", "v2"

MEASURES = ["n_words", "word_chars", "n_symbols", "n_lines", "n_dup_lines", "n_repeat_words"]


def mask(policy: str) -> int:
    names = list(RULES)
    return sum(1 << names.index(rule) for rule in POLICIES[policy])


def measure(docs: DataFrame) -> DataFrame:
    """doc_id and the measurements of each whole text, one row for each row of ``docs``.

    ``n_repeat_words``: words that lie in a window of eight words found twice or more in the text. Windows are compared
    by a 64-bit hash over their words. They are sorted only in texts where the number of distinct hashes shows a repeat.
    """
    text = F.coalesce(F.col("text"), F.lit(""))
    split = docs.select(
        "doc_id",
        (F.length(text) - F.length(F.regexp_replace(text, r"[^\x20\x09-\x0D]+", ""))).cast("long").alias("word_chars"),
        F.length(F.regexp_replace(text, r"[^#*$%&|<>]+", "")).cast("long").alias("n_symbols"),
        F.filter(F.split(text, "\n"), lambda x: x.rlike(r"[^\x20\x09-\x0D]")).alias("lines"),
        F.filter(F.split(text, SPACE), lambda x: x != "").alias("words"),
    )
    windows = split.select(
        "doc_id",
        F.size("words").cast("long").alias("n_words"),
        "word_chars",
        "n_symbols",
        F.size("lines").cast("long").alias("n_lines"),
        (F.size("lines") - F.size(F.array_distinct("lines"))).cast("long").alias("n_dup_lines"),
        F.when(
            F.size("words") >= WINDOW,
            F.transform(F.sequence(F.lit(1), F.size("words") - (WINDOW - 1)), lambda i: F.xxhash64(F.slice("words", i, WINDOW))),
        )
        .otherwise(F.array().cast("array<long>"))
        .alias("hashes"),
    )
    ordered = windows.withColumn(
        "ordered",
        F.when(
            F.size(F.array_distinct("hashes")) < F.size("hashes"),
            F.array_sort(F.transform("hashes", lambda h, i: F.struct(h.alias("h"), i.alias("i")))),
        ).otherwise(F.array().cast("array<struct<h:bigint,i:int>>")),
    ).drop("hashes")

    def twice(x: Column, k: Column) -> Column:
        # beyond either end, get() gives NULL, which equals nothing
        return F.coalesce(F.get("ordered", k - 1)["h"] == x["h"], F.lit(False)) | F.coalesce(
            F.get("ordered", k + 1)["h"] == x["h"], F.lit(False)
        )

    found = ordered.withColumn("found", F.sort_array(F.transform(F.filter("ordered", twice), lambda x: x["i"]))).drop("ordered")
    covered = F.aggregate(
        "found",
        F.struct(F.lit(0).alias("end"), F.lit(0).alias("n")),
        lambda a, p: F.struct((p + WINDOW).alias("end"), (a["n"] + p + WINDOW - F.greatest(p, a["end"])).alias("n")),
        lambda a: a["n"].cast("long"),
    )
    return found.withColumn("n_repeat_words", covered).select("doc_id", *MEASURES)


def ledger(docs: DataFrame) -> DataFrame:
    """The measurements and ``failed_bits``: bit r is set if rule r of ``RULES`` failed."""
    bits = sum(
        (F.when(F.expr(rule), F.lit(1 << r)).otherwise(F.lit(0)).cast("long") for r, rule in enumerate(RULES.values())),
        F.lit(0).cast("long"),
    )
    return measure(docs).withColumn("failed_bits", bits)


def passes(policy: str, bits: Column | str = "failed_bits") -> Column:
    column = F.col(bits) if isinstance(bits, str) else bits
    return column.bitwiseAND(F.lit(mask(policy)).cast("long")) == 0


def ablation(rows: DataFrame, policy: str = CURRENT) -> DataFrame:
    """What each rule of a policy contributes, from a ledger: rule, n_failed, n_only (rejected by no other rule of the
    policy), n_kept_without (documents kept if the rule is left out).

    The ledger is first counted by bit pattern, of which there are at most 2 to the power of the number of rules.
    An empty ledger gives zeros.
    """
    whole, names = mask(policy), list(RULES)
    patterns = rows.groupBy("failed_bits").agg(F.count("*").alias("n"))

    def counted(condition: str) -> Column:
        return F.coalesce(F.sum(F.when(F.expr(condition), F.col("n"))), F.lit(0)).cast("long")

    columns, stacked = [], []
    for rule in POLICIES[policy]:
        bit = 1 << names.index(rule)
        columns += [
            counted(f"failed_bits & {bit}L = {bit}L").alias(f"{rule}_failed"),
            counted(f"failed_bits & {whole}L = {bit}L").alias(f"{rule}_only"),
            counted(f"failed_bits & {whole & ~bit}L = 0L").alias(f"{rule}_without"),
        ]
        stacked.append(f"'{rule}', {rule}_failed, {rule}_only, {rule}_without")
    return patterns.agg(*columns).select(
        F.expr(f"stack({len(stacked)}, {', '.join(stacked)}) as (rule, n_failed, n_only, n_kept_without)")
    )


def verdicts(docs: DataFrame, policy: str = CURRENT) -> DataFrame:
    """The ledger with ``base_failed`` and ``kept`` (false if the base policy or ``policy`` rejects)."""
    return ledger(docs).select(
        "doc_id",
        *MEASURES,
        "failed_bits",
        (~passes(BASE)).alias("base_failed"),
        (passes(BASE) & passes(policy)).alias("kept"),
    )


SQL = r"""
WITH w AS (
  SELECT doc_id, coalesce(text, '') AS t,
         list_filter(string_split_regex(coalesce(text, ''), '[\x20\x09-\x0D]+'), lambda x: x <> '') AS words,
         list_filter(string_split(coalesce(text, ''), chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS lines
  FROM documents
),
win AS (
  SELECT doc_id, i, array_to_string(words[i:i + 7], ' ') AS s FROM w, unnest(range(1, len(words) - 6)) AS u(i)
),
twice AS (SELECT doc_id, i FROM (SELECT doc_id, i, count(*) OVER (PARTITION BY doc_id, s) AS n FROM win) WHERE n > 1),
covered AS (
  SELECT doc_id, count(DISTINCT i + k) AS n_repeat_words FROM twice, unnest(range(0, 8)) AS u(k) GROUP BY doc_id
),
m AS (
  SELECT w.doc_id, CAST(len(words) AS BIGINT) AS n_words,
         CAST(length(regexp_replace(t, '[\x20\x09-\x0D]+', '', 'g')) AS BIGINT) AS word_chars,
         CAST(length(regexp_replace(t, '[^#*$%&|<>]+', '', 'g')) AS BIGINT) AS n_symbols,
         CAST(len(lines) AS BIGINT) AS n_lines,
         CAST(len(lines) - len(list_distinct(lines)) AS BIGINT) AS n_dup_lines,
         CAST(coalesce(n_repeat_words, 0) AS BIGINT) AS n_repeat_words
  FROM w LEFT JOIN covered ON w.doc_id = covered.doc_id
),
f AS (
  SELECT *, CAST(CASE WHEN n_words < 20 THEN 1 ELSE 0 END
       + CASE WHEN 100 * n_repeat_words > 30 * n_words THEN 2 ELSE 0 END
       + CASE WHEN 100 * n_symbols > 10 * word_chars THEN 4 ELSE 0 END
       + CASE WHEN 100 * n_dup_lines > 60 * n_lines THEN 8 ELSE 0 END
       + CASE WHEN word_chars < 2 * n_words OR word_chars > 25 * n_words THEN 16 ELSE 0 END AS BIGINT) AS failed_bits
  FROM m
)
SELECT doc_id, n_words, word_chars, n_symbols, n_lines, n_dup_lines, n_repeat_words, failed_bits,
       failed_bits & 3 <> 0 AS base_failed, failed_bits & 31 = 0 AS kept
FROM f
"""
