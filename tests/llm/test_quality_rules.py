from __future__ import annotations

import random
import re
from collections import Counter

from strata.llm import quality_rules as q
from tests.llm.frames import documents


def measured(text):
    text = text or ""
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    windows = [tuple(words[i : i + 8]) for i in range(len(words) - 7)]
    counts = Counter(windows)
    repeated = {i + k for i, w in enumerate(windows) if counts[w] > 1 for k in range(8)}
    lines = [x for x in text.split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    return {
        "n_words": len(words),
        "word_chars": sum(map(len, words)),
        "n_symbols": sum(c in "#*$%&|<>" for c in text),
        "n_lines": len(lines),
        "n_dup_lines": len(lines) - len(set(lines)),
        "n_repeat_words": len(repeated),
    }


def failed(m):
    return [
        m["n_words"] < 20,
        100 * m["n_repeat_words"] > 30 * m["n_words"],
        100 * m["n_symbols"] > 10 * m["word_chars"],
        100 * m["n_dup_lines"] > 60 * m["n_lines"],
        m["word_chars"] < 2 * m["n_words"] or m["word_chars"] > 25 * m["n_words"],
    ]


def texts():
    rng = random.Random(5)
    out = [None, "", " \t\n", "one", "a " * 500, "word " * 7, "x" * 100_000, "\x1f \x85 é", "|" * 50]
    for _ in range(40):
        vocabulary = rng.choice([3, 30, 3000])
        out.append("".join(f"w{rng.randrange(vocabulary)}{rng.choice([' ', ' ', chr(10), '  ', ' # ', chr(11)])}" for _ in range(rng.randrange(120))))
    return [(i, t) for i, t in enumerate(out)] + [(3, "one"), (None, "no id")]


def test_measures_and_bits_by_brute_force(spark):
    rows = texts()
    got = q.verdicts(documents(spark, rows, {"n_words": "clash", "kept": 1, "hashes": 2})).collect()
    assert len(got) == len(rows)
    want = sorted((str(i), *measured(t).values(), sum(f << r for r, f in enumerate(failed(measured(t))))) for i, t in rows)
    assert sorted((str(r["doc_id"]), *[r[m] for m in q.MEASURES], r["failed_bits"]) for r in got) == want
    for r in got:
        assert r["base_failed"] == bool(r["failed_bits"] & 3)
        assert r["kept"] == (r["failed_bits"] == 0)


def test_a_policy_is_a_mask_and_ablation_counts_bits(spark):
    rows = texts()
    ledger = q.ledger(documents(spark, rows))
    got = {r["rule"]: r for r in q.ablation(ledger, "v2").collect()}
    bits = [failed(measured(t)) for _, t in rows]
    for r, rule in enumerate(q.RULES):
        assert got[rule]["n_failed"] == sum(f[r] for f in bits)
        assert got[rule]["n_only"] == sum(f[r] and sum(f) == 1 for f in bits)
        assert got[rule]["n_kept_without"] == sum(sum(f) - f[r] == 0 for f in bits)
    assert [r["n_failed"] for r in q.ablation(ledger.limit(0)).collect()] == [0] * len(q.RULES)
    assert q.verdicts(documents(spark, rows), "v1").filter("kept").count() == sum(not (f[0] or f[1]) for f in bits)


def test_no_python_in_the_plan(spark):
    plan = q.verdicts(documents(spark, texts()))._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan and "Exchange" not in plan


def test_empty_table(spark):
    assert q.verdicts(documents(spark, [])).count() == 0
