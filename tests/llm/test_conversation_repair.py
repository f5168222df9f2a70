from __future__ import annotations

import hashlib
import itertools
import random
import re
import zlib

import pytest

from strata.llm import conversation_repair as c

LEGAL = re.compile(r"(s?(ua)+)?")
SCHEMA = "conv_id long, turn long, role string, text string"


def plain_audit(rows):
    """(cost, audit, roles) of the best of all edits, by trying them all. rows: (initial, must go, truncated)."""
    best = None
    for edits in itertools.product("DKRr", repeat=len(rows)):  # r: to assistant
        if any(e != "D" and must for e, (_, must, _) in zip(edits, rows, strict=True)):
            continue
        base = sum({"D": 3, "K": 0, "R": 2, "r": 2}[e] + (e != "D" and t) for e, (_, _, t) in zip(edits, rows, strict=True))
        for gaps in itertools.product(("", "u", "a", "ua", "au"), repeat=len(rows) + 1):
            cost = base + 2 * sum(map(len, gaps))
            if best and cost > best[0]:
                continue
            kept = [{"D": "", "K": i or "?", "R": "u", "r": "a"}[e] for e, (i, _, _) in zip(edits, rows, strict=True)]
            roles = gaps[0] + "".join(k + g for k, g in zip(kept, gaps[1:], strict=True))
            if LEGAL.fullmatch(roles):
                audit = "I" * len(gaps[0]) + "".join(e.upper() + "I" * len(g) for e, g in zip(edits, gaps[1:], strict=True))
                best = min(best or (cost, audit, roles), (cost, audit, roles))
    return best


def searched(rows, nodes=c.NODES):
    search = c.Audit(nodes)
    for row in rows:
        search.row(*row)
    return search.finish()


def random_rows(rng, n):
    return [(rng.choice(["u", "a", "s", "x", ""]), rng.random() < 0.15, rng.random() < 0.25) for _ in range(n)]


def test_audits_are_the_best_of_all():
    rng = random.Random(1)
    assert searched([]) == (0, "")
    for n in [1, 1, 1, 2, 2, 2, 3, 3] * 12 + [4] * 8:
        rows = random_rows(rng, n)
        rows = [(i, must, t and not must) for i, must, t in rows]
        assert searched(rows) == plain_audit(rows)[:2]


def test_settling_changes_nothing():
    rng = random.Random(2)
    for n in (200, 3000):
        rows = random_rows(rng, n)
        assert searched(rows, 8) == searched(rows, 10**9)


def test_ties_by_longest_common_prefix():
    rng = random.Random(3)
    p = c.Prefixes()
    nodes = [0]
    for _ in range(1500):
        nodes.append(p.add(rng.choice(nodes[-30:]), rng.choice("DIKR")))
    for _ in range(3000):
        a, b = rng.choice(nodes), rng.choice(nodes)
        assert p.less(a, b) == (p.spell(a) < p.spell(b))
        assert p.spell(p.lift(a, p.depth[a] // 2)) == p.spell(a)[: p.depth[a] // 2]


@pytest.mark.parametrize("base", [0, 1])
def test_collisions_of_hashes_are_found(monkeypatch, base):
    monkeypatch.setattr(c, "_BASE", base)  # strings of one last letter, or of one sum of letters, collide
    rng = random.Random(4)
    p = c.Prefixes()
    nodes = [0]
    for _ in range(300):
        nodes.append(p.add(rng.choice(nodes), rng.choice("DIKR")))
    for a, b in itertools.product(rng.sample(nodes, 60), repeat=2):
        assert p.less(a, b) == (p.spell(a) < p.spell(b))


def plain_report(conversations):
    """The contract, row by row."""
    groups = {}
    for conv, turn, role, text in conversations:
        rows = groups.setdefault(conv, [])
        key = f"{' ' if conv is None else conv}:{' ' if turn is None else turn}"
        role, text = " " if role is None else role, " " if text is None else text
        fault = zlib.crc32(key.encode()) % 20
        text = "" if fault == 1 else re.sub("[.!?]", "", text) if fault == 2 else text
        rows += [(turn, "user" if fault == 4 else role, text)] * {0: 0, 3: 2}.get(fault, 1)
    out = []
    for conv, rows in groups.items():
        rows.sort(key=lambda r: (r[0] is not None, r[0] or 0, r[1].encode(), r[2][:100].encode(), hashlib.sha256(f"{len(r[1])}:{r[1]}{r[2]}".encode()).digest()))
        turns = {t for t, _, _ in rows if t is not None}
        seen, facts, counts = set(), [], [0, 0, 0]
        for _, role, text in rows:
            ended = re.sub(r"[\x20\x09-\x0D]+\Z", "", text)
            fault = 0 if not ended else 1 if (role, text) in seen else 2 if ended[-1] not in ".!?" else None
            seen.add((role, text))
            if fault is not None:
                counts[fault] += 1
            facts.append((role[:1], fault in (0, 1), fault == 2))
        cost, audit, roles = plain_audit(facts) if len(rows) < 4 else (*searched(facts), None)
        illegal = sum(a[1][:1] + b[1][:1] not in ("su", "ua", "au") for a, b in itertools.pairwise(rows))
        places, lines, at = len(audit) - audit.count("D"), [], 0
        roles = roles if roles is not None else "s" * (places % 2) + "ua" * (places // 2)
        for e in audit:
            role, text = (None, "") if e == "I" else rows[at][1:]
            at += e != "I"
            if e != "D":
                lines.append(f"{role if e == 'K' else {'u': 'user', 'a': 'assistant'}[roles[len(lines)]]}:{text}")
        gaps = max(turns) - min(turns) + 1 - len(turns) if turns else 0
        out.append((conv, gaps, *counts, illegal, cost, audit, hashlib.sha256("\n".join(lines).encode()).hexdigest()))
    return sorted(out, key=str)


def corpus():
    rng = random.Random(5)
    texts = ["Hi.", "What?", "Fine!", "cut off", "", " \n\t", None, "é 你好。", "Ends. \r\n", "x" * 150 + ".", "x" * 150 + "!", "!!!"]
    rows = []
    for conv in [*range(40), None]:
        for turn in range(rng.randrange(1, 6)):
            rows.append((conv, rng.choice([turn, turn, turn * 3, None]), rng.choice(["user", "assistant", "system", "tool", "", None, "User"]), rng.choice(texts)))
    for turn in range(300):
        rows.append((100, turn, ("user", "assistant")[turn % 2] if rng.random() < 0.8 else "tool", f"t{turn}" + rng.choice([".", ""])))
    rows += [(101, 1, "user", "long " * 100_000 + "."), (101, 2, "assistant", "a."), (101, 2, "assistant", "a."), (101, 2, "assistant", "b.")]
    dropped = [n for n in range(1000, 2000) if zlib.crc32(f"{n}:7".encode()) % 20 == 0][:2]
    return rows + [(n, 7, "user", "all gone") for n in dropped]


def test_report_by_brute_force(spark):
    rows = corpus()
    table = spark.createDataFrame(rows, SCHEMA)
    from pyspark.sql import functions as F

    wide = table.withColumns({x: F.lit(1) for x in ("fault", "head", "content", "kind", "audit", "again", "copy", "none")})
    got = c.repair_report(c.damage(wide), wide)
    assert got.columns == ["conv_id", "gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256"]
    assert sorted(map(tuple, got.collect()), key=str) == plain_report(rows)


def test_repaired_rows_are_legal(spark):
    rows = spark.createDataFrame(corpus(), SCHEMA)
    found = c.audits(rows)
    lines = {}
    for r in sorted(c.repaired(rows, found).collect(), key=lambda r: r["position"]):
        lines.setdefault(r["conv_id"], []).append((r["role"], r["text"]))
    for said in lines.values():
        assert LEGAL.fullmatch("".join(role[0] for role, _ in said))
    digests = {r[0]: r[1] for r in c.repaired_digests(rows, found).collect()}
    assert len(digests) == found.count()
    for conv, digest in digests.items():
        assert digest == hashlib.sha256("\n".join(f"{r}:{t}" for r, t in lines.get(conv, [])).encode()).hexdigest()


def test_empty_table(spark):
    nothing = spark.createDataFrame([], SCHEMA)
    assert c.repair_report(c.damage(nothing), nothing).count() == 0
    assert c.repaired(nothing, c.audits(nothing)).count() == 0
