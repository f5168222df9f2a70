from __future__ import annotations

import random
import re

import xxhash

from strata.llm import components as c
from strata.llm import simhash as h
from tests.llm.frames import documents, words


def plain_fingerprint(text: str | None) -> int:
    text = "".join(chr(ord(x) + 32) if "A" <= x <= "Z" else x for x in text or "")
    parts = re.findall(r"[^\x20\x09-\x0D]+", text)
    if not parts:
        return 0
    shingles = [" ".join(parts[i : i + 4]) for i in range(max(1, len(parts) - 3))]
    hashes = [xxhash.xxh64_intdigest(x.encode(), 42) for x in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in hashes) > len(hashes))


def joined(n: int, pairs) -> list[int]:
    up = list(range(n))
    for a, b in pairs:
        a, b = up[a], up[b]
        up = [min(a, b) if x in (a, b) else x for x in up]
    return up


def test_tree_links_join_what_all_pairs_join():
    rng = random.Random(3)
    for _ in range(100):
        base, fps = [rng.getrandbits(64) for _ in range(4)], []
        for _ in range(rng.randrange(50)):
            fp = rng.choice(base)
            for _ in range(rng.randrange(6)):
                fp ^= 1 << rng.randrange(64)
            fps.append(fp)
        near = [(i, j) for i in range(len(fps)) for j in range(i) if (fps[i] ^ fps[j]).bit_count() <= 4]
        links = h.tree_links(fps)
        assert len(links) < max(1, len(fps))
        assert joined(len(fps), near) == joined(len(fps), links)


def test_components_of_long_paths_and_stars(spark):
    path = [(i, i + 1) for i in range(100, 160)]
    star = [(7, i) for i in range(200, 260)]
    edges = spark.createDataFrame([*path, *star, (900, 900), (5, 3), (3, 5), (5, 3)], "a long, b long")
    got = dict(c.components(edges).collect())
    assert got == {**{i: 100 for i in range(100, 161)}, **{i: 7 for i in [7, *range(200, 260)]}, 5: 3, 3: 3}
    assert c.components(edges.limit(0)).count() == 0


def corpus():
    rng = random.Random(4)
    base = [words(rng, 80) for _ in range(12)]
    texts = [(0, None), (1, ""), (2, " \n"), (3, "one TWO"), (4, "ONE two"), (5, "é É ü"), (6, "w " * 30_000)]
    for k in range(10, 60):
        parts = rng.choice(base).split()
        for _ in range(rng.randrange(3)):
            parts[rng.randrange(len(parts))] = "changed"
        texts.append((k, " ".join(parts)))
    return [*texts, (10, texts[7][1]), (None, texts[8][1]), (None, "alone without id")]


def test_documents_by_brute_force(spark):
    texts = corpus()
    fps = [plain_fingerprint(t) for _, t in texts]
    near = [(i, j) for i in range(len(fps)) for j in range(i) if (fps[i] ^ fps[j]).bit_count() <= 4]
    groups = joined(len(fps), near)
    ids = {g: min((texts[i][0] for i in range(len(fps)) if groups[i] == g and texts[i][0] is not None), default=None) for g in set(groups)}
    want = sorted((str(d), f"{fp:016x}", str(ids[g])) for (d, _), fp, g in zip(texts, fps, groups, strict=True))
    docs = documents(spark, texts, {"fp": 1, "component_id": 2})
    for shard_rows in (h.SHARD_ROWS, 1):  # with 1 every shard is dealt on
        got = sorted((str(r[0]), r[1], str(r[2])) for r in h.near_duplicates(docs, shard_rows=shard_rows).collect())
        assert got == want


def test_ids_link_nothing(spark):
    """Two texts of one id don't join their groups; a text without an id joins those on both sides of it."""
    rng = random.Random(9)
    one, two = words(rng, 200), words(rng, 200)
    got = {(r[0], r[2]) for r in h.near_duplicates(documents(spark, [(5, one), (5, two), (6, one), (7, two)])).collect()}
    assert got == {(5, 5), (6, 5), (7, 5)}
    got = sorted((r[0], r[2]) for r in h.near_duplicates(documents(spark, [(1, one), (1, two), (2, one), (3, two), (0, two)])).collect())
    assert got == [(0, 0), (1, 0), (1, 1), (2, 1), (3, 0)]
    chain = [0, 0b1111, 0b11111111]
    classes = spark.createDataFrame([(x, x) for x in chain], "id long, fp long")
    assert {r[1] for r in c.components(h.links(classes)).collect()} == {0}


def test_empty_table(spark):
    assert h.near_duplicates(documents(spark, [])).count() == 0
