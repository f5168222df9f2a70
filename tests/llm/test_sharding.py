from __future__ import annotations

import hashlib
import random
from collections import Counter

import pytest

from strata.llm import sharding as s
from tests.llm.frames import documents


def bits(doc_id) -> str:
    digest = hashlib.md5(("" if doc_id is None else str(doc_id)).encode()).hexdigest()[:15]
    return f"{int(digest, 16):060b}"


def split(rows, limit: int, prefix: str = "") -> dict:
    """Shard by row number, splitting only what is too large."""
    if sum(n for _, _, n in rows) <= limit or len(rows) == 1 or len(prefix) == 60:
        return {i: "s" + prefix for i, _, _ in rows}
    out = {}
    for bit in "01":
        own = [r for r in rows if r[1][len(prefix)] == bit]
        if own:
            out |= split(own, limit, prefix + bit)
    return out


@pytest.mark.parametrize("limit,steps", [(10**9, s.STEPS), (20_000, s.STEPS), (1_500, s.STEPS), (3_000, [2, 4, 8, 60])])
def test_shards_by_brute_force(spark, monkeypatch, limit, steps):
    monkeypatch.setattr(s, "STEPS", steps)
    rng = random.Random(3)
    texts = [(k, "é" * rng.randrange(400)) for k in range(300)] + [(1000, None), (1001, ""), (1002, "x" * 30_000), (None, "no id")]
    got = s.assign(documents(spark, texts, {"shard": "clash", "depth": 1, "__x": 2, "__hash": 3, "__bytes": 4, "__depth": 5, "__group": 6, "__key": 7}), limit).collect()
    rows = [(i, bits(d), len((t or "").encode())) for i, (d, t) in enumerate(texts)]
    want = split(rows, limit)
    assert sorted((str(r["doc_id"]), r["n_bytes"], r["shard"], r["depth"]) for r in got) == sorted(
        (str(texts[i][0]), n, want[i], len(want[i]) - 1) for i, _, n in rows
    )


def test_rows_of_one_id_are_split_by_position(spark):
    texts = [(7, "x" * 100)] * 50 + [(7, "y" * 90)] * 20 + [(k, "z" * 100) for k in range(20, 60)]
    got = s.assign(documents(spark, texts), 1000).collect()
    assert len(got) == len(texts)
    size, rows = Counter(), Counter()
    for r in got:
        size[r["shard"]] += r["n_bytes"]
        rows[r["shard"]] += 1
    assert all(n <= 1000 or rows[shard] == 1 for shard, n in size.items())
    assert any("-" in shard for shard in size)


def test_written_shards(spark, tmp_path):
    docs = documents(spark, [(k, "x" * 100) for k in range(100)])
    s.write_shards(docs, str(tmp_path / "shards"), 2_000)
    back = spark.read.parquet(str(tmp_path / "shards"))
    assert back.count() == 100
    folders = [p for p in (tmp_path / "shards").iterdir() if p.name.startswith("shard=")]
    assert len(folders) > 4 and all(len(list(f.glob("*.parquet"))) == 1 for f in folders)


def test_empty_table(spark):
    assert s.assign(documents(spark, [])).count() == 0
