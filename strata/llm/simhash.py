"""SimHash near-duplicates through BK-trees.

1. Every text gets a 64-bit fingerprint of its word shingles. Equal fingerprints form a class; only classes go on.
2. Two fingerprints that differ in at most r bits agree in at least one of r + 1 blocks of bits. Each class is dealt to
   one shard per block, keyed by the block's bits, so any pair to be linked meets in a shard. A shard with over
   ``SHARD_ROWS`` classes is dealt on by blocks of the remaining bits, by the same argument.
3. A shard builds a BK-tree: the children of a node are keyed by their Hamming distance to it. A search follows only the
   edges within r of its own distance. Subtrees already linked to the searching class are skipped, so a dense group
   costs about one visit per class and yields a spanning tree of links, never all pairs.
4. The links of all shards form the components.

Trees are built where their shard is and not broadcast: together they grow with the data, and only its own shard
searches a tree.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from strata.llm.common import batches_of, parts_for, stash, utf8
from strata.llm.components import components

WORDS = 4
RADIUS = 4
SEED = 42
SHARD_ROWS = 20_000
SLICE_BYTES = 1 << 20


def shingles(parts: list[bytes], words: int) -> list[bytes]:
    """Runs of ``words`` words, joined by spaces; of fewer words all of them, of none nothing."""
    if len(parts) <= words:
        return [b" ".join(parts)] if parts else []
    line = b" ".join(parts)
    ends = np.cumsum(np.fromiter(map(len, parts), np.int64, len(parts)) + 1)
    starts = np.concatenate([[0], ends[:-words]]).tolist()
    return [line[a:b] for a, b in zip(starts, (ends[words - 1 :] - 1).tolist(), strict=True)]


def bits_of(hashes: np.ndarray) -> int:
    """The bits that are set in over half the hashes."""
    hashes, ones = hashes.astype(">u8"), np.zeros(64, np.int64)
    for at in range(0, len(hashes), 4096):
        ones += np.unpackbits(hashes[at : at + 4096].view(np.uint8).reshape(-1, 8), axis=1).sum(axis=0, dtype=np.int64)
    return int.from_bytes(np.packbits(2 * ones > len(hashes)).tobytes(), "big")


def fingerprint(text: bytes, words: int = WORDS) -> int:
    """SimHash of the lower-cased word shingles of a UTF-8 text, repeats included; zero if it has no word."""
    return bits_of(np.array([xxhash.xxh64_intdigest(s, SEED) for s in shingles(text.lower().split(), words)], np.uint64))


def fingerprints(docs: DataFrame, words: int = WORDS) -> DataFrame:
    """doc_id and fp (the 64 bits as a signed long) of each row's whole text."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for start, end in batches_of(batch, "text", SLICE_BYTES):
                part = batch.slice(start, end - start)
                fps = np.array([fingerprint(t, words) for t in part.column("text").to_pylist()], np.uint64).view(np.int64)
                yield pa.RecordBatch.from_arrays([part.column("doc_id").cast(pa.int64()), pa.array(fps)], names=["doc_id", "fp"])

    return docs.select("doc_id", utf8().alias("text")).mapInArrow(run, "doc_id long, fp long")


class _Union:
    """Disjoint sets over 0..n-1."""

    def __init__(self, n: int):
        self.up = list(range(n))

    def find(self, x: int) -> int:
        up = self.up
        while up[x] != x:
            up[x] = up[up[x]]
            x = up[x]
        return x


def tree_links(fps: list[int], radius: int = RADIUS) -> list[tuple[int, int]]:
    """Links (pairs of positions) that connect what lies within ``radius`` bits of each other in a BK-tree of ``fps``.

    They join the same components as all pairs within the radius do, and are fewer than ``fps``.
    """
    sets, links = _Union(len(fps)), []
    children: list[dict[int, int]] = [{} for _ in fps]  # by distance; a node has the position of its fingerprint
    whole = [True] * len(fps)  # all of the subtree is known to be in one set
    for x in range(1, len(fps)):
        fp, todo = fps[x], [0]
        while todo:
            node = todo.pop()
            distance = (fps[node] ^ fp).bit_count()
            if distance <= radius:
                a, b = sets.find(node), sets.find(x)
                if a != b:
                    sets.up[max(a, b)] = min(a, b)
                    links.append((node, x))
            for key, child in children[node].items():
                if -radius <= key - distance <= radius and not (whole[child] and sets.find(child) == sets.find(x)):
                    todo.append(child)
        node = 0
        while True:
            if whole[node] and sets.find(node) != sets.find(x):
                whole[node] = False
            distance = (fps[node] ^ fp).bit_count()
            if distance not in children[node]:
                children[node][distance] = x
                break
            node = children[node][distance]
    return links


def _blocks(bits: list[int], n: int) -> list[list[int]]:
    cuts = [len(bits) * i // n for i in range(n + 1)]
    return [bits[a:b] for a, b in zip(cuts, cuts[1:], strict=False)]


def _value(bits: list[int]) -> Column:
    """The given bits of the fingerprint as one number; neighbouring bits are taken together."""
    total, at = F.lit(0).cast("long"), 0
    while at < len(bits):
        run = at
        while run + 1 < len(bits) and bits[run + 1] == bits[run] + 1:
            run += 1
        part = F.shiftrightunsigned(F.col("fp"), bits[at]).bitwiseAND(F.lit((1 << (run + 1 - at)) - 1).cast("long"))
        total, at = total + F.shiftleft(part, at), run + 1
    return total


def _values(blocks: list[list[int]]) -> Column:
    return F.array(*[F.struct(F.lit(i).alias("i"), _value(bits).alias("v")) for i, bits in enumerate(blocks)])


def _deal(classes: DataFrame, radius: int, shard_rows: int) -> DataFrame:
    """(shard, fp, id): each class once for each shard it is dealt to."""
    blocks = _blocks(list(range(64)), radius + 1)
    dealt = stash(classes.select("fp", "id", F.explode(_values(blocks)).alias("s")).select("fp", "id", "s.i", "s.v"), "shards")
    large = stash(dealt.groupBy("i", "v").count().filter(F.col("count") > shard_rows).select("i", "v"), "large-shards")
    shard = F.concat_ws(":", "i", "v")
    small = dealt.join(large, ["i", "v"], "left_anti").select(shard.alias("shard"), "fp", "id")
    if large.isEmpty():
        return small
    finer = F.array().cast("array<struct<i:int,v:bigint>>")
    for i, block in enumerate(blocks):
        rest = [bit for bit in range(64) if bit not in block]
        finer = F.when(F.col("i") == i, _values(_blocks(rest, radius + 1))).otherwise(finer)
    again = dealt.join(large, ["i", "v"], "left_semi").select("fp", "id", shard.alias("shard"), F.explode(finer).alias("s"))
    return small.union(again.select(F.concat_ws(":", "shard", "s.i", "s.v").alias("shard"), "fp", "id"))


def links(classes: DataFrame, radius: int = RADIUS, shard_rows: int = SHARD_ROWS) -> DataFrame:
    """(a, b): links between classes (id, fp), enough to connect all that lie within ``radius`` bits."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shard, fps, ids = None, [], []

        def linked() -> pa.RecordBatch:
            found = tree_links(fps, radius) if len(fps) > 1 else []
            return pa.RecordBatch.from_arrays(
                [pa.array([ids[i] for i, _ in found], pa.int64()), pa.array([ids[j] for _, j in found], pa.int64())], names=["a", "b"]
            )

        for batch in batches:  # sorted by shard
            for key, fp, name in zip(
                batch.column("shard").to_pylist(),
                batch.column("fp").to_numpy().view(np.uint64).tolist(),
                batch.column("id").to_pylist(),
                strict=True,
            ):
                if key != shard:
                    if len(fps) > 1:
                        yield linked()
                    shard, fps, ids = key, [], []
                fps.append(fp)
                ids.append(name)
        yield linked()

    dealt = _deal(classes, radius, shard_rows)
    together = dealt.repartition(parts_for(classes), "shard").sortWithinPartitions("shard", "id")
    return together.mapInArrow(run, "a long, b long")


def near_duplicates(docs: DataFrame, words: int = WORDS, radius: int = RADIUS, shard_rows: int = SHARD_ROWS) -> DataFrame:
    """doc_id, fingerprint (16 lower-case hex digits) and component_id, one row for each row of ``docs``.

    The component is the smallest doc_id reachable over fingerprints that differ in at most ``radius`` bits. Fingerprints
    are what is linked, so texts that share an id aren't linked by it, and a text without an id links others all the same. NULL and
    blank texts have fingerprint zero, which is linked like any other. Repeated rows share their class. A NULL id names a
    component only if there is no other id (then NULL). No rows give no rows.
    """
    marked = stash(fingerprints(docs, words), "fingerprints")
    classes = stash(marked.groupBy("fp").agg(F.min("doc_id").alias("least")).withColumn("id", F.col("fp")), "classes")
    found = components(links(classes.select("id", "fp"), radius, shard_rows))
    placed = classes.join(found, classes["id"] == found["node"], "left").select("fp", "least", F.coalesce("component", "id").alias("component"))
    placed = stash(placed, "placed")
    names = placed.groupBy("component").agg(F.min("least").alias("component_id"))
    named = placed.join(names, "component").select("fp", "component_id")
    return marked.join(named, "fp", "left").select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")
