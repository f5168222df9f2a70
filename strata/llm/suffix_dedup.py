"""Exact removal of long repeated byte strings, by suffix sorting around sampled anchors.

A string of ``LENGTH`` bytes is removed where it also starts anywhere else. All positions of all texts are covered, but
suffixes are only sorted where a repeat is possible:

1. Every window of ``LENGTH`` bytes has an anchor: the least hash of its ``KMER``-byte strings. Equal windows have equal anchors at the
   same offset. Neighbouring windows share an anchor; such a stretch (some 150 windows) is a row of hashes, without text.
2. Stretches of equal anchor and content form a class. A class that occurs twice is repeated whole. A class whose anchor no other
   class has is not repeated at all.
3. Only where different classes share an anchor is text needed, once per class. Their suffixes from the anchor on, and their
   prefixes read backwards, are sorted deep-shallow: multikey quicksort by words to ``SHALLOW`` bytes, then the groups that still
   agree go through blind tries. The longest common prefixes of neighbours then tell which windows of which classes agree.
4. An anchor with over ``HOT_CLASSES`` classes is not sorted in one task; its windows are counted one by one, by hash.

Ids of documents and texts that repeat are fine: rows are told apart by doc_id and a hash of the text, and rows that agree in both
have the same result. NULL texts are empty. Extra columns don't matter.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strata.llm.common import batches_of, parts_for, stash, utf8

LENGTH = 400
KMER = 100
SHALLOW = 64
HOT_CLASSES = 50_000
SLICE_BYTES = 1 << 20
BATCH_CLASSES = 4096

_BASE = np.uint64(0x9E3779B97F4A7C15)
_CODES = np.random.default_rng(5).integers(1, 1 << 63, 256, dtype=np.uint64)


def _mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    x = (x ^ (x >> np.uint64(29))) * np.uint64(0xA0761D6478BD642F)
    return x ^ (x >> np.uint64(32))


class _Rolling:
    """Hashes of any stretch of bytes in constant time each, from running sums."""

    powers = np.ones(1, np.uint64)
    inverse = np.ones(1, np.uint64)

    def __init__(self, data: bytes):
        if len(_Rolling.powers) <= len(data):
            n = max(len(data) + 1, SLICE_BYTES * 2)
            _Rolling.powers = np.concatenate([[np.uint64(1)], np.full(n, _BASE)]).cumprod(dtype=np.uint64)
            _Rolling.inverse = np.concatenate([[np.uint64(1)], np.full(n, np.uint64(pow(int(_BASE), -1, 1 << 64)))]).cumprod(dtype=np.uint64)
        codes = _CODES[np.frombuffer(data, np.uint8)]
        self.sums = np.concatenate([[np.uint64(0)], (codes * _Rolling.powers[: len(data)]).cumsum(dtype=np.uint64)])

    def of(self, start: np.ndarray, length: np.ndarray | int) -> np.ndarray:
        return _mixed((self.sums[start + length] - self.sums[start]) * _Rolling.inverse[start] + np.asarray(length).astype(np.uint64))


def _stretches(texts: list[bytes]) -> dict[str, np.ndarray]:
    """Stretches of windows that share an anchor: row, start (in the row), windows, offset (of the anchor), anchor, content, last
    (start of the last of several equal stretches in a row) and n (how many)."""
    data = b"".join(texts)
    names = ("row", "start", "windows", "offset", "anchor", "content", "last", "n")
    if len(data) < LENGTH:
        return {name: np.zeros(0, np.int64) for name in names}
    rolling = _Rolling(data)
    starts = np.arange(len(data) - KMER + 1)
    kmers = rolling.of(starts, KMER)
    bits = np.uint64(int(len(data)).bit_length())
    # the position in the low bits makes the leftmost of equals the least
    least = (kmers >> bits << bits) | starts.astype(np.uint64)
    width, span = LENGTH - KMER + 1, 1
    while span * 2 <= width:
        least = np.minimum(least[:-span], least[span:])
        span *= 2
    if span < width:
        least = np.minimum(least[: len(least) - (width - span)], least[width - span :])
    at = (least & ((np.uint64(1) << bits) - np.uint64(1))).astype(np.int64)
    sizes = np.array([len(t) for t in texts])
    ends = np.cumsum(sizes)
    rows = np.searchsorted(ends, np.arange(len(at)), side="right")
    valid = np.flatnonzero(np.arange(len(at)) + LENGTH <= ends[np.minimum(rows, len(ends) - 1)])
    if not len(valid):
        return {name: np.zeros(0, np.int64) for name in names}
    at, row = at[valid], rows[valid]
    firsts = np.flatnonzero(np.concatenate([[True], (at[1:] != at[:-1]) | (row[1:] != row[:-1])]))
    count = np.diff(np.concatenate([firsts, [len(valid)]]))
    start, at, row = valid[firsts], at[firsts], row[firsts]
    content = _mixed(rolling.of(start, count + (LENGTH - 1)) + (at - start).astype(np.uint64))
    # where a text repeats itself with a short period, equal stretches follow each other
    run = np.flatnonzero(np.concatenate([[True], (content[1:] != content[:-1]) | (row[1:] != row[:-1])]))
    base = (ends - sizes)[row]
    last = np.concatenate([run[1:], [len(start)]]) - 1
    return {
        "row": row[run],
        "start": (start - base)[run],
        "windows": count[run],
        "offset": (at - start)[run],
        "anchor": kmers[at[run]].view(np.int64),
        "content": content[run].view(np.int64),
        "last": (start - base)[last],
        "n": last - run + 1,
    }


def _common(a: bytes, b: bytes) -> int:
    """Length of the common prefix."""
    m = min(len(a), len(b))
    differ = int.from_bytes(a[:m], "big") ^ int.from_bytes(b[:m], "big")
    return m - (differ.bit_length() + 7) // 8


def _blind_trie(strings: list[bytes], group: list[int]) -> list[int]:
    """``group`` in the order of its strings. Nodes know only the depth and the byte at which strings part; one comparison
    per string, with the leaf that a search by these bytes ends at, tells where it belongs."""
    root: list = [group[0]]  # a leaf lists equal strings; an inner node is (depth, children by byte)
    top: dict = {0: root}
    for i in group[1:]:
        s, holder, key, path = strings[i], top, 0, []
        node = top[0]
        while isinstance(node, tuple):
            path.append((holder, key, node))
            depth, children = node
            byte = s[depth] if depth < len(s) else -1
            holder, key = children, byte if byte in children else next(iter(children))
            node = children[key]
        path.append((holder, key, node))
        other = strings[node[0]]
        shared = _common(s, other)
        if shared == len(s) == len(other):
            node.append(i)
            continue
        for holder, key, node in path:
            if not isinstance(node, tuple) or node[0] >= shared:
                break
        byte = s[shared] if shared < len(s) else -1
        if isinstance(node, tuple) and node[0] == shared:
            node[1][byte] = [i]
        else:
            holder[key] = (shared, {other[shared] if shared < len(other) else -1: node, byte: [i]})
    order, todo = [], [top[0]]
    while todo:
        node = todo.pop()
        if isinstance(node, tuple):
            todo += [node[1][byte] for byte in sorted(node[1], reverse=True)]
        else:
            order += node
    return order


def deep_shallow(strings: list[bytes], depth: int = 0, shallow: int = SHALLOW) -> list[int]:
    """Positions of ``strings`` in their order; the first ``depth`` bytes are known to agree."""
    order: list[int] = []
    limit, todo = depth + shallow, [(list(range(len(strings))), depth)]
    while todo:
        group, at = todo.pop()
        if len(group) < 2:
            order += group
        elif at >= limit:
            order += _blind_trie(strings, group)
        else:
            words = [strings[i][at : at + 8] for i in group]
            pivot = words[len(words) // 2]
            less = [i for i, w in zip(group, words, strict=True) if w < pivot]
            equal = [i for i, w in zip(group, words, strict=True) if w == pivot]
            more = [i for i, w in zip(group, words, strict=True) if w > pivot]
            todo += [(more, at), (equal, at + 8 if len(pivot) == 8 else limit), (less, at)]
    return order


def _ranks(groups: list[list[bytes]], depth: int) -> tuple[np.ndarray, np.ndarray]:
    """Rank of every string in the order of groups and, inside, of strings; common prefix of each rank with the one before
    (-1 at the start of a group)."""
    ranks, shared, base = [], [], 0
    for strings in groups:
        order = deep_shallow(strings, depth)
        own = [0] * len(order)
        for r, i in enumerate(order):
            own[i] = base + r
        ranks += own
        shared += [-1] + [_common(strings[a], strings[b]) for a, b in zip(order, order[1:], strict=False)]
        base += len(order)
    return np.array(ranks), np.array(shared)


def repeated_windows(groups: list[list[tuple[int, int, bytes]]]) -> np.ndarray:
    """Which windows of stretches occur in another stretch of their group. Stretches are (windows, offset of the anchor, text).

    Returns a matrix: stretch (counted through all groups) by offset of the anchor in the window.
    """
    flat = [stretch for group in groups for stretch in group]
    right, after = _ranks([[text[offset:] for _, offset, text in group] for group in groups], KMER)
    left, before = _ranks([[text[:offset][::-1] for _, offset, text in group] for group in groups], 0)
    high = np.array([offset for _, offset, _ in flat])
    low = high - np.array([windows for windows, _, _ in flat]) + 1
    found = np.zeros((len(flat), LENGTH - KMER + 1), bool)
    for offset in range(LENGTH - KMER + 1):
        own = np.flatnonzero((low <= offset) & (offset <= high))
        if len(own) < 2:
            continue
        # classes of those that agree in so many bytes before the anchor, and in so many from it on
        a = np.cumsum(before < offset)[left[own]]
        b = np.cumsum(after < LENGTH - offset)[right[own]]
        _, which, n = np.unique(a * (len(flat) + 1) + b, return_inverse=True, return_counts=True)
        found[own, offset] = n[which] > 1
    return found


def _sliced(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[pa.RecordBatch, list[bytes]]]:
    for batch in batches:
        for start, end in batches_of(batch, "text", SLICE_BYTES):
            part = batch.slice(start, end - start)
            yield part, part.column("text").to_pylist()


def _documents(docs: DataFrame) -> DataFrame:
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), utf8().alias("text")).withColumn("text_hash", F.xxhash64("text"))


def _all_stretches(texts: DataFrame) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part, own in _sliced(batches):
            found = _stretches(own)
            rows = pa.array(found["row"], pa.int64())
            yield pa.RecordBatch.from_arrays(
                [part.column("doc_id").take(rows), part.column("text_hash").take(rows)]
                + [pa.array(found[c].astype(np.int64 if c in ("anchor", "content") else np.int32)) for c in columns],
                names=["doc_id", "text_hash", *columns],
            )

    columns = ["start", "windows", "offset", "anchor", "content", "last", "n"]
    schema = "doc_id long, text_hash long, start int, windows int, offset int, anchor long, content long, last int, n int"
    return texts.mapInArrow(run, schema)


def _attach(texts: DataFrame, known: DataFrame, column: str, how: str) -> DataFrame:
    """``texts`` with the array that ``known`` has for their rows. Texts go to it by a shuffle, at any size alike."""
    same = texts["doc_id"].eqNullSafe(known["doc_id"]) & (texts["text_hash"] == known["text_hash"])
    return texts.join(known, same, how).select(texts["doc_id"], texts["text_hash"], "text", column)


def _contexts(texts: DataFrame, classes: DataFrame) -> DataFrame:
    """(doc_id, text_hash, anchor, windows, offset, start, n, bytes) of classes, cut from the text of their least occurrence."""
    cuts = classes.select(
        F.col("first.doc_id").alias("doc_id"),
        F.col("first.text_hash").alias("text_hash"),
        F.struct("anchor", "windows", "offset", F.col("first.start").alias("start"), "n").alias("cut"),
    )
    cuts = cuts.groupBy("doc_id", "text_hash").agg(F.collect_list("cut").alias("cuts"))
    # rows that agree in id and text give the same cuts
    cut = _attach(texts, cuts, "cuts", "inner").select("doc_id", "text_hash", "text", F.explode("cuts").alias("cut"))
    return cut.select(
        "doc_id", "text_hash", "cut.*", F.expr(f"substring(text, cut.start + 1, cut.windows + {LENGTH - 1})").alias("bytes")
    )


def _partial(contexts: DataFrame) -> DataFrame:
    """Spans of classes that occur once and share some windows with other classes of their anchor."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        groups: list[list[tuple]] = []
        anchor = None

        def spans() -> pa.RecordBatch:
            out: list[tuple] = []
            ready = [g for g in groups if len(g) > 1]
            if ready:
                found = repeated_windows([[(r[1], r[2], r[5]) for r in g] for g in ready])
                for (_, _, offset, start, n, _, doc_id, text_hash), own in zip((r for g in ready for r in g), found, strict=True):
                    if n == 1 and own.any():
                        # a window whose anchor is at offset k starts at start + offset - k
                        edges = np.flatnonzero(np.diff(np.concatenate([[0], own.astype(np.int8), [0]])))
                        for a, b in zip(edges[::2].tolist(), edges[1::2].tolist(), strict=True):
                            out.append((doc_id, text_hash, start + offset - (b - 1), start + offset - a + LENGTH))
            columns = list(zip(*out, strict=True)) or [[], [], [], []]
            return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, (pa.int64(), pa.int64(), pa.int32(), pa.int32()), strict=True)], names=["doc_id", "text_hash", "start", "end"])

        held = 0
        for batch in batches:  # sorted by anchor
            for row in zip(*(batch.column(c).to_pylist() for c in ("anchor", "windows", "offset", "start", "n", "bytes", "doc_id", "text_hash")), strict=True):
                if row[0] != anchor:
                    if held >= BATCH_CLASSES:
                        yield spans()
                        groups, held = [], 0
                    groups.append([])
                    anchor = row[0]
                groups[-1].append(row)
                held += 1
        yield spans()

    together = contexts.repartition(parts_for(contexts), "anchor").sortWithinPartitions("anchor")
    return together.mapInArrow(run, "doc_id long, text_hash long, start int, end int")


def _counted(contexts: DataFrame) -> DataFrame:
    """The same for anchors with very many classes: equal windows are counted by hash, with partial sums."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for doc_id, text_hash, anchor, windows, start, n, data in zip(
                *(batch.column(c).to_pylist() for c in ("doc_id", "text_hash", "anchor", "windows", "start", "n", "bytes")), strict=True
            ):
                at = np.arange(windows)
                ids = pa.array([doc_id] * windows, pa.int64()), pa.array([text_hash] * windows, pa.int64()), pa.array([anchor] * windows, pa.int64())
                window = pa.array(_Rolling(data).of(at, LENGTH).view(np.int64))
                yield pa.RecordBatch.from_arrays(
                    [*ids, window, pa.array((at + start).astype(np.int32)), pa.array(np.full(windows, n, np.int64))],
                    names=["doc_id", "text_hash", "anchor", "window", "start", "n"],
                )

    rows = contexts.mapInArrow(run, "doc_id long, text_hash long, anchor long, window long, start int, n long")
    twice = rows.groupBy("anchor", "window").agg(F.count("*").alias("m")).filter("m > 1").select("anchor", "window")
    found = rows.filter("n = 1").join(twice, ["anchor", "window"], "left_semi")
    return found.select("doc_id", "text_hash", "start", (F.col("start") + LENGTH).alias("end"))


def repeated_spans(docs: DataFrame, hot_classes: int = HOT_CLASSES) -> DataFrame:
    """(doc_id, text_hash, spans): (start, end) in bytes of strings that also start elsewhere; they may overlap."""
    texts = _documents(docs)
    rows = stash(_all_stretches(texts), "stretches")
    key = ["anchor", "content"]
    classes = stash(
        rows.groupBy(*key).agg(
            F.sum("n").alias("n"),
            F.first("windows").alias("windows"),
            F.first("offset").alias("offset"),
            F.min(F.struct("doc_id", "text_hash", "start")).alias("first"),
        ),
        "classes",
    )
    several = stash(classes.groupBy("anchor").agg(F.count("*").alias("m")).filter("m > 1"), "anchors")
    whole = rows.join(classes.filter("n > 1").select(*key), key, "left_semi").select(
        "doc_id", "text_hash", "start", (F.col("last") + F.col("windows") + (LENGTH - 1)).alias("end")
    )
    usual = classes.join(several.filter(F.col("m") <= hot_classes).select("anchor"), "anchor", "left_semi")
    spans = whole.union(_partial(_contexts(texts, usual)))
    hot = several.filter(F.col("m") > hot_classes)
    if not hot.isEmpty():
        spans = spans.union(_counted(stash(_contexts(texts, classes.join(hot.select("anchor"), "anchor", "left_semi")), "hot-contexts")))
    return spans.groupBy("doc_id", "text_hash").agg(F.collect_set(F.struct("start", "end")).alias("spans"))


def _merged(spans: list[tuple[int, int]]) -> list[tuple[int, int]]:
    out: list[tuple[int, int]] = []
    for a, b in sorted(spans):
        if out and a <= out[-1][1]:
            out[-1] = (out[-1][0], max(out[-1][1], b))
        else:
            out.append((a, b))
    return out


def remove_repeats(docs: DataFrame, hot_classes: int = HOT_CLASSES) -> DataFrame:
    """doc_id, n_bytes, n_removed, n_spans, kept_sha256, kept (the remaining bytes), removed (start, end of the maximal runs): one row for
    each row of ``docs``. Every byte goes that a string of ``LENGTH`` bytes covers which also starts anywhere else, in the same text or another."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part, texts in _sliced(batches):
            out = []
            for doc_id, text, spans in zip(part.column("doc_id").to_pylist(), texts, part.column("spans").to_pylist(), strict=True):
                runs = _merged([(s["start"], s["end"]) for s in spans or ()])
                bounds = [0, *(x for run in runs for x in run), len(text)]
                kept = b"".join(text[a:b] for a, b in zip(bounds[::2], bounds[1::2], strict=True))
                removed = [{"start": a, "end": b} for a, b in runs]
                out.append((doc_id, len(text), len(text) - len(kept), len(runs), hashlib.sha256(kept).hexdigest(), kept, removed))
            kinds = (pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.binary(), pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32())])))
            columns = list(zip(*out, strict=True))
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, kinds, strict=True)], names=names)

    names = ["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256", "kept", "removed"]
    schema = "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string, kept binary, removed array<struct<start:int,end:int>>"
    return _attach(_documents(docs), repeated_spans(docs, hot_classes), "spans", "left").select("doc_id", "text", "spans").mapInArrow(run, schema)
