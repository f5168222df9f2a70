"""Byte-level BPE by monoid tree reduction.

The encodings of byte strings form a monoid: the encoding of ``a + b`` follows from those of ``a`` and ``b``. A match of the
pattern is encoded by encoding its halves and joining them, so its tokens are the root of a tree of joins.

* A join merges the bytes of a window around the seam anew: the last tokens of the left side and the first ones of the
  right side. The window grows on a side until its outermost token there is the one that was there before.
* Then the tokens outside stand. If each pair of neighbouring tokens is what its own bytes encode to, so is the whole: take
  the first merge that would cross a border between two tokens. Up to it nothing crossed any border, so both tokens went
  through the same merges as in their own two-token string, and there too it would be the next. Pairs outside the window
  and across its edges were neighbours before the join, pairs inside come from an encoding.
* Matches of the pattern never merge with each other, so above them a join is a concatenation. The same holds for decoding.

Merging takes the pair of lowest rank, of equal ones the leftmost, as the rank files are meant.
"""

from __future__ import annotations

import base64
import heapq
import uuid
from collections.abc import Callable, Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strata.llm.common import batches_of

#: Matches up to so many bytes are merged at once, longer ones are halved.
LEAF_BYTES = 32
#: Windows up to so many parts are merged by looking at all pairs, larger ones through a heap.
SMALL_WINDOW = 48
#: Matches kept with their ids in a worker, twice as many at most, and the longest that is kept.
KEPT, KEPT_BYTES = 400_000, 64
_NONE = 1 << 62
SLICE_BYTES = 1 << 20
SLICE_TOKENS = 1 << 18
#: Tokens put together at once when decoding; longer lists are halved.
LEAF_TOKENS = 4096


def read_ranks(path: str) -> dict[bytes, int]:
    """The rank file at ``path``, a local file of the driver: a token in base 64 and its rank on each line."""
    with open(path, "rb") as lines:
        return {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, lines)}


class Vocabulary:
    """Tokens by rank, and the monoid of their encodings."""

    def __init__(self, ranks: dict[bytes, int]):
        missing = [i for i in range(256) if bytes([i]) not in ranks]
        if missing:
            raise ValueError(f"bytes without a token: {missing[:5]}")
        self.ranks, self.tokens = ranks, {rank: token for token, rank in ranks.items()}
        # where each token's bytes lie among those of all tokens; of a number that is no rank -1
        self.lengths = np.full(max(self.tokens) + 1, -1, np.int64)
        for rank, token in self.tokens.items():
            self.lengths[rank] = len(token)
        self.starts = np.cumsum(np.maximum(self.lengths, 0)) - np.maximum(self.lengths, 0)
        self.bytes = np.frombuffer(b"".join(self.tokens[r] for r in sorted(self.tokens)), np.uint8)

    def merge(self, piece: bytes) -> list[int]:
        """Tokens of a byte string, by merges alone."""
        if len(piece) > SMALL_WINDOW:
            return self._merge_by_heap(piece)
        ranks, rank_of = self.ranks, self.ranks.get
        parts = [piece[i : i + 1] for i in range(len(piece))]
        pairs = [rank_of(piece[i : i + 2], _NONE) for i in range(len(piece) - 1)]
        while pairs and (least := min(pairs)) < _NONE:
            at = pairs.index(least)
            merged = parts[at] + parts.pop(at + 1)
            parts[at] = merged
            del pairs[at]
            if at:
                pairs[at - 1] = rank_of(parts[at - 1] + merged, _NONE)
            if at < len(pairs):
                pairs[at] = rank_of(merged + parts[at + 1], _NONE)
        return [ranks[part] for part in parts]

    def _merge_by_heap(self, piece: bytes) -> list[int]:
        ranks, n = self.ranks, len(piece)
        end = list(range(1, n + 1))  # of the part that starts here
        before = list(range(-1, n - 1))
        heap = []

        def offer(a: int) -> None:
            b = end[a]
            if b < n and (rank := ranks.get(piece[a : end[b]])) is not None:
                heapq.heappush(heap, (rank, a, b, end[b]))

        for i in range(n - 1):
            offer(i)
        gone = [False] * n
        while heap:
            _, a, b, stop = heapq.heappop(heap)
            if gone[a] or gone[b] or end[a] != b or end[b] != stop:
                continue  # one of the parts has grown since
            end[a], gone[b] = stop, True
            if stop < n:
                before[stop] = a
            offer(a)
            if before[a] >= 0:
                offer(before[a])
        ids, at = [], 0
        while at < n:
            ids.append(ranks[piece[at : end[at]]])
            at = end[at]
        return ids

    def join(self, left: list[int], right: list[int]) -> list[int]:
        """The encoding of the bytes of two encodings, one after the other."""
        if not left or not right:
            return left + right
        tokens, i, j = self.tokens, 1, 1
        while True:
            i, j = min(i, len(left)), min(j, len(right))
            window = self.merge(b"".join([tokens[t] for t in left[len(left) - i :] + right[:j]]))
            stands = i == len(left) or window[0] == left[-i]
            if stands and (j == len(right) or window[-1] == right[j - 1]):
                return left[: len(left) - i] + window + right[j:]
            if not stands:
                i *= 2
            if j < len(right) and window[-1] != right[j - 1]:
                j *= 2

    def encode(self, piece: bytes) -> list[int]:
        """Tokens of one match of the pattern."""
        whole = self.ranks.get(piece)
        return self._reduce(piece) if whole is None else [whole]

    def _reduce(self, piece: bytes) -> list[int]:
        if len(piece) <= LEAF_BYTES:
            return self.merge(piece)
        middle = len(piece) // 2
        return self.join(self._reduce(piece[:middle]), self._reduce(piece[middle:]))

    def decode(self, ids: np.ndarray) -> bytes:
        """Bytes of an array of tokens, put together up the tree."""
        if len(ids) > LEAF_TOKENS:
            middle = len(ids) // 2
            return self.decode(ids[:middle]) + self.decode(ids[middle:])
        if len(ids) and not (0 <= ids.min() and ids.max() < len(self.lengths) and (self.lengths[ids] >= 0).all()):
            raise ValueError("ids that are no ranks")
        lengths = self.lengths[ids]
        ends = np.cumsum(lengths)
        places = np.repeat(self.starts[ids] - ends + lengths, lengths) + np.arange(ends[-1] if len(ids) else 0)
        return self.bytes[places].tobytes()


class _Kept(dict):
    """Ids by match, encoded when first asked for. What was not asked for since the last time it was full is forgotten."""

    def __init__(self, vocabulary: Vocabulary):
        super().__init__()
        self.vocabulary, self.older = vocabulary, {}

    def __missing__(self, match: str) -> tuple[int, ...]:
        ids = self.older.get(match)
        if ids is None:
            piece = match.encode()
            ids = tuple(self.vocabulary.encode(piece))
            if len(piece) > KEPT_BYTES:
                return ids
        if len(self) >= KEPT:
            self.older = dict(self)
            self.clear()
        self[match] = ids
        return ids


def text_encoder(vocabulary: Vocabulary, pattern: str) -> Callable[[str], np.ndarray]:
    """A function from a whole text to its ids. Matches are encoded as they are found, so a long text costs its ids only."""
    matches, kept = regex.compile(pattern), _Kept(vocabulary)

    def encode(text: str) -> np.ndarray:
        found = (m.group() for m in matches.finditer(text)) if len(text) > SLICE_BYTES else matches.findall(text)
        return np.fromiter(chain.from_iterable(map(kept.__getitem__, found)), np.int32)

    return encode


#: The encoder of this worker's latest job, by the job's key.
_ENCODERS: dict[str, Callable[[str], np.ndarray]] = {}


def _lists(values: list[np.ndarray]) -> pa.Array:
    offsets = np.zeros(len(values) + 1, np.int32)
    np.cumsum([len(v) for v in values], out=offsets[1:])
    return pa.ListArray.from_arrays(offsets, np.concatenate(values) if values else np.empty(0, np.int32))


def encode(docs: DataFrame, ranks: dict[bytes, int], pattern: str) -> DataFrame:
    """doc_id and ids (array of int) of each row's whole text, by the ranks, each match of ``pattern`` by itself.

    The pattern is one of the ``regex`` module and has to cover every text; text between matches is left out, as the
    pattern asks. There are no special tokens. NULL and empty texts have no ids. Rows are independent of each other: repeated
    rows and NULL ids stay as they are, an empty table gives an empty one, and columns beside doc_id and text aren't read.
    A text is one task's work; batches of rows are cut to about a megabyte of text. The ranks go to every task: their
    size is that of a vocabulary file, whatever the corpus.
    """
    sent, key = docs.sparkSession.sparkContext.broadcast(ranks), uuid.uuid4().hex

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        if key not in _ENCODERS:  # a worker's later tasks find what it has kept
            _ENCODERS.clear()
            _ENCODERS[key] = text_encoder(Vocabulary(sent.value), pattern)
        ids_of = _ENCODERS[key]
        for batch in batches:
            for start, end in batches_of(batch, "text", SLICE_BYTES):
                part = batch.slice(start, end - start)
                ids = [ids_of(text) for text in part.column("text").to_pylist()]
                yield pa.RecordBatch.from_arrays([part.column("doc_id").cast(pa.int64()), _lists(ids)], names=["doc_id", "ids"])

    return docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text")).mapInArrow(run, "doc_id long, ids array<int>")


def decode(encoded: DataFrame, ranks: dict[bytes, int]) -> DataFrame:
    """The frame of (doc_id, ids) with the bytes that the ids stand for as column ``decoded``; NULL ids are an empty list.

    An id that is no rank fails.
    """
    sent = encoded.sparkSession.sparkContext.broadcast(ranks)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        vocabulary = Vocabulary(sent.value)
        for batch in batches:
            ids = batch.column("ids")
            values, offsets = ids.values.to_numpy(), ids.offsets.to_numpy()
            start = 0
            while start < batch.num_rows:
                end = max(start + 1, int(np.searchsorted(offsets, offsets[start] + SLICE_TOKENS, "right")) - 1)
                texts = [vocabulary.decode(values[a:b]) for a, b in zip(offsets[start:end], offsets[start + 1 : end + 1], strict=True)]
                part = batch.slice(start, end - start)
                columns = [part.column("doc_id"), part.column("ids"), pa.array(texts, pa.binary())]
                yield pa.RecordBatch.from_arrays(columns, names=["doc_id", "ids", "decoded"])
                start = end

    return encoded.select("doc_id", F.coalesce("ids", F.array().cast("array<int>")).alias("ids")).mapInArrow(
        run, "doc_id long, ids array<int>, decoded binary"
    )


def digests(decoded: DataFrame) -> DataFrame:
    """doc_id, n_tokens, ids_sha256 (of the decimal ids joined by one space) and decoded_sha256 of decoded rows."""
    return decoded.select(
        "doc_id",
        F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(F.concat_ws(" ", F.col("ids").cast("array<string>")).cast("binary"), 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )
