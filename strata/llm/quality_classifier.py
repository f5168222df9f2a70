"""Quality classifier over random-indexing word vectors.

1. Random indexing, over all documents. Words fall into ``BUCKETS`` by hash and every bucket has a fixed sparse ternary
   index vector. The vector of a bucket is the sum of the index vectors of its neighbours, in all texts. Tasks sum their
   own part, Spark adds the parts up. The result has ``BUCKETS`` rows at any input size, so it can be sent to all tasks.
2. Each document pools the vectors of its words, the index vectors of the words' shapes (letter case, digits, symbols),
   and its length and variety.
3. A network of two layers learns the labels on the driver, from at most ``TRAIN_ROWS`` labelled documents in hash order
   of the id (a bound of a few MB). A fifth of these only calibrates the temperature of the probabilities.
4. Tasks score the documents; nothing is shuffled for that.

Only the text is scored. NULL and empty texts pool to zeros and get a score like any other. Without labels of both
classes every score is the share of label 1 among the labels, or 0.5. NULL labels are skipped, of labels repeated for a document the least
counts. A NULL id has no label and isn't held out. Repeated rows are scored each. Extra columns don't matter.
"""

from __future__ import annotations

import re
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from strata.llm.common import batches_of

BUCKETS = 8192
SHAPES = 1024
DIM = 32
REACH = 2
TRAIN_ROWS = 20_000
FOLDS = 5
THRESHOLD = 0.3
SLICE_BYTES = 1 << 20
MEMO_WORDS = 300_000

_LETTERS = [(re.compile("[A-ZÀ-ÖØ-Þ]+"), "A"), (re.compile("[a-zß-öø-ÿ]+"), "a"), (re.compile("[0-9]+"), "0")]
_REPEATED = re.compile(r"(.)\1+", re.S)


def _index_vectors(rows: int, seed: int) -> np.ndarray:
    """Fixed sparse ternary vectors, and a last row of zeros for the gaps between documents."""
    vectors = np.random.default_rng(seed).choice(np.array([-1, 0, 1], np.float32), (rows + 1, DIM), p=[0.125, 0.75, 0.125])
    vectors[rows] = 0
    return vectors


class _Codes(dict):
    """Word to bucket * (SHAPES + 1) + shape; forgets all when full, so its memory is bounded."""

    def __missing__(self, word: str) -> int:
        if len(self) >= MEMO_WORDS:
            self.clear()
        shape = word
        for letters, sign in _LETTERS:
            shape = letters.sub(sign, shape)
        core = word.strip("#*$%&|<>.,;:!?\"'()[]{}").lower()
        code = zlib.crc32(core.encode()) % BUCKETS * (SHAPES + 1) + zlib.crc32(_REPEATED.sub(r"\1", shape)[:12].encode()) % SHAPES
        self[word] = code
        return code


def _slices(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[pa.RecordBatch, list[list[str]]]]:
    """Parts of the batches with the words of each text."""
    for batch in batches:
        for start, end in batches_of(batch, "text", SLICE_BYTES):
            part = batch.slice(start, end - start)
            yield part, [(text or "").split() for text in part.column("text").to_pylist()]


def _neighbour_sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    index, shape_index = _index_vectors(BUCKETS, 1), _index_vectors(SHAPES, 2)
    sums, codes, gap = np.zeros((BUCKETS + 1, DIM)), _Codes(), [BUCKETS * (SHAPES + 1) + SHAPES] * REACH
    for _, texts in _slices(batches):
        flat = list(gap)
        for words in texts:
            flat.extend(map(codes.__getitem__, words))
            flat.extend(gap)
        for at in range(0, len(flat), 100_000):  # with the neighbours of the part's ends
            low, high = max(0, at - REACH), min(len(flat), at + 100_000 + REACH)
            buckets, shapes = np.divmod(np.array(flat[low:high], np.int64), SHAPES + 1)
            own = index[buckets] + shape_index[shapes]
            near = np.zeros_like(own)
            for d in range(1, REACH + 1):
                near[d:] += own[:-d]
                near[:-d] += own[d:]
            inner = slice(at - low, min(len(flat), at + 100_000) - low)
            order = np.argsort(buckets[inner], kind="stable")
            values, firsts = np.unique(buckets[inner][order], return_index=True)
            sums[values] += np.add.reduceat(near[inner][order], firsts, axis=0)
    used = np.flatnonzero(sums[:BUCKETS].any(axis=1))
    yield pa.RecordBatch.from_arrays(
        [pa.array(used.astype(np.int32))] + [pa.array(sums[used, d].astype(np.int64)) for d in range(DIM)],
        names=["bucket", *(f"v{d}" for d in range(DIM))],
    )


def word_vectors(docs: DataFrame) -> np.ndarray:
    """Vectors of all buckets, of length one (or zero for buckets without words)."""
    schema = "bucket int, " + ", ".join(f"v{d} long" for d in range(DIM))
    parts = docs.select("text").mapInArrow(_neighbour_sums, schema)
    sums = parts.groupBy("bucket").agg(*[F.sum(f"v{d}").cast("double").alias(f"v{d}") for d in range(DIM)])
    vectors = np.zeros((BUCKETS + 1, DIM), np.float32)
    rows = np.array(sums.collect(), dtype=np.float64).reshape(-1, DIM + 1)  # BUCKETS rows at most
    vectors[rows[:, 0].astype(int)] = rows[:, 1:] / np.maximum(np.linalg.norm(rows[:, 1:], axis=1, keepdims=True), 1e-9)
    return vectors


def _pool(texts: list[list[str]], vectors: np.ndarray, shapes: np.ndarray, codes: _Codes) -> np.ndarray:
    """Features of each text."""
    counts = np.array([len(words) for words in texts], np.int64)
    out = np.zeros((len(texts), 2 * DIM + 3), np.float32)
    flat = np.fromiter((code for words in texts for code in map(codes.__getitem__, words)), np.int64, int(counts.sum()))
    full = np.flatnonzero(counts)
    if len(full):
        starts = (np.cumsum(counts) - counts)[full]
        bucket, shape = np.divmod(flat, SHAPES + 1)
        n = counts[full, None]
        out[full, :DIM] = np.add.reduceat(vectors[bucket], starts, axis=0) / n
        out[full, DIM : 2 * DIM] = np.add.reduceat(shapes[shape], starts, axis=0) / n
        out[full, 2 * DIM] = np.log1p(counts[full])
        distinct = np.array([len(set(texts[i])) for i in full])
        out[full, 2 * DIM + 1] = distinct / counts[full]
        out[full, 2 * DIM + 2] = np.log1p(counts[full]) - np.log1p(distinct)
    return out


@dataclass
class Model:
    """What scoring needs; its size does not depend on the input."""

    vectors: np.ndarray
    mean: np.ndarray
    spread: np.ndarray
    layers: list[np.ndarray]
    temperature: float
    prior: float | None = None

    def logits(self, x: np.ndarray) -> np.ndarray:
        w1, b1, w2, b2 = self.layers
        return np.tanh((x - self.mean) / self.spread @ w1 + b1) @ w2 + b2

    def scores(self, x: np.ndarray) -> np.ndarray:
        if self.prior is not None:
            return np.full(len(x), self.prior)
        z = np.clip(self.logits(x.astype(np.float64)) / self.temperature, -60, 60)
        return 1 / (1 + np.exp(-z))


def _train(x: np.ndarray, y: np.ndarray, hidden: int = 32, epochs: int = 60, rate: float = 0.005) -> list[np.ndarray]:
    """Adam on the log loss with a little weight decay."""
    rng = np.random.default_rng(11)
    layers = [rng.normal(0, x.shape[1] ** -0.5, (x.shape[1], hidden)), np.zeros(hidden), rng.normal(0, hidden**-0.5, hidden), np.zeros(1)]
    first, second, step = [np.zeros_like(a) for a in layers], [np.zeros_like(a) for a in layers], 0
    for _ in range(epochs):
        for rows in np.array_split(rng.permutation(len(x)), max(1, len(x) // 256)):
            h = np.tanh(x[rows] @ layers[0] + layers[1])
            error = (1 / (1 + np.exp(-np.clip(h @ layers[2] + layers[3], -60, 60))) - y[rows]) / len(rows)
            back = np.outer(error, layers[2]) * (1 - h * h)
            grads = [x[rows].T @ back + 1e-4 * layers[0], back.sum(0), h.T @ error + 1e-4 * layers[2], error.sum(keepdims=True)]
            step += 1
            for i, g in enumerate(grads):
                first[i] = 0.9 * first[i] + 0.1 * g
                second[i] = 0.999 * second[i] + 0.001 * g * g
                layers[i] = layers[i] - rate * (first[i] / (1 - 0.9**step)) / (np.sqrt(second[i] / (1 - 0.999**step)) + 1e-8)
    return layers


def _temperature(logits: np.ndarray, y: np.ndarray) -> float:
    """The divisor of the logits with the least log loss on rows that were not trained on."""
    grid = np.geomspace(0.25, 8, 61)
    return float(min(grid, key=lambda t: np.mean(np.logaddexp(0, logits / t) - y * logits / t)))


def held_out(column: str = "doc_id") -> Column:
    """Whether crc32 of the id as text is divisible by five."""
    return F.coalesce(F.crc32(F.col(column).cast("string").cast("binary")) % FOLDS == 0, F.lit(False))


def _features(model_vectors: np.ndarray):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codes, shapes = _Codes(), _index_vectors(SHAPES, 2)
        for part, texts in _slices(batches):
            x = _pool(texts, model_vectors, shapes, codes)
            yield pa.RecordBatch.from_arrays(
                [part.column("doc_id").cast(pa.int64()), pa.array([row.tobytes() for row in x], pa.binary())], names=["doc_id", "x"]
            )

    return run


def fit(docs: DataFrame, labels: DataFrame, train_rows: int = TRAIN_ROWS) -> Model:
    """Word vectors of ``docs`` and a network for ``labels`` (doc_id, quality), learnt outside the held-out fold."""
    vectors = word_vectors(docs)
    known = (
        labels.filter(F.col("doc_id").isNotNull() & F.col("quality").isNotNull() & ~held_out())
        .groupBy("doc_id")
        .agg(F.min("quality").cast("int").alias("quality"))
    )
    chosen = known.join(docs.select("doc_id").distinct(), "doc_id", "left_semi").orderBy(F.xxhash64("doc_id"), "doc_id").limit(train_rows)
    targets = {r["doc_id"]: r["quality"] for r in chosen.collect()}  # train_rows at most
    blank = Model(vectors, np.zeros(1), np.ones(1), [], 1.0)
    if len(set(targets.values())) < 2:
        blank.prior = float(np.mean(list(targets.values()))) if targets else 0.5
        return blank
    ids = docs.sparkSession.createDataFrame([(k,) for k in targets], "doc_id long")
    texts = docs.select("doc_id", "text").join(F.broadcast(ids), "doc_id", "left_semi")  # 8 bytes for each of train_rows ids
    seen = texts.mapInArrow(_features(vectors), "doc_id long, x binary")
    # of a repeated id one text is learnt
    rows = sorted(seen.groupBy("doc_id").agg(F.min("x").alias("x")).collect(), key=lambda r: (zlib.crc32(str(r["doc_id"]).encode()), r["doc_id"]))
    x = np.array([np.frombuffer(r["x"], np.float32) for r in rows], np.float64)
    y = np.array([targets[r["doc_id"]] for r in rows], np.float64)
    mean, spread = x.mean(0), x.std(0) + 1e-6
    aside = np.arange(len(rows)) % 5 == 4
    if len(set(y[~aside])) < 2 or not aside.any():
        aside[:] = False
    layers = _train(((x - mean) / spread)[~aside], y[~aside])
    model = Model(vectors, mean, spread, layers, 1.0)
    if aside.any():
        model.temperature = _temperature(model.logits(x[aside]), y[aside])
    return model


def score(docs: DataFrame, model: Model, threshold: float = THRESHOLD) -> DataFrame:
    """doc_id, held_out, score, predicted: one row for each row of ``docs``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codes, shapes = _Codes(), _index_vectors(SHAPES, 2)
        for part, texts in _slices(batches):
            values = model.scores(_pool(texts, model.vectors, shapes, codes))
            yield pa.RecordBatch.from_arrays([part.column("doc_id").cast(pa.int64()), pa.array(values, pa.float64())], names=["doc_id", "score"])

    scored = docs.select("doc_id", "text").mapInArrow(run, "doc_id long, score double")
    return scored.select("doc_id", held_out().alias("held_out"), "score", (F.col("score") >= threshold).cast("int").alias("predicted"))


def accepted(docs: DataFrame, model: Model, threshold: float = THRESHOLD) -> DataFrame:
    """The rows of ``docs`` whose text scores ``threshold`` or more, with all their columns."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codes, shapes = _Codes(), _index_vectors(SHAPES, 2)
        for part, texts in _slices(batches):
            yield part.filter(pa.array(model.scores(_pool(texts, model.vectors, shapes, codes)) >= threshold))

    return docs.mapInArrow(run, docs.schema)
