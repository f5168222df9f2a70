"""Ranked lexical search by the Best Position Algorithm.

1. One pass over the documents counts the terms of the queries in each text and writes a row per document: its length, and
   the query terms it holds with their counts. Sums over these rows give the corpus statistics.
2. A second pass over these rows, far narrower than the texts, takes them block by block. Within a block each term has an
   impact list: its documents by falling impact. For an item the lists of its terms are read in parallel from the top. A
   document that comes up is looked up in all lists of the item (direct access), which gives its score and marks its
   position in each list as seen.
3. The best position of a list is the last one up to which all positions are seen. No unseen document can score more than
   the sum of the impacts at the best positions, a tighter bound than the last positions read. A search ends when that sum
   is strictly below the item's kth score so far, so documents that tie with the kth are all met.
4. A task carries the k best of each item from block to block, so later blocks start with a high kth score. The k best of
   all tasks, at most k rows an item and task, meet in a window.

A block is bounded by rows and by postings, whatever term a third of all documents share. Queries are sent to all tasks in
groups of bounded size.
"""

from __future__ import annotations

import heapq
import math
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from strata.llm.common import batches_of, stash, utf8

TOP = 10
#: Bytes of query terms that are sent to all tasks at once; more items are searched group by group.
QUERY_BYTES = 16 << 20
#: Rows and postings of a block.
BLOCK_ROWS, BLOCK_POSTINGS = 8192, 2_000_000
#: Positions read from each list in the first round; rounds double.
FIRST_READ = 16
SLICE_BYTES = 1 << 20

#: Digits, ASCII letters (lower-cased) and all bytes of longer characters make terms, other bytes part them.
_FOLDED = bytes(b if b >= 128 or chr(b).isalnum() else 32 for b in range(256)).lower()


def term_counts(text: bytes) -> Counter:
    """How often each term occurs in a UTF-8 text. Long texts are counted piece by piece."""
    counts: Counter = Counter()
    folded, start = text.translate(_FOLDED), 0
    while start < len(folded):
        end = start + SLICE_BYTES
        if end < len(folded):
            cut = folded.find(b" ", end)
            end = cut if cut >= 0 else len(folded)
        counts.update(folded[start:end].split())
        start = end
    return counts


def _item_terms(items: DataFrame, id_column: str) -> DataFrame:
    """(item, term), once each."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for item, text in zip(batch.column("item"), batch.column("text").to_pylist(), strict=True):
                found = list(term_counts(text))
                yield pa.RecordBatch.from_arrays([pa.array([item.as_py()] * len(found), pa.int64()), pa.array(found, pa.binary())], names=["item", "term"])

    texts = items.select(F.col(f"`{id_column}`").cast("long").alias("item"), utf8().alias("text"))
    return texts.mapInArrow(run, "item long, term binary").distinct()


def _postings(docs: DataFrame, vocabulary: dict[bytes, int]) -> DataFrame:
    """doc_id, n (terms with repeats), ids and tfs: the terms of the vocabulary that a text holds, and their counts."""
    sent = docs.sparkSession.sparkContext.broadcast(vocabulary)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = sent.value
        for batch in batches:
            for start, end in batches_of(batch, "text", SLICE_BYTES):
                part = batch.slice(start, end - start)
                lengths, ends, ids, tfs = [], [0], [], []
                for text in part.column("text").to_pylist():
                    counts = term_counts(text)
                    lengths.append(counts.total())
                    held = [(known[t], n) for t, n in counts.items() if t in known]
                    ids += [i for i, _ in held]
                    tfs += [n for _, n in held]
                    ends.append(len(ids))
                offsets = pa.array(ends, pa.int32())
                yield pa.RecordBatch.from_arrays(
                    [
                        part.column("doc_id").cast(pa.int64()),
                        pa.array(lengths, pa.int64()),
                        pa.ListArray.from_arrays(offsets, pa.array(ids, pa.int32())),
                        pa.ListArray.from_arrays(offsets, pa.array(tfs, pa.int64())),
                    ],
                    names=["doc_id", "n", "ids", "tfs"],
                )

    return docs.select("doc_id", utf8().alias("text")).mapInArrow(run, "doc_id long, n long, ids array<int>, tfs array<long>")


class Block:
    """Impact lists over the documents 0..size-1, from postings (document, term, impact above 0)."""

    def __init__(self, size: int, docs: np.ndarray, terms: np.ndarray, impacts: np.ndarray):
        by_term = np.lexsort((docs, terms))
        self.size, self.keys = size, terms[by_term].astype(np.int64) * size + docs[by_term]
        self.impact_of_key = impacts[by_term]
        ranked = np.lexsort((docs, -impacts, terms))  # each list in falling impact
        self.docs, self.impacts = docs[ranked], impacts[ranked]
        self.terms, self.starts, self.counts = np.unique(terms[ranked], return_index=True, return_counts=True)
        # of each key, its place among all lists
        place = np.empty(len(docs), np.int64)
        place[ranked] = np.arange(len(docs))
        self.place_of_key = place[by_term]

    def search(self, terms: np.ndarray, top: list[tuple], names: list, k: int, first_read: int = FIRST_READ) -> tuple[list[tuple], int]:
        """The k best of ``top`` and the block's documents: (-score, whether the id is missing, id), least first. ``names`` has
        the ids. Also returns how many documents were scored."""
        lists = np.searchsorted(self.terms, terms)
        lists = lists[(lists < len(self.terms)) & (self.terms[np.minimum(lists, len(self.terms) - 1)] == terms)]
        if not len(lists):
            return top, 0
        starts, counts = self.starts[lists], self.counts[lists]
        base = np.concatenate([[0], np.cumsum(counts + 1)])  # a position that is never seen ends each list
        seen, best = np.zeros(base[-1], bool), np.zeros(len(lists), np.int64)
        shift = base[:-1] - starts
        met, depth, step, scored = np.zeros(self.size, bool), 0, first_read, 0
        least = max(1, -top[k - 1][0]) if len(top) >= k else 1
        row_keys = self.terms[lists].astype(np.int64)[:, None] * self.size
        while True:
            read = np.minimum(counts, depth + step) - np.minimum(counts, depth)  # sorted access
            at = np.repeat(starts + depth - np.concatenate([[0], np.cumsum(read)[:-1]]), read) + np.arange(read.sum())
            fresh = np.unique(self.docs[at])
            fresh = fresh[~met[fresh]]
            if len(fresh):
                met[fresh], scored = True, scored + len(fresh)
                keys = row_keys + fresh  # direct access: each fresh document in each list
                slots = np.minimum(np.searchsorted(self.keys, keys.ravel()), len(self.keys) - 1).reshape(keys.shape)
                hit = self.keys[slots] == keys
                scores = np.where(hit, self.impact_of_key[slots], 0).sum(axis=0)
                seen[(self.place_of_key[slots] + shift[:, None])[hit]] = True
                good = np.flatnonzero(scores >= least)
                if len(good):
                    found = [(-s, names[d] is None, names[d] or 0) for s, d in zip(scores[good].tolist(), fresh[good].tolist(), strict=True)]
                    top = heapq.nsmallest(k, top + found)
                    least = max(1, -top[k - 1][0]) if len(top) >= k else 1
                for i, (a, n) in enumerate(zip(base.tolist(), counts.tolist(), strict=False)):
                    best[i] += int(np.argmin(seen[a + best[i] : a + n + 1]))
            # what an unseen document can score at most: its places lie behind the best positions, or it is not in the list
            bound = int(np.where(best < counts, self.impacts[starts + np.maximum(best, 1) - 1], 0).sum())
            if bound < least:
                return top, scored
            depth, step = depth + step, step * 2


def _blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Slices within the bounds of a block; a document of more postings is a block of its own."""
    for batch in batches:
        ends = batch.column("ids").offsets.to_numpy()[1:] - batch.column("ids").offsets[0].as_py()
        start = 0
        while start < batch.num_rows:
            before = ends[start - 1] if start else 0
            end = max(start + 1, min(start + BLOCK_ROWS, int(np.searchsorted(ends, before + BLOCK_POSTINGS, "right"))))
            yield batch.slice(start, end - start)
            start = end


def weight(n_docs: int, df: int) -> int:
    return math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df + 1)))


def _tops(postings: DataFrame, items: list[tuple], weights: np.ndarray, n_docs: int, n_terms: int, k: int) -> DataFrame:
    """(item, doc_id, score): the k best of each item and task. ``items`` has (item, term numbers)."""
    sent = postings.sparkSession.sparkContext.broadcast((items, weights))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        items, weights = sent.value
        tops: list[list[tuple]] = [[] for _ in items]
        for batch in _blocks(batches):
            ids, tfs = batch.column("ids").flatten().to_numpy().astype(np.int64), batch.column("tfs").flatten().to_numpy()
            docs = np.repeat(np.arange(batch.num_rows), np.diff(batch.column("ids").offsets.to_numpy()))
            m = 100 - 90 + (90 * batch.column("n").to_numpy() * n_docs) // max(1, n_terms)
            impacts = weights[ids] * ((1_000_000_000 * tfs) // (1000 * tfs + 8 * m[docs]))
            some = impacts > 0
            block, names = Block(batch.num_rows, docs[some], ids[some], impacts[some]), batch.column("doc_id").to_pylist()
            if len(block.terms):
                for i, (_, terms) in enumerate(items):
                    tops[i], _ = block.search(terms, tops[i], names, k)
        rows = [(item, None if missing else doc, -s) for (item, _), top in zip(items, tops, strict=True) for s, missing, doc in top]
        yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in (zip(*rows, strict=True) if rows else ([], [], []))], names=["item", "doc_id", "score"])

    return postings.select("doc_id", "n", "ids", "tfs").mapInArrow(run, "item long, doc_id long, score long")


def search(docs: DataFrame, items: DataFrame, id_column: str = "item_id", k: int = TOP, query_bytes: int = QUERY_BYTES) -> DataFrame:
    """item, rank (from 1), doc_id and score of the ``k`` best documents of each item; ties by rising doc_id, then NULL.

    The item column keeps the name ``id_column``. Items of one id are one item with the terms of all their rows, those
    without an id too. Each row of ``docs`` is a document, repeated ids and texts as well; NULL and empty texts hold no
    term. An item without a hit has no row; empty tables give none. Columns beside ids and text aren't read.
    """
    spark = docs.sparkSession
    wanted = stash(_item_terms(items, id_column), "items")
    total = wanted.agg(F.sum(F.length("term") + 16)).first()[0] or 0
    groups, found = math.ceil(total / query_bytes), None
    for group in range(groups):
        rows = wanted.filter(F.pmod(F.xxhash64("item"), F.lit(groups)) == group).collect()  # query_bytes or so
        if not rows:
            continue
        vocabulary = {term: i for i, term in enumerate(sorted({bytes(r["term"]) for r in rows}))}
        terms: dict = {}
        for r in rows:
            terms.setdefault(r["item"], []).append(vocabulary[bytes(r["term"])])
        postings = stash(_postings(docs, vocabulary), "postings")
        n_docs, n_terms = postings.agg(F.count_if(F.col("n") > 0), F.coalesce(F.sum("n"), F.lit(0))).first()
        weights = np.zeros(len(vocabulary), np.int64)  # of terms that no document holds, never asked for
        for term, df in postings.select(F.explode("ids").alias("term")).groupBy("term").count().collect():  # the vocabulary at most
            weights[term] = weight(n_docs, df)
        listed = [(item, np.array(sorted(numbers), np.int64)) for item, numbers in terms.items()]
        tops = stash(_tops(postings, listed, weights, n_docs, n_terms, k), "tops")
        found = tops if found is None else found.union(tops)
    if found is None:
        found = spark.createDataFrame([], "item long, doc_id long, score long")
    order = Window.partitionBy("item").orderBy(F.col("score").desc(), F.col("doc_id").asc_nulls_last())
    ranked = found.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)
    return ranked.select(F.col("item").alias(id_column), "rank", "doc_id", "score")


_TERMS = r"regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')"

SQL = f"""
WITH texts AS (SELECT row_number() OVER () AS line, doc_id, {_TERMS} AS terms FROM documents),
wanted AS (SELECT DISTINCT item_id, unnest({_TERMS}) AS term FROM benchmark),
sizes AS (SELECT count(*) FILTER (len(terms) > 0) AS n_docs, sum(len(terms))::BIGINT AS n_terms FROM texts),
held AS (
    SELECT line, doc_id, n, term, count(*) AS tf
    FROM (SELECT line, doc_id, len(terms) AS n, unnest(terms) AS term FROM texts)
    WHERE term IN (SELECT term FROM wanted) GROUP BY ALL
),
weights AS (
    SELECT term, floor(1000 * ln((2 * n_docs + 2)::DOUBLE / (2 * count(*) + 1)::DOUBLE))::BIGINT AS w
    FROM held, sizes GROUP BY term, n_docs
),
scores AS (
    SELECT item_id, line, doc_id,
        sum(w * ((1000000000 * tf) // (1000 * tf + 8 * (100 - 90 + (90 * n * n_docs) // n_terms))))::BIGINT AS score
    FROM wanted JOIN weights USING (term) JOIN held USING (term), sizes GROUP BY ALL
)
SELECT item_id, rank::INTEGER AS rank, doc_id, score
FROM (SELECT *, row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id NULLS LAST) AS rank FROM scores WHERE score > 0)
WHERE rank <= {TOP}
"""
