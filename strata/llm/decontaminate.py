"""Benchmark decontamination by canonical templates.

1. Words become template tokens: numbers, units and names (capitalised words, neighbouring ones together unless a sentence
   or colon ends between them) are replaced by typed placeholders, all else is lower-cased; punctuation around words is dropped. What a placeholder stands for is
   kept as its slot. As letter case may have been changed, a second form of each text takes names as plain words.
2. Windows of ``WORDS`` template tokens, hashed, of documents and benchmark items are joined. Windows of fewer than
   ``LITERALS`` literal tokens say nothing and are left out on both sides.
3. Matches of a document and an item in the same form, in the order of both and at offsets that move by ``SHIFT`` tokens at most
   from one run of matches to the next, belong together. They are a leak if their windows hold at least ``COVERAGE`` of the tokens
   that the item's windows hold, and the slots are consistent: each slot value of the item always stands where one and
   the same value of the document does, and the other way round. So a question with other numbers or names is found, while
   a text that only happens to have the same form is not. A name at either end of an item is not asked for this: in a
   document it may go on in the words around the item.

The benchmark is a query set. Up to ``SENT_WINDOWS`` window hashes of it (8 bytes each) go to all tasks and only matching
windows of the documents leave them; a larger benchmark is joined by a shuffle with all windows. Either way gives the same.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strata.llm.common import batches_of, parts_for, stash

WORDS = 5
LITERALS = 2
COVERAGE = 0.8
#: Tokens that may be put in or left out between two runs of matches.
SHIFT = 5
SENT_WINDOWS = 2_000_000
SLICE_BYTES = 1 << 20
MEMO_WORDS = 300_000

#: Units that become a placeholder.
UNITS = frozenset(
    "mm cm m km in ft yd mi mg g kg t lb lbs oz ml cl l gal s sec min h hr hrs ms hz khz mhz ghz w kw mw v a j kj cal kcal pa kpa "
    "usd eur gbp jpy dollar dollars cent cents euro euros pound pounds meter meters metre metres kilometer kilometers mile miles "
    "gram grams kilogram kilograms liter liters litre litres second seconds minute minutes hour hours day days week weeks month months "
    "year years percent degree degrees".split()
)
_LITERAL, _NUMBER, _UNIT, _NAME = range(4)
_EDGE = "\"'`.,;:!?()[]{}<>#*&|~^_=+/\\-…“”„‘’«»¿¡"
#: Punctuation that ends a name, unless the word is an initial or a title.
_ENDS = frozenset(".:;!?…")
_TITLES = frozenset("mr mrs ms dr prof st jr sr".split())
_NUMERAL = re.compile(r"([$€£]?)([+-]?[0-9][0-9.,:/]*)([A-Za-z%$€£]*)")


class _Tokens(dict):
    """Word to number of its first token; tokens by number have kind, hash as plain word, slot hash, a follower or -1, and whether a name ends there."""

    def __init__(self):
        self.reset()

    def reset(self) -> None:
        self.clear()
        self.fresh: list[list[int]] = []
        self.kind, self.next = np.zeros(0, np.int8), np.zeros(0, np.int64)
        self.hash, self.slot = np.zeros(0, np.uint64), np.zeros(0, np.uint64)
        self.end = np.zeros(0, np.bool_)

    def settle(self) -> None:
        """Put the tokens met since the last call behind the others."""
        if self.fresh:
            columns = zip(("kind", "hash", "slot", "next", "end"), zip(*self.fresh, strict=True), strict=True)
            for name, values in columns:
                known = getattr(self, name)
                setattr(self, name, np.concatenate([known, np.array(values, known.dtype)]))
            self.fresh = []

    def _token(self, kind: int, text: str) -> int:
        slot = 0 if kind == _LITERAL else xxhash.xxh64_intdigest(text.encode(), 2) | 1
        self.fresh.append([kind, xxhash.xxh64_intdigest(text.encode(), 1), slot, -1, False])
        return len(self.kind) + len(self.fresh) - 1

    def __missing__(self, word: str) -> int:
        core = word.strip(_EDGE)
        numeral = _NUMERAL.fullmatch(core.rstrip("%$€£")) if core[:1] in "$€£+-0123456789" and core else None
        low = core.lower()
        if numeral and (not numeral[3] or numeral[3].lower() in UNITS):
            code = self._token(_NUMBER, numeral[2].rstrip(".,:/"))
            unit = numeral[1] or numeral[3].lower() or core[len(core.rstrip("%$€£")) :]
            if unit:
                self.fresh[-1][3] = code + 1
                self._token(_UNIT, unit)
        elif low in UNITS:
            code = self._token(_UNIT, low)
        elif core[:1].isupper() and (len(core) == 1 or core[1:].islower()):
            code = self._token(_NAME, low)
            tail = word[len(word.rstrip(_EDGE)) :]
            self.fresh[-1][4] = not _ENDS.isdisjoint(tail) and not (tail == "." and (len(core) == 1 or low in _TITLES))
        elif core:
            code = self._token(_LITERAL, low)
        else:
            code = -1 if _ENDS.isdisjoint(word) else -2  # punctuation alone is no token
        self[word] = code
        return code


def _tokenise(texts: list[str], tokens: _Tokens) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Row number and number of all tokens of the texts, and whether a name ends there."""
    if len(tokens) > MEMO_WORDS:
        tokens.reset()
    split = [text.split() for text in texts]
    rows = np.repeat(np.arange(len(split)), [len(words) for words in split])
    codes = np.fromiter((c for words in split for c in map(tokens.__getitem__, words)), np.int64, len(rows))
    tokens.settle()
    kept = np.flatnonzero(codes >= 0)
    before = np.searchsorted(kept, np.flatnonzero(codes == -2)) - 1  # the token that punctuation alone follows
    rows, codes = rows[kept], codes[kept]
    ends = tokens.end[codes]
    ends[before[before >= 0]] = True
    follower = tokens.next
    if len(codes) and (follower[codes] >= 0).any():
        twice = 1 + (follower[codes] >= 0)
        last = np.cumsum(twice) - 1
        rows, wide, ends = np.repeat(rows, twice), np.repeat(codes, twice), np.repeat(ends, twice)
        wide[last] = np.where(twice == 2, follower[codes], codes)
        codes = wide
    return rows, codes, ends


def _template(rows: np.ndarray, codes: np.ndarray, ends: np.ndarray, tokens: _Tokens, names: bool) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Row number, template hash, slot hash and kind of all tokens, with placeholders for names or without."""
    if not len(codes):
        return rows, np.zeros(0, np.uint64), np.zeros(0, np.uint64), np.zeros(0, np.int8)
    kinds, slots = tokens.kind[codes], tokens.slot[codes]
    if not names:
        kinds[kinds == _NAME] = _LITERAL
    hashes = np.where(kinds == _LITERAL, tokens.hash[codes], kinds.astype(np.uint64))
    # neighbouring names are one name
    inner = (kinds[1:] == _NAME) & (kinds[:-1] == _NAME) & (rows[1:] == rows[:-1]) & ~ends[:-1]
    firsts = np.flatnonzero(np.concatenate([[True], ~inner]))
    return rows[firsts], hashes[firsts], np.add.reduceat(slots, firsts), kinds[firsts]


def _windows(rows: np.ndarray, codes: np.ndarray, ends: np.ndarray, tokens: _Tokens, names: bool, items: bool) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Row number, position in the row, hash and slots (0 for literals) of all windows that say something.

    Of ``items`` the names at either end have no slot."""
    rows, hashes, slots, kinds = _template(rows, codes, ends, tokens, names)
    n = len(rows) - WORDS + 1
    if n <= 0:
        return np.zeros(0, int), np.zeros(0, int), np.zeros(0, np.int64), np.zeros((0, WORDS), np.int64)
    first = np.searchsorted(rows, rows, side="left")
    total, literals = np.full(n, names, np.uint64), np.zeros(n, np.int8)
    for k in range(WORDS):
        total = total * np.uint64(0x9E3779B97F4A7C15) + hashes[k : n + k]
        total ^= total >> np.uint64(29)
        literals += kinds[k : n + k] == _LITERAL
    kept = np.flatnonzero((rows[:n] == rows[WORDS - 1 :]) & (literals >= LITERALS))
    own = np.where(kinds == _LITERAL, np.uint64(0), slots)
    if items:
        border = np.concatenate([[True], rows[1:] != rows[:-1]]) | np.concatenate([rows[1:] != rows[:-1], [True]])
        own[border & (kinds == _NAME)] = 0
    return rows[kept], (np.arange(n) - first[:n])[kept], total[kept].view(np.int64), own.view(np.int64)[kept[:, None] + np.arange(WORDS)]


def windows(df: DataFrame, key: str, only: np.ndarray | None = None, items: bool = False) -> DataFrame:
    """(id, text_hash, form, pos, hash, slots, n_windows) of all texts, in both forms; with ``only`` (sorted hashes) just these."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokens = _Tokens()
        for batch in batches:
            for start, end in batches_of(batch, "text", SLICE_BYTES):
                part = batch.slice(start, end - start)
                texts = [text or "" for text in part.column("text").to_pylist()]
                all_rows, codes, ends = _tokenise(texts, tokens)
                for form in (0, 1):
                    rows, pos, hashes, slots = _windows(all_rows, codes, ends, tokens, form == 1, items)
                    counts = np.bincount(rows, minlength=len(texts))
                    if only is not None:
                        at = np.minimum(np.searchsorted(only, hashes), len(only) - 1)
                        kept = np.flatnonzero(only[at] == hashes) if len(only) else np.zeros(0, int)
                        rows, pos, hashes, slots = rows[kept], pos[kept], hashes[kept], slots[kept]
                    text_hash = np.zeros(len(texts), np.int64)
                    for r in np.unique(rows):
                        text_hash[r] = np.uint64(xxhash.xxh64_intdigest(texts[r].encode(), 0)).view(np.int64)
                    offsets = pa.array(np.arange(len(rows) + 1) * WORDS, pa.int32())
                    columns = [
                        part.column("id").cast(pa.int64()).take(pa.array(rows, pa.int64())),
                        pa.array(text_hash[rows]),
                        pa.array(np.full(len(rows), form, np.int32)),
                        pa.array(pos.astype(np.int32)),
                        pa.array(hashes),
                        pa.ListArray.from_arrays(offsets, pa.array(slots.ravel(), pa.int64())),
                        pa.array(counts[rows].astype(np.int32)),
                    ]
                    yield pa.RecordBatch.from_arrays(columns, names=names)

    names = ["id", "text_hash", "form", "pos", "hash", "slots", "n_windows"]
    schema = "id long, text_hash long, form int, pos int, hash long, slots array<long>, n_windows int"
    return df.select(F.col(key).alias("id"), "text").mapInArrow(run, schema)


def best_match(offsets: list[tuple[int, list[tuple]]], n_tokens: int, coverage: float) -> list[tuple[float, int, bool]]:
    """(coverage, n_slots, reworded) of the consistent matches of a text and an item, in order, that cover enough of it.

    ``offsets`` are the matches (item_pos, item_slots, doc_slots) by offset.
    """
    runs: list[tuple[int, int, int, list[tuple]]] = []  # first token, end, offset, matches
    for at, matches in offsets:
        for match in sorted(matches):
            if runs and runs[-1][2] == at and match[0] <= runs[-1][1]:
                runs[-1][3].append(match)
                runs[-1] = (runs[-1][0], match[0] + WORDS, at, runs[-1][3])
            else:
                runs.append((match[0], match[0] + WORDS, at, [match]))
    runs.sort(key=lambda r: r[:3])
    best, before, by_offset = [], [], {}
    for i, (start, end, at, _) in enumerate(runs):
        score, link = end - start, -1
        for other in range(at - SHIFT, at + SHIFT + 1):
            for j in by_offset.get(other, ()):
                s, e, o, _ = runs[j]
                # in order in the item, and in the document; of what overlaps there, words count once
                if s < start and e < end and s + o < start + at and e + o < end + at:
                    total = best[j] + min(end - start, end - e, end + at - e - o)
                    if total > score:
                        score, link = total, j
        best.append(score)
        before.append(link)
        by_offset.setdefault(at, []).append(i)
    # chains, and what lies at one offset by itself
    chosen = [own for own in by_offset.values()]
    for i in range(len(runs)):
        if best[i] >= coverage * n_tokens:
            chosen.append([])
            while i >= 0:
                chosen[-1].append(i)
                i = before[i]
    found = []
    for own in chosen:
        covered = len({t for i in own for t in range(*runs[i][:2])})
        if covered < coverage * n_tokens:
            continue
        slots = {(a, b) for i in own for _, x, y in runs[i][3] for a, b in zip(x, y, strict=True) if a}
        if len(slots) == len({a for a, _ in slots}) == len({b for _, b in slots}):
            found.append((covered / n_tokens, len(slots), any(a != b for a, b in slots)))
    return found


def leaks(docs: DataFrame, benchmark: DataFrame, coverage: float = COVERAGE) -> DataFrame:
    """doc_id, item_id, coverage, n_slots, reworded: items that a document holds.

    ``reworded`` tells that some slot differs, so the question was asked with other values. NULL texts and texts shorter
    than a window hold nothing, nor are items found without a window that says something. Rows with a NULL id on either side are left out. Rows
    that repeat an id count as one document; each of their texts is judged alone. Extra columns don't matter.
    """
    items = stash(windows(benchmark.filter("item_id is not null and text is not null"), "item_id", items=True).distinct(), "items")
    sent = items.select("hash").distinct()
    only = None
    if sent.count() <= SENT_WINDOWS:
        only = np.sort(np.array([r[0] for r in sent.toLocalIterator()], np.int64))  # at most SENT_WINDOWS numbers
    found = windows(docs.filter("doc_id is not null"), "doc_id", only).selectExpr(
        "id as doc_id", "text_hash as doc_text", "form", "pos as doc_pos", "hash", "slots as doc_slots"
    )
    right = items.selectExpr(
        "id as item_id", "text_hash as item_text", "form", "pos as item_pos", "hash", "slots as item_slots", "n_windows"
    )
    pairs = found.join(right, ["hash", "form"]).withColumn("at", F.col("doc_pos") - F.col("item_pos"))
    group = ["doc_id", "doc_text", "item_id", "item_text", "form"]
    # an item and a document meet once for each offset, which holds each window of the item once at most
    runs = pairs.groupBy(*group, "at").agg(F.collect_set(F.struct("item_pos", "item_slots", "doc_slots")).alias("matches"))
    runs = stash(runs, "matches")
    spread = F.expr(f"explode(sequence(item_pos, item_pos + {WORDS - 1}))")
    held = items.select(F.col("id").alias("item_id"), F.col("text_hash").alias("item_text"), "form", F.col("pos").alias("item_pos"))
    sizes = held.withColumn("token", spread).groupBy("item_id", "item_text", "form").agg(F.countDistinct("token").alias("n_tokens"))
    # only what could cover enough, in whatever order, is put in order
    tokens = runs.select(*group, F.explode("matches.item_pos").alias("item_pos")).distinct().withColumn("token", spread)
    enough = tokens.groupBy(*group).agg(F.countDistinct("token").alias("n")).join(sizes, ["item_id", "item_text", "form"])
    enough = stash(enough.filter(F.col("n") >= coverage * F.col("n_tokens")).select(*group, "n_tokens"), "candidates")
    near = runs.join(enough, group).repartition(parts_for(docs), *group).sortWithinPartitions(*group, "at")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, rows, n_tokens, out = None, [], 0, []
        for batch in batches:  # sorted by group
            columns = [batch.column(c).to_pylist() for c in (*group, "n_tokens", "at", "matches")]
            for *key, n, at, matches in zip(*columns, strict=True):
                if key != now:
                    if rows:
                        out += [(now[0], now[2], *x) for x in best_match(rows, n_tokens, coverage)]
                    now, rows, n_tokens = key, [], n
                rows.append((at, [(m["item_pos"], tuple(m["item_slots"]), tuple(m["doc_slots"])) for m in matches]))
            yield pa.RecordBatch.from_pylist([dict(zip(kind.names, x, strict=True)) for x in out], schema=kind)
            out = []
        if rows:
            out = [(now[0], now[2], *x) for x in best_match(rows, n_tokens, coverage)]
        yield pa.RecordBatch.from_pylist([dict(zip(kind.names, x, strict=True)) for x in out], schema=kind)

    kind = pa.schema([("doc_id", pa.int64()), ("item_id", pa.int64()), ("coverage", pa.float64()), ("n_slots", pa.int64()), ("reworded", pa.bool_())])
    return (
        near.mapInArrow(run, "doc_id long, item_id long, coverage double, n_slots long, reworded boolean")
        .groupBy("doc_id", "item_id")
        .agg(F.max("coverage").alias("coverage"), F.max("n_slots").alias("n_slots"), F.min("reworded").alias("reworded"))
    )
