"""Secret scan with one deterministic automaton for all rules.

The regexes of the rules become automata over bytes, which subset construction merges into one; states that no text can
tell apart are then merged. The result is a transition array: for every state its successor by byte, and a mask of the
rules that match up to here. Scanning follows one array entry per byte, for all rules at once. Per rule, matches
are leftmost, as long as possible, and don't overlap; where a match starts is found by running the reversed rule back
from its first accepting byte.

Documents are scanned where they lie: no shuffle, no state beyond a slice of texts. NULL texts count as empty, rows are
reported one by one, also repeated ones, and extra columns don't matter.
"""

from __future__ import annotations

import operator
from collections.abc import Iterator
from dataclasses import dataclass
from itertools import accumulate
from re import IGNORECASE, _constants, _parser  # the standard library's own parse trees

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strata.llm.common import batches_of, utf8

SLICE_BYTES = 1 << 20
#: Between texts; occurs in no UTF-8 text and in no rule.
BREAK = 0xFF


@dataclass(frozen=True)
class Rule:
    """``least``: at so many bytes at least the match must be accepted, else it is consumed but not reported."""

    kind: str
    pattern: str
    least: int
    ignore_case: bool = False


BASE = [
    Rule("assign", r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", 6, True),
    Rule("access", r"AKIA[A-Z0-9]+", 16),
    Rule("hex", r"[0-9a-f]+", 24),
]
MORE = [
    Rule("jwt", r"eyJ[A-Za-z0-9_-]+\.eyJ[A-Za-z0-9_-]+\.[A-Za-z0-9_-]+", 16),
    Rule("github", r"gh[pousr]_[A-Za-z0-9]+", 30),
    Rule("pem", r"-----BEGIN [A-Z ]*PRIVATE KEY-----", 1),
]
RULES = [*BASE, *MORE]


class _Nfa:
    """Thompson's automaton of one rule; state 0 is the start."""

    def __init__(self, rule: Rule):
        self.empty: list[list[int]] = []
        self.edges: list[list[tuple[frozenset[int], int]]] = []
        self.start = self._state()
        flags = IGNORECASE if rule.ignore_case else 0
        self.accept = self._sequence(_parser.parse(rule.pattern), self.start, bool(flags))

    def _state(self) -> int:
        self.empty.append([])
        self.edges.append([])
        return len(self.empty) - 1

    def _bytes(self, codes: set[int], at: int, fold: bool) -> int:
        if fold:
            codes = codes | {ord(chr(c).swapcase()) for c in codes if chr(c).isalpha()}
        if not codes or max(codes) > 127:
            raise ValueError("rules are made of ASCII characters")
        to = self._state()
        self.edges[at].append((frozenset(codes), to))
        return to

    def _sequence(self, items, at: int, fold: bool) -> int:
        for op, value in items:
            at = self._item(op, value, at, fold)
        return at

    def _item(self, op, value, at: int, fold: bool) -> int:
        if op is _constants.LITERAL:
            return self._bytes({value}, at, fold)
        if op is _constants.IN:
            codes: set[int] = set()
            for kind, v in value:
                if kind is _constants.LITERAL:
                    codes.add(v)
                elif kind is _constants.RANGE:
                    codes.update(range(v[0], v[1] + 1))
                else:
                    raise ValueError(f"not for this scanner: {kind}")
            # letters of the rule may come in either case, but classes of a rule say what they mean
            return self._bytes(codes, at, False)
        if op is _constants.SUBPATTERN:
            return self._sequence(value[3], at, fold)
        if op is _constants.BRANCH:
            to = self._state()
            for branch in value[1]:
                self.empty[self._sequence(branch, at, fold)].append(to)
            return to
        if op is _constants.MAX_REPEAT:
            low, high, body = value
            for _ in range(low):
                at = self._sequence(body, at, fold)
            if high is _constants.MAXREPEAT:
                loop = self._state()
                self.empty[at].append(loop)
                self.empty[self._sequence(body, loop, fold)].append(loop)
                return loop
            to = self._state()
            self.empty[at].append(to)
            for _ in range(high - low):
                at = self._sequence(body, at, fold)
                self.empty[at].append(to)
            return to
        raise ValueError(f"not for this scanner: {op}")

    def close(self, states) -> frozenset[int]:
        seen, todo = set(states), list(states)
        while todo:
            for to in self.empty[todo.pop()]:
                if to not in seen:
                    seen.add(to)
                    todo.append(to)
        return frozenset(seen)

    def step(self, states, byte: int) -> frozenset[int]:
        return self.close([to for s in states for codes, to in self.edges[s] if byte in codes])

    def reversed(self) -> _Nfa:
        other = object.__new__(_Nfa)
        other.empty, other.edges = [[] for _ in self.empty], [[] for _ in self.edges]
        for s, targets in enumerate(self.empty):
            for to in targets:
                other.empty[to].append(s)
        for s, edges in enumerate(self.edges):
            for codes, to in edges:
                other.edges[to].append((codes, s))
        other.start, other.accept = self.accept, self.start
        return other


#: The attempts of a rule that are under way, each a set of states, the one that started first at the front.
Attempts = tuple[frozenset[int], ...]


def _search(nfa: _Nfa, now: Attempts, byte: int) -> Attempts:
    """Attempts after one more byte. A match keeps out all later attempts until it ends."""
    matched = bool(now) and nfa.accept in now[0]
    after, seen = [], set()
    for states in now:
        new = nfa.step(states, byte) - seen
        seen |= new
        if new:
            after.append(new)
    if matched and after and nfa.accept not in after[0]:
        raise ValueError("a match must stay one until it ends")
    if matched and after:
        return (after[0],)
    if not any(nfa.accept in states for states in after):
        fresh = nfa.step(nfa.close([nfa.start]), byte) - seen
        if fresh:
            after.append(fresh)
    if any(nfa.accept in states for states in after[1:]):
        raise ValueError("a later attempt may not match before an earlier one ends")
    return tuple(after[:1]) if after and nfa.accept in after[0] else tuple(after)


@dataclass
class Automaton:
    rules: list[Rule]
    transitions: np.ndarray  # state, byte -> state
    masks: np.ndarray  # state -> bits of the rules that match
    back: list[tuple[np.ndarray, np.ndarray]]  # of each reversed rule: transitions (0: none), accepting


def _classes(nfas: list[_Nfa]) -> list[list[int]]:
    """Bytes that no rule tells apart."""
    sets = sorted({tuple(sorted(codes)) for n in nfas for edges in n.edges for codes, _ in edges})
    by: dict[tuple[bool, ...], list[int]] = {}
    members = [set(s) for s in sets]
    for byte in range(256):
        by.setdefault(tuple(byte in s for s in members), []).append(byte)
    return list(by.values())


def _subsets(start, step, classes: list[list[int]]) -> tuple[list, np.ndarray]:
    """All states reachable from ``start`` and their transitions by byte."""
    number, states, rows = {start: 0}, [start], []
    for state in states:  # grows meanwhile
        row = np.zeros(256, np.int32)
        for members in classes:
            to = step(state, members[0])
            if to not in number:
                number[to] = len(states)
                states.append(to)
            row[members] = number[to]
        rows.append(row)
    return states, np.array(rows)


def _minimal(transitions: np.ndarray, outputs: np.ndarray, columns: list[int]) -> tuple[np.ndarray, np.ndarray]:
    """Merges states of equal output and equivalent successors; state 0 stays 0."""
    part = np.unique(outputs, return_inverse=True)[1].ravel()
    while True:
        keys = np.column_stack([part, part[transitions[:, columns]]])
        _, first, new = np.unique(keys, axis=0, return_index=True, return_inverse=True)
        new = new.ravel()
        if len(first) == part.max() + 1:
            break
        part = new
    order = np.argsort(first)  # by first member, so that the start comes first
    rank = np.empty_like(order)
    rank[order] = np.arange(len(order))
    return rank[new][transitions[first[order]]], outputs[first[order]]


def compile_rules(rules: list[Rule]) -> Automaton:
    """One minimal automaton for all rules (eight at most)."""
    if len(rules) > 8:
        raise ValueError("a mask has room for eight rules")
    nfas = [_Nfa(rule) for rule in rules]
    classes = _classes(nfas)
    steps: dict = {}

    def search(i: int, now: Attempts, byte: int) -> Attempts:
        key = (i, now, byte)
        if key not in steps:
            steps[key] = _search(nfas[i], now, byte)
        return steps[key]

    states, transitions = _subsets(
        tuple(() for _ in rules), lambda state, byte: tuple(search(i, now, byte) for i, now in enumerate(state)), classes
    )
    masks = np.array(
        [sum(1 << i for i, now in enumerate(state) if now and nfas[i].accept in now[0]) for state in states], np.int64
    )
    transitions, masks = _minimal(transitions, masks, [c[0] for c in classes])
    back = []
    for nfa in nfas:
        other = nfa.reversed()
        sets, table = _subsets(other.close([other.start]), other.step, _classes([other]))
        back.append((table, np.array([(other.accept in s) + 2 * (not s) for s in sets])))
    return Automaton(rules, transitions, masks, back)


class Scanner:
    """The automaton as nested lists, which is what plain iteration follows fastest."""

    def __init__(self, automaton: Automaton):
        self.rules, self.back = automaton.rules, automaton.back
        self.states: list[list] = [[] for _ in automaton.masks]
        for state, row, mask in zip(self.states, automaton.transitions, automaton.masks, strict=True):
            state.extend(self.states[to] for to in row)
            state.append(int(mask))

    def scan(self, data: bytes) -> list[tuple[int, int, int]]:
        """(start, rule, end) of all matches, in byte offsets."""
        visited = accumulate(data, operator.getitem, initial=self.states[0])
        masks = np.frombuffer(bytes(map(operator.itemgetter(256), visited)), np.uint8)
        found = []
        for i, rule in enumerate(self.rules):
            bits = np.zeros(len(masks) + 1, np.int8)
            bits[:-1] = (masks >> i) & 1
            turns = np.flatnonzero(np.diff(bits))  # a match is on after turn + 1 bytes, and off again
            ons, offs = turns[::2] + 1, turns[1::2]
            ended = 0
            long = offs - ons + 1 >= rule.least
            for first, end in zip(ons[long].tolist(), offs[long].tolist(), strict=True):
                found.append((self._start(i, data, first, ended), i, end))
                ended = end
        return sorted(found)

    def _start(self, i: int, data: bytes, first: int, bound: int) -> int:
        table, accepting = self.back[i]
        state, at, start = 0, first, first
        while at > bound:
            at -= 1
            state = table[state, data[at]]
            if accepting[state] == 2:
                break
            if accepting[state]:
                start = at
        return start


def find_secrets(docs: DataFrame, rules: list[Rule] | None = None) -> DataFrame:
    """doc_id and ``found``: the secrets of each text as array of (kind, start, end), by start, kind as listed, end.
    Offsets are code points, ends exclusive."""
    automaton = compile_rules(rules or RULES)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scanner = Scanner(automaton)
        kinds = [rule.kind for rule in automaton.rules]
        for batch in batches:
            for start, end in batches_of(batch, "text", SLICE_BYTES):
                part = batch.slice(start, end - start)
                texts = part.column("text").to_pylist()
                data = bytes([BREAK]).join(texts)
                starts = np.cumsum([0] + [len(t) + 1 for t in texts])
                rows: list[list[dict]] = [[] for _ in texts]
                for low, rule, high in scanner.scan(data):
                    k = int(np.searchsorted(starts, low, side="right")) - 1
                    text, base = texts[k], int(starts[k])
                    at = len(text[: low - base].decode())
                    rows[k].append({"kind": kinds[rule], "start": at, "end": at + len(data[low:high].decode())})
                kind = pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64())])
                yield pa.RecordBatch.from_arrays(
                    [part.column("doc_id").cast(pa.int64()), pa.array(rows, pa.list_(kind))], names=["doc_id", "found"]
                )

    return docs.select("doc_id", utf8().alias("text")).mapInArrow(run, "doc_id long, found array<struct<kind:string,start:long,end:long>>")


def secret_counts(docs: DataFrame) -> DataFrame:
    """doc_id, n_assign, n_access, n_hex, base_sha256 (over the base spans) and spans (all), spans as kind:start:end."""
    base = [rule.kind for rule in BASE]

    def joined(found):
        return F.array_join(F.transform(found, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")

    def count(kind: str):
        return F.size(F.filter("found", lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")

    return find_secrets(docs).select(
        "doc_id",
        *[count(kind) for kind in base],
        F.sha2(joined(F.filter("found", lambda s: s["kind"].isin(base))), 256).alias("base_sha256"),
        joined(F.col("found")).alias("spans"),
    )
