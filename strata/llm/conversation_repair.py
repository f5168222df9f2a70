"""Repair of a conversation's structure by the cheapest edits.

The roles of a repaired conversation read ``(s?(ua)+)?`` by their initials. Each row is kept, given another role or deleted;
empty rows may be inserted anywhere. A conversation's audit spells the edits by their initials. Of the cheapest audits the
ASCII-least one counts.

The search goes row by row with four states: nothing yet, system last, user last, assistant last. Of each state only the
best prefix is carried, which is enough: prefixes of equal cost that have used the same rows are never prefixes of each
other, as an insertion costs more than nothing.

* A prefix is a node that links to the prefix it extends, so prefixes share their beginnings. A node has binary-lifting
  ancestors (1, 2, 4, ... edits back) and a rolling hash of its whole string.
* A tie is decided at the end of the longest common prefix, found by lifting both nodes as long as their hashes differ. Equal
  hashes are verified edit by edit, and nodes verified once are remembered as equal, so none is compared twice.
* Whatever all states share is settled: it is spelled out and its nodes are dropped. So memory follows the undecided end.

Rows come sorted by conversation and turn and are streamed, twice: first without texts for the audits, then with
them for the repair, each conversation behind its audit. No task holds the texts of a conversation, however long it is.
The audit is one string, so a conversation is one task's work.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from strata.llm.common import parts_for, stash

DELETE, INSERT, REROLE, TRUNCATED = 3, 2, 2, 1
BLANKS = "\x20\x09\x0a\x0b\x0c\x0d"
#: Code points of a text that order rows of one turn and role; beyond them its digest does.
ORDERING = 100
#: Nodes at which what is settled is spelled out.
NODES = 4096
START, SYSTEM, USER, ASSISTANT = range(4)
#: State before and after a row whose role has this initial.
MOVES = {"s": {START: SYSTEM}, "u": {START: USER, SYSTEM: USER, ASSISTANT: USER}, "a": {USER: ASSISTANT}}
_PRIME, _BASE = (1 << 61) - 1, 1_000_003


class Prefixes:
    """Strings as linked nodes; node 0 is the empty string."""

    def __init__(self):
        self.letter, self.depth, self.hash = [""], [0], [1]
        self.ups: list[list[int]] = [[]]
        self.same = [0]  # disjoint sets of nodes verified to be equal

    def add(self, parent: int, letter: str) -> int:
        node, up, at = len(self.letter), [parent], 0
        while at < len(self.ups[up[at]]):
            up.append(self.ups[up[at]][at])
            at += 1
        self.letter.append(letter)
        self.depth.append(self.depth[parent] + 1)
        self.hash.append((self.hash[parent] * _BASE + ord(letter)) % _PRIME)
        self.ups.append(up)
        self.same.append(node)
        return node

    def spell(self, node: int, above: int = 0) -> str:
        """The string of a node behind that of an ancestor."""
        letters = []
        while node != above:
            letters.append(self.letter[node])
            node = self.ups[node][0]
        return "".join(reversed(letters))

    def lift(self, node: int, depth: int) -> int:
        while (by := self.depth[node] - depth) > 0:
            node = self.ups[node][by.bit_length() - 1]
        return node

    def _find(self, node: int) -> int:
        while self.same[node] != node:
            self.same[node] = node = self.same[self.same[node]]
        return node

    def equal(self, a: int, b: int) -> bool:
        """Whether nodes of one depth spell the same; equal hashes are verified."""
        if self.hash[a] != self.hash[b]:
            return False
        passed = []
        while self._find(a) != self._find(b):
            if self.letter[a] != self.letter[b]:
                return False
            passed.append((a, b))
            a, b = self.ups[a][0], self.ups[b][0]
        for a, b in passed:
            self.same[self._find(a)] = self._find(b)
        return True

    def less(self, a: int, b: int) -> bool:
        """Whether the string of ``a`` comes before that of ``b``; a prefix comes first."""
        depth = min(self.depth[a], self.depth[b])
        x, y = self.lift(a, depth), self.lift(b, depth)
        if self.equal(x, y):
            return self.depth[a] < self.depth[b]
        at = len(self.ups[x]) - 1
        while at >= 0:
            if at < len(self.ups[x]) and self.hash[self.ups[x][at]] != self.hash[self.ups[y][at]]:
                x, y = self.ups[x][at], self.ups[y][at]
            at -= 1
        if self.letter[x] != self.letter[y] and self.equal(self.ups[x][0], self.ups[y][0]):
            return self.letter[x] < self.letter[y]
        return self.spell(a) < self.spell(b)  # two strings of one hash

    def common(self, nodes: list[int]) -> int:
        """The deepest node that all descend from."""
        depth = min(self.depth[n] for n in nodes)
        at = {self.lift(n, depth) for n in nodes}
        while len(at) > 1:
            at = {self.ups[n][0] for n in at}
        return at.pop()

    def below(self, above: int, nodes: list[int]) -> tuple[Prefixes, list[int]]:
        """A new set of prefixes that holds what leads from ``above`` to the nodes, and their places in it."""
        fresh, moved = Prefixes(), {above: 0}
        for node in nodes:
            path = []
            while node not in moved:
                path.append(node)
                node = self.ups[node][0]
            for n in reversed(path):
                moved[n] = fresh.add(moved[self.ups[n][0]], self.letter[n])
        return fresh, [moved[n] for n in nodes]


class Audit:
    """The search for one conversation: ``row`` for each row in order, then ``finish``."""

    def __init__(self, nodes: int = NODES):
        self.prefixes, self.settled, self.limit, self.nodes = Prefixes(), [], nodes, nodes
        self.states: list[tuple[int, int] | None] = [(0, 0), None, None, None]  # cost and node

    def _step(self, state: tuple[int, int] | None, cost: int, letter: str) -> tuple[int, int, str] | None:
        return None if state is None else (state[0] + cost, state[1], letter)

    def _best(self, *found: tuple | None) -> tuple[int, int] | None:
        """The best of some states and steps, as a state."""
        best = None
        for x in found:
            if x is None or (best is not None and x[0] > best[0]):
                continue
            state = x if len(x) == 2 else (x[0], self.prefixes.add(x[1], x[2]))
            if best is None or state[0] < best[0] or self.prefixes.less(state[1], best[1]):
                best = state
        return best

    def _insert(self) -> None:
        start, system, user, assistant = self.states
        user = self._best(user, *[self._step(s, INSERT, "I") for s in (start, system, assistant)])
        self.states = [start, system, user, self._best(assistant, self._step(user, INSERT, "I"))]

    def row(self, initial: str, deleted: bool, truncated: bool) -> None:
        """``deleted`` rows have to go."""
        self._insert()
        after: list[list] = [[self._step(state, DELETE, "D")] for state in self.states]
        if not deleted:
            for before, now in MOVES.get(initial, {}).items():
                after[now].append(self._step(self.states[before], TRUNCATED * truncated, "K"))
            for role in "ua":
                for before, now in MOVES[role].items():
                    after[now].append(self._step(self.states[before], REROLE + TRUNCATED * truncated, "R"))
        self.states = [self._best(*found) for found in after]
        if len(self.prefixes.letter) > self.limit:
            self._settle()

    def _settle(self) -> None:
        live = [s[1] for s in self.states if s]
        above = self.prefixes.common(live)
        self.settled.append(self.prefixes.spell(above))
        self.prefixes, moved = self.prefixes.below(above, live)
        places = iter(moved)
        self.states = [s and (s[0], next(places)) for s in self.states]
        self.limit = max(self.nodes, 2 * len(self.prefixes.letter))

    def finish(self) -> tuple[int, str]:
        """Cost and audit."""
        self._insert()
        cost, node = self._best(self.states[START], self.states[ASSISTANT])
        return cost, "".join(self.settled) + self.prefixes.spell(node)


def damage(conversations: DataFrame) -> DataFrame:
    """The rows with planted faults, by the CRC-32 of ``conv_id:turn`` modulo 20: 0 drops a row, 1 empties its text, 2 takes
    out its ``.!?``, 3 repeats it, 4 makes it the user's. A NULL is one space there, in roles and in texts."""
    key = F.concat(F.coalesce(F.col("conv_id").cast("string"), F.lit(" ")), F.lit(":"), F.coalesce(F.col("turn").cast("string"), F.lit(" ")))
    fault = F.crc32(key.cast("binary")) % 20
    role, text = F.coalesce("role", F.lit(" ")), F.coalesce("text", F.lit(" "))
    return (
        conversations.select("conv_id", "turn", role.alias("role"), text.alias("text"), fault.alias("fault"))
        .filter("fault <> 0")
        .select(
            "conv_id",
            "turn",
            F.when(F.col("fault") == 4, "user").otherwise(F.col("role")).alias("role"),
            F.when(F.col("fault") == 1, "").when(F.col("fault") == 2, F.translate("text", ".!?", "")).otherwise(F.col("text")).alias("text"),
            F.explode(F.array_repeat(F.lit(0), F.when(F.col("fault") == 3, 2).otherwise(1))).alias("copy"),
        )
        .drop("copy")
    )


def _content() -> Column:
    """What rows of equal role and text share: a SHA-256 of both."""
    return F.unhex(F.sha2(F.concat(F.length("role").cast("string"), F.lit(":"), F.col("role"), F.col("text")).cast("binary"), 256))


def _clean(rows: DataFrame) -> DataFrame:
    return rows.select(
        F.col("conv_id").cast("long").alias("conv_id"),
        F.col("turn").cast("long").alias("turn"),
        F.coalesce("role", F.lit(" ")).alias("role"),
        F.coalesce("text", F.lit(" ")).alias("text"),
    )


#: The order of a conversation's rows, NULL turns first.
_ORDER = ["turn", "role", "head", "content"]


def audits(rows: DataFrame) -> DataFrame:
    """conv_id, gaps, blank, duplicate, truncated, illegal, cost (longs) and audit of each conversation of ``rows``.

    Rows go by turn, NULL first, then role and text (by its first 100 code points, then its SHA-256). A row's first
    fault counts: blank (only white space), duplicate (role and text seen earlier), truncated (the last character that is no white space is
    none of ``.!?``). Gaps are turns missing between the least and the largest, NULLs aside. Illegal are neighbours whose
    initials are not su, ua or au. NULL roles and texts are one space. A role that begins with neither s, u nor a, or that is
    empty, can't be kept. Rows of a NULL conv_id are one conversation; repeated rows are rows. Empty tables give none.
    """
    ended = F.rtrim(F.col("text"), F.lit(BLANKS))
    light = _clean(rows).select(
        "conv_id",
        "turn",
        "role",
        F.substring("text", 1, ORDERING).alias("head"),
        _content().alias("content"),
        (ended == "").alias("blank"),
        (~F.substring(ended, -1, 1).isin(".", "!", "?")).alias("open"),
    )
    # one shuffle: the window over a conversation's equal rows is served by the rows' place, too
    dealt = light.repartition(parts_for(rows), "conv_id")
    seen = F.row_number().over(Window.partitionBy("conv_id", "content").orderBy("turn")) > 1
    ordered = dealt.withColumn("again", seen).sortWithinPartitions("conv_id", *_ORDER)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        done: list[tuple] = []
        now: list = []  # the conversation at hand: its id, if any

        def close() -> None:
            cost, audit = search.finish()
            done.append((now[0], last - first + 1 - turns if turns else 0, *faults, illegal, cost, audit))

        for batch in batches:
            columns = [batch.column(c).to_pylist() for c in ("conv_id", "turn", "initial", "blank", "again", "open")]
            for conv, turn, initial, blank, again, is_open in zip(*columns, strict=True):
                if now != [conv]:
                    if now:
                        close()
                    now, search, faults, illegal = [conv], Audit(), [0, 0, 0], 0
                    turns, first, last, before = 0, None, None, None
                if turn is not None and (not turns or turn != last):
                    first, last, turns = turn if first is None else first, turn, turns + 1
                if before is not None and before + initial not in ("su", "ua", "au"):
                    illegal += 1
                before = initial
                fault = 0 if blank else 1 if again else 2 if is_open else None
                if fault is not None:
                    faults[fault] += 1
                search.row(initial, fault in (0, 1), fault == 2)
            yield _audit_batch(done)
            done.clear()
        if now:
            close()
        yield _audit_batch(done)

    needed = ordered.select("conv_id", "turn", F.substring("role", 1, 1).alias("initial"), "blank", "again", "open")
    return needed.mapInArrow(run, ", ".join(f"{c} long" for c in _AUDIT[:-1]) + ", audit string")


_AUDIT = ["conv_id", "gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit"]


def _audit_batch(rows: list[tuple]) -> pa.RecordBatch:
    columns = list(zip(*rows, strict=True)) if rows else [[]] * len(_AUDIT)
    return pa.RecordBatch.from_arrays([*[pa.array(c, pa.int64()) for c in columns[:-1]], pa.array(columns[-1], pa.string())], names=_AUDIT)


def _edited(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[int | None, str | None, str]]:
    """(conv_id, role, text) of the repaired rows, in order; role None opens a conversation. Its audit comes as its first row."""
    audit, at, seats, places = "", 0, 0, 0

    def seat() -> str:
        return "user" if (places - seats) % 2 else "assistant"

    def inserted(conv) -> Iterator[tuple]:
        nonlocal at, places
        while at < len(audit) and audit[at] == "I":
            at, places = at + 1, places + 1
            yield conv, seat(), ""

    for batch in batches:
        for conv, found, role, text in zip(*[batch.column(c).to_pylist() for c in ("conv_id", "audit", "role", "text")], strict=True):
            if found is not None:
                # an odd number of rows begins with the system's
                audit, at, places, seats = found, 0, 0, (len(found) - found.count("D")) % 2
                yield conv, None, ""
            else:
                edit, at = audit[at], at + 1
                if edit != "D":
                    places += 1
                    yield conv, role if edit == "K" else seat(), text
            yield from inserted(conv)


def _behind_audits(rows: DataFrame, found: DataFrame) -> DataFrame:
    texts = _clean(rows).select(
        "conv_id", F.lit(1).alias("kind"), F.lit(None).cast("string").alias("audit"), "turn", "role",
        F.substring("text", 1, ORDERING).alias("head"), _content().alias("content"), "text",
    )
    nothing = F.lit(None)
    heads = found.select(
        "conv_id", F.lit(0).alias("kind"), "audit", nothing.cast("long").alias("turn"), F.lit("").alias("role"),
        F.lit("").alias("head"), nothing.cast("binary").alias("content"), F.lit("").alias("text"),
    )
    dealt = heads.union(texts).repartition(parts_for(rows), "conv_id")
    return dealt.sortWithinPartitions("conv_id", "kind", *_ORDER).select("conv_id", "audit", "role", "text")


def repaired(rows: DataFrame, found: DataFrame) -> DataFrame:
    """conv_id, position (from 1), role and text of all rows after the edits of ``found``, the :func:`audits` of ``rows``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out, size, position = [], 0, 0

        def batch() -> pa.RecordBatch:
            columns = zip(*out, strict=True) if out else [[]] * 4
            return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, (pa.int64(), pa.int64(), pa.string(), pa.string()), strict=True)], names=["conv_id", "position", "role", "text"])

        for conv, role, text in _edited(batches):
            if role is None:
                position = 0
                continue
            position += 1
            out.append((conv, position, role, text))
            size += len(text) + 32
            if size > 1 << 20:
                yield batch()
                out, size = [], 0
        yield batch()

    return _behind_audits(rows, found).mapInArrow(run, "conv_id long, position long, role string, text string")


def repaired_digests(rows: DataFrame, found: DataFrame) -> DataFrame:
    """conv_id and repaired_sha256, of the repaired ``role:text`` lines joined by line feeds, fed to the hash as they come."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        done, now, digest, lines = [], None, None, 0

        def batch() -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array([c for c, _ in done], pa.int64()), pa.array([d for _, d in done], pa.string())], names=["conv_id", "repaired_sha256"])

        for conv, role, text in _edited(batches):
            if role is None:
                if digest is not None:
                    done.append((now, digest.hexdigest()))
                    if len(done) >= 10_000:
                        yield batch()
                        done = []
                now, digest, lines = conv, hashlib.sha256(), 0
            else:
                digest.update((("\n" if lines else "") + f"{role}:").encode())
                digest.update(text.encode())
                lines += 1
        if digest is not None:
            done.append((now, digest.hexdigest()))
        yield batch()

    return _behind_audits(rows, found).mapInArrow(run, "conv_id long, repaired_sha256 string")


def repair_report(rows: DataFrame, everyone: DataFrame) -> DataFrame:
    """The audits of ``rows`` with the digest of what they repair, one row for each conv_id of ``everyone``.

    A conversation without rows has zeros, an empty audit and the digest of the empty string.
    """
    found = stash(audits(rows), "audits")
    digests = repaired_digests(rows, found)
    ids = everyone.select(F.col("conv_id").cast("long").alias("conv_id")).distinct()
    # NULL is an id like any other
    keyed = [df.withColumn("none", F.col("conv_id").isNull()).withColumn("conv_id", F.coalesce("conv_id", F.lit(0))) for df in (ids, found, digests)]
    joined = keyed[0].join(keyed[1], ["conv_id", "none"], "left").join(keyed[2], ["conv_id", "none"], "left")
    empty = hashlib.sha256(b"").hexdigest()
    return joined.select(
        F.when(~F.col("none"), F.col("conv_id")).alias("conv_id"),
        *[F.coalesce(c, F.lit(0).cast("long")).alias(c) for c in _AUDIT[1:-1]],
        F.coalesce("audit", F.lit("")).alias("audit"),
        F.coalesce("repaired_sha256", F.lit(empty)).alias("repaired_sha256"),
    )


def _add(state: str, cost: str, letter: str) -> str:
    return f"(lpad((substr({state}, 1, 12)::BIGINT + {cost})::VARCHAR, 12, '0') || substr({state}, 13) || '{letter}')"


def _with_insertions(s: str, then: str) -> str:
    """SQL for ``then``, in which n.x0 to n.x3 are the states of ``s`` after insertions."""
    user = f"least({s}.x2, {_add(f'{s}.x0', '2', 'I')}, {_add(f'{s}.x1', '2', 'I')}, {_add(f'{s}.x3', '2', 'I')})"
    more = f"list_transform([{{'x0': {s}.x0, 'x1': {s}.x1, 'x2': {user}, 'x3': {s}.x3}}], lambda v: {{'x0': v.x0, 'x1': v.x1, 'x2': v.x2, 'x3': least(v.x3, {_add('v.x2', '2', 'I')})}})"
    return f"list_transform({more}, lambda n: {then})[1]"


_TO_USER = "least(n.x0, n.x1, n.x3)"
_SEARCH = _with_insertions(
    "s",
    f"""{{
    'x0': {_add("n.x0", "3", "D")},
    'x1': least({_add("n.x1", "3", "D")}, CASE WHEN r.must = 0 AND r.i = 's' THEN {_add("n.x0", "r.t", "K")} END),
    'x2': least({_add("n.x2", "3", "D")}, CASE WHEN r.must = 0 AND r.i = 'u' THEN {_add(_TO_USER, "r.t", "K")} END,
        CASE WHEN r.must = 0 THEN {_add(_TO_USER, "r.t + 2", "R")} END),
    'x3': least({_add("n.x3", "3", "D")}, CASE WHEN r.must = 0 AND r.i = 'a' THEN {_add("n.x2", "r.t", "K")} END,
        CASE WHEN r.must = 0 THEN {_add("n.x2", "r.t + 2", "R")} END),
    'i': NULL::VARCHAR, 'must': 0, 't': 0}}""",
)

#: Costs are twelve digits before the audit, so that the least string is the cheapest and then the ASCII-least audit.
SQL = f"""
WITH keyed AS (
    SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text,
        coalesce(conv_id::VARCHAR, ' ') || ':' || coalesce(turn::VARCHAR, ' ') AS k FROM conversations
),
faults AS (
    SELECT *, xor(list_reduce(
        [4294967295] || list_transform(range(0, 8 * length(k)), lambda i: ((ascii(substr(k, i // 8 + 1, 1)) >> (i % 8)::INTEGER) & 1)::BIGINT),
        lambda c, b: xor(c >> 1, 3988292384 * xor(c & 1, b))), 4294967295) % 20 AS fault FROM keyed
),
damaged AS (
    SELECT conv_id, turn, CASE WHEN fault = 4 THEN 'user' ELSE role END AS role,
        CASE WHEN fault = 1 THEN '' WHEN fault = 2 THEN translate(text, '.!?', '') ELSE text END AS text
    FROM (SELECT *, unnest(range(CASE WHEN fault = 3 THEN 2 ELSE 1 END)) AS copy FROM faults WHERE fault <> 0)
),
numbered AS (
    SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text[:100], sha256(length(role) || ':' || role || text)) AS line
    FROM damaged
),
looked AS (
    SELECT *, row_number() OVER (PARTITION BY conv_id, role, text ORDER BY line) > 1 AS again,
        regexp_replace(text, '[\\x20\\x09-\\x0D]+$', '') AS ended, left(role, 1) AS i,
        lag(left(role, 1)) OVER (PARTITION BY conv_id ORDER BY line) AS before
    FROM numbered
),
judged AS (
    SELECT *, CASE WHEN ended = '' THEN 'blank' WHEN again THEN 'duplicate' WHEN right(ended, 1) NOT IN ('.', '!', '?') THEN 'truncated' END AS fault
    FROM looked
),
searched AS (
    SELECT conv_id,
        coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0)::BIGINT AS gaps,
        count(*) FILTER (fault = 'blank') AS blank,
        count(*) FILTER (fault = 'duplicate') AS duplicate,
        count(*) FILTER (fault = 'truncated') AS truncated,
        count(*) FILTER (before IS NOT NULL AND before || i NOT IN ('su', 'ua', 'au')) AS illegal,
        list_reduce(
            [{{'x0': '000000000000', 'x1': NULL::VARCHAR, 'x2': NULL::VARCHAR, 'x3': NULL::VARCHAR, 'i': NULL::VARCHAR, 'must': 0, 't': 0}}] || list({{
                'x0': NULL::VARCHAR, 'x1': NULL::VARCHAR, 'x2': NULL::VARCHAR, 'x3': NULL::VARCHAR, 'i': i,
                'must': CASE WHEN fault IN ('blank', 'duplicate') THEN 1 ELSE 0 END,
                't': CASE WHEN fault = 'truncated' THEN 1 ELSE 0 END}} ORDER BY line),
            lambda s, r: {_SEARCH}) AS s
    FROM judged GROUP BY conv_id
),
found AS (SELECT * EXCLUDE s, {_with_insertions("s", "least(n.x0, n.x3)")} AS best FROM searched),
edits AS (
    SELECT conv_id, p, edit, count(*) FILTER (edit <> 'I') OVER w AS line, count(*) FILTER (edit <> 'D') OVER w AS place,
        count(*) FILTER (edit <> 'D') OVER (PARTITION BY conv_id) % 2 AS seats
    FROM (SELECT conv_id, unnest(range(13, length(best) + 1)) AS p, best FROM found), LATERAL (SELECT substr(best, p, 1) AS edit)
    WINDOW w AS (PARTITION BY conv_id ORDER BY p)
),
lines AS (
    SELECT e.conv_id, p, CASE WHEN edit = 'K' THEN role WHEN (place - seats) % 2 = 1 THEN 'user' ELSE 'assistant' END || ':'
        || CASE WHEN edit = 'I' THEN '' ELSE text END AS said
    FROM edits e LEFT JOIN numbered n ON e.conv_id IS NOT DISTINCT FROM n.conv_id AND e.line = n.line WHERE edit <> 'D'
),
whole AS (SELECT conv_id, string_agg(said, chr(10) ORDER BY p) AS said FROM lines GROUP BY conv_id)
SELECT a.conv_id, coalesce(gaps, 0) AS gaps, coalesce(blank, 0) AS blank, coalesce(duplicate, 0) AS duplicate,
    coalesce(truncated, 0) AS truncated, coalesce(illegal, 0) AS illegal, coalesce(substr(best, 1, 12)::BIGINT, 0) AS cost,
    coalesce(substr(best, 13), '') AS audit, sha256(coalesce(said, '')) AS repaired_sha256
FROM (SELECT DISTINCT conv_id FROM conversations) a
LEFT JOIN found f ON a.conv_id IS NOT DISTINCT FROM f.conv_id
LEFT JOIN whole w ON a.conv_id IS NOT DISTINCT FROM w.conv_id
"""
