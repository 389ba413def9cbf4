"""Repair of conversation structure: the cheapest edit list, by a dynamic programme over shared edit prefixes.

A well-formed conversation reads ``(s?(ua)+)?`` in initials of its roles. Per
row the programme may Keep (0; a truncated row 3), Rerole to user or assistant
(3; truncated 6) or Delete (4, required for blank and repeated rows), and
anywhere Insert an empty user or assistant row (3). Of the cheapest edit lists
the ASCII-least string of initials (D < I < K < R) is taken.

1. Faults that need other rows of the conversation (role and text seen earlier)
   come from a window over equal rows; the rest is judged on the row itself.
2. Rows are hashed by conversation, sorted by turn and streamed. One pass holds,
   for each of the four states of the grammar, the cost and the edits so far.
   Edit lists are linked nodes with a shared past (:class:`Trails`): a node
   knows its ancestors at powers of two and the rolling hash of its whole string.
   Two lists of equal cost are compared at the end of their longest common
   prefix, found by lifting both while the hashes differ. Equal hashes of
   different nodes are verified letter by letter.
   (Comparing prefixes is enough: with equal cost and state neither can be a
   proper prefix of the other, as every Insert costs.)
3. What all living lists share is settled: its letters are given out, its rows
   go into the running SHA-256, its nodes go. Memory follows the stretch that
   is still open and the edit string itself, not the texts of a conversation.

A conversation's digest is one SHA-256 over its rows in order, so each conversation
is the work of one task, however long; it is streamed there and never held.

Defined cases: NULL role or text is one space, a NULL id or turn is one space in the
damage's key; rows without id form one conversation; NULL turns come first; rows
of one turn are ordered by role, then text; equal rows are interchangeable (all
but the first are duplicates); a role that begins with none of s, u, a (the empty one too)
can't be kept; a conversation without rows has zeros, no edits and the digest of nothing;
an empty table gives an empty result; extra columns are ignored; texts are whole, whatever their length.
"""

from __future__ import annotations

import hashlib
from collections import deque
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

_SPACE = "\x20\x09\x0a\x0b\x0c\x0d"
#: Costs of the edits, and what an undeleted truncated row adds.
KEEP, REROLE, DELETE, INSERT, TRUNCATED = 0, 3, 4, 3, 3
#: The grammar: state -> role initial -> state (0 start, 1 after s, 2 after u, 3 after a); 0 and 3 may end.
GRAMMAR = ({"s": 1, "u": 2}, {"u": 2}, {"a": 3}, {"u": 2})
ENDS = (0, 3)
ROLES = {"u": "user", "a": "assistant"}
_PRIME, _BASE = (1 << 61) - 1, 1_000_003


class Trails:
    """Strings that grow at the end and share their past. Node 0 is the empty string."""

    def __init__(self) -> None:
        self.letter, self.depth, self.hash = [""], [0], [0]
        self.ups: list[list[int]] = [[]]  # ups[n][k]: the ancestor 2 ** k letters back

    def __len__(self) -> int:
        return len(self.letter)

    def add(self, node: int, letter: str) -> int:
        ups, k = [node], 0
        while k < len(self.ups[ups[k]]):
            ups.append(self.ups[ups[k]][k])
            k += 1
        self.ups.append(ups)
        self.letter.append(letter)
        self.depth.append(self.depth[node] + 1)
        self.hash.append((self.hash[node] * _BASE + ord(letter)) % _PRIME)
        return len(self.letter) - 1

    def lift(self, node: int, letters: int) -> int:
        k = 0
        while letters:
            if letters & 1:
                node = self.ups[node][k]
            letters >>= 1
            k += 1
        return node

    def same(self, a: int, b: int) -> bool:
        """Equal strings? Both of one length. Hashes decide against, letters decide for."""
        if a == b:
            return True
        if self.hash[a] != self.hash[b]:
            return False
        while a != b:
            if self.letter[a] != self.letter[b]:
                return False
            a, b = self.ups[a][0], self.ups[b][0]
        return True

    def part(self, a: int, b: int) -> tuple[int, int]:
        """The first nodes in which two different strings of one length differ."""
        for k in reversed(range(len(self.ups[a]))):
            if k < len(self.ups[a]):
                x, y = self.ups[a][k], self.ups[b][k]
                if not self.same(x, y):
                    a, b = x, y
        return a, b

    def less(self, a: int, b: int) -> bool:
        """Is the string of ``a`` before that of ``b``?"""
        short = min(self.depth[a], self.depth[b])
        x, y = self.lift(a, self.depth[a] - short), self.lift(b, self.depth[b] - short)
        if self.same(x, y):
            return self.depth[a] < self.depth[b]
        x, y = self.part(x, y)
        return self.letter[x] < self.letter[y]

    def shared(self, nodes: list[int]) -> int:
        """The last node that all of ``nodes`` come from."""
        out = nodes[0]
        for node in nodes[1:]:
            short = min(self.depth[out], self.depth[node])
            a, b = self.lift(out, self.depth[out] - short), self.lift(node, self.depth[node] - short)
            if a != b:
                for k in reversed(range(len(self.ups[a]))):
                    if k < len(self.ups[a]) and self.ups[a][k] != self.ups[b][k]:
                        a, b = self.ups[a][k], self.ups[b][k]
                a = self.ups[a][0]
            out = a
        return out

    def letters(self, node: int, since: int = 0) -> str:
        """The string of ``node`` after its ancestor ``since``."""
        out = []
        while node != since:
            out.append(self.letter[node])
            node = self.ups[node][0]
        return "".join(reversed(out))


class Audit:
    """One conversation, row by row in order."""

    def __init__(self, settle_at: int = 4096) -> None:
        self.trails = Trails()
        self.heads: dict[int, tuple[int, int]] = {0: (0, 0)}  # state -> cost, node
        self.settle_at = settle_at
        self.open: deque[tuple[str, str]] = deque()  # rows whose edit isn't settled
        self.state, self.edits, self.sha, self.lines = 0, [], hashlib.sha256(), 0
        self.counts = dict.fromkeys(("blank", "duplicate", "truncated", "illegal"), 0)
        self.initial: str | None = None
        self.turns: list[int] = []  # first, last
        self.distinct = 0

    def row(self, turn: int | None, role: str, text: str, seen: bool) -> None:
        """The next row; ``seen``: its role and text occurred earlier."""
        if turn is not None:
            if not self.turns:
                self.turns, self.distinct = [turn, turn], 1
            elif turn != self.turns[1]:
                self.turns[1], self.distinct = turn, self.distinct + 1
        own = role[:1]
        if self.initial is not None and self.initial + own not in ("su", "ua", "au"):
            self.counts["illegal"] += 1
        self.initial = own
        solid = text.rstrip(_SPACE)
        fault = "blank" if not solid else "duplicate" if seen else "truncated" if solid[-1] not in ".!?" else None
        if fault:
            self.counts[fault] += 1
        self.open.append((role, text))
        self._insert()
        extra = TRUNCATED if fault == "truncated" else 0
        ways: dict[int, list[tuple[int, int, str]]] = {}
        for state, (cost, node) in self.heads.items():
            ways.setdefault(state, []).append((cost + DELETE, node, "D"))
            if fault in ("blank", "duplicate"):
                continue
            if own in GRAMMAR[state]:
                ways.setdefault(GRAMMAR[state][own], []).append((cost + KEEP + extra, node, "K"))
            for to in ROLES:
                if to in GRAMMAR[state]:
                    ways.setdefault(GRAMMAR[state][to], []).append((cost + REROLE + extra, node, "R"))
        self.heads = {state: self._best(some) for state, some in ways.items()}
        self._drop_hopeless()
        if len(self.trails) > self.settle_at:
            self._settle(list(self.heads))

    def _drop_hopeless(self) -> None:
        """Forget states that can't be part of a cheapest list any more, so that the others' past settles.

        After an a, the next may be what follows s, and the end is allowed: state 1 is hopeless once
        it costs more. What state 0 can do besides is to keep an s, which state 3 can Delete."""
        if 3 in self.heads:
            cost = self.heads[3][0]
            for state, worth in ((0, DELETE), (1, 0)):
                if state in self.heads and self.heads[state][0] > cost + worth:
                    del self.heads[state]

    def _best(self, ways: list[tuple[int, int, str]]) -> tuple[int, int]:
        low = min(cost for cost, _, _ in ways)
        best = None
        for cost, node, letter in ways:
            if cost == low:
                new = self.trails.add(node, letter)
                if best is None or self.trails.less(new, best):
                    best = new
        return low, best

    def _insert(self) -> None:
        """Inserts in front of the next row (or the end): each state's best with any number of them."""
        changed = True
        while changed:
            changed = False
            for state, (cost, node) in list(self.heads.items()):
                for to in ROLES:
                    if to not in GRAMMAR[state]:
                        continue
                    target = GRAMMAR[state][to]
                    known = self.heads.get(target)
                    if known is not None and known[0] < cost + INSERT:
                        continue
                    new = self.trails.add(node, "I")
                    if known is None or cost + INSERT < known[0] or self.trails.less(new, known[1]):
                        self.heads[target], changed = (cost + INSERT, new), True

    def _settle(self, states: list[int]) -> None:
        """Give out what the lists of ``states`` share; the rest starts anew behind it."""
        base = self.trails.shared([self.heads[s][1] for s in states])
        self._give(self.trails.letters(base))
        fresh, known = Trails(), {}
        for s in states:
            node = 0
            for letter in self.trails.letters(self.heads[s][1], base):
                if (node, letter) not in known:
                    known[node, letter] = fresh.add(node, letter)
                node = known[node, letter]
            self.heads[s] = (self.heads[s][0], node)
        self.trails, self.settle_at = fresh, max(self.settle_at, 2 * len(fresh))

    def _give(self, letters: str) -> None:
        self.edits.append(letters)
        for letter in letters:
            role, text = ("", "") if letter == "I" else self.open.popleft()
            if letter == "D":
                continue
            if letter in "IR":
                role = next(ROLES[to] for to in ROLES if to in GRAMMAR[self.state])
            self.state = GRAMMAR[self.state][role[0]]
            self.sha.update(("\n" * bool(self.lines) + f"{role}:{text}").encode())
            self.lines += 1

    def result(self) -> tuple:
        """``gaps, blank, duplicate, truncated, illegal, cost, audit, repaired_sha256``."""
        self._insert()
        least = min(self.heads[s][0] for s in ENDS if s in self.heads)
        best = None
        for s in ENDS:
            if s in self.heads and self.heads[s][0] == least:
                if best is None or self.trails.less(self.heads[s][1], self.heads[best][1]):
                    best = s
        self._give(self.trails.letters(self.heads[best][1]))
        gaps = self.turns[1] - self.turns[0] + 1 - self.distinct if self.turns else 0
        return (gaps, *self.counts.values(), least, "".join(self.edits), self.sha.hexdigest())


def damage(turns: DataFrame, *, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role",
           text_col: str = "text") -> DataFrame:
    """``conv, turn, role, text, times``: the damaged rows; ``times`` 0 (dropped), 1 or 2 (repeated)."""
    shown = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(" "))
    draw = F.crc32(F.concat(shown(conv_col), F.lit(":"), shown(turn_col)).cast("binary")) % 20
    text = F.when(draw == 1, F.lit("")).when(draw == 2, F.regexp_replace(shown(text_col), "[.!?]", "")).otherwise(shown(text_col))
    return turns.select(F.col(conv_col).alias("conv"), F.col(turn_col).cast("long").alias("turn"),
                        F.when(draw == 4, F.lit("user")).otherwise(shown(role_col)).alias("role"), text.alias("text"),
                        F.when(draw == 0, F.lit(0)).when(draw == 3, F.lit(2)).otherwise(F.lit(1)).alias("times"))


def as_rows(turns: DataFrame, *, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role",
            text_col: str = "text") -> DataFrame:
    """Undamaged rows in the form of :func:`damage`."""
    shown = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(" "))
    return turns.select(F.col(conv_col).alias("conv"), F.col(turn_col).cast("long").alias("turn"),
                        shown(role_col).alias("role"), shown(text_col).alias("text"), F.lit(1).alias("times"))


_COUNTS = ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")


def audit(rows: DataFrame) -> DataFrame:
    """One row per conversation of ``rows`` (``conv, turn, role, text, times``): ``conv_id``, the counts of
    faults, ``cost``, ``audit`` and ``repaired_sha256``."""
    conv_type = rows.schema["conv"].dataType
    out = T.StructType([T.StructField("conv_id", conv_type), *[T.StructField(c, T.LongType()) for c in _COUNTS],
                        T.StructField("audit", T.StringType()), T.StructField("repaired_sha256", T.StringType())])
    equal = Window.partitionBy("conv", "role", "text", "gone").orderBy(F.col("turn").asc_nulls_first())
    marked = rows.withColumn("gone", F.col("times") == 0).withColumn("seen", F.row_number().over(equal) > 1)
    order: list[Column | str] = ["conv", F.col("turn").asc_nulls_first(), "role", "text", "seen"]
    streamed = marked.select("conv", "turn", "role", "text", "seen", "times").repartition("conv").sortWithinPartitions(*order)
    return streamed.mapInArrow(_audited, out)


def _audited(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows sorted by conversation -> one row per conversation."""
    found: list[tuple] = []
    names = ["conv_id", *_COUNTS, "audit", "repaired_sha256"]
    kinds, conv, own = None, None, None

    def table() -> pa.RecordBatch:
        arrays = [pa.array([r[i] for r in found], kinds[i]) for i in range(len(names))]
        found.clear()
        return pa.RecordBatch.from_arrays(arrays, names=names)

    for batch in batches:
        kinds = [batch.schema.field(0).type, *[pa.int64()] * len(_COUNTS), pa.string(), pa.string()]
        for c, turn, role, text, seen, times in zip(*[col.to_pylist() for col in batch.columns]):
            if own is None or c != conv:
                if own is not None:
                    found.append((conv, *own.result()))
                    if len(found) >= 4096:
                        yield table()
                conv, own = c, Audit()
            for again in range(times):
                own.row(turn, role, text, seen or again > 0)
    if own is not None:
        found.append((conv, *own.result()))
    if found:
        yield table()
