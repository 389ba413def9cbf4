"""Conversation trie and repair against plain versions."""

from __future__ import annotations

import hashlib
import itertools
import random
import re
import zlib
from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from tripspark.llm import conversation_repair, conversation_trie
from tripspark.llm.common import running
from tripspark.llm.conversation_repair import Audit, Trails

from edge import rows_of

SCHEMA = "conv_id bigint, turn bigint, role string, text string"
NAMES = ("conv", "turn", "role", "text", "times", "seen", "depth", "part", "at", "length", "words", "k", "gone", "h", "base",
         "_stretch", "own", "place", "x1", "s1", "e1", "d1", "saved", "leaf", "jump")


def _table(spark, rows):
    return spark.createDataFrame(rows, SCHEMA)


def _clashing(df):
    return df.withColumns({c: F.lit("x") for c in NAMES if c not in df.columns})


def _random_rows(seed, convs=60):
    rng = random.Random(seed)
    rows = []
    for c in range(convs):
        for t in range(rng.randint(0, 9)):
            rows.append((c, rng.choice([t, t, t, None]), rng.choice(["user", "assistant", "system", None]),
                         rng.choice(["hi there.", "a b c", "yes!", "", None, "ok"])))
    return rows


EDGE = [
    (None, 1, "user", "nobody's"), (None, None, None, None), (7, None, None, None), (7, 1, "user", "hi."), (7, 1, "user", "hi."),
    (7, 1, "user", "hi."), (8, 0, "", " \t\n"), (8, 5, "tool", "x"), (9, 0, "system", "s."), (20, 0, "user", "long " * 50_000 + "."),
    (21, 0, "user", "long " * 50_000 + "."), (22, 3, "student", "why?"), (22, 3, "assistant", "so.")]


# --- repair ---------------------------------------------------------------------------------

def _plain_rows(rows):
    """Damaged rows per conversation, in order."""
    convs = defaultdict(list)
    shown = lambda x: " " if x is None else str(x)
    for c, t, role, text in rows:
        draw = zlib.crc32(f"{shown(c)}:{shown(t)}".encode()) % 20
        role, text = shown(role), shown(text)
        own = convs[c]
        text = "" if draw == 1 else re.sub("[.!?]", "", text) if draw == 2 else text
        own += [(t, "user" if draw == 4 else role, text)] * {0: 0, 3: 2}.get(draw, 1)
    return {c: sorted(own, key=lambda r: (r[0] is not None, r[0] or 0, r[1], r[2])) for c, own in convs.items()}


def _plain_audit(rows):
    """All edit lists by breadth over rows, whole strings compared."""
    faults, seen = [], set()
    for _, role, text in rows:
        solid = text.strip("\x20\x09\x0a\x0b\x0c\x0d")
        faults.append("blank" if not solid else "duplicate" if (role, text) in seen else "truncated" if solid[-1] not in ".!?" else "")
        seen.add((role, text))

    def state(initials):
        return 0 if not initials else {"s": 1, "u": 2, "a": 3}[initials[-1]]

    def fits(initials):
        return re.fullmatch("s?(ua)*u?", initials) is not None

    heads = {0: (0, "", "", ())}

    def put(heads, initials, cost, audit, lines):
        if fits(initials):
            k = state(initials)
            if k not in heads or (cost, audit) < heads[k][:2]:
                heads[k] = (cost, audit, initials, lines)

    def inserts(heads):
        for _ in range(3):
            for cost, audit, initials, lines in list(heads.values()):
                for r in "ua":
                    put(heads, initials + r, cost + 3, audit + "I", (*lines, {"u": "user:", "a": "assistant:"}[r]))
        return heads

    for (_, role, text), fault in zip(rows, faults):
        new = {}
        extra = 3 if fault == "truncated" else 0
        for cost, audit, initials, lines in inserts(heads).values():
            put(new, initials, cost + 4, audit + "D", lines)
            if fault not in ("blank", "duplicate"):
                if role[:1] and role[:1] in "sua":
                    put(new, initials + role[:1], cost + extra, audit + "K", (*lines, f"{role}:{text}"))
                for r in "ua":
                    put(new, initials + r, cost + 3 + extra, audit + "R", (*lines, {"u": "user:", "a": "assistant:"}[r] + text))
        heads = new
    done = [h for h in inserts(heads).values() if re.fullmatch("(s?(ua)+)?", h[2])]
    cost, audit, _, lines = min(done)
    pairs = sum(a[1][:1] + b[1][:1] not in ("su", "ua", "au") for a, b in zip(rows, rows[1:]))
    turns = [t for t, _, _ in rows if t is not None]
    return (max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0, *[faults.count(f) for f in ("blank", "duplicate", "truncated")],
            pairs, cost, audit, hashlib.sha256("\n".join(lines).encode()).hexdigest())


@pytest.mark.parametrize("seed", [1, 2])
def test_repair_equals_plain(spark, seed):
    rows = _random_rows(seed) + EDGE
    got = conversation_repair.audit(conversation_repair.damage(_clashing(_table(spark, rows))))
    assert rows_of(got) == sorted(((c, *_plain_audit(own)) for c, own in _plain_rows(rows).items()), key=repr)


def test_whole_table_equals_plain(spark):
    table = spark.read.parquet("/root/testdata/sf0.01/conversations.parquet")
    rows = [tuple(r) for r in table.select("conv_id", "turn", "role", "text").collect()]
    got = conversation_repair.audit(conversation_repair.damage(table))
    assert rows_of(got) == sorted(((c, *_plain_audit(own)) for c, own in _plain_rows(rows).items()), key=repr)


def test_every_edit_list_of_few_rows():
    """The programme against every edit list with up to two Inserts in each gap."""
    for roles in itertools.product(["user", "assistant", "system", "x"], repeat=3):
        rows = [(i, r, t) for i, (r, t) in enumerate(zip(roles, ["a.", "b", "c?"]))]
        best = None
        for edits in itertools.product("DKR", repeat=3):
            for gaps in itertools.product(range(3), repeat=4):
                audit = "I" * gaps[0] + "".join(e + "I" * g for e, g in zip(edits, gaps[1:]))
                cost, initials, at, ok = 0, "", 0, True
                for e in audit:
                    cost += {"D": 4, "K": 0, "R": 3, "I": 3}[e]
                    if e == "D":
                        at += 1
                        continue
                    if e == "K":
                        initials += rows[at][1][0]
                    else:
                        initials += "a" if initials.endswith("u") else "u"
                    if e != "I":
                        cost += 3 * (rows[at][2][-1] not in ".!?")
                        at += 1
                    ok = ok and re.fullmatch("s?(ua)*u?", initials)
                if ok and re.fullmatch("(s?(ua)+)?", initials) and (best is None or (cost, audit) < best):
                    best = (cost, audit)
        own = Audit()
        for row in rows:
            own.row(*row, False)
        assert own.result()[5:7] == best


def test_settling_changes_nothing():
    rng = random.Random(3)
    for _ in range(20):
        rows = [(i, rng.choice(["user", "assistant", "system", "?"]), rng.choice(["a.", "b", "", "c!"]), rng.random() < 0.1) for i in range(200)]
        results = []
        for settle_at in (1, 8, 10 ** 9):
            own = Audit(settle_at)
            for row in rows:
                own.row(*row)
            results.append(own.result())
        assert results[0] == results[1] == results[2]


def test_long_conversation_settles():
    own = Audit()
    for i in range(30_000):
        own.row(i, ("user", "assistant")[i % 2], "same.", False)
        assert len(own.trails) < 10_000 and len(own.open) < 10_000
    assert own.result()[5:7] == (0, "K" * 30_000)


def test_trails_compare_as_strings_even_with_equal_hashes():
    rng = random.Random(5)
    for collide in (False, True):
        trails = Trails()
        nodes = {0: ""}
        for _ in range(300):
            n = rng.choice(list(nodes))
            letter = rng.choice("DIKR")
            new = trails.add(n, letter)
            if collide:
                trails.hash[new] = 1  # every hash equal: letters must decide
            nodes[new] = nodes[n] + letter
        for a, b in itertools.product(list(nodes)[::7], repeat=2):
            assert trails.less(a, b) == (nodes[a] < nodes[b])


def test_undamaged_rows_of_text_ids(spark):
    """The operator by itself: any id type, no damage."""
    rows = [("a", 1, "user", "Why?"), ("a", 2, "assistant", "So."), ("b", 1, "assistant", "Hello."), ("b", 2, "user", "hm")]
    table = spark.createDataFrame(rows, "conv_id string, turn int, role string, text string")
    got = {r["conv_id"]: r for r in conversation_repair.audit(conversation_repair.as_rows(table)).collect()}
    assert (got["a"]["audit"], got["a"]["cost"], got["a"]["illegal"]) == ("KK", 0, 0)
    assert got["a"]["repaired_sha256"] == hashlib.sha256(b"user:Why?\nassistant:So.").hexdigest()
    # keep the answer behind an inserted user (3) and delete the truncated question (4)
    assert (got["b"]["audit"], got["b"]["cost"], got["b"]["truncated"]) == ("IKD", 7, 1)


def test_repair_of_nothing(spark):
    assert conversation_repair.audit(conversation_repair.damage(_table(spark, []))).count() == 0
    empty = "e3b0c44298fc1c149afbf4c8996fb92427ae41e4649b934ca495991b7852b855"
    assert hashlib.sha256(b"").hexdigest() == empty
    gone = next(t for t in range(1000) if zlib.crc32(f"5:{t}".encode()) % 20 == 0)
    got = conversation_repair.audit(conversation_repair.damage(_table(spark, [(5, gone, "user", "x")])))
    assert rows_of(got) == [(5, 0, 0, 0, 0, 0, 0, "", empty)]


# --- trie -----------------------------------------------------------------------------------

def _plain_trie(rows):
    convs = defaultdict(list)
    for c, t, role, text in rows:
        if c is not None:
            convs[c].append((t is not None, t or 0, role or "", text or ""))
    convs = {c: [r[2:] for r in sorted(own)] for c, own in convs.items()}
    built = {}
    for c, own in convs.items():
        h = zlib.crc32(str(c).encode()) % 4
        built[c] = convs.get(c - c % 20, [])[:h] + own[h:]
    members, ends = defaultdict(set), defaultdict(list)
    for c, own in built.items():
        for d in range(len(own) + 1):
            members[tuple(own[:d])].add(c)
        ends[tuple(own)].append(c)
    kids = defaultdict(int)
    for node in members:
        if node:
            kids[node[:-1]] += 1
    leaves, saved = defaultdict(int), defaultdict(int)
    for node, own in members.items():
        words = len(re.findall(r"[^\x20\x09-\x0D]+", node[-1][1])) if node else 0
        for d in range(len(node) + 1):
            leaves[node[:d]] += node not in kids
            saved[node[:d]] += (len(own) - 1) * words
    return sorted(((min(own), len(n), min(members[n[:-1]]) if n else None, len(own), kids.get(n, 0), leaves[n], saved[n],
                    hashlib.sha256(",".join(map(str, sorted(ends.get(n, [])))).encode()).hexdigest()) for n, own in members.items()), key=repr)


@pytest.mark.parametrize("block", [1, 4])
def test_trie_equals_plain(spark, block):
    rows = _random_rows(11) + EDGE
    # nested branches: conversation i leaves conversation i - 1 one turn later
    rows += [(100 + i, t, "user", f"t{t}" if t < i else f"own {i}") for i in range(12) for t in range(i + 2)]
    rows += [(200 + i, t, "user", "copy") for i in range(40) for t in range(6)]
    assert rows_of(conversation_trie.prefix_trie(_clashing(_table(spark, rows)), block=block)) == _plain_trie(rows)


def test_trie_of_one_very_long_conversation(spark):
    rows = [(40, t, "user", f"turn {t % 5}") for t in range(200)] + [(41, t, "user", f"turn {t % 5}") for t in range(90)]
    got = conversation_trie.prefix_trie(_table(spark, rows).repartition(6))
    assert rows_of(got) == _plain_trie(rows)


def test_empty_trie(spark):
    assert conversation_trie.prefix_trie(_table(spark, [])).count() == 0
    assert conversation_trie.prefix_trie(_table(spark, [(None, 1, "user", "x")])).count() == 0


def test_id_digests_join_pieces(spark, monkeypatch):
    monkeypatch.setattr(conversation_trie, "_PIECE", 3)
    ends = spark.range(50).selectExpr("id % 2 as depth", "7L as d1", "8L as d2", "id as conv")
    got = {r["depth"]: r["ends_sha256"] for r in conversation_trie.id_digests(ends).collect()}
    assert got == {k: hashlib.sha256(",".join(str(i) for i in range(k, 50, 2)).encode()).hexdigest() for k in (0, 1)}


def test_running_totals(spark):
    rows = spark.createDataFrame([(k, i, (i * 7 + k) % 11) for k in range(3) for i in range(100)], "k int, i bigint, v bigint")
    for descending in (False, True):
        got = {(r["k"], r["i"]): (r["s"], r["x"]) for r in running(
            rows, ["k"], "i", {"s": (F.sum, F.col("v")), "x": (F.bit_xor, F.col("v"))}, descending=descending, width=7).collect()}
        for k in range(3):
            total, xor = 0, 0
            for i in (reversed(range(100)) if descending else range(100)):
                total, xor = total + (i * 7 + k) % 11, xor ^ ((i * 7 + k) % 11)
                assert got[k, i] == (total, xor)
