from __future__ import annotations

import hashlib
import random
import re
import zlib
from functools import lru_cache
from itertools import groupby

from martflow.llm import audit_dp as A
from martflow.llm.queries import QUERIES
from tests.conftest import SF0001, need_testdata

GRAMMAR = re.compile(r"(s?(ua)+)?\Z")
COLUMNS = ("gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256")


def faults(rows):
    out, seen = [], set()
    for _, role, text in rows:
        body = re.sub(r"[\x20\x09-\x0D]", "", text)
        if not body:
            out.append("blank")
        elif (role, text) in seen:
            out.append("duplicate")
        else:
            out.append("truncated" if body[-1] not in ".!?" else "")
        seen.add((role, text))
    return out


def cheapest(rows, kinds):
    """Cheapest edits from the end, with no prefix shared: (cost, audit, kept rows)."""

    @lru_cache(None)
    def best(i, done, inserts):
        options = [(0, "", ())] if i == len(rows) and GRAMMAR.match(done) else []
        while len(done) > 3:  # one pair fewer: the grammar goes on alike
            done = done[:-2]

        def more(cost, letter, j, new, row, ins=0):
            if re.match(r"s?(ua)*u?\Z", done + new):
                rest = best(j, done + new, ins)
                if rest is not None:
                    options.append((cost + rest[0], letter + rest[1], (row,) * (row is not None) + rest[2]))

        if inserts < 3:
            for role in ("user", "assistant"):
                more(3, "I", i, role[0], (role, ""), inserts + 1)
        if i < len(rows):
            _, role, text = rows[i]
            more(4, "D", i + 1, "", None)
            if kinds[i] not in ("blank", "duplicate"):
                extra = 3 * (kinds[i] == "truncated")
                if role:
                    more(extra, "K", i + 1, role[0], (role, text))
                for r in ("user", "assistant"):
                    more(3 + extra, "R", i + 1, r[0], (r, text))
        return min(options, default=None)

    return best(0, "", 0)


def brute(rows):
    kinds = faults(rows)
    pairs = sum(a[1][:1] + b[1][:1] not in {"su", "ua", "au"} for a, b in zip(rows, rows[1:]))
    turns = {t for t, _, _ in rows if t is not None}
    cost, audit, kept = cheapest(tuple(rows), tuple(kinds))
    text = "\n".join(f"{r}:{t}" for r, t in kept)
    return (max(turns) - min(turns) + 1 - len(turns) if turns else 0, kinds.count("blank"), kinds.count("duplicate"),
            kinds.count("truncated"), pairs, cost, audit, hashlib.sha256(text.encode()).hexdigest())


def by_hand(table):
    """Damage and repair of ``(conv_id, turn, role, text)`` rows in plain Python."""
    out, key = {}, lambda r: (r[0] is not None, r[0])
    for conv, rows in groupby(sorted(table, key=key), lambda r: r[0]):
        kept = []
        for _, turn, role, text in rows:
            role, text = (" " if x is None else x for x in (role, text))
            fault = zlib.crc32(f"{' ' if conv is None else conv}:{' ' if turn is None else turn}".encode()) % 20
            row = (turn, "user" if fault == 4 else role, "" if fault == 1 else re.sub("[.!?]", "", text) if fault == 2 else text)
            kept += [row] * (0 if fault == 0 else 2 if fault == 3 else 1)
        kept.sort(key=lambda r: (r[0] is not None, r[0] or 0, r[1].encode(), r[2].encode()))
        out[conv] = brute(kept)
    return out


def found(df):
    return {r.conv_id: tuple(r[c] for c in COLUMNS) for r in df.collect()}


def test_repair_equals_brute_force():
    rng = random.Random(3)
    for _ in range(1500):
        rows = [(i, rng.choice(["user", "assistant", "system", "tool", ""]), rng.choice(["Hi.", "so", "", "Yes!", "no "]))
                for i in range(rng.randrange(8))]
        conv = A.Conversation()
        for row in rows:
            conv.row(*row)
        got = conv.result()
        assert tuple(got[c] for c in COLUMNS) == brute(rows), rows


def chain(text):
    node = A.Edit(None, "")
    for x in text:
        node = A.Edit(node, x)
    return node


def test_order_of_prefixes(monkeypatch):
    rng = random.Random(4)
    for modulus in (A.MODULUS, 2):  # with 2, nearly all hashes collide
        monkeypatch.setattr(A, "MODULUS", modulus)
        for _ in range(2000):
            stem = "".join(rng.choice("DK") for _ in range(rng.randrange(40)))
            shared = chain(stem)
            a, b = ("".join(rng.choice("DIKR") for _ in range(rng.randrange(6))) for _ in range(2))
            x = y = shared
            for c in a:
                x = A.Edit(x, c)
            for c in b:
                y = A.Edit(y, c)
            if rng.random() < 0.5:
                y = chain(stem + b)  # equal letters in other nodes
            assert x.text() == stem + a
            assert A.before(x, y) == (stem + a < stem + b)
            assert A.ancestor(x, len(stem) // 2).text() == stem[: len(stem) // 2]


def test_long_conversation_needs_few_steps():
    conv = A.Conversation()
    for i in range(20000):
        conv.row(i, "ua"[i % 2] + "x", f"{i}.")
    got = conv.result()
    assert got["audit"] == "K" * 20000 and got["cost"] == 0 and got["gaps"] == 0
    node = conv.repair.paths[A.ASSISTANT].edit
    steps = 0
    while node.depth > 7:
        node = node.jump if node.jump.depth >= 7 else node.back
        steps += 1
    assert steps < 60


def test_query_equals_brute_force(spark):
    need_testdata()
    rows = [tuple(r) for r in spark.read.parquet(f"{SF0001}/conversations.parquet")
            .select("conv_id", "turn", "role", "text").collect()]
    assert found(QUERIES["op12_audit_dp"](spark, SF0001)) == by_hand(rows)


def test_odd_rows(spark):
    schema = "conv_id long, turn long, role string, text string, copy int, fault string"
    rows = [(1, None, None, None), (1, 5, "user", "Hello."), (1, 5, "user", "Hello."), (1, 9, "assistant", "x" * 200_000),
            (None, 1, "user", "No id."), (None, None, "", "."), (2, 3, "sys", "é "), (2, 3, "assistant", "\t\n"),
            (3, 1, "user", ""), (-1, -7, "user", "a?"), (-1, 2**40, "assistant", "b.")]
    rows += [(100 + i, 1, "user", "Dropped?") for i in range(60)]
    df = spark.createDataFrame([(*r, 1, "z") for r in rows], schema)
    got = found(A.repaired(A.damaged(df)))
    assert got == by_hand(rows)
    gone = [v for v in got.values() if v == (0, 0, 0, 0, 0, 0, "", hashlib.sha256(b"").hexdigest())]
    assert gone  # all rows dropped
    assert A.repaired(A.damaged(df.limit(0))).count() == 0
