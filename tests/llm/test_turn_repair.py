"""Conversation repair against a plain program that works backwards over whole conversations."""

from __future__ import annotations

import hashlib
import zlib
from collections import defaultdict

import pytest

from pagesieve.llm import turn_repair
from pagesieve.llm.queries import QUERIES

BLANKS = " \t\n\x0b\x0c\r"


def plain_damage(rows):
    out = []
    for conv_id, turn, role, text in rows:
        key = ":".join(" " if x is None else str(x) for x in (conv_id, turn))
        fault, role, text = zlib.crc32(key.encode()) % 20, " " if role is None else role, " " if text is None else text
        if fault == 1:
            text = ""
        if fault == 2:
            text = text.replace(".", "").replace("!", "").replace("?", "")
        if fault == 4:
            role = "user"
        out += [(conv_id, turn, role, text)] * {0: 0, 3: 2}.get(fault, 1)
    return out


def cheapest(rows):
    """(cost, audit, repaired) of one conversation, from its end backwards; rows: (role, text, must go, truncated)."""
    follow = {"": "su", "s": "u", "u": "a", "a": "u"}
    name = {"u": "user", "a": "assistant"}
    best = {"": (0, "", []), "a": (0, "", [])}

    def with_insertions(now):
        for _ in range(3):
            for state in follow:
                for r in follow[state]:
                    if r in name and r in now:
                        cost, audit, kept = now[r]
                        way = (cost + 3, "I" + audit, [f"{name[r]}:", *kept])
                        now[state] = min(now.get(state, way), way)
        return now

    best = with_insertions(best)
    for role, text, must_go, truncated in reversed(rows):
        now = {}
        for state in follow:
            ways = []
            if state in best:
                cost, audit, kept = best[state]
                ways.append((cost + 4, "D" + audit, kept))
            for r in follow[state]:
                if not must_go and r in best:
                    cost, audit, kept = best[r]
                    cost += 3 * truncated
                    if role[:1] == r:
                        ways.append((cost, "K" + audit, [f"{role}:{text}", *kept]))
                    if r in name:
                        ways.append((cost + 3, "R" + audit, [f"{name[r]}:{text}", *kept]))
            if ways:
                now[state] = min(ways)
        best = with_insertions(now)
    return best[""]


def plain_repair(rows):
    """rows: (conv_id, turn, role, text) after damage, in any order."""
    by = defaultdict(list)
    for r in rows:
        by[r[0]].append(r)
    out = {}
    for conv_id, own in by.items():
        digest = lambda r: hashlib.md5(f"{len(r[2])}:{r[2]}{r[3]}".encode()).hexdigest()
        own.sort(key=lambda r: (r[1] is not None, r[1] or 0, digest(r)))
        seen, judged, counts = set(), [], [0, 0, 0]
        for _, _, role, text in own:
            ends = text.rstrip(BLANKS)
            fault = 0 if not ends else 1 if (role, text) in seen else 2 if ends[-1] not in ".!?" else None
            seen.add((role, text))
            if fault is not None:
                counts[fault] += 1
            judged.append((role, text, fault in (0, 1), fault == 2))
        turns = [r[1] for r in own if r[1] is not None]
        gaps = max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0
        illegal = sum((a[2][:1] + b[2][:1]) not in ("su", "ua", "au") for a, b in zip(own, own[1:], strict=False))
        cost, audit, kept = cheapest(judged)
        out[conv_id] = (gaps, *counts, illegal, cost, audit, hashlib.sha256("\n".join(kept).encode()).hexdigest())
    return out


NOTHING = (0, 0, 0, 0, 0, 0, "", hashlib.sha256(b"").hexdigest())


def as_tuples(df):
    return {r[0]: tuple(r[1:]) for r in df.collect()}


def test_query(spark, sf):
    rows = [tuple(r) for r in spark.read.parquet(f"{sf}/conversations.parquet").select("conv_id", "turn", "role", "text").collect()]
    want = {r[0]: NOTHING for r in rows} | plain_repair(plain_damage(rows))
    out = QUERIES["op11_turn_repair"](spark, sf)
    assert out.columns == ["conv_id", "gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256"]
    assert as_tuples(out) == want


SCHEMA = "conv_id long, turn long, role string, text string, digest string, what string, part string"


def odd_rows():
    rows = [
        (None, 0, "user", "no id."), (None, 1, "assistant", "none."), (2**62, 5, "user", "big"), (2**62, 2**53 + 1, "user", "big."),
        (7, None, "user", "null turn."), (7, None, "assistant", "first."), (7, 3, None, None), (7, 3, "", "empty role."),
        (7, 4, "tool", "x!"), (7, 4, "tool", "x!"), (8, 0, "system", "s."), (8, 1, "system", "s."), (8, 2, "system", "t."),
        (9, 0, "user", "word " * 60_000 + "."), (9, 1, "user", "word " * 60_000 + "."), (9, 9, "assistant", "end.\x0b\n"),
        (10, 0, "user", "a."), (10, 0, "user", "b."), (10, 1, "user", "a."), (10, 2, "assistant", ""), (11, None, None, None),
    ]
    return [(*r, "d", "w", "p") for r in rows]


def test_odd_rows(spark):
    rows = odd_rows()
    got = as_tuples(turn_repair.repair(spark.createDataFrame(rows, SCHEMA)))
    want = plain_repair([(c, t, " " if r is None else r, " " if x is None else x) for c, t, r, x, *_ in rows])
    assert got == want
    assert as_tuples(turn_repair.repair(turn_repair.damaged(spark.createDataFrame(rows, SCHEMA)))) == (
        {r[0]: NOTHING for r in rows} | plain_repair(plain_damage([r[:4] for r in rows]))
    )
    empty = spark.createDataFrame([], SCHEMA)
    assert turn_repair.repair(turn_repair.damaged(empty)).collect() == []


@pytest.mark.parametrize("spill", [3, 1000])
def test_giant_conversation(spark, spill):
    """Batches and spilled parts of any size give the same edits."""
    giant = [
        (1, i, ("user", "assistant", "user", "system", "tool")[zlib.crc32(b"%d" % i) % 5], f"text {i % 997}" + ".!,"[i % 3])
        for i in range(6000)
    ]
    rows = giant + [(2, i, "user", "hi.") for i in range(50)]
    turns = spark.createDataFrame([(*r, "d", "w", "p") for r in rows], SCHEMA)
    assert as_tuples(turn_repair.repair(turns, spill_rows=spill)) == plain_repair(rows)


def test_repaired_rows(spark, sf):
    """The written-out repair has the digest the summary states."""
    turns = turn_repair.damaged(spark.read.parquet(f"{sf}/conversations.parquet"))
    found = turn_repair.repair(turns)
    by = defaultdict(list)
    for r in turn_repair.repaired(turns, found).collect():
        by[r.conv_id].append(r)
    for r in found.collect():
        own = sorted(by[r.conv_id], key=lambda x: x.place)
        assert [x.place for x in own] == list(range(len(own)))
        assert "".join(x.edit for x in own) == r.audit.replace("D", "")
        assert hashlib.sha256("\n".join(f"{x.role}:{x.text}" for x in own).encode()).hexdigest() == r.repaired_sha256
