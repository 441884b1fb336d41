from __future__ import annotations

import hashlib
import itertools
import random
import re
import zlib
from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from tests.llm.tables import documents, whole, write_tables
from tidepool.llm import repair as R
from tidepool.llm.queries import conversation_repair

COLUMNS = ("gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256")
LEGAL = re.compile("(s?(ua)+)?")


def plain_faults(rows: list[tuple]) -> list[str | None]:
    seen, out = set(), []
    for _, role, text in rows:
        shown = re.findall("[^\x20\x09-\x0d]", text)
        if not shown:
            out.append("blank")
        elif (role, text) in seen:
            out.append("duplicate")
        else:
            out.append(None if shown[-1] in ".!?" else "truncated")
        seen.add((role, text))
    return out


def plain_search(rows: list[tuple]) -> tuple[int, str, list[str]]:
    """The least (cost, audit), and the lines, with the whole strings of every state at every row."""
    allowed = {"": "su", "s": "u", "u": "a", "a": "u"}

    def inserted(found):
        for _ in range(2):
            for state, (cost, audit, lines) in list(found.items()):
                for new in allowed[state]:
                    if new != "s":
                        now = (cost + 2, audit + "I", [*lines, {"u": "user", "a": "assistant"}[new] + ":"])
                        found[new] = min(found.get(new, now), now)
        return found

    states = inserted({"": (0, "", [])})
    for (_, role, text), fault in zip(rows, plain_faults(rows)):
        after: dict = {}
        for state, (cost, audit, lines) in states.items():
            ways = [(state, 3, "D", lines)]
            if fault not in ("blank", "duplicate"):
                more = fault == "truncated"
                if role[:1] and role[:1] in allowed[state]:
                    ways.append((role[:1], more, "K", [*lines, f"{role}:{text}"]))
                ways += [(new[0], 2 + more, "R", [*lines, f"{new}:{text}"]) for new in ("user", "assistant") if new[0] in allowed[state]]
            for target, price, sign, written in ways:
                now = (cost + price, audit + sign, written)
                after[target] = min(after.get(target, now), now)
        states = inserted(after)
    return min(states[s] for s in ("", "a") if s in states)


def every_way(rows: list[tuple]) -> tuple[int, str]:
    """The least (cost, audit) of all edits, with up to two inserts between rows."""
    faults = plain_faults(rows)
    each = []
    for (_, role, _), fault in zip(rows, faults):
        ways = [("D", 3, "")]
        if fault not in ("blank", "duplicate"):
            ways += [("K", fault == "truncated", role[:1] or "?"), ("R", 2 + (fault == "truncated"), "u"), ("R", 2 + (fault == "truncated"), "a")]
        each.append(ways)
    puts = ["", "u", "a", "ua", "au"]
    best = None
    for chosen in itertools.product(*each):
        for between in itertools.product(puts, repeat=len(rows) + 1):
            roles, audit, cost = between[0], "I" * len(between[0]), 2 * sum(map(len, between))
            for (sign, price, initial), put in zip(chosen, between[1:]):
                roles, audit, cost = roles + initial + put, audit + sign + "I" * len(put), cost + price
            if LEGAL.fullmatch(roles):
                best = min(best or (cost, audit), (cost, audit))
    return best


def plain_repair(rows: list[tuple]) -> tuple:
    rows = sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, r[1], r[2]))
    faults = plain_faults(rows)
    turns = [t for t, _, _ in rows if t is not None]
    gaps = max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0
    illegal = sum(a[1][:1] + b[1][:1] not in ("su", "ua", "au") for a, b in zip(rows, rows[1:]))
    cost, audit, lines = plain_search(rows)
    return (gaps, *(faults.count(f) for f in ("blank", "duplicate", "truncated")), illegal, cost, audit,
            hashlib.sha256("\n".join(lines).encode()).hexdigest())


def plain_query(table: list[tuple]) -> dict:
    by = defaultdict(list)
    for conv, turn, role, text in table:
        role, text = (" " if x is None else x for x in (role, text))
        kind = zlib.crc32(f"{' ' if conv is None else conv}:{' ' if turn is None else turn}".encode()) % 20
        rows = by[conv]
        if kind == 0:
            continue
        text = "" if kind == 1 else re.sub("[.!?]", "", text) if kind == 2 else text
        rows += [(turn, "user" if kind == 4 else role, text)] * (2 if kind == 3 else 1)
    return {conv: plain_repair(rows) for conv, rows in by.items()}


def check(rows, expected: dict) -> None:
    assert len(rows) == len(expected)
    for r in rows:
        assert tuple(r[c] for c in COLUMNS) == expected[r["conv_id"]], r["conv_id"]


def test_the_whole_table_against_the_plain_way(spark, sf_dir):
    expected = plain_query([tuple(r[c] for c in ("conv_id", "turn", "role", "text")) for r in whole(spark, sf_dir, "conversations")])
    assert sum(any(v[:5]) for v in expected.values()) > 50
    check(conversation_repair(spark, sf_dir).collect(), expected)


def drawn(draw: random.Random, n: int) -> list[tuple]:
    roles = ["user", "assistant", "system", "user", "assistant", "tool", "", "ugly"]
    texts = ["Yes.", "No!", "what", " ", "", "so?", "a.", "b.", "c", "d. "]
    return [(draw.choice([None, k, k // 2, 2 * k]), draw.choice(roles), draw.choice(texts) + draw.choice(["", str(draw.randrange(9)) + "."]))
            for k in range(n)]


def walked(rows: list[tuple]) -> tuple:
    rows = sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, r[1], r[2]))
    walk, seen = R.Walk(True), set()
    for turn, role, text in rows:
        walk.row(turn, role, text, (role, text) in seen)
        seen.add((role, text))
    end = walk.finish()
    lines = "\n".join(f"{role}:{text}" for _, role, text, _ in walk.out)
    assert hashlib.sha256(lines.encode()).hexdigest() == end[7]
    return end


@pytest.mark.parametrize("seed", range(400))
def test_walk_against_whole_strings(seed):
    rows = drawn(random.Random(seed), seed % 41)
    assert walked(rows)[:8] == plain_repair(rows)


@pytest.mark.parametrize("seed", range(40))
def test_walk_against_every_way(seed):
    rows = sorted(drawn(random.Random(-seed), seed % 4), key=lambda r: (r[0] is not None, r[0] or 0, r[1], r[2]))
    assert plain_repair(rows)[5:7] == every_way(rows)


@pytest.mark.parametrize("roles", ["u", "s", "ua", "uua", "a", "su", "x", "uuaa", "sa"])
def test_long_ties_are_decided_on_whole_suffixes(roles):
    rows = [(k, {"u": "user", "a": "assistant", "s": "system", "x": "tool"}[roles[k % len(roles)]], f"text {k}.") for k in range(301)]
    assert walked(rows)[:8] == plain_repair(rows)


def test_what_is_held_does_not_grow_with_the_conversation():
    held = []
    for n in (100, 10_000):
        draw = random.Random(n)
        walk = R.Walk(True)
        walk.row(0, "system", "Be kind.", False)
        for k in range(1, n):
            role = ("assistant", "user")[k % 2] if draw.random() < 0.97 else "user"
            walk.row(k, role, f"Text {k}" + "." * (draw.random() < 0.9), draw.random() < 0.03)
            walk.out.clear()
        assert len(walk.waiting) < 60
        held.append(walk.finish()[8])
        assert len(walk.tree.step) < 300
    assert max(held) < 200


def test_awkward_rows(spark, tmp_path):
    rows = [(1, 1, "assistant", "Second."), (1, 0, "user", "First."), (2, 0, "assistant", None), (3, 0, None, "x"), (3, 0, None, "x"),
            (4, None, "assistant", "Hm."), (4, None, None, None), (None, 0, "user", "No id."), (None, 3, "assistant", "No id."), (5, 0, "", ""),
            (6, 5, "user", "y" * 300_000 + "."), (6, -5, "user", "é漢\U0001F600!"), (7, 2**62, "system", "a."), *[(8, k, "user", "Same.") for k in range(9)]]
    rows += [(k, 0, "user", "Alone.") for k in range(100, 160)]  # some are dropped, so that nothing is left
    frame = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    folder = write_tables(spark, tmp_path / "a", documents(spark, []), conversations=rows)
    expected = plain_query(rows)
    assert any(v[5:] == (0, "", hashlib.sha256(b"").hexdigest()) for k, v in expected.items() if (k or 0) >= 100)
    check(conversation_repair(spark, folder).collect(), expected)
    extra = frame.withColumns({name: F.lit("x") for name in ("kind", "gone", "duplicate", "copy", "place")})
    assert len(R.damaged(extra).columns) == 5
    assert conversation_repair(spark, write_tables(spark, tmp_path / "b", documents(spark, []))).collect() == []


def test_repaired_rows(spark):
    rows = [(1, 0, "user", "A."), (1, 1, "user", "B."), (1, 2, "assistant", "C."), (1, 2, "assistant", "C."), (2, 0, "tool", ""), (3, 4, "system", "S.")]
    frame = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    found = defaultdict(list)
    for r in R.repaired(frame).orderBy("id", "place").collect():
        found[r["id"]].append((r["turn"], r["role"], r["text"], r["edit"]))
    summary = {r["id"]: r for r in R.repairs(frame).collect()}
    assert set(summary) == {1, 2, 3} and summary[2]["audit"] == "D" and 2 not in found
    for conv, own in found.items():
        assert hashlib.sha256("\n".join(f"{role}:{text}" for _, role, text, _ in own).encode()).hexdigest() == summary[conv]["repaired_sha256"]
        assert LEGAL.fullmatch("".join(role[0] for _, role, *_ in own))
    assert [r[3] for r in found[1]] == ["K", "I", "K", "K"] and summary[1]["audit"] == "KIKKD"
