"""Conversation repair against plain Python that knows nothing of queues or segments."""

import hashlib
import random
import re
import zlib

import pytest
from conftest import against_sql

from orgloom.llm import conversation_repair, queries

ORDER = lambda x: (x is not None, x or 0)


def damage(rows):
    out, ids = [], set()
    for conv, turn, role, text in rows:
        ids.add(conv)
        role, text = " " if role is None else role, " " if text is None else text
        k = zlib.crc32(f"{' ' if conv is None else conv}:{' ' if turn is None else turn}".encode()) % 20
        text = "" if k == 1 else re.sub("[.!?]", "", text) if k == 2 else text
        out += [(conv, turn, "user" if k == 4 else role, text)] * (0 if k == 0 else 2 if k == 3 else 1)
    return ids, out


def cheapest(rows):
    """(cost, audit, repaired lines): least over all ways, by a table of the best (cost, audit) of each state."""
    initials = lambda r: r[:1]
    nodes = {"": (0, "", ())}  # by the last initial that is there ('' for none)
    follows = {"": "su", "s": "u", "u": "a", "a": "u"}
    name = {"u": "user", "a": "assistant"}

    def inserted(nodes):
        for _ in range(2):
            for state, (cost, audit, lines) in list(nodes.items()):
                to = "a" if state == "u" else "u"
                put(nodes, to, (cost + 5, audit + "I", (*lines, f"{name[to]}:")))
        return nodes

    def put(nodes, state, what):
        if state not in nodes or what[:2] < nodes[state][:2]:
            nodes[state] = what

    for role, text, fault in rows:
        new = {}
        for state, (cost, audit, lines) in inserted(nodes).items():
            put(new, state, (cost + 2, audit + "D", lines))
            if fault != "gone":
                more = 5 * (fault == "cut")
                if initials(role) and initials(role) in follows[state]:
                    put(new, initials(role), (cost + more, audit + "K", (*lines, f"{role}:{text}")))
                to = "a" if state == "u" else "u"
                put(new, to, (cost + more + 1, audit + "R", (*lines, f"{name[to]}:{text}")))
        nodes = new
    ends = inserted(nodes)
    return min(ends[s] for s in ("", "a") if s in ends)


def brute(ids, rows):
    out = []
    for conv in ids:
        own = sorted(((t, r, x) for c, t, r, x in rows if c == conv), key=lambda r: (ORDER(r[0]), r[1:]))
        seen, marked, count = set(), [], {"blank": 0, "duplicate": 0, "cut": 0}
        for _, role, text in own:
            bare = text.strip(" \t\n\x0b\x0c\r")
            fault = "blank" if not bare else "duplicate" if (role, text) in seen else "" if bare[-1] in ".!?" else "cut"
            seen.add((role, text))
            if fault:
                count[fault] += 1
            marked.append((role, text, "gone" if fault in ("blank", "duplicate") else fault))
        turns = [t for t, _, _ in own if t is not None]
        gaps = max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0
        illegal = sum(f"{a[1][:1]}{b[1][:1]}" not in ("su", "ua", "au") for a, b in zip(own, own[1:]))  # noqa: B905
        cost, audit, lines = cheapest(marked)
        out.append((conv, gaps, count["blank"], count["duplicate"], count["cut"], illegal, cost, audit, hashlib.sha256("\n".join(lines).encode()).hexdigest()))
    return sorted(map(repr, out))


COLUMNS = ["conv_id", "gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256"]
SCHEMA = "text string, conv_id long, turn long, role string, edge string, part string, codes int"


def frame(spark, rows):
    return spark.createDataFrame([(x, c, t, r, "e", "p", 1) for c, t, r, x in rows], SCHEMA)


def got(df):
    return sorted(repr(tuple(r[c] for c in COLUMNS)) for r in df.collect())


def made_up(n, seed):
    r = random.Random(seed)
    roles = ["user", "assistant", "system", "tool", "umpire", "", "Assistant", None]
    texts = ["One.", "two", "Three!\n", " \t", "", "same?", "same? no", "é。", "x" * 300 + ".", None]
    return [(r.choice([1, 2, 3, 4, 5, None, 77]), r.choice([None, *range(-3, 12)]), r.choices(roles, [6, 6, 2, 1, 1, 1, 1, 1])[0], r.choice(texts)) for _ in range(n)]


@pytest.mark.parametrize("segment_rows", [1, 2, 5, 1 << 16])
def test_equals_plain_python(spark, segment_rows):
    for seed, n in ((1, 9), (2, 170)):
        rows = made_up(n, seed)
        rows = list({(c, t, r, x): (c, t, r, x) for c, t, r, x in rows}.values()) + rows[:3]  # repeated rows, too
        want = brute({c for c, *_ in rows}, [(c, t, " " if r is None else r, " " if x is None else x) for c, t, r, x in rows])
        assert got(conversation_repair.repair(frame(spark, rows), segment_rows=segment_rows).facts()) == want


@pytest.mark.parametrize("segment_rows", [3, 1 << 16])
def test_after_damage(spark, segment_rows):
    rows = [(c, t, ["user", "assistant"][t % 2] if t else "system", f"Text {t}.") for c in range(300) for t in range(c % 7 + 1)] + [(None, None, None, None)]
    df = conversation_repair.damaged(frame(spark, rows))
    found = conversation_repair.repair(df, copies_col="copies", segment_rows=segment_rows).facts()
    want = brute(*damage(rows))
    assert got(found) == want
    assert any(", ''," in x for x in want) and all(any(letter in eval(x)[7] for x in want) for letter in "DKR")


def test_one_conversation_over_many_tasks(spark):
    """Half of all rows in one conversation, many of them alike: no task has them all."""
    rows = [(1, i, ["user", "assistant", "system"][i % 3 if i % 10 == 0 else i % 2], f"Text {i % 50}." if i % 7 else "") for i in range(400)] + [(1, 400, "user", "same?")] * 60
    rows += [(c, t, ["user", "assistant"][t % 2], f"Yes {t}") for c in range(2, 102) for t in range(4)]
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")  # else so few rows are one task's
    try:
        r = conversation_repair.repair(frame(spark, rows), segment_rows=50)
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    assert got(r.facts()) == brute({c for c, *_ in rows}, rows)
    assert r._pieces.filter("conv_id = 1").select("part").distinct().count() > 1
    lines = [f"{x['role']}:{x['text']}" for x in sorted(r.rows().filter("conv_id = 1").collect(), key=lambda x: (x["part"], x["seg"], x["at"]))]
    sha = {x["conv_id"]: x["repaired_sha256"] for x in r.facts().collect()}
    assert hashlib.sha256("\n".join(lines).encode()).hexdigest() == sha[1]


def test_empty_and_dropped(spark):
    assert conversation_repair.repair(frame(spark, [])).facts().collect() == []
    df = frame(spark, [(5, 0, "user", "Hi."), (5, 1, "assistant", "Yes.")]).selectExpr("*", "0 AS copies")
    assert got(conversation_repair.repair(df, copies_col="copies").facts()) == [repr((5, 0, 0, 0, 0, 0, 0, "", hashlib.sha256(b"").hexdigest()))]


def test_long_text_and_extreme_turns(spark):
    rows = [(1, -(2**63), "user", "y" * 6_000_000), (1, 2**63 - 1, "assistant", "z."), (2, 3, "user", "a."), (2, 9, "assistant", "b.")]
    facts = {r["conv_id"]: r for r in conversation_repair.repair(frame(spark, rows)).facts().collect()}
    assert facts[1]["gaps"] is None and facts[2]["gaps"] == 5
    assert facts[1]["audit"] == "DD" and facts[2]["audit"] == "KK"


def test_distances_by_relaxation():
    """Dial's distances equal those of relaxing every arc until nothing changes."""
    r = random.Random(5)
    for _ in range(200):
        codes = bytes(r.randrange(12) for _ in range(r.randrange(6)))
        goal, last = r.choice([((0, conversation_repair.FAR, conversation_repair.FAR, 0), True), ((0, 10, 5, 0), False), ((7, 2, 0, 3), False)])
        n = len(codes)
        want = [conversation_repair.FAR] * (4 * n) + list(goal)
        for _ in range(4 * n + 8):
            for node in range(4 * n + 4):
                place, s = divmod(node, 4)
                if place < n:
                    for _, cost, to in conversation_repair.FORWARD[codes[place]][s]:
                        want[node] = min(want[node], cost + want[4 * place + 4 + to])
                if place < n or last:
                    want[node] = min(want[node], 5 + want[4 * place + conversation_repair.NEXT[s]])
        assert [min(x, conversation_repair.FAR) for x in want] == conversation_repair.distances(codes, goal, last)


def test_query_equals_sql(spark, sf_dir):
    have, want = against_sql(spark, sf_dir, queries.op13_conversation_repair, queries.ORACLES["op13_conversation_repair"])
    assert have == want and len(have) >= 20
