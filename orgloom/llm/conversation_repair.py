"""Repair of the structure of conversations by shortest paths.

Edits (Delete a row, Insert an empty turn, Keep a row, Rerole it) turn the initials of a conversation's roles into
``(s?(ua)+)?``. A node is a place between rows and a state of that pattern; an arc is an edit, with a cost of 0 to 6.
Dial's queue of buckets gives each node its distance to the end, going backwards; then a walk
from the start takes, of the arcs that lie on a shortest path, the one of least letter.

Rows are sorted over the whole table by conversation and turn, so a task has a stretch of the order, and a conversation that is
larger than a task is in several. A task packs its rows into segments of bounded size. Most conversations are
one segment, and are solved where they lie. Of the others, each segment gives the cost from each state at its beginning to each at
its end; these small matrices, joined backwards, give the distances at each segment's end; and its walks
from each state, joined forwards, the state that it begins in. So no task holds a whole conversation.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import bound_batches, materialize, tidied

#: Rows and bytes of text of a segment, at most (one longer text is a segment of its own size).
SEGMENT_ROWS, SEGMENT_BYTES = 1 << 16, 4 << 20
BLANKS = " \t\n\x0b\x0c\r"
ENDS = ".!?"
#: Costs of edits, and of a truncated row that stays.
REROLE, DELETE, INSERT, TRUNCATED = 1, 2, 5, 5
FAR = 1 << 60
#: States: nothing yet, after s, after u, after a. Where a user or assistant turn leads from each; where a row's own initial does.
START, USER, ASSISTANT = 0, 2, 3
NEXT = (USER, USER, ASSISTANT, USER)
INITIALS = {"s": 1, "u": 2, "a": 3}
KEPT = {(0, 1): 1, (0, 2): 2, (1, 2): 2, (2, 3): 3, (3, 2): 2}
LEGAL = {(1, 2), (2, 3), (3, 2)}
#: A row's code is its initial (0 for any other) and four times what is wrong: 0 nothing, 1 truncated, 2 blank or duplicate.
WHOLE, CUT, MUST_GO = 0, 4, 8
#: Distances to the end behind the last row.
GOAL = (0, FAR, FAR, 0)


def _forward() -> list[list[list[tuple[str, int, int]]]]:
    """By code and state: (letter, cost, next state) of the edits of a row, in order of letters."""
    table = []
    for code in range(12):
        initial, fault = code % 4, code - code % 4
        more = TRUNCATED if fault == CUT else 0
        rows = []
        for state in range(4):
            arcs = [("D", DELETE, state)]
            if fault != MUST_GO:
                if (state, initial) in KEPT:
                    arcs.append(("K", more, KEPT[state, initial]))
                arcs.append(("R", REROLE + more, NEXT[state]))
            rows.append(arcs)
        table.append(rows)
    return table


FORWARD = _forward()
BACKWARD = [[[(a, cost) for a in range(4) for _, cost, b in rows[a] if b == to] for to in range(4)] for rows in FORWARD]
INSERTED = [[a for a in range(4) if NEXT[a] == to] for to in range(4)]
LONGEST = REROLE + TRUNCATED


def distances(codes: bytes, goal: tuple[int, ...] | list[int], last: bool) -> list[int]:
    """Distance to the end of node (place, state), at 4 * place + state. Turns are inserted behind the last row only if ``last``."""
    n = len(codes)
    dist = [FAR] * (4 * n + 4)
    size = max(g for g in goal if g < FAR) + LONGEST + 1
    buckets: list[list[int]] = [[] for _ in range(size)]
    waiting = 0
    for state, g in enumerate(goal):
        if g < FAR:
            dist[4 * n + state] = g
            buckets[g].append(4 * n + state)
            waiting += 1
    d = 0
    while waiting:
        bucket = buckets[d % size]
        while bucket:
            node = bucket.pop()
            waiting -= 1
            if dist[node] != d:
                continue
            place, state = divmod(node, 4)
            found = [(4 * place - 4 + a, d + cost) for a, cost in BACKWARD[codes[place - 1]][state]] if place else []
            if place < n or last:
                found += [(4 * place + a, d + INSERT) for a in INSERTED[state]]
            for other, far in found:
                if far < dist[other]:
                    dist[other] = far
                    buckets[far % size].append(other)
                    waiting += 1
        d += 1
    return dist


def walk(codes: bytes, dist: list[int], state: int, last: bool) -> tuple[str, list[int]]:
    """(letters of the edits, states after each), by the arc of least letter of those on a shortest path."""
    n, place, letters, states = len(codes), 0, [], []
    while place < n or (last and dist[4 * n + state]):
        d = dist[4 * place + state]
        arcs = FORWARD[codes[place]][state] if place < n else []
        insert = ("I", INSERT, NEXT[state])
        for letter, cost, to in [*arcs[:1], insert, *arcs[1:]]:
            at = place + (letter != "I")
            if dist[4 * at + to] + cost == d:
                letters.append(letter)
                states.append(to)
                place, state = at, to
                break
        else:
            raise ValueError("no arc leads on")
    return "".join(letters), states


def edited(letters: str, states: list[int], roles: list[str], texts: list[str]) -> tuple[list[str], list[str]]:
    """Roles and texts of the repaired rows."""
    out_roles, out_texts, at = [], [], 0
    for letter, state in zip(letters, states, strict=True):
        if letter != "D":
            out_roles.append(roles[at] if letter == "K" else "user" if state == USER else "assistant")
            out_texts.append("" if letter == "I" else texts[at])
        at += letter != "I"
    return out_roles, out_texts


def code_of(role: str, text: str, seen: bool) -> int:
    bare = text.rstrip(BLANKS)
    fault = MUST_GO if not bare or seen else WHOLE if bare[-1] in ENDS else CUT
    return INITIALS.get(role[:1], 0) + fault


# --------------------------------------------------------------------------
# segments

PACKED = "part int, seg long, edge boolean, codes binary, blank long, keys array<binary>, first_turn long, last_turn long, n_turns long, roles array<string>, texts array<string>"


def _batch(rows: list[dict], names: list[str], types: list[pa.DataType]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array([r[k] for r in rows], t) for k, t in zip(names, types, strict=True)], names)


def packed(rows: DataFrame, segment_rows: int, segment_bytes: int) -> DataFrame:
    """A written table of segments of ``rows`` (conv_id, turn, role, text, copies), whose (part, seg) say their order.

    edge: the conversation may have other segments. keys: of those, a digest of each row's role and text."""
    order = [F.col("conv_id").asc_nulls_first(), F.col("turn").asc_nulls_first(), "head", "begin", "h"]
    # What the sort looks at is short, and copies of a row, however many, are dealt out by the last column.
    keyed = rows.select("*", F.substring("role", 1, 16).alias("head"), F.substring("text", 1, 32).alias("begin"), F.xxhash64("role", "text").alias("h"), F.pmod(F.monotonically_increasing_id(), F.lit(1024)).alias("salt"))
    dealt = keyed.repartitionByRange(*order, "salt").sortWithinPartitions(*order).select("conv_id", "turn", "role", "text", "copies")
    kind = rows.schema["conv_id"].dataType.simpleString()
    names = ["conv_id", *[x.split()[0] for x in PACKED.split(", ")]]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, seg, runs, size, out, types = TaskContext.get().partitionId(), 0, 0, 0, [], None
        now: dict | None = None
        seen: set[tuple[str, str]] = set()

        def closed(edge: bool) -> None:
            nonlocal seg, size
            if edge:
                now["edge"] = True
                now["keys"] = [hashlib.md5(f"{len(r)}:{r}{t}".encode()).digest() for r, t in zip(now["roles"], now["texts"], strict=True)]
            now["codes"] = bytes(now["codes"])
            now["seg"] = seg
            seg += 1
            size += now.pop("bytes")
            out.append(now)

        def opened(conv: object) -> dict:
            seen.clear()
            return {"conv_id": conv, "part": part, "edge": False, "codes": bytearray(), "blank": 0, "keys": None, "first_turn": None, "last_turn": None, "n_turns": 0, "roles": [], "texts": [], "bytes": 0}

        for b in batches:
            types = types or [b.column(0).type, pa.int32(), pa.int64(), pa.bool_(), pa.binary(), pa.int64(), pa.list_(pa.binary()), pa.int64(), pa.int64(), pa.int64(), pa.list_(pa.string()), pa.list_(pa.string())]
            for conv, turn, role, text, copies in zip(*[c.to_pylist() for c in b.columns], strict=True):
                if now is None:
                    now = opened(conv)
                elif now["conv_id"] != conv:
                    closed(now["edge"] or runs == 0)
                    runs += 1
                    now = opened(conv)
                for _ in range(copies):
                    if now["codes"] and (len(now["codes"]) >= segment_rows or now["bytes"] + len(text) > segment_bytes):
                        closed(True)
                        now = opened(conv)
                        now["edge"] = True
                    code = code_of(role, text, (role, text) in seen)
                    seen.add((role, text))
                    now["blank"] += not text.strip(BLANKS)
                    now["codes"].append(code)
                    now["roles"].append(role)
                    now["texts"].append(text)
                    now["bytes"] += len(text) + 64
                    if turn is not None:
                        if now["first_turn"] is None:
                            now["first_turn"] = turn
                        now["n_turns"] += now["last_turn"] != turn
                        now["last_turn"] = turn
                if size >= segment_bytes:
                    yield _batch(out, names, types)
                    out, size = [], 0
        if now is not None:
            closed(True)
            yield _batch(out, names, types)

    return materialize(dealt.mapInArrow(tidied(run), f"conv_id {kind}, {PACKED}"), "segments")


# --------------------------------------------------------------------------
# conversations of several segments

def _narrow(pieces: DataFrame) -> DataFrame:
    """(conv_id, part, seg, codes) of the pieces, with rows that an earlier segment has marked as duplicates."""
    keys = pieces.select("conv_id", "part", "seg", F.posexplode("keys").alias("at", "key"))
    first = keys.groupBy("conv_id", "key").agg(F.min(F.struct("part", "seg")).alias("first"))
    held = keys.groupBy("conv_id", "key", "part", "seg").agg(F.min("at").alias("at"))  # later ones in the segment are marked already
    met = held.alias("h").join(first.alias("f"), F.col("h.conv_id").eqNullSafe(F.col("f.conv_id")) & (F.col("h.key") == F.col("f.key")))
    again = met.filter(F.struct("part", "seg") != F.col("first")).groupBy("part", "seg").agg(F.collect_list("at").alias("again"))
    kind = pieces.schema["conv_id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            out = []
            for codes, again in zip(b.column(3).to_pylist(), b.column(4).to_pylist(), strict=True):
                codes = bytearray(codes)
                for at in again or ():
                    codes[at] = codes[at] % 4 + MUST_GO
                out.append(bytes(codes))
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), b.column(2), pa.array(out, pa.binary())], ["conv_id", "part", "seg", "codes"])

    joined = pieces.select("conv_id", "part", "seg", "codes").join(again, ["part", "seg"], "left").select("conv_id", "part", "seg", "codes", "again")
    return materialize(joined.mapInArrow(run, f"conv_id {kind}, part int, seg long, codes binary"), "narrow")


def _ends(narrow: DataFrame) -> DataFrame:
    """(part, seg, ends array<long>, last): the distances at the end of each segment, from the costs of crossing those behind it."""

    def crossed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            out = []
            for codes in b.column(3).to_pylist():
                by_end = [distances(codes, [0 if t == s else FAR for t in range(4)], False)[:4] for s in range(4)]
                out.append([by_end[t][s] for s in range(4) for t in range(4)])
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), b.column(2), pa.array(out, pa.list_(pa.int64()))], ["conv_id", "part", "seg", "costs"])

    def backwards(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            rows = []
            for group in b.column(0).to_pylist():
                ends, last = [0, 2 * INSERT, INSERT, 0], True
                for x in reversed(group):
                    rows.append({"part": x["part"], "seg": x["seg"], "ends": list(GOAL) if last else ends, "last": last})
                    ends = [min(FAR, *(x["costs"][4 * s + t] + ends[t] for t in range(4))) for s in range(4)]
                    least, last = min(ends), False
                    ends = [min(e - least, FAR) if e < FAR else FAR for e in ends]
            yield _batch(rows, ["part", "seg", "ends", "last"], [pa.int32(), pa.int64(), pa.list_(pa.int64()), pa.bool_()])

    kind = narrow.schema["conv_id"].dataType.simpleString()
    costs = narrow.mapInArrow(crossed, f"conv_id {kind}, part int, seg long, costs array<long>")
    grouped = costs.groupBy("conv_id").agg(F.array_sort(F.collect_list(F.struct("part", "seg", "costs"))).alias("g"))  # 16 numbers for each segment
    return grouped.select("g").mapInArrow(backwards, "part int, seg long, ends array<long>, last boolean")


def _begins(narrow: DataFrame, ends: DataFrame) -> DataFrame:
    """(part, seg, codes, ends, last, begin): the state that each segment begins in, from where walks through those before it lead."""

    def walked(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            out = []
            for codes, goal, last in zip(b.column(3).to_pylist(), b.column(4).to_pylist(), b.column(5).to_pylist(), strict=True):
                dist = distances(codes, goal, last)
                out.append([([s, *walk(codes, dist, s, last)[1]][-1] if dist[s] < FAR else -1) for s in range(4)])
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), b.column(2), pa.array(out, pa.list_(pa.int64()))], ["conv_id", "part", "seg", "to"])

    def forwards(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            rows = []
            for group in b.column(0).to_pylist():
                state = START
                for x in group:
                    rows.append({"part": x["part"], "seg": x["seg"], "begin": state})
                    state = x["to"][state]
            yield _batch(rows, ["part", "seg", "begin"], [pa.int32(), pa.int64(), pa.int32()])

    kind = narrow.schema["conv_id"].dataType.simpleString()
    known = narrow.join(ends, ["part", "seg"]).select("conv_id", "part", "seg", "codes", "ends", "last")
    grouped = known.mapInArrow(walked, f"conv_id {kind}, part int, seg long, to array<long>").groupBy("conv_id").agg(F.array_sort(F.collect_list(F.struct("part", "seg", "to"))).alias("g"))
    begins = grouped.select("g").mapInArrow(forwards, "part int, seg long, begin int")
    return known.select("part", "seg", F.col("codes").alias("marked"), "ends", "last").join(begins, ["part", "seg"])


# --------------------------------------------------------------------------
# results

SOLVED = "part int, seg long, codes binary, blank long, first_turn long, last_turn long, n_turns long, cost long, audit string, roles array<string>, texts array<string>"
_SOLVED = [x.split()[0] for x in SOLVED.split(", ")]
FACTS = "gaps long, blank long, duplicate long, truncated long, illegal long, cost long, audit string, repaired_sha256 string"
_FACTS = [x.split()[0] for x in FACTS.split(", ")]


def _solve(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Segments (.., roles, texts, ends, last, begin) with their edits done."""
    strings = pa.list_(pa.string())
    for b in batches:
        out = []
        for r in b.select([i for i in range(b.num_columns) if i]).to_pylist():
            goal, last, begin = (r["ends"], r["last"], r["begin"]) if r["ends"] else (GOAL, True, START)
            dist = distances(r["codes"], goal, last)
            audit, states = walk(r["codes"], dist, begin, last)
            roles, texts = edited(audit, states, r["roles"], r["texts"])
            spent = dist[begin] - (0 if last else goal[[begin, *states][-1]])
            out.append({**r, "cost": spent, "audit": audit, "roles": roles, "texts": texts})
        types = [pa.int32(), pa.int64(), pa.binary(), *[pa.int64()] * 5, pa.string(), strings, strings]
        solved = _batch(out, _SOLVED, types)
        yield pa.RecordBatch.from_arrays([b.column(0), *solved.columns], ["conv_id", *_SOLVED])


def _folded(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """One row of facts for each conversation, whose solved segments follow each other."""
    now: dict | None = None
    kind = None

    def done() -> dict:
        span = now["max"] - now["min"] + 1 - now["turns"] if now["min"] is not None else 0
        return {**now, "gaps": span if span < 1 << 63 else None, "repaired_sha256": now["sha"].hexdigest(), "audit": "".join(now["audit"])}

    for b in batches:
        kind, out = b.column(0).type, []
        for r in b.to_pylist():
            if now is None or now["conv_id"] != r["conv_id"]:
                if now is not None:
                    out.append(done())
                now = {"conv_id": r["conv_id"], "min": None, "max": None, "turns": 0, **{k: 0 for k in ("blank", "duplicate", "truncated", "illegal", "cost")}, "audit": [], "sha": hashlib.sha256(), "before": None, "some": False}
            codes = r["codes"]
            initials = [c % 4 for c in codes]
            if codes:
                pairs = zip([now["before"], *initials[:-1]] if now["before"] is not None else initials[:-1], initials if now["before"] is not None else initials[1:], strict=True)
                now["illegal"] += sum(p not in LEGAL for p in pairs)
                now["before"] = initials[-1]
            now["blank"] += r["blank"]
            now["duplicate"] += sum(c >= MUST_GO for c in codes) - r["blank"]
            now["truncated"] += sum(CUT <= c < MUST_GO for c in codes)
            now["cost"] += r["cost"]
            now["audit"].append(r["audit"])
            if r["first_turn"] is not None:
                now["turns"] += r["n_turns"] - (now["max"] == r["first_turn"])
                now["min"] = r["first_turn"] if now["min"] is None else now["min"]
                now["max"] = r["last_turn"]
            for role, text in zip(r["roles"], r["texts"], strict=True):
                now["sha"].update(f"{chr(10) if now['some'] else ''}{role}:{text}".encode())
                now["some"] = True
        if out:
            yield _batch(out, ["conv_id", *_FACTS], [kind, *[pa.int64()] * 6, pa.string(), pa.string()])
    if now is not None:
        yield _batch([done()], ["conv_id", *_FACTS], [kind, *[pa.int64()] * 6, pa.string(), pa.string()])


class Repair:
    """What ``repair`` has found; ``facts`` and ``rows`` give it as tables."""

    def __init__(self, whole: DataFrame, pieces: DataFrame):
        self._whole, self._pieces = whole, pieces
        self._kind = whole.schema["conv_id"].dataType.simpleString()

    def facts(self) -> DataFrame:
        """(conv_id, gaps, blank, duplicate, truncated, illegal, cost long, audit, repaired_sha256): one row for each conversation.

        A conversation of one segment is worked on in place; the segments of another are read in order, one at a time."""
        schema = f"conv_id {self._kind}, {FACTS}"
        one = self._whole.mapInArrow(tidied(lambda batches: _folded(_solve(batches))), schema)
        solved = self._pieces.mapInArrow(tidied(_solve), f"conv_id {self._kind}, {SOLVED}")
        ordered = solved.repartition("conv_id").sortWithinPartitions(F.col("conv_id").asc_nulls_first(), "part", "seg")
        return one.unionByName(ordered.mapInArrow(tidied(_folded), schema))

    def rows(self) -> DataFrame:
        """(conv_id, part, seg, at, role, text): the repaired rows; (part, seg, at) is their order."""
        solved = self._whole.unionByName(self._pieces).mapInArrow(tidied(_solve), f"conv_id {self._kind}, {SOLVED}")
        both = solved.select("conv_id", "part", "seg", F.posexplode(F.arrays_zip("roles", "texts")).alias("at", "x"))
        return both.select("conv_id", "part", "seg", "at", F.col("x.roles").alias("role"), F.col("x.texts").alias("text"))


def repair(turns: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role", text_col: str = "text", copies_col: str | None = None, segment_rows: int = SEGMENT_ROWS, segment_bytes: int = SEGMENT_BYTES) -> Repair:
    """The cheapest edits of each conversation; ties go to the least letters, in ASCII.

    Rows are in order of turn, nulls first, then of role (16 characters), text (32 characters) and a hash of both. A row's first
    fault counts: blank, duplicate (its role and text were seen earlier), truncated (its last sign is none of ``.!?``). Keep costs 0,
    Rerole 1, Delete 2 (the only edit of blank and duplicate rows), Insert 5, and a truncated row that stays 5 more.
    Null roles and texts are one space; a role of no initial s, u or a can't be kept; a null id is a conversation
    too; repeated rows are duplicates; gaps of turns that don't fit a long are null; an empty table gives an empty
    result; other columns are not looked at. ``copies_col`` says how often a row stands (0: its conversation alone counts)."""
    bound_batches(turns.sparkSession)
    string = lambda c: F.coalesce(F.col(f"`{c}`").cast("string"), F.lit(" "))
    copies = F.coalesce(F.col(f"`{copies_col}`").cast("int"), F.lit(1)) if copies_col else F.lit(1)
    rows = turns.select(F.col(f"`{conv_col}`").alias("conv_id"), F.col(f"`{turn_col}`").cast("long").alias("turn"), string(role_col).alias("role"), string(text_col).alias("text"), copies.alias("copies"))
    segments = packed(rows, segment_rows, segment_bytes)
    several = materialize(segments.filter("edge").groupBy("conv_id").count().filter("count > 1").select(F.col("conv_id").alias("of")), "several")  # a few for each task
    same = F.col("conv_id").eqNullSafe(F.col("of"))
    base = ["conv_id", "part", "seg", "codes", "blank", "first_turn", "last_turn", "n_turns", "roles", "texts"]
    whole = segments.join(several, same, "left_anti").select(*base, F.lit(None).cast("array<long>").alias("ends"), F.lit(True).alias("last"), F.lit(START).alias("begin"))
    pieces = segments.filter("edge").join(several, same, "left_semi")
    narrow = _narrow(pieces)
    known = materialize(_begins(narrow, _ends(narrow)), "known")
    marked = pieces.join(known, ["part", "seg"]).select(*[F.col("marked").alias("codes") if c == "codes" else c for c in base], "ends", "last", "begin")
    return Repair(whole, marked)


def damaged(turns: DataFrame) -> DataFrame:
    """``turns`` (conv_id, turn, role, text) with the faults that crc32 of ``conv_id:turn`` deals out, and copies; nulls are one space.

    By the remainder of 20: 0 drops the row (copies 0), 1 empties its text, 2 takes its sentence ends away, 3 repeats it
    (copies 2), 4 makes it a user's. Native."""
    string = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(" "))
    fault = F.crc32(F.concat(string("conv_id"), F.lit(":"), string("turn")).cast("binary")) % 20
    text = F.when(fault == 1, "").when(fault == 2, F.translate(string("text"), ENDS, "")).otherwise(string("text"))
    return turns.select("conv_id", "turn", F.when(fault == 4, "user").otherwise(string("role")).alias("role"), text.alias("text"), F.when(fault == 0, 0).when(fault == 3, 2).otherwise(1).alias("copies"))
