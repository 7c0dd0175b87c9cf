"""Conversation structure repair: cheapest edits that make a conversation's roles alternate, by bidirectional Dijkstra.

A node of the edit lattice is (rows read, state of the repaired turns): nothing yet, after system, after user, after
assistant. From a node lead at most four edges, each with a letter of its own: Keep 0, Rerole to the role that may
follow 2, Delete 3, Insert an empty turn 2; a truncated row that stays adds 1; blank rows and repeats must go. One
heap grows from the start and one back from the accepting ends; when they have met, all crossings of equal cost are
finished, and the least audit is read off the edges that lie on any cheapest path. As letters differ at each node, an
audit names one path, and no audit between two nodes is the beginning of another of equal cost.

Rows are dealt by ranges of (conversation, turn), so that a conversation of any length is spread over tasks. A
conversation that lies whole inside a task is settled there. Of others each block of ``BLOCK`` rows is searched from
every state to every state, and one pass over the blocks, a row of each, puts them together; it holds four
running audits and hashes, never a conversation's texts.

Rows: nulls in role and text read as one space; turns order rows, nulls first, ties by role and then by the text's
SHA-256. Rows alike in conversation, turn, role and text are counted, not sorted. A null conversation id is a
conversation like any other. Other columns are left out, whatever their names. An empty table gives no rows.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator
from heapq import heappop, heappush
from itertools import chain

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tenantferry.session import materialise

BLOCK = 256
KEEP, REROLE, DELETE, INSERT, CUT = 0, 2, 3, 2, 1
EMPTY, SYSTEM, USER, ASSISTANT = range(4)
ACCEPTING = (EMPTY, ASSISTANT)
#: The state after a turn put in, or a turn whose role is changed; and its role.
NEXT = (USER, USER, ASSISTANT, USER)
ROLE = {USER: "user", ASSISTANT: "assistant"}
#: The state after a kept turn, by its role's first letter.
KEPT = {"s": {EMPTY: SYSTEM}, "u": {EMPTY: USER, SYSTEM: USER, ASSISTANT: USER}, "a": {USER: ASSISTANT}}
SPACES = " \t\n\x0b\x0c\r"
FAR = float("inf")

COUNTS = "blank long, duplicate long, truncated long, illegal long"
PARTS = "counts array<long>, roles array<string>, texts array<string>"


class Step:
    """A row that may stay (``times`` 0), or ``times`` rows that must go."""

    __slots__ = ("cut", "initial", "role", "text", "times")

    def __init__(self, role: str, text: str | None, times: int, cut: bool):
        self.role, self.text, self.times, self.cut, self.initial = role, text, times, cut, role[:1]


def edges(step: Step | None, state: int) -> list[tuple[str, int, int, int]]:
    """Letter, rows read, next state and cost of a node's edges, by letter."""
    if step is None:
        return [("I", 0, NEXT[state], INSERT)]
    if step.times:
        return [("D", 1, state, DELETE * step.times), ("I", 0, NEXT[state], INSERT)]
    out = [("D", 1, state, DELETE), ("I", 0, NEXT[state], INSERT)]
    kept = KEPT.get(step.initial, {}).get(state)
    if kept is not None:
        out.append(("K", 1, kept, KEEP + CUT * step.cut))
    out.append(("R", 1, NEXT[state], REROLE + CUT * step.cut))
    return out


def cheapest(steps: list[Step], entry: int, exits: tuple[int, ...]) -> tuple[int, str] | None:
    """Cost and least audit of the cheapest edits from ``entry`` to one of ``exits``; a run that must go is one letter here.

    None if no edits lead there: only a kept turn leads to the state after system, and none back to the empty one.
    """
    n = len(steps)
    out: dict[int, list] = {}
    into: dict[int, list] = {}

    def leaving(node: int) -> list:
        if node not in out:
            i, s = divmod(node, 4)
            out[node] = [(letter, 4 * (i + read) + t, w) for letter, read, t, w in edges(steps[i] if i < n else None, s)]
        return out[node]

    def entering(node: int) -> list:
        if node not in into:
            i = node // 4
            before = range(4 * max(0, i - 1), 4 * i + 4)
            into[node] = [(u, w) for u in before for _, v, w in leaving(u) if v == node]
        return into[node]

    start, goals = entry, {4 * n + x for x in exits}
    ahead, back = {start: 0}, dict.fromkeys(goals, 0)
    heap_a, heap_b = [(0, start)], [(0, g) for g in sorted(goals)]
    done_a: set[int] = set()
    done_b: set[int] = set()
    best = FAR
    # past the sum of both fronts no path can cross as cheaply; up to it, crossings of equal cost are finished too
    while heap_a and heap_b and heap_a[0][0] + heap_b[0][0] <= best:
        if heap_a[0][0] <= heap_b[0][0]:
            d, u = heappop(heap_a)
            if u in done_a:
                continue
            done_a.add(u)
            for _, v, w in leaving(u):
                if d + w < ahead.get(v, FAR):
                    ahead[v] = d + w
                    heappush(heap_a, (d + w, v))
                best = min(best, d + w + back.get(v, FAR))
        else:
            d, v = heappop(heap_b)
            if v in done_b:
                continue
            done_b.add(v)
            for u, w in entering(v):
                if d + w < back.get(u, FAR):
                    back[u] = d + w
                    heappush(heap_b, (d + w, u))
                best = min(best, d + w + ahead.get(u, FAR))
        if start in goals:
            best = min(best, 0)

    if best == FAR:
        return None
    # nodes settled from the start that lie on a cheapest path: rows read, then cost, is an order along every edge
    lead: set[int] = set()

    def good(u: int) -> Iterator[tuple[str, int, int]]:
        for letter, v, w in leaving(u):
            over = v in done_b and u in done_a and ahead[u] + w + back[v] == best
            along = v in lead and u in done_a and ahead[u] + w == ahead[v]
            down = u in done_b and v in done_b and w + back[v] == back[u]
            if over or along or down:
                yield letter, v, w

    for u in sorted(done_a, key=lambda x: (-(x // 4), -ahead[x])):
        if (u in goals and ahead[u] == best) or any(True for _ in good(u)):
            lead.add(u)
    u, spent, audit = start, 0, []
    while not (u in goals and spent == best):
        letter, u, w = next(good(u))
        audit.append(letter)
        spent += w
    return best, "".join(audit)


def written(steps: list[Step], audit: str) -> str:
    """The audit with a letter for each row of a run that must go."""
    if not any(s.times > 1 for s in steps):
        return audit
    rest, out = iter(steps), []
    for letter in audit:
        times = 1 if letter == "I" else next(rest).times
        out.append(letter * max(1, times))
    return "".join(out)


def turns(steps: list[Step], entry: int, audit: str) -> Iterator[tuple[str, str]]:
    """The repaired turns of the steps under a written audit."""
    state, rest, letters = entry, iter(steps), iter(audit)
    for letter in letters:
        if letter == "I":
            state = NEXT[state]
            yield ROLE[state], ""
            continue
        step = next(rest)
        if letter == "D":
            for _ in range(step.times - 1):
                next(letters)
        else:
            state = KEPT[step.initial][state] if letter == "K" else NEXT[state]
            yield (step.role if letter == "K" else ROLE[state]), step.text


class Block:
    """Rows of a conversation in order: what is counted, and the steps of its lattice."""

    def __init__(self):
        self.steps: list[Step] = []
        self.n = [0, 0, 0, 0]  # blank, duplicate, truncated, illegal
        self.first = self.last = None  # role initials
        self.low = self.high = None  # turns
        self.turns = 0
        self.order = None

    def add(self, turn, role: str, text: str, copies: int, seen: bool, key: str) -> None:
        if self.order is None:
            self.order, self.first = (turn, role, key), role[:1]
        else:
            self.n[3] += self.last + role[:1] not in ("su", "ua", "au")
        self.n[3] += copies - 1  # no role may follow itself
        self.last = role[:1]
        if turn is not None:
            self.turns += turn != self.high
            self.low, self.high = turn if self.low is None else self.low, turn
        body = text.strip(SPACES)
        if not body:
            self.n[0] += copies
            gone = copies
        else:
            gone = copies - (not seen)
            self.n[1] += gone
            if not seen:
                cut = body[-1] not in ".!?"
                self.n[2] += cut
                self.steps.append(Step(role, text, 0, cut))
        if gone:
            self.steps.append(Step(role, None, gone, False))


def _record(conv, block: Block, whole: bool, keep_texts: bool) -> dict:
    pairs = [(EMPTY, ACCEPTING)] if whole else [(s, (t,)) for s in range(4) for t in range(4)]
    found = [cheapest(block.steps, s, ends) for s, ends in pairs]
    audits = [written(block.steps, x[1]) if x else None for x in found]
    digest = hashlib.sha256("\n".join(f"{r}:{t}" for r, t in turns(block.steps, EMPTY, audits[0])).encode()) if whole else None
    kept = keep_texts or not whole
    return {
        "conv_id": conv, "turn": block.order[0], "role": block.order[1], "key": block.order[2], "whole": whole,
        "blank": block.n[0], "duplicate": block.n[1], "truncated": block.n[2], "illegal": block.n[3],
        "first": block.first, "last": block.last, "low": block.low, "high": block.high, "turns": block.turns,
        "costs": [x[0] if x else None for x in found], "audits": audits, "sha256": digest.hexdigest() if digest else None,
        "counts": [s.times for s in block.steps] if kept else None,
        "roles": [s.role for s in block.steps] if kept else None,
        "texts": [s.text for s in block.steps] if kept else None,
    }


def _rows(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
    for b in batches:
        yield from zip(*(c.to_pylist() for c in b.columns))


def _batches(records: Iterator[dict], schema: pa.Schema, size: int) -> Iterator[pa.RecordBatch]:
    held: list[dict] = []
    for r in records:
        held.append(r)
        if len(held) == size:
            yield pa.RecordBatch.from_pylist(held, schema)
            held = []
    if held:
        yield pa.RecordBatch.from_pylist(held, schema)


def _cut(schema: pa.Schema, block_rows: int, keep_texts: bool) -> Callable:
    def records(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
        block, conv, whole, begun = Block(), None, False, False
        for c, turn, role, text, copies, seen, key in _rows(batches):
            if not begun or c != conv:
                if begun:
                    yield _record(conv, block, whole, keep_texts)
                # the first and the last conversation of a task may go on in another
                block, conv, whole, begun = Block(), c, begun, True
            elif len(block.steps) >= block_rows:
                yield _record(conv, block, False, keep_texts)
                block, whole = Block(), False
            block.add(turn, role, text, copies, seen, key)
        if begun:
            yield _record(conv, block, False, keep_texts)

    return lambda batches: _batches(records(batches), schema, 64)


def _steps(counts: list[int], roles: list[str], texts: list[str]) -> list[Step]:
    return [Step(r, t, c, False) for c, r, t in zip(counts, roles, texts)]


class _Path:
    """The cheapest way to a state so far: cost, the part of the audit in which the ways differ, hash of the turns."""

    def __init__(self, cost: float, tail: str, digest, some: bool, pieces: tuple):
        self.cost, self.tail, self.digest, self.some, self.pieces = cost, tail, digest, some, pieces


def _fold(schema: pa.Schema, with_pieces: bool) -> Callable:
    """Puts the blocks of each conversation together; with pieces, one record for each block with its entry and audit."""
    def advance(paths: list[_Path | None], r: dict, steps: list[Step]) -> list[_Path | None]:
        out = []
        for t in range(4):
            ways = [(p.cost + r["costs"][4 * s + t], p.tail + r["audits"][4 * s + t], s) for s, p in enumerate(paths) if p and r["costs"][4 * s + t] is not None]
            if not ways:
                out.append(None)
                continue
            cost, tail, s = min(ways)
            old, audit = paths[s], r["audits"][4 * s + t]
            digest, some = old.digest.copy(), old.some
            for role, text in turns(steps, s, audit):
                digest.update(f"{chr(10) if some else ''}{role}:{text}".encode())
                some = True
            piece = ((s, audit, r["turn"], r["role"], r["key"]), old.pieces) if with_pieces else ()
            out.append(_Path(cost, tail, digest, some, piece))
        return out

    def finish(conv, paths: list[_Path | None], shared: list[str], sums: dict) -> Iterator[dict]:
        best = min((paths[s] for s in ACCEPTING if paths[s]), key=lambda p: (p.cost, p.tail))
        if with_pieces:
            at, listed = best.pieces, []
            while at:
                listed.append(at[0])
                at = at[1]
            for entry, audit, turn, role, key in reversed(listed):
                yield {"conv_id": conv, "entry": entry, "audit": audit, "turn": turn, "role": role, "key": key}
            return
        gaps = sums["high"] - sums["low"] + 1 - sums["turns"] if sums["low"] is not None else 0
        yield {"conv_id": conv, "gaps": gaps, **{k: sums[k] for k in ("blank", "duplicate", "truncated", "illegal")},
               "cost": best.cost, "audit": "".join([*shared, best.tail]), "sha256": best.digest.hexdigest()}

    def records(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
        conv, paths, shared, sums = None, None, [], {}
        for r in chain.from_iterable(b.to_pylist() for b in batches):
            if paths is None or r["conv_id"] != conv:
                if paths is not None:
                    yield from finish(conv, paths, shared, sums)
                conv, shared = r["conv_id"], []
                paths = [_Path(0, "", hashlib.sha256(), False, ()), None, None, None]
                sums = dict.fromkeys(("blank", "duplicate", "truncated", "illegal", "turns"), 0) | {"low": None, "high": None, "last": None}
            else:
                sums["illegal"] += sums["last"] + r["first"] not in ("su", "ua", "au")
            for k in ("blank", "duplicate", "truncated", "illegal", "turns"):
                sums[k] += r[k]
            if r["low"] is not None:
                sums["turns"] -= r["low"] == sums["high"]
                sums["low"], sums["high"] = r["low"] if sums["low"] is None else sums["low"], r["high"]
            sums["last"] = r["last"]
            paths = advance(paths, r, _steps(r["counts"], r["roles"], r["texts"]))
            live = [p for p in paths if p]
            same = _common([p.tail for p in live])
            shared.append(same)
            for p in live:
                p.tail = p.tail[len(same):]
        if paths is not None:
            yield from finish(conv, paths, shared, sums)

    return lambda batches: _batches(records(batches), schema, 64)


def _common(texts: list[str]) -> str:
    low, high = min(texts), max(texts)
    n = next((i for i, (a, b) in enumerate(zip(low, high)) if a != b), min(len(low), len(high)))
    return low[:n]


def damaged(conversations: DataFrame) -> DataFrame:
    """``conv_id, turn, role, text, copies`` after the damage that CRC-32 of ``conv_id:turn`` deals out."""
    space = F.lit(" ")
    text = F.coalesce("text", space)
    kind = F.crc32(F.concat(*(F.coalesce(F.col(c).cast("string"), space) if c else F.lit(":") for c in ("conv_id", "", "turn"))).cast("binary")) % 20
    return conversations.where(kind != 0).select(
        "conv_id", "turn", F.when(kind == 4, "user").otherwise(F.coalesce("role", space)).alias("role"),
        F.when(kind == 1, "").when(kind == 2, F.regexp_replace(text, "[.!?]", "")).otherwise(text).alias("text"),
        F.when(kind == 3, 2).otherwise(1).cast("long").alias("copies"))


def _sorted_rows(rows: DataFrame) -> DataFrame:
    """Alike rows as one, each marked if its role and text were seen before, dealt and sorted by conversation and turn."""
    keyed = rows.select(
        "conv_id", "turn", F.coalesce("role", F.lit(" ")).alias("role"), F.coalesce("text", F.lit(" ")).alias("text"),
        F.coalesce(F.col("copies").cast("long"), F.lit(1)).alias("copies"),
    ).withColumn("key", F.sha2(F.col("text").cast("binary"), 256))
    alike = ["conv_id", "turn", "role", "key"]
    counted = keyed.groupBy(*alike).agg(F.first("text").alias("text"), F.sum("copies").alias("copies"))
    # the join's key holds the turn too, so a reply that fills half a conversation is spread over tasks
    first = keyed.groupBy("conv_id", "role", "key").agg(F.min(F.struct(F.col("turn").isNotNull().alias("known"), "turn")).alias("at"))
    first = first.select(F.col("conv_id").alias("c"), F.col("at.turn").alias("t"), F.col("role").alias("r"), F.col("key").alias("k"))
    same = [F.col(a).eqNullSafe(F.col(b)) for a, b in zip(alike, "ctrk")]
    marked = counted.join(first, same, "left").select("conv_id", "turn", "role", "text", "copies", F.col("k").isNull().alias("seen"), "key")
    return marked.repartitionByRange("conv_id", "turn", "role", "key").sortWithinPartitions("conv_id", "turn", "role", "key")


def blocks(rows: DataFrame, block_rows: int = BLOCK, keep_texts: bool = False) -> DataFrame:
    """One record for each conversation that lies whole in a task and for each block of the others, written once."""
    dealt = _sorted_rows(rows)
    conv, turn = dealt.schema["conv_id"].dataType.simpleString(), dealt.schema["turn"].dataType.simpleString()
    shape = T.StructType.fromDDL(
        f"conv_id {conv}, turn {turn}, role string, key string, whole boolean, {COUNTS}, first string, last string, low {turn}, high {turn}, "
        f"turns long, costs array<long>, audits array<string>, sha256 string, {PARTS}")
    return materialise(dealt.mapInArrow(_cut(_arrow(shape), block_rows, keep_texts), shape), "lattice")


def _arrow(shape: T.StructType) -> pa.Schema:
    from pyspark.sql.pandas.types import to_arrow_schema

    return to_arrow_schema(shape)


def _open_in_order(found: DataFrame) -> DataFrame:
    cut = found.where(~F.col("whole"))
    return cut.repartition("conv_id").sortWithinPartitions("conv_id", "turn", "role", "key")


def summary(found: DataFrame) -> DataFrame:
    """Per conversation that has rows: gaps, faults, cost, audit and the hash of its repaired ``role:text`` lines."""
    conv = found.schema["conv_id"].dataType.simpleString()
    shape = T.StructType.fromDDL(f"conv_id {conv}, gaps long, {COUNTS}, cost long, audit string, sha256 string")
    settled = found.where("whole").select(
        "conv_id", F.coalesce(F.col("high") - F.col("low") + 1 - F.col("turns"), F.lit(0)).cast("long").alias("gaps"),
        "blank", "duplicate", "truncated", "illegal", F.col("costs")[0].alias("cost"), F.col("audits")[0].alias("audit"), "sha256")
    return settled.unionByName(_open_in_order(found).mapInArrow(_fold(_arrow(shape), False), shape))


def repaired_turns(found: DataFrame) -> DataFrame:
    """The repaired turns, ``conv_id, at, turns``: a row for each record, ``at`` the place of its first row; needs ``keep_texts``."""
    types = {c: found.schema[c].dataType.simpleString() for c in ("conv_id", "turn")}
    shape = T.StructType.fromDDL(f"conv_id {types['conv_id']}, entry int, audit string, turn {types['turn']}, role string, key string")
    path = _open_in_order(found).mapInArrow(_fold(_arrow(shape), True), shape)
    on = ["conv_id", "turn", "role", "key"]
    cut = found.where(~F.col("whole"))
    joined = cut.join(path, [cut[c].eqNullSafe(path[c]) for c in on]).select(*(cut[c] for c in [*on, "counts", "roles", "texts"]), "entry", "audit")
    settled = found.where("whole").select(*on, "counts", "roles", "texts", F.lit(EMPTY).alias("entry"), F.col("audits")[0].alias("audit"))
    done = T.StructType.fromDDL(f"conv_id {types['conv_id']}, at struct<turn: {types['turn']}, role: string, key: string>, turns array<struct<role: string, text: string>>")

    def spell(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
        for r in chain.from_iterable(b.to_pylist() for b in batches):
            made = turns(_steps(r["counts"], r["roles"], r["texts"]), r["entry"], r["audit"])
            yield {"conv_id": r["conv_id"], "at": {k: r[k] for k in ("turn", "role", "key")}, "turns": [{"role": a, "text": b} for a, b in made]}

    schema = _arrow(done)
    return settled.unionByName(joined).mapInArrow(lambda batches: _batches(spell(batches), schema, 64), done)


def repair(rows: DataFrame, block_rows: int = BLOCK) -> DataFrame:
    """``summary`` of rows ``conv_id, turn, role, text, copies``."""
    return summary(blocks(rows, block_rows))


def conversations(table: DataFrame, block_rows: int = BLOCK) -> DataFrame:
    """Every conversation of the table, damaged and repaired; one without rows after the damage has zeros and empty texts."""
    ids = table.select("conv_id").distinct()
    found = repair(damaged(table), block_rows)
    joined = ids.join(found.withColumnRenamed("conv_id", "__conv"), F.col("conv_id").eqNullSafe(F.col("__conv")), "left")
    zeros = (F.coalesce(c, F.lit(0)).cast("long").alias(c) for c in ("gaps", "blank", "duplicate", "truncated", "illegal", "cost"))
    return joined.select(
        "conv_id", *zeros, F.coalesce("audit", F.lit("")).alias("audit"),
        F.coalesce("sha256", F.lit(hashlib.sha256().hexdigest())).alias("repaired_sha256"))
