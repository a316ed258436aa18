"""Conversations repaired to ``(s?(ua)+)?``: the cheapest edits by depth-first branch and bound.

Rows are put in order by ranges, so even a conversation that fills many partitions is cut into
blocks of bounded size. Each block is searched on its own: an explicit stack of prefixes, lower
bounds of what the rest must cost, the best (cost, audit) so far, and per node the best prefix
that reached it. Blocks are then joined by the role they end with, which is all that the next
one depends on.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterable, Iterator
from dataclasses import dataclass, field

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import small_batches, written

BLOCK = 128
KEEP, REROLE, DELETE, INSERT, CUT = 0, 2, 3, 2, 1
# What a prefix ends with: nothing, a system, a user or an assistant row.
NONE, SYSTEM, USER, ASSISTANT = range(4)
NAMES = {USER: "user", ASSISTANT: "assistant"}
# The role a rerole or an insert gives, by what stands before.
NEXT = {NONE: USER, SYSTEM: USER, USER: ASSISTANT, ASSISTANT: USER}
# Inserts that end a conversation.
TAIL = {NONE: "", SYSTEM: "II", USER: "I", ASSISTANT: ""}
BLANKS = "[^\\x20\\x09-\\x0D]"


@dataclass(frozen=True)
class Item:
    """One row as the search sees it: what its role is, if it is cut off, if it must go, and how
    many equal rows follow it (which must go)."""

    role: int | None
    truncated: bool = False
    forced: bool = False
    extra: int = 0


def _after(state: int, role: int | None) -> bool:
    return role == NEXT[state] or (state == NONE and role == SYSTEM)


def suffix_bounds(items: list[Item]) -> list[int]:
    """Least cost of the rows from each place on: forced deletions, cut-off rows, and disjoint
    pairs of neighbours (or single rows) that cannot both stay as they are."""
    out, clash, following = [0], 0, None
    base = 0
    for item in reversed(items):
        base += DELETE * item.extra
        if item.forced:
            base += DELETE
        else:
            base += CUT * item.truncated
            if item.role is None:
                clash, following = clash + 1, None
            elif following is not None and not (NEXT[item.role] == following):
                clash, following = clash + 1, None
            else:
                following = item.role
        out.append(base + REROLE * clash)
    return out[::-1]


def search(items: list[Item], entry: int, goal: int | None) -> tuple[int, str] | None:
    """The cheapest (cost, audit), ASCII-least among equals, that takes the state ``entry`` over
    all items to ``goal``; without a goal, to a proper end of the conversation."""
    if goal is not None and goal < entry and not (entry == ASSISTANT and goal == USER):
        return None
    bounds = suffix_bounds(items)
    # A first answer, cheapest step first; then all others in the order of their audits.
    best = _walk(items, bounds, entry, goal, None)
    return best and _walk(items, bounds, entry, goal, best)


def _lost(state: int, goal: int | None) -> bool:
    return goal in (NONE, SYSTEM) and state > goal


def _walk(items, bounds, entry, goal, best):
    n, hasty = len(items), best is None
    reached: dict[tuple[int, int], tuple[int, str]] = {}
    stack = [(0, entry, 0, "")]
    while stack:
        i, state, cost, audit = stack.pop()
        if _lost(state, goal):
            continue
        if best is not None:
            least = cost + bounds[i]
            if least > best[0] or (least == best[0] and audit > best[1][:len(audit)]):
                continue
        before = reached.get((i, state))
        if before is not None and before <= (cost, audit):
            continue  # no worse a prefix got here
        reached[i, state] = (cost, audit)
        if i == n:
            if state == goal if goal is not None else not TAIL[state]:
                if best is None or (cost, audit) < best:
                    best = (cost, audit)
                if hasty:
                    return best
            elif goal is None:
                stack.append((n, NEXT[state], cost + INSERT, audit + "I"))
            continue
        item = items[i]
        rest, more = "D" * item.extra, cost + DELETE * item.extra
        steps = [(i + 1, state, more + DELETE, audit + "D" + rest)]
        if not item.forced:
            more += CUT * item.truncated
            steps.append((i, NEXT[state], cost + INSERT, audit + "I"))
            if _after(state, item.role):
                steps.append((i + 1, item.role, more + KEEP, audit + "K" + rest))
            steps.append((i + 1, NEXT[state], more + REROLE, audit + "R" + rest))
        # Taken from the end of the stack: cheapest first for the first answer, else least audit.
        stack += sorted(steps, key=lambda s: (-s[2], s[0])) if hasty else reversed(steps)
    return best


def solutions(items: list[Item], entries: Iterable[int]) -> list[tuple[int, int, int, str]]:
    """(entry, goal, cost, audit) for each entry and each state the block can end in. Audits do
    not end with an insert: it belongs to the row that follows."""
    out = []
    for entry in entries:
        for goal in range(4):
            found = search(items, entry, goal)
            if found:
                out.append((entry, goal, *found))
    return out


@dataclass
class Fold:
    """The best audit of a conversation, block by block: one prefix per state, ordered by rank."""

    states: dict = field(default_factory=lambda: {NONE: (0, 0)})
    trail: list = field(default_factory=list)  # per block: state -> (state before, audit)

    def add(self, found: list[tuple[int, int, int, str]]) -> None:
        best: dict[int, tuple] = {}
        for entry, goal, cost, audit in found:
            if entry in self.states:
                paid, rank = self.states[entry]
                key = (paid + cost, rank, audit, entry)
                if goal not in best or key < best[goal]:
                    best[goal] = key
        # No prefix is the beginning of another, so their order stays whatever follows.
        order = sorted(best, key=lambda g: best[g][1:3])
        self.states = {g: (best[g][0], order.index(g)) for g in best}
        self.trail.append({g: (best[g][3], best[g][2]) for g in best})

    def close(self) -> tuple[int, list[tuple[int, str]], str]:
        """(cost, (state before, audit) of each block, inserts at the end)."""
        cost, _, state = min((c + INSERT * len(TAIL[s]), rank, s) for s, (c, rank) in self.states.items())
        tail, pieces = TAIL[state], []
        for step in reversed(self.trail):
            state, audit = step[state]
            pieces.append((state, audit))
        return cost, pieces[::-1], tail


def apply_audit(audit: str, state: int, rows: Iterator[tuple[str, str, int]]) -> Iterator[tuple[str, str, str]]:
    """(role, text, edit) of the repaired rows; ``rows`` are (role, text, copies)."""
    queue = ((role, text) for role, text, copies in rows for _ in range(copies))
    for edit in audit:
        role, text = ("", "") if edit == "I" else next(queue)
        if edit == "D":
            continue
        if edit == "K":
            state = SYSTEM if state == NONE and role[:1] == "s" else NEXT[state]
        else:
            state = NEXT[state]
            role = NAMES[state]
        yield role, text, edit


def damage(rows: DataFrame) -> DataFrame:
    """``conversations`` damaged by a hash of conversation and turn: rows dropped, emptied, without
    their sentence ends, repeated, or given to the user. Nulls count as one space."""
    def shown(c):
        return F.coalesce(F.col(c).cast("string"), F.lit(" "))

    kind = F.crc32(F.concat(shown("conv_id"), F.lit(":"), shown("turn")).cast("binary")) % 20
    text, role = shown("text"), shown("role")
    return rows.select(
        F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").cast("long").alias("turn"),
        F.when(kind == 4, "user").otherwise(role).alias("role"),
        F.when(kind == 1, "").when(kind == 2, F.regexp_replace(text, "[.!?]", "")).otherwise(text).alias("text"),
        F.explode(F.when(kind == 3, F.array(F.lit(1), F.lit(2))).otherwise(F.array(F.lit(1)))).alias("copy"),
        kind.alias("kind")).where("kind <> 0").drop("copy", "kind")


def faults(rows: DataFrame) -> DataFrame:
    """Each different (conv_id, turn, role, text) once, with its copies and its first fault:
    "blank", "duplicate", "truncated" or none. Copies beyond the first are blank or duplicates.

    Equal rows are counted by partial aggregates and the first place of a role and text is an
    aggregate joined back, so that neither is a group in one task.
    """
    rows = rows.select("conv_id", F.col("turn").cast("long").alias("turn"),
                       *[F.coalesce(F.col(c).cast("string"), F.lit(" ")).alias(c) for c in ("role", "text")])
    each = rows.groupBy("conv_id", "turn", "role", "text").agg(F.count("*").alias("copies"))
    same = [F.xxhash64(F.lit(k), F.coalesce("conv_id", F.lit(0)), F.col("conv_id").isNull(), "role", "text").alias(f"_s{k}")
            for k in (1, 2)]
    each = written(each.select("*", *same), "conversation-rows")
    # Null turns come first.
    first = each.groupBy("_s1", "_s2").agg(F.min("turn").alias("_low"), F.max(F.col("turn").isNull()).alias("_null"))
    blank = ~F.col("text").rlike(BLANKS)
    late = F.when(F.col("_null"), F.col("turn").isNotNull()).otherwise(F.col("turn") > F.col("_low"))
    cut = ~F.col("text").rlike(r"[.!?][\x20\x09-\x0D]*\z")
    return each.join(first.hint("merge"), ["_s1", "_s2"]).select(
        "conv_id", "turn", "role", "text", "copies",
        F.when(blank, "blank").when(late, "duplicate").when(cut, "truncated").alias("fault"))


def _ordered(rows: DataFrame) -> DataFrame:
    """Rows by conversation and turn (nulls first), ties by role and text; with their place:
    numbers that grow, by one inside a partition."""
    parts = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    order = ["conv_id", "turn", "role", "text"]
    ranged = rows.repartitionByRange(parts, "conv_id", "turn", F.substring("role", 1, 16), F.substring("text", 1, 64))
    placed = ranged.sortWithinPartitions(*order).withColumn("_at", F.monotonically_increasing_id())
    return written(placed, "conversation-order")


_ROLES = {"s": SYSTEM, "u": USER, "a": ASSISTANT}
_LEGAL = {"su", "ua", "au"}
_COUNTS = ("n_rows", "blank", "duplicate", "truncated", "illegal", "turns")
_BLOCKS = ("conv_id long, start long, whole boolean, found array<struct<entry:int,goal:int,cost:long,audit:string>>, "
           + ", ".join(f"{c} long" for c in _COUNTS) + ", first string, last string, low long, high long")


def _measures(rows: list[tuple]) -> dict:
    """Counts of a block's rows (turn, initial, copies, fault)."""
    out = dict.fromkeys(_COUNTS, 0)
    last = last_turn = None
    for turn, initial, copies, fault in rows:
        out["n_rows"] += copies
        if fault:
            out[fault] += 1
        out["blank" if fault == "blank" else "duplicate"] += copies - 1
        out["illegal"] += (last is not None and last + initial not in _LEGAL) + (
            (copies - 1) * (initial + initial not in _LEGAL))
        out["turns"] += turn is not None and turn != last_turn
        last, last_turn = initial, turn
    turns = [r[0] for r in rows if r[0] is not None]
    return out | {"first": rows[0][1], "last": last, "low": turns[0] if turns else None, "high": turns[-1] if turns else None}


def _blocks(ordered: DataFrame) -> DataFrame:
    """Each block of each conversation searched: rows of ``_BLOCKS``, named by the place they start at.

    A task may read several files in any order, or a part of one: a conversation goes on or ends
    only where the next place is there to tell.
    """
    size = BLOCK
    names = [c.split()[0] for c in _BLOCKS.split(", ")]
    types = [pa.int64()] * 2 + [pa.bool_(), pa.list_(pa.struct([
        ("entry", pa.int32()), ("goal", pa.int32()), ("cost", pa.int64()), ("audit", pa.string())]))
    ] + [pa.int64()] * len(_COUNTS) + [pa.string()] * 2 + [pa.int64()] * 2

    def solve(batches):
        def result(key, rows, first, last):
            items = [Item(_ROLES.get(initial), fault == "truncated", fault in ("blank", "duplicate"), copies - 1)
                     for _, initial, copies, fault in rows]
            # Other conversations right before and after it: nothing of it elsewhere.
            whole = not first and not last
            if whole:
                cost, audit = search(items, NONE, None)
                found = [(NONE, NONE, cost, audit)]
            else:
                found = solutions(items, range(4))
            found = [dict(zip(("entry", "goal", "cost", "audit"), x)) for x in found]
            m = _measures(rows)
            return (*key, whole, found, *[m[c] for c in (*_COUNTS, "first", "last", "low", "high")])

        def out(done):
            return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*done), types)], names=names)

        key, rows, done, first, before = None, [], [], True, None
        for batch in batches:
            columns = [batch.column(c).to_pylist() for c in ("conv_id", "_at", "turn", "initial", "copies", "fault")]
            for conv, at, *row in zip(*columns):
                follows = before is not None and at == before + 1
                if not follows or conv != key[0] or at % size == 0:
                    unsure = not follows or conv == key[0]
                    if rows:
                        done.append(result(key, rows, first, unsure))
                    first = unsure
                    if len(done) >= 256:
                        yield out(done)
                        done = []
                    key, rows = (conv, at), []
                before = at
                rows.append(tuple(row))
        if rows:
            done.append(result(key, rows, first, True))
        if done:
            yield out(done)

    narrow = ordered.select("conv_id", "_at", "turn", F.substring("role", 1, 1).alias("initial"), "copies", "fault")
    return narrow.mapInArrow(solve, _BLOCKS)


_PLAN = ("conv_id long, start long, entry int, piece string, closing boolean, audit string, cost long, "
         "gaps long, n_rows long, blank long, duplicate long, truncated long, illegal long")


def _plan(blocks: DataFrame) -> DataFrame:
    """Per block the state before it and its edits; the last one also closes the conversation."""
    names = [c.split()[0] for c in _PLAN.split(", ")]
    types = [pa.int64()] * 2 + [pa.int32(), pa.string(), pa.bool_(), pa.string()] + [pa.int64()] * 7

    def join(batches):
        def close(held, fold):
            conv = held[0]["conv_id"]
            cost, pieces, tail = fold.close()
            sums = {c: sum(b[c] for b in held) for c in _COUNTS}
            for a, b in zip(held, held[1:]):
                sums["illegal"] += a["last"] + b["first"] not in _LEGAL
                sums["turns"] -= a["high"] is not None and a["high"] == b["low"]
            lows, highs = ([b[c] for b in held if b[c] is not None] for c in ("low", "high"))
            gaps = highs[-1] - lows[0] + 1 - sums["turns"] if lows else 0
            for k, (b, (state, piece)) in enumerate(zip(held, pieces)):
                end = k + 1 == len(held)
                whole = "".join(p for _, p in pieces) + tail if end else None
                yield (conv, b["start"], state, piece + tail if end else piece, end, whole,
                       *[x if end else None for x in (cost, gaps, *[sums[c] for c in (
                           "n_rows", "blank", "duplicate", "truncated", "illegal")])])

        def out(done):
            return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*done), types)], names=names)

        held, done, fold = [], [], Fold()
        for batch in batches:
            for row in batch.to_pylist():
                if held and row["conv_id"] != held[0]["conv_id"]:
                    done += close(held, fold)
                    held, fold = [], Fold()
                    if len(done) >= 256:
                        yield out(done)
                        done = []
                fold.add([(f["entry"], f["goal"], f["cost"], f["audit"]) for f in row.pop("found")])
                held.append(row)
        if held:
            done += close(held, fold)
        if done:
            yield out(done)

    return blocks.repartition("conv_id").sortWithinPartitions("conv_id", "start").mapInArrow(join, _PLAN)


def _repaired(ordered: DataFrame, plan: DataFrame, digest: bool) -> DataFrame:
    """The edits carried out, in streams of blocks in order; or per conversation their hash."""
    schema = "conv_id long, repaired_sha256 string" if digest else "conv_id long, place long, role string, text string, edit string"
    names = [c.split()[0] for c in schema.split(", ")]

    def carry_out(batches):
        def stream():
            """(conv_id, role, text, edit) in order; a block's edits come before its rows."""
            def rows():
                for batch in batches:
                    yield from zip(*(batch.column(c).to_pylist()
                                     for c in ("conv_id", "kind", "entry", "piece", "role", "text", "copies")))

            source = rows()
            for conv, kind, entry, piece, *_ in source:
                assert kind == 0  # all rows of a block are taken by its edits
                body = ((role, text, copies) for *_, role, text, copies in source)
                for done in apply_audit(piece, entry, body):
                    yield (conv, *done)

        out: list[tuple] = []
        if digest:
            key, sha = (), None
            for conv, role, text, _ in stream():
                if key != (conv,):
                    if sha:
                        out.append((*key, sha.hexdigest()))
                    key, sha = (conv,), hashlib.sha256()
                else:
                    sha.update(b"\n")
                sha.update(f"{role}:{text}".encode())
                if len(out) >= 4096:
                    yield pa.RecordBatch.from_arrays(list(map(pa.array, zip(*out))), names=names)
                    out = []
            if sha:
                out.append((*key, sha.hexdigest()))
        else:
            key, place, size = (), 0, 0
            for conv, role, text, edit in stream():
                place = place + 1 if key == (conv,) else 1
                key = (conv,)
                out.append((conv, place, role, text, edit))
                size += len(text) + 64
                if size > 1 << 20:
                    yield pa.RecordBatch.from_arrays(list(map(pa.array, zip(*out))), names=names)
                    out, size = [], 0
        if out:
            types = [pa.int64(), pa.string()] if digest else [pa.int64(), pa.int64(), *[pa.string()] * 3]
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out), types)], names=names)

    edits = plan.select("conv_id", F.col("start").alias("_at"), F.lit(0).alias("kind"), "entry", "piece",
                        *[F.lit(None).cast("string").alias(c) for c in ("role", "text")], F.lit(0).cast("long").alias("copies"))
    rows = ordered.select("conv_id", "_at", F.lit(1).alias("kind"), F.lit(None).cast("int").alias("entry"),
                          F.lit(None).cast("string").alias("piece"), "role", "text", "copies")
    both = edits.unionAll(rows).repartition("conv_id").sortWithinPartitions("conv_id", "_at", "kind")
    return both.mapInArrow(carry_out, schema)


class Repair:
    """Repaired conversations of rows (conv_id, turn, role, text).

    ``report``: one row per conversation with rows: gaps in the turns, rows by first fault, illegal
    neighbours, cost and audit. ``rows``: the repaired rows in order, with the edit of each.
    ``digests``: a hash of each conversation's repaired rows.

    Rows stand by turn, nulls first, ties by role and text; equal rows are adjacent. Null role or
    text counts as one space; a null conv_id is a conversation of its own. A role is known by its
    first letter; a row without one can be deleted or given a role. Empty tables give no rows;
    other columns are not read. Blocks hold at most ``BLOCK`` different rows; of a conversation,
    one task only strings the audits of its blocks together and streams over its text.
    """

    def __init__(self, rows: DataFrame):
        small_batches(rows.sparkSession)
        self._ordered = _ordered(faults(rows))
        self._plan = written(_plan(_blocks(self._ordered)), "conversation-plan")
        self.report = self._plan.where("closing").select(
            "conv_id", "gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit")

    @property
    def rows(self) -> DataFrame:
        return _repaired(self._ordered, self._plan, False)

    @property
    def digests(self) -> DataFrame:
        return _repaired(self._ordered, self._plan, True)


def repair_report(original: DataFrame, damaged: DataFrame) -> DataFrame:
    """One row per conversation of ``original``, whether or not ``damaged`` left rows of it."""
    done = Repair(damaged)
    report = done.report.withColumnRenamed("conv_id", "_c")
    digests = done.digests.withColumnRenamed("conv_id", "_d")
    ids = original.select(F.col("conv_id").cast("long").alias("conv_id")).distinct()
    joined = ids.join(report, F.col("conv_id").eqNullSafe(F.col("_c")), "left").join(
        digests, F.col("conv_id").eqNullSafe(F.col("_d")), "left")
    longs = [F.coalesce(c, F.lit(0)).cast("long").alias(c) for c in ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")]
    return joined.select("conv_id", *longs, F.coalesce("audit", F.lit("")).alias("audit"),
                         F.coalesce("repaired_sha256", F.lit(hashlib.sha256().hexdigest())).alias("repaired_sha256"))
