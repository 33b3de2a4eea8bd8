"""Conversation structure repair: cheapest edits by checkpointed dynamic programming.

A conversation should read system (or not), then user and assistant in turns, or be empty.
Rows are kept (0), given another role (1) or deleted (2, the only way for blank and
repeated ones); empty rows are put in (5); a row that ends in the middle of a sentence
costs 5 unless it is deleted. The cheapest edits are unique once ties go to the ASCII-least
string of their initials D, I, K and R: what has been said so far decides which role may
come next.

The costs of the best way to end are a vector, one number for each state of what has been
said. It is computed backwards; the edits are read off forwards. No conversation is held
whole for that:

1. Narrow rows, without the texts, are put in order over range partitions and cut in
   segments of at most 4,096 rows. A hot conversation is many segments.
2. A segment of rows maps the cost vector behind it to the one before it, a matrix over
   (min, +). The segments of a conversation are streamed backwards to apply one matrix
   after the other: the vectors at segment ends are the checkpoints.
3. Each segment is walked forward on its own, for all states it could begin in. Within a
   segment of n rows vectors are stored at each sqrt(n)-th row only, and those between
   are computed again block by block while walking.
4. A stream in order over each conversation picks the walk for the state it is in, and
   meets the texts: only here are they moved, once. What one value of the result holds
   (a hash of the text, the string of edits) is what one task must see in sequence; it
   keeps neither texts nor rows.

Definitions. A conversation is the rows of one id; null is an id of its own. Its rows are
taken by turn (null first), then by role and by the MD5 of the text; rows that agree in
all this are equal, and all but the first of them duplicates. A null role or text is one
space. Blank: nothing but space and \\x09 to \\x0D. Duplicate: not blank, and role and text
as in an earlier row (by two 64-bit hashes). Truncated: neither, and the last character
that isn't white space is none of ``.!?``. A role counts by its first character; an empty
role, and any but s, u and a, has no place. Other columns play no part, whatever their
names. An empty table gives an empty table; a conversation without rows has no edits.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from math import isqrt

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from docloom.llm.common import stage

#: Rows of a segment are at most two to this power.
SEGMENT_BITS = 12
#: What the edits cost.
REROLE, DELETE, INSERT, TRUNCATED = 1, 2, 5, 5

# States: nothing said, system said, user said, assistant said.
_START, _SYSTEM, _USER, _ASSISTANT = range(4)
_NEXT = (_USER, _USER, _ASSISTANT, _USER)
_ROLES = {_USER: "user", _ASSISTANT: "assistant"}
_FAR = 1 << 60
#: White space: a text of nothing else is blank.
SPACE = " \t\n\x0b\x0c\r"

# A row in a byte: its role as the state it leads to (0: none), and two marks.
_DOOMED, _CUT = 4, 8

Vector = tuple[int, int, int, int]


def _closed(start: int, system: int, user: int, assistant: int) -> Vector:
    """Costs from each state if rows may be inserted first."""
    best_user = min(user, INSERT + assistant)
    more = INSERT + best_user
    return min(start, more), min(system, more), best_user, min(assistant, more)


#: Costs behind the last row: only nothing, or an assistant, may end a conversation.
END = _closed(0, _FAR, _FAR, 0)


def _before(code: int, after: Vector) -> Vector:
    """Costs before a row from those behind it."""
    costs = [DELETE + x for x in after]
    if not code & _DOOMED:
        pay = TRUNCATED if code & _CUT else 0
        for state in range(4):
            follows = _NEXT[state]
            costs[state] = min(costs[state], pay + REROLE + after[follows])
            if _fits(code, state):
                costs[state] = min(costs[state], pay + after[code & 3])
    return _closed(*costs)


def _fits(code: int, state: int) -> bool:
    """Whether a row as it is may follow."""
    role = code & 3
    return role == _NEXT[state] or (role == _SYSTEM and state == _START)


def matrix(codes: bytes) -> list[int]:
    """What rows make of the costs behind them: entry 4 * s + t is the cost from state s
    before the rows to state t behind them."""
    columns = []
    for t in range(4):
        v = tuple(0 if s == t else _FAR for s in range(4))
        for code in reversed(codes):
            v = _before(code, v)
        columns.append(v)
    return [min(columns[t][s], _FAR) for s in range(4) for t in range(4)]


def applied(entries: list[int], after: Vector) -> Vector:
    return tuple(min(entries[4 * s + t] + after[t] for t in range(4)) for s in range(4))


def _walk(codes: bytes, at: int, costs: list[Vector], state: int, edits: bytearray) -> int:
    """Take the least tight edit from row ``at`` on, as far as ``costs`` reach."""
    for here, after in zip(costs, costs[1:]):
        code = codes[at]
        pay = TRUNCATED if code & _CUT else 0
        while True:
            left = here[state]
            if left == DELETE + after[state]:
                edits += b"D"
                break
            if left == INSERT + here[_NEXT[state]]:
                edits += b"I"
                state = _NEXT[state]
                continue
            if _fits(code, state) and left == pay + after[code & 3]:
                edits += b"K"
                state = code & 3
                break
            edits += b"R"
            state = _NEXT[state]
            break
        at += 1
    return state


def walks(codes: bytes, after: Vector, last: bool) -> tuple[list[bytes], list[int]]:
    """Edits and final state from each of the four states before the rows.

    ``after`` are the costs behind the rows; the ``last`` rows of a conversation are
    followed by the insertions that end it.
    """
    size = isqrt(len(codes)) + 1
    checkpoints, v = [after], after
    for at in range(len(codes) - 1, -1, -1):
        v = _before(codes[at], v)
        if at % size == 0:
            checkpoints.append(v)
    checkpoints.pop()  # the costs before the first row come again with its block
    edits, states = [bytearray() for _ in range(4)], list(range(4))
    for begin in range(0, len(codes), size):
        costs = [checkpoints.pop()]
        for code in reversed(codes[begin : begin + size]):
            costs.append(_before(code, costs[-1]))
        costs.reverse()
        states = [_walk(codes, begin, costs, s, e) for s, e in zip(states, edits)]
    if last:
        for i, state in enumerate(states):
            while after[state]:
                edits[i] += b"I"
                state = _NEXT[state]
            states[i] = state
    return [bytes(e) for e in edits], states


def _keyed(turns: DataFrame, conv_id: str, turn: str, role: str, text: str) -> DataFrame:
    conv = F.coalesce(F.concat(F.lit("="), F.col(f"`{conv_id}`").cast("string")), F.lit(""))
    said = F.coalesce(F.col(f"`{text}`"), F.lit(" "))
    return turns.select(
        conv.alias("conv"),
        F.col(f"`{turn}`").alias("turn"),
        F.coalesce(F.col(f"`{role}`"), F.lit(" ")).alias("role"),
        F.md5(said.cast("binary")).alias("mark"),
        said.alias("text"),
    )


_ORDER = ["conv", "turn", "role", "mark"]


def _turns(keyed: DataFrame) -> DataFrame:
    """The rows in order, numbered by ``place``, with their faults, without their texts."""
    partitions = int(keyed.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    shown = F.rtrim("text", F.lit(SPACE))
    initial = F.substring("role", 1, 1)
    role = F.when(initial == "s", _SYSTEM).when(initial == "u", _USER).when(initial == "a", _ASSISTANT)
    narrow = keyed.select(
        *_ORDER,
        F.coalesce(role, F.lit(0)).alias("initial"),
        (shown == "").alias("blank"),
        (~F.substring(shown, -1, 1).isin(".", "!", "?")).alias("open"),
        F.xxhash64("role", "text").alias("same"),
        F.xxhash64("text", F.lit("other"), "role").alias("same_too"),
        F.monotonically_increasing_id().alias("tie"),
    )
    ordered = narrow.repartitionByRange(partitions, *_ORDER, "tie").sortWithinPartitions(*_ORDER, "tie")
    rows = stage(ordered.withColumn("place", F.monotonically_increasing_id()), "turns")
    first = (
        rows.where("not blank")
        .groupBy("conv", "same", "same_too")
        .agg(F.min("place").alias("place"))
        .select("place", F.lit(True).alias("first"))
    )
    duplicate = ~F.col("blank") & F.col("first").isNull()
    cut = ~F.col("blank") & F.col("first").isNotNull() & F.col("open")
    code = (
        F.col("initial") + F.when(F.col("blank") | duplicate, _DOOMED).otherwise(0) + F.when(cut, _CUT).otherwise(0)
    )
    faults = rows.join(first, "place", "left").select(
        *_ORDER, "place", "blank", duplicate.alias("duplicate"), cut.alias("truncated"), code.cast("byte").alias("code")
    )
    return stage(faults, "faults")


_SEGMENT_ROW = "codes binary, entries array<long>, first int, final int, illegal long"


def _summed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Add to each segment its matrix, its first and last role, and how many pairs are illegal."""
    for batch in batches:
        codes = [bytes(x["code"] for x in rows) for rows in batch.column("rows").to_pylist()]
        out = [
            batch.column("conv"),
            batch.column("at"),
            batch.column("start"),
            pa.array(codes, pa.binary()),
            pa.array(map(matrix, codes), pa.list_(pa.int64())),
            pa.array([c[0] & 3 for c in codes], pa.int32()),
            pa.array([c[-1] & 3 for c in codes], pa.int32()),
            pa.array([sum(map(_illegal, c, c[1:])) for c in codes], pa.int64()),
        ]
        names = ["conv", "at", "start", "codes", "entries", "first", "final", "illegal"]
        yield pa.RecordBatch.from_arrays(out, names=names)


def _illegal(a: int, b: int) -> bool:
    return (a & 3, b & 3) not in ((_SYSTEM, _USER), (_USER, _ASSISTANT), (_ASSISTANT, _USER))


def _segments(turns: DataFrame) -> DataFrame:
    """At most 2 ** ``SEGMENT_BITS`` neighbouring rows of one conversation each, told apart by ``at``."""
    at = F.shiftright("place", SEGMENT_BITS).alias("at")
    grouped = turns.groupBy("conv", at).agg(
        F.min(F.struct("place", "turn", "role", "mark")).alias("start"),
        F.sort_array(F.collect_list(F.struct("place", "code"))).alias("rows"),
    )
    schema = "conv string, at long, start struct<place: long, turn: {}, role: string, mark: string>, " + _SEGMENT_ROW
    turn = grouped.schema["start"].dataType["turn"].dataType.simpleString()
    return stage(grouped.mapInArrow(_summed, schema.format(turn)), "segments")


_CHECKPOINT = "conv string, at long, after array<long>, last boolean, cost long, illegal long"


def _backwards(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Costs behind each segment; with the first one of a conversation its cost and its number
    of illegal pairs. Segments come from the last to the first."""
    held: dict | None = None
    following = 0
    for batch in batches:
        out: list[dict] = []
        for row in batch.to_pylist():
            if held and held["conv"] == row["conv"]:
                out.append(held | {"cost": None, "illegal": None})
                after, last = held["before"], False
                illegal = held["illegal"] + _illegal(row["final"], following)
            else:
                if held:
                    out.append(held)
                after, last, illegal = END, True, 0
            before = applied(row["entries"], after)
            held = {"conv": row["conv"], "at": row["at"], "after": list(after), "last": last}
            held |= {"cost": before[_START], "illegal": illegal + row["illegal"], "before": before}
            following = row["first"]
        yield _checkpoints(out)
    if held:
        yield _checkpoints([held])


def _checkpoints(rows: list[dict]) -> pa.RecordBatch:
    kinds = {"conv": pa.string(), "at": pa.int64(), "after": pa.list_(pa.int64()), "last": pa.bool_(), "cost": pa.int64(), "illegal": pa.int64()}
    return pa.RecordBatch.from_pydict({c: pa.array([r[c] for r in rows], kind) for c, kind in kinds.items()})


_WALK = "edits array<binary>, states array<int>"


def _walked(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        columns = (batch.column(c).to_pylist() for c in ("codes", "after", "last"))
        found = [walks(*row) for row in zip(*columns)]
        yield pa.RecordBatch.from_arrays(
            [
                batch.column("conv"),
                batch.column("at"),
                batch.column("start"),
                pa.array([edits for edits, _ in found], pa.list_(pa.binary())),
                pa.array([states for _, states in found], pa.list_(pa.int32())),
            ],
            names=["conv", "at", "start", "edits", "states"],
        )


_LINE = "conv string, line long, edit string, role string, text string"


def _edited(rows: Iterator[dict]) -> Iterator[tuple[str, str, str, str]]:
    """(conv, edit, role, text) of every edit, from walks and texts in order.

    A walk comes before the first row of its segment, or earlier if that row equals those
    before it; the edits of the walks wait in a queue for their rows.
    """
    conv, state, waiting, ahead = None, _START, [], _START
    for row in rows:
        if row["conv"] != conv:
            yield from _inserted(conv, state, waiting)
            conv, state, waiting, ahead = row["conv"], _START, [], _START
        if row["edits"] is not None:
            waiting.append(iter(row["edits"][ahead].decode()))
            ahead = row["states"][ahead]
            continue
        for edit in _drained(waiting):
            if edit == "I":
                state = _NEXT[state]
                yield conv, edit, _ROLES[state], ""
                continue
            role = row["role"]
            if edit == "K":
                state = {"s": _SYSTEM, "u": _USER, "a": _ASSISTANT}[role[0]]
            elif edit == "R":
                state = _NEXT[state]
                role = _ROLES[state]
            yield conv, edit, role, row["text"]
            break
        else:
            raise AssertionError(f"no edit for a row of {conv!r}")
    yield from _inserted(conv, state, waiting)


def _drained(waiting: list[Iterator[str]]) -> Iterator[str]:
    while waiting:
        yield from waiting[0]
        waiting.pop(0)


def _inserted(conv: str | None, state: int, waiting: list[Iterator[str]]) -> Iterator[tuple]:
    for edit in _drained(waiting):
        if edit != "I":
            raise AssertionError(f"no row for an edit of {conv!r}")
        state = _NEXT[state]
        yield conv, edit, _ROLES[state], ""


def _rows(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
    for batch in batches:
        for begin in range(0, batch.num_rows, 256):  # few texts as Python objects at a time
            yield from batch.slice(begin, 256).to_pylist()


def _lines(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    kinds = {"conv": pa.string(), "line": pa.int64(), "edit": pa.string(), "role": pa.string(), "text": pa.string()}
    out: list[tuple] = []
    size, line, before = 0, 0, None

    def batch() -> pa.RecordBatch:
        return pa.RecordBatch.from_pydict({c: pa.array([x[i] for x in out], k) for i, (c, k) in enumerate(kinds.items())})

    for conv, edit, role, text in _edited(_rows(batches)):
        line = line + 1 if conv == before else 0
        before = conv
        out.append((conv, line, edit, role, text))
        size += len(text) + 32
        if size > 1 << 20:
            yield batch()
            out, size = [], 0
    if out:
        yield batch()


_DIGEST = "conv string, audit string, repaired_sha256 string"


def _hashed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """One row per conversation: the string of edits, and the hash of what they leave."""
    done: list[tuple[str, str, str]] = []
    conv, audit, text = None, bytearray(), hashlib.sha256()
    lines = 0
    for key, edit, role, said in _edited(_rows(batches)):
        if key != conv:
            if conv is not None:
                done.append((conv, audit.decode(), text.hexdigest()))
            conv, audit, text, lines = key, bytearray(), hashlib.sha256(), 0
            if len(done) == 1000:
                yield _digest_rows(done)
                done = []
        audit += edit.encode()
        if edit != "D":
            text.update(f"{chr(10) if lines else ''}{role}:".encode())
            text.update(said.encode())
            lines += 1
    if conv is not None:
        done.append((conv, audit.decode(), text.hexdigest()))
    yield _digest_rows(done)


def _digest_rows(rows: list[tuple[str, str, str]]) -> pa.RecordBatch:
    names = ("conv", "audit", "repaired_sha256")
    return pa.RecordBatch.from_pydict({c: pa.array([r[i] for r in rows], pa.string()) for i, c in enumerate(names)})


class Repair:
    """The repair of a table of conversations; its tables are computed once and written down."""

    def __init__(
        self, turns: DataFrame, conv_id: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text"
    ) -> None:
        self._keyed = _keyed(turns, conv_id, turn, role, text)
        self.turns = _turns(self._keyed)
        segments = _segments(self.turns)
        partitions = int(turns.sparkSession.conf.get("spark.sql.shuffle.partitions"))
        self.checkpoints = stage(
            segments.select("conv", "at", "entries", "first", "final", "illegal")
            .repartition(partitions, "conv")
            .sortWithinPartitions("conv", F.desc("at"))
            .mapInArrow(_backwards, _CHECKPOINT),
            "checkpoints",
        )
        walked = segments.select("conv", "at", "start", "codes").join(
            self.checkpoints.select("conv", "at", "after", "last"), ["conv", "at"]
        )
        start = segments.schema["start"].dataType.simpleString()
        self.walks = stage(walked.mapInArrow(_walked, f"conv string, at long, start {start}, {_WALK}"), "walks")

    def _stream(self) -> DataFrame:
        """Walks and texts, each conversation in one partition and in order."""
        partitions = int(self.turns.sparkSession.conf.get("spark.sql.shuffle.partitions"))
        walked = self.walks.select("conv", "start.turn", "start.role", "start.mark", "at", "edits", "states")
        said = self._keyed.select(*_ORDER, F.lit(None).cast("long").alias("at"), "text")
        both = said.unionByName(walked, allowMissingColumns=True)
        order = [*_ORDER, F.col("edits").isNull(), "at"]
        return both.repartition(partitions, "conv").sortWithinPartitions(*order).select(
            "conv", "role", "text", "edits", "states"
        )

    def lines(self) -> DataFrame:
        """(conv, line, edit, role, text) of every edit in order; those but D make the
        repaired conversation. ``conv`` is ``=`` and the id, or empty for a null id."""
        return self._stream().mapInArrow(_lines, _LINE)

    def summaries(self) -> DataFrame:
        """Counts of faults, cost, edits and a hash of the repaired text, per conversation."""
        counted = ("blank", "duplicate", "truncated")
        # by turn first: one conversation may hold a third of all rows
        turns = self.turns.groupBy("conv", "turn").agg(*[F.count_if(c).alias(c) for c in counted])
        gaps = F.max("turn") - F.min("turn") + 1 - F.count("turn")
        faults = turns.groupBy("conv").agg(
            F.coalesce(gaps, F.lit(0)).cast("long").alias("gaps"), *[F.sum(c).alias(c) for c in counted]
        )
        costs = self.checkpoints.where("cost is not null").select("conv", "illegal", "cost")
        return faults.join(costs, "conv").join(self._stream().mapInArrow(_hashed, _DIGEST), "conv")


def damaged(turns: DataFrame) -> DataFrame:
    """(conv_id, turn, role, text) with faults planted by the hash of conversation and turn."""
    key = F.concat_ws(":", *[F.coalesce(F.col(c).cast("string"), F.lit(" ")) for c in ("conv_id", "turn")])
    fault = F.crc32(key.cast("binary")) % 20
    text = F.coalesce("text", F.lit(" "))
    changed = F.when(fault == 1, "").when(fault == 2, F.regexp_replace(text, "[.!?]", "")).otherwise(text)
    role = F.when(fault == 4, "user").otherwise(F.coalesce("role", F.lit(" ")))
    copies = F.explode(F.sequence(F.lit(1), F.when(fault == 3, 2).otherwise(1)))
    rows = turns.where(fault != 0).select("conv_id", "turn", role.alias("role"), changed.alias("text"), copies)
    return rows.drop("col")


def digests(turns: DataFrame) -> DataFrame:
    """Damage all conversations, repair them, and report on every one there was."""
    conv = F.coalesce(F.concat(F.lit("="), F.col("conv_id").cast("string")), F.lit("")).alias("conv")
    every = turns.select("conv_id").distinct().select("conv_id", conv)
    given = turns.select("conv_id", "turn", "role", "text")
    found = every.join(Repair(damaged(given)).summaries(), "conv", "left")
    counts = ["gaps", "blank", "duplicate", "truncated", "illegal", "cost"]
    return found.select(
        "conv_id",
        *[F.coalesce(c, F.lit(0)).cast("long").alias(c) for c in counts],
        F.coalesce("audit", F.lit("")).alias("audit"),
        F.coalesce("repaired_sha256", F.lit(hashlib.sha256().hexdigest())).alias("repaired_sha256"),
    )
