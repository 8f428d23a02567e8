"""Repair of the turn structure of conversations at the least cost, by divide and conquer in linear space."""

from __future__ import annotations

import hashlib
from collections.abc import Iterable, Iterator, Sequence
from functools import lru_cache

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from seasonstar.llm.common import store, text_slices

#: What an edit costs, by its initial. A truncated row that stays costs more.
COST = {"D": 2, "I": 5, "K": 0, "R": 1}
KEPT_TRUNCATED = 5
#: Rows and characters after which a block of a conversation is closed.
BLOCK_ROWS, BLOCK_CHARS = 2048, 1 << 20
#: Blocks of at most so many rows have their costs remembered, for so many different blocks.
SHORT_ROWS, REMEMBERED = 24, 20_000

_WHITE = " \t\n\x0b\x0c\r"
_NEVER = 1 << 60
#: Initials of roles, by their code; any other initial has code 3. Faults: 0 none, 1 must be deleted, 2 truncated.
_INITIALS = "sua"
_LEGAL = {(0, 1), (1, 2), (2, 1)}

#: States of a repaired conversation: nothing yet, after the system turn, after a user, after an assistant.
STATES = range(4)
_AFTER = {0: 2, 1: 2, 2: 3, 3: 2}  # the turn that may always follow: user, or assistant after a user
_SAYS = {2: "user", 3: "assistant"}
#: What closes a conversation that ends in a state.
_TAIL = {0: "", 1: "II", 2: "I", 3: ""}

#: For each pair of states, the cost of the least way between them and what orders the ways from one state.
Step = Sequence[Sequence[tuple[int, object] | None]]


def _row_step(code: int, fault: int) -> Step:
    """The edits of one row, with the turns put in before it."""
    out: list[list[tuple[int, str] | None]] = [[None] * 4 for _ in STATES]
    for x in STATES:
        y, put = x, ""
        for _ in range(3):  # more insertions only come back to the same state
            ways = [(y, "D")]
            if fault != 1:
                kept = {(0, 0): 1, (0, 1): 2, (1, 1): 2, (2, 2): 3, (3, 1): 2}.get((y, code))
                ways += [(kept, "K")] if kept else []
                ways.append((_AFTER[y], "R"))
            for z, op in ways:
                cost = len(put) * COST["I"] + COST[op] + (KEPT_TRUNCATED if fault == 2 and op != "D" else 0)
                way = (cost, put + op)
                out[x][z] = way if out[x][z] is None else min(out[x][z], way)
            y, put = _AFTER[y], put + "I"
    return out


_ROW_STEPS = [[_row_step(code, fault) for fault in range(3)] for code in range(4)]


def row_steps(codes: bytes) -> list[Step]:
    """Steps of rows, each given as three times the code of its initial plus its fault."""
    return [_ROW_STEPS[c // 3][c % 3] for c in codes]


def forward(steps: Sequence[Step], lo: int, hi: int, start: int) -> tuple[list[int], list[int]]:
    """Least cost from a state to each state, and the order of the audits of these four ways.

    Audits of the same rows are never prefixes of one another (each row gives one edit that is no insertion), so
    the order of two ways is that of their ways to the row before, then that of the last row.
    """
    cost, rank = [_NEVER] * 4, [0] * 4
    cost[start] = 0
    for i in range(lo, hi):
        step, best = steps[i], [None] * 4
        for x in STATES:
            if cost[x] < _NEVER:
                for y, way in enumerate(step[x]):
                    if way is not None:
                        found = (cost[x] + way[0], rank[x], way[1])
                        if best[y] is None or found < best[y]:
                            best[y] = found
        reached = sorted((b[1:], y) for y, b in enumerate(best) if b is not None)
        cost = [_NEVER if b is None else b[0] for b in best]
        for place, (_, y) in enumerate(reached):
            rank[y] = place
    return cost, rank


def backward(steps: Sequence[Step], lo: int, hi: int, end: int) -> list[int]:
    """Least cost from each state to a state."""
    cost = [_NEVER] * 4
    cost[end] = 0
    for i in range(hi - 1, lo - 1, -1):
        cost = [min([w[0] + cost[y] for y, w in enumerate(steps[i][x]) if w is not None], default=_NEVER) for x in STATES]
    return cost


def crossings(steps: Sequence[Step], start: int, end: int) -> list[int]:
    """The states before, between and after the steps on the cheapest way, the audit-least of equally cheap ones.

    Forward and backward costs meet in the middle; the crossing of the least audit is taken, and both halves are cut
    again, so no more than two vectors and the answer are held.
    """
    states = [start] * len(steps) + [end]
    parts = [(0, len(steps))]
    while parts:
        lo, hi = parts.pop()
        if hi - lo < 2:
            continue
        mid = (lo + hi) // 2
        cost, rank = forward(steps, lo, mid, states[lo])
        rest = backward(steps, mid, hi, states[hi])
        states[mid] = min((cost[x] + rest[x], rank[x], x) for x in STATES)[2]
        parts += [(lo, mid), (mid, hi)]
    return states


def last_state(cost: Sequence[int], rank: Sequence[int]) -> int:
    """Where the cheapest way ends, what closes the conversation included."""
    return min((cost[x] + COST["I"] * len(_TAIL[x]), rank[x], x) for x in STATES)[2]


def _block_step(codes: bytes) -> list[list[tuple[int, int] | None]]:
    steps = row_steps(codes)
    found = [forward(steps, 0, len(steps), x) for x in STATES]
    return [[(c, r) if c < _NEVER else None for c, r in zip(*f)] for f in found]


_short_block_step = lru_cache(REMEMBERED)(_block_step)


def block_step(codes: bytes) -> list[list[tuple[int, int] | None]]:
    """A block as one step: costs, and the order of the audits, between all states."""
    return _short_block_step(codes) if len(codes) <= SHORT_ROWS else _block_step(codes)


@lru_cache(REMEMBERED)
def _short_audit(codes: bytes, start: int, end: int) -> tuple[str, ...]:
    return _audit(codes, start, end)


def _audit(codes: bytes, start: int, end: int) -> tuple[str, ...]:
    steps = row_steps(codes)
    states = crossings(steps, start, end)
    return tuple(step[x][y][1] for step, x, y in zip(steps, states, states[1:]))


def block_audit(codes: bytes, start: int, end: int) -> tuple[str, ...]:
    """The edits of each row, on the way through a block between two states."""
    return _short_audit(codes, start, end) if len(codes) <= SHORT_ROWS else _audit(codes, start, end)


def _applied(edits: Iterable[str], rows: Iterator[tuple[str, str]], state: int) -> Iterator[str]:
    """The turns that the edits leave, as `role:text`."""
    for edit in edits:
        for op in edit:
            if op == "I":
                state = _AFTER[state]
                yield _SAYS[state] + ":"
                continue
            role, text = next(rows)
            if op == "K":
                state = {"s": 1, "u": 2, "a": 3}[role[0]]
                yield f"{role}:{text}"
            elif op == "R":
                state = _AFTER[state]
                yield f"{_SAYS[state]}:{text}"


def damage(turns: DataFrame) -> DataFrame:
    """Rows conv_id, turn, role, text with planted faults, by the remainder of crc32(`conv_id:turn`) by 20.

    0 drops the row, 1 empties its text, 2 removes `[.!?]` from it, 3 repeats the row, 4 sets its role to user. A null
    in any column counts as one space, but ids and turns stay null.
    """
    key = F.concat_ws(":", *(F.coalesce(F.col(c).cast("string"), F.lit(" ")) for c in ("conv_id", "turn")))
    text = F.coalesce("text", F.lit(" "))
    rows = turns.select(
        F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").cast("long").alias("turn"),
        F.coalesce("role", F.lit(" ")).alias("role"), text.alias("text"), (F.crc32(key.cast("binary")) % 20).alias("fault"),
    ).where("fault <> 0")
    text = F.when(F.col("fault") == 1, "").when(F.col("fault") == 2, F.regexp_replace("text", "[.!?]", "")).otherwise(F.col("text"))
    role = F.when(F.col("fault") == 4, "user").otherwise(F.col("role"))
    times = F.when(F.col("fault") == 3, F.array(F.lit(1), F.lit(2))).otherwise(F.array(F.lit(1)))
    return rows.select("conv_id", "turn", role.alias("role"), text.alias("text"), F.explode(times).alias("time")).drop("time")


def _digest(role: Column, text: Column) -> Column:
    return F.unhex(F.sha2(F.concat(F.length(role).cast("string"), F.lit(":"), role, text), 256))


def _flagged(turns: DataFrame) -> DataFrame:
    """Rows with the code of their initial and first fault, ready to be dealt in order."""
    rows = turns.select(
        F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").cast("long").alias("turn"),
        F.coalesce("role", F.lit(" ")).alias("role"), F.coalesce("text", F.lit(" ")).alias("text"),
        F.monotonically_increasing_id().alias("nth"),
    )
    rows = store(rows, "turns")  # the numbers must not change between the two uses
    rows = rows.withColumn("digest", _digest(F.col("role"), F.col("text")))
    at = F.struct(F.col("turn").isNotNull().alias("known"), F.coalesce("turn", F.lit(0)).alias("turn"), "nth")
    first = rows.groupBy(F.col("conv_id").alias("conv"), F.col("digest").alias("said")).agg(F.min(at).alias("first"), F.count("*").alias("n"))
    again = first.where("n > 1")
    same = rows["conv_id"].eqNullSafe(again["conv"]) & (rows["digest"] == again["said"])
    seen = F.coalesce(at > F.col("first"), F.lit(False))
    end = F.rtrim("text", F.lit(_WHITE))
    fault = F.when((end == "") | seen, 1).when(F.right(end, F.lit(1)).isin(".", "!", "?"), 0).otherwise(2)
    code = F.coalesce(*(F.when(F.left("role", F.lit(1)) == c, i) for i, c in enumerate(_INITIALS)), F.lit(3))
    return rows.join(again, same, "left").select(
        "conv_id", "turn", "role", "text", F.left("role", F.lit(64)).alias("role_head"), F.left("text", F.lit(64)).alias("text_head"),
        "digest", "nth", (3 * code + fault).cast("int").alias("code"), (end == "").alias("blank"),
    )


_BLOCKS = (
    "conv_id long, block long, roles array<string>, texts array<string>, codes binary, n_blank long, n_deleted long, "
    "min_turn long, max_turn long, n_turns long, costs array<long>, ranks array<long>"
)
_BLOCK_TYPES = [
    pa.int64(), pa.int64(), pa.list_(pa.string()), pa.list_(pa.string()), pa.binary(), pa.int64(), pa.int64(),
    pa.int64(), pa.int64(), pa.int64(), pa.list_(pa.int64()), pa.list_(pa.int64()),
]


#: Rows that are turned into Python values, and into a batch, at once; a batch ends earlier at `BLOCK_CHARS`.
READ_ROWS, WRITTEN_ROWS = 64, 1024


def _read(batches: Iterable[pa.RecordBatch]) -> Iterator[dict]:
    for batch in batches:
        for start in range(0, batch.num_rows, READ_ROWS):
            yield from batch.slice(start, READ_ROWS).to_pylist()


def _written(rows: Iterable[tuple[int, tuple]], types: Sequence[pa.DataType], names: Sequence[str]) -> Iterator[pa.RecordBatch]:
    """Batches of rows, each given with its size in characters."""
    held, size = [], 0

    def batch() -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*held), types)], names=list(names))

    for chars, row in rows:
        held.append(row)
        size += chars
        if len(held) >= WRITTEN_ROWS or size >= BLOCK_CHARS:
            yield batch()
            held, size = [], 0
    if held:
        yield batch()


def _names(schema: str) -> list[str]:
    return [c.split()[0] for c in schema.split(", ")]


def blocks(turns: DataFrame) -> DataFrame:
    """Blocks of whole rows in the order of their conversation, each with its costs between all states.

    Rows are dealt by ranges of conversation and turn, so one conversation with very many rows is read by many tasks.
    """
    order = ["conv_id", "turn", "role_head", "text_head", "digest", "nth"]
    dealt = _flagged(turns).repartitionByRange(*order).sortWithinPartitions(*order)

    def cut(batches: Iterable[pa.RecordBatch]) -> Iterator[tuple[int, tuple]]:
        number, size, held = TaskContext.get().partitionId() << 33, 0, []

        def closed() -> tuple[int, tuple]:
            codes = bytes(r["code"] for r in held)
            known = [r["turn"] for r in held if r["turn"] is not None]
            step = block_step(codes)
            row = (
                held[0]["conv_id"], number, [r["role"] for r in held], [r["text"] for r in held], codes,
                sum(r["blank"] for r in held), sum(c % 3 == 1 for c in codes), min(known, default=None), max(known, default=None),
                len(set(known)), [_NEVER if w is None else w[0] for s in step for w in s], [0 if w is None else w[1] for s in step for w in s],
            )
            held.clear()
            return size, row

        for batch in text_slices(batches):
            for row in batch.select(["conv_id", "turn", "role", "text", "code", "blank"]).to_pylist():
                if held and (row["conv_id"] != held[0]["conv_id"] or len(held) >= BLOCK_ROWS or size >= BLOCK_CHARS):
                    yield closed()
                    number, size = number + 1, 0
                held.append(row)
                size += len(row["role"]) + len(row["text"])
        if held:
            yield closed()

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        return _written(cut(batches), _BLOCK_TYPES, _names(_BLOCKS))

    return dealt.mapInArrow(run, _BLOCKS)


def _steps(costs: Sequence[int], ranks: Sequence[int]) -> Step:
    return [[None if c >= _NEVER else (c, r) for c, r in zip(costs[i : i + 4], ranks[i : i + 4])] for i in (0, 4, 8, 12)]


def _ways(found: DataFrame) -> DataFrame:
    """The states before and after each block of conversations of several blocks: the same crossings, a block for a row.

    One conversation's blocks meet in one task: 33 numbers for each `BLOCK_ROWS` rows.
    """
    narrow = found.select("conv_id", "block", "costs", "ranks")
    several = narrow.groupBy(F.col("conv_id").alias("conv")).agg(F.count("*").alias("n")).where("n > 1").drop("n")
    narrow = narrow.join(several, narrow["conv_id"].eqNullSafe(several["conv"]), "left_semi")

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        conv, held = None, []

        def solved() -> pa.RecordBatch:
            steps = [s for _, s in held]
            states = crossings(steps, 0, last_state(*forward(steps, 0, len(steps), 0)))
            columns = [b for b, _ in held], states[:-1], states[1:]
            held.clear()
            return pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in columns], names=["way_block", "start", "stop"])

        for batch in batches:
            for row in batch.to_pylist():
                if held and row["conv_id"] != conv:
                    yield solved()
                conv = row["conv_id"]
                held.append((row["block"], _steps(row["costs"], row["ranks"])))
        if held:
            yield solved()

    return narrow.repartition("conv_id").sortWithinPartitions("conv_id", "block").mapInArrow(run, "way_block long, start long, stop long")


_PIECES = (
    "conv_id long, block long, text string, audit string, filled boolean, first int, last int, illegal long, blank long, "
    "duplicate long, truncated long, min_turn long, max_turn long, n_turns long, cost long, stop long"
)


def _pieces(found: DataFrame) -> DataFrame:
    """The edits and repaired text of each block."""
    types = [pa.int64(), pa.int64(), pa.string(), pa.string(), pa.bool_(), pa.int32(), pa.int32(), *[pa.int64()] * 9]

    def piece(r: dict) -> tuple[int, tuple]:
        codes, step = r["codes"], _steps(r["costs"], r["ranks"])
        start, stop = r["start"], r["stop"]
        if start is None:  # the only block of its conversation
            start, stop = 0, last_state(*zip(*((w or (_NEVER, 0)) for w in step[0])))
        edits = block_audit(codes, start, stop)
        said = list(_applied(edits, iter(zip(r["roles"], r["texts"])), start))
        text, kinds = "\n".join(said), [c // 3 for c in codes]
        return len(text), (
            r["conv_id"], r["block"], text, "".join(edits), bool(said), kinds[0], kinds[-1],
            sum(pair not in _LEGAL for pair in zip(kinds, kinds[1:])), r["n_blank"], r["n_deleted"] - r["n_blank"],
            sum(c % 3 == 2 for c in codes), r["min_turn"], r["max_turn"], r["n_turns"], step[start][stop][0], stop,
        )

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        return _written(map(piece, _read(batches)), types, _names(_PIECES))

    return found.mapInArrow(run, _PIECES)


_RESULT = (
    "conv_id long, gaps long, blank long, duplicate long, truncated long, illegal long, cost long, audit string, "
    "repaired_sha256 string"
)


class _Closing:
    """One conversation, block by block in order."""

    def __init__(self, conv_id: int | None):
        self.conv_id, self.digest, self.empty, self.audit = conv_id, hashlib.sha256(), True, []
        self.counts = {"blank": 0, "duplicate": 0, "truncated": 0, "illegal": 0, "cost": 0}
        self.least = self.most = self.last = None
        self.turns, self.state = 0, 0

    def _say(self, text: str) -> None:
        self.digest.update((text if self.empty else "\n" + text).encode("utf-8", "surrogatepass"))
        self.empty = False

    def add(self, r: dict) -> None:
        for name in self.counts:
            self.counts[name] += r[name]
        if self.last is not None and (self.last, r["first"]) not in _LEGAL:
            self.counts["illegal"] += 1
        self.last = r["last"]
        if r["n_turns"]:
            self.turns += r["n_turns"] - (self.most == r["min_turn"])
            self.least = r["min_turn"] if self.least is None else self.least
            self.most = r["max_turn"]
        if r["filled"]:
            self._say(r["text"])
        self.audit.append(r["audit"])
        self.state = r["stop"]

    def row(self) -> tuple[int, tuple]:
        tail = _TAIL[self.state]
        for text in _applied(tail, iter(()), self.state):
            self._say(text)
        gaps = min(self.most - self.least + 1 - self.turns, (1 << 63) - 1) if self.turns else 0
        c = self.counts
        cost = c["cost"] + COST["I"] * len(tail)
        audit = "".join(self.audit) + tail
        counts = gaps, c["blank"], c["duplicate"], c["truncated"], c["illegal"], cost
        return len(audit), (self.conv_id, *counts, audit, self.digest.hexdigest())


def repair(turns: DataFrame) -> DataFrame:
    """The cheapest edits that make each conversation a system turn (or none) and pairs of user and assistant turns.

    `turns` needs `conv_id`, `turn`, `role` and `text`; other columns are ignored. A null role or text is one space. Rows
    stand in the order of `turn`, nulls first; rows of one turn in the order of role, text (64 characters of each)
    and digest. A row's first fault counts: blank (no character but ASCII white space), duplicate (its role and text
    stood earlier in the conversation), truncated (its last character but white space is none of `.!?`). Each row is
    kept (K, 0), given the role user or assistant (R, 1) or deleted (D, 2; blank and duplicate rows must be); empty
    user and assistant turns may be inserted (I, 5); a truncated row that is not deleted costs 5 more. The initials of
    the roles left form `(s?(ua)+)?`. `audit` has the edits' initials in order, the ASCII-least of the cheapest; `cost` their
    cost; `repaired_sha256` the digest of the repaired `role:text`, joined by line breaks. `gaps` counts turn numbers
    missing between the first and the last one, nulls left out; `illegal` neighbouring rows whose initials are not su,
    ua or au. A null `conv_id` is a conversation. No rows give no conversations.

    A conversation is cut into blocks of `BLOCK_ROWS` rows, which tasks turn into costs between the four states; where
    it has several, their crossings are found first and the edits of each block after that, by the same divide and
    conquer. Only the digest, which is sequential by nature, reads a conversation's blocks in one task, one at a time.
    """
    found = store(blocks(turns), "turn-blocks")
    ways = _ways(found)
    parts = _pieces(found.join(ways, found["block"] == ways["way_block"], "left").drop("way_block"))

    def closed(batches: Iterable[pa.RecordBatch]) -> Iterator[tuple[int, tuple]]:
        state: _Closing | None = None
        for r in _read(batches):
            if state is None or state.conv_id != r["conv_id"]:
                if state is not None:
                    yield state.row()
                state = _Closing(r["conv_id"])
            state.add(r)
        if state is not None:
            yield state.row()

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        return _written(closed(batches), [*[pa.int64()] * 7, pa.string(), pa.string()], _names(_RESULT))

    return parts.repartition("conv_id").sortWithinPartitions("conv_id", "block").mapInArrow(run, _RESULT)


def repair_all(turns: DataFrame, damaged: DataFrame) -> DataFrame:
    """A row for each conversation of `turns`, repaired from `damaged`; with no rows left: zeros and empty strings."""
    done = repair(damaged)
    ids = turns.select(F.col("conv_id").cast("long").alias("id")).distinct()
    empty = F.lit(hashlib.sha256().hexdigest())
    names = _names(_RESULT)[1:]
    values = [F.coalesce(c, {"audit": F.lit(""), "repaired_sha256": empty}.get(c, F.lit(0).cast("long"))).alias(c) for c in names]
    return ids.join(done, ids["id"].eqNullSafe(done["conv_id"]), "left").select(F.col("id").alias("conv_id"), *values)


#: The same by a plain search: the best way to each state, row by row, with its audit and what is said on it.
REPAIR_SQL = r"""
WITH RECURSIVE keyed AS (
  SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text,
         coalesce(conv_id::VARCHAR, ' ') || ':' || coalesce(turn::VARCHAR, ' ') AS key
  FROM conversations),
hashed AS (
  SELECT *, xor(list_reduce(
    list_prepend(4294967295::BIGINT, list_transform(range(1, length(key) + 1), lambda i: ascii(substr(key, i::INT, 1))::BIGINT)),
    lambda crc, byte: list_reduce(list_prepend(xor(crc, byte), range(8)),
                                  lambda v, bit: CASE WHEN v & 1 = 1 THEN xor(v >> 1, 3988292384) ELSE v >> 1 END)
  ), 4294967295) % 20 AS damage
  FROM keyed),
damaged AS (
  SELECT conv_id, turn, CASE WHEN damage = 4 THEN 'user' ELSE role END AS role,
         CASE damage WHEN 1 THEN '' WHEN 2 THEN regexp_replace(text, '[.!?]', '', 'g') ELSE text END AS text,
         unnest(CASE WHEN damage = 3 THEN [1, 2] ELSE [1] END) AS copy
  FROM hashed WHERE damage <> 0),
placed AS (
  SELECT *, rtrim(text, chr(32) || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)) AS filled, left(role, 1) AS initial,
         row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text, copy) AS i,
         row_number() OVER (PARTITION BY conv_id, role, text ORDER BY turn NULLS FIRST, copy) AS nth
  FROM damaged),
judged AS (
  SELECT conv_id, turn, role, text, initial, i,
         CASE WHEN filled = '' THEN 'blank' WHEN nth > 1 THEN 'duplicate' WHEN right(filled, 1) NOT IN ('.', '!', '?') THEN 'truncated'
              ELSE '' END AS fault,
         lag(initial) OVER (PARTITION BY conv_id ORDER BY i) || initial AS pair
  FROM placed),
counted AS (
  SELECT conv_id, count(*) AS n, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps,
         count(*) FILTER (fault = 'blank') AS blank, count(*) FILTER (fault = 'duplicate') AS duplicate,
         count(*) FILTER (fault = 'truncated') AS truncated,
         count(*) FILTER (pair IS NOT NULL AND pair NOT IN ('su', 'ua', 'au')) AS illegal
  FROM judged GROUP BY conv_id),
put(x, y, price, edits, said) AS (
  VALUES (0, 0, 0, '', []::VARCHAR[]), (1, 1, 0, '', []), (2, 2, 0, '', []), (3, 3, 0, '', []),
         (0, 2, 5, 'I', ['user:']), (1, 2, 5, 'I', ['user:']), (2, 3, 5, 'I', ['assistant:']), (3, 2, 5, 'I', ['user:']),
         (0, 3, 10, 'II', ['user:', 'assistant:']), (1, 3, 10, 'II', ['user:', 'assistant:'])),
edit(op, y, initial, z, price, says) AS (
  VALUES ('D', 0, NULL, 0, 2, NULL), ('D', 1, NULL, 1, 2, NULL), ('D', 2, NULL, 2, 2, NULL), ('D', 3, NULL, 3, 2, NULL),
         ('R', 0, NULL, 2, 1, 'user'), ('R', 1, NULL, 2, 1, 'user'), ('R', 2, NULL, 3, 1, 'assistant'), ('R', 3, NULL, 2, 1, 'user'),
         ('K', 0, 's', 1, 0, NULL), ('K', 0, 'u', 2, 0, NULL), ('K', 1, 'u', 2, 0, NULL), ('K', 2, 'a', 3, 0, NULL),
         ('K', 3, 'u', 2, 0, NULL)),
walk AS (
  SELECT conv_id, 0::BIGINT AS i, 0 AS s, {'cost': 0, 'audit': '', 'said': []::VARCHAR[]} AS way FROM counted
  UNION ALL
  SELECT w.conv_id, j.i, e.z, min({
    'cost': way.cost + p.price + e.price + CASE WHEN j.fault = 'truncated' AND e.op <> 'D' THEN 5 ELSE 0 END,
    'audit': way.audit || p.edits || e.op,
    'said': list_concat(list_concat(way.said, p.said), CASE WHEN e.op = 'D' THEN [] ELSE [coalesce(e.says, j.role) || ':' || j.text] END)})
  FROM walk w JOIN judged j ON w.conv_id IS NOT DISTINCT FROM j.conv_id AND j.i = w.i + 1 JOIN put p ON p.x = w.s
  JOIN edit e ON e.y = p.y AND (e.initial IS NULL OR e.initial = j.initial) AND (e.op = 'D' OR j.fault NOT IN ('blank', 'duplicate'))
  GROUP BY w.conv_id, j.i, e.z),
closed AS (
  SELECT w.conv_id, min({'cost': way.cost + p.price, 'audit': way.audit || p.edits, 'said': list_concat(way.said, p.said)}) AS way
  FROM walk w JOIN counted c ON w.conv_id IS NOT DISTINCT FROM c.conv_id AND w.i = c.n
  JOIN put p ON p.x = w.s AND (p.y = 3 OR p.y = 0) GROUP BY w.conv_id)
SELECT a.conv_id, coalesce(gaps, 0)::BIGINT AS gaps, coalesce(blank, 0)::BIGINT AS blank, coalesce(duplicate, 0)::BIGINT AS duplicate,
       coalesce(truncated, 0)::BIGINT AS truncated, coalesce(illegal, 0)::BIGINT AS illegal, coalesce(way.cost, 0)::BIGINT AS cost,
       coalesce(way.audit, '') AS audit, sha256(coalesce(array_to_string(way.said, chr(10)), '')) AS repaired_sha256
FROM (SELECT DISTINCT conv_id FROM conversations) a
LEFT JOIN counted c ON a.conv_id IS NOT DISTINCT FROM c.conv_id LEFT JOIN closed d ON a.conv_id IS NOT DISTINCT FROM d.conv_id
"""
