"""Repair of conversations: the lightest derivation of a well-formed one, by Knuth's agenda.

A conversation's rows are to be edited so that the initials of their roles read ``(s?(ua)+)?``.  Four states follow that pattern:
nothing yet, after the system's row, after a user's, after an assistant's; the first and the last may end it.  An item (i, q) says
that the first i rows are dealt with and state q is reached.  Deductions lead from an item to others: keep, rerole or delete row i, or
insert a row.  Each has a weight function (cost, audit) -> (cost + c, audit + letter).  These are superior: never below what they are
given, and monotone in it, since at one item the audit fixes the cost, so of two audits of equal cost none begins with the
other and what follows leaves their order as it is.  So an agenda that pops the least (cost, audit) pops each item with its lightest
derivation, and the first goal popped ends the search: a clean conversation costs one pop per row.

Long conversations are not one task's affair.  Rows without their texts are range-sorted by (conversation, turn), and a stretch
of rows is solved from each state to each state.  Two neighbouring stretches make one by deductions of two premises, (left, q, m) and (right,
m, r) to (both, q, r); that is associative, so stretches are joined in a balanced way, first in a partition and then across.  Texts move
once, to be hashed in order with the edits at hand, streaming: sha256 of the repaired text is sequential by definition, so this last
step has one task per conversation, in memory that doesn't depend on its length.  Equal rows of a conversation are counted before
they move.

Defined results: a missing role or text counts as one space (so does a missing id or turn in the key of the damage); rows of a missing
``conv_id`` are one conversation; missing turns come first.  Rows of equal turn are ordered by role, then by the sha256 of their
text.  A role's class is its first letter, so a missing or empty role is none of s, u, a.  An empty table gives no rows; a conversation
without rows zeros, an empty audit and the hash of nothing.  Other columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import lru_cache
from heapq import heappop, heappush

import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from graticule.llm.common import groups_of

# What edits cost, by the letter that stands for them in the audit.
KEEP, REROLE, DELETE, INSERT, TRUNCATED = 0, 1, 2, 5, 5
# After which state which initial may follow, and the state it leads to.
NEXT = ({"s": 1, "u": 2}, {"u": 2}, {"a": 3}, {"u": 2})
ENDS = (0, 3)
ROLES = {"u": "user", "a": "assistant"}
LEGAL = ("su", "ua", "au")
WHITE = " \t\n\x0b\x0c\r"
STRETCH = 512  # rows solved at once where a conversation is cut

Weight = tuple[int, str]
Table = dict[tuple[int, int], Weight]


def kind_of(initial: str, truncated: bool, gone: bool) -> str:
    """A row as the deductions see it: d must go; else its initial, o for others, a capital letter if truncated."""
    if gone:
        return "d"
    letter = initial if initial in ("s", "u", "a") else "o"
    return letter.upper() if truncated else letter


def deductions(kinds: str, item: tuple[int, int]) -> Iterator[tuple[tuple[int, int], int, str]]:
    """(conclusion, cost, letter) of everything that follows from an item."""
    i, q = item
    for role, state in NEXT[q].items():
        if role != "s":
            yield (i, state), INSERT, "I"
    if i == len(kinds):
        return
    kind = kinds[i]
    yield (i + 1, q), DELETE, "D"
    if kind == "d":
        return
    extra = TRUNCATED if kind.isupper() else 0
    for role, state in NEXT[q].items():
        if role == kind.lower():
            yield (i + 1, state), KEEP + extra, "K"
        elif role != "s":
            yield (i + 1, state), REROLE + extra, "R"


def agenda(kinds: str, start: int, goals: tuple[int, ...] | None = None) -> Table:
    """(start, end) -> its lightest (cost, audit); with ``goals`` only the lightest of those ends, else every end that can be reached."""
    waiting, final, out = [(0, "", (0, start))], set(), {}
    while waiting:
        cost, audit, item = heappop(waiting)
        if item in final:
            continue
        final.add(item)
        if item[0] == len(kinds) and (goals is None or item[1] in goals):
            out[start, item[1]] = cost, audit
            if goals is not None:
                break
        for conclusion, more, letter in deductions(kinds, item):
            if conclusion not in final:
                heappush(waiting, (cost + more, audit + letter, conclusion))
    return out


@lru_cache(maxsize=100_000)
def whole(kinds: str) -> tuple[int, int, str]:
    """(end, cost, audit) of a conversation that lies in one place."""
    ((_, end), (cost, audit)), = agenda(kinds, 0, ENDS).items()
    return end, cost, audit


def stretch(kinds: str) -> Table:
    return {k: v for start in range(len(NEXT)) for k, v in agenda(kinds, start).items()}


def joined(left: Table, right: Table) -> Table:
    out: Table = {}
    for (q, m), (c1, a1) in left.items():
        for (n, r), (c2, a2) in right.items():
            if m == n and ((q, r) not in out or (c1 + c2, a1 + a2) < out[q, r]):
                out[q, r] = c1 + c2, a1 + a2
    return out


class Stretches:
    """Tables in order, joined like digits of a counter: each audit is copied a logarithmic number of times."""

    def __init__(self):
        self.stack: list[tuple[int, Table]] = []

    def add(self, table: Table) -> None:
        rank = 0
        while self.stack and self.stack[-1][0] <= rank:
            table, rank = joined(self.stack.pop()[1], table), rank + 1
        self.stack.append((rank, table))

    def table(self) -> Table:
        out: Table | None = None
        for _, table in reversed(self.stack):
            out = table if out is None else joined(table, out)
        return out if out is not None else {(q, q): (0, "") for q in range(len(NEXT))}


# --- damage -----------------------------------------------------------------------------------------------------------


def damaged(conversations: DataFrame) -> DataFrame:
    """(conv_id, turn, role, text, present): one row in twenty each is dropped (kept as not ``present``), emptied, stripped of its
    sentence ends, repeated, or becomes a user's."""
    conv, turn = conversations["conv_id"].cast("long"), conversations["turn"].cast("long")
    blank = lambda c: F.coalesce(c.cast("string"), F.lit(" "))
    case = F.crc32(F.concat(blank(conv), F.lit(":"), blank(turn)).cast("binary")) % 20
    role, text = blank(conversations["role"]), blank(conversations["text"])
    rows = conversations.select(
        conv.alias("conv_id"), turn.alias("turn"), F.when(case == 4, "user").otherwise(role).alias("role"),
        F.when(case == 1, "").when(case == 2, F.translate(text, ".!?", "")).otherwise(text).alias("text"), case.alias("case"))
    times = F.explode(F.when(F.col("case") == 3, F.array(F.lit(1), F.lit(2))).otherwise(F.array(F.lit(1))))
    return rows.withColumn("time", times).select("conv_id", "turn", "role", "text", (F.col("case") != 0).alias("present"))


# --- repair -----------------------------------------------------------------------------------------------------------

_PART = pa.schema([
    ("conv_id", pa.int64()), ("part", pa.int64()), ("blank", pa.int64()), ("duplicate", pa.int64()), ("truncated", pa.int64()),
    ("illegal", pa.int64()), ("first", pa.string()), ("last", pa.string()), ("low", pa.int64()), ("high", pa.int64()), ("turns", pa.int64()),
    ("start", pa.list_(pa.int32())), ("end", pa.list_(pa.int32())), ("cost", pa.list_(pa.int64())), ("audit", pa.list_(pa.string())),
])
_PART_SQL = (
    "conv_id long, part long, blank long, duplicate long, truncated long, illegal long, first string, last string, low long, high long, "
    "turns long, start array<int>, end array<int>, cost array<long>, audit array<string>")
_RESULT = pa.schema([
    ("conv_id", pa.int64()), *[(c, pa.int64()) for c in ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")],
    ("audit", pa.string()), ("repaired_sha256", pa.string()),
])
_RESULT_SQL = (
    "conv_id long, gaps long, blank long, duplicate long, truncated long, illegal long, cost long, audit string, repaired_sha256 string")


def _rows(batch: pa.RecordBatch) -> Iterator[tuple]:
    return zip(*[column.to_pylist() for column in batch.columns])


class Part:
    """What stands in one place of a conversation: its counts and its rows' kinds, solved in stretches."""

    def __init__(self, conv_id, inner: bool):
        self.conv_id, self.inner, self.solved, self.kinds = conv_id, inner, Stretches(), []
        self.blank = self.duplicate = self.truncated = self.illegal = self.turns = 0
        self.first = self.last = self.low = self.high = None

    def add(self, turn, role: str, times: int, blank: bool, truncated: bool, new: bool) -> None:
        initial = role[:1]
        if self.last is None:
            self.first = initial
        else:
            self.illegal += self.last + initial not in LEGAL
        self.illegal += times - 1
        self.last = initial
        if turn is not None and turn != self.high:
            self.turns += 1
            self.low = turn if self.low is None else self.low
            self.high = turn
        if blank:
            self.blank += times
        else:
            self.duplicate += times - new
            self.truncated += new and truncated
        if new and not blank:
            self._kind(kind_of(initial, truncated, False), 1)
            times -= 1
        self._kind("d", times)

    def _kind(self, kind: str, times: int) -> None:
        while times > 0:
            room = min(times, STRETCH - len(self.kinds))
            self.kinds += kind * room
            times -= room
            if len(self.kinds) == STRETCH:
                self.inner = False
                self._solve()

    def _solve(self) -> None:
        self.solved.add(stretch("".join(self.kinds)))
        self.kinds = []

    def table(self, inner: bool) -> Table:
        """``inner``: all of the conversation is here, so that one derivation from start to end is enough."""
        if inner and self.inner:
            end, cost, audit = whole("".join(self.kinds))
            return {(0, end): (cost, audit)}
        if self.kinds:
            self._solve()
        return self.solved.table()

    def row(self, part: int, inner: bool) -> tuple:
        table = self.table(inner)
        return (
            self.conv_id, part, self.blank, self.duplicate, self.truncated, self.illegal, self.first, self.last, self.low, self.high, self.turns,
            [q for q, _ in table], [r for _, r in table], [c for c, _ in table.values()], [a for _, a in table.values()])


def _parts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    part, out, place = None, [], 0
    for batch in batches:
        for place, conv_id, turn, role, times, blank, truncated, new in _rows(batch):
            if part is None or conv_id != part.conv_id:
                if part is not None:
                    out.append(part.row(place, True))
                # The first conversation of a partition may have begun in the one before, the last may go on in the next.
                part = Part(conv_id, part is not None)
            part.add(turn, role, times, blank, truncated, new)
        if len(out) >= 1000:
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*out), _PART)], schema=_PART)
            out = []
    if part is not None:
        out.append(part.row(place + 1, False))
        yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*out), _PART)], schema=_PART)


def _text_marks(text: Column) -> tuple[Column, Column]:
    """(blank, truncated)"""
    end = F.substring(F.rtrim(text, F.lit(WHITE)), -1, 1)
    return end == "", ~end.isin("", ".", "!", "?")


def parts(rows: DataFrame, rows_per_partition: int = 1 << 16) -> DataFrame:
    """Counts and lightest derivations of every stretch of every conversation; ``rows``: conv_id, turn, role, text, all present."""
    blank, truncated = _text_marks(F.col("text"))
    narrow = rows.select(
        "conv_id", "turn", "role", F.unhex(F.sha2("text", 256)).alias("digest"), blank.alias("blank"), truncated.alias("truncated"))
    counted = narrow.groupBy("conv_id", "turn", "role", "digest").agg(
        F.count(F.lit(1)).alias("times"), F.bool_or("blank").alias("blank"), F.bool_or("truncated").alias("truncated"))
    at = F.struct(F.col("turn").isNotNull().alias("there"), "turn")
    earliest = counted.groupBy("conv_id", "role", "digest").agg(F.min(at).alias("at")).select(
        F.col("conv_id").alias("_conv"), F.col("role").alias("_role"), F.col("digest").alias("_digest"), "at")
    same = F.col("conv_id").eqNullSafe(F.col("_conv")) & (F.col("role") == F.col("_role")) & (F.col("digest") == F.col("_digest"))
    order = [F.col("conv_id").asc_nulls_first(), F.col("turn").asc_nulls_first(), "role", "digest"]
    ranged = counted.join(earliest, same).withColumn("new", F.col("turn").eqNullSafe(F.col("at.turn"))).repartitionByRange(
        groups_of(rows.count(), rows_per_partition), *order).sortWithinPartitions(*order)
    return ranged.select(
        F.monotonically_increasing_id().alias("place"), "conv_id", "turn", "role", "times", "blank", "truncated", "new").mapInArrow(_parts, _PART_SQL)


class Repair:
    """One conversation: its parts in order, then its texts in order."""

    def __init__(self, conv_id):
        self.conv_id, self.solved, self.hash, self.empty = conv_id, Stretches(), hashlib.sha256(), True
        self.counts, self.turns, self.low, self.high, self.last = [0, 0, 0, 0], 0, None, None, None
        self.cost, self.audit, self.at, self.state = 0, None, 0, 0

    def part(self, blank, duplicate, truncated, illegal, first, last, low, high, turns, start, end, cost, audit) -> None:
        self.counts = [a + b for a, b in zip(self.counts, (blank, duplicate, truncated, illegal))]
        if self.last is not None:
            self.counts[3] += self.last + first not in LEGAL
        self.last = last
        if low is not None:
            self.turns += turns - (low == self.high)
            self.low, self.high = low if self.low is None else self.low, high
        self.solved.add(dict(zip(zip(start, end), zip(cost, audit))))

    def _solve(self) -> None:
        if self.audit is None:
            table = self.solved.table()
            self.cost, self.audit = min(table[0, q] for q in ENDS if (0, q) in table)

    def _write(self, role: str, text: str) -> None:
        if not self.empty:
            self.hash.update(b"\n")
        self.empty = False
        self.hash.update(f"{role}:{text}".encode())

    def _inserted(self) -> None:
        while self.at < len(self.audit) and self.audit[self.at] == "I":
            self._take(next(r for r in NEXT[self.state] if r != "s"), "")

    def _take(self, initial: str, text: str, role: str | None = None) -> None:
        self._write(ROLES[initial] if role is None else role, text)
        self.state = NEXT[self.state][initial]
        self.at += 1

    def text(self, role: str, text: str) -> None:
        self._solve()
        self._inserted()
        letter = self.audit[self.at]
        if letter == "D":
            self.at += 1
        elif letter == "K":
            self._take(role[:1], text, role)
        else:
            self._take(next(r for r in NEXT[self.state] if r != "s"), text)

    def row(self) -> tuple:
        self._solve()
        self._inserted()
        gaps = self.high - self.low + 1 - self.turns if self.low is not None else 0
        return (self.conv_id, gaps, *self.counts, self.cost, self.audit, self.hash.hexdigest())


def _finish(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    current, out = None, []
    for batch in batches:
        for conv_id, step, role, text, part in _rows(batch):
            if current is None or conv_id != current.conv_id:
                if current is not None:
                    out.append(current.row())
                current = Repair(conv_id)
            if step == 0:
                current.part(**part)
            elif step == 1:
                current.text(role, text)
        if len(out) >= 1000:
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*out), _RESULT)], schema=_RESULT)
            out = []
    if current is not None:
        out.append(current.row())
        yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*out), _RESULT)], schema=_RESULT)


def repaired(rows: DataFrame, rows_per_partition: int = 1 << 16) -> DataFrame:
    """Per conversation of ``rows`` (conv_id, turn, role, text, present) its faults, the lightest repair and the hash of its outcome."""
    present = rows.where("present")
    fields = [f.name for f in _PART if f.name not in ("conv_id", "part")]
    solved = parts(present, rows_per_partition).select(
        "conv_id", F.lit(0).alias("step"), "part", F.lit(None).cast("long").alias("turn"), F.lit(None).cast("string").alias("role"),
        F.lit(None).cast("binary").alias("digest"), F.lit(None).cast("string").alias("text"), F.struct(*fields).alias("solved"))
    shape = solved.schema["solved"].dataType
    texts = rows.select(
        "conv_id", F.when(F.col("present"), 1).otherwise(2).alias("step"), F.lit(0).cast("long").alias("part"),
        *[F.when(F.col("present"), c).alias(n) for n, c in (
            ("turn", F.col("turn")), ("role", F.col("role")), ("digest", F.unhex(F.sha2("text", 256))), ("text", F.col("text")))],
        F.lit(None).cast(shape).alias("solved"))
    order = [F.col("conv_id").asc_nulls_first(), "step", "part", F.col("turn").asc_nulls_first(), "role", "digest"]
    together = solved.unionByName(texts).repartition("conv_id").sortWithinPartitions(*order)
    return together.select("conv_id", "step", "role", "text", "solved").mapInArrow(_finish, _RESULT_SQL)
