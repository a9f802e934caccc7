"""Repair of the turn structure of conversations with the cheapest edits.

A conversation should be empty, or an opening `system` turn or none and then user and assistant in
turn, ending with the assistant.  Turns are kept, given another role, deleted, or inserted.

Rows are dealt by conversation once and sorted three times within their partitions: by text, to mark
repeats; by turn backwards, for a pass that carries the cost-to-go of each state of the grammar over
Arrow batches and leaves each row's best edits (one byte: an edit a state) beside it; and by turn
forwards, for a pass that follows these back-pointers from the start.  The sorts spill to disk, so a
conversation of any length needs a few numbers in Python, apart from the result's own row.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass
from functools import partial

import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tallymart.llm.shared import map_batches

SPACE = "\x20\x09\x0a\x0b\x0c\x0d"
FINE, BLANK, DUPLICATE, TRUNCATED = range(4)  # faults
FAULTS = (None, "blank", "duplicate", "truncated")
SYSTEM, USER, ASSISTANT, OTHER = range(4)  # who speaks, by the role's first letter
ROLES = ("system", "user", "assistant")
OPEN, OPENED, ASKED, ANSWERED = range(4)  # states: nothing yet, after system, user, assistant
FINAL = (OPEN, ANSWERED)
DELETE, INSERT, KEEP, REROLE = range(4)  # in the order of their letters
LETTERS = "DIKR"
NEXT_ROLE = (USER, USER, ASSISTANT, USER)  # whom an inserted or renamed turn gives in each state
STEP = {(OPEN, SYSTEM): OPENED, **{(s, r): ASKED if r == USER else ANSWERED for s, r in enumerate(NEXT_ROLE)}}
AFTER = tuple(STEP[s, r] for s, r in enumerate(NEXT_ROLE))
BATCH_ROWS, BATCH_CHARS = 5000, 4_000_000


@dataclass(frozen=True)
class Costs:
    """Of an edit; `truncated` is added for each truncated turn that stays.  All above 0."""

    rerole: int = 1
    delete: int = 2
    insert: int = 5
    truncated: int = 5


def _closed(base: list[float], edits: list[int], costs: Costs) -> tuple[tuple[float, ...], int]:
    """Cost-to-go and best edits once insertions before the row (or the end) are allowed too."""
    best = list(base)
    for _ in range(len(best)):  # a chain of insertions visits a state once
        for state in range(4):
            if (cost := costs.insert + best[AFTER[state]]) < best[state] or (cost == best[state] and edits[state] > INSERT):
                best[state], edits[state] = cost, INSERT
    return tuple(best), sum(edit << 2 * state for state, edit in enumerate(edits))


def at_end(costs: Costs) -> tuple[tuple[float, ...], int]:
    return _closed([0 if s in FINAL else float("inf") for s in range(4)], [DELETE] * 4, costs)


def before(after: tuple[float, ...], who: int, fault: int, costs: Costs) -> tuple[tuple[float, ...], int]:
    """Cost-to-go before a row, from that after it, and the row's best edits, 2 bits a state; ties to the first letter."""
    base, edits = [], []
    extra = costs.truncated if fault == TRUNCATED else 0
    for state in range(4):
        choices = [(costs.delete + after[state], DELETE)]
        if fault not in (BLANK, DUPLICATE):
            if (state, who) in STEP:
                choices.append((extra + after[STEP[state, who]], KEEP))
            choices.append((costs.rerole + extra + after[AFTER[state]], REROLE))
        cost, edit = min(choices)
        base.append(cost)
        edits.append(edit)
    return _closed(base, edits, costs)


def _edits(batches: Iterator[pa.RecordBatch], costs: Costs) -> Iterator[pa.RecordBatch]:
    """Adds `edits` to rows that come from a conversation's last to its first; the state lives across batches."""
    known: dict[tuple, tuple[tuple[float, ...], int]] = {}  # differences of costs are bounded, so it is small
    end, _ = at_end(costs)
    conversation, costs_to_go = (), end
    for batch in batches:
        out = []
        for conv, who, fault, gone in zip(*(batch[c].to_pylist() for c in ("conv_id", "who", "fault", "gone")), strict=True):
            if conversation != (conv,):
                conversation, costs_to_go = (conv,), end
            if gone:
                out.append(0)
                continue
            key = (costs_to_go, who, fault)
            if key not in known:
                found, edits = before(costs_to_go, who, fault, costs)
                least = min(found)
                known[key] = tuple(c - least for c in found), edits
            costs_to_go, edits = known[key]
            out.append(edits)
        yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(out, pa.int32())], [*batch.schema.names, "edits"])


#: A row of `_walk`: conversation, edit, turn, role before, role after, text, fault, cost, whether its
#: place after the row before it is illegal.  A row that is gone has no edit and counts for nothing.
Step = tuple


def _walk(batches: Iterator[pa.RecordBatch], costs: Costs) -> Iterator[Step]:
    """The edits of rows that come from a conversation's first to its last."""
    _, at_last = at_end(costs)
    names = ("conv_id", "turn", "role", "text", "who", "fault", "gone", "edits")
    conversation, state, last = (), OPEN, None

    def inserted(edits: int) -> Iterator[Step]:
        nonlocal state
        while edits >> 2 * state & 3 == INSERT:
            role = ROLES[NEXT_ROLE[state]]
            state = AFTER[state]
            yield conversation[0], INSERT, None, None, role, "", FINE, costs.insert, False

    for batch in batches:
        for conv, turn, role, text, who, fault, gone, edits in zip(*(batch[c].to_pylist() for c in names), strict=True):
            if conversation != (conv,):
                if conversation:
                    yield from inserted(at_last)
                conversation, state, last = (conv,), OPEN, None
            if gone:
                yield conv, None, None, None, None, None, FINE, 0, False
                continue
            illegal = last is not None and (last, who) not in ((SYSTEM, USER), (USER, ASSISTANT), (ASSISTANT, USER))
            last = who
            yield from inserted(edits)
            edit = edits >> 2 * state & 3
            cost = costs.truncated if fault == TRUNCATED and edit != DELETE else 0
            if edit == DELETE:
                yield conv, edit, turn, role, None, text, fault, costs.delete, illegal
            elif edit == KEEP:
                state = STEP[state, who]
                yield conv, edit, turn, role, role, text, fault, cost, illegal
            else:
                new = ROLES[NEXT_ROLE[state]]
                state = AFTER[state]
                yield conv, edit, turn, role, new, text, fault, cost + costs.rerole, illegal
    if conversation:
        yield from inserted(at_last)


EDITS = "conv_id long, place long, edit string, turn long, old_role string, role string, text string, fault string, cost long"


def _edit_rows(batches: Iterator[pa.RecordBatch], costs: Costs) -> Iterator[pa.RecordBatch]:
    kinds = [pa.int64(), pa.int64(), *[pa.string()], pa.int64(), *[pa.string()] * 4, pa.int64()]
    names = [c.split()[0] for c in EDITS.split(", ")]
    rows, size, place, conversation = [], 0, 0, ()

    def packed() -> pa.RecordBatch:
        columns = zip(*rows, strict=True) if rows else [[]] * len(kinds)
        return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], names)

    for conv, edit, turn, old, role, text, fault, cost, _ in _walk(batches, costs):
        place = place + 1 if conversation == (conv,) else 0
        conversation = (conv,)
        if edit is None:
            place -= 1
            continue
        rows.append((conv, place, LETTERS[edit], turn, old, role, text, FAULTS[fault], cost))
        size += len(text)
        if len(rows) >= BATCH_ROWS or size >= BATCH_CHARS:
            yield packed()
            rows, size = [], 0
    yield packed()


AUDIT = (
    "conv_id long, gaps long, blank long, duplicate long, truncated long, illegal long, cost long,"
    " audit string, repaired_sha256 string"
)


class _Digest:
    """What `AUDIT` says of one conversation, from its steps in order."""

    def __init__(self, conv: int | None):
        self.conv, self.counts, self.illegal, self.cost = conv, [0] * 4, 0, 0
        self.letters, self.sha, self.lines = bytearray(), hashlib.sha256(), 0
        self.low = self.high = None
        self.turns = 0

    def add(self, step: Step) -> None:
        _, edit, turn, _, role, text, fault, cost, illegal = step
        if edit is None:
            return
        self.letters += LETTERS[edit].encode()
        self.cost += cost
        self.counts[fault] += 1
        self.illegal += illegal
        if turn is not None and turn != self.high:  # turns come in order
            self.low, self.high = turn if self.low is None else self.low, turn
            self.turns += 1
        if role is not None:
            self.sha.update(f"{chr(10) if self.lines else ''}{role}:{text}".encode())
            self.lines += 1

    def row(self) -> tuple:
        gaps = min(self.high - self.low + 1 - self.turns, (1 << 63) - 1) if self.turns else 0
        return (self.conv, gaps, *self.counts[1:], self.illegal, self.cost, self.letters.decode(), self.sha.hexdigest())


def _audit_rows(batches: Iterator[pa.RecordBatch], costs: Costs) -> Iterator[pa.RecordBatch]:
    kinds = [pa.int64()] * 7 + [pa.string()] * 2
    names = [c.split()[0] for c in AUDIT.split(", ")]
    rows, size, own = [], 0, None

    def packed() -> pa.RecordBatch:
        columns = zip(*rows, strict=True) if rows else [[]] * len(kinds)
        return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], names)

    for step in _walk(batches, costs):
        if own is None or own.conv != step[0]:
            if own is not None:
                rows.append(own.row())
                size += len(own.letters)
            own = _Digest(step[0])
            if len(rows) >= BATCH_ROWS or size >= BATCH_CHARS:
                yield packed()
                rows, size = [], 0
        own.add(step)
    if own is not None:
        rows.append(own.row())
    yield packed()


def _with_edits(turns: DataFrame, costs: Costs) -> DataFrame:
    """The turns with who, fault and edits, whole conversations in order within partitions; deals them out once."""
    if min(costs.rerole, costs.delete, costs.insert, costs.truncated) <= 0:
        raise ValueError("costs must be above 0")
    gone = F.col("gone") if "gone" in turns.columns else F.lit(False)
    blank = F.lit(" ")
    rows = turns.select(
        F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").cast("long").alias("turn"),
        F.coalesce("role", blank).alias("role"), F.coalesce("text", blank).alias("text"), gone.alias("gone"),
    ).repartition("conv_id")
    mark, tail, letter = F.xxhash64("role", "text"), F.rtrim(F.col("text"), F.lit(SPACE)), F.left("role", F.lit(1))
    # the conversation is in one partition already: the window sorts, it does not shuffle
    same = Window.partitionBy("conv_id", "gone", "mark", "role", "text").orderBy(F.asc_nulls_first("turn"))
    rows = rows.withColumn("mark", mark).withColumn("again", F.row_number().over(same) > 1).drop("mark")
    fault = (
        F.when(tail == "", BLANK).when(F.col("again"), DUPLICATE)
        .when(~F.right(tail, F.lit(1)).isin(".", "!", "?"), TRUNCATED).otherwise(FINE)
    )
    who = F.when(letter == "s", SYSTEM).when(letter == "u", USER).when(letter == "a", ASSISTANT).otherwise(OTHER)
    rows = rows.select("*", fault.alias("fault"), who.alias("who"))
    keys = ("role", "text", "again")
    back = rows.sortWithinPartitions("conv_id", F.desc_nulls_last("turn"), *(F.desc(k) for k in keys))
    marked = map_batches(back, partial(_edits, costs=costs), _schema(rows))
    return marked.sortWithinPartitions("conv_id", F.asc_nulls_first("turn"), *keys)


def _schema(rows: DataFrame) -> str:
    return ", ".join(f"{name} {kind}" for name, kind in [*rows.dtypes, ("edits", "int")])


def repair(turns: DataFrame, costs: Costs = Costs()) -> DataFrame:
    """Rows (conv_id, place, edit, turn, old_role, role, text, fault, cost): the cheapest edits of every conversation.

    `turns` has conv_id, turn, role, text.  A conversation's rows are taken by turn (null turns first), rows of
    one turn by role and text.  `place` counts a conversation's edits from 0; rows with edit D are dropped from it
    (role null), the others in order are the repaired conversation.  Of equally cheap lists of edits the
    least in ASCII order is taken.

    Null role and text are one space, so such a text is blank; null conv_ids are one conversation; wholly equal
    rows are repeats, whose later ones go; no rows: no rows.  Other columns are not read, except `gone`: rows
    with it are not there.
    """
    return map_batches(_with_edits(turns, costs), partial(_edit_rows, costs=costs), EDITS)


def audit(turns: DataFrame, costs: Costs = Costs()) -> DataFrame:
    """Rows of AUDIT, one per conversation: faults, illegal neighbours, the letters of the edits that `repair` makes,
    what they cost, and the digest of the repaired `role:text` lines.

    Gaps beyond a long count as the largest long.  Conversations of which all rows are `gone` have zeros.
    """
    return map_batches(_with_edits(turns, costs), partial(_audit_rows, costs=costs), AUDIT)


def damage(conversations: DataFrame) -> DataFrame:
    """Rows damaged by the checksum of `conv_id:turn` modulo 20: 0 gone (marked), 1 no text, 2 no final marks,
    3 twice, 4 said by the user.  Nulls count as one space in the checksum, in role and in text."""
    blank = F.lit(" ")
    name = F.concat_ws(":", *(F.coalesce(F.col(c).cast("string"), blank) for c in ("conv_id", "turn")))
    text = F.coalesce("text", blank)
    rows = conversations.select(
        "conv_id", "turn", F.coalesce("role", blank).alias("role"), text.alias("text"),
        F.pmod(F.crc32(F.encode(name, "UTF-8")), F.lit(20)).alias("fate"),
    )
    text = F.when(F.col("fate").isin(0, 1), "").when(F.col("fate") == 2, F.translate("text", ".!?", "")).otherwise(F.col("text"))
    copies = F.when(F.col("fate") == 3, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))
    return rows.select(
        "conv_id", "turn", F.when(F.col("fate") == 4, "user").otherwise(F.col("role")).alias("role"),
        text.alias("text"), (F.col("fate") == 0).alias("gone"), F.explode(copies).alias("copy"),
    ).drop("copy")
