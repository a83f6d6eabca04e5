"""Repair of the turn structure of conversations, by iterative-deepening A*.

A conversation's rows stand in order of turn (null first), then of role and text. The first fault of a row counts:

* ``blank``: the text has no other characters than ``[\\x20\\x09-\\x0D]``;
* ``duplicate``: an earlier row of the conversation has the same role and text;
* ``truncated``: the last other character is not one of ``.!?``.

A conversation is in order if the initials of its roles read ``(s?(ua)+)?``. Edits lead there: *Keep* a row
(cost 0), *Rerole* it to user or assistant (3), *Delete* it (4; blank and duplicate rows must go), *Insert*
a user or assistant row with an empty text anywhere (3). A truncated row that isn't deleted adds 3.

The search is depth-first in the ASCII order of the edits' initials (D, I, K, R) under a bound on the cost. A
state is the next row and what the roles so far allow. A branch ends where its cost and the least cost still to come exceed
the bound; the least such sum is the next bound. Failed states are kept in a transposition table with the cost
that they are known to need, so that no later visit, in this round or the next, tries them with less. The first accepting
path is the answer: no cheaper one exists, and of equally cheap ones its initials are the least. As roles alternate, the
initials determine the edits. ``estimate`` gives the cost still to come at least: required deletions, truncated rows, roles that can't stay and
runs of one role.

A task reads a conversation's rows one after the other and holds some small numbers for each, never their texts: rows are sorted
by Spark, searched in a first pass and repaired in a second, in which the audit comes ahead of the rows. What
is a duplicate is found by aggregation over (conversation, role, text) and joined back. Rows of one conversation meet in
one task, as each pass reads them in order; a conversation with a large share of all rows makes its task long, and its
audit is one string.

A null role or text is one space; a null id is a conversation of its own; a null turn comes before all others.
Conversations without rows are not known here and so have no result.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass, field
from itertools import chain, groupby
from operator import itemgetter

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerloom.llm.common import BLOCK_BYTES, same, ship, stage

SPACE = r"[\x20\x09-\x0D]"
KEEP, REROLE, DELETE, INSERT = "KRDI"
REROLE_COST, DELETE_COST, INSERT_COST, TRUNCATED_COST = 3, 4, 3, 3

# What was said last, as the grammar sees it: nothing, a system, a user or an assistant row.
NOTHING, SYSTEM, USER, ASSISTANT = range(4)
_ACCEPTING = (NOTHING, ASSISTANT)
# A role's initial leads from one of these to the next.
_NEXT = {
    NOTHING: {"s": SYSTEM, "u": USER},
    SYSTEM: {"u": USER},
    USER: {"a": ASSISTANT},
    ASSISTANT: {"u": USER},
}
_DUE = {state: ("a" if state == USER else "u") for state in _NEXT}
ROLES = {"u": "user", "a": "assistant"}

# Faults of a row.
SOUND, BLANK, DUPLICATE, TRUNCATED = " bdt"
LEGAL = ("su", "ua", "au")

COUNTS = ("cost", "gaps", "blank", "duplicate", "truncated", "illegal")
BATCH_ROWS = 1000


# --- the search ------------------------------------------------------------------------------


def _run_cost(rows: int, truncated: int, neighbours: int) -> int:
    """The least cost of parting a run of one role, beside 3 for each of its truncated rows.

    Deleting a truncated row adds 1. Of ``m`` rows that stay, and ``neighbours`` that can't change, each
    two adjacent ones need a row reroled or inserted; one edit mends two such places.
    """
    return min(
        gone + REROLE_COST * ((rows - gone + neighbours) // 2) for gone in {truncated, max(truncated - 1, 0)}
    )


@dataclass
class Estimates:
    """A lower bound of the cost still to come, from every row on and in every state."""

    fixed: list[int]  # deletions, truncated rows, roles that can't stay, runs behind the first
    system: list[int]  # what one system row saves if it may stay
    run: list[tuple[str, int, int, bool] | None]  # the first run: role, rows, truncated ones, at the end
    bare: list[bool]  # whether no row is left that could stay

    @classmethod
    def of(cls, initials: str, faults: str) -> Estimates:
        n = len(initials)
        fixed, system, run, bare = [0] * (n + 1), [0] * (n + 1), [None] * (n + 1), [True] * (n + 1)
        cost = saved = 0
        head, empty = None, True
        for i in range(n - 1, -1, -1):
            if faults[i] in (BLANK, DUPLICATE):
                cost += DELETE_COST
            else:
                truncated = faults[i] == TRUNCATED
                cost += TRUNCATED_COST * truncated
                if initials[i] in ROLES:
                    if head and head[0] == initials[i]:
                        head = (head[0], head[1] + 1, head[2] + truncated, head[3])
                    else:
                        cost += cls._parted(head, 0)
                        head = (initials[i], 1, int(truncated), empty)
                else:
                    unfit = DELETE_COST - TRUNCATED_COST if truncated else REROLE_COST
                    cost += cls._parted(head, 0) + unfit
                    head = None
                    if initials[i] == "s":
                        saved = max(saved, unfit)
                empty = False
            fixed[i], system[i], run[i], bare[i] = cost, saved, head, empty
        return cls(fixed, system, run, bare)

    @staticmethod
    def _parted(run, before: int) -> int:
        if run is None:
            return 0
        role, rows, truncated, last = run
        return _run_cost(rows, truncated, before + (last and role == "u"))

    def at(self, row: int, state: int) -> int:
        cost = self.fixed[row] - (self.system[row] if state == NOTHING else 0)
        if self.bare[row]:
            return cost + {SYSTEM: 2 * INSERT_COST, USER: INSERT_COST}.get(state, 0)
        run = self.run[row]
        return cost + self._parted(run, int(run is not None and run[0] != _DUE[state]))


@dataclass
class Repair:
    audit: str
    cost: int
    bounds: list[int] = field(default_factory=list)  # of the rounds, for tests
    visits: int = 0


def search(initials: str, faults: str) -> Repair:
    """The cheapest repair of rows with these role initials and faults."""
    n = len(initials)
    estimates = Estimates.of(initials, faults)
    needed: dict[int, int] = {}  # 4 * row + state: the cost that a failed state needs at least
    result = Repair("", 0)

    def least(row: int, state: int) -> int:
        known = needed.get(4 * row + state)
        guess = estimates.at(row, state)
        return guess if known is None or known < guess else known

    def steps(row: int, state: int) -> list[tuple[str, int, int, int]]:
        """Edits in ASCII order: initial, cost, next row, next state."""
        due = _NEXT[state]
        made = []
        if row < n:
            made.append((DELETE, DELETE_COST, row + 1, state))
        made.append((INSERT, INSERT_COST, row, due[_DUE[state]]))
        if row < n and faults[row] not in (BLANK, DUPLICATE):
            more = TRUNCATED_COST if faults[row] == TRUNCATED else 0
            if initials[row] in due:
                made.append((KEEP, more, row + 1, due[initials[row]]))
            made.append((REROLE, REROLE_COST + more, row + 1, due[_DUE[state]]))
        return made

    bound = least(0, NOTHING)
    while True:
        result.bounds.append(bound)
        # a frame: row, state, cost so far, edits left to try, least cost found for it, edit that led here
        frames = [[0, NOTHING, 0, None, None, ""]]
        while frames:
            frame = frames[-1]
            row, state, spent = frame[:3]
            if frame[3] is None:
                result.visits += 1
                if row == n and state in _ACCEPTING:
                    result.audit, result.cost = "".join(f[5] for f in frames), spent
                    return result
                frame[3] = iter(steps(row, state))
            for edit, cost, to, then in frame[3]:
                still = cost + least(to, then)
                if spent + still <= bound:
                    frames.append([to, then, spent + cost, None, None, edit])
                    break
                if frame[4] is None or still < frame[4]:
                    frame[4] = still
            else:
                key = 4 * row + state
                needed[key] = max(frame[4], needed.get(key, 0))
                frames.pop()
                if frames:
                    # a child that failed needs more than it was allowed
                    above = frames[-1]
                    still = spent - above[2] + needed[key]
                    if above[4] is None or still < above[4]:
                        above[4] = still
        bound = least(0, NOTHING)


# --- rows ------------------------------------------------------------------------------------


def _ordered(rows: DataFrame, *more: str) -> DataFrame:
    """All rows of a conversation in one task, one after the other."""
    return rows.repartition("conv_id").sortWithinPartitions("conv_id", *more)


def _fault(text: Column, duplicate: Column) -> Column:
    said = F.regexp_replace(text, f"{SPACE}+$", "")
    return (
        F.when(said == "", BLANK)
        .when(duplicate, DUPLICATE)
        .when(~F.substring(said, -1, 1).isin(".", "!", "?"), TRUNCATED)
        .otherwise(SOUND)
    )


def _faulty_rows(conversations: DataFrame, id_col: str, turn_col: str, role_col: str, text_col: str) -> DataFrame:
    """Rows ``conv_id, turn, role, text, fault``. Of rows alike in all of these, all but the first are duplicates
    too: their reader sees that, as they follow each other."""
    rows = stage(
        conversations.select(
            F.col(id_col).alias("conv_id"),
            F.col(turn_col).cast("long").alias("turn"),
            F.coalesce(F.col(role_col).cast("string"), F.lit(" ")).alias("role"),
            F.coalesce(F.col(text_col).cast("string"), F.lit(" ")).alias("text"),
        ).withColumn("said", F.sha2(F.concat_ws("\n", F.length("role"), "role", "text"), 256)),
        "conversation-rows",
    )
    # only what occurs twice can be a duplicate; its rows of the first turn are not
    first = stage(
        rows.groupBy(F.col("conv_id").alias("of_conv"), F.col("said").alias("of_said"))
        .agg(
            F.count("*").alias("times"),
            F.when(F.count_if(F.col("turn").isNull()) == 0, F.min("turn")).alias("first_turn"),
        )
        .where("times > 1"),
        "repeated-rows",
    )
    joined = rows.join(first, same(rows["conv_id"], F.col("of_conv")) & (rows["said"] == F.col("of_said")), "left")
    duplicate = F.col("of_said").isNotNull() & ~same(F.col("turn"), F.col("first_turn"))
    faulty = joined.select("conv_id", "turn", "role", "text", _fault(F.col("text"), duplicate).alias("fault"))
    return stage(faulty, "faulty-rows")


def _stream(batches: Iterator[pa.RecordBatch]) -> tuple[pa.DataType, Iterator[tuple]]:
    """Type of the first column, and all rows of a task."""
    first = next(batches, None)
    if first is None:
        return pa.null(), iter(())
    whole = chain([first], batches)
    return first.schema.field(0).type, (row for b in whole for row in zip(*(c.to_pylist() for c in b.columns)))


def _collected(rows: Iterator[tuple], schema: pa.Schema, size: int) -> Iterator[pa.RecordBatch]:
    """Rows in batches; column ``size`` is a text that counts towards a batch's bytes."""
    held, chars = [], 0
    for row in chain(rows, [None]):
        if held and (row is None or len(held) == BATCH_ROWS or chars > BLOCK_BYTES):
            columns = [pa.array(c, f.type) for c, f in zip(zip(*held), schema)]
            yield pa.RecordBatch.from_arrays(columns, schema=schema)
            held, chars = [], 0
        if row is not None:
            held.append(row)
            chars += len(row[size])


class _Seen:
    """What a conversation's rows leave behind as they go by."""

    def __init__(self, conv) -> None:
        self.conv = conv
        self.initials, self.faults = bytearray(), bytearray()
        self.turns, self.low, self.high = 0, None, None
        self.illegal = 0
        self.previous = None

    def add(self, turn, role: str, text: str, fault: str) -> None:
        if self.previous == (turn, role, text) and fault != BLANK:
            fault = DUPLICATE
        self.previous = turn, role, text
        initial = role[:1] if role[:1] in ("s", "u", "a") else "-"
        if self.initials and chr(self.initials[-1]) + initial not in LEGAL:
            self.illegal += 1
        self.initials += initial.encode()
        self.faults += fault.encode()
        if turn is not None:
            self.turns += turn != self.high
            self.low, self.high = turn if self.low is None else self.low, turn

    def report(self) -> tuple:
        initials, faults = self.initials.decode(), self.faults.decode()
        found = search(initials, faults)
        gaps = 0 if self.low is None else self.high - self.low + 1 - self.turns
        counts = (faults.count(f) for f in (BLANK, DUPLICATE, TRUNCATED))
        return self.conv, found.audit, found.cost, gaps, *counts, self.illegal


def _reports(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    kind, rows = _stream(batches)
    schema = pa.schema([("conv_id", kind), ("audit", pa.string()), *((n, pa.int64()) for n in COUNTS)])
    of_conversation = groupby(rows, key=itemgetter(0))

    def reports():
        for conv, own in of_conversation:
            seen = _Seen(conv)
            for row in own:
                seen.add(*row[1:])
            yield seen.report()

    yield from _collected(reports(), schema, 1)


def apply_audit(audit: str, rows: Iterator[tuple]) -> Iterator[tuple]:
    """Rows (turn, role, text, edit) after the edits; an inserted row has no turn."""
    last = ""
    for edit in audit:
        if edit == INSERT:
            turn, role, text = None, ROLES["a" if last == "u" else "u"], ""
        else:
            turn, role, text = next(rows)
            if edit == DELETE:
                continue
            if edit == REROLE:
                role = ROLES["a" if last == "u" else "u"]
        last = role[:1]
        yield turn, role, text, edit


def _repaired(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    kind, rows = _stream(batches)
    schema = pa.schema(
        [("conv_id", kind), ("position", pa.int64()), ("turn", pa.int64())]
        + [(n, pa.string()) for n in ("role", "text", "edit")]
    )

    def repaired():
        for conv, own in groupby(rows, key=itemgetter(0)):
            audit = next(own)[-1]
            for position, row in enumerate(apply_audit(audit, (r[2:5] for r in own))):
                yield conv, position, *row

    yield from _collected(repaired(), schema, 4)


def repair(
    conversations: DataFrame,
    id_col: str = "conv_id",
    turn_col: str = "turn",
    role_col: str = "role",
    text_col: str = "text",
) -> tuple[DataFrame, DataFrame]:
    """A report for each conversation and the rows of the repaired ones.

    Report: ``conv_id, audit, cost, gaps, blank, duplicate, truncated, illegal``. ``audit`` has the edits'
    initials in order, ``gaps`` the turn numbers missing between the first and the last one, ``illegal`` the adjacent
    rows whose roles may not follow each other. Rows: ``conv_id, position, turn, role, text, edit``.
    """
    rows = _faulty_rows(conversations, id_col, turn_col, role_col, text_col)
    ship(rows.sparkSession)
    kind = rows.schema["conv_id"].dataType.simpleString()
    reports = stage(
        _ordered(rows, "turn", "role", "text").mapInArrow(
            _reports, f"conv_id {kind}, audit string, " + ", ".join(f"{n} long" for n in COUNTS)
        ),
        "conversation-reports",
    )
    none = F.lit(None)
    audits = reports.select(
        "conv_id", F.lit(0).alias("kind"), none.cast("long").alias("turn"), F.lit("").alias("role"),
        F.lit("").alias("text"), "audit",
    )
    bodies = rows.select(
        "conv_id", F.lit(1).alias("kind"), "turn", "role", "text", none.cast("string").alias("audit")
    )
    repaired = _ordered(audits.unionByName(bodies), "kind", "turn", "role", "text").mapInArrow(
        _repaired, f"conv_id {kind}, position long, turn long, role string, text string, edit string"
    )
    return reports, stage(repaired, "repaired-rows")


def _digests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    kind, rows = _stream(batches)

    def digests():
        for conv, own in groupby(rows, key=itemgetter(0)):
            digest = hashlib.sha256()
            for position, (_, _, role, text) in enumerate(own):
                digest.update(f"{chr(10) if position else ''}{role}:{text}".encode())
            yield conv, digest.hexdigest()

    yield from _collected(digests(), pa.schema([("conv_id", kind), ("sha256", pa.string())]), 1)


def row_digests(repaired: DataFrame) -> DataFrame:
    """``conv_id, sha256`` of each conversation's ``role:text``, joined by newlines; a text at a time."""
    rows = repaired.select("conv_id", "position", "role", "text")
    ship(rows.sparkSession)
    kind = rows.schema["conv_id"].dataType.simpleString()
    return _ordered(rows, "position").mapInArrow(_digests, f"conv_id {kind}, sha256 string")
