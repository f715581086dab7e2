"""Repair of conversation structure by Knuth's lightest-derivation agenda.

The edits of a conversation are deductions of a weighted hypergraph. Items are
(rows read, state of the role grammar ``(s?(ua)+)?``); a deduction joins an item
with the next row (keep, rerole, delete) or with an inserted turn, adds its
cost and appends its initial to the audit. Both are superior functions: a
conclusion is never below its premise in the order (cost, audit), and two
derivations of one item with equal cost never have audits of which one begins
the other, so appending keeps their order. Items are therefore final when they
leave the agenda, and the first time the goal item leaves it is the answer.

Rows are dealt by conversation and streamed in turn order. A conversation goes
through the agenda in segments of ``SEGMENT`` rows: the final items of a segment
are the axioms of the next, each with a running SHA-256 of its repaired text, so
neither its rows nor its texts are ever held as a whole. (The digest of one
conversation is a function of all its text in order, so one task streams it.)
"""

from __future__ import annotations

import hashlib
import heapq
import itertools
import os.path
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

#: FIXED VALUES: costs and initials of the contract.
KEEP, REROLE, DELETE, INSERT = "K", "R", "D", "I"
COST = {KEEP: 0, REROLE: 1, DELETE: 2, INSERT: 5}
TRUNCATED_COST = 5
BLANK_CHARACTERS = " \t\n\x0b\x0c\r"
LEGAL = {"su", "ua", "au"}

#: Rows that go through the agenda at once.
SEGMENT = 512

EMPTY, SYSTEM, USER, ASSISTANT, GOAL = range(5)
_KEEPS = ({"s": SYSTEM, "u": USER}, {"u": USER}, {"a": ASSISTANT}, {"u": USER})
#: State and role that a reroled or inserted turn leads to.
_TURNS = (USER, USER, ASSISTANT, USER)
_ROLE = {USER: "user", ASSISTANT: "assistant"}


def lightest(rows: list[tuple], axioms: dict, last: bool) -> dict:
    """Final items of a segment: {(rows read, state): (cost, audit, premise,
    letter)}. ``rows`` are (initial, fault); ``axioms`` {state: (cost, audit)}.

    With ``last`` the agenda stops when the goal item, the end in an accepting
    state, is final; its entry is ``final[GOAL]``. Otherwise it ends when every
    state behind the last row is final.
    """
    n, final = len(rows), {}
    agenda, made = [], itertools.count()  # equal derivations go by their number

    def conclude(*item) -> None:
        heapq.heappush(agenda, (*item[:4], next(made), *item[4:]))

    for state, (cost, audit) in axioms.items():
        conclude(cost, audit, 0, state, None, None)
    ends = 0
    while agenda:
        cost, audit, i, state, _, premise, letter = heapq.heappop(agenda)
        if (i, state) in final:
            continue
        final[i, state] = (cost, audit, premise, letter)
        here = (i, state)
        if i == n:
            if last and state in (EMPTY, ASSISTANT, GOAL):
                if state == GOAL:
                    return final
                conclude(cost, audit, n, GOAL, here, "")
            ends += 1
            if not last and ends == 4:
                return final
        if state == GOAL:
            continue
        conclude(cost + COST[INSERT], audit + INSERT, i, _TURNS[state], here, INSERT)
        if i == n:
            continue
        initial, fault = rows[i]
        conclude(cost + COST[DELETE], audit + DELETE, i + 1, state, here, DELETE)
        if fault in ("blank", "duplicate"):
            continue
        cost += TRUNCATED_COST if fault == "truncated" else 0
        kept = _KEEPS[state].get(initial)
        if kept is not None:
            conclude(cost, audit + KEEP, i + 1, kept, here, KEEP)
        conclude(cost + COST[REROLE], audit + REROLE, i + 1, _TURNS[state], here, REROLE)
    return final


class _Conversation:
    """One conversation, fed row by row in turn order."""

    def __init__(self, key):
        self.key, self.rows, self.audit = key, [], []
        # state: (cost, audit since the last common part, digest, lines so far, begins with a system turn)
        self.entry = {EMPTY: (0, "", hashlib.sha256(), 0, False)}
        self.seen: set[bytes] = set()
        self.counts = dict.fromkeys(("blank", "duplicate", "truncated"), 0)
        self.illegal, self.before = 0, None
        self.low = self.high = None
        self.turns = 0

    def add(self, turn, role: str, text: str) -> None:
        if turn is not None:
            if turn != self.high:
                self.turns += 1
            self.low, self.high = turn if self.low is None else self.low, turn
        if self.before is not None and self.before + role[:1] not in LEGAL:
            self.illegal += 1
        self.before = role[:1]
        bare = text.rstrip(BLANK_CHARACTERS)
        mark = hashlib.blake2b(f"{len(role)}:{role}{text}".encode("utf-8", "replace"), digest_size=16).digest()
        fault = None
        if not bare:
            fault = "blank"
        elif mark in self.seen:
            fault = "duplicate"
        elif bare[-1] not in ".!?":
            fault = "truncated"
        self.seen.add(mark)
        if fault:
            self.counts[fault] += 1
        if len(self.rows) == SEGMENT:
            self._segment(False)
        self.rows.append((role, text, fault))

    def _segment(self, last: bool) -> None:
        n = len(self.rows)
        final = lightest([(role[:1], fault) for role, _, fault in self.rows],
                         {q: e[:2] for q, e in self.entry.items()}, last)
        ends = [GOAL] if last else [q for q in range(4) if (n, q) in final]
        entry = {}
        for q in ends:
            cost, audit, premise, letter = final[n, q]
            path, item = [], (n, q)
            while premise is not None:
                path.append((premise, letter, item[1]))
                item, (_, _, premise, letter) = premise, final[premise]
            _, _, digest, lines, system = self.entry[item[1]]
            digest = digest.copy()
            for (i, state), letter, after in reversed(path):
                if letter in ("", DELETE):
                    continue
                role, text = (_ROLE.get(after), "") if letter == INSERT else self.rows[i][:2]
                if letter == REROLE:
                    role = _ROLE[after]
                digest.update((("\n" if lines else "") + f"{role}:{text}").encode("utf-8", "replace"))
                lines += 1
                system = system or after == SYSTEM
            entry[q] = (cost, audit, digest, lines, system)
        common = os.path.commonprefix([e[1] for e in entry.values()])
        self.audit.append(common)
        self.entry = {q: (e[0], e[1][len(common):], *e[2:]) for q, e in entry.items()}
        self.rows.clear()

    def result(self) -> tuple:
        self._segment(True)
        cost, _, digest, _, system = self.entry[GOAL]
        gaps = 0 if self.low is None else self.high - self.low + 1 - self.turns
        return (self.key, gaps, self.counts["blank"], self.counts["duplicate"], self.counts["truncated"],
                self.illegal, cost, "".join(self.audit), digest.hexdigest(), system)


_COLUMNS = ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")


def _schema(conv: T.DataType) -> T.StructType:
    return T.StructType([T.StructField("conv_id", conv), *[T.StructField(c, T.LongType()) for c in _COLUMNS],
                         T.StructField("audit", T.StringType()), T.StructField("repaired_sha256", T.StringType()),
                         T.StructField("system_first", T.BooleanType())])


def _stream(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    now, out, schema = None, [], None

    def flush() -> pa.RecordBatch:
        columns = list(zip(*out)) if out else [()] * len(schema)
        out.clear()
        return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, schema)], schema=schema)

    for batch in batches:
        if schema is None:
            schema = pa.schema([pa.field("conv_id", batch.schema.field("conv").type), *[pa.field(c, pa.int64()) for c in _COLUMNS],
                                pa.field("audit", pa.string()), pa.field("repaired_sha256", pa.string()),
                                pa.field("system_first", pa.bool_())])
        for conv, present, turn, role, text in zip(*[batch[c].to_pylist() for c in ("conv", "present", "turn", "role", "text")]):
            if now is None or conv != now.key:
                if now is not None:
                    out.append(now.result())
                now = _Conversation(conv)
            if present:
                now.add(turn, role, text)
        yield flush()
    if now is not None:
        out.append(now.result())
        yield flush()


def _rows(df: DataFrame, conv: str, turn: str, role: str, text: str, present: Column | None) -> DataFrame:
    return df.select(F.col(conv).alias("conv"), F.coalesce(F.lit(True) if present is None else present, F.lit(False)).alias("present"),
                     F.col(turn).cast("long").alias("turn"), F.coalesce(F.col(role), F.lit(" ")).alias("role"),
                     F.coalesce(F.col(text), F.lit(" ")).alias("text"))


def repair(df: DataFrame, conv: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text",
           present: Column | None = None) -> DataFrame:
    """One row per conversation: (conv_id, gaps, blank, duplicate, truncated,
    illegal, cost, audit, repaired_sha256, system_first).

    Rows for which ``present`` is not true only name their conversation. Null
    roles and texts are one space; rows without conversation are one
    conversation; null turns come first; rows of one turn go by role and text,
    repeated rows beside each other, of which the first is none. A conversation
    of blank or duplicate rows only has an empty repair; a table without rows no
    result. Texts and conversations may have any length; memory holds one
    segment and 16 bytes for each different row of the conversation at hand.
    Other columns are not read and may have any names.
    """
    rows = _rows(df, conv, turn, role, text, present)
    dealt = rows.repartition("conv").sortWithinPartitions("conv", "turn", "role", "text")
    return dealt.mapInArrow(_stream, _schema(df.schema[conv].dataType))


def repaired_turns(df: DataFrame, repaired: DataFrame, conv: str = "conv_id", turn: str = "turn", role: str = "role",
                   text: str = "text", present: Column | None = None) -> DataFrame:
    """The repaired conversations: (conv_id, place from 0, role, text), by the
    audits of ``repair`` on the same rows; an inserted turn has an empty text."""
    order = Window.partitionBy("conv").orderBy("turn", "role", "text")
    rows = (_rows(df, conv, turn, role, text, present).where("present")
            .select("conv", "role", "text", F.row_number().over(order).alias("row")))
    edits = Window.partitionBy("conv").orderBy("pos")
    letters = (repaired.where(F.col("audit") != "")
               .select(F.col("conv_id").alias("conv"), "system_first", F.posexplode(F.split("audit", "")).alias("pos", "edit"))
               .where(F.col("edit") != "")
               .select("conv", "edit", F.col("system_first").cast("int").alias("first"),
                       F.sum((F.col("edit") != INSERT).cast("int")).over(edits).alias("row"),
                       (F.sum((F.col("edit") != DELETE).cast("int")).over(edits) - 1).alias("place"))
               .where(F.col("edit") != DELETE)
               .select(F.col("conv").alias("of"), "edit", "place", "row", "first",
                       F.when(F.col("edit") != INSERT, F.col("row")).alias("at")))
    given = F.when((F.col("place") - F.col("first")) % 2 == 0, "user").otherwise("assistant")
    return (letters.join(rows.withColumnRenamed("row", "_row"),
                         F.col("of").eqNullSafe(F.col("conv")) & (F.col("at") == F.col("_row")), "left")
            .select(F.col("of").alias("conv_id"), F.col("place").cast("long").alias("place"),
                    F.when(F.col("edit") == KEEP, F.col("role")).otherwise(given).alias("role"),
                    F.coalesce("text", F.lit("")).alias("text")))
