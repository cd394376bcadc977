"""Repair of the turn structure of conversations by weighted CYK interval parsing.

A repaired conversation is empty or an optional system turn and then pairs of a user's and an
assistant's turn: ``(s?(ua)+)?`` in role initials. Edits are Keep (0), Rerole to user or
assistant (2), Delete (3; blank and duplicate turns have to go) and Insert of an empty turn (2);
a truncated turn that stays costs 1 more. Wanted are the cheapest edits, and of these the
ASCII-least row of initials, the audit.

The grammar is in Chomsky normal form. Its nonterminals X(p,q) are the spans that lead the
language's automaton from state p to state q, its rules X(p,q) -> X(p,r) X(r,q), and a single
turn is an X(p,q) by the edits that apply, with any insertions before and behind (the closure
of inserting). A span's cell holds the least (cost, audit) for each X(p,q). Cells are combined
bottom-up by span length: 1, 2, 4 and so on. As nonterminals are pairs of states, every split
of a span has the same derivations, so one split is enough and the work is linear in the turns,
but for the audits themselves. Least audits of halves make the least audit of the whole:
strings of one span and cost are never proper prefixes of each other, because further letters
could only be insertions, which cost.

Conversations are cut into pieces by ranges of conversation, turn, role and text; each piece is
parsed where it lies and the few pieces of a conversation that crosses a border are combined
like spans. So a conversation with a large share of all rows is many tasks' work. Only the last
step, which applies the audit, streams a conversation's turns through one task, a batch at a
time, because a digest of the whole needs them in order.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache
from hashlib import sha256

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructField, StructType

from cardlens.llm.graphs import stored
from cardlens.llm.skew import join_counted
from cardlens.llm.tables import map_batches, named

#: What does not count as text, for SQL's trim and for regular expressions.
BLANKS, FILLED = " \t\n\x0b\x0c\r", r"[^\x20\x09-\x0D]"
#: The automaton: nothing yet (0), after system (1), after user (2), after a pair (3).
MOVES = {("s", 0): 1, ("u", 0): 2, ("u", 1): 2, ("a", 2): 3, ("u", 3): 2}
STATES, ACCEPTED = 4, (0, 3)
KEEP, REROLE, DELETE, INSERT, TRUNCATED = 0, 2, 3, 2, 1
#: Rows of edits whose cells a worker remembers, up to this length.
MOST_KEPT, LONGEST_KEPT = 100_000, 16

#: The least (cost, audit) of each pair of states, None where no edits lead from one to the other.
Cell = list


def _least(cell: Cell, at: int, cost: int, audit: str) -> None:
    if cell[at] is None or (cost, audit) < cell[at]:
        cell[at] = (cost, audit)


def combined(left: Cell, right: Cell) -> Cell:
    """The cell of two spans side by side."""
    made: Cell = [None] * (STATES * STATES)
    for p in range(STATES):
        for r in range(STATES):
            first = left[p * STATES + r]
            if first is not None:
                cost, audit = first
                for q in range(STATES):
                    second = right[r * STATES + q]
                    if second is not None:
                        _least(made, p * STATES + q, cost + second[0], audit + second[1])
    return made


@lru_cache(maxsize=1)
def insertions() -> Cell:
    """The cell of an empty span: all rows of insertions."""
    closed: Cell = [None] * (STATES * STATES)
    for p in range(STATES):
        closed[p * STATES + p] = (0, "")
    for (initial, p), q in MOVES.items():
        if initial != "s":
            _least(closed, p * STATES + q, INSERT, "I")
    while (longer := combined(closed, closed)) != closed:
        closed = longer
    return closed


@lru_cache(maxsize=64)
def turn_cell(code: str) -> Cell:
    """The cell of one turn. Its code is the role's initial (x: any other) and fault, see CODES."""
    initial, fault = CODES[code]
    cell: Cell = [None] * (STATES * STATES)
    for p in range(STATES):
        _least(cell, p * STATES + p, DELETE, "D")
    if fault != "delete":
        more = TRUNCATED if fault == "truncated" else 0
        for (role, p), q in MOVES.items():
            if role == initial:
                _least(cell, p * STATES + q, KEEP + more, "K")
            if role != "s":
                _least(cell, p * STATES + q, REROLE + more, "R")
    return combined(combined(insertions(), cell), insertions())


#: A character for each kind of turn: initial and fault.
CODES = {
    chr(ord("A") + 3 * i + f): (initial, fault)
    for i, initial in enumerate("suax")
    for f, fault in enumerate(("none", "delete", "truncated"))
}
_CODE = {kind: code for code, kind in CODES.items()}


def _parsed(codes: str) -> Cell:
    level = [turn_cell(code) for code in codes]
    while len(level) > 1:
        odd = level[-1:] if len(level) % 2 else []
        level = [combined(a, b) for a, b in zip(level[::2], level[1::2])] + odd
    return level[0]


_remembered = lru_cache(maxsize=MOST_KEPT)(_parsed)


def parse(codes: str) -> Cell:
    """The cell of a row of turns, at least one."""
    return _remembered(codes) if len(codes) <= LONGEST_KEPT else _parsed(codes)


def best(cell: Cell) -> tuple[int, str]:
    """Cost and audit of a whole conversation."""
    return min(cell[q] for q in ACCEPTED if cell[q] is not None)


def damage(
    df: DataFrame,
    conv_col: str = "conv_id",
    turn_col: str = "turn",
    role_col: str = "role",
    text_col: str = "text",
) -> DataFrame:
    """``conv, turn, role, text`` after reproducible faults, chosen by a checksum of the key.

    CRC-32 of ``conv:turn`` modulo 20: 0 drops the row, 1 empties its text, 2 takes ``.!?`` out
    of it, 3 repeats the row, 4 makes its role user. A null is a space, in the key as well as in
    role and text; a null conversation or turn stays null.
    """
    space = F.lit(" ")
    as_text = [F.coalesce(named(c).cast("string"), space) for c in (conv_col, turn_col)]
    fault = F.pmod(F.crc32(F.concat_ws(":", *as_text).cast("binary")), F.lit(20))
    rows = df.select(
        named(conv_col).alias("conv"),
        named(turn_col).cast("long").alias("turn"),
        F.coalesce(named(role_col).cast("string"), space).alias("role"),
        F.coalesce(named(text_col).cast("string"), space).alias("text"),
        fault.alias("fault"),
    ).where("fault <> 0")
    text = (
        F.when(F.col("fault") == 1, F.lit(""))
        .when(F.col("fault") == 2, F.regexp_replace("text", "[.!?]", ""))
        .otherwise(F.col("text"))
    )
    times = F.when(F.col("fault") == 3, F.lit(2)).otherwise(F.lit(1))
    return rows.select(
        "conv",
        "turn",
        F.when(F.col("fault") == 4, F.lit("user")).otherwise(F.col("role")).alias("role"),
        text.alias("text"),
        F.explode(F.sequence(F.lit(1), times)).alias("copy"),
    ).drop("copy")


def _in_order() -> list[Column]:
    """Turns of a conversation: missing numbers first, ties by role and a hash of the text."""
    turn = F.col("turn").asc_nulls_first()
    return [F.col("conv").asc_nulls_first(), turn, F.col("role"), F.col("h1"), F.col("h2")]


def _rows(df: DataFrame, conv: str, turn: str, role: str, text: str) -> DataFrame:
    """``conv, turn, role, text`` without nulls in the latter two, and 128 bits of all but turn."""
    space = F.lit(" ")
    rows = df.select(
        named(conv).alias("conv"),
        named(turn).cast("long").alias("turn"),
        F.coalesce(named(role).cast("string"), space).alias("role"),
        F.coalesce(named(text).cast("string"), space).alias("text"),
    )
    key = [F.col("conv").isNull(), F.col("conv"), F.col("role"), F.col("text")]
    return rows.withColumns(
        {"h1": F.xxhash64(*key), "h2": F.xxhash64(F.lit("second"), *key)}
    )


_PIECE = (
    "piece int, least long, most long, turns long, first_turn long, last_turn long,"
    " blank long, duplicate long, truncated long, illegal long,"
    " first_initial string, last_initial string, cell array<struct<at int, cost long, audit string>>"
)
_LEGAL = {"su", "ua", "au"}


class Piece:
    """What a stretch of one conversation adds up to; rows come in order."""

    def __init__(self) -> None:
        self.blank = self.duplicate = self.truncated = self.illegal = self.turns = 0
        self.least = self.most = self.first = self.last = None
        self.first_initial = self.last_initial = self.before = None
        self.codes: list[str] = []

    def add(self, turn, initial: str, fault: str, later: bool, key: tuple) -> None:
        """``later``: the same role and text have come at a smaller turn."""
        if fault != "blank" and (later or self.before == (turn, *key)):
            fault = "duplicate"  # rows alike in all columns stand side by side
        self.before = (turn, *key)
        if fault != "none":
            setattr(self, fault, getattr(self, fault) + 1)
        kind = "delete" if fault in ("blank", "duplicate") else fault
        self.codes.append(_CODE[initial if initial in ("s", "u", "a") else "x", kind])
        if self.last_initial is None:
            self.first_initial, self.first = initial, turn
        elif self.last_initial + initial not in _LEGAL:
            self.illegal += 1
        if turn is not None:
            self.turns += turn != self.most
            self.least = turn if self.least is None else self.least
            self.most = turn
        self.last_initial, self.last = initial, turn

    def row(self) -> dict:
        cell = parse("".join(self.codes))
        return {
            "least": self.least,
            "most": self.most,
            "turns": self.turns,
            "first_turn": self.first,
            "last_turn": self.last,
            "blank": self.blank,
            "duplicate": self.duplicate,
            "truncated": self.truncated,
            "illegal": self.illegal,
            "first_initial": self.first_initial,
            "last_initial": self.last_initial,
            "cell": [{"at": i, "cost": c[0], "audit": c[1]} for i, c in enumerate(cell) if c],
        }


def _pieces(rows: DataFrame) -> DataFrame:
    """``conv`` and a piece for each stretch of a conversation within a range of the rows."""
    order = F.struct(F.col("turn").isNotNull(), F.coalesce("turn", F.lit(0).cast("long")))
    repeated = (
        rows.groupBy("h1", "h2")
        .agg(F.count(F.lit(1)).alias("n"), F.min(order).alias("first"))
        .where("n > 1")
    )
    ended = F.right(F.rtrim("text", F.lit(BLANKS)), F.lit(1))
    fault = (
        F.when(~F.col("text").rlike(FILLED), "blank")
        .when(~ended.isin(".", "!", "?"), "truncated")
        .otherwise("none")
    )
    narrow = rows.select(
        "conv", "turn", "role", "h1", "h2", F.left("role", F.lit(1)).alias("initial"), fault.alias("fault")
    )
    narrow = join_counted(narrow, stored(repeated, "repeated"), ["h1", "h2"], ["conv", "turn"])
    later = F.coalesce(order > F.col("first"), F.lit(False))
    ranges = (
        narrow.withColumn("later", later)
        .drop("n", "first")
        .repartitionByRange(*_in_order())
        .sortWithinPartitions(*_in_order())
        .select("conv", "turn", "initial", "fault", "later", "h1", "h2")
    )
    schema = StructType([StructField("conv", rows.schema["conv"].dataType)])
    for field in StructType.fromDDL(_PIECE):
        schema.add(field)
    kinds = to_arrow_schema(schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number = TaskContext.get().partitionId()
        conv, piece = None, None
        for batch in batches:
            made = []
            for row in zip(*(c.to_pylist() for c in batch.columns)):
                if piece is None or row[0] != conv:
                    if piece is not None:
                        made.append({"conv": conv, "piece": number, **piece.row()})
                    conv, piece = row[0], Piece()
                piece.add(*row[1:5], row[5:])
            yield pa.RecordBatch.from_pylist(made, kinds)
        if piece is not None:
            made = [{"conv": conv, "piece": number, **piece.row()}]
            yield pa.RecordBatch.from_pylist(made, kinds)

    return map_batches(ranges, run, schema)


_FOUND = (
    "gaps long, blank long, duplicate long, truncated long, illegal long, cost long, audit string"
)
_COUNTS = ("blank", "duplicate", "truncated", "illegal")


def _joined(pieces: list[dict]) -> dict:
    """The findings on a conversation from its pieces, which are in order."""
    whole, cell = None, None
    for piece in pieces:
        parts: Cell = [None] * (STATES * STATES)
        for entry in piece["cell"]:
            parts[entry["at"]] = (entry["cost"], entry["audit"])
        if whole is None:
            whole, cell = dict(piece), parts
            continue
        cell = combined(cell, parts)
        for name in _COUNTS:
            whole[name] += piece[name]
        whole["illegal"] += whole["last_initial"] + piece["first_initial"] not in _LEGAL
        shared = piece["first_turn"] is not None and piece["first_turn"] == whole["last_turn"]
        whole["turns"] += piece["turns"] - shared
        whole["least"] = piece["least"] if whole["least"] is None else whole["least"]
        whole["most"] = whole["most"] if piece["most"] is None else piece["most"]
        whole["last_turn"], whole["last_initial"] = piece["last_turn"], piece["last_initial"]
    cost, audit = best(cell)
    known = whole["least"] is not None
    gaps = whole["most"] - whole["least"] + 1 - whole["turns"] if known else 0
    return {"gaps": gaps, **{n: whole[n] for n in _COUNTS}, "cost": cost, "audit": audit}


def _findings(rows: DataFrame) -> DataFrame:
    """``conv`` and what is found in each conversation."""
    names = StructType.fromDDL(_PIECE).names
    pieces = _pieces(rows).groupBy("conv").agg(  # no more than one piece for each range
        F.sort_array(F.collect_list(F.struct(*names))).alias("pieces")
    )
    schema = StructType([StructField("conv", rows.schema["conv"].dataType)])
    for field in StructType.fromDDL(_FOUND):
        schema.add(field)
    kinds = to_arrow_schema(schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            convs, lists = (c.to_pylist() for c in batch.columns)
            made = [{"conv": c, **_joined(some)} for c, some in zip(convs, lists)]
            yield pa.RecordBatch.from_pylist(made, kinds)

    return map_batches(pieces, run, schema)


class Repair:
    """Applies an audit to the turns of one conversation, which come one by one."""

    def __init__(self, audit: str) -> None:
        self.audit, self.at, self.state = audit, 0, 0

    def _emit(self, role: str | None, text: str, edit: str) -> tuple[str, str, str]:
        if role is None:  # the role that the language wants next
            role = "assistant" if self.state == 2 else "user"
        self.state = MOVES[role[0], self.state]
        return role, text, edit

    def _inserted(self) -> Iterator[tuple[str, str, str]]:
        while self.at < len(self.audit) and self.audit[self.at] == "I":
            self.at += 1
            yield self._emit(None, "", "I")

    def turn(self, role: str, text: str) -> Iterator[tuple[str, str, str]]:
        """The repaired turns up to and with this one: role, text and edit."""
        yield from self._inserted()
        edit = self.audit[self.at]
        self.at += 1
        if edit != "D":
            yield self._emit(role if edit == "K" else None, text, edit)

    def end(self) -> Iterator[tuple[str, str, str]]:
        """The turns behind the last one."""
        return self._inserted()


class _Digests:
    """A digest for each conversation: its repaired ``role:text``, joined by newlines."""

    fields = "repaired_sha256 string"

    def begin(self) -> None:
        self.digest, self.any = sha256(), False

    def turns(self, found: Iterator[tuple[str, str, str]]) -> list[tuple]:
        for role, text, _ in found:
            self.digest.update((("\n" if self.any else "") + f"{role}:{text}").encode())
            self.any = True
        return []

    def end(self) -> list[tuple]:
        return [(self.digest.hexdigest(),)]


class _Turns:
    """A row for each repaired turn."""

    fields = "position long, role string, text string, edit string"

    def begin(self) -> None:
        self.position = -1

    def turns(self, found: Iterator[tuple[str, str, str]]) -> list[tuple]:
        made = []
        for turn in found:
            self.position += 1
            made.append((self.position, *turn))
        return made

    def end(self) -> list[tuple]:
        return []


def _applied(rows: DataFrame, findings: DataFrame, kind: type, with_findings: bool) -> DataFrame:
    """Streams each conversation in order, its findings ahead of its turns."""
    found = findings.columns[1:]
    head = findings.select(
        "conv",
        F.lit(0).alias("part"),
        *[F.lit(None).cast(t).alias(c) for c, t in rows.dtypes if c != "conv"],
        F.struct(*found).alias("found"),
    )
    tail = rows.select(
        "conv",
        F.lit(1).alias("part"),
        *[c for c in rows.columns if c != "conv"],
        F.lit(None).cast(head.schema["found"].dataType).alias("found"),
    )
    conv, *others = _in_order()
    streams = (
        head.union(tail)
        .repartition("conv")
        .sortWithinPartitions(conv, "part", *others)
        .select("conv", "part", "role", "text", "found")
    )
    schema = StructType([findings.schema["conv"]])
    for field in [*(findings.schema.fields[1:] if with_findings else []), *StructType.fromDDL(kind.fields)]:
        schema.add(field)
    kinds = to_arrow_schema(schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out, repair, lead = kind(), None, ()

        def rows_of(found: list[tuple]) -> list[tuple]:
            return [(*lead, *values) for values in found]

        def batch_of(made: list[tuple]) -> pa.RecordBatch:
            columns = zip(*made) if made else [()] * len(kinds)
            arrays = [pa.array(list(c), k.type) for c, k in zip(columns, kinds)]
            return pa.RecordBatch.from_arrays(arrays, names=kinds.names)

        for batch in batches:
            made = []
            for conv, part, role, text, found in zip(*(c.to_pylist() for c in batch.columns)):
                if part == 0:
                    if repair is not None:
                        made += rows_of(out.turns(repair.end()) + out.end())
                    repair = Repair(found["audit"])
                    lead = (conv, *found.values()) if with_findings else (conv,)
                    out.begin()
                else:
                    made += rows_of(out.turns(repair.turn(role, text)))
            yield batch_of(made)
        if repair is not None:
            yield batch_of(rows_of(out.turns(repair.end()) + out.end()))

    return map_batches(streams, run, schema)


def repair(
    df: DataFrame,
    conv_col: str = "conv_id",
    turn_col: str = "turn",
    role_col: str = "role",
    text_col: str = "text",
) -> DataFrame:
    """Per conversation: its faults, the cost and audit of its repair, and the result's digest.

    Turns go by number, missing numbers first; turns of one number by role, then by a hash of
    the text; rows alike in all columns are duplicates but for one. A null role or text is a
    space; rows without a conversation are one conversation. ``gaps`` are numbers that no turn
    has between the least and the greatest. A turn's first fault counts: ``blank``,
    ``duplicate`` (role and text at an earlier place) or ``truncated`` (doesn't end in
    ``.!?``). ``illegal`` are neighbours whose role initials are not su, ua or au. Other
    columns don't matter; a table without rows has no conversations.
    """
    rows = _rows(df, conv_col, turn_col, role_col, text_col)
    return _applied(rows, _findings(rows), _Digests, True).withColumnRenamed("conv", conv_col)


def repaired_turns(
    df: DataFrame,
    conv_col: str = "conv_id",
    turn_col: str = "turn",
    role_col: str = "role",
    text_col: str = "text",
) -> DataFrame:
    """The conversations after repair: ``position, role, text, edit`` of each turn that stays."""
    rows = _rows(df, conv_col, turn_col, role_col, text_col)
    return _applied(rows, _findings(rows), _Turns, False).withColumnRenamed("conv", conv_col)
