"""Repair of conversation structure by weighted interval parsing.

A repaired conversation is empty or has role initials ``s?(ua)+``. The repair grammar has a nonterminal [p, q] for every two places p
and q of such a sequence (nothing yet, after s, after u, after ua); it derives the rows and edits that lead from p to q. In Chomsky
normal form its rules are

- [p, q] -> [p, r] [r, q] for every place r between them,
- [p, q] -> row, by keeping it or giving it another role (p to q is that role's step) or by deleting it (p = q),
- [p, q] -> nothing, by inserting turns; closed under itself, so that any number of turns may be inserted anywhere.

A cell holds the least (cost, audit) of every nonterminal over one interval of rows, audits being the initials of the edits. Cells
combine bottom-up by the length of their intervals. As the rules have a place r for every split, each split of an interval
gives the same cell, and one of them, in the middle, is enough: n rows need n - 1 combinations. The least audit of an interval
is made of the least audits of its halves, because equally cheap audits of the same rows are never one the beginning of
another (the letters decide the cost, and what follows could only be paid insertions).

That also cuts long conversations: rows are sorted by range, so a conversation may lie in many tasks, each of which
parses segments of bounded length; only the segments' cells meet.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterable, Iterator

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidegauge.session import cut_lineage, written_once

KEEP, REROLE, DELETE, INSERT, TRUNCATED = 0, 3, 4, 3, 3
#: Rows that one cell of a segment covers.
SEGMENT = 4096
#: Places: 0 nothing yet, 1 after s, 2 after u, 3 after ua; and the steps between them.
START, ENDS = 0, (0, 3)
STEPS = {(0, "s"): 1, (0, "u"): 2, (1, "u"): 2, (2, "a"): 3, (3, "u"): 2}
ROLES = {"u": "user", "a": "assistant"}
LEGAL = {"su", "ua", "au"}
_PLACES = range(4)
_FROM = {0: (0, 1, 2, 3), 1: (1, 2, 3), 2: (2, 3), 3: (2, 3)}
NONTERMINALS = [(p, q) for p in _PLACES for q in _FROM[p]]
#: For each nonterminal the pairs that it derives, as places in a cell.
RULES = [
    [(NONTERMINALS.index((p, r)), NONTERMINALS.index((r, q))) for r in _FROM[p] if q in _FROM[r]] for p, q in NONTERMINALS
]

Cell = list  # of (cost, audit) or None, one per nonterminal


def combine(left: Cell, right: Cell) -> Cell:
    """The cell of two neighbouring intervals."""
    found: Cell = []
    for rules in RULES:
        best = None
        for l, r in rules:
            x, y = left[l], right[r]
            if x is None or y is None:
                continue
            cost = x[0] + y[0]
            if best is None or cost < best[0]:
                best = (cost, x[1] + y[1])
            elif cost == best[0]:
                best = min(best, (cost, x[1] + y[1]))
        found.append(best)
    return found


def _least(*cells: Cell) -> Cell:
    return [min((x for x in options if x is not None), default=None) for options in zip(*cells, strict=True)]


def _nothing() -> Cell:
    """The cell of an empty interval: no edit, or insertions; closed under combination."""
    cell: Cell = [(0, "") if p == q else None for p, q in NONTERMINALS]
    for (p, initial), q in STEPS.items():
        if initial in ROLES:
            cell[NONTERMINALS.index((p, q))] = (INSERT, "I")
    while True:
        closed = _least(cell, combine(cell, cell))
        if closed == cell:
            return cell
        cell = closed


NOTHING = _nothing()


def row_cell(initial: str, must_go: bool, truncated: bool) -> Cell:
    """The cell of one row, with insertions around it."""
    cell: Cell = [(DELETE, "D") if p == q else None for p, q in NONTERMINALS]
    if not must_go:
        more = TRUNCATED if truncated else 0
        for (p, step), q in STEPS.items():
            at = NONTERMINALS.index((p, q))
            options = [x for x in (cell[at],) if x]
            if step == initial:
                options.append((KEEP + more, "K"))
            if step in ROLES:
                options.append((REROLE + more, "R"))
            cell[at] = min(options, default=None)
    return combine(combine(NOTHING, cell), NOTHING)


def deleted_cell(rows: int) -> Cell:
    """The cell of ``rows`` rows that must go; an insertion among them is never less than one after them."""
    cell = [(DELETE * rows, "D" * rows) if p == q else None for p, q in NONTERMINALS]
    return combine(combine(NOTHING, cell), NOTHING)


def parse(cells: list[Cell]) -> Cell:
    """The cell of a whole interval from those of neighbouring parts, by length of the interval."""
    if not cells:
        return NOTHING
    while len(cells) > 1:
        pairs = [combine(cells[i], cells[i + 1]) for i in range(0, len(cells) - 1, 2)]
        cells = pairs + cells[len(cells) - len(cells) % 2 :]
    return cells[0]


def best(cell: Cell) -> tuple[int, str]:
    """The cheapest repair, of equally cheap ones that with the least audit."""
    return min(x for x in (cell[NONTERMINALS.index((START, q))] for q in ENDS) if x is not None)


class Edits:
    """Applies an audit to rows as they come, in order."""

    def __init__(self, audit: str):
        self.audit, self.at, self.place = audit, 0, START

    def inserted(self) -> Iterator[tuple[str, str, str]]:
        """``(edit, role, text)`` of what is inserted before the next row."""
        while self.audit[self.at : self.at + 1] == "I":
            self.at += 1
            yield "I", self._given(), ""

    def row(self, role: str, text: str) -> tuple[str, str, str] | None:
        """What becomes of the next row; none if it goes."""
        edit = self.audit[self.at]
        self.at += 1
        if edit == "D":
            return None
        if edit == "R":
            return edit, self._given(), text
        self.place = STEPS[self.place, role[:1]]
        return edit, role, text

    def _given(self) -> str:
        initial = "a" if self.place == 2 else "u"
        self.place = STEPS[self.place, initial]
        return ROLES[initial]


def damage(rows: DataFrame) -> DataFrame:
    """``conv_id, turn, role, text`` with faults put in by the checksum of ``conv_id:turn``, in twentieths.

    0 drops the row, 1 empties its text, 2 takes ``.!?`` out of it, 3 repeats the row, 4 sets the role ``user``. Null roles and texts
    are one space, and so are null ids and turns inside the checksum; as columns those stay null.
    """
    blank = F.lit(" ")
    key = F.concat(F.coalesce(F.col("conv_id").cast("string"), blank), F.lit(":"), F.coalesce(F.col("turn").cast("string"), blank))
    fault = F.pmod(F.crc32(key.cast("binary")), F.lit(20)).alias("_fault")
    marked = rows.select("conv_id", "turn", F.coalesce("role", blank).alias("role"), F.coalesce("text", blank).alias("text"), fault)
    return marked.filter("_fault <> 0").select(
        "conv_id",
        "turn",
        F.when(F.col("_fault") == 4, F.lit("user")).otherwise(F.col("role")).alias("role"),
        F.when(F.col("_fault") == 1, F.lit("")).when(F.col("_fault") == 2, F.regexp_replace("text", "[.!?]", "")).otherwise(F.col("text")).alias("text"),
        F.explode(F.array_repeat(F.lit(0), F.when(F.col("_fault") == 3, 2).otherwise(1))).alias("_copy"),
    ).drop("_copy")


def _described(rows: DataFrame) -> DataFrame:
    """Rows with null roles and texts as one space, and what parsing needs of the text."""
    text = F.coalesce("text", F.lit(" "))
    return rows.select(
        "conv_id",
        "turn",
        F.coalesce("role", F.lit(" ")).alias("role"),
        text.alias("text"),
        F.unhex(F.sha2(text, 256)).alias("digest"),
        (~text.rlike(r"[^\x20\x09-\x0D]")).alias("blank"),
        (~text.rlike(r"[.!?][\x20\x09-\x0D]*\z")).alias("truncated"),
    )


ORDER = ["conv_id", "turn", "role", "digest"]


def _classed(rows: DataFrame) -> DataFrame:
    """One row per distinct (conv_id, turn, role, text) with its number ``n``, and whether role and text came at an earlier turn.

    The first is looked up by the whole key, turn included, so a text that fills a conversation spreads over all tasks.
    """
    met = rows.groupBy(*ORDER).agg(F.count(F.lit(1)).alias("n"), F.first("blank").alias("blank"), F.first("truncated").alias("truncated"))
    firsts = rows.groupBy("conv_id", "role", "digest").agg(F.min(F.struct("turn")).alias("first"))
    firsts = firsts.select(
        F.col("conv_id").alias("_conv"), F.col("first.turn").alias("_turn"), F.col("role").alias("_role"), F.col("digest").alias("_digest"), F.lit(True).alias("new")
    )

    def same(column: str, other: str) -> Column:
        return F.col(column).eqNullSafe(F.col(other))

    joined = met.join(
        firsts, same("conv_id", "_conv") & same("turn", "_turn") & (F.col("role") == F.col("_role")) & (F.col("digest") == F.col("_digest")), "left"
    )
    return joined.select(*ORDER, "n", "blank", "truncated", F.col("new").isNull().alias("seen"))


_SEGMENT = (
    "conv_id {kind}, part int, place long, first string, last string, least {turn}, greatest {turn}, turns long, "
    "blank long, duplicate long, truncated long, illegal long, costs array<long>, audits array<string>"
)


class _Segment:
    """What one interval of a conversation's rows comes to."""

    def __init__(self, conv_id):
        self.conv_id, self.rows, self.cells = conv_id, 0, []
        self.first = self.last = self.least = self.greatest = None
        self.turns = self.blank = self.duplicate = self.truncated = self.illegal = 0

    def add(self, turn, role: str, n: int, blank: bool, truncated: bool, seen: bool, known: dict) -> None:
        initial = role[:1]
        if self.last is None:
            self.first = initial
        else:
            self.illegal += self.last + initial not in LEGAL
        self.illegal += (n - 1) * (initial + initial not in LEGAL)
        self.last = initial
        if turn is not None and turn != self.greatest:
            self.least = turn if self.least is None else self.least
            self.greatest = turn
            self.turns += 1
        must_go = blank or seen
        if blank:
            self.blank += n
        else:
            self.duplicate += n if seen else n - 1
            self.truncated += truncated and not seen
        key = (initial if initial in "sua" else "", must_go, truncated)
        if key not in known:
            known[key] = row_cell(*key)
        self.cells.append(known[key])
        if n > 1:
            self.cells.append(deleted_cell(n - 1))
        self.rows += 1

    def values(self) -> tuple:
        cell = parse(self.cells)
        return (
            self.first, self.last, self.least, self.greatest, self.turns, self.blank, self.duplicate, self.truncated, self.illegal,
            [x and x[0] for x in cell], [x and x[1] for x in cell],
        )


def _segments(rows: DataFrame, segment: int) -> DataFrame:
    """Rows sorted by range, as one row per segment: ``part, place`` order the segments of a conversation."""
    kind, turn = (rows.schema[name].dataType.simpleString() for name in ("conv_id", "turn"))
    schema = _SEGMENT.format(kind=kind, turn=turn)

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, place, now, known = TaskContext.get().partitionId(), 0, None, {}
        types: pa.Schema | None = None
        for batch in batches:
            if types is None:
                types = _arrow(batch.schema.field("conv_id").type, batch.schema.field("turn").type)
            done = []
            for conv_id, turn_, role, n, blank, truncated, seen in zip(*(column.to_pylist() for column in batch.columns), strict=True):
                if now is not None and (now.conv_id != conv_id or now.rows >= segment):
                    done.append((now.conv_id, part, place, *now.values()))
                    place, now = place + 1, None
                now = now or _Segment(conv_id)
                now.add(turn_, role, n, blank, truncated, seen, known)
            yield pa.RecordBatch.from_pylist([dict(zip(types.names, row, strict=True)) for row in done], types)
        if now is not None:
            yield pa.RecordBatch.from_pylist([dict(zip(types.names, (now.conv_id, part, place, *now.values()), strict=True))], types)

    ordered = rows.repartitionByRange(*ORDER).sortWithinPartitions(*ORDER)
    return ordered.select("conv_id", "turn", "role", "n", "blank", "truncated", "seen").mapInArrow(run, schema)


def _arrow(kind: pa.DataType, turn: pa.DataType) -> pa.Schema:
    longs, texts = pa.list_(pa.int64()), pa.list_(pa.string())
    return pa.schema(
        [("conv_id", kind), ("part", pa.int32()), ("place", pa.int64()), ("first", pa.string()), ("last", pa.string()), ("least", turn), ("greatest", turn)]
        + [(name, pa.int64()) for name in ("turns", "blank", "duplicate", "truncated", "illegal")]
        + [("costs", longs), ("audits", texts)]
    )


REPORT = ["gaps", "blank", "duplicate", "truncated", "illegal", "cost"]


def report(rows: DataFrame, segment: int = SEGMENT) -> DataFrame:
    """``conv_id, gaps, blank, duplicate, truncated, illegal, cost, audit``: one row per conversation of ``conv_id, turn, role, text``.

    Rows of a conversation are ordered by turn, nulls first, then role and the text's SHA-256; rows equal in all follow one another, so
    repeated rows are duplicates of the first. A null conv_id is a conversation of its own. Null roles and texts are one space.
    Each row has its first fault of: blank (no character but white space), duplicate (role and text came before), truncated (last
    such character not one of ``.!?``). ``gaps`` counts turns missing between the smallest and the largest, nulls left out,
    ``illegal`` neighbouring rows whose role initials aren't su, ua or au. ``cost`` and ``audit`` are the cheapest repair, see the
    module; only ``s``, ``u`` and ``a`` can be kept, any other role is given a new one or goes. Other columns are not read.

    A task parses at most ``segment`` rows into one cell; a second one joins the cells of a conversation.
    """
    segments = _segments(_classed(_described(rows)), segment)
    kind = rows.schema["conv_id"].dataType.simpleString()
    names = segments.columns

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own, types = [], None
        for batch in batches:
            types = types or batch.schema.field("conv_id").type
            done = []
            for row in zip(*(column.to_pylist() for column in batch.columns), strict=True):
                row = dict(zip(names, row, strict=True))
                if own and own[0]["conv_id"] != row["conv_id"]:
                    done.append(_joined(own))
                    own = []
                own.append(row)
            yield _reports(done, types)
        if own:
            yield _reports([_joined(own)], types)

    gathered = segments.repartition("conv_id").sortWithinPartitions("conv_id", "part", "place")
    return gathered.mapInArrow(run, f"conv_id {kind}, " + ", ".join(f"{name} long" for name in REPORT) + ", audit string")


def _joined(segments: list[dict]) -> tuple:
    """The report of a conversation from its segments in order."""
    cells = [[None if c is None else (c, a) for c, a in zip(s["costs"], s["audits"], strict=True)] for s in segments]
    turns, illegal = sum(s["turns"] for s in segments), sum(s["illegal"] for s in segments)
    greatest = None
    for before, after in zip([None, *segments], segments, strict=False):
        if before is not None:
            illegal += before["last"] + after["first"] not in LEGAL
        if after["least"] is not None and after["least"] == greatest:
            turns -= 1  # the turn goes on
        greatest = greatest if after["greatest"] is None else after["greatest"]
    least = next((s["least"] for s in segments if s["least"] is not None), None)
    gaps = 0 if least is None else greatest - least + 1 - turns
    return (segments[0]["conv_id"], gaps, *(sum(s[name] for s in segments) for name in REPORT[1:4]), illegal, *best(parse(cells)))


def _reports(rows: list[tuple], kind: pa.DataType) -> pa.RecordBatch:
    types = pa.schema([("conv_id", kind), *((name, pa.int64()) for name in REPORT), ("audit", pa.string())])
    return pa.RecordBatch.from_pylist([dict(zip(types.names, row, strict=True)) for row in rows], types)


def _together(rows: DataFrame, reports: DataFrame) -> DataFrame:
    """Each conversation's report, then its rows in order; partitions hold whole conversations and are read as streams."""
    described = _described(rows).select(*ORDER, "text")
    lines = described.withColumn("kind", F.lit(1))
    heads = reports.select("conv_id", F.col("audit").alias("text"), F.lit(0).alias("kind"), *REPORT)
    both = heads.unionByName(lines, allowMissingColumns=True).repartition("conv_id").sortWithinPartitions("conv_id", "kind", "turn", "role", "digest")
    return both.select("conv_id", "kind", "role", "text", *REPORT)


def repaired(rows: DataFrame, reports: DataFrame) -> DataFrame:
    """``conv_id, place, edit, role, text``: the repaired conversations, from the rows that ``reports`` was made of.

    ``place`` counts from 0; ``edit`` is K (kept), R (given a role) or I (inserted, with empty text).
    """
    kind = rows.schema["conv_id"].dataType.simpleString()

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        edits, place, conv_id = Edits(""), 0, None
        for batch in batches:
            done = []
            for conv_id, head, role, text in zip(*(batch.column(k).to_pylist() for k in range(4)), strict=True):
                if head == 0:
                    edits, place = Edits(text), 0
                    made = list(edits.inserted())
                else:
                    made = [x for x in (edits.row(role, text), *edits.inserted()) if x]
                for edit in made:
                    done.append((conv_id, place, *edit))
                    place += 1
            columns = list(zip(*done, strict=True)) if done else [()] * 5
            types = [batch.schema.field("conv_id").type, pa.int64(), pa.string(), pa.string(), pa.string()]
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, t) for c, t in zip(columns, types, strict=True)], ["conv_id", "place", "edit", "role", "text"]
            )

    return _together(rows, reports).mapInArrow(run, f"conv_id {kind}, place long, edit string, role string, text string")


def digests(rows: DataFrame, reports: DataFrame) -> DataFrame:
    """``reports`` with ``repaired_sha256``, of the repaired lines ``role:text`` joined by line feeds.

    SHA-256 reads a conversation from its start to its end, so one task reads all of it, as a stream: memory holds one batch
    and the conversation's audit. A conversation without rows has the hash of the empty string.
    """
    kind = rows.schema["conv_id"].dataType.simpleString()

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        edits, head, state, lines = Edits(""), None, hashlib.sha256(), 0

        def finished() -> tuple:
            return (*head, edits.audit, state.hexdigest())

        types = None
        for batch in batches:
            types = types or pa.schema(
                [("conv_id", batch.schema.field("conv_id").type), *((n, pa.int64()) for n in REPORT), ("audit", pa.string()), ("repaired_sha256", pa.string())]
            )
            done = []
            for conv_id, kind_, role, text, *counts in zip(*(column.to_pylist() for column in batch.columns), strict=True):
                if kind_ == 0:
                    if head is not None:
                        done.append(finished())
                    edits, head, state, lines = Edits(text), (conv_id, *counts), hashlib.sha256(), 0
                    made = list(edits.inserted())
                else:
                    made = [x for x in (edits.row(role, text), *edits.inserted()) if x]
                for _, given, own in made:
                    state.update(f"{chr(10) if lines else ''}{given}:{own}".encode())
                    lines += 1
            yield pa.RecordBatch.from_pylist([dict(zip(types.names, row, strict=True)) for row in done], types)
        if head is not None:
            yield pa.RecordBatch.from_pylist([dict(zip(types.names, finished(), strict=True))], types)

    schema = f"conv_id {kind}, " + ", ".join(f"{name} long" for name in REPORT) + ", audit string, repaired_sha256 string"
    return _together(rows, reports).mapInArrow(run, schema)


def damaged_and_repaired(rows: DataFrame, segment: int = SEGMENT) -> DataFrame:
    """The report and digest of every conversation of ``rows`` after :func:`damage`.

    A conversation of which no row is left has zeros, an empty audit and the hash of the empty string. No rows give no rows.
    """
    with written_once(damage(rows)) as left:
        own = report(left, segment).withColumnRenamed("conv_id", "_conv")
        every = rows.select("conv_id").distinct()
        reports = every.join(own, F.col("conv_id").eqNullSafe(F.col("_conv")), "left").drop("_conv")
        zeros = reports.fillna(0, REPORT).fillna("", ["audit"])
        return cut_lineage(digests(left, zeros))
