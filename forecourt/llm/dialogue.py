"""Conversation repair by weighted interval parsing.

A well-formed conversation is empty, or an optional system turn and then user and assistant in
turn. Rows may be kept, given another role or deleted, and empty turns may be inserted, each at a
cost. The repair grammar is in Chomsky normal form: a nonterminal is the first and the last role
of what a span of rows becomes (``E``: nothing), and a binary rule joins two neighbours whose
roles may follow each other. A cell is the least (cost, audit) of one span and nonterminal, the
audit being the initials of its edits. The cells of one row are closed under insertions before
and after it, so insertions need no rows of their own later on.

Rows are sorted by conversation and turn over all tasks, which may cut a long conversation
anywhere. A task parses blocks of ``BLOCK`` rows by all splits of all intervals, and joins
neighbouring spans of equal length bottom-up. Equal costs are never settled wrongly by a part:
of two audits of one span, neither begins with the other unless it costs more. What is left, one
span per conversation and task, meets the texts again, sorted once by conversation; repaired
turns leave in that order while the texts stream by, so no conversation is ever held as a whole.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import lru_cache

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from forecourt.llm.stages import sliced

BLOCK = 8
REROLE, DELETE, INSERT, TRUNCATED = 2, 3, 2, 1
_FOLLOWS = {"s": "u", "u": "a", "a": "u"}
_ROLES = {"u": "user", "a": "assistant"}

# E, then (first, last) role of what a span becomes.
SYMBOLS = ("E", "ss", "su", "sa", "uu", "ua", "au", "aa")
RULES = [(i, i, 0) for i in range(len(SYMBOLS))] + [(i, 0, i) for i in range(1, len(SYMBOLS))] + [
    (SYMBOLS.index(x[0] + y[1]), i, j) for i, x in enumerate(SYMBOLS) for j, y in enumerate(SYMBOLS) if i and j and _FOLLOWS[x[1]] == y[0]]
ACCEPTED = [SYMBOLS.index(s) for s in ("E", "ua", "sa")]

Cell = tuple[int, str] | None
Cells = tuple[Cell, ...]


def _least(a: Cell, b: Cell) -> Cell:
    return b if a is None or b is not None and b < a else a


def joined(left: Cells, right: Cells) -> Cells:
    """The cells of two neighbouring spans together."""
    out: list[Cell] = [None] * len(SYMBOLS)
    for parent, i, j in RULES:
        if (a := left[i]) is not None and (b := right[j]) is not None:
            cost = a[0] + b[0]
            if (best := out[parent]) is None or cost <= best[0]:
                out[parent] = _least(best, (cost, a[1] + b[1]))
    return tuple(out)


def _closed(cells: Cells, inserted: Cells) -> Cells:
    """Cells with any insertions before and after."""
    while True:
        more = tuple(_least(_least(c, a), b) for c, a, b in zip(cells, joined(inserted, cells), joined(cells, inserted)))
        if more == cells:
            return cells
        cells = more


_SINGLE: Cells = tuple((INSERT, "I") if s in ("uu", "aa") else None for s in SYMBOLS)
INSERTED = _closed(_SINGLE, _SINGLE)


def leaf(token: str) -> Cells:
    """The cells of one row: ``x`` must go, s u a are roles and o another one, in capitals where the text is cut off."""
    cells: list[Cell] = [None] * len(SYMBOLS)
    cells[0] = (DELETE, "D")
    if token != "x":
        role, cut = token.lower(), TRUNCATED if token.isupper() else 0
        if role != "o":
            cells[SYMBOLS.index(role * 2)] = (cut, "K")
        for s in ("uu", "aa"):
            cells[SYMBOLS.index(s)] = _least(cells[SYMBOLS.index(s)], (REROLE + cut, "R"))
    return _closed(tuple(cells), INSERTED)


@lru_cache(1 << 14)
def parsed(tokens: str) -> Cells:
    """The cells of a block of rows, by spans of growing length and all their splits."""
    chart = {(i, i + 1): leaf(t) for i, t in enumerate(tokens)}
    for size in range(2, len(tokens) + 1):
        for i in range(len(tokens) - size + 1):
            spans = (joined(chart[i, k], chart[k, i + size]) for k in range(i + 1, i + size))
            best = next(spans)
            for other in spans:
                best = tuple(map(_least, best, other))
            chart[i, i + size] = best
    return chart[0, len(tokens)]


class Spans:
    """Neighbouring spans of one conversation, joined when two have the same length."""

    def __init__(self):
        self.waiting, self.held = "", []

    def push(self, tokens: str) -> None:
        self.waiting += tokens
        while len(self.waiting) >= BLOCK:
            block, self.waiting = self.waiting[:BLOCK], self.waiting[BLOCK:]
            self.add(parsed(block))

    def add(self, cells: Cells, level: int = 0) -> None:
        while self.held and self.held[-1][0] == level:
            cells, level = joined(self.held.pop()[1], cells), level + 1
        self.held.append((level, cells))

    def cells(self) -> Cells | None:
        """The cells of all rows so far; None without rows."""
        rest = parsed(self.waiting) if self.waiting else None
        for _, cells in reversed(self.held):
            rest = cells if rest is None else joined(cells, rest)
        return rest


class Summary:
    """What is counted of a run of rows of one conversation, in order; runs add up from left to right."""

    COUNTS = ("blank", "duplicate", "truncated", "illegal")

    def __init__(self):
        self.counts = dict.fromkeys(self.COUNTS, 0)
        self.first = self.last = None  # role initials, once there are rows
        self.low = self.high = None  # turns, nulls left out
        self.turns = 0
        self.spans = Spans()

    def row(self, turn: int | None, initial: str, copies: int, blank: bool, again: bool, cut: bool) -> None:
        """``copies`` equal rows; all but the first repeat it."""
        if not copies:
            return
        self._follow(initial, initial)
        self.counts["illegal"] += copies - 1
        if turn is not None:
            self._turns(turn, turn, 1)
        if blank:
            self.counts["blank"] += copies
            tokens = "x" * copies
        else:
            self.counts["duplicate"] += copies - (not again)
            self.counts["truncated"] += cut and not again
            known = initial if initial in _FOLLOWS else "o"
            tokens = "x" * copies if again else (known.upper() if cut else known) + "x" * (copies - 1)
        self.spans.push(tokens)

    def _follow(self, first: str, last: str) -> None:
        if self.first is None:
            self.first = first
        else:
            self.counts["illegal"] += _FOLLOWS.get(self.last) != first
        self.last = last

    def _turns(self, low: int, high: int, turns: int) -> None:
        # The rows come by turn, so only the seam of two runs can hold one turn twice.
        self.turns += turns - (self.high is not None and self.high == low)
        self.low, self.high = low if self.low is None else self.low, high

    def run(self, r: dict) -> None:
        """Add a later run, as ``values`` gives it."""
        if r["first"] is None:
            return
        for name in self.COUNTS:
            self.counts[name] += r[name]
        self._follow(r["first"], r["last"])
        if r["low"] is not None:
            self._turns(r["low"], r["high"], r["turns"])
        self.spans.add(tuple(None if c < 0 else (c, a) for c, a in zip(r["costs"], r["audits"])))

    def values(self) -> dict:
        cells = self.spans.cells()
        return {**self.counts, "first": self.first, "last": self.last, "low": self.low, "high": self.high, "turns": self.turns,
                "costs": [-1 if c is None else c[0] for c in cells or ()], "audits": ["" if c is None else c[1] for c in cells or ()]}

    def report(self) -> dict:
        cells = self.spans.cells()
        cost, audit = min(cells[i] for i in ACCEPTED if cells[i] is not None) if cells else (0, "")
        gaps = 0 if self.low is None else self.high - self.low + 1 - self.turns
        return {"gaps": gaps, **self.counts, "cost": cost, "audit": audit}


RUN = ("blank bigint, duplicate bigint, truncated bigint, illegal bigint, first string, last string, low bigint, high bigint, "
       "turns bigint, costs array<bigint>, audits array<string>")
_RUN = pa.struct([(c, pa.int64()) for c in Summary.COUNTS] + [("first", pa.string()), ("last", pa.string()), ("low", pa.int64()),
                 ("high", pa.int64()), ("turns", pa.int64()), ("costs", pa.list_(pa.int64())), ("audits", pa.list_(pa.string()))])
REPORT = "gaps bigint, blank bigint, duplicate bigint, truncated bigint, illegal bigint, cost bigint, audit string"
_REPORT = pa.struct([(c, pa.int64()) for c in ("gaps", *Summary.COUNTS, "cost")] + [("audit", pa.string())])
_ANY = object()  # no conversation yet


def damage(conversations: DataFrame) -> DataFrame:
    """(conv_id, turn, role, text, copies): rows spoilt by a hash of conversation and turn; nulls in role and text are a space.

    No copies: the row is dropped; two: it is repeated at once.
    """
    named = F.concat_ws(":", *(F.coalesce(F.col(c).cast("string"), F.lit(" ")) for c in ("conv_id", "turn")))
    dice = F.crc32(named.cast("binary")) % 20
    text, role = F.coalesce("text", F.lit(" ")), F.coalesce("role", F.lit(" "))
    return conversations.select(
        "conv_id", "turn", F.when(dice == 4, "user").otherwise(role).alias("role"),
        F.when(dice == 1, "").when(dice == 2, F.translate(text, ".!?", "")).otherwise(text).alias("text"),
        F.when(dice == 0, 0).when(dice == 3, 2).otherwise(1).alias("copies"))


def _shown(text: Column) -> Column:
    return text.rlike(r"[^\x20\x09-\x0D]")


def _ordered(*more: str) -> list[Column]:
    return [F.col("conv_id").asc_nulls_first(), *map(F.col, more), F.col("turn").asc_nulls_first(), F.col("role"), F.col("digest")]


def runs(rows: DataFrame) -> DataFrame:
    """(conv_id, task, run): the summaries of the rows of a conversation, one per task that its rows were sorted into.

    Equal rows are one row with a count before they are sorted; a repeated role and text is found
    by aggregates, which combine before the shuffle.
    """
    light = rows.select("conv_id", "turn", "role", F.unhex(F.sha2("text", 256)).alias("digest"), F.col("copies").cast("bigint").alias("copies"),
                        (~_shown(F.col("text"))).alias("blank"), (~F.col("text").rlike(r"[.!?][\x20\x09-\x0D]*\z")).alias("cut"))
    said = light.groupBy("conv_id", "turn", "role", "digest").agg(
        F.sum("copies").alias("copies"), F.first("blank").alias("blank"), F.first("cut").alias("cut"))
    same = ["conv_id", "role", "digest"]
    # Null turns come first; only texts said at two turns are kept.
    spoken = said.where("copies > 0").groupBy(*same).agg(F.count("*").alias("n"), F.min(F.struct(
        F.col("turn").isNotNull().alias("some"), "turn")).alias("first")).where("n > 1")
    spoken = spoken.select(*[F.col(c).alias(f"of_{c}") for c in same], F.col("first.turn").alias("first"), F.lit(True).alias("repeats"))
    met = said.join(spoken, F.col("conv_id").eqNullSafe(F.col("of_conv_id")) & (F.col("role") == F.col("of_role"))
                    & (F.col("digest") == F.col("of_digest")), "left")
    marked = met.select("conv_id", "turn", "role", "digest", F.substring("role", 1, 1).alias("initial"), "copies", "blank", "cut",
                        (F.coalesce("repeats", F.lit(False)) & ~F.col("turn").eqNullSafe(F.col("first"))).alias("again"))
    kind = dict(rows.dtypes)["conv_id"]

    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        task, now, summary = TaskContext.get().partitionId(), _ANY, Summary()
        for batch in sliced(batches):
            done: list[tuple] = []
            columns = [batch.column(c).to_pylist() for c in ("conv_id", "turn", "initial", "copies", "blank", "again", "cut")]
            for conv, *row in zip(*columns):
                if conv != now:
                    if now is not _ANY:
                        done.append((now, summary.values()))
                    now, summary = conv, Summary()
                summary.row(*row)
            yield from _made(done, batch.schema.field("conv_id").type, task)
        if now is not _ANY:
            yield from _made([(now, summary.values())], batch.schema.field("conv_id").type, task)

    ordered = marked.repartitionByRange(*_ordered()).sortWithinPartitions(*_ordered())
    return ordered.mapInArrow(counted, f"conv_id {kind}, task int, run struct<{', '.join(f.replace(' ', ':', 1) for f in RUN.split(', '))}>")


def _made(done: list[tuple], kind: pa.DataType, task: int) -> Iterator[pa.RecordBatch]:
    if done:
        yield pa.record_batch({"conv_id": pa.array([c for c, _ in done], kind), "task": pa.array([task] * len(done), pa.int32()),
                               "run": pa.array([r for _, r in done], _RUN)})


def repair(rows: DataFrame) -> DataFrame:
    """(conv_id, at, role, text, edit, report) from (conv_id, turn, role, text, copies), sorted by conversation within tasks.

    The row at 0 of a conversation has its report and nothing else: ``gaps`` in its turns, its
    ``blank``, ``duplicate``, ``truncated`` rows (the first fault of a row counts) and ``illegal``
    neighbours, and the ``cost`` and ``audit`` of the cheapest repair. The repaired turns follow
    at 1, 2, ..., ``edit`` being K, R or I.

    Rows of a conversation are read by turn, nulls first; rows of one turn by role and then by the
    SHA-256 of their text. Rows without conv_id are one conversation. A row with no copies only
    names its conversation; a conversation without other rows is empty and costs nothing. Role
    and text must not be null. An empty table gives an empty result.
    """
    kind = dict(rows.dtypes)["conv_id"]
    of_run = "struct<" + ", ".join(f.replace(" ", ":", 1) for f in RUN.split(", ")) + ">"
    found = runs(rows).select("conv_id", "task", "run", F.lit(None).cast("bigint").alias("turn"), F.lit(None).cast("string").alias("role"),
                              F.lit(None).cast("string").alias("text"), F.lit(None).cast("binary").alias("digest"), F.lit(0).alias("copies"))
    said = rows.where("copies > 0").select(
        "conv_id", F.lit((1 << 31) - 1).alias("task"), F.lit(None).cast(of_run).alias("run"), "turn", "role", "text",
        F.unhex(F.sha2("text", 256)).alias("digest"), F.col("copies").cast("int").alias("copies"))
    dealt = found.union(said).repartition("conv_id").sortWithinPartitions(*_ordered("task")).drop("digest", "turn")
    names = ("conv_id", "at", "role", "text", "edit", "report")

    def repaired(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, summary, report, left, at = _ANY, Summary(), None, iter(""), 0
        out: list[tuple] = []
        expected = "u"

        def insert(edits: Iterator[str]) -> str | None:
            """Turns inserted up to the next edit of a row; that edit."""
            nonlocal at, expected
            for edit in edits:
                if edit != "I":
                    return edit
                at += 1
                out.append((now, at, _ROLES[expected], "", edit, None))
                expected = _FOLLOWS[expected]
            return None

        def opened() -> None:
            nonlocal report, left
            if report is None and now is not _ANY:
                report = summary.report()
                out.append((now, 0, None, None, None, report))
                left = iter(report["audit"])

        def made(kind: pa.DataType) -> pa.RecordBatch:
            kinds = (kind, pa.int64(), pa.string(), pa.string(), pa.string(), _REPORT)
            columns = zip(*out) if out else [()] * len(names)
            return pa.record_batch([pa.array(c, k) for c, k in zip(columns, kinds)], names=list(names))

        for batch in sliced(batches):
            for conv, run, role, text, copies in zip(*(batch.column(c).to_pylist() for c in ("conv_id", "run", "role", "text", "copies"))):
                if conv != now:
                    opened()
                    insert(left)
                    now, summary, report, at, expected = conv, Summary(), None, 0, "u"
                if run is not None:
                    summary.run(run)
                    continue
                opened()
                for _ in range(copies):
                    edit = insert(left)
                    if edit == "K":
                        at += 1
                        out.append((now, at, role, text, edit, None))
                        expected = _FOLLOWS[role[0]]
                    elif edit == "R":
                        at += 1
                        out.append((now, at, _ROLES[expected], text, edit, None))
                        expected = _FOLLOWS[expected]
            yield made(batch.schema.field("conv_id").type)
            out.clear()
        if now is not _ANY:
            opened()
            insert(left)
            yield made(batch.schema.field("conv_id").type)

    return dealt.mapInArrow(repaired, f"conv_id {kind}, at bigint, role string, text string, edit string, "
                                      f"report struct<{', '.join(f.replace(' ', ':', 1) for f in REPORT.split(', '))}>")


def digests(repaired: DataFrame) -> DataFrame:
    """(conv_id, report, repaired_sha256): per conversation the SHA-256 of its ``role:text`` lines, from the frame of ``repair``.

    Reads the rows in the order in which ``repair`` gives them, so nothing may shuffle between the two.
    """
    kind = dict(repaired.dtypes)["conv_id"]

    def hashed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        open_, digest = None, hashlib.sha256()

        def made(done: list[tuple], batch: pa.RecordBatch) -> pa.RecordBatch:
            kinds = (batch.schema.field("conv_id").type, _REPORT, pa.string())
            columns = zip(*done) if done else [()] * 3
            return pa.record_batch([pa.array(c, k) for c, k in zip(columns, kinds)], names=["conv_id", "report", "repaired_sha256"])

        for batch in sliced(batches):
            done: list[tuple] = []
            for conv, at, role, text, report in zip(*(batch.column(c).to_pylist() for c in ("conv_id", "at", "role", "text", "report"))):
                if at == 0:
                    if open_:
                        done.append((*open_, digest.hexdigest()))
                    open_, digest = (conv, report), hashlib.sha256()
                else:
                    digest.update(f"{role}:{text}".encode() if at == 1 else f"\n{role}:{text}".encode())
            yield made(done, batch)
        if open_:
            yield made([(*open_, digest.hexdigest())], batch)

    return repaired.mapInArrow(hashed, f"conv_id {kind}, report {dict(repaired.dtypes)['report']}, repaired_sha256 string")
