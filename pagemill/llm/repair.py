"""Repair of the structure of conversations by the cheapest edits.

A conversation is well formed if the initials of its roles are
``(s?(ua)+)?``. Its rows, taken by turn, are edited: keep costs 0, giving a
row the role user or assistant 3, deleting it 4, inserting an empty user or
assistant row 3; a truncated row that stays costs 3 more, a blank or repeated
row has to go. The edits' initials in order are the audit. Of all cheapest
audits the least in ASCII order is taken, and it determines the result.

Edits are paths in a lattice: a node is a number of rows dealt with and the
state of the pattern. ``least_path`` searches from both ends at once. Labels
are a cost and a least audit; of two cheapest audits that lead to the same node
neither begins with the other (what is left could only be insertions, which
cost something), so the least label stays the least whatever follows. Within a
cost, nodes are settled in the order of their rows, since only keeping is free
and it goes on by a row. The search ends when the next two labels together cost
more than the best meeting, so all meetings of equal cost have been seen.

Rows are cut by ranges of conversation and turn, so a long conversation lies in
several tasks, and a task holds at most ``PIECE_ROWS`` rows or some
``PIECE_BYTES`` of text at a time. A
conversation that is whole within a task is solved there. Of every other piece
the least paths between all states are found, and pieces are joined as matrices
whose product takes the least sum; ``FAN`` of them at a time, so no task gathers
a long conversation. Its text is only streamed.

Defined results: a null role or text counts as one space; a null conversation is a
conversation; rows with a null turn come first; rows with equal turns are in
the order of role and text. Equal rows are counted before anything is
shuffled: the first of them is edited, the others are repeats. Other columns
are ignored. An empty table gives no rows. Texts are handled one at a time as
bytes; a long one costs its own size.
"""

from __future__ import annotations

import heapq
from collections.abc import Callable, Iterator, Sequence
from dataclasses import dataclass, field
from functools import lru_cache
from hashlib import sha256
from typing import Any

import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from pagemill.llm.batches import values
from pagemill.operators.ordering import null_safe_join
from pagemill.session import ship_package
from pagemill.storage import cut_lineage

KEEP, REROLE, DELETE, INSERT, TRUNCATED = 0, 3, 4, 3, 3
START, SYSTEM, USER, ASSISTANT = range(4)  # what the rows so far end with
ENDS = (START, ASSISTANT)
AFTER = {(START, "s"): SYSTEM, (START, "u"): USER, (SYSTEM, "u"): USER, (USER, "a"): ASSISTANT, (ASSISTANT, "u"): USER}
LEGAL = ("su", "ua", "au")
PIECE_ROWS = 1_024
PIECE_BYTES = 8 << 20
RECORDS = 512  # conversations in a batch that a task hands on
FAN = 32
PREFIX = 100  # letters of a text that cut ranges; rows are in the order of the whole text within them
SPACES = b" \t\n\x0b\x0c\r"

Label = tuple[int, str]  # cost and audit
Step = tuple[str, bool, bool]  # initial, must be deleted, truncated


@lru_cache(maxsize=None)
def row_edges(step: Step) -> tuple[tuple[int, int, int, str], ...]:
    """``from, to, cost, letter`` of every edit of one row."""
    initial, forced, truncated = step
    edges = [(s, s, DELETE, "D") for s in range(4)]
    if not forced:
        extra = TRUNCATED * truncated
        for s in range(4):
            if (s, initial) in AFTER:
                edges.append((s, AFTER[s, initial], KEEP + extra, "K"))
            edges += [(s, AFTER[s, r], REROLE + extra, "R") for r in "ua" if (s, r) in AFTER]
    return tuple(edges)


INSERTS = tuple((s, AFTER[s, r], INSERT, "I") for s in range(4) for r in "ua" if (s, r) in AFTER)


def least_path(steps: Sequence[Step], sources: Sequence[int], targets: Sequence[int]) -> Label | None:
    """The cheapest audit from a source state before the rows to a target state after them, the least of equal ones."""
    count = len(steps)
    ahead: dict[tuple[int, int], Label] = {(0, s): (0, "") for s in sources}
    back: dict[tuple[int, int], Label] = {(count, s): (0, "") for s in targets}
    # Entries are cost, rows from the heap's own end, state and audit.
    heaps = ([(0, 0, s, "") for s in sources], [(0, 0, s, "") for s in targets])
    best: Label | None = min(((0, "") for node in ahead if node in back), default=None)
    done: tuple[set, set] = (set(), set())
    while heaps[0] and heaps[1] and (best is None or heaps[0][0][0] + heaps[1][0][0] <= best[0]):
        side = 0 if heaps[0][0][:2] <= heaps[1][0][:2] else 1
        cost, rows, state, audit = heapq.heappop(heaps[side])
        if (rows, state) in done[side]:
            continue
        done[side].add((rows, state))
        own, other = (ahead, back) if side == 0 else (back, ahead)
        moves = [(0, edge) for edge in INSERTS]
        if rows < count:
            moves += [(1, edge) for edge in row_edges(steps[rows] if side == 0 else steps[count - rows - 1])]
        for by, (a, b, price, letter) in moves:
            if state != (a if side == 0 else b):
                continue
            beside = b if side == 0 else a
            node = (rows + by if side == 0 else count - rows - by, beside)
            label = (cost + price, audit + letter if side == 0 else letter + audit)
            if node in own and own[node] <= label:
                continue
            own[node] = label
            heapq.heappush(heaps[side], (label[0], rows + by, beside, label[1]))
            if node in other and (best is None or label[0] + other[node][0] <= best[0]):
                first, last = (label, other[node]) if side == 0 else (other[node], label)
                met = (first[0] + last[0], first[1] + last[1])
                best = met if best is None else min(best, met)
    return best


Paths = dict[tuple[int, int], Label]


def all_paths(steps: Sequence[Step]) -> Paths:
    """The least label between any two states; pairs without a path are left out."""
    found = {(a, b): least_path(steps, [a], [b]) for a in range(4) for b in range(4)}
    return {k: v for k, v in found.items() if v is not None}


def joined_paths(first: Paths, last: Paths) -> Paths:
    out: Paths = {}
    for (a, b), (cost, audit) in first.items():
        for c in range(4):
            if (b, c) in last:
                more, rest = last[b, c]
                if (a, c) not in out or cost + more <= out[a, c][0]:
                    met = (cost + more, audit + rest)
                    out[a, c] = min(out.get((a, c), met), met)
    return out


def spelled(audit: str, copies: Sequence[int]) -> str:
    """The audit with the deletion of each row's further copies after the row's own letter."""
    if all(n == 1 for n in copies):
        return audit
    left, out = iter(copies), []
    for letter in audit:
        out.append(letter if letter == "I" else letter + "D" * (next(left) - 1))
    return "".join(out)


class Repairer:
    """Applies an audit to rows as they come; knows which role the pattern wants next."""

    def __init__(self, audit: str):
        self.audit, self.at, self.placed = audit, 0, 0
        self.system = (len(audit) - audit.count("D")) % 2  # pairs, and one row more if a system row is first

    def _placed(self, role: bytes | None, text: bytes) -> tuple[bytes, bytes]:
        wanted = b"user" if (self.placed - self.system) % 2 == 0 else b"assistant"
        self.placed += 1
        return (wanted if role is None else role, text)

    def inserted(self) -> Iterator[tuple[bytes, bytes]]:
        while self.at < len(self.audit) and self.audit[self.at] == "I":
            self.at += 1
            yield self._placed(None, b"")

    def row(self, role: bytes, text: bytes, copies: int) -> Iterator[tuple[bytes, bytes]]:
        """What comes out up to the row and its copies; insertions after them come with the next row or at the end."""
        yield from self.inserted()
        letter = self.audit[self.at]
        self.at += copies
        if letter != "D":
            yield self._placed(role if letter == "K" else None, text)


@dataclass
class Piece:
    """Rows of one conversation in order: what was counted, and what a later piece has to be joined by."""

    conv: Any
    rows: list[tuple[bytes, bytes, int]] = field(default_factory=list)  # role, text, copies
    steps: list[Step] = field(default_factory=list)
    counts: dict[str, int] = field(default_factory=lambda: dict.fromkeys(("blank", "duplicate", "truncated", "illegal", "turns"), 0))
    initials: tuple[str, str] = ("", "")
    ends: tuple[int | None, int | None] = (None, None)  # the first and the last turn
    least: int | None = None
    size: int = 0

    def add(self, turn: int | None, role: bytes, text: bytes, copies: int, repeat: bool) -> None:
        initial = role.decode("utf-8", "replace")[:1]
        bare = text.rstrip(SPACES)
        blank, cut = not bare, bool(bare) and bare[-1:] not in (b".", b"!", b"?")
        count = self.counts
        if blank:
            count["blank"] += copies
        else:
            count["duplicate"] += copies - (not repeat)
            count["truncated"] += cut and not repeat
        pairs = copies - 1 if initial + initial not in LEGAL else 0
        count["illegal"] += pairs + bool(self.rows and self.initials[1] + initial not in LEGAL)
        count["turns"] += turn is not None and (not self.rows or turn != self.ends[1])
        self.initials = (self.initials[0] if self.rows else initial, initial)
        self.ends = (self.ends[0] if self.rows else turn, turn)
        self.least = turn if self.least is None else self.least
        self.size += len(text)
        self.rows.append((role, text, copies))
        self.steps.append((initial, blank or repeat, cut))

    @property
    def copies(self) -> list[int]:
        return [n for _, _, n in self.rows]

    @property
    def copies_cost(self) -> int:
        return DELETE * (sum(self.copies) - len(self.rows))


TURNS = T.ArrayType(T.StructType([T.StructField("role", T.StringType()), T.StructField("text", T.StringType())]))
RAW = T.ArrayType(T.StructType([T.StructField("role", T.BinaryType()), T.StructField("text", T.BinaryType()), T.StructField("copies", T.LongType())]))
LABELS = T.ArrayType(T.StructType([T.StructField("a", T.IntegerType()), T.StructField("b", T.IntegerType()), T.StructField("cost", T.LongType()), T.StructField("audit", T.StringType())]))
COUNTED = ("blank", "duplicate", "truncated", "illegal", "turns")


def _schema(key: T.DataType, *more: tuple[str, T.DataType]) -> T.StructType:
    return T.StructType([T.StructField("conv", key), *[T.StructField(n, t) for n, t in more]])


def _piece_schema(key: T.DataType) -> T.StructType:
    longs = [(n, T.LongType()) for n in ("place", "seq", *COUNTED, "least", "first_turn", "last_turn", "cost")]
    strings = [(n, T.StringType()) for n in ("first_initial", "last_initial", "audit")]
    return _schema(key, ("whole", T.BooleanType()), *longs, *strings, ("paths", LABELS), ("turns_out", TURNS), ("raw", RAW))


def _text(value: bytes) -> str:
    return value.decode("utf-8", "replace")


def _out(rows: Iterator[tuple[bytes, bytes]]) -> list[dict[str, str]]:
    return [{"role": _text(r), "text": _text(t)} for r, t in rows]


def piece_record(piece: Piece, whole: bool, place: int, seq: int) -> dict[str, Any]:
    record = {"conv": piece.conv, "whole": whole, "place": place, "seq": seq, **piece.counts, "least": piece.least}
    record |= {"first_turn": piece.ends[0], "last_turn": piece.ends[1], "first_initial": piece.initials[0], "last_initial": piece.initials[1]}
    if whole:
        cost, audit = least_path(piece.steps, [START], ENDS)
        audit = spelled(audit, piece.copies)
        repairer = Repairer(audit)
        turns = [out for row in piece.rows for out in repairer.row(*row)] + list(repairer.inserted())
        return record | {"cost": cost + piece.copies_cost, "audit": audit, "paths": None, "turns_out": _out(iter(turns)), "raw": None}
    paths = [{"a": a, "b": b, "cost": c + piece.copies_cost, "audit": spelled(x, piece.copies)} for (a, b), (c, x) in all_paths(piece.steps).items()]
    raw = [{"role": r, "text": t, "copies": n} for r, t, n in piece.rows]
    return record | {"cost": None, "audit": None, "paths": paths, "turns_out": None, "raw": raw}


def pieces(rows: DataFrame) -> DataFrame:
    """Conversations of ``conv, turn, role, text, copies, repeat``, solved if a task has all of one, else cut into pieces."""
    schema = _piece_schema(rows.schema["conv"].dataType)
    arrow = to_arrow_schema(schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        place, current, seq, first = TaskContext.get().partitionId(), None, 0, True
        ready, size = [], 0

        def close(piece: Piece, whole: bool) -> None:
            nonlocal size
            ready.append(piece_record(piece, whole, place, seq))
            size += piece.size

        def sent(least: int) -> Iterator[pa.RecordBatch]:
            nonlocal size
            if len(ready) >= least or ready and size >= PIECE_BYTES:
                yield pa.RecordBatch.from_pylist(ready, schema=arrow)
                ready.clear()
                size = 0

        for batch in batches:
            for conv, turn, role, text, copies, repeat in zip(*[values(batch, c) for c in batch.schema.names], strict=True):
                if current is not None and conv != current.conv:
                    # The first and the last conversation of a task can go on in others.
                    close(current, not first and seq == 0)
                    current, seq, first = None, 0, False
                if current is not None and (len(current.rows) >= PIECE_ROWS or current.size >= PIECE_BYTES):
                    close(current, False)
                    current, seq = None, seq + 1
                yield from sent(RECORDS)
                current = Piece(conv) if current is None else current
                current.add(turn, role, text, copies, repeat)
        if current is not None:
            close(current, False)
        yield from sent(1)

    prefix = F.substring("text", 1, PREFIX)
    spread = rows.repartitionByRange("conv", "turn", "role", prefix).sortWithinPartitions("conv", "turn", "role", "text")
    plain = spread.select("conv", "turn", F.col("role").cast("binary").alias("role"), F.col("text").cast("binary").alias("text"), "copies", "repeat")
    return plain.mapInArrow(run, schema)


def _combine(group: pd.DataFrame, columns: Sequence[str]) -> pd.DataFrame:
    """One piece of several in order."""
    group = group.sort_values("index")
    merged, paths = None, None
    for row in group.to_dict("records"):
        own = {(p["a"], p["b"]): (int(p["cost"]), p["audit"]) for p in row["paths"]}
        turns = [None if pd.isna(row[c]) else int(row[c]) for c in ("first_turn", "last_turn", "least")]
        if merged is None:
            merged, paths = row | dict(zip(("first_turn", "last_turn", "least"), turns, strict=True)), own
            continue
        merged["illegal"] += merged["last_initial"] + row["first_initial"] not in LEGAL
        merged["turns"] -= turns[0] is not None and turns[0] == merged["last_turn"]
        for c in COUNTED:
            merged[c] += row[c]
        merged |= {"last_initial": row["last_initial"], "last_turn": turns[1]}
        merged["least"] = turns[2] if merged["least"] is None else merged["least"]
        paths = joined_paths(paths, own)
    merged["index"] //= FAN
    merged["paths"] = [{"a": a, "b": b, "cost": c, "audit": x} for (a, b), (c, x) in paths.items()]
    frame = pd.DataFrame([merged], columns=columns)
    return frame.astype({c: "Int64" for c in ("first_turn", "last_turn", "least")})


def solved(cut: DataFrame) -> DataFrame:
    """``conv`` with counts, cost and audit of every conversation that lies in several pieces; ``cut`` has the pieces with their ``index``."""
    level = cut.select("conv", "index", *COUNTED, "least", "first_turn", "last_turn", "first_initial", "last_initial", "paths")
    schema, columns = level.schema, level.columns

    def combine(group: pd.DataFrame) -> pd.DataFrame:
        return _combine(group, columns)

    last = cut.agg(F.max("index")).first()[0] or 0
    while True:  # a whole conversation is one row after as many rounds as its pieces have digits to the base FAN
        level = level.groupBy("conv", F.floor(F.col("index") / FAN).alias("bucket")).applyInPandas(combine, schema)
        level = cut_lineage(level, "joined-pieces")
        if last < FAN:
            break
        last //= FAN
    good = F.filter("paths", lambda p: (p["a"] == START) & p["b"].isin(*ENDS))
    best = F.array_min(F.transform(good, lambda p: F.struct(p["cost"].alias("cost"), p["audit"].alias("audit"))))
    return level.withColumn("best", best).select("conv", *COUNTED, "least", F.col("last_turn"), F.col("best.cost").alias("cost"), F.col("best.audit").alias("audit"))


def _applied(cut: DataFrame, audits: DataFrame) -> DataFrame:
    """``conv, part, alone, turns`` of conversations in pieces: each is streamed through one task after its audit, a piece at a time."""
    key = cut.schema["conv"].dataType
    schema = _schema(key, ("part", T.LongType()), ("alone", T.BooleanType()), ("turns", TURNS))
    arrow = to_arrow_schema(schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        repairer, last = None, 0
        for batch in batches:
            for k in range(batch.num_rows):
                row = {c: batch.column(c)[k].as_py() for c in ("conv", "index", "last", "audit", "raw")}
                if row["index"] < 0:
                    repairer, last = Repairer(row["audit"]), row["last"]
                    continue
                turns = [out for r in row["raw"] for out in repairer.row(r["role"], r["text"], r["copies"])]
                if row["index"] == last:
                    turns += repairer.inserted()
                part = {"conv": row["conv"], "part": row["index"], "alone": False, "turns": _out(iter(turns))}
                yield pa.RecordBatch.from_pylist([part], schema=arrow)

    ends = cut.groupBy("conv").agg(F.max("index").alias("last"))
    heads = null_safe_join(audits, ends, ["conv"]).select("conv", F.lit(-1).cast("long").alias("index"), "last", "audit", F.lit(None).cast(RAW).alias("raw"))
    body = cut.select("conv", "index", F.lit(None).cast("long").alias("last"), F.lit(None).cast("string").alias("audit"), "raw")
    ordered = heads.unionByName(body).repartition("conv").sortWithinPartitions("conv", "index")
    return ordered.mapInArrow(run, schema)


@dataclass(frozen=True)
class Repair:
    """``audits``: a row for each conversation with rows. ``parts``: its repaired rows, in one part or in several in order."""

    audits: DataFrame
    parts: DataFrame


def repair(rows: DataFrame, key: str = "conv_id", turn: str = "turn", role: str = "role", column: str = "text", copies: str | None = None) -> Repair:
    """Repair every conversation of ``rows``; ``copies`` names a column with the number of times a row stands there.

    ``audits`` has ``conv, gaps, blank, duplicate, truncated, illegal, cost,
    audit``, ``parts`` has ``conv, part, alone, turns``.
    """
    ship_package(rows.sparkSession)
    times = F.lit(1) if copies is None else F.col(copies)
    plain = rows.select(
        F.col(key).alias("conv"),
        F.col(turn).cast("long").alias("turn"),
        F.coalesce(F.col(role), F.lit(" ")).alias("role"),
        F.coalesce(F.col(column), F.lit(" ")).alias("text"),
        times.cast("long").alias("times"),
    )
    counted = cut_lineage(plain.groupBy("conv", "turn", "role", "text").agg(F.sum("times").alias("copies")), "turns")
    said = counted.select("conv", "role", F.sha2("text", 256).alias("said"), F.struct(F.col("turn").isNotNull().alias("known"), "turn").alias("at"))
    firsts = said.groupBy("conv", "role", "said").agg(F.min("at").alias("first"), F.count("*").alias("n")).filter("n > 1").drop("n")
    firsts = cut_lineage(firsts, "first-said")
    at = F.struct(F.col("turn").isNotNull().alias("known"), "turn")
    marked = null_safe_join(counted.withColumn("said", F.sha2("text", 256)), firsts, ["conv", "role", "said"], "left")
    marked = marked.select("conv", "turn", "role", "text", "copies", F.coalesce(at > F.col("first"), F.lit(False)).alias("repeat"))
    found = cut_lineage(pieces(cut_lineage(marked, "marked")), "pieces")
    whole, rest = found.filter("whole"), found.filter("NOT whole")
    order = Window.partitionBy("conv").orderBy("place", "seq")
    numbers = rest.select("conv", "place", "seq", (F.row_number().over(order) - 1).cast("long").alias("index"))
    cut = cut_lineage(null_safe_join(rest, numbers, ["conv", "place", "seq"]), "cut")
    chained = solved(cut)
    names = ["conv", *COUNTED, "least", "last_turn", "cost", "audit"]
    audits = whole.select(*names).unionByName(chained.select(*names))
    missing = F.when(F.col("turns") > 0, F.col("last_turn") - F.col("least") + 1 - F.col("turns")).otherwise(0)
    audits = audits.select("conv", missing.cast("long").alias("gaps"), "blank", "duplicate", "truncated", "illegal", "cost", "audit")
    parts = whole.select("conv", F.lit(0).cast("long").alias("part"), F.lit(True).alias("alone"), F.col("turns_out").alias("turns"))
    return Repair(audits, parts.unionByName(_applied(cut, chained)))


def transcript_digests(parts: DataFrame) -> DataFrame:
    """``conv, digest``: SHA-256 of a conversation's ``role:text`` lines. One in several parts is streamed through one task."""
    schema = _schema(parts.schema["conv"].dataType, ("digest", T.StringType()))
    arrow = to_arrow_schema(schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        state, conv, empty = None, None, True

        def closed() -> pa.RecordBatch:
            return pa.RecordBatch.from_pylist([{"conv": conv, "digest": state.hexdigest()}], schema=arrow)

        for batch in batches:
            for k in range(batch.num_rows):
                own, part, turns = (batch.column(c)[k].as_py() for c in ("conv", "part", "turns"))
                if state is None or own != conv:
                    if state is not None:
                        yield closed()
                    state, conv, empty = sha256(), own, True
                for row in turns:
                    state.update(f"{'' if empty else chr(10)}{row['role']}:{row['text']}".encode())
                    empty = False
        if state is not None:
            yield closed()

    line = F.transform("turns", lambda r: F.concat(r["role"], F.lit(":"), r["text"]))
    alone = parts.filter("alone").select("conv", F.sha2(F.array_join(line, "\n"), 256).alias("digest"))
    several = parts.filter("NOT alone").select("conv", "part", "turns").repartition("conv").sortWithinPartitions("conv", "part")
    return alone.unionByName(several.mapInArrow(run, schema))


DAMAGES = 20


def damaged(rows: DataFrame, key: str = "conv_id", turn: str = "turn") -> DataFrame:
    """Rows with the faults a repair is tried on, by a hash of conversation and turn; ``copies`` is 2 for a repeated row."""
    kind = F.crc32(F.concat(*[F.coalesce(F.col(c).cast("string"), F.lit(" ")) if c else F.lit(":") for c in (key, None, turn)])) % DAMAGES
    text = F.coalesce("text", F.lit(" "))
    hurt = F.when(kind == 1, "").when(kind == 2, F.translate(text, ".!?", "")).otherwise(text)
    role = F.when(kind == 4, "user").otherwise(F.coalesce("role", F.lit(" ")))
    return rows.filter(kind != 0).select(F.col(key), F.col(turn), role.alias("role"), hurt.alias("text"), F.when(kind == 3, 2).otherwise(1).alias("copies"))
