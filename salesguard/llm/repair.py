"""Conversation structure repair by the cheapest edits.

A repaired conversation's role initials are ``(s?(ua)+)?``. Keeping a row is
free, another role costs 2, deleting 3 (the only choice for blank rows and
repeats), an empty turn put in 2, and a truncated row that stays 1. What may
come next depends on four states (nothing yet, after s, u or a), so a row is a
4 x 4 matrix of least costs, and rows one after the other are its min-plus
product. Equal consecutive symbols (role initial and fault) are one run, passed
in one step by the binary powers of the symbol's matrix, which are kept. Costs to
the end are found backwards, run by run; the choices are then unrolled forwards,
each time the letter least in ASCII that reaches the least cost.

A conversation may lie in several chunks: its fragments' matrices are chained,
each is unrolled for every state it may begin in, and the states are picked.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import cache

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from salesguard.llm.chunks import Texts, chunk_id, finish_texts, record_batch
from salesguard.llm.columns import WHITE, need
from salesguard.session import cut

KEEP, REROLE, DELETE, INSERT, LATE = 0, 2, 3, 2, 1
#: Role initials and faults; a symbol is initial * 3 + fault.
INITIALS = "sua"
OTHER = 3
SOUND, GONE, TRUNCATED = 0, 1, 2
#: The state after an initial, and the state that a turn put in, or a new role, leads to.
AFTER = {(0, 0): 1, (0, 1): 2, (1, 1): 2, (2, 2): 3, (3, 1): 2}
NEXT = (2, 2, 3, 2)
ROLE = {2: "user", 3: "assistant"}
NEVER = 1 << 60
#: Least cost of the turns to put in at the end.
END = (0, 2 * INSERT, INSERT, 0)
ENDING = ("", "II", "I", "")
NOTHING = hashlib.sha256(b"").hexdigest()

Matrix = tuple[tuple[int, ...], ...]
Vector = tuple[int, ...]


def times(a: Matrix, b: Matrix) -> Matrix:
    """Min-plus product."""
    return tuple(tuple(min(NEVER, *(a[p][k] + b[k][q] for k in range(4))) for q in range(4)) for p in range(4))


UNIT: Matrix = tuple(tuple(0 if p == q else NEVER for q in range(4)) for p in range(4))


def _inserts() -> Matrix:
    one = tuple(tuple(0 if p == q else INSERT if NEXT[p] == q else NEVER for q in range(4)) for p in range(4))
    return times(one, one)                                # three turns put in at a place are never cheapest


PUT_IN = _inserts()


@cache
def moves(symbol: int, state: int) -> tuple[tuple[str, int, int], ...]:
    """Ways to deal with a row: letter, cost, state after it."""
    initial, fault = divmod(symbol, 3)
    out = [("D", DELETE, state)]
    if fault != GONE:
        late = LATE if fault == TRUNCATED else 0
        if (state, initial) in AFTER:
            out.append(("K", KEEP + late, AFTER[state, initial]))
        out.append(("R", REROLE + late, NEXT[state]))
    return tuple(out)


@cache
def power(symbol: int, k: int) -> Matrix:
    """The matrix of 2^k rows of a symbol."""
    if k:
        return times(power(symbol, k - 1), power(symbol, k - 1))
    row = tuple(tuple(min([NEVER, *(c for _, c, to in moves(symbol, p) if to == q)]) for q in range(4)) for p in range(4))
    return times(PUT_IN, row)


def run_matrix(symbol: int, n: int) -> Matrix:
    out, k = UNIT, 0
    while n >> k:
        if n >> k & 1:
            out = times(out, power(symbol, k))
        k += 1
    return out


def _back(symbol: int, n: int, end: Vector) -> Vector:
    k = 0
    while n >> k:
        if n >> k & 1:
            m = power(symbol, k)
            end = tuple(min(m[p][q] + end[q] for q in range(4)) for p in range(4))
        k += 1
    return end


class Solver:
    """Costs and choices, remembered for vectors that differ by a constant."""

    def __init__(self):
        self.seen, self.told = {}, {}

    def back(self, symbol: int, n: int, end: Vector) -> Vector:
        """Costs to the end from before a run, from those after it."""
        low = min(end)
        key = (symbol, n, end[0] - low, end[1] - low, end[2] - low, end[3] - low)
        got = self.seen.get(key)
        if got is None:
            if len(self.seen) > 100_000:
                self.seen.clear()
            got = self.seen[key] = _back(symbol, n, key[2:])
        return tuple(x + low for x in got)

    def row(self, symbol: int, state: int, end: Vector) -> tuple[str, int]:
        """The letters for one row, and the state after it."""
        due, out = self.back(symbol, 1, end), ""
        while True:
            ways = [(x, state_, "") for x, c, state_ in moves(symbol, state) if c + end[state_] == due[state]]
            if due[NEXT[state]] + INSERT == due[state]:
                ways.append(("I", NEXT[state], "more"))
            letter, state, more = min(ways)
            out += letter
            if not more:
                return out, state

    def unroll(self, symbol: int, n: int, state: int, end: Vector) -> tuple[str, int]:
        """The letters for a run, and the state after it: both halves, the first
        against the costs from the middle on."""
        low = min(end)
        key = (symbol, n, state, end[0] - low, end[1] - low, end[2] - low, end[3] - low)
        got = self.told.get(key)
        if got is None:
            if n == 1:
                got = self.row(symbol, state, key[3:])
            else:
                half = n // 2
                first, middle = self.unroll(symbol, half, state, self.back(symbol, n - half, key[3:]))
                rest, after = self.unroll(symbol, n - half, middle, key[3:])
                got = first + rest, after
            if n <= 64:
                if len(self.told) > 100_000:
                    self.told.clear()
                self.told[key] = got
        return got

    def solve(self, runs: list[tuple[int, int]], end: Vector, starts: range) -> tuple[Vector, list[str], list[int]]:
        """Costs before a fragment, and for each start its letters and state at the end."""
        ends = [end]
        for symbol, n in reversed(runs):
            ends.append(self.back(symbol, n, ends[-1]))
        due = ends.pop()
        ends.reverse()
        audits, states = [], []
        for state in starts:
            out = []
            for (symbol, n), after in zip(runs, ends, strict=True):
                letters, state = self.unroll(symbol, n, state, after)
                out.append(letters)
            audits.append("".join(out))
            states.append(state)
        return due, audits, states


SCAN = ("frag boolean, conv_id long, chunk int, part long, seq long, turn long, role string, text string, n long, "
        "symbols binary, sizes binary, blank long, duplicate long, truncated long, illegal long, first int, last int, "
        "turns long, least long, most long, matrix array<long>, edge boolean")
_NAMES = [x.split()[0] for x in SCAN.split(", ")]
_KINDS = [pa.bool_(), pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.string(), pa.int64(),
          pa.binary(), pa.binary(), *[pa.int64()] * 4, pa.int32(), pa.int32(), *[pa.int64()] * 3, pa.list_(pa.int64()), pa.bool_()]
_LEGAL = {(0, 1), (1, 2), (2, 1)}


class Fragment:
    """Runs and counts of a conversation's rows in one chunk."""

    def __init__(self):
        self.symbols, self.sizes = bytearray(), []
        self.blank = self.duplicate = self.truncated = self.illegal = self.turns = 0
        self.first = self.last = self.least = self.most = None

    def add(self, initial: int, turn: int | None, n: int, blank: bool, late: bool, known: bool) -> None:
        """``n`` equal rows; ``known``: role and text were seen earlier."""
        self.illegal += n - 1 + (self.last is not None and (self.last, initial) not in _LEGAL)
        self.last = initial
        self.first = initial if self.first is None else self.first
        if turn is not None and turn != self.most:
            self.turns, self.most = self.turns + 1, turn
            self.least = turn if self.least is None else self.least
        if blank:
            self.blank += n
            self._run(initial * 3 + GONE, n)
            return
        self.duplicate += n - 1 + known
        self.truncated += late and not known
        self._run(initial * 3 + (GONE if known else TRUNCATED if late else SOUND), 1)
        if n > 1:
            self._run(initial * 3 + GONE, n - 1)

    def _run(self, symbol: int, n: int) -> None:
        if self.symbols and self.symbols[-1] == symbol:
            self.sizes[-1] += n
        else:
            self.symbols.append(symbol)
            self.sizes.append(n)

    def row(self, conv, chunk: int, part: int, edge: bool) -> tuple:
        matrix = None
        if edge:
            matrix = UNIT
            for symbol, n in zip(self.symbols, self.sizes, strict=True):
                matrix = times(matrix, run_matrix(symbol, n))
            matrix = [x for line in matrix for x in line]
        return (True, conv, chunk, part, -1, None, None, None, None, bytes(self.symbols), np.array(self.sizes, "<i8").tobytes(),
                self.blank, self.duplicate, self.truncated, self.illegal, self.first, self.last, self.turns, self.least,
                self.most, matrix, edge)


def _scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows with their place, and a row for each fragment. A row of the first of
    equal texts comes right after its mark."""
    chunk, conv, part, seq, now, mark = chunk_id(), None, -1, 0, None, None
    gap = (None,) * 13
    for b in batches:
        out = []
        for c, turn, role, digest, real, text, n, initial, blank, late in zip(*(x.to_pylist() for x in b.columns), strict=True):
            if now is None or c != conv:
                if now is not None:
                    out.append(now.row(conv, chunk, part, part == 0))
                conv, part, now = c, part + 1, Fragment()
            if not real:
                mark = (c, turn, role, digest)
                continue
            now.add(initial, turn, n, blank, late, mark != (c, turn, role, digest))
            out.append((False, c, chunk, part, seq, turn, role, text, n, *gap))
            seq += 1
        yield record_batch(out, _NAMES, _KINDS)
    if now is not None:
        yield record_batch([now.row(conv, chunk, part, True)], _NAMES, _KINDS)


def _chain(frags: pd.DataFrame) -> pd.DataFrame:
    """For a conversation's fragments: costs from their ends on, whether they are
    its first and last, and what two neighbours share."""
    frags = list(frags.sort_values("chunk").itertuples())
    ends: list[Vector] = [END]
    for r in frags[:0:-1]:
        ends.append(tuple(min(int(r.matrix[4 * p + q]) + ends[-1][q] for q in range(4)) for p in range(4)))
    ends.reverse()
    out, last, most = [], None, None
    for k, (r, end) in enumerate(zip(frags, ends, strict=True)):
        joint = last is not None and (last, r.first) not in _LEGAL
        shared = most is not None and not pd.isna(r.least) and most == r.least
        out.append((r.chunk, r.part, list(end), k == 0, k == len(frags) - 1, int(joint), int(shared)))
        last, most = r.last, most if pd.isna(r.most) else r.most
    return pd.DataFrame(out, columns=["chunk", "part", "end", "is_first", "is_last", "joint", "shared"])


def _pick(frags: pd.DataFrame) -> pd.DataFrame:
    """The state in which each of a conversation's fragments begins."""
    out, state = [], 0
    for r in frags.sort_values("chunk").itertuples():
        out.append((r.chunk, r.part, state))
        state = int(r.states[state])
    return pd.DataFrame(out, columns=["chunk", "part", "start"])


def _solve(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    solver = Solver()
    for b in batches:
        out = []
        for chunk, part, symbols, sizes, end, last in zip(*(x.to_pylist() for x in b.columns), strict=True):
            runs = list(zip(symbols, np.frombuffer(sizes, "<i8").tolist(), strict=True))
            due, audits, states = solver.solve(runs, tuple(end) if end else END, range(4 if end else 1))
            if last:
                audits = [a + ENDING[s] for a, s in zip(audits, states, strict=True)]
            out.append((chunk, part, due[0], audits, states))
        yield record_batch(out, ["chunk", "part", "due", "audits", "states"],
                           [pa.int32(), pa.int64(), pa.int64(), pa.list_(pa.string()), pa.list_(pa.int32())])


_REPAIRED = "conv_id long, chunk int, at long, turn long, edit string, role string, text string"


def _apply(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The turns that stay, from rows that follow their fragment's letters."""
    names = [x.split()[0] for x in _REPAIRED.split(", ")]
    kinds = [pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.string(), pa.string(), pa.string()]
    conv = chunk = letters = None
    state = place = at = 0

    def put_in(out: list) -> None:
        nonlocal state, place, at
        while place < len(letters) and letters[place] == "I":
            state = NEXT[state]
            out.append((conv, chunk, at, None, "I", ROLE[state], ""))
            place, at = place + 1, at + 1

    for b in batches:
        out: list[tuple] = []
        for c, k, audit, start, turn, role, text, n in zip(*(x.to_pylist() for x in b.columns), strict=True):
            if audit is not None:
                if letters is not None:
                    put_in(out)                            # what is put in at the end of the conversation before
                conv, chunk, letters, state, place = c, k, audit, start, 0
                continue
            for _ in range(n):
                put_in(out)
                letter = letters[place]
                place += 1
                if letter == "D":
                    continue
                if letter == "R":
                    state = NEXT[state]
                    out.append((conv, chunk, at, turn, "R", ROLE[state], text))
                else:
                    state = AFTER[state, INITIALS.index(role[0])]
                    out.append((conv, chunk, at, turn, "K", role, text))
                at += 1
        yield record_batch(out, names, kinds)
    out = []
    if letters is not None:
        put_in(out)
    yield record_batch(out, names, kinds)


def damage(conversations: DataFrame) -> DataFrame:
    """Rows as a careless export would leave them, by crc32(``conv_id:turn``) % 20:
    0 drops a row, 1 empties its text, 2 takes out its ``[.!?]``, 3 repeats it, 4
    sets its role to user. Nulls are one space in texts, roles and that string."""
    blank = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(" "))
    rows = need(conversations, "conv_id", "turn", "role", "text").withColumn(
        "kind", F.crc32(F.concat(blank("conv_id"), F.lit(":"), blank("turn")).cast("binary")) % 20)
    text = F.when(F.col("kind") == 1, "").when(F.col("kind") == 2, F.translate(blank("text"), ".!?", "")).otherwise(blank("text"))
    return rows.where("kind <> 0").select(
        "conv_id", "turn", F.when(F.col("kind") == 4, "user").otherwise(blank("role")).alias("role"), text.alias("text"),
        F.when(F.col("kind") == 3, 2).otherwise(1).cast("long").alias("n"))


def repair(conversations: DataFrame, copies: str | None = None) -> tuple[DataFrame, DataFrame]:
    """Finds faults and the cheapest repair of every conversation.

    ``conversations`` has ``conv_id, turn, role, text``; the column ``copies`` may say how
    often a row stands there. Returns one row for each conversation: ``conv_id, gaps, blank,
    duplicate, truncated, illegal, cost, audit``; and its repaired turns ``conv_id,
    chunk, at, turn, edit, role, text``, in order of ``chunk`` and ``at`` (turns put in
    have no ``turn``), each partition holding whole chunks in order.

    Turns go by ``turn`` (null first), equal ones by role and the SHA-256 of the
    text; repeated rows stand next to each other. Null roles and texts are one
    space. Rows without ``conv_id`` are one conversation. An empty table gives no
    rows; other columns are not read. A long conversation is spread over many
    tasks; only its audit, one string, is put together in one row."""
    count = F.col(f"`{copies}`") if copies else F.lit(1).cast("long")
    bare = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(" ")).alias(c)
    rows = conversations.select(F.col("conv_id").cast("long"), F.col("turn").cast("long"), bare("role"), bare("text"), count.alias("n"))
    rows = rows.groupBy("conv_id", "turn", "role", "text").agg(F.sum("n").alias("n")).withColumn(
        "digest", F.unhex(F.sha2("text", 256)))
    inner = F.trim("text", F.lit(WHITE))
    initial = F.coalesce(*[F.when(F.substring("role", 1, 1) == x, k) for k, x in enumerate(INITIALS)], F.lit(OTHER))
    real = rows.select("conv_id", "turn", "role", "digest", F.lit(True).alias("real"), "text", "n", initial.alias("initial"),
                       (inner == "").alias("blank"), (~F.substring(inner, -1, 1).isin(".", "!", "?")).alias("late"))
    firsts = rows.groupBy("conv_id", "role", "digest").agg(F.max(F.col("turn").isNull()).alias("none"), F.min("turn").alias("turn"))
    none = lambda kind: F.lit(None).cast(kind)
    marks = firsts.select("conv_id", F.when(~F.col("none"), F.col("turn")).alias("turn"), "role", "digest", F.lit(False).alias("real"),
                          none("string").alias("text"), none("long").alias("n"), none("int").alias("initial"),
                          none("boolean").alias("blank"), none("boolean").alias("late"))
    order = ["conv_id", "turn", "role", "digest"]         # a mark and its row stay together
    found = cut(real.unionByName(marks).repartitionByRange(*order).sortWithinPartitions(*order, "real")
                .mapInArrow(_scan, SCAN), "rows")
    frags = found.where("frag")
    chains = frags.where("edge").groupBy("conv_id").applyInPandas(
        _chain, "chunk int, part long, end array<long>, is_first boolean, is_last boolean, joint long, shared long")
    chained = frags.join(chains, ["chunk", "part"], "left").withColumns(
        {c: F.coalesce(c, F.lit(v)) for c, v in (("is_first", True), ("is_last", True), ("joint", 0), ("shared", 0))})
    chained = cut(chained.drop("turn", "role", "text", "n", "seq", "frag"), "frags")
    solved = cut(chained.select("chunk", "part", "symbols", "sizes", "end", "is_last").mapInArrow(
        _solve, "chunk int, part long, due long, audits array<string>, states array<int>")
        .join(chained.drop("symbols", "sizes", "matrix", "end"), ["chunk", "part"]), "solved")
    picked = solved.where("edge").groupBy("conv_id").applyInPandas(_pick, "chunk int, part long, start int")
    solved = solved.join(picked, ["chunk", "part"], "left").withColumn("start", F.coalesce("start", F.lit(0)))
    solved = cut(solved.withColumn("letters", F.element_at("audits", F.col("start") + 1)).drop("audits", "states"), "letters")
    turns = F.sum("turns") - F.sum("shared")
    total = lambda c: F.sum(c).alias(c)
    report = solved.groupBy("conv_id").agg(
        F.when(turns > 0, F.max("most") - F.min("least") + 1 - turns).otherwise(0).alias("gaps"),
        total("blank"), total("duplicate"), total("truncated"), F.sum(F.col("illegal") + F.col("joint")).alias("illegal"),
        F.sum(F.when(F.col("is_first"), F.col("due")).otherwise(0)).alias("cost"),
        F.array_join(F.transform(F.sort_array(F.collect_list(F.struct("chunk", "letters"))), lambda x: x["letters"]), "").alias("audit"))
    line = solved.select("conv_id", "chunk", "part", F.lit(-1).cast("long").alias("seq"), "letters", "start",
                         none("long").alias("turn"), none("string").alias("role"), none("string").alias("text"), none("long").alias("n"))
    lines = found.where("not frag").select("conv_id", "chunk", "part", "seq", none("string").alias("letters"),
                                           none("int").alias("start"), "turn", "role", "text", "n").unionByName(line)
    repaired = (lines.repartition("chunk").sortWithinPartitions("chunk", "part", "seq")
                .select("conv_id", "chunk", "letters", "start", "turn", "role", "text", "n").mapInArrow(_apply, _REPAIRED))
    return report, repaired


def digests(repaired: DataFrame) -> DataFrame:
    """``conv_id, sha``: the SHA-256 of each conversation's ``role:text``, joined by line feeds.
    ``repaired`` comes straight from ``repair``, whose order in a task is used."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names, kinds = ["conv_id", "sha", "chunk", "piece", "raw"], [pa.int64(), pa.string(), pa.int32(), pa.int64(), pa.binary()]
        texts, key = None, None
        for b in batches:
            out = []
            for c, chunk, role, text in zip(*(x.to_pylist() for x in b.columns), strict=True):
                if texts is None or chunk != texts.chunk or key != (c,):
                    if texts is not None:
                        texts.done(key, chunk != texts.chunk)
                        out += texts.rows
                        texts.rows.clear()
                    if texts is None or chunk != texts.chunk:
                        texts = Texts(chunk, b"\n")
                    key = (c,)
                texts.add(f"{role}:{text}".encode(), key)
                out += texts.rows
                texts.rows.clear()
            yield record_batch(out, names, kinds)
        if texts is not None:
            texts.done(key, True)
            yield record_batch(texts.rows, names, kinds)

    parts = repaired.select("conv_id", "chunk", "role", "text").mapInArrow(
        run, "conv_id long, sha string, chunk int, piece long, raw binary")
    return finish_texts(cut(parts, "texts"), ["conv_id"], b"\n")


def repaired_report(conversations: DataFrame, damaged: DataFrame, copies: str | None = None) -> DataFrame:
    """The report of ``damaged`` with ``repaired_sha256``, for every ``conv_id`` of
    ``conversations``: zeros and empty texts where no row is left."""
    report, repaired = repair(damaged, copies)
    both = report.select(F.col("conv_id").alias("c"), F.struct(*report.columns[1:]).alias("r"))
    sums = digests(repaired).select(F.col("conv_id").alias("s"), "sha")
    ids = need(conversations, "conv_id").select(F.col("conv_id").cast("long")).distinct()
    whole = ids.join(both, F.col("conv_id").eqNullSafe(F.col("c")), "left").join(
        sums, F.col("conv_id").eqNullSafe(F.col("s")), "left")
    zero = F.lit(0).cast("long")
    return whole.select("conv_id", *[F.coalesce(F.col(f"r.{c}"), zero).alias(c) for c in report.columns[1:-1]],
                        F.coalesce("r.audit", F.lit("")).alias("audit"), F.coalesce("sha", F.lit(NOTHING)).alias("repaired_sha256"))
