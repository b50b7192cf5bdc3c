"""Conversation structure repair by the auction algorithm for shortest paths.

A conversation's rows, in order of turn, are edited so that the initials of
its roles read ``(s?(ua)+)?``.  The edits form a lattice: a node is a number of
rows read and what was written last (nothing, s, u or a), an arc is an edit
with a whole cost.  The cheapest edits are a shortest path.

The auction algorithm (Bertsekas 1991) keeps a price for every node, a lower
bound of the cost from there to the end, and a path from the origin.  At the
path's last node it looks for the cheapest arc plus price beyond: if that is
more than the node's own price, the price rises to it and the path contracts;
otherwise the path is extended along that arc.  When the path reaches the end,
the prices are an optimal dual solution: the arcs of *every* shortest path are
tight (cost equal to the difference of the prices).  Tight arcs from which the
end can be reached over tight arcs are then followed from the origin, the
ASCII-least edit first.

Conversations of any length are cut into pieces of ``PIECE`` lattice rows, in
parallel by ranges of (conversation, turn).  Of a conversation with several
pieces, each gives a 4 x 4 table of costs from state to state, a backward scan
of the tables gives the prices at the pieces' ends, and each piece is traced
for every state it may be entered in.  A last scan follows the states from
piece to piece and hashes the repaired text; a SHA-256 is serial, so a
conversation's rows pass through one task there, in order and with one piece
in memory at a time.
"""

from __future__ import annotations

import hashlib
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from telemetry_lake.llm.frames import saved, table

PIECE = 32
SPACES = " \t\n\x0b\x0c\r"
REROLE, DELETE, INSERT, TRUNCATED = 3, 4, 3, 3
INFINITE = 1 << 60

#: States: 0 nothing written, 1 after s, 2 after u, 3 after a; initials: 0 s, 1 u, 2 a, 3 any other.
_PUT = (2, 2, 3, 2)  # the state after a user or assistant was put in
_KEPT = {(0, 0): 1, (0, 1): 2, (1, 1): 2, (2, 2): 3, (3, 1): 2}
_FORCED = 8  # code of rows that must go; others: initial, plus 4 if truncated
#: Cost and inserts that end a conversation in each state.
_ENDS = (0, 2 * INSERT, INSERT, 0)
_LAST = ("", "II", "I", "")
_ROLES = {2: "user", 3: "assistant"}


# --- damage and faults --------------------------------------------------------------


def damaged(rows: DataFrame) -> DataFrame:
    """(conv_id, turn, role, text, copies): rows dropped, emptied, stripped of marks, repeated or given to the user."""

    def text(name: str) -> Column:
        return F.coalesce(F.col(name).cast("string"), F.lit(" "))

    pick = F.crc32(F.concat(text("conv_id"), F.lit(":"), text("turn")).cast("binary")) % 20
    return rows.select(
        F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").cast("long").alias("turn"),
        F.when(pick == 4, F.lit("user")).otherwise(text("role")).alias("role"),
        F.when(pick == 1, F.lit("")).when(pick == 2, F.regexp_replace(text("text"), "[.!?]", "")).otherwise(
            text("text")).alias("text"),
        F.when(pick == 3, F.lit(2)).otherwise(F.lit(1)).cast("long").alias("copies"), pick.alias("pick"),
    ).where("pick <> 0").drop("pick")


def turns(rows: DataFrame) -> DataFrame:
    """Rows (conv_id, turn, role, text, copies), equal ones held once, with a digest and faults of the text alone."""
    end = F.rtrim(F.col("text"), F.lit(SPACES))
    digest = F.sha2(F.col("text").cast("binary"), 256)
    return rows.withColumn("digest", digest).groupBy("conv_id", "turn", "role", "digest", "text").agg(
        F.sum("copies").alias("copies")
    ).withColumns({"blank": end == "", "cut": ~F.right(end, F.lit(1)).isin(".", "!", "?")})


def judged(held: DataFrame) -> DataFrame:
    """``turns`` with ``code``: the first of a conversation's rows with this role and text isn't a duplicate."""
    firsts = held.groupBy("conv_id", "role", "digest").agg(
        F.min("turn").alias("least"), F.max(F.col("turn").isNull()).alias("without"))
    firsts = firsts.select(F.col("conv_id").alias("c"), F.col("role").alias("r"), F.col("digest").alias("d"), "least", "without")
    first = F.col("turn").isNull() | (~F.col("without") & (F.col("turn") == F.col("least")))
    place = F.instr(F.lit("sua"), F.left("role", F.lit(1)))
    initial = F.when((F.col("role") == "") | (place == 0), 3).otherwise(place - 1)
    code = F.when(F.col("blank") | ~first, _FORCED).otherwise(initial + F.when(F.col("cut"), 4).otherwise(0))
    same = F.col("conv_id").eqNullSafe(F.col("c")) & (F.col("role") == F.col("r")) & (F.col("digest") == F.col("d"))
    return held.join(firsts, same).withColumn("code", code.cast("int")).drop("c", "r", "d", "least", "without", "cut")


def items(code: int, copies: int) -> list[int]:
    """Lattice rows (count * 16 + code) of equal rows: the first, and the others to delete."""
    if code == _FORCED:
        return [copies << 4 | _FORCED]
    return [1 << 4 | code] + ([(copies - 1) << 4 | _FORCED] if copies > 1 else [])


# --- auction ------------------------------------------------------------------------


def lattice(rows: tuple[int, ...], ends: tuple[int, ...]) -> list[list[tuple[str, int, int]]]:
    """Arcs (edit, cost, node) of every node; node 4 * i + state, then the end.

    Rows that must go cost nothing here: every path deletes them.
    """
    out: list[list[tuple[str, int, int]]] = []
    for i, row in enumerate(rows):
        code = row & 15
        for q in range(4):
            arcs = [("D", 0 if code == _FORCED else DELETE, 4 * i + 4 + q), ("I", INSERT, 4 * i + _PUT[q])]
            if code != _FORCED:
                more = TRUNCATED if code & 4 else 0
                if kept := _KEPT.get((q, code & 3)):
                    arcs.append(("K", more, 4 * i + 4 + kept))
                arcs.append(("R", REROLE + more, 4 * i + 4 + _PUT[q]))
            out.append(arcs)
    end = 4 * len(rows) + 4
    return [*out, *([("", ends[q], end)] if ends[q] < INFINITE else [] for q in range(4)), []]


def reaching(arcs: list[list[tuple[str, int, int]]], price: list[int] | None = None) -> list[bool]:
    """Nodes from which the end can be reached, over tight arcs only if prices are given."""
    end = len(arcs) - 1
    alive = [False] * end + [True]
    for layer in range(end - 4, -1, -4):
        for _ in range(3):  # inserts stay in their layer
            for node in range(layer, layer + 4):
                alive[node] = alive[node] or any(
                    alive[j] and (price is None or price[node] == c + price[j]) for _, c, j in arcs[node])
    return alive


def start_prices(arcs: list[list[tuple[str, int, int]]]) -> list[int]:
    """Zero, and INFINITE where no way leads to the end."""
    return [0 if r else INFINITE for r in reaching(arcs)]


def auction(arcs: list[list[tuple[str, int, int]]], price: list[int], origin: int) -> int:
    """Raise the prices until a path from ``origin`` to the end is found; its cost (INFINITE: there is none).

    ``price``: ``start_prices``, or what an earlier call made of them.
    """
    if price[origin] >= INFINITE:
        return INFINITE
    path, end = [origin], len(arcs) - 1
    while path[-1] != end:
        at = path[-1]
        best, to = INFINITE, -1
        for _, cost, node in arcs[at]:
            if cost + price[node] < best:
                best, to = cost + price[node], node
        if best > price[at]:  # contract
            price[at] = best
            if len(path) > 1:
                path.pop()
        else:
            path.append(to)
    return price[origin]


def trace(arcs: list[list[tuple[str, int, int]]], price: list[int], origin: int) -> tuple[str, int]:
    """(ASCII-least edits, state at the end) over tight arcs from which the end is reached over tight arcs."""
    end, alive = len(arcs) - 1, reaching(arcs, price)
    edits, at = [], origin
    while arcs[at][0][2] != end:
        label, _, at = min((e, c, j) for e, c, j in arcs[at] if alive[j] and price[at] == c + price[j])
        edits.append(label)
    return "".join(edits), at % 4


@lru_cache(maxsize=1 << 15)
def traced(rows: tuple[int, ...], ends: tuple[int, ...], states: int) -> list[tuple[str, int]]:
    """(edits, last state) of a piece entered in each of the first ``states`` states."""
    arcs = lattice(rows, ends)
    price, out = start_prices(arcs), []
    for q in range(states):
        auction(arcs, price, q)
        out.append(trace(arcs, price, q))
    return out


@lru_cache(maxsize=1 << 15)
def crossing(rows: tuple[int, ...]) -> list[int]:
    """Costs from each state before a piece to each state after it (16 values; INFINITE: no way)."""
    costs = np.full((4, 4), INFINITE, dtype=np.int64)
    for last in range(4):
        arcs = lattice(rows, tuple(0 if q == last else INFINITE for q in range(4)))
        price = start_prices(arcs)
        costs[:, last] = [auction(arcs, price, q) for q in range(4)]
    return costs.ravel().tolist()


# --- pieces -------------------------------------------------------------------------


_ORDER = ["conv_id", "turn", "role", "digest"]
_PIECE = "conv_id bigint, turn bigint, role string, digest string, codes binary"


def pieces(rows: DataFrame, size: int = PIECE) -> DataFrame:
    """Conversations cut into pieces of at most ``size`` rows (or where a task's range ends), named by their first row."""

    def run(batches):
        key, codes, read, names = None, [], 0, _PIECE.replace(",", "").split()[::2]
        done: list[tuple] = []

        def batch_of(found):
            columns = list(zip(*found, strict=True))
            kinds = (pa.int64(), pa.int64(), pa.string(), pa.string(), pa.binary())
            return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], names=names)

        for batch in batches:
            for conv, turn, role, digest, code, copies in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if key is None or conv != key[0] or read == size:
                    if key is not None:
                        done.append((*key, np.array(codes, "<i8").tobytes()))
                    key, codes, read = (conv, turn, role, digest), [], 0
                codes += items(code, copies)
                read += 1
            if done:
                yield batch_of(done)
                done = []
        if key is not None:
            yield batch_of([(*key, np.array(codes, "<i8").tobytes())])

    ordered = rows.select(*_ORDER, "code", "copies").repartitionByRange(*_ORDER).sortWithinPartitions(*_ORDER)
    return ordered.mapInArrow(run, _PIECE)


def _codes(column: pa.Array) -> list[tuple[int, ...]]:
    return [tuple(np.frombuffer(x, "<i8").tolist()) for x in column.to_pylist()]


def ends_of(cut: DataFrame) -> DataFrame:
    """(piece, ends): what it costs from each state after a piece to the end of its conversation.

    ``cut``: (piece, conv_id, turn, role, digest, codes) of conversations with several pieces.
    """

    def cross(batches):
        for batch in batches:
            costs = pa.array([crossing(c) for c in _codes(batch.column(5))], pa.list_(pa.int64()))
            yield pa.RecordBatch.from_arrays([*batch.columns[:5], costs], names=[*batch.schema.names[:5], "costs"])

    def back(batches):
        conv, ends = (), None
        for batch in batches:
            pieces_, lists = [], []
            for piece, of, costs in zip(*(batch.column(c).to_pylist() for c in (0, 1, 5)), strict=True):
                if conv != (of,):
                    conv, ends = (of,), np.array(_ENDS, dtype=np.int64)
                pieces_.append(piece)
                lists.append(ends.tolist())
                ends = np.minimum((np.array(costs).reshape(4, 4) + ends).min(axis=1), INFINITE)
            yield pa.RecordBatch.from_arrays([pa.array(pieces_, pa.int64()), pa.array(lists, pa.list_(pa.int64()))],
                                             names=["piece", "ends"])

    table_of = cut.select("piece", *_ORDER, "codes").mapInArrow(
        cross, "piece bigint, conv_id bigint, turn bigint, role string, digest string, costs array<bigint>")
    last_first = table_of.repartition("conv_id").sortWithinPartitions(
        "conv_id", F.desc_nulls_last("turn"), F.desc("role"), F.desc("digest"))
    return last_first.mapInArrow(back, "piece bigint, ends array<bigint>")


def traces(cut: DataFrame) -> DataFrame:
    """(conv_id, turn, role, digest, edits, states): each piece's edits and last state for every state it may begin in."""
    cut = saved(cut.withColumn("piece", F.monotonically_increasing_id()), "pieces")
    several = cut.groupBy("conv_id").agg(F.count(F.lit(1)).alias("n")).where("n > 1").select(F.col("conv_id").alias("c"))
    long = cut.join(several, F.col("conv_id").eqNullSafe(F.col("c")), "left_semi")
    known = cut.join(saved(ends_of(long), "ends"), "piece", "left")

    def run(batches):
        for batch in batches:
            found = []
            for rows, ends in zip(_codes(batch.column(4)), batch.column(5).to_pylist(), strict=True):
                found.append(traced(rows, _ENDS, 1) if ends is None else traced(rows, tuple(ends), 4))
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[:4], pa.array([[e for e, _ in f] for f in found], pa.list_(pa.string())),
                 pa.array([[q for _, q in f] for f in found], pa.list_(pa.int32()))],
                names=[*_ORDER, "edits", "states"],
            )

    return known.select(*_ORDER, "codes", "ends").mapInArrow(
        run, "conv_id bigint, turn bigint, role string, digest string, edits array<string>, states array<int>")


# --- repair -------------------------------------------------------------------------


_LEGAL = {"su", "ua", "au"}
_RESULT = ("conv_id bigint, gaps bigint, blank bigint, duplicate bigint, truncated bigint, illegal bigint, cost bigint, "
           "audit string, repaired_sha256 string")


class _Conversation:
    """Figures and repaired text of one conversation, row by row."""

    def __init__(self, conv_id):
        self.conv_id = conv_id
        self.least = self.turn = None
        self.turns = self.blank = self.duplicate = self.truncated = self.illegal = self.cost = 0
        self.initial, self.state, self.edits = None, 0, iter("")
        self.written, self.audit, self.hash = 0, [], hashlib.sha256()

    def _write(self, role: str, text: str) -> None:
        self.hash.update((b"\n" if self.written else b"") + f"{role}:{text}".encode("utf-8", "surrogatepass"))
        self.written += 1

    def _insert(self) -> None:
        self.state = _PUT[self.state]
        self._write(_ROLES[self.state], "")
        self.cost += INSERT
        self.audit.append("I")

    def enter(self, edits: list[str], states: list[int]) -> None:
        """The next piece begins."""
        self.edits = iter(edits[self.state])

    def row(self, turn, role: str, text: str, code: int, copies: int, blank: bool) -> None:
        if turn is not None and turn != self.turn:
            self.least = turn if self.least is None else self.least
            self.turn, self.turns = turn, self.turns + 1
        initial = role[:1]
        if self.initial is not None:
            self.illegal += self.initial + initial not in _LEGAL
        self.illegal += copies - 1  # no role may follow itself
        self.initial = initial
        for item in items(code, copies):
            count, code = item >> 4, item & 15
            while (edit := next(self.edits)) == "I":
                self._insert()
            self.audit.append(edit * count)
            if code == _FORCED:
                self.blank += count if blank else 0
                self.duplicate += 0 if blank else count
            self.truncated += code != _FORCED and code >> 2
            if edit == "D":
                self.cost += DELETE * count
                continue
            self.cost += TRUNCATED * (code >> 2)
            if edit == "K":
                self.state = _KEPT[self.state, code & 3]
            else:
                self.state, self.cost = _PUT[self.state], self.cost + REROLE
                role = _ROLES[self.state]
            self._write(role, text)

    def result(self) -> tuple:
        for _ in _LAST[self.state]:
            self._insert()
        gaps = self.turn - self.least + 1 - self.turns if self.turns else 0
        return (self.conv_id, gaps, self.blank, self.duplicate, self.truncated, self.illegal, self.cost,
                "".join(self.audit), self.hash.hexdigest())


def repaired(rows: DataFrame, found: DataFrame) -> DataFrame:
    """One row per conversation of judged ``rows``, by the traces of its pieces."""
    none = F.lit(None)
    names = [*_ORDER, "kind", "text", "code", "copies", "blank", "edits", "states"]
    own = rows.withColumns({"kind": F.lit(1), "edits": none.cast("array<string>"), "states": none.cast("array<int>")})
    before = found.withColumns({"kind": F.lit(0), "text": none.cast("string"), "code": none.cast("int"),
                                "copies": none.cast("bigint"), "blank": none.cast("boolean")})

    def run(batches):
        now = None
        for batch in batches:
            done = []
            columns = [c.to_pylist() for c in batch.columns]
            for conv, turn, role, _, kind, text, code, copies, blank, edits, states in zip(*columns, strict=True):
                if now is None or now.conv_id != conv:
                    if now is not None:
                        done.append(now.result())
                    now = _Conversation(conv)
                if kind == 0:
                    now.enter(edits, states)
                else:
                    now.row(turn, role, text, code, copies, blank)
            if done:
                yield _results(done)
        if now is not None:
            yield _results([now.result()])

    both = before.select(*names).unionByName(own.select(*names))
    return both.repartition("conv_id").sortWithinPartitions(*_ORDER, "kind").mapInArrow(run, _RESULT)


def _results(rows: list[tuple]) -> pa.RecordBatch:
    names = _RESULT.replace(",", "").split()
    kinds = {"bigint": pa.int64(), "string": pa.string()}
    return pa.RecordBatch.from_arrays(
        [pa.array(c, kinds[k]) for c, k in zip(zip(*rows, strict=True), names[1::2], strict=True)], names=names[::2])


def repair(rows: DataFrame, size: int = PIECE) -> DataFrame:
    """Faults and cheapest repair of conversations ``rows`` (conv_id, turn, role, text, copies).

    Rows stand in order of turn, NULL first, those of one turn by role and then
    by a digest of the text; ``copies`` equal rows stand side by side.  Rows
    without conv_id are one conversation.  A role that begins with none of s, u
    and a can only be reroled or deleted.  Very long conversations are cut into
    pieces (see the module).  An empty table gives no rows.  Returns one row per
    conversation: conv_id, gaps, blank, duplicate, truncated, illegal, cost,
    audit, repaired_sha256.
    """
    held = saved(turns(rows), "turns")
    known = judged(held)
    return repaired(known, saved(traces(pieces(known, size)), "traces"))


def audit_damaged(rows: DataFrame, size: int = PIECE) -> DataFrame:
    """``repair`` of conversations (conv_id, turn, role, text) after a fixed damage, for every conv_id there was.

    A NULL role, text, conv_id or turn is one space where the damage is drawn
    and in the texts; conversations that lose all rows have zeros, an empty
    audit and the hash of nothing.  Other columns are ignored.
    """
    done = repair(damaged(rows), size)
    ids = rows.select(F.col("conv_id").cast("long").alias("c")).distinct()
    out = ids.join(done, F.col("c").eqNullSafe(F.col("conv_id")), "left")
    figures = ["gaps", "blank", "duplicate", "truncated", "illegal", "cost"]
    return out.select(
        F.col("c").alias("conv_id"), *[F.coalesce(n, F.lit(0)).cast("long").alias(n) for n in figures],
        F.coalesce("audit", F.lit("")).alias("audit"),
        F.coalesce("repaired_sha256", F.lit(hashlib.sha256().hexdigest())).alias("repaired_sha256"),
    )


def op13_conversations(spark, sf_dir):
    """Every conversation, damaged and repaired."""
    return audit_damaged(table(spark, sf_dir, "conversations"))
