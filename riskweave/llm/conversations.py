"""Conversation structure repair by Hirschberg's divide and conquer.

A conversation's rows are edited (Keep, Rerole, Delete, Insert) so that the
roles that are left read `(s?(ua)+)?`. Four states say what may come next: 0
nothing yet, 1 after the system role, 2 after user, 3 after assistant. The
cheapest edits, of these the ones whose letters are least, are found by cost
vectors over the four states: forwards from the start to the middle, backwards
from the end to the middle; the optimal crossing with the least letters so far
is chosen, and both halves are solved alone. The forward vector carries, beside
each state's cost, the order of the states' letters: as each row takes exactly
one of K, R and D and inserts stand before it, none of these texts begins another, so
their order decides the order of the whole.

Spark cuts the rows, sorted by conversation and turn, into pieces of bounded
length. A conversation in one piece is solved there. For a longer one the
pieces' four-by-four matrices take the rows' place: the same search gives the
states at the edges of the sorted partitions, then at the edges of the pieces
in each, so no task holds a whole conversation's rows.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from .common import stored

#: Rows of a piece: 2 to this power.
PIECE_BITS = 10
KEEP, REROLE, DELETE, INSERT, CUT_OFF = 0, 1, 2, 5, 5
#: Letters of one row's edits, inserts first, in ASCII order.
STEPS = ["D", "ID", "IID", "IIK", "IIR", "IK", "IR", "K", "R"]
NEVER = 1 << 40
ACCEPT = -1
#: Inserts that finish the pattern from each state, and their cost.
TAIL = ["", "II", "I", ""]
TAIL_COST = np.array([INSERT * len(t) for t in TAIL], dtype=np.int64)
BLANKS = " \t\n\x0b\x0c\r"
#: Role initials by number; 3 is any other.
INITIALS = "sua"


def _next(state: int, initial: int) -> int | None:
    """The state after a role, or None if it may not stand there."""
    if initial == 0:
        return 1 if state == 0 else None
    if initial == 1:
        return 2 if state in (0, 1, 3) else None
    return 3 if initial == 2 and state == 2 else None


def _filled(state: int) -> int:
    """The state after the role that is wanted there."""
    return 3 if state == 2 else 2


def _row_tables() -> tuple[np.ndarray, np.ndarray]:
    """Cost and letters (as a place in STEPS) of a row of each kind from state
    to state. Kind 0 must be deleted; 1 + 2 * initial + truncated are the others."""
    cost = np.full((9, 4, 4), NEVER, dtype=np.int64)
    rank = np.zeros((9, 4, 4), dtype=np.int64)
    for kind in range(9):
        initial, truncated = divmod(kind - 1, 2) if kind else (3, 0)
        for start in range(4):
            state = start
            for inserts in range(3):
                ways = [("D", state, DELETE)]
                if kind:
                    ways.append(("R", _filled(state), REROLE + CUT_OFF * truncated))
                    if _next(state, initial) is not None:
                        ways.append(("K", _next(state, initial), KEEP + CUT_OFF * truncated))
                for letter, end, price in ways:
                    new = (price + INSERT * inserts, STEPS.index("I" * inserts + letter))
                    if new < (cost[kind, start, end], rank[kind, start, end]):
                        cost[kind, start, end], rank[kind, start, end] = new
                state = _filled(state)
    return cost, rank


ROW_COST, ROW_RANK = _row_tables()


def forward(cost: np.ndarray, rank: np.ndarray, at: np.ndarray, upto: np.ndarray, start: np.ndarray
            ) -> tuple[np.ndarray, np.ndarray]:
    """(costs, order of letters) at each of the four states after the elements
    at..upto-1 of several stretches at once, from each one's start state.
    `cost` and `rank` hold a matrix for each element."""
    f = np.full((len(at), 4), NEVER, dtype=np.int64)
    f[np.arange(len(at)), start] = 0
    order = np.tile(np.arange(4), (len(at), 1))
    live, step = np.arange(len(at)), 0
    while len(live := live[at[live] + step < upto[live]]):
        i = at[live] + step
        letters = order[live][:, :, None] * 16 + rank[i]
        key = np.minimum(f[live][:, :, None] + cost[i], NEVER) * 64 + letters
        by = key.argmin(axis=1)[:, None, :]
        f[live] = np.take_along_axis(key, by, axis=1)[:, 0] >> 6
        order[live] = np.take_along_axis(letters, by, axis=1)[:, 0].argsort(axis=1).argsort(axis=1)
        step += 1
    return f, order


def backward(cost: np.ndarray, at: np.ndarray, upto: np.ndarray, end: np.ndarray) -> np.ndarray:
    """Cost from each state before the elements at..upto-1 to the end costs."""
    b = end.copy()
    live, step = np.arange(len(at)), 1
    while len(live := live[upto[live] - step >= at[live]]):
        b[live] = np.minimum((cost[upto[live] - step] + b[live][:, None, :]).min(axis=2), NEVER)
        step += 1
    return b


def ends(state: np.ndarray) -> np.ndarray:
    """Costs at the end of a stretch: of the state that it must end in, or of
    the inserts that finish the pattern."""
    cost = np.full((len(state), 4), NEVER, dtype=np.int64)
    for i, s in enumerate(state):
        if s == ACCEPT:
            cost[i] = TAIL_COST
        else:
            cost[i, s] = 0
    return cost


def hirschberg(cost: np.ndarray, rank: np.ndarray, at: np.ndarray, upto: np.ndarray, start: np.ndarray, end: np.ndarray
               ) -> tuple[np.ndarray, np.ndarray]:
    """(state before, state after) of every element on the best path of each
    stretch: all stretches are halved together until each has one element."""
    before, after = np.zeros(len(cost), dtype=np.int64), np.zeros(len(cost), dtype=np.int64)
    some = at < upto
    at, upto, start, end = at[some], upto[some], start[some], end[some]
    while len(at):
        one = upto - at == 1
        if one.any():
            i = at[one]
            key = (cost[i, start[one]] + end[one]) * 16 + rank[i, start[one]]
            before[i], after[i] = start[one], key.argmin(axis=1)
        at, upto, start, end = at[~one], upto[~one], start[~one], end[~one]
        if not len(at):
            break
        middle = (at + upto) // 2
        f, order = forward(cost, rank, at, middle, start)
        b = backward(cost, middle, upto, end)
        crossing = ((f + b) * 4 + order).argmin(axis=1)
        left = np.full((len(at), 4), NEVER, dtype=np.int64)
        left[np.arange(len(at)), crossing] = 0
        at, upto, start, end = (np.concatenate(x) for x in ((at, middle), (middle, upto), (start, crossing), (left, end)))
    return before, after


def _matrices(kinds: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """Cost and order of letters from each state to each over whole pieces."""
    rows = np.concatenate([np.zeros(0, dtype=np.int64), *kinds])
    upto = np.cumsum([len(k) for k in kinds])
    at = upto - [len(k) for k in kinds]
    n = len(kinds)
    f, order = forward(ROW_COST[rows], ROW_RANK[rows], np.repeat(at, 4), np.repeat(upto, 4), np.tile(np.arange(4), n))
    return f.reshape(n, 4, 4), order.reshape(n, 4, 4)


def _kinds(batch: pa.RecordBatch, kinds: str, copies: str) -> list[np.ndarray]:
    """Kinds of the rows of each piece, repeats written out: all but the first must go."""
    out = []
    names = batch.schema.names
    for kind, n in zip(batch.column(names.index(kinds)), batch.column(names.index(copies))):
        kind, n = np.array(kind.as_py(), dtype=np.int64), np.array(n.as_py(), dtype=np.int64)
        every = np.zeros(int(n.sum()), dtype=np.int64)
        every[np.cumsum(n) - n] = kind
        out.append(every)
    return out


def _groups(batches: Iterator[pa.RecordBatch], by: int) -> Iterator[list[dict]]:
    """Consecutive rows that agree in their first `by` columns."""
    held: list[dict] = []
    for batch in batches:
        for row in batch.to_pylist():
            if held and [held[0][c] for c in batch.schema.names[:by]] != [row[c] for c in batch.schema.names[:by]]:
                yield held
                held = []
            held.append(row)
    if held:
        yield held


def _stacked(rows: list[dict]) -> tuple[np.ndarray, np.ndarray]:
    return tuple(np.array([r[c] for r in rows], dtype=np.int64).reshape(-1, 4, 4) for c in ("cost", "rank"))


MATRIX = "cost array<long>, rank array<long>"


def _measured(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(conv, part, piece, kinds, copies) -> (conv, part, piece, matrix)."""
    for batch in batches:
        cost, rank = _matrices(_kinds(batch, "kinds", "copies"))
        yield pa.RecordBatch.from_arrays(
            [batch.column(0), batch.column(1), batch.column(2)] + [pa.array(x.reshape(-1, 16).tolist(), pa.list_(pa.int64())) for x in (cost, rank)],
            names=["conv", "part", "piece", "cost", "rank"])


def _joined(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Pieces in order -> (conv, part, matrix over all of the part's pieces)."""
    for rows in _groups(batches, 2):
        cost, rank = _stacked(rows)
        n = len(rows)
        f, order = forward(cost, rank, np.zeros(4, dtype=int), np.full(4, n), np.arange(4))
        yield pa.RecordBatch.from_pylist([{"conv": rows[0]["conv"], "part": rows[0]["part"], "cost": f.ravel().tolist(),
                                           "rank": order.ravel().tolist()}],
                                         schema=pa.schema([("conv", pa.string()), ("part", pa.int64()), ("cost", pa.list_(pa.int64())),
                                                           ("rank", pa.list_(pa.int64()))]))


def _edges(by: int, name: str):
    """Groups of matrices in order, with the states the group starts and ends
    in -> (conv, name, start, end) of each; without such states a group is a whole conversation."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows in _groups(batches, by):
            cost, rank = _stacked(rows)
            start, end = rows[0].get("start", 0), rows[0].get("end", ACCEPT)
            before, after = hirschberg(cost, rank, np.array([0]), np.array([len(rows)]), np.array([start]), ends(np.array([end])))
            last = [*after[:-1].tolist(), end]
            yield pa.RecordBatch.from_arrays(
                [pa.array([r["conv"] for r in rows], pa.string()), pa.array([r[name] for r in rows], pa.int64()),
                 pa.array(before, pa.int32()), pa.array(last, pa.int32())], names=["conv", name, "start", "end"])
    return run


def _solved(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Adds the state before each row of a piece and its letters; the last row
    of a conversation has the inserts that finish the pattern too."""
    for batch in batches:
        names = batch.schema.names
        start, end = (batch.column(names.index(c)).to_numpy().astype(np.int64) for c in ("start", "end"))
        kinds = _kinds(batch, "kinds", "copies")
        rows = np.concatenate([np.zeros(0, dtype=np.int64), *kinds])
        upto = np.cumsum([len(k) for k in kinds], dtype=np.int64)
        at = upto - [len(k) for k in kinds]
        before, after = hirschberg(ROW_COST[rows], ROW_RANK[rows], at, upto, start, ends(end))
        letters = [STEPS[r] for r in ROW_RANK[rows, before, after]]
        states, edits = [], []
        for p, n in enumerate(batch.column(names.index("copies")).to_pylist()):
            i, own, own_before = int(at[p]), [], []
            for many in n:
                own.append("".join(letters[i:i + many]))
                own_before.append(int(before[i]))
                i += many
            if own and end[p] == ACCEPT:
                own[-1] += TAIL[after[i - 1]]
            states.append(own_before)
            edits.append(own)
        yield pa.RecordBatch.from_arrays(
            [batch.column(names.index("piece_rows")), pa.array(states, pa.list_(pa.int32())), pa.array(edits, pa.list_(pa.string()))],
            names=["piece_rows", "before", "edits"])


def _key(col: Column) -> Column:
    """An id as text that is never null, so that null is an id of its own."""
    return F.when(col.isNull(), F.lit("-")).otherwise(F.concat(F.lit("="), col.cast("string")))


def _last(text: Column) -> Column:
    return F.right(F.rtrim(text, F.lit(BLANKS)), F.lit(1))


def _shaped(rows: DataFrame, id_col: str, turn_col: str, role_col: str, text_col: str) -> DataFrame:
    text = F.coalesce(F.col(text_col), F.lit(" "))
    return rows.select(_key(F.col(id_col)).alias("conv"), F.col(id_col).alias("id"), F.col(turn_col).alias("turn"),
                       F.coalesce(F.col(role_col), F.lit(" ")).alias("role"), text.alias("text"),
                       F.unhex(F.sha2(text, 256)).alias("digest"))


ORDER = ["conv", "turn", "role", "digest"]


def edits(rows: DataFrame, id_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role", text_col: str = "text",
          piece_bits: int = PIECE_BITS) -> DataFrame:
    """(conv, id, turn, role, digest, copies, initial, blank, repeated,
    cut_off, at, before, edits) of each different row of each conversation.

    `digest` is the SHA-256 of the text, `copies` how often the row occurs;
    `edits` has the letters of all its copies, inserts before each, and
    `before` the state before them. Rows stand in the order of turn (nulls
    first), role and digest; `at` rises in it. Null ids are one conversation;
    null roles and texts are one space. An empty table gives no rows. Texts are
    not shuffled. A row that is repeated within a conversation costs one row
    here, whatever its copies.
    """
    shaped = _shaped(rows, id_col, turn_col, role_col, text_col)
    blank = F.translate("text", BLANKS, "") == ""
    narrow = (shaped.withColumns({"blank": blank, "open": ~_last(F.col("text")).isin(".", "!", "?")})
              .groupBy("conv", "id", "turn", "role", "digest", "blank", "open").agg(F.count("*").alias("copies")))
    narrow = stored(narrow, "turns")
    first = narrow.groupBy("conv", "role", "digest").agg(F.min(F.struct("turn")).alias("first"))
    initial = F.coalesce(*(F.when(F.substring("role", 1, 1) == c, F.lit(i)) for i, c in enumerate(INITIALS)), F.lit(3))
    faulty = narrow.join(first, ["conv", "role", "digest"]).select(
        "conv", "id", "turn", "role", "digest", "copies", "blank", initial.alias("initial"),
        (~F.col("blank") & ~F.col("turn").eqNullSafe(F.col("first.turn"))).alias("repeated"),
        (~F.col("blank") & F.col("open")).alias("open"))
    faulty = faulty.withColumn("cut_off", F.col("open") & ~F.col("repeated")).drop("open")
    kind = F.when(F.col("blank") | F.col("repeated"), F.lit(0)).otherwise(
        F.lit(1) + 2 * F.col("initial") + F.col("cut_off").cast("int"))
    sorted_rows = faulty.repartitionByRange(*ORDER).sortWithinPartitions(*ORDER)
    numbered = stored(sorted_rows.withColumn("kind", kind).withColumn("at", F.monotonically_increasing_id()), "turns-in-order")

    piece = F.shiftright("at", piece_bits)
    row = F.struct("at", "kind", "copies", "id", "turn", "role", "digest", "initial", "blank", "repeated", "cut_off")
    pieces = stored(numbered.groupBy("conv", piece.alias("piece")).agg(F.sort_array(F.collect_list(row)).alias("piece_rows"))
                    .select("conv", F.shiftright("piece", 33 - piece_bits).alias("part"), "piece", "piece_rows",
                            F.col("piece_rows.kind").alias("kinds"), F.col("piece_rows.copies").alias("copies")), "pieces")

    several = pieces.groupBy("conv").agg(F.count("*").alias("pieces")).where("pieces > 1").select("conv")
    long = pieces.join(several, "conv").select("conv", "part", "piece", "kinds", "copies")
    measured = stored(long.mapInArrow(_measured, f"conv string, part long, piece long, {MATRIX}"), "piece-matrices")
    parts = (measured.repartition("conv", "part").sortWithinPartitions("conv", "part", "piece")
             .select("conv", "part", "cost", "rank").mapInArrow(_joined, f"conv string, part long, {MATRIX}"))
    at_parts = (parts.repartition("conv").sortWithinPartitions("conv", "part")
                .mapInArrow(_edges(1, "part"), "conv string, part long, start int, end int"))
    at_pieces = (measured.join(at_parts, ["conv", "part"]).repartition("conv", "part").sortWithinPartitions("conv", "part", "piece")
                 .select("conv", "part", "piece", "cost", "rank", "start", "end")
                 .mapInArrow(_edges(2, "piece"), "conv string, piece long, start int, end int"))
    asked = pieces.join(at_pieces, ["conv", "piece"], "left").select(
        "piece_rows", "kinds", "copies", F.coalesce("start", F.lit(0)).alias("start"), F.coalesce("end", F.lit(ACCEPT)).alias("end"), "conv")
    given = T.StructType([pieces.schema["piece_rows"], T.StructField("before", T.ArrayType(T.IntegerType())),
                          T.StructField("edits", T.ArrayType(T.StringType()))])
    found = asked.mapInArrow(_solved, given).select(F.explode(F.arrays_zip("piece_rows", "before", "edits")).alias("e"))
    return found.select(_key(F.col("e.piece_rows.id")).alias("conv"), "e.piece_rows.*", "e.before", "e.edits").drop("kind")


def _ordered(rows: DataFrame, found: DataFrame, columns: tuple[str, str, str, str], by: list[str], ids: DataFrame | None
             ) -> DataFrame:
    """Each row's edits, then its text, sorted; with `ids`, a conversation
    begins with its own row (step 0)."""
    head = ["conv", "step", "turn", "role", "digest", "half"]
    facts = ["id", "at", "copies", "initial", "blank", "repeated", "cut_off", "before", "edits", "text"]
    edited = found.withColumns({"step": F.lit(1), "half": F.lit(0), "text": F.lit(None).cast("string")}).select(*head, *facts)
    texts = _shaped(rows, *columns).where(F.translate("text", BLANKS, "") != "").withColumns(
        {"step": F.lit(1), "half": F.lit(1)})
    both = edited.unionByName(texts.select(*head, "id", "text"), allowMissingColumns=True)
    if ids is not None:
        both = both.unionByName(ids.select(_key(F.col("id")).alias("conv"), F.lit(0).alias("step"), "id"), allowMissingColumns=True)
    return both.repartition(*by).sortWithinPartitions(*head)


def _walk(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[str, tuple]]:
    """("conversation", (id,)), ("row", facts) and ("line", (id, turn, at, nth,
    letter, role, text)) in order; one text is held at a time."""
    names = ["conv", "step", "turn", "role", "digest", "half", "id", "at", "copies", "initial", "blank", "repeated",
             "cut_off", "before", "edits"]
    waiting: list | None = None  # lines that stand after the text still to come

    def lines(row: dict) -> list[tuple[str, str, bool]]:
        state, out = row["before"], []
        for letter in row["edits"]:
            if letter == "D":
                continue
            if letter == "K":
                out.append(("K", row["role"], True))
                state = _next(state, row["initial"])
            else:
                state = _filled(state)
                out.append((letter, "user" if state == 2 else "assistant", letter == "R"))
        return out

    for batch in batches:
        text_at = batch.schema.names.index("text")
        columns = {c: batch.column(batch.schema.names.index(c)).to_pylist() for c in names if c != "conv"}
        for i in range(len(batch)):
            row = {c: v[i] for c, v in columns.items()}
            if row["step"] == 0:
                yield "conversation", (row["id"],)
                continue
            if row["half"] == 0:
                yield "row", (row,)
                todo = [(row["id"], row["turn"], row["at"], n, *line) for n, line in enumerate(lines(row))]
                while todo and not todo[0][-1]:
                    yield "line", (*todo.pop(0)[:-1], "")
                waiting = todo
            elif waiting:
                text = batch.column(text_at)[i].as_py()
                for line in waiting:
                    yield "line", (*line[:-1], text if line[-1] else "")
                waiting = None


def repair(rows: DataFrame, id_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role", text_col: str = "text",
           piece_bits: int = PIECE_BITS) -> DataFrame:
    """The repaired rows: (id, turn, role, text, edit, at, nth). `edit` is K, R
    or I; an inserted row has an empty text and the turn of the row it is next
    to. (at, nth) is the order within a conversation.

    Rows that must go, or go more cheaply than they stay, are not returned, and
    a conversation without a row left has none. See `edits` for nulls, repeats
    and ties. Every row's lines are made apart, whatever conversation it is of.
    """
    columns = (id_col, turn_col, role_col, text_col)
    found = edits(rows, *columns, piece_bits=piece_bits)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out = []
        for what, got in _walk(batches):
            if what == "line":
                out.append(got)
            if len(out) >= 256:
                yield record(out)
                out = []
        yield record(out)

    schema = T.StructType([T.StructField(id_col, rows.schema[id_col].dataType), T.StructField(turn_col, rows.schema[turn_col].dataType),
                           T.StructField("at", T.LongType()), T.StructField("nth", T.IntegerType()), T.StructField("edit", T.StringType()),
                           T.StructField(role_col, T.StringType()), T.StructField(text_col, T.StringType())])

    def record(out: list[tuple]) -> pa.RecordBatch:
        return pa.RecordBatch.from_pylist([dict(zip(schema.names, line)) for line in out], schema=arrow)
    arrow = to_arrow_schema(schema)
    done = _ordered(rows, found, columns, ["conv", "turn", "role", "digest"], None).mapInArrow(run, schema)
    return done.select(id_col, turn_col, role_col, text_col, "edit", "at", "nth")


def audit(rows: DataFrame, ids: DataFrame, id_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role",
          text_col: str = "text", piece_bits: int = PIECE_BITS) -> DataFrame:
    """(id, gaps, blank, duplicate, truncated, illegal, cost, audit,
    repaired_sha256) of each conversation in `ids`, which may have no rows left.

    A hash of a whole conversation is one stream, so one task reads the rows of
    a conversation in order; it holds one text and the letters of the edits.
    """
    columns = (id_col, turn_col, role_col, text_col)
    found = edits(rows, *columns, piece_bits=piece_bits)
    whole = ids.select(F.col(id_col).alias("id")).distinct()
    counts = ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")
    schema = T.StructType([T.StructField(id_col, rows.schema[id_col].dataType), *(T.StructField(c, T.LongType()) for c in counts),
                           T.StructField("audit", T.StringType()), T.StructField("repaired_sha256", T.StringType())])
    arrow = to_arrow_schema(schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        one: _Report | None = None
        out = []
        for what, got in _walk(batches):
            if what == "conversation":
                if one:
                    out.append(one.row(id_col))
                one = _Report(got[0])
                if len(out) >= 1000:
                    yield pa.RecordBatch.from_pylist(out, schema=arrow)
                    out = []
            elif what == "row":
                one.take(got[0])
            else:
                one.line(got[-2], got[-1])
        if one:
            out.append(one.row(id_col))
        yield pa.RecordBatch.from_pylist(out, schema=arrow)

    return _ordered(rows, found, columns, ["conv"], whole).mapInArrow(run, schema)


class _Report:
    """What is said of one conversation while its rows pass by."""

    def __init__(self, ident):
        self.ident, self.hash, self.lines, self.letters = ident, hashlib.sha256(), 0, []
        self.turns = self.blank = self.duplicate = self.truncated = self.illegal = self.cost = 0
        self.least = self.most = self.role = None

    def take(self, row: dict) -> None:
        copies, turn = row["copies"], row["turn"]
        if turn is not None:
            self.turns += turn != self.most
            self.least, self.most = turn if self.least is None else self.least, turn
        if row["blank"]:
            self.blank += copies
        else:
            self.duplicate += copies if row["repeated"] else copies - 1
            self.truncated += row["cut_off"]
        if self.role is not None:
            self.illegal += (self.role, row["initial"]) not in ((0, 1), (1, 2), (2, 1))
        self.illegal += copies - 1
        self.role = row["initial"]
        letters = row["edits"]
        self.letters.append(letters)
        stays = letters.lstrip("I")[:1] in ("K", "R")
        self.cost += (INSERT * letters.count("I") + DELETE * letters.count("D") + REROLE * letters.count("R")
                      + CUT_OFF * (row["cut_off"] and stays))

    def line(self, role: str, text: str) -> None:
        if self.lines:
            self.hash.update(b"\n")
        self.lines += 1
        self.hash.update(f"{role}:".encode())
        self.hash.update(text.encode())

    def row(self, id_col: str) -> dict:
        gaps = 0 if self.most is None else self.most - self.least + 1 - self.turns
        return {id_col: self.ident, "gaps": gaps, "blank": self.blank, "duplicate": self.duplicate, "truncated": self.truncated,
                "illegal": self.illegal, "cost": self.cost, "audit": "".join(self.letters), "repaired_sha256": self.hash.hexdigest()}


def damaged(rows: DataFrame, id_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role", text_col: str = "text"
            ) -> DataFrame:
    """Rows with planted faults, by crc32 of `id:turn` modulo 20 (nulls are one
    space): 0 the row is gone, 1 its text is empty, 2 it has lost `.`, `!` and `?`, 3 it
    stands twice, 4 its role is user."""
    def given(c: str) -> Column:
        return F.coalesce(F.col(c).cast("string"), F.lit(" "))

    fault = F.crc32(F.concat(given(id_col), F.lit(":"), given(turn_col)).cast("binary")) % 20
    text = F.when(fault == 1, "").when(fault == 2, F.translate(given(text_col), ".!?", "")).otherwise(given(text_col))
    return rows.where(fault != 0).select(
        id_col, turn_col, F.when(fault == 4, "user").otherwise(given(role_col)).alias(role_col), text.alias(text_col),
        F.explode(F.array_repeat(F.lit(0), F.when(fault == 3, 2).otherwise(1))).alias("copy")).drop("copy")
