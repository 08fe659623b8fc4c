"""Conversation structure repair by Hirschberg's divide and conquer.

A conversation's rows, by turn, are edited at the least cost until their role
initials read ``(s?(ua)+)?`` (system at most first, then user and assistant in
turns).  Edits: Keep 0, Rerole to user or assistant 1, Delete 2 (required for
blank and duplicate rows), Insert an empty user or assistant row 5; a truncated
row that stays costs 5 more.  Of equally cheap repairs, the one whose audit
(the edits' initials) is least in ASCII is taken.

*States.*  What has been put out so far matters only by its last role: nothing,
system, user or assistant.  A stretch of rows is a 4 x 4 table: the least cost
from each state to each, and the rank of the least audit among those of the
same first state.  Audits are compared after a row's own edit; there none is a
prefix of another, so ranks are all that later stretches need to know of it.

*Pieces.*  Rows are range-partitioned by conversation and turn and cut into
pieces of bounded rows and bytes, so a conversation that holds a third of all
rows is many pieces.  Their tables are composed up a tree of ``fan`` children a
node; then, from the root down, forward cost vectors from the left meet
backward vectors from the right, the audit-least optimal crossing is fixed, and
both halves recurse: over the children of a node, and at last over a piece's
own rows.  No table of rows x states is ever held: memory is linear.

Defined results: a null role or text reads as one space; rows of the same turn
go by role, then by the first 32 characters and a hash of the text, null turns
first; a null id is a conversation of its own; an empty table gives empty
tables; other columns are ignored, whatever their names."""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator, Sequence
from hashlib import sha256

import pyarrow as pa
import xxhash
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from strata.llm.ship import ship_package
from strata.llm.words import give_back
from strata.session import scratch_path

# Costs of the edits, and the roles that are put out.
REROLE, DELETE, INSERT, TRUNCATED = 1, 2, 5, 5
USER, ASSISTANT = "user", "assistant"
BLANKS = " \t\n\x0b\x0c\r"

START, SYSTEM, AFTER_USER, AFTER_ASSISTANT = range(4)
STATES = range(4)
NEVER = 1 << 60
OK, CUT_OFF, MUST_GO = 0, 1, 2  # what an edit may do with a row
FAN = 512
PIECE_ROWS = 4096
PIECE_BYTES = 1 << 20

Vector = tuple[tuple[int, ...], tuple[int, ...]]  # per state: least cost, rank of its least audit
Table = tuple[Vector, ...]  # a vector for each first state


# --- one row ---------------------------------------------------------------------------------------


def put_out(state: int) -> int:
    """The state after the role that may follow ``state`` (user, or assistant after a user)."""
    return AFTER_ASSISTANT if state == AFTER_USER else AFTER_USER


def moves(kind: int, state: int) -> list[tuple[int, str, int]]:
    """(cost, edits, state after) of every way to treat a row, with insertions before it."""
    status, initial = divmod(kind, 4)
    out = []
    for inserts in range(3):  # a third can't help: two lead from any state to one that needs none
        lead, cost = "I" * inserts, INSERT * inserts
        out.append((cost + DELETE, lead + "D", state))
        if status != MUST_GO:
            stays = cost + (TRUNCATED if status == CUT_OFF else 0)
            out.append((stays + REROLE, lead + "R", put_out(state)))
            if (initial == SYSTEM and state == START) or (initial != SYSTEM and initial == put_out(state)):
                out.append((stays, lead + "K", initial))
        state = put_out(state)
    return out


def ranked(best: Sequence[tuple]) -> Vector:
    """A vector of (cost, order of the audit) per state; the order is any comparable value."""
    known = sorted((order, t) for t, (cost, order) in enumerate(best) if cost < NEVER)
    ranks = [4] * 4
    for k, (_, t) in enumerate(known):
        ranks[t] = k
    return tuple(cost for cost, _ in best), tuple(ranks)


def row_words(kind: int) -> list[list[tuple[int, str]]]:
    """(cost, edits) of the best treatment of a row from each state to each."""
    out = []
    for state in STATES:
        best = [(NEVER, "~")] * 4
        for cost, word, after in moves(kind, state):
            best[after] = min(best[after], (cost, word))
        out.append(best)
    return out


WORDS = [row_words(kind) for kind in range(12)]
ROWS: list[Table] = [tuple(ranked(best) for best in words) for words in WORDS]
UNIT: Table = tuple(ranked([(0, "") if s == t else (NEVER, "") for t in STATES]) for s in STATES)
# what is inserted at the end: nothing, an assistant after a user, a user and an assistant after a system turn
ENDING = ((0, ""), (2 * INSERT, "II"), (INSERT, "I"), (0, ""))


# --- stretches of rows -----------------------------------------------------------------------------


def forward(vector: Vector, table: Table) -> Vector:
    """The vector after one more stretch."""
    costs, ranks = vector
    best = []
    for t in STATES:
        cost, rank, s = min((costs[s] + table[s][0][t], ranks[s], s) for s in STATES)
        best.append((cost, (rank, table[s][1][t])) if cost < NEVER else (NEVER, (4, 4)))
    return ranked(best)


def backward(table: Table, after: Sequence[int]) -> tuple[int, ...]:
    """Least costs from each state through the stretch, given those behind it."""
    return tuple(min(NEVER, min(table[s][0][t] + after[t] for t in STATES)) for s in STATES)


class Steps:
    """``forward`` and ``backward`` over rows, remembered: less their smallest cost, vectors recur."""

    def __init__(self) -> None:
        self.ahead: dict = {}
        self.behind: dict = {}

    def forward(self, vector: Vector, kinds: bytes) -> Vector:
        base, known = 0, self.ahead
        for kind in kinds:
            step = known.get((vector, kind))
            if step is None:
                costs, ranks = forward(vector, ROWS[kind])
                least = min(costs)
                step = known[vector, kind] = (tuple(c - least if c < NEVER else NEVER for c in costs), ranks), least
            vector, more = step
            base += more
        return tuple(c + base if c < NEVER else NEVER for c in vector[0]), vector[1]

    def backward(self, kinds: bytes, after: tuple[int, ...]) -> tuple[int, ...]:
        base, known = 0, self.behind
        for kind in reversed(kinds):
            step = known.get((after, kind))
            if step is None:
                costs = backward(ROWS[kind], after)
                least = min(costs)
                step = known[after, kind] = tuple(c - least if c < NEVER else NEVER for c in costs), least
            after, more = step
            base += more
        return tuple(c + base if c < NEVER else NEVER for c in after)

    def table(self, kinds: bytes) -> Table:
        return tuple(self.forward(UNIT[s], kinds) for s in STATES)


def only(state: int) -> tuple[int, ...]:
    return tuple(0 if s == state else NEVER for s in STATES)


def crossing(ahead: Vector, behind: Sequence[int]) -> int:
    """The state where the cheapest way, of those the audit-least, crosses the middle."""
    return min((ahead[0][s] + behind[s], ahead[1][s], s) for s in STATES)[2]


def row_edits(kinds: bytes, first: int, last: int, steps: Steps) -> list[str]:
    """The edits of each row on the audit-least cheapest way from state ``first`` to ``last``."""
    out = [""] * len(kinds)
    open_ = [(0, len(kinds), first, last)] if kinds else []
    while open_:
        lo, hi, a, b = open_.pop()
        if hi - lo == 1:
            out[lo] = WORDS[kinds[lo]][a][b][1]
            continue
        mid = (lo + hi) // 2
        s = crossing(steps.forward(UNIT[a], kinds[lo:mid]), steps.backward(kinds[mid:hi], only(b)))
        open_ += [(lo, mid, a, s), (mid, hi, s, b)]
    return out


def child_states(tables: Sequence[Table], first: int, last: int) -> list[tuple[int, int]]:
    """(first, last) state of each child of a node that is passed from ``first`` to ``last``."""
    out = [(0, 0)] * len(tables)
    open_ = [(0, len(tables), first, last)]
    while open_:
        lo, hi, a, b = open_.pop()
        if hi - lo == 1:
            out[lo] = (a, b)
            continue
        mid = (lo + hi) // 2
        ahead, behind = UNIT[a], only(b)
        for table in tables[lo:mid]:
            ahead = forward(ahead, table)
        for table in reversed(tables[mid:hi]):
            behind = backward(table, behind)
        s = crossing(ahead, behind)
        open_ += [(lo, mid, a, s), (mid, hi, s, b)]
    return out


def composed(tables: Iterable[Table]) -> Table:
    whole = UNIT
    for table in tables:
        whole = tuple(forward(v, table) for v in whole)
    return whole


def flat(table: Table) -> list[int]:
    return [x for costs, ranks in table for x in (*costs, *ranks)]


def unflat(values: Sequence[int]) -> Table:
    return tuple((tuple(values[8 * s:8 * s + 4]), tuple(values[8 * s + 4:8 * s + 8])) for s in STATES)


# --- Spark -----------------------------------------------------------------------------------------

ROW = pa.struct([("turn", pa.int64()), ("role", pa.string()), ("text", pa.string())])
PIECES = "none boolean, conv long, part int, block int, rows array<struct<turn:long,role:string,text:string>>, keys array<binary>"
MARKED = ("none boolean, conv long, part int, block int, kinds binary, matrix array<long>, blank long, duplicate long, truncated long, "
          "illegal long, opening string, closing string, turns long, low long, high long")
EDITS = "none boolean, conv long, part int, block int, audit string, repaired array<struct<role:string,text:string>>"


def _initial(role: str) -> str:
    return role[:1]


def _cut(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Consecutive rows of a conversation as pieces, with a digest of each (role, text) that is new in its piece."""
    part = TaskContext.get().partitionId()
    block, held, rows, keys, size = 0, None, [], [], 0

    def piece() -> pa.RecordBatch:
        nonlocal block, rows, keys, size
        out = pa.RecordBatch.from_arrays(
            [pa.array([held[0]]), pa.array([held[1]], pa.int64()), pa.array([part], pa.int32()), pa.array([block], pa.int32()),
             pa.array([rows], pa.list_(ROW)), pa.array([keys], pa.list_(pa.binary()))], ["none", "conv", "part", "block", "rows", "keys"])
        block, rows, keys, size = block + 1, [], [], 0
        return out

    for batch in batches:
        for none, conv, turn, role, text in zip(*(batch.column(c).to_pylist() for c in ("none", "conv", "turn", "role", "text"))):
            if rows and (held != (none, conv) or len(rows) >= PIECE_ROWS or size >= PIECE_BYTES):
                yield piece()
            if not rows:
                held, seen = (none, conv), set()
            key = xxhash.xxh3_128_digest(f"{len(role)}:{role}{text}")
            keys.append(None if key in seen else key)
            seen.add(key)
            rows.append({"turn": turn, "role": role, "text": text})
            size += len(role) + len(text)
    if rows:
        yield piece()
    give_back()


def _mark(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Faults, kinds and table of each piece; ``late`` are the rows whose text stood in an earlier piece."""
    steps = Steps()
    for batch in batches:
        out = []
        for p in batch.to_pylist():
            late, kinds, blank, duplicate, truncated = set(p["late"] or ()), bytearray(), 0, 0, 0
            for i, (r, key) in enumerate(zip(p["rows"], p["keys"])):
                said = r["text"].rstrip(BLANKS)
                status = OK
                if not said:
                    blank, status = blank + 1, MUST_GO
                elif key is None or i in late:
                    duplicate, status = duplicate + 1, MUST_GO
                elif said[-1] not in ".!?":
                    truncated, status = truncated + 1, CUT_OFF
                kinds.append(4 * status + max(0, "?sua".find(_initial(r["role"]))))
            initials = [_initial(r["role"]) for r in p["rows"]]
            turns = [r["turn"] for r in p["rows"] if r["turn"] is not None]
            out.append({"none": p["none"], "conv": p["conv"], "part": p["part"], "block": p["block"], "kinds": bytes(kinds), "matrix": flat(steps.table(bytes(kinds))),
                        "blank": blank, "duplicate": duplicate, "truncated": truncated, "illegal": sum(a + b not in ("su", "ua", "au") for a, b in zip(initials, initials[1:])),
                        "opening": initials[0], "closing": initials[-1], "turns": len(set(turns)), "low": min(turns, default=None), "high": max(turns, default=None)})
        yield pa.RecordBatch.from_pylist(out, MARKED_ARROW)
    give_back()


MARKED_ARROW = pa.schema([("none", pa.bool_()), ("conv", pa.int64()), ("part", pa.int32()), ("block", pa.int32()), ("kinds", pa.binary()), ("matrix", pa.list_(pa.int64())),
                          *[(c, pa.int64()) for c in ("blank", "duplicate", "truncated", "illegal")], ("opening", pa.string()), ("closing", pa.string()),
                          *[(c, pa.int64()) for c in ("turns", "low", "high")]])


def _compose(key: tuple, children: pa.Table) -> pa.Table:
    children = children.sort_by("place")
    whole = composed(unflat(m) for m in children.column("matrix").to_pylist())
    return pa.table({"none": children.column("none")[:1], "conv": children.column("conv")[:1], "place": pa.array([key[2].as_py()], pa.int64()),
                     "matrix": pa.array([flat(whole)], pa.list_(pa.int64()))})


def _descend(key: tuple, children: pa.Table) -> pa.Table:
    children = children.sort_by("place")
    first, last = children.column("parent_first")[0].as_py(), children.column("parent_last")[0].as_py()
    states = child_states([unflat(m) for m in children.column("matrix").to_pylist()], first, last)
    return pa.table({"none": children.column("none"), "conv": children.column("conv"), "place": children.column("place"),
                     "first": pa.array([a for a, _ in states], pa.int32()), "last": pa.array([b for _, b in states], pa.int32())})


def _root(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        first, last, costs = [], [], []
        for m in batch.column("matrix").to_pylist():
            whole = unflat(m)[START]
            end = crossing(whole, [cost for cost, _ in ENDING])
            first.append(START)
            last.append(end)
            costs.append(whole[0][end] + ENDING[end][0])
        yield pa.RecordBatch.from_arrays([batch.column("none"), batch.column("conv"), batch.column("place"), pa.array(first, pa.int32()), pa.array(last, pa.int32()), pa.array(costs, pa.int64())],
                                         ["none", "conv", "place", "first", "last", "cost"])


def _edit(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    steps = Steps()
    for batch in batches:
        out = []
        for p in batch.to_pylist():
            state, audit, repaired = p["first"], [], []
            words = row_edits(p["kinds"], p["first"], p["last"], steps)
            for word, row in zip([*words, ENDING[p["last"]][1] if p["closes"] else ""], [*p["rows"], None]):
                audit.append(word)
                for edit in word:
                    if edit == "D":
                        continue
                    state = SYSTEM if edit == "K" and _initial(row["role"]) == "s" else put_out(state)
                    role = row["role"] if edit == "K" else USER if state == AFTER_USER else ASSISTANT
                    repaired.append({"role": role, "text": "" if edit == "I" else row["text"]})
            out.append({"none": p["none"], "conv": p["conv"], "part": p["part"], "block": p["block"], "audit": "".join(audit), "repaired": repaired})
        yield pa.RecordBatch.from_pylist(out, EDITS_ARROW)
    give_back()


EDITS_ARROW = pa.schema([("none", pa.bool_()), ("conv", pa.int64()), ("part", pa.int32()), ("block", pa.int32()), ("audit", pa.string()),
                         ("repaired", pa.list_(pa.struct([("role", pa.string()), ("text", pa.string())])))])


def _kept(df: DataFrame, name: str) -> DataFrame:
    spark = df.sparkSession
    path = scratch_path(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


CONV = ["none", "conv"]
HERE = ["part", "block"]


def _pieces(turns: DataFrame, id_col: str, turn_col: str, role_col: str, text_col: str) -> DataFrame:
    rows = turns.select(F.col(id_col).isNull().alias("none"), F.coalesce(F.col(id_col).cast("long"), F.lit(0)).alias("conv"), F.col(turn_col).cast("long").alias("turn"),
                        *[F.coalesce(F.col(c), F.lit(" ")).alias(name) for c, name in ((role_col, "role"), (text_col, "text"))])
    # the number is written first: it then splits rows that are equal in all else, and no retry changes it
    rows = _kept(rows.withColumn("number", F.monotonically_increasing_id()), "turns")
    order = ["none", "conv", F.col("turn").asc_nulls_first(), "role", F.substring("text", 1, 32), F.xxhash64("text"), "number"]
    return _kept(rows.repartitionByRange(*order).sortWithinPartitions(*order).mapInArrow(_cut, PIECES), "pieces")


def _marked(pieces: DataFrame) -> DataFrame:
    """Faults of each piece.  Only texts of conversations in several pieces are compared across them."""
    several = pieces.groupBy(*CONV).agg(F.count(F.lit(1)).alias("n")).filter("n > 1").select(*CONV)
    said = (pieces.select(*CONV, *HERE, "keys").join(several, CONV, "left_semi").select(*CONV, *HERE, F.posexplode("keys").alias("i", "key")).filter("key is not null"))
    first = said.groupBy(*CONV, "key").agg(F.min(F.struct(*HERE)).alias("first"), F.count(F.lit(1)).alias("n")).filter("n > 1").drop("n")
    late = said.join(first, [*CONV, "key"]).filter(F.struct(*HERE) != F.col("first")).groupBy(*HERE).agg(F.collect_list("i").alias("late"))
    return _kept(pieces.join(late, HERE, "left").mapInArrow(_mark, MARKED), "marked")


ROOT = "none boolean, conv long, place long, first int, last int, cost long"


def _passages(placed: DataFrame, fan: int) -> tuple[DataFrame, DataFrame]:
    """(first, last) state of every piece, and the least cost of every conversation.

    A conversation of one piece is its own root, in place; only those in several pieces go up and down a tree."""
    alone = (F.col("place") == 0) & F.col("closes")
    single = placed.filter(alone).select(*CONV, "place", "matrix").mapInArrow(_root, ROOT)
    states, costs = _tree(placed.filter(~alone), fan)
    return states.unionByName(single.drop("cost")), costs.unionByName(single.select(*CONV, "cost"))


def _tree(placed: DataFrame, fan: int) -> tuple[DataFrame, DataFrame]:
    levels = [placed.select(*CONV, "place", "matrix")]
    schema = "none boolean, conv long, place long, matrix array<long>"
    while True:
        up = levels[-1].groupBy(*CONV, F.expr(f"place div {fan}").alias("above")).applyInArrow(_compose, schema)
        levels.append(_kept(up, "level"))
        if not levels[-1].agg(F.max("place").alias("m")).first()["m"]:
            break
    root = _kept(levels[-1].mapInArrow(_root, ROOT), "root")
    known = root.drop("cost")
    for level in reversed(levels[:-1]):
        above = known.select(*CONV, F.col("place").alias("above"), F.col("first").alias("parent_first"), F.col("last").alias("parent_last"))
        down = level.withColumn("above", F.expr(f"place div {fan}")).join(above, [*CONV, "above"])
        known = _kept(down.groupBy(*CONV, "above").applyInArrow(_descend, "none boolean, conv long, place long, first int, last int"), "states")
    return known, root.select(*CONV, "cost")


def repair(turns: DataFrame, id_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role", text_col: str = "text", fan: int = FAN) -> tuple[DataFrame, DataFrame]:
    """The repaired conversations and a summary of each.

    The first has one row per piece: none (whether the id is null), conv (the id, 0 if null),
    part, block (the order of the pieces), audit, and repaired, an array of (role, text).  The second
    has one row per conversation: none, conv, gaps, blank, duplicate, truncated, illegal, cost."""
    ship_package(turns.sparkSession)
    pieces = _pieces(turns, id_col, turn_col, role_col, text_col)
    by = Window.partitionBy(*CONV).orderBy(*HERE)
    before = by.rowsBetween(Window.unboundedPreceding, -1)
    placed = (_marked(pieces).withColumn("place", F.row_number().over(by).cast("long") - 1).withColumn("closes", F.lead("part").over(by).isNull())
              .withColumn("crosses", F.concat(F.lag("closing").over(by), "opening")).withColumn("reached", F.last("high", ignorenulls=True).over(before)))
    placed = _kept(placed, "placed")
    states, costs = _passages(placed, fan)
    passed = placed.select(*CONV, *HERE, "place", "kinds", "closes").join(states, [*CONV, "place"]).select(*HERE, "kinds", "closes", "first", "last")
    edits = _kept(pieces.drop("keys").join(passed, HERE).mapInArrow(_edit, EDITS), "edits")
    turns_seen = F.sum(F.col("turns") - F.coalesce((F.col("low") == F.col("reached")).cast("long"), F.lit(0)))
    summary = placed.groupBy(*CONV).agg(
        F.coalesce(F.max("high") - F.min("low") + 1 - turns_seen, F.lit(0)).alias("gaps"), *[F.sum(c).alias(c) for c in ("blank", "duplicate", "truncated")],
        (F.sum("illegal") + F.count_if(~F.col("crosses").isin("su", "ua", "au"))).alias("illegal"))
    return edits, summary.join(costs, CONV)


def _digest(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(none, conv, audit, sha256) of conversations whose pieces come in order: one piece is held at a time."""
    held, audit, sha, wrote = None, [], None, False

    def out() -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array([held[0]]), pa.array([held[1]], pa.int64()), pa.array(["".join(audit)]), pa.array([sha.hexdigest()])],
                                          ["none", "conv", "audit", "repaired_sha256"])

    for batch in batches:
        for none, conv, part, rows in zip(*(batch.column(c).to_pylist() for c in ("none", "conv", "audit", "repaired"))):
            if held != (none, conv):
                if held is not None:
                    yield out()
                held, audit, sha, wrote = (none, conv), [], sha256(), False
            audit.append(part)
            for r in rows:
                sha.update(f"{chr(10) if wrote else ''}{r['role']}:{r['text']}".encode())
                wrote = True
    if held is not None:
        yield out()


def repair_digests(edits: DataFrame) -> DataFrame:
    """Audit and sha256 (of ``role:text``, newline-joined) of each conversation.  A hash runs over
    a text from its beginning, so a conversation's pieces stream through one task, one at a time."""
    ordered = edits.repartition(*CONV).sortWithinPartitions(*CONV, *HERE)
    return ordered.mapInArrow(_digest, "none boolean, conv long, audit string, repaired_sha256 string")


def conversation_report(turns: DataFrame, ids: DataFrame, fan: int = FAN) -> DataFrame:
    """One row for each different ``conv_id`` of ``ids``; one without rows has zeros and an empty repair."""
    edits, summary = repair(turns, fan=fan)
    every = ids.select(F.col("conv_id").isNull().alias("none"), F.coalesce(F.col("conv_id").cast("long"), F.lit(0)).alias("conv")).distinct()
    found = every.join(summary, CONV, "left").join(repair_digests(edits), CONV, "left")
    counts = [F.coalesce(c, F.lit(0)).cast("long").alias(c) for c in ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")]
    return found.select(F.when(~F.col("none"), F.col("conv")).alias("conv_id"), *counts, F.coalesce("audit", F.lit("")).alias("audit"),
                        F.coalesce("repaired_sha256", F.lit(sha256(b"").hexdigest())).alias("repaired_sha256"))
