"""Conversation repair against a search over all edits, in pieces of every size."""

import heapq
import random
import re
from collections import defaultdict
from hashlib import sha256

import pytest
from pyspark.sql import functions as F

from strata.llm import conversation_repair as R
from strata.llm.queries import QUERIES

BLANK = re.compile(r"[^\x20\x09-\x0D]")


def faults(rows):
    seen, out = set(), []
    for role, text in rows:
        said = BLANK.findall(text)
        out.append("blank" if not said else "duplicate" if (role, text) in seen else "truncated" if said[-1] not in ".!?" else "")
        seen.add((role, text))
    return out


def cheapest(rows):
    """(cost, audit, repaired rows): always go on with the least (cost, audit) so far."""
    fault = faults(rows)
    heap, done = [(0, "", 0, "", ())], set()
    while True:
        cost, audit, i, last, out = heapq.heappop(heap)
        if i == len(rows) and last in ("", "a"):
            return cost, audit, out
        if (i, last) in done:
            continue
        done.add((i, last))
        role = "assistant" if last == "u" else "user"
        heapq.heappush(heap, (cost + 5, audit + "I", i, role[0], (*out, (role, ""))))
        if i < len(rows):
            heapq.heappush(heap, (cost + 2, audit + "D", i + 1, last, out))
            if fault[i] in ("", "truncated"):
                more = 5 if fault[i] else 0
                heapq.heappush(heap, (cost + 1 + more, audit + "R", i + 1, role[0], (*out, (role, rows[i][1]))))
                x = rows[i][0][:1]
                if x == role[0] or (x == "s" and last == ""):
                    heapq.heappush(heap, (cost + more, audit + "K", i + 1, x, (*out, rows[i])))


def brute(turns):
    """conv_id -> all columns of the report, from (conv_id, turn, role, text) rows."""
    by = defaultdict(list)
    for conv, turn, role, text in turns:
        by[conv].append((turn, role, text))
    want = {}
    for conv, rows in by.items():
        rows.sort(key=lambda r: (r[0] is not None, r[0] or 0, r[1], r[2]))
        said = [(role, text) for _, role, text in rows]
        known = [t for t, _, _ in rows if t is not None]
        fault = faults(said)
        cost, audit, out = cheapest(said)
        illegal = sum((a[0][:1] + b[0][:1]) not in ("su", "ua", "au") for a, b in zip(said, said[1:]))
        gaps = max(known) - min(known) + 1 - len(set(known)) if known else 0
        digest = sha256("\n".join(f"{r}:{t}" for r, t in out).encode()).hexdigest()
        want[conv] = (gaps, *(fault.count(f) for f in ("blank", "duplicate", "truncated")), illegal, cost, audit, digest)
    return want


COLUMNS = ("gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256")


def report(turns, ids=None, **kw):
    return {r["conv_id"]: tuple(r[c] for c in COLUMNS) for r in R.conversation_report(turns, ids or turns, **kw).collect()}


def conversations(rng, n, longest):
    rows = []
    for conv in [*range(n), None]:
        for turn in range(rng.randint(1, longest)):
            role = rng.choice(["user", "assistant"] * 4 + ["system", "tool", "", "User"])
            text = rng.choice(["Yes.", "No!", "cut off", "", " \t\n", "Why?", f"t{turn}.", f"u{turn}", "é.\n"])
            rows.append((conv, rng.choice([turn, turn, turn + 1, None]), role, text))
    return rows


@pytest.mark.parametrize("piece,fan", [(4096, 512), (1, 2), (3, 2), (2, 3)])
def test_repairs_are_the_audit_least_cheapest(spark, monkeypatch, piece, fan):
    rows = conversations(random.Random(piece), 150, 14)
    turns = spark.createDataFrame([(*r, 1, "x") for r in rows], "conv_id long, turn long, role string, text string, none int, conv string").repartition(3)
    monkeypatch.setattr(R, "PIECE_ROWS", piece)
    cut = R._cut
    monkeypatch.setattr(R, "_cut", with_piece(cut, piece))
    assert report(turns, fan=fan) == brute(rows)


def with_piece(cut, piece):
    """The workers import the module anew: set its size of pieces there."""
    def run(batches):
        import strata.llm.conversation_repair as module

        module.PIECE_ROWS = piece
        try:
            yield from cut(batches)
        finally:
            module.PIECE_ROWS = 4096
    return run


def test_divide_and_conquer_is_the_whole_search():
    rng, steps = random.Random(8), R.Steps()
    for _ in range(300):
        rows = [(rng.choice(["user", "assistant", "system", "tool"]), rng.choice(["a.", "b", "", f"{i}."])) for i in range(rng.randint(0, 20))]
        status = {"": R.OK, "truncated": R.CUT_OFF}
        kinds = bytes(4 * status.get(f, R.MUST_GO) + max(0, "?sua".find(r[0])) for f, (r, _) in zip(faults(rows), rows))
        whole = steps.table(kinds)[R.START]
        end = R.crossing(whole, [c for c, _ in R.ENDING])
        audit = "".join(R.row_edits(kinds, R.START, end, steps)) + R.ENDING[end][1]
        assert (whole[0][end] + R.ENDING[end][0], audit) == cheapest(rows)[:2]
        tables = [steps.table(kinds[i:i + 3]) for i in range(0, len(kinds), 3)]
        assert R.composed(tables)[R.START] == whole
        assert R.unflat(R.flat(R.composed(tables))) == R.composed(tables)


def test_one_conversation_may_hold_most_rows(spark):
    """Thousands of rows of one conversation, a third of them equal, and a conversation all of whose rows were dropped."""
    rows = [(7, None if i % 3 == 0 else i, "user" if i % 2 else "assistant", "same text." if i % 3 == 0 else f"text {i}" + "." * (i % 5 > 0)) for i in range(9000)]
    rows += [(c, 0, "user", "hello there.") for c in range(100)] + [(c, 1, "assistant", "yes.") for c in range(100) if c != 7]
    turns = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").repartition(5)
    ids = turns.select("conv_id").unionByName(spark.range(-1, 0).select(F.col("id").alias("conv_id")))
    got = report(turns, ids, fan=4)
    empty = sha256(b"").hexdigest()
    assert got.pop(-1) == (0, 0, 0, 0, 0, 0, "", empty)
    assert got == brute(rows)


def test_long_texts_empty_tables_and_the_query(spark, sf):
    rows = [(1, 0, "user", "x" * 3_000_000 + "."), (1, 1, "assistant", "y" * 2_000_000), (2, 0, "assistant", "z.")]
    turns = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    assert report(turns) == brute(rows)
    assert report(turns.limit(0)) == {}
    edits, summary = R.repair(turns.limit(0))
    assert edits.count() == 0 and summary.count() == 0
    edits, _ = R.repair(spark.createDataFrame([(3, 0, "assistant", "b."), (3, 1, "tool", "c.")], "conv_id long, turn long, role string, text string"))
    assert [(r["audit"], [tuple(x) for x in r["repaired"]]) for r in edits.collect()] == [("RR", [("user", "b."), ("assistant", "c.")])]
    got = QUERIES["op12_conversation_repair"](spark, sf)
    assert got.count() == spark.read.parquet(f"{sf}/conversations.parquet").select("conv_id").distinct().count()
