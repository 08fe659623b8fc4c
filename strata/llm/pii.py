"""Personal data: base patterns, and bootstrapped contextual extraction.

One pass over every whole text finds the base spans (email, ip, card,
phone) and the candidates: other words with a digit or an ``@``, whole runs of digit groups (of up to
19 digits) with single blanks between them, and addresses spelled out (``name at host dot org``).  Each of
them is one occurrence with its lexical contexts: the words to the left (one,
and two), the glued-on prefix (``password=``), and the word to the right, lower-cased.

Spark then scores the pattern-instance graph for ``rounds`` rounds: a
pattern's confidence in a kind is the mean confidence of the different values it
stands at, however often each is copied; candidates that could be of the kind by their form and aren't accepted yet
are left out, as nothing is known of them, all others count as 0.  An instance's confidence is ``1 - prod(1 - confidence)`` of its
patterns that have at least ``min_support`` different seeds.  Base spans are
the seeds (confidence 1 in their kind, 0 in the others).  Instances that
reach ``accept`` seed the next round, and in the end every occurrence of an
accepted instance next to a confident pattern is a span of the pattern's kind.

The graph is aggregated before every join, so a context or an instance that
occurs in a third of all documents is one row per map task.  Base spans always stay.

Defined results: null texts are empty and have no spans; spans are in code
points, end exclusive; a candidate that overlaps a base span is dropped; an
instance accepted in two kinds takes the more confident, ties by name;
repeated rows are searched each; an empty table gives an empty result; other
columns are ignored."""

from __future__ import annotations

import re
from collections.abc import Iterable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from strata.llm.ship import ship_package
from strata.llm.words import bounded, texts_of
from strata.session import scratch_path

# The base patterns, in the order of the result.
KINDS = ("email", "ip", "card", "phone")
EMAIL = re.compile(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
IP = re.compile(r"(?<![0-9])[0-9]+\.[0-9]+\.[0-9]+\.[0-9]+")  # a match begins where its digits do: long runs are read once
CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])+")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
LOCAL = re.compile(r"[A-Za-z0-9._%+-]+")
DOMAIN = re.compile(r"@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")

MIN_SUPPORT = 5
ACCEPT = 0.8
ROUNDS = 3
CONTEXT_CHARS = 64

WORD = re.compile(r"[^\x20\x09-\x0D]+")
HELD = re.compile("[0-9@]")
GLUED = re.compile(r"^([^\W\d_]{2,}[=:#])(.+)$", re.S)
GROUPS = re.compile(r"[0-9][0-9().+/-]*")
BETWEEN = (" ", ") ", " (", ") (")
LONGEST_RUN = 19
SPELLED = re.compile(r"\x20(?:at|\(at\)|\[at\])\x20[a-z0-9-]+(?:\x20(?:dot|\(dot\)|\[dot\])\x20[a-z0-9-]+)+", re.I | re.A)
DATE = r"^([0-9]{4}[./-][0-9]{1,2}[./-][0-9]{1,2}|[0-9]{1,2}[./-][0-9]{1,2}[./-]([0-9]{2}|[0-9]{4}))$"
EDGES = "\"'()[]{}<>,;:!?.|"


def forms(value: Column) -> list[Column]:
    """Whether an unseen (lower-cased) identifier may be of each kind; dates are of none.

    Signs are tested by character classes and bounded counts only, so that a
    word of any length is read in one pass without recursion."""
    address = value.rlike(r"@|\x20[(\[]?at[)\]]?\x20")
    parts = value.rlike(r"^[0-9a-f.:]++$") & value.rlike("[0-9]") & value.rlike(r"[.:][0-9a-f]*+[.:]")
    card = value.rlike(r"^([0-9][\x20-]?){12,19}$")
    phone = value.rlike(r"^\+?\(?([0-9][\x20()./-]{0,2}){5,15}$")
    return [form & ~value.rlike(DATE) for form in (address, parts, card, phone)]


def luhn(digits: str) -> bool:
    total = 0
    for i, d in enumerate(reversed(digits)):
        x = int(d) * (1 + i % 2)
        total += x - 9 if x > 9 else x
    return total % 10 == 0


def emails(text: str) -> Iterator[tuple[int, int]]:
    """Leftmost non-overlapping matches of EMAIL, found from the ``@`` signs:
    only the run of local-part characters before one is looked at."""
    done = at = 0
    while (at := text.find("@", at)) >= 0:
        m = DOMAIN.match(text, at)
        first = at
        while m and first > done and LOCAL.match(text[first - 1]):
            first -= 1
        if m and first < at:
            yield first, m.end()
            done = at = m.end()
        else:
            at += 1


def base_spans(text: str) -> list[tuple[int, int, int]]:
    """(kind, start, end) of all base matches, by kind as listed, then start."""
    out = [(0, a, b) for a, b in emails(text)] if "@" in text else []
    if not any(d in text for d in "0123456789"):
        return out
    for m in IP.finditer(text):
        if all(len(p.lstrip("0")) <= 3 and int(p) <= 255 for p in m[0].split(".")):
            out.append((1, m.start(), m.end()))
    for m in CARD.finditer(text):
        if m.end() - m.start() >= 13:
            digits = m[0].replace(" ", "").replace("-", "")
            if 13 <= len(digits) <= 19 and luhn(digits):
                out.append((2, m.start(), m.end()))
    if "+" in text:
        for m in PHONE.finditer(text):
            if 9 <= sum(c.isdigit() for c in m[0]) <= 15:
                out.append((3, m.start(), m.end()))
    return out


def spelled_dot(text: str) -> bool:
    low = text.lower()
    return " dot " in low or " (dot) " in low or " [dot] " in low


def spelled_out(text: str) -> Iterator[tuple[int, int]]:
    """Addresses like ``name at host dot org``, found from the `` at ``."""
    done = 0
    for m in SPELLED.finditer(text):
        first = m.start()
        while first > done and LOCAL.match(text[first - 1]):
            first -= 1
        if first < m.start():
            yield first, m.end()
            done = m.end()


def joined_groups(text: str, spans: list[tuple[int, int, int]]) -> list[tuple[int, int, int]]:
    """The candidates with neighbouring digit groups made one, if they have ``LONGEST_RUN`` digits at most."""
    out, k = [], 0
    while k < len(spans):
        last = k
        if GROUPS.fullmatch(text, spans[k][1], spans[k][2]):
            while last + 1 < len(spans) and text[spans[last][2]:spans[last + 1][1]] in BETWEEN and GROUPS.fullmatch(text, spans[last + 1][1], spans[last + 1][2]):
                last += 1
        a, b = spans[k][1], spans[last][2]
        if last > k and sum(c.isdigit() for c in text[a:b]) > LONGEST_RUN:
            out += spans[k:last + 1]
        else:
            if text.count(")", a, b) > text.count("(", a, b) and text[a - 1:a] == "(":
                a -= 1
            elif text.count("(", a, b) > text.count(")", a, b) and text[b:b + 1] == ")":
                b += 1
            out.append((-1, a, b))
        k = last + 1
    return out


def candidates(text: str, base: list[tuple[int, int, int]]) -> list[tuple[int, int, int]]:
    """Other words with a digit or ``@``, without signs at their edges or a glued-on prefix, digit
    groups joined, and addresses spelled out: (-1, start, end)."""
    taken = sorted((a, b) for _, a, b in base)
    spelled = [s for s in spelled_out(text) if not any(a < s[1] and s[0] < b for a, b in taken)] if spelled_dot(text) else []
    taken = sorted(taken + spelled)
    out, k = [], 0
    for m in WORD.finditer(text):
        word = m[0]
        if not HELD.search(word):
            continue
        a = m.start() + len(word) - len(word.lstrip(EDGES))
        b = m.end() - (len(word) - len(word.rstrip(EDGES)))
        if glued := GLUED.match(text[a:b]):
            a += glued.end(1)
        a += len(text[a:b]) - len(text[a:b].lstrip(EDGES))
        while k < len(taken) and taken[k][1] <= a:
            k += 1
        if a < b and not (k < len(taken) and taken[k][0] < b):
            out.append((-1, a, b))
    return sorted(joined_groups(text, out) + [(-1, a, b) for a, b in spelled], key=lambda x: x[1])


def contexts(text: str, a: int, b: int) -> list[str]:
    """Lexical patterns of an occurrence: its glued-on prefix, or the words around it."""
    begin = a
    while begin > 0 and a - begin < CONTEXT_CHARS and not text[begin - 1].isspace():
        begin -= 1
    glued = text[begin:a].lower().lstrip(EDGES)
    if len(glued) > 2 and glued[-1] in "=:#":
        return [f"={glued}"]
    left = text[max(0, a - CONTEXT_CHARS):a].lower().split()
    right = text[b:b + CONTEXT_CHARS].lower().split()
    out = []
    if left:
        out.append(f"<{left[-1]}")
    if len(left) > 1:
        out.append(f"<{left[-2]} {left[-1]}")
    if right:
        out.append(f">{right[0]}")
    return out


OCCURRENCES = "kind int, start long, end long, value string, patterns array<string>"


def _extract(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    kind = pa.list_(pa.struct([("kind", pa.int32()), ("start", pa.int64()), ("end", pa.int64()), ("value", pa.string()), ("patterns", pa.list_(pa.string()))]))
    for batch in bounded(batches):
        rows = []
        for text in texts_of(batch.column("text")).to_pylist():
            base = base_spans(text)
            rows.append([{"kind": k, "start": a, "end": b, "value": text[a:b].lower(), "patterns": contexts(text, a, b)}
                         for k, a, b in base + candidates(text, base)])
        yield pa.RecordBatch.from_arrays([batch.column("row"), batch.column("doc_id"), pa.array(rows, kind)], ["row", "doc_id", "found"])


def _kept(df: DataFrame, name: str) -> DataFrame:
    spark = df.sparkSession
    path = scratch_path(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def score_graph(seen: DataFrame, rounds: int = ROUNDS, min_support: int = MIN_SUPPORT, accept: float = ACCEPT) -> tuple[DataFrame, DataFrame]:
    """Bootstrapping over different (value, base kind or -1, pattern) rows.  Returns (pattern, kind, confidence) and (value, kind, confidence) of
    confident patterns and accepted candidate instances."""
    total = seen.groupBy("pattern").agg(F.count(F.lit(1)).alias("total"))
    seeds = _kept(seen.filter("kind >= 0").groupBy("pattern", "kind").agg(F.count(F.lit(1)).cast("double").alias("weight"), F.count(F.lit(1)).alias("support")), "seeds")
    fits = forms(F.col("value"))
    open_ = seen.filter("kind < 0").join(seeds.select("pattern").distinct(), "pattern", "left_semi").select("value", "pattern", *[f.alias(f"fits_{k}") for k, f in enumerate(fits)])
    open_ = _kept(open_, "open")
    accepted = patterns = None
    for _ in range(rounds):
        known = seeds
        if accepted is not None:
            more = open_.join(accepted, "value").groupBy("pattern", "kind").agg(
                F.sum("confidence").alias("weight"), F.count(F.lit(1)).alias("support"))
            known = known.unionByName(more).groupBy("pattern", "kind").agg(F.sum("weight").alias("weight"), F.sum("support").alias("support"))
        unknown = open_ if accepted is None else open_.join(accepted, "value", "left_anti")
        unknown = unknown.groupBy("pattern").agg(F.array(*[F.sum(F.col(f"fits_{k}").cast("long")) for k in range(len(KINDS))]).alias("unknown"))
        counted = F.col("total") - F.coalesce(F.get("unknown", F.col("kind")), F.lit(0))
        patterns = _kept(known.filter(F.col("support") >= min_support).join(total, "pattern").join(unknown, "pattern", "left").select(
            "pattern", "kind", (F.col("weight") / counted).alias("confidence")).filter(F.col("confidence") >= accept), "patterns")
        # an instance is as doubtful as all its patterns together
        doubt = F.sum(F.log(F.greatest(F.lit(1e-9), 1 - F.col("confidence"))))
        scored = open_.join(patterns, "pattern").groupBy("value", "kind").agg((1 - F.exp(doubt)).alias("confidence")).filter(F.col("confidence") >= accept)
        best = scored.groupBy("value").agg(F.min(F.struct((-F.col("confidence")).alias("c"), "kind")).alias("best"))
        accepted = _kept(best.select("value", F.col("best.kind").alias("kind"), (-F.col("best.c")).alias("confidence")), "instances")
    return patterns, accepted


def find_personal_data(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", rounds: int = ROUNDS,
                       min_support: int = MIN_SUPPORT, accept: float = ACCEPT) -> DataFrame:
    """One row per row of ``docs``: doc_id, ``base`` and ``added``, arrays of
    (kind, start, end) in the order of KINDS, then start."""
    ship_package(docs.sparkSession)
    rows = docs.select(F.monotonically_increasing_id().alias("row"), F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    found = _kept(rows.mapInArrow(_extract, f"row long, doc_id long, found array<struct<{OCCURRENCES.replace(' ', ':').replace(',:', ',')}>>"), "found")
    each = found.select("row", F.explode("found").alias("f")).select("row", "f.*")
    seen = _kept(each.select("value", "kind", F.explode("patterns").alias("pattern")).distinct(), "seen")
    patterns, accepted = score_graph(seen, rounds, min_support, accept)
    named = (each.filter("kind < 0").select("row", "start", "end", "value", F.explode("patterns").alias("pattern"))
             .join(accepted.select("value", F.col("kind").alias("as_kind")), "value")
             .join(patterns.select("pattern", F.col("kind").alias("as_kind")), ["pattern", "as_kind"], "left_semi"))
    added = named.select("row", "start", "end", "as_kind").distinct().groupBy("row").agg(
        F.sort_array(F.collect_list(F.struct(F.col("as_kind").alias("kind"), "start", "end"))).alias("added"))
    base = F.transform(F.filter("found", lambda f: f["kind"] >= 0), lambda f: F.struct(f["kind"].alias("kind"), f["start"].alias("start"), f["end"].alias("end")))
    none = F.array().cast("array<struct<kind:int,start:bigint,end:bigint>>")
    return found.select("row", "doc_id", base.alias("base")).join(added, "row", "left").select("doc_id", "base", F.coalesce("added", none).alias("added"))
