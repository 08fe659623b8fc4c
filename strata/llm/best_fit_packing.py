"""Best-fit packing by exact-complement hashing.

Token sequences of documents go into as few sequences of ``capacity`` tokens
as can be.  Only documents longer than that are cut, into pieces of
``capacity`` tokens of which the first may be shorter.

What can be packed together depends on lengths alone, so the work splits in three:

1. Every document is encoded and cut where it lies; a piece takes the next
   number among those of its length in its task.  Pieces are written once.
2. The number of pieces of each length (``capacity`` rows, whatever the size of
   the corpus) is planned on the driver.  A plan is a list of patterns: lengths
   that share a sequence, and how often.  A pattern begins with the longest
   length left; its gap is looked up among single lengths, sums of pairs and
   sums of triples (an index of pair sums, kept up as lengths run out; a triple
   is a length whose complement is an indexed pair).  A combination that fills
   the gap exactly is consumed as often as the counts of its lengths allow;
   where there is none, the gap takes its best fit, the longest length that
   fits, and is looked up again.  Every step uses up some length, so the plan
   has a bounded number of patterns, not one per sequence.
3. A piece's number among all of its length (its number in its task, plus the
   counts of earlier tasks, joined) finds its pattern by binary search in the
   plan; sequence and offset follow by arithmetic.  No piece meets another.

Defined results: a null text is the empty text; every document ends with
``end_id``, so an empty one is a piece of one token; rows that repeat an id, and
rows with a null id, are packed each on its own; an empty table gives an empty
result; other columns are ignored, whatever their names."""

from __future__ import annotations

import json
import os
import re
import zlib
from collections import Counter
from collections.abc import Callable, Iterable, Iterator, Mapping
from functools import lru_cache
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from strata.llm.bpe import byte_letters
from strata.llm.bpe import pack as pack_ids
from strata.llm.ship import ship_package
from strata.llm.words import bounded, spread, texts_of
from strata.session import scratch_path

CAPACITY = 1024
CACHE_CHUNKS = 200_000

# Texts are cut before each blank run that follows a word: byte-level BPE never puts a token across that
# place.  Texts with any other white space, or with a special token's string, are encoded whole.
ODD_SPACE = r"[\x0b\x0c\x1c-\x1f\x{85}\x{a0}\x{1680}\x{180e}\x{2000}-\x{200b}\x{2028}\x{2029}\x{202f}\x{205f}\x{2060}\x{3000}\x{feff}]"
# A blank, Latin letters, and ASCII signs behind them: two words of the tokenizer's own splitting.
PLAIN = re.compile(r"( ?[A-Za-z\u00c0-\u00d6\u00d8-\u00f6\u00f8-\u024f]+)([!-/:-@\[-`{-~]*)")


def split_chunks(texts: pa.Array) -> tuple[np.ndarray, np.ndarray, list[bytes]]:
    """(offsets, codes, chunks): text ``i`` is ``codes[offsets[i]:offsets[i+1]]``, each a blank run with the word behind it."""
    offsets = np.frombuffer(texts.buffers()[1], np.int32)[texts.offset:texts.offset + len(texts) + 1].astype(np.int64)
    data = np.frombuffer(texts.buffers()[2] or b"", np.uint8)[offsets[0]:offsets[-1]]
    offsets -= offsets[0]
    blank = (data == 32) | (data == 9) | (data == 10) | (data == 13)
    begins = blank.copy()
    begins[1:] &= ~blank[:-1]
    begins[offsets[:-1][np.diff(offsets) > 0]] = True
    begins = np.flatnonzero(begins)
    ends = np.append(begins, len(data)).astype(np.int32)
    chunks = pa.Array.from_buffers(pa.binary(), len(begins), [None, pa.py_buffer(ends.tobytes()), pa.py_buffer(data.tobytes())]).dictionary_encode()
    return np.searchsorted(begins, offsets), chunks.indices.to_numpy(zero_copy_only=False), chunks.dictionary.to_pylist()


class ChunkEncoder:
    """A tokenizers file; ids are packed little-endian unsigned 32-bit integers."""

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.lib = Tokenizer.from_file(path)
        self.lib.no_truncation()
        self.lib.no_padding()
        spec = json.loads(self.lib.to_str())
        split = spec.get("pre_tokenizer") or {}
        self.by_chunk = (spec.get("normalizer") is None and split.get("type") == "ByteLevel" and split.get("use_regex") and not split.get("add_prefix_space"))
        self.added = [t["content"] for t in spec["added_tokens"]]
        self.letters = dict(enumerate(byte_letters()))
        self.known: dict[bytes, bytes] = {}
        self.parts: dict[str, bytes] = {}

    def library(self, texts: list[str]) -> list[bytes]:
        return [np.array(e.ids, "<u4").tobytes() for e in self.lib.encode_batch_fast(texts, add_special_tokens=False)]

    def part(self, word: str) -> bytes:
        """Ids of one word of the tokenizer's splitting."""
        ids = self.parts.get(word)
        if ids is None:
            if len(self.parts) >= CACHE_CHUNKS:
                self.parts.clear()
            ids = self.parts[word] = pack_ids([t.id for t in self.lib.model.tokenize(word.encode().decode("latin-1").translate(self.letters))])
        return ids

    def chunks(self, chunks: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """(lengths, flat ids) of the chunks, one after another."""
        out = list(map(self.known.get, chunks))
        if len(self.known) > CACHE_CHUNKS:
            self.known.clear()
        rest = []
        for i in [i for i, ids in enumerate(out) if ids is None]:
            text = chunks[i].decode()
            if plain := PLAIN.fullmatch(text):
                out[i] = self.known[chunks[i]] = self.part(plain[1]) + self.part(plain[2]) if plain[2] else self.part(plain[1])
            else:
                rest.append(i)
        for i, ids in zip(rest, self.library([chunks[i].decode() for i in rest])):
            out[i] = self.known[chunks[i]] = ids
        return np.fromiter(map(len, out), np.int64, len(out)) // 4, np.frombuffer(b"".join(out), "<u4")

    def encode(self, texts: pa.Array) -> list[bytes | memoryview]:
        """The ids of each whole text."""
        odd = pa.array([not self.by_chunk] * len(texts))
        if self.by_chunk:
            odd = pc.match_substring_regex(texts, ODD_SPACE)
            for token in self.added:
                odd = pc.or_(odd, pc.match_substring(texts, token))
        offsets, codes, chunks = split_chunks(pc.if_else(odd, "", texts))
        at, ids = spread(codes, offsets, *self.chunks(chunks))
        raw = memoryview(ids.astype("<u4").tobytes())
        out = [raw[4 * a:4 * b] for a, b in zip(at.tolist(), at[1:].tolist())]
        whole = np.flatnonzero(odd.to_numpy(zero_copy_only=False)).tolist()
        for i, ids in zip(whole, self.library(texts.take(pa.array(whole, pa.int64())).to_pylist())):
            out[i] = ids
        return out


@lru_cache(maxsize=2)
def encoder(path: str) -> ChunkEncoder:
    return ChunkEncoder(path)


def cuts(length: int, capacity: int) -> list[tuple[int, int]]:
    """(start, length) of a document's pieces."""
    first = (length - 1) % capacity + 1
    return [(0, first), *((start, capacity) for start in range(first, length, capacity))]


PIECES = "doc_id long, piece int, start long, length long, ids_crc32 long, task int, number long"


def _measure(tokenizer: str, end_id: int, capacity: int) -> Callable:
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        task, seen, end = TaskContext.get().partitionId(), Counter(), int(end_id).to_bytes(4, "little")
        for b in bounded(batches):
            rows = []
            for doc, ids in zip(b.column("doc_id").to_pylist(), encoder(tokenizer).encode(texts_of(b.column("text")))):
                ids = memoryview(bytes(ids) + end)
                for k, (start, length) in enumerate(cuts(len(ids) // 4, capacity)):
                    rows.append((doc, k, start, length, zlib.crc32(ids[4 * start:4 * (start + length)]), task, seen[length]))
                    seen[length] += 1
            types = (pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64(), pa.int32(), pa.int64())
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), types)], ["doc_id", "piece", "start", "length", "ids_crc32", "task", "number"])
    return run


# --- the plan --------------------------------------------------------------------------------------


class Pattern(NamedTuple):
    lengths: tuple[int, ...]  # of the pieces of one sequence, longest first
    times: int


class Complements:
    """Which single lengths, pairs and triples of those left sum to a gap."""

    def __init__(self, counts: Mapping[int, int], capacity: int):
        self.left = np.zeros(capacity + 1, np.int64)
        for length, n in counts.items():
            self.left[length] = n
        have = (self.left > 0).astype(np.int64)
        # pairs[s]: how many pairs of lengths left sum to s, a length with itself if it is left twice
        self.pairs = np.convolve(have, have)[: capacity + 1]
        self.pairs[::2] += 2 * (self.left > 1)[: capacity // 2 + 1] - have[: capacity // 2 + 1]
        self.pairs //= 2

    def use(self, lengths: Iterable[int], times: int) -> None:
        for length, n in Counter(lengths).items():
            before = self.left[length]
            after = before - n * times
            if before > 1 >= after and 2 * length < len(self.pairs):
                self.pairs[2 * length] -= 1
            self.left[length] = after
            if after == 0:
                others = np.flatnonzero(self.left[: len(self.pairs) - length])
                self.pairs[others + length] -= 1

    def longest(self, most: int) -> int:
        """The longest length left that is at most ``most``; 0 if there is none."""
        found = np.flatnonzero(self.left[: most + 1])
        return int(found[-1]) if len(found) else 0

    def pair(self, gap: int, spare: np.ndarray, most: int) -> tuple[int, int] | None:
        """The pair summing to ``gap`` with the longest first length (at most ``most``)."""
        a = np.arange(min(gap - 1, most), (gap - 1) // 2, -1)
        found = a[(spare[a] > 0) & (spare[gap - a] > (2 * a == gap))]
        return (int(found[0]), gap - int(found[0])) if len(found) else None

    def filling(self, gap: int, used: Counter, most: int = 3) -> tuple[int, ...] | None:
        """Up to ``most`` lengths, apart from those ``used``, that sum to ``gap`` exactly: fewest first, then longest first."""
        spare = self.left
        if used:
            spare = spare.copy()
            for length, n in used.items():
                spare[length] -= n
        if spare[gap] > 0:
            return (gap,)
        if most < 2:
            return None
        if self.pairs[gap] > 0 and (pair := self.pair(gap, spare, gap)):
            return pair
        if most < 3:
            return None
        third = np.arange(gap - 2, (gap - 1) // 3, -1)
        for c in third[(spare[third] > 0) & (self.pairs[gap - third] > 0)].tolist():  # the index rules out nearly all that fail
            rest = spare.copy()
            rest[c] -= 1
            if pair := self.pair(gap - c, rest, c):
                return (c, *pair)
        return None


def fill_gaps(counts: Mapping[int, int], capacity: int, most: int) -> list[Pattern]:
    """Patterns that use every length as often as ``counts`` says, gaps filled by up to ``most`` lengths at once."""
    index, out = Complements(counts, capacity), []
    while longest := index.longest(capacity):
        lengths, gap, used = [longest], capacity - longest, Counter([longest])
        while gap:
            if filling := index.filling(gap, used, most):
                lengths += filling
                break
            best = gap
            while (best := index.longest(best)) and index.left[best] <= used[best]:
                best -= 1
            if not best:
                break
            lengths.append(best)
            used[best] += 1
            gap -= best
        used = Counter(lengths)
        times = min(int(index.left[length]) // n for length, n in used.items())
        index.use(lengths, times)
        out.append(Pattern(tuple(sorted(lengths, reverse=True)), times))
    return out


def plan_sequences(counts: Mapping[int, int], capacity: int = CAPACITY) -> list[Pattern]:
    """The plan with the fewest sequences of those that fill gaps by up to triples, pairs, or single lengths."""
    return min((fill_gaps(counts, capacity, most) for most in (3, 2, 1)), key=lambda plan: sum(p.times for p in plan))


class Places:
    """Where the n-th piece of a length goes: the plan as sorted arrays, one row per pattern and length."""

    def __init__(self, plan: list[Pattern], capacity: int):
        self.capacity = capacity
        by: dict[int, list[tuple[int, int, int, int]]] = {}
        done, base = Counter(), 0
        for lengths, times in plan:
            offset = 0
            for length, n in sorted(Counter(lengths).items(), reverse=True):
                by.setdefault(length, []).append((done[length], n, base, offset))
                done[length] += n * times
                offset += n * length
            base += times
        self.rows = {length: np.array(rows, np.int64).T for length, rows in by.items()}

    def of(self, lengths: np.ndarray, numbers: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(sequence, offset) of pieces by length and number."""
        sequence, offset = np.empty(len(lengths), np.int64), np.empty(len(lengths), np.int64)
        order = np.argsort(lengths, kind="stable")
        ends = np.append(np.flatnonzero(np.diff(lengths[order])) + 1, len(order)) if len(order) else []
        first = 0
        for last in ends:
            here = order[first:last]
            length = int(lengths[here[0]])
            begin, per, base, offset_of = self.rows[length]
            at = np.searchsorted(begin, numbers[here], "right") - 1
            nth = numbers[here] - begin[at]
            sequence[here] = base[at] + nth // per[at]
            offset[here] = offset_of[at] + nth % per[at] * length
            first = last
        return sequence, offset


def _place(places: Places) -> Callable:
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            numbers = b.column("number").to_numpy() + b.column("before").to_numpy()
            sequence, offset = places.of(b.column("length").to_numpy(), numbers)
            names = ["doc_id", "piece", "start", "length", "ids_crc32"]
            yield pa.RecordBatch.from_arrays([*(b.column(c) for c in names), pa.array(sequence), pa.array(offset)], [*names, "sequence_id", "offset"])
    return run


def pack(docs: DataFrame, tokenizer: str, end_id: int, capacity: int = CAPACITY, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per piece: doc_id, piece, start (ids of its document before it),
    length, ids_crc32, sequence_id and offset.  ``tokenizer`` is the path of a tokenizers file."""
    spark = docs.sparkSession
    ship_package(spark)
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    path = scratch_path(spark, "pieces")
    rows.mapInArrow(_measure(tokenizer, end_id, capacity), PIECES).write.parquet(path)
    pieces = spark.read.schema(PIECES).parquet(path)
    path = scratch_path(spark, "counts")
    pieces.groupBy("task", "length").agg(F.count(F.lit(1)).alias("n")).write.parquet(path)
    counts = spark.read.schema("task int, length long, n long").parquet(path)
    # at most ``capacity`` rows, however large the corpus
    of_length = {r["length"]: r["n"] for r in counts.groupBy("length").agg(F.sum("n").alias("n")).collect()}
    places = Places(plan_sequences(of_length, capacity), capacity)
    earlier = Window.partitionBy("length").orderBy("task").rowsBetween(Window.unboundedPreceding, -1)
    before = counts.select("task", "length", F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("before"))
    return pieces.join(before, ["task", "length"]).mapInArrow(
        _place(places), "doc_id long, piece int, start long, length long, ids_crc32 long, sequence_id long, offset long")
