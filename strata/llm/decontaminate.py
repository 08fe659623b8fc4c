"""Benchmark decontamination by greedy string tiling.

Texts are word sequences (runs of letters and digits, lower-cased).  The
running Karp-Rabin hash of every ``min_match``-word window of a document is joined with
those of the benchmark items; hits on one diagonal form maximal matches.  Per
document and item the longest match is marked first, then the longest of
what is left unmarked on both sides, and so on (matches never overlap, and
their order doesn't matter, so reordered passages count in full).  A
document is contaminated by an item if the tiles cover at least ``coverage`` of the item's words, or if those of
``PASSAGE_TILE`` words or more cover ``PASSAGE_WORDS``, however long the item is.

Documents are read in place, without a shuffle.  The benchmark is written as a
table of blocks of about ``block_bytes`` of text in the shared folder, and tasks read a block
from there: no item passes through the driver or a plan.  A larger benchmark takes one scan of
the documents per block, each written before the next, so a plan or a worker holds one block.

Defined results: null texts are empty; an item of fewer than ``min_match``
words matches where it stands whole: anywhere if it has ``SHORT_WORDS`` or more, else only as a document of
nothing else; an item without words matches nothing; repeated rows give
repeated results; empty tables give an empty result; other columns are
ignored by ``contaminated`` and passed through by ``drop_contaminated``, whatever their names."""

from __future__ import annotations

import heapq
import math
import re
from collections.abc import Callable, Iterable, Iterator
from functools import lru_cache, reduce

import numpy as np
import pyarrow as pa
import pyarrow.fs as pafs
import pyarrow.parquet as pq
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strata.llm.ship import ship_package
from strata.llm.token_files import open_folder
from strata.llm.words import bounded, spread, split_words, texts_of
from strata.session import scratch_path

MIN_MATCH = 5
COVERAGE = 0.5
PASSAGE_TILE, PASSAGE_WORDS = 8, 50
SHORT_WORDS = 3
BLOCK_BYTES = 16 << 20
HITS = 1 << 18
BASE = np.uint64(0x9E3779B97F4A7C15)
PLAIN = re.compile(r"[^\W_]+")

RESULT = "doc_id long, item_id long, item_words long, covered_words long, coverage double, tiles array<struct<doc_word:long,item_word:long,words:long>>"


def plain_words(text: str) -> list[str]:
    return PLAIN.findall(text.lower())


def window_hashes(ids: np.ndarray, at: np.ndarray, n: int) -> np.ndarray:
    """Karp-Rabin hashes (mod 2^64) of the ``n``-word windows that start at ``at``."""
    value = np.zeros(len(at), np.uint64)
    for k in range(n):
        value = value * BASE + ids[at + k].astype(np.uint64) + np.uint64(1)
    return value


class Items:
    """One block of benchmark items, with the hashes of all their windows."""

    def __init__(self, rows: tuple[tuple[int, str], ...], min_match: int):
        self.n = min_match
        words = [plain_words(text) for _, text in rows]
        kept = [k for k, w in enumerate(words) if len(w) >= min_match]
        self.short = [(rows[k][0], w) for k, w in enumerate(words) if 0 < len(w) < min_match]
        self.item_ids = [rows[k][0] for k in kept]
        self.vocabulary = {w: i for i, w in enumerate(dict.fromkeys(w for item in words for w in item))}
        self.lengths = np.array([len(words[k]) for k in kept], np.int64)
        self.starts = np.concatenate([[0], np.cumsum(self.lengths)]).astype(np.int64)
        self.ids = np.array([self.vocabulary[w] for k in kept for w in words[k]], np.int32)
        item = np.repeat(np.arange(len(kept)), np.maximum(self.lengths - min_match + 1, 0))
        at = np.concatenate([np.arange(s, s + n - min_match + 1) for s, n in zip(self.starts, self.lengths)]) if kept else np.empty(0, np.int64)
        value = window_hashes(self.ids, at, min_match)
        order = np.argsort(value, kind="stable")
        self.seeds, self.seed_item, self.seed_at = value[order], item[order], at[order]

    def short_hits(self, offsets: np.ndarray, ids: np.ndarray) -> Iterator[tuple[int, int, int, int]]:
        """(document, item id, first word in the document, words) of items shorter than a window, once for each document."""
        lengths = np.diff(offsets)
        for item_id, words in self.short:
            n = len(words)
            if len(ids) < n:
                continue
            here = np.ones(len(ids) - n + 1, bool)
            for k, w in enumerate(words):
                here &= ids[k:len(ids) - n + 1 + k] == self.vocabulary[w]
            at = np.flatnonzero(here)
            doc = np.searchsorted(offsets, at, "right") - 1
            fits = (at + n <= offsets[doc + 1]) & ((n >= SHORT_WORDS) | (lengths[doc] == n))
            doc, first = np.unique(doc[fits], return_index=True)
            for d, i in zip(doc, at[fits][first]):
                yield int(d), item_id, int(i - offsets[d]), n

    def word_ids(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """(offsets, ids) of the texts' words; -1 for words of no item."""
        offsets, codes, chunks = split_words(texts)
        get = self.vocabulary.get
        out = []
        for c in chunks:
            low = c.lower()
            out.append((get(low, -1),) if low.isalnum() else tuple(get(w, -1) for w in PLAIN.findall(low)))
        lengths = np.fromiter(map(len, out), np.int64, len(out))
        return spread(codes, offsets, lengths, np.fromiter((i for o in out for i in o), np.int32, int(lengths.sum())))

    def matches(self, offsets: np.ndarray, ids: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """Maximal matches: (document, item, word in the batch, word among the items, words), by document and item.

        Equal windows of one diagonal are one match, found at its first window.  Windows are compared
        ``HITS`` at a time, so a word that texts and items repeat takes memory for its diagonals only."""
        n = self.n
        none = (np.empty(0, np.int64),) * 5
        if len(ids) < n or not len(self.seeds):
            return none
        good = ids >= 0
        whole = good[: len(ids) - n + 1].copy()
        for k in range(1, n):
            whole &= good[k:len(ids) - n + 1 + k]
        at = np.flatnonzero(whole)
        doc = np.searchsorted(offsets, at, "right") - 1
        inside = at + n <= offsets[doc + 1]
        at, doc = at[inside], doc[inside]
        value = window_hashes(ids, at, n)
        lo, hi = np.searchsorted(self.seeds, value, "left"), np.searchsorted(self.seeds, value, "right")
        seen = hi > lo
        at, doc, lo, times = at[seen], doc[seen], lo[seen], (hi - lo)[seen]
        ends = np.cumsum(times)
        found, a = [none], 0
        while a < len(at):
            b = max(a + 1, int(np.searchsorted(ends, (ends[a - 1] if a else 0) + HITS, "right")))
            found.append(self._maximal(offsets, ids, at[a:b], doc[a:b], lo[a:b], times[a:b]))
            a = b
        doc, item, at, place, length = map(np.concatenate, zip(*found))
        order = np.lexsort((at, place, item, doc))
        return doc[order], item[order], at[order], place[order], length[order]

    def _maximal(self, offsets: np.ndarray, ids: np.ndarray, at: np.ndarray, doc: np.ndarray, lo: np.ndarray,
                 times: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """The matches that begin at the given windows, each with ``times`` seeds from ``lo`` on."""
        at, doc, lo = (np.repeat(x, times) for x in (at, doc, lo))
        seed = lo + np.arange(len(lo)) - np.repeat(np.cumsum(times) - times, times)
        item, place = self.seed_item[seed], self.seed_at[seed]
        begins = (at == offsets[doc]) | (place == self.starts[item]) | (ids[at - 1] != self.ids[place - 1])
        at, doc, item, place = at[begins], doc[begins], item[begins], place[begins]
        same = np.ones(len(at), bool)
        for k in range(self.n):
            same &= ids[at + k] == self.ids[place + k]
        at, doc, item, place = at[same], doc[same], item[same], place[same]
        room = np.minimum(offsets[doc + 1] - at, self.starts[item + 1] - place)
        length, more = np.full(len(at), self.n), np.arange(len(at))
        while len(more := more[length[more] < room[more]]) and len(more := more[ids[(at + length)[more]] == self.ids[(place + length)[more]]]):
            length[more] += 1
        return doc, item, at, place, length


def tile(at: np.ndarray, place: np.ndarray, length: np.ndarray, n: int) -> list[tuple[int, int, int]]:
    """Greedy tiles (document word, item word, words) of at least ``n`` words from
    all maximal matches of a document and an item."""
    heap = [(-int(k), int(j), int(i)) for i, j, k in zip(at, place, length)]
    heapq.heapify(heap)
    marked_doc: set[int] = set()
    marked_item = bytearray(int((place + length).max(initial=0)))
    room, tiles = bytes(n), []
    while heap and room in marked_item:  # no tile fits where fewer than n words in a row are unmarked
        k, j, i = heapq.heappop(heap)
        free, begin = [], None
        for x in range(-k + 1):
            open_ = x < -k and i + x not in marked_doc and not marked_item[j + x]
            if open_ and begin is None:
                begin = x
            elif not open_ and begin is not None:
                free.append((begin, x))
                begin = None
        if free == [(0, -k)]:
            marked_doc.update(range(i, i - k))
            marked_item[j:j - k] = b"\1" * -k
            tiles.append((i, j, -k))
        else:
            for a, b in free:
                if b - a >= n:
                    heapq.heappush(heap, (a - b, j + a, i + a))
    return tiles


@lru_cache(maxsize=1)
def _index(block: str, min_match: int) -> Items:
    """The items of a block's folder, in order of id and text (no folder: none)."""
    fs, folder = open_folder(block)
    parts = sorted(f.path for f in fs.get_file_info(pafs.FileSelector(folder, allow_not_found=True)) if f.path.endswith(".parquet"))
    rows = [row for part in parts for row in pq.read_table(fs.open_input_file(part), columns=["item_id", "text"]).to_pylist()]
    return Items(tuple(sorted(((r["item_id"], r["text"]) for r in rows), key=lambda r: (r[0] is not None, r[0] or 0, r[1]))), min_match)


def _matches(items: Items, batch: pa.RecordBatch, text: str, coverage: float) -> Iterator[tuple[int, int, int, list[tuple[int, int, int]], int]]:
    """(row, item id, item words, tiles, covered words) of the batch's contaminated rows."""
    offsets, ids = items.word_ids(texts_of(batch.column(text)))
    for d, item_id, first, n in items.short_hits(offsets, ids):
        yield d, item_id, n, [(first, 0, n)], n
    doc, item, at, place, length = items.matches(offsets, ids)
    if not len(doc):
        return
    pair = np.flatnonzero(np.append(True, (np.diff(doc) != 0) | (np.diff(item) != 0)))
    for a, b in zip(pair, np.append(pair[1:], len(doc))):
        size, start = int(items.lengths[item[a]]), int(items.starts[item[a]])
        need = coverage * size - 1e-9
        least = min(need, PASSAGE_WORDS)
        reach = np.zeros(size + 1, np.int64)  # words that any match covers: no tiling can cover more
        np.add.at(reach, place[a:b] - start, 1)
        np.subtract.at(reach, place[a:b] - start + length[a:b], 1)
        if np.count_nonzero(np.cumsum(reach)[:size]) < least:
            continue
        tiles = tile(at[a:b] - offsets[doc[a]], place[a:b] - start, length[a:b], items.n)
        covered = sum(k for _, _, k in tiles)
        if covered >= need or sum(k for _, _, k in tiles if k >= PASSAGE_TILE) >= PASSAGE_WORDS:
            yield int(doc[a]), items.item_ids[int(item[a])], size, tiles, covered


def _find(block: str, min_match: int, coverage: float) -> Callable:
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        items = _index(block, min_match)
        for batch in bounded(batches):
            out = [(batch.column("doc_id")[d].as_py(), i, size, covered, covered / size,
                    [{"doc_word": x, "item_word": y, "words": k} for x, y, k in sorted(tiles)])
                   for d, i, size, tiles, covered in _matches(items, batch, "text", coverage)]
            if out:
                cols = list(zip(*out))
                tiles_type = pa.list_(pa.struct([("doc_word", pa.int64()), ("item_word", pa.int64()), ("words", pa.int64())]))
                types = [pa.int64()] * 4 + [pa.float64(), tiles_type]
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, types)],
                                                 ["doc_id", "item_id", "item_words", "covered_words", "coverage", "tiles"])
    return run


def _clean(block: str, min_match: int, coverage: float, text: str) -> Callable:
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        items = _index(block, min_match)
        for batch in bounded(batches, text):
            keep = np.ones(batch.num_rows, bool)
            for d, *_ in _matches(items, batch, text, coverage):
                keep[d] = False
            yield batch.filter(pa.array(keep))
    return run


def item_blocks(benchmark: DataFrame, item_col: str = "item_id", text_col: str = "text", block_bytes: int = BLOCK_BYTES) -> list[str]:
    """Folders of the benchmark's rows (item_id, text), each of about ``block_bytes`` of text."""
    spark = benchmark.sparkSession
    items = benchmark.select(F.col(item_col).cast("long").alias("item_id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    total = items.agg(F.sum(F.octet_length("text") + 16)).first()[0] or 0
    n, path = max(1, math.ceil(total / block_bytes)), scratch_path(spark, "items")
    items.withColumn("block", F.pmod(F.xxhash64("item_id", "text"), F.lit(n))).repartition("block").write.partitionBy("block").parquet(path)
    return [f"{path}/block={k}" for k in range(n)]


def _kept(df: DataFrame, name: str) -> DataFrame:
    spark, path = df.sparkSession, scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def contaminated(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text", min_match: int = MIN_MATCH,
                 coverage: float = COVERAGE, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """One row per contaminated document and item: doc_id, item_id, the
    item's words, those covered, their share and the tiles."""
    ship_package(docs.sparkSession)
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    blocks = item_blocks(benchmark, block_bytes=block_bytes)
    parts = [rows.mapInArrow(_find(block, min_match, coverage), RESULT) for block in blocks]
    return parts[0] if len(parts) == 1 else reduce(DataFrame.unionByName, [_kept(part, "contaminated") for part in parts])


def drop_contaminated(docs: DataFrame, benchmark: DataFrame, text_col: str = "text", min_match: int = MIN_MATCH,
                      coverage: float = COVERAGE, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """The rows of ``docs`` that no item contaminates, all their columns as they are."""
    ship_package(docs.sparkSession)
    for k, block in enumerate(item_blocks(benchmark, block_bytes=block_bytes)):
        before = _kept(docs, "clean") if k else docs
        docs = before.mapInArrow(_clean(block, min_match, coverage, text_col), docs.schema)
    return docs
